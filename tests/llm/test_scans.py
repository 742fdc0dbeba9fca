"""Benchmark phrases and licences, which look at each document alone."""

import hashlib

import numpy as np
import pytest

from tests.llm.common import docs, empty, plain, rows
from walletgraph.llm import fm_index, licenses

ITEMS = "item_id long, text string"


def benchmark(spark):
    own = [t for _, t, *_ in rows() if t and len(t.split()) > 30]
    items = [(i, " ".join(t.split()[3:21])) for i, t in enumerate(own[:6])]
    items += [(100, " ".join(own[7].split()[:9])), (101, own[8].split()[4]), (101, " ".join(own[9].split()[:12])), (102, ""), (103, None), (None, own[10]), (9, " ".join(own[0].split()[3:21])), (104, "zzz " * 20)]
    return spark.createDataFrame(items, ITEMS), items


def expected(items, size):
    windows = {}
    for i, text in items:
        w = plain(text)
        k = min(size, len(w))
        for p in range(len(w) - k + 1) if w and i is not None else ():
            windows.setdefault(tuple(w[p : p + k]), set()).add(str(i))
    out = []
    for i, text, *_ in rows():
        w, found = plain(text), set()
        hit = [False] * len(w)
        for k in {len(x) for x in windows}:
            for p in range(len(w) - k + 1):
                if tuple(w[p : p + k]) in windows:
                    found |= windows[tuple(w[p : p + k])]
                    hit[p : p + k] = [True] * k
        out.append((i, len(w), sum(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(found), hit))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size,block", [(10, 1 << 20), (10, 100), (4, 1 << 20)])
def test_contamination(spark, monkeypatch, size, block):
    items, plain_items = benchmark(spark)
    out = fm_index.contamination(docs(spark), items, size, block)
    want = expected(plain_items, size)
    assert sorted(map(tuple, out.drop("spans").collect()), key=repr) == sorted((x[:-1] for x in want), key=repr)
    assert any(x[5] for x in want) and not all(x[5] for x in want)
    hits = {x[0]: x[-1] for x in want}
    for r in out.collect():
        own = [False] * r.n_words
        for lo, hi in r.spans:
            own[lo:hi] = [True] * (hi - lo)
        assert own == hits[r.doc_id]


def test_shards(spark, monkeypatch):
    items, plain_items = benchmark(spark)
    monkeypatch.setattr(fm_index, "SHARD_WORDS", 50)
    assert sorted(map(tuple, fm_index.contamination(docs(spark), items).drop("spans").collect()), key=repr) == sorted((x[:-1] for x in expected(plain_items, 10)), key=repr)


def test_decontaminate(spark):
    items, plain_items = benchmark(spark)
    own = docs(spark)
    out = fm_index.decontaminate(own, items)
    assert out.schema == own.schema
    hits = {x[0]: x[-1] for x in expected(plain_items, 10)}
    before = {r[0]: r for r in rows()}
    got = out.collect()
    assert {r.doc_id for r in got} == {i for i, h in hits.items() if not h or not all(h)}
    for r in got:
        hit = hits[r.doc_id]
        assert plain(r.text) == [w for w, h in zip(plain(before[r.doc_id][1]), hit, strict=True) if not h]
        assert tuple(r) == before[r.doc_id] if not any(hit) else r.n_chars == len(r.text)


def test_empty(spark):
    items, _ = benchmark(spark)
    none = spark.createDataFrame([], ITEMS)
    assert fm_index.contamination(empty(spark), items).collect() == []
    assert {r.contaminated for r in fm_index.contamination(docs(spark), none).collect()} == {False}
    assert fm_index.decontaminate(docs(spark), none).count() == len(rows())
    assert licenses.scan(empty(spark)).collect() == []


def test_index():
    rng = np.random.default_rng(0)
    for _ in range(20):
        n = int(rng.integers(1, 60))
        text = np.r_[rng.integers(0, 4, n), 0]
        index = fm_index.FMIndex(text, 3)
        for k in (1, 2, 4):
            phrases = rng.integers(1, 4, (10, k))
            low, high = index.search(phrases)
            for p, lo, hi in zip(phrases, low, high, strict=True):
                want = [i for i in range(len(text) - k + 1) if (text[i : i + k] == p).all()]
                assert sorted(index.locate(np.arange(lo, hi)).tolist()) == want


def test_licences(spark):
    own = [
        (1, "Released under the MIT License."),
        (2, "GNU General Public License; the gnu-general public LICENSE, cc by\napache license"),
        (3, "Licensed under the Apache License, Version 2.0 (the 'License'); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/ Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an 'AS IS' BASIS, without warranties or conditions of any kind, either express or implied."),
        (4, "Licensed under the Apache License, Version 2.1"),
        (5, "This work is licensed under the GNU General Public License, either version 3 of it"),
        (6, "mit licenses, gnu general public, apache  x license, ccby"),
        (7, None),
        (8, ""),
        (None, "cc by"),
        (9, "licensed under the terms of CC BY-NC 4.0 mit license mit license"),
        (10, "Copyright 2020 some one All rights reserved"),
    ]
    out = {r.doc_id: tuple(r)[1:] for r in licenses.scan(spark.createDataFrame([(*x, 1) for x in own], "doc_id long, text string, labels int")).collect()}
    assert out[1] == (5, 1, 3, 3, "mit", "mit,mit-notice", 1.0)
    assert out[2] == (13, 4, 0, 11, "apache,cc-by,gpl", "apache,cc-by,gpl", 0.5)
    assert out[3][4:] == ("apache", "apache,apache-2.0-header,apache-2.0-notice", 1.0)
    assert out[4][4:] == ("apache", "apache", 0.5)
    assert out[5][4:] == ("gpl", "gpl,gpl-3.0-notice", 1.0)
    assert out[6][1:] == (0, None, None, "", "", 0.0)
    assert out[7] == out[8] == (0, 0, None, None, "", "", 0.0)
    assert out[None][1:4] == (1, 0, 0)
    assert out[9][1:] == (3, 5, 12, "cc-by,mit", "cc-by,cc-by-nc-4.0-notice,mit", 1.0)
    assert out[10][4:] == ("", "rights-reserved", 1.0)
    assert licenses.scan(docs(spark)).where("n_base > 0 or labels <> ''").count() == 0


def test_whole_wording(spark):
    """A grant without its warranty paragraph, or with another one, is not the whole licence."""
    grant = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the 'Software'), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
    warranty = "The software is provided 'as is', without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement. In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software."
    header = "Licensed under the Apache License, Version 2.0 (the 'License'); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/ Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an 'AS IS' BASIS, without warranties or conditions of any kind, either express or implied. "
    end = "See the License for the specific language governing permissions and limitations under the License."
    own = [grant + warranty, grant, grant + warranty.replace("tort", "fault"), header + end, header, header + end.replace("limitations", "limits")]
    out = {r.doc_id: (r.labels.split(","), r.score) for r in licenses.scan(spark.createDataFrame(list(enumerate(own)), "doc_id long, text string")).collect()}
    assert out[0] == (["mit-grant"], 1.0) and out[1] == out[2] == ([""], 0.0)
    assert ["apache-2.0-header-whole" in out[i][0] for i in (3, 4, 5)] == [True, False, False]


def test_automaton():
    run = lambda t, text: licenses.Automaton.compile(t).accepts(np.array(licenses.word_hashes(text), np.uint64))
    t = "a <<beginOptional>>b <<beginOptional>>c<<endOptional>><<endOptional>> <<var;match=1..2>> d"
    assert all(run(t, x) for x in ("a x d", "a b c x y d", "a b x d", "a b d", "a d d", "a x y d e"))
    assert not any(run(t, x) for x in ("a d", "a", "b a x d", "a x y z d", "a b c x y z d"))
    for bad in ("<<var;match=1..2>> a", "", "<<beginOptional>>a", "<<beginOptional>>a<<endOptional>>", "a <<endOptional>>", "a <<var;match=.+>> b", "a <<var>> b", "a <<var;match=3..2>> b", "a <<note>> b"):
        with pytest.raises(ValueError):
            licenses.Automaton.compile(bad)


def test_automaton_against_expressions():
    """Random templates on random words, against a backtracking matcher."""
    import random
    import re

    rng = random.Random(6)

    def part(depth):
        kind = rng.random()
        if kind < 0.25 and depth < 3:
            inner = [part(depth + 1) for _ in range(rng.randint(1, 3))]
            return f"<<beginOptional>>{' '.join(x for x, _ in inner)}<<endOptional>>", f"(?:{''.join(y for _, y in inner)})?"
        if kind < 0.45:
            low = rng.randint(0, 2)
            high = low + rng.randint(0, 2)
            return f"<<var;match={low}..{high}>>", f"(?: [a-z]+){{{low},{high}}}"
        word = rng.choice("abc")
        return word, f" {word}"

    seen = set()
    for _ in range(300):
        parts = [part(0) for _ in range(rng.randint(1, 5))]
        machine = licenses.Automaton.compile(" ".join(["a", *(x for x, _ in parts), "b"]))
        plain_form = re.compile(" a" + "".join(y for _, y in parts) + " b(?: |$)")
        for _ in range(20):
            words = [rng.choice("abcd") for _ in range(rng.randint(0, 9))]
            want = bool(plain_form.match("".join(f" {w}" for w in words)))
            seen.add(want)
            assert machine.accepts(np.array(licenses.word_hashes(" ".join(words)), np.uint64)) == want
    assert seen == {True, False}


def test_whole_texts(spark):
    """Each template's own wording is accepted, with its regions filled or left out, by the automata and by the SQL's expressions alike."""
    import re

    from walletgraph.llm import oracles

    fill = lambda t, n: re.sub(r"<<var;match=(\d+)\.\.(\d+)>>", lambda m: " ".join(["word"] * int(m[n])), t)
    full = {label: re.sub("<<.*?>>", "", fill(t, 2)) for label, t in licenses.TEMPLATES.items()}
    lean = {label: re.sub("<<beginOptional>>.*?<<endOptional>>", "", fill(t.replace("<<beginOptional>>This <<var;match=1..3>> is<<endOptional>>", ""), 1)) for label, t in licenses.TEMPLATES.items()}
    own = [(f"{label}/{i}", f"xx {text} yy") for i, texts in enumerate((full, lean)) for label, text in texts.items()]
    cut = [(f"{label}/cut", " ".join(text.split()[:-1])) for label, text in lean.items()]
    ids = dict(enumerate(own + cut))
    got = {ids[r.doc_id][0]: r.labels.split(",") for r in licenses.scan(spark.createDataFrame([(i, t) for i, (_, t) in ids.items()], "doc_id long, text string")).collect()}
    for name, text in own + cut:
        label, kind = name.split("/")
        assert (label in got[name]) == (kind != "cut"), name
        words = "".join(f" {w}" for w in plain(text))
        assert sorted(x for x, t in licenses.TEMPLATES.items() if re.search(oracles.wording(t), words)) == sorted(set(got[name]) & set(licenses.TEMPLATES)), name
