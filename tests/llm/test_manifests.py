"""Filter audit, Merkle manifest and line deduplication against plain forms, on small and odd tables."""

import hashlib
import random
import zlib
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.common import SCHEMA, docs, empty, lower, rows, spaced
from walletgraph.llm import filter_audit, line_dedup, merkle
from walletgraph.llm.perfect_hash import PerfectHash

LONG = " ".join(random.Random(3).choices(["alpha", "beta", "Gamma", "δέλτα"], k=300_000))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Filter audit.


def plain_audit(own, labels):
    first, good, toxic = {}, set(), set()
    for doc, text, *_ in own:
        if doc is not None:
            first[text or ""] = min(doc, first.get(text or "", doc))
    for doc, q, t in labels:
        if doc is not None:
            good |= {doc} if q == 1 else set()
            toxic |= {doc} if t == 1 else set()

    def fails(doc, text):
        t = text or ""
        w = spaced(t)
        return {f for f, x in zip("ABCDE", (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t), any(c in "#$%&*|" for c in t), doc is not None and first[t] < doc), strict=True) if x}

    seen = [(lang or "", fails(doc, text), doc in good, doc in toxic) for doc, text, lang, *_ in own]
    out = set()
    for part in {p for p, *_ in seen}:
        mine, total, lines = [x for x in seen if x[0] == part], dict.fromkeys("ABCDE", 0), []
        for order in map("".join, permutations("ABCDE")):
            for i, f in enumerate(order):
                gone = [x for x in mine if x[1] & set(order[:i])]
                here = [x for x in mine if f in x[1] and x not in gone]
                total[f] += len(here)
                lines.append((part, order, i + 1, len(mine) - len(gone) - len(here), len(here), sum(f in x[1] for x in gone), sum(x[1] == {f} for x in mine), sum(x[2] for x in here), sum(x[3] for x in here), f))
        out |= {(*x[:-1], total[x[-1]]) for x in lines}
    return out


def test_audit(spark):
    own = rows(seed=4, n=25) + [(9001, LONG, "en", None, 1, None, None), (9002, LONG, None, None, 1, None, None), (9000, LONG, "en", None, 1, None, None), (None, LONG, "en", None, 1, None, None), (9000, LONG, "en", None, 1, None, None)]
    ids = [r[0] for r in own]
    labels = [(i, i % 2 if i and i % 3 else None, int(i % 5 == 0) if i is not None else 1) for i in ids[::2]] + [(9001, 1, 1), (9001, 0, None), (None, 1, 1), (77_777, 1, 1)]
    df = spark.createDataFrame(own, SCHEMA).withColumn("mask", F.lit("x")).withColumn("digest", F.lit(0)).withColumn("part", F.lit(1.5)).repartition(5)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("text", F.lit("clash"))
    got = filter_audit.audit(df, known).collect()
    assert len(got) == 600 * len({r[2] or "" for r in own}) and set(map(tuple, got)) == plain_audit(own, labels)


def test_audit_of_nothing(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(empty(spark), labels).count() == 0
    one = spark.createDataFrame([(1, None, None, None, None, None, None)], SCHEMA)
    got = {(r.filter_order, r.step): r for r in filter_audit.audit(one, labels).collect()}
    assert len(got) == 600 and got["ABCDE", 1].removed == 1 and got["BACDE", 1].kept == 1 and got["BACDE", 1].shapley == 0 and got["EABCD", 2].shapley == 120


def test_outcomes():
    """Each mask has one outcome at each place: it is kept, removed, or was removed before."""
    m = filter_audit.outcomes()
    assert all(x.shape == (32, 600) for x in m.values())
    last = np.arange(4, 600, 5)
    assert (m["removed"].reshape(32, 120, 5).sum(axis=2) + m["kept"][:, last] == 1).all()
    assert (m["redundant"] * m["removed"] == 0).all() and (m["unique_fails"] <= m["removed"]).all()


def test_pieces(monkeypatch):
    text = LONG[:5000].encode()
    whole = filter_audit.failures(text, 5000)
    monkeypatch.setattr(filter_audit, "PIECE", 7)
    assert filter_audit.failures(text, 5000) == whole and [w for x in filter_audit.words(text) for w in x] == text.split()


# Merkle manifest.


def plain_tree(level):
    """Root and each leaf's proof steps."""
    steps, where = [[] for _ in level], [[i] for i in range(len(level))]
    while len(level) > 1:
        nxt, under = [], []
        for at in range(0, len(level), 8):
            run = level[at : at + 8]
            for i, own in enumerate(where[at : at + 8]):
                for x in own:
                    steps[x].append(("".join(run[:i]), "".join(run[i + 1 :])))
            nxt.append(sha("".join(run))), under.append([x for own in where[at : at + 8] for x in own])
        level, where = nxt, under
    return level[0], steps


def plain_manifest(own):
    field = lambda x: "-" if x is None else f"{len(str(x).encode())}:{x}"
    leaf = lambda doc, text, lang, source, n: sha("".join(map(field, (doc, source, lang, n, text))))
    parts = {}
    for doc, text, lang, source, n, *_ in own:
        parts.setdefault(lang, []).append((leaf(doc, text, lang, source, n), doc, leaf(doc, text and lower(text), lang, source, n) if doc is not None and zlib.crc32(str(doc).encode()) % 3 == 0 else leaf(doc, text, lang, source, n)))
    order = sorted(parts, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for x in order:
        parts[x].sort(key=lambda r: (r[1] is not None, r[1] or 0, r[0]))
        trees.append(plain_tree([r[0] for r in parts[x]]))
    root, upper = plain_tree([t[0] for t in trees])
    out = []
    for x, (sub, steps), rest in zip(order, trees, upper, strict=True):
        for (own_leaf, doc, start), path in zip(parts[x], steps, strict=True):
            h = start
            for left, right in path + rest:
                h = sha(left + h + right)
            out.append((doc, own_leaf, sub, root, sha("".join(a + b for a, b in path + rest)), h, h == root))
    return sorted(map(repr, out))


@pytest.mark.parametrize("langs", [(None,), ("é", "de", None, ""), tuple(f"l{i}" for i in range(30))])
def test_manifest(spark, langs):
    own = [(d, t, langs[i % len(langs)] if i % 4 else langs[0], s, n, b, k) for i, (d, t, _, s, n, b, k) in enumerate(rows(seed=5, n=20))]
    own += [(100_000 + i, "Some TEXT", langs[-1], None, None, None, None) for i in range(80)]
    df = spark.createDataFrame(own, SCHEMA)
    for c in ("tree", "place", "many", "path", "digest", "leaf"):
        df = df.withColumn(c, F.lit("clash"))
    got = merkle.manifest(df.repartition(7))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(repr, map(tuple, got.collect()))) == plain_manifest(own)


def test_small_manifests(spark):
    assert merkle.manifest(empty(spark)).count() == 0
    alone = [(3, LONG, None, "s", None, None, None)]
    got = merkle.manifest(spark.createDataFrame(alone, SCHEMA)).collect()
    assert sorted(map(repr, map(tuple, got))) == plain_manifest(alone)
    assert got[0].leaf == got[0].subroot == got[0].root and got[0].proof_sha256 == sha("")


def test_full_tree(spark):
    """65 leaves: a run of one on the lower two levels; equal rows are leaves of their own."""
    own = [(i // 2, f"t{i // 4}", "en", None, i, None, None) for i in range(65)] + [(7, "same", "en", None, 1, None, None)] * 520
    got = merkle.manifest(spark.createDataFrame(own, SCHEMA).repartition(3)).collect()
    assert sorted(map(repr, map(tuple, got))) == plain_manifest(own)
    rows_ = merkle.proofs(spark.createDataFrame(own[:65], SCHEMA), {"n_chars": F.col("n_chars") + 1})
    bad = rows_.select(merkle.folded("leaf").alias("a"), merkle.folded("altered_leaf").alias("b"), "root").collect()
    assert all(r.a == r.root != r.b for r in bad) and len(bad) == 65


# Lines.


def texts_of_lines(seed):
    rng = random.Random(seed)
    common = ["A line that stands in very many of the documents", "\x0b It is short only with its white space stripped \t", "ééééé" * 8, "é" * 39, "x" * 39, "Exactly forty code points of a line: ññ.", "z" * 41]
    out = []
    for i in range(90):
        lines = [rng.choice(common) if rng.random() < 0.6 else f"line {rng.random()} of a document of its own, number {i}" for _ in range(rng.randint(0, 9))]
        lines = [x.upper() if rng.random() < 0.2 else f"  {x}\r" if rng.random() < 0.2 else x for x in lines]
        out.append("\n".join(lines) + rng.choice(["", "\n", "\n\n"]))
    return out + [None, "", "\n", *["only a line that five documents have and no other"] * 5, *["four documents have this line, so it stays in them"] * 4, "\n".join(["the same line again and again in one document"] * 50)]


def plain_lines(own):
    strip = " \t\n\r\x0b\x0c"
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(strip))
    held = {}
    for doc, text, *_ in own:
        if doc is not None:
            for x in (text or "").split("\n"):
                held.setdefault(key(x), set()).add(doc)
    out = []
    for doc, text, *_ in own:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc is None or len(key(x)) < 40 or len(held[key(x)]) < 5 or max(held[key(x)]) == doc]
        out.append((doc, len(lines), len(lines) - len(kept), sha("\n".join(kept)), "\n".join(kept)))
    return out


@pytest.mark.parametrize("most", [line_dedup.MOST, -1])
def test_lines(spark, monkeypatch, most):
    """By arrays that all tasks have, and by arrays that stay in their shards, some of them in several copies."""
    monkeypatch.setattr(line_dedup, "LOAD", 4)
    texts = texts_of_lines(1)
    ids = random.Random(2).sample(range(1000), len(texts))
    own = [(i, t, None, None, None, "clash", i) for i, t in zip(ids, texts, strict=True)]
    own += [own[3], (own[4][0], texts[9], *own[4][2:]), (None, texts[0], *own[0][2:]), (None, texts[5], *own[0][2:]), (2000, "\n".join(t or "" for t in texts) + "\n" + LONG, *own[0][2:])]
    own += [(5000 + i, None, *own[0][2:]) for i in range(3)] + [(3000, texts[8], *own[0][2:])] * 6
    df = spark.createDataFrame(own, SCHEMA).repartition(6)
    expected = plain_lines(own)
    got = sorted(map(repr, map(tuple, line_dedup.digests(df, most=most).collect())))
    assert got == sorted(repr(x[:4]) for x in expected) and any(x[2] for x in expected)
    kept = line_dedup.remove(df.withColumns({"own_id": F.lit("x"), "own_lost": F.lit(1)}), most=most)
    assert kept.columns == [*df.columns, "own_id", "own_lost"]
    plain = sorted(repr((x[0], x[4] if x[2] else t[1])) for x, t in zip(expected, own, strict=True))
    assert sorted(repr((r.doc_id, r.text)) for r in kept.collect()) == plain
    assert all(r.n_chars is None or r.n_chars == len(r.text) for r in kept.collect())


@pytest.mark.parametrize("most", [line_dedup.MOST, -1])
def test_few_lines(spark, most):
    assert line_dedup.digests(empty(spark), most=most).count() == 0 and line_dedup.remove(empty(spark), most=most).count() == 0
    got = sorted(map(repr, map(tuple, line_dedup.digests(docs(spark, 6), most=most).collect())))
    assert got == sorted(repr(x[:4]) for x in plain_lines(rows(6)))


def test_line_pieces(monkeypatch):
    text = "\n".join(t or "" for t in texts_of_lines(2)).encode()
    whole = list(line_dedup.keys(text, 40))
    for piece in (1, 13, 200):
        monkeypatch.setattr(line_dedup, "PIECE", piece)
        assert list(line_dedup.keys(text, 40)) == whole


def test_empty_arrays_find_nothing(spark, monkeypatch):
    """The result is what the arrays say."""
    df = spark.createDataFrame([(i, "a line that all of these documents have, word for word") for i in range(9)], "doc_id long, text string")
    shards, n = line_dedup.index(df)
    row = shards.df.where("n > 0").collect()
    assert len(row) == 1 and row[0].n == 1 and row[0].load == 9 and np.frombuffer(row[0].counts, np.uint8).tolist() == [5] and np.frombuffer(row[0].largest, np.int64).tolist() == [8]
    assert sum(r.n_dropped for r in line_dedup.digests(df).collect()) == 8
    monkeypatch.setattr(line_dedup.PerfectHash, "find", lambda self, high, low: np.full(len(high), -1))
    assert line_dedup._gone(df.toArrow().to_batches()[0], "doc_id", [line_dedup.Shard(r.hash, r.prints, r.counts, r.largest) for r in row] * n, 40, 5) == {}


@pytest.mark.parametrize("many", [0, 1, 2, 63, 1000, 50_000])
def test_perfect_hash(many):
    rng = np.random.default_rng(many)
    high, low = rng.integers(0, 1 << 63, many, np.uint64), rng.integers(0, 1 << 63, many, np.uint64)
    high[: many // 2] = high[0] if many else 0  # equal halves are no equal keys
    machine = PerfectHash.from_bytes(PerfectHash.of(high, low).to_bytes())
    assert sorted(machine.find(high, low).tolist()) == list(range(many))
    other = machine.find(low + np.uint64(1), high)
    assert ((other >= -1) & (other < max(many, 1))).all() and (many < 50_000 or 8 * len(machine.to_bytes()) < 4 * many)
