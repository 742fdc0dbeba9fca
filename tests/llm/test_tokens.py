import collections
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs as pafs
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.common import SCHEMA, docs, empty, rows, texts
from walletgraph.llm import id_files, packing, tokens
from walletgraph.shared import new_path

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD = ["<|endoftext|> a<|endoftext|>b <|startoftext|>", "a   b", "a  b ", "\n\n x\n ", " lead", "tab\t\tx", "a \n b", "a b  c", "don't\x1cI'll", "ﬀ ẞ Σς ΑΣ", "é ́x", "  ", " ", "a\x85b", "½²①", "​ a᠎b"]


@pytest.fixture(scope="module")
def library():
    return {p: Tokenizer.from_file(p) for p in (WORD, BYTE)}


@pytest.fixture(scope="module")
def counter():
    return tokens.Counter(BYTE, tokens.whole_tokens(BYTE), remembered=50)


@pytest.fixture(scope="module")
def encoder():
    return tokens.IdEncoder(WORD, remembered=50)


def ids(library, path, text):
    return library[path].encode(text, add_special_tokens=False).ids


def check(library, counter, encoder, own):
    assert counter.count(own) == [len(ids(library, BYTE, t)) for t in own]
    assert [np.frombuffer(x, "<u2").tolist() for x in encoder.encode(own)] == [ids(library, WORD, t) for t in own]


def test_texts(library, counter, encoder):
    own = [t or "" for t in texts()] + ODD
    for _ in range(2):
        check(library, counter, encoder, own)
    for t in own:
        check(library, counter, encoder, [t])


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(codec="utf-8", max_codepoint=0x2FFF), st.sampled_from(" \n\t'.aZé")), max_size=25))
def test_any_text(library, counter, encoder, text):
    check(library, counter, encoder, [text])


def test_whole_tokens(library):
    whole = tokens.whole_tokens(BYTE)
    assert " the" in whole and "the" in whole and len(whole) > 40_000
    for t in list(whole)[::500]:
        assert len(ids(library, BYTE, t)) == 1


def test_counts(spark, library):
    got = sorted((tuple(r) for r in tokens.token_counts(docs(spark), BYTE, 40).collect()), key=repr)
    want = [(i, len((t or "").encode()), n := len(ids(library, BYTE, t or "")), n > 40) for i, t, *_ in rows()]
    assert got == sorted(want, key=repr)
    assert tokens.token_counts(empty(spark), BYTE).collect() == []


def test_groups():
    assert [x for _, part in tokens.groups(pa.array(["a", None, "b" * 50, "c"]), 2, 10) for x in part] == ["a", "", "b" * 50, "c"]


@pytest.mark.parametrize("capacity", [2048, 64, 7])
def test_pack(spark, library, capacity):
    out = packing.pack(docs(spark), WORD, capacity).collect()
    want = collections.Counter()
    for i, t, *_ in rows():
        own = ids(library, WORD, t or "") + [0]
        for piece, start in enumerate(range(0, len(own), capacity)):
            part = np.array(own[start : start + capacity], "<u4")
            want[i, piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    assert collections.Counter(tuple(r)[:5] for r in out) == want
    fill = collections.defaultdict(list)
    for r in out:
        fill[r.sequence_id].append((r.offset, r.length))
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(fill) == plain_best_fit([r.length for r in out], capacity)


def plain_best_fit(lengths, capacity):
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, room in enumerate(bins) if room >= n]
        if fits:
            bins[min(fits, key=lambda i: bins[i])] -= n
        else:
            bins.append(capacity - n)
    return len(bins)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_best_fit(lengths):
    plan = packing.best_fit(collections.Counter(lengths), 20)
    fill, ranks = collections.defaultdict(list), collections.Counter()
    for n in lengths:
        rank = ranks[n]
        ranks[n] += 1
        own = plan[(plan[:, 0] == n) & (plan[:, 1] <= rank)]
        _, first, start, each, place = own[own[:, 1].argmax()]
        fill[start + (rank - first) // each].append((place + (rank - first) % each * n, n))
    for parts in fill.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 20
    assert len(fill) == plain_best_fit(lengths, 20)


def test_pack_empty(spark):
    assert packing.pack(empty(spark), WORD).collect() == []
    one = spark.createDataFrame([(None,) * 7], SCHEMA)
    assert [tuple(r) for r in packing.pack(one, WORD).collect()] == [(None, 0, 0, 1, zlib.crc32(b"\0\0\0\0"), 0, 0)]


def test_files(spark, library):
    own, folder = docs(spark), new_path(spark, "test")
    files, dictionary = id_files.write(own, WORD, folder)
    got = id_files.read(files, folder, dictionary).collect()
    start, at = [], 0
    for i, t, *_ in sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        part = np.array(ids(library, WORD, t or "") + [1], "<u4")
        start.append((i, at, len(part), zlib.crc32(part.tobytes())))
        at += len(part)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == start
    system, place = pafs.FileSystem.from_uri(folder)
    for r in files.collect():
        reader = id_files.Reader(system.open_input_file(f"{place}/{r.file}"), dictionary)
        for doc in set(reader.docs.tolist()) - {-(1 << 63)}:
            assert [(len(x), zlib.crc32(x.astype("<u4").tobytes())) for x in reader.document(doc)] == [(n, c) for i, _, n, c in start if i == doc]
        assert reader.document(10**9) == []
        with pytest.raises(ValueError):
            id_files.Reader(system.open_input_file(f"{place}/{r.file}"), b"another")


def test_files_empty(spark):
    folder = new_path(spark, "test")
    files, dictionary = id_files.write(empty(spark), WORD, folder)
    assert id_files.read(files, folder, dictionary).collect() == []


def test_many_rows_of_one_id(spark, library):
    """Rows without an id, or with one, are dealt to several files and keep their order."""
    own, folder = [(None, f"{i % 97} null words {i}") for i in range(400)] + [(3, f"{i % 89} more words {i}") for i in range(300)] + [(5, "same")] * 50, new_path(spark, "test")
    files, dictionary = id_files.write(spark.createDataFrame(own, "doc_id long, text string").repartition(4), WORD, folder)
    assert sum(r.n_docs > 0 for r in files.collect()) >= 5 and max(r.n_docs for r in files.collect()) < 300
    want, at = [], 0
    for i, t in sorted(own, key=lambda r: (r[0] or 0, r[1])):
        part = np.array(ids(library, WORD, t) + [1], "<u4")
        want.append((i, at, len(part), zlib.crc32(part.tobytes())))
        at += len(part)
    assert sorted(map(tuple, id_files.read(files, folder, dictionary).collect()), key=lambda r: r[1]) == want


def test_starts_over_runs_of_files(spark, monkeypatch):
    """Starts are the same however many files' sums are taken together."""
    own, folder = docs(spark), new_path(spark, "test")
    files, dictionary = id_files.write(own, WORD, folder)
    want = sorted(map(tuple, id_files.read(files, folder, dictionary).collect()), key=repr)
    for shift in (0, 1, 2):
        monkeypatch.setattr(id_files, "TOGETHER_SHIFT", shift)
        assert sorted(map(tuple, id_files.read(files, folder, dictionary).collect()), key=repr) == want
