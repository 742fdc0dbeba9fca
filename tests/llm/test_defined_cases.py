"""Very long texts, columns whose names operators use themselves, and empty tables, for every operator on documents."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.common import empty, plain, spaced
from walletgraph.llm import catalog, fm_index, id_files, jaccard, language, licenses, line_dedup, merkle, packing, repeats, tokens
from walletgraph.shared import new_path

WORD, BYTE = (public_tokenizers.path(x) for x in (catalog.WORD_VOCABULARY, catalog.BYTE_VOCABULARY))
CLASHING = "task lengths rank label bucket kind start piece n_words n_tokens print slot part nth bits spans key keys own_id shard".split()
PASSAGE = "seven quiet herons crossed the flooded meadow before the early bells began"


def _long():
    rng = random.Random(5)
    return " ".join("".join(rng.choices("aeinorst", k=rng.randint(2, 7))) for _ in range(60_000))


LONG = f"{_long()}\n{PASSAGE} GNU General Public License"
#: The long text, a near copy that differs in its last word only, odd ones, and two that repeat an id.
ROWS = [(1, LONG, "en"), (2, LONG + "s", "en"), (3, None, None), (4, "", "de"), (5, "two words", "de"), (5, "two words", "de"), (6, f"so {PASSAGE}", None), (None, "no id", "en")]


@pytest.fixture(scope="module")
def narrow(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, lang string").repartition(3).cache()


@pytest.fixture(scope="module")
def wide(narrow):
    return narrow.select("*", *(F.lit(i if i % 2 else str(i)).alias(c) for i, c in enumerate(CLASHING)))


def _items(spark):
    return spark.createDataFrame([("a", PASSAGE)], "item_id string, text string")


def _files(df):
    folder = new_path(df.sparkSession, "test")
    files, dictionary = id_files.write(df, WORD, folder)
    return id_files.read(files, folder, dictionary)


OPERATORS = {
    1: lambda df: packing.pack(df, WORD).select("doc_id", "piece", "start", "length", "ids_crc32"),
    2: lambda df: fm_index.contamination(df, _items(df.sparkSession)),
    3: licenses.scan,
    4: lambda df: tokens.token_counts(df, BYTE),
    5: _files,
    6: lambda df: repeats.digests(df, "suffix_array"),
    7: lambda df: jaccard.near_duplicates(df, k=4, num=85, den=100),
    8: lambda df: repeats.digests(df, "automata"),
    10: lambda df: language.predict(df, language.fit(df)),
    12: lambda df: merkle.manifest(df.select("*", *(F.lit(None).cast(t).alias(c) for c, t in (("source", "string"), ("n_chars", "int"))))),
    13: line_dedup.digests,
}


@pytest.mark.parametrize("number", sorted(OPERATORS))
def test_clashing_names_change_nothing(narrow, wide, number):
    seen = [sorted(map(repr, map(tuple, OPERATORS[number](df).collect()))) for df in (narrow, wide)]
    assert seen[0] == seen[1] and len(seen[0]) >= len(ROWS) - (number == 7)


@pytest.mark.parametrize("number", sorted(OPERATORS))
def test_empty_table(spark, number):
    assert OPERATORS[number](empty(spark).drop("source", "n_chars")).collect() == []


def _of(df, number, doc_id=1):
    return [r for r in OPERATORS[number](df).collect() if r.doc_id == doc_id]


def test_very_long_texts_are_read_to_their_end(narrow):
    """What stands in the last line of a text of some 300,000 characters is found, and counts are the library's."""
    words, own = plain(LONG), spaced(LONG)
    hit = _of(narrow, 2)[0]
    assert (hit.n_words, hit.n_hit, hit.n_items) == (len(words), len(PASSAGE.split()), 1)
    licence = _of(narrow, 3)[0]
    assert (licence.n_words, licence.first_word, licence.base_labels) == (len(words), len(words) - 4, "gpl")
    counted = _of(narrow, 4)[0]
    assert counted.n_tokens == len(Tokenizer.from_file(BYTE).encode(LONG, add_special_tokens=False).ids) and counted.over_limit
    n = len(Tokenizer.from_file(WORD).encode(LONG, add_special_tokens=False).ids) + 1
    assert _of(narrow, 5)[0].n_tokens == n
    pieces = sorted(_of(narrow, 1), key=lambda r: r.piece)
    assert [r.start for r in pieces] == list(range(0, n, 2048)) and sum(r.length for r in pieces) == n
    shingles = {tuple(x.lower() for x in own[i : i + 4]) for i in range(len(own) - 3)}
    assert _of(narrow, 7)[0].n_shingles == len(shingles) and _of(narrow, 7, 2)[0].component_id == 1
    for number in (6, 8):  # all words of the second are in the first, but its last
        cut = _of(narrow, number, 2)[0]
        assert (cut.n_words, cut.n_removed) == (len(own), len(own) - 1) and _of(narrow, number)[0].n_removed == 0
