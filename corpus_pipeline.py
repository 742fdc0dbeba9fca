"""A packed training corpus from raw documents, in stages that are each written as Parquet before the next reads it.

1. language: documents whose language can't be told go, and letters that are no language, such as hex or random ones.
2. near copies: of each group of documents with similar word sets the one with the smallest doc_id stays.
3. repeats: passages of 50 words that also stand in a document with a smaller doc_id are cut out.
4. benchmark: words covered by a benchmark's phrases are cut out.
5. packing: the remaining texts become token sequences of one length.

Rows of the first four have the columns of documents, with text and n_chars as the stage left them.

Defined cases, by stage:

* Null, empty and letterless texts: language drops them, whatever was learned. Handed to a later stage they
  stay unchanged in near copies, repeats and benchmark, and are one piece, the end id, in packing.
* Very long texts are worked on whole by every stage; packing cuts them into pieces.
* Null lang: not learned from; where no label is left at all, language keeps all texts with a letter. Two
  languages of equal score: the text is not ahead in either and goes.
* Null doc_id: never learned from, never a near copy, never cut by or a cause of repeats; cleaned of the
  benchmark and packed like any other.
* Repeated rows: one doc_id stands for its component, so all its rows stay or go together in near copies;
  they don't cut each other's words in repeats; each row is packed. Ties between copies go to the smaller doc_id.
* Texts without a word left by repeats or benchmark: their rows go.
* Empty tables give empty tables; an empty benchmark cuts nothing; benchmark items without id or words count not.
* Extra columns, whatever their names, pass the first four stages unchanged; packing returns its own columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from walletgraph.llm import fm_index, jaccard, language, packing, repeats
from walletgraph.llm.catalog import WORD_VOCABULARY
from walletgraph.shared import Table

#: How many times the next language's share the best one's must be: where no language is known, all are near each other, however many there are.
AHEAD = 1.1
#: Not expressible in SQL: the classifier and the packing.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.identified(docs, language.fit(docs, noise=True), AHEAD)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.representatives(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return repeats.remove(docs, "suffix_array")


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return fm_index.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path(WORD_VOCABULARY))


STAGES = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("repeats", cut_repeats),
    ("benchmark", cut_benchmark),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        new = Table(stage(spark, docs, sf_dir), name, rebalance=False)
        if held:
            held.drop()
        docs, held = new.df, new
    return STAGES[-1][1](spark, docs, sf_dir)
