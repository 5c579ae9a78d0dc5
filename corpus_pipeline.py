"""Documents to packed training sequences: language, quality, near duplicates, mixing, packing.

``STAGES`` are applied in order; the result of each is written as Parquet to the shared folder and
read again, so that a lost executor costs a stage at most. There is no SQL for the learned stages,
so ``ORACLE_SQL`` is None and the tests hold the stages against brute force.

Every stage takes nulls in any column, empty and very long texts, repeated rows, an empty table, which stays empty, and other
columns whatever their names, which pass through; ``tests/llm/test_edges.py`` runs such tables through all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from brontide.llm import langid, mixing, ngram_join, packing, quality
from brontide.llm.catalog import tokenizer_path
from brontide.llm.common import fold, table
from brontide.session import materialize

ORACLE_SQL = None
_LEAST_PROBABILITY = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a probability of one half at least.

    Null texts and texts without a letter have no language and go. Equal texts are judged alike.
    """
    model = langid.train_language_id(docs, train=~fold("doc_id", 3, 1))
    found = langid.identify_language(docs, model, into=("__lang", "__sure"))
    return found.filter(f"__lang <> '{langid.UNKNOWN}' and __sure >= {_LEAST_PROBABILITY}").select(docs.columns)


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts: a score of 0.3 at least.

    Empty texts are scored by their statistics. Without any labels every score is one half, and all stay.
    """
    model = quality.train_quality(docs, table(spark, sf_dir, "labels"), metadata=("n_chars",),
                                  train=~fold("doc_id", 5, 0))
    return quality.score_quality(docs, model, into=("__score", "__kept")).filter("__kept = 1").select(docs.columns)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, that with the least id.

    Rows equal in id and text count as one, also without words; other texts without words are near to none.
    """
    return ngram_join.keep_first(docs).select(docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, at most three times each.

    Null sources are one source; texts without words add nothing to it and are taken or not by their digest.
    """
    return mixing.repeat_rows(mixing.mix(docs)).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of the documents with their places in sequences; of every row, so repeated ones have pieces of their own.

    A null or empty text is one piece with the end alone; texts beyond 4096 tokens are cut.
    """
    return packing.pack(packing.token_pieces(docs, tokenizer_path()))


STAGES = [("language", language), ("quality", good), ("near duplicates", distinct), ("mix", mixed), ("pack", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
