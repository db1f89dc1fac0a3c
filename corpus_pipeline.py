"""From raw documents to token ids: language, toxicity, near-duplicates, mixing, encoding.

Each stage takes what its predecessor kept and returns documents; the last returns their token ids. Rows are handed on whole,
whatever their columns are called; a NULL in a column that a stage does not read changes nothing. Texts are read whole. An empty
table gives an empty one with the same columns.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tierloom.llm import bpe, language, mixing, ngram_join, toxicity
from tierloom.llm.common import stored

#: Least posterior probability of a document's language.
SURE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; those without letters, or of no clear language, go.

    NULL, empty and blank texts have no letters. A NULL ``lang`` is not learned from. Rows with a NULL id, and rows that repeat others, are judged one by one
    and stay or go with their text.
    """
    vocabulary = public_tokenizers.path("piece_bpe_32k.model")
    found = language.predicted(docs, language.train(docs, vocabulary), vocabulary, whole=True)
    return found.where((found.lang_pred != language.UNKNOWN) & (found.score >= SURE)).select("row.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic.

    Labels without id or label, and labelled texts that are NULL, are not learned from. NULL and empty texts are scored as empty ones. Rows with a NULL id,
    and rows that repeat others, are scored one by one.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, toxicity.labelled(docs, labels))
    return toxicity.scored(docs, model, whole=True).where("predicted = 0").select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, that of the smallest id.

    Of rows that repeat an id and a text one stays. A row with a NULL id stays only if its class has no other. NULL, empty and blank texts are near to
    nothing; of those that share an id one stays.
    """
    return ngram_join.deduplicated(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, shard by shard, shuffled.

    A NULL source is a source. NULL and empty texts have no words and come as often as their place in the draw says. Rows with a NULL id, and rows that
    repeat others, are drawn one by one, at most twice each.
    """
    return mixing.mixed(docs).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the hashes of ids and decoded text.

    NULL and empty texts have no ids and the hashes of the empty string. Rows with a NULL id, and rows that repeat others, give a row each.
    """
    return bpe.encoded(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each one's result a table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs


#: No SQL expresses the stages; tests/llm holds them against brute force.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
REGISTERED_SQL: dict[str, str] = {}
