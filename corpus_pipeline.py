"""The corpus pipeline: each stage works on all that the one before it kept."""

from __future__ import annotations

import functools
import threading
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from maktaba.llm import knn_quality, ngram_join, packing, quality_rules, suffix_dedup
from maktaba.llm.common import collecting, drop, staged

#: What each stage left in the shared folder, by thread, sf_dir and place. A stage's result is written before the next
#: stage of that run starts, so the next stage deletes what its predecessor left. Runs in other threads are not touched.
_left: dict[tuple[int, str, int], list[str]] = {}


def _stage(place: int):
    def wrap(function: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
        @functools.wraps(function)
        def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            run_ = (threading.get_ident(), sf_dir)
            drop(spark, _left.pop((*run_, place - 1), []))
            with collecting() as made:
                found = function(spark, docs, sf_dir)
            _left.setdefault((*run_, place), []).extend(made)
            return found

        return run_stage

    return wrap


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


@_stage(0)
def keep_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, all columns unchanged.

    A null or empty text has no words and goes by the base rules; equal texts fare alike; a null id is judged by its text
    and only never learnt from; without labels the base rules decide alone; an empty table gives an empty one.
    """
    return quality_rules.keep(docs, quality_rules.learn(docs, _labels(spark, sf_dir)))


@_stage(1)
def keep_by_neighbours(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps, all columns unchanged.

    Null and empty texts are scored like a text without content; equal texts fare alike; without labels every score is the
    neutral one of knn_quality; an empty table gives an empty one.
    """
    return knn_quality.keep(docs, knn_quality.learn(docs, _labels(spark, sf_dir)))


@_stage(2)
def keep_one_of_alike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group that the n-gram Jaccard join finds, all columns unchanged.

    Documents without words, and rows with a null id, link with nothing and stay; of rows with one id and equal sets one
    stays; an empty table gives an empty one.
    """
    return ngram_join.keep_one(docs)


@_stage(3)
def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the strings that a document with a smaller id holds.

    No row goes: a text may become empty, a null text stays null; rows with equal ids don't cut each other; a null id
    counts as the largest.
    """
    return suffix_dedup.cut_repeats(docs)


@_stage(4)
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 ids.

    A null or empty text has its end id alone; a text of any length is cut into as many pieces as it needs; an empty table
    gives no pieces.
    """
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", keep_by_rules),
    ("quality classifier", keep_by_neighbours),
    ("n-gram Jaccard join", keep_one_of_alike),
    ("suffix-array dedup", cut_repeated_passages),
    ("packing", pack_sequences),
]

#: Learnt models decide which documents stay, which SQL can't express; the tests hold the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each stage's result written and read again, and deleted once it is read."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            with collecting() as made:
                docs = staged(docs, f"stage_{i + 1}")
            drop(spark, before)
            before = list(made)
    return docs
