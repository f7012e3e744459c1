"""A training corpus from ``documents``: quality, exact and near copies, mixture, packing; each stage is written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from logvista.llm.op1_minhash import drop_near_duplicates
from logvista.llm.op2_packing import pack
from logvista.llm.op3_quality import keep_good, learn
from logvista.llm.op6_mixing import mixed
from logvista.llm.op7_exact_dedup import drop_exact_duplicates
from logvista.llm.shared import Workspace, read_table, scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


# Every stage takes all rows of its predecessor, with nulls in any column, empty and very long texts, repeated rows, rows without
# id and ids on several rows; rows are told apart by themselves and not by their ids. An empty table gives an empty one. All
# but the last keep all columns, whatever their names.


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a classifier of ``labels.quality`` does not reject. Each row is judged by its text, null as empty."""
    return keep_good(docs, learn(docs, read_table(spark, sf_dir, "labels")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts (white space aside, null as empty), one with the smallest id."""
    return drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies (runs of five words, similarity 0.8), one with the smallest id.

    Texts without words and rows without id are near copies of nothing and stay.
    """
    return drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask, three times at most; null is a source of its own."""
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document and its place in a sequence of 1024 ids; a null text counts as empty."""
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [("quality", quality), ("exact", exact), ("near", near), ("mix", mix), ("packing", packing)]

#: SQL can express neither the classifier nor the tokens; all rows of ``run`` are tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scratch():  # what a stage wrote for itself goes once its rows are written
            docs = work.keep(stage(spark, docs, sf_dir), name)
    return docs
