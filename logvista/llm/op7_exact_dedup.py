"""Exact de-duplication with the frequent digests split off.

A Misra-Gries summary (Spark's ``approx_top_k`` family, which keeps one in a DataSketches frequent-items sketch) names the
digests that may be frequent. They are verified by an exact count, and the few winners go to every task by broadcast, so
that rows of a large group are settled where they are read and never meet in one task. All other digests are grouped by an
ordinary shuffle. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import Workspace, free_name, read_table

#: Winners at most, and counters of each summary: every digest with more than about 1/2800 of a task's rows is kept in it, so
#: that of those left to the shuffle none has more than about a thousandth of all rows.
WINNERS, COUNTERS, FAN_IN = 1000, 4096, 64

#: Runs of white space that are not one space already; the rest of ``[ \t-\r]+`` needs no change.
_RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalized(text) -> F.Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), _RUNS, " ")


def frequent(digests: DataFrame, column: str, winners: int = WINNERS, counters: int = COUNTERS) -> DataFrame:
    """At most ``winners`` rows (column): candidates for the most frequent values. Summaries of tasks are merged in two steps.

    The last step is grouped too, since a summary without values, as a task without rows would make one, can't be merged.
    """
    part = digests.groupBy(F.pmod(F.spark_partition_id(), F.lit(FAN_IN)).alias("part_"))
    sketches = part.agg(F.expr(f"approx_top_k_accumulate({column}, {counters})").alias("s"))
    top = sketches.groupBy(F.lit(0).alias("all_")).agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(s, {counters}), {winners})").alias("top"))
    return top.select(F.explode("top").alias("x")).select(F.col("x.item").alias(column))


def _digest(text_col: str) -> F.Column:
    return F.sha2(normalized(F.col(text_col)).cast("binary"), 256)


def _groups(own: DataFrame, work: Workspace) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of (id, digest, row): the groups of frequent digests, the rows of all others, and the groups of those.

    A group is (digest, first, group_size), ``first`` the id and row that stay.
    """
    first = F.min(F.struct(F.col("id").isNull().alias("absent"), "id", "row")).alias("first")
    group = [first, F.count("*").alias("group_size")]
    hot = work.keep(
        own.join(F.broadcast(frequent(own, "digest")), "digest").groupBy("digest").agg(*group).where("group_size > 1"), "hot"
    )
    rest = own.join(F.broadcast(hot), "digest", "left_anti")
    return hot, rest, rest.groupBy("digest").agg(*group)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a row of ``docs``: (id_col, keep_id, group_size, kept, text_sha256).

    Texts are equal if they are after each run of ASCII white space became one space; null counts as empty. Of equal texts
    the row with the smallest id stays; of rows with that id, one; a row without id stays only if no row of its group has
    one. Texts of any length are read whole, an empty table gives no rows, and other columns are not read.
    """
    work = Workspace(docs.sparkSession, "exact")
    own = work.keep(docs.select(F.col(id_col).alias("id"), _digest(text_col).alias("digest")).withColumn("row", F.monotonically_increasing_id()), "digests")
    hot, rest, others = _groups(own, work)
    large = own.join(F.broadcast(hot), "digest")  # at most WINNERS rows
    other = rest.join(others, "digest")
    return large.unionByName(other).select(
        F.col("id").alias(id_col), F.col("first.id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"), F.col("digest").alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``exact_duplicates`` keeps: one row of each group of equal texts.

    Rows are numbered in a copy of ``docs``, so that neither repeated nor missing ids matter.
    """
    work = Workspace(docs.sparkSession, "exact")
    digest, row, stays = (free_name(docs, n) for n in ("digest", "row", "stays"))
    whole = work.keep(docs.withColumns({digest: _digest(text_col), row: F.monotonically_increasing_id()}), "rows")
    hot, _, others = _groups(whole.select(F.col(id_col).alias("id"), F.col(digest).alias("digest"), F.col(row).alias("row")), work)
    kept = hot.unionByName(others).select(F.col("first.row").alias(stays))
    return whole.join(kept, F.col(row) == F.col(stays), "left_semi").drop(digest, row)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(read_table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""
