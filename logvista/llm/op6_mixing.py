"""Mixing sources to target weights by capped water-filling. DataFrame operations only.

A source whose share would exceed its largest number of epochs is held at that; what it leaves over goes to the others in
proportion to their weights, again and again until none is above. Each document is then taken a whole number of times, and
once more if it comes early enough in a seeded order of its source for the fraction that is left. That order is cut by
bucket totals, so that only the one bucket in which the cut falls is summed, however large the source. Where the cut falls
is kept as a place in the order, so that every row decides for itself and none has to be looked up.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import Workspace, broadcast_if_small, free_name, join_split, read_table

WORD = r"[^\x20\x09-\x0D]+"
#: Sources up to which their plan is broadcast; beyond, frequent sources are and the others are joined by a shuffle.
FEW = 20_000
#: Sources that are put in order in one task, about.
SORTED = 200_000


@dataclass(frozen=True)
class Mix:
    rows: DataFrame  #: what ``_keyed`` makes of every row, and its number ``row``
    plan: DataFrame  #: src, source_size, target, whole, cut, p, upto of every source
    work: Workspace


def _keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> list[Column]:
    """id, src (the source, not null), size, key (the seeded order: by id, or by text where that is null) and tie."""
    text, id_, source = F.col(text_col).cast("string"), F.col(id_col).cast("string"), F.col(source_col).cast("string")
    name = F.coalesce(id_, F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return [
        F.col(id_col).alias("id"), F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("src"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.concat(name, F.lit(f"|{seed}")).cast("binary")).alias("key"), F.xxhash64(text).alias("tie"),
    ]


def _weighed(sizes: DataFrame, weights: tuple[int, ...], work: Workspace) -> DataFrame:
    """``sizes`` (src, source_size) with the weight of each source by its place in code-point order, null last, in parts."""
    order = [F.col("src") == "", F.col("src")]
    tasks = max(1, -(-sizes.count() // SORTED))
    placed = sizes.repartitionByRange(tasks, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    placed = work.keep(placed, "ordered").withColumn("part", F.shiftright("at", 33))
    parts = placed.groupBy("part").agg(F.count("*").alias("n"))  # a row for each task
    base = parts.select("part", (F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("base"))
    rank = F.col("base") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int")).cast("double")
    return placed.join(F.broadcast(base), "part").select("src", "source_size", weight.alias("weight"))


def _targets(sources: DataFrame, max_epochs: int) -> DataFrame:
    """Water-filling: a source is held at its cap once its share of what the held ones leave reaches that."""
    cap = F.col("source_size").cast("double") * max_epochs
    total, open_ = sources.agg(F.sum(F.col("source_size").cast("double")), F.sum("weight")).first()
    total, held, open_ = total or 0.0, 0.0, open_ or 0.0
    while True:
        full = cap * open_ <= (total - held) * F.col("weight") if open_ else F.lit(True)
        now = sources.agg(F.sum(F.when(full, cap).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        now = (now[0] or 0.0, now[1] or 0.0)
        if now == (held, open_):
            break
        held, open_ = now
    share = (total - held) * F.col("weight") / (open_ or 1.0)
    target = F.when(full, cap).otherwise(share)
    whole = F.when(F.col("source_size") > 0, F.floor(target / F.col("source_size"))).otherwise(0)
    return sources.select("src", "source_size", target.alias("target"), whole.alias("whole"), (target - whole * F.col("source_size")).alias("need"))


def _bucket() -> Column:
    return F.substring("key", 1, 3)


def _cut(rows: DataFrame, sources: DataFrame, work: Workspace) -> DataFrame:
    """``sources`` with the place of the cut: bucket ``cut``, in it the first ``p`` (key, size, tie) of which not all copies are
    taken (null if all are), and of those the rows up to number ``upto``.

    Rows of one ``p`` are alike: their copies are counted and not put in order.
    """
    totals = rows.groupBy("src", _bucket().alias("bucket")).agg(F.sum("size").alias("s"))
    base = F.sum("s").over(Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("s")
    at = totals.withColumn("base", base).join(broadcast_if_small(sources, FEW), "src").where("need > 0 and base <= need and need < base + s")
    at = work.keep(at.select("src", F.col("bucket").alias("cut"), "base", "need"), "cut")
    inside = rows.join(broadcast_if_small(at, FEW).withColumnRenamed("src", "of"), (F.col("src") == F.col("of")) & (_bucket() == F.col("cut")))
    alike = inside.groupBy("src", "key", "size", "tie").agg(F.count("*").alias("m"), F.first("base").alias("base"), F.first("need").alias("need"))
    order = Window.partitionBy("src").orderBy("key", "size", "tie").rowsBetween(Window.unboundedPreceding, 0)
    own = F.col("m") * F.col("size")
    before = F.col("base") + F.sum(own).over(order) - own
    alike = alike.select("src", F.struct("key", "size", "tie").alias("p"), "m", "size", "need", before.alias("before"))
    one = F.col("before") * 2 + F.col("size") <= F.col("need") * 2  # a copy is taken if the cut lies behind its middle
    more = F.floor((F.col("need") * 2 - F.col("size") - F.col("before") * 2) / (F.greatest(F.lit(1), "size") * 2)) + 1
    some = F.when(~one, 0).when((F.col("m") == 1) | (F.col("size") == 0), F.col("m")).otherwise(F.least("m", F.greatest(F.lit(1), more)))
    first = alike.withColumn("some", some).where("some < m").groupBy("src").agg(F.min(F.struct("p", "some")).alias("f"))
    first = work.keep(first.select("src", "f.p", F.col("f.some").alias("some")), "first")
    # Of alike rows the ones with the smallest numbers: counts of each task's rows first, then one task's rows.
    split = broadcast_if_small(first.where("some > 0"), FEW).withColumnRenamed("src", "of")
    mine = rows.join(split, (F.col("src") == F.col("of")) & (F.struct("key", "size", "tie") == F.col("p"))).select("src", "some", "row", F.shiftright("row", 33).alias("part"))
    mine = work.keep(mine, "alike")
    parts = mine.groupBy("src", "part").agg(F.count("*").alias("n"), F.first("some").alias("some"))
    there = F.sum("n").over(Window.partitionBy("src").orderBy("part").rowsBetween(Window.unboundedPreceding, 0))
    parts = parts.withColumn("to", there).where("to - n < some and some <= to").select("src", "part", (F.col("some") - F.col("to") + F.col("n")).alias("nth"))
    nth = F.row_number().over(Window.partitionBy("src").orderBy("row"))
    last = mine.join(parts, ["src", "part"]).withColumn("i", nth).where("i = nth").select("src", F.col("row").alias("upto"))
    return work.keep(sources.join(at.select("src", "cut"), "src", "left").join(first.drop("some"), "src", "left").join(last, "src", "left"), "plan")


def _planned(rows: DataFrame, weights: tuple[int, ...], max_epochs: int, work: Workspace) -> Mix:
    sizes = work.keep(rows.groupBy("src").agg(F.sum("size").alias("source_size")), "sizes")
    sources = work.keep(_weighed(sizes, weights, work), "sources")
    return Mix(rows, _cut(rows, work.keep(_targets(sources, max_epochs), "targets"), work), work)


def plan_mix(
    docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, seed: int = 7, id_col: str = "doc_id",
    text_col: str = "text", source_col: str = "source",
) -> Mix:
    """How often each row is taken. A size is the number of words (null: 0); sources sorted by code point, null last, take ``weights`` in turn.

    Repeated rows and rows without id count each for itself; of rows that are alike in id, source and text, any may be the
    ones that are taken once more. An empty table gives an empty plan. Other columns are not read.
    """
    work = Workspace(docs.sparkSession, "mix")
    rows = docs.select(*_keyed(docs, id_col, text_col, source_col, seed), F.monotonically_increasing_id().alias("row"))
    return _planned(work.keep(rows, "rows"), weights, max_epochs, work)


def _joined(rows: DataFrame, mix: Mix) -> DataFrame:
    """Rows with src, size, key, tie and row, and the plan of their source and ``repetitions``."""
    plan = broadcast_if_small(mix.plan, FEW)
    both = rows.join(plan, "src") if plan is not mix.plan else join_split(rows, plan, ["src"], mix.work)
    mine, bucket = F.struct("key", "size", "tie"), _bucket()
    extra = (
        F.when(F.col("cut").isNull() | (bucket > F.col("cut")), 0).when((bucket < F.col("cut")) | F.col("p").isNull() | (mine < F.col("p")), 1)
        .when((mine == F.col("p")) & (F.col("row") <= F.col("upto")), 1).otherwise(0)
    )
    return both.withColumn("repetitions", F.col("whole") + extra)


def mix_plan(mix: Mix) -> DataFrame:
    """One row a row: (id, source, size, source_size, target, repetitions)."""
    source = F.when(F.col("src") != "", F.substring("src", 2, 1 << 30))
    return _joined(mix.rows, mix).select("id", source.alias("source"), "size", "source_size", "target", "repetitions")


def mixed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 7, weights: tuple[int, ...] = (1, 2, 3),
    max_epochs: int = 3,
) -> DataFrame:
    """The rows of ``docs`` with all their columns, each as often as the mix takes it (zero to ``max_epochs`` times).

    Exactly what ``plan_mix`` plans: rows are numbered in a copy of ``docs``, so that repeated and missing ids don't matter.
    Rows without words are taken as often as their source is taken whole, or once more before the cut. Texts are not shuffled.
    """
    work = Workspace(docs.sparkSession, "mix")
    here, again = (free_name(docs, n) for n in ("mix", "mix_again"))
    whole = work.keep(docs.withColumn(here, F.struct(*_keyed(docs, id_col, text_col, source_col, seed), F.monotonically_increasing_id().alias("row"))), "rows")
    mix = _planned(whole.select(f"{here}.*").drop("id"), weights, max_epochs, work)
    packed = whole.select(F.struct(*docs.columns).alias("doc"), f"{here}.*").drop("id")
    return _joined(packed, mix).select("doc.*", F.explode(F.array_repeat(F.lit(0), F.col("repetitions").cast("int"))).alias(again)).drop(again)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mix_plan(plan_mix(read_table(spark, sf_dir, "documents")))
    return plan.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("repetitions")).alias("taken"))


SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                  md5(coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, ''))) || '|7') AS key FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank, CAST(source_size AS DOUBLE) * 3 AS cap,
             CAST(sum(source_size) OVER () AS DOUBLE) AS total FROM s),
w AS (SELECT *, CAST(1 + rank % 3 AS DOUBLE) AS weight FROM r),
f AS (SELECT *, sum(cap) OVER (ORDER BY cap / weight, rank ROWS UNBOUNDED PRECEDING) - cap AS below,
             sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS above FROM w),
g AS (SELECT *, cap * above <= (total - below) * weight AS is_full FROM f),
h AS (SELECT *, sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER () AS held,
             sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER () AS open FROM g),
t AS (SELECT source, source_size, CASE WHEN is_full THEN cap ELSE (total - held) * weight / open END AS target FROM h),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
c AS (SELECT d.doc_id, d.size, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS need,
             CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size AS DOUBLE) AS before
      FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN need > 0 AND before * 2 + size <= need * 2 THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM c
"""
