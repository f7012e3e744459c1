"""Samples and splits that keep actors or time whole, all by a seeded hash or a total order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.staging import staged


def seeded(column: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(column).cast("string"), F.lit(f"|{seed}")).cast("binary"))


#: Rows that are put in order in one task, about.
IN_ORDER = 250_000


def number_rows(df: DataFrame, order: list[Column], out: str = "position") -> DataFrame:
    """Rows numbered from 0 by a total order, without sorting them in one task.

    Ranges of the order are dealt to tasks, in proportion to the rows, sorted there, and numbered from the number of rows
    before each range; what is summed in one place is a count a task. Ranges are cut by all columns of the order, so that many
    rows of one time don't meet in one task.
    """
    tasks = max(1, -(-df.count() // IN_ORDER))
    placed = df.select("*", *(c.alias(f"order{i}_") for i, c in enumerate(order)))
    keys = [F.col(f"order{i}_") for i in range(len(order))]
    placed = placed.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys).withColumn("at_", F.monotonically_increasing_id()).drop(*(f"order{i}_" for i in range(len(order))))
    if tasks == 1:
        return placed.withColumnRenamed("at_", out)
    placed = staged(placed, "ordered").withColumn("task_", F.shiftright("at_", 33))
    counts = placed.groupBy("task_").agg(F.count("*").alias("n_")).collect()  # a row a task
    before, base = 0, {}
    for r in sorted(counts, key=lambda r: r["task_"]):
        base[r["task_"]] = before
        before += r["n_"]
    sizes = df.sparkSession.createDataFrame(list(base.items()) or [(0, 0)], "task_ long, base_ long")
    placed = placed.join(F.broadcast(sizes), "task_")
    return placed.withColumn(out, F.col("base_") + F.col("at_").bitwiseAND(F.lit((1 << 33) - 1))).drop("task_", "base_", "at_")


def running(df: DataFrame, order: Column, sums: dict[str, Column]) -> DataFrame:
    """``df`` with sums of all rows up to each one, in a total order, without sorting them in one task.

    As in ``number_rows``, ranges of the order are dealt to tasks once there are many rows; a row a task comes together.
    """
    tasks = max(1, -(-df.count() // IN_ORDER))
    if tasks == 1:
        w = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({n: F.sum(c).over(w) for n, c in sums.items()})
    parts = df.withColumns({f"{n}_own": c for n, c in sums.items()}).repartitionByRange(tasks, order).sortWithinPartitions(order).withColumn("at_", F.monotonically_increasing_id())
    parts = staged(parts, "running").withColumn("task_", F.shiftright("at_", 33))
    inside = Window.partitionBy("task_").orderBy("at_").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("task_").rowsBetween(Window.unboundedPreceding, -1)
    totals = parts.groupBy("task_").agg(*(F.sum(f"{n}_own").alias(f"{n}_all") for n in sums))  # a row a task
    totals = totals.select("task_", *(F.coalesce(F.sum(f"{n}_all").over(before), F.lit(0)).alias(f"{n}_before") for n in sums))
    out = parts.join(F.broadcast(totals), "task_").withColumns({n: F.col(f"{n}_before") + F.sum(f"{n}_own").over(inside) for n in sums})
    return out.drop("task_", "at_", *(f"{n}_{x}" for n in sums for x in ("own", "before")))


def quantiles(df: DataFrame, column: str, shares: list[float]) -> list[float | None]:
    """Exact quantiles of the known values of a numeric column, interpolated linearly between ranks; None without any.

    Small tables are sorted in one task, of large ones only the neighbourhood of the wanted ranks is.
    """
    known = df.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("v"))
    n = known.count()
    if n <= IN_ORDER:
        return known.agg(F.percentile("v", F.array(*map(F.lit, shares))).alias("q")).first()["q"] or [None] * len(shares)
    at = [s * (n - 1) for s in shares]
    ranks = sorted({r for x in at for r in (int(x), min(n - 1, int(x) + 1))})
    value = {r: p[0][0] for r, p in zip(ranks, _places(known, [F.col("v")], ranks), strict=True)}
    return [value[int(x)] + (x - int(x)) * (value[min(n - 1, int(x) + 1)] - value[int(x)]) for x in at]


def numbered(df: DataFrame, key: Column, ties: list[Column], out: str = "position") -> DataFrame:
    """Rows numbered from 0 by a key, then ``ties``, which make the order total."""
    return number_rows(df, [key, *ties], out)


def temporal_split(df: DataFrame, key: Column, ties: list[Column], cuts: tuple[float, float] = (0.70, 0.85)) -> DataFrame:
    """Adds ``split``: train, validation, test by position in time order."""
    n = df.count()
    a, b = (int(n * c) for c in cuts)
    first = _places(df, [key, *ties], [a, b])
    now = F.struct(key.alias("o0"), *(t.alias(f"o{i}") for i, t in enumerate(ties, 1)))
    split = F.lit("train")
    for place, name in zip(first, ("validation", "test"), strict=True):
        if place is not None:
            split = F.when(now >= F.struct(*(F.lit(v).cast(t).alias(f"o{i}") for i, (v, t) in enumerate(place))), name).otherwise(split)
    return df.withColumn("split", split)


def _places(df: DataFrame, order: list[Column], ranks: list[int]) -> list[list[tuple] | None]:
    """The values (and types) of ``order`` of the rows that have these ranks in it; None beyond the last row.

    Only rows near a wanted rank are put in order: quantiles of the first column cut the rest off, rows with that same value
    are narrowed down by the next column, and so on. The columns hold no nulls.
    """
    keys = df.select(*(c.alias(f"o{i}") for i, c in enumerate(order)))
    total = keys.count()
    out: list[list[tuple] | None] = []
    for rank in ranks:
        if rank >= total:
            out.append(None)
            continue
        part, left, size = keys, rank, total
        for i in range(len(order)):
            c = f"o{i}"
            if not isinstance(keys.schema[c].dataType, T.NumericType | T.TimestampType | T.DateType):
                break
            while size > IN_ORDER:
                share = (left + 0.5) / size
                cuts = part.agg(F.percentile_approx(c, [max(0.0, share - 0.002), min(1.0, share + 0.002)], 10_000)).first()[0]
                low, high = F.lit(cuts[0]), F.lit(cuts[1])
                r = part.agg(F.count_if(F.col(c) < low).alias("below"), F.count_if(F.col(c).between(low, high)).alias("n")).first()
                inside = part.where(F.col(c).between(low, high))
                if not r["below"] <= left < r["below"] + r["n"] or r["n"] == size:
                    break
                part, left, size = inside, left - r["below"], r["n"]
            if size <= IN_ORDER:
                break
            # One value holds most of what is left, or the quantiles were off: find the value itself by counts.
            values = part.groupBy(c).agg(F.count("*").alias("n"))
            w = Window.orderBy(c).rowsBetween(Window.unboundedPreceding, 0)
            at = values.withColumn("to", F.sum("n").over(w)).where((F.col("to") > left) & (F.col("to") - F.col("n") <= left)).first()
            part, left, size = part.where(F.col(c) == F.lit(at[c])), left - (at["to"] - at["n"]), at["n"]
        names = [f"o{i}" for i in range(len(order))]
        row = part.orderBy(*names).offset(left).limit(1).first()
        out.append([(row[c], keys.schema[c].dataType) for c in names])
    return out


def cap_actors(df: DataFrame, actor: str, key: str, most: int = 80, seed: int = 42) -> DataFrame:
    """At most ``most`` rows of an actor, chosen by a seeded hash; a sample on purpose, for training only."""
    nth = F.row_number().over(Window.partitionBy(actor).orderBy(seeded(key, seed), key))
    return df.withColumn("nth_", nth).where(F.col("nth_") <= most).drop("nth_")


def above_cap(df: DataFrame, actor: str, most: int = 80) -> DataFrame:
    """(actors_above, share_before, share_after) of the largest actor."""
    c = df.groupBy(actor).agg(F.count("*").alias("n"))
    r = c.agg(F.count_if(F.col("n") > most).alias("actors_above"), F.max("n").alias("x"), F.sum("n").alias("t"), F.sum(F.least(F.col("n"), F.lit(most))).alias("t2"))
    return r.select("actors_above", (F.col("x") / F.col("t")).alias("share_before"), (F.least("x", F.lit(most)) / F.col("t2")).alias("share_after"))


def actor_sample(
    df: DataFrame, actor: str, signal: str, least: int = 300, target: int = 400, most: int = 500, sizes: tuple[int, int] = (2, 20), seed: int = 42
) -> DataFrame:
    """All events of some actors: between ``least`` and ``most`` events, ``target`` if possible, with and without a flag.

    Eligible actors have a number of events within ``sizes``. The first flagged and the first unflagged actor in a seeded
    order come first, then others in that order while they fit. As no actor has more than sizes[1] events, the first
    ``most`` + 2 candidates decide, and only those come to the driver. Raises ValueError if there are too few events.
    """
    if not 0 < least <= target <= most or not 1 <= sizes[0] <= sizes[1]:
        raise ValueError("expected 0 < least <= target <= most and 1 <= smallest <= largest")
    per = df.groupBy(actor).agg(F.count("*").alias("n"), F.sum(signal).alias("f")).where(F.col("n").between(*sizes)).withColumn("h", seeded(actor, seed))
    first = [per.where(c).orderBy("h", actor).limit(1) for c in ("f > 0", "f = 0")]
    rows = [*first[0].collect(), *first[1].collect(), *per.orderBy("h", actor).limit(most + 2).collect()]
    chosen, total = {}, 0
    for i, r in enumerate(rows):
        if r[actor] not in chosen and total + r["n"] <= most and (i < 2 or total < target):
            chosen[r[actor]] = r["n"]
            total += r["n"]
    if total < least:
        raise ValueError(f"{total} events of eligible actors, fewer than {least}")
    names = df.sparkSession.createDataFrame([(a,) for a in chosen], [actor])  # at most ``most`` rows
    return df.join(F.broadcast(names.withColumn(actor, F.col(actor).cast(df.schema[actor].dataType))), actor, "left_semi")


def in_sample_order(sample: DataFrame, actor: str = "actor_pseudo_id", key: str = "event_id") -> DataFrame:
    """A sample with ``position``, the place of each event by actor, number in its sequence and id, in that order within each part."""
    return number_rows(sample, [F.col(actor), F.col("prior_event_count"), F.col(key)], "position")
