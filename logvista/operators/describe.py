"""Descriptive summaries. Each is one or two aggregates; only a table's few result rows are ordered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sampling import quantiles, running

MISSING = "<missing>"


def rate(column: str = "sig") -> Column:
    return F.avg(column) * 100


def overview(df: DataFrame, actor: str, time: str, signal: str, attributes: int) -> DataFrame:
    """(metric, value), in the order that a reader expects; values as text, since they mix counts and times."""
    one = df.agg(
        F.count("*").alias("events"), F.countDistinct(actor).alias("actors"), F.lit(attributes).alias("attributes"), F.sum(signal).alias("flagged"), F.sum(1 - F.col(signal)).alias("not_flagged"),
        F.round(rate(signal), 9).alias("flagged_percent"), F.min(F.date_trunc("hour", time)).alias("first_hour"), F.max(F.date_trunc("hour", time)).alias("last_hour"),
    )
    pairs = F.array(*(F.struct(F.lit(c).alias("metric"), F.col(c).cast("string").alias("value")) for c in one.columns))
    return one.select(F.inline(pairs))


def per_actor(df: DataFrame, actor: str, signal: str) -> DataFrame:
    return df.groupBy(actor).agg(F.count("*").alias("event_count"), F.sum(signal).alias("flagged_events"))


def ranked_counts(counts: DataFrame, n: str = "event_count") -> DataFrame:
    """(x, actors, below, total, actors_below): one row a distinct count, with cumulated actors and events.

    Actors are first grouped by their number of events, so that what is put in one order are distinct counts and not actors.
    """
    g = counts.groupBy(F.col(n).alias("x")).agg(F.count("*").alias("actors"))
    events = F.col("x") * F.col("actors")
    g = running(g, F.col("x"), {"actors_to": F.col("actors"), "events_to": events})
    return g.crossJoin(F.broadcast(g.agg(F.sum("actors").alias("all_actors"), F.sum(events).alias("all_events"))))  # one row


def gini(counts: DataFrame, n: str = "event_count") -> DataFrame:
    """2 * sum(i * x_i) / (n * sum x) - (n + 1) / n over actors sorted by x; null for no actors or no events.

    Of a run of m equal values whose last rank is r, the ranks add up to m * (2r - m + 1) / 2.
    """
    r = ranked_counts(counts, n).agg(F.sum(F.col("x") * F.col("actors") * (2 * F.col("actors_to") - F.col("actors") + 1)).alias("s2"), F.max("all_actors").alias("n"), F.max("all_events").alias("t"))
    return r.select(F.when(F.col("t") > 0, F.col("s2") / (F.col("n") * F.col("t")) - (F.col("n") + 1) / F.col("n")).alias("gini"))


def lorenz(counts: DataFrame, n: str = "event_count") -> DataFrame:
    """(actor_share, event_share) at the end of every run of equal counts, and the origin."""
    r = ranked_counts(counts, n).select((F.col("actors_to") / F.col("all_actors")).alias("actor_share"), (F.col("events_to") / F.col("all_events")).alias("event_share"))
    return r.unionAll(counts.sparkSession.createDataFrame([(0.0, 0.0)], "actor_share double, event_share double"))


def top_share(counts: DataFrame, shares: tuple[float, ...] = (0.01, 0.10), n: str = "event_count") -> DataFrame:
    """(share, actors, events, percent): events of the most active ceil(share * actors) actors, one at least."""
    r = ranked_counts(counts, n)
    p = counts.sparkSession.createDataFrame([(s,) for s in shares], "share double")
    k = F.greatest(F.lit(1), F.ceil(F.col("share") * F.col("all_actors")))
    left = F.col("all_actors") - F.col("actors_to")  # actors with more events
    taken = F.greatest(F.lit(0), F.least(F.col("actors"), k - left))
    each = r.crossJoin(F.broadcast(p)).groupBy("share").agg(F.sum(taken).alias("actors"), F.sum(taken * F.col("x")).alias("events"), F.max("all_events").alias("t"))
    return each.select("share", "actors", "events", (F.col("events") * 100 / F.col("t")).alias("percent"))


def actor_activity(df: DataFrame, actor: str, signal: str) -> DataFrame:
    """One row: singletons, recurrent, events with and without history, exact quartiles, the largest."""
    c = per_actor(df, actor, signal).groupBy("event_count").agg(F.count("*").alias("n"))  # a row a count, of which there are few
    q = F.percentile("event_count", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("n"))
    events = F.col("event_count") * F.col("n")
    one = c.agg(
        F.coalesce(F.sum(F.when(F.col("event_count") == 1, F.col("n"))), F.lit(0)).alias("singletons"), F.coalesce(F.sum(F.when(F.col("event_count") > 1, F.col("n"))), F.lit(0)).alias("recurrent"),
        F.sum("n").alias("without_history"), F.sum(events - F.col("n")).alias("with_history"), q.alias("q"), F.max("event_count").alias("largest"),
    )
    return one.select("singletons", "recurrent", "with_history", "without_history", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"), "largest")


def quartiles(df: DataFrame, column: str) -> DataFrame:
    return df.sparkSession.createDataFrame([tuple(quantiles(df, column, [0.25, 0.5, 0.75]))], "q1 double, median double, q3 double")


def category(df: DataFrame, column: str, label: str | None = MISSING) -> DataFrame:
    """(value, events, percent), missing ones under ``label`` (left out if that is None)."""
    d = df if label is not None else df.where(F.col(column).isNotNull())
    value = F.coalesce(F.col(column).cast("string"), F.lit(label)) if label is not None else F.col(column).cast("string")
    g = d.groupBy(value.alias("value")).agg(F.count("*").alias("events"))
    return g.withColumn("percent", F.col("events") * 100 / F.sum("events").over(Window.partitionBy()))


def token_distribution(df: DataFrame, column: str) -> DataFrame:
    """(token, occurrences, percent_of_events): a token counts each time it stands, its share is of all events."""
    total = df.agg(F.count("*").alias("n_"))
    parts = df.select(F.explode(F.split(F.col(column), r"\|")).alias("t")).select(F.trim("t").alias("token")).where("token <> ''")
    g = parts.groupBy("token").agg(F.count("*").alias("occurrences")).crossJoin(F.broadcast(total))
    return g.select("token", "occurrences", (F.col("occurrences") * 100 / F.col("n_")).alias("percent_of_events"))


def by_group(df: DataFrame, keys: list[Column], signal: str, actor: str | None = None) -> DataFrame:
    """events, (actors,) flagged and percent by group."""
    agg = [F.count("*").alias("events"), F.sum(signal).alias("flagged"), rate(signal).alias("percent")]
    return df.groupBy(*keys).agg(*agg, *([F.countDistinct(actor).alias("actors")] if actor else []))


def having_rate(df: DataFrame, key: str, signal: str, least: int = 30) -> DataFrame:
    return by_group(df.where(F.col(key).isNotNull()), [F.col(key)], signal).where(F.col("events") >= least).withColumn("always", F.col("flagged") == F.col("events"))


def heatmap(df: DataFrame, day: Column, hour: Column, signal: str) -> DataFrame:
    g = df.withColumn("hour_", hour).groupBy(day.alias("day")).pivot("hour_", list(range(24)))
    out = g.agg(F.avg(signal))
    return out.select("day", *(F.col(str(h)).alias(f"h{h:02d}") for h in range(24)))


def missingness(df: DataFrame) -> DataFrame:
    """(attribute, missing, percent) in the order of the columns, in one pass."""
    one = df.agg(F.count("*").alias("n_"), *(F.count_if(F.col(c).isNull()).alias(c) for c in df.columns))
    rows = F.array(*(F.struct(F.lit(i).alias("position"), F.lit(c).alias("attribute"), F.col(c).alias("missing")) for i, c in enumerate(df.columns)))
    return one.select("n_", F.inline(rows)).select("position", "attribute", "missing", (F.col("missing") * 100 / F.col("n_")).alias("percent"))


def country_summary(df: DataFrame, column: str = "ip_country") -> DataFrame:
    return df.agg(F.countDistinct(column).alias("known_country_values"), F.count_if(F.col(column).isNull()).alias("missing_country_events"))


def top_k(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values, ties to the smaller value."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("events")).orderBy(F.desc("events"), column).limit(k)


def group_rare(df: DataFrame, column: str, least: int, other: str = "Other") -> DataFrame:
    """Analysis only: values of fewer than ``least`` rows become ``other``."""
    kept = df.groupBy(F.col(column).alias("v_")).count().where(F.col("count") >= least).select("v_")
    return df.join(kept, F.col(column) == F.col("v_"), "left").withColumn(column, F.when(F.col(column).isNotNull(), F.coalesce("v_", F.lit(other)))).drop("v_")


def entropy(df: DataFrame, actor: str, value: str) -> DataFrame:
    """(actor, entropy): Shannon bits of the known values of each actor."""
    g = df.where(F.col(value).isNotNull()).groupBy(actor, value).agg(F.count("*").alias("c"))
    return g.groupBy(actor).agg((F.log2(F.sum("c")) - F.sum(F.col("c") * F.log2("c")) / F.sum("c")).alias("entropy"))


def describe(df: DataFrame, key: str, value: str) -> DataFrame:
    """Count, moments, extremes and quartiles of a value by ``key``, of which there are few (a flag, say)."""
    g = df.groupBy(key).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.min(value).alias("low"), F.max(value).alias("high"))
    keys = [r[key] for r in g.select(key).collect()]
    found = [(k, *quantiles(df.where(F.col(key).eqNullSafe(F.lit(k))), value, [0.25, 0.5, 0.75])) for k in keys]
    q = df.sparkSession.createDataFrame(found, f"k_ {df.schema[key].dataType.simpleString()}, q1 double, median double, q3 double")
    return g.join(F.broadcast(q), F.col(key).eqNullSafe(F.col("k_"))).select(key, "n", "mean", "std", "low", "q1", "median", "q3", "high")


def statistics(df: DataFrame, actor: str, time: str, signal: str, country: str, name: str = "", version: str = "", sha256: str = "") -> dict:
    """The flat document of public statistics; every entry comes from a result of a few rows."""
    o = {r["metric"]: r["value"] for r in overview(df, actor, time, signal, len(df.columns)).collect()}
    counts = per_actor(df, actor, signal)
    a = actor_activity(df, actor, signal).first()
    top = {round(r["share"] * 100): r["percent"] for r in top_share(counts).collect()}
    places = country_summary(df, country).first()
    return {
        "dataset_name": name, "dataset_version": version, "public_sha256": sha256, "events": int(o["events"]), "actors": int(o["actors"]), "public_attributes": int(o["attributes"]),
        "public_time_hour_min": o["first_hour"], "public_time_hour_max": o["last_hour"], "singleton_users": a["singletons"], "recurrent_users": a["recurrent"], "events_with_prior_history": a["with_history"],
        "events_without_prior_history": a["without_history"], "provider_suspicious_0": int(o["not_flagged"]), "provider_suspicious_1": int(o["flagged"]), "provider_suspicious_pct": float(o["flagged_percent"]),
        "actor_events_q1": a["q1"], "actor_events_median": a["median"], "actor_events_q3": a["q3"], "actor_events_max": a["largest"], "activity_gini": gini(counts).first()["gini"],
        "top_1pct_actor_event_share_pct": top[1], "top_10pct_actor_event_share_pct": top[10], "known_country_values": places["known_country_values"], "missing_country_events": places["missing_country_events"],
    }
