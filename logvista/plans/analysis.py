"""The descriptive analysis of a public release: its tables, their files and the document of statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import describe as D
from .release import write_json

ACTOR, TIME, SIGNAL = "actor_pseudo_id", "event_time_hour_utc", "provider_suspicious"


def tables(release: DataFrame) -> dict[str, DataFrame]:
    """Every table by name; each is a few aggregates over ``release`` and has few rows."""
    history = (F.col("prior_event_count") > 0).cast("int").alias("has_prior_history")
    counts = D.per_actor(release, ACTOR, SIGNAL)
    return {
        "dataset_overview": D.overview(release, ACTOR, TIME, SIGNAL, len(release.columns)), "actor_activity_summary": actor_summary(release, counts), "lorenz": D.lorenz(counts),
        "provider_suspicious_distribution": D.category(release, SIGNAL), "provider_suspicious_by_history": D.by_group(release, [history], SIGNAL),
        "login_type_distribution": D.category(release, "login_type"), "login_challenge_method_distribution": D.category(release, "login_challenge_method"),
        "login_challenge_token_distribution": D.token_distribution(release, "login_challenge_method"), "country_distribution": D.category(release, "ip_country"), "country_summary": D.country_summary(release),
        "monthly_characterization": D.by_group(release, [F.date_format(TIME, "yyyy-MM").alias("year_month")], SIGNAL, ACTOR), "missingness_public": D.missingness(release),
        "heatmap": D.heatmap(release, F.col("day_of_week"), F.col("event_hour"), SIGNAL),
    }


def actor_summary(release: DataFrame, counts: DataFrame) -> DataFrame:
    """(metric, value, percent): singletons and the rest, events with and without history, quartiles, Gini, top shares."""
    one = D.actor_activity(release, ACTOR, SIGNAL).crossJoin(D.gini(counts))  # a row each
    share = lambda a, b: F.col(a) * 100 / F.when(F.col(a) + F.col(b) > 0, F.col(a) + F.col(b))
    none = F.lit(None).cast("double")
    metric = lambda name, value, percent=none: F.struct(F.lit(name).alias("metric"), F.col(value).cast("double").alias("value"), percent.cast("double").alias("percent"))
    rows = F.array(
        metric("Actors with one event", "singletons", share("singletons", "recurrent")), metric("Actors with recurrent events", "recurrent", share("recurrent", "singletons")),
        metric("Events with prior observed history", "with_history", share("with_history", "without_history")),
        metric("Events without prior observed history", "without_history", share("without_history", "with_history")),
        metric("First quartile", "q1"), metric("Median", "median"), metric("Third quartile", "q3"), metric("Largest", "largest"), metric("Gini", "gini"),
    )
    top = D.top_share(counts).select(F.concat(F.lit("Events of the top "), (F.col("share") * 100).cast("int").cast("string"), F.lit(" % of actors")).alias("metric"), F.col("events").cast("double").alias("value"), "percent")
    return one.select(F.inline(rows)).unionByName(top)


def analyse(release: DataFrame, folder: str) -> dict:
    """Writes each table as CSV and the statistics as JSON under ``folder``; returns the latter."""
    release = release.persist()
    for name, df in tables(release).items():
        df.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")
    stats = D.statistics(release, ACTOR, TIME, SIGNAL, "ip_country")
    write_json(stats, f"{folder}/statistics.json")
    release.unpersist()
    return stats
