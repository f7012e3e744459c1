"""Checks of a release; each is a count of rows that break a rule."""

from __future__ import annotations

from array import array
from collections import OrderedDict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .windows import HOUR_US, Sequence

#: Windows that are found a second way, and their hours.
SPANS = (("24h", 24), ("7d", 168), ("30d", 720))


def require(bad: dict[str, int]) -> None:
    if broken := {k: v for k, v in bad.items() if v}:
        raise AssertionError(f"rows that break a rule: {broken}")


def require_unique(df: DataFrame, key: str) -> None:
    if df.groupBy(key).count().where("count > 1").limit(1).count():
        raise ValueError(f"{key} is not unique")


def schema_errors(df: DataFrame, expected: list[str], forbidden: set[str] = frozenset()) -> list[str]:
    out = [] if df.columns == expected else [f"missing {sorted(set(expected) - set(df.columns))}, extra {sorted(set(df.columns) - set(expected))}, or another order"]
    return out + [f"forbidden: {c}" for c in df.columns if c.lower() in forbidden]


def forbidden(df: DataFrame, names: set[str]) -> list[str]:
    """Columns that must not be there, however they are written."""
    return [c for c in df.columns if c.lower() in names]


RULES = {
    "history_flag": "history_available <> cast(prior_event_count > 0 as int)",
    "first_change": "prior_event_count = 0 and country_changed <> 0",
    "signal_not_binary": "provider_suspicious is null or provider_suspicious not in (0, 1)",
    "first_event": "prior_event_count = 0 and (hours_since_last_login is not null or hours_since_first_observed_login <> 0 or logins_30d <> 1)",
    "later_event": "prior_event_count > 0 and hours_since_last_login is null",
    "logins_nested": "not (1 <= logins_24h and logins_24h <= logins_7d and logins_7d <= logins_30d)",
    "networks_nested": "not (distinct_networks_24h <= distinct_networks_7d and distinct_networks_7d <= distinct_networks_30d and distinct_networks_30d <= networks_seen_to_date)",
    "countries_nested": "not (distinct_countries_24h <= distinct_countries_7d and distinct_countries_7d <= distinct_countries_30d and distinct_countries_30d <= distinct_countries_to_date)",
    "active_days": "not (active_days_30d between 1 and 30 and active_days_30d <= logins_30d)",
    "known_network": "actor_network_id is not null and distinct_networks_24h < 1",
    "continent_known": "continent is not null and ip_country is null",
    "other_country": "ip_country = 'Other'",
    "hour_of_time": "event_time_hour_utc <> date_trunc('hour', event_time)",
    "coordinates_paired": "(latitude is null) <> (longitude is null)",
    "travel_pairs": "travel_speed_kmh is not null and travel_distance_km is null",
}


def invariants(df: DataFrame) -> dict[str, int]:
    """Broken rows by rule, in one pass; rules on columns that ``df`` lacks are left out. Shared networks take a second one."""
    names = set(df.columns)
    usable = {k: r for k, r in RULES.items() if all(c in names for c in _columns(r))}
    row = df.agg(*(F.count_if(F.coalesce(F.expr(r), F.lit(False))).alias(k) for k, r in usable.items())).first().asDict()
    if "actor_network_id" in names:
        row["network_shared"] = shared_networks(df).count()
    return row


def _columns(rule: str) -> set[str]:
    import re

    words = re.findall(r"[a-z_]+[a-z0-9_]*", re.sub(r"'[^']*'", "", rule))
    return set(words) - {"is", "null", "or", "and", "not", "in", "between", "date_trunc"}


def shared_networks(df: DataFrame) -> DataFrame:
    known = df.where("actor_network_id is not null").groupBy("actor_network_id")
    return known.agg(F.min("actor_pseudo_id").alias("a"), F.max("actor_pseudo_id").alias("b")).where("a <> b")


def collapse_guard(df: DataFrame, narrow: str = "distinct_countries_24h", wide: str = "distinct_countries_30d") -> bool:
    """Whether two windows agree in every row although the hours span more than a day, which means that units were mixed up."""
    r = df.agg(F.count("*").alias("n"), F.countDistinct("event_time_hour_utc").alias("h"), F.count_if(~F.col(narrow).eqNullSafe(F.col(wide))).alias("d")).first()
    return r["n"] > 1 and r["h"] > 24 and r["d"] == 0


def out_of_order(df: DataFrame, line: str, time: str = "event_time", key: str = "event_id") -> int:
    """Rows of a written release (``line`` numbers them) that come before their predecessor's (time, key).

    Lines are compared with the next one by a join on their number, so that no task sorts the whole release.
    """
    nxt = df.select((F.col(line) - 1).alias("l_"), F.struct(time, key).alias("next_"))
    return df.join(nxt, F.col(line) == F.col("l_")).where(F.col("next_") < F.struct(time, key)).count()


def differs(a: DataFrame, b: DataFrame, key: str) -> int:
    """Rows whose key is in one table only, or whose shared columns differ (null equals null)."""
    shared = [c for c in a.columns if c in b.columns and c != key]
    x, y = a.select(key, F.struct(*shared).alias("x_")), b.select(key, F.struct(*shared).alias("y_"))
    return x.join(y, key, "full").where(F.col("x_").isNull() | F.col("y_").isNull() | ~F.col("x_").eqNullSafe(F.col("y_"))).count()


def not_subset(sample: DataFrame, source: DataFrame, key: str) -> int:
    return sample.join(source.select(key), key, "left_anti").count()


def sample_errors(source: DataFrame, sample: DataFrame, actor: str = "actor_pseudo_id", key: str = "event_id") -> dict:
    """What keeps a sample from being whole actors of its source: events (how many), columns that only one of the two has,
    repeated events, actors with another number of events than in the source, and events that the source lacks."""
    count = lambda d, n: d.groupBy(actor).agg(F.count("*").alias(n))
    per = count(sample, "n_").join(count(source, "of_"), actor, "left")
    return {
        "events": sample.count(), "columns": sorted(set(sample.columns) ^ set(source.columns)), "repeated": sample.groupBy(key).count().where("count > 1").count(),
        "incomplete_actors": per.where("of_ is null or n_ <> of_").count(), "unknown_events": not_subset(sample, source, key),
    }


def raw_hash_text(df: DataFrame, raw_hashes: DataFrame) -> int:
    """Cells of a public table that are one of the raw hashes (a column ``hash``)."""
    text = [c for c, t in df.dtypes if t == "string"]
    cells = df.select(F.explode(F.array(*map(F.col, text))).alias("hash")).where("hash is not null")
    return cells.join(raw_hashes.select("hash").distinct(), "hash", "left_semi").count()


def nonnull_counts(df: DataFrame) -> DataFrame:
    return df.agg(*(F.count(c).alias(c) for c in df.columns))


def _walk(actor: str, ties: tuple[str, ...], names: list[str]):
    """Of rows in the order of actor, time and ties: their numbers, found by going from event to event. Numbers are kept across batches."""
    spans = [h for _, h in SPANS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        who = None
        for batch in batches:
            out = {n: [] for n in names}
            for a, us, network, country in zip(*(batch.column(c).to_pylist() for c in (actor, "us_", "actor_network_id", "ip_country")), strict=True):
                if a != who:
                    who, n, first, last, networks, countries = a, 0, None, None, set(), set()
                    times, starts, recent = array("q"), [0] * len(spans), [OrderedDict() for _ in spans]
                new = network is not None and network not in networks
                if network is not None:
                    networks.add(network)
                if country is not None:
                    countries.add(country)
                first = us if first is None else first
                row = [n, None if us is None or last is None else us - last, None if us is None else us - first]
                if us is None:  # before all others, and in no window
                    row += [0] * (2 * len(spans))
                else:
                    last, hour = us, us // HOUR_US
                    times.append(us)
                    for i, (span, held) in enumerate(zip(spans, recent, strict=True)):
                        while us - times[starts[i]] > span * HOUR_US:
                            starts[i] += 1
                        if country is not None:
                            held[country] = hour
                            held.move_to_end(country)
                        while held and hour - held[oldest := next(iter(held))] > span:
                            del held[oldest]
                        row += [len(times) - starts[i], len(held)]
                    if (gone := min(starts)) > 10_000 and 2 * gone > len(times):
                        del times[:gone]
                        starts = [x - gone for x in starts]
                row += [len(networks), len(countries), None if network is None else int(new)]
                n += 1
                for x, v in zip(out.values(), row, strict=True):
                    x.append(v)
            arrays = [pa.array(v, pa.int32() if k == "is_new_ip" else pa.int64()) for k, v in out.items()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (actor, *ties)), *arrays], names=[actor, *ties, *names])

    return run


def recompute(df: DataFrame, s: Sequence | None = None) -> DataFrame:
    """Twelve features a second way, by walking through each actor's events; compare by event id.

    A different algorithm on purpose: no frames, no sums over entries and exits. One pass over sorted rows, whose cost does not
    depend on how many events a window holds; what is kept are one actor's times of a month and distinct networks and countries.
    Events without actor have no row.
    """
    s = s or Sequence()
    base = df.where(F.col(s.actor).isNotNull()).select(s.actor, *s.ties, s.us.alias("us_"), "actor_network_id", "ip_country")
    names = ["prior_event_count", "since_last_", "since_first_", *(f"{x}_{k}" for k, _ in SPANS for x in ("logins", "distinct_countries")), "networks_seen_to_date", "distinct_countries_to_date", "is_new_ip"]
    schema = T.StructType([*(base.schema[c] for c in (s.actor, *s.ties)), *(T.StructField(n, T.IntegerType() if n == "is_new_ip" else T.LongType()) for n in names)])
    walked = base.repartition(s.actor).sortWithinPartitions(s.actor, "us_", *s.ties).mapInArrow(_walk(s.actor, s.ties, names), schema)
    hours = {"since_last_": "hours_since_last_login", "since_first_": "hours_since_first_observed_login"}
    return walked.select(s.actor, *s.ties, *(F.bround(F.col(n) / HOUR_US, 4).alias(hours[n]) if n in hours else F.col(n) for n in names))


def minimum(df: DataFrame, rows: int, columns: int) -> list[str]:
    """What keeps a table from having so many rows and columns, unique events and a binary signal."""
    out = [] if len(df.columns) == columns else [f"{len(df.columns)} columns"]
    r = df.agg(F.count("*").alias("n"), F.countDistinct("event_id").alias("d"), F.count_if(F.coalesce(~F.col("provider_suspicious").isin(0, 1), F.lit(True))).alias("b")).first()
    return out + [x for x, bad in ((f"{r['n']} rows", r["n"] != rows), ("repeated events", r["d"] != r["n"]), ("signal not binary", r["b"] > 0)) if bad]


def peers_backwards(df: DataFrame, s: Sequence | None = None, hour: str = "event_time_hour_utc") -> int:
    s = s or Sequence()
    return df.withColumn("b_", s.backwards(hour)).where("b_").count()


def missingness_differs(df: DataFrame, stated: dict[str, int]) -> dict[str, tuple[int, int | None]]:
    """Columns whose number of nulls is not the stated one: (found, stated)."""
    found = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in df.columns)).first().asDict()
    return {c: (n, stated.get(c)) for c, n in found.items() if stated.get(c) != n}


def report(restricted: DataFrame, public: DataFrame, expected: list[str]) -> dict:
    """All checks of a release in one document; every number but the counts should be 0 and every list empty."""
    again = recompute(restricted).drop("actor_pseudo_id")
    return {
        "rows": restricted.count(), "schema": schema_errors(public, expected), "invariants": invariants(restricted), "public_differs": differs(public, restricted, "event_id"),
        "recomputed_differs": differs(again, restricted, "event_id"), "hours_backwards": peers_backwards(restricted), "windows_collapsed": collapse_guard(restricted),
        "non_null": nonnull_counts(restricted).first().asDict(),
    }
