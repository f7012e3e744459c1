"""From raw files to the two releases."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..functions.identity import add_identities, key_table
from ..operators import validate as V
from ..operators.features import add_features
from ..sources.raw_csv import RawFile, read_all
from ..sources.staging import staged
from .schema import FORBIDDEN_LEGACY, FORBIDDEN_PUBLIC, FORBIDDEN_RESTRICTED, LEGACY_20, LEGACY_35, PUBLIC_42, RAW, REQUIRED, RESTRICTED_50


@dataclass
class Processed:
    public: DataFrame
    restricted: DataFrame
    counts: dict[str, int] = field(default_factory=dict)


def dedupe_keep_first(df: DataFrame, content: list[str], order: Column | str = "row_order") -> DataFrame:
    """One row of each content, the first in ``order``; nulls are equal. The order is a total one, made when lines were read.

    What is shuffled are digests of the content and the order; whole rows stay where they are but for one join, whose hash
    side is one short row a content.
    """
    parts = [F.concat(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")), F.when(F.col(f"`{c}`").isNull(), "\x1e").otherwise("\x1f")) for c in content]
    d = df.withColumn("digest_", F.sha2(F.concat(*parts).cast("binary"), 256)).withColumn("order_", F.col(order) if isinstance(order, str) else order)
    first = d.groupBy("digest_").agg(F.min("order_").alias("first_"))
    return d.join(first.withColumnRenamed("digest_", "of_"), (F.col("digest_") == F.col("of_")) & (F.col("order_") == F.col("first_"))).drop("digest_", "order_", "of_", "first_")


def clean(raw: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """Typed and canonical columns; rows without a time or an actor dropped and counted."""
    d = raw
    for c in RAW:
        if c not in d.columns:
            d = d.withColumn(c, F.lit(None).cast("string"))
    d = d.withColumn("event_time", S.parse_time(F.col("event_time")))
    lat, lon = S.coordinates(S.decimal(F.col("latitude")), S.decimal(F.col("longitude")))
    d = d.withColumns({"latitude": lat, "longitude": lon, "ip_country": S.country(F.col("ip_country")), "ip_version": S.ip_version(F.col("ip_version"))})
    good = F.col("event_time").isNotNull() & (F.coalesce(F.trim("actor_email_hash"), F.lit("")) != "")
    n = raw.select(S.parse_time(F.col("event_time")).alias("event_time"), "actor_email_hash").where(~good).count()
    return d.where(good), {"removed_invalid_core_rows": n}


def refuse_bad_signals(df: DataFrame, column: str = "is_suspicious") -> None:
    """Raises ValueError with up to ten examples if a signal is none of the known words."""
    bad = df.where(S.signal(F.col(column)).isNull()).select(F.coalesce(F.col(column), F.lit("<NA>")).alias("x")).distinct().orderBy("x").limit(10).collect()
    if bad:
        raise ValueError(f"{column} holds {[r['x'] for r in bad]}")


def process(spark: SparkSession, files: list[RawFile], legacy: bool = False, strict_guard: bool = True) -> Processed:
    """Both releases, written to the shared folder and then validated as written: forbidden columns, unique events, rules of each row,
    equality of the two, and windows of a day and a month that don't agree everywhere (unless ``strict_guard`` is off).

    ``legacy`` gives the narrow contract (20 and 35 columns, change against null is 0).
    """
    raw, counts = read_all(spark, files, REQUIRED)
    cleaned, more = clean(raw)
    counts |= more
    content = [c for c in RAW if c != "record_id" and c in cleaned.columns]
    refuse_bad_signals(cleaned)
    unique = dedupe_keep_first(cleaned, content)
    keys = key_table(spark, {f.institution: f.key for f in files})
    events = S.with_continent(add_identities(unique, keys, content))
    featured = add_features(events, null_as_zero=legacy).withColumn("provider_suspicious", S.signal(F.col("is_suspicious")))
    if legacy:
        whole, names = featured.select(*LEGACY_35), LEGACY_20
    else:
        whole, names = featured.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in RESTRICTED_50.fields)), PUBLIC_42.names
    whole = staged(whole, "release")
    counts["removed_duplicate_rows"] = cleaned.count() - whole.count()
    out = Processed(whole.select(*names), whole, counts)
    V.require_unique(whole, "event_id")
    V.require(V.invariants(whole))
    forbidden = V.forbidden(out.public, FORBIDDEN_LEGACY if legacy else FORBIDDEN_PUBLIC) + V.forbidden(whole, FORBIDDEN_RESTRICTED)
    if forbidden:
        raise AssertionError(f"forbidden columns: {forbidden}")
    narrow, wide = ("countries_seen_24h", "countries_seen_30d") if legacy else ("distinct_countries_24h", "distinct_countries_30d")
    if strict_guard and V.collapse_guard(whole, narrow, wide):
        raise RuntimeError(f"{narrow} and {wide} agree in every row: look at the units of the windows")
    return out
