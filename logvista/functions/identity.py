"""Keyed pseudonyms as plain expressions.

HMAC-SHA256 is put together from ``sha2`` and ``unhex``. Keys come in as columns (inner and outer pad) of a small broadcast
table, so that no key stands as a literal in a plan, a log or the UI.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SEPARATOR = "\x1f"
MISSING = "<NA>"


def pads(key: bytes) -> tuple[bytes, bytes]:
    key = hashlib.sha256(key).digest() if len(key) > 64 else key
    key = key.ljust(64, b"\0")
    return bytes(k ^ 0x36 for k in key), bytes(k ^ 0x5C for k in key)


def key_table(spark: SparkSession, keys: dict[str, bytes]) -> DataFrame:
    """(institution, ipad, opad): a row an institution, to be broadcast and dropped before anything is released."""
    rows = [(name, *map(bytearray, pads(key))) for name, key in sorted(keys.items())]
    return spark.createDataFrame(rows, "institution string, ipad binary, opad binary")


def hmac_hex(value: Column, ipad: Column, opad: Column, length: int = 64) -> Column:
    inner = F.sha2(F.concat(ipad, value.cast("binary")), 256)
    return F.substring(F.sha2(F.concat(opad, F.unhex(inner)), 256), 1, length)


def pseudonym(value: Column, prefix: str, length: int, ipad: Column, opad: Column) -> Column:
    """prefix + keyed hash; null and empty stay null."""
    return F.when(F.coalesce(value, F.lit("")) != "", F.concat(F.lit(prefix), hmac_hex(value, ipad, opad, length)))


def canonical_row(df: DataFrame, columns: list[str]) -> Column:
    """One string of a row's content: sorted ``name=value`` joined by a control character, with a mark for null.

    Numbers and times are written as Spark casts them; strings are trimmed. This form is our own.
    """
    parts = [F.concat(F.lit(f"{c}="), F.coalesce(F.trim(F.col(c).cast("string")), F.lit(MISSING))) for c in sorted(columns)]
    return F.concat_ws(SEPARATOR, *parts)


def add_identities(df: DataFrame, keys: DataFrame, content: list[str]) -> DataFrame:
    """Adds event, actor, network, actor-network, institution and file pseudonyms; ``df`` has institution and source_file."""
    out = df.join(F.broadcast(keys), "institution")
    ip, op = F.col("ipad"), F.col("opad")
    out = out.withColumns({
        "actor_pseudo_id": pseudonym(F.col("actor_email_hash"), "U", 16, ip, op), "network_pseudo_id": pseudonym(F.col("ip_hash"), "N", 16, ip, op),
        "institution_pseudo_id": pseudonym(F.col("institution"), "I", 10, ip, op), "source_file_id": pseudonym(F.col("source_file"), "F", 12, ip, op),
        "event_id": pseudonym(canonical_row(df, content), "E", 32, ip, op),
    })
    both = F.concat_ws(SEPARATOR, "actor_pseudo_id", "network_pseudo_id")
    own = F.when(F.col("network_pseudo_id").isNotNull() & F.col("actor_pseudo_id").isNotNull(), both)
    return out.withColumn("actor_network_id", pseudonym(own, "A", 16, ip, op)).drop("ipad", "opad")
