"""Writing releases and their manifest."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ORDER = ["event_time", "event_id"]


def file_hash(path: str, chunk: int = 1 << 20) -> str:
    digest = hashlib.sha256()
    with open(path, "rb") as f:
        for part in iter(lambda: f.read(chunk), b""):
            digest.update(part)
    return digest.hexdigest()


def file_hashes(spark: SparkSession, folder: str) -> dict[str, str]:
    """The SHA-256 of each data file in a folder of any store, by its name; found where the files are read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    rows = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.sha2("content", 256).alias("sha256")).collect()  # a row a file
    return {r["name"]: r["sha256"] for r in sorted(rows, key=lambda r: r["name"])}


def parts(folder: str) -> Iterator[Path]:
    return (p for p in sorted(Path(folder).iterdir()) if p.name.startswith("part-"))


def write_release(restricted: DataFrame, public_columns: list[str], public_path: str, restricted_path: str, form: str = "parquet") -> None:
    """Both tables in one order, by exact time and event id; CSV goes to a single file each.

    The public table is sorted by the exact time, which it does not hold, so it is cut from the sorted restricted one.
    """
    ordered = restricted.orderBy(*ORDER)
    for df, path in ((ordered.select(*public_columns), public_path), (ordered, restricted_path)):
        if form == "csv":
            stamps = {c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'") for c, t in df.dtypes if t == "timestamp"}
            df.withColumns(stamps).coalesce(1).write.mode("overwrite").options(header=True, nullValue="", emptyValue="").csv(path)
        else:
            df.write.mode("overwrite").format(form).save(path)


def summary(restricted: DataFrame) -> DataFrame:
    """One row of the counts that a manifest states."""
    per = restricted.groupBy("actor_pseudo_id").count().agg(F.count("*").alias("users"), F.count_if(F.col("count") == 1).alias("singleton_users"))
    total = restricted.agg(
        F.count("*").alias("events"), F.min("event_time").alias("event_time_min"), F.max("event_time").alias("event_time_max"), F.sum("provider_suspicious").alias("flagged"),
        (F.avg("provider_suspicious") * 100).alias("flagged_percent"), F.countDistinct("institution_pseudo_id").alias("institutions"),
    )
    return total.crossJoin(per)  # one row each


def manifest(restricted: DataFrame, public_columns: list[str], counts: dict[str, int], hashes: dict | None = None) -> dict:
    row = summary(restricted).first().asDict()
    known = {k: v.isoformat() if hasattr(v, "isoformat") else v for k, v in row.items()}
    return known | counts | {
        "ordering": ORDER, "actor_ordering": ["actor_pseudo_id", *ORDER], "public_columns": public_columns, "restricted_columns": restricted.columns, "sha256": hashes or {},
        "policies": {"country": "names are kept, none are grouped", "signal": "an operational flag of the provider, not a label", "missing": "a missing value is no category of its own"},
    }


def write_json(doc: dict, path: str) -> None:
    Path(path).write_text(json.dumps(doc, indent=2, ensure_ascii=False, default=str) + "\n", encoding="utf-8")
