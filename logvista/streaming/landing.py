"""A landing folder of API items as a stream of raw records, each delivered once to a table of raw rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.api_json import ITEM, flatten


def raw_stream(spark: SparkSession, path: str, files_at_once: int = 100) -> DataFrame:
    """The 16 raw columns of the items that land under ``path``."""
    return flatten(spark.readStream.schema(ITEM).option("maxFilesPerTrigger", files_at_once).json(path))


def land(spark: SparkSession, path: str, out: str, checkpoint: str, late: str = "2 days"):
    """Appends raw rows to Parquet, without repeats of an item that arrive within ``late``; returns the started query, which ends when all is read."""
    d = raw_stream(spark, path).withColumn("at_", F.current_timestamp())  # arrival: an old event is not a late one
    d = d.withWatermark("at_", late).dropDuplicatesWithinWatermark(["record_id"]).drop("at_")
    return d.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
