"""Tables that a plan reads more than once, written to the folder that driver and executors share and read back.

Writing cuts the lineage at a fixed table: what is counted and what is used are the same rows, in the same partitions, even
if an executor is lost in between.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a local session without one, as in tests, gets a folder of its own, a cluster an error."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        at = tempfile.mkdtemp(prefix="logvista-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def new_path(spark: SparkSession, name: str = "t") -> str:
    return f"{shared_folder(spark)}/staged-{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str = "t") -> DataFrame:
    """``df`` as it was written; ``discard`` deletes it once nothing reads it any more."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
    out = df.sparkSession.read.schema(schema).parquet(path)
    out._staged_at = path
    return out


def discard(*tables: DataFrame) -> None:
    for t in tables:
        spark = t.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(t._staged_at)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
