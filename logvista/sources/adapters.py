"""The test tables seen as login events, so that every operator can be run and compared over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import Sequence

E_SEQUENCE = Sequence("actor", "ts", ("event_id",))
L_SEQUENCE = Sequence("actor", "ts", ("ok", "ln", "pk", "sk", "price"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, actor, ts, cat (null for views), net, sig, tok (two tokens, null for null cat), lat, lon, value."""
    d = table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("actor"), F.col("ts").cast("timestamp").alias("ts"), "event_type", F.nullif(F.col("event_type"), F.lit("view")).alias("cat"),
        F.get_json_object("props", "$.k").alias("net"), (F.col("event_type") == "error").cast("int").alias("sig"), "value",
    )
    k = F.col("net").cast("long")
    return d.withColumns({
        "tok": F.concat(F.lit(" "), F.col("cat"), F.lit(" | t"), (k % 3).cast("string"), F.lit("||"), F.col("cat")),
        "lat": F.when(k % 7 != 0, (F.col("event_id") * 37 % 180 - 90).cast("double")), "lon": F.when(k % 7 != 0, (F.col("event_id") * 91 % 360 - 180).cast("double")),
    })


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as events of the ordering customer, with real ties in time; nation and region of the supplier."""
    li, o, s, n, r = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "supplier", "nation", "region"))
    d = li.join(o.select("o_orderkey", "o_custkey"), li["l_orderkey"] == F.col("o_orderkey"))
    place = F.broadcast(n.join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name"))  # nations: a fixed, small set
    d = d.join(s.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey")).join(place, F.col("s_nationkey") == F.col("n_nationkey"))
    return d.select(
        F.col("o_custkey").alias("actor"), F.col("l_shipdate").cast("timestamp").alias("ts"), F.col("l_orderkey").alias("ok"), F.col("l_linenumber").alias("ln"), F.col("l_partkey").alias("pk"),
        F.col("l_suppkey").alias("sk"), F.col("l_extendedprice").alias("price"), F.col("n_name").alias("country"), F.col("r_name").alias("continent"), (F.col("l_returnflag") == "R").cast("int").alias("sig"),
    )
