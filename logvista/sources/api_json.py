"""Audit-API pages landed as JSON, flattened to raw records.

``land_pages`` follows the page tokens of a client and keeps each page as it came; a page holds ``items`` and, but for the
last, ``nextPageToken``. Everything after that reads what has landed.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import detect_ip_version, event_status
from ..operators.sampling import number_rows


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


_S = T.StringType()
#: A parameter is a map, for it matters which of its keys are there, with or without a value.
_PARAMETERS = T.ArrayType(T.MapType(_S, _S))
ITEM = _struct(
    id=_struct(time=_S, uniqueQualifier=_S), actor=_struct(email=_S), ipAddress=_S, geoLocation=_struct(country=_S, region=_S, city=_S, continent=_S),
    events=T.ArrayType(_struct(name=_S, parameters=_PARAMETERS)),
)
PAGE = _struct(items=T.ArrayType(ITEM), nextPageToken=_S)
GEO = "ip string, country string, region string, city string, continent string, latitude double, longitude double"


def land_pages(call: Callable[[str | None], dict], folder: str) -> int:
    """Calls for page after page, each with the token that the one before gave, and keeps them as numbered files; returns how many.

    ``call`` takes a token (None for the first page) and returns a page; which application, event and times it asks for is up to it.
    """
    Path(folder).mkdir(parents=True, exist_ok=True)
    n, token = 0, None
    while True:
        page = call(token)
        Path(folder, f"page-{n:08d}.json").write_text(json.dumps(page, ensure_ascii=False), encoding="utf-8")
        n += 1
        if not (token := page.get("nextPageToken")):
            return n


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """The items of landed pages, as ``read_items`` gives them, with page_ (the file's name) and at_ (the place in the page).

    Raises ValueError unless exactly the last page is without a token, which tells a stopped run.
    """
    pages = spark.read.schema(PAGE).option("multiLine", True).json(path).withColumn("page_", F.col("_metadata.file_name"))
    ends = pages.agg(F.max("page_").alias("last"), F.max(F.when(F.col("nextPageToken").isNull(), F.col("page_"))).alias("end"), F.count_if(F.col("nextPageToken").isNull()).alias("n")).first()
    if ends["last"] is not None and (ends["n"] != 1 or ends["end"] != ends["last"]):
        raise ValueError("the pages do not end with the only one that has no token")
    return pages.select("page_", F.posexplode("items").alias("at_", "item")).select("item.*", "page_", "at_")


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """Items that landed one a line."""
    return spark.read.schema(ITEM).option("multiLine", False).json(path)


def parameter_value(p: Column) -> Column:
    """A parameter's value as text, by the first key it has: plain, boolean, integer, or a list, whose members are joined by bars."""
    out = F.when(F.lit(False), "")
    for key in ("value", "boolValue", "intValue", "multiValue", "multiStrValue"):
        text = p[key]
        if key.startswith("multi"):
            text = F.array_join(F.from_json(text, "array<string>"), "|", "None")
        out = out.when(F.map_contains_key(p, key), text)
    return out


def _hash(text: Column) -> Column:
    """A short hash of a text as it is; null for null and empty."""
    return F.when(F.coalesce(text, F.lit("")) != "", F.substring(F.sha2(text.cast("binary"), 256), 1, 16))


def flatten(items: DataFrame, geo: DataFrame | None = None, record_id: Column | None = None) -> DataFrame:
    """The 16 raw columns of each item, all text; ``record_id`` is the item's own name unless a column is given.

    The first event name that is not null names the record and its status, which is null without any event; of parameters
    with one name the last counts, even if it has no value. An ``ip_address`` parameter takes the place of the item's address
    in its hash. What the provider tells of the place wins, if it is not empty, over ``geo`` (GEO, a row an address), which
    fills the rest.
    """
    all_ = F.flatten(F.transform(F.col("events"), lambda e: F.coalesce(e["parameters"], F.array().cast(_PARAMETERS))))

    def told(name: str) -> Column:
        return F.filter(all_, lambda p: p["name"] == name)

    def last(name: str) -> Column:
        return F.when(F.size(told(name)) > 0, parameter_value(F.element_at(told(name), -1)))

    name = F.try_element_at(F.filter(F.transform("events", lambda e: e["name"]), lambda n: n.isNotNull()), F.lit(1))
    address = F.trim(F.col("ipAddress"))
    out = items
    g = {c: F.lit(None).cast("string") for c in ("country", "region", "city", "continent", "latitude", "longitude")}
    if geo is not None:
        out = items.join(geo.select(F.struct("*").alias("geo_")), address == F.col("geo_.ip"), "left")
        g = {c: F.col(f"geo_.{c}").cast("string") for c in g}
    place = {c: F.coalesce(F.nullif(F.col(f"geoLocation.{c}"), F.lit("")), g[c]) for c in ("country", "region", "city", "continent")}
    ip_hash = F.when(F.size(told("ip_address")) > 0, _hash(last("ip_address"))).otherwise(_hash(F.col("ipAddress")))
    number = F.col("id.uniqueQualifier") if record_id is None else record_id
    return out.select(
        number.cast("string").alias("record_id"), F.col("id.time").alias("event_time"), _hash(F.col("actor.email")).alias("actor_email_hash"), ip_hash.alias("ip_hash"),
        detect_ip_version(address).cast("string").alias("ip_version"), place["country"].alias("ip_country"), place["region"].alias("ip_region"), place["city"].alias("ip_city"),
        place["continent"].alias("continent"), g["latitude"].alias("latitude"), g["longitude"].alias("longitude"), name.alias("event_name"), last("is_suspicious").alias("is_suspicious"),
        last("login_type").alias("login_type"), last("login_challenge_method").alias("login_challenge_method"), F.when(F.size("events") > 0, event_status(name)).alias("login_status"),
    )


def extract(pages: DataFrame, geo: DataFrame | None = None) -> DataFrame:
    """Raw records of landed pages, numbered from 1 in the order in which the items came."""
    ordered = number_rows(pages, [F.col("page_"), F.col("at_")], "number_")
    return flatten(ordered, geo, F.col("number_") + 1)


def write_raw(records: DataFrame, path: str) -> None:
    """Raw records as CSV with a header, in parts."""
    records.write.mode("overwrite").options(header=True, nullValue="", emptyValue="", quote='"', escape='"').csv(path)


def distinct_addresses(items: DataFrame) -> DataFrame:
    """The addresses to look up, each once."""
    return items.where(F.coalesce("ipAddress", F.lit("")) != "").select(F.col("ipAddress").alias("ip")).distinct()


def geo_status(answers: DataFrame) -> DataFrame:
    """Looked-up answers (ip, http, error, status, timezone, latitude, longitude, country…) judged: adds ``lookup``, takes the region
    of the time zone for the continent, and clears each coordinate that is out of range. ``error`` names why there is no answer.
    """
    version = detect_ip_version(F.trim("ip"))
    lookup = (
        F.when(F.coalesce("ip", F.lit("")) == "", "empty_ip").when(version.isNull(), "invalid_ip").when(F.col("http").isNull(), F.concat(F.lit("request_error:"), F.coalesce("error", F.lit("Unknown"))))
        .when(F.col("http") != 200, F.concat(F.lit("http_"), F.col("http").cast("string"))).when(F.col("status").isNull(), "invalid_response")
        .when(F.col("status") == "fail", "provider_fail").otherwise("ok")
    )
    region = F.when(F.col("timezone").contains("/"), F.split_part(F.col("timezone"), F.lit("/"), F.lit(1)))
    out = answers.withColumn("lookup", lookup).withColumn("continent", region)
    return out.withColumns({"latitude": F.when(F.col("latitude").between(-90, 90), F.col("latitude")), "longitude": F.when(F.col("longitude").between(-180, 180), F.col("longitude"))})
