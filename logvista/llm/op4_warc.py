"""WARC captures and the resolution of not-modified revisits.

A not-modified revisit says that a page had not changed: it has validators and headers, but no body. It is resolved by an
as-of join on the canonical URL to the latest earlier full response. Its validators have to agree with that response's; then it
gets that body, and the response's headers with those that a 304 may update. Revisits of the other profile, by an identical
payload, are no such statement and take no part.

The as-of join runs in two steps for URLs with very many captures, so that they don't meet in one task: within buckets of
time, cut at quantiles of the URL's own captures, and over one summary row for each bucket for captures that have no response
earlier in their own.
"""

from __future__ import annotations

import gzip
import io
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import Workspace, join_split, likely, read_table

#: Buckets that the captures of a frequent URL are cut into; a URL is frequent with more than this and 1/SHARE of all captures.
BUCKETS, FREQUENT, SHARE = 256, 10_000, 1000
#: Bytes of bodies that are handed over at once, about.
BATCH = 1 << 24
#: Header fields that a 304 does not update, for they describe the stored body or one connection (RFC 9111, 3.2).
KEPT = (
    "connection", "content-encoding", "content-length", "content-location", "content-md5", "content-range", "content-type", "keep-alive",
    "proxy-authenticate", "proxy-authentication-info", "proxy-authorization", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade",
)
_URL = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::(\d*))?([^?#]*)(?:\?([^#]*))?"
_TRACKING = r"^(?:utm_[^=]*|fbclid|gclid|msclkid)(?:=|$)"
RECORDS = "record_id long, url string, at long, kind string, status int, profile string, headers map<string,string>, body binary"
_FULL = "kind = 'response' and status = 200 and body is not null"
_NOT_MODIFIED = "kind = 'revisit' and coalesce(rtrim('/', profile) like '%server-not-modified', status = 304)"


def canonical_url(url) -> F.Column:
    """Host in lower case without www, port unless 80 or 443, path without final slash, parameters sorted without tracking ones.

    Scheme, user and fragment don't count. What is not an absolute URL is left as it is; null stays null.
    """
    part = lambda i: F.regexp_extract(url, _URL, i)
    host = F.regexp_replace(F.lower(part(1)), r"^www\d*\.|\.$", "")
    port = F.when(part(2).isin("", "80", "443"), "").otherwise(F.concat(F.lit(":"), part(2)))
    wanted = F.array_sort(F.filter(F.split(part(4), "&"), lambda p: (p != "") & ~p.rlike(_TRACKING)))
    query = F.when(F.size(wanted) > 0, F.concat(F.lit("?"), F.array_join(wanted, "&"))).otherwise("")
    return F.when(url.rlike(_URL), F.concat(host, port, F.regexp_replace(part(3), "/+$", ""), query)).otherwise(url)


def _strong(etag) -> F.Column:
    return F.regexp_replace(F.trim(etag), "^W/", "")


def latest_response(records: DataFrame, work: Workspace) -> DataFrame:
    """(record_id, key, at, headers, found) for each revisit; found: (id, etag, modified) of the latest earlier response, or null.

    Earlier is strictly earlier; of responses at one instant the largest id counts.
    """
    name = lambda n: F.element_at("headers", n)
    full = F.expr(_FULL)
    slim = records.where((full | F.expr(_NOT_MODIFIED)) & F.col("url").isNotNull() & F.col("at").isNotNull()).select(
        "record_id", canonical_url(F.col("url")).alias("key"), "at", full.cast("int").alias("full"), F.when(~full, F.col("headers")).alias("headers"),
        F.when(full, F.struct(F.col("record_id").alias("id"), _strong(name("etag")).alias("etag"), name("last-modified").alias("modified"))).alias("own"),
    )
    slim = work.keep(slim, "slim")
    many = max(FREQUENT, slim.count() // SHARE)
    cuts = F.percentile_approx("at", [i / BUCKETS for i in range(1, BUCKETS)], 10 * BUCKETS)
    frequent = slim.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > many).select("key")  # SHARE rows at most
    frequent = work.keep(slim.join(F.broadcast(work.keep(frequent, "frequent")), "key").groupBy("key").agg(cuts.alias("cuts")), "cuts")
    slim = slim.join(F.broadcast(frequent), "key", "left")
    slim = slim.withColumn("bucket", F.when(F.col("cuts").isNull(), 0).otherwise(F.size(F.filter("cuts", lambda c: c <= F.col("at"))))).drop("cuts")
    order = Window.partitionBy("key", "bucket").orderBy("at", "full", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    here = slim.withColumn("found", F.last("own", ignorenulls=True).over(order)).where("full = 0")
    last = slim.groupBy("key", "bucket").agg(F.max(F.when(F.col("full") == 1, F.struct("at", "record_id", "own"))).alias("last"))
    before = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("key", "bucket", F.last("last.own", ignorenulls=True).over(before).alias("carried"))
    return here.join(carried, ["key", "bucket"], "left").select("record_id", "key", "at", "headers", F.coalesce("found", "carried").alias("found"))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row a revisit: (record_id, canonical_url, at, outcome, response_id, headers, body).

    ``outcome`` is resolved; mismatch (a validator that both have differs; entity tags are compared weakly, and decide
    alone where both have one); unvalidated (no validator in common); or missing (no earlier full response). Only resolved
    ones have headers and body. ``records`` is as RECORDS, header names in lower case; a revisit without URL or time takes
    no part, nor does one whose profile is not server-not-modified (without a profile: whose status is not 304). Repeated
    revisits get a row each; of responses that share their id, the last one's body counts. Empty bodies are bodies. Other
    columns are not read; an empty table gives no rows. Only bodies that some revisit needs are shuffled.
    """
    work = Workspace(records.sparkSession, "warc")
    own = latest_response(records, work)
    etag, modified = _strong(F.element_at("headers", "etag")), F.element_at("headers", "last-modified")
    both_tags, both_dates = etag.isNotNull() & F.col("found.etag").isNotNull(), modified.isNotNull() & F.col("found.modified").isNotNull()
    outcome = (
        F.when(F.col("found").isNull(), "missing")
        .when(both_tags, F.when(etag == F.col("found.etag"), "resolved").otherwise("mismatch"))
        .when(both_dates, F.when(modified == F.col("found.modified"), "resolved").otherwise("mismatch"))
        .otherwise("unvalidated")
    )
    judged = work.keep(own.select("record_id", "key", "at", outcome.alias("outcome"), F.col("found.id").alias("response_id"), "headers"), "judged")
    done = judged.where("outcome = 'resolved'")
    needed = work.keep(done.select(F.col("response_id").alias("id")).distinct(), "needed")
    stored = records.where(_FULL).select(F.col("record_id").alias("id"), "at", F.col("headers").alias("s_headers"), "body")
    stored = likely(stored, needed).join(needed, "id").groupBy("id").agg(F.max_by(F.struct("s_headers", "body"), F.struct("at", F.md5("body"))).alias("s"))
    stored = work.keep(stored.select(F.col("id").alias("response_id"), "s.*"), "stored")
    none = stored.schema
    rest = judged.where("outcome <> 'resolved'").select("*", *(F.lit(None).cast(none[c].dataType).alias(c) for c in ("s_headers", "body")))
    out = join_split(done, stored, ["response_id"], work).unionByName(rest)
    update = F.map_filter("headers", lambda k, _: ~k.isin(*KEPT))
    old = F.map_filter("s_headers", lambda k, _: ~F.coalesce(F.map_contains_key(update, k), F.lit(False)))
    merged = F.map_concat(old, F.coalesce(update, F.create_map().cast("map<string,string>")))
    return out.select("record_id", F.col("key").alias("canonical_url"), "at", "outcome", "response_id", merged.alias("headers"), "body")


# --- WARC files -------------------------------------------------------------------------------------------------------


def _fields(block: bytes) -> tuple[str, dict[str, str]]:
    """The first line, and the fields by their names in lower case; values of a repeated field are joined as HTTP says."""
    first, *rest = re.sub(rb"\r?\n[ \t]+", b" ", block).decode("utf-8", "replace").split("\n")
    fields: dict[str, str] = {}
    for line in rest:
        name, colon, value = line.partition(":")
        if colon:
            name, value = name.strip().lower(), value.strip()
            fields[name] = (fields[name] + ("\n" if name == "set-cookie" else ", ") + value) if name in fields else value
    return first.strip(), fields


def _whole(body: bytes) -> bytes | None:
    """A chunked body put together; None if it is not chunked."""
    out, at = [], 0
    while m := re.compile(rb"([0-9A-Fa-f]{1,8})[^\r\n]*\r\n").match(body, at):
        size, at = int(m[1], 16), m.end()
        if not size:
            return b"".join(out)
        out.append(body[at : at + size])
        if len(out[-1]) < size or body[at + size : at + size + 2] != b"\r\n":
            return None
        at += size + 2
    return None


def parse(source) -> Iterator[dict]:
    """The captures of a WARC file, plain or gzipped by record: its response and revisit records, in order.

    ``source`` is bytes or a binary file, which is read record by record, so that memory follows the largest record. Bodies
    are bytes as they were sent, chunked ones put together; a content coding stays, and so does its header field. Raises
    ValueError where a record does not begin or end as it should.
    """
    f = io.BytesIO(source) if isinstance(source, bytes | bytearray) else source
    start = f.read(2)
    f.seek(0)
    f = io.BufferedReader(gzip.GzipFile(fileobj=f) if start == b"\x1f\x8b" else f)
    while line := f.readline(1 << 16):
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("a record does not begin with its version")
        lines = [line]
        while (line := f.readline(1 << 20)).strip():
            lines.append(line)
        if not line:
            raise ValueError("a record ends within its header")
        _, head = _fields(b"".join(lines))
        size = int(head.get("content-length", 0))
        block = f.read(size)
        if len(block) < size:
            raise ValueError("a record is shorter than its content-length")
        if head.get("warc-type") in ("response", "revisit"):
            http, _, body = block.partition(b"\r\n\r\n")
            first, headers = _fields(http)
            code = re.match(r"HTTP/\S+\s+(\d{3})", first)
            if "chunked" in headers.get("transfer-encoding", "").lower() and (whole := _whole(body)) is not None:
                body = whole
                del headers["transfer-encoding"]
            yield {
                "url": head.get("warc-target-uri", "").strip("<>"), "date": head.get("warc-date"), "kind": head["warc-type"], "status": int(code[1]) if code else None,
                "profile": head.get("warc-profile"), "headers": headers, "body": body if head["warc-type"] == "response" else None,
            }


def build(captures: list[dict]) -> bytes:
    """A WARC file of captures as ``parse`` yields them."""
    out = []
    for c in captures:
        http = f"HTTP/1.1 {c['status']} -\r\n" + "".join(f"{k}: {v}\r\n" for k, v in c["headers"].items()) + "\r\n"
        block = http.encode() + (c["body"] or b"")
        profile = f"WARC-Profile: {c['profile']}\r\n" if c["profile"] else ""
        out.append(f"WARC/1.1\r\nWARC-Type: {c['kind']}\r\nWARC-Target-URI: {c['url']}\r\nWARC-Date: {c['date']}\r\n{profile}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n")
    return b"".join(out)


_PARSED = (
    ("path", pa.string()), ("n", pa.int64()), ("url", pa.string()), ("date", pa.string()), ("kind", pa.string()), ("status", pa.int32()), ("profile", pa.string()),
    ("headers", pa.map_(pa.string(), pa.string())), ("body", pa.binary()),
)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Captures (RECORDS) of the WARC files under ``path``, read by Spark; ids number files and records, times are in microseconds.

    A file without captures gives no rows; a field or header that is missing is null or absent. Repeated records get a row
    each. A compressed file is unpacked record by record. Spark reads files of up to 2 GB; larger ones have to be cut between records.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in _PARSED], names=[c for c, _ in _PARSED])

        for batch in batches:
            for name, raw in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                rows, size = [], 0
                for i, c in enumerate(parse(pa.BufferReader(raw.as_buffer()))):
                    rows.append(c | {"path": name, "n": i, "headers": list(c["headers"].items())})
                    size += len(c["body"] or b"") + 1000
                    if size > BATCH:
                        yield out(rows)
                        rows, size = [], 0
                yield out(rows)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    rows = files.mapInArrow(run, "path string, n long, url string, date string, kind string, status int, profile string, headers map<string,string>, body binary")
    id_ = F.shiftleft(F.xxhash64("path").bitwiseAND(F.lit((1 << 31) - 1)), 32).bitwiseOR(F.col("n"))
    return rows.select(id_.alias("record_id"), "url", F.unix_micros(F.try_to_timestamp("date")).alias("at"), "kind", "status", "profile", "headers", "body")


# --- the query --------------------------------------------------------------------------------------------------------


def captures_of(pages: DataFrame) -> DataFrame:
    """Captures of every page, so that each outcome occurs, by the remainder m of page_id and 8.

    A first response at 4 * page_id (none if m = 0), a second one of another body 1000 later (m = 1, 3) or after the revisit
    (m = 2), and a not-modified revisit 10,001 later. That has the entity tag of the first response, but of the second for
    m = 3, none for m = 4 (no validator), 5 (the first's date) and 6 (another date).
    """
    m, page = F.pmod("page_id", F.lit(8)), F.col("page_id")
    tag = lambda html: F.concat(F.lit('"'), F.md5(F.coalesce(html, F.lit("")).cast("binary")), F.lit('"'))
    second = F.concat(F.col("html"), F.lit("<!-- 2 -->"))
    date = lambda x: F.concat(F.lit(x), page.cast("string"))
    fields = lambda **x: F.map_filter(F.create_map(*(v for k, c in x.items() for v in (F.lit(k.replace("_", "-")), c))), lambda _, v: v.isNotNull())
    seen = {"content_type": F.lit("text/html"), "x_seen": F.lit("first")}
    again = fields(
        etag=F.when(m < 3, F.concat(F.lit("W/"), tag(F.col("html")))).when(m == 3, F.concat(F.lit("W/"), tag(second))).when(m == 7, tag(F.col("html"))),
        last_modified=F.when(m == 5, date("d")).when(m == 6, date("x")), content_type=F.lit("none"), x_seen=F.lit("again"),
    )
    one = lambda n, at, kind, status, headers, body: F.struct(
        (page * 4 + n).alias("record_id"), at.alias("at"), F.lit(kind).alias("kind"), F.lit(status).alias("status"), headers.alias("headers"), body.cast("binary").alias("body")
    )
    first = F.when(m != 0, one(0, page * 4, "response", 200, fields(etag=tag(F.col("html")), last_modified=date("d"), **seen), F.col("html")))
    later = F.when(m.between(1, 3), one(1, page * 4 + F.when(m == 2, 20_000).otherwise(1000), "response", 200, fields(etag=tag(second), last_modified=date("e"), **seen), second))
    revisit = one(2, page * 4 + 10_001, "revisit", 304, again, F.lit(None))
    every = pages.select("url", F.explode(F.array(first, later, revisit)).alias("c")).where("c is not null")
    return every.select("c.*", "url", F.lit(None).cast("string").alias("profile"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resolve_revisits(captures_of(read_table(spark, sf_dir, "pages")))
    header = lambda n: F.element_at("headers", n).alias(n.replace("-", "_"))
    return out.select(
        F.shiftright("record_id", 2).alias("page_id"), "canonical_url", "at", "outcome", "response_id", *map(header, ("etag", "last-modified", "content-type", "x-seen")),
        F.octet_length("body").cast("long").alias("body_bytes"), F.md5("body").alias("body_md5"),
    )


SQL = r"""
WITH u AS (
  SELECT page_id, html, url, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::(\d*))?([^?#]*)(?:\?([^#]*))?', ['host', 'port', 'path', 'query']) AS p FROM pages
), k AS (
  SELECT page_id, html, page_id % 8 AS m,
    regexp_replace(lower(p.host), '^www\d*\.|\.$', '', 'g') || CASE WHEN p.port IN ('', '80', '443') THEN '' ELSE ':' || p.port END || regexp_replace(p.path, '/+$', '') ||
    CASE WHEN len(list_filter(string_split(p.query, '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(?:utm_[^=]*|fbclid|gclid|msclkid)(?:=|$)'))) > 0
         THEN '?' || array_to_string(list_sort(list_filter(string_split(p.query, '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(?:utm_[^=]*|fbclid|gclid|msclkid)(?:=|$)'))), '&') ELSE '' END AS key
  FROM u
), s AS (
  SELECT key, 4 * page_id AS id, 4 * page_id AS "at", html AS body, 'd' || page_id AS modified FROM k WHERE m <> 0 AND html IS NOT NULL
  UNION ALL
  SELECT key, 4 * page_id + 1, 4 * page_id + CASE WHEN m = 2 THEN 20000 ELSE 1000 END, html || '<!-- 2 -->', 'e' || page_id FROM k WHERE m BETWEEN 1 AND 3 AND html IS NOT NULL
), v AS (
  SELECT key, page_id, 4 * page_id + 10001 AS "at", CASE WHEN m < 3 OR m = 7 THEN md5(coalesce(html, '')) WHEN m = 3 THEN md5(coalesce(html || '<!-- 2 -->', '')) END AS tag, m,
    CASE WHEN m = 5 THEN 'd' || page_id WHEN m = 6 THEN 'x' || page_id END AS modified FROM k
), r AS (
  SELECT v.page_id, v.key, v."at", v.tag AS own, v.m, v.modified AS own_modified, s.id AS response_id, s.body, s.modified, row_number() OVER (PARTITION BY v.page_id ORDER BY s."at" DESC NULLS LAST, s.id DESC) AS n
  FROM v LEFT JOIN s ON s.key = v.key AND s."at" < v."at"
), o AS (
  SELECT *, CASE WHEN response_id IS NULL THEN 'missing' WHEN own IS NOT NULL THEN CASE WHEN own = md5(body) THEN 'resolved' ELSE 'mismatch' END
    WHEN own_modified IS NOT NULL THEN CASE WHEN own_modified = modified THEN 'resolved' ELSE 'mismatch' END ELSE 'unvalidated' END AS outcome FROM r WHERE n = 1
)
SELECT page_id, key AS canonical_url, "at", outcome, response_id,
  CASE WHEN outcome = 'resolved' THEN CASE WHEN own IS NULL OR m = 7 THEN '' ELSE 'W/' END || '"' || coalesce(own, md5(body)) || '"' END AS etag,
  CASE WHEN outcome = 'resolved' THEN coalesce(own_modified, modified) END AS last_modified,
  CASE WHEN outcome = 'resolved' THEN 'text/html' END AS content_type, CASE WHEN outcome = 'resolved' THEN 'again' END AS x_seen,
  CASE WHEN outcome = 'resolved' THEN CAST(strlen(body) AS BIGINT) END AS body_bytes, CASE WHEN outcome = 'resolved' THEN md5(body) END AS body_md5
FROM o
"""
