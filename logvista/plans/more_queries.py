"""More registered queries: sources, releases, checks that must find planted breaks, samples and features, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import describe as D
from ..operators import ml as M
from ..operators import sampling as P
from ..operators import stats as T
from ..operators import validate as V
from ..sources import api_json as A
from ..sources.adapters import E_SEQUENCE as ES
from ..sources.adapters import events, shipments, table
from ..sources.raw_csv import Folder, RawFile, read_all
from ..sources.staging import discard, new_path, staged
from . import queries as Q
from . import release as R
from .process import clean, dedupe_keep_first
from .queries import _E, _G, _KM, _L, _R, query
from .schema import FORBIDDEN_PUBLIC, PUBLIC_42, RAW, RESTRICTED_50

# --- sources

_KEY = b"key of the test tables"


@query(
    ", x AS (SELECT event_id, 'a' || actor AS a, CASE WHEN event_id % 50 <> 3 THEN date_trunc('second', ts) END AS t, "
    "(['Netherlands', 'São \"Tomé\"\nand more; x', 'NA', 'Brazil'])[CAST(event_id % 4 + 1 AS INTEGER)] AS country, CASE WHEN event_id % 6 < 4 THEN 4 WHEN event_id % 6 = 4 THEN 6 END AS version, "
    "CASE WHEN event_id % 9 <> 5 THEN event_id % 180 - 90 + 0.25::DOUBLE END AS lat, CASE WHEN event_id % 9 <> 5 THEN event_id % 360 - 180 + 0.5::DOUBLE END AS lon, event_id % 2 AS sig FROM e) "
    "SELECT CAST(event_id AS VARCHAR) AS record_id, CASE WHEN event_id % 3 = 0 THEN 'north' ELSE 'south' END AS institution, t AS event_time, country, CAST(version AS INTEGER) AS version, "
    "CASE WHEN lat <= 90 AND lon <= 180 THEN lat END AS lat, CASE WHEN lat <= 90 AND lon <= 180 THEN lon END AS lon, CAST(sig AS INTEGER) AS signal FROM x WHERE t IS NOT NULL AND event_id % 40 <> 7"
)
def raw_files(spark, sf):
    """Events written as raw CSV files of two forms, with copies, blank rows and broken times, then read, cleaned and made unique."""
    e = events(spark, sf)
    i = F.col("event_id")
    text = {
        "record_id": i.cast("string"), "event_time": F.when(i % 50 == 3, "never").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")), "actor_email_hash": F.concat(F.lit("a"), F.col("actor").cast("string")),
        "ip_hash": i.cast("string"), "ip_version": F.when(i % 6 < 4, "4").when(i % 6 == 4, "6.0").otherwise("none"),
        "ip_country": F.element_at(F.array(*map(F.lit, ("The Netherlands", 'São "Tomé"\nand more; x', "NA", "Brazil"))), (i % 4 + 1).cast("int")),
        "latitude": F.when(i % 9 != 5, F.replace((i % 180 - 90 + 0.25).cast("string"), F.lit("."), F.lit(","))), "longitude": F.when(i % 9 != 5, (i % 360 - 180 + 0.5).cast("string")),
        "is_suspicious": F.when(i % 2 == 1, " TRUE").otherwise("no"), "login_type": F.col("event_type"), "login_challenge_method": F.lit("password"),
    }
    raw = e.select(i.alias("id_"), *(F.when(i % 40 != 7, c).alias(n) for n, c in text.items()))
    more = raw.where("id_ % 20 = 0").withColumn("record_id", F.concat(F.lit("copy "), F.col("record_id")))  # the same content, read later
    forms = {"north": (raw.where("id_ % 3 = 0"), ",", "UTF-8"), "south": (raw.where("id_ % 3 <> 0"), ";", "ISO-8859-1"), "west": (more, "|", "UTF-8")}
    files = []
    for name, (part, sep, encoding) in forms.items():
        path = new_path(spark, f"raw-{name}")
        part.drop("id_").write.options(header=True, sep=sep, encoding=encoding, quote='"', escape='"', quoteAll=True, emptyValue="").csv(path)
        files += [RawFile(p, name, _KEY) for p, _ in Folder(path, spark).entries() if p.endswith(".csv")]
    found, _ = read_all(spark, files, ["event_time"])
    cleaned, _ = clean(found)
    unique = dedupe_keep_first(cleaned, [c for c in RAW if c != "record_id" and c in cleaned.columns])
    return unique.select("record_id", "institution", F.col("event_time").cast("timestamp_ntz").alias("event_time"), F.col("ip_country").alias("country"), F.col("ip_version").alias("version"), F.col("latitude").alias("lat"),
                         F.col("longitude").alias("lon"), S.signal(F.col("is_suspicious")).alias("signal"))


_NAMES = "login_success login_failure login_challenge login_verification logout".split()


@query(
    ", x AS (SELECT *, event_id % 5 AS k, (['login_success', 'login_failure', 'login_challenge', 'login_verification', 'logout'])[CAST(event_id % 5 + 1 AS INTEGER)] AS name, '10.0.' || (event_id % 7) || '.1' AS ip FROM e) "
    "SELECT CAST(event_id AS VARCHAR) AS record_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS event_time, substr(sha256('U' || actor || '@x.org'), 1, 16) AS actor_email_hash, "
    "CASE WHEN event_id % 4 = 1 THEN substr(sha256('9.9.9.' || (event_id % 3)), 1, 16) WHEN event_id % 4 = 2 THEN NULL ELSE substr(sha256(ip), 1, 16) END AS ip_hash, '4' AS ip_version, "
    "CASE WHEN event_id % 3 = 0 THEN 'Angola' WHEN event_id % 7 < 3 THEN 'Country ' || (event_id % 7) END AS ip_country, CASE WHEN event_id % 7 < 3 THEN 'Africa' END AS continent, CASE WHEN event_id % 7 < 3 THEN CAST((event_id % 7) + 0.5 AS VARCHAR) END AS latitude, "
    "CASE WHEN event_id % 6 <> 0 THEN name END AS event_name, CASE WHEN event_id % 6 = 0 THEN NULL WHEN k = 0 THEN 'success' WHEN k = 1 THEN 'failure' WHEN k = 2 THEN 'challenge' WHEN k = 3 THEN 'verification' ELSE 'other' END AS login_status, "
    "CASE WHEN event_id % 6 = 0 THEN NULL ELSE CASE WHEN sig = 1 THEN 'true' ELSE 'false' END END AS is_suspicious, CASE WHEN event_id % 6 = 0 THEN NULL ELSE 'second' END AS login_type, CASE WHEN event_id % 6 = 0 THEN NULL ELSE 'password|t' || (event_id % 2) END AS login_challenge_method FROM x"
    .replace("CASE WHEN event_id % 4 = 1 THEN", "CASE WHEN event_id % 6 <> 0 AND event_id % 4 = 1 THEN").replace("WHEN event_id % 4 = 2 THEN NULL", "WHEN event_id % 6 <> 0 AND event_id % 4 = 2 THEN NULL")
)
def api_records(spark, sf):
    """Audit items as JSON lines, flattened: the last of repeated parameters, explicit nulls, lists, places of the provider and of a look-up."""
    i = F.col("event_id")
    address = F.when(i % 4 == 1, F.format_string(',{"name":"ip_address","value":"9.9.9.%d"}', i % 3)).when(i % 4 == 2, ',{"name":"ip_address","value":null,"intValue":"1"}').otherwise("")
    more = F.format_string(
        '{"name":null},{"name":"%s","parameters":[{"name":"login_type","value":"first"},{"name":"is_suspicious","boolValue":%s},{"name":"login_challenge_method","multiValue":["password","t%d"]}%s]},{"name":"late","parameters":[{"name":"login_type","value":"second"}]}',
        F.element_at(F.array(*map(F.lit, _NAMES)), (i % 5 + 1).cast("int")), F.when(F.col("sig") == 1, "true").otherwise("false"), i % 2, address,
    )
    item = F.format_string(
        '{"id":{"time":"%s","uniqueQualifier":"%d"},"actor":{"email":"U%d@x.org"},"ipAddress":"10.0.%d.1"%s%s}', F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), i, F.col("actor"), i % 7,
        F.when(i % 3 == 0, ',"geoLocation":{"country":"Angola"}').when(i % 3 == 1, ',"geoLocation":{"country":""}').otherwise(""), F.when(i % 6 == 0, F.lit("")).otherwise(F.concat(F.lit(',"events":['), more, F.lit("]"))),
    )
    path = new_path(spark, "items")
    events(spark, sf).select(item.alias("value")).write.text(path)
    geo = spark.createDataFrame([(f"10.0.{k}.1", f"Country {k}", None, None, "Africa", k + 0.5, None) for k in range(3)], A.GEO)
    out = A.flatten(A.read_items(spark, path), geo)
    return out.select("record_id", "event_time", "actor_email_hash", "ip_hash", "ip_version", "ip_country", "continent", "latitude", "event_name", "login_status", "is_suspicious", "login_type", "login_challenge_method")


@query(
    "SELECT event_id, (['empty_ip', 'invalid_ip', 'http_503', 'provider_fail', 'ok', 'request_error:Timeout', 'invalid_response'])[CAST(event_id % 7 + 1 AS INTEGER)] AS lookup, CASE WHEN event_id % 2 = 0 THEN 'Africa' END AS continent, "
    "CASE WHEN event_id % 120 <= 90 THEN CAST(event_id % 120 AS DOUBLE) END AS latitude, CASE WHEN event_id % 200 <= 180 THEN CAST(event_id % 200 AS DOUBLE) END AS longitude FROM e"
)
def geo_lookup(spark, sf):
    i = F.col("event_id")
    k = i % 7
    answers = events(spark, sf).select(
        "event_id", F.when(k == 0, "").when(k == 1, "10.0.0.256").otherwise(" 10.0.0.1").alias("ip"), F.when(k == 5, F.lit(None)).when(k == 2, 503).otherwise(200).alias("http"), F.when(k == 5, "Timeout").alias("error"),
        F.when(k == 3, "fail").when(k != 6, "success").alias("status"), F.when(i % 2 == 0, "Africa/Luanda").otherwise("UTC").alias("timezone"), (i % 120).cast("double").alias("latitude"), (i % 200).cast("double").alias("longitude"),
    )
    return A.geo_status(answers).select("event_id", "lookup", "continent", "latitude", "longitude")


_ADDRESSES = ("10.0.0.1", "256.1.1.1", "2001:db8::1", "::", "1::2::3", "a.b", "1.2.3", "255.255.255.255", "1:2:3:4:5:6:7:8", "")


@query("SELECT event_id, (" + str([4, None, 6, 6, None, None, None, 4, 6, None]).replace("None", "NULL") + ")[CAST(event_id % 10 + 1 AS INTEGER)] AS version, CASE event_id % 4 WHEN 0 THEN 4 WHEN 1 THEN 6 END AS domain FROM e")
def ip_versions(spark, sf):
    address = F.element_at(F.array(*map(F.lit, _ADDRESSES)), (F.col("event_id") % 10 + 1).cast("int"))
    text = F.element_at(F.array(*map(F.lit, ("4.0", "6", "5", "x"))), (F.col("event_id") % 4 + 1).cast("int"))
    return events(spark, sf).select("event_id", S.detect_ip_version(address).alias("version"), S.ip_version(text).alias("domain"))


# --- scalar cleaning and features

_TIMES = ("2026-05-01T10:00:00Z", "2026-05-01 10:00:00.5", "2026-05-01T12:00:00+02:00", "never", "")


@query(
    "SELECT event_id, (['2026-05-01 10:00:00', '2026-05-01 10:00:00.5', '2026-05-01 10:00:00', NULL, NULL])[CAST(event_id % 5 + 1 AS INTEGER)]::TIMESTAMP AS time, CASE WHEN event_id % 3 = 0 THEN -8.5::DOUBLE WHEN event_id % 3 = 1 THEN event_id / 4.0::DOUBLE END AS number, "
    "CASE event_id % 3 WHEN 0 THEN 'Netherlands' WHEN 1 THEN 'Other Netherlands' END AS country, CASE WHEN rn = 1 THEN 0 ELSE coalesce(CAST(us - lag(us) OVER (PARTITION BY actor ORDER BY rn) > 0 AS INTEGER), 0) END AS known_history, "
    "CAST(event_id % 2 + CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS INTEGER) AS geo_jump FROM e"
)
def scalar_cleaning(spark, sf):
    i = F.col("event_id")
    pick = lambda xs, n: F.element_at(F.array(*map(F.lit, xs)), (i % n + 1).cast("int"))
    number = F.when(i % 3 == 0, " -8,5").when(i % 3 == 1, F.replace((i / 4).cast("string"), F.lit("."), F.lit(","))).otherwise("1,2,3")
    return events(spark, sf).select(
        "event_id", S.parse_time(pick(_TIMES, 5)).cast("timestamp_ntz").alias("time"), S.decimal(number).alias("number"), S.country(pick(("The Netherlands", "Other Netherlands", None), 3)).alias("country"),
        S.known_history(ES.us_since_last()).alias("known_history"), S.geo_jump((i % 2).cast("int"), F.when(i % 3 == 0, 1).otherwise(0)).alias("geo_jump"),
    )


_METHODS = ("password|passkey", "knowledge_historical_password", None, "device_prompt|device_prompt|x", "idv_preregistered_phone|idv_preregistered_email", "")


@query(
    ", m AS (SELECT event_id, (['password|passkey', 'knowledge_historical_password', NULL, 'device_prompt|device_prompt|x', 'idv_preregistered_phone|idv_preregistered_email', ''])[CAST(event_id % 6 + 1 AS INTEGER)] AS t FROM e) SELECT event_id, "
    + ", ".join(f"CAST(contains(coalesce(t, ''), '{c}') AS INTEGER) AS uses_{c}" for c in S.CHALLENGES) + ", CASE WHEN coalesce(t, '') = '' THEN 0 ELSE CAST(len(list_distinct(string_split(t, '|'))) AS INTEGER) END AS num_challenge_methods FROM m"
)
def challenge_flags(spark, sf):
    text = F.element_at(F.array(*map(F.lit, _METHODS)), (F.col("event_id") % 6 + 1).cast("int"))
    return events(spark, sf).select("event_id", *(c.alias(n) for n, c in S.challenge_flags(text).items()))


@query("SELECT count(*) FILTER (cat IS NOT NULL AND lat IS NOT NULL) AS kept, count(*) FILTER (cat IS NULL OR lat IS NULL) AS dropped, avg(sig) FILTER (cat IS NOT NULL AND lat IS NOT NULL) AS rate_kept, avg(sig) FILTER (cat IS NULL OR lat IS NULL) AS rate_dropped FROM e")
def drop_gaps(spark, sf):
    kept, bias = M.drop_gaps(events(spark, sf), ["cat", "lat"], "sig")
    return kept.agg(F.count("*").alias("kept")).select("kept", F.lit(bias["dropped"]).cast("long").alias("dropped"), *(F.lit(bias[c]).alias(c) for c in ("rate_kept", "rate_dropped")))


@query("SELECT event_id FROM e WHERE ts < (SELECT min(ts) + INTERVAL 10 DAY FROM e)")
def before_cutoff(spark, sf):
    e = events(spark, sf)
    cutoff = str(e.agg((F.min("ts") + F.expr("interval 10 days")).cast("timestamp_ntz")).first()[0])
    return M.before(e, "ts", cutoff).select("event_id")


@query(
    ", r AS (SELECT min(value) AS low, max(value) AS high FROM e WHERE event_id % 3 = 0) "
    "SELECT event_id, round(CASE WHEN value IS NULL THEN NULL ELSE greatest(0, least(1, (value - low) / (high - low + 1e-9::DOUBLE))) END, 9) AS scaled, coalesce(lat, 0) AS lat0 FROM e, r"
)
def scaled_by_validation(spark, sf):
    e = events(spark, sf).select("event_id", "value", "lat").fillna(0.0, ["lat"])
    d = M.scale_by(e, e.where("event_id % 3 = 0"), "value")
    return d.select("event_id", F.round("value", 9).alias("scaled"), F.col("lat").alias("lat0"))


@query(
    ", k AS (SELECT country FROM l GROUP BY 1 ORDER BY count(*) DESC, country LIMIT 3) SELECT ok, ln, pk, sk, " + ", ".join(f"CASE WHEN country = (SELECT country FROM (SELECT country, row_number() OVER (ORDER BY country) AS n FROM k) WHERE n = {i}) THEN 1 ELSE 0 END AS hot{i}" for i in (1, 2, 3))
    + ", CASE WHEN country IN (SELECT country FROM k) THEN 0 ELSE 1 END AS other FROM l", _L
)
def one_hot(spark, sf):
    d = shipments(spark, sf)
    known = M.top_values(d, "country", 3)
    return M.one_hot(d, "country", known).select("ok", "ln", "pk", "sk", *(F.col(f"country={v}").alias(f"hot{i}") for i, v in enumerate(sorted(known), 1)), F.col("country=_other_").alias("other"))


@query("SELECT event_id, coalesce(lat, 0) AS x0, CAST(hour(ts) AS DOUBLE) AS x1, CAST(sig AS DOUBLE) AS label, count(*) OVER () / 2.0::DOUBLE / CASE WHEN sig = 1 THEN sum(sig) OVER () ELSE sum(1 - sig) OVER () END AS weight FROM e")
def assembled(spark, sf):
    from pyspark.ml.functions import vector_to_array

    d = M.assemble(events(spark, sf).withColumn("h", F.hour("ts")), ["lat", "h"], "sig").withColumn("v", vector_to_array("features"))
    return d.select("event_id", F.col("v")[0].alias("x0"), F.col("v")[1].alias("x1"), "label", "weight")


# --- statistics and summaries


@query(
    ", f AS (SELECT sig, unnest(['late', 'even', 'placed']) AS flag, unnest([CAST(hour(ts) >= 18 AS INTEGER), CAST(event_id % 2 = 0 AS INTEGER), CASE WHEN cat IS NOT NULL THEN CAST(lat IS NOT NULL AS INTEGER) END]) AS f FROM e), "
    "t AS (SELECT flag, count(*) FILTER (f = 1 AND sig = 1) AS a, count(*) FILTER (f = 1 AND sig = 0) AS b, count(*) FILTER (f = 0 AND sig = 1) AS c, count(*) FILTER (f = 0 AND sig = 0) AS d FROM f GROUP BY flag) "
    f"SELECT flag, round({Q._OR}, 3) AS odds_ratio, round(exp(ln({Q._OR}) - 1.96 * {Q._SE}), 3) AS low, round(exp(ln({Q._OR}) + 1.96 * {Q._SE}), 3) AS high FROM t"
)
def odds_table(spark, sf):
    d = events(spark, sf).select("sig", (F.hour("ts") >= 18).cast("int").alias("late"), (F.col("event_id") % 2 == 0).cast("int").alias("even"), F.when(F.col("cat").isNotNull(), F.col("lat").isNotNull().cast("int")).alias("placed"))
    return T.odds_table(d, ["late", "even", "placed"], "sig")


@query(
    ", x AS (SELECT CAST(hour(ts) >= 18 AS INTEGER) AS r, sig AS c, count(*) AS o FROM e GROUP BY ALL), y AS (SELECT *, sum(o) OVER (PARTITION BY r) * sum(o) OVER (PARTITION BY c) / sum(o) OVER ()::DOUBLE AS ex, sum(o) OVER () AS n FROM x) "
    "SELECT round(sum(pow(greatest(abs(o - ex) - 0.5, 0), 2) / ex), 6) AS chi2, 1::BIGINT AS dof, CAST(max(n) AS BIGINT) AS n, round(sqrt(sum(pow(greatest(abs(o - ex) - 0.5, 0), 2) / ex) / max(n)), 9) AS cramers_v FROM y"
)
def chi2_two_by_two(spark, sf):
    t = T.chi_square(events(spark, sf).withColumn("late", (F.hour("ts") >= 18).cast("int")), "late", "sig")
    return t.select(F.round("chi2", 6).alias("chi2"), F.col("dof").cast("long").alias("dof"), "n", F.round("cramers_v", 9).alias("cramers_v"))


@query(
    ", g AS (SELECT actor, cat, count(*) AS c FROM e WHERE cat IS NOT NULL GROUP BY ALL), h AS (SELECT actor, log2(sum(c)) - sum(c * log2(c)) / sum(c) AS entropy FROM g GROUP BY actor), f AS (SELECT actor, max(sig) AS ever, count(*) AS n FROM e GROUP BY actor) "
    "SELECT ever AS ever_flagged, count(*) AS actors, round(avg(entropy), 6) AS mean_entropy, CAST(sum(n) AS BIGINT) AS events FROM h JOIN f USING (actor) GROUP BY 1"
)
def entropy_by_ever_flagged(spark, sf):
    e = events(spark, sf)
    both = D.entropy(e, "actor", "cat").join(e.groupBy("actor").agg(F.max("sig").alias("ever_flagged"), F.count("*").alias("n")), "actor")
    return both.groupBy("ever_flagged").agg(F.count("*").alias("actors"), F.round(F.avg("entropy"), 6).alias("mean_entropy"), F.sum("n").alias("events"))


@query(
    ", c AS (SELECT actor, count(*) AS x FROM e GROUP BY actor) SELECT (SELECT count(*) FROM e) AS events, (SELECT min(ts) FROM e) AS event_time_min, (SELECT max(ts) FROM e) AS event_time_max, (SELECT CAST(sum(sig) AS BIGINT) FROM e) AS flagged, (SELECT avg(sig) * 100 FROM e) AS flagged_percent, "
    "1::BIGINT AS institutions, count(*) AS users, count(*) FILTER (x = 1) AS singleton_users FROM c"
)
def manifest_summary(spark, sf):
    out = R.summary(Q.as_logins(spark, sf))
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("event_time_min", "event_time_max")})


@query(
    ", c AS (SELECT actor, count(*) AS x FROM e GROUP BY actor), r AS (SELECT x, row_number() OVER (ORDER BY x DESC) AS i, row_number() OVER (ORDER BY x) AS j, count(*) OVER () AS n, sum(x) OVER () AS t FROM c), "
    "v AS (SELECT (SELECT count(*) FROM e) AS events, (SELECT count(*) FROM c) AS actors, (SELECT CAST(sum(sig) AS DOUBLE) FROM e) AS flagged, (SELECT avg(sig) * 100 FROM e) AS pct, (SELECT count(*) FILTER (x = 1) FROM c) AS single, (SELECT quantile_cont(x, 0.5) FROM c) AS median, "
    "(SELECT max(x) FROM c) AS largest, (SELECT 2 * sum(j * x) / (max(n) * max(t))::DOUBLE - (max(n) + 1) / max(n)::DOUBLE FROM r) AS gini, (SELECT sum(x) * 100 / max(t)::DOUBLE FROM r WHERE i <= greatest(1, ceil(0.1::DOUBLE * n))) AS top10, "
    "(SELECT count(DISTINCT cat) FROM e) AS countries, (SELECT count(*) - count(cat) FROM e) AS missing) "
    "SELECT k AS key, round(x, 6) AS value FROM (SELECT unnest(['events', 'actors', 'events_with_prior_history', 'events_without_prior_history', 'provider_suspicious_0', 'provider_suspicious_1', 'provider_suspicious_pct', 'singleton_users', 'recurrent_users', 'actor_events_median', 'actor_events_max', "
    "'activity_gini', 'top_10pct_actor_event_share_pct', 'known_country_values', 'missing_country_events']) AS k, unnest([events, actors, events - actors, actors, events - flagged, flagged, pct, single, actors - single, median, largest, gini, top10, countries, missing]::DOUBLE[]) AS x FROM v)"
)
def statistics_document(spark, sf):
    doc = D.statistics(events(spark, sf), "actor", "ts", "sig", "cat", name="test", version="0", sha256="0" * 64)
    wanted = """events actors events_with_prior_history events_without_prior_history provider_suspicious_0 provider_suspicious_1 provider_suspicious_pct singleton_users recurrent_users actor_events_median
        actor_events_max activity_gini top_10pct_actor_event_share_pct known_country_values missing_country_events""".split()
    return spark.createDataFrame([(k, round(float(doc[k]), 6)) for k in wanted], "key string, value double")


# --- samples


@query(
    ", per AS (SELECT actor, count(*) AS n, sum(sig) AS f, md5(CAST(actor AS VARCHAR) || '|42') AS h FROM e GROUP BY actor HAVING count(*) BETWEEN 2 AND 200), "
    "lead_ AS (SELECT actor, 0 AS g FROM (SELECT * FROM per WHERE f > 0 ORDER BY h, actor LIMIT 1) UNION ALL SELECT actor, 1 FROM (SELECT * FROM per WHERE f = 0 ORDER BY h, actor LIMIT 1)), "
    "cand AS (SELECT per.*, coalesce(lead_.g, 2) AS g, row_number() OVER (ORDER BY coalesce(lead_.g, 2), h, per.actor) AS i FROM per LEFT JOIN lead_ USING (actor)), "
    "walk AS (SELECT i, CASE WHEN n <= 500 THEN n ELSE 0 END AS total, n <= 500 AS taken FROM cand WHERE i = 1 UNION ALL "
    "SELECT c.i, w.total + CASE WHEN w.total + c.n <= 500 AND (c.g < 2 OR w.total < 400) THEN c.n ELSE 0 END, w.total + c.n <= 500 AND (c.g < 2 OR w.total < 400) FROM walk w JOIN cand c ON c.i = w.i + 1) "
    "SELECT e.event_id, e.actor FROM e JOIN cand USING (actor) JOIN walk USING (i) WHERE taken", _E.replace("WITH e0", "WITH RECURSIVE e0")
)
def actor_sample(spark, sf):
    return P.actor_sample(events(spark, sf), "actor", "sig", sizes=(2, 200)).select("event_id", "actor")


@query(
    ", s AS (SELECT * FROM e WHERE actor % 10 = 3) SELECT row_number() OVER (ORDER BY actor, rn, event_id) - 1 AS position, event_id, actor FROM s"
)
def sample_order(spark, sf):
    """Whole actors by a list, in the order of a written sample."""
    e = events(spark, sf).withColumn("prior_event_count", ES.prior_count())
    chosen = e.where("actor % 10 = 3").select("actor").distinct()
    return P.in_sample_order(e.join(chosen, "actor", "left_semi"), "actor").select("position", "event_id", "actor")


@query(
    ", s AS (SELECT event_id, actor FROM e WHERE actor % 10 = 3 AND event_id % 50 <> 1), a AS (SELECT * FROM s UNION ALL (SELECT * FROM s ORDER BY event_id LIMIT 1)), t AS (SELECT actor, count(*) AS n FROM a GROUP BY actor), u AS (SELECT actor, count(*) AS n FROM e GROUP BY actor) "
    "SELECT (SELECT count(*) FROM a) + 1 AS events, 1::BIGINT AS wrong_columns, 1::BIGINT AS repeated, (SELECT count(*) FROM t JOIN u USING (actor) WHERE t.n <> u.n) + 1 AS incomplete_actors, 1::BIGINT AS unknown_events"
)
def sample_checks(spark, sf):
    """A sample with events missing, one twice, one from nowhere and a column too many; what its validation finds."""
    e = events(spark, sf).select(F.col("event_id").cast("long").alias("event_id"), F.col("actor").cast("long").alias("actor_pseudo_id"))
    part = e.where("actor_pseudo_id % 10 = 3 and event_id % 50 <> 1")
    plant = spark.createDataFrame([(-1, -1)], e.schema).union(part.orderBy("event_id").limit(1))
    found = V.sample_errors(e, part.union(plant).withColumn("history_available", F.lit(0)))
    return spark.createDataFrame([tuple(len(v) if isinstance(v, list) else v for v in found.values())], "events long, wrong_columns long, repeated long, incomplete_actors long, unknown_events long")


# --- releases

_RELEASE = _E + f""", q AS (SELECT e.*, o.toks, us // 86400000000 AS d, 'A' || lpad(CAST(actor AS VARCHAR), 8, '0') || '-' || net AS own, CASE WHEN cat IS NOT NULL THEN (['Angola', 'Brazil', 'France', 'Japan'])[CAST(event_id % 4 + 1 AS INTEGER)] END AS country,
  CASE WHEN cat IS NOT NULL THEN array_to_string(o.toks, '|') END AS method, CASE WHEN cat IS NOT NULL THEN array_to_string(list_sort(o.toks), '|') END AS tokset FROM e JOIN o USING (event_id)),
p AS (SELECT *, CASE country WHEN 'Angola' THEN 'Africa' WHEN 'Brazil' THEN 'South America' WHEN 'France' THEN 'Europe' WHEN 'Japan' THEN 'Asia' END AS cont FROM q),
pr AS (SELECT a.event_id, b.own, b.country, b.event_type, b.toks, a.us - b.us AS age, a.hr - b.hr AS hours, a.d - b.d AS days FROM p a JOIN p b ON a.actor = b.actor AND b.rn <= a.rn),
g AS (SELECT event_id, {', '.join(f"count(*) FILTER (age <= {n * 86_400_000_000}) AS logins_{k}" for k, n in (('24h', 1), ('7d', 7), ('30d', 30)))},
  {', '.join(f"CAST(count(DISTINCT CASE WHEN hours <= {n} THEN {c} END) AS INTEGER) AS distinct_{m}_{k}" for m, c in (('networks', 'own'), ('countries', 'country')) for k, n in (('24h', 24), ('7d', 168), ('30d', 720)))},
  count(DISTINCT own) AS networks_seen_to_date, count(DISTINCT country) AS distinct_countries_to_date, CAST(count(DISTINCT CASE WHEN hours <= 720 THEN event_type END) AS INTEGER) AS distinct_login_types_30d,
  CAST(count(DISTINCT CASE WHEN days <= 29 THEN days END) AS INTEGER) AS active_days_30d FROM pr GROUP BY event_id),
tk AS (SELECT event_id, CAST(count(DISTINCT tok) AS INTEGER) AS n FROM (SELECT event_id, unnest(toks) AS tok FROM pr WHERE hours <= 720) GROUP BY 1),
tr AS (SELECT event_id, actor, rn, unnest(toks) AS tok FROM p), tf AS (SELECT actor, tok, min(rn) AS first FROM tr GROUP BY ALL),
nt AS (SELECT event_id, CAST(max(CAST(first = rn AS INTEGER)) AS INTEGER) AS is_new FROM tr JOIN tf USING (actor, tok) GROUP BY 1),
x AS (SELECT p.*, {_R('(us - lag(us) OVER w) / 3600000000.0', 4)} AS h, {_KM} AS km FROM p WINDOW w AS (PARTITION BY actor ORDER BY rn))
"""
_NEW = lambda c, n: f"CASE WHEN {c} IS NOT NULL THEN CAST(row_number() OVER (PARTITION BY actor, {c} ORDER BY rn) = 1 AS INTEGER) END AS {n}"
_CHANGED = lambda c, n: f"CASE WHEN rn = 1 THEN 0 ELSE CAST({c} <> lag({c}) OVER w AS INTEGER) END AS {n}"
_PUBLIC_SQL = f"""SELECT 'E' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS event_id, 'U' || lpad(CAST(actor AS VARCHAR), 8, '0') AS actor_pseudo_id, date_trunc('hour', ts) AS event_time_hour_utc, CAST(hour(ts) AS INTEGER) AS event_hour,
  CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week, CAST(month(ts) AS INTEGER) AS month, CAST(isodow(ts) >= 6 AS INTEGER) AS is_weekend, rn - 1 AS prior_event_count, h AS hours_since_last_login,
  {_R('(us - min(us) OVER (PARTITION BY actor)) / 3600000000.0', 4)} AS hours_since_first_observed_login, logins_24h, logins_7d, logins_30d, logins_30d / least(30, d - min(d) OVER (PARTITION BY actor) + 1)::DOUBLE AS login_rate_30d, active_days_30d,
  own AS actor_network_id, 4 AS ip_version, {_NEW('own', 'is_new_ip')}, {_CHANGED('own', 'ip_changed')}, distinct_networks_24h, distinct_networks_7d, distinct_networks_30d, networks_seen_to_date, country AS ip_country, cont AS continent,
  {_NEW('country', 'is_new_country')}, {_CHANGED('country', 'country_changed')}, {_NEW('cont', 'is_new_continent')}, {_CHANGED('cont', 'continent_changed')}, distinct_countries_24h, distinct_countries_7d, distinct_countries_30d, distinct_countries_to_date,
  event_type AS login_type, method AS login_challenge_method, {_NEW('event_type', 'is_new_login_type')}, {_CHANGED('event_type', 'login_type_changed')}, CASE WHEN cat IS NOT NULL THEN is_new END AS is_new_challenge,
  {_CHANGED('tokset', 'challenge_changed')}, distinct_login_types_30d, coalesce(tk.n, 0) AS distinct_challenges_30d, sig AS provider_suspicious"""
_FROM = " FROM x JOIN g USING (event_id) LEFT JOIN tk USING (event_id) LEFT JOIN nt USING (event_id) WINDOW w AS (PARTITION BY actor ORDER BY rn)"


def _zoneless(d: DataFrame) -> DataFrame:
    return d.withColumns({c: F.col(c).cast("timestamp_ntz") for c, t in d.dtypes if t == "timestamp"})


@query(_PUBLIC_SQL + _FROM, _RELEASE)
def release_public(spark, sf):
    return _zoneless(Q._release(spark, sf).select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in PUBLIC_42.fields)))


@query(
    _PUBLIC_SQL + f""", ts AS event_time, 'I0' AS institution_pseudo_id, 'N' || net AS network_pseudo_id, CAST(NULL AS VARCHAR) AS ip_city, lat AS latitude, lon AS longitude, {_R('km', 2)} AS travel_distance_km,
  CASE WHEN h > 0 THEN {_R('km / h', 2)} END AS travel_speed_kmh""" + _FROM, _RELEASE
)
def release_restricted(spark, sf):
    return _zoneless(_restricted(spark, sf))


def _restricted(spark, sf) -> DataFrame:
    return Q._release(spark, sf).select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in RESTRICTED_50.fields))


# --- checks that must find what was planted


@query(
    """, c AS (SELECT *, event_id % 101 AS k FROM e) SELECT rule, n AS broken FROM (SELECT unnest(['signal_not_binary', 'logins_nested', 'networks_nested', 'countries_nested', 'other_country', 'hour_of_time', 'coordinates_paired', 'active_days', 'continent_known', 'first_event', 'later_event', 'known_network', 'travel_pairs', 'first_change', 'network_shared']) AS rule,
  unnest([count(*) FILTER (k = 1), count(*) FILTER (k = 2), count(*) FILTER (k = 3), count(*) FILTER (k = 4), count(*) FILTER (k = 5), count(*) FILTER (k = 6), count(*) FILTER (k = 7 AND lat IS NOT NULL), count(*) FILTER (k = 8), count(*) FILTER (k = 9 AND cat IS NOT NULL), count(*) FILTER (rn = 1 AND event_id % 2 = 0), 0, 0, 0, 0, 0]) AS n FROM c)"""
)
def invariants(spark, sf):
    """A release in which rules are broken at stated rows: how many broken rows each rule finds."""
    d = _restricted(spark, sf).withColumn("i_", F.substring("event_id", 2, 12).cast("long"))
    k = F.col("i_") % 101
    put = lambda n, c, v: F.when(k == n, v).otherwise(F.col(c))
    d = d.withColumns({
        "provider_suspicious": put(1, "provider_suspicious", 2), "logins_24h": put(2, "logins_24h", 0), "distinct_networks_24h": put(3, "distinct_networks_24h", 9999), "distinct_countries_7d": put(4, "distinct_countries_7d", 9999),
        "ip_country": F.when(k == 5, "Other").when(k != 9, F.col("ip_country")), "event_time_hour_utc": put(6, "event_time_hour_utc", F.col("event_time_hour_utc") + F.expr("interval 1 hour")),
        "latitude": F.when(k != 7, F.col("latitude")), "active_days_30d": put(8, "active_days_30d", 31), "continent": F.when(k != 5, F.col("continent")),
        "logins_30d": F.when((F.col("prior_event_count") == 0) & (F.col("i_") % 2 == 0), 2).otherwise(F.col("logins_30d")),
    }).drop("i_")
    return spark.createDataFrame(list(V.invariants(d).items()), "rule string, broken long")


@query("SELECT 0::BIGINT AS different_rows, count(*) FILTER (event_id % 50 IN (0, 1)) AS planted_rows FROM e")
def recomputation(spark, sf):
    """The features a second way: how many events differ, and how many once two features were falsified."""
    names = ["prior_event_count", "hours_since_last_login", "hours_since_first_observed_login", "networks_seen_to_date", "distinct_countries_to_date", "is_new_ip", *(f"{x}_{k}" for k, _ in V.SPANS for x in ("logins", "distinct_countries"))]
    full = staged(_restricted(spark, sf).select("event_id", "actor_pseudo_id", "event_time", "actor_network_id", "ip_country", *names), "features")
    again = staged(V.recompute(full).drop("actor_pseudo_id"), "again")
    k = F.substring("event_id", 2, 12).cast("long") % 50
    false = full.withColumns({"logins_7d": F.when(k == 0, F.col("logins_7d") + 1).otherwise(F.col("logins_7d")), "is_new_ip": F.when(k == 1, 1 - F.col("is_new_ip")).otherwise(F.col("is_new_ip"))})
    found = V.differs(again, full, "event_id"), V.differs(again, false, "event_id")
    discard(full, again)
    return spark.createDataFrame([found], "different_rows long, planted_rows long")


@query("SELECT net AS actor_network_id, min(actor) AS a, max(actor) AS b FROM e WHERE net IS NOT NULL GROUP BY net HAVING min(actor) <> max(actor)")
def shared_networks(spark, sf):
    return V.shared_networks(events(spark, sf).select(F.col("net").alias("actor_network_id"), F.col("actor").alias("actor_pseudo_id")))


@query(
    ", n AS (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS line, ts FROM e), m AS (SELECT *, CASE WHEN line % 97 = 0 THEN ts + INTERVAL 1 DAY ELSE ts END AS t FROM n), w AS (SELECT *, lead(t) OVER (ORDER BY line) AS nt, lead(event_id) OVER (ORDER BY line) AS ni FROM m), "
    "b AS (SELECT CASE WHEN event_id % 31 = 0 THEN hr + 5 ELSE hr END AS h2, actor, rn FROM e), c AS (SELECT *, lag(h2) OVER (PARTITION BY actor ORDER BY rn) AS before FROM b) "
    "SELECT unnest(['out_of_order', 'hours_backwards', 'raw_text', 'not_in_source', 'different', 'rows_differ', 'collapsed', 'collapsed_planted', 'schema_errors', 'forbidden', 'minimum', 'not_unique']) AS found, unnest(["
    "(SELECT count(*) FROM w WHERE nt < t OR (nt = t AND ni < event_id)), (SELECT count(*) FROM c WHERE h2 < before), (SELECT count(*) FROM e WHERE event_type IN ('click', 'error')), (SELECT count(*) FROM e WHERE event_id % 2 = 1), "
    "(SELECT count(*) FROM e WHERE event_id % 9 = 0), (SELECT count(*) FROM e WHERE event_id % 9 = 0), 0, 1, 1, 2, 2, 1]) AS n"
)
def release_checks(spark, sf):
    """What each check of whole tables finds where something was planted for it."""
    e = events(spark, sf)
    d = e.select("event_id", F.col("ts").alias("event_time"), "event_type", F.col("sig").alias("provider_suspicious"))
    lines = P.number_rows(d, [F.col("event_time"), F.col("event_id")], "line")
    lines = lines.withColumn("event_time", F.when(F.col("line") % 97 == 0, F.col("event_time") + F.expr("interval 1 day")).otherwise(F.col("event_time")))
    hour = F.floor(F.unix_micros("ts") / 3_600_000_000)
    hours = e.select("event_id", "actor", "ts", F.when(F.col("event_id") % 31 == 0, hour + 5).otherwise(hour).alias("event_time_hour_utc"))
    hashes = spark.createDataFrame([("click",), ("error",), ("nothing",)], "hash string")
    other = d.withColumn("event_type", F.when(F.col("event_id") % 9 == 0, "else").otherwise(F.col("event_type")))
    full = _restricted(spark, sf).select("event_time_hour_utc", "distinct_countries_24h", "distinct_countries_30d")
    try:
        V.require_unique(d.union(d.limit(1)), "event_id")
        repeated = 0
    except ValueError:
        repeated = 1
    found = {
        "out_of_order": V.out_of_order(lines, "line"), "hours_backwards": V.peers_backwards(hours, ES), "raw_text": V.raw_hash_text(d, hashes), "not_in_source": V.not_subset(d, d.where("event_id % 2 = 0"), "event_id"),
        "different": V.differs(d, other, "event_id"), "rows_differ": V.differs(d, d.where("event_id % 9 <> 0"), "event_id"), "collapsed": int(V.collapse_guard(full)),
        "collapsed_planted": int(V.collapse_guard(full.withColumn("distinct_countries_30d", F.col("distinct_countries_24h")))), "schema_errors": len(V.schema_errors(d, ["event_time", "event_id", "event_type", "provider_suspicious"])),
        "forbidden": len(V.forbidden(d.withColumn("Risk_Score", F.lit(1)), FORBIDDEN_PUBLIC)), "minimum": len(V.minimum(d, -1, 3)), "not_unique": repeated,
    }
    return spark.createDataFrame(list(found.items()), "found string, n long")


@query("SELECT unnest(['event_id', 'cat', 'net', 'lat', 'tok']) AS attribute, unnest([count(event_id), count(cat), count(net), count(lat), count(tok)]) AS non_null, unnest([count(*) - count(event_id), count(*) - count(cat), count(*) - count(net), count(*) - count(lat), count(*) - count(tok)]) AS missing_found FROM e")
def stated_counts(spark, sf):
    """Non-null counts, and the numbers of nulls that differ from a stated one (-1 is never right)."""
    d = events(spark, sf).select(*Q._MISSING)
    known, differ = V.nonnull_counts(d).first().asDict(), V.missingness_differs(d, dict.fromkeys(d.columns, -1))
    return spark.createDataFrame([(c, known[c], differ[c][0]) for c in d.columns], "attribute string, non_null long, missing_found long")


@query("SELECT row_number() OVER (ORDER BY ts, event_id) - 1 AS line, 'E' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS event_id, ts AS event_time, sig AS provider_suspicious FROM e")
def written_release(spark, sf):
    """A restricted release as written and read back, with the number of each line: parts in order, and lines in order in each."""
    pub, res = new_path(spark, "public"), new_path(spark, "restricted")
    R.write_release(Q.as_logins(spark, sf).withColumn("line_check", F.lit(1)), ["event_id", "provider_suspicious"], pub, res)
    back = spark.read.parquet(res).select("event_id", "event_time", "provider_suspicious", F.col("_metadata.file_name").alias("file_"), F.monotonically_increasing_id().alias("at_"))
    lines = P.number_rows(back, [F.col("file_"), F.col("at_")], "line")
    return _zoneless(lines.select("line", "event_id", "event_time", "provider_suspicious"))


@query(
    "SELECT * FROM (SELECT unnest(['events', 'actors', 'attributes', 'flagged', 'not_flagged', 'flagged_percent', 'first_hour', 'last_hour']) AS metric, unnest([CAST(count(*) AS VARCHAR), CAST(count(DISTINCT actor) AS VARCHAR), '12', CAST(CAST(sum(sig) AS BIGINT) AS VARCHAR), "
    "CAST(CAST(sum(1 - sig) AS BIGINT) AS VARCHAR), CAST(round(avg(sig) * 100, 9) AS VARCHAR), CAST(date_trunc('hour', min(ts)) AS VARCHAR), CAST(date_trunc('hour', max(ts)) AS VARCHAR)]) AS value FROM e)"
)
def overview(spark, sf):
    return D.overview(events(spark, sf), "actor", "ts", "sig", 12)


_COUNTRIES = {
    "Angola": "Africa", "South Sudan": "Africa", "Central African Republic": "Africa", "Eswatini": "Africa", "Comoros": "Africa", "Seychelles": "Africa", "Cabo Verde": "Africa", "Brunei": "Asia", "North Korea": "Asia",
    "Japan": "Asia", "Türkiye": "Asia", "France": "Europe", "Czech Republic": "Europe", "Czechia": "Europe", "Vatican City": "Europe", "Saint Lucia": "North America", "Mexico": "North America", "Antigua and Barbuda": "North America",
    "Brazil": "South America", "Suriname": "South America", "Australia": "Oceania", "Marshall Islands": "Oceania", "Micronesia": "Oceania", "New Zealand": "Oceania", "Atlantis": None, "angola": None,
}


@query(
    f", names AS (SELECT event_id, CASE WHEN event_id % 27 < 26 THEN ({list(_COUNTRIES)})[CAST(event_id % 27 + 1 AS INTEGER)] END AS country FROM e) "
    f"SELECT event_id, country, CASE country {' '.join(f'WHEN {c!r} THEN {k!r}' for c, k in _COUNTRIES.items() if k)} END AS continent FROM names"
)
def continent_lookup(spark, sf):
    name = F.when(F.col("event_id") % 27 < 26, F.element_at(F.array(*map(F.lit, _COUNTRIES)), (F.col("event_id") % 27 + 1).cast("int")))
    return S.with_continent(events(spark, sf).select("event_id", name.alias("country")), "country").select("event_id", "country", "continent")


_LAT, _LON = "(l_discount - 0.05) * 3000", "(l_tax - 0.04) * 6000"


@query(
    f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN ok THEN round(lat, 6) END AS lat, CASE WHEN ok THEN round(lon, 6) END AS lon FROM (SELECT *, coalesce(lat BETWEEN -90 AND 90, true) AND coalesce(lon BETWEEN -180 AND 180, true) AS ok FROM "
    f"(SELECT *, CASE WHEN l_linenumber <> 2 THEN {_LAT} END AS lat, CASE WHEN l_linenumber <> 3 THEN {_LON} END AS lon FROM lineitem))", ""
)
def coordinate_pairs(spark, sf):
    d = table(spark, sf, "lineitem")
    lat, lon = S.coordinates(F.when(F.col("l_linenumber") != 2, F.expr(_LAT)), F.when(F.col("l_linenumber") != 3, F.expr(_LON)))
    return d.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(lat, 6).alias("lat"), F.round(lon, 6).alias("lon"))


@query(f"SELECT event_type AS login_type, {_G} FROM e GROUP BY 1")
def login_type_stats(spark, sf):
    return D.by_group(events(spark, sf), [F.col("event_type").alias("login_type")], "sig")
