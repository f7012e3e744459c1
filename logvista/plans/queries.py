"""Registered queries for the analytics operators and the SQL that each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import identity as I
from ..functions import scalar as S
from ..operators import describe as D
from ..operators import ml as M
from ..operators import sampling as P
from ..operators import stats as T
from ..operators.features import add_features
from ..operators.windows import speed
from ..sources.adapters import E_SEQUENCE as ES
from ..sources.adapters import L_SEQUENCE as LS
from ..sources.adapters import events, shipments, table
from ..sources.staging import staged
from .process import dedupe_keep_first

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}

# --- the same views in SQL

_E = """WITH e0 AS (SELECT event_id, user_id AS actor, ts, epoch_us(ts) AS us, epoch_us(ts) // 3600000000 AS hr, event_type, nullif(event_type, 'view') AS cat,
  regexp_extract(props, '"k": ?([0-9]+)', 1) AS net, CAST(event_type = 'error' AS INTEGER) AS sig, value FROM events),
e AS (SELECT *, ' ' || cat || ' | t' || CAST(CAST(net AS BIGINT) % 3 AS VARCHAR) || '||' || cat AS tok, row_number() OVER (PARTITION BY actor ORDER BY ts, event_id) AS rn,
  CASE WHEN CAST(net AS BIGINT) % 7 <> 0 THEN CAST(event_id * 37 % 180 - 90 AS DOUBLE) END AS lat, CASE WHEN CAST(net AS BIGINT) % 7 <> 0 THEN CAST(event_id * 91 % 360 - 180 AS DOUBLE) END AS lon FROM e0),
o AS (SELECT event_id, [x for x in [cat, 't' || CAST(CAST(net AS BIGINT) % 3 AS VARCHAR)] if x IS NOT NULL AND cat IS NOT NULL] AS toks FROM e),
pairs AS (SELECT a.event_id, a.cat AS a_cat, b.event_id AS b_id, b.cat, b.net, b.us, a.us - b.us AS age, a.hr - b.hr AS hours, epoch_us(a.ts) // 86400000000 - epoch_us(b.ts) // 86400000000 AS days
  FROM e a JOIN e b ON a.actor = b.actor AND b.rn <= a.rn)
"""
_L = """WITH l AS (SELECT o_custkey AS actor, l_shipdate AS ts, epoch_us(l_shipdate) AS us, l_orderkey AS ok, l_linenumber AS ln, l_partkey AS pk, l_suppkey AS sk, l_extendedprice AS price, n_name AS country,
  r_name AS continent, CAST(l_returnflag = 'R' AS INTEGER) AS sig FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
"""
_R = lambda x, n: f"CAST(round_even({x}, {n}) AS DOUBLE)"


def query(sql: str | None = None, base: str = _E):
    def add(f: Query) -> Query:
        _queries[f.__name__] = f
        if sql:
            _sql[f.__name__] = base + sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)


# --- sequences and windows


@query("SELECT event_id, actor, rn AS seq_no, rn - 1 AS prior_event_count FROM e")
def actor_sequence(spark, sf):
    return events(spark, sf).select("event_id", "actor", ES.seq_no().alias("seq_no"), ES.prior_count().alias("prior_event_count"))


@query(f"SELECT event_id, {_R('(us - lag(us) OVER (PARTITION BY actor ORDER BY rn)) / 3600000000.0', 4)} AS hours_since_last_login FROM e")
def hours_since_last(spark, sf):
    return events(spark, sf).select("event_id", ES.hours_since_last().alias("hours_since_last_login"))


@query(f"SELECT event_id, {_R('(us - min(us) OVER (PARTITION BY actor)) / 3600000000.0', 4)} AS hours_since_first FROM e")
def hours_since_first(spark, sf):
    return events(spark, sf).select("event_id", ES.hours_since_first().alias("hours_since_first"))


_COUNTS = "rn - min(rn) OVER (PARTITION BY actor ORDER BY us RANGE BETWEEN {} PRECEDING AND CURRENT ROW) + 1 AS {}"
_DAY = 86_400_000_000


@query("SELECT event_id, actor, " + ", ".join(_COUNTS.format(d * _DAY, n) for d, n in ((1, "logins_24h"), (7, "logins_7d"), (30, "logins_30d"))) + " FROM e")
def trailing_login_counts(spark, sf):
    d = ES.sweep(events(spark, sf), logins={"logins_24h": 1, "logins_7d": 7, "logins_30d": 30})
    return d.select("event_id", "actor", "logins_24h", "logins_7d", "logins_30d")


@query(
    ", n AS (SELECT *, row_number() OVER (PARTITION BY actor ORDER BY ts, ok, ln, pk, sk, price) AS rn FROM l) "
    "SELECT actor, ok, ln, pk, sk, price, " + ", ".join(_COUNTS.format(d * _DAY, n) for d, n in ((1, "n_24h"), (30, "n_30d"))) + " FROM n", _L
)
def trailing_counts_with_ties(spark, sf):
    d = LS.sweep(shipments(spark, sf), logins={"n_24h": 1, "n_30d": 30})
    return d.select("actor", "ok", "ln", "pk", "sk", "price", "n_24h", "n_30d")


@query(
    ", c AS (SELECT *, rn - min(rn) OVER (PARTITION BY actor ORDER BY us RANGE BETWEEN 2592000000000 PRECEDING AND CURRENT ROW) + 1 AS n, us // 86400000000 AS d FROM e) "
    "SELECT event_id, CAST(n AS DOUBLE) / least(30, d - min(d) OVER (PARTITION BY actor) + 1) AS login_rate_30d FROM c"
)
def login_rate_30d(spark, sf):
    d = ES.sweep(events(spark, sf), logins={"n": 30}, more={"d": ES.calendar_days()})
    return d.select("event_id", (F.col("n") / F.col("d")).alias("login_rate_30d"))


@query("SELECT event_id, CAST(count(DISTINCT CASE WHEN days BETWEEN 0 AND 29 THEN days END) AS INTEGER) AS active_days_30d FROM pairs GROUP BY event_id")
def active_days_30d(spark, sf):
    return ES.sweep(events(spark, sf), active={"active_days_30d": 30}).select("event_id", "active_days_30d")


@query("SELECT event_id, " + ", ".join(f"CAST(count(DISTINCT CASE WHEN hours <= {h} THEN {c} END) AS INTEGER) AS {c}_{n}" for c in ("cat", "net") for h, n in ((24, "24h"), (168, "7d"), (720, "30d"))) + " FROM pairs GROUP BY event_id")
def distinct_24h_7d_30d(spark, sf):
    names = {f"{c}_{n}": (c, h) for c in ("cat", "net") for h, n in ((24, "24h"), (168, "7d"), (720, "30d"))}
    return ES.sweep(events(spark, sf), distinct=names).select("event_id", *names)


@query("SELECT event_id, count(DISTINCT cat) AS cats_to_date, count(DISTINCT net) AS nets_to_date FROM pairs GROUP BY event_id")
def seen_to_date(spark, sf):
    d = events(spark, sf).withColumns({"c1": ES.is_first("cat"), "n1": ES.is_first("net")})
    return d.select("event_id", ES.to_date("cat", "c1").alias("cats_to_date"), ES.to_date("net", "n1").alias("nets_to_date"))


@query("SELECT event_id, CASE WHEN cat IS NOT NULL THEN CAST(row_number() OVER (PARTITION BY actor, cat ORDER BY rn) = 1 AS INTEGER) END AS is_new_cat FROM e")
def is_new_value(spark, sf):
    return events(spark, sf).select("event_id", ES.is_first("cat").alias("is_new_cat"))


@query(
    "SELECT event_id, CASE WHEN rn = 1 THEN 0 ELSE CAST(cat <> lag(cat) OVER w AS INTEGER) END AS changed, CASE WHEN rn = 1 THEN 0 ELSE coalesce(CAST(cat <> lag(cat) OVER w AS INTEGER), 0) END AS changed_or_zero "
    "FROM e WINDOW w AS (PARTITION BY actor ORDER BY rn)"
)
def value_changed(spark, sf):
    return events(spark, sf).select("event_id", ES.changed("cat").alias("changed"), ES.changed("cat", True).alias("changed_or_zero"))


_TOKENS = "array_sort(list_distinct(o.toks))"


@query(
    ", t AS (SELECT e.event_id, e.actor, e.rn, unnest(o.toks) AS tok FROM e JOIN o USING (event_id)), f AS (SELECT actor, tok, min(rn) AS first FROM t GROUP BY ALL) "
    "SELECT e.event_id, CASE WHEN e.cat IS NOT NULL THEN (SELECT CAST(max(CAST(f.first = t.rn AS INTEGER)) AS INTEGER) FROM t JOIN f ON f.actor = t.actor AND f.tok = t.tok WHERE t.event_id = e.event_id) END AS any_new_token FROM e"
)
def token_novelty(spark, sf):
    d = events(spark, sf).withColumn("t", S.tokens(F.col("tok")))
    return ES.sweep(d, tokens=("t", 720, "any_new_token", "n")).select("event_id", "any_new_token")


@query(
    ", s AS (SELECT e.*, CASE WHEN cat IS NOT NULL THEN array_to_string(list_sort(o.toks), '|') END AS t FROM e JOIN o USING (event_id)) "
    "SELECT event_id, CASE WHEN rn = 1 THEN 0 ELSE CAST(t <> lag(t) OVER (PARTITION BY actor ORDER BY rn) AS INTEGER) END AS set_changed FROM s"
)
def token_set_changed(spark, sf):
    d = events(spark, sf).withColumn("t", S.tokens(F.col("tok")))
    return d.select("event_id", ES.set_changed("t").alias("set_changed"))


@query(
    ", t AS (SELECT pairs.event_id, unnest(o.toks) AS tok FROM pairs JOIN o ON o.event_id = pairs.b_id WHERE hours <= 720) "
    "SELECT e.event_id, CAST(coalesce(n, 0) AS INTEGER) AS tokens_30d FROM e LEFT JOIN (SELECT event_id, count(DISTINCT tok) AS n FROM t GROUP BY 1) USING (event_id)"
)
def distinct_tokens_30d(spark, sf):
    d = events(spark, sf).withColumn("t", S.tokens(F.col("tok")))
    return ES.sweep(d, tokens=("t", 720, "new", "tokens_30d")).select("event_id", "tokens_30d")


# --- cleaning and identity


@query("SELECT event_id, actor, cat, net FROM (SELECT *, row_number() OVER (PARTITION BY actor, cat, net ORDER BY ts, event_id) AS n FROM e) WHERE n = 1")
def dedupe_first(spark, sf):
    d = dedupe_keep_first(events(spark, sf), ["actor", "cat", "net"], F.struct("ts", "event_id"))
    return d.select("event_id", "actor", "cat", "net")


_WORDS = ["TRUE ", "1", " Yes", "false", "0", "NO", "maybe", ""]
_PICK = f"([{', '.join(repr(w) for w in _WORDS)}])[CAST(event_id % 8 + 1 AS INTEGER)]"


@query(f"SELECT event_id, CASE WHEN lower(trim({_PICK})) IN ('true', '1', 'yes') THEN 1 WHEN lower(trim({_PICK})) IN ('false', '0', 'no') THEN 0 END AS signal FROM e")
def normalize_signal(spark, sf):
    word = F.element_at(F.array(*map(F.lit, _WORDS)), (F.col("event_id") % 8 + 1).cast("int"))
    return events(spark, sf).select("event_id", S.signal(word).alias("signal"))


@query("SELECT event_id, CASE WHEN cat IS NOT NULL THEN array_to_string(o.toks, '|') END AS tokens FROM e JOIN o USING (event_id)")
def pipe_dedupe(spark, sf):
    return events(spark, sf).select("event_id", S.pipe_dedupe(F.col("tok")).alias("tokens"))


_PADS = {n: p.hex() for n, p in zip(("i", "o"), I.pads(b"key of the test tables"), strict=True)}


@query(
    f"SELECT event_id, 'U' || substr(sha256(unhex('{_PADS['o']}') || unhex(sha256(unhex('{_PADS['i']}') || encode(CAST(actor AS VARCHAR))))), 1, 16) AS actor_pseudo_id FROM e"
)
def hmac_pseudonym(spark, sf):
    keys = I.key_table(spark, {"test": b"key of the test tables"})
    d = events(spark, sf).withColumn("institution", F.lit("test")).join(F.broadcast(keys), "institution")
    return d.select("event_id", I.pseudonym(F.col("actor").cast("string"), "U", 16, F.col("ipad"), F.col("opad")).alias("actor_pseudo_id"))


@query(
    "SELECT event_id, date_trunc('hour', ts) AS event_time_hour_utc, CAST(hour(ts) AS INTEGER) AS event_hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week, CAST(month(ts) AS INTEGER) AS month, "
    "CAST(isodow(ts) >= 6 AS INTEGER) AS is_weekend FROM e"
)
def calendar_parts(spark, sf):
    parts = S.calendar(F.col("ts"))
    parts["event_time_hour_utc"] = parts["event_time_hour_utc"].cast("timestamp_ntz")
    return events(spark, sf).select("event_id", *(c.alias(n) for n, c in parts.items()))


_ROOT = "sqrt(pow(sin(radians(lat - lag(lat) OVER w) / 2), 2) + cos(radians(lag(lat) OVER w)) * cos(radians(lat)) * pow(sin(radians(lon - lag(lon) OVER w) / 2), 2))"
_KM = f"2 * 6371.0088 * asin(CASE WHEN {_ROOT} > 1 THEN 1 ELSE {_ROOT} END)"  # not least(), which passes over nulls


@query(f"SELECT event_id, {_R(_KM, 2)} AS travel_distance_km FROM e WINDOW w AS (PARTITION BY actor ORDER BY rn)")
def haversine_prev(spark, sf):
    return events(spark, sf).select("event_id", F.bround(ES.distance("lat", "lon"), 2).alias("travel_distance_km"))


@query(
    f", t AS (SELECT event_id, {_KM} AS km, {_R('(us - lag(us) OVER w) / 3600000000.0', 4)} AS h FROM e WINDOW w AS (PARTITION BY actor ORDER BY rn)) "
    "SELECT event_id, CASE WHEN h > 0 THEN CAST(round_even(km / h, 2) AS DOUBLE) END AS travel_speed_kmh, CASE WHEN h > 0 THEN CAST(km / h > 900 AS INTEGER) END AS is_impossible_travel FROM t"
)
def travel_speed(spark, sf):
    d = events(spark, sf).withColumns({"km": ES.distance("lat", "lon"), "h": ES.hours_since_last()}).withColumn("v", speed(F.col("km"), F.col("h")))
    return d.select("event_id", F.bround("v", 2).alias("travel_speed_kmh"), (F.col("v") > 900).cast("int").alias("is_impossible_travel"))


@query(
    "SELECT event_id, " + ", ".join(f"CASE WHEN tok LIKE '%{c}%' THEN 1 ELSE 0 END AS uses_{c}" for c in ("click", "error", "t1")) + " FROM (SELECT event_id, coalesce(tok, '') AS tok FROM e)"
)
def substring_flags(spark, sf):
    return events(spark, sf).select("event_id", *(F.coalesce(F.col("tok"), F.lit("")).contains(c).cast("int").alias(f"uses_{c}") for c in ("click", "error", "t1")))


# --- summaries

_G = " count(*) AS events, CAST(sum(sig) AS BIGINT) AS flagged, avg(sig) * 100 AS percent"


_C = ", c AS (SELECT actor, count(*) AS x FROM e GROUP BY actor)"


@query(
    _C + " SELECT count(*) FILTER (x = 1) AS singletons, count(*) FILTER (x > 1) AS recurrent, CAST(sum(x) - count(*) AS BIGINT) AS with_history, count(*) AS without_history, "
    "quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3, max(x) AS largest FROM c"
)
def actor_activity(spark, sf):
    return D.actor_activity(events(spark, sf), "actor", "sig")


@query(_C + ", r AS (SELECT x, row_number() OVER (ORDER BY x) AS i, count(*) OVER () AS n, sum(x) OVER () AS t FROM c) SELECT round(2 * sum(i * x) / (max(n) * max(t))::DOUBLE - (max(n) + 1) / max(n)::DOUBLE, 9) AS gini FROM r")
def gini(spark, sf):
    return D.gini(D.per_actor(events(spark, sf), "actor", "sig")).select(F.round("gini", 9).alias("gini"))


@query(
    _C + ", g AS (SELECT x, count(*) AS a, count(*) * x AS s FROM c GROUP BY x), k AS (SELECT sum(a) OVER (ORDER BY x) / sum(a) OVER ()::DOUBLE AS actor_share, sum(s) OVER (ORDER BY x) / sum(s) OVER ()::DOUBLE AS event_share FROM g) "
    "SELECT round(actor_share, 9) AS actor_share, round(event_share, 9) AS event_share FROM k UNION ALL SELECT 0.0::DOUBLE, 0.0::DOUBLE"
)
def lorenz(spark, sf):
    return D.lorenz(D.per_actor(events(spark, sf), "actor", "sig")).select(*(F.round(c, 9).alias(c) for c in ("actor_share", "event_share")))


@query(
    _C + ", r AS (SELECT x, row_number() OVER (ORDER BY x DESC) AS i, count(*) OVER () AS n, sum(x) OVER () AS t FROM c) "
    "SELECT share, count(*) AS actors, CAST(sum(x) AS BIGINT) AS events, sum(x) * 100 / max(t)::DOUBLE AS percent FROM r, (VALUES (0.01::DOUBLE), (0.1::DOUBLE)) p(share) WHERE i <= greatest(1, ceil(share * n)) GROUP BY share"
)
def top_share(spark, sf):
    return D.top_share(D.per_actor(events(spark, sf), "actor", "sig"))


@query("SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS median, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem", "")
def quartiles(spark, sf):
    return D.quartiles(table(spark, sf, "lineitem"), "l_extendedprice")


@query(f"SELECT CAST(rn > 1 AS INTEGER) AS has_history, {_G} FROM e GROUP BY ALL")
def signal_by_history(spark, sf):
    d = events(spark, sf).withColumn("p", ES.prior_count())
    return D.by_group(d, [(F.col("p") > 0).cast("int").alias("has_history")], "sig")


@query("SELECT coalesce(cat, '<missing>') AS value, count(*) AS events, count(*) * 100 / sum(count(*)) OVER ()::DOUBLE AS percent FROM e GROUP BY 1")
def category_dist(spark, sf):
    return D.category(events(spark, sf), "cat")


@query(
    ", p AS (SELECT unnest(string_split(tok, '|')) AS t FROM e) SELECT trim(t) AS token, count(*) AS occurrences, count(*) * 100 / (SELECT count(*) FROM e)::DOUBLE AS percent_of_events FROM p WHERE trim(t) <> '' GROUP BY 1"
)
def token_dist(spark, sf):
    return D.token_distribution(events(spark, sf), "tok")


@query(f"SELECT strftime(ts, '%Y-%m') AS year_month, {_G}, count(DISTINCT actor) AS actors FROM e GROUP BY 1")
def monthly(spark, sf):
    return D.by_group(events(spark, sf), [F.date_format("ts", "yyyy-MM").alias("year_month")], "sig", "actor")


_MISSING = ["event_id", "cat", "net", "lat", "tok"]


@query(" UNION ALL ".join(f"SELECT {i} AS position, '{c}' AS attribute, count(*) - count({c}) AS missing, (count(*) - count({c})) * 100 / count(*)::DOUBLE AS percent FROM e" for i, c in enumerate(_MISSING)))
def missingness(spark, sf):
    return D.missingness(events(spark, sf).select(*_MISSING))


@query(f"SELECT CAST(hour(ts) AS INTEGER) AS hour, {_G} FROM e GROUP BY 1")
def hour_rate(spark, sf):
    return D.by_group(events(spark, sf), [F.hour("ts").alias("hour")], "sig")


@query("SELECT CAST(isodow(ts) - 1 AS INTEGER) AS day, " + ", ".join(f"avg(sig) FILTER (hour(ts) = {h}) AS h{h:02d}" for h in range(24)) + " FROM e GROUP BY 1")
def dow_hour_pivot(spark, sf):
    return D.heatmap(events(spark, sf), F.weekday("ts"), F.hour("ts"), "sig")


@query(f", g AS (SELECT country, {_G} FROM l GROUP BY 1) SELECT country, events, flagged, percent, flagged = events AS always FROM g WHERE events >= 30", _L)
def having_rate(spark, sf):
    return D.having_rate(shipments(spark, sf), "country", "sig")


@query("SELECT count(DISTINCT cat) AS known_country_values, count(*) - count(cat) AS missing_country_events FROM e")
def country_summary(spark, sf):
    return D.country_summary(events(spark, sf), "cat")


@query("SELECT country, count(*) AS events FROM l GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10", _L)
def top_values(spark, sf):
    return D.top_k(shipments(spark, sf), "country", 10)


@query(", g AS (SELECT actor, cat, count(*) AS c FROM e WHERE cat IS NOT NULL GROUP BY ALL) SELECT actor, round(log2(sum(c)) - sum(c * log2(c)) / sum(c), 9) AS entropy FROM g GROUP BY actor")
def entropy_by_actor(spark, sf):
    return D.entropy(events(spark, sf), "actor", "cat").select("actor", (F.round("entropy", 9) + 0.0).alias("entropy"))


@query(
    "SELECT sig, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, min(value) AS low, round(quantile_cont(value, 0.25), 6) AS q1, round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.75), 6) AS q3, "
    "max(value) AS high FROM e GROUP BY sig"
)
def group_describe(spark, sf):
    return D.describe(events(spark, sf), "sig", "value").withColumns({c: F.round(c, 6) for c in ("mean", "std", "q1", "median", "q3")})


@query("SELECT actor, CAST(max(sig) AS INTEGER) AS ever_flagged, count(*) AS event_count FROM e GROUP BY actor")
def ever_flagged(spark, sf):
    return events(spark, sf).groupBy("actor").agg(F.max("sig").alias("ever_flagged"), F.count("*").alias("event_count"))


@query("SELECT event_type, count(*) FILTER (sig = 0) AS n0, count(*) FILTER (sig = 1) AS n1 FROM e GROUP BY 1")
def crosstab(spark, sf):
    return events(spark, sf).groupBy("event_type").agg(F.count_if(F.col("sig") == 0).alias("n0"), F.count_if(F.col("sig") == 1).alias("n1"))


# --- statistics

_FLAG = "CAST(hour(ts) >= 18 AS INTEGER)"
_OR = "a::DOUBLE * d / (b * c)"
_SE = "sqrt(1 / greatest(a, 1)::DOUBLE + 1 / greatest(b, 1)::DOUBLE + 1 / greatest(c, 1)::DOUBLE + 1 / greatest(d, 1)::DOUBLE)"


@query(
    f", t AS (SELECT count(*) FILTER (f = 1 AND sig = 1) AS a, count(*) FILTER (f = 1 AND sig = 0) AS b, count(*) FILTER (f = 0 AND sig = 1) AS c, count(*) FILTER (f = 0 AND sig = 0) AS d FROM (SELECT {_FLAG} AS f, sig FROM e)) "
    f"SELECT a, b, c, d, round({_OR}, 9) AS odds_ratio, round(exp(ln({_OR}) - 1.96 * {_SE}), 9) AS low, round(exp(ln({_OR}) + 1.96 * {_SE}), 9) AS high FROM t"
)
def odds_ratio(spark, sf):
    d = events(spark, sf).withColumn("late", (F.hour("ts") >= 18).cast("int"))
    return T.odds_ratio(d, "late", "sig").withColumns({c: F.round(c, 9) for c in ("odds_ratio", "low", "high")})


@query(
    ", x AS (SELECT country AS r, sig AS c, count(*) AS o FROM l GROUP BY ALL), m AS (SELECT a.r, b.c, coalesce(o, 0) AS o FROM (SELECT DISTINCT r FROM x) a CROSS JOIN (SELECT DISTINCT c FROM x) b LEFT JOIN x ON x.r = a.r AND x.c = b.c), "
    "e AS (SELECT r, c, o, sum(o) OVER (PARTITION BY r) * sum(o) OVER (PARTITION BY c) / sum(o) OVER ()::DOUBLE AS e, sum(o) OVER () AS n FROM m) "
    "SELECT round(sum((o - e) * (o - e) / e), 6) AS chi2, CAST((count(DISTINCT r) - 1) * (count(DISTINCT c) - 1) AS BIGINT) AS dof, CAST(max(n) AS BIGINT) AS n, "
    "round(sqrt(sum((o - e) * (o - e) / e) / (max(n) * (least(count(DISTINCT r), count(DISTINCT c)) - 1))), 9) AS cramers_v FROM e", _L
)
def chi2_cramers_v(spark, sf):
    t = T.chi_square(shipments(spark, sf), "country", "sig")
    return t.select(F.round("chi2", 6).alias("chi2"), F.col("dof").cast("long").alias("dof"), "n", F.round("cramers_v", 9).alias("cramers_v"))


@query(
    ", v AS (SELECT round(value, 0) AS v, sig FROM e WHERE value IS NOT NULL), r AS (SELECT *, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0 AS rank, count(*) OVER (PARTITION BY v) AS t FROM v) "
    "SELECT count(*) FILTER (sig = 1) AS n1, count(*) FILTER (sig = 0) AS n0, CAST(sum(rank) FILTER (sig = 1) - count(*) FILTER (sig = 1) * (count(*) FILTER (sig = 1) + 1) / 2.0 AS DOUBLE) AS u, "
    "CAST(sum(t * t - 1) AS DOUBLE) AS tie_term FROM r"
)
def mann_whitney_u(spark, sf):
    return T.mann_whitney(events(spark, sf).withColumn("v", F.round("value", 0)), "v", "sig")


@query(
    ", p AS (SELECT strftime(ts, '%Y-%m-%d') AS o, round(avg(sig), 3) AS v FROM e GROUP BY 1), s AS (SELECT CAST(sum(sign(b.v - a.v)) AS BIGINT) AS s FROM p a JOIN p b ON a.o < b.o), "
    "t AS (SELECT v, count(*) AS t FROM p GROUP BY v) SELECT CAST(sum(t) AS BIGINT) AS n, max(s) AS s, (sum(t) * (sum(t) - 1) * (2 * sum(t) + 5) - sum(t * (t - 1) * (2 * t + 5))) / 18.0::DOUBLE AS var_s FROM t, s"
)
def mann_kendall(spark, sf):
    p = events(spark, sf).groupBy(F.date_format("ts", "yyyy-MM-dd").alias("o")).agg(F.round(F.avg("sig"), 3).alias("v"))
    return T.mann_kendall(p, "o", "v")


# --- sampling, splits and metrics


@query(
    ", n AS (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS i, count(*) OVER () AS n FROM e) "
    "SELECT event_id, CASE WHEN i < floor(n * 0.7::DOUBLE) THEN 'train' WHEN i < floor(n * 0.85::DOUBLE) THEN 'validation' ELSE 'test' END AS split FROM n"
)
def temporal_split(spark, sf):
    return P.temporal_split(events(spark, sf), F.unix_micros("ts"), [F.col("event_id")]).select("event_id", "split")


@query("SELECT event_id, actor FROM (SELECT *, row_number() OVER (PARTITION BY actor ORDER BY md5(CAST(event_id AS VARCHAR) || '|42'), event_id) AS n FROM e) WHERE n <= 40")
def cap_actors(spark, sf):
    return P.cap_actors(events(spark, sf), "actor", "event_id", 40).select("event_id", "actor")


@query(_C + " SELECT count(*) FILTER (x > 40) AS actors_above, max(x) / sum(x)::DOUBLE AS share_before, least(max(x), 40) / sum(least(x, 40))::DOUBLE AS share_after FROM c")
def above_cap(spark, sf):
    return P.above_cap(events(spark, sf), "actor", 40)


@query(
    ", k AS (SELECT country FROM l GROUP BY 1 ORDER BY count(*) DESC, country LIMIT 5) SELECT CASE WHEN country IN (SELECT country FROM k) THEN country ELSE '_other_' END AS country, count(*) AS events FROM l GROUP BY 1", _L
)
def topk_encode(spark, sf):
    d = shipments(spark, sf)
    return d.groupBy(M.cap_category("country", M.top_values(d, "country", 5)).alias("country")).agg(F.count("*").alias("events"))


_SCORED = ", s AS (SELECT event_id, least(floor((hour(ts) * 4 + value) / 2) / 100, 1) AS score, sig AS label, rn FROM e), g AS (SELECT score AS s, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS n FROM s GROUP BY 1), "
_CUM = _SCORED + "c AS (SELECT s, p, n, sum(p) OVER (ORDER BY s DESC) AS tp, sum(n) OVER (ORDER BY s DESC) AS fp, sum(p) OVER () AS positives, sum(n) OVER () AS negatives FROM g) "


def _scores(spark, sf):
    score = F.least(F.floor((F.hour("ts") * 4 + F.col("value")) / 2) / 100, F.lit(1.0))  # exact in binary but for one division
    return events(spark, sf).select("event_id", "actor", score.alias("score"), F.col("sig").alias("label"), ES.prior_count().alias("prior"))


@query(_CUM + "SELECT round(sum(n * (tp - p / 2.0)) / max(positives * negatives)::DOUBLE, 9) AS roc_auc FROM c")
def roc_auc(spark, sf):
    return M.roc_auc(M.cumulated(_scores(spark, sf))).select(F.round("roc_auc", 9).alias("roc_auc"))


@query(_CUM + "SELECT round(sum(p / positives::DOUBLE * (tp / (tp + fp)::DOUBLE)), 9) AS average_precision FROM c")
def average_precision(spark, sf):
    return M.average_precision(M.cumulated(_scores(spark, sf))).select(F.round("average_precision", 9).alias("average_precision"))


@query(_CUM + "SELECT s AS threshold, round(2 * tp / (tp + fp + positives)::DOUBLE, 9) AS f1 FROM c ORDER BY 2 * tp / (tp + fp + positives)::DOUBLE DESC, s LIMIT 1")
def threshold_f1(spark, sf):
    return M.best_threshold(M.cumulated(_scores(spark, sf))).withColumn("f1", F.round("f1", 9))


@query(
    _CUM + ", t AS (SELECT i / 1000.0::DOUBLE AS threshold, CAST(coalesce((SELECT sum(n) FROM c WHERE s >= i / 1000.0::DOUBLE), 0) AS BIGINT) AS fp FROM range(50, 1000) r(i)) SELECT threshold, fp FROM t ORDER BY abs(fp - 100), threshold LIMIT 1"
)
def matched_threshold(spark, sf):
    return M.matched_threshold(M.cumulated(_scores(spark, sf)), 100)


@query(
    _SCORED + "m AS (SELECT count(*) FILTER (score >= 0.4 AND label = 1) AS tp, count(*) FILTER (score >= 0.4 AND label = 0) AS fp, count(*) FILTER (score < 0.4 AND label = 1) AS fn, count(*) FILTER (score < 0.4 AND label = 0) AS tn, "
    "round(avg((score - label) * (score - label)), 9) AS brier, count(*) AS n FROM s) SELECT tp, fp, fn, tn, brier, CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::DOUBLE ELSE 0 END AS precision, "
    "CASE WHEN tp + fn > 0 THEN tp / (tp + fn)::DOUBLE ELSE 0 END AS recall, CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn)::DOUBLE ELSE 0 END AS f1, 1000 * fp / n::DOUBLE AS fp_per_1000 FROM m"
)
def confusion_metrics(spark, sf):
    return M.metrics(_scores(spark, sf), 0.4).withColumn("brier", F.round("brier", 9))


@query(_CUM + "SELECT s AS threshold, round(fp / negatives::DOUBLE, 9) AS fpr, round(tp / positives::DOUBLE, 9) AS tpr FROM c")
def roc_curve(spark, sf):
    return M.roc_curve(M.cumulated(_scores(spark, sf))).withColumns({c: F.round(c, 9) for c in ("fpr", "tpr")})


@query(_CUM + "SELECT s AS threshold, round(tp / (tp + fp)::DOUBLE, 9) AS precision, round(tp / positives::DOUBLE, 9) AS recall FROM c")
def pr_curve(spark, sf):
    return M.pr_curve(M.cumulated(_scores(spark, sf))).withColumns({c: F.round(c, 9) for c in ("precision", "recall")})


@query(
    _SCORED + "q AS (SELECT list_distinct(quantile_cont(score, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS e FROM s) "
    "SELECT CAST(len(list_filter(e, lambda x: x <= score)) AS INTEGER) AS bin, round(avg(score), 9) AS mean_score, round(avg(label), 9) AS rate, count(*) AS rows FROM s, q GROUP BY 1"
)
def calibration(spark, sf):
    return M.calibration(_scores(spark, sf)).withColumns({c: F.round(c, 9) for c in ("mean_score", "rate")})


@query(
    _SCORED + "f AS (SELECT *, CASE WHEN rn = 1 THEN '0' WHEN rn <= 10 THEN '1-9' ELSE '>=10' END AS profile FROM s), h AS (SELECT profile, score AS s, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS n FROM f GROUP BY ALL), "
    "k AS (SELECT *, sum(p) OVER (PARTITION BY profile ORDER BY s DESC) AS tp FROM h) SELECT profile, CAST(sum(p + n) AS BIGINT) AS rows, CAST(sum(p) AS BIGINT) AS positives, "
    "CASE WHEN sum(p) > 0 AND sum(n) > 0 THEN round(sum(n * (tp - p / 2.0)) / (sum(p) * sum(n))::DOUBLE, 9) END AS roc_auc FROM k GROUP BY profile HAVING sum(p + n) >= 10"
)
def profile_breakdown(spark, sf):
    d = _scores(spark, sf).withColumn("profile", S.profile(F.col("prior")))
    return M.by_profile(d, "profile").withColumn("roc_auc", F.round("roc_auc", 9))


@query(_SCORED[:-2] + ", w AS (SELECT count(*) FILTER (label = 0) / greatest(count(*) FILTER (label = 1), 1)::DOUBLE AS weight FROM s) SELECT weight FROM w")
def class_weight(spark, sf):
    return M.class_weight(_scores(spark, sf), "label")


# --- whole releases and models, which SQL does not express in reasonable length


def as_logins(spark, sf):
    """``events`` in the column names of the cleaned login table."""
    d = events(spark, sf)
    return d.select(
        F.format_string("E%012d", "event_id").alias("event_id"), F.format_string("U%08d", "actor").alias("actor_pseudo_id"), F.col("ts").alias("event_time"),
        F.concat_ws("-", F.format_string("A%08d", "actor"), "net").alias("actor_network_id"), F.concat(F.lit("N"), "net").alias("network_pseudo_id"), F.lit(4).alias("ip_version"),
        F.when(F.col("cat").isNotNull(), F.element_at(F.array(*map(F.lit, ("Angola", "Brazil", "France", "Japan"))), (F.col("event_id") % 4 + 1).cast("int"))).alias("ip_country"),
        F.col("event_type").alias("login_type"), F.col("tok").alias("login_challenge_method"), F.col("sig").alias("provider_suspicious"), F.lit("I0").alias("institution_pseudo_id"),
        F.lit(None).cast("string").alias("ip_city"), F.col("lat").alias("latitude"), F.col("lon").alias("longitude"),
    )


def _release(spark, sf):
    return add_features(S.with_continent(as_logins(spark, sf)))


@query()
def model_benchmark(spark, sf):
    """All classifiers on the release's features: a row a model."""
    columns = ["prior_event_count", "logins_24h", "logins_7d", "logins_30d", "login_rate_30d", "event_hour", "day_of_week", "distinct_networks_7d", "is_new_ip"]
    features = _release(spark, sf).select("event_id", "event_time", "provider_suspicious", *columns)
    d = P.temporal_split(staged(features, "features"), F.unix_micros("event_time"), [F.col("event_id")])
    found = M.benchmark(*(d.where(F.col("split") == s) for s in ("train", "validation", "test")), columns, "provider_suspicious")
    return spark.createDataFrame([(k, float(v["roc_auc"] or 0), float(v["average_precision"] or 0), float(v["f1"])) for k, v in found.items()], "model string, roc_auc double, average_precision double, f1 double")


@query()
def isolation_forest(spark, sf):
    d = events(spark, sf).select("event_id", F.hour("ts").cast("double").alias("hour"), "value")
    return M.isolation_scores(d, d, ["hour", "value"], "event_id").select("event_id", "score")


from . import more_queries  # noqa: E402, F401  (registers its queries)
