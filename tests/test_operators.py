"""Operators against brute force on small random tables with ties and nulls, and forms that SQL doesn't have."""

import hashlib
import json
import math
import random

import numpy as np
from pyspark.sql import functions as F

from logvista.functions import scalar as S
from logvista.operators import describe as D
from logvista.operators import ml as M
from logvista.operators import sampling as P
from logvista.operators import stats as T
from logvista.operators import validate as V
from logvista.operators.windows import Sequence
from logvista.plans.schema import RAW
from logvista.sources import api_json as A
from logvista.streaming import landing


def test_metrics_on_ties(spark):
    r = random.Random(1)
    data = [(r.randint(0, 12) / 12, int(r.random() < 0.3)) for _ in range(400)]
    c = M.cumulated(spark.createDataFrame(data, "score double, label int"))
    pos, neg = [s for s, y in data if y], [s for s, y in data if not y]
    auc = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / len(pos) / len(neg)
    assert abs(M.roc_auc(c).first()[0] - auc) < 1e-12
    f1 = {t: 2 * sum(p >= t for p in pos) / (sum(s >= t for s, _ in data) + len(pos)) for t, _ in data}
    best = max(f1.values())
    got = M.best_threshold(c).first()
    assert abs(got["f1"] - best) < 1e-12 and got["threshold"] == min(t for t in f1 if f1[t] == best)
    one = M.cumulated(spark.createDataFrame([(0.5, 1)], "score double, label int"))
    assert M.roc_auc(one).first()[0] is None
    u = T.mann_whitney(spark.createDataFrame(data, "v double, g int"), "v", "g").first()
    assert abs(u["u"] / u["n1"] / u["n0"] - auc) < 1e-12 and 0 < T.mann_whitney_p(*u) <= 1


def test_p_values():
    assert abs(T.chi_square_p(3.841458820694124, 1) - 0.05) < 1e-9 and abs(T.chi_square_p(18.307038053275146, 10) - 0.05) < 1e-9 and T.chi_square_p(0, 3) == 1
    z, p, trend = T.mann_kendall_p(45, 125.0)
    assert trend == "increasing" and p < 0.001 and z > 0
    assert T.mann_kendall_p(0, 125.0)[2] == "no trend"
    assert abs(T.mann_whitney_p(3, 4, 12, 0) - 2 / 35) < 1e-12 and T.mann_whitney_p(3, 4, 6, 0) == 1 and abs(T.mann_whitney_p(2, 5, 0, 0) - 2 / 21) < 1e-12
    assert 0 < T.mann_whitney_p(3, 4, 12, 6) < 1 and 0 < T.mann_whitney_p(20, 30, 400, 0) < 0.1


def test_odds_ratios(spark):
    d = spark.createDataFrame([(1, 0, 1)] * 8 + [(1, 1, 0)] * 2 + [(0, 0, 1)] * 3 + [(0, 1, 0)] * 7 + [(None, None, 1)], "f int, g int, y int")
    r = T.odds_ratio(d, "f", "y").first()
    assert abs(r["odds_ratio"] - 8 * 7 / 6) < 1e-12 and r["low"] < r["odds_ratio"] < r["high"]
    g = {x["flag"]: x for x in T.odds_table(d, ["f", "g"], "y").collect()}
    assert g["f"]["odds_ratio"] == 9.333 and g["g"]["odds_ratio"] == 0.0 and g["g"]["low"] is None
    inf = T.odds_ratio(d.where("y = 1 and f = 1 or y = 0 and f = 0"), "f", "y").first()
    assert math.isinf(inf["odds_ratio"]) and inf["high"] is None
    s = T.logistic_summary(d.where("f is not null"), ["f"], "y")
    assert s[0]["name"] == "const" and abs(s[1]["odds_ratio"] - 8 * 7 / 6) < 1e-4


def test_known_history_after_a_moment(spark, tmp_path):
    from logvista.plans import queries as Q

    rows = [(0, 0), (1, 0), (2, 1), (3, 58_871), (4, 258_871), (5, 4_000_000_000)]  # microseconds: none, the same instant, then later ones
    d = spark.createDataFrame(rows, "event_id long, us long").select("event_id", F.timestamp_micros("us").cast("timestamp_ntz").alias("ts"), F.lit(1).cast("long").alias("user_id"), F.lit("view").alias("event_type"), F.lit(1.0).alias("value"), F.lit('{"k": 1}').alias("props"))
    d.write.parquet(f"{tmp_path}/events.parquet")
    got = {r["event_id"]: r["known_history"] for r in Q.queries()["scalar_cleaning"](spark, str(tmp_path)).collect()}
    assert got == {0: 0, 1: 0, 2: 1, 3: 1, 4: 1, 5: 1}


def test_recompute_by_brute_force(spark):
    r = random.Random(11)
    hour = 3_600_000_000
    rows = []
    for i in range(300):
        us = None if r.random() < 0.05 else r.choice([r.randrange(1600) * hour, r.randrange(1600 * hour)])
        rows.append((f"e{r.randrange(10**6):06d}{i}", r.choice("abcde") if i % 50 else None, us, r.choice([None, "n1", "n2", "n3"]), r.choice([None, "A", "B", "C", "D"])))
    d = spark.createDataFrame(rows, "event_id string, actor_pseudo_id string, us long, actor_network_id string, ip_country string").withColumn("event_time", F.timestamp_micros("us"))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)  # an actor's events come in many batches
    try:
        again = V.recompute(d)
        assert "Join" not in again._jdf.queryExecution().optimizedPlan().toString()
        got = {x["event_id"]: x.asDict() for x in again.collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert len(got) == sum(x[1] is not None for x in rows)
    key = lambda x: (x[2] is not None, x[2] or 0, x[0])
    for e in rows:
        if e[1] is None:
            continue
        past = [x for x in rows if x[1] == e[1] and key(x) <= key(e)]
        known = [x for x in past if x[2] is not None and e[2] is not None]
        want = {
            "event_id": e[0], "actor_pseudo_id": e[1], "prior_event_count": len(past) - 1,
            "hours_since_last_login": round((e[2] - max(x[2] for x in known if x is not e)) / hour, 4) if known[1:] else None,
            "hours_since_first_observed_login": round((e[2] - min(x[2] for x in known)) / hour, 4) if known else None,
            "networks_seen_to_date": len({x[3] for x in past} - {None}), "distinct_countries_to_date": len({x[4] for x in past} - {None}),
            "is_new_ip": None if e[3] is None else int(all(x[3] != e[3] for x in past if x is not e)),
        }
        for name, n in (("24h", 24), ("7d", 168), ("30d", 720)):
            want[f"logins_{name}"] = sum(e[2] - x[2] <= n * hour for x in known)
            want[f"distinct_countries_{name}"] = len({x[4] for x in known if e[2] // hour - x[2] // hour <= n} - {None})
        assert {k: v for k, v in got[e[0]].items() if k[:5] != "hours"} == {k: v for k, v in want.items() if k[:5] != "hours"}
        for k in ("hours_since_last_login", "hours_since_first_observed_login"):
            assert (got[e[0]][k] is None) == (want[k] is None) and (want[k] is None or abs(got[e[0]][k] - want[k]) < 1.1e-4)


def test_recompute_of_one_busy_actor(spark):
    step, n = 600_000_000, 30_000  # every ten minutes; a join of all earlier events would have 450 million rows
    i = F.col("id")
    d = spark.range(n).select(F.format_string("e%06d", i).alias("event_id"), F.lit("a").alias("actor_pseudo_id"), F.timestamp_micros(i * step).alias("event_time"), (i % 9).cast("string").alias("actor_network_id"), F.when(i < 10, "A").otherwise("B").alias("ip_country"))
    got = V.recompute(d).orderBy("event_id").toPandas()
    for name, days in (("24h", 1), ("7d", 7), ("30d", 30)):
        assert (got[f"logins_{name}"] == np.minimum(np.arange(n) + 1, days * 144 + 1)).all()
        at = np.arange(n) // 6
        assert (got[f"distinct_countries_{name}"] == 1 + ((np.arange(n) >= 10) & (at - 1 <= days * 24))).all()
    assert got["is_new_ip"].sum() == 9 and (got["prior_event_count"] == np.arange(n)).all()


def test_gini_of_nothing_and_some(spark):
    c = spark.createDataFrame([(i, x) for i, x in enumerate([1, 1, 2, 5, 5, 9])], "actor int, event_count long")
    x = sorted([1, 1, 2, 5, 5, 9])
    want = 2 * sum((i + 1) * v for i, v in enumerate(x)) / (6 * sum(x)) - 7 / 6
    assert abs(D.gini(c).first()[0] - want) < 1e-12 and D.gini(c.limit(0)).first()[0] is None
    top = {r["share"]: r["events"] for r in D.top_share(c, (0.01, 0.5)).collect()}
    assert top == {0.01: 9, 0.5: 19}


def test_summaries_with_missing(spark):
    d = spark.createDataFrame([("A", 1, "x|y", "a1"), (None, 0, None, "a1"), ("A", 0, " y| |y", "a2"), ("B", 0, "x", "a2")], "c string, s int, t string, a string").withColumn("time", F.current_timestamp())
    assert {r["value"]: r["events"] for r in D.category(d, "c").collect()} == {"A": 2, "<missing>": 1, "B": 1}
    assert {r["token"]: r["occurrences"] for r in D.token_distribution(d, "t").collect()} == {"x": 2, "y": 3}
    assert {r["c"] for r in D.group_rare(d, "c", 2).collect()} == {"A", None, "Other"}
    doc = D.statistics(d, "a", "time", "s", "c", "n", "1", "h")
    assert doc["known_country_values"] == 2 and doc["events"] == 4 and doc["public_sha256"] == "h" and len(doc) == 24
    x, bias = M.drop_gaps(d, ["c", "t"], "s")
    assert x.count() == 3 and bias["dropped"] == 1
    hot = M.one_hot(d, "c", M.top_values(d, "c", 1))
    assert [(r["c=A"], r["c=_other_"]) for r in hot.orderBy("t").collect()].count((0, 1)) == 2


def test_numbering_and_caps(spark, monkeypatch):
    d = spark.range(1000).select((F.col("id") % 37).alias("k"), "id")
    monkeypatch.setattr(P, "IN_ORDER", 20)
    n = P.numbered(d, F.col("k"), [F.col("id")]).orderBy("position").collect()
    assert [r["position"] for r in n] == list(range(1000)) and [(r["k"], r["id"]) for r in n] == sorted((i % 37, i) for i in range(1000))
    assert P.numbered(d.limit(0), F.col("k"), [F.col("id")]).count() == 0
    c = P.cap_actors(d, "k", "id", 10)
    assert c.count() == 370 and {r["id"] for r in c.collect()} == {r["id"] for r in P.cap_actors(d.repartition(3), "k", "id", 10).collect()}
    parts = {r["split"]: r["count"] for r in P.temporal_split(d, F.col("k"), [F.col("id")]).groupBy("split").count().collect()}
    assert parts == {"train": 700, "validation": 150, "test": 150}
    ranked = sorted((i % 37, i) for i in range(1000))
    split = {r["id"]: r["split"] for r in P.temporal_split(d, F.col("k"), [F.col("id")]).collect()}
    assert all(split[i] == ("train" if n < 700 else "validation" if n < 850 else "test") for n, (_, i) in enumerate(ranked))
    one = d.withColumn("k", F.lit(5))  # all at one time
    split = {r["id"]: r["split"] for r in P.temporal_split(one, F.col("k"), [F.col("id")]).collect()}
    assert all(split[i] == ("train" if i < 700 else "validation" if i < 850 else "test") for i in range(1000))
    assert P.temporal_split(d.limit(0), F.col("k"), [F.col("id")]).count() == 0


def test_models(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=(600, 2))
    d = spark.createDataFrame([(float(a), float(b), int(a + b > 0.8)) for a, b in x], "a double, b double, y int").withColumn("id", F.monotonically_increasing_id())
    train, rest = d.where("id % 3 > 0"), d.where("id % 3 = 0")
    from pyspark.ml.classification import DecisionTreeClassifier

    tree = DecisionTreeClassifier(maxDepth=3, seed=1, weightCol="weight")
    out = M.ablation(train, rest, rest, {"one": ["a"], "two": ["a", "b"]}, "y", tree)
    assert out["two"]["roc_auc"] > out["one"]["roc_auc"] > 0.5 and out["two"]["columns"] == 2
    best, area = M.search(train, rest, ["a", "b"], "y", tree, [{"maxDepth": 1}, {"maxDepth": 4}])
    assert best == {"maxDepth": 4} and area > 0.8
    forest = M.IsolationForest.fit(np.concatenate([x, [[9.0, 9.0]]]), trees=50)
    assert forest.score(np.array([[9.0, 9.0], [0.0, 0.0]]))[0] > 0.6 > forest.score(np.array([[0.0, 0.0]]))[0]
    e = M.early_stopping(train, rest, ["a", "b"], "y", rounds=6, patience=2, step=3)
    assert 1 <= e["best_round"] <= 6 and e["roc_auc"] > 0.9 and e["model"].getNumTrees == e["best_round"]
    top = M.importances(tree.fit(M.assemble(train, ["a", "b"], "y")), ["a", "b"])
    assert [n for n, _ in top] and abs(sum(v for _, v in top) - 1) < 1e-9
    scored = M.isolation_scores(d, d, ["a", "b"], "id", trees=20, size=16).collect()
    assert len(scored) == 600 and {(r["id"], r["score"]) for r in scored} == {(r["id"], r["score"]) for r in M.isolation_scores(d.repartition(5), d, ["a", "b"], "id", trees=20, size=16).collect()}
    assert M.gains({"m": {"roc_auc": 0.5}}, {"m": {"roc_auc": 0.75}}) == [("m", 0.5, 0.75, 0.25)]
    s = M.scale_by(spark.createDataFrame([(0.0,), (5.0,), (99.0,)], "v double"), spark.createDataFrame([(0.0,), (10.0,)], "v double"), "v")
    assert [round(r[0], 6) for r in s.orderBy("v").collect()] == [0, 0.5, 1]


ITEM = {
    "id": {"time": "2026-05-01T10:00:00Z", "uniqueQualifier": "q1"}, "actor": {"email": "A@b.c"}, "ipAddress": "10.0.0.1", "geoLocation": {"country": "Angola", "region": "", "continent": "Africa"},
    "events": [{"name": None}, {"name": "login_success", "parameters": [
        {"name": "login_type", "value": "reauth"}, {"name": "login_type", "value": "exchange"}, {"name": "is_suspicious", "boolValue": True}, {"name": "login_challenge_method", "multiValue": ["password", "none"]},
    ]}],
}


def test_one_very_large_actor(spark):
    """A hundred thousand events of one actor, with ties, against plain loops; a frame for each row would take ten billion steps."""
    n = 100_000
    r = np.random.default_rng(5)
    us = np.sort(r.integers(0, 40 * 86_400, n)) * 1_000_000
    value = r.integers(0, 400, n)
    ids = spark.createDataFrame(list(zip(range(n), us.tolist(), (int(v) if v else None for v in value))), "event_id long, us long, v long")
    d = ids.select("event_id", F.timestamp_micros("us").alias("event_time"), F.lit("a").alias("actor_pseudo_id"), "v")
    got = Sequence().sweep(d, logins={"n": 1, "m": 30}, distinct={"k": ("v", 24)}, active={"days": 30}).orderBy("event_id").toPandas()
    day = 86_400_000_000
    assert (got["seq_no_"].to_numpy() == np.arange(1, n + 1)).all()
    for name, days in (("n", 1), ("m", 30)):
        assert (got[name].to_numpy() == np.arange(1, n + 1) - np.searchsorted(us, us - days * day, "left")).all()
    hour, last, first, counts, kinds = us // 3_600_000_000, 0, 0, {}, []
    for i in range(n):
        while hour[first] < hour[i] - 24:
            if value[first]:
                counts[value[first]] -= 1
                if not counts[value[first]]:
                    del counts[value[first]]
            first += 1
        if value[i]:
            counts[value[i]] = counts.get(value[i], 0) + 1
        kinds.append(len(counts))
    assert got["k"].tolist() == kinds
    date = us // day
    assert (got["days"].to_numpy() == [len(set(date[max(0, np.searchsorted(date, d - 29)) : i + 1].tolist())) if i % 997 == 0 else got["days"][i] for i, d in enumerate(date)]).all()


def test_api_items_batch_and_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.json").write_text("\n".join(json.dumps(x) for x in (ITEM, ITEM | {"id": {"uniqueQualifier": "q2"}, "ipAddress": " ::1 ", "events": None, "geoLocation": None})))
    geo = spark.createDataFrame([("::1", "France", "IDF", "Paris", "Europe", 48.8, 2.3), ("10.0.0.1", "X", "Luanda Province", "Luanda", "Y", 1.0, 2.0)], A.GEO)
    items = A.read_items(spark, str(src))
    a, b = A.flatten(items, geo).orderBy("record_id").collect()
    assert (a["ip_country"], a["ip_region"], a["continent"], a["ip_version"], a["login_type"], a["is_suspicious"], a["login_challenge_method"], a["event_name"], a["login_status"]) == (
        "Angola", "Luanda Province", "Africa", "4", "exchange", "true", "password|none", "login_success", "success")
    assert (b["ip_country"], b["ip_version"], b["ip_city"], b["event_name"], b["login_status"]) == ("France", "6", "Paris", None, None)
    assert a["actor_email_hash"] == hashlib.sha256(b"A@b.c").hexdigest()[:16] and b["ip_hash"] == hashlib.sha256(b" ::1 ").hexdigest()[:16]
    assert A.distinct_addresses(items).count() == 2
    (src / "b.json").write_text(json.dumps(ITEM))
    q = landing.land(spark, str(src), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_pages_are_followed_and_numbered(spark, tmp_path):
    more = [{"name": "ip_address", "value": "1.1.1.1"}, {"name": "is_suspicious", "boolValue": False}, {"name": "is_suspicious", "value": None, "boolValue": True}, {"name": "login_type", "intValue": "7"},
            {"name": "login_challenge_method", "multiStrValue": ["a", "b"]}, {"name": "other", "value": "z"}]
    items = [ITEM, {"events": [{"name": "logout", "parameters": more}, {"name": "login_failure"}]}, {"events": []}, {}, ITEM]
    pages = {None: {"items": items[:2], "nextPageToken": "t1"}, "t1": {"nextPageToken": "t2"}, "t2": {"items": items[2:]}}
    folder = str(tmp_path / "pages")
    assert A.land_pages(pages.__getitem__, folder) == 3
    rows = A.extract(A.read_pages(spark, folder)).orderBy(F.col("record_id").cast("int")).collect()
    assert [r["record_id"] for r in rows] == ["1", "2", "3", "4", "5"] and rows[0]["login_type"] == rows[4]["login_type"] == "exchange"
    r = rows[1]
    assert (r["event_name"], r["login_status"], r["is_suspicious"], r["login_type"], r["login_challenge_method"]) == ("logout", "other", None, "7", "a|b")
    assert r["ip_hash"] == hashlib.sha256(b"1.1.1.1").hexdigest()[:16] and r["actor_email_hash"] is None
    assert all(v is None for k, v in rows[2].asDict().items() if k != "record_id") and rows[3]["login_status"] is None
    A.write_raw(A.extract(A.read_pages(spark, folder)), str(tmp_path / "raw"))
    assert spark.read.option("header", True).csv(str(tmp_path / "raw")).columns == RAW
    (tmp_path / "pages" / "page-00000002.json").unlink()
    try:
        A.read_pages(spark, folder)
        raise AssertionError
    except ValueError:
        pass


def test_geo_answers(spark):
    rows = [("", None, None, None, None, None, None), ("x", 200, None, "success", "A/B", 1.0, 1.0), ("1.2.3.4", 500, None, None, None, None, None), ("1.2.3.4", 200, None, "fail", None, None, None),
            ("::1", 200, None, "success", "Africa/Luanda", 99.0, 1.0), ("1.2.3.4", None, "Timeout", None, None, None, None), ("1.2.3.4", 200, None, "success", "UTC", 1.0, 1.0)]
    got = A.geo_status(spark.createDataFrame(rows, "ip string, http int, error string, status string, timezone string, latitude double, longitude double")).collect()
    assert [r["lookup"] for r in got] == ["empty_ip", "invalid_ip", "http_500", "provider_fail", "ok", "request_error:Timeout", "ok"]
    assert got[4]["continent"] == "Africa" and got[4]["latitude"] is None and got[4]["longitude"] == 1.0 and got[6]["continent"] is None


def test_challenges_and_addresses(spark):
    d = spark.createDataFrame([("knowledge_historical_password|passkey|passkey",), (None,)], "t string")
    a, b = d.select(*(c.alias(n) for n, c in S.challenge_flags(F.col("t")).items())).collect()
    assert (a["uses_password"], a["uses_passkey"], a["num_challenge_methods"], b["uses_password"], b["num_challenge_methods"]) == (1, 1, 2, 0, 0)
    ips = spark.createDataFrame([("1.2.3.4",), ("256.1.1.1",), ("::",), ("2001:db8::1",), ("1::2::3",), (None,)], "ip string")
    assert [r[0] for r in ips.select(S.detect_ip_version(F.col("ip"))).collect()] == [4, None, 6, 6, None, None]


def test_release_order(spark):
    d = spark.createDataFrame([(0, "a", 1), (1, "b", 2), (2, "c", 0)], "line long, event_id string, event_time int")
    assert V.out_of_order(d, "line") == 1
