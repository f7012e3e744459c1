"""Raw files to releases."""

import hashlib
import hmac
import json

import pytest

from pyspark.sql import functions as F

from logvista.functions import identity as I
from logvista.operators import sampling as P
from logvista.operators import validate as V
from logvista.plans import analysis as A
from logvista.plans import outputs as U
from logvista.plans import release as R
from logvista.plans.process import process
from logvista.plans.schema import FORBIDDEN_PUBLIC, LEGACY_20, LEGACY_35, PUBLIC_42, RAW, RESTRICTED_50
from logvista.sources import raw_csv as C

BASE = {
    "record_id": "1", "event_time": "2026-05-01T10:00:00.000Z", "actor_email_hash": "aaaa1111bbbb2222", "ip_hash": "1111aaaa2222bbbb", "ip_version": "4", "ip_country": "Angola", "ip_region": "AO",
    "ip_city": "Luanda", "continent": "Africa", "latitude": "-8.8371", "longitude": "13.2333", "event_name": "login_success", "is_suspicious": "False", "login_type": "google_password",
    "login_challenge_method": "password", "login_status": "success",
}


def write(path, rows, sep=",", encoding="utf-8", columns=RAW):
    lines = [sep.join(columns)] + [sep.join((BASE | r).get(c, "") for c in columns) for r in rows]
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n", encoding=encoding)
    return path


def run(spark, folder, **env):
    return process(spark, C.discover(str(folder), env or {"HMAC_SECRET_KEY": "secret"}))


def test_two_files_with_an_overlap(spark, tmp_path):
    write(tmp_path / "suspicious_login_logs_1.csv", [{"record_id": "1"}, {"record_id": "2", "event_time": "2026-05-02T10:00:00Z"}])
    write(tmp_path / "suspicious_login_logs_2.csv", [{"record_id": "9"}], columns=RAW[::-1])
    p = run(spark, tmp_path)
    assert p.counts == {"removed_empty_rows": 0, "removed_invalid_core_rows": 0, "removed_duplicate_rows": 1}
    assert p.public.columns == PUBLIC_42.names and p.restricted.columns == RESTRICTED_50.names and p.public.count() == 2
    assert not set(p.public.columns) & FORBIDDEN_PUBLIC and V.schema_errors(p.public, PUBLIC_42.names, FORBIDDEN_PUBLIC) == []
    raw = spark.createDataFrame([(BASE["actor_email_hash"],), (BASE["ip_hash"],)], ["hash"])
    assert V.raw_hash_text(p.public, raw) == 0
    assert V.differs(p.public, p.restricted, "event_id") == 0 and V.minimum(p.public, 2, 42) == []


def test_refused_inputs(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        C.discover(str(tmp_path / "none"), {})
    with pytest.raises(FileNotFoundError):
        C.discover(str(tmp_path), {})
    write(tmp_path / "suspicious_login_logs_1.csv", [{}])
    with pytest.raises(KeyError, match="HMAC_SECRET_KEY"):
        C.discover(str(tmp_path), {})
    write(tmp_path / "suspicious_login_logs_2.csv", [{}], columns=[c if c != "ip_city" else "city" for c in RAW])
    with pytest.raises(ValueError, match="differ"):
        run(spark, tmp_path)
    for i, bad in enumerate(("maybe", "", "1.0")):
        write(tmp_path / f"x{i}" / "suspicious_login_logs_1.csv", [{"is_suspicious": bad}])
        with pytest.raises(ValueError, match="is_suspicious"):
            run(spark, tmp_path / f"x{i}")


def test_forms_of_files(spark, tmp_path):
    rows = [{"ip_city": "São Paulo", "latitude": "-8,8371", "ip_country": "NA", "login_challenge_method": "password|password | passkey"}, {c: "" for c in RAW}]
    write(tmp_path / "suspicious_login_logs_1.csv", rows, sep=";", encoding="cp1252")
    p = run(spark, tmp_path)
    (r,) = p.restricted.collect()
    assert (r["ip_city"], r["latitude"], r["ip_country"], r["continent"], r["login_challenge_method"]) == ("São Paulo", -8.8371, "NA", None, "password|passkey")
    assert p.counts["removed_empty_rows"] == 1
    write(tmp_path / "b" / "suspicious_login_logs_1.csv", [{"latitude": "95"}, {"event_time": "never", "record_id": "2"}, {"ip_country": "The Netherlands", "event_time": "2026-05-01T11:00:00Z"}])
    p = process(spark, [C.RawFile(str(tmp_path / "b" / "suspicious_login_logs_1.csv"), "b", b"k")])
    assert p.counts["removed_invalid_core_rows"] == 1
    a, b = p.restricted.orderBy("event_time").collect()
    assert (a["latitude"], a["longitude"]) == (None, None) and (b["ip_country"], b["continent"], b["country_changed"]) == ("Netherlands", "Europe", 1)


def test_records_over_lines_in_any_encoding(spark, tmp_path):
    for encoding in ("utf-8", "cp1252", "latin-1"):
        rows = [{"ip_city": '"S\u00e3o\nPaulo; ""x"""', "ip_region": "\x0c-\x1d" if encoding != "latin-1" else "\x81"}, {"event_time": "2026-05-01T12:00:00Z"}]
        path = write(tmp_path / encoding / "suspicious_login_logs_1.csv", rows, encoding=encoding)
        got = C.read_raw(spark, str(path)).orderBy("line_").collect()
        assert [r["ip_city"] for r in got] == ['S\u00e3o\nPaulo; "x"', "Luanda"] and [r["ip_region"] for r in got] == [rows[0]["ip_region"], "AO"], encoding
    files = [C.RawFile(str(tmp_path / e / "suspicious_login_logs_1.csv"), e, b"k") for e in ("utf-8", "cp1252", "latin-1")]
    raw, _ = C.read_all(spark, files, [])
    assert [(r["institution"], r["record_id"]) for r in raw.orderBy("row_order").collect()] == [(e, "1") for e in ("utf-8", "cp1252", "latin-1") for _ in range(2)]
    found = C.discover(str(tmp_path), {f"HMAC_SECRET_KEY_{x}": "k" for x in ("UTF_8", "CP1252", "LATIN_1")}, spark=spark)
    assert [f.institution for f in found] == ["cp1252", "latin-1", "utf-8"] and C.read_all(spark, found, [])[0].count() == 6


def test_institutions(spark, tmp_path):
    write(tmp_path / "north" / "suspicious_login_logs.csv", [{}])
    write(tmp_path / "south" / "suspicious_login_logs.csv", [{"event_time": "2026-05-01T12:00:00Z"}])
    (tmp_path / "empty").mkdir()
    said = []
    env = {"HMAC_SECRET_KEY_NORTH": "n", "HMAC_SECRET_KEY_SOUTH": "s"}
    files = C.discover(str(tmp_path), env, said.append)
    assert len(files) == 2 and len(said) == 1 and C.key_name("a-b.c") == "HMAC_SECRET_KEY_A_B_C"
    p = process(spark, files)
    assert p.restricted.select("actor_pseudo_id").distinct().count() == 2 and p.restricted.select("institution_pseudo_id").distinct().count() == 2
    want = "U" + hmac.new(b"n", BASE["actor_email_hash"].encode(), hashlib.sha256).hexdigest()[:16]
    assert want in {r[0] for r in p.public.select("actor_pseudo_id").collect()}
    text = p.restricted._jdf.queryExecution().toString()
    assert I.pads(b"n")[0].hex().upper() not in text.upper()
    old = process(spark, files, legacy=True)
    assert old.public.columns == LEGACY_20 and old.restricted.columns == LEGACY_35
    R.write_release(p.restricted, PUBLIC_42.names, str(tmp_path / "pub"), str(tmp_path / "res"), "csv")
    (part,) = R.parts(str(tmp_path / "pub"))
    back = C.read_release(spark, str(part), PUBLIC_42)
    assert back.count() == 2 and R.file_hash(str(part)) == hashlib.sha256(part.read_bytes()).hexdigest()
    doc = R.manifest(p.restricted, PUBLIC_42.names, p.counts, {"public": R.file_hash(str(part))})
    R.write_json(doc, str(tmp_path / "m.json"))
    assert json.loads((tmp_path / "m.json").read_text())["users"] == 2
    with pytest.raises(ValueError):
        C.read_release(spark, str(part), RESTRICTED_50)
    stats = A.analyse(p.public, str(tmp_path / "tables"))
    assert stats["events"] == 2 and stats["singleton_users"] == 2 and len(stats) == 24 and {x.name for x in (tmp_path / "tables").iterdir()} == {*A.tables(p.public), "statistics.json"}
    doc = V.report(p.restricted, p.public, PUBLIC_42.names)
    assert not doc["schema"] and not any(doc["invariants"].values()) and doc["public_differs"] == doc["recomputed_differs"] == doc["hours_backwards"] == 0 and not doc["windows_collapsed"]
    assert V.missingness_differs(p.public, {c: 0 for c in PUBLIC_42.names}) == {"hours_since_last_login": (2, 0)}


def test_hmac_of_any_text(spark):
    for key in (b"k", b"x" * 100):
        ipad, opad = I.pads(key)
        keys = I.key_table(spark, {"i": key})
        got = keys.select(I.hmac_hex(F.lit("naïve ☃"), keys["ipad"], keys["opad"])).first()[0]
        assert got == hmac.new(key, "naïve ☃".encode(), hashlib.sha256).hexdigest() and len(ipad) == len(opad) == 64


def test_sampler_refuses(spark):
    df = spark.range(10).selectExpr("id % 5 as actor", "0 as sig")
    with pytest.raises(ValueError):
        P.actor_sample(df, "actor", "sig", least=5, target=4, most=3)
    with pytest.raises(ValueError):
        P.actor_sample(df, "actor", "sig", least=300, target=400, most=500)
    s = P.actor_sample(df, "actor", "sig", least=4, target=6, most=7)
    assert s.count() == 6 and V.not_subset(s.distinct(), df.distinct(), "actor") == 0


def test_a_written_release_is_held_against_its_manifest(spark, tmp_path):
    write(tmp_path / "in" / "suspicious_login_logs.csv", [{"event_time": f"2026-05-{d:02d}T{h:02d}:00:00Z", "ip_country": c} for d in (1, 2, 3) for h in (1, 5) for c in ("Angola", "Brazil")])
    p = run(spark, tmp_path / "in")
    folders = {"public": str(tmp_path / "pub"), "restricted": str(tmp_path / "res")}
    R.write_release(p.restricted, PUBLIC_42.names, folders["public"], folders["restricted"])
    doc = R.manifest(p.restricted, PUBLIC_42.names, p.counts, {n: R.file_hashes(spark, f) for n, f in folders.items()})
    R.write_json(doc, str(tmp_path / "manifest.json"))
    doc = U.read_manifest(str(tmp_path / "manifest.json"))
    tables = [spark.read.parquet(folders[n]) for n in ("public", "restricted")]
    good = U.validate_release(spark, *tables, doc, folders, str(tmp_path / "report.json"))
    assert good["status"] == "PASS" and good["failed"] == [] and json.loads((tmp_path / "report.json").read_text())["status"] == "PASS"
    bad = U.validate_release(spark, tables[0].withColumn("label", F.lit(1)), tables[1].withColumn("provider_suspicious", F.lit(3)), doc | {"events": 5, "sha256": {}}, folders)
    assert bad["status"] == "FAIL" and {"schema", "public_differs", "invariant signal_not_binary", "hash public", "hash restricted", "forbidden label", "rows"} <= set(bad["failed"])
    U.write_odds_ratios(p.public, ["is_new_country", "country_changed"], "provider_suspicious", str(tmp_path / "odds"))
    assert spark.read.option("header", True).csv(str(tmp_path / "odds")).columns == ["flag", "odds_ratio", "low", "high"]
    U.write_results(spark, {"a": {"roc_auc": 0.5, "f1": None}, "b": {"roc_auc": 1, "columns": 3}}, str(tmp_path / "bench"))
    (part,) = R.parts(str(tmp_path / "bench"))
    assert part.read_text().split() == ["place,model,roc_auc,f1,columns", "0,a,0.5,,", "1,b,1.0,,3.0"]
    U.write_gains(spark, [("m", 0.5, 0.75, 0.25)], str(tmp_path / "gains"))
    U.write_sample(p.public, str(tmp_path / "sample"))
    lines = [line for f in R.parts(str(tmp_path / "sample")) for line in f.read_text().split("\n")[1:] if line]
    assert len(lines) == 12 and [int(x.split(",")[PUBLIC_42.names.index("prior_event_count")]) for x in lines] == list(range(12))
    assert V.sample_errors(p.public, p.public) == {"events": 12, "columns": [], "repeated": 0, "incomplete_actors": 0, "unknown_events": 0}
