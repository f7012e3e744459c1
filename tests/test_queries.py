"""Every registered query with SQL agrees with it over the smallest test tables."""

import math
import os

import pytest

from logvista.plans import queries as Q

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(x):
    if x is None or str(x) in ("NaT", "<NA>", "nan"):
        return None
    if type(x).__name__ in ("int", "int32", "int64", "float", "float32", "float64", "Decimal"):
        return None if math.isnan(float(x)) else float(x)
    return str(x)


def rows(frame):
    return sorted((tuple(map(plain, r)) for r in frame[sorted(frame.columns)].itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_agrees(spark, duck, name):
    got, want = Q.queries()[name](spark, SF).toPandas(), duck.sql(Q.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_whole_actors_in_the_sample(spark):
    got = Q.queries()["actor_sample"](spark, SF).toPandas()
    full = Q.events(spark, SF).select("event_id", "actor").toPandas()
    assert 300 <= len(got) <= 500
    assert (got.groupby("actor").size() == full[full.actor.isin(got.actor)].groupby("actor").size()).all()


def test_one_exchange_by_actor(spark):
    plan = Q.queries()["distinct_24h_7d_30d"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
