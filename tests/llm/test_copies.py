"""Near and exact copies, components, mixing."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F


from logvista.llm import components as C
from logvista.llm import op1_minhash as N
from logvista.llm import op6_mixing as X
from logvista.llm import op7_exact_dedup as E
from logvista.llm import textbytes as tb
from logvista.llm.shared import Workspace, hot_keys, join_split

from .conftest import thue_morse

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sets(texts, k):
    out = []
    for t in texts:
        w = WORD.findall((t or "").translate(LOWER))
        out.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    return out


def components(s, percent=80):
    root = list(range(len(s)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(s)):
        for j in range(i):
            both = len(s[i] & s[j])
            if s[i] and s[j] and 100 * both >= percent * (len(s[i]) + len(s[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(s))]


@pytest.mark.parametrize("k", [4, 5])
def test_near_copies_are_those_of_brute_force(docs, texts, k):
    s = sets(texts, k)
    want = components(s)
    got = N.near_duplicates(docs, k=k).collect()
    assert len(got) == len(texts) + 1  # the repeated row too
    for r in got:
        i = r["doc_id"]
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(s[i]), want[i], want[i] == i)


@pytest.mark.parametrize("n", [1024, 8192])
def test_texts_with_equal_polynomial_hashes_are_told_apart(spark, n):
    words = thue_morse(n)
    sequences = [w.replace("a", "foo ").replace("b", "bar ") for w in words]
    tail = " ".join(f"w{i}" for i in range(20))
    every = [*words, *sequences, *(f"{w} {tail}" for w in words), *(f"{w} {tail} x" for w in words), f"{words[0]} {words[1]}", f"{words[1]} {words[0]}", " ".join([*words, *words])]
    d = spark.createDataFrame(list(enumerate(every)), "doc_id long, text string")
    for k in (1, 4):
        s = sets(every, k)
        want = components(s)
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in N.near_duplicates(d, k=k).collect()}
        assert got == {i: (len(s[i]), want[i]) for i in range(len(every))}


def test_a_slice_whose_hashes_collide_is_counted_by_its_words(texts, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(tb, "mix64", lambda x: x & np.uint64(3))  # four hashes for all shingles
    batch = pa.RecordBatch.from_arrays([pa.array(texts[:-2] + texts[-1:] * 2)], names=["text"])
    s = sets(batch.column(0).to_pylist(), 3)
    for at, to, data, bounds in tb.slices(batch, "text", 1 << 12, 2):
        assert at % 2 == 0 and tb.Shingles(data, bounds, 3).tally()[:, 1].tolist() == [len(x) for x in s[at:to]]
        if (to - at) % 2 == 0:
            pairs = [(len(a - b), len(b - a), len(a & b)) for a, b in zip(s[at:to:2], s[at + 1 : to : 2], strict=True)]
            assert [tuple(x) for x in tb.Shingles(data, bounds, 3).tally(2)[:, 1:].tolist()] == pairs


def test_large_groups_and_buckets_in_blocks(spark, monkeypatch):
    """Every frequent key is broadcast, and buckets are cut into blocks of three members."""
    r = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    base = [r.choice(words, 80).tolist() for _ in range(4)]
    every = []
    for i in range(90):
        w = list(base[i % 4])
        for j in r.integers(0, 80, int(r.integers(0, 9))):
            w[j] = f"e{r.integers(0, 3)}"
        every.append(" ".join(w))
    every += [every[0]] * 30
    d = spark.createDataFrame(list(enumerate(every)), "doc_id long, text string").repartition(5)
    s = sets(every, 5)
    want = components(s)
    monkeypatch.setattr(N, "BLOCK", 3)
    few = lambda left, key, work, least=0, counts=None: hot_keys(left, key, work, 30, 2, counts)
    monkeypatch.setattr(N, "hot_keys", few)
    monkeypatch.setattr(N, "join_split", lambda left, right, key, work, least=0, hot="count": join_split(left, right, key, work, hot=few(left, key, work) if isinstance(hot, str) else hot))
    got = {r["doc_id"]: r["component_id"] for r in N.near_duplicates(d).collect()}
    assert got == dict(enumerate(want)) and 4 < len(set(want)) < 90


def test_near_copies_of_nothing_and_without_id(spark, empty):
    assert N.near_duplicates(empty).count() == 0
    d = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d  e f")], "doc_id long, text string")
    got = {(r["doc_id"], r["component_id"], r["kept"]) for r in N.near_duplicates(d).collect()}
    assert got == {(None, None, True), (1, 1, True), (2, 1, False)}


def test_rejected_rows_go_and_columns_stay(docs, texts):
    want = components(sets(texts, 5))
    got = N.drop_near_duplicates(docs)
    assert got.columns == docs.columns and {r["doc_id"] for r in got.select("doc_id").collect()} == {i for i, c in enumerate(want) if c == i}


def test_near_copies_go_by_row(spark):
    """Ids 1 and 2 stand on two texts each; only the texts are linked, and one row of a component stays."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a), (1, b), (2, f"{a} end"), (2, f"{c} end"), (3, f"{b} end"), (4, c), (5, "q r s t u v"), (5, "q r s t u v"), (6, ""), (6, ""), (None, a)]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit("x")).repartition(3)
    s = sets([t for _, t in rows], 5)
    low = [min(rows[j][0] for j, g in enumerate(components(s)) if g == h and rows[j][0]) if s[i] and rows[i][0] else rows[i][0] for i, h in enumerate(components(s))]
    assert low == [1, 1, 1, 2, 1, 2, 5, 5, 6, 6, None]
    got = N.near_duplicates(d).collect()
    assert sorted(((r["doc_id"], r["component_id"]) for r in got), key=str) == sorted(((i, h) for (i, _), h in zip(rows, low, strict=True)), key=str)
    stay = N.drop_near_duplicates(d)
    assert stay.columns == d.columns
    assert sorted((tuple(r)[:2] for r in stay.collect()), key=str) == sorted([(1, a), (1, b), (2, f"{c} end"), (5, "q r s t u v"), (6, ""), (6, ""), (None, a)], key=str)


def test_components_in_few_and_many_tasks(spark):
    r = np.random.default_rng(0)
    edges = [(int(a), int(b)) for a, b in r.integers(0, 300, (200, 2))] + [(i, i + 1) for i in range(1000, 1040)] + [(5, 5), (None, 3)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(4)
    near = {}
    for a, b in edges:
        if a is not None and a != b:
            near.setdefault(a, set()).add(b), near.setdefault(b, set()).add(a)
    want = {}
    for n in sorted(near):
        todo = [n] if n not in want else []
        while todo:
            x = todo.pop()
            if x not in want:
                want[x] = n
                todo += near[x]
    for most in (10**6, 60):
        got = {x["node"]: x["root"] for x in C.connected_components(df, Workspace(spark, "t"), most).collect()}
        assert got == want
    assert C.connected_components(df.limit(0), Workspace(spark, "t")).count() == 0


def test_exact_copies(spark, docs, texts, empty):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for t in texts]
    got = E.exact_duplicates(docs).collect()
    rows = [*range(len(texts)), 5]
    assert sorted(r["doc_id"] for r in got) == sorted(rows) and sum(r["kept"] for r in got) == len(set(norm))
    for r in got:
        same = [i for i in rows if norm[i] == norm[r["doc_id"]]]
        assert (r["keep_id"], r["group_size"], r["text_sha256"]) == (min(same), len(same), hashlib.sha256(norm[r["doc_id"]].encode()).hexdigest())
    assert E.exact_duplicates(empty).count() == 0 and E.drop_exact_duplicates(docs).columns == docs.columns
    d = spark.createDataFrame([(None, "a"), (3, "a"), (2, " b"), (None, "c")], "doc_id long, text string")
    assert {(r["doc_id"], r["keep_id"], r["kept"]) for r in E.exact_duplicates(d).collect()} == {(None, 3, False), (3, 3, True), (2, 2, True), (None, None, True)}


def test_exact_copies_go_by_row(spark):
    rows = [(1, "a", "x"), (1, "a", "x"), (2, "b", "x"), (3, "b", "x"), (3, "c", "x"), (None, "d", "x"), (None, "d", "x"), (None, "a", "x"), (None, "e", "x"), (4, None, "x"), (5, " ", "x"), (6, "", "x")]
    d = spark.createDataFrame(rows, "doc_id long, text string, row string").repartition(4)
    got = E.drop_exact_duplicates(d)
    assert got.columns == d.columns
    assert sorted(got.collect(), key=str) == sorted([(1, "a", "x"), (2, "b", "x"), (3, "c", "x"), (None, "d", "x"), (None, "e", "x"), (4, None, "x"), (5, " ", "x")], key=str)


def test_mixture(spark, docs, empty):
    plan = X.mix_plan(X.plan_mix(docs)).collect()
    total = sum(r["size"] for r in plan)
    targets = {r["source"]: (r["target"], r["source_size"]) for r in plan}
    assert abs(sum(t for t, _ in targets.values()) - total) < 1e-6 and all(t <= 3 * s for t, s in targets.values()) and None in targets
    for source, (target, _) in targets.items():
        mine = [r for r in plan if r["source"] == source]
        assert abs(sum(r["size"] * r["repetitions"] for r in mine) - target) <= max(r["size"] for r in mine) / 2 + 1e-6
        assert all(0 <= r["repetitions"] <= 3 for r in mine)
    times = {}
    for r in plan:
        times[r["id"]] = times.get(r["id"], 0) + r["repetitions"]
    got = X.mixed(docs)
    assert got.columns == docs.columns
    counted = {r["doc_id"]: r["count"] for r in got.groupBy("doc_id").count().collect()}
    assert counted == {i: n for i, n in times.items() if n}
    again = {(r["id"], r["repetitions"]) for r in X.mix_plan(X.plan_mix(docs.repartition(2))).collect()}
    assert again == {(r["id"], r["repetitions"]) for r in plan}
    assert X.mixed(empty).count() == 0 and X.mix_plan(X.plan_mix(empty)).count() == 0


def test_the_mix_is_the_plan_for_repeated_and_missing_ids(spark):
    """One id on rows of two sources and of several texts, copies without id, and copies that the cut goes through."""
    rows = [(1, "a b c d e f g", s) for s in "xy"] + [(1, "a b c d e f", "x"), (2, "p q", "y"), (2, "p q r", "y"), (3, "", "y"), (4, None, None), (5, "k l m", None)]
    rows += [(None, "a b c d e", "x")] * 7 + [(None, "one two", "z")] * 40 + [(9, "one two three", "z")] * 40 + [(8, " ".join("w" * 30), "big")] * 3
    d = spark.createDataFrame([(*r, 1, "s") for r in rows], "doc_id long, text string, source string, mix int, src string").coalesce(3)
    plan = X.mix_plan(X.plan_mix(d)).collect()
    assert len(plan) == len(rows)
    for source in {r["source"] for r in plan}:
        mine = [r for r in plan if r["source"] == source]
        taken = sum(r["size"] * r["repetitions"] for r in mine)
        assert abs(taken - mine[0]["target"]) <= max(r["size"] for r in mine) / 2 + 1e-6, source
    want, got = {}, {}
    for r in plan:
        key = (r["id"], r["source"], r["size"])
        want[key] = want.get(key, 0) + r["repetitions"]
    out = X.mixed(d)
    assert out.columns == d.columns
    for r in out.collect():
        key = (r["doc_id"], r["source"], len((r["text"] or "").split()))
        got[key] = got.get(key, 0) + 1
    assert got == {k: n for k, n in want.items() if n}


def test_targets_of_many_sources_in_parts(spark, monkeypatch):
    """Ranks from several tasks, plans that are not broadcast, and the levels of a plain loop."""
    r = np.random.default_rng(4)
    sizes = {f"s{i}" if i else None: int(n) for i, n in enumerate(r.zipf(1.4, 200).clip(0, 3000))}
    rows = [(i, " ".join("w" * n), s) for i, (s, n) in enumerate(sizes.items())]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for name, value in (("SORTED", 50), ("FEW", 10)):
        monkeypatch.setattr(X, name, value)
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight, cap, total = {s: 1 + i % 3 for i, s in enumerate(names)}, {s: 3 * n for s, n in sizes.items()}, sum(sizes.values())
    full: set = set()
    while True:
        level = (total - sum(cap[s] for s in full)) / max(1, sum(weight[s] for s in names if s not in full))
        more = {s for s in names if s not in full and cap[s] <= level * weight[s]}
        if not more:
            break
        full |= more
    got = {x["source"]: x["target"] for x in X.mix_plan(X.plan_mix(d)).collect()}
    assert got.keys() == sizes.keys() and all(abs(got[s] - (cap[s] if s in full else level * weight[s])) < 1e-6 for s in names)


def test_water_filling_caps(spark):
    d = spark.createDataFrame([(i, "w " * n, s) for i, (s, n) in enumerate([("a", 100), ("b", 100), ("c", 1), ("d", 0)])], "doc_id long, text string, source string")
    got = {r["source"]: r["target"] for r in X.mix_plan(X.plan_mix(d)).collect()}
    assert got["c"] == 3 and got["d"] == 0 and abs(got["a"] - 198 / 3) < 1e-9 and abs(got["b"] - 2 * 198 / 3) < 1e-9


