"""The corpus pipeline, stage by stage, and what it may not import."""

import re
import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest

from logvista.llm import bpe

from .test_copies import WORD, components, sets
from .test_scores import plain_score
from .test_tokens import best_fit

ROOT = Path(__file__).resolve().parents[2]
SF = Path("/root/testdata/sf0.001")


@pytest.mark.skipif(not SF.is_dir(), reason="no test tables")
def test_stages(spark):
    import corpus_pipeline as C
    from logvista.llm.shared import Workspace

    work, docs = Workspace(spark, "t"), spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, [{r[0] for r in docs.select("doc_id").collect()}]
    for name, stage in C.STAGES:
        docs = work.keep(stage(spark, docs, str(SF)), name)
        seen.append({r[0] for r in docs.select("doc_id").collect()})
        assert seen[-1] <= seen[-2] and seen[-1] and (name == "packing" or docs.columns == columns)
    assert [n for n, _ in C.STAGES] == ["quality", "exact", "near", "mix", "packing"] and len(seen[1]) < len(seen[0])
    assert C.run(spark, str(SF)).count() == docs.count()


def brute_force(rows, model):
    """The rows (doc_id, text, source, …) that reach the packing stage, by plain loops; nothing of the operators but the model's tables."""
    import hashlib

    rows = [r for r in rows if plain_score(model, r["text"] or "") >= 0.5]
    first = {}
    for r in rows:
        t = re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "")
        low = lambda x: (x["doc_id"] is None, x["doc_id"] or 0)
        if t not in first or low(r) < low(first[t]):
            first[t] = r
    rows = list(first.values())
    known = [r for r in rows if r["doc_id"] is not None]
    s = sets([r["text"] for r in known], 5)
    groups = {}
    for r, words, c in zip(known, s, components(s), strict=True):
        groups.setdefault(c if words else id(r), []).append(r)
    rows = [min(g, key=lambda r: r["doc_id"]) for g in groups.values()] + [r for r in rows if r["doc_id"] is None]
    size = lambda r: len(WORD.findall(r["text"] or ""))
    names = sorted({r["source"] for r in rows}, key=lambda x: (x is None, x))
    total = {n: sum(size(r) for r in rows if r["source"] == n) for n in names}
    weight, full = {n: 1 + i % 3 for i, n in enumerate(names)}, set()
    while True:
        left = sum(total.values()) - sum(3 * total[n] for n in full)
        open_ = sum(weight[n] for n in names if n not in full)
        more = {n for n in names if n not in full and 3 * total[n] * open_ <= left * weight[n]}
        if not more:
            break
        full |= more
    out = []
    for n in names:
        target = 3 * total[n] if n in full else left * weight[n] / open_
        whole = int(target // total[n]) if total[n] else 0
        need, before = target - whole * total[n], 0
        name = lambda r: str(r["doc_id"]) if r["doc_id"] is not None else hashlib.md5((r["text"] or "").encode()).hexdigest()
        for r in sorted((r for r in rows if r["source"] == n), key=lambda r: (hashlib.md5(f"{name(r)}|7".encode()).hexdigest(), size(r))):
            out += [r] * (whole + (need > 0 and 2 * before + size(r) <= 2 * need))
            before += size(r)
    return out


@pytest.mark.skipif(not SF.is_dir(), reason="no test tables")
def test_all_rows_by_brute_force(spark, texts, tmp_path):
    """Over the smallest tables and rows of every odd kind, whose columns have the names that operators use."""
    import corpus_pipeline as C
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    base = [r.asDict() for r in docs.collect()]
    good = [r["text"] for r in base if r["doc_id"] % 5 == 0][:12]
    own = [(i, t) for i, t in enumerate([*texts, *good], 10_000)] + [(1, good[0] + " more words at the end"), (1, good[1]), (2, good[2] + " tail"), (None, good[3]), (None, good[4] + " a b c d"), (None, None), (None, None)]
    rows = base + [{"doc_id": i, "text": t, "lang": None, "source": None if k % 4 == 0 else f"s{k % 3}", "n_chars": k} for k, (i, t) in enumerate(own)] + base[:9]
    schema = docs.schema.simpleString()[7:-1].replace(":", " ") + ", row string, size string, rep string, `Key` string, mix int"
    path = str(tmp_path)
    spark.createDataFrame([(*(r[c] for c in docs.columns), "r", None, "s", "k", 1) for r in rows], schema).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{path}/labels.parquet")
    from logvista.llm.op3_quality import learn

    want = brute_force(rows, learn(spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet")))
    got = C.run(spark, path).collect()
    tok = Tokenizer.from_file(bpe.default_path())
    pieces, lengths = [], []
    for r in want:
        ids = np.array([*tok.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        head = (len(ids) - 1) % 1024 + 1
        edges = [0, *range(head, len(ids) + 1, 1024)]
        for i, (a, b) in enumerate(zip(edges, edges[1:])):
            pieces.append((r["doc_id"], i, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            lengths.append(b - a)
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(pieces, key=str)
    places = {}
    for r in got:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert len(places) == best_fit(lengths, 1024)
    for v in places.values():
        end = 0
        for offset, length in sorted(v):
            assert offset == end
            end += length
        assert end <= 1024


def test_stages_on_nothing(spark, tmp_path):
    import corpus_pipeline as C

    path = str(tmp_path)
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long, row int, mix int")
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    for name, stage in C.STAGES:
        out = stage(spark, docs, path)
        assert out.count() == 0 and (name == "packing" or out.columns == docs.columns)
    assert C.run(spark, path).count() == 0


def test_the_rest_stands_without_it():
    code = (
        "import sys, builtins; real = builtins.__import__\n"
        "def no(name, *a, **k):\n"
        "    if 'corpus_pipeline' in name or name.endswith('.llm') or '.llm.' in name or (a and a[2] and 'llm' in a[2]): raise ImportError(name)\n"
        "    return real(name, *a, **k)\n"
        "builtins.__import__ = no\n"
        "import __spark_entry__ as e; q = e.queries(); assert 'gini' in q and not [x for x in q if x.startswith('op') and x[2].isdigit()] and 'pipeline' not in q"
    )
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT).returncode == 0
    for path in (ROOT / "logvista").rglob("*.py"):
        if "llm" not in path.parts:
            assert "llm" not in path.read_text(encoding="utf-8"), path
