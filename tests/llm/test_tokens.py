"""Tokens, files and packing against the library on whole texts."""

import os
import random
import subprocess
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest

from logvista.llm import bpe
from logvista.llm import op2_packing as P
from logvista.llm import op5_tokens as O
from logvista.llm import rans
from logvista.llm import textbytes as tb
from logvista.llm.shared import Workspace

from .conftest import thue_morse


@pytest.fixture(scope="module")
def ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.default_path())
    return [np.array([*t.encode(x or "", add_special_tokens=False).ids, 2], "<u4") for x in texts]


def test_pieces_give_the_ids_of_whole_texts():
    r = random.Random(1)
    alphabet = list("ab'1 \n\t.,!é 　\x1c\x85日SL ") + ["<|endoftext|>", "  ", "\n\n", "'s ", "\r\n"]
    odd = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 30))) for _ in range(4000)]
    e = bpe.Encoder(bpe.default_path())
    batch = pa.RecordBatch.from_arrays([pa.array(odd)], names=["text"])
    for at, to, data, bounds in tb.slices(batch, "text", 1 << 12):
        got, b = e.encode(data, bounds)
        for i, t in enumerate(odd[at:to]):
            assert got[b[i] : b[i + 1]].tolist() == e.tok.encode(t, add_special_tokens=False).ids, t


@pytest.mark.parametrize("n", [1024, 2048, 4096, 8192])
def test_pieces_with_equal_hashes_are_told_apart(n):
    a, b = thue_morse(n)
    e = bpe.Encoder(bpe.default_path())
    for every in ([a], [b, f"{a} {b}", f"x {b}\n{a}"], [a, b, b, a]):  # remembered from before, and both in one batch
        got, bounds = e.encode(*next(tb.slices(pa.RecordBatch.from_arrays([pa.array(every)], names=["text"]), "text", 1 << 30))[2:])
        for i, t in enumerate(every):
            assert got[bounds[i] : bounds[i + 1]].tolist() == e.tok.encode(t, add_special_tokens=False).ids


def test_pieces_in_a_cache_of_clashes(monkeypatch):
    """With eight hashes for all pieces nearly every find is a wrong one."""
    r = random.Random(2)
    odd = ["".join(r.choice("ab'1 .,!\né") for _ in range(r.randint(0, 300))) for _ in range(200)]
    real = tb.span_hashes
    monkeypatch.setattr(tb, "span_hashes", lambda *x: real(*x) & np.uint64(7 << 61))
    e = bpe.Encoder(bpe.default_path())
    for at, to, data, bounds in tb.slices(pa.RecordBatch.from_arrays([pa.array(odd)], names=["text"]), "text", 1 << 12):
        got, b = e.encode(data, bounds)
        for i, t in enumerate(odd[at:to]):
            assert got[b[i] : b[i + 1]].tolist() == e.tok.encode(t, add_special_tokens=False).ids, t


def test_files_and_sequences_of_equal_hashes(spark):
    every = [x for n in (1024, 4096) for x in thue_morse(n)]
    d = spark.createDataFrame(list(enumerate(every)), "doc_id long, text string").coalesce(1)
    t = bpe.Encoder(bpe.default_path()).tok
    crc = {i: zlib.crc32(np.array([*t.encode(x, add_special_tokens=False).ids, 2], "<u4").tobytes()) for i, x in enumerate(every)}
    files = O.TokenFiles.write(d, Workspace(spark, "t").path("f"))
    assert {r["id"]: r["ids_crc32"] for r in files.documents().collect()} == crc
    assert {r["doc_id"]: r["ids_crc32"] for r in P.pack(d, size=8192).collect()} == crc


def test_files_round_trip(spark, docs, empty, ids):
    files = O.TokenFiles.write(docs, Workspace(spark, "t").path("f"))
    got = sorted(files.documents().collect(), key=lambda r: (r["start"], r["id"]))
    order = sorted([*range(len(ids)), 5])
    assert [r["id"] for r in got] == order
    start = 0
    for r in got:
        own = ids[r["id"]]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(own), zlib.crc32(own.tobytes()))
        start += len(own)
    assert O.TokenFiles.write(empty, Workspace(spark, "t").path("f")).documents().count() == 0
    d = spark.createDataFrame([(None, "a"), (1, "a b")], "doc_id long, text string")
    assert [r["id"] for r in sorted(O.TokenFiles.write(d, Workspace(spark, "t").path("f")).documents().collect(), key=lambda r: r["start"])] == [None, 1]


def test_blocks_stand_alone_and_notice_damage():
    r = np.random.default_rng(5)
    x = (r.zipf(1.3, 50_000) % 5000).astype(np.uint32)
    model = rans.Model.from_bytes(rans.Model.fit(np.bincount(x)).to_bytes())
    assert int(model.freq.sum()) == 1 << model.bits
    coder = rans.Coder(model, lanes=64, every=16)
    lengths = np.array([49_000, 0, 1000])
    raw = coder.pack(x, lengths, np.array([1, 2, 3]), np.zeros(3, bool), 77)
    got = coder.unpack(raw)
    assert (got[0] == x).all() and got[1].tolist() == lengths.tolist() and got[2].tolist() == [1, 2, 3] and got[4] == 77
    assert (coder.segment(raw, 3) == x[3 * 1024 : 4 * 1024]).all()
    p = np.bincount(x) / len(x)
    bits = -(p[p > 0] * np.log2(p[p > 0])).sum() * len(x)
    assert len(raw) * 8 < bits * 1.02 + 64 * 64 * (50_000 // 1024 + 2)
    for at in (3, 100, len(raw) - 1):
        with pytest.raises(ValueError):
            coder.unpack(raw[:at] + bytes([raw[at] ^ 1]) + raw[at + 1 :])
    none = coder.unpack(coder.pack(x[:0], np.array([], int), np.array([], int), np.array([], bool), 0))
    assert len(none[0]) == 0
    with pytest.raises(ValueError):
        rans.Coder(rans.Model.fit(np.array([0, 5, 5])), lanes=4).pack(np.array([0]), np.array([1]), np.array([1]), np.zeros(1, bool), 0)


def best_fit(lengths, size):
    """Best fit decreasing, item by item."""
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(room) if r >= n]
        if fits:
            room[min(fits, key=lambda i: room[i])] -= n
        else:
            room.append(size - n)
    return len(room)


@pytest.mark.parametrize("seed", range(8))
def test_plan_over_counts_is_best_fit(seed):
    r = random.Random(seed)
    size = r.choice([10, 50, 1024])
    lengths = [r.randint(1, size) for _ in range(r.randint(0, 400))]
    histogram = {n: lengths.count(n) for n in set(lengths)}
    used = {}
    for length, rank, n, first, each, offset in P.plan(histogram, size):
        for i in range(n):
            used.setdefault(first + i // each, []).append((offset + i % each * length, length))
        histogram[length] -= n
    assert not any(histogram.values()) and len(used) == best_fit(lengths, size)
    for places in used.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= size
    with pytest.raises(ValueError):
        P.plan({size + 1: 1}, size)


def test_packed_documents(docs, empty, ids):
    got = P.pack(docs, size=64).collect()
    seen, places = {}, {}
    for r in sorted(got, key=lambda r: (r["doc_id"], r["piece"])):
        own = ids[r["doc_id"]]
        assert r["length"] <= 64 and r["ids_crc32"] == zlib.crc32(own[r["start"] : r["start"] + r["length"]].tobytes())
        seen[r["doc_id"]] = seen.get(r["doc_id"], 0) + r["length"]
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert seen == {i: len(x) * (2 if i == 5 else 1) for i, x in enumerate(ids)}
    for v in places.values():
        end = 0
        for offset, length in sorted(v):
            assert offset == end
            end += length
        assert end <= 64
    lengths = [64] * sum((len(x) - 1) // 64 for x in [*ids, ids[5]]) + [(len(x) - 1) % 64 + 1 for x in [*ids, ids[5]]]
    assert len(places) == best_fit(lengths, 64)
    assert P.pack(empty).count() == 0


_HELD = """
import numpy as np, pyarrow as pa
from logvista.llm import bpe, op1_minhash, op2_packing
from logvista.llm.shared import lean

def batches():
    r = np.random.default_rng(1)
    for _ in range(3):
        text = r.integers(97, 123, (10_000, 1000)).astype(np.uint8)
        text[:, ::8] = 32
        yield pa.RecordBatch.from_arrays([pa.array(range(10_000)), pa.array(range(10_000)), pa.array([x.tobytes().decode() for x in text])], names=["row", "id", "text"])

def mb():
    return sum(int(x.split()[1]) for x in open("/proc/self/smaps_rollup") if x.startswith(("Pss_Anon", "Pss_Shmem"))) / 1024

before = mb()
sum(x.num_rows for x in lean(op2_packing._pieces(bpe.default_path(), 2, 1024), "encoder")(batches()))
assert bpe.encoder.cache_info().currsize == 1  # for the next task of the step
sum(x.num_rows for x in lean(op1_minhash._sketch(5, 64, 7))(batches()))
assert bpe.encoder.cache_info().currsize == 0
print(mb() - before)
"""


@pytest.mark.skipif(not os.path.exists("/proc/self/smaps_rollup"), reason="memory can't be read here")
def test_workers_give_memory_back():
    """A worker that made pieces and then sketches of 30 MB of text keeps little."""
    out = subprocess.run([sys.executable, "-c", _HELD], capture_output=True, text=True, cwd=os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    assert out.returncode == 0, out.stderr[-2000:]
    assert float(out.stdout.split()[-1]) < 150
