"""Nearest neighbours by cosine with randomly rotated one-bit codes.

Every vector is normalised, rotated by one random orthogonal matrix and kept as the signs of its coordinates, with one
scalar, the inner product of the unit vector with its code. Query times code over that scalar estimates the cosine without
bias, with an error that exceeds ``ERROR`` deviations very seldom. In a block, the best estimates are scored exactly first;
their k-th score is a bar, and every vector whose estimate plus error bound reaches it is scored exactly as well.

Queries are a stated set of rows, so all rows meet them in blocks: what is crossed is a table of query blocks with a table
of vector blocks, each block one row of about ``BYTES``, by broadcast or as a product of partitions, so that no key, and not
the dimension either, gathers rows in one task. A block pair is a few matrix operations. Results of different blocks are cut
to the best ones of a query in each task before they meet.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import Workspace, read_table

#: Deviations of the estimate's error that a vector is given the benefit of; rows of a block of vectors and of queries, at most.
ERROR, VECTORS, QUERIES = 3.0, 4096, 512
#: Far more than the error of an inner product of unit vectors in single precision.
ROUNDING = np.float32(1e-3)
#: Bytes of the vectors of a block, and of those whose exact scores are computed at once, about.
BYTES = 1 << 21
_BLOCK = "dim int, n int, ids binary, vectors binary, codes binary, scalars binary"


@lru_cache(maxsize=4)
def rotation(dim: int, seed: int = 1) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return (q * np.sign(np.diag(r))).astype(np.float32)


def _units(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return (x / np.sqrt((x * x).sum(axis=1, keepdims=True))).astype(np.float32)


def _block(ids: np.ndarray, x: np.ndarray) -> tuple:
    turned = _units(x) @ rotation(x.shape[1]).T
    scalar = np.abs(turned).sum(axis=1) / np.sqrt(x.shape[1])
    return x.shape[1], len(ids), ids.tobytes(), x.tobytes(), np.packbits(turned > 0, axis=1).tobytes(), scalar.astype(np.float32).tobytes()


def _blocks(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def out(dim: int) -> pa.RecordBatch:
            ids, x = (np.concatenate(c) for c in zip(*held.pop(dim), strict=True))
            return pa.RecordBatch.from_pylist([dict(zip(("dim", "n", "ids", "vectors", "codes", "scalars"), _block(ids, x), strict=True))],
                                              schema=pa.schema([("dim", pa.int32()), ("n", pa.int32()), *((c, pa.binary()) for c in ("ids", "vectors", "codes", "scalars"))]))

        for batch in batches:
            ids = batch.column("id").to_numpy()
            col = batch.column("vector")
            flat = col.flatten().fill_null(np.nan).to_numpy()
            size = np.asarray(col.value_lengths())
            begin = np.cumsum(size) - size
            for dim in np.unique(size):
                if not dim:
                    continue
                of = np.flatnonzero(size == dim)
                x = flat[begin[of][:, None] + np.arange(dim)].astype(np.float64)
                good = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
                x, own = x[good], ids[of][good]
                fit = max(1, min(most, BYTES // (8 * int(dim))))
                for a in range(0, len(x), fit):
                    held.setdefault(int(dim), []).append((own[a : a + fit], x[a : a + fit]))
                    if sum(len(i) for i, _ in held[int(dim)]) >= fit:
                        yield out(int(dim))
        for dim in list(held):
            yield out(dim)

    return run


def cosines(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosine of each row of q (or of the one vector q) with that row of x, in double precision; equal pairs get equal results wherever they stand."""
    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
        dot, norms = (x * q).sum(axis=-1), np.sqrt((x * x).sum(axis=-1)) * np.sqrt((q * q).sum(axis=-1))
        out = dot / norms
    if len(bad := np.flatnonzero(~(np.isfinite(dot) & np.isfinite(norms) & (norms > 0)))):
        x, q = x[bad], np.broadcast_to(q, x.shape)[bad]
        x, q = (v / np.abs(v).max(axis=-1, keepdims=True) for v in (x, q))
        out[bad] = (x * q).sum(axis=-1) / (np.sqrt((x * x).sum(axis=-1)) * np.sqrt((q * q).sum(axis=-1)))
    return out


def _exact(q: np.ndarray, x: np.ndarray, qi: np.ndarray, xi: np.ndarray) -> np.ndarray:
    step = max(1, BYTES // (8 * x.shape[1]))
    return np.concatenate([cosines(q[qi[a : a + step]], x[xi[a : a + step]]) for a in range(0, len(qi), step)] or [np.zeros(0)])


def search_block(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, codes: np.ndarray, scalars: np.ndarray, k: int):
    """(query id, id, exact cosine) of each query's k best other vectors of the block."""
    dim = x.shape[1]
    signs = np.unpackbits(codes, axis=1, count=dim).astype(np.float32) * 2 - 1
    estimate = (_units(q) @ rotation(dim).T) @ signs.T / np.sqrt(np.float32(dim)) / scalars
    bound = ERROR * np.sqrt(np.maximum(0, 1 - scalars**2)) / scalars / np.sqrt(max(1, dim - 1)) + 1e-5
    own = q_ids[:, None] == ids[None, :]
    estimate[own] = -np.inf
    first = min(len(ids), 4 * k + 1)
    start = np.argpartition(-estimate, first - 1, axis=1)[:, :first]
    rows = np.arange(len(q_ids))[:, None]
    exact = _exact(q, x, np.repeat(rows, first), start.ravel()).reshape(start.shape)
    exact[own[rows, start]] = -np.inf
    bar = np.partition(exact, -k, axis=1)[:, -k] if first >= k else np.full(len(q_ids), -np.inf)
    among = estimate + bound >= bar[:, None]
    among[rows, start] = True
    among &= ~own
    # Reranking: of the chosen vectors, single precision leaves out what lies clearly below the bar, the rest is scored exactly.
    among &= _units(q) @ _units(x).T >= bar[:, None].astype(np.float32) - ROUNDING
    qi, xi = np.nonzero(among)
    exact = _exact(q, x, qi, xi)
    order = np.lexsort((ids[xi], -exact, qi))
    qi, xi, exact = qi[order], xi[order], exact[order]
    top = np.arange(len(qi)) - np.searchsorted(qi, qi) < k
    return q_ids[qi[top]], ids[xi[top]], exact[top]


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch.column(c)[i] for c in batch.schema.names}
                dim, n = r["dim"].as_py(), r["n"].as_py()
                if dim != r["q_dim"].as_py():
                    continue
                array = lambda c, t=np.float64: np.frombuffer(r[c].as_buffer(), t)  # noqa: B023, E731
                found = search_block(
                    array("q_ids", np.int64), array("q_vectors").reshape(-1, dim), array("ids", np.int64), array("vectors").reshape(-1, dim),
                    array("codes", np.uint8).reshape(n, -1), array("scalars", np.float32), k,
                )
                yield pa.RecordBatch.from_arrays([pa.array(f) for f in found], names=["query_id", "vec_id", "score"])

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest other rows by cosine, ties to the smaller id.

    Vectors that are null, zero or hold null or non-finite components take no part, nor do rows without id; vectors meet
    those of their own dimension only. Rows repeated under one id are candidates each; a query id is searched once. An
    empty table gives no rows. Other columns are not read.
    """
    work = Workspace(vectors.sparkSession, "ann")

    def blocks(df: DataFrame, most: int, name: str) -> DataFrame:
        own = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector")).where("id is not null and vector is not null")
        own = own if name == "vectors" else own.dropDuplicates(["id"])
        n = max(1, -(-own.count() // most))
        return work.keep(own.repartition(n, "id").mapInArrow(_blocks(most), _BLOCK), name)

    v = blocks(vectors, VECTORS, "vectors")
    q = blocks(queries, QUERIES, "queries").select(F.col("dim").alias("q_dim"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))
    tasks = max(vectors.sparkSession.sparkContext.defaultParallelism, -(-v.count() // 16))
    met = v.repartition(tasks).crossJoin(q)  # blocks of a stated query set; dimensions are compared where the blocks are
    found = met.mapInArrow(_search(k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read_table(spark, sf_dir, "embeddings")
    return nearest(table, table.where("vec_id % 50 = 0"))
