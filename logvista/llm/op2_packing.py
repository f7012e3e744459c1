"""Best-fit-decreasing packing of documents into sequences, planned on the histogram of lengths.

The plan needs one count for each length, not the documents: best fit treats all pieces of a length alike, and sequences
with the same room left alike, so that both are handled as runs. Its size is bounded by the sequence length, whatever the
corpus. Each piece then finds its slot by its length and its rank within that length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bpe
from . import textbytes as tb
from .shared import Workspace, lean, read_table

TEXT_BYTES = 1 << 20
#: Pieces of one length that are ranked in one task, about.
RANKED = 50_000


def plan(histogram: dict[int, int], size: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit over counts, longest first: runs (length, first rank, ranks, first sequence, pieces in each, offset).

    Piece r of a run goes to sequence first + r // pieces, at offset + (r % pieces) * length.
    """
    room: dict[int, list[tuple[int, int]]] = {}  # room left -> (first sequence, sequences)
    rooms: list[int] = []  # those that some sequence has, sorted
    opened, runs = 0, []

    def add(left: int, first: int, n: int) -> None:
        if left and n:
            if left not in room:
                room[left] = []
                insort(rooms, left)
            room[left].append((first, n))

    for length in sorted((x for x, n in histogram.items() if n), reverse=True):
        if not 1 <= length <= size:
            raise ValueError(f"a piece of length {length} does not fit in a sequence of {size}")
        rank, count = 0, histogram[length]
        while count:
            i = bisect_left(rooms, length)
            if i < len(rooms):
                left = rooms[i]
                first, n = room[left].pop()
                if not room[left]:
                    del room[left], rooms[i]
            else:
                left, first, n = size, opened, -(-count // (size // length))
                opened += n
            each = left // length
            taken = min(count, n * each)
            runs.append((length, rank, taken, first, each, size - left))
            full, over = divmod(taken, each)
            add(left - each * length, first, full)
            if over:
                add(left - over * length, first + full, 1)
                full += 1
            add(left, first + full, n - full)
            rank += taken
            count -= taken
    return runs


def _pieces(path: str, end_id: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = bpe.encoder(path)
        for batch in batches:
            for at, to, data, bounds in tb.slices(batch, "text", TEXT_BYTES):
                ids, own = bpe.with_end(*enc.encode(data, bounds), end_id)
                raw = ids.astype("<u4")
                n = np.diff(own)
                pieces = -(-n // size)
                row = np.repeat(np.arange(to - at), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                head = n - (pieces - 1) * size  # length of the first piece, the one that may be shorter
                start = np.where(piece == 0, 0, head[row] + (piece - 1) * size)
                length = np.where(piece == 0, head[row], size)
                begin = own[row] + start
                crc = np.array([zlib.crc32(raw[a : a + k].tobytes()) for a, k in zip(begin.tolist(), length.tolist(), strict=True)], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(at, to - at).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc)],
                    names=["id", "piece", "start", "length", "ids_crc32"],
                )

    return run


def pack(
    docs: DataFrame, size: int = 1024, tokenizer: str | None = None, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row a piece: (id_col, piece, start, length, ids_crc32, sequence_id, offset).

    A document is its whole text's ids without special tokens, then ``end_id``; a null text counts as empty. Documents of
    more than ``size`` ids are cut into pieces of ``size``, the first of which may be shorter. Every row is packed, repeated
    rows and rows without id too. Other columns are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "pack")
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    pieces = work.keep(own.mapInArrow(lean(_pieces(tokenizer or bpe.default_path(), end_id, size), "encoder"), "id long, piece int, start long, length long, ids_crc32 long"), "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most ``size`` rows
    runs = [(a, b, b + n, *rest) for a, b, n, *rest in plan(histogram, size)]
    slots = spark.createDataFrame(runs, "length long, from_ long, to_ long, first_ long, each_ long, at_ long") if runs else None
    if slots is None:
        return pieces.select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    # Rank within length: counts of (length, salt) first, then row numbers within each, so that no length meets in one task.
    salts = max(16, -(-max(histogram.values()) // RANKED))
    salted = pieces.withColumn("salt_", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(salts)))
    each = salted.groupBy("length", "salt_").count()
    base = each.select("length", "salt_", (F.sum("count").over(Window.partitionBy("length").orderBy("salt_").rowsBetween(Window.unboundedPreceding, 0)) - F.col("count")).alias("base_"))
    inside = F.row_number().over(Window.partitionBy("length", "salt_").orderBy("id", "piece", "ids_crc32"))
    ranked = salted.withColumn("n_", inside - 1).join(base, ["length", "salt_"]).withColumn("rank_", F.col("base_") + F.col("n_"))
    placed = ranked.join(F.broadcast(slots), (ranked["length"] == slots["length"]) & F.col("rank_").between(F.col("from_"), F.col("to_") - 1))
    nth = F.col("rank_") - F.col("from_")
    return placed.select(
        F.col("id").alias(id_col), "piece", "start", pieces["length"], "ids_crc32",
        (F.col("first_") + F.floor(nth / F.col("each_"))).alias("sequence_id"),
        (F.col("at_") + nth % F.col("each_") * ranked["length"]).alias("offset"),
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"))
