"""Token ids in files of range-asymmetric-numeral-system blocks (see ``rans``), written and read by Spark.

Three passes: tokenise in document order, keeping plain ids; count all ids for the one shared table; encode blocks of whole
documents. A file is Spark's own container with one block a row, so that it lands in, and is read from, any store that Spark
reaches. Blocks carry the documents' ids and lengths and the number of ids before them, and are read independently.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe
from . import textbytes as tb
from .rans import Coder, Model
from .shared import Workspace, read_table

#: A block is closed after the document with which it reaches so many ids.
BLOCK = 1 << 18
#: Bytes of text tokenised at once, and in one task, about.
TEXT_BYTES, PART = 1 << 20, 1 << 24


def _tokenise(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, before = bpe.encoder(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            for at, to, data, bounds in tb.slices(batch, "text", TEXT_BYTES):
                ids, own = bpe.with_end(*enc.encode(data, bounds), end_id)
                ids = ids.astype(enc.dtype)
                offsets = pa.array((own * enc.dtype.itemsize).astype(np.int64))
                raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), to - at, [None, offsets.buffers()[1], pa.py_buffer(ids.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(to - at, part, np.int32)), batch.column("id").slice(at, to - at),
                     pa.array(before + own[:-1]), pa.array(np.full(to - at, enc.dtype.itemsize, np.int32)), raw.cast(pa.binary())],
                    names=["part", "id", "at", "width", "ids"],
                )
                before += int(own[-1])

    return run


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a batch of ``_tokenise``, and each row's bounds."""
    col = batch.column("ids").cast(pa.large_binary())
    width = batch.column("width")[0].as_py()
    bounds = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, 8 * col.offset)
    raw = np.frombuffer(col.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
    return raw.view(f"<u{width}"), (bounds - bounds[0]) // width


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in batches:
        if batch.num_rows:
            now = np.bincount(_flat(batch)[0])
            total = np.pad(total, (0, max(0, len(now) - len(total))))
            total[: len(now)] += now
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["token", "n"])


def _encode(model: bytes, base: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(Model.from_bytes(model))
        held: list[tuple] = []
        count, expected = 0, None

        def block() -> pa.RecordBatch:
            ids, lengths, names, absent = (np.concatenate(x) for x in zip(*(h[:4] for h in held), strict=True))
            first = held[0][4]
            raw = coder.pack(ids, lengths, names, absent, first)
            return pa.RecordBatch.from_arrays([pa.array([first]), pa.array([raw], pa.binary())], names=["first", "block"])

        for batch in batches:
            if not batch.num_rows:
                continue
            ids, bounds = _flat(batch)
            part, at = (batch.column(c).to_numpy() for c in ("part", "at"))
            name = batch.column("id")
            absent, name = name.is_null().to_numpy(zero_copy_only=False), name.fill_null(0).to_numpy()
            i = 0
            while i < batch.num_rows:
                where = (int(part[i]), int(at[i]))
                if held and (where != expected or count >= BLOCK):
                    yield block()
                    held, count = [], 0
                j = i + 1  # as many whole documents as the block still takes, as long as they follow each other
                while j < batch.num_rows and part[j] == part[i] and count + bounds[j] - bounds[i] < BLOCK:
                    j += 1
                held.append((ids[bounds[i] : bounds[j]], np.diff(bounds[i : j + 1]), name[i:j], absent[i:j], base[where[0]] + where[1]))
                count += int(bounds[j] - bounds[i])
                expected = (where[0], where[1] + int(bounds[j] - bounds[i]))
                i = j
        if held:
            yield block()

    return run


def _decode(model: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(Model.from_bytes(model))
        for batch in batches:
            for raw in batch.column("block"):
                ids, lengths, names, absent, first = coder.unpack(raw.as_py())
                ends = np.cumsum(lengths)
                text = ids.astype("<u4")
                crc = np.array([zlib.crc32(text[b - n : b].tobytes()) for b, n in zip(ends.tolist(), lengths.tolist(), strict=True)], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, mask=absent), pa.array(first + ends - lengths), pa.array(lengths), pa.array(crc)],
                    names=["id", "start", "n_tokens", "ids_crc32"],
                )

    return run


class TokenFiles:
    """Files of blocks in the folder ``path``, with the shared table beside them."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    @staticmethod
    def write(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> TokenFiles:
        """Encodes every row: its whole text's ids without special tokens, then ``end_id``; null counts as empty.

        Rows stand in ascending order of id, those without an id first, repeated ids in any order. Other columns are not
        read. An empty table makes files without blocks.
        """
        spark = docs.sparkSession
        work = Workspace(spark, "tokens")
        own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
        size = own.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
        parts = max(spark.sparkContext.defaultParallelism, -(-size // PART))
        own = own.repartitionByRange(parts, "id").sortWithinPartitions("id")
        plain = work.keep(own.mapInArrow(_tokenise(tokenizer or bpe.default_path(), end_id), "part int, id long, at long, width int, ids binary"), "plain", compression="zstd")
        counts = plain.select("width", "ids").mapInArrow(_count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).toPandas()  # a row for each id of the vocabulary
        dense = np.zeros(int(counts["token"].max()) + 1 if len(counts) else 1, np.int64)
        dense[counts["token"].to_numpy(np.int64)] = counts["n"].to_numpy(np.int64)
        model = Model.fit(dense).to_bytes()
        sizes = plain.groupBy("part").agg(F.max(F.col("at") + F.length("ids") / F.col("width")).cast("long").alias("n")).orderBy("part").collect()  # a row for each partition
        base, total = {}, 0
        for r in sizes:
            base[r["part"]] = total
            total += r["n"]
        plain.mapInArrow(_encode(model, base), "first long, block binary").write.option("compression", "none").parquet(f"{path}/blocks")
        spark.createDataFrame([(bytearray(model),)], "model binary").coalesce(1).write.parquet(f"{path}/model")
        work.drop(plain)
        return TokenFiles(spark, path)

    def documents(self) -> DataFrame:
        """(id, start, n_tokens, ids_crc32) of each document, from the decoded blocks, whose checksums are verified."""
        model = bytes(self.spark.read.parquet(f"{self.path}/model").first()["model"])
        blocks = self.spark.read.schema("first long, block binary").parquet(f"{self.path}/blocks")
        return blocks.select("block").mapInArrow(_decode(model), "id long, start long, n_tokens long, ids_crc32 long")


def op5_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = TokenFiles.write(read_table(spark, sf_dir, "documents"), Workspace(spark, "token-files").path("files"))
    return files.documents().withColumnRenamed("id", "doc_id")
