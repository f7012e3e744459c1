"""Tables in the folder that driver and executors share, and other small helpers."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that are worked on at once.
SLICE_BYTES = 1 << 19
#: Bits of a map of wanted ids (``likely``), at most: 8 MB, whatever the corpus.
MAP_BITS = 1 << 26


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir).

    Where that is unset, a local session gets a folder of its own, as in tests; on a cluster RuntimeError is raised, for what
    one machine writes to its own disk the others can't read.
    """
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        at = tempfile.mkdtemp(prefix="logvista-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
#: What a Python worker remembers from task to task, by name: how to forget it.
CACHES: dict[str, Callable[[], None]] = {}


@lru_cache(maxsize=1)
def _trim():
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)  # of the GNU library only


def give_back(keep: str = "") -> None:
    """Forgets all ``CACHES`` but ``keep``, and returns to the system what Arrow and the C library hold of freed memory."""
    for name, forget in CACHES.items():
        if name != keep:
            forget()
    pa.default_memory_pool().release_unused()
    _trim()(0)


def lean(run: Run, keep: str = "") -> Run:
    """``run`` for mapInArrow, giving back memory at the start, after each batch and at the end.

    Workers outlive their tasks and share their executor's limit: what one keeps is missing in all later steps.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def fed() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch
                batch = None
                give_back(keep)

        give_back(keep)
        try:
            yield from run(fed())
        finally:
            give_back(keep)

    return whole


class Workspace:
    """Tables written to the shared folder and read back, which cuts lineage and survives lost executors.

    ``drop`` deletes a table that no later plan reads, to keep disk use down; ``close`` deletes all of them, and so has to
    wait until what was made from them is written. ``scratch`` does that for every workspace opened inside it.
    """

    _open: list[list[Workspace]] = []

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.count = 0
        if Workspace._open:
            Workspace._open[-1].append(self)

    def keep(self, df: DataFrame, name: str = "t", **options: str) -> DataFrame:
        path = self.path(name)
        df.write.options(**options).parquet(path)
        back = self.spark.read.schema(_nullable(df.schema)).parquet(path)
        back._logvista_path = path
        return back

    def path(self, name: str) -> str:
        self.count += 1
        return f"{self.root}/{self.count:03d}-{name}"

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            at, fs = _hadoop_path(self.spark, t._logvista_path)
            fs.delete(at, True)

    def close(self) -> None:
        at, fs = _hadoop_path(self.spark, self.root)
        fs.delete(at, True)


@contextmanager
def scratch() -> Iterator[None]:
    """Closes the workspaces that were opened inside, at the end, however that is reached."""
    Workspace._open.append([])
    try:
        yield
    finally:
        for w in Workspace._open.pop():
            w.close()


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column of ``df`` is called so (names compare without case, as in Spark)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def broadcast_if_small(df: DataFrame, most: int, most_bytes: int = 1 << 25) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``most`` rows of ``most_bytes`` together, as text; otherwise as it is, for an ordinary join."""
    if df.limit(most + 1).count() > most:
        return df
    size = df.agg(F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0)).alias("n")).first()["n"]
    return F.broadcast(df) if size <= most_bytes else df


def hot_keys(left: DataFrame, key: list[str], work: Workspace, share: int = 1000, least: int = 1000, counts: DataFrame | None = None) -> DataFrame | None:
    """Keys on more than 1/share of the rows (and more than ``least``), of which there are fewer than ``share``; None if there are none.

    ``counts`` are the numbers of rows by key (a column n_) if they are known.
    """
    rows = left.count() if counts is None else counts.agg(F.coalesce(F.sum("n_"), F.lit(0))).first()[0]
    if rows <= least:
        return None
    counts = left.groupBy(*key).agg(F.count("*").alias("n_")) if counts is None else counts
    hot = work.keep(counts.where(F.col("n_") > max(least, rows // share)).dropna(subset=key).select(*key), "hot")
    return None if hot.isEmpty() else hot


def join_split(left: DataFrame, right: DataFrame, key: list[str], work: Workspace, share: int = 1000, least: int = 1000, hot: DataFrame | None | str = "count") -> DataFrame:
    """``left`` joined with ``right``, which has one row a key, where ``left`` may hold one key very often. Null keys match nothing.

    Frequent keys (``hot_keys``, or ``hot`` if that is known) are so few that their rows of ``right`` are broadcast and the
    rows of ``left`` stay where they are. All others meet by a shuffle. ``left`` is read several times and should be a
    written table.
    """
    if isinstance(hot, str):
        hot = hot_keys(left, key, work, share, least)
    if hot is None:
        return left.join(right, key)
    hot = F.broadcast(hot)
    frequent = F.broadcast(work.keep(right.join(hot, key, "left_semi"), "frequent"))
    return left.join(frequent, key).unionByName(left.join(hot, key, "left_anti").join(right, key))


def likely(rows: DataFrame, wanted: DataFrame, column: str = "id") -> DataFrame:
    """Rows whose ``column`` may be among that of ``wanted``: all that are, and few others while ``wanted`` is not much larger than the map.

    The map of hashed values is broadcast in pieces of 4 KB; MAP_BITS bounds it.
    """
    bits = min(MAP_BITS, max(1 << 15, 1 << (16 * wanted.count()).bit_length()))
    place = F.pmod(F.xxhash64(column), F.lit(bits)) + 1
    maps = wanted.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("map"))
    bit = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("map", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    met = rows.join(F.broadcast(maps), F.bitmap_bucket_number(place) == F.col("piece"))
    return met.where(F.getbit(byte, (bit % 8).cast("int")) == 1).select(*rows.columns)
