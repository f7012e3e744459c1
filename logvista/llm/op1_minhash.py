"""Near-duplicate detection with circulant MinHash.

Two bijections of the 32-bit ring take the place of the two permutations: the first scatters the shingles of a text, the
second gives coordinate k after the scattered values were shifted round the ring by k. So one pass of shift, mix and
minimum per coordinate yields the signature, without a family of K hash functions.

Bands of the signature propose pairs; each pair is settled on the full shingle sets, whose words are compared byte by byte
wherever hashes agree. A bucket is never expanded into all its pairs: its members are compared with one pivot in each of some rounds, as long as that connects many of them, and only
members that are in different components even then are compared with each other. Before a pair is made, set sizes and one bit
of each coordinate have to allow the similarity, with a margin of ``MARGIN`` deviations; in the last round that is done
with ``FINE`` coordinates, in the first bucket that the two share, and in blocks of ``BLOCK`` members.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textbytes as tb
from .components import connected_components
from .shared import SLICE_BYTES, Workspace, free_name, hot_keys, join_split, lean, likely, read_table

#: Bands and rows of each: a pair at similarity 0.8 is missed with probability (1 - 0.8^7)^64, which is 3e-7.
BANDS, ROWS = 64, 7
#: Deviations by which a pair's estimate may fall short: passed by a pair at the threshold but for 2 in 100 million.
MARGIN = 5.5
#: Coordinates of which a bit is kept for the last round.
FINE = 4096
#: Members of a bucket that meet in one task in the last round; texts of a task that makes sketches for it.
BLOCK, TEXTS = 4096, 500
#: Rounds of pivots at most; what they leave is compared in full.
ROUNDS = 8
#: Rows of a few numbers that one task takes in its stride (some megabytes): a bucket or component of fewer is not set apart.
NARROW = 100_000


def signatures(shingle_hashes: np.ndarray, bounds: np.ndarray, n: int) -> np.ndarray:
    """(n, texts) minima; coordinate k is the minimum of the second permutation shifted by k. Each text needs a shingle."""
    y = tb.mix64(shingle_hashes ^ np.uint64(0x243F6A8885A308D3)).astype(np.uint32)  # first permutation, on the ring
    out = np.empty((n, len(bounds) - 1), np.uint32)
    z, t = np.empty_like(y), np.empty_like(y)
    for k in range(n):
        np.subtract(y, np.uint32(k), out=z)
        np.multiply(z, np.uint32(0x9E3779B1), out=z)
        np.right_shift(z, np.uint32(15), out=t)
        np.bitwise_xor(z, t, out=z)
        np.multiply(z, np.uint32(0x85EBCA77), out=z)
        np.right_shift(z, np.uint32(13), out=t)
        np.bitwise_xor(z, t, out=z)
        np.minimum.reduceat(z, bounds[:-1], out=out[k])
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(texts, bands) 64-bit bucket keys; equal only for equal coordinates in the same band."""
    out = np.empty((signature.shape[1], bands), np.int64)
    for b in range(bands):
        h = np.full(signature.shape[1], b + 1, np.uint64)
        for r in range(rows):
            h = tb.mix64(h * np.uint64(0x9E3779B97F4A7C15) + signature[b * rows + r].astype(np.uint64))
        out[:, b] = h.view(np.int64)
    return out


def low_bits(signature: np.ndarray) -> np.ndarray:
    """(texts, longs): the lowest bit of every coordinate, in 64-bit words, the last one filled up with zeros."""
    packed = np.packbits((signature & 1).astype(np.uint8).T, axis=1)
    return np.ascontiguousarray(np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8)))).view(np.int64)


def _sketch(k: int, bands: int, rows: int):
    """Of rows (row, id, text), (row, id, n, s1, s2, bands, bits)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, bounds in tb.slices(batch, "text", SLICE_BYTES):
                s = tb.Shingles(data, bounds, k)
                n, digest = s.tally()[:, 1], tb.sequence_digests(data, bounds)
                keys = np.zeros((to - at, bands), np.int64)
                bits = np.zeros((to - at, -(-bands * rows // 64)), np.int64)
                if (some := n > 0).any():
                    signature = signatures(s.hashes, np.append(s.bounds[:-1][some], len(s.hashes)), bands * rows)
                    keys[some], bits[some] = band_keys(signature, bands, rows), low_bits(signature)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(at, to - at) for c in ("row", "id")), pa.array(n), pa.array(digest[:, 0]), pa.array(digest[:, 1]),
                        *(pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel())) for x in (keys, bits)),
                    ],
                    names=["row", "id", "n", "s1", "s2", "bands", "bits"],
                )

    return run


def _fine(k: int):
    """Of rows (id, text), (id, fine): a bit of each of ``FINE`` coordinates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, bounds in tb.slices(batch, "text", SLICE_BYTES):
                s = tb.Shingles(data, bounds, k)
                bits = low_bits(signatures(s.hashes, s.bounds, FINE))  # texts of pairs have shingles
                lists = pa.ListArray.from_arrays(np.arange(0, bits.size + 1, bits.shape[1], dtype=np.int32), pa.array(bits.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(at, to - at), lists], names=["id", "fine"])

    return run


def most_differing(percent: int, n: int) -> int:
    """Differing bits of n that a pair at the threshold exceeds with the probability of ``MARGIN`` deviations."""
    agree = (1 + percent / 100) / 2
    return int(n * (1 - agree + MARGIN * math.sqrt(agree * (1 - agree) / n)))


def near_enough(bits: str, n: int, percent: int) -> F.Column:
    """Whether sizes (n_a, n_b) and sketches (``bits``_a, ``bits``_b) allow two sets to be similar enough."""
    sizes = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    differ = F.lit(0)
    for i in range(-(-n // 64)):
        differ = differ + F.bit_count(F.col(f"{bits}_a")[i].bitwiseXOR(F.col(f"{bits}_b")[i]))
    return sizes & (differ <= most_differing(percent, n))


def _settle(k: int, numerator: int, denominator: int):
    """Of rows (a, b, text_a, text_b), the pairs whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            turn = np.arange(2 * batch.num_rows).reshape(2, -1).T.ravel()  # the two texts of a pair beside each other
            both = pa.concat_arrays([batch.column(c).cast(pa.large_string()) for c in ("text_a", "text_b")]).take(pa.array(turn))
            keep = np.zeros(batch.num_rows, bool)
            for at, to, data, bounds in tb.slices(pa.RecordBatch.from_arrays([both], names=["text"]), "text", SLICE_BYTES, 2):
                n = tb.Shingles(data, bounds, k).tally(2)
                keep[at // 2 : to // 2] = denominator * n[:, 3] >= numerator * n[:, 1:].sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep)) for c in ("a", "b")], names=["a", "b"])

    return run


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80,
    bands: int = BANDS, rows: int = ROWS,
) -> DataFrame:
    """One row a document: (id_col, n_shingles, component_id, kept).

    Words end at ASCII white space and are compared after lower-casing A-Z; the set of a text is its distinct runs of k
    words, or the whole sequence if it has fewer. Two texts are linked if 100 * |intersection| >= percent * |union|.
    ``component_id`` is the smallest id that can be reached over links, and ``kept`` whether it is the row's own. Null and
    empty texts and those of white space have n_shingles 0 and are linked with nothing. Rows are told apart by a number and
    not by their id: repeated rows of one id get a row each, and different texts of one id are linked each on its own. A
    row without id is linked with nothing (component_id null, kept). Further columns of ``docs`` are not read. Copies of a
    word sequence share one representative, so that a large group of copies costs as much as one text; nothing else is
    merged or capped.
    """
    work = Workspace(docs.sparkSession, "near")
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.monotonically_increasing_id().alias("row"))
    found = _components(work.keep(own, "rows"), work, k, percent, bands, rows)
    component = F.coalesce("first.id", "id")
    return found.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def _components(own: DataFrame, work: Workspace, k: int, percent: int, bands: int, rows: int) -> DataFrame:
    """Of (row, id, text), (row, id, n, first): ``first`` is the component's smallest (id, row), null for what can't be linked.

    Wherever rows meet by a key that many may share (a word sequence, a bucket, a component), ``join_split`` keeps frequent
    keys out of the shuffle; for rows of a few numbers that takes ``NARROW`` of one key to be worth the passes.
    """
    pair_schema = "a long, b long"
    sketch = work.keep(
        own.mapInArrow(lean(_sketch(k, bands, rows)), "row long, id long, n long, s1 long, s2 long, bands array<long>, bits array<long>"), "sketch"
    )
    full = "n > 0 and id is not null"
    first = work.keep(sketch.where(full).groupBy("s1", "s2").agg(F.min(F.struct("id", "row")).alias("rep")), "first")
    first_ = F.col("row") == F.col("rep.row")
    placed = join_split(sketch.where(full), first, ["s1", "s2"], work).select(
        "row", "id", "n", "rep", F.when(first_, F.col("bands")).alias("bands"), F.when(first_, F.col("bits")).alias("bits")
    )
    placed = work.keep(placed, "members")
    alone = work.keep(sketch.where(f"not ({full})").select("row", "id", "n"), "alone")
    members = placed.select("row", "id", "n", "rep")
    work.drop(sketch, first)
    # From here on a text is known by the row that represents it.
    texts_of = placed.where("bands is not null").select(F.col("row").alias("id"), "n", "bands", "bits")
    rows_ = texts_of.select("id", F.explode("bands").alias("key"))
    sizes = work.keep(rows_.groupBy("key").agg(F.count("*").alias("n_")).where("n_ > 1"), "sizes")
    hot = hot_keys(sizes, ["key"], work, least=NARROW, counts=sizes)
    rows_ = work.keep(likely(rows_, sizes, "key"), "keys")  # most buckets have one text and are met by none of these
    shared = work.keep(join_split(rows_, sizes.withColumnRenamed("n_", "size"), ["key"], work, hot=hot), "buckets")  # buckets of several texts only
    degree = shared.groupBy("id").agg(F.sum("size").alias("degree"))
    shared = work.keep(shared.select("id", "key").join(degree, "id"), "degrees")

    def side(x: str) -> DataFrame:
        return texts_of.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}"))

    def paired(pairs: DataFrame, of) -> DataFrame:
        """Pairs with what ``of`` tells of each; a pivot is in very many pairs. Nothing is joined twice for that."""
        hot = hot_keys(pairs, ["a"], work)
        half = join_split(pairs, of("b"), ["b"], work)
        half = half if hot is None else work.keep(half, "half")
        return join_split(half, of("a"), ["a"], work, hot=hot)

    needed = work.keep(shared.select("id").distinct(), "needed")
    texts = likely(own.select(F.col("row").alias("id"), "text"), needed).join(needed, "id")  # no semi-join, which Spark would do before the map
    texts = work.keep(texts, "texts")

    def settled(p: DataFrame, name: str) -> DataFrame:
        two = paired(p, lambda x: texts.select(F.col("id").alias(x), F.col("text").alias(f"text_{x}")))
        return work.keep(two.select("a", "b", "text_a", "text_b").mapInArrow(lean(_settle(k, percent, 100)), pair_schema), name)

    # Each round compares the members of a bucket with one pivot that is not yet connected with them: the text that has most
    # neighbours in all its buckets, then the next one, so that the same few texts are pivots of most buckets.
    none = work.spark.createDataFrame([], pair_schema)
    tried, links, placed, last, open_ids = none, none, shared.withColumn("root", F.col("id")), None, 0
    for _ in range(ROUNDS):
        top = F.struct("degree", "id", "root")
        left = placed if last is None else join_split(placed, last, ["key"], work, least=NARROW).where(F.struct("degree", "id") < F.struct("top.degree", "top.id")).drop("top")
        pivots = work.keep(left.groupBy("key").agg(F.max(top).alias("top")), "pivots")
        last = pivots if last is None else work.keep(pivots.unionByName(last.join(pivots, "key", "left_anti")), "last")
        pairs = join_split(placed, pivots, ["key"], work, least=NARROW).where(F.col("root") != F.col("top.root"))
        pairs = pairs.select(F.least("id", "top.id").alias("a"), F.greatest("id", "top.id").alias("b")).distinct().join(tried, ["a", "b"], "left_anti")
        pairs = work.keep(pairs, "proposed")
        tried = work.keep(tried.unionByName(pairs), "tried")
        more = settled(work.keep(paired(pairs, side).where(near_enough("bits", bands * rows, percent)).select("a", "b"), "pairs"), "more")
        found = more.count()
        if last is not pivots and not found:
            break
        links = work.keep(links.unionByName(more), "links")
        roots = work.keep(connected_components(links, work), "roots")
        # What is left are the buckets whose members are not yet all connected.
        placed = shared.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
        placed = work.keep(placed, "rooted")
        open_ = placed.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.ceil(F.count("*") / BLOCK).alias("blocks")).where("r0 < r1")
        open_ = work.keep(open_.select("key", "blocks"), "open")
        placed = work.keep(join_split(placed, open_, ["key"], work, least=NARROW), "open")
        unsettled = work.keep(placed.select("id").distinct(), "unsettled")
        open_ids = unsettled.count()
        if found * 50 < open_ids or not open_ids:
            break
    # The rest: each member with every member of another component, once in all buckets.
    if open_ids:
        about = texts_of.select("id", "n", F.transform("bands", lambda x: x.bitwiseAND(F.lit((1 << 31) - 1)).cast("int")).alias("marks"), "bands")
        tasks = max(1, -(-open_ids // TEXTS))
        fine = texts.join(unsettled, "id").repartition(tasks, "id").mapInArrow(lean(_fine(k)), "id long, fine array<long>")
        about = work.keep(about.join(fine, "id"), "sketches")
        placed = placed.drop("degree").join(about, "id").withColumn("nth", F.array_position("bands", F.col("key"))).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
        placed = work.keep(placed.drop("bands"), "open")
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))  # a block meets each block; a bucket of up to BLOCK members is one
        left = placed.withColumn("block_b", other).withColumnRenamed("block", "block_a")
        right = placed.withColumn("block_a", other).withColumnRenamed("block", "block_b")
        left, right = (d.select("key", "block_a", "block_b", "nth", *(F.col(c).alias(f"{c}_{x}") for c in ("id", "root", "n", "marks", "fine"))) for d, x in ((left, "a"), (right, "b")))
        first_shared = F.array_position(F.zip_with("marks_a", "marks_b", lambda x, y: x == y), True) == left["nth"]
        same = (left["key"] == right["key"]) & (left["block_a"] == right["block_a"]) & (left["block_b"] == right["block_b"])
        apart = same & (F.col("id_a") < F.col("id_b")) & (F.col("root_a") != F.col("root_b"))
        rest = left.join(right, apart & near_enough("fine", FINE, percent) & first_shared)
        rest = rest.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).join(tried, ["a", "b"], "left_anti")
        more = settled(work.keep(rest, "rest"), "more")
        if not more.isEmpty():
            roots = work.keep(connected_components(links.union(more), work), "roots")
    firsts = members.where("row = rep.row").select(F.col("row").alias("node"), "rep")
    firsts = work.keep(roots.join(firsts, "node").groupBy("root").agg(F.min("rep").alias("first")), "firsts")
    linked = work.keep(join_split(roots, firsts, ["root"], work, least=NARROW).select("node", "first"), "linked")
    single = members.select(F.col("rep.row").alias("node")).distinct().join(linked, "node", "left_anti").select("node", F.lit(None).cast(linked.schema["first"].dataType).alias("first"))
    every = work.keep(linked.unionByName(single), "every")
    out = join_split(members.withColumn("node", F.col("rep.row")), every, ["node"], work)
    none = alone.select("row", "id", "n", F.lit(None).cast(linked.schema["first"].dataType).alias("first"))
    return out.select("row", "id", "n", F.coalesce("first", "rep").alias("first")).unionByName(none)


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80,
    bands: int = BANDS, rows: int = ROWS,
) -> DataFrame:
    """The rows of ``docs``, with all their columns, that no other row of their component comes before: of each component of
    ``near_duplicates`` one row with the smallest id, and all rows that can't be linked.
    """
    work = Workspace(docs.sparkSession, "near")
    row, gone = (free_name(docs, n) for n in ("row", "gone"))
    whole = work.keep(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    own = whole.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.col(row).alias("row"))
    found = _components(own, work, k, percent, bands, rows).where("row <> first.row").select(F.col("row").alias(gone))
    return whole.join(found, F.col(row) == F.col(gone), "left_anti").drop(row)


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), k=4)
