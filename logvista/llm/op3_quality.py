"""Text quality by a generalised additive model with pairwise interactions.

A text becomes a few dozen measures of form (shares of character classes, repetition, shape of words and lines), none of
which depends on a language. Each measure is binned by quantiles of the training rows. Boosting visits the features in
turn, each time fitting a shallow tree on one feature's bins to what is left, and adds it to that feature's table; after
the single features, the pairs whose grid explains most of the rest are visited in the same way. What is learned is a table
for each feature and each pair, so that scoring is a sum of table look-ups over whole batches.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textbytes as tb
from .shared import lean, read_table

#: Labelled rows that are learned from, at most: those with the smallest hash of their id.
SAMPLE = 20_000

_B = np.arange(256)
_CLASSES = {
    "upper": (_B >= 0x41) & (_B <= 0x5A), "lower": (_B >= 0x61) & (_B <= 0x7A), "digit": (_B >= 0x30) & (_B <= 0x39), "high": _B >= 0x80,
    "line": _B == 0x0A, "blank": (_B == 0x20) | (_B == 0x09), "control": (_B < 0x20) & ~tb.SPACE, "stop": np.isin(_B, list(b".!?")), "comma": np.isin(_B, list(b",;:")),
    "quote": np.isin(_B, list(b"\"'`")), "bracket": np.isin(_B, list(b"()[]{}<>")), "shout": _B == 0x21, "bar": _B == 0x7C, "symbol": np.isin(_B, list(b"#$%&*+/=@\\^_~-")),
}
_CLASS_OF = np.zeros(256, np.int64)
for _i, _m in enumerate(_CLASSES.values()):
    _CLASS_OF[_m & (_CLASS_OF == 0)] = _i + 1  # the first class that fits
_N = len(_CLASSES) + 1
FEATURES = [
    *_CLASSES, "log_words", "mean_word", "long_words", "distinct_words", "top_word", "same_as_previous", "same_as_one_before", "distinct_lines", "mean_line", "distinct_pairs",
    "symbol_words",
]


def measures(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(texts, features); an empty text has zeros."""
    texts = len(bounds) - 1
    size = np.diff(bounds)
    cls = _CLASS_OF[data]
    owner = np.repeat(np.arange(texts), size)
    counts = np.bincount(owner * _N + cls, minlength=texts * _N).reshape(texts, _N)
    share = counts[:, 1:] / np.maximum(1, size)[:, None]
    start, end, per_text = tb.word_spans(data, bounds)
    h = tb.span_hashes(tb._BYTE[data], start, end)
    m = np.diff(per_text)
    at_least = np.maximum(1, m)
    of = np.repeat(np.arange(texts), m)
    length = end - start
    wrong = np.isin(cls, [list(_CLASSES).index(c) + 1 for c in ("shout", "bar", "symbol", "bracket", "control")])
    bad = np.concatenate([[0], np.cumsum(wrong)])
    marked = bad[end] > bad[start]

    def repeats(gap: int) -> np.ndarray:
        same = (h[gap:] == h[:-gap]) & (of[gap:] == of[:-gap]) if len(h) > gap else np.zeros(0, bool)
        return np.bincount(of[gap:][same], minlength=texts) / at_least

    def distinct(values: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct values and the largest count of one, by text."""
        order = np.lexsort((values, owners))
        v, o = values[order], owners[order]
        new = np.ones(len(v), bool)
        new[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
        first = np.flatnonzero(new)
        top = np.zeros(texts, np.int64)
        np.maximum.at(top, o[first], np.diff(np.append(first, len(v))))
        return np.bincount(o[first], minlength=texts), top

    kinds, top = distinct(h, of)
    follows = of[1:] == of[:-1]
    pairs, _ = distinct((tb.mix64(h[:-1]) + h[1:])[follows], of[1:][follows])
    l_start, l_end, l_text = tb.word_spans(data, bounds, _B == 0x0A)
    lines = np.diff(l_text)
    l_kinds, _ = distinct(tb.span_hashes(tb._BYTE[data], l_start, l_end), np.repeat(np.arange(texts), lines))
    mean = lambda x: np.bincount(of, x, minlength=texts) / at_least
    columns = [
        *share.T, np.log1p(m), mean(length), mean(length > 12), kinds / at_least, top / at_least, repeats(1), repeats(2), l_kinds / np.maximum(1, lines),
        size / np.maximum(1, lines), pairs / np.maximum(1, m - 1), mean(marked),
    ]
    return np.stack(columns, axis=1).astype(np.float64)


@dataclass
class Additive:
    """intercept + the sum of the features' tables + the sum of the pairs' tables, as log odds of label 1."""

    edges: list[np.ndarray]
    intercept: float
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    grids: list[np.ndarray]

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)], axis=1)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        out = np.full(len(x), self.intercept)
        for j, t in enumerate(self.tables):
            out += t[b[:, j]]
        for (i, j), g in zip(self.pairs, self.grids, strict=True):
            out += g[b[:, i], b[:, j]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(x), -30, 30)))


def _tree(gradient: np.ndarray, weight: np.ndarray, leaves: int, l2: float) -> np.ndarray:
    """A tree of up to ``leaves`` leaves over ordered bins: each bin's value (a Newton step)."""
    cuts = [(0, len(gradient))]
    g, w = np.concatenate([[0], np.cumsum(gradient)]), np.concatenate([[0], np.cumsum(weight)])
    gain_of = lambda a, b: (g[b] - g[a]) ** 2 / (w[b] - w[a] + l2)
    while len(cuts) < leaves:
        best = (1e-9, None, None)
        for k, (a, b) in enumerate(cuts):
            if b - a > 1:
                c = np.arange(a + 1, b)
                gain = gain_of(a, c) + gain_of(c, b) - gain_of(a, b)
                i = int(np.argmax(gain))
                best = max(best, (float(gain[i]), k, int(c[i])), key=lambda t: t[0])
        if best[1] is None:
            break
        a, b = cuts.pop(best[1])
        cuts += [(a, best[2]), (best[2], b)]
    out = np.zeros(len(gradient))
    for a, b in cuts:
        out[a:b] = (g[b] - g[a]) / (w[b] - w[a] + l2)
    return out


def _grid(gradient: np.ndarray, weight: np.ndarray, l2: float) -> tuple[np.ndarray, float]:
    """The best tree of depth two over two features' bins, one split on each: its values and its gain."""
    g, w = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (gradient, weight))

    def quarters(c):
        tl, t, left, all_ = c[1:-1, 1:-1], c[1:-1, -1:], c[-1:, 1:-1], c[-1, -1]
        return tl, t - tl, left - tl, all_ - t - left + tl

    qs = list(zip(quarters(g), quarters(w), strict=True))
    out = np.zeros_like(gradient)
    if not qs[0][0].size:
        return out, 0.0
    gain = sum(a**2 / (b + l2) for a, b in qs)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    for part, (a, b) in zip(((slice(i + 1), slice(j + 1)), (slice(i + 1), slice(j + 1, None)), (slice(i + 1, None), slice(j + 1)), (slice(i + 1, None), slice(j + 1, None))), qs, strict=True):
        out[part] = a[i, j] / (b[i, j] + l2)
    return out, float(gain[i, j])


def fit(x: np.ndarray, y: np.ndarray, bins: int = 64, rounds: int = 150, rate: float = 0.1, leaves: int = 3, n_pairs: int = 8, pair_rounds: int = 40, l2: float = 2.0) -> Additive:
    """Cyclic boosting of log loss. With one class only (or no rows) the model is its rate, drawn towards a half."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0) for j in range(x.shape[1])]
    p = (y.sum() + 1) / (len(y) + 2)
    model = Additive(edges, float(np.log(p / (1 - p))), [np.zeros(len(e) + 1) for e in edges], [], [])
    if not 0 < y.sum() < len(y):
        return model
    b = model.bins(x)
    f = np.full(len(y), model.intercept)
    prob = lambda: 1 / (1 + np.exp(-f))
    for _ in range(rounds):
        for j, t in enumerate(model.tables):
            if len(t) > 1:
                q = prob()
                step = rate * _tree(np.bincount(b[:, j], y - q, len(t)), np.bincount(b[:, j], q * (1 - q), len(t)), leaves, l2)
                t += step
                f += step[b[:, j]]
    shape = [len(t) for t in model.tables]
    cell = lambda i, j: b[:, i] * shape[j] + b[:, j]

    def sums(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        q, c, n = prob(), cell(i, j), shape[i] * shape[j]
        return np.bincount(c, y - q, n).reshape(shape[i], shape[j]), np.bincount(c, q * (1 - q), n).reshape(shape[i], shape[j])

    found = sorted(((-_grid(*sums(i, j), l2)[1], i, j) for i, j in itertools.combinations(range(len(shape)), 2)))[:n_pairs]
    model.pairs = [(i, j) for _, i, j in found]
    model.grids = [np.zeros((shape[i], shape[j])) for i, j in model.pairs]
    for _ in range(pair_rounds):
        for (i, j), grid in zip(model.pairs, model.grids, strict=True):
            step = rate * _grid(*sums(i, j), l2)[0]
            grid += step
            f += step[b[:, i], b[:, j]]
    return model


def is_held_out(id_) -> F.Column:
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _rows(score: Additive | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, bounds in tb.slices(batch, "text", 1 << 20):
                x = measures(data, bounds)
                other = [batch.column(i).slice(at, to - at) for i in range(batch.num_columns) if batch.schema.names[i] != "text"]
                names = [c for c in batch.schema.names if c != "text"]
                out = pa.array(score.score(x)) if score else pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*other, out], names=[*names, "out"])

    return run


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Additive:
    """A model of ``label_col``, from at most ``sample`` labelled texts whose id is not held out (see ``is_held_out``).

    Labels other than 0 and 1 and rows without id are left out; of labels that contradict each other for one id, 1 counts.
    Of an id that stands on several rows the text with the smallest hash counts, so that no more than ``sample`` rows reach
    the driver. Null texts count as empty and long ones are read whole. Without labels the model says a half for every text.
    """
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("double").alias("y")).where("id is not null and y in (0, 1)")
    known = known.where(~is_held_out(F.col("id"))).groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(sample)
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    own = own.join(F.broadcast(known), "id").groupBy("id", "y").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    rows = own.mapInArrow(lean(_rows(None)), "id long, y double, out array<double>")  # ``sample`` rows at most
    got = rows.orderBy("id").toPandas()
    x = np.array(got["out"].tolist(), np.float64).reshape(-1, len(FEATURES))
    return fit(x, got["y"].to_numpy())


def classify(docs: DataFrame, model: Additive, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a row: (id_col, held_out, score, predicted). Only the text enters the score, null as empty, and long ones whole.

    Repeated rows get a row each; a row without id is not held out. Other columns are not read; an empty table gives no rows.
    """
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    scored = own.mapInArrow(lean(_rows(model)), "id long, out double")
    return scored.select(F.col("id").alias(id_col), is_held_out(F.col("id")).alias("held_out"), F.col("out").alias("score"), (F.col("out") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Additive, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, that the model does not reject (score of at least a half).

    Each row is judged for itself by its text alone, null as empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, bounds in tb.slices(batch, text_col, 1 << 20):
                yield batch.slice(at, to - at).filter(pa.array(model.score(measures(data, bounds)) >= 0.5))

    return docs.mapInArrow(lean(run), docs.schema)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return classify(docs, learn(docs, read_table(spark, sf_dir, "labels")))
