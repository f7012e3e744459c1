"""Evaluation of detectors: features, metrics on tied scores, thresholds, and models of Spark ML."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .describe import top_k
from .sampling import quantiles, running, seeded


def drop_gaps(df: DataFrame, columns: list[str], label: str) -> tuple[DataFrame, dict]:
    """Rows that have all columns, and how the rate of the label differs between them and those dropped."""
    known = F.lit(True)
    for c in columns:
        known = known & F.col(c).isNotNull()
    r = df.agg(F.count_if(known).alias("kept"), F.count_if(~known).alias("dropped"), F.avg(F.when(known, F.col(label))).alias("rate_kept"), F.avg(F.when(~known, F.col(label))).alias("rate_dropped")).first()
    return df.where(known), r.asDict()


def before(df: DataFrame, time: str, cutoff: str) -> DataFrame:
    """Events before the evaluation ends."""
    return df.where(F.col(time) < F.lit(cutoff).cast("timestamp"))


def top_values(train: DataFrame, column: str, k: int = 10) -> list[str]:
    return [r[column] for r in top_k(train, column, k).collect()]  # k rows


def cap_category(column: str, known: list[str], other: str = "_other_") -> Column:
    return F.when(F.col(column).isin(known), F.col(column)).otherwise(F.lit(other))


def one_hot(df: DataFrame, column: str, known: list[str], other: str = "_other_") -> DataFrame:
    """A 0/1 column for each known value and the rest; the columns come from ``known``, so that all splits have the same."""
    capped = cap_category(column, known, other)
    return df.withColumns({f"{column}={v}": (capped == v).cast("int") for v in [*sorted(known), other]})


def class_weight(df: DataFrame, label: str) -> DataFrame:
    pos, neg = F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)
    return df.agg((neg / F.greatest(pos, F.lit(1))).alias("weight"))


# --- metrics: over distinct scores, so that ties fall together and what is ordered is as small as it can be


def cumulated(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """(s, p, n, tp, fp, positives, negatives), one row a distinct score; tp and fp count rows with at least that score."""
    g = df.groupBy(F.col(score).alias("s")).agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n"))
    g = running(g, F.desc("s"), {"tp": F.col("p"), "fp": F.col("n")})
    return g.crossJoin(F.broadcast(g.agg(F.sum("p").alias("positives"), F.sum("n").alias("negatives"))))  # one row


def roc_auc(c: DataFrame) -> DataFrame:
    """From ``cumulated``; null if one class is missing."""
    area = F.sum(F.col("n") * (F.col("tp") - F.col("p") / 2))
    return c.agg(F.when((F.max("positives") > 0) & (F.max("negatives") > 0), area / F.max(F.col("positives") * F.col("negatives"))).alias("roc_auc"))


def average_precision(c: DataFrame) -> DataFrame:
    """Steps of recall times precision; no interpolation."""
    return c.agg(F.when(F.max("positives") > 0, F.sum(F.col("p") / F.when(F.col("positives") > 0, F.col("positives")) * (F.col("tp") / (F.col("tp") + F.col("fp"))))).alias("average_precision"))


def best_threshold(c: DataFrame) -> DataFrame:
    """(threshold, f1): the largest F1 of score >= threshold over all scores, the lowest of equals."""
    f1 = 2 * F.col("tp") / (F.col("tp") + F.col("fp") + F.col("positives"))
    return c.select(F.col("s").alias("threshold"), f1.alias("f1")).orderBy(F.desc("f1"), "threshold").limit(1)


def matched_threshold(c: DataFrame, false_positives: int, low: int = 50, high: int = 999) -> DataFrame:
    """(threshold, fp): of .050, .051 … .999 the first whose number of false positives is nearest to the wanted one."""
    near = F.floor(F.col("s") * 1000 + 0.5)
    step = F.when(near / 1000 <= F.col("s"), near).otherwise(near - 1)  # the last threshold that the score reaches
    step = F.greatest(F.lit(low - 1), F.least(F.lit(high), step)).cast("long")
    steps = c.groupBy(step.alias("id")).agg(F.sum("n").alias("n"))  # as many rows as thresholds
    grid = c.sparkSession.range(low, high + 1).join(F.broadcast(steps), "id", "left")
    down = Window.orderBy(F.desc("id")).rowsBetween(Window.unboundedPreceding, 0)
    fp = grid.select((F.col("id") / 1000).alias("threshold"), F.coalesce(F.sum("n").over(down), F.lit(0)).alias("fp"))
    return fp.orderBy(F.abs(F.col("fp") - false_positives), "threshold").limit(1)


def metrics(df: DataFrame, threshold: float, score: str = "score", label: str = "label") -> DataFrame:
    """Precision, recall, F1 (0 where undefined), Brier, false positives a thousand, and the confusion."""
    hit, y = F.col(score) >= threshold, F.col(label) == 1
    t = df.agg(
        F.count_if(hit & y).alias("tp"), F.count_if(hit & ~y).alias("fp"), F.count_if(~hit & y).alias("fn"), F.count_if(~hit & ~y).alias("tn"),
        F.avg((F.col(score) - F.col(label)) * (F.col(score) - F.col(label))).alias("brier"), F.count("*").alias("rows"),
    )
    part = lambda a, b: F.when(b > 0, a / F.when(b > 0, b)).otherwise(0.0)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return t.select("tp", "fp", "fn", "tn", "brier", part(tp, tp + fp).alias("precision"), part(tp, tp + fn).alias("recall"), part(2 * tp, 2 * tp + fp + fn).alias("f1"), part(1000 * fp, F.col("rows")).alias("fp_per_1000"))


def roc_curve(c: DataFrame) -> DataFrame:
    return c.select(F.col("s").alias("threshold"), (F.col("fp") / F.col("negatives")).alias("fpr"), (F.col("tp") / F.col("positives")).alias("tpr"))


def pr_curve(c: DataFrame) -> DataFrame:
    return c.select(F.col("s").alias("threshold"), (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"), (F.col("tp") / F.col("positives")).alias("recall"))


def calibration(df: DataFrame, bins: int = 10, score: str = "score", label: str = "label") -> DataFrame:
    """(bin, mean_score, rate, rows) for bins between exact quantiles of the scores; a score on an edge belongs to the higher bin."""
    edges = sorted({e for e in quantiles(df, score, [i / bins for i in range(1, bins)]) if e is not None})
    d = df.withColumn("bin", F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: e <= F.col(score))) if edges else F.lit(0))
    return d.groupBy("bin").agg(F.avg(score).alias("mean_score"), F.avg(label).alias("rate"), F.count("*").alias("rows"))


def by_profile(df: DataFrame, profile: str, least: int = 10, score: str = "score", label: str = "label") -> DataFrame:
    """(profile, rows, positives, roc_auc) of profiles of at least ``least`` rows; the area is null for one class."""
    g = df.groupBy(profile, F.col(score).alias("s")).agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n"))
    g = g.withColumn("tp", F.sum("p").over(Window.partitionBy(profile).orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, 0)))
    t = g.groupBy(profile).agg(F.sum(F.col("p") + F.col("n")).alias("rows"), F.sum("p").alias("positives"), F.sum("n").alias("n_"), F.sum(F.col("n") * (F.col("tp") - F.col("p") / 2)).alias("area"))
    both = (F.col("positives") > 0) & (F.col("n_") > 0)
    return t.where(F.col("rows") >= least).select(profile, "rows", "positives", F.when(both, F.col("area") / F.when(both, F.col("positives") * F.col("n_"))).alias("roc_auc"))


# --- models


def classifiers(seed: int = 42) -> dict:
    """Estimators by name; the boosted trees stand in for other libraries' and are a different algorithm."""
    from pyspark.ml import classification as C

    common = {"featuresCol": "features", "labelCol": "label", "weightCol": "weight"}
    return {
        "logistic_regression": C.LogisticRegression(maxIter=1000, **common), "decision_tree": C.DecisionTreeClassifier(maxDepth=8, seed=seed, **common),
        "random_forest": C.RandomForestClassifier(numTrees=200, maxDepth=10, seed=seed, **common), "gradient_boosting": C.GBTClassifier(maxIter=50, maxDepth=6, seed=seed, **common),
    }


def assemble(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """``features``, ``label`` and balanced ``weight``; nulls count as 0."""
    from pyspark.ml.feature import VectorAssembler

    d = df.select("*", *(F.col(f"`{c}`").cast("double").alias(f"x_{i}") for i, c in enumerate(columns))).fillna(0.0, [f"x_{i}" for i in range(len(columns))])
    d = VectorAssembler(inputCols=[f"x_{i}" for i in range(len(columns))], outputCol="features").transform(d).drop(*(f"x_{i}" for i in range(len(columns))))
    r = df.agg(F.count_if(F.col(label) == 1).alias("p"), F.count("*").alias("n")).first()
    p, n = max(1, r["p"]), max(1, r["n"])
    return d.withColumn("label", F.col(label).cast("double")).withColumn("weight", F.when(F.col("label") == 1, n / 2 / p).otherwise(n / 2 / max(1, n - p)))


def scored(model, df: DataFrame) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    return model.transform(df).withColumn("score", vector_to_array("probability")[1])


def importances(model, columns: list[str], k: int = 15) -> list[tuple[str, float]]:
    values = model.featureImportances if hasattr(model, "featureImportances") else [abs(c) for c in model.coefficients]
    return sorted(zip(columns, map(float, values), strict=True), key=lambda t: (-t[1], t[0]))[:k]


def evaluate(model, validation: DataFrame, test: DataFrame) -> dict:
    """Metrics on test at the threshold that is best on validation."""
    t = best_threshold(cumulated(scored(model, validation))).first()
    s = scored(model, test).select("score", "label").persist()
    c = cumulated(s)
    out = {"threshold": t["threshold"], **roc_auc(c).first().asDict(), **average_precision(c).first().asDict(), **metrics(s, t["threshold"]).first().asDict()}
    s.unpersist()
    return out


def benchmark(train: DataFrame, validation: DataFrame, test: DataFrame, columns: list[str], label: str, models: dict | None = None) -> dict[str, dict]:
    parts = [assemble(d, columns, label).persist() for d in (train, validation, test)]
    out = {name: evaluate(est.fit(parts[0]), *parts[1:]) for name, est in (models or classifiers()).items()}
    for p in parts:
        p.unpersist()
    return out


def ablation(train: DataFrame, validation: DataFrame, test: DataFrame, groups: dict[str, list[str]], label: str, model) -> dict[str, dict]:
    """The same model on growing sets of columns: each group adds its columns to those before, repeated ones once."""
    out, columns = {}, []
    for name, more in groups.items():
        columns = list(dict.fromkeys([*columns, *more]))
        out[name] = benchmark(train, validation, test, columns, label, {name: model})[name] | {"columns": len(columns)}
    return out


def search(train: DataFrame, validation: DataFrame, columns: list[str], label: str, estimator, grid: list[dict]) -> tuple[dict, float]:
    """The parameters with the largest area on validation, and that area; a grid, since Spark has no adaptive search."""
    a, b = (assemble(d, columns, label).persist() for d in (train, validation))
    found = []
    for g in grid:
        params = {estimator.getParam(k): v for k, v in g.items()}
        area = roc_auc(cumulated(scored(estimator.copy(params).fit(a), b))).first()["roc_auc"]
        found.append((-(area or 0), len(found), g))
    a.unpersist(), b.unpersist()
    area, _, best = min(found)
    return best, -area


def early_stopping(train: DataFrame, validation: DataFrame, columns: list[str], label: str, rounds: int = 2000, patience: int = 30, step: int = 30, seed: int = 42) -> dict:
    """Boosted trees that stop once the area on validation has not risen for ``patience`` rounds: model, best_round, area.

    Rounds are added ``step`` at a time, by a model of that many more; with one seed the first trees of a longer model are
    those of a shorter one, so that the area after every round is read off the longest. Its trees after the best are left out
    of the score.
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import vector_to_array

    a, b = (assemble(d, columns, label).persist() for d in (train, validation))
    best, n = (-1.0, 0), 0
    while n < rounds:
        n = min(rounds, n + step)
        model = GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight", maxIter=n, maxDepth=6, seed=seed).fit(a)
        for i in range(best[1] if best[1] == 0 else n - step, n):
            part = _first_trees(model, i + 1).transform(b).withColumn("score", vector_to_array("rawPrediction")[1])
            area = roc_auc(cumulated(part)).first()["roc_auc"] or 0.0
            if area > best[0]:
                best = (area, i + 1)
            if i + 1 - best[1] >= patience:
                break
        if n - best[1] >= patience:
            break
    a.unpersist(), b.unpersist()
    return {"model": _first_trees(model, best[1]), "best_round": best[1], "roc_auc": best[0]}


def _first_trees(model, n: int):
    """The boosted model of the first n trees."""
    from pyspark import SparkContext
    from pyspark.ml.classification import GBTClassificationModel

    java, context = model._java_obj, SparkContext._active_spark_context
    ml = context._jvm.org.apache.spark.ml
    trees = context._gateway.new_array(ml.regression.DecisionTreeRegressionModel, n)
    weights = context._gateway.new_array(context._jvm.double, n)
    for i, (tree, weight) in enumerate(zip(java.trees()[:n], list(java.treeWeights())[:n], strict=True)):
        trees[i], weights[i] = tree, weight
    return GBTClassificationModel(ml.classification.GBTClassificationModel(java.uid(), trees, weights, java.numFeatures(), 2))


def gains(before: dict[str, dict], after: dict[str, dict], metric: str = "roc_auc") -> list[tuple[str, float, float, float]]:
    return [(k, before[k][metric], after[k][metric], after[k][metric] - before[k][metric]) for k in before if k in after]


# --- isolation forest, which Spark ML lacks


def _path(n: float) -> float:
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


@dataclass
class IsolationForest:
    """Trees grown on small seeded samples; a score near 1 is easy to isolate."""

    trees: list[tuple]
    size: int

    @staticmethod
    def fit(x: np.ndarray, trees: int = 200, size: int = 256, seed: int = 42) -> IsolationForest:
        rng = np.random.default_rng(seed)
        size = min(size, len(x))
        limit = int(np.ceil(np.log2(max(2, size))))

        def grow(rows: np.ndarray, depth: int):
            spread = np.flatnonzero(rows.max(axis=0) > rows.min(axis=0)) if len(rows) > 1 else np.zeros(0, int)
            if depth >= limit or not len(spread):
                return depth + _path(len(rows))
            j = int(rng.choice(spread))
            cut = float(rng.uniform(rows[:, j].min(), rows[:, j].max()))
            left = rows[:, j] < cut
            return j, cut, grow(rows[left], depth + 1), grow(rows[~left], depth + 1)

        own = len(x) >= trees * size  # rows of its own for every tree, or a draw for each
        rows = lambda i: x[i * size : (i + 1) * size] if own else x[rng.choice(len(x), size, replace=False)]
        return IsolationForest([grow(rows(i), 0) for i in range(trees)], size)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))

        def walk(node, rows: np.ndarray) -> None:
            if not len(rows):
                return
            if isinstance(node, tuple):
                j, cut, low, high = node
                left = x[rows, j] < cut
                walk(low, rows[left])
                walk(high, rows[~left])
            else:
                total[rows] += node

        for t in self.trees:
            walk(t, np.arange(len(x)))
        return 2.0 ** (-total / len(self.trees) / max(_path(self.size), 1e-9))


def isolation_scores(train: DataFrame, test: DataFrame, columns: list[str], key: str, trees: int = 200, size: int = 256, seed: int = 42) -> DataFrame:
    """``test`` with ``score``. Each tree grows on its own ``size`` rows, drawn from all rows of ``train`` by a seeded hash of ``key``.

    The trees * size rows of smallest hash come to the driver, whatever the layout of the table.
    """
    numeric = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns]
    order = seeded(key, seed)
    x = train.select(*numeric, order.alias("order_")).orderBy("order_").limit(trees * size).drop("order_").toPandas().to_numpy()
    forest = IsolationForest.fit(x, trees=trees, size=size, seed=seed)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            yield p.assign(score=forest.score(p[columns].fillna(0).astype(float).to_numpy()))

    from pyspark.sql import types as T

    return test.mapInPandas(run, T.StructType([*test.schema.fields, T.StructField("score", T.DoubleType())]))


def scale_by(df: DataFrame, reference: DataFrame, column: str) -> DataFrame:
    """``column`` scaled to [0, 1] by the range in ``reference``, clipped."""
    from ..functions.scalar import min_max

    r = reference.agg(F.min(column).alias("low_"), F.max(column).alias("high_"))
    return df.crossJoin(F.broadcast(r)).withColumn(column, min_max(F.col(column), F.col("low_"), F.col("high_"))).drop("low_", "high_")
