"""Inferential statistics: counts and ranks are tables, only closed forms of a few numbers are left to the driver."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sampling import numbered, running


def odds_ratio(df: DataFrame, flag: str, label: str) -> DataFrame:
    """(a, b, c, d, odds_ratio, low, high): Woolf's 95 % interval; a row with a null is left out.

    Infinite where b * c is 0. The interval is null where the ratio is 0 or infinite.
    """
    known = df.where(F.col(flag).isNotNull() & F.col(label).isNotNull())
    cell = lambda f, y: F.count_if((F.col(flag) == f) & (F.col(label) == y))
    t = known.agg(cell(1, 1).alias("a"), cell(1, 0).alias("b"), cell(0, 1).alias("c"), cell(0, 0).alias("d"))
    return with_ratio(t)


def with_ratio(t: DataFrame) -> DataFrame:
    ratio = F.when(F.col("b") * F.col("c") == 0, F.lit(math.inf)).otherwise(F.col("a") * F.col("d") / F.when(F.col("b") * F.col("c") > 0, F.col("b") * F.col("c")))
    se = F.sqrt(sum(1 / F.greatest(F.col(x), F.lit(1)) for x in "abcd"))
    usable = (F.col("odds_ratio") > 0) & (F.col("odds_ratio") < math.inf)
    edge = lambda sign: F.when(usable, F.exp(F.log(F.when(usable, F.col("odds_ratio"))) + sign * 1.96 * se))
    return t.withColumn("odds_ratio", ratio).withColumns({"low": edge(-1), "high": edge(1)})


def odds_table(df: DataFrame, flags: list[str], label: str) -> DataFrame:
    """One row a flag, rounded to three places; one pass over ``df``."""
    long = df.select(label, F.explode(F.array(*(F.struct(F.lit(f).alias("flag"), F.col(f).cast("int").alias("on")) for f in flags))).alias("x")).select(label, "x.*")
    long = long.where(F.col("on").isNotNull() & F.col(label).isNotNull())
    cell = lambda f, y: F.count_if((F.col("on") == f) & (F.col(label) == y))
    t = long.groupBy("flag").agg(cell(1, 1).alias("a"), cell(1, 0).alias("b"), cell(0, 1).alias("c"), cell(0, 0).alias("d"))
    return with_ratio(t).select("flag", *(F.round(c, 3).alias(c) for c in ("odds_ratio", "low", "high")))


def chi_square(df: DataFrame, column: str, label: str, least: int = 10) -> DataFrame:
    """(chi2, dof, n, cramers_v) of a crosstab, without categories of fewer than ``least`` rows; Yates' correction for one degree."""
    g = df.where(F.col(column).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(column).alias("r"), F.col(label).alias("c")).agg(F.count("*").alias("o"))
    g = g.withColumn("row", F.sum("o").over(Window.partitionBy("r"))).where(F.col("row") >= least)
    full = g.select("r", "row").distinct().crossJoin(g.select("c").distinct()).join(g.select("r", "c", "o"), ["r", "c"], "left").fillna({"o": 0})  # a cell each
    full = full.withColumns({"col": F.sum("o").over(Window.partitionBy("c")), "n": F.sum("o").over(Window.partitionBy())})
    full = full.withColumns({"e": F.col("row") * F.col("col") / F.col("n"), "rows": F.size(F.collect_set("r").over(Window.partitionBy())), "cols": F.size(F.collect_set("c").over(Window.partitionBy()))})
    full = full.withColumn("dof", (F.col("rows") - 1) * (F.col("cols") - 1))
    off = F.abs(F.col("o") - F.col("e"))
    off = F.when(F.col("dof") == 1, off - F.least(F.lit(0.5), off)).otherwise(off)
    t = full.agg(F.sum(off * off / F.col("e")).alias("chi2"), F.first("dof").alias("dof"), F.first("n").alias("n"), F.first(F.least("rows", "cols") - 1).alias("k"))
    return t.select("chi2", "dof", "n", F.when(F.col("k") > 0, F.sqrt(F.col("chi2") / (F.col("n") * F.when(F.col("k") > 0, F.col("k"))))).alias("cramers_v"))


def chi_square_p(chi2: float, dof: int) -> float:
    """Upper tail of the chi-square distribution, by the series or the continued fraction of the incomplete gamma function."""
    a, x = dof / 2, chi2 / 2
    if x <= 0 or dof <= 0:
        return 1.0
    front = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1
            term *= x / n
            total += term
        return max(0.0, 1 - total * front)
    tiny = 1e-300
    b, c = x + 1 - a, 1 / tiny
    d = h = 1 / b
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b or tiny)
        c = b + an / c or tiny
        h *= d * c
        if abs(d * c - 1) < 1e-16:
            break
    return front * h


def mann_whitney(df: DataFrame, value: str, group: str) -> DataFrame:
    """(n1, n0, u, tie_term): U of group 1 against group 0, nulls dropped, ties at their mean rank.

    Ranks are made over distinct values, so that the one ordered table has a row for each of those.
    """
    g = df.where(F.col(value).isNotNull() & F.col(group).isin(0, 1)).groupBy(F.col(value).alias("v")).agg(F.count("*").alias("t"), F.count_if(F.col(group) == 1).alias("t1"))
    g = running(g, F.col("v"), {"to": F.col("t")})
    rank = F.col("to") - (F.col("t") - 1) / 2
    r = g.agg(F.sum("t1").alias("n1"), F.sum(F.col("t") - F.col("t1")).alias("n0"), F.sum(rank * F.col("t1")).alias("r1"), F.sum(F.col("t").cast("double") * F.col("t") * F.col("t") - F.col("t")).alias("tie_term"))
    return r.select("n1", "n0", (F.col("r1") - F.col("n1") * (F.col("n1") + 1) / 2).alias("u"), "tie_term")


def _u_counts(few: int, many: int) -> list[int]:
    """In how many orders of two samples without ties U is 0, 1, … few * many."""
    out = [1] + [0] * (few * many)
    for i in range(1, few + 1):
        for j in range(len(out) - 1, many + i - 1, -1):
            out[j] -= out[j - many - i]
        for j in range(i, len(out)):
            out[j] += out[j - i]
    return out


def mann_whitney_p(n1: int, n0: int, u: float, tie_term: float) -> float:
    """Two-sided: exact without ties if a sample has at most eight rows (and the other is not huge), else by the normal
    approximation with ties and continuity."""
    n = n1 + n0
    few, many = sorted((n1, n0))
    if 0 < few <= 8 and tie_term == 0 and few * many <= 1_000_000:
        counts = _u_counts(few, many)
        return min(1.0, 2 * sum(counts[math.ceil(max(u, n1 * n0 - u)) :]) / math.comb(n, few))
    var = n1 * n0 / 12 * (n + 1 - tie_term / (n * (n - 1))) if n > 1 else 0
    if var <= 0:
        return 1.0
    z = (abs(u - n1 * n0 / 2) - 0.5) / math.sqrt(var)
    return min(1.0, math.erfc(max(z, 0) / math.sqrt(2)))


def mann_kendall(points: DataFrame, order: str, value: str) -> DataFrame:
    """(n, s, var_s) of a short series (months, say): every point is compared with the later ones."""
    p = points.where(F.col(value).isNotNull()).select(F.col(order).alias("o"), F.col(value).alias("v"))
    q = p.select(F.col("o").alias("o2"), F.col("v").alias("v2"))
    s = p.join(q, F.col("o") < F.col("o2")).agg(F.coalesce(F.sum(F.signum(F.col("v2") - F.col("v"))), F.lit(0.0)).cast("long").alias("s"))
    t = p.groupBy("v").agg(F.count("*").alias("t")).agg(F.sum("t").alias("n"), F.sum(F.col("t") * (F.col("t") - 1) * (2 * F.col("t") + 5)).alias("ties"))
    n = F.col("n")
    return t.crossJoin(s).select("n", "s", ((n * (n - 1) * (2 * n + 5) - F.col("ties")) / 18).alias("var_s"))


def mann_kendall_p(s: int, var_s: float) -> tuple[float, float, str]:
    """(z, p, trend)."""
    z = 0.0 if var_s <= 0 or s == 0 else (s - math.copysign(1, s)) / math.sqrt(var_s)
    p = math.erfc(abs(z) / math.sqrt(2))
    return z, p, "no trend" if p >= 0.05 else "increasing" if z > 0 else "decreasing"


def logistic_summary(df: DataFrame, flags: list[str], label: str) -> list[dict]:
    """A row a coefficient, the constant first: estimate, odds ratio, standard error, z and p. Null flags count as 0."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GeneralizedLinearRegression

    d = df.select(F.col(label).cast("double").alias(label), *(F.col(f).cast("double").alias(f) for f in flags)).fillna(0.0, flags)
    x = VectorAssembler(inputCols=flags, outputCol="x_").transform(d)
    m = GeneralizedLinearRegression(family="binomial", link="logit", featuresCol="x_", labelCol=label).fit(x)
    s = m.summary
    names, values = ["const", *flags], [m.intercept, *m.coefficients]
    last = lambda seq: [seq[-1], *seq[:-1]]  # noqa: E731  Spark puts the intercept last
    rows = zip(names, values, last(list(s.coefficientStandardErrors)), last(list(s.tValues)), last(list(s.pValues)), strict=True)
    return [{"name": n, "coefficient": b, "odds_ratio": math.exp(b), "std_error": e, "z": z, "p": p} for n, b, e, z, p in rows]


def coefficient_stability(df: DataFrame, flags: list[str], label: str, key: Column, ties: list[Column], parts: int = 3) -> list[dict]:
    """Coefficients on the first 1/parts, 2/parts … of the rows in time order."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    d = numbered(df, key, ties).fillna(0, flags).persist()
    n, out = d.count(), []
    for i in range(1, parts + 1):
        part = VectorAssembler(inputCols=flags, outputCol="x_").transform(d.where(F.col("position") < n * i // parts).withColumn("y_", F.col(label).cast("double")))
        m = LogisticRegression(featuresCol="x_", labelCol="y_", regParam=1 / max(1, n * i // parts), standardization=False).fit(part)
        out.append({"rows": n * i // parts, **dict(zip(flags, map(float, m.coefficients), strict=True))})
    d.unpersist()
    return out
