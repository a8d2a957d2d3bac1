"""Trends, intervals, densities and smooths by group."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .quantiles import quantiles


def incomplete_beta(a: float, b: float, x: float) -> float:
    """The regularized incomplete beta function, by its continued fraction."""
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - incomplete_beta(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x)) / a
    tiny, f, c, d = 1e-300, 1.0, 1.0, 0.0
    for i in range(300):
        m = i // 2
        if i == 0:
            n = 1.0
        elif i % 2 == 0:
            n = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            n = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1 / (d_ if abs(d_ := 1 + n * d) > tiny else tiny)
        c = c_ if abs(c_ := 1 + n / c) > tiny else tiny
        f *= c * d
        if abs(1 - c * d) < 1e-14:
            break
    return front * (f - 1)


def beta_quantile(p: float, a: float, b: float) -> float:
    low, high = 0.0, 1.0
    for _ in range(200):
        mid = (low + high) / 2
        if incomplete_beta(a, b, mid) < p:
            low = mid
        else:
            high = mid
    return (low + high) / 2


def two_sided_p(t: float, df: float) -> float:
    """Of Student's t."""
    return incomplete_beta(df / 2, 0.5, df / (df + t * t)) if df > 0 and math.isfinite(t) else (0.0 if df > 0 else math.nan)


def trend(rows: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """keys, n, slope, intercept, r2 and p_value of a line through each group's points.

    Sums run in the engine; only the p value of each group's few figures is left to a pandas UDF.
    """

    @F.pandas_udf(T.DoubleType())
    def p_value(r2: pd.Series, n: pd.Series) -> pd.Series:
        def one(q: float, k: float) -> float:
            if k is None or k < 3 or q is None or math.isnan(q):
                return math.nan
            return 0.0 if q >= 1 else two_sided_p(math.sqrt(q * (k - 2) / (1 - q)), k - 2)

        return pd.Series([one(q, k) for q, k in zip(r2, n, strict=True)])

    stats = rows.groupBy(*keys).agg(F.regr_count(y, x).alias("n"), F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"))
    return stats.withColumn("p_value", p_value("r2", F.col("n").cast("double")))


def jeffreys(rows: DataFrame, hits: str, n: str, level: float = 0.95, low: str = "low", high: str = "high") -> DataFrame:
    """The Jeffreys interval of a proportion: quantiles of Beta(hits + 1/2, n - hits + 1/2)."""

    @F.pandas_udf("low double, high double")
    def interval(x: pd.Series, k: pd.Series) -> pd.DataFrame:
        tail = (1 - level) / 2
        memo: dict = {}
        out = []
        for a, b in zip(x, k, strict=True):
            if pd.isna(a) or pd.isna(b):
                out.append((None, None))
                continue
            if (a, b) not in memo:
                memo[a, b] = (beta_quantile(tail, a + 0.5, b - a + 0.5), beta_quantile(1 - tail, a + 0.5, b - a + 0.5))
            out.append(memo[a, b])
        return pd.DataFrame(out, columns=["low", "high"])

    return rows.withColumn("_i", interval(F.col(hits).cast("double"), F.col(n).cast("double"))).withColumn(low, F.col("_i.low")).withColumn(high, F.col("_i.high")).drop("_i")


def histogram(rows: DataFrame, value: str, low: float, high: float, bins: int) -> DataFrame:
    """bin (0 below, bins + 1 from high on), bin_start and n."""
    b = F.width_bucket(F.col(value).cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(bins))
    counted = rows.filter(F.col(value).isNotNull()).groupBy(b.alias("bin")).agg(F.count("*").alias("n"))
    return counted.withColumn("bin_start", F.lit(low) + (F.col("bin") - 1) * F.lit((high - low) / bins))


def density(rows: DataFrame, value: str, grid: Sequence[float], bandwidth: float | None = None) -> DataFrame:
    """Gaussian kernel density on a grid; by default the usual rule-of-thumb bandwidth.

    Equal values are counted first; each row of counts meets the grid's few points.
    """
    v = rows.select(F.col(value).cast("double").alias("v")).filter("v IS NOT NULL")
    if bandwidth is None:
        s = v.agg(F.stddev_samp("v").alias("sd"), F.count("*").alias("n")).first()
        if not s["n"]:
            bandwidth = 1.0
        else:
            q = quantiles(v, [], "v", {"q1": 0.25, "q3": 0.75}).first()
            wide = [x for x in (s["sd"], (q["q3"] - q["q1"]) / 1.34) if x]
            bandwidth = 0.9 * (min(wide) if wide else 1.0) * s["n"] ** -0.2
    counted = v.groupBy("v").agg(F.count("*").alias("n"))
    z = (F.col("x") - F.col("v")) / F.lit(bandwidth)
    points = counted.withColumn("x", F.explode(F.array(*(F.lit(float(x)) for x in grid))))
    kernel = F.exp(-z * z / 2) / F.lit(bandwidth * math.sqrt(2 * math.pi))
    return points.groupBy("x").agg((F.sum(F.col("n") * kernel) / F.sum("n")).alias("density"))


def polynomial(rows: DataFrame, keys: Sequence[str], x: str, y: str, degree: int) -> DataFrame:
    """keys, coefficients (from the constant up) and residual standard deviation of each group's fit."""
    schema = T.StructType([*(T.StructField(k, rows.schema[k].dataType) for k in keys), T.StructField("coefficients", T.ArrayType(T.DoubleType())), T.StructField("sigma", T.DoubleType())])

    # The normal equations' sums are all that a group needs.
    powers = rows.select(*keys, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")).filter("_x IS NOT NULL AND _y IS NOT NULL")
    sums = powers.groupBy(*keys).agg(F.count("*").alias("_n"), F.sum(F.col("_y") * F.col("_y")).alias("_yy"), F.array(*(F.sum(F.pow("_x", F.lit(p))) for p in range(2 * degree + 1))).alias("_s"), F.array(*(F.sum(F.pow("_x", F.lit(p)) * F.col("_y")) for p in range(degree + 1))).alias("_t"))

    def solve(batches):
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                s, t, n = np.array(row["_s"]), np.array(row["_t"]), row["_n"]
                m = np.array([[s[i + j] for j in range(degree + 1)] for i in range(degree + 1)])
                beta = np.linalg.lstsq(m, t, rcond=None)[0]
                rss = max(0.0, float(row["_yy"] - beta @ t))
                out.append([*(row[k] for k in keys), beta.tolist(), math.sqrt(rss / (n - degree - 1)) if n > degree + 1 else None])
            yield pd.DataFrame(out, columns=[*keys, "coefficients", "sigma"])

    return sums.mapInPandas(solve, schema)
