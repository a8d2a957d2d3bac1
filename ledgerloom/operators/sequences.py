"""Neighbour tests, runs and gaps, changes from one period to the next, and standard scores."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.recode import logit
from .ordering import numbered, with_neighbours


def neighbour_flags(rows: DataFrame, order: str, group: Sequence[str] = (), month: str = "month", day: str = "day", unit: str = "unit", bad: Column | None = None) -> DataFrame:
    """Which impossible dates look like one slip of the pen, from the records before and after.

    month_slipped: the month before is earlier, its day no later, the unit the same;
    day_transposed: month and unit equal on each side that exists, and the day larger than both;
    day_added: three records of one month whose day is that before plus one, as is the next if known.
    """
    looked = with_neighbours(rows, group, order, [order, month, day, unit])
    p, n = (lambda c: F.col(f"_p_{c}")), (lambda c: F.col(f"_n_{c}"))
    has_p, has_n = p(order).isNotNull(), n(order).isNotNull()
    yes = lambda c: F.coalesce(c, F.lit(False))
    looked_at = yes(bad) if bad is not None else F.lit(True)
    slipped = has_p & (p(month) < F.col(month)) & (p(day) <= F.col(day)) & (p(unit) == F.col(unit))
    before = ~has_p | yes((p(month) == F.col(month)) & (F.col(day) > p(day)) & (p(unit) == F.col(unit)))
    after = ~has_n | yes((n(month) == F.col(month)) & (F.col(day) > n(day)) & (n(unit) == F.col(unit)))
    grown = has_p & has_n & (p(month) == F.col(month)) & (n(month) == F.col(month)) & (F.col(day) == p(day) + 1) & F.coalesce(n(day) == p(day) + 1, F.lit(True))
    flags = {"month_slipped": looked_at & yes(slipped), "day_transposed": looked_at & before & after, "day_added": looked_at & yes(grown)}
    return looked.withColumns(flags).select(*rows.columns, *flags)


def runs(rows: DataFrame, keys: Sequence[str], order: str, on: Column) -> DataFrame:
    """keys, on, run_start, run_end, run_length of each stretch of equal ``on`` along ``order`` (consecutive whole numbers)."""
    w = Window.partitionBy(*keys).orderBy(order)
    v = Window.partitionBy(*keys, "on").orderBy(order)
    marked = rows.withColumn("on", on).withColumn("island", F.row_number().over(w) - F.row_number().over(v))
    return marked.groupBy(*keys, "on", "island").agg(F.min(order).alias("run_start"), F.max(order).alias("run_end"), F.count("*").alias("run_length")).drop("island")


def longest_run(found: DataFrame, keys: Sequence[str], on: bool = True) -> DataFrame:
    """The longest stretch of each key, the first on ties."""
    best = found.filter(F.col("on") == on).groupBy(*keys).agg(F.max_by(F.struct("run_start", "run_end", "run_length"), F.struct("run_length", -F.col("run_start"))).alias("b"))
    return best.select(*keys, "b.run_start", "b.run_end", "b.run_length")


def run_count(found: DataFrame, keys: Sequence[str], on: bool = True) -> DataFrame:
    return found.filter(F.col("on") == on).groupBy(*keys).agg(F.count("*").alias("n_runs"))


def ratio_extremes(rows: DataFrame, keys: Sequence[str], order: str, value: str) -> DataFrame:
    """Smallest and largest ratio to the period before, periods of zero left out first."""
    w = Window.partitionBy(*keys).orderBy(order)
    ratio = F.col(value).cast("double") / F.lag(value).over(w)
    return rows.filter(F.col(value) > 0).withColumn("ratio", ratio).groupBy(*keys).agg(F.min("ratio").alias("least_ratio"), F.max("ratio").alias("most_ratio"))


def finite_ratio_extremes(rows: DataFrame, keys: Sequence[str], order: str, value: str) -> DataFrame:
    """The same with all periods, keeping only finite positive ratios; 0 and 1 where there are none."""
    w = Window.partitionBy(*keys).orderBy(order)
    before = F.lag(value).over(w)
    ratio = F.when((before > 0) & (F.col(value) > 0), F.col(value).cast("double") / before)
    return rows.withColumn("ratio", ratio).groupBy(*keys).agg(F.coalesce(F.min("ratio"), F.lit(0.0)).alias("least_ratio"), F.coalesce(F.max("ratio"), F.lit(1.0)).alias("most_ratio"))


def logit_changes(rows: DataFrame, keys: Sequence[str], order: str, share: str, name: str = "logit_change") -> DataFrame:
    """Change of a share on the logit scale; infinite changes are dropped."""
    w = Window.partitionBy(*keys).orderBy(order)
    return rows.withColumn(name, logit(F.col(share)) - F.lag(logit(F.col(share))).over(w)).filter(F.col(name).isNotNull())


def top_share(shared: DataFrame, keep: float, form: str = "above", name: str = "share_below") -> DataFrame:
    """Units that make up the top share, from rows of ``running_share``.

    above: cumulative share over 1 - keep; with_next: also the largest unit not above it;
    strict: units strictly larger than the last one below it.
    The cut is the decimal 1 - keep: in doubles 1 - 0.95 lies above 0.05, and a share of just that would fall short.
    """
    cut = float(1 - Decimal(str(keep)))
    if form == "above":
        return shared.filter(F.col(name) > cut)
    if form == "with_next":
        edge = shared.filter(F.col(name) < cut).agg(F.max(name).alias("_edge"))
        return shared.crossJoin(edge).filter((F.col(name) >= cut) | F.coalesce(F.col(name) == F.col("_edge"), F.lit(False))).drop("_edge")
    if form == "strict":
        edge = shared.filter(F.col(name) < cut).agg(F.max("n").alias("_edge"))
        return shared.crossJoin(edge).filter(F.col("n") > F.coalesce("_edge", F.lit(-1))).drop("_edge")
    raise ValueError(form)


def dense_codes(rows: DataFrame, column: str, name: str) -> DataFrame:
    """Distinct values numbered 1.. in order, by a join with the numbered values; nulls stay null."""
    codes = numbered(rows.select(column).filter(F.col(column).isNotNull()).distinct(), [column], name)
    return rows.join(codes.withColumn(name, F.col(name).cast("int")), column, "left")


def standardized(rows: DataFrame, value: str, keys: Sequence[str], name: str) -> DataFrame:
    """(x - mean) / sd of the group's finite values; infinite and missing values give null."""
    x = F.when(~F.isnan(value) & (F.abs(F.col(value)) < float("inf")), F.col(value))
    stats = rows.groupBy(*keys).agg(F.avg(x).alias("_mean"), F.stddev_samp(x).alias("_sd"))
    joined = rows.join(stats, list(keys), "left") if keys else rows.crossJoin(stats)
    return joined.withColumn(name, (x - F.col("_mean")) / F.nullif(F.col("_sd"), F.lit(0.0))).drop("_mean", "_sd")


def threshold_counts(rows: DataFrame, keys: Sequence[str], value: str, high: float = 0.99, low: float = 0.8) -> DataFrame:
    """Of each key's periods: how many there are, are missing, exceed ``high`` and fall short of ``low``."""
    return rows.groupBy(*keys).agg(
        F.count("*").alias("n_periods"),
        F.count(F.when(F.col(value).isNull(), 1)).alias("n_missing"),
        F.count(F.when(F.col(value) > high, 1)).alias("n_high"),
        F.count(F.when(F.col(value) < low, 1)).alias("n_low"),
    )
