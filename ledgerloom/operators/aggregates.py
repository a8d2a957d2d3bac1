"""Counts, cubes, contingency tables, shares and rates."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import running
from .quantiles import quantiles

ALL = "All Combined"


def counts(rows: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Rows by key; nulls are a group."""
    return rows.groupBy(*keys).agg(F.count("*").alias(name))


def cube_within(rows: DataFrame, fixed: Sequence[str], rolled: Sequence[str], measure: str, name: str, together: Sequence[Sequence[str]] = (), label: str = ALL) -> DataFrame:
    """Sums over every subset of the rolled columns, totals labelled, in one grouping-sets aggregate.

    fixed columns are never rolled up; the columns of each list in ``together`` are rolled
    up jointly.  A total is told from a null by ``grouping()``.
    """
    units = [[c] for c in rolled] + [list(t) for t in together]
    free = [c for u in units for c in u]
    sets = [[*fixed, *(c for u in kept for c in u)] for n in range(len(units) + 1) for kept in combinations(units, n)]
    grouped = rows.groupingSets([[F.col(c) for c in s] for s in sets], *fixed, *free).agg(F.sum(measure).cast("long").alias(name), *(F.grouping(c).alias(f"_g_{c}") for c in free))
    return grouped.select(*fixed, *(F.when(F.col(f"_g_{c}") == 1, F.lit(label)).otherwise(F.col(c)).alias(c) for c in free), name)


def dense_counts(rows: DataFrame, keys: Sequence[str], name: str = "n", keep_null: bool = False) -> DataFrame:
    """Counts of every combination of the values that occur, zeros included.

    The values of the named columns are crossed, not the rows; name only columns of few values.
    """
    there = rows if keep_null else rows.na.drop(how="any", subset=list(keys))
    levels = None
    for k in keys:
        values = there.select(k).distinct()
        levels = values if levels is None else levels.crossJoin(values)
    found = counts(there, keys, name).alias("f")
    on = None
    for k in keys:
        c = F.col(f"l.{k}").eqNullSafe(F.col(f"f.{k}"))
        on = c if on is None else on & c
    return levels.alias("l").join(found, on, "left").select(*(F.col(f"l.{k}").alias(k) for k in keys), F.coalesce(F.col(f"f.{name}"), F.lit(0)).cast("long").alias(name))


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def share_if(condition: Column, among: Column | None = None) -> Column:
    """The share of rows for which the condition holds, null without rows; null conditions count as not holding."""
    of = F.count(F.when(among, 1)) if among is not None else F.count("*")
    held = F.count(F.when(condition & among if among is not None else condition, 1))
    return held.cast("double") / F.nullif(of.cast("double"), F.lit(0.0))


def mode_by(rows: DataFrame, keys: Sequence[str], value: str, name: str = "mode") -> DataFrame:
    """The most frequent value of each group, the first by value on ties; nulls don't count."""
    n = counts(rows.filter(F.col(value).isNotNull()), [*keys, value], "_n")
    return n.groupBy(*keys).agg(F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(name))


def summaries(rows: DataFrame, keys: Sequence[str], c: str) -> DataFrame:
    """keys, minimum, quartiles, mean and maximum of each group; quantiles interpolated between order statistics."""
    means = rows.groupBy(*keys).agg(F.min(c).cast("double").alias("minimum"), F.avg(c).alias("mean"), F.max(c).cast("double").alias("maximum"))
    out = _beside(means, quantiles(rows, keys, c, {"lower_quartile": 0.25, "median": 0.5, "upper_quartile": 0.75}), keys)
    return out.select(*keys, "minimum", "lower_quartile", "median", "mean", "upper_quartile", "maximum")


def spreads(rows: DataFrame, keys: Sequence[str], c: str) -> DataFrame:
    """keys, minimum, maximum, width, mean, sd and median of each group."""
    means = rows.groupBy(*keys).agg(F.min(c).alias("minimum"), F.max(c).alias("maximum"), (F.max(c) - F.min(c)).alias("width"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("sd"))
    return _beside(means, quantiles(rows, keys, c, {"median": 0.5}), keys)


def _beside(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Two tables of one row a group, nulls being a group."""
    a, b = a.withColumn("_one", F.lit(0)), b.withColumn("_one", F.lit(0))
    on = F.lit(True)
    for k in (*keys, "_one"):
        on = on & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    return a.alias("a").join(b.alias("b"), on).select("a.*", *(f"b.{c}" for c in b.columns if c not in (*keys, "_one"))).drop("_one")


def weighted_rate(part_share: str, weight: str) -> Column:
    """100 * sum(weight * share / 100) / sum(weight)."""
    return F.lit(100.0) * F.sum(F.col(weight) * F.col(part_share) / 100) / F.nullif(F.sum(weight).cast("double"), F.lit(0.0))


def halved_total(rows: DataFrame, column: str, measure: str, label: str = ALL) -> DataFrame:
    """Totals over overlapping groups count everyone twice: half, cut to a whole number."""
    return rows.withColumn(measure, F.when(F.col(column) == label, F.floor(F.col(measure) / 2)).otherwise(F.col(measure)).cast("long"))


def overlapping(rows: DataFrame, groups: Sequence[Column], name: str) -> DataFrame:
    """Each row once for each group that it belongs to."""
    return rows.withColumn(name, F.explode(F.array(*groups)))


def reconcile(a: DataFrame, b: DataFrame, keys: Sequence[str], measure: str, tolerance: float = 0.0) -> DataFrame:
    """Groups where two aggregates differ, or that one lacks: keys, left, right, difference."""
    x = a.select(*keys, F.col(measure).cast("double").alias("left"), F.lit(None).cast("double").alias("right"))
    y = b.select(*keys, F.lit(None).cast("double").alias("left"), F.col(measure).cast("double").alias("right"))
    both = x.union(y).groupBy(*keys).agg(F.sum("left").alias("left"), F.sum("right").alias("right"))
    diff = F.coalesce("left", F.lit(0.0)) - F.coalesce("right", F.lit(0.0))
    return both.withColumn("difference", diff).filter((F.abs("difference") > tolerance) | F.col("left").isNull() | F.col("right").isNull())


def assert_reconciled(a: DataFrame, b: DataFrame, keys: Sequence[str], measure: str, tolerance: float = 0.0) -> DataFrame:
    """One row with the number of groups that differ, or an error on reading it if there are any."""
    n = reconcile(a, b, keys, measure, tolerance).agg(F.count("*").alias("n_different"))
    return n.select(F.when(F.col("n_different") == 0, F.col("n_different")).otherwise(F.raise_error(F.concat(F.col("n_different").cast("string"), F.lit(" groups differ")))).alias("n_different"))


def single_row_flag(rows: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Each group's flag if the group is one row, else 0."""
    return rows.groupBy(*keys).agg(F.when(F.count("*") == 1, F.first(flag)).otherwise(F.lit(0)).alias(flag))


def side_by_side(rows: DataFrame, keys: Sequence[str], blocks: dict[str, tuple[str, Sequence]]) -> DataFrame:
    """Counts of several contingency tables next to each other; blocks: prefix to (column, its listed values). One aggregate."""
    cells = [count_if(F.col(column) == v).alias(f"{prefix}_{v}") for prefix, (column, values) in blocks.items() for v in values]
    return rows.groupBy(*keys).agg(*cells)


def composite(columns: Sequence[str]) -> Column:
    """The sum of several columns, nulls counting 0."""
    total = F.lit(0)
    for c in columns:
        total = total + F.coalesce(c, F.lit(0))
    return total


def running_share(rows: DataFrame, measure: str, name: str = "share_below") -> DataFrame:
    """In ascending order of the measure, each row's cumulative share of the total (ties by all columns)."""
    order = [measure, *(c for c in rows.columns if c != measure)]
    total = rows.agg(F.sum(measure).cast("double").alias("_total"))  # one row
    summed = running(rows, order, F.col(measure), "_cum").join(F.broadcast(total))
    return summed.withColumn(name, F.col("_cum").cast("double") / F.nullif(F.col("_total"), F.lit(0.0))).select(*rows.columns, name)


def dense_series(rows: DataFrame, keys: Sequence[str], period: str, name: str = "n") -> DataFrame:
    """Counts of each key's periods from the first to the last that occur at all (whole numbers), zeros included.

    Each key's few counts are spread over the periods by themselves: keys and periods aren't crossed.
    """
    found = counts(rows.filter(F.col(period).isNotNull()), [*keys, period], name)
    span = found.agg(F.min(period).alias("_low"), F.max(period).alias("_high"))  # one row
    held = found.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(period, name))).alias("_held")).join(F.broadcast(span))
    spread = held.withColumn(period, F.explode(F.sequence("_low", "_high")))
    return spread.select(*keys, period, F.coalesce(F.try_element_at("_held", F.col(period)), F.lit(0)).cast("long").alias(name))
