"""Exact quantiles of groups of any size, by selection.

Every rank that is asked for has a range of values in which it lies, at first its group's whole
range.  In a pass the rows in these ranges are counted in ``BINS`` equal bins, with each bin's least
and largest value; the bin that holds the rank is its next range.  A range is done when it is one
value, and when it has few rows they are read in order.  No task holds a group: what is
sent is counts by bin, and a sort never has more than ``BINS`` bins or ``FEW`` values.

A pass narrows a range by ``BINS`` times, so that two or three do for most data; values that
differ by many orders of magnitude take more.  Nulls, NaN and infinities don't count; groups
without other values have null quantiles.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..durable import Steps, cut

#: Bins of a range in one pass; rows of a range that are read in order.
BINS, FEW = 1 << 12, 1 << 12


def _same(keys: Sequence[str], a: str, b: str):
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
    return on


def quantiles(rows: DataFrame, keys: Sequence[str], value: str, at: Mapping[str, float], bins: int = BINS, few: int = FEW) -> DataFrame:
    """keys and, under each name of ``at``, the quantile of its share, interpolated between order statistics; a row a group.

    ``rows`` are read once a pass: cut the plan of what is dear to make.
    """
    named = [f"_k{i}" for i in range(len(keys))]
    plain = rows.select(*(F.col(k).alias(n) for k, n in zip(keys, named, strict=True)), F.col(value).cast("double").alias("_v"))
    finite = F.coalesce(~F.isnan("_v") & (F.abs("_v") < float("inf")), F.lit(False))
    groups = [*named, "_all"]  # a constant, so that no keys are keys too
    held = plain.filter(finite).withColumn("_all", F.lit(0))
    steps = Steps(rows.sparkSession, keep=4)
    whole = cut(plain.withColumn("_all", F.lit(0)).groupBy(*groups).agg(F.count(F.when(finite, 1)).alias("_n"), F.min(F.when(finite, F.col("_v"))).alias("_low"), F.max(F.when(finite, F.col("_v"))).alias("_high")))
    place = {name: F.lit(float(p)) * (F.col("_n") - 1) for name, p in at.items()}
    ranks = F.array_distinct(F.flatten(F.array(*(F.array(F.floor(h) + 1, F.ceil(h) + 1) for h in place.values()))))
    open_ranks = whole.filter("_n > 0").select(*groups, F.explode(ranks).alias("_rank"), F.lit(0).cast("long").alias("_before"), "_low", "_high", "_n")
    while True:
        open_ranks = steps.written(open_ranks)
        left = open_ranks.filter((F.col("_low") < F.col("_high")) & (F.col("_n") > few))
        if left.isEmpty():
            break
        # A rank's range, and those that are done, in one table again.
        open_ranks = _narrowed(held, groups, left, bins).unionByName(open_ranks.filter((F.col("_low") == F.col("_high")) | (F.col("_n") <= few)))
    found = steps.written(_read(held, groups, open_ranks).groupBy(*groups).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_value"))).alias("_at")))
    both = whole.alias("w").join(found.alias("f"), _same(groups, "w", "f"), "left").select("w.*", "f._at")

    def interpolated(h):
        low, high = F.floor(h) + 1, F.ceil(h) + 1
        a, b = F.element_at("_at", low), F.element_at("_at", high)
        return F.when(F.col("_n") > 0, F.when(low == high, a).otherwise((high - 1 - h) * a + (h - (low - 1)) * b))

    out = both.select(*(F.col(n).alias(k) for k, n in zip(keys, named, strict=True)), *(interpolated(h).alias(name) for name, h in place.items()))
    out = cut(out)
    steps.close()
    return out


def _in_ranges(held: DataFrame, groups: Sequence[str], ranges: DataFrame) -> DataFrame:
    """The rows of each range, with the range; ranges overlap only if they are equal."""
    wanted = ranges.select(*groups, "_low", "_high").distinct()
    pairs = held.alias("h").join(wanted.alias("r"), _same(groups, "h", "r") & (F.col("h._v") >= F.col("r._low")) & (F.col("h._v") <= F.col("r._high")))
    return pairs.select(*(F.col(f"r.{g}").alias(g) for g in groups), "r._low", "r._high", "h._v")


def _narrowed(held: DataFrame, groups: Sequence[str], ranges: DataFrame, bins: int) -> DataFrame:
    """Each rank with the bin of its range that holds it."""
    # Halves, as the width of the widest range is no finite number; that of the narrowest is 0.
    width = F.col("_high") / 2 - F.col("_low") / 2
    part = F.when(width > 0, (F.col("_v") / 2 - F.col("_low") / 2) / width).otherwise(F.when(F.col("_v") > F.col("_low"), 1.0).otherwise(0.0))
    inside = _in_ranges(held, groups, ranges).withColumn("_bin", F.least(F.floor(part * bins), F.lit(bins - 1)))
    counted = inside.groupBy(*groups, "_low", "_high", "_bin").agg(F.count("*").alias("_m"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
    along = Window.partitionBy(*groups, "_low", "_high").orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = counted.withColumn("_upto", F.sum("_m").over(along))
    on = _same([*groups, "_low", "_high"], "t", "c") & (F.col("t._rank") - F.col("t._before") <= F.col("c._upto")) & (F.col("t._rank") - F.col("t._before") > F.col("c._upto") - F.col("c._m"))
    found = ranges.alias("t").join(counted.alias("c"), on)
    return found.select(*(F.col(f"t.{g}").alias(g) for g in groups), "t._rank", (F.col("t._before") + F.col("c._upto") - F.col("c._m")).alias("_before"), F.col("c._least").alias("_low"), F.col("c._most").alias("_high"), F.col("c._m").alias("_n"))


def _read(held: DataFrame, groups: Sequence[str], ranges: DataFrame) -> DataFrame:
    """Each rank with its value: that of its range, or read in order from the range's few rows."""
    done = ranges.filter("_low = _high").select(*groups, "_rank", F.col("_low").alias("_value"))
    few = ranges.filter("_low < _high")
    counted = _in_ranges(held, groups, few).groupBy(*groups, "_low", "_high", "_v").agg(F.count("*").alias("_m"))
    along = Window.partitionBy(*groups, "_low", "_high").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = counted.withColumn("_upto", F.sum("_m").over(along))
    on = _same([*groups, "_low", "_high"], "t", "c") & (F.col("t._rank") - F.col("t._before") <= F.col("c._upto")) & (F.col("t._rank") - F.col("t._before") > F.col("c._upto") - F.col("c._m"))
    read = few.alias("t").join(counted.alias("c"), on).select(*(F.col(f"t.{g}").alias(g) for g in groups), "t._rank", F.col("c._v").alias("_value"))
    return done.unionByName(read)
