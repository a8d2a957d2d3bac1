"""Positions and running sums along a global order that no single task has to hold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..durable import cut

PART = "_part"


def ranged(rows: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """``rows`` in ranges of the order, kept, each with the number of its range; numbers ascend with the order."""
    return cut(rows.repartitionByRange(*order).withColumn(PART, F.spark_partition_id()))


def running(rows: DataFrame, order: Sequence[Column | str], measure: Column, name: str) -> DataFrame:
    """The sum of ``measure`` up to each row, itself included; rows that tie in all of ``order`` come in any order.

    Ranges are summed by themselves and their totals added up: one row a range in one task.
    """
    placed = ranged(rows.withColumn("_measure", measure), order)
    sums = placed.groupBy(PART).agg(F.sum("_measure").alias("_sum"))
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    ahead = sums.select(PART, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_ahead"))
    within = Window.partitionBy(PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = placed.withColumn("_within", F.sum("_measure").over(within)).join(F.broadcast(ahead), PART)
    return out.withColumn(name, F.col("_ahead") + F.col("_within")).drop(PART, "_measure", "_within", "_ahead")


def numbered(rows: DataFrame, order: Sequence[Column | str], name: str) -> DataFrame:
    """Rows numbered 1.. along the order."""
    return running(rows, order, F.lit(1).cast("long"), name)


def without_positions(rows: DataFrame, order: Sequence[Column | str], positions: Sequence[int]) -> DataFrame:
    """``rows`` but those at these places (from 1) of the order."""
    return numbered(rows, order, "_nth").filter(~F.col("_nth").isin(list(positions))).drop("_nth")


def with_neighbours(rows: DataFrame, group: Sequence[str], order: str, columns: Sequence[str], before: str = "_p_", after: str = "_n_") -> DataFrame:
    """Each row with ``columns`` of the rows before and after it in its group, under prefixed names; null at the ends.

    A group may hold any share of all rows: within a range the rows are at hand, and of the
    ranges on either side the row at the edge is.
    """
    held = [*group, *columns]
    placed = ranged(rows, [*group, order])
    key = F.struct(*group, order)
    edges = placed.groupBy(PART).agg(F.min_by(F.struct(*held), key).alias("_first"), F.max_by(F.struct(*held), key).alias("_last"))
    along = Window.orderBy(PART)
    edges = edges.select(PART, F.lag("_last").over(along).alias("_edge_p"), F.lead("_first").over(along).alias("_edge_n"))
    within = Window.partitionBy(PART, *group).orderBy(order)
    out = placed.join(F.broadcast(edges), PART)
    out = out.withColumn("_own_p", F.lag(F.struct(*held)).over(within)).withColumn("_own_n", F.lead(F.struct(*held)).over(within))
    for side, prefix in (("p", before), ("n", after)):
        same = F.lit(True)
        for g in group:
            same = same & F.col(f"_edge_{side}.{g}").eqNullSafe(F.col(g))
        near = F.coalesce(F.col(f"_own_{side}"), F.when(same, F.col(f"_edge_{side}")))
        out = out.withColumn(f"_near_{side}", near).withColumns({f"{prefix}{c}": F.col(f"_near_{side}.{c}") for c in columns})
    return out.drop(PART, "_edge_p", "_edge_n", "_own_p", "_own_n", "_near_p", "_near_n")


def carried(rows: DataFrame, group: Sequence[str], order: str, column: str, name: str) -> DataFrame:
    """``rows`` with the last value of ``column`` in their group up to and with each row, nulls passed over.

    A segmented scan: ranges of the order are filled by themselves, and each takes what the ranges
    before it hold last, if its first group is that one's.  One row a range is in one task, so
    a group may hold any share of all rows.
    """
    placed = ranged(rows, [*group, order])
    last = F.max(F.when(F.col(column).isNotNull(), F.struct(*group, order, column)))
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    edges = placed.groupBy(PART).agg(last.alias("_last")).select(PART, F.last("_last", ignorenulls=True).over(before).alias("_carry"))
    within = Window.partitionBy(PART, *group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    same = F.lit(True)
    for g in group:
        same = same & F.col(f"_carry.`{g}`").eqNullSafe(F.col(g))
    filled = placed.withColumn("_own", F.last(column, ignorenulls=True).over(within)).join(F.broadcast(edges), PART)
    return filled.withColumn(name, F.coalesce("_own", F.when(same, F.col(f"_carry.`{column}`")))).drop(PART, "_own", "_carry")
