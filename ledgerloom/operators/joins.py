"""Joins with code tables, audits of what doesn't match, and null-tolerant matching."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import numbered


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def decode(rows: DataFrame, table: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left join with a code table; rows multiply where a code is there twice.

    Spark broadcasts the table if its size allows, and shuffles both if not.
    """
    return rows.join(table, on, "left")


def first_match(rows: DataFrame, table: DataFrame, on: str, order: str) -> DataFrame:
    """Left join with the first row of the table for each code, by ``order``; rows never multiply."""
    first = table.groupBy(on).agg(F.min_by(F.struct(*[c for c in table.columns if c != on]), order).alias("_first"))
    return rows.join(first, on, "left").select(*rows.columns, *(F.col("_first")[c].alias(c) for c in table.columns if c != on))


def versioned_match(rows: DataFrame, table: DataFrame, code: str, flag: str, since: Column, value: str, missing: str = "NA") -> DataFrame:
    """The table's value for a code in the version that applies: flag 1 where ``since`` holds, else 0.

    A code with one row in the table has that row's value in either version; one with several
    rows, none of the wanted version, gives ``missing``, as does one that the table lacks.
    Where ``since`` is null the largest flag applies.  Of several rows of one version the
    largest value is taken.
    """
    by = table.groupBy(code).agg(
        F.max(F.when(F.col(flag) == 0, F.col(value))).alias("_old"),
        F.max(F.when(F.col(flag) == 1, F.col(value))).alias("_new"),
        F.count("*").alias("_rows"),
    )
    joined = rows.join(by, code, "left")
    either = F.coalesce("_new", "_old")
    chosen = F.when((F.col("_rows") == 1) | since.isNull(), either).when(since, F.col("_new")).otherwise(F.col("_old"))
    return joined.withColumn(value, F.coalesce(chosen, F.lit(missing))).drop("_old", "_new", "_rows")


def unmatched(rows: DataFrame, table: DataFrame, on: str) -> DataFrame:
    """Each code that the table lacks, with its number of rows; null codes count as one."""
    return rows.join(table.select(on).distinct(), on, "left_anti").groupBy(on).agg(F.count("*").alias("n_rows"))


def merged_counts(left: DataFrame, right: DataFrame, key: str, left_name: str = "n_left", right_name: str = "n_right") -> DataFrame:
    """How often each value occurs on either side, zeros filled in; null is a value."""
    a = left.select(F.col(key), F.lit(1).alias("l"), F.lit(0).alias("r"))
    b = right.select(F.col(key), F.lit(0).alias("l"), F.lit(1).alias("r"))
    return a.union(b).groupBy(key).agg(F.sum("l").cast("long").alias(left_name), F.sum("r").cast("long").alias(right_name))


def flagged(rows: DataFrame, keys: DataFrame, on: str | Sequence[str], flag: str) -> DataFrame:
    """Rows with whether their key is among ``keys``."""
    names = [on] if isinstance(on, str) else list(on)
    there = keys.select(*names).distinct().withColumn(flag, F.lit(True))
    return rows.join(there, names, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def remap_keys(rows: DataFrame, mapping: DataFrame, columns: Sequence[str], old: str = "old", new: str = "new") -> DataFrame:
    """Key columns replaced through a map from old to new keys; keys that aren't mapped become null."""
    out = rows
    for c in columns:
        m = mapping.select(F.col(old).alias(f"_{c}_old"), F.col(new).alias(f"_{c}_new"))
        out = out.join(m, F.col(c) == F.col(f"_{c}_old"), "left").withColumn(c, F.col(f"_{c}_new")).drop(f"_{c}_old", f"_{c}_new")
    return out


def consistent(rows: DataFrame, table: DataFrame, on: str, mine: str, theirs: str) -> DataFrame:
    """One row: how many rows were looked up, and whether all agree with the table."""
    joined = rows.join(table.select(on, F.col(theirs).alias("_theirs")), on, "left")
    return joined.agg(F.count("*").alias("n_rows"), F.coalesce(F.bool_and(F.col(mine).eqNullSafe(F.col("_theirs"))), F.lit(True)).alias("agree"))


def failed_parses(raw: DataFrame, typed: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """key, column and text of each field that holds text but no typed value."""
    pairs = F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"r.{c}").cast("string").alias("text"), F.col(f"t.{c}").isNull().alias("lost")) for c in columns))
    joined = raw.alias("r").join(typed.alias("t"), key).select(key, F.explode(pairs).alias("p"))
    return joined.filter("p.lost AND trim(p.text) <> ''").select(key, "p.column", "p.text")


def wildcard_pairs(left: DataFrame, right: DataFrame, keys: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """Theta join of small tables: all keys equal or null on either side, and equal (null with null) within.

    For tables too large for that, see ``operators.risk.compatible_counts``.
    """
    a, b = left.alias("a"), right.alias("b")
    match = [F.col(f"a.{k}").isNull() | F.col(f"b.{k}").isNull() | (F.col(f"a.{k}") == F.col(f"b.{k}")) for k in keys]
    same = [F.col(f"a.{w}").eqNullSafe(F.col(f"b.{w}")) for w in within]
    return a.join(b, _all([*match, *same]))


def shares_value(rows: DataFrame, chosen: DataFrame, keys: Sequence[str], within: Sequence[str], flag: str) -> DataFrame:
    """Rows with whether any key's value (null being one) occurs in that column among the chosen rows of the same group."""
    out = rows
    for i, k in enumerate(keys):
        there = chosen.select(*(F.col(w).alias(f"_w{j}") for j, w in enumerate(within)), F.col(k).alias("_k")).distinct().withColumn(f"_hit{i}", F.lit(True))
        on = [F.col(w).eqNullSafe(F.col(f"_w{j}")) for j, w in enumerate(within)] + [F.col(k).eqNullSafe(F.col("_k"))]
        out = out.join(there, _all(on), "left").drop("_k", *(f"_w{j}" for j in range(len(within))))
    hit = reduce(lambda a, b: a | b, (F.coalesce(f"_hit{i}", F.lit(False)) for i in range(len(keys))))
    return out.withColumn(flag, hit).drop(*(f"_hit{i}" for i in range(len(keys))))


def with_group_max(rows: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Each row with its group's maximum, by a join with the grouped table (a group may hold any share of the rows)."""
    top = rows.groupBy(*keys).agg(F.max(value).alias(name))
    return rows.join(top, list(keys), "left")


def permuted_keys(rows: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """old and new: the distinct keys numbered 1.. in a seeded random order."""
    keys = rows.select(F.col(key).alias("old")).distinct().withColumn("_lot", F.xxhash64(F.lit(seed), "old"))
    return numbered(keys, ["_lot", "old"], "new").select("old", "new")
