"""Wide to long and back, packed codes to rows, top rows and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parsing import packed_codes


def long(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str = "name", value: str = "value") -> DataFrame:
    """One row for each key and column."""
    return rows.unpivot(list(keys), list(columns), name, value)


def wide(rows: DataFrame, keys: Sequence[str], across: str, values: Sequence, measure: Column) -> DataFrame:
    """One column for each listed value; listing them spares a job and fixes the schema."""
    return rows.groupBy(*keys).pivot(across, list(values)).agg(measure)


def crosstab(rows: DataFrame, keys: Sequence[str], across: str, values: Sequence, prefix: str = "n_") -> DataFrame:
    """Counts by key with a column for each value, 0 where there are none."""
    out = rows.groupBy(*keys).pivot(across, list(values)).agg(F.count(F.lit(1)))
    return out.select(*keys, *(F.coalesce(F.col(f"`{v}`"), F.lit(0)).cast("long").alias(f"{prefix}{v}") for v in values))


def explode_codes(rows: DataFrame, keys: Sequence[str], packed: str, name: str = "code", width: int = 2, count: int = 7) -> DataFrame:
    """A row for each non-blank code of a packed field."""
    return rows.select(*keys, F.explode(packed_codes(F.col(packed), width, count)).alias(name))


def code_usage(rows: DataFrame, packed: str, by: Sequence[str] = (), width: int = 2, count: int = 7) -> DataFrame:
    """How often each code is used."""
    return explode_codes(rows, by, packed, "code", width, count).groupBy("code", *by).agg(F.count("*").alias("n"))


def frequent_codes(first: DataFrame, second: DataFrame, more_than: int = 500) -> DataFrame:
    """Codes used more often than that in either of two usages (code, n): code, n_first, n_second."""
    a = first.select("code", F.col("n").alias("n_first"), F.lit(0).cast("long").alias("n_second"))
    b = second.select("code", F.lit(0).cast("long"), F.col("n"))
    both = a.union(b).groupBy("code").agg(F.sum("n_first").alias("n_first"), F.sum("n_second").alias("n_second"))
    return both.filter((F.col("n_first") > more_than) | (F.col("n_second") > more_than))


def ends(rows: DataFrame, by: str, n: int = 8, ties: Sequence[str] = ()) -> DataFrame:
    """The n rows with the largest and the n with the smallest value, told apart by ``end``."""
    top = rows.orderBy(F.desc_nulls_last(by), *ties).limit(n).withColumn("end", F.lit("largest"))
    low = rows.orderBy(F.asc_nulls_last(by), *ties).limit(n).withColumn("end", F.lit("smallest"))
    return top.union(low)


def sample_rows(rows: DataFrame, n: int, key: str, seed: int = 0) -> DataFrame:
    """n rows at random, the same for the same seed however the rows are dealt."""
    return rows.orderBy(F.xxhash64(F.lit(seed), key), key).limit(n)


def only_left(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of the left that the right lacks."""
    return left.subtract(right)


def either(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of either side."""
    return left.union(right).distinct()


def transposed(rows: DataFrame, name: str, names: Sequence[str], columns: Sequence[str], into: str) -> DataFrame:
    """Columns as rows: one for each of ``columns``, with a column for each of ``names``, the values of ``name``."""
    spread = long(rows.select(name, *columns), [name], columns, into, "_value")
    return spread.groupBy(into).pivot(name, list(names)).agg(F.first("_value"))


def truncated_names(rows: DataFrame, most: int = 32) -> DataFrame:
    return rows.toDF(*(c[:most] for c in rows.columns))
