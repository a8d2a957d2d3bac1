"""What columns hold, and where loads or fields contradict each other."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .aggregates import summaries

Hook = Callable[[DataFrame, str], DataFrame]


def column_profile(rows: DataFrame, masked: Sequence[str] = ()) -> DataFrame:
    """column, kind, n_rows, n_null, n_distinct, least, most.

    kind: binary for numbers of two values, else number, date, boolean or text; masked
    columns keep their counts and hide their values.  Counts and extremes are one aggregate
    over a scan.  Distinct values are counted in two levels: rows are turned into (column,
    value), each task sends every pair once, and what is left is counted by column.  A column
    of one value and one of only different values so cost the same few rows a task or
    their own number.
    """
    parts, values = [], []
    for i, f in enumerate(rows.schema.fields):
        c = F.col(f"`{f.name}`")
        number = isinstance(f.dataType, T.NumericType)
        kind = "number" if number else "date" if isinstance(f.dataType, (T.DateType, T.TimestampType)) else "boolean" if isinstance(f.dataType, T.BooleanType) else "text"
        ordered = not isinstance(f.dataType, (T.MapType, T.VariantType))
        show = lambda x, n=f.name, ok=ordered: x.cast("string") if ok and n not in masked else F.lit(None).cast("string")
        parts.append(F.struct(F.lit(i).alias("nth"), F.lit(f.name).alias("column"), F.lit(kind).alias("kind"), F.count("*").alias("n_rows"), F.count(F.when(c.isNull(), 1)).alias("n_null"), show(F.min(c) if ordered else c).alias("least"), show(F.max(c) if ordered else c).alias("most")))
        values.append(F.struct(F.lit(i).alias("nth"), _as_text(c, f.dataType).alias("value")))
    whole = rows.agg(F.array(*parts).alias("p")).select(F.inline("p"))
    pairs = rows.select(F.explode(F.array(*values)).alias("v")).select("v.nth", "v.value").filter("value IS NOT NULL").distinct()
    distinct = pairs.groupBy("nth").agg(F.count("*").alias("n_distinct"))
    both = whole.join(distinct, "nth", "left").withColumn("n_distinct", F.coalesce("n_distinct", F.lit(0)))
    binary = F.when((F.col("kind") == "number") & (F.col("n_distinct") == 2), "binary").otherwise(F.col("kind"))
    return both.select("column", binary.alias("kind"), "n_rows", "n_null", "n_distinct", "least", "most")


def _as_text(c: Column, kind: T.DataType) -> Column:
    """A string for each different value."""
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(c)
    if isinstance(kind, T.BinaryType):
        return F.hex(c)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        c = c + F.lit(0.0).cast(kind)  # both zeros are one value
    return c.cast("string")


def preview(rows: DataFrame, n: int = 6, columns: int = 7) -> DataFrame:
    return rows.select(*rows.columns[:columns]).limit(n)


def frequencies(rows: DataFrame, column: str, names: DataFrame | None = None) -> DataFrame:
    """Each value with its number of rows, and its name from a table (column, name) if given; null is a value."""
    n = rows.groupBy(column).agg(F.count("*").alias("n"))
    return n.join(names, column, "left") if names is not None else n


def six_numbers(rows: DataFrame, column: str) -> DataFrame:
    return summaries(rows, [], column)


def variable_summary(rows: DataFrame, column: str, hooks: dict[str, Hook] | None = None) -> DataFrame:
    """A registered hook's table, or six numbers of a number, or the frequencies of anything else."""
    if hooks and column in hooks:
        return hooks[column](rows, column)
    number = isinstance(rows.schema[column].dataType, T.NumericType)
    return six_numbers(rows, column) if number else frequencies(rows, column)


def reconcile_stages(raw: DataFrame, typed: DataFrame, raw_value: Column, typed_value: Column) -> DataFrame:
    """value, n_raw, n_typed and their difference, of values whose counts changed between two stages."""
    a = raw.select(raw_value.cast("string").alias("value"), F.lit(1).alias("r"), F.lit(0).alias("t"))
    b = typed.select(typed_value.cast("string").alias("value"), F.lit(0).alias("r"), F.lit(1).alias("t"))
    both = a.union(b).groupBy("value").agg(F.sum("r").cast("long").alias("n_raw"), F.sum("t").cast("long").alias("n_typed"))
    return both.withColumn("difference", F.col("n_raw") - F.col("n_typed")).filter("difference <> 0")


def impossible_dates(rows: DataFrame, year: str, month: str, day: str) -> DataFrame:
    """Rows whose parts are there and make no date."""
    from ..functions.dates import date_of

    there = F.col(year).isNotNull() & F.col(month).isNotNull() & F.col(day).isNotNull()
    return rows.filter(there & date_of(F.col(year), F.col(month), F.col(day)).isNull())


def implausible(rows: DataFrame, value: str, low: float, high: float, by: Sequence[str]) -> DataFrame:
    """How many values are at most ``low`` and at least ``high``, by group with any."""
    few, many = F.count(F.when(F.col(value) <= low, 1)), F.count(F.when(F.col(value) >= high, 1))
    return rows.groupBy(*by).agg(few.alias("n_low"), many.alias("n_high")).filter("n_low > 0 OR n_high > 0")


def contradictions(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """rule and number of rows that break it."""
    parts = [F.struct(F.lit(name).alias("rule"), F.count(F.when(broken, 1)).alias("n_rows")) for name, broken in rules.items()]
    return rows.agg(F.array(*parts).alias("p")).select(F.inline("p"))


def kept(path: str, make: Callable[[], DataFrame], spark) -> DataFrame:
    """A table made once: read where it is, else made and written."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(path)
    except AnalysisException:
        make().write.parquet(path)
        return spark.read.parquet(path)


def unmatched_audit(rows: DataFrame, tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """column, code, n_rows of all codes that their tables lack; tables: column to (table, its column)."""
    parts = []
    for column, (table, key) in tables.items():
        known = table.select(F.col(key).cast("string").alias("code")).distinct()
        codes = rows.select(F.col(column).cast("string").alias("code")).groupBy("code").agg(F.count("*").alias("n_rows"))
        parts.append(codes.join(known, "code", "left_anti").select(F.lit(column).alias("column"), "code", "n_rows"))
    return reduce(lambda a, b: a.union(b), parts)
