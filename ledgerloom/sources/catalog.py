"""Named tables in several formats, with hooks that run on load."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

Hook = Callable[[DataFrame], DataFrame]


@dataclass
class Entry:
    path: str
    form: str = "parquet"
    schema: str | None = None
    options: dict[str, str] = field(default_factory=dict)
    on_load: Hook | None = None


class Catalog:
    """Tables by name; a hook is a function, never text."""

    def __init__(self, spark: SparkSession):
        self.spark, self.entries = spark, dict[str, Entry]()

    def add(self, name: str, path: str, form: str = "parquet", schema: str | None = None, on_load: Hook | None = None, **options: str) -> None:
        self.entries[name] = Entry(path, form, schema, options, on_load)

    def load(self, name: str) -> DataFrame:
        entry = self.entries[name]
        if entry.form == "table":
            df = self.spark.table(entry.path)
        elif entry.form == "jdbc":
            df = self.spark.read.format("jdbc").options(dbtable=entry.path, **entry.options).load()
        elif entry.form in ("csv", "parquet", "json", "orc"):
            reader = self.spark.read.options(**entry.options)
            df = (reader.schema(entry.schema) if entry.schema else reader).format(entry.form).load(entry.path)
        else:
            raise ValueError(f"unknown format {entry.form!r} of {name}")
        return entry.on_load(df) if entry.on_load else df


def read_csv(spark: SparkSession, path: str, schema: str, sep: str = ",", header: bool = True, encoding: str = "ISO-8859-1") -> DataFrame:
    """A delimited file under a declared schema, with or without a header."""
    return spark.read.schema(schema).option("sep", sep).option("header", str(header).lower()).option("encoding", encoding).csv(path)


def write_csv(rows: DataFrame, path: str, null: str = "NULL") -> None:
    """One folder of delimited files with a header; nulls are written as ``null``."""
    rows.write.mode("overwrite").option("header", "true").option("nullValue", null).csv(path)


def create(rows: DataFrame, table: str, mode: str = "error", partition_by: list[str] | None = None) -> None:
    """Create, replace (overwrite) or extend (append) a table; partitions stand in for indexes."""
    writer = rows.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(table)


def drop(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def truncate(spark: SparkSession, table: str) -> None:
    spark.sql(f"TRUNCATE TABLE {table}")
