"""Which files were loaded, what changed since, and appends that can be repeated."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

MANIFEST = "file string, size long, modified timestamp, hash string, id_start long, id_end long, raw_done boolean, typed_done boolean"


def scan_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """file, size, modified and hash (MD5 of the bytes) of each file in a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"), F.md5("content").alias("hash"))


def changes(found: DataFrame, manifest: DataFrame) -> DataFrame:
    """file and state: new, deleted, changed (size or bytes), touched (time only) or same."""
    a, b = found.alias("a"), manifest.alias("b")
    state = (
        F.when(F.col("b.file").isNull(), "new")
        .when(F.col("a.file").isNull(), "deleted")
        .when(~F.col("a.size").eqNullSafe(F.col("b.size")) | ~F.col("a.hash").eqNullSafe(F.col("b.hash")), "changed")
        .when(~F.col("a.modified").eqNullSafe(F.col("b.modified")), "touched")
        .otherwise("same")
    )
    return a.join(b, F.col("a.file") == F.col("b.file"), "full").select(F.coalesce("a.file", "b.file").alias("file"), state.alias("state"))


def pending(manifest: DataFrame, stage: str) -> DataFrame:
    """Files that a stage (raw or typed) hasn't done."""
    return manifest.filter(~F.coalesce(F.col(f"{stage}_done"), F.lit(False))).select("file")


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def new_rows(rows: DataFrame, existing: DataFrame, key: str = "internal_uid") -> DataFrame:
    """Rows whose key isn't there yet, each key once: of rows that share one, the least in all columns."""
    least = rows.groupBy(key).agg(F.min(F.struct(*(c for c in rows.columns if c != key))).alias("_row"))
    return least.join(existing.select(key), key, "left_anti").select(*(key if c == key else F.col(f"_row.`{c}`").alias(c) for c in rows.columns))


def append_new(rows: DataFrame, path: str, key: str = "internal_uid") -> dict[str, int]:
    """Appends the new rows; counts those added and those ignored."""
    spark = rows.sparkSession
    existing = read_or_empty(spark, path, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema))
    had = existing.count()
    new_rows(rows, existing, key).write.mode("append").parquet(path)
    added = spark.read.parquet(path).count() - had
    return {"added": added, "ignored": rows.count() - added}


def replace_files(rows: DataFrame, path: str, file: str = "file") -> None:
    """Rows of the files at hand replace those that the table has of them; other files stay."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(file).parquet(path)
