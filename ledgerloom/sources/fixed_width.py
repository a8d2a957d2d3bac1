"""Fixed-width files as records, with the keys that make loads repeatable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dates, parsing


def read_records(spark: SparkSession, paths: str | list[str], encoding: str = "ISO-8859-1") -> DataFrame:
    """file, recno (from 1) and record of every line, blanks kept, with odd bytes as blanks.

    A line's number comes from its place in the file: the offset at which its split starts
    orders splits, and lines within a split follow each other.
    """
    lines = (
        spark.read.option("encoding", encoding)
        .option("sep", "\u0001")
        .option("quote", "")
        .option("escape", "")
        .option("comment", "")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .schema("record string")
        .csv(paths)
        .select("record", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"))
        .withColumn("line", F.monotonically_increasing_id())
    )
    return number_lines(lines).select("file", "recno", parsing.printable(F.col("record")).alias("record"))


def number_lines(lines: DataFrame) -> DataFrame:
    """recno within file from (file, block, line): counts per block are summed ahead, so a large file isn't sorted in one task."""
    counts = lines.groupBy("file", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.withColumn("ahead", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = Window.partitionBy("file", "block").orderBy("line")
    return lines.withColumn("within", F.row_number().over(inside)).join(ahead, ["file", "block"]).withColumn("recno", F.col("ahead") + F.col("within")).drop("ahead", "within")


def uid(file: str = "file", recno: str = "recno") -> Column:
    """``file:recno``: the same row loaded twice has the same key."""
    return F.concat_ws(":", file, F.col(recno).cast("string"))


def surrogate_keys(rows: DataFrame, first: int = 1, file: str = "file", recno: str = "recno") -> DataFrame:
    """db_id: consecutive from ``first``, by file name and then record number."""
    sizes = rows.groupBy(file).agg(F.max(recno).alias("size"))
    before = Window.orderBy(file).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("offset", F.coalesce(F.sum("size").over(before), F.lit(0))).drop("size")
    return rows.join(offsets, file).withColumn("db_id", F.col("offset") + F.col(recno) + F.lit(first - 1)).drop("offset")


def wrong_length(records: DataFrame, length: int, record: str = "record") -> DataFrame:
    """Records of another length than the file's layout has."""
    return records.filter(F.length(record) != length)


def file_year(file: Column) -> Column:
    """The year in a name that ends in two digits before its suffix."""
    return dates.century(F.regexp_extract(file, r"([0-9]{2})(?:\.[^.]*)?$", 1).try_cast("int"))


def write_delimited(rows: DataFrame, path: str, sep: str = "|", null: str = "") -> None:
    rows.write.mode("overwrite").option("sep", sep).option("header", "true").option("nullValue", null).csv(path)
