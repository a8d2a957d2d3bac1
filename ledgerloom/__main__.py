"""``python -m ledgerloom VERB IN OUT``: one step of a dataset's life over Parquet tables.

import: the fixed-width files of folder IN that are new or changed since the last import become
typed records (by a layout from ``--layout``, a JSON list of [name, start, length, type or
labels], and ``--length``), those of deleted files go;
clean: typed arrest records are repaired; anonymize: repaired records become the release
files.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from .plans import cleaning, release
from .session import session
from .sources import fixed_width, loads
from .sources.tabledef import TableDef


def import_records(spark: SparkSession, source: str, target: str, layout: str, length: int) -> DataFrame:
    """Typed records with their file, number and key: files that are new or changed since the last import are loaded."""
    with open(layout, encoding="utf-8") as f:
        table = TableDef.of("records", [tuple(field) for field in json.load(f)], length)

    def parse(records: DataFrame) -> DataFrame:
        return table.typed(table.split(records)).withColumn("internal_uid", fixed_width.uid())

    loaded = loads.Loads(spark, target, parse)
    loaded.run(source)
    return loaded.rows()


def clean(spark: SparkSession, source: str, target: str) -> DataFrame:
    cleaning.clean_arrests(loads.read(spark, source)).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def anonymize(spark: SparkSession, source: str, target: str, k: int = 5, least: int = 5, counties: str | None = None, groups: str | None = None) -> dict[str, str]:
    """The release files; ``counties`` is a CSV of code and name, ``groups`` a JSON list of lists of names that become one county."""
    table = None
    if counties:
        joined = []
        if groups:
            with open(groups, encoding="utf-8") as f:
                joined = json.load(f)
        table = release.county_table(spark.read.schema("code int, name string").option("header", "true").csv(counties), joined)
    rows = release.protect(release.prepare(spark.read.parquet(source), table), release.standard_passes(k, least))
    return release.write_files(rows, target)


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(prog="python -m ledgerloom", description=__doc__)
    parser.add_argument("verb", choices=["import", "clean", "anonymize"])
    parser.add_argument("source")
    parser.add_argument("target")
    parser.add_argument("--layout")
    parser.add_argument("--length", type=int)
    parser.add_argument("--counties")
    parser.add_argument("--groups")
    parser.add_argument("--k", type=int, default=5)
    parser.add_argument("--least", type=int, default=5)
    asked = parser.parse_args(arguments)
    spark = spark or session(f"ledgerloom {asked.verb}")
    if asked.verb == "import":
        if not asked.layout or not asked.length:
            parser.error("import needs --layout and --length")
        import_records(spark, asked.source, asked.target, asked.layout, asked.length)
    elif asked.verb == "clean":
        clean(spark, asked.source, asked.target)
    else:
        anonymize(spark, asked.source, asked.target, asked.k, asked.least, asked.counties, asked.groups)


if __name__ == "__main__":
    main()
