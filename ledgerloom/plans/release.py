"""Public use files: adults only, generalized, then cells suppressed for k and l in several passes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..durable import cut
from ..functions.predicates import is_in, not_in
from ..functions.recode import RELEASE_BANDS, release_race, right_closed
from ..operators.aggregates import weighted_rate
from ..operators.risk import suppress_small, suppress_uniform
from .summaries import complaint_sought

IDENTIFIERS = ["gender", "race", "age"]


@dataclass(frozen=True)
class Pass:
    """k: least rows a cell; l: least distinct sensitive values a cell."""

    name: str
    among: Column | None
    k: int = 0
    least: int = 0
    only: Column | None = None


def standard_passes(k: int = 5, least: int = 5, drawn_offenses: Sequence[int] = ()) -> list[Pass]:
    """Overlapping subsets, the narrowest first, by rows and then by sensitive values."""
    released, sought, felony = is_in(F.col("disposition"), ["released"]), is_in(F.col("disposition"), ["complaint sought"]), is_in(F.col("offense_level"), ["felony"])
    other = not_in(F.col("disposition"), ["complaint sought"]) | not_in(F.col("offense_level"), ["felony"])
    return [
        Pass("released", released, k=k, only=is_in(F.col("offense_code"), drawn_offenses)),
        Pass("felony referred", sought & felony, k=k),
        Pass("felony released", released & felony, k=k),
        Pass("not felony referred", other, k=k),
        Pass("all", None, k=k),
        Pass("felony referred", sought & felony, least=least),
        Pass("not felony referred", other, least=least),
        Pass("felony released", released & felony, least=least),
        Pass("all", None, least=least),
    ]


def prepare(arrests: DataFrame, counties: DataFrame | None = None) -> DataFrame:
    """Adults, with the county from the jurisdiction code, grouped races, age bands and merged dispositions.

    counties: code and code_new, where small counties are grouped.
    """
    rows = arrests.filter("age > 17").withColumn("county", F.substring("ncic_jurisdiction", 1, 2).try_cast("int"))
    if counties is not None:
        rows = rows.join(counties.select(F.col("code").alias("county"), "code_new"), "county", "left").withColumn("county", F.col("code_new")).drop("code_new")
    return rows.withColumn("race", release_race(F.col("race"))).withColumn("age", right_closed(F.col("age"), RELEASE_BANDS)).withColumn("disposition", complaint_sought(F.col("disposition")))


def protect(rows: DataFrame, passes: Sequence[Pass], within: Sequence[str] = ("year",), identifiers: Sequence[str] = tuple(IDENTIFIERS), column: str = "county", sensitive: Sequence[str] = ("offense_code",)) -> DataFrame:
    """Each pass in turn on what the last one left.

    A pass reads its rows twice (to count cells and to mark them), so what it leaves is kept.
    """
    out = rows
    for p in passes:
        out = cut(out)
        if p.k:
            out = suppress_small(out, within, identifiers, column, p.k, p.only, p.among)
        if p.least:
            out = suppress_uniform(out, within, identifiers, column, sensitive, p.least, p.among)
    return out


def write_files(rows: DataFrame, folder: str, columns: Sequence[str] = ("year", "county", "gender", "race", "age", "offense_code", "offense_level", "disposition")) -> dict[str, str]:
    """The release files, delimited with a header: all rows, those released and those whose complaint was sought; name to path."""
    from ..sources.catalog import write_csv

    parts = {"all": F.lit(True), "released": is_in(F.col("disposition"), ["released"]), "complaint_sought": is_in(F.col("disposition"), ["complaint sought"])}
    kept = cut(rows.select(*columns, "disposition") if "disposition" not in columns else rows.select(*columns))
    for name, among in parts.items():
        write_csv(kept.filter(among).select(*columns), f"{folder}/{name}")
    return {name: f"{folder}/{name}" for name in parts}


def county_table(names: DataFrame, groups: Sequence[Sequence[str]]) -> DataFrame:
    """code, name, code_new and name_new: groups take their first county's code and joined names, codes renumbered from 1.

    names: code and name, one row a county; the table is small and numbered as a whole.
    """
    from pyspark.sql import Window

    code, name = F.col("code"), F.regexp_replace("name", " County$", "")
    group = F.lit(None).cast("string")
    for g in groups:
        group = F.when(name.isin(list(g)), F.lit("/".join(g))).otherwise(group)
    named = names.select(code, name.alias("name"), F.coalesce(group, name).alias("name_new"))
    lead = named.withColumn("first", F.col("name") == F.get(F.split("name_new", "/"), F.lit(0))).groupBy("name_new").agg(F.coalesce(F.min(F.when(F.col("first"), F.col("code"))), F.min("code")).alias("lead"))
    return named.join(lead, "name_new").withColumn("code_new", F.dense_rank().over(Window.orderBy("lead"))).select("code", "name", "code_new", "name_new")


def state_rollup(counties: DataFrame, year: str, measures: Sequence[str], rates: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """County rows to one a year: measures summed without nulls, shares weighted by another measure; rates: name to (share, weight)."""
    weighted = [F.floor(weighted_rate(share, weight) * 10).alias(name) for name, (share, weight) in (rates or {}).items()]
    out = counties.groupBy(year).agg(*(F.sum(m).alias(m) for m in measures), *weighted)
    for name in rates or {}:
        out = out.withColumn(name, F.col(name) / 10)
    return out


def wide_summary(rows: DataFrame, keys: Sequence[str], codes: Sequence[int], code: str = "summary_code", form: str = "SCO%02d_sum") -> DataFrame:
    """Counts of each summary code as columns."""
    out = rows.groupBy(*keys).pivot(code, list(codes)).agg(F.count(F.lit(1)))
    return out.select(*keys, *(F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("long").alias(form % c) for c in codes))
