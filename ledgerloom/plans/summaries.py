"""The summary layer: arrests by jurisdiction and group, population shares, rates and disparity.

Inputs: arrests (year, ncic_jurisdiction, offense_level, offense_code, summary_code,
status_type, race, gender, age), jurisdictions (ncic_jurisdiction, county), demographics
(year, county, race, gender, age_group, population; totals labelled ``All Combined``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.recode import age_class, per_100k, per_cent, smoothed_ratio
from ..operators.aggregates import ALL, cube_within

OFFENSE = ["offense_level", "offense_code", "summary_code", "status_type"]


def arrest_summary(arrests: DataFrame, jurisdictions: DataFrame) -> DataFrame:
    """Counts by nine keys with the county: counted before the county is looked up."""
    counted = arrests.withColumn("age_group", age_class(F.col("age"))).groupBy("year", "ncic_jurisdiction", *OFFENSE, "race", "gender", "age_group").agg(F.count("*").alias("arrests"))
    return counted.join(jurisdictions, "ncic_jurisdiction", "left").select("year", "ncic_jurisdiction", "county", *OFFENSE, "race", "gender", "age_group", "arrests")


def arrest_cube(summary: DataFrame, offense: Sequence[str] = OFFENSE) -> DataFrame:
    """The summary with totals over race, gender and age group, by jurisdiction and statewide: one aggregate."""
    return cube_within(summary, ["year", *offense], ["race", "gender", "age_group"], "arrests", "arrests", together=[["ncic_jurisdiction", "county"]])


def year_jurisdiction_offense(arrests: DataFrame, jurisdictions: DataFrame) -> DataFrame:
    counted = arrests.groupBy("year", "ncic_jurisdiction", *OFFENSE, "race").agg(F.count("*").alias("total"))
    return counted.join(jurisdictions, "ncic_jurisdiction", "left")


def _county_totals(demographics: DataFrame) -> DataFrame:
    whole = demographics.filter((F.col("gender") == ALL) & (F.col("age_group") == ALL))
    return whole.groupBy("year", "county").agg(F.max("population").alias("county_population"))


def year_county_race(demographics: DataFrame) -> DataFrame:
    """Each race's share of its county's population."""
    whole = demographics.filter((F.col("gender") == ALL) & (F.col("age_group") == ALL)).select("year", "county", "race", "population")
    joined = _county_totals(demographics).join(whole, ["year", "county"], "left")
    return joined.select("year", "county", "race", "population", per_cent(F.col("population"), F.col("county_population")).alias("percentage"))


def demographic_summary(demographics: DataFrame, groups: Sequence[str] = (ALL, "Juvenile", "Adult")) -> DataFrame:
    """Each group's share of its county's population."""
    part = demographics.filter(F.col("age_group").isin(list(groups))).select("year", "county", "race", "gender", "age_group", "population")
    joined = _county_totals(demographics).join(part, ["year", "county"], "left")
    return joined.select("year", "county", "race", "gender", "age_group", "population", per_cent(F.col("population"), F.col("county_population")).alias("percentage"))


def arrest_rates(offenses: DataFrame, shares: DataFrame, after: int, before: int) -> DataFrame:
    """Arrests per 100,000 by race and year, years strictly between the bounds."""
    arrested = offenses.filter((F.col("year") > after) & (F.col("year") < before)).groupBy("year", "race").agg(F.sum("total").alias("n"))
    people = shares.filter((F.col("county") == ALL) & (F.col("race") != ALL)).select("year", "race", "population")
    return people.join(arrested, ["year", "race"]).select("year", "race", per_100k(F.col("n"), F.col("population")).alias("arrest_rate"))


def rates_wide(rates: DataFrame, years: Sequence[int]) -> DataFrame:
    """One row a race and one column a year."""
    return rates.groupBy("race").pivot("year", list(years)).agg(F.first("arrest_rate"))


def disparity(offenses: DataFrame, shares: DataFrame, by: Sequence[str] = (), status: str | None = None) -> DataFrame:
    """A race's share of arrests over its share of the population, statewide, by year and more."""
    rows = offenses.filter(F.col("status_type") == status) if status else offenses
    of_race = _shares_of(rows, ["year", *by])
    people = shares.filter((F.col("county") == ALL) & (F.col("race") != ALL)).select("year", "race", "percentage")
    return people.join(of_race, ["year", "race"]).select("year", "race", *by, (F.col("percent_arrests") / F.nullif(F.col("percentage"), F.lit(0.0))).alias("disparity_index"))


def _shares_of(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    part = rows.groupBy(*keys, "race").agg(F.sum("total").alias("n_race"))
    total = part.groupBy(*keys).agg(F.sum("n_race").alias("n_all"))
    return part.join(total, list(keys)).withColumn("percent_arrests", per_cent(F.col("n_race"), F.col("n_all")))


def disparity_by_code(offenses: DataFrame, shares: DataFrame, codes: DataFrame, new_from: int = 2013) -> DataFrame:
    """By summary offense code, each year named by the code book in force; codes: summary_code, offense_type, before_new."""
    named = codes.select("summary_code", "offense_type", "before_new").distinct()
    parts = []
    for old in (True, False):
        years = F.col("year") < new_from if old else F.col("year") >= new_from
        of_race = _shares_of(offenses.filter(years), ["year", "summary_code"])
        book = named.filter(F.col("before_new") == old).select("summary_code", "offense_type")
        parts.append(of_race.join(book, "summary_code").select("year", "race", "summary_code", "offense_type", "percent_arrests"))
    both = parts[0].union(parts[1]).distinct()
    people = shares.filter((F.col("county") == ALL) & (F.col("race") != ALL)).select("year", "race", "percentage")
    return people.join(both, ["year", "race"]).select("year", "race", "summary_code", "offense_type", (F.col("percent_arrests") / F.nullif(F.col("percentage"), F.lit(0.0))).alias("disparity_index"))


def disparity_by_county(offenses: DataFrame, shares: DataFrame, status: str) -> DataFrame:
    """By county, the population share kept from 0 by a small addend."""
    of_race = _shares_of(offenses.filter(F.col("status_type") == status), ["year", "county"])
    people = shares.filter((F.col("county") != ALL) & (F.col("race") != ALL))
    joined = people.join(of_race, ["year", "county", "race"])
    return joined.select("year", "county", "race", "population", F.col("percentage").alias("percent_population"), smoothed_ratio(F.col("percent_arrests"), F.col("percentage")).alias("disparity_index"), F.col("n_race"), F.col("n_all"))


def population_cube(people: DataFrame, measure: str = "population") -> DataFrame:
    """Population by year over every subset of county, race, gender and age group."""
    return cube_within(people, ["year"], ["county", "race", "gender", "age_group"], measure, measure)


def age_at_risk(rows: DataFrame, low: int = 5, high: int = 89, age: str = "age") -> DataFrame:
    """Without implausible ages: at most ``low`` or at least ``high``; unknown ages go too."""
    return rows.filter((F.col(age) > low) & (F.col(age) < high))


def complaint_sought(disposition: Column) -> Column:
    return F.when(disposition.isin("felony complaint sought", "misdemeanor complaint sought"), F.lit("complaint sought")).otherwise(disposition)
