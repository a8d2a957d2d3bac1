"""Repairs that cleaning runs in a fixed order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import age_by_month, birth_year, date_of, days_between, full_year
from ..functions.recode import remap, without


def clean_arrests(rows: DataFrame) -> DataFrame:
    """Deleted records go; blank codes are null; underscores are blanks; letter races join digit ones."""
    out = rows.na.drop(how="all", subset=["age", "race", "gender"])
    blank = {"bcs_jurisdiction": ["     "], "ncic_jurisdiction": ["  \x7f\x7f", "    "], "fbi_offense_code": ["    "]}
    for c, values in blank.items():
        out = out.withColumn(c, without(F.col(c), values))
    out = out.withColumn("fbi_offense_code", F.trim("fbi_offense_code"))
    for c in ("offense_level", "disposition"):
        out = out.withColumn(c, F.translate(c, "_", " "))
    race = F.regexp_replace("race", "_[a-z]$", "")
    return out.withColumn("race", F.translate(race, "_", " ")).withColumn("arrest_date", date_of(F.col("arrest_year"), F.col("arrest_month"), F.col("arrest_day")))


def clean_dispositions(rows: DataFrame) -> DataFrame:
    """Two-digit years, then birth years, then zeros and the sentinel they turn into, then ages and delays.

    The order matters: 1899-99-99 only exists once two-digit birth years have a century.
    """
    out = rows.withColumn("court_year", full_year(F.col("court_year"))).withColumn("arrest_year", full_year(F.col("arrest_year"), 101))
    out = out.withColumn("birth_year", birth_year(F.col("birth_year"), F.col("court_year")))
    sentinel = (F.col("birth_year") == 1899) & (F.col("birth_month") == 99) & (F.col("birth_day") == 99)
    for c in ("birth_year", "birth_month", "birth_day"):
        out = out.withColumn(f"_{c}", F.when(F.coalesce(sentinel, F.lit(False)) | (F.col(c) == 0), None).otherwise(F.col(c)))
    out = out.drop("birth_year", "birth_month", "birth_day").withColumnsRenamed({f"_{c}": c for c in ("birth_year", "birth_month", "birth_day")})
    for c in ("court_month", "court_day", "arrest_month", "arrest_day"):
        out = out.withColumn(c, without(F.col(c), [0]))
    court, arrest = date_of(F.col("court_year"), F.col("court_month"), F.col("court_day")), date_of(F.col("arrest_year"), F.col("arrest_month"), F.col("arrest_day"))
    return out.withColumn("age", age_by_month(F.col("birth_year"), F.col("birth_month"), F.col("arrest_year"), F.col("arrest_month"))).withColumn("days_to_disposition", days_between(court, arrest))


def merge_spellings(rows: DataFrame) -> DataFrame:
    """Juvenile referral columns: one spelling each, and clearer names."""
    out = rows.withColumn("referral_source", remap(F.col("referral_source"), [["Lae Enforcement Agency", "Law Enforcement Agency"]], ["Law Enforcement Agency"]))
    out = out.withColumn("detention", remap(F.col("detention"), [["Detained - Secure Facility", "Detained-Secure Facility"]], ["Detained - Secure Facility"]))
    return out.withColumnsRenamed({"fitness_hearing_out_desc": "fitness_hearing_result", "county_desc": "referral_county_name"})


def time_to_disposition(rows: DataFrame, court_classes: list[str], limits: tuple[int, int]) -> DataFrame:
    """Days from arrest to the date that the disposition's class refers to, within limits."""
    ended = F.when(F.col("disposition_class").isin(court_classes), F.col("court_date")).otherwise(F.col("arrest_disposition_date"))
    return rows.withColumn("days", days_between(ended, F.col("arrest_date"))).filter(F.col("days").between(*limits))
