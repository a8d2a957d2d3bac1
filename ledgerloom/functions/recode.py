"""Recoding: merged levels, bands, sentinels, and the code tables that results depend on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .predicates import is_in

# Race codes of arrest records, the digits used before 1991 and the letters since.
RACE_CODES = {
    "1": "White",
    "2": "Hispanic",
    "3": "Black",
    "4": "American Indian",
    "5": "Chinese",
    "6": "Japanese",
    "7": "Filipino",
    "8": "Other",
    "9": "Pacific Islander",
    "A": "Other Asian",
    "B": "Black",
    "C": "Chinese",
    "D": "Cambodian",
    "F": "Filipino",
    "G": "Guamanian",
    "H": "Hispanic",
    "I": "American Indian",
    "J": "Japanese",
    "K": "Korean",
    "L": "Laotian",
    "O": "Other",
    "P": "Pacific Islander",
    "S": "Samoan",
    "U": "Hawaiian",
    "V": "Vietnamese",
    "W": "White",
    "Z": "Asian Indian",
}

# Juvenile court dispositions.
JUVENILE_DISPOSITIONS = {
    "10": "Dismissed",
    "12": "Transferred",
    "13": "Remanded to Adult Court",
    "14": "Deported",
    "15": "Traffic Court",
    "16": "Direct File - Adult Court",
    "20": "Informal Probation (654 WI)",
    "21": "Informal Probation (654.2 WI)",
    "30": "Non-Ward Probation (725(a) WI)",
    "40": "Wardship (Own/Relative's Home)",
    "41": "Wardship (Non-secure County Facility)",
    "42": "Wardship (Secure County Facility - Includes Electronic Monitoring)",
    "43": "Wardship (Other Public Facility)",
    "44": "Wardship (Private Facility)",
    "49": "Wardship (Other)",
    "50": "Wardship (CYA)",
    "60": "Diversion",
    "61": "Deferred Entry of Judgment",
}

# Small counties that releases report together.
COUNTY_GROUPS = [
    ["Alpine", "Tuolumne", "Calaveras", "Amador"],
    ["Colusa", "Glenn", "Yuba", "Sutter", "Lake"],
    ["Sierra", "Plumas", "Lassen", "Modoc", "Nevada"],
    ["Inyo", "Mono", "Mariposa", "Madera", "San Benito"],
    ["Trinity", "Del Norte", "Siskiyou", "Tehama"],
]

# Groups that releases report as one.
ASIAN_GROUPS = ["Chinese", "Asian Indian", "Cambodian", "Guamanian", "Filipino", "Hawaiian", "Japanese", "Korean", "Laotian", "other Asian", "Pacific Islander", "Samoan", "Vietnamese"]

# Last age of each population band; older and unknown ages are 60+.
POPULATION_BANDS = [(9, "0-9"), (14, "10-14"), (17, "15-17"), (24, "18-24"), (29, "25-29"), (39, "30-39"), (49, "40-49"), (59, "50-59")]

# Right-closed age bands of the public use file.
RELEASE_BANDS = [(17, 24, "18-24"), (24, 32, "25-32"), (32, 44, "33-44"), (44, 150, "45+")]


def remap(c: Column, groups: Sequence[Sequence[str] | str], names: Sequence[str]) -> Column:
    """Levels of each group under the group's name; other values and null stay."""
    if len(groups) != len(names):
        raise ValueError("one name for each group")
    out = c
    for group, name in reversed([*zip(groups, names, strict=True)]):
        out = F.when(is_in(c, [group] if isinstance(group, str) else group), F.lit(name)).otherwise(out)
    return out


def race_label(code: Column) -> Column:
    """One label set for both generations of race codes; blank and unknown codes are null."""
    return F.try_element_at(F.create_map(*(F.lit(x) for item in RACE_CODES.items() for x in item)), code)


def juvenile_disposition(code: Column) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for item in JUVENILE_DISPOSITIONS.items() for x in item)), code)


def county_group(name: Column) -> Column:
    """Small counties under their group's joined name."""
    plain = F.regexp_replace(name, r" County$", "")
    return remap(plain, COUNTY_GROUPS, ["/".join(g) for g in COUNTY_GROUPS])


def release_race(race: Column) -> Column:
    return remap(race, [ASIAN_GROUPS, "American Indian"], ["Asian or Pac Isl", "other"])


def right_closed(c: Column, bands: Sequence[tuple[float, float, str]]) -> Column:
    """The band (low, high] that holds c, or null."""
    out = F.lit(None).cast("string")
    for low, high, name in bands:
        out = F.when((c > low) & (c <= high), F.lit(name)).otherwise(out)
    return out


def population_band(age: Column) -> Column:
    """The band of an age; a missing age falls into the last."""
    out = F.lit("60+")
    for last, name in reversed(POPULATION_BANDS):
        out = F.when(age <= last, F.lit(name)).otherwise(out)
    return out


def age_class(age: Column) -> Column:
    """Juvenile below 18; Adult otherwise, and where the age is unknown."""
    return F.when(age < 18, F.lit("Juvenile")).otherwise(F.lit("Adult"))


def without(c: Column, sentinels: Sequence) -> Column:
    """Null where c is a sentinel."""
    return F.when(~is_in(c, sentinels), c)


def tidy_name(c: Column) -> Column:
    """Lower case, runs of other characters than letters and digits as one underscore."""
    return F.lower(F.regexp_replace(c, r"[^A-Za-z0-9]+", "_"))


def shortened(c: Column, most: int) -> Column:
    """At most ``most`` characters, the last three of a longer text being dots."""
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, most - 3), F.lit("..."))).otherwise(c)


def floor_tenth(c: Column) -> Column:
    return F.floor(c * 10) / 10


def per_cent(part: Column, whole: Column) -> Column:
    """100 * part / whole in double precision, null for an empty whole."""
    return F.lit(100.0) * part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def per_100k(part: Column, whole: Column) -> Column:
    return F.lit(100000.0) * part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def logit(p: Column) -> Column:
    """log(p / (1 - p)), null outside (0, 1)."""
    return F.when((p > 0) & (p < 1), F.log(p / (1 - p)))


def logistic(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def smoothed_ratio(x: Column, y: Column, by: float = 0.0001) -> Column:
    return x / (F.lit(by) + y)


def magnitude(n: Column, cuts: Sequence[int] = (100000, 10000, 1000, 100, 10, 1)) -> Column:
    """The largest cut that n reaches; 0 below all."""
    out = F.lit(0)
    for c in sorted(cuts):
        out = F.when(n >= c, F.lit(c)).otherwise(out)
    return out
