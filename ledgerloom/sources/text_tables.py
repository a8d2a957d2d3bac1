"""Tables that manuals print as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import carried

# Statute code types, as the code manual abbreviates them.
STATUTES = "VC PC FA LC BP HN WI SH MV IC CI CP FG HS FC UI CC PU PR RT GC EL EC US CA WC ZZ UF".split()

# District names that don't follow "place - court".
ODD_DISTRICTS = {
    "Nevada County Court Nevada": ("Nevada County Court", "Nevada"),
    "Placer County Court - Colfax- Alta - Dutch Flat": ("Placer County Court", "Colfax/Alta/Dutch Flat"),
    "Plumas County Court - Almanor - Chester Branch": ("Plumas County Court", "Almanor/Chester Branch"),
    "Sacramento Court - Fair Oaks - Folsom": ("Sacramento County Court", "Fair Oaks/Folsom"),
    "San Benito Municip- Hollister": ("San Benito County Court", "Hollister"),
    "Shasta County Court Central Valley": ("Shasta County Court", "Central Valley"),
    "Tuolumne Court _ Fifth (Jamestown)": ("Tuolumne Court", "Fifth (Jamestown)"),
}


def columns_of(line: Column) -> Column:
    """The columns of a line that two or more blanks divide."""
    return F.split(F.trim(line), r"\s{2,}")


def split_manual(lines: DataFrame, line: str = "line", order: str = "lineno") -> DataFrame:
    """Columns of a code manual's lines, found from the statute type and then from the right.

    A line without a statute type is cut where the line before it was; manuals of any length
    are scanned in ranges of lines, to which the last cut is carried.
    """
    where = F.regexp_instr(F.col(line), F.lit(rf"\s({'|'.join(STATUTES)})\s"))
    cut = carried(lines.select(order, line).withColumn("own_cut", F.when(where > 0, where)), [], order, "own_cut", "cut")
    prefix, suffix = F.expr(f"substring({line}, 1, cut)"), F.expr(f"substring({line}, cut + 1)")
    parts = cut.withColumn("prefix", prefix).withColumn("suffix", suffix)
    tail = r"^(.*?)([FMNIS])?\s*([0-9]{2})\s+([0-9]+)$"
    kind = F.trim(F.substring("suffix", 1, 2))
    piece = lambda n: F.regexp_extract(F.rtrim("suffix"), tail, n)
    return parts.select(
        order,
        F.trim(F.substring("prefix", 1, 5)).alias("code"),
        F.trim(F.expr("substring(prefix, 6)")).alias("statute"),
        F.when(kind != "", kind).alias("code_type"),
        F.trim(F.expr(f"substring(regexp_extract(rtrim(suffix), '{tail.replace(chr(92), chr(92) * 2)}', 1), 3)")).alias("literal"),
        F.when(piece(2) != "", piece(2)).alias("offense_class"),
        piece(3).try_cast("int").alias("summary_code"),
        piece(4).try_cast("int").alias("hierarchy"),
    )


def split_district(name: Column) -> tuple[Column, Column, Column]:
    """county, type and agency of a judicial district's name."""
    parts = F.split(name, " - ")
    court, agency = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    for odd, (a, b) in ODD_DISTRICTS.items():
        court = F.when(name == odd, a).otherwise(court)
        agency = F.when(name == odd, b).otherwise(agency)
    court = F.when(F.lower(court).contains("county"), court).otherwise(F.regexp_replace(court, "Court", "County Court"))
    county = F.get(F.split(court, " County "), F.lit(0))
    kind = F.get(F.split(court, " County "), F.lit(1))
    labels = F.when(kind.startswith("Arrest"), "Arrest").when(kind.startswith("Juvenile"), "Juvenile").otherwise("County")
    return F.when(county == "El Dorada", "El Dorado").otherwise(county), labels, agency
