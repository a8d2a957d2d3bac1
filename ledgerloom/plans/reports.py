"""Reports on how arrests end: disposition shares by agency, and how many arrests have a booking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..durable import cut
from ..operators.ordering import numbered
from ..operators.quantiles import quantiles

#: Where a case ends: in court, with the police, with the prosecutor.
CLASSES = ("crt", "lea", "da")

# The dispositions of each class, as recorded.
COURT = ("acquitted", "certified_to_juvenile_court", "convicted", "defendant_deceased", "dismissed", "diversion_dismissed", "not_guilty_insane")
RELEASED = (
    "lea_rel_arrestee_exonerated",
    "lea_rel_complaintant_refuses",
    "lea_rel_further_investigation",
    "lea_rel_inadmissable_search",
    "lea_rel_lack_of_corpus",
    "lea_rel_other",
    "lea_rel_unspecified",
)
DECLINED = (
    "da_dec_combined_cases",
    "da_dec_complaintant_refuses",
    "da_dec_deferred_recovation_of_parole",
    "da_dec_inadmissable_search",
    "da_dec_interest_of_justice",
    "da_dec_lack_of_cause",
    "da_dec_lack_of_corpus",
    "da_dec_other",
    "da_dec_probation_revoked_1203_2PC",
    "da_dec_prosecution_prefiling_deferred",
    "da_dec_witness_unavailable",
)


def classified(disposition: Column) -> Column:
    """The class of a disposition; one that no class has stays as it is."""
    of = dict(zip(CLASSES, (COURT, RELEASED, DECLINED), strict=True))
    out = disposition
    for name, values in of.items():
        out = F.when(disposition.isin(*values), F.lit(name)).otherwise(out)
    return out


def disposition_class(court: Column, arrest: Column) -> Column:
    """The court's disposition where there is one, else that of the arrest."""
    return F.coalesce(court, arrest)


def disposition_shares(rows: DataFrame, keys: Sequence[str], column: str = "class", classes: Sequence[str] = CLASSES) -> DataFrame:
    """keys, n and each class's share in per cent of the rows that have one."""
    share = lambda c: (F.lit(100.0) * F.count(F.when(F.col(column) == c, 1)).cast("double") / F.count("*")).alias(c)
    return rows.filter(F.col(column).isNotNull()).groupBy(*keys).agg(F.count("*").alias("n"), *map(share, classes))


def median_ranked(shares: DataFrame, unit: str, share: str) -> DataFrame:
    """unit, the median of its shares over the periods, and its place from the least and from the most (ties by unit)."""
    medians = quantiles(cut(shares), [unit], share, {"median": 0.5}).withColumn("median", F.round("median", 9))
    placed = numbered(medians, ["median", unit], "from_least")
    return numbered(placed, [F.desc("median"), unit], "from_most").select(unit, "median", "from_least", "from_most")


def match_rates(rows: DataFrame, keys: Sequence[str], flag: str, least: int = 1) -> DataFrame:
    """keys, n, n_matched and rate in per cent, of groups of at least so many rows."""
    matched = F.count(F.when(F.col(flag), 1))
    rates = rows.groupBy(*keys).agg(F.count("*").alias("n"), matched.alias("n_matched"), (F.lit(100.0) * matched.cast("double") / F.count("*")).alias("rate"))
    return rates.filter(F.col("n") >= least)
