"""Disclosure risk of rows: how many others each could be, and what that reveals.

Keys are nullable strings; a null key stands for any value, on either side.  Rows are
counted by pattern first, and all matching is between patterns, so the cost follows the
number of distinct patterns rather than rows.  Results are per row, whatever the order of
the strata.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import product

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..durable import cut

RiskFunction = Callable[[dict], float]
NULL_LEVEL = "NA"


def check(rows: DataFrame, keys: Sequence[str], strata: Sequence[str] = (), div: str | Sequence[str] | None = None, risk: object = None) -> None:
    """Raises ValueError for unknown columns and for columns in two parts."""
    divs = [div] if isinstance(div, str) else list(div or ())
    if len(divs) > 1:
        raise ValueError("at most one diversity column")
    if not keys:
        raise ValueError("no keys")
    for name in (*keys, *strata, *divs):
        if name not in rows.columns:
            raise ValueError(f"no column {name!r}")
    for a, b, what in ((divs, keys, "diversity column among the keys"), (strata, keys, "strata among the keys"), (divs, strata, "diversity column among the strata")):
        if set(a) & set(b):
            raise ValueError(what)
    if risk is not None and not callable(risk) and not isinstance(risk, Column):
        raise ValueError("risk must be a function or a built-in")
    if risk is not None and not divs:
        raise ValueError("a risk function needs a diversity column")


def patterns(rows: DataFrame, keys: Sequence[str], strata: Sequence[str] = (), div: str | None = None, name: str = "n", weight: str | None = None) -> DataFrame:
    """Distinct strata, keys (and sensitive level) with their numbers of rows, or sums of ``weight``."""
    return rows.groupBy(*strata, *keys, *([div] if div else [])).agg((F.sum(weight) if weight else F.count("*")).alias(name))


def _mask(keys: Sequence[str]) -> Column:
    """Which keys are null, as bits."""
    mask = F.lit(0).cast("long")
    for i, k in enumerate(keys):
        mask = mask + F.when(F.col(k).isNull(), F.lit(1 << i)).otherwise(F.lit(0))
    return mask


def _blanked(keys: Sequence[str], mask: str, other: str) -> list[Column]:
    """Keys with a placeholder wherever either side is null."""
    return [F.when((F.col(mask).bitwiseOR(F.col(other)).bitwiseAND(F.lit(1 << i))) != 0, F.lit(None).cast("string")).otherwise(F.col(k).cast("string")).alias(f"_k{i}") for i, k in enumerate(keys)]


def compatible_counts(rows: DataFrame, keys: Sequence[str], strata: Sequence[str] = (), div: str | None = None, name: str = "n", weight: str | None = None) -> DataFrame:
    """For each pattern of strata and keys: how many rows (of each sensitive level) are compatible.

    One equi-join: both sides are repeated for each null mask that occurs, keys null on
    either side are blanked, and masks and blanked keys must be equal.
    """
    pats = patterns(rows, keys, strata, div, "_n", weight).withColumn("_mask", _mask(keys))
    masks = pats.select(F.col("_mask").alias("_other")).distinct()
    mine = pats.select(*strata, *keys, "_mask").distinct().crossJoin(masks)
    theirs = pats.crossJoin(masks)
    by = [*(f"_s{i}" for i in range(len(strata))), *(f"_k{i}" for i in range(len(keys)))]
    stratum = [F.col(s).cast("string").alias(f"_s{i}") for i, s in enumerate(strata)]
    left = mine.select(*strata, *keys, F.col("_mask").alias("_a"), F.col("_other").alias("_b"), *stratum, *_blanked(keys, "_mask", "_other"))
    level = [F.coalesce(F.col(div).cast("string"), F.lit(NULL_LEVEL)).alias("_level")] if div else []
    right = theirs.select(F.col("_other").alias("_a"), F.col("_mask").alias("_b"), *stratum, *_blanked(keys, "_mask", "_other"), *level, "_n")
    right = right.groupBy("_a", "_b", *by, *(["_level"] if div else [])).agg(F.sum("_n").alias("_n"))
    # A null stands for a blank, so the keys are hashed with a mark and compared null-safe.
    tag = lambda df: df.withColumn("_h", F.xxhash64(*(F.coalesce(F.concat(F.lit("="), c), F.lit("")) for c in by)))
    x, y = tag(left).alias("x"), tag(right).alias("y")
    on = (F.col("x._a") == F.col("y._a")) & (F.col("x._b") == F.col("y._b")) & (F.col("x._h") == F.col("y._h"))
    for c in by:
        on = on & F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}"))
    joined = x.join(y, on).select(*(F.col(f"x.{c}").alias(c) for c in (*strata, *keys)), *([F.col("y._level").alias("_level")] if div else []), F.col("y._n").alias("_n"))
    return joined.groupBy(*strata, *keys, *(["_level"] if div else [])).agg(F.sum("_n").alias(name))


def _back(rows: DataFrame, by: DataFrame, columns: Sequence[str], wanted: Sequence[str]) -> DataFrame:
    """Each row with what its pattern has."""
    renamed = by.select(*(F.col(c).alias(f"_p_{c}") for c in columns), *wanted)
    on = None
    for c in columns:
        equal = F.col(c).eqNullSafe(F.col(f"_p_{c}"))
        on = equal if on is None else on & equal
    return rows.join(renamed, on, "left").drop(*(f"_p_{c}" for c in columns))


# Built-in risks: columns over a map from sensitive level to number of compatible rows.
def diversity(levels: Column) -> Column:
    """The number of levels that occur."""
    return F.size(F.map_filter(levels, lambda _, n: n > 0)).cast("double")


def share_of(*names: str) -> Callable[[Column], Column]:
    """The share of rows with one of these levels."""

    def risk(levels: Column) -> Column:
        part = F.aggregate(F.map_values(F.map_filter(levels, lambda k, _: k.isin(list(names)))), F.lit(0).cast("long"), lambda a, n: a + n)
        whole = F.aggregate(F.map_values(levels), F.lit(0).cast("long"), lambda a, n: a + n)
        return part.cast("double") / whole

    return risk


def present(name: str) -> Callable[[Column], Column]:
    """1 where the level occurs, else 0."""
    return lambda levels: F.coalesce(F.try_element_at(levels, F.lit(name)) > 0, F.lit(False)).cast("double")


def custom(f: RiskFunction) -> Callable[[Column], Column]:
    """Any function of a dict from level to number of rows, by a pandas UDF over patterns."""

    @F.pandas_udf(T.DoubleType())
    def run(levels: pd.Series) -> pd.Series:
        return levels.map(lambda m: float(f(dict(m))))

    return lambda levels: run(levels)


def calc_risk(rows: DataFrame, keys: Sequence[str], strata: Sequence[str] = (), div: str | None = None, risk: Callable[[Column], Column] | None = None, within_completions: bool = False, name: str = "risk", weight: str | None = None) -> DataFrame:
    """Every row with its risk: the number of compatible rows, or a function of their sensitive levels.

    within_completions: the risk is taken over the rows that agree with one full completion
    of the keys or leave them open, and is the least among the completions with the most
    known keys; rows without any known key get 1.  weight: a column that says how many rows
    each row stands for.
    """
    check(rows, keys, strata, div, risk)
    columns = [*strata, *keys]
    if within_completions:
        return _back(rows, completion_risk(rows, keys, strata, div, risk, name, weight), columns, [name])
    found = compatible_counts(rows, keys, strata, div if risk is not None else None, "_n", weight)
    if risk is None:
        by = found.withColumn(name, F.col("_n").cast("double"))
    else:
        by = found.groupBy(*columns).agg(F.map_from_entries(F.collect_list(F.struct("_level", "_n"))).alias("_levels")).withColumn(name, risk(F.col("_levels")))
    return _back(rows, by, columns, [name])


def completion_risk(rows: DataFrame, keys: Sequence[str], strata: Sequence[str], div: str | None, risk: Callable[[Column], Column] | None, name: str, weight: str | None = None) -> DataFrame:
    """Risk by pattern within completions.

    A completion takes each key's value from the levels of the stratum, and pools the patterns
    that equal it where they are known.  Of the completions of a pattern those count that a
    pattern with the most known keys agrees with, and the least risk among them is the pattern's.
    The product of the levels isn't made:

    * the most known keys are those of the patterns compatible with this one, by an equi-join;
    * where these know all keys they are the completions themselves, and their least risk is
      looked up by mask and known keys;
    * else this pattern and each of those are joined, and what stays open takes a level that no
      compatible pattern has, if the stratum has one, which pools least; if not, only the levels
      that compatible patterns have.
    """
    pats = cut(patterns(rows, keys, strata, div if risk is not None else None, "_n", weight))
    own = [f"_e{i}" for i in range(len(keys))]
    stratum = [F.coalesce(F.concat(F.lit("="), F.col(s).cast("string")), F.lit("")) for s in strata]
    coded = [F.concat(F.lit("="), F.col(k).cast("string")).alias(e) for k, e in zip(keys, own, strict=True)]
    level = [F.coalesce(F.col(div).cast("string"), F.lit(NULL_LEVEL)).alias("_level")] if risk is not None else []
    coded_pats = pats.select(F.array(*stratum).alias("_s"), *coded, _mask(keys).alias("_mask"), *level, "_n")
    each = pats.select(*strata, *keys).distinct()
    each = cut(each.select(*strata, *keys, F.array(*stratum).alias("_s"), *coded, _mask(keys).alias("_mask"), F.monotonically_increasing_id().alias("_p")))
    masks = [r[0] for r in each.select("_mask").distinct().collect()]  # at most a power of the number of keys
    known = F.lit(len(keys)) - F.bit_count("_mask")
    everything = (1 << len(keys)) - 1
    asked = each.filter(F.col("_mask") != everything)

    # The most known keys of a compatible pattern.
    theirs = _facing(each.withColumn("_known", known), masks, own).groupBy("_s", "_fit", F.col("_mask").alias("_other"), F.col("_other").alias("_mask")).agg(F.max("_known").alias("_known"))
    most = cut(_facing(asked, masks, own).join(theirs, ["_s", "_fit", "_mask", "_other"]).groupBy("_p").agg(F.max("_known").alias("_most")))

    # Completions that are patterns: their risks, and the least for what each mask leaves of them.
    whole = each.filter("_mask = 0").select("_s", *own, F.col("_p").alias("_c"))
    risked = whole.join(_pooled(whole, coded_pats, masks, own, risk), "_c")
    least = risked.withColumn("_mask", F.lit(0).cast("long"))
    least = _facing(least, masks, own).groupBy("_s", "_fit", F.col("_other").alias("_mask")).agg(F.min("_risk").alias("_risk"))
    complete = _own_fit(asked.join(most.filter(F.col("_most") == len(keys)), "_p"), own).join(least, ["_s", "_fit", "_mask"]).select("_p", "_risk")

    # The others: joined with the most known, open keys filled.
    rest = cut(asked.join(most.filter(F.col("_most") < len(keys)), "_p"))
    found = complete
    if not rest.isEmpty():
        found = found.unionByName(_filled(rest, each, coded_pats, masks, own, risk))
    scored = each.join(found.groupBy("_p").agg(F.min("_risk").alias("_risk")), "_p", "left")
    return scored.select(*strata, *keys, F.when(F.col("_mask") == everything, F.lit(1.0)).otherwise(F.col("_risk")).alias(name))


def _facing(rows: DataFrame, masks: Sequence[int], own: Sequence[str]) -> DataFrame:
    """Rows once for each mask that they may meet, as ``_other``, with what both sides know as ``_fit``."""
    each = rows.withColumn("_other", F.explode(F.array(*(F.lit(m).cast("long") for m in masks))))
    return each.withColumn("_fit", F.array(*(F.when(F.col("_mask").bitwiseOR(F.col("_other")).bitwiseAND(F.lit(1 << i)) == 0, F.col(e)).otherwise(F.lit("")) for i, e in enumerate(own))))


def _own_fit(rows: DataFrame, own: Sequence[str]) -> DataFrame:
    return rows.withColumn("_fit", F.array(*(F.coalesce(F.col(e), F.lit("")) for e in own)))


def _pooled(completions: DataFrame, pats: DataFrame, masks: Sequence[int], own: Sequence[str], risk: Callable[[Column], Column] | None) -> DataFrame:
    """_c and _risk: over the patterns that equal a completion (no key open) wherever they are known."""
    facing = _facing(completions.withColumn("_mask", F.lit(0).cast("long")), masks, own).select("_c", "_s", "_fit", F.col("_other").alias("_mask"))
    met = facing.join(_own_fit(pats, own), ["_s", "_fit", "_mask"])
    if risk is None:
        return met.groupBy("_c").agg(F.sum("_n").cast("double").alias("_risk"))
    by_level = met.groupBy("_c", "_level").agg(F.sum("_n").alias("_n"))
    return by_level.groupBy("_c").agg(F.map_from_entries(F.collect_list(F.struct("_level", "_n"))).alias("_levels")).select("_c", risk(F.col("_levels")).alias("_risk"))


def _filled(rest: DataFrame, each: DataFrame, pats: DataFrame, masks: Sequence[int], own: Sequence[str], risk: Callable[[Column], Column] | None) -> DataFrame:
    """_p and _risk of the completions that join a pattern of ``rest`` with a most known one and pool least beyond."""
    theirs = each.select("_s", "_mask", *own, (F.lit(len(own)) - F.bit_count("_mask")).alias("_known"))
    right = _facing(theirs, masks, own).select("_s", "_fit", F.col("_mask").alias("_other"), F.col("_other").alias("_mask"), F.col("_known").alias("_most"), *(F.col(e).alias(f"q{e}") for e in own))
    pairs = _facing(rest, masks, own).join(right, ["_s", "_fit", "_mask", "_other", "_most"])
    made = pairs.select("_p", "_s", *(F.coalesce(e, f"q{e}").alias(e) for e in own)).distinct()
    for e in own:
        # Few columns go on: the pattern asked for and the keys known so far.
        made = cut(made.withColumn("_c", F.monotonically_increasing_id()))
        open_here = made.filter(F.col(e).isNull())
        mask = F.lit(0).cast("long")
        for i, x in enumerate(own):
            mask = mask + F.when(F.col(x).isNull(), F.lit(1 << i)).otherwise(F.lit(0))
        open_here = open_here.withColumn("_mask", mask)
        made_masks = [r[0] for r in open_here.select("_mask").distinct().collect()]
        done = made.filter(F.col(e).isNotNull()).select("_p", "_s", *own)
        if not made_masks:
            made = done
            continue
        there = theirs.filter(F.col(e).isNotNull()).withColumn("_v", F.col(e))
        sent = _facing(there, made_masks, own).select("_s", "_fit", F.col("_mask").alias("_other"), F.col("_other").alias("_mask"), "_v").distinct()
        met = _facing(open_here, masks, own).join(sent, ["_s", "_fit", "_mask", "_other"]).select("_c", "_v").distinct()
        n_levels = there.groupBy("_s").agg(F.count_distinct("_v").alias("_levels"))
        n_met = met.groupBy("_c").agg(F.count("*").alias("_met"))
        counted = open_here.join(n_levels, "_s", "left").join(n_met, "_c", "left")
        spare = F.col("_levels").isNull() | (F.coalesce("_met", F.lit(0)) < F.col("_levels"))
        # "*" is a level that no compatible pattern has.
        free = counted.filter(spare).withColumn(e, F.lit("*")).select("_p", "_s", *own)
        bound = counted.filter(~spare).join(met, "_c").withColumn(e, F.col("_v")).select("_p", "_s", *own)
        made = done.unionByName(free).unionByName(bound).distinct()
    made = cut(made)
    completions = cut(made.select("_s", *own).distinct().withColumn("_c", F.monotonically_increasing_id()))
    risked = completions.join(_pooled(completions, pats, masks, own, risk), "_c").drop("_c")
    return made.join(risked, ["_s", *own]).select("_p", "_risk")


def suppressible(levels: Sequence[str], f: RiskFunction, threshold: float) -> list[str]:
    """Sensitive levels that reveal nothing: alone, their risk is above 0.  Only for thresholds below 1."""
    return [v for v in levels if f({v: 1}) > 0] if threshold < 1 else []


def at_risk(name: str = "risk", threshold: float = 5, div: str | None = None, safe_levels: Sequence[str] = ()) -> Column:
    """Whether a row's risk is below the threshold; for shares, only rows with a sensitive level that isn't safe."""
    low = F.col(name) < threshold
    if div is None or not safe_levels:
        return low
    return low & F.col(div).isNotNull() & ~F.col(div).isin(list(safe_levels))


def at_risk_subset(rows: DataFrame, keys: Sequence[str], threshold: float = 5, strata: Sequence[str] = (), div: str | None = None, risk: Callable[[Column], Column] | None = None, safe_levels: Sequence[str] = (), within_completions: bool = False) -> DataFrame:
    """Rows at risk and rows of their stratum that share any key value with one (null being a value), with orig_risk."""
    from .joins import shares_value

    if not isinstance(threshold, (int, float)) or isinstance(threshold, bool) or threshold <= 0:
        raise ValueError("the threshold must be a number above 0")
    risked = cut(calc_risk(rows, keys, strata, div, risk, within_completions, name="orig_risk"))
    low = at_risk("orig_risk", threshold, div, safe_levels)
    pats = cut(risked.groupBy(*strata, *keys).agg(F.bool_or(low).alias("_low")))
    chosen = pats.filter("_low").select(*strata, *keys)
    near = shares_value(pats.drop("_low"), chosen, keys, strata, "_near").filter("_near")
    return _back(risked, near, [*strata, *keys], ["_near"]).filter("_near").drop("_near")


def suppress_small(rows: DataFrame, within: Sequence[str], identifiers: Sequence[str], column: str, k: int, only: Column | None = None, among: Column | None = None) -> DataFrame:
    """Null in ``column`` where fewer than k rows share strata, identifiers and its value.

    among: rows that count and may change (all by default); only: rows that may change among
    them.  Cells are counted by a grouped table joined back, so a cell may hold any share of rows.
    """
    return _suppress(rows, [*within, *identifiers, column], column, F.count("*") < k, only, among)


def suppress_uniform(rows: DataFrame, within: Sequence[str], identifiers: Sequence[str], column: str, sensitive: Sequence[str], least: int, among: Column | None = None) -> DataFrame:
    """Null in ``column`` where a cell has fewer than ``least`` distinct sensitive values (null counting as one)."""
    values = F.struct(*(F.coalesce(F.col(s).cast("string"), F.lit("\u0000")) for s in sensitive))
    return _suppress(rows, [*within, *identifiers, column], column, F.countDistinct(values) < least, None, among)


def suppress_ordered(rows: DataFrame, within: Sequence[str], identifiers: Sequence[str], column: str, sensitive: str, severe: str, lesser: str, among: Column | None = None) -> DataFrame:
    """Null in ``column`` where a cell has the severe level and lacks the lesser one."""
    n = lambda level: F.count(F.when(F.col(sensitive) == level, 1))
    return _suppress(rows, [*within, *identifiers, column], column, (n(severe) > 0) & (n(lesser) == 0), None, among)


def _suppress(rows: DataFrame, cell: Sequence[str], column: str, test: Column, only: Column | None, among: Column | None) -> DataFrame:
    inside = F.coalesce(among, F.lit(False)) if among is not None else F.lit(True)
    counted = rows.filter(inside).groupBy(*cell).agg(test.alias("_hide")).filter("_hide")
    marked = _back(rows, counted, cell, ["_hide"])
    hide = F.coalesce("_hide", F.lit(False)) & inside & (F.coalesce(only, F.lit(False)) if only is not None else F.lit(True))
    return marked.withColumn(column, F.when(~hide, F.col(column))).drop("_hide").select(*rows.columns)


def suppression_counts(before: DataFrame, after: DataFrame, key: str, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """How many cells of each column were made null, and their share in per cent, overall or by group."""
    joined = before.alias("b").join(after.alias("a"), key)
    made = {c: F.count(F.when(F.col(f"b.{c}").isNotNull() & F.col(f"a.{c}").isNull(), 1)) for c in columns}
    cols = [x for c, n in made.items() for x in (n.alias(f"n_{c}"), (F.lit(100.0) * n / F.nullif(F.count("*"), F.lit(0))).alias(f"pct_{c}"))]
    return joined.groupBy(*(F.col(f"b.{c}").alias(c) for c in by)).agg(F.count("*").alias("n_rows"), *cols)


def brute_force_k(rows: Sequence[tuple]) -> list[int]:
    """Compatible rows of each row, by comparing all pairs: for checking."""
    fits = lambda a, b: all(x is None or y is None or x == y for x, y in zip(a, b, strict=True))
    return [sum(fits(a, b) for b in rows) for a in rows]


def completions(row: tuple, levels: Sequence[Sequence]) -> list[tuple]:
    return list(product(*([v] if v is not None else list(vs) or [None] for v, vs in zip(row, levels, strict=True))))
