"""Randomized local suppression of strata of any size: a local search by rounds over patterns.

What is searched is the table of distinct patterns, each (stratum, chain) a group of its own
and all groups at once.  Rows that had one pattern and have had the same keys nulled are one row
of the state, with their number; no task holds a stratum.

Nulling.  In a round every unsafe pattern draws a key, by the weights, and looks for a partner: a
pattern of its group that differs in that key alone, safe ones first, exact before open ones.
Rows of both lose the key, as many as the pattern lacks.  Demands on one pattern are served in
random order up to its rows.  Rounds end when all are safe or have no key left.

Restoring.  In a round every pattern with nulled keys proposes to put one back.  A proposal
touches the patterns that fit it only while the key is open.  It is refused for good if one of
these, or the pattern that it makes, would become unsafe by it alone.  Of the others an
independent set is taken: each pattern lets in the proposals below the largest of some random
limits whose rows it can spare in all, or else the first; a proposal that all let in is made.
For counts that is safe by arithmetic; for other measures every pattern lets in one proposal,
the outcome is measured, and what made a pattern unsafe is taken back and tried with half the rows.

Fits are found by equi-joins on the null masks of both sides and the keys known to both, so that
a proposal costs the patterns that it touches, and a round's risks cost patterns times masks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..durable import Steps, cut
from . import risk as risks
from .ordering import numbered

#: Random limits 1, 1/2, ... of which a pattern takes the largest that it can serve.
_LIMITS = [2.0**-i for i in range(13)]


def _bit(mask: Column, i: int) -> Column:
    return mask.bitwiseAND(F.lit(1 << i)) != 0


class Rounds:
    """The search over a state: g, pid, o0.. (the pattern's own keys), level, mask (keys nulled), n, tried, most, risk."""

    def __init__(self, steps: Steps, n_keys: int, measure: Callable[[dict], float] | None, threshold: float, safe_levels: Sequence[str], weights: np.ndarray, seed: int, within_completions: bool):
        self.steps, self.k, self.measure, self.threshold, self.safe_levels = steps, n_keys, measure, float(threshold), list(safe_levels)
        self.weights, self.seed, self.within = weights, seed, within_completions
        self.own = [f"o{i}" for i in range(n_keys)]
        self.keys = [f"k{i}" for i in range(n_keys)]
        self.counts = measure is None

    def known(self, state: DataFrame) -> DataFrame:
        """The state with its current keys, and which of them are null as ``open``."""
        held = state.withColumns({k: F.when(~_bit(F.col("mask"), i), F.col(o)) for i, (k, o) in enumerate(zip(self.keys, self.own, strict=True))})
        return held.withColumn("open", self.open_mask())

    def open_mask(self) -> Column:
        mask = F.lit(0).cast("long")
        for i, k in enumerate(self.keys):
            mask = mask + F.when(F.col(k).isNull(), F.lit(1 << i)).otherwise(F.lit(0))
        return mask

    def measured(self, state: DataFrame) -> DataFrame:
        """The state, kept, with every pattern's risk and whether that is too low."""
        state = self.known(state.filter("n > 0").drop("risk", "unsafe", *self.keys, "open"))
        f = None if self.counts else risks.custom(self.measure)
        out = risks.calc_risk(state, self.keys, ["g"], None if self.counts else "level", f, self.within, name="risk", weight="n")
        unsafe = F.col("risk") < self.threshold
        if self.safe_levels:
            unsafe = unsafe & (F.col("level") != risks.NULL_LEVEL) & ~F.col("level").isin(self.safe_levels)
        return self.steps.written(out.withColumn("unsafe", unsafe))

    def drawn(self, *what: Column | str) -> Column:
        """A number in [0, 1) by hash."""
        h = F.xxhash64(F.lit(self.seed), *(F.col(w) if isinstance(w, str) else w for w in what))
        return F.pmod(h, F.lit(1 << 53)).cast("double") / float(1 << 53)

    def touched(self, moves: DataFrame, others: DataFrame, masks: Sequence[int], carry: Sequence[str]) -> DataFrame:
        """Pairs of a move (g, e, bit, v, own keys with the moved one open) and a pattern that fits it while that key is open.

        Unless risks are within completions, patterns that fit either way are left out.
        masks: of the others' open keys; carry: columns of the others to keep.
        """
        made = sorted({m | (1 << i) for m in masks for i in range(self.k)} | set(masks))
        blank = lambda a, b: F.array(*(F.when(_bit(F.col(a).bitwiseOR(F.col(b)), i), F.lit("")).otherwise(F.concat(F.lit("="), F.col(k))) for i, k in enumerate(self.keys)))
        left = moves.withColumn("_q", F.explode(F.array(*(F.lit(m).cast("long") for m in masks)))).withColumn("_fit", blank("open", "_q"))
        left = left.select("g", "_fit", F.col("open").alias("_e"), "_q", *(c for c in moves.columns if c not in ("g", "open", *self.keys)))
        at = F.element_at(F.array(*self.keys), F.col("bit") + 1)
        right = others.withColumn("_e", F.explode(F.array(*(F.lit(m).cast("long") for m in made)))).withColumn("_fit", blank("_e", "open"))
        right = right.select("g", "_fit", "_e", F.col("open").alias("_q"), *self.keys, *carry)
        pairs = left.join(right, ["g", "_fit", "_e", "_q"])
        if not self.within:
            pairs = pairs.filter(at.isNotNull() & (at != F.col("v")))
        return pairs

    def moves_of(self, state: DataFrame, bit: Column) -> DataFrame:
        """Each row of the state as a move of the key ``bit``: v is its value there, the key itself open."""
        out = state.withColumn("bit", bit).withColumn("v", F.element_at(F.array(*self.own), F.col("bit") + 1))
        out = out.withColumns({k: F.when(F.col("bit") != i, F.col(k)) for i, k in enumerate(self.keys)})
        return out.withColumn("open", self.open_mask())

    def applied(self, state: DataFrame, moves: DataFrame, clear: bool) -> DataFrame:
        """The state after ``moves`` (g, pid, mask, bit, amount); risks are of before."""
        by = ["g", "pid", "mask"]
        gone = moves.groupBy(*by).agg(F.sum("amount").alias("_gone"))
        kept = ["g", "pid", *self.own, "level", "mask", "n", "tried", "most"]
        left = state.join(gone, by, "left").withColumn("n", F.col("n") - F.coalesce("_gone", F.lit(0))).select(*kept)
        flag = F.expr("shiftleft(1L, bit)")
        there = F.col("mask").bitwiseAND(F.bitwise_not(flag)) if clear else F.col("mask").bitwiseOR(flag)
        came = state.join(moves.select(*by, "bit", "amount"), by).withColumn("mask", there).withColumn("n", F.col("amount")).withColumn("most", F.lit(None).cast("long")).select(*kept)
        both = left.unionByName(came).filter("n > 0")
        return both.groupBy("g", "pid", "mask").agg(*(F.first(c).alias(c) for c in (*self.own, "level")), F.sum("n").alias("n"), F.bit_and("tried").alias("tried"), F.min("most").alias("most"))

    # -- nulling ----------------------------------------------------------------------

    def nulled(self, state: DataFrame) -> DataFrame:
        """Rounds until every pattern is safe or has no key left that may be nulled."""
        finite = [i for i in range(self.k) if np.isfinite(self.weights[i])]
        if not finite:
            return state
        can = F.lit(False)
        for i in finite:
            can = can | F.col(f"k{i}").isNotNull()
        nth = 0
        while True:
            asking = state.filter(F.col("unsafe") & can)
            masks = [r[0] for r in asking.select("g").distinct().join(state, "g").select("open").distinct().collect()]
            if not masks:
                return state
            nth += 1
            state = self.measured(self.applied(state, self.null_moves(state, asking, masks, finite, nth), clear=False))

    def lacking(self) -> Column:
        """Rows that a pattern lacks, at least one."""
        short = F.lit(self.threshold) - F.col("risk")
        if not self.counts and self.threshold < 1:
            short = short * F.col("n") / (1 - self.threshold)
        return F.greatest(F.lit(1), F.ceil(short)).cast("long")

    def null_moves(self, state: DataFrame, asking: DataFrame, masks: Sequence[int], finite: Sequence[int], nth: int) -> DataFrame:
        draws = [F.when(F.col(f"k{i}").isNotNull(), F.struct((-F.ln(1 - self.drawn("g", "pid", "mask", F.lit(nth), F.lit(i))) * float(self.weights[i])).alias("u"), F.lit(i).alias("i"))) for i in finite]
        first = F.array_min(F.array_compact(F.array(*draws)))
        lacking = asking.withColumn("lacks", self.lacking()).withColumn("e_open", F.col("open"))
        asks = self.moves_of(lacking, first["i"]).select("g", "pid", "mask", "bit", "v", "n", "lacks", "e_open", "open", *self.keys)
        others = state.select("g", F.col("pid").alias("q_pid"), F.col("mask").alias("q_mask"), F.col("n").alias("q_n"), F.col("unsafe").alias("q_unsafe"), "open", *self.keys)
        pairs = self.touched(asks, others, masks, ["q_pid", "q_mask", "q_n", "q_unsafe"])
        if self.within:
            at = F.element_at(F.array(*self.keys), F.col("bit") + 1)
            pairs = pairs.filter(at.isNotNull() & (at != F.col("v")))
        exact = F.col("_e") == F.col("_q").bitwiseOR(F.expr("shiftleft(1L, bit)"))
        rank = F.struct(F.when(F.col("q_unsafe"), 2).otherwise(0) + F.when(exact, 0).otherwise(1), self.drawn("g", "pid", "mask", "q_pid", "q_mask", F.lit(nth)))
        best = pairs.groupBy("g", "pid", "mask").agg(F.min_by(F.struct("q_pid", "q_mask", "q_n"), rank).alias("q"))
        asked = asks.select("g", "pid", "mask", "bit", "n", "lacks").join(best, ["g", "pid", "mask"], "left")
        claims = asked.filter("q IS NOT NULL").select("g", F.col("q.q_pid").alias("pid"), F.col("q.q_mask").alias("mask"), "bit", F.least("lacks", "q.q_n").alias("amount"), F.col("q.q_n").alias("n"))
        # A count grows for both; of a share, the row that joins changes what the one at risk reveals.
        alone = asked if self.counts else asked.filter("q IS NULL")
        own = alone.select("g", "pid", "mask", "bit", F.when(F.col("q").isNull(), F.col("n")).otherwise(F.least("lacks", "n")).alias("amount"), "n")
        wanted = claims.unionByName(own).groupBy("g", "pid", "mask", "bit").agg(F.max("amount").alias("amount"), F.max("n").alias("n"))
        # At most one row for each key.
        turn = Window.partitionBy("g", "pid", "mask").orderBy(self.drawn("g", "pid", "mask", "bit", F.lit(nth), F.lit("turn")), "bit").rowsBetween(Window.unboundedPreceding, -1)
        ahead = F.coalesce(F.sum("amount").over(turn), F.lit(0))
        return wanted.withColumn("amount", F.least("amount", F.col("n") - ahead)).filter("amount > 0").select("g", "pid", "mask", "bit", "amount")

    # -- restoring --------------------------------------------------------------------

    def restored(self, state: DataFrame) -> DataFrame:
        """Rounds until no nulled key is left that hasn't been refused."""
        nth = 0
        while True:
            left = F.col("mask").bitwiseAND(F.bitwise_not(F.col("tried")))
            proposing = state.filter(left != 0)
            masks = [r[0] for r in proposing.select("g").distinct().join(state, "g").select("open").distinct().collect()]
            if not masks:
                return state
            nth += 1
            state = self.restoring_round(state, proposing, masks, nth)

    def restoring_round(self, state: DataFrame, proposing: DataFrame, masks: Sequence[int], nth: int) -> DataFrame:
        left = F.col("mask").bitwiseAND(F.bitwise_not(F.col("tried")))
        bits = F.array_compact(F.array(*(F.when(_bit(left, i), F.struct(self.drawn("g", "pid", "mask", F.lit(nth), F.lit(i)).alias("u"), F.lit(i).alias("i"))) for i in range(self.k))))
        moves = self.moves_of(proposing, F.array_min(bits)["i"]).withColumn("amount", F.coalesce(F.least("n", "most"), F.col("n"))).withColumn("u", self.drawn("g", "pid", "mask", F.lit(nth), F.lit("restore")))
        moves = moves.select("g", "pid", "mask", "bit", "v", "u", "amount", "risk", "open", *self.keys)
        others = state.select("g", F.col("pid").alias("q_pid"), F.col("mask").alias("q_mask"), F.col("n").alias("q_n"), (F.col("risk") - self.threshold).alias("spare"), "open", *self.keys)
        by = ["g", "pid", "mask"]
        if self.counts:
            alone = self.touched(moves, others, masks, ["q_n", "spare"]).groupBy(*by).agg(F.sum("q_n").alias("lost"), F.min("spare").alias("least"))
            moves = moves.join(alone, by, "left").withColumn("target", F.col("risk") - F.coalesce("lost", F.lit(0)) - self.threshold)
            moves = moves.withColumn("amount", F.when(F.col("target") >= 0, F.least("amount", F.floor(F.coalesce("least", F.col("amount"))))).otherwise(F.lit(0)).cast("long")).drop("lost", "least", "risk")
        else:
            # Every pattern that is touched lets in one proposal.
            others = others.withColumn("spare", F.lit(0.0))
            moves = moves.withColumn("target", F.lit(0.0)).drop("risk")
        moves = cut(moves)
        able = moves.filter("amount > 0")
        made = able.withColumns({k: F.when(F.col("bit") == i, F.col("v")).otherwise(F.col(k)) for i, k in enumerate(self.keys)})
        made = made.withColumn("open", self.open_mask()).select("g", F.col("pid").alias("q_pid"), F.col("mask").alias("q_mask"), F.col("target").alias("spare"), F.col("u").alias("q_u"), "open", *self.keys)
        both = others.select("g", "q_pid", "q_mask", "spare", F.lit(None).cast("double").alias("q_u"), "open", *self.keys).unionByName(made)
        made_masks = sorted(set(masks) | {m & ~(1 << i) for m in masks for i in range(self.k)})
        asks = able.select("g", "pid", "mask", "bit", "v", "u", "amount", "open", *self.keys)
        # The pattern that a proposal makes doesn't stand in that proposal's way.
        pairs = self.touched(asks, both, made_masks, ["q_pid", "q_mask", "q_u", "spare"]).filter(F.col("q_u").isNull() | (F.col("pid") != F.col("q_pid")) | (F.col("mask") != F.col("q_mask")))
        q = ["g", "q_pid", "q_mask", "q_u"]
        sums = [F.sum(F.when(F.col("u") <= limit, F.col("amount")).otherwise(0)).alias(f"s{i}") for i, limit in enumerate(_LIMITS)]
        met = pairs.groupBy(*q).agg(F.min("u").alias("first"), F.max("spare").alias("spare"), *sums)
        limit = F.coalesce(*(F.when((F.col(f"s{i}") <= F.col("spare")) & (F.col(f"s{i}") > 0), F.lit(x)) for i, x in enumerate(_LIMITS)), F.col("first"))
        # A pattern yet to be made: its own proposal and the first of the others' compete, unless there is room for all.
        free = (F.col("s0") <= F.col("spare")) | F.col("q_u").isNull()
        met = met.select(*(F.col(c).alias(f"_{c}") for c in q), F.when(F.col("q_u").isNull(), limit).when(free, F.lit(1.0)).when(F.col("q_u") < F.col("first"), F.lit(-1.0)).otherwise(F.lit(1.0)).alias("limit"), (~free & (F.col("first") <= F.col("q_u"))).alias("yields"))
        on = (F.col("g") == F.col("_g")) & (F.col("q_pid") == F.col("_q_pid")) & (F.col("q_mask") == F.col("_q_mask")) & F.col("q_u").eqNullSafe(F.col("_q_u"))
        let_in = pairs.drop("_q", "_e", "_fit").join(met.drop("yields"), on).groupBy(*by).agg(F.min("limit").alias("limit"))
        yields = met.filter("yields").select(F.col("_g").alias("g"), F.col("_q_pid").alias("pid"), F.col("_q_mask").alias("mask")).distinct().withColumn("yields", F.lit(True))
        won = able.join(let_in, by, "left").join(yields, by, "left").filter((F.coalesce("limit", F.lit(1.0)) >= F.col("u")) & F.col("yields").isNull())
        won = cut(won.select("g", "pid", "mask", "bit", "v", "amount", "open", *self.keys))
        refused = moves.filter("amount = 0").select("g", "pid", "mask", "bit", F.lit(True).alias("for_good"), F.lit(0).cast("long").alias("half"))
        if not self.counts:
            won, lost = self.taken_back(state, won, masks)
            refused = refused.unionByName(lost)
        flags = refused.groupBy(*by).agg(F.bit_or(F.when(F.col("for_good"), F.expr("shiftleft(1L, bit)")).otherwise(F.lit(0).cast("long"))).alias("_flags"), F.max(F.when(~F.col("for_good"), F.col("half"))).alias("_half"))
        marked = state.join(flags, by, "left").withColumn("tried", F.col("tried").bitwiseOR(F.coalesce("_flags", F.lit(0).cast("long")))).withColumn("most", F.when(F.col("_flags").isNull(), F.col("most")).otherwise(F.col("_half"))).drop("_flags", "_half")
        return self.measured(self.applied(marked, won, clear=True))

    def taken_back(self, state: DataFrame, won: DataFrame, masks: Sequence[int]) -> tuple[DataFrame, DataFrame]:
        """The moves that leave all patterns safe, and those that don't: g, pid, mask, bit, for_good, half."""
        tried = self.measured(self.applied(state, won, clear=True))
        unsafe = tried.filter("unsafe")
        none = won.limit(0).select("g", "pid", "mask", "bit", F.lit(True).alias("for_good"), F.lit(0).cast("long").alias("half"))
        if unsafe.isEmpty():
            return won, none
        after = sorted(set(masks) | {m & ~(1 << i) for m in masks for i in range(self.k)})
        by = ["g", "pid", "mask"]
        hit = self.touched(won, unsafe.select("g", "open", *self.keys), after, []).select(*by)
        own = won.withColumn("_to", F.col("mask").bitwiseAND(F.bitwise_not(F.expr("shiftleft(1L, bit)")))).join(unsafe.select("g", "pid", F.col("mask").alias("_to")), ["g", "pid", "_to"]).select(*by)
        bad = hit.unionByName(own).distinct()
        lost = cut(won.join(bad, by, "left_semi"))
        half = F.floor(F.col("amount") / 2).cast("long")
        return cut(won.join(lost.select(*by), by, "left_anti")), lost.select("g", "pid", "mask", "bit", (F.col("amount") <= 1).alias("for_good"), half.alias("half"))

    # -- outcome ----------------------------------------------------------------------

    def objective(self, state: DataFrame, gamma: float, alpha: float) -> DataFrame:
        """g and its objective, as ``suppress.Stratum.objective`` has it."""
        r, n, k = F.col("risk"), F.col("n"), self.threshold
        if k >= 1:
            term = (alpha - 1) * F.ln(F.greatest(r, F.lit(1e-12))) - (alpha - 1) / k * r
        else:
            beta = max(alpha / k - alpha, 1e-6)
            q = F.least(F.greatest(r, F.lit(1e-12)), F.lit(1 - 1e-12))
            term = (alpha - 1) * F.ln(q) + (beta - 1) * F.ln(1 - q)
        w = F.lit(0.0)
        for i, weight in enumerate(self.weights):
            if np.isfinite(weight):
                w = w + F.when(_bit(F.col("mask"), i), F.lit(float(weight))).otherwise(F.lit(0.0))
        sums = state.groupBy("g").agg((F.sum(term * n) / F.sum("n")).alias("risks"), (F.sum(w * n) / F.sum("n")).alias("nulls"))
        return sums.select("g", (gamma * F.col("risks") - 2 * (1 - gamma) * F.ln(F.greatest("nulls", F.lit(1e-12)))).alias("objective"))


def suppress(rows: DataFrame, keys: Sequence[str], row_id: str, strata: Sequence[str], div: str | None, measure: Callable[[dict], float] | None, threshold: float, chains: int, weights: np.ndarray, seed: int, gamma: float, alpha: float, within_completions: bool, safe_levels: Sequence[str] = ()) -> DataFrame:
    """As ``suppress.suppress``, for strata of any size; ids decide which of a pattern's rows lose a key."""
    level = F.coalesce(F.col(div).cast("string"), F.lit(risks.NULL_LEVEL)) if measure is not None else F.lit(risks.NULL_LEVEL)
    own = [f"o{i}" for i in range(len(keys))]
    held = rows.select(*(F.col(s).alias(f"s{i}") for i, s in enumerate(strata)), *(F.col(k).cast("string").alias(o) for k, o in zip(keys, own, strict=True)), level.alias("level"), F.col(row_id).alias("id"))
    s_cols = [f"s{i}" for i in range(len(strata))]
    columns = [*s_cols, *own, "level"]
    patterns = held.groupBy(*columns).agg(F.count("*").alias("n"))
    groups = cut(patterns.groupBy(*s_cols).agg(F.sum("n").alias("size")).withColumn("sid", F.monotonically_increasing_id()))
    patterns = cut(risks._back(patterns, groups, s_cols, ["sid", "size"]).withColumn("pid", F.monotonically_increasing_id())) if s_cols else cut(patterns.withColumn("sid", F.lit(0).cast("long")).withColumn("size", F.lit(groups.first()["size"])).withColumn("pid", F.monotonically_increasing_id()))
    steps = Steps(rows.sparkSession)
    search = Rounds(steps, len(keys), measure, threshold, safe_levels, weights, seed, within_completions)
    every = F.lit(0).cast("long")
    for i, o in enumerate(own):
        every = every + F.when(F.col(o).isNotNull(), F.lit(1 << i)).otherwise(F.lit(0))
    hopeless = (F.col("size") < threshold) if measure is None else F.lit(False)
    start = patterns.withColumn("g", F.explode(F.sequence(F.col("sid") * chains, F.col("sid") * chains + chains - 1)))
    start = start.select("g", "pid", *own, "level", F.when(hopeless, every).otherwise(F.lit(0).cast("long")).alias("mask"), "n", F.lit(0).cast("long").alias("tried"), F.lit(None).cast("long").alias("most"))
    state = search.nulled(search.measured(start))
    # Where that didn't help, all keys go; these and what was hopeless stay as they are.
    stuck = state.groupBy("g").agg(F.bool_or("unsafe").alias("stuck")).filter("stuck")
    state = state.join(stuck, "g", "left").withColumn("mask", F.when(F.col("stuck"), every).otherwise(F.col("mask"))).withColumn("tried", F.when(F.col("stuck"), F.col("mask")).otherwise(F.col("tried")))
    merged = state.groupBy("g", "pid", "mask").agg(*(F.first(c).alias(c) for c in (*own, "level")), F.sum("n").alias("n"), F.bit_and("tried").alias("tried"), F.min("most").alias("most"), F.bool_or("stuck").alias("stuck"))
    failed = cut(merged.groupBy("g").agg(F.coalesce(F.bool_or("stuck"), F.lit(False)).alias("failed")))
    state = search.restored(search.measured(merged.drop("stuck")))
    scored = search.objective(state, gamma, alpha).join(failed, "g")
    sid = F.floor(F.col("g") / chains).cast("long")
    best = scored.groupBy(sid.alias("sid")).agg(F.max_by(F.struct("g", "objective"), F.struct(~F.col("failed"), F.col("objective"), -F.col("g"))).alias("best")).select("sid", F.col("best.g").alias("g"), F.col("best.objective").alias("objective"))
    # Of each pattern: its rows by place, and the keys nulled up to each.  At most one entry for each set of keys.
    parts = state.join(best, "g").groupBy("pid").agg(F.first("objective").alias("objective"), F.sort_array(F.collect_list(F.struct("mask", "n"))).alias("parts"))
    grown = F.aggregate("parts", F.expr("named_struct('upto', 0L, 'list', cast(array() as array<struct<upto: bigint, mask: bigint>>))"), lambda a, x: F.struct((a["upto"] + x["n"]).alias("upto"), F.array_append(a["list"], F.struct((a["upto"] + x["n"]).alias("upto"), x["mask"].alias("mask"))).alias("list")))
    parts = cut(parts.select("pid", "objective", grown["list"].alias("upto")))
    steps.close()
    chosen = _allotted(cut(risks._back(held, patterns, columns, ["pid"]).select("id", "pid")), parts, seed)
    chosen = chosen.select(*(F.col(c).alias(f"_r_{c}") for c in ("id", "mask", "objective")))
    joined = rows.join(chosen, F.col(row_id) == F.col("_r_id"))
    others = [c for c in rows.columns if c not in keys]
    kept = (F.when(~_bit(F.col("_r_mask"), i), F.col(k).cast("string")).alias(k) for i, k in enumerate(keys))
    return joined.select(*others, *kept, F.col("_r_objective").alias("objective"), F.bit_count("_r_mask").cast("int").alias("n_nulled"))


def _allotted(ids: DataFrame, parts: DataFrame, seed: int) -> DataFrame:
    """id, mask and objective: a pattern's rows in the order of a hash take its parts in turn; places come from ranges."""
    whole = parts.filter(F.size("upto") == 1).select("pid", "objective", F.col("upto")[0]["mask"].alias("mask"))
    plain = ids.join(whole, "pid").select("id", "mask", "objective")
    split = parts.filter(F.size("upto") > 1)
    placed = numbered(ids.join(split.select("pid"), "pid").withColumn("lot", F.xxhash64(F.lit(seed), "id")), ["pid", "lot", "id"], "nth")
    first = placed.groupBy("pid").agg(F.min("nth").alias("first"))
    found = placed.join(first, "pid").join(split, "pid")
    place = F.col("nth") - F.col("first")
    mask = F.filter("upto", lambda x: place < x["upto"])[0]["mask"]
    return plain.unionByName(found.select("id", mask.alias("mask"), "objective"))
