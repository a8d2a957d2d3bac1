"""Randomized local suppression: null as few key cells as needed for every row to be safe.

Strata of up to ``TASK_ROWS`` rows are searched in a task, each (stratum, chain) by itself with
its own seed, cell by cell: counts of compatible rows are kept by row and level, so that a cell
nulled or put back costs one look at the rows, not a pass over pairs.  Larger strata go by rounds
over patterns (``suppress_rounds``), no task holding a stratum.  The cheapest chain of each
stratum is kept.  Steps run until all rows are safe; where no chain gets there, as no row at
risk has a key left that may be nulled, the stratum has all its keys nulled.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..durable import cut
from . import risk as risks
from . import suppress_rounds

#: Sensitive levels that a measure may tell apart.
MOST_LEVELS = 1000
#: Rows of a stratum that a task searches whole.
TASK_ROWS = 2000


def key_weights(keys: Sequence[str], weights: dict[str, float] | Sequence[str] | None = None) -> np.ndarray:
    """Weights that add up to the number of keys; names alone mean falling priority; infinite means never."""
    if weights is None:
        return np.ones(len(keys))
    if not isinstance(weights, dict):
        if set(weights) != set(keys):
            raise ValueError("priorities must name every key")
        weights = {k: float(len(keys) - i) for i, k in enumerate(weights)}
    if unknown := set(weights) - set(keys):
        raise ValueError(f"weights for unknown keys {sorted(unknown)}")
    w = np.array([float(weights.get(k, 1.0)) for k in keys])
    if (w <= 0).any() or np.isnan(w).any():
        raise ValueError("weights must be positive")
    finite = np.isfinite(w)
    if finite.any():
        w[finite] *= finite.sum() / w[finite].sum()
    return w


class Stratum:
    """Rows of coded keys (0: null) with sensitive levels; risks of all rows."""

    def __init__(self, codes: np.ndarray, levels: np.ndarray, names: list[str], measure: Callable[[dict], float] | None, threshold: float, safe: set[str], within_completions: bool = False):
        self.codes, self.names, self.measure, self.threshold = codes, names, measure, threshold
        #: The level of each row as a column of the table of fits; counts need but one.
        self.levels = levels if measure is not None else np.zeros(len(codes), int)
        self.n_levels = len(names) if measure is not None else 1
        #: Every full pattern of the stratum's levels, where risks are taken within completions.
        self.complete = np.array([*product(*(range(min(1, int(c.max())), int(c.max()) + 1) for c in codes.T))]) if within_completions else None
        self.asks = np.ones(len(codes), bool) if not safe else np.array([names[v] != risks.NULL_LEVEL and names[v] not in safe for v in levels])
        self.known_risks: dict[tuple, float] = {}

    def risk(self, codes: np.ndarray) -> np.ndarray:
        """Of every row: compatible rows, or the measure of their levels."""
        if self.complete is not None:
            pats, at, n = np.unique(codes, axis=0, return_inverse=True, return_counts=True)
            return self._within(pats, at.ravel(), n)[at.ravel()]
        return self._measured(self.fits(codes))

    def fits(self, codes: np.ndarray) -> np.ndarray:
        """Rows by levels: how many rows of each level are compatible with each row."""
        pats, at = np.unique(codes, axis=0, return_inverse=True)
        at = at.ravel()
        by_level, out = self._by_level(at, len(pats)), np.zeros((len(pats), self.n_levels), np.int64)
        for i, p in enumerate(pats):
            out[i] = by_level[((pats == p) | (pats == 0) | (p == 0)).all(1)].sum(0)
        return out[at]

    def _by_level(self, at: np.ndarray, patterns: int) -> np.ndarray:
        found = np.zeros((patterns, self.n_levels), np.int64)
        np.add.at(found, (at, self.levels), 1)
        return found

    def _measured(self, pooled: np.ndarray) -> np.ndarray:
        if self.measure is None:
            return pooled[:, 0].astype(float)
        out = np.empty(len(pooled))
        for i, row in enumerate(map(tuple, pooled.tolist())):
            if row not in self.known_risks:
                self.known_risks[row] = self.measure({name: v for name, v in zip(self.names, row, strict=True) if v}) if any(row) else np.inf
            out[i] = self.known_risks[row]
        return out

    def _within(self, pats: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Of every pattern: the least risk among the completions with the most known keys; 1 without a known key."""
        agrees = np.ones((len(self.complete), len(pats)), bool)
        for k in range(pats.shape[1]):
            agrees &= (pats[None, :, k] == 0) | (pats[None, :, k] == self.complete[:, k, None])
        known = np.where(agrees, (pats != 0).sum(1)[None, :], -1).max(1)
        risk = (agrees @ n).astype(float) if self.measure is None else self._measured(agrees @ self._by_level(at, len(pats)))
        out = np.ones(len(pats))
        for i in np.flatnonzero((pats != 0).any(1)):
            own = np.flatnonzero(agrees[:, i])
            out[i] = risk[own[known[own] == known[own].max()]].min()
        return out

    def unsafe(self, codes: np.ndarray) -> np.ndarray:
        return (self.risk(codes) < self.threshold) & self.asks

    def search(self, weights: np.ndarray, rng: np.random.Generator) -> np.ndarray | None:
        """Nulls cells until all rows are safe, then restores what it can; None if no row at risk has a key left to null.

        Each step nulls a cell at least, so it ends; a changed cell costs the rows that it touches.
        """
        held = Held(self)
        draw = np.where(np.isfinite(weights), 1 / weights, 0.0)
        while held.unsafe.any():
            rows = np.flatnonzero(held.unsafe & ((held.codes != 0) & (draw > 0)).any(1))
            if not len(rows):
                return None
            i = int(rng.choice(rows))
            p = np.where(held.codes[i] != 0, draw, 0.0)
            k = int(rng.choice(len(p), p=p / p.sum()))
            j = self.partner(held.codes, i, k, held.unsafe, rng)
            # A count grows for both; of a share, the row that joins changes what the one at risk reveals.
            if self.measure is None or j is None:
                held.put(i, k, 0)
            if j is not None:
                held.put(j, k, 0)
        return self.restore(held, rng)

    def partner(self, codes: np.ndarray, i: int, k: int, bad: np.ndarray, rng: np.random.Generator) -> int | None:
        """A row that equals this one in all other keys: safe ones first, exact before open ones."""
        others = [c for c in range(codes.shape[1]) if c != k]
        differs = (codes[:, k] != codes[i, k]) & (codes[:, k] != 0)
        exact = (codes[:, others] == codes[i, others]).all(1) & differs
        loose = ((codes[:, others] == codes[i, others]) | (codes[:, others] == 0) | (codes[i, others] == 0)).all(1) & differs
        for candidates in (exact & ~bad, loose & ~bad, exact & bad, loose & bad):
            found = np.flatnonzero(candidates)
            if len(found):
                return int(rng.choice(found))
        return None

    def restore(self, held: Held, rng: np.random.Generator) -> np.ndarray:
        """Puts back nulled cells, in random order, wherever everyone stays safe."""
        made = np.argwhere((held.codes == 0) & (self.codes != 0))
        for i, k in made[rng.permutation(len(made))]:
            if held.put(i, k, self.codes[i, k]):
                held.put(i, k, 0)
        return held.codes

    def objective(self, codes: np.ndarray, weights: np.ndarray, gamma: float, alpha: float) -> float:
        """gamma * risk term + 2 (1 - gamma) * (- log mean weighted nulls); larger is better.

        The risk term is a gamma density's for thresholds from 1, a beta density's below.
        """
        r = self.risk(codes)
        k = self.threshold
        if k >= 1:
            beta = (alpha - 1) / k
            term = float(np.mean((alpha - 1) * np.log(np.maximum(r, 1e-12)) - beta * r))
        else:
            beta = max(alpha / k - alpha, 1e-6)
            q = np.clip(r, 1e-12, 1 - 1e-12)
            term = float(np.mean((alpha - 1) * np.log(q) + (beta - 1) * np.log(1 - q)))
        w = np.where(np.isfinite(weights), weights, 0.0)
        nulls = float((((codes == 0) & (self.codes != 0)) * w).sum(1).mean())
        return gamma * term + 2 * (1 - gamma) * -math.log(max(nulls, 1e-12))


class Held:
    """Codes that change cell by cell, with each row's compatible rows by level and whether it is unsafe."""

    def __init__(self, stratum: Stratum):
        self.stratum, self.codes = stratum, stratum.codes.copy()
        self.fits = None if stratum.complete is not None else stratum.fits(self.codes)
        self.unsafe = stratum.unsafe(self.codes)

    def put(self, i: int, k: int, value: int) -> bool:
        """Nulls a cell (value 0) or puts back its value; whether a row that this touches is unsafe then."""
        s, known = self.stratum, value or self.codes[i, k]
        if self.fits is None:
            self.codes[i, k] = value
            self.unsafe = s.unsafe(self.codes)
            return bool(self.unsafe.any())
        own = self.codes[i]
        fit = (self.codes == own) | (self.codes == 0) | (own == 0)
        fit[:, k] = (self.codes[:, k] != 0) & (self.codes[:, k] != known)
        # These fit the row only while its cell is null.
        touched = np.flatnonzero(fit.all(1))
        sign = 1 if value == 0 else -1
        self.codes[i, k] = value
        self.fits[touched, s.levels[i]] += sign
        self.fits[i] += sign * np.bincount(s.levels[touched], minlength=s.n_levels)
        rows = np.append(touched, i)
        self.unsafe[rows] = (s._measured(self.fits[rows]) < s.threshold) & s.asks[rows]
        return bool(self.unsafe[rows].any())


def suppress(
    rows: DataFrame,
    keys: Sequence[str],
    row_id: str,
    strata: Sequence[str] = (),
    div: str | None = None,
    measure: Callable[[dict], float] | None = None,
    threshold: float = 5,
    chains: int = 8,
    weights: dict[str, float] | Sequence[str] | None = None,
    seed: int = 0,
    gamma: float = 0.5,
    alpha: float = 2.0,
    within_completions: bool = False,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """``rows`` with key cells nulled so that each row's risk reaches the threshold, with objective and n_nulled.

    measure: a function of a dict from sensitive level to number of rows; compatible rows are
    counted without one.  If the rows of a stratum cannot be made safe, all its keys are null.
    within_completions: as for ``risk.calc_risk``.  Strata of up to ``task_rows`` rows are
    searched whole in a task, cell by cell; larger ones by rounds over many tasks.
    """
    risks.check(rows, keys, strata, div, measure)
    if threshold <= 0:
        raise ValueError("the threshold must be above 0")
    w = key_weights(keys, weights)
    sizes = cut(rows.groupBy(*strata).agg(F.count("*").alias("_size")))
    large = sizes.filter(F.col("_size") > task_rows).drop("_size")
    if not large.isEmpty():
        safe = () if measure is None or threshold >= 1 else risks.suppressible(_levels(rows, div), measure, threshold)
        options = (keys, row_id, strata, div, measure, threshold, chains, w, seed, gamma, alpha, within_completions)
        if not strata:
            return suppress_rounds.suppress(rows, *options, safe)
        marked = risks._back(rows, large.withColumn("_large", F.lit(True)), strata, ["_large"])
        by_rounds = suppress_rounds.suppress(cut(marked.filter("_large").drop("_large")), *options, safe)
        return by_rounds.unionByName(_by_task(marked.filter("_large IS NULL").drop("_large"), *options))
    return _by_task(rows, keys, row_id, strata, div, measure, threshold, chains, w, seed, gamma, alpha, within_completions)


def _levels(rows: DataFrame, div: str) -> list[str]:
    levels = [r[0] for r in rows.select(F.col(div).cast("string")).distinct().limit(MOST_LEVELS + 1).collect()]
    if len(levels) > MOST_LEVELS:
        raise ValueError(f"more than {MOST_LEVELS} sensitive levels")
    return [v for v in levels if v is not None]


def _by_task(rows: DataFrame, keys: Sequence[str], row_id: str, strata: Sequence[str], div: str | None, measure: Callable[[dict], float] | None, threshold: float, chains: int, w: np.ndarray, seed: int, gamma: float, alpha: float, within_completions: bool) -> DataFrame:
    """Each (stratum, chain) searched in one task."""
    kept = [*strata, row_id, *keys, *([div] if div else [])]
    out_schema = T.StructType([*(T.StructField(f"_{s}", rows.schema[s].dataType) for s in strata), T.StructField("_chain", T.IntegerType()), T.StructField("_objective", T.DoubleType()), T.StructField("_ids", T.ArrayType(rows.schema[row_id].dataType)), *(T.StructField(f"_{k}", T.ArrayType(T.StringType())) for k in keys)])
    key_names, stratum_names = list(keys), list(strata)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        chain = int(group["_chain"].iloc[0])
        group = group.sort_values(row_id, kind="stable")
        coded = [pd.factorize(group[k], use_na_sentinel=True) for k in key_names]
        codes = np.stack([c + 1 for c, _ in coded], 1).astype(np.int64)
        found = group[div].astype(object).where(group[div].notna(), risks.NULL_LEVEL).astype(str) if div else pd.Series(["all"] * len(group))
        levels, names = pd.factorize(found)
        safe = set(risks.suppressible(list(names), measure, threshold)) if measure is not None else set()
        stratum = Stratum(codes, levels, list(names), measure, threshold, safe, within_completions)
        mark = int(pd.util.hash_pandas_object(group[stratum_names].iloc[:1].astype(str), index=False).iloc[0]) if stratum_names else 0
        rng = np.random.default_rng([seed, chain, mark % (1 << 32)])
        if not (codes != 0).any() or not stratum.unsafe(codes).any():
            best = codes
        elif measure is None and threshold > len(codes):
            best = np.zeros_like(codes)
        else:
            best = stratum.search(w, rng)
            best = np.zeros_like(codes) if best is None else best
        cells = {f"_{k}": [[None if c == 0 else str(coded[i][1][c - 1]) for c in best[:, i]]] for i, k in enumerate(key_names)}
        first = {f"_{s}": [group[s].iloc[0]] for s in stratum_names}
        return pd.DataFrame({**first, "_chain": [chain], "_objective": [stratum.objective(best, w, gamma, alpha)], "_ids": [group[row_id].tolist()], **cells})

    each = rows.select(*kept).withColumn("_chain", F.explode(F.sequence(F.lit(0), F.lit(chains - 1))))
    tried = each.groupBy(*strata, "_chain").applyInPandas(run, out_schema)
    columns = ["_objective", "_ids", *(f"_{k}" for k in keys)]
    best = tried.groupBy(*(f"_{s}" for s in strata)).agg(F.max_by(F.struct(*columns), F.struct("_objective", -F.col("_chain"))).alias("_best"))
    cells = best.select(F.col("_best._objective").alias("objective"), F.explode(F.arrays_zip(F.col("_best._ids").alias("_id"), *(F.col(f"_best._{k}").alias(f"_{k}") for k in keys))).alias("_c"))
    done = cells.select("objective", F.col("_c._id").alias("_id"), *(F.col(f"_c._{k}").alias(f"_{k}") for k in keys))
    joined = rows.join(done, F.col(row_id) == F.col("_id"))
    nulled = F.lit(0)
    for k in keys:
        nulled = nulled + F.when(F.col(k).isNotNull() & F.col(f"_{k}").isNull(), 1).otherwise(0)
    others = [c for c in rows.columns if c not in keys]
    return joined.select(*others, *(F.col(f"_{k}").alias(k) for k in keys), "objective", nulled.alias("n_nulled"))


def suppress_at_risk(rows: DataFrame, keys: Sequence[str], row_id: str, threshold: float = 5, **options) -> DataFrame:
    """The same, searching only the rows at risk and those that share a value with one; the rest come back as they are.

    Rows at risk are found by the same measure, completions and levels as ``suppress`` is given.
    """
    div, measure, strata = options.get("div"), options.get("measure"), options.get("strata", ())
    safe = ()
    if measure is not None and threshold < 1:
        safe = risks.suppressible(_levels(rows, div), measure, threshold)
    subset = risks.at_risk_subset(rows, keys, threshold, strata, div, risks.custom(measure) if measure is not None else None, safe, options.get("within_completions", False)).drop("orig_risk")
    done = cut(suppress(cut(subset), keys, row_id, threshold=threshold, **options))
    rest = rows.join(done.select(row_id), row_id, "left_anti").withColumn("objective", F.lit(None).cast("double")).withColumn("n_nulled", F.lit(0))
    return done.unionByName(rest)
