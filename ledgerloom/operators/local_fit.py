"""Local linear smooths of groups of any size.

A group's points lie in blocks of neighbouring x.  The weights of a fit are a polynomial of the
distance on either side of its point, so a block that lies wholly in the windows of all points of
another counts through its moments alone; rows travel only between a block and those that hold
the ends of its windows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from numpy.polynomial import Polynomial
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..durable import cut
from .ordering import PART, ranged

#: Powers of x that a weighted line needs: nine of the weight and two of the line.
POWERS = 12
#: Moments keep their digits for blocks up to this share of a window; of wider ones a window holds few.
NARROW = 1 / 8
#: Distances that a task holds at once.
CELLS = 2_000_000


def loess(rows: DataFrame, keys: Sequence[str], x: str, y: str, span: float = 0.75, block: int = 4_096) -> DataFrame:
    """keys, x, n (rows there) and smooth: the local line with tricube weights at each distinct x of a group.

    A window reaches to the q-th nearest row, q being ``span`` of the group's rows.  Rows whose x or
    y is null or not finite take no part; null keys are a group of their own.  Rows of one x are added
    up first, so a task's size follows distinct x.  A task plans a group over one row for each
    ``block`` distinct x; others hold a block and what the ends of its windows pass over, which is
    some blocks, or more where x leaps within a block.
    """
    given = rows.select(*keys, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    finite = (F.abs("_x") < F.lit(math.inf)) & (F.abs("_y") < F.lit(math.inf))
    points = given.filter(finite).withColumn("_x", F.col("_x") + F.lit(0.0)).groupBy(*keys, "_x").agg(F.count("*").cast("double").alias("_n"), F.sum("_y").alias("_sy"))
    blocks = _blocks(points, keys, block)
    plan = cut(_summaries(blocks, keys).groupBy(*keys).applyInPandas(lambda pdf: _routes(pdf, span), ROUTE))
    sent = plan.select(F.col("block").alias("at"), F.explode("sources").alias("block"))
    halo = blocks.join(sent, "block").select("at", "block", "_x", "_n", "_sy")
    fits = halo.groupBy("at").cogroup(plan.groupBy("block")).applyInPandas(_solve, "at long, _x double, smooth double")
    named = blocks.withColumnRenamed("block", "at").select(*keys, "at", "_x", F.col("_n").cast("long").alias("n"))
    return named.join(fits, ["at", "_x"]).select(*keys, F.col("_x").alias(x), "n", "smooth")


#: For each block: how many rows its windows hold, what whole blocks bring together, and the blocks whose rows it needs.
ROUTE = "block long, needed double, wholes array<struct<sign double, centre double, scale double, counts array<double>, sums array<double>>>, sources array<long>"


def _blocks(points: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """``points`` in blocks of up to ``size`` of one group and range, with the block's number and ends; numbers ascend with x."""
    placed = ranged(points, [*keys, "_x"])
    along = Window.partitionBy(PART).orderBy(*keys, "_x")
    nth = placed.withColumn("_nth", F.row_number().over(along).cast("long"))
    nth = nth.withColumn("_from", F.min("_nth").over(Window.partitionBy(PART, *keys)))
    start = F.col("_from") + F.floor((F.col("_nth") - F.col("_from")) / size) * size
    numbered = nth.withColumn("block", F.col(PART).cast("long") * F.lit(1 << 40) + start)
    inside = Window.partitionBy("block")
    return cut(numbered.select(*keys, "block", "_x", "_n", "_sy", F.min("_x").over(inside).alias("lo"), F.max("_x").over(inside).alias("hi")))


def _summaries(blocks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row a block: its ends, its rows and its moments about its middle, in halves of its width."""
    half = (F.col("hi") - F.col("lo")) / 2
    z = (F.col("_x") - F.col("lo") - half) / F.when(half > 0, half).otherwise(1.0)
    moments = lambda c, k: F.array(*(F.sum(F.col(c) * F.pow(z, F.lit(float(p)))) for p in range(k)))
    return blocks.groupBy(*keys, "block", "lo", "hi").agg(F.sum("_n").alias("n"), moments("_n", POWERS).alias("counts"), moments("_sy", POWERS - 1).alias("sums"))


def _reach(distances: np.ndarray, n: np.ndarray, q: float) -> float:
    """The distance at which q rows are reached."""
    order = np.argsort(distances, kind="stable")
    return float(distances[order][min(np.searchsorted(np.cumsum(n[order]), q), len(order) - 1)])


def _recentred(moments: np.ndarray, scale: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """The sum over blocks of their moments, each of z turned into those of scale * z + shift."""
    k = moments.shape[1]
    return np.array([sum((math.comb(p, j) * scale**j * shift ** (p - j) * moments[:, j]).sum() for j in range(p + 1)) for p in range(k)])


def _together(lo: np.ndarray, hi: np.ndarray, counts: np.ndarray, sums: np.ndarray, sign: float) -> dict:
    """Whole blocks as one, about their common middle."""
    centre, width = (lo.min() + hi.max()) / 2, (hi.max() - lo.min()) / 2 or 1.0
    half = np.where(hi > lo, (hi - lo) / 2, 1.0)
    scale, shift = half / width, ((lo + hi) / 2 - centre) / width
    return {"sign": sign, "centre": centre, "scale": width, "counts": _recentred(counts, scale, shift).tolist(), "sums": _recentred(sums, scale, shift).tolist()}


def _routes(pdf: pd.DataFrame, span: float) -> pd.DataFrame:
    """For each block of a group, what it needs.

    Both ends of a window move up with its point, so those of a block's first and last points bound all
    between.  Each end is known to within a block by the ends and sizes of blocks alone.
    """
    pdf = pdf.sort_values("lo")
    lo, hi, n, ids = (pdf[c].to_numpy() for c in ("lo", "hi", "n", "block"))
    counts, sums = np.stack(pdf["counts"].to_list()), np.stack(pdf["sums"].to_list())
    needed = min(n.sum(), max(2.0, math.ceil(span * n.sum())))
    out = []
    for i in range(len(ids)):
        near = [_reach(np.maximum(np.maximum(lo - at, at - hi), 0.0), n, needed) for at in (lo[i], hi[i])]
        most = [_reach(np.maximum(np.abs(lo - at), np.abs(hi - at)), n, needed) for at in (lo[i], hi[i])]
        outside = (hi < lo[i] - most[0]) | (lo > hi[i] + most[1])
        whole = (lo > hi[i] - near[1]) & (hi < lo[i] + near[0]) & (hi - lo <= min(near) * NARROW)
        whole[i] = outside[i] = False
        lot = np.abs((lo + hi) / 2 - (lo[i] + hi[i]) / 2) > min(near) / 2
        if hi[i] - lo[i] > min(near) * NARROW:  # the same blocks are near some of its points and far from others
            lot = np.arange(len(ids))
        wholes = []
        for sign, side in ((-1.0, lo < lo[i]), (1.0, lo > lo[i])):
            side &= whole
            for one in np.unique(lot[side]):
                which = side & (lot == one)
                wholes.append(_together(lo[which], hi[which], counts[which], sums[which], sign))
        out.append((ids[i], needed, wholes, ids[~whole & ~outside].tolist()))
    return pd.DataFrame(out, columns=["block", "needed", "wholes", "sources"])


def _weighted(p: int, far: bool) -> np.ndarray:
    """The tricube weight times u^p, by powers of u, the distance in units of the window; ``far``: by powers of 1 - u.

    Near the end of a window weights are small, and only powers of 1 - u keep their digits.
    """
    weight, line = ([0, 3, -3, 1], [1, -1]) if far else ([1, 0, 0, -1], [0, 1])
    return (Polynomial(weight) ** 3 * Polynomial(line) ** p).coef


def _last_within(xs: np.ndarray, at: np.ndarray, pos: np.ndarray, d: np.ndarray, step: int) -> np.ndarray:
    """The farthest place from ``pos`` upwards (step 1) or downwards (-1) whose distance is at most d."""
    near, far = pos.copy(), np.full_like(pos, len(xs) - 1 if step > 0 else 0)
    while (open_ := near != far).any():
        mid = near + step * ((np.abs(far - near) + 1) // 2)
        ok = np.abs(xs[mid] - at) <= d
        near, far = np.where(ok & open_, mid, near), np.where(~ok & open_, mid - step, far)
    return near


def _kth_distance(xs: np.ndarray, cum: np.ndarray, at: np.ndarray, k: float) -> np.ndarray:
    """The distance from each point to its k-th nearest row; ``cum`` counts rows before each place."""
    pos = np.searchsorted(xs, at)

    def held(d: np.ndarray) -> np.ndarray:
        return cum[_last_within(xs, at, pos, d, 1) + 1] - cum[_last_within(xs, at, pos, d, -1)]

    best = np.full(len(at), math.inf)
    for step, end in ((1, len(xs) - 1), (-1, 0)):
        near, far = pos.copy(), np.full_like(pos, end)
        while (open_ := near != far).any():  # the nearest place on this side that reaches k
            mid = near + step * (np.abs(far - near) // 2)
            ok = held(np.abs(xs[mid] - at)) >= k
            near, far = np.where(~ok & open_, mid + step, near), np.where(ok & open_, mid, far)
        d = np.abs(xs[near] - at)
        best = np.minimum(best, np.where(held(d) >= k, d, math.inf))
    return best


def _solve(rows: pd.DataFrame, plan: pd.DataFrame) -> pd.DataFrame:
    """The fits at the points of one block."""
    if rows.empty or plan.empty:
        return pd.DataFrame({"at": [], "_x": [], "smooth": []})
    plan, rows = plan.iloc[0], rows.sort_values("_x")
    xs, n, sy = (rows[c].to_numpy(float) for c in ("_x", "_n", "_sy"))
    at = xs[(rows["block"] == rows["at"]).to_numpy()]
    inner = sum(group["counts"][0] for group in plan["wholes"])
    h = np.maximum(_kth_distance(xs, np.concatenate([[0.0], np.cumsum(n)]), at, plan["needed"] - inner), 1e-12)
    # s and t: sums of weight times the 0th, 1st and 2nd power of distance / h, over rows and over y.
    s, t = np.zeros((3, len(at))), np.zeros((2, len(at)))
    for a in range(0, len(at), step := max(1, CELLS // len(xs))):
        part = slice(a, a + step)
        u = (xs[None, :] - at[part, None]) / h[part, None]
        w = np.clip(1 - np.abs(u) ** 3, 0, None) ** 3
        for p in range(3):
            s[p, part] += (w * u**p) @ n
            if p < 2:
                t[p, part] += (w * u**p) @ sy
    for group in plan["wholes"]:
        away = (group["centre"] - at) * group["sign"] / h
        for far in (False, True):
            if not (here := (away > 0.5) == far).any():
                continue
            step = group["scale"] / h[here] * (-group["sign"] if far else group["sign"])
            shift = 1 - away[here] if far else away[here]
            for moments, into in ((group["counts"], s), (group["sums"], t)):
                powers = [sum(math.comb(p, j) * step**j * shift ** (p - j) * moments[j] for j in range(p + 1)) for p in range(len(moments))]
                for p in range(len(into)):
                    into[p, here] += group["sign"] ** p * sum(c * powers[k] for k, c in enumerate(_weighted(p, far)) if c)
    det = s[0] * s[2] - s[1] * s[1]
    line = det > 1e-12 * s[0] * s[2]
    smooth = np.where(line, (s[2] * t[0] - s[1] * t[1]) / np.where(line, det, 1.0), t[0] / s[0])
    return pd.DataFrame({"at": int(rows["at"].iloc[0]), "_x": at, "smooth": smooth})
