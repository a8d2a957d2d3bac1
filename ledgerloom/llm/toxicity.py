"""Toxicity by a support vector machine on a subsequence string kernel with Nyström landmarks.

A text is split into sentences, and a sentence is seen through windows: its words, lower-cased
and freed of all but letters (so ``id-i.ot`` is ``idiot``), runs of single letters joined
(``i - d* i o t``) and any two neighbours of up to ``SHORT`` letters joined (``id iot``),
whatever white space and signs lie between, each between end marks, so that a whole word and
a longer one that begins or ends alike differ.  What is longer than ``WIDTH`` gives overlapping
windows of that length.  Windows are compared by the gap-weighted subsequence kernel of order
3: a subsequence counts ``DECAY`` to the power of the stretch that it covers, up to
``STRETCH`` characters, so a match survives inserted characters; kernels are normalised.  The
commonest letters have numbers of their own and all others share one.

The machine is trained on labelled sentences.  A sentence of a clean text is clean: so is
every window of it.  A toxic text has some toxic sentence, which the labels don't name, so
the machine finds it (multiple-instance learning): at first every sentence of a toxic text
counts as toxic; then, in turns, the machine picks the windows of toxic texts that it takes
for toxic, of each text the worst at least, and learns those against all windows of clean
sentences; at last it also learns two spellings of each,
with a letter put in.  Windows of equal sentences count once, so that
copies of a sentence are one.  A text scores as its worst sentence, a sentence as its worst
window: what is toxic only as a combination of windows isn't learned.

Landmarks are windows, of toxic and of clean sentences, at which the loss so far pulls
hardest.  As the kernel is an inner product of subsequence counts, the weights of all
landmarks fold into one weight for each subsequence: scoring a window costs the same for
any number of landmarks, and is the Nyström machine's exact decision.

Learning takes a bounded sample of labelled rows (``TOXIC_ROWS`` and ``CLEAN_ROWS``, in
expectation, by a hash of the id, and of the windows in fewer than ``SEEN`` toxic sentences a
share of ``RARE_WINDOWS``, also by hash); scoring runs over whole texts of all rows, of any
length, a stretch of a text at a time.  Null and empty texts score as a text without a
window.  Where the sample doesn't hold both labels, or no window, every text gets one score:
the share of toxic labels.  Repeated rows each give a row; labels that are null or repeated
with both values count as neither; ties between windows go to the first by code point;
columns other than those named are ignored, whatever their names; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache
from hashlib import blake2b
from itertools import combinations, pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .durable import cut, give_back, small_batches, tidy
from .langid import held_out

#: Bounds of the sample that is learned from.
TOXIC_ROWS, CLEAN_ROWS, RARE_WINDOWS = 4000, 8000, 200_000
#: Toxic sentences from which a window is always in the sample.
SEEN = 3
#: Landmarks, how many are found at a time, rounds before and after toxic sentences are picked.
LANDMARKS, AT_A_TIME, ROUNDS, TURNS = 512, 40, 8, 5
#: Windows that the machine is first fitted on, and that a round adds.
FIRST, MORE = 1500, 400
#: Loss of a window for each sentence that holds it, and sentences that count.
COST, MOST_COUNTED, PRIOR = 0.6, 30, 1.0
#: Neighbours of so many letters at most are also joined.
SHORT = 4
DECAY, STRETCH, WIDTH = 0.6, 6, 16
SYMBOLS = 64
#: Opens and closes a window's string; no letter.
END = "."
_OFFSETS = [(j, k) for j, k in combinations(range(1, STRETCH), 2)]
_WIDTHS = [8, 12, WIDTH]  # to which windows are filled up, by their length, where they are many
_AT_ONCE = 2000  # windows whose subsequences are held together
_WIDE_ROWS = 64  # windows whose kernels with all landmarks are computed together
_WORK = 1 << 20  # characters whose new strings are scored together
_MEMORY = 40 << 20  # bytes of strings that a task remembers, roughly

# A sentence ends after a word of two letters or more, so that letters set apart by signs stay together.
_SENTENCE_END = regex.compile(r"(?<=\w\w)(?:[.!?…]+(?=\s)|\s*\n)")


def strings(text: str) -> list[str]:
    """A text's words, its runs of three single letters or more, joined, and its short neighbours, joined in twos."""
    words = text.split()
    return words + joins(words)


def joins(words: list[str]) -> list[str]:
    """Strings of three letters or more that gaps cut up; words without a letter lie in a gap."""
    out: list[str] = []
    run, before = "", ""
    for w in words:
        x = (w if w.isalpha() else letters(w)) if len(w) > SHORT else _short_letters(w)
        if not x:
            continue
        if len(x) == 1:
            run += x
        else:
            if len(run) >= 3:
                out.append(run)
            run = ""
        if len(x) > SHORT:
            before = ""
            continue
        if before and len(before) + len(x) >= 3:
            out.append(before + x)
        before = x
    if len(run) >= 3:
        out.append(run)
    return out


def letters(word: str) -> str:
    low = word.lower()
    return low if low.isalpha() else "".join(filter(str.isalpha, low))


#: Short words are few and come often.
_short_letters = lru_cache(1 << 14)(letters)


def windows_of(string: str) -> list[str]:
    """The windows of a closed string, each of at most WIDTH characters."""
    if len(string) <= WIDTH:
        return [string]
    return [string[at : at + WIDTH] for at in range(0, len(string) - WIDTH // 2, WIDTH // 2)]


def sentences(text: str) -> Iterator[set[str]]:
    """The windows of each sentence."""
    for sentence in _SENTENCE_END.split(text):
        if found := {w for s in strings(sentence) if (x := letters(s)) for w in windows_of(END + x + END)}:
            yield found


def sentence_hash(windows: set[str]) -> int:
    """Equal for sentences with the same windows."""
    return int.from_bytes(blake2b(" ".join(sorted(windows)).encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


@dataclass
class Symbols:
    """Numbers of letters; 0 is no letter and the last number all rare letters."""

    number: dict[str, int]

    @staticmethod
    def of(words: list[str]) -> Symbols:
        seen: dict[str, int] = {}
        for w in words:
            for c in w:
                seen[c] = seen.get(c, 0) + 1
        common = sorted(seen, key=lambda c: (-seen[c], c))[: SYMBOLS - 2]
        return Symbols({c: i + 1 for i, c in enumerate(common)})

    @cached_property
    def _of_code_point(self) -> np.ndarray:
        table = np.full(0x110000, SYMBOLS - 1, np.uint8)
        for c, n in self.number.items():
            table[ord(c)] = n
        return table

    def rows(self, windows: list[str], width: int = WIDTH) -> np.ndarray:
        """A row of numbers for each window, filled up to a width that none exceeds."""
        lengths = np.fromiter(map(len, windows), np.int64, len(windows))
        out = np.zeros((len(windows), width), np.int32)
        out[np.arange(width) < lengths[:, None]] = self._of_code_point[np.frombuffer("".join(windows).encode("utf-32-le", "surrogatepass"), "<u4")]
        return out


def subsequences(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row its subsequences of three (numbers; 0: none) and their weights."""
    ids, weights, width = [], [], rows.shape[1]
    for j, k in _OFFSETS:
        a, b, c = rows[:, : width - k], rows[:, j : width - k + j], rows[:, k:]
        ids.append(np.where(c > 0, (a * SYMBOLS + b) * SYMBOLS + c, 0))
        weights.append(np.full(width - k, DECAY ** (k + 1)))
    return np.concatenate(ids, 1), np.concatenate(weights)


def norms(ids: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The root of each row's kernel with itself."""
    kinds, kind = np.unique(weights, return_inverse=True)  # a weight for each stretch: few, so they're sorted along
    packed = np.sort(ids << 3 | kind.astype(ids.dtype), axis=1)
    sorted_ids = packed >> 3
    sums = np.cumsum(np.where(sorted_ids > 0, kinds[packed & 7], 0.0), 1)
    ends = np.ones(sums.shape, bool)
    ends[:, :-1] = sorted_ids[:, 1:] != sorted_ids[:, :-1]
    at_ends = np.where(ends, sums, 0.0)
    earlier = np.zeros_like(at_ends)
    earlier[:, 1:] = np.maximum.accumulate(at_ends, 1)[:, :-1]
    return np.sqrt(np.maximum((np.where(ends, sums - earlier, 0.0) ** 2).sum(1), 1e-30))


@dataclass
class ToxicityModel:
    symbols: Symbols
    weights: np.ndarray | None  # of each subsequence
    bias: float
    slope: float
    offset: float

    def decide(self, windows: list[str]) -> np.ndarray:
        """The machine's decision for each window; windows of fewer than three characters have none and get the least."""
        out, lengths = np.full(len(windows), -2.0), np.fromiter(map(len, windows), np.int64, len(windows))
        for less, width in pairwise([0, *(_WIDTHS if len(windows) > _AT_ONCE else [WIDTH])]):
            alike = np.flatnonzero((lengths > less) & (lengths <= width))
            for at in range(0, len(alike), _AT_ONCE):
                part = alike[at : at + _AT_ONCE]
                rows = self.symbols.rows([windows[i] for i in part.tolist()], width)
                found = subsequences(rows)
                out[part] = self._decide(rows, *found, norms(*found))
        return out

    def decide_rows(self, rows: np.ndarray, norm: np.ndarray) -> np.ndarray:
        return self._decide(rows, *subsequences(rows), norm)

    def _decide(self, rows: np.ndarray, ids: np.ndarray, w: np.ndarray, norm: np.ndarray) -> np.ndarray:
        value = self.weights[ids] @ w / norm + self.bias
        return np.where(rows[:, 2] > 0, np.clip(value, -2.0, 2.0), -2.0)

    def decide_strings(self, strings: list[str]) -> np.ndarray:
        """For strings of a text: the decision of the worst window of each."""
        windows, owner = [], []
        for i, s in enumerate(strings):
            if x := letters(s):
                own = windows_of(END + x + END)
                windows += own
                owner += [i] * len(own)
        out = np.full(len(strings), -2.0)
        np.maximum.at(out, np.array(owner, np.int64), self.decide(windows))
        return out

    def probability(self, decision: float) -> float:
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.slope * decision + self.offset))))

    def scores(self, texts: Iterator[str | None], known: dict[str, float]) -> Iterator[float]:
        """The decision for each text; ``known`` remembers strings."""
        waiting: list[set[str]] = []
        size = 0
        for text in texts:
            waiting.append(set(strings(text)) if text and self.weights is not None else set())
            size += len(text or "")
            if size >= _WORK:
                yield from self._settle(waiting, known)
                waiting, size = [], 0
        yield from self._settle(waiting, known)

    def _settle(self, waiting: list[set[str]], known: dict[str, float]) -> Iterator[float]:
        asked = set().union(*waiting)
        if len(known) * 130 > _MEMORY:
            known.clear()
        new = [*asked.difference(known)]
        known.update(zip(new, self.decide_strings(new).tolist() if new else [], strict=True))
        for own in waiting:
            yield max(map(known.__getitem__, own), default=-2.0)
        for s in new:
            if len(s) > 4 * WIDTH:  # rarely met again
                del known[s]


def _kernel(symbols: Symbols, windows: list[str], landmarks: list[str]) -> np.ndarray:
    """Normalised kernels of windows with landmarks."""
    there = np.unique(subsequences(symbols.rows(landmarks))[0])
    there = there[there > 0]
    column = np.zeros(SYMBOLS**3, np.int32)
    column[there] = np.arange(1, len(there) + 1)

    def dense(strings: list[str]) -> np.ndarray:
        """Rows of all subsequences that landmarks have: few strings at a time, as the rows are long."""
        ids, w = subsequences(symbols.rows(strings))
        wide = len(there) + 1
        at = (np.arange(len(ids))[:, None] * wide + column[ids]).ravel()
        out = np.bincount(at, np.tile(w, len(ids)), minlength=len(ids) * wide).reshape(-1, wide)
        out[:, 0] = 0
        out /= norms(ids, w)[:, None]
        return out.astype(np.float32)

    right = np.concatenate([dense(landmarks[at : at + _WIDE_ROWS]) for at in range(0, len(landmarks), _WIDE_ROWS)]).T
    parts = [dense(windows[at : at + _WIDE_ROWS]) @ right for at in range(0, len(windows), _WIDE_ROWS)]
    return np.concatenate(parts).astype(np.float64)


def fit_svm(x: np.ndarray, toxic: np.ndarray, clean: np.ndarray, steps: int = 30) -> np.ndarray:
    """Primal support vector machine with squared hinge loss by Newton's method.

    ``toxic`` and ``clean`` are each row's masses under either label; the last column isn't penalised.
    """
    w = np.zeros(x.shape[1])
    penal = np.ones(x.shape[1])
    penal[-1] = 1e-6

    def loss(v: np.ndarray) -> float:
        f = x @ v
        return float(0.5 * (penal * v * v).sum() + (toxic * np.maximum(0, 1 - f) ** 2 + clean * np.maximum(0, 1 + f) ** 2).sum())

    now = loss(w)
    for _ in range(steps):
        f = x @ w
        up, down = toxic * (f < 1), clean * (f > -1)
        gradient = penal * w - 2 * x.T @ (up * (1 - f) - down * (1 + f))
        curve = np.diag(penal)
        for at in range(0, len(x), _AT_ONCE):
            part = x[at : at + _AT_ONCE]
            curve += 2 * (part * (up + down)[at : at + _AT_ONCE, None]).T @ part
        step = np.linalg.solve(curve, gradient)
        rate, before = 1.0, now
        while rate > 1e-4 and (now := loss(w - rate * step)) > before:
            rate /= 2
        w = w - rate * step
        if before - now <= 1e-5 * before:
            break
    return w


def disguised(window: str, seed: int = 0) -> list[str]:
    """Two spellings of a window of a whole string with a letter put in."""
    if not 7 <= len(window) < WIDTH or window[0] != END or window[-1] != END:
        return []
    rng = np.random.default_rng([seed, *map(ord, window)])
    return [window[:at] + chr(ord("a") + int(rng.integers(26))) + window[at:] for at in rng.choice(np.arange(2, len(window) - 1), 2, replace=False)]


class Learner:
    """Fits the machine to windows, with how many toxic and clean sentences hold each; finds landmarks as it goes."""

    def __init__(self, windows: list[str], toxic: np.ndarray, clean: np.ndarray):
        self.windows, self.clean = windows, clean
        self.symbols = Symbols.of(windows)
        self.rows = self.symbols.rows(windows).astype(np.uint8)
        self.norms = np.concatenate([norms(*subsequences(self.rows[at : at + _AT_ONCE].astype(np.int32))) for at in range(0, len(windows), _AT_ONCE)])
        self.landmarks: list[int] = []
        self.active: list[int] = []
        # Windows of toxic sentences are far fewer: both kinds weigh alike in all.
        self.weigh(toxic, clean.sum() / toxic.sum(), PRIOR)

    def weigh(self, toxic: np.ndarray, times: float = 1.0, prior: float = 0.0) -> None:
        """Masses of the windows under either label, from counts of toxic ones, each weighing so many times a clean one.

        ``prior`` sentences of either kind are added to each window's, so that rare ones say little.
        """
        mass = COST * np.minimum(toxic + self.clean, MOST_COUNTED)
        share = times * (toxic + prior) / np.maximum(times * (toxic + 2 * prior) + self.clean, 1e-9)
        self.up, self.down = mass * share, mass * (1 - share)

    def add(self, windows: list[str], toxic: np.ndarray) -> None:
        """More windows, of toxic sentences only, in the fit from now on."""
        rows = self.symbols.rows(windows)
        self.active += range(len(self.windows), len(self.windows) + len(windows))
        self.windows, self.clean = self.windows + windows, np.append(self.clean, np.zeros(len(windows)))
        self.rows, self.norms = np.concatenate([self.rows, rows.astype(np.uint8)]), np.append(self.norms, norms(*subsequences(rows)))
        mass = COST * np.minimum(toxic, MOST_COUNTED)
        self.up, self.down = np.append(self.up, mass), np.append(self.down, np.zeros(len(windows)))

    def decisions(self, model: ToxicityModel) -> np.ndarray:
        return np.concatenate([model.decide_rows(self.rows[at : at + _AT_ONCE].astype(np.int32), self.norms[at : at + _AT_ONCE]) for at in range(0, len(self.windows), _AT_ONCE)])

    def pull(self, decisions: np.ndarray) -> np.ndarray:
        """How hard the loss pulls at each window's decision."""
        return np.abs(self.up * np.maximum(0, 1 - decisions) - self.down * np.maximum(0, 1 + decisions))

    def _add(self, pull: np.ndarray, landmarks: int, active: int) -> None:
        order = np.argsort(-pull, kind="stable")
        held, used = set(self.landmarks), set(self.active)
        self.landmarks += [i for i in order[: landmarks + len(held)].tolist() if i not in held][: min(landmarks, LANDMARKS - len(held))]
        self.active += [i for i in order[: active + len(used)].tolist() if i not in used and pull[i] > 1e-3][:active]

    def fit(self, model: ToxicityModel | None = None) -> ToxicityModel:
        """The machine after a round: with more landmarks, and more windows, where the one before was pulled hardest."""
        if model is None:
            self._add(np.abs(self.up - self.down), AT_A_TIME, FIRST)
            spread = np.random.default_rng(0).permutation(len(self.windows))[:FIRST].tolist()
            self.active = list(dict.fromkeys([*self.active, *spread]))
        else:
            self._add(self.pull(self.decisions(model)), AT_A_TIME, MORE)
        return self._machine()

    def _machine(self) -> ToxicityModel:
        landmarks = [self.windows[i] for i in self.landmarks]
        values, vectors = np.linalg.eigh(_kernel(self.symbols, landmarks, landmarks))
        kept = values > 1e-6 * values[-1]
        half = vectors[:, kept] / np.sqrt(values[kept])
        x = np.ones((len(self.active), half.shape[1] + 1))
        for at in range(0, len(x), _AT_ONCE):  # no second copy of all rows
            x[at : at + _AT_ONCE, :-1] = _kernel(self.symbols, [self.windows[i] for i in self.active[at : at + _AT_ONCE]], landmarks) @ half
        w = fit_svm(x, self.up[self.active], self.down[self.active])
        ids, weight = subsequences(self.symbols.rows(landmarks))
        share = (half @ w[:-1]) / norms(ids, weight)
        folded = np.bincount(ids.ravel(), (share[:, None] * weight[None, :]).ravel(), minlength=SYMBOLS**3)
        folded[0] = 0
        return ToxicityModel(self.symbols, folded.astype(np.float32), float(w[-1]), 1.0, 0.0)


def learn(windows: list[str], toxic: np.ndarray, clean: np.ndarray, worst_windows: Callable[[ToxicityModel], dict[str, int]]) -> tuple[ToxicityModel, list[str]]:
    """The machine, and spellings of toxic windows that it hasn't seen.

    ``worst_windows`` tells in how many toxic texts a model finds each window toxic, or the worst.
    """
    learner = Learner(windows, toxic, clean)
    model = None
    for _ in range(ROUNDS):
        model = learner.fit(model)
    at = {w: i for i, w in enumerate(windows)}
    for turn in range(TURNS):
        picked = np.zeros(len(windows))
        for w, n in worst_windows(model).items():
            if w in at:
                picked[at[w]] = n
        learner.weigh(picked)
        if turn == TURNS - 1:
            spelt = {v: picked[at[w]] for w in windows if picked[at[w]] >= SEEN for v in disguised(w) if v not in at}
            if spelt:
                learner.add([*spelt], np.array([*spelt.values()]))
            model = learner.fit(model)
        model = learner.fit(model)
    unseen = [v for w in windows if picked[at[w]] >= SEEN for v in disguised(w, 1) if v not in at]
    return model, unseen


def fit_slope(decisions: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Platt's sigmoid, by Newton's method on smoothed labels, classes as they are."""
    n1, n0 = toxic.sum(), (1 - toxic).sum()
    target = np.where(toxic > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([decisions, np.ones(len(decisions))], 1)
    w = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (p - target) + 1e-3 * w)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(w[0], 1e-3)), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> ToxicityModel:
    """Learns from labelled rows that aren't held out."""
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic")).filter(F.col("toxic").isin(0, 1) & ~held_out(F.col("id")))
    marks = marks.groupBy("id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).filter("toxic = most").drop("most")
    n = {r["toxic"]: r["n"] for r in marks.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    constant = ToxicityModel(Symbols({}), None, 0.0, 0.0, math.log((n1 + 0.5) / (n0 + 0.5)) if n1 + n0 and n1 else -10.0)
    if not n1 or not n0:
        return constant
    drawn = F.pmod(F.xxhash64(F.lit("toxicity"), F.col("id").cast("string")), F.lit(1_000_000)) / 1e6
    marks = marks.filter(drawn < F.when(F.col("toxic") == 1, F.lit(toxic_rows / n1)).otherwise(F.lit(clean_rows / n0)))
    # The marks drawn are bounded by the sample's size, so texts needn't move to meet them.
    marks = cut(marks.filter("id IS NOT NULL"))
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(marks), "id").select("toxic", "text")
    sample = cut(small_batches(sample))

    @tidy
    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, found, held_in = [], [], []
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for own in sentences(text.as_py() or ""):
                    toxic.append(label)
                    found.append(sorted(own))
                    held_in.append(sentence_hash(own))
            yield pa.RecordBatch.from_arrays([pa.array(toxic, pa.int32()), pa.array(held_in, pa.int64()), pa.array(found, pa.list_(pa.string()))], names=["toxic", "sentence", "windows"])

    said = sample.mapInArrow(take, "toxic int, sentence long, windows array<string>")
    # Equal sentences are one; one that clean texts hold too is clean.
    said = said.groupBy("sentence").agg(F.min("toxic").alias("toxic"), F.min("windows").alias("windows"))
    by_window = said.select("toxic", F.explode("windows").alias("window")).groupBy("window").agg(F.sum("toxic").cast("long").alias("t"), F.sum(1 - F.col("toxic")).cast("long").alias("c"))
    by_window = cut(by_window)
    rare = by_window.filter(F.col("t") < SEEN).count()
    lot = F.pmod(F.xxhash64("window"), F.lit(1_000_000)) / 1e6 < F.lit(RARE_WINDOWS / max(1, rare))
    sampled = by_window.filter((F.col("t") >= SEEN) | lot)
    drawn_windows = sampled.select("window")
    found = sampled.select("window", "t", "c").toArrow()  # bounded by the sample
    names = found.column("window").to_pylist()
    order = np.array(sorted(range(len(names)), key=names.__getitem__), np.int64)
    windows = [names[i] for i in order]
    toxic, clean = (found.column(c).to_numpy().astype(float)[order] for c in ("t", "c"))
    del found, names
    if not toxic.any() or not clean.any():
        return constant

    @tidy
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set().union(*sentences(text.as_py() or ""))) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([pa.array([ws for ws in found if ws], pa.list_(pa.string()))], names=["windows"])

    toxic_texts = cut(sample.filter("toxic = 1").mapInArrow(split, "windows array<string>"))

    def worst_windows(model: ToxicityModel) -> dict[str, int]:
        shared = docs.sparkSession.sparkContext.broadcast(model)

        @tidy
        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for batch in batches:
                texts = batch.column(0).to_pylist()
                asked = sorted(set().union(*texts))
                known = dict(zip(asked, own.decide(asked).tolist(), strict=True))
                worst = []
                for ws in texts:
                    decided = [known[w] for w in ws]
                    worst += {ws[decided.index(max(decided))], *(w for w, f in zip(ws, decided, strict=True) if f > 0)}
                yield pa.RecordBatch.from_arrays([pa.array(worst, pa.string())], names=["window"])

        picked = toxic_texts.mapInArrow(pick, "window string").groupBy("window").agg(F.count("*").alias("n"))
        return {r["window"]: r["n"] for r in picked.join(drawn_windows, "window").collect()}  # of the bounded windows only

    model, unseen = learn(windows, toxic, clean, worst_windows)
    # The sigmoid is set for the sample's shares, with spellings that weren't learned among the toxic.
    seen = [(r["decision"], r["toxic"]) for r in _decide(sample, model, "toxic").collect()]
    seen = np.array([*seen, *((d, 1) for d in model.decide(unseen))], float)
    model.slope, model.offset = fit_slope(seen[:, 0], seen[:, 1])
    give_back()
    return model


def _decide(rows: DataFrame, model: ToxicityModel, id_col: str) -> DataFrame:
    """id_col and decision of rows of (id_col, text)."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([T.StructField(id_col, rows.schema[0].dataType), T.StructField("decision", T.DoubleType())])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = shared.value, {}
        for batch in batches:
            made = [*own.scores((t.as_py() for t in batch.column(1)), known)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.float64())], names=schema.names)

    return rows.mapInArrow(run, schema)


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score (0 to 1) and predicted (1 from 0.5) of every row: one scan, no shuffle."""
    rows = small_batches(docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text")))
    z = F.lit(model.slope) * F.col("decision") + F.lit(model.offset)
    return _decide(rows, model, id_col).select(id_col, (1 / (1 + F.exp(-z))).alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def annotate(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """``docs`` with toxic_score and toxic_predicted (in place of columns of those names): one scan, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = small_batches(docs.drop("toxic_score", "toxic_predicted"))
    at = rows.columns.index(text_col)
    schema = T.StructType([*rows.schema.fields, T.StructField("toxic_score", T.DoubleType())])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = shared.value, {}
        for batch in batches:
            made = [own.probability(d) for d in own.scores((t.as_py() for t in batch.column(at)), known)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.float64())], names=schema.names)

    return rows.mapInArrow(run, schema).withColumn("toxic_predicted", (F.col("toxic_score") >= 0.5).cast("int"))
