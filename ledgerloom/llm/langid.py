"""Language identification by sparse multinomial logistic regression.

A text's features are its lower-cased character n-grams (1 to 3), hashed into a fixed
number of places: log of one plus the count, times the inverse document frequency, divided
by the text's norm.  The weights are fitted by follow-the-regularised-leader with elastic
net penalties on a bounded sample of the labelled rows; a temperature fitted on labelled
rows kept apart from those makes the scores probabilities.

The sample takes about ``ROWS_A_LANGUAGE`` rows of each language, by a hash of their ids.
Document frequencies are of all rows that may be learned from, and prediction runs over whole
texts, of any length, of all rows.  Null and empty texts and texts without a letter are
``und`` with score 0, as is every text where there is no labelled row.  Every fifth row of the
sample sets the temperature; of fewer than five rows none does and it's 1.  Ties go to the
language first by code point.  Repeated rows each give a row; columns other than the id, the
text and the language are ignored, whatever their names; empty tables give no rows.  A model
holds a weight for each place and language, so more than ``MOST_LANGUAGES`` different values
of the language are an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .durable import cut, give_back, small_batches, tidy

#: Bound of the sample: labelled rows of each language, in expectation.
ROWS_A_LANGUAGE = 800
PLACES = 1 << 15
MOST_LANGUAGES = 1000
#: Tasks that add up the document frequencies of all tasks.
MOST_SUMS = 8
_LETTER = regex.compile(r"\p{L}")
_SLICE = 1 << 20
UNDETERMINED = "und"


def held_out(id_col: Column) -> Column:
    """Whether the row is kept out of learning: crc32 of its id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def counts(text: str) -> np.ndarray:
    """How many of a text's character n-grams fall into each place."""
    total = np.zeros(PLACES, np.int64)
    low = text.lower()
    for at in range(0, max(1, len(low)), _SLICE):
        codes = np.frombuffer(low[max(0, at - 2) : at + _SLICE].encode("utf-32-le"), np.uint32)
        own = 2 if at else 0  # n-grams that end among these were counted with the last slice
        one = codes * np.uint32(0x9E3779B1)
        two = (one[:-1] ^ np.uint32(0x85EBCA6B)) * np.uint32(0x27D4EB2F) + one[1:]
        three = (two[:-1] ^ np.uint32(0xC2B2AE35)) * np.uint32(0x165667B1) + one[2:]
        grams = np.concatenate([one[own:], two[max(0, own - 1) :], three])
        total += np.bincount(((grams ^ (grams >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(17), minlength=PLACES)
    return total


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # places x languages
    bias: np.ndarray
    temperature: float

    def features(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        c = counts(text)
        places = np.flatnonzero(c)
        return self.weigh(places, c[places])

    def weigh(self, places: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = np.log1p(n) * self.idf[places]
        return places, x / (np.linalg.norm(x) or 1.0)

    def probabilities(self, places: np.ndarray, x: np.ndarray) -> np.ndarray:
        return softmax((x @ self.weights[places] + self.bias) / self.temperature)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not text or not _LETTER.search(text):
            return UNDETERMINED, 0.0
        p = self.probabilities(*self.features(text))
        best = int(np.argmax(p))
        return self.languages[best], float(min(1.0, p[best]))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], languages: int, epochs: int = 3, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias by FTRL-proximal, one row after another; the bias isn't penalised."""
    z, n = np.zeros((PLACES + 1, languages)), np.zeros((PLACES + 1, languages))
    free = np.array([PLACES])

    def weights(places: np.ndarray) -> np.ndarray:
        zs, ns = z[places], n[places]
        one, two = np.full(len(places), l1)[:, None], np.full(len(places), l2)[:, None]
        one[places == PLACES], two[places == PLACES] = 0, 0
        return np.where(np.abs(zs) <= one, 0.0, -(zs - np.sign(zs) * one) / ((beta + np.sqrt(ns)) / alpha + two))

    for _ in range(epochs):
        for places, x, label in rows:
            places, x = np.concatenate([places, free]), np.append(x, 1.0)
            w = weights(places)
            error = softmax(x @ w)
            error[label] -= 1
            g = x[:, None] * error
            ns = n[places]
            z[places] += g - (np.sqrt(ns + g * g) - np.sqrt(ns)) / alpha * w
            n[places] = ns + g * g
    w = weights(np.arange(PLACES + 1))
    return w[:PLACES].astype(np.float32), w[PLACES]


def fit_temperature(logits: list[np.ndarray], labels: list[int]) -> float:
    """The temperature that makes the labels likeliest, within 1/20 and 20; 1 without rows.

    One label more than there are rows counts as wrong, so that rows that are all told
    apart don't make every score 1.
    """
    if not labels:
        return 1.0
    z, y = np.array(logits), np.array(labels)
    wrong = 1 / (len(y) + 1)

    def loss(t: float) -> float:
        s = z / t
        s = s - s.max(1, keepdims=True)
        return float(np.mean(np.log(np.exp(s).sum(1)) - (1 - wrong) * s[np.arange(len(y)), y] - wrong * s.mean(1)))

    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 200))
    return float(min(grid, key=loss))


def fit(docs: DataFrame, rows_a_language: int = ROWS_A_LANGUAGE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Learns from rows that aren't held out and have a text and a language."""
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("id")))
    there = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(there) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages = sorted(there, key=lambda s: s.encode())
    if not languages:
        return LanguageModel([], np.zeros(PLACES), np.zeros((PLACES, 0)), np.zeros(0), 1.0)

    drawn = F.pmod(F.xxhash64(F.lit("langid"), F.coalesce("id", F.lit(""))), F.lit(1_000_000)) / 1e6
    keep = F.lit(False)
    for lang, n in there.items():
        keep = keep | ((F.col("lang") == F.lit(lang)) & (drawn < F.lit(rows_a_language / n)))
    schema = "draw double, lang string, places binary, n binary"

    @tidy
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The features of the rows of the sample, and at last in how many rows each place occurs."""
        held = np.zeros(PLACES, np.int64)
        for batch in batches:
            picked, places, n = [], [], []
            for i, (mine, text) in enumerate(zip(batch.column(3).to_pylist(), batch.column(2), strict=True)):
                c = counts(text.as_py())
                at = np.flatnonzero(c)
                held[at] += 1
                if mine:
                    picked.append(i)
                    places.append(at.astype(np.uint16).tobytes())
                    n.append(c[at].astype(np.uint32).tobytes())
            own = batch.take(pa.array(picked, pa.int32()))
            yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array(places, pa.binary()), pa.array(n, pa.binary())], names=["draw", "lang", "places", "n"])
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.float64()), pa.nulls(1, pa.string()), pa.nulls(1, pa.binary()), pa.array([held.tobytes()], pa.binary())], names=["draw", "lang", "places", "n"])

    @tidy
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(PLACES, np.int64)
        for batch in batches:
            for own in batch.column(0):
                total += np.frombuffer(own.as_py(), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["n"])

    read = cut(small_batches(rows.select(drawn.alias("draw"), "lang", "text", keep.alias("mine"))).mapInArrow(extract, schema))
    held = read.filter("draw IS NULL").select("n")
    df = np.zeros(PLACES, np.int64)
    for r in held.repartition(MOST_SUMS).mapInArrow(add, "n binary").collect():
        df += np.frombuffer(r["n"], np.int64)
    sample = read.filter("draw IS NOT NULL").collect()
    sample.sort(key=lambda r: (r["draw"], r["lang"], bytes(r["places"])))
    parsed = [(np.frombuffer(r["places"], np.uint16).astype(np.int64), np.frombuffer(r["n"], np.uint32).astype(np.int64), languages.index(r["lang"])) for r in sample]

    idf = np.log((1 + sum(there.values())) / (1 + df)) + 1
    model = LanguageModel(languages, idf.astype(np.float32), np.zeros((PLACES, len(languages)), np.float32), np.zeros(len(languages)), 1.0)
    weighed = [(*model.weigh(places, n), label) for places, n, label in parsed]
    apart = weighed[4::5]
    model.weights, model.bias = fit_ftrl([r for i, r in enumerate(weighed) if i % 5 != 4], len(languages))
    model.temperature = fit_temperature([x @ model.weights[places] + model.bias for places, x, _ in apart], [label for *_, label in apart])
    del sample, parsed, weighed, apart
    give_back()
    return model


def annotate(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and lang_score (in place of columns of those names): one scan, no shuffle.

    The model that is broadcast has a fixed number of places for each language.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = small_batches(docs.drop("lang_pred", "lang_score"))
    at = rows.columns.index(text_col)
    schema = T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("lang_score", T.DoubleType())])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            made = [own.predict(t.as_py()) for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.float64())], names=schema.names)

    return rows.mapInArrow(run, schema)


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred and score of every row."""
    rows = small_batches(docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text")))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([T.StructField(id_col, rows.schema[0].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            made = [own.predict(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.float64())], names=schema.names)

    return rows.mapInArrow(run, schema)
