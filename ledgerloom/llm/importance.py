"""Importance resampling towards a target, with n-grams as tuples of integer word ids.

Texts are read once.  A task numbers the words that it meets and the n-grams of more words, as
tuples of those numbers; a document is then a bag of its n-grams' numbers, packed into a few
bytes.  Numbers hold for a lot, a bounded stretch of a task's documents.  The lots' word lists meet
in one dictionary: sorted by word, each distinct word takes an id; tuples take these ids and are
counted over all lots, on the corpus' side and the target's.  Each distinct tuple's bytes are put
together again and hashed once; counts by bucket give each bucket's gain; gains go back to tuples,
to the lots' n-grams and to the bags.  Only word lists and n-gram lists are shuffled by content, a
row for each lot and distinct word or n-gram, so a frequent word is a few rows; documents go once,
by lot.

A document's score is its weight with noise of an extreme value distribution by a hash of its
id, so that the highest scores are a draw without replacement in proportion to the weights.
The order is found over ranges of scores, no task holding them all.

Null and empty texts and texts without words have no features and weight 0, can't be drawn, and
have a score all the same.  A document without an id takes the hash of an empty id and comes
last among equal scores.  Repeated rows are as many documents, each with a rank of its own if drawn.
Texts of any length are read whole.  An empty target or corpus leaves gains by counts of 0;
columns other than the id and the text are ignored, whatever their names; empty tables give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..durable import Steps
from ..operators.ordering import numbered
from .durable import cut, small_batches, tidy

#: A-Z count as a-z; all other characters beyond ASCII are of words.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: A lot ends with the document that brings it to so many distinct n-grams, documents or n-grams in all.
LOT_GRAMS, LOT_DOCUMENTS, LOT_FEATURES = 1 << 18, 1 << 14, 1 << 23
SENT_BYTES = 4 << 20


class _Words(dict):
    """Word as written: number of its lower-cased form."""

    def __init__(self):
        super().__init__()
        self.lowered: dict[str, int] = {}

    def __missing__(self, word: str) -> int:
        n = self[word] = self.lowered.setdefault(word.translate(_LOWER), len(self.lowered))
        return n


class _Numbered(dict):
    def __missing__(self, key: tuple) -> int:
        n = self[key] = len(self)
        return n


class _Times:
    """How often each number has occurred, for the corpus and the target."""

    def __init__(self):
        self.held = [np.zeros(0, np.int64)] * 2

    def add(self, numbers: np.ndarray, target: bool) -> None:
        counted = np.bincount(numbers)
        if len(self.held[target]) < len(counted):
            self.held[target] = np.concatenate([self.held[target], np.zeros(2 * len(counted) - len(self.held[target]), np.int64)])
        self.held[target][: len(counted)] += counted

    def upto(self, n: int) -> list[np.ndarray]:
        return [np.concatenate([held[:n], np.zeros(max(0, n - len(held)), np.int64)]) for held in self.held]


class Lot:
    """Numbers of words and n-grams of some documents, and how often each occurs on either side.

    A single word's number is its word's.  Where there are longer n-grams too, single words take
    the even numbers and longer ones the odd.
    """

    def __init__(self, least: int, most: int):
        self.single, self.sizes = least == 1, range(max(2, least), most + 1)
        self.stride = 2 if self.single and self.sizes else 1
        self.words, self.grams = _Words(), _Numbered()
        self.word_times, self.gram_times = _Times(), _Times()
        self.documents = self.features = 0

    def bag(self, text: str | None, target: bool) -> tuple[int, np.ndarray]:
        """The number of words, and the n-grams' numbers in order."""
        words = [*map(self.words.__getitem__, WORD.findall(text or ""))]
        parts = []
        if self.single:
            parts.append(np.array(words, np.uint32))
            self.word_times.add(parts[0], target)
            parts[0] *= np.uint32(self.stride)
        if self.sizes:
            number = self.grams.__getitem__
            longer = np.array([number(gram) for n in self.sizes for gram in zip(*(words[i:] for i in range(n)), strict=False)], np.uint32)
            self.gram_times.add(longer, target)
            parts.append(longer * np.uint32(self.stride) + np.uint32(self.stride - 1))
        bag = np.concatenate(parts)
        bag.sort()
        self.documents += 1
        self.features += len(bag)
        return len(words), bag

    def full(self) -> bool:
        return len(self.words.lowered) + len(self.grams) >= LOT_GRAMS or self.documents >= LOT_DOCUMENTS or self.features >= LOT_FEATURES


def packed(bag: np.ndarray) -> bytes:
    """A sorted bag as steps, compressed: most steps fit a byte."""
    return pa.compress(np.diff(bag, prepend=np.uint32(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True) if len(bag) else b""


def unpacked(data: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.int64)
    steps = np.frombuffer(pa.decompress(data, decompressed_size=4 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(steps.reshape(4, n).T).view("<u4").ravel().cumsum()


def _lots(steps: Steps, docs: DataFrame, target: DataFrame, least: int, most: int, kind: T.DataType) -> DataFrame:
    """Rows of two roles: 0, a lot's words, longer n-grams and times on both sides; 1, a document's bag."""
    rows = docs.select(F.lit(False).alias("target"), "id", "text").unionByName(target.select(F.lit(True).alias("target"), "id", "text"))
    fields = [("lot", T.LongType()), ("role", T.IntegerType()), ("id", kind), ("n_words", T.LongType()), ("n_features", T.LongType()), ("bag", T.BinaryType()), ("words", T.ArrayType(T.StringType())), ("grams", T.ArrayType(T.ArrayType(T.IntegerType()))), *((c, T.ArrayType(T.LongType())) for c in ("times", "wanted", "gram_times", "gram_wanted"))]
    schema = T.StructType([T.StructField(*f) for f in fields])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lot, at, first = Lot(least, most), 0, TaskContext.get().partitionId() << 24
        kinds: list[pa.DataType] = []
        held: list[list] = [[] for _ in range(4)]

        def documents() -> pa.RecordBatch:
            ids, n_words, n_features, bags = held
            n = len(ids)
            columns = [pa.array([first + at] * n, pa.int64()), pa.array([1] * n, pa.int32()), pa.array(ids, kinds[0]), pa.array(n_words, pa.int64()), pa.array(n_features, pa.int64()), pa.array(bags, pa.binary())]
            for column in held:
                column.clear()
            return pa.RecordBatch.from_arrays([*columns, pa.nulls(n, pa.list_(pa.string())), pa.nulls(n, pa.list_(pa.list_(pa.int32()))), *(pa.nulls(n, pa.list_(pa.int64())) for _ in range(4))], names=schema.names)

        def lists() -> pa.RecordBatch:
            grams = pa.array([[*lot.grams]], pa.list_(pa.list_(pa.int32())))
            columns = [pa.array([first + at], pa.int64()), pa.array([0], pa.int32()), pa.nulls(1, kinds[0]), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary())]
            times = [*lot.word_times.upto(len(lot.words.lowered)), *lot.gram_times.upto(len(lot.grams))]
            return pa.RecordBatch.from_arrays([*columns, pa.array([[*lot.words.lowered]], pa.list_(pa.string())), grams, *(pa.array([x], pa.list_(pa.int64())) for x in times)], names=schema.names)

        size = 0
        for batch in batches:
            kinds = [batch.column(1).type]
            for of_target, doc_id, text in zip(*batch.columns, strict=True):
                of_target = of_target.as_py()
                n_words, bag = lot.bag(text.as_py(), of_target)
                if not of_target:
                    for column, x in zip(held, (doc_id.as_py(), n_words, len(bag), packed(bag)), strict=True):
                        column.append(x)
                    size += 64 + len(held[3][-1])
                if lot.full():
                    yield documents()
                    yield lists()
                    lot, at, size = Lot(least, most), at + 1, 0
                elif size > SENT_BYTES:
                    yield documents()
                    size = 0
        if lot.documents:
            yield documents()
            yield lists()

    return steps.written(small_batches(rows).mapInArrow(run, schema))


def _with_ids(steps: Steps, lists: DataFrame) -> DataFrame:
    """lot, nth, word_id, times and wanted of every lot's words; ``word`` in one row of each id."""
    words = lists.select("lot", F.posexplode(F.arrays_zip("words", "times", "wanted")).alias("nth", "of")).select("lot", "nth", "of.words", "of.times", "of.wanted")
    schema = "lot long, nth int, word_id long, times long, wanted long, word string"

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, at = None, TaskContext.get().partitionId() << 40
        for batch in batches:
            if not len(batch):
                continue
            lot, nth, word, times, wanted = batch.columns
            new = np.ones(len(word), bool)
            new[0] = last is None or word[0].as_py() != last
            new[1:] = pc.not_equal(word[1:], word[:-1]).to_numpy(zero_copy_only=False)
            ids = at + np.cumsum(new)
            last, at = word[len(word) - 1].as_py(), int(ids[-1])
            yield pa.RecordBatch.from_arrays([lot, nth, pa.array(ids), times, wanted, pc.if_else(pa.array(new), word, pa.scalar(None, word.type))], names=["lot", "nth", "word_id", "times", "wanted", "word"])

    return steps.written(words.repartition("words").sortWithinPartitions("words").mapInArrow(run, schema))


def _gained(spelled: DataFrame, buckets: int) -> Callable[[DataFrame, str], DataFrame]:
    """spelled: times, wanted and feature of every distinct tuple.  A function that gives tuples (with ``bucket``) their gain."""
    counts = spelled.groupBy("bucket").agg(F.sum("times").alias("s"), F.sum("wanted").alias("t"))
    counts = cut(counts)  # as many rows as buckets at most
    whole = counts.agg(F.coalesce(F.sum("s"), F.lit(0)), F.coalesce(F.sum("t"), F.lit(0))).first()
    ratio = ((F.col("t") + 1).cast("double") * float(whole[0] + buckets)) / ((F.col("s") + 1).cast("double") * float(whole[1] + buckets))
    by_bucket = counts.select("bucket", F.floor(F.lit(1000.0) * F.ln(ratio)).alias("gain"))
    return lambda tuples, key: tuples.join(F.broadcast(by_bucket), "bucket").select(key, "gain")


def _bucket(feature: Column, buckets: int) -> Column:
    return (F.crc32(feature.cast("binary")) % buckets).cast("int").alias("bucket")


def _gains(steps: Steps, lots: DataFrame, least: int, most: int, buckets: int) -> DataFrame:
    """lot, and the numbers and gains of its n-grams."""
    lists = lots.filter("role = 0")
    words = _with_ids(steps, lists)
    stride = 2 if least == 1 < most else 1
    spelled, tuples = [], []
    if least == 1:
        # The rows of an id lie together, so that each task sums them before they are sent.
        totals = words.groupBy("word_id").agg(F.sum("times").alias("times"), F.sum("wanted").alias("wanted"), F.max("word").alias("word"))
        spelled.append(steps.written(totals.select("word_id", "times", "wanted", _bucket(F.col("word"), buckets))))
        tuples.append((words.select("lot", (F.col("nth") * stride).alias("number"), "word_id"), "word_id"))
    if most > 1:
        ids = words.groupBy("lot").agg(F.sort_array(F.collect_list(F.struct("nth", "word_id"))).alias("ids"))
        in_ids = F.transform("grams", lambda gram: F.transform(gram, lambda i: F.element_at("ids.word_id", i + 1)))
        grams = lists.select("lot", "grams", "gram_times", "gram_wanted").join(ids, "lot").select("lot", F.posexplode(F.arrays_zip(in_ids.alias("gram"), F.col("gram_times").alias("times"), F.col("gram_wanted").alias("wanted"))).alias("nth", "of"))
        grams = steps.written(grams.select("lot", (F.col("nth") * stride + (stride - 1)).alias("number"), "of.gram", "of.times", "of.wanted"))
        totals = grams.groupBy("gram").agg(F.sum("times").alias("times"), F.sum("wanted").alias("wanted"))
        dictionary = words.filter("word IS NOT NULL").select("word_id", "word")
        parts = totals.select("*", F.posexplode("gram").alias("nth", "word_id")).join(dictionary, "word_id")
        parts = parts.groupBy("gram").agg(F.max("times").alias("times"), F.max("wanted").alias("wanted"), F.sort_array(F.collect_list(F.struct("nth", "word"))).alias("words"))
        spelled.append(steps.written(parts.select("gram", "times", "wanted", _bucket(F.concat_ws(" ", "words.word"), buckets))))
        tuples.append((grams.select("lot", "number", "gram"), "gram"))
    counted = [x.select("bucket", "times", "wanted") for x in spelled]
    gained = _gained(counted[0].unionByName(counted[-1]) if len(counted) > 1 else counted[0], buckets)
    found = [own.join(gained(whole, key), key).select("lot", "number", "gain") for whole, (own, key) in zip(spelled, tuples, strict=True)]
    both = found[0].unionByName(found[1]) if len(found) > 1 else found[0]
    return both.groupBy("lot").agg(F.collect_list(F.struct("number", "gain")).alias("of")).select("lot", "of.number", "of.gain")


def weights(docs: DataFrame, target: DataFrame, least: int = 1, most: int = 2, buckets: int = 10_000, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text") -> DataFrame:
    """id, n_words, n_features and weight of every row of ``docs``: its n-grams' gains, from ``least`` to ``most`` words each."""
    if not 1 <= least <= most:
        raise ValueError("n-grams need 1 <= least <= most")
    kind = docs.schema[id_col].dataType
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    wanted = target.select(F.lit(None).cast(kind).alias("id"), F.col(target_text_col).cast("string").alias("text"))
    steps = Steps(docs.sparkSession, keep=9)
    lots = _lots(steps, own, wanted, least, most, kind)
    columns = ["lot", "role", "id", "n_words", "n_features", "bag"]
    gains = _gains(steps, lots, least, most, buckets).withColumn("role", F.lit(0))
    rows = lots.filter("role = 1").select(*columns).unionByName(gains, allowMissingColumns=True)
    schema = T.StructType([T.StructField(id_col, kind), *(T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight"))])

    @tidy
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A lot's gains come first and are held; its documents follow."""
        held = np.zeros(0, np.int64)
        for batch in batches:
            roles, n_features, bags, numbers, gains = (batch.column(i) for i in (1, 4, 5, 6, 7))
            total, take = [], []
            for i, role in enumerate(roles.to_pylist()):
                if role == 0:
                    places = numbers[i].values.to_numpy()
                    held = np.zeros(places.max(initial=0) + 1, np.int64)
                    held[places] = gains[i].values.to_numpy()
                    continue
                take.append(i)
                total.append(int(held[unpacked(bags[i].as_py(), n_features[i].as_py())].sum()))
            at = pa.array(take, pa.int32())
            yield pa.RecordBatch.from_arrays([*(batch.column(i).take(at) for i in (2, 3, 4)), pa.array(total, pa.int64())], names=schema.names)

    # A lot is bounded, and so is its list of gains.
    weighed = cut(rows.repartition("lot").sortWithinPartitions("lot", "role").mapInArrow(weigh, schema))
    steps.close()
    return weighed


def noise(id_col: Column, seed: int) -> Column:
    """floor(-1000 ln(-ln u)) for u by the first 8 hex digits of the hash of seed and id."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256), 1, 8)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln(u)))


def resample(weighed: DataFrame, percent: int = 10, least_words: int = 20, seed: int = 2024, id_col: str = "doc_id") -> DataFrame:
    """``weighed`` with score and rank: of the rows with enough words, ``percent`` in a hundred have a rank, from 1; others null."""
    scored = cut(weighed.withColumn("score", F.col("weight") + noise(F.col(id_col), seed)))
    able = F.coalesce(F.col("n_words") >= least_words, F.lit(False))
    drawn = scored.filter(able).count() * percent // 100
    # Equal rows are told apart by their place, so that a range needn't hold all of them.
    placed = scored.withColumn("_able", able).withColumn("_place", F.monotonically_increasing_id())
    ordered = numbered(placed, [F.desc("_able"), F.desc("score"), F.asc_nulls_last(id_col), F.asc("_place")], "_nth")
    return ordered.withColumn("rank", F.when(F.col("_able") & (F.col("_nth") <= drawn), F.col("_nth"))).drop("_able", "_place", "_nth")


def select(docs: DataFrame, weighed: DataFrame, percent: int = 10, least_words: int = 20, seed: int = 2024, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose ids are drawn."""
    ids = resample(weighed, percent, least_words, seed, id_col).filter("rank IS NOT NULL").select(F.col(id_col).alias("_drawn")).distinct()
    return docs.join(ids, F.col(id_col).eqNullSafe(F.col("_drawn")), "left_semi")
