"""Exact top-k search by BM25 over sharded inverted indexes with block-max WAND.

The index holds every word of every document and is built once for all queries.  A shard is a
bounded stretch of the documents of one task, numbered by ascending id.  A term's postings are
numbers and term frequencies, in blocks, each with the largest frequency and the smallest
length in it, which bound every score in the block; a posting is decoded and scored only when
its block is reached.  Statistics (documents, words, documents with each term) are summed
over all shards, so that shards score alike; each shard is then searched by itself with
dynamic pruning, and the shards' best are merged: the result is that of scoring every
document.

Words are runs of ASCII letters and digits and of all other characters beyond ASCII, A-Z
lower-cased.  Scores are rounded to six decimals; ties go to the smaller id.  Null and empty
texts have no words, and very long ones are indexed whole; documents count towards the
statistics whether they have words or not; of rows with one id each counts towards the
statistics, and the id is found once, by its best row; rows without an id count towards
nothing and are not found.  Queries that are null or without a known word find nothing.  Only
documents with a positive score are returned; empty tables give no rows; columns other than
those named are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .durable import cut, small_batches, tidy

K1, B = 1.2, 0.75
BLOCK = 64
#: Documents and postings of a shard, beyond those of its last document; terms of a row of the index.
SHARD_DOCS, SHARD_POSTINGS, ROW_TERMS = 20_000, 2_000_000, 1024
#: Queries that are searched together.
QUERY_BLOCK = 2048
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: A row without terms opens a shard: its documents' ids (numbers), their lengths (tfs), its words.
INDEX = "terms binary, counts binary, numbers binary, tfs binary, block_tfs binary, block_lens binary, words long"
_NAMES = [f.split()[0] for f in INDEX.split(", ")]


def words(text: str | None) -> list[bytes]:
    return _WORD.findall((text or "").encode().lower())


class Shard:
    """Documents on their way into the index."""

    def __init__(self, most_docs: int = SHARD_DOCS):
        self.most_docs = most_docs
        self.terms: dict[bytes, int] = {}
        self.docs: list[tuple[int, int, np.ndarray, np.ndarray]] = []  # id, length, terms, frequencies
        self.postings = 0

    def add(self, doc: int, text: str | None) -> None:
        found, terms = words(text), self.terms
        ids = np.fromiter((terms.setdefault(w, len(terms)) for w in found), np.int32, len(found))
        of, tf = np.unique(ids, return_counts=True)
        self.docs.append((doc, len(found), of, tf))
        self.postings += len(of)

    @property
    def full(self) -> bool:
        return len(self.docs) >= self.most_docs or self.postings >= SHARD_POSTINGS

    def rows(self) -> Iterator[pa.RecordBatch]:
        """The opening row, then rows of terms in order of bytes."""
        self.docs.sort(key=lambda d: d[0])
        ids, lengths = np.array([d[0] for d in self.docs], np.int64), np.array([d[1] for d in self.docs], np.uint32)
        yield _row(None, None, ids, lengths, None, None, int(lengths.sum(dtype=np.int64)))
        names = sorted(self.terms)
        place = np.empty(len(names), np.int32)
        place[[self.terms[t] for t in names]] = np.arange(len(names), dtype=np.int32)
        of = place[np.concatenate([d[2] for d in self.docs])]
        order = np.argsort(of, kind="stable")
        number = np.repeat(np.arange(len(self.docs), dtype=np.uint16), [len(d[2]) for d in self.docs])[order]
        tf = np.concatenate([d[3] for d in self.docs])[order].astype(np.uint32)
        counts = np.bincount(of, minlength=len(names)).astype(np.uint32)
        starts = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        for at in range(0, len(names), ROW_TERMS):
            own = counts[at : at + ROW_TERMS]
            a, b = starts[at], starts[at + len(own)]
            blocks = _block_starts(own)
            freq, length = tf[a:b], lengths[number[a:b]]
            tfs = freq.astype(np.uint16) if freq.max() < 1 << 16 else freq
            yield _row(b" ".join(names[at : at + ROW_TERMS]), own, number[a:b], tfs, np.maximum.reduceat(freq, blocks), np.minimum.reduceat(length, blocks), None)


def _block_starts(counts: np.ndarray) -> np.ndarray:
    """Where the blocks of terms with these counts begin."""
    blocks = -(-counts.astype(np.int64) // BLOCK)
    first = np.repeat(np.cumsum(blocks) - blocks, blocks)
    begin = np.repeat(np.cumsum(counts, dtype=np.int64) - counts, blocks)
    return begin + (np.arange(blocks.sum()) - first) * BLOCK


def _row(terms: bytes | None, counts, numbers, tfs, block_tfs, block_lens, total: int | None) -> pa.RecordBatch:
    held = [terms, *(None if x is None else x.tobytes() for x in (counts, numbers, tfs, block_tfs, block_lens))]
    return pa.RecordBatch.from_arrays([*(pa.array([x], pa.binary()) for x in held), pa.array([total], pa.int64())], names=_NAMES)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_docs: int = SHARD_DOCS) -> DataFrame:
    """The index of all documents: the rows of one shard follow each other in one partition."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).filter("id IS NOT NULL")

    @tidy
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard(shard_docs)
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                shard.add(doc, text.as_py())
                if shard.full:
                    yield from shard.rows()
                    shard = Shard(shard_docs)
        if shard.docs:
            yield from shard.rows()

    return small_batches(rows).mapInArrow(build, INDEX)


def postings(row: tuple, wanted: set[bytes]) -> Iterator[tuple[bytes, tuple[np.ndarray, ...]]]:
    """Of a row of terms: (term, (numbers, tfs, block_tfs, block_lens)) of those wanted; the rest isn't looked at."""
    terms, counts, numbers, tfs, block_tfs, block_lens = row
    names = terms.split(b" ")
    found = [i for i, t in enumerate(names) if t in wanted]
    if not found:
        return
    n = np.frombuffer(counts, np.uint32).astype(np.int64)
    ends, block_ends = np.cumsum(n), np.cumsum(-(-n // BLOCK))
    numbers = np.frombuffer(numbers, np.uint16)
    tfs = np.frombuffer(tfs, np.uint16 if len(tfs) == 2 * len(numbers) else np.uint32)
    block_tfs, block_lens = np.frombuffer(block_tfs, np.uint32), np.frombuffer(block_lens, np.uint32)
    for i in found:
        own, blocks = slice(ends[i] - n[i], ends[i]), slice(block_ends[i] - -(-n[i] // BLOCK), block_ends[i])
        yield names[i], (numbers[own], tfs[own], block_tfs[blocks], block_lens[blocks])


class Cursor:
    """A term's postings in a shard; a block is decoded when it's reached and scored when a posting of it is."""

    def __init__(self, weight: float, held: tuple[np.ndarray, ...], lengths: np.ndarray, average: float):
        self.numbers, self.tfs, block_tfs, block_lens = held
        self.weight, self.lengths, self.average = weight, lengths, average
        self.ends = self.numbers[np.minimum(np.arange(BLOCK - 1, len(self.numbers) + BLOCK - 1, BLOCK), len(self.numbers) - 1)].tolist()
        self.bounds = impact(weight, block_tfs, block_lens, average).tolist()
        self.most = max(self.bounds)
        self.block, self.decoded, self.valued, self.scored = 0, -1, -1, 0
        self.seen = 0  # the block of the last bound asked for
        self.move(0)

    def move(self, doc: int) -> None:
        """To the first posting at or after ``doc``."""
        self.block = bisect_left(self.ends, doc, self.block)
        if self.block == len(self.ends):
            self.doc = math.inf
            return
        if self.decoded != self.block:
            self.docs, self.decoded = self.numbers[self.block * BLOCK : (self.block + 1) * BLOCK].tolist(), self.block
        self.at = bisect_left(self.docs, doc)
        self.doc = self.docs[self.at]

    def value(self) -> float:
        """The score of the posting under the cursor."""
        if self.valued != self.block:
            own = slice(self.block * BLOCK, (self.block + 1) * BLOCK)
            self.values, self.valued = impact(self.weight, self.tfs[own], self.lengths[self.numbers[own]], self.average).tolist(), self.block
            self.scored += len(self.values)
        return self.values[self.at]

    def reach(self, doc: int) -> tuple[float, float]:
        """The bound and the last number of the block that would hold ``doc``; no posting is read."""
        self.seen = bisect_left(self.ends, doc, max(self.seen, self.block))
        return (self.bounds[self.seen], self.ends[self.seen]) if self.seen < len(self.ends) else (0.0, math.inf)


def impact(weight: float, tf: np.ndarray, length: np.ndarray, average: float) -> np.ndarray:
    return weight * (tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / average)))


def idf(documents: int, holding: int) -> float:
    return math.log(1 + (documents - holding + 0.5) / (holding + 0.5))


class Best:
    """The k best ids, by score and then smaller id; an id that comes again keeps its best score."""

    def __init__(self, k: int):
        self.k, self.heap, self.held = k, [], {}  # worst first: (score, -id)

    @property
    def least(self) -> float:
        """What a score must exceed, or equal with a smaller id."""
        return self.heap[0][0] if len(self.heap) == self.k else 0.0

    def offer(self, score: float, doc: int) -> None:
        before = self.held.get(doc)
        if score <= 0 or (before is not None and before >= score):
            return
        if before is not None:
            self.heap.remove((before, -doc))
            heapq.heapify(self.heap)
        elif len(self.heap) == self.k:
            if (score, -doc) <= self.heap[0]:
                return
            del self.held[-heapq.heappop(self.heap)[1]]
        heapq.heappush(self.heap, (score, -doc))
        self.held[doc] = score


def wand(cursors: list[Cursor], ids: np.ndarray, k: int) -> list[tuple[float, int]]:
    """The k best (score, id) of a shard, by score and then smaller id; ids by number, ascending."""
    order, best = [*cursors], Best(k)
    beats = lambda bound: len(best.heap) < k or round(bound + 1e-9, 6) > best.least
    while True:
        order.sort(key=lambda c: c.doc)
        bound, pivot = 0.0, -1
        for i, c in enumerate(order):
            if c.doc == math.inf:
                break
            bound += c.most
            if beats(bound):
                pivot = i
                break
        if pivot < 0:
            break
        doc = order[pivot].doc
        while pivot + 1 < len(order) and order[pivot + 1].doc == doc:
            pivot += 1
        bound, end = 0.0, math.inf
        for c in order[: pivot + 1]:
            b, e = c.reach(doc)
            bound += b
            end = min(end, e)
        if beats(bound):
            if order[0].doc == doc:
                best.offer(round(sum(c.value() for c in cursors if c.doc == doc), 6), int(ids[doc]))
                for c in order[: pivot + 1]:
                    c.move(doc + 1)
            else:
                max((c for c in order[:pivot] if c.doc < doc), key=lambda c: c.most).move(doc)
        else:
            to = end + 1
            if pivot + 1 < len(order):
                to = min(to, order[pivot + 1].doc)
            if to == math.inf:
                break
            for c in order[: pivot + 1]:
                if c.doc < to:
                    c.move(to)
    return sorted(((s, -d) for s, d in best.heap), key=lambda x: (-x[0], x[1]))


def search(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", query_id_col: str = "item_id", query_text_col: str = "text") -> DataFrame:
    """query_id, rank, doc_id, score: the k best documents of each query."""
    return search_index(cut(build_index(docs, id_col, text_col)), queries, k, query_id_col, query_text_col)


def search_index(index: DataFrame, queries: DataFrame, k: int = 10, query_id_col: str = "item_id", query_text_col: str = "text") -> DataFrame:
    """The same over a kept index (of ``build_index``); queries are taken in blocks of bounded size, each of which reads it once."""
    asked = queries.select(F.col(query_id_col).cast("long").alias("query_id"), F.col(query_text_col).cast("string").alias("text")).filter("query_id IS NOT NULL AND text IS NOT NULL")
    blocks = -(-asked.count() // QUERY_BLOCK)
    totals = index.filter("terms IS NULL").agg(F.sum(F.octet_length("numbers") / 8).cast("long"), F.sum("words")).first()
    found = None
    for i in range(blocks):
        block = asked.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == i).collect()
        part = _search_block(index, [(r["query_id"], Counter(words(r["text"]))) for r in block], k, totals[0] or 0, totals[1] or 0)
        found = part if found is None else found.union(part)
    return found if found is not None else index.sparkSession.createDataFrame([], "query_id long, rank int, doc_id long, score double")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Each row's first six columns, of one batch at a time."""
    for batch in batches:
        yield from zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True)


def _search_block(index: DataFrame, queries: list[tuple[int, Counter]], k: int, documents: int, total: int) -> DataFrame:
    average = total / documents if total else 1.0
    sc = index.sparkSession.sparkContext
    asked_terms = sc.broadcast({t for _, q in queries for t in q})

    @tidy
    def holding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for row in _rows(batches):
            if row[0] is not None:
                counts.update({t: len(held[0]) for t, held in postings(row, asked_terms.value)})
        yield pa.RecordBatch.from_arrays([pa.array([*counts], pa.binary()), pa.array([*counts.values()], pa.int64())], names=["term", "n"])

    of_terms = index.mapInArrow(holding, "term binary, n long").groupBy("term").agg(F.sum("n").alias("n"))
    weights = {bytes(r["term"]): idf(documents, r["n"]) for r in of_terms.collect()}  # of the block's queries only
    shared = sc.broadcast((queries, weights, average))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weight, avg = shared.value
        ids, lengths, held = None, None, {}

        def searched() -> pa.RecordBatch:
            out = []
            for query, terms in asked:
                cursors = [Cursor(weight[t] * terms[t], held[t], lengths, avg) for t in sorted(terms) if t in held]
                out += [(query, doc, score) for score, doc in wand(cursors, ids, k)] if cursors else []
            q, d, s = zip(*out, strict=True) if out else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(d, pa.int64()), pa.array(s, pa.float64())], names=["query_id", "doc_id", "score"])

        for row in _rows(batches):
            if row[0] is None:
                if held:
                    yield searched()
                ids, lengths, held = np.frombuffer(row[2], np.int64), np.frombuffer(row[3], np.uint32), {}
            else:
                held.update(postings(row, weight.keys()))
        if held:
            yield searched()

    best = index.mapInArrow(run, "query_id long, doc_id long, score double")
    best = best.groupBy("query_id", "doc_id").agg(F.max("score").alias("score"))
    merged = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    return best.withColumn("rank", F.row_number().over(merged)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
