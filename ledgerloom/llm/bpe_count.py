"""Token counts by heap-and-linked-list byte-pair merging; no identifiers are emitted.

Every piece of a text starts as one symbol a byte, linked to its neighbours.  A heap
holds the adjacent pairs that can merge, lowest rank first and then leftmost; popping
one merges it and pushes the pairs that the merged symbol forms.  The count of a piece
is its bytes less its merges.

Null and empty texts count 0 tokens and 0 bytes; repeated rows each give a row; columns
other than the id and the text are ignored, whatever their names; empty tables give no rows.
Very long texts are counted whole, in segments cut at spaces; a word without a space is one
segment, of some 60 bytes of memory for each of its own.
"""

from __future__ import annotations

import heapq
from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from .bytelevel import PIECES, Remembered, Vocabulary, chunked, load_vocabulary, special_pattern
from .durable import small_batches, tidy


#: Bytes, roughly, of each generation of a task's memory of words; their counts are small.
WORD_BYTES = 64 << 20
#: Bytes of a word from which its places are packed.
_LONG = 1 << 12


def _packed(numbers: Iterable[int]) -> array:
    return array("i", numbers)


class Merges:
    """Merges by rank, and for each left id the ranks by right id; ids of bytes."""

    def __init__(self, vocabulary: Vocabulary):
        self.merges = vocabulary.merges
        nothing: dict[int, int] = {}
        self.ranks = [nothing] * (1 + max((max(merge) for merge in vocabulary.merges), default=0))
        self.ranks += [nothing] * (1 + max(vocabulary.byte_ids, default=0) - len(self.ranks))
        for rank, (a, b, _) in reversed([*enumerate(vocabulary.merges)]):
            if self.ranks[a] is nothing:
                self.ranks[a] = {}
            self.ranks[a][b] = rank
        self.byte_ids, self.special = vocabulary.byte_ids, vocabulary.special


class PairCounter:
    """Counts the tokens of whole texts; ``merges`` may be shared by counters, each with memories of its own."""

    def __init__(self, merges: Merges):
        self.merges, self.ranks, self.byte_ids, self.special = merges.merges, merges.ranks, merges.byte_ids, special_pattern(merges.special)
        self.pieces = Remembered(self.merged)
        self.chunks = Remembered(lambda chunk: self.chunk(" " + chunk), WORD_BYTES)

    def merged(self, piece: str) -> int:
        """Bytes of the piece less the merges made in it."""
        data = piece.encode()
        n = len(data)
        if n == 1:
            return 1
        # Places of a very long word lie in arrays, of an eighth of the memory; lists are faster.
        hold = list if n < _LONG else _packed
        ranks, symbols = self.ranks, hold(map(self.byte_ids.__getitem__, data))
        # A heap entry is one number, rank * n + place of the left symbol: lowest rank first, then leftmost.
        heap = [r * n + i for i in range(n - 1) if (r := ranks[symbols[i]].get(symbols[i + 1])) is not None]
        if not heap:
            return n
        heapq.heapify(heap)
        before, after, left = hold(range(-1, n - 1)), hold(range(1, n + 1)), n
        while heap:
            rank, i = divmod(heapq.heappop(heap), n)
            a, b, both = self.merges[rank]
            j = after[i]
            if symbols[i] != a or j >= n or symbols[j] != b:
                continue  # the pair there is no longer this one
            symbols[i], symbols[j] = both, -1
            k = after[i] = after[j]
            left -= 1
            if k < n:
                before[k] = i
                if (r := ranks[both].get(symbols[k])) is not None:
                    heapq.heappush(heap, r * n + i)
            if (h := before[i]) >= 0 and (r := ranks[symbols[h]].get(both)) is not None:
                heapq.heappush(heap, r * n + h)
        return left

    def chunk(self, chunk: str) -> int:
        return sum(map(self.pieces.__getitem__, PIECES.findall(chunk)))

    def count(self, text: str | None) -> int:
        n = 0
        for special, first, rest in chunked(text or "", self.special):
            n += 1 if special else self.chunk(first) + sum(map(self.chunks.__getitem__, rest))
        return n


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_tokens and over_limit of every row of ``docs``: one scan, no shuffle."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Merges(load_vocabulary(tokenizer_path)))
    rows = small_batches(docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text")))
    schema = T.StructType([T.StructField(id_col, rows.schema[0].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PairCounter(shared.value)
        for batch in batches:
            texts = batch.column(1)
            n_tokens = [counter.count(t.as_py()) for t in texts]
            n_bytes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), n_bytes, pa.array(n_tokens, pa.int64())], names=schema.names)

    return rows.mapInArrow(count, schema).withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
