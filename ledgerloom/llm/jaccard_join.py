"""Near-duplicate classes by an n-gram Jaccard join with adaptive multi-match prefixes.

A document is the set of its distinct word n-grams, as 64-bit hashes.  Two documents are
linked when 100 * intersection >= 75 * union; the result is exact.

* A sketch of fixed size counts, over all documents, how often n-grams occur.  It orders
  n-grams from rare to common (then by hash), alike for all documents.
* Of a set of n, the first n - ceil(t * n) + m n-grams are its m-match prefix: two linked
  sets share m n-grams of their m-match prefixes.  Each document takes the m that makes
  the estimated cost least: prefix n-grams cost what the sketch says they bring up, over
  m, as a candidate must be brought up m times.  A pair must share as many prefix n-grams
  as the smaller m of both.
* Copies (equal sets) are one node.  Prefix n-grams of one node only are dropped.
* A prefix n-gram counts for a pair only if what both sets have left from it on can still
  make up the overlap that their sizes ask for.
* Each node is first compared with the node that shares most around its n-grams; what links
  forms stars, and stars components.  Only pairs of components that still share enough
  prefix n-grams are compared, member by member, in blocks of bounded size, so that neither
  a large group of near copies nor a common n-gram makes pairs of its members.

Texts without words have an empty set, linked with nothing.  Rows without an id link with
nothing and have no component.  Repeated rows are copies; ties don't matter, as links alone
decide; columns other than the id and the text are ignored, whatever their names; empty
tables give no rows.  Very long texts are taken whole: a task holds the n-grams of a block
of documents.  A 64-bit hash stands for a word and for an n-gram, and 128 bits for a set.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .durable import cut, small_batches, tidy
from .graph import components
from .mixing import fresh

#: Cells of the sketch and of the pieces in which it's summed.
CELLS, PIECE = 1 << 20, 1 << 14
#: Documents of either side that are compared in one block.
BLOCK = 256
#: Prefix rows of a bucket, on average, and the count from which an n-gram's rows bypass buckets.
BUCKET_ROWS, HEAVY = 400_000, 20_000
MOST_MATCHES = 6
#: Cost of comparing two sets, in prefix rows read.
COMPARE = 4.0

#: A node in packed rows.
NODE = np.dtype([("high", "<u8"), ("low", "<u8")])
#: N-grams that a task holds at once, beyond those of one document.
HELD = 400_000

_U = np.uint64
_MULTIPLIER = _U(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(29))) * _U(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> _U(32))


def word_hash(word: bytes) -> int:
    return int.from_bytes(blake2b(word, digest_size=8).digest(), "little")


#: Bytes of a word up to which its hash is the sum of a random number for each place and byte; A-Z have those of a-z.
_SHORT = 64
_NUMBER = np.random.default_rng(5).integers(1, 1 << 64, (_SHORT, 256), dtype=np.uint64)
_NUMBER[:, ord("A") : ord("Z") + 1] = _NUMBER[:, ord("a") : ord("z") + 1]
_BLANK = np.isin(np.arange(256), [*range(9, 14), 32])
#: Bytes that are hashed at a time, and a bit more, up to the end of a word.
_STRETCH = 1 << 20


class NGrams:
    """The hashed n-grams of texts."""

    def __init__(self, words: int = 5):
        self.words = words

    def word_hashes(self, text: str) -> np.ndarray:
        """Of each run of characters other than blanks, A-Z lower-cased; bytes split and lower-case by just these."""
        data = np.frombuffer(text.encode(), np.uint8)
        if len(data) <= _STRETCH:
            return self._hashes(data)
        out, at = [], 0
        while at < len(data):
            end = at + _STRETCH
            while end < len(data) and not (blank := _BLANK[data[end : end + _STRETCH]]).any():
                end += _STRETCH
            end = end + int(blank.argmax()) if end < len(data) else len(data)
            out.append(self._hashes(data[at:end]))
            at = end
        return np.concatenate(out)

    def _hashes(self, data: np.ndarray) -> np.ndarray:
        inside = np.flatnonzero(~_BLANK[data])
        if not len(inside):
            return np.zeros(0, np.uint64)
        first = np.flatnonzero(np.diff(inside, prepend=-2) > 1)  # of each word, among the bytes inside words
        length = np.diff(first, append=len(inside))
        place = np.minimum(np.arange(len(inside)) - np.repeat(first, length), _SHORT - 1)
        out = np.add.reduceat(_NUMBER[place, data[inside]], first)
        for i in np.flatnonzero(length > _SHORT).tolist():
            at = inside[first[i]]
            out[i] = word_hash(data[at : at + length[i]].tobytes().lower())
        return out

    def __call__(self, text: str | None) -> np.ndarray:
        """The sorted distinct n-grams; of fewer words the whole sequence as one."""
        w = self.word_hashes(text) if text else np.zeros(0, np.uint64)
        if not len(w):
            return w
        n = len(w) - self.words + 1
        total = np.full(max(n, 1), 0 if n >= 1 else len(w), np.uint64)
        w = _mixed(w)
        for i in range(min(self.words, len(w))):
            total = total * _MULTIPLIER + (w[i : i + n] if n >= 1 else w[i : i + 1])
        return np.unique(_mixed(total))


def set_hash(grams: np.ndarray) -> bytes:
    """A 128-bit hash of a sorted set of n-grams."""
    return blake2b(grams.tobytes(), digest_size=16).digest()


def _binary(nodes: np.ndarray) -> pa.Array:
    """Rows of 16 bytes as an Arrow column."""
    return pa.Array.from_buffers(pa.binary(), len(nodes), [None, pa.py_buffer(np.arange(0, 16 * len(nodes) + 1, 16, dtype=np.int32)), pa.py_buffer(np.ascontiguousarray(nodes))])


def _cell(grams: np.ndarray) -> np.ndarray:
    return (grams >> _U(44)).astype(np.int64)


@dataclass
class Rule:
    words: int = 5
    per_cent: int = 75

    def prefix(self, n: int, matches: int) -> int:
        return min(n, n - -(-self.per_cent * n // 100) + matches)

    def linked(self, shared: int, a: int, b: int) -> bool:
        return 100 * shared >= self.per_cent * (a + b - shared)


def choose_prefix(grams: np.ndarray, counts: np.ndarray, noise: float, rule: Rule) -> tuple[np.ndarray, int]:
    """The prefix and the matches that it asks for, at the least estimated cost."""
    n = len(grams)
    seen = counts[_cell(grams)]
    key = (np.minimum(seen, (1 << 19) - 1).astype(np.uint64) << _U(44)) | (grams >> _U(20))
    order = np.argsort(key, kind="stable")[: rule.prefix(n, MOST_MATCHES)]
    brings = np.cumsum(np.maximum(seen[order] - noise, 0.0))
    best, least = 1, np.inf
    for m in range(1, MOST_MATCHES + 1):
        size = rule.prefix(n, m)
        cost = size + brings[size - 1] * (1 + COMPARE / m)
        if cost < least:
            best, least = m, cost
        if size == n:
            break
    return grams[order[: rule.prefix(n, best)]], best


def first_scan(docs: DataFrame, id_col: str, rule: Rule) -> DataFrame:
    """Of rows (id, text, mark): id, mark, node (hash of the set; null without n-grams) and n_shingles; and each task's sketch, in pieces."""
    schema = T.StructType([T.StructField(id_col, docs.schema[0].dataType), T.StructField("mark", T.LongType()), T.StructField("node", T.BinaryType()), T.StructField("n_shingles", T.LongType()), T.StructField("piece", T.IntegerType()), T.StructField("places", T.BinaryType()), T.StructField("counts", T.BinaryType())])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, kind, grams = np.zeros(CELLS, np.int64), None, NGrams(rule.words)
        for batch in batches:
            kind, nodes, sizes = batch.column(0).type, [], []
            for text in batch.column(1):
                found = grams(text.as_py())
                np.add.at(cells, _cell(found), 1)
                nodes.append(set_hash(found) if len(found) else None)
                sizes.append(len(found))
            n = len(nodes)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())], names=schema.names)
        for piece in range(0, CELLS, PIECE):
            part = cells[piece : piece + PIECE]
            at = np.flatnonzero(part)
            if len(at):
                dense = len(at) > PIECE // 2
                width = np.uint16 if part.max() < 1 << 16 else np.int64
                places, counts = (b"", part) if dense else (at.astype(np.uint16).tobytes(), part[at])
                yield pa.RecordBatch.from_arrays([pa.nulls(1, kind), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64()), pa.array([piece // PIECE], pa.int32()), pa.array([places], pa.binary()), pa.array([counts.astype(width).tobytes()], pa.binary())], names=schema.names)

    return docs.mapInArrow(run, schema)


def sketch(scanned: DataFrame) -> np.ndarray:
    """How many of all documents' n-grams fall into each cell; of fixed size."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, places, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = np.frombuffer(places, np.uint16) if places else slice(None)
                size = len(places) // 2 or PIECE
                sums.setdefault(piece, np.zeros(PIECE, np.int64))[at] += np.frombuffer(counts, np.int64 if len(counts) == 8 * size else np.uint16).astype(np.int64)
        for piece, own in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([np.minimum(own, (1 << 31) - 1).astype(np.int32).tobytes()], pa.binary())], names=["piece", "n"])

    parts = scanned.filter("piece IS NOT NULL").select("piece", "places", "counts").repartition("piece").mapInArrow(add, "piece int, n binary").collect()
    cells = np.zeros(CELLS, np.int32)
    for r in parts:
        cells[r["piece"] * PIECE : (r["piece"] + 1) * PIECE] = np.frombuffer(r["n"], np.int32)
    return cells


def shared_prefixes(docs: DataFrame, cells: np.ndarray, rule: Rule) -> DataFrame:
    """gram, node, need (matches asked for), n (set size) and rest of prefix n-grams of several nodes.

    rest: how many of the set's n-grams there are from this one on, in the common order.

    The rows of a task go to buckets of n-grams as packed arrays; n-grams that the sketch
    finds in very many documents don't meet in a bucket but pass as they are.
    """
    total = int(cells.sum(dtype=np.int64))
    buckets = max(1, total // 4 // BUCKET_ROWS)
    noise = float(np.median(cells))
    shared = docs.sparkSession.sparkContext.broadcast(cells)

    def packed(grams: list[np.ndarray], nodes: list[bytes], needs: list[int], sizes: list[int], heavy_bucket: int) -> Iterator[pa.RecordBatch]:
        all_grams = np.concatenate(grams)
        owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.minimum(np.arange(len(g)), 65535) for g in grams]).astype(np.uint16)
        bucket = (all_grams % _U(buckets)).astype(np.int64)
        bucket[shared.value[_cell(all_grams)] > HEAVY] = heavy_bucket
        order = np.argsort(bucket, kind="stable")
        bounds = np.flatnonzero(np.diff(bucket[order], prepend=np.int64(-(1 << 40)), append=np.int64(1 << 40)))
        node, need, size = np.frombuffer(b"".join(nodes), NODE), np.array(needs, np.uint8), np.array(sizes, np.uint32)
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            rows = order[a:b]
            who, length = np.unique(owner[rows], return_counts=True)
            columns = [all_grams[rows], place[rows], node[who], need[who], size[who], length.astype(np.uint32)]
            yield pa.RecordBatch.from_arrays([pa.array([bucket[rows[0]]], pa.int64()), *(pa.array([c.tobytes()], pa.binary()) for c in columns)], names=names)

    names = ["bucket", "grams", "places", "nodes", "needs", "sizes", "lengths"]

    @tidy
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ngrams = NGrams(rule.words)
        grams, nodes, needs, sizes, held, done = [], [], [], [], 0, set()
        for batch in batches:
            for text in batch.column(1):
                found = ngrams(text.as_py())
                if not len(found):
                    continue
                node = set_hash(found)
                if node in done:
                    continue
                done.add(node)
                prefix, need = choose_prefix(found, shared.value, noise, rule)
                grams.append(prefix)
                nodes.append(node)
                needs.append(need)
                sizes.append(len(found))
                held += len(prefix)
                if held > HELD:
                    yield from packed(grams, nodes, needs, sizes, -1 - node[0])
                    grams, nodes, needs, sizes, held, done = [], [], [], [], 0, set()
        if grams:
            yield from packed(grams, nodes, needs, sizes, -1 - nodes[0][0])

    def unpacked(row: tuple) -> tuple[np.ndarray, ...]:
        grams, places, nodes, needs, sizes, lengths = (np.frombuffer(x, t) for x, t in zip(row, (np.uint64, np.uint16, NODE, np.uint8, np.uint32, np.uint32), strict=True))
        return grams, places, *(np.repeat(x, lengths) for x in (nodes, needs, sizes))

    def rows_of(parts: list[tuple], single: bool) -> Iterator[pa.RecordBatch]:
        grams, places, nodes, needs, sizes = (np.concatenate(c) for c in zip(*map(unpacked, parts), strict=True))
        order = np.lexsort((nodes["low"], nodes["high"], grams))
        g, v = grams[order], nodes[order]
        first = np.ones(len(g), bool)
        first[1:] = (g[1:] != g[:-1]) | (v[1:] != v[:-1])
        order, g = order[first], g[first]
        if single:
            new = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
            many = np.repeat(np.diff(np.append(new, len(g))) > 1, np.diff(np.append(new, len(g))))
            order, g = order[many], g[many]
        for at in range(0, len(g), 100_000):
            part = order[at : at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(g[at : at + 100_000].view(np.int64)), _binary(nodes[part]), pa.array(needs[part].astype(np.int32)), pa.array(sizes[part].astype(np.int64)), pa.array(sizes[part].astype(np.int64) - places[part])], names=["gram", "node", "need", "n", "rest"])

    @tidy
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, parts = None, []
        for batch in batches:
            for now, *row in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
                if now < 0:
                    yield from rows_of([tuple(row)], single=False)
                    continue
                if now != bucket and parts:
                    yield from rows_of(parts, single=True)
                    parts = []
                bucket = now
                parts.append(tuple(row))
        if parts:
            yield from rows_of(parts, single=True)

    blobs = docs.mapInArrow(scan, "bucket long, grams binary, places binary, nodes binary, needs binary, sizes binary, lengths binary")
    return blobs.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(meet, "gram long, node binary, need int, n long, rest long")


def packed_texts(docs: DataFrame, id_col: str) -> DataFrame:
    schema = T.StructType([T.StructField(id_col, docs.schema[0].dataType), T.StructField("packed", T.BinaryType())])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([press.compress((t.as_py() or "").encode()) for t in batch.column(1)], pa.binary())], names=schema.names)

    return docs.mapInArrow(run, schema)


def pressed(rows: DataFrame, text_col: str, back: bool = False) -> DataFrame:
    """``rows`` with their texts compressed, or ``back`` as they were; for texts that move, as the engine's own files hold them in half again the room."""
    rows, at = small_batches(rows), rows.columns.index(text_col)
    schema = T.StructType([*rows.schema.fields])
    schema.fields[at] = T.StructField(text_col, T.StringType() if back else T.BinaryType())

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press, unpress = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        for batch in batches:
            texts = (t.as_py() for t in batch.column(at))
            made = [None if t is None else unpress.decompress(t).decode() if back else press.compress(t.encode()) for t in texts]
            columns = batch.columns
            columns[at] = pa.array(made, pa.string() if back else pa.binary())
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)


def verify(blocks: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """Links (a, b) between the askers (role 0) and the others (role 1) of each block.

    blocks: target, part, asking, role, node; at most about BLOCK askers share one (target,
    part, asking); texts: node, packed.
    """
    rows = blocks.join(texts, "node").select("target", "part", "asking", "role", "node", "packed")

    @tidy
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press, ngrams = zstandard.ZstdDecompressor(), NGrams(rule.words)
        key, askers = None, {}
        for batch in batches:
            a, b = [], []
            for *now, role, node, packed in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if now != key:
                    key, askers = now, {}
                if role == 1 and not askers or role == 0 and node in askers:
                    continue
                grams = ngrams(press.decompress(packed).decode())
                if set_hash(grams) != node:
                    continue  # another text under the same id
                if role == 0:
                    askers[node] = grams
                    continue
                for asker, own in askers.items():
                    small, large = sorted((len(own), len(grams)))
                    if asker == node or 100 * small < rule.per_cent * large:
                        continue
                    less, more = (own, grams) if len(own) <= len(grams) else (grams, own)
                    at = np.searchsorted(more, less)
                    at[at == len(more)] = 0
                    if rule.linked(int((more[at] == less).sum()), small, large):
                        a.append(min(asker, node))
                        b.append(max(asker, node))
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    keys = ["target", "part", "asking"]
    return rows.repartition(*keys).sortWithinPartitions(*keys, "role").mapInArrow(compare, "a binary, b binary")


def _parts(count, block: int = BLOCK):
    return F.greatest(F.lit(1), F.ceil(count / block)).cast("int")


def _part_of(node: str, parts: str):
    return F.pmod(F.xxhash64(F.col(node)), F.col(parts)).cast("int")


def _possible(rule: Rule, need, one: str, other: str):
    """Whether sets of such sizes, sharing no more than need - 1 n-grams before this one, can link.

    The overlap that a link takes is above what both have left, and one is long enough for the other.
    """
    a, b = (lambda x: F.col(f"{one}.{x}")), (lambda x: F.col(f"{other}.{x}"))
    enough = (F.lit(100 + rule.per_cent) * (need - 1 + F.least(a("rest"), b("rest")))) >= F.lit(rule.per_cent) * (a("least") + b("least"))
    return enough & (a("most") * 100 >= b("least") * rule.per_cent) & (b("most") * 100 >= a("least") * rule.per_cent)


def star_pairs(shared: DataFrame, rule: Rule) -> DataFrame:
    """node, centre: for each node the centre that it meets most often.

    The centre of an n-gram is the node, among those with it, that has most shared prefix
    n-grams for its size: an unedited original rather than its edited copies.
    """
    shared = shared.repartition("node")  # once for the ranks and for the join with them
    rank = shared.groupBy("node").agg((F.count("*") / F.max("n")).alias("rank"))
    sized = shared.join(rank, "node").select("gram", "node", "need", "rest", F.col("n").alias("least"), F.col("n").alias("most"), "rank")
    tops = sized.groupBy("gram").agg(F.max(F.struct("rank", "node", "need", "rest", "least", "most")).alias("top")).select("gram", "top.*")
    x, y = sized.alias("x"), tops.alias("y")
    met = x.join(y, (F.col("x.gram") == F.col("y.gram")) & (F.col("x.node") != F.col("y.node")) & _possible(rule, F.least("x.need", "y.need"), "x", "y"))
    met = met.groupBy(F.col("x.node").alias("node"), F.col("y.node").alias("centre")).agg(F.count("*").alias("met"))
    return met.groupBy("node").agg(F.max(F.struct("met", "centre")).alias("best")).select("node", "best.centre")


def star_blocks(pairs: DataFrame) -> DataFrame:
    sizes = pairs.groupBy("centre").agg(F.count("*").alias("n")).select("centre", _parts(F.col("n")).alias("parts"))
    members = pairs.join(sizes, "centre").select(F.col("centre").alias("target"), _part_of("node", "parts").alias("part"), F.lit(0).alias("asking"), F.lit(1).alias("role"), "node")
    askers = sizes.select(F.col("centre").alias("target"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("asking"), F.lit(0).alias("role"), F.col("centre").alias("node"))
    return members.unionByName(askers)


def component_pairs(shared: DataFrame, labels: DataFrame, compared: DataFrame, rule: Rule) -> DataFrame:
    """Pairs of components (one, other) that share as many prefix n-grams as either asks for."""
    held = shared.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    by_gram = held.groupBy("gram", "component").agg(F.min("need").alias("need"), F.max("need").alias("most_need"), F.max("rest").alias("rest"), F.min("n").alias("least"), F.max("n").alias("most"))
    many = by_gram.groupBy("gram").agg(F.count("*").alias("k")).filter("k > 1").select("gram")
    left = cut(by_gram.join(many, "gram", "left_semi"))
    one, other = left.alias("x"), left.alias("y")
    possible = _possible(rule, F.least("x.most_need", "y.most_need"), "x", "y")
    met = one.join(other, (F.col("x.gram") == F.col("y.gram")) & (F.col("x.component") < F.col("y.component")) & possible)
    pairs = met.groupBy(F.col("x.component").alias("one"), F.col("y.component").alias("other")).agg(F.count("*").alias("met"), F.min(F.least("x.need", "y.need")).alias("need")).filter("met >= need")
    larger = labels.select("component").distinct()
    done = compared.select(F.least("node", "centre").alias("one"), F.greatest("node", "centre").alias("other")).distinct()
    done = done.join(larger, done.one == larger.component, "left_anti").join(larger, done.other == larger.component, "left_anti")
    return pairs.select("one", "other").join(done, ["one", "other"], "left_anti")


def component_blocks(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Blocks in which every member of one component meets every member of the other."""
    ends = pairs.select(F.col("one").alias("component")).union(pairs.select("other")).distinct()
    members = cut(ends.join(labels, "component", "left").select("component", F.coalesce("node", "component").alias("node")))
    sizes = members.groupBy("component").agg(F.count("*").alias("size"))
    sized = pairs.join(sizes.select(F.col("component").alias("one"), F.col("size").alias("m")), "one").join(sizes.select(F.col("component").alias("other"), F.col("size").alias("n")), "other")
    swap = F.col("m") > F.col("n")
    sized = cut(sized.select(F.when(swap, F.col("one")).otherwise(F.col("other")).alias("target"), F.when(swap, F.col("other")).otherwise(F.col("one")).alias("asker"), F.least("m", "n").alias("asking_size"), F.greatest("m", "n").alias("size")))
    targets = sized.groupBy("target").agg(_parts(F.max("size")).alias("parts"), _parts(F.sum("asking_size")).alias("askings"))
    held = targets.join(members, targets.target == members.component).select("target", _part_of("node", "parts").alias("part"), F.explode(F.sequence(F.lit(0), F.col("askings") - 1)).alias("asking"), F.lit(1).alias("role"), "node")
    asking = sized.select("target", "asker").join(targets, "target").join(members, F.col("asker") == members.component)
    asking = asking.select("target", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), _part_of("node", "askings").alias("asking"), F.lit(0).alias("role"), "node")
    return held.unionByName(asking)


def _placed(docs: DataFrame, rule: Rule, id_col: str, text_col: str) -> DataFrame:
    """id, mark (a hash of the text), n_shingles and component of every row; rows without an id or n-grams have no component."""
    rows = small_batches(docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"), _mark(text_col).alias("mark")))
    there = rows.filter(F.col(id_col).isNotNull()).drop("mark")
    scanned = cut(first_scan(rows, id_col, rule))
    nodes = scanned.filter("piece IS NULL").select(id_col, "mark", "node", "n_shingles")
    shared = cut(shared_prefixes(there, sketch(scanned), rule))

    wanted = nodes.filter(F.col(id_col).isNotNull() & F.col("node").isNotNull()).groupBy("node").agg(F.min(id_col).alias(id_col)).join(shared.select("node").distinct(), "node", "left_semi")
    texts = cut(packed_texts(there, id_col).join(wanted, id_col).select("node", "packed"))

    compared = cut(star_pairs(shared, rule))
    stars = components(verify(star_blocks(compared), texts, rule))
    pairs = cut(component_pairs(shared, stars, compared, rule))
    links = verify(component_blocks(pairs, stars), texts, rule)
    labels = components(links.union(stars.select(F.col("node").alias("a"), F.col("component").alias("b"))))

    placed = nodes.join(labels, "node", "left")
    return placed.select(id_col, "mark", "n_shingles", F.when(F.col(id_col).isNotNull(), F.coalesce("component", "node")).alias("component"))


def _mark(text_col: str) -> Column:
    return F.xxhash64(F.col(text_col).cast("string"))


def classes(docs: DataFrame, rule: Rule | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles and component_id (the smallest id that links reach) of every row."""
    placed = _placed(docs, rule or Rule(), id_col, text_col)
    alone = F.col("component").isNull()
    smallest = placed.filter(~alone).groupBy("component").agg(F.min(id_col).alias("component_id"))
    together = placed.filter(~alone).join(smallest, "component").select(id_col, "n_shingles", "component_id")
    return together.union(placed.filter(alone).select(id_col, "n_shingles", F.col(id_col).alias("component_id")))


def one_of_each_class(docs: DataFrame, rule: Rule | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without an id or a word, and one row of each class: its smallest id's.

    Where that id is repeated, a row with the text of the least hash, and of those the one
    with the least columns: so columns must have an order.  Reruns agree.  Texts move compressed
    (different texts of one hash and id would be ordered so).
    """
    mine, its_id, its_mark = (fresh(n, docs.columns) for n in ("mark", "first_id", "first_mark"))
    placed = _placed(docs, rule or Rule(), id_col, text_col).filter("component IS NOT NULL")
    first = placed.groupBy("component").agg(F.min(F.struct(id_col, "mark")).alias("least")).select(F.col(f"least.{id_col}").alias(its_id), F.col("least.mark").alias(its_mark))
    linked = F.col(id_col).isNotNull() & F.coalesce(F.col(text_col).cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    moved, strings = docs.filter(linked).withColumn(mine, _mark(text_col)), docs.select(text_col).schema[0].dataType == T.StringType()
    kept = (pressed(moved, text_col) if strings else moved).join(first, (F.col(id_col) == F.col(its_id)) & (F.col(mine) == F.col(its_mark)), "left_semi")
    kept = kept.groupBy(id_col, mine).agg(F.min(F.struct(*docs.columns)).alias("least")).select("least.*")
    return (pressed(kept, text_col, back=True) if strings else kept).union(docs.filter(~linked))
