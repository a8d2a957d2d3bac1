"""BPE encoding and decoding by an automaton over tokens.

Compilation starts from one state with an arc to itself for every byte and applies, merge
by merge, a gadget.  For the merge (u, v) -> w:

* the state that u leads to is copied without its arc for v, and u's arcs go to the copy:
  from now on v never follows u;
* wherever u then v could be read, an arc for w leads to a copy of the state where v led.

The automaton so made is deterministic and accepts exactly the token sequences that the
merges produce, one for each byte string.  It is compiled into a table of bits, a row for
each state and a column for each class of symbols; states, and symbols, that the same gadgets
have gone over are one.  The state that an arc leads to is that of its symbol.

A pre-split word is encoded from left to right by looking up (state, symbol), the longest
label that an arc allows first; where no arc goes on, the search goes back to the last place
with a shorter one.  Each place is reached by at most one accepted sequence, so none is gone
through twice.  The symbols whose labels begin at a place are read off a table of
(node, byte).  Decoding emits the labels of the arcs.

Short words that a task meets for the first time are encoded many at once, place by place:
as each place is reached by one sequence only, its state is known once all earlier places
are done, and so no search goes back.  The ids are read from the ends.

Null texts encode as empty ones: no ids; repeated rows each give a row; columns other than
the id and the text are ignored, whatever their names; empty tables give no rows.  Very long
texts are encoded whole, in segments cut at spaces, so that only their ids are held.
"""

from __future__ import annotations

import gc
import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from .bytelevel import PIECES, Vocabulary, chunked, load_vocabulary, special_pattern
from .durable import give_back, small_batches, tidy

Merge = tuple[int, int, int]

#: Bytes of a word up to which it's encoded with others, and words that are encoded together.
SHORT, TOGETHER = 64, 4096
#: Bytes, roughly, of a task's memory of words, and of an entry besides its letters and ids.
REMEMBERED_BYTES, _ENTRY = 32 << 20, 200
#: Characters of texts whose new words are encoded together, roughly.
_GROUP = 1 << 18
#: Ids whose texts and labels are put together at a time.
_STRETCH = 1 << 16


class Gadgets:
    """The automaton while merges are applied; a state is named by the symbol that leads to it.

    A copy is kept as what it was copied from and the arc that it lacks.
    """

    def __init__(self, base: Iterable[int]):
        self.symbols = dict.fromkeys(base)
        self.lacks: dict[int, int] = {}  # (state << 32 | symbol): the merge that took the arc away
        self.left: dict[int, tuple[int, int]] = {}  # w: u and the merge; w's arcs are where u's were then
        self.right: dict[int, tuple[int, int]] = {}  # w: v and the merge; w's state is a copy of v's then

    def has_arc(self, state: int, symbol: int) -> bool:
        """Whether a state has an arc, read through the copies that both come from."""
        copied_at = 1 << 62
        while True:
            s, added_at = symbol, 1 << 62
            while True:
                k = self.lacks.get((state << 32) | s)
                if k is not None and k < copied_at and k <= added_at:
                    return False
                if s not in self.left:
                    break
                s, added_at = self.left[s]
            if state not in self.right:
                return True
            state, copied_at = self.right[state]

    def apply(self, k: int, merge: Merge) -> None:
        u, v, w = merge
        if w in self.symbols or u not in self.symbols or v not in self.symbols or not self.has_arc(u, v):
            return  # nothing reads u then v, or an earlier merge made w
        self.symbols[w] = None
        self.lacks[(u << 32) | v] = k
        self.left[w], self.right[w] = (u, k), (v, k)

    def _ordered(self, origin: dict[int, tuple[int, int]]) -> tuple[dict[int, int], dict[int, list[tuple[int, int]]], dict[int, int]]:
        """Numbers under which what comes from one symbol, from some merge on, lies together up to that symbol."""
        made: dict[int, list[tuple[int, int]]] = {}
        for w, (s, k) in origin.items():
            made.setdefault(s, []).append((k, w))
        number: dict[int, int] = {}
        first: dict[int, int] = {}
        for root in self.symbols:
            stack = [(root, 0)] if root not in origin else []
            while stack:
                s, nth = stack.pop()
                first.setdefault(s, len(number))
                if nth < len(made.get(s, ())):
                    stack += [(s, nth + 1), (made[s][nth][1], 0)]
                else:
                    number[s] = len(number)
        return number, made, first

    def table(self) -> tuple[np.ndarray, dict[int, int], dict[int, int]]:
        """Bits of (state, class of symbols), and the state and the class of every symbol."""
        row_of, copies, first_row = self._ordered(self.right)
        column_of, adds, first_column = self._ordered(self.left)
        gone = []
        for key, k in self.lacks.items():
            u, v = key >> 32, key & 0xFFFFFFFF
            later = bisect_right(copies.get(u, []), (k, 1 << 62))
            top = first_row[copies[u][later][1]] if later < len(copies.get(u, ())) else row_of[u]
            later = bisect_left(adds.get(v, []), (k, -1))
            side = first_column[adds[v][later][1]] if later < len(adds.get(v, ())) else column_of[v]
            gone.append((top, row_of[u] + 1, side, column_of[v] + 1))
        gone = np.array(gone, np.int64).reshape(-1, 4)
        rows, columns = _classes(gone[:, 0], gone[:, 1], len(row_of)), _classes(gone[:, 2], gone[:, 3], len(column_of))
        n_columns = int(columns.max(initial=-1)) + 1
        packed = np.full((int(rows.max(initial=-1)) + 1, -(-n_columns // 8)), 255, np.uint8)
        for a, b, c, d in gone.tolist():
            if b - a == 1 and d - c == 1:
                packed[rows[a], columns[c] >> 3] &= 255 ^ (1 << (int(columns[c]) & 7))
            else:
                taken = np.zeros(packed.shape[1] * 8, bool)
                taken[columns[c:d]] = True
                packed[np.unique(rows[a:b])] &= ~np.packbits(taken, bitorder="little")
        return packed, {s: int(rows[i]) for s, i in row_of.items()}, {s: int(columns[i]) for s, i in column_of.items()}


def _classes(start: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """The class of each of n numbers: those that lie in the same stretches are one class."""
    mark = np.random.default_rng(0).integers(1, 1 << 63, (len(start), 2), dtype=np.uint64)
    change = np.zeros((n + 1, 2), np.uint64)
    np.add.at(change, start, mark)
    np.subtract.at(change, end, mark)
    return np.unique(np.cumsum(change, 0)[:n], axis=0, return_inverse=True)[1].ravel()


def _laid_out(labelled: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The table of (node, byte) in one row: base of each node; at base + byte the node whose entry it is and the node below; the symbol of each node, or -1."""
    below, symbols = [labelled], [-1]
    entries: list[dict[int, int]] = []
    for node in below:  # grows on the way
        own = {}
        for byte, (arc, deeper) in node.items():
            own[byte] = len(below)
            below.append(deeper)
            symbols.append(-1 if arc is None else arc[3])
        entries.append(own)
    taken = bytearray(1024 + 8 * len(below))
    base, owner, child = np.zeros(len(below), np.int32), np.full(len(taken), -1, np.int32), np.zeros(len(taken), np.int32)
    begin: dict[int, int] = {}  # nodes with as many entries found no room before; single entries fill the gaps
    for i in sorted((i for i, own in enumerate(entries) if own), key=lambda i: -len(entries[i])):
        own = entries[i]
        first = min(own)
        at = taken.find(0, max(first, begin.get(len(own), 0)))
        while any(taken[at - first + byte] for byte in own):
            at = taken.find(0, at + 1)
        base[i], begin[len(own)] = at - first, at
        for byte, node in own.items():
            place = at - first + byte
            taken[place], owner[place], child[place] = 1, i, node
    used = int(base.max()) + 257  # and 256, which ends a word
    return base, owner[:used], child[:used], np.array(symbols, np.int32)


class TokenAutomaton:
    """The compiled tables; of a size that the vocabulary bounds, and so broadcast."""

    def __init__(self, vocabulary: Vocabulary):
        self.labels = vocabulary.token_bytes
        self.special = vocabulary.special
        made = Gadgets(vocabulary.byte_ids)
        for k, merge in enumerate(vocabulary.merges):
            made.apply(k, merge)
        packed, state, column = made.table()
        # The first row is the start's, which has every arc; the last that of places which nothing reaches, without any.
        self.wide = packed.shape[1]
        self.bits = b"".join([b"\xff" * self.wide, packed.data, bytes(self.wide)])
        #: A node: by byte, the arc of the symbol whose label ends there, or None, and the node below.
        #: An arc: the byte and the bit of its column, the row of the state that it leads to, the symbol.
        self.labelled: dict[int, tuple[tuple[int, int, int, int] | None, dict]] = {}
        for s in made.symbols:
            *path, last = self.labels[s]
            node = self.labelled
            for b in path:
                node = node.setdefault(b, (None, {}))[1]
            node[last] = ((column[s] >> 3, 1 << (column[s] & 7), (state[s] + 1) * self.wide, s), node[last][1] if last in node else {})
        self.nodes = _laid_out(self.labelled)
        #: By symbol: what its arcs hold, and the bytes of its label.
        self.arcs = np.zeros((4, max(self.labels, default=-1) + 1), np.int32)
        for s in made.symbols:
            self.arcs[:, s] = column[s] >> 3, 1 << (column[s] & 7), (state[s] + 1) * self.wide, len(self.labels[s])

    def encode_word(self, word: str | bytes) -> list[int]:
        """The ids of one pre-split word; nothing, if the table accepts no sequence for it."""
        data = word.encode() if isinstance(word, str) else word
        n, bits, labelled = len(data), self.bits, self.labelled
        i, row, ids, untried = 0, 0, [], []
        while i < n:
            node, j, arcs = labelled, i, []
            while j < n:
                found = node.get(data[j])
                if found is None:
                    break
                arc, node = found
                j += 1
                if arc is not None and bits[row + arc[0]] & arc[1]:
                    arcs.append((j, arc))
            untried.append(arcs)
            while not untried[-1]:  # nothing goes on from here: back to the last place with a shorter arc
                untried.pop()
                if not untried:
                    return []
                ids.pop()
            i, (_, _, row, symbol) = untried[-1].pop()
            ids.append(symbol)
        return ids

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.labels.__getitem__, ids)).decode("utf-8", errors="replace")


class Words:
    """Encodes many pre-split words at once by an automaton's tables."""

    def __init__(self, automaton: TokenAutomaton):
        self.automaton = automaton
        self.base, self.owner, self.child, self.symbol = automaton.nodes
        self.byte, self.bit, self.row, self.length = automaton.arcs
        self.bits, self.nowhere = np.frombuffer(automaton.bits, np.uint8), len(automaton.bits) - automaton.wide

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, and how many each has; none, if the table accepts no sequence for it."""
        ids, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for at in range(0, len(words), TOGETHER):
            data = [w.encode() for w in words[at : at + TOGETHER]]
            long = [i for i, d in enumerate(data) if len(d) > SHORT]
            alone = {i: np.array(self.automaton.encode_word(data[i]), np.int32) for i in long}
            for i in long:
                data[i] = b""
            found, n = self._together(data)
            if long:
                found = np.insert(found, np.repeat(np.cumsum(n)[long], [len(alone[i]) for i in long]), np.concatenate([alone[i] for i in long]))
                n[long] = [len(alone[i]) for i in long]
            ids.append(found)
            counts.append(n)
        return np.concatenate(ids), np.concatenate(counts)

    def _together(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        data = np.frombuffer(b"\0".join(words) + b"\0", np.uint8).astype(np.int32)
        data[ends] = 256  # no byte: no node has an entry for it
        place = np.arange(len(data), dtype=np.int32) - np.repeat(ends - sizes, sizes + 1).astype(np.int32)
        starts, stops, symbols = self._labels(data)
        order = np.argsort(place[starts].astype(np.uint8), kind="stable")
        starts, stops, symbols = starts[order], stops[order], symbols[order]
        bounds = np.cumsum(np.bincount(place[starts], minlength=1))
        bytes_, bits = self.byte[symbols], self.bit[symbols]

        row = np.full(len(data), self.nowhere, np.int32)
        row[ends - sizes] = 0
        last = np.full(len(data), -1, np.int32)  # the symbol that ends at a place
        for a, b in zip([0, *bounds[:-1].tolist()], bounds.tolist(), strict=True):
            on = np.flatnonzero(self.bits[row[starts[a:b]] + bytes_[a:b]] & bits[a:b]) + a
            last[stops[on]] = symbols[on]
            row[stops[on]] = self.row[symbols[on]]

        counts, steps = np.zeros(len(words), np.int64), []
        open_ = np.flatnonzero((sizes > 0) & (last[ends] >= 0))
        at = ends[open_]
        while len(open_):
            symbol = last[at]
            steps.append((open_, symbol))
            counts[open_] += 1
            at = at - self.length[symbol]
            more = place[at] > 0
            open_, at = open_[more], at[more]
        ids, to = np.zeros(int(counts.sum()), np.int32), np.cumsum(counts) - 1
        for i, (who, symbol) in enumerate(steps):
            ids[to[who] - i] = symbol
        return ids, counts

    def _labels(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where labels begin and end, and their symbols."""
        start, found = np.arange(len(data), dtype=np.int32), []
        at, node = start, np.zeros(len(data), np.int32)
        while len(at):
            entry = self.base[node] + data[at]
            on = np.flatnonzero(self.owner[entry] == node)
            start, at, node = start[on], at[on] + 1, self.child[entry[on]]
            symbol = self.symbol[node]
            there = np.flatnonzero(symbol >= 0)
            found.append((start[there], at[there], symbol[there]))
        return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _ragged(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches of values, one after another."""
    before = np.cumsum(lengths) - lengths
    return values[np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))]


class Encoder:
    """Encodes whole texts by an automaton, with a task's memory of words, bounded by bytes."""

    def __init__(self, automaton: TokenAutomaton):
        self.automaton = automaton
        self.pattern = special_pattern(automaton.special)
        self.words = Words(automaton)
        most = max(automaton.labels, default=-1) + 1
        #: By id: its text and a comma; where its label lies among all labels, and its bytes.
        self.texts = np.array([f"{i}," for i in range(most)], "S")
        self.lengths = np.array([len(automaton.labels.get(i, b"")) for i in range(most)], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.labels = np.frombuffer(b"".join(automaton.labels.get(i, b"") for i in range(most)), np.uint8)
        self._forget()

    def _forget(self) -> None:
        #: The number of a chunk that follows a space; by number, where its ids are among all ids, and how many.
        self.known: dict[str, int] = {}
        self.bytes, self.ids, self.at, self.counts = 0, np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _encoded(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all chunks, and how many each has."""
        pieces, last = [], []
        for chunk in chunks:
            if chunk[1:].isalpha() and chunk.isascii() and (chunk[0] == " " or chunk[0].isalpha()):
                pieces.append(chunk)  # a space and letters only: one piece
            else:
                pieces += PIECES.findall(chunk)
            last.append(len(pieces))
        ids, counts = self.words.encode(pieces)
        sums = np.concatenate([[0], np.cumsum(counts)])[[0, *last]]
        return ids, np.diff(sums)

    def _learn(self, new: list[str]) -> None:
        ids, counts = self._encoded([" " + chunk for chunk in new])
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        self.at = np.concatenate([self.at, len(self.ids) + np.cumsum(counts) - counts])
        self.counts, self.ids = np.concatenate([self.counts, counts]), np.concatenate([self.ids, ids])
        self.bytes += _ENTRY * len(new) + sum(map(len, new)) + 4 * len(ids)

    def segments(self, texts: Iterable[str | None]) -> Iterator[tuple[int, np.ndarray]]:
        """The ids of texts, a segment of one at a time, with the text's place; several segments are encoded together."""
        waiting, size = [], 0
        for i, text in enumerate(texts):
            for special, first, rest in chunked(text or "", self.pattern):
                waiting.append((i, special, first, rest))
                size += len(special or first) + sum(map(len, rest)) + len(rest)
                if size >= _GROUP:
                    yield from self._settle(waiting)
                    waiting, size = [], 0
        yield from self._settle(waiting)

    def _settle(self, waiting: list[tuple[int, str | None, str | None, list[str]]]) -> Iterator[tuple[int, np.ndarray]]:
        if self.bytes >= REMEMBERED_BYTES:
            self._forget()
        self._learn([*set().union(*(rest for *_, rest in waiting)).difference(self.known)])
        firsts, n_firsts = self._encoded([first or "" for _, _, first, _ in waiting])
        of_first = np.split(firsts, np.cumsum(n_firsts)[:-1]) if waiting else []
        for (i, special, _, rest), head in zip(waiting, of_first, strict=True):
            if special:
                yield i, np.array([self.automaton.special[special]], np.int32)
                continue
            which = np.fromiter(map(self.known.__getitem__, rest), np.int64, len(rest))
            yield i, np.concatenate([head, _ragged(self.ids, self.at[which], self.counts[which])])

    def _told(self, ids: list[int] | np.ndarray) -> tuple[int, str, bytes]:
        """Number of ids, the ids joined by commas, and their labels."""
        ids = np.asarray(ids, np.int64)
        texts, labels = [], []
        for at in range(0, len(ids), _STRETCH):
            own = ids[at : at + _STRETCH]
            texts.append(self.texts[own].tobytes().translate(None, b"\0"))
            labels.append(_ragged(self.labels, self.starts[own], self.lengths[own]).tobytes())
        return len(ids), b"".join(texts)[:-1].decode(), b"".join(labels)

    def encode(self, text: str | None) -> list[int]:
        return [i for _, ids in self.segments([text]) for i in ids.tolist()]

    def digests(self, texts: list[str | None]) -> Iterator[tuple[int, str, str]]:
        """Of each text: number of ids, SHA-256 of the ids joined by commas, SHA-256 of the decoded text."""
        now, n, of_ids, of_text = 0, 0, hashlib.sha256(), hashlib.sha256()
        for i, ids in self.segments(texts):
            while now < i:
                yield n, of_ids.hexdigest(), of_text.hexdigest()
                now, n, of_ids, of_text = now + 1, 0, hashlib.sha256(), hashlib.sha256()
            if len(ids):
                count, told, labels = self._told(ids)
                of_ids.update((("," if n else "") + told).encode())
                of_text.update(labels.decode("utf-8", errors="replace").encode())
                n += count
        for _ in range(now, len(texts)):
            yield n, of_ids.hexdigest(), of_text.hexdigest()
            n, of_ids, of_text = 0, hashlib.sha256(), hashlib.sha256()

    def digest(self, text: str | None) -> tuple[int, str, str]:
        return next(self.digests([text]))


def _broadcast(rows: DataFrame, tokenizer_path: str) -> Broadcast:
    """The compiled automaton, of which the driver's Python keeps nothing."""
    shared = rows.sparkSession.sparkContext.broadcast(TokenAutomaton(load_vocabulary(tokenizer_path)))
    give_back()
    return shared


def _scan(docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str, fields: list[T.StructField], arrays) -> DataFrame:
    """One scan that adds what ``arrays`` makes of an encoder and a batch's texts."""
    shared = _broadcast(docs, tokenizer_path)
    rows = small_batches(docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text")))
    schema = T.StructType([T.StructField(id_col, rows.schema[0].dataType), *fields])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        gc.freeze()  # until the task gives back: the automaton is no garbage, and looking through it takes long
        for batch in batches:
            made = arrays(encoder, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=schema.names)

    return rows.mapInArrow(run, schema)


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and token_ids (array of int) of every row."""

    def arrays(encoder: Encoder, texts: list[str | None]) -> list[pa.Array]:
        return [pa.array([encoder.encode(t) for t in texts], pa.list_(pa.int32()))]

    return _scan(docs, tokenizer_path, id_col, text_col, [T.StructField("token_ids", T.ArrayType(T.IntegerType()))], arrays)


def decode(encoded: DataFrame, tokenizer_path: str, id_col: str = "doc_id", ids_col: str = "token_ids") -> DataFrame:
    """id and text of every row of ids; null ids decode as null."""
    shared = _broadcast(encoded, tokenizer_path)
    rows = encoded.select(F.col(id_col), F.col(ids_col).cast("array<int>").alias("ids"))
    schema = T.StructType([T.StructField(id_col, rows.schema[0].dataType), T.StructField("text", T.StringType())])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        for batch in batches:
            made = [None if (ids := x.as_py()) is None else automaton.decode(ids) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.string())], names=schema.names)

    return rows.mapInArrow(run, schema)


def round_trip(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, ids_sha256 and decoded_sha256 of every row: encoded and decoded in one scan."""
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]

    def arrays(encoder: Encoder, texts: list[str | None]) -> list[pa.Array]:
        made = [*encoder.digests(texts)]
        return [pa.array([m[0] for m in made], pa.int64()), pa.array([m[1] for m in made], pa.string()), pa.array([m[2] for m in made], pa.string())]

    return _scan(docs, tokenizer_path, id_col, text_col, fields, arrays)
