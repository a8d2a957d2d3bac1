"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

The rank file (a base64 token and its rank on each line) is read once on the driver and sent
to the tasks: its size is bounded by the vocabulary.  Every match of the pre-tokenizer's
pattern is encoded by itself, without special tokens: their strings are ordinary text.

Long texts are cut first, where a match of the pattern ends whatever follows: behind a
character that isn't white space and before white space, or behind a letter or digit and
before ASCII or CJK punctuation.  No match spans such a place and the pattern doesn't look
behind, so the parts' ids joined are the text's ids.  A stretch without such a place stays whole.
In long runs of white space, for which the library's pattern engine runs out of stack, the
one match is known: all of the run but its last character where something follows; the library
merges it without the pattern.  These cuts are for ``PATTERN``; for any other pattern, texts go whole.

Null texts are empty texts; empty texts have no ids and decode to no bytes.  Texts of any
length are encoded whole.  Repeated rows each give a row, rows without an id too; columns
other than the id and the text are ignored, whatever their names; empty tables give no rows.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .durable import small_batches, tidy

#: Fixed value: the pattern that the safe places below are safe for.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters that the library is given at once, where a text can be cut; bytes of texts whose ids are sent on together.
SEGMENT, SENT_BYTES = 1 << 17, 4 << 20
_BLANK = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SAFE = re.compile(rf"(?<=[^{_BLANK}])(?=[ \t\r\n])|(?<=[0-9A-Za-zぁ-ゖァ-ヺ一-龥])(?=[!-/:-@\[-`{{-~、。！，？])")
LONG_BLANK = re.compile(rf"[{_BLANK}]{{1000,}}")


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def encoding(ranks: dict[bytes, int], pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def parts(text: str, longest: int = SEGMENT) -> Iterator[str]:
    """The text cut at the first safe place behind each ``longest`` characters."""
    start = 0
    while len(text) - start > longest and (m := SAFE.search(text, start + longest)):
        yield text[start : m.start()]
        start = m.start()
    yield text[start:] if start else text


def encode_whole(library: tiktoken.Encoding, text: str) -> list[int]:
    """The library's ids of the text, whatever its length."""
    if len(text) < 1000 or library._pat_str != PATTERN:
        return library.encode_ordinary(text)
    ids: list[int] = []
    at = 0
    for run in LONG_BLANK.finditer(text):
        for part in parts(text[at : run.start()]):
            ids += library.encode_ordinary(part)
        at = run.end() - (run.end() < len(text))
        ids += library._encode_single_piece(text[run.start() : at])
    for part in parts(text[at:] if at else text):
        ids += library.encode_ordinary(part)
    return ids


def _by_library(rows: DataFrame, ranks: dict[bytes, int], pattern: str, schema: T.StructType, made: Callable, reads: Callable) -> DataFrame:
    """The id and what ``made`` makes of the other column's values; ``reads`` tells the bytes of a value."""
    shared = rows.sparkSession.sparkContext.broadcast(ranks)
    kinds = [pa.int32() if isinstance(f.dataType, T.ArrayType) else pa.binary() for f in schema.fields[1:]]
    kinds = [pa.list_(k) if k == pa.int32() else k for k in kinds]

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = encoding(shared.value, pattern)
        for batch in batches:
            begun, size, out = 0, 0, [[] for _ in kinds]
            for i, value in enumerate(batch.column(1), 1):
                value = value.as_py()
                size += reads(value)
                for column, x in zip(out, made(library, value), strict=True):
                    column.append(x)
                if size > SENT_BYTES or i == len(batch):
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(begun, i - begun), *map(pa.array, out, kinds)], names=schema.names)
                    begun, size, out = i, 0, [[] for _ in kinds]

    return small_batches(rows).mapInArrow(run, schema)


def _schema(rows: DataFrame, id_col: str, *columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(id_col, rows.schema[0].dataType), *(T.StructField(*c) for c in columns)])


def encode(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and ids of every row: one scan, no shuffle."""
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    schema = _schema(rows, id_col, ("ids", T.ArrayType(T.IntegerType())))
    return _by_library(rows, load_ranks(rank_file), pattern, schema, lambda library, text: [encode_whole(library, text or "")], lambda text: len(text or ""))


def decode(encoded: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id and the raw bytes that the ids stand for (null ids: none); an id that the file lacks is an error."""
    rows = encoded.select(F.col(id_col), F.col(ids_col).cast("array<int>").alias("ids"))
    schema = _schema(rows, id_col, ("decoded", T.BinaryType()))
    return _by_library(rows, load_ranks(rank_file), pattern, schema, lambda library, ids: [library.decode_bytes(ids or [])], lambda ids: 4 * len(ids or []))


def round_trip(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids and the bytes decoded from these, in one pass over the texts."""
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    schema = _schema(rows, id_col, ("ids", T.ArrayType(T.IntegerType())), ("decoded", T.BinaryType()))

    def both(library: tiktoken.Encoding, text: str | None) -> list:
        ids = encode_whole(library, text or "")
        return [ids, library.decode_bytes(ids)]

    return _by_library(rows, load_ranks(rank_file), pattern, schema, both, lambda text: len(text or ""))
