"""What both byte-level BPE operators share: the vocabulary file and the pre-split.

The file (a ``tokenizers`` JSON of a byte-level BPE) is read once on the driver and
broadcast: its size is bounded by its vocabulary, never by the corpus.

A text is first cut at the strings of special tokens, then at spaces, then by the
pattern.  A space between two characters that aren't white space always begins a new
piece, so a text can be cut there before the slower pattern runs, and the outcome for
each such chunk can be remembered.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import regex

# Fixed value: the pattern of the byte-level pre-tokenizer.
PIECES = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
_TWO_BLANKS = re.compile(r"\s\s")
_INNER_SPACE = re.compile(r"(?<=\S) (?=\S)")
#: Characters of a text that are split at a time, so that very long texts need no long lists.
SEGMENT = 1 << 20
#: Bytes, roughly, that each of the two generations of a task's memory may hold.
REMEMBERED_BYTES = 24 << 20
#: Rough bytes of an entry besides its letters and numbers.
_ENTRY = 220


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte, as byte-level vocabularies write them."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


@dataclass(frozen=True)
class Vocabulary:
    """token_bytes: by id; merges: (left id, right id, id of both) by rank; special: string to id."""

    token_bytes: dict[int, bytes]
    merges: list[tuple[int, int, int]]
    special: dict[str, int]
    byte_ids: list[int] = field(default_factory=list)


def load_vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    pre = spec.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer") or model.get("ignore_merges"):
        raise ValueError("only plain byte-level BPE files are supported")
    alphabet, vocab = byte_alphabet(), model["vocab"]
    merges = []
    for pair in model["merges"]:
        left, right = pair if isinstance(pair, list) else pair.split(" ")
        merges.append((vocab[left], vocab[right], vocab[left + right]))
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    labels = {i: bytes(alphabet[c] for c in token) for token, i in vocab.items() if token not in special}
    labels |= {i: s.encode() for s, i in special.items()}
    byte_ids = [0] * 256
    for shown, b in alphabet.items():
        byte_ids[b] = vocab[shown]
    return Vocabulary(labels, merges, special, byte_ids)


def _size(value) -> int:
    """Rough bytes of what a list or a tuple (count, text, bytes) holds of its own: of one token, the vocabulary holds both."""
    if isinstance(value, tuple):
        return 82 + len(value[1]) + len(value[2]) if value[0] > 1 else 0
    return 8 * len(value) if isinstance(value, list) else 0


class Remembered(dict):
    """A task's memory of ``make(key)``, bounded by bytes: when it is full, what was used since the last time stays."""

    def __init__(self, make: Callable, most_bytes: int = REMEMBERED_BYTES):
        super().__init__()
        self.make, self.most_bytes, self.bytes, self.older = make, most_bytes, 0, {}

    def __missing__(self, key):
        if self.bytes >= self.most_bytes:
            self.older, self.bytes = dict(self), 0
            self.clear()
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        self.bytes += _ENTRY + len(key) + _size(value)
        self[key] = value
        return value


def _segments(text: str) -> Iterator[str]:
    start = 0
    while len(text) - start > SEGMENT:
        m = _INNER_SPACE.search(text, start + SEGMENT)
        if not m:
            break
        yield text[start : m.start()]
        start = m.start()
    yield text[start:] if start else text


def chunked(text: str, special: regex.Pattern | None) -> Iterator[tuple[str | None, str | None, list[str]]]:
    """(special string, first chunk, other chunks); the other chunks lack their leading space."""
    at = 0
    for m in special.finditer(text) if special else ():
        if m.start() > at:
            yield from _chunked(text[at : m.start()])
        yield m.group(), None, []
        at = m.end()
    if at < len(text):
        yield from _chunked(text[at:] if at else text)


def _chunked(text: str) -> Iterator[tuple[None, str, list[str]]]:
    for part in _segments(text):
        chunks = _INNER_SPACE.split(part) if _TWO_BLANKS.search(part) else part.split(" ")
        yield None, chunks[0], chunks[1:]


def special_pattern(special: dict[str, int]) -> regex.Pattern | None:
    names = sorted((s for s in special if s), key=len, reverse=True)
    return regex.compile("|".join(map(regex.escape, names))) if names else None
