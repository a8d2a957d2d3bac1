import hashlib
import itertools
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerloom.llm import bpe_automaton, bpe_count
from ledgerloom.llm.bytelevel import Remembered, Vocabulary, chunked, load_vocabulary, special_pattern

PATH = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = [*" \n\t  aaabbethinoré'sdtllve ñß漢字🙂\x1c\x85 ​²½Ⅷ١!?.,--__0123", "<|endoftext|>", "  ", "the ", "ing", "\r\n"]


@pytest.fixture(scope="module")
def vocabulary():
    return load_vocabulary(PATH)


def texts(n, longest=40):
    rng = random.Random(7)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, longest))) for _ in range(n)] + ["", "a" * 3000, " " * 50, "x <|endoftext|><|endoftext|> y", "the " * 400]


def encoder(vocabulary):
    return bpe_automaton.Encoder(bpe_automaton.TokenAutomaton(vocabulary))


@pytest.fixture(scope="module")
def whole(vocabulary):
    return encoder(vocabulary)


def test_both_equal_the_library(vocabulary, whole):
    counter, library = bpe_count.PairCounter(bpe_count.Merges(vocabulary)), Tokenizer.from_file(PATH)
    for text in texts(3000):
        ids = library.encode(text, add_special_tokens=False).ids
        assert whole.encode(text) == ids
        assert counter.count(text) == len(ids)
        assert whole.automaton.decode(ids) == library.decode(ids, skip_special_tokens=False)
        n, ids_hash, decoded = whole.digest(text)
        assert (n, ids_hash) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert decoded == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def small(merges, letters="abc"):
    """A vocabulary of few letters; merges: pairs of strings."""
    ids = {c: i for i, c in enumerate(letters)}
    made = []
    for a, b in merges:
        ids.setdefault(a + b, len(ids))
        made.append((ids[a], ids[b], ids[a + b]))
    return Vocabulary({i: s.encode() for s, i in ids.items()}, made, {}, [*range(len(letters))])


def random_merges(rng):
    parts, merges = ["a", "b", "c"], []
    while len(merges) < 12:
        pair = rng.choice(parts), rng.choice(parts)
        if pair not in merges and len(pair[0] + pair[1]) < 9:
            merges.append(pair)
            parts.append(pair[0] + pair[1])
    return merges


def merged(word, merges):
    """By definition: merge by merge, from left to right."""
    parts = [*word]
    while True:
        ranks = [merges.index(p) for p in zip(parts, parts[1:], strict=False) if p in merges]
        if not ranks:
            return parts
        a, b = merges[min(ranks)]
        at, out = 0, []
        while at < len(parts):
            both = parts[at : at + 2] == [a, b]
            out.append(a + b if both else parts[at])
            at += 1 + both
        parts = out


@pytest.mark.parametrize("seed", range(12))
def test_compiled_automaton_is_that_of_its_merges(seed):
    rng = random.Random(seed)
    merges = random_merges(rng)
    vocabulary = small(merges)
    automaton = bpe_automaton.TokenAutomaton(vocabulary)
    for n in range(1, 8):
        for letters in itertools.product("abc", repeat=n):
            word = "".join(letters)
            assert [vocabulary.token_bytes[i].decode() for i in automaton.encode_word(word)] == merged(word, merges)


def test_only_the_table_decides_an_encoding():
    vocabulary = small([("a", "b"), ("ab", "c")])
    automaton = bpe_automaton.TokenAutomaton(vocabulary)
    a, b, c, ab, abc = range(5)
    assert automaton.encode_word("abcab") == [abc, ab]

    def bit(before, symbol):
        row = next(arc for arc in arcs(automaton.labelled) if arc[3] == before)[2]
        byte, mask, _, _ = next(arc for arc in arcs(automaton.labelled) if arc[3] == symbol)
        return row + byte, mask

    def arcs(node):
        for arc, below in node.values():
            yield from [arc] * (arc is not None)
            yield from arcs(below)

    there = {(x, y) for x in range(5) for y in range(5) if automaton.bits[(at := bit(x, y))[0]] & at[1]}
    assert {(a, b), (ab, c)}.isdisjoint(there) and (a, a) in there and (b, ab) in there and (a, c) in there
    at, mask = bit(abc, ab)
    changed = bytearray(automaton.bits)
    changed[at] &= 255 - mask
    automaton.bits = bytes(changed)
    assert automaton.encode_word("abcab") != [abc, ab]


def test_memories_are_bounded_by_bytes():
    made = []
    memory = Remembered(lambda key: made.append(key) or key, most_bytes=10_000)
    for i in range(1000):
        memory[f"{i:0100}"]
    assert len(memory) + len(memory.older) < 70 and len(made) == 1000
    assert memory["x" * 50] == "x" * 50 and memory["x" * 50] and len(made) == 1001


def test_long_texts_are_cut_at_spaces_only(vocabulary, monkeypatch):
    from ledgerloom.llm import bytelevel

    text = " ".join(texts(300))
    ids, digest = encoder(vocabulary).encode(text), encoder(vocabulary).digest(text)
    monkeypatch.setattr(bytelevel, "SEGMENT", 50)
    assert len([*chunked(text, special_pattern({}))]) > 10
    assert encoder(vocabulary).encode(text) == ids and encoder(vocabulary).digest(text) == digest


def test_rows_of_every_kind(spark):
    rows = [(1, "the cat", "x"), (1, "the cat", "y"), (2, None, None), (3, "", "z"), (None, "dog <|endoftext|>", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    counted = {(r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in bpe_count.token_counts(docs, PATH, limit=1).collect()}
    assert counted == {(1, 7, 2, True), (2, 0, 0, False), (3, 0, 0, False), (None, 17, 3, True)}
    made = bpe_automaton.round_trip(docs, PATH).collect()
    assert len(made) == 5 and {r["n_tokens"] for r in made if r["doc_id"] in (2, 3)} == {0}
    back = bpe_automaton.decode(bpe_automaton.encode(docs, PATH), PATH)
    assert {r["text"] for r in back.collect()} == {"the cat", "", "dog <|endoftext|>"}
    assert bpe_automaton.round_trip(docs.limit(0), PATH).count() == 0 and bpe_count.token_counts(docs.limit(0), PATH).count() == 0


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        load_vocabulary(public_tokenizers.path("word_bpe_49k.json"))


def test_a_very_long_word_is_packed(vocabulary):
    import tracemalloc

    counter, library = bpe_count.PairCounter(bpe_count.Merges(vocabulary)), Tokenizer.from_file(PATH)
    rng = random.Random(3)
    for n in (bpe_count._LONG - 1, bpe_count._LONG, 100_000):
        word = "".join(rng.choices("abcdeñ", k=n))
        tracemalloc.start()
        assert counter.count(word) == len(library.encode(word, add_special_tokens=False).ids)
        assert tracemalloc.get_traced_memory()[1] < 20_000_000
        tracemalloc.stop()


def test_a_word_is_looked_up_from_where_tokens_begin():
    class Counting(dict):
        looked = 0

        def get(self, *key):
            Counting.looked += 1
            return super().get(*key)

    vocabulary = small([("a", "b"), ("ab", "c"), ("abc", "abc")])
    automaton = bpe_automaton.TokenAutomaton(vocabulary)
    automaton.labelled = Counting(automaton.labelled)
    assert automaton.encode_word("abc" * 40) == [5] * 20
    assert Counting.looked == 20


def test_what_is_told_of_ids():
    vocabulary = small([("a", "b"), ("ab", "c")])
    encoder = bpe_automaton.Encoder(bpe_automaton.TokenAutomaton(vocabulary))
    ids = [0, 4, 3]
    assert encoder._told(ids) == (3, "0,4,3", b"aabcab") and encoder._told([4]) == (1, "4", b"abc")


def test_many_words_are_encoded_together_as_each_alone(vocabulary, monkeypatch):
    automaton = bpe_automaton.TokenAutomaton(vocabulary)
    rng = random.Random(5)
    words = ["".join(rng.choices("etaonrish é漢.", k=rng.randint(0, 90))) for _ in range(3000)] + ["", "a" * 500]
    alone = [automaton.encode_word(w) for w in words]
    looked = []
    monkeypatch.setattr(bpe_automaton.TokenAutomaton, "encode_word", lambda self, word, own=bpe_automaton.TokenAutomaton.encode_word: looked.append(word) or own(self, word))
    ids, counts = bpe_automaton.Words(automaton).encode(words)
    assert counts.tolist() == [len(x) for x in alone] and ids.tolist() == [i for x in alone for i in x]
    assert {*looked} == {x for w in words if len(x := w.encode()) > bpe_automaton.SHORT}


@pytest.mark.parametrize("seed", range(5))
def test_words_together_follow_the_merges_and_unknown_letters_have_none(seed):
    merges = random_merges(random.Random(seed))
    automaton = bpe_automaton.TokenAutomaton(small(merges))
    words = ["".join(x) for n in range(1, 7) for x in itertools.product("abc", repeat=n)] + ["abx", "xab"]
    ids, counts = bpe_automaton.Words(automaton).encode(words)
    labels = iter([automaton.labels[i].decode() for i in ids.tolist()])
    assert [[*itertools.islice(labels, n)] for n in counts.tolist()] == [merged(w, merges) if "x" not in w else [] for w in words]


def test_a_memory_of_words_that_is_full_changes_no_digest(vocabulary, whole, monkeypatch):
    some = [None, *texts(300), None]
    expected = [*whole.digests(some)]
    assert expected == [whole.digest(t) for t in some]
    monkeypatch.setattr(bpe_automaton, "REMEMBERED_BYTES", 1000)
    monkeypatch.setattr(bpe_automaton, "_GROUP", 500)
    assert [*encoder(vocabulary).digests(some)] == expected
