import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from ledgerloom.llm import importance, rank_bpe, whitening

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return rank_bpe.encoding(rank_bpe.load_ranks(RANKS), public_tokenizers.PATTERN)


PARTS = [*" \n\t  aaabb'sdt'llve'M ñß漢字。🙂\x1c\x85 ​²½Ⅷ١!?.,--__0123　 ", "<|endoftext|>", "  ", "the ", "ing", "\r\n"]


@pytest.mark.parametrize("longest", [1, 7, 60])
def test_texts_cut_at_safe_places_have_the_same_ids(library, monkeypatch, longest):
    rng = random.Random(longest)
    whole = rank_bpe.parts
    monkeypatch.setattr(rank_bpe, "parts", lambda text: whole(text, longest))
    for i in range(600):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(1, 300)))
        if i % 5 == 0:
            text += rng.choice([" ", "\n", "\t 　"]) * rng.choice([999, 1000, 1700]) + rng.choice(["", "x", " y", "!", "'s"])
        text += "z" * 1000  # so that it counts as long
        assert "".join(whole(text, longest)) == text
        assert rank_bpe.encode_whole(library, text) == library.encode_ordinary(text)


def test_runs_of_blanks_that_the_library_alone_cannot_take(library):
    for text in (" " * 2_000_000 + "x", "\n" * 1_000_001, "a" + " " * 1_500_000):
        ids = rank_bpe.encode_whole(library, text)
        assert library.decode_bytes(ids) == text.encode()
    assert rank_bpe.encode_whole(library, " " * 5000 + "x") == library.encode_ordinary(" " * 5000 + "x")


def test_another_pattern_goes_whole(library):
    other = rank_bpe.encoding(rank_bpe.load_ranks(RANKS), r"\S+\s*|\s+")
    text = "some words. " * 200_00 + " " * 2000
    assert rank_bpe.encode_whole(other, text) == other.encode_ordinary(text)


def test_coded_rows_of_every_kind(spark, library):
    long = "word, " * 100_000
    rows = [(1, "the cat", "x"), (1, "the cat", "y"), (2, None, None), (3, "", "z"), (None, "dog <|endoftext|>", "z"), (4, long, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    made = rank_bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted((str(r["doc_id"]), r["ids"], bytes(r["decoded"])) for r in made) == sorted((str(i), library.encode_ordinary(t or ""), (t or "").encode()) for i, t, _ in rows)
    coded = rank_bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    back = rank_bpe.decode(coded, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted(bytes(r["decoded"]) for r in back) == sorted((t or "").encode() for _, t, _ in rows)
    none = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert bytes(rank_bpe.decode(none, RANKS, public_tokenizers.PATTERN).first()["decoded"]) == b""
    assert rank_bpe.round_trip(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_the_coded_query_gives_the_digests(spark, library, tmp_path):
    from ledgerloom.llm import registry

    rows = [(7, "The quick brown fox's  tail\n\n"), (8, None), (9, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for r in registry.op11_rank_bpe(spark, str(tmp_path)).collect():
        text = dict(rows)[r["doc_id"]] or ""
        ids = library.encode_ordinary(text)
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def drawn(docs, target, least, most, buckets, percent=10, least_words=20, seed=2024):
    """By definition: (id, n_features, weight, score) of every row, and the ids drawn in order."""

    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        return len(words), [" ".join(words[i : i + n]) for n in range(least, most + 1) for i in range(len(words) - n + 1)]

    place = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = (Counter(place(f) for text in texts for f in features(text)[1]) for texts in ([x for _, x in docs], target))
    all_s, all_t = s.total(), t.total()
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    rows = []
    for doc_id, text in docs:
        n, found = features(text)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(place(f)) for f in found)
        rows.append((doc_id, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= least_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    return rows, able[: len(able) * percent // 100]


@pytest.mark.parametrize("least,most,buckets", [(1, 1, 10_000), (1, 2, 50), (2, 3, 7)])
def test_resampling_equals_its_definition(spark, least, most, buckets):
    rng = random.Random(buckets)
    words = ["the", "THE", "a1", "straße", "漢字", "Ünder", "x", "y", "z", "_", "-", "\x7f", "İ"]
    docs = [(i, rng.choice([" ", ", ", "\n"]).join(rng.choice(words) for _ in range(rng.choice([0, 5, 19, 25, 60])))) for i in range(150)]
    docs += [(3, docs[3][1]), (3, "the " * 30), (None, "x y z " * 10), (None, None), (500, None), (501, ""), (502, "!!"), (503, "the x " * 20_000)]
    target = ["the straße x", None, "Z z z y", ""]
    table = spark.createDataFrame([(*d, "q") for d in docs], "doc_id long, text string, lot string").repartition(5)
    wanted = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id int, text string")
    weighed = importance.weights(table, wanted, least, most, buckets)
    out = importance.resample(weighed).collect()
    rows, ranked = drawn(docs, target, least, most, buckets)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_words"], r["n_features"], r["weight"], r["score"]) for r in out) == sorted((r[0] is None, r[0] or 0, *r[1:]) for r in rows)
    got = sorted((r["rank"], r["doc_id"], r["score"]) for r in out if r["rank"] is not None)
    assert got == [(i, r[0], r[4]) for i, r in enumerate(ranked, 1)]


def test_lots_are_bounded_and_bags_are_whole():
    lot, rng = importance.Lot(1, 2), np.random.default_rng(1)
    for _ in range(50):
        bag = np.sort(rng.integers(0, rng.choice([3, 70_000]), rng.integers(0, 300))).astype(np.uint32)
        assert (importance.unpacked(importance.packed(bag), len(bag)) == bag).all()
    n, bag = lot.bag("One two ONE two", False)
    assert n == 4 and len(bag) == 7 and [*lot.grams] == [(0, 1), (1, 0)] and [*lot.words.lowered] == ["one", "two"]
    assert (bag[:6] % 2).tolist() == [0, 0, 1, 1, 0, 0] and lot.word_times.upto(2)[0].tolist() == [2, 2] and lot.gram_times.upto(2)[0].tolist() == [2, 1]
    lot.bag(" ".join(map(str, range(140_000))), True)
    assert lot.full() and lot.gram_times.upto(len(lot.grams))[1].sum() == 139_999 and lot.word_times.upto(140_002)[0].sum() == 4


def test_resampling_nothing(spark):
    docs = spark.createDataFrame([(1, "a b " * 20), (2, None)], "doc_id long, text string")
    none = docs.limit(0)
    assert importance.resample(importance.weights(none, docs)).count() == 0
    out = {r["doc_id"]: r for r in importance.resample(importance.weights(docs, none), percent=100).collect()}
    assert out[1]["rank"] == 1 and out[2]["rank"] is None and out[2]["weight"] == 0
    weighed = importance.weights(docs, docs)
    assert [r["doc_id"] for r in importance.select(docs, weighed, percent=100).collect()] == [1]
    with pytest.raises(ValueError):
        importance.weights(docs, docs, 2, 1)


def by_definition(vectors, k):
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(0)
    c = x - sums / n
    values, parts = np.linalg.eigh(c.T @ c / n)
    values, parts = values[::-1][:k], parts[:, ::-1][:, :k]
    return ((n * x - sums) ** 2).sum(1), c @ parts / np.sqrt(values), values / np.trace(c.T @ c / n)


def test_whitening_equals_its_definition(spark):
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=(300, 40)) * np.linspace(1, 3, 40)).astype(np.float32)
    odd = [(900, None), (901, []), (902, [float("nan")] * 40), (903, [1.0] * 39 + [None]), (904, [float("inf")] + [0.0] * 39), (905, [1.0, 2.0]), (906, [1e30] + [0.0] * 39)]
    rows = [(i, [float(v) for v in x], "q") for i, x in enumerate(vectors)]
    rows += [(*o, "q") for o in odd]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, component string").repartition(3)
    model = whitening.fit(table, 32)
    out = whitening.transform(table, model).toPandas()
    assert len(out) == 300 * 32 and set(out.vec_id) == set(range(300))
    deviation, white, explained = by_definition(vectors, 32)
    wide = out.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    signs = np.sign((wide * white).sum(0))
    assert np.abs(wide * signs - white).max() < 1e-7
    first = out[out.component == 1].sort_values("vec_id")
    assert [int(v) for v in first.deviation] == deviation.tolist() and set(out.n) == {300}
    assert np.allclose(out[out.vec_id == 0].sort_values("component").explained, explained, rtol=1e-9)
    assert out.identity_error.nunique() == 1 and out.identity_error[0] < 1e-9
    measured = np.cov(wide.T, bias=True) - np.eye(32)
    assert abs(np.abs(measured).max() - out.identity_error[0]) < 1e-9


def test_large_entries_are_summed_exactly(spark):
    rows = [(i, [float(2**50 + i), float(-(2**55)), 0.25 * i]) for i in range(4)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    model = whitening.fit(table)
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x, strict=True)]
    assert model.sums == sums and model.n == 4
    out = {r["vec_id"]: int(r["deviation"]) for r in whitening.transform(table, model).filter("component = 1").collect()}
    assert out == {i: sum((4 * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for i, v in enumerate(x)}
    many = np.array([[2**40, -(2**40)]])
    assert whitening.deviations(many, [0, 0], 10**6).to_pylist() == [2 * (10**6 * 2**40) ** 2] and whitening.deviations(many, [0, 0], 10**9).to_pylist() == [None]


def test_components_without_variance_and_repeated_rows(spark):
    rows = [(1, [1.0, 2.0, 3.0]), (1, [1.0, 2.0, 3.0]), (None, [2.0, 2.0, 4.0]), (4, [3.0, 2.0, 5.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = whitening.transform(table, whitening.fit(table)).collect()
    assert len(out) == 12 and {r["component"] for r in out if r["whitened"] is None} == {2, 3}
    assert all(r["identity_error"] < 1e-9 for r in out) and sum(r["explained"] for r in out if r["vec_id"] == 4) == pytest.approx(1)
    one = table.limit(1)
    alone = whitening.transform(one, whitening.fit(one)).collect()
    assert {(r["whitened"], r["explained"], r["identity_error"], int(r["deviation"])) for r in alone} == {(None, None, None, 0)}
    none = table.limit(0)
    assert whitening.fit(none) is None and whitening.transform(none, None).count() == 0
