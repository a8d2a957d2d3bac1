import math
import random
import zlib

import numpy as np

from ledgerloom.llm import langid, toxicity

LETTERS = {"xa": "abcdeo", "xb": "mnopqu", "xc": "rstvyi"}


def words(rng, letters, n):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


def test_language_is_told_on_rows_that_were_held_out(spark):
    rng = random.Random(1)
    rows = [(i, words(rng, LETTERS[lang], 30), lang) for i in range(400) for lang in [rng.choice([*LETTERS])]]
    rows += [(1000, None, "xa"), (1001, "123 ... !!", "xb"), (1002, "", None), (1003, "abcde abe", None)]
    docs = spark.createDataFrame([(*r, "s", "clash") for r in rows], "doc_id long, text string, lang string, source string, score string")
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(docs, langid.fit(docs)).collect()}
    held = [r for r in rows[:400] if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert len(held) > 40 and np.mean([found[r[0]][0] == r[2] for r in held]) > 0.97
    assert found[1000] == found[1001] == found[1002] == ("und", 0.0) and found[1003][0] == "xa"
    assert all(0 <= s <= 1 for _, s in found.values())


def test_language_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "abc", None), (None, "abc", None)], "doc_id long, text string, lang string")
    assert {tuple(r) for r in langid.predict(docs, langid.fit(docs)).collect()} == {(1, "und", 0.0), (None, "und", 0.0)}
    empty = docs.limit(0)
    assert langid.predict(empty, langid.fit(empty)).count() == 0


def test_weights_are_those_of_ftrl_one_coordinate_at_a_time():
    rng = np.random.default_rng(5)
    rows = []
    for _ in range(40):
        places = np.sort(rng.choice(30, 6, replace=False))
        rows.append((places, rng.random(6), int(rng.integers(3))))
    alpha, beta, l1, l2 = 0.5, 1.0, 0.4, 0.02
    z, n = np.zeros((31, 3)), np.zeros((31, 3))

    def weight(i, k):
        a, b = (0, 0) if i == 30 else (l1, l2)
        return 0.0 if abs(z[i, k]) <= a else -(z[i, k] - math.copysign(a, z[i, k])) / ((beta + n[i, k] ** 0.5) / alpha + b)

    for _ in range(3):
        for places, x, label in rows:
            own = [*zip(places.tolist(), x.tolist(), strict=True), (30, 1.0)]
            w = {(i, k): weight(i, k) for i, _ in own for k in range(3)}
            scores = [sum(v * w[i, k] for i, v in own) for k in range(3)]
            p = [math.exp(s) / sum(map(math.exp, scores)) for s in scores]
            for i, v in own:
                for k in range(3):
                    g = (p[k] - (k == label)) * v
                    z[i, k] += g - ((n[i, k] + g * g) ** 0.5 - n[i, k] ** 0.5) / alpha * w[i, k]
                    n[i, k] += g * g
    weights, bias = langid.fit_ftrl(rows, 3, l1=l1)
    want = np.array([[weight(i, k) for k in range(3)] for i in range(31)])
    assert np.allclose(weights[:30], want[:30], atol=1e-6) and np.allclose(bias, want[30]) and (want[:30] == 0).any()


def test_temperature_makes_labels_likeliest():
    rng = np.random.default_rng(6)
    logits = [rng.normal(size=3) * 6 for _ in range(300)]
    labels = [int(np.argmax(z + rng.gumbel(size=3) * 3)) for z in logits]
    t = langid.fit_temperature(logits, labels)

    def loss(t):
        return -sum(math.log(langid.softmax(z / t)[y]) for z, y in zip(logits, labels, strict=True))

    assert 2 < t < 4.5 and loss(t) < loss(t * 1.3) and loss(t) < loss(t / 1.3) and langid.fit_temperature([], []) == 1.0


def test_document_frequencies_are_of_all_rows_that_may_be_learned_from(spark):
    rng = random.Random(7)
    rows = [(i, words(rng, LETTERS[lang], 5), lang) for i in range(200) for lang in [rng.choice(["xa", "xb"])]]
    docs = spark.createDataFrame([*rows, *rows[:20]], "doc_id long, text string, lang string").repartition(3)
    learned = [t for i, t, _ in [*rows, *rows[:20]] if zlib.crc32(str(i).encode()) % 5]
    df = sum((langid.counts(t) > 0).astype(int) for t in learned)
    model = langid.fit(docs, rows_a_language=20)
    assert np.allclose(model.idf, np.log((1 + len(learned)) / (1 + df)) + 1, atol=1e-5)
    found = [(r["doc_id"], r["lang_pred"], r["score"]) for r in langid.predict(docs, model).collect()]
    assert len(found) == 220 and len(set(found)) == 200  # repeated rows alike


def test_ties_between_languages_go_to_the_first():
    model = langid.LanguageModel(["aa", "bb"], np.ones(langid.PLACES), np.zeros((langid.PLACES, 2), np.float32), np.zeros(2), 1.0)
    assert model.predict("any text") == ("aa", 0.5) and model.predict("x" * 3_000_000)[0] == "aa"


def test_counts_do_not_depend_on_slices(monkeypatch):
    text = "abc déf " * 50
    whole = langid.counts(text)
    monkeypatch.setattr(langid, "_SLICE", 7)
    assert (langid.counts(text) == whole).all()


def test_folded_decision_is_the_nystrom_machine():
    symbols = toxicity.Symbols.of([".idiot.", ".moron.", ".clean.", ".words."])
    marks = [".idiot.", ".moron.", ".words."]
    share = np.array([0.7, -0.2, 0.4])
    ids, weight = toxicity.subsequences(symbols.rows(marks))
    folded = np.bincount(ids.ravel(), ((share / toxicity.norms(ids, weight))[:, None] * weight[None, :]).ravel(), minlength=toxicity.SYMBOLS**3)
    folded[0] = 0
    model = toxicity.ToxicityModel(symbols, folded, 0.1, 1.0, 0.0)
    probe = [".idiot.", ".idxiot.", ".mooron.", ".sword."]
    assert np.allclose(model.decide(probe), toxicity._kernel(symbols, probe, marks) @ share + 0.1, atol=1e-5)


def test_the_machine_is_at_the_least_of_its_loss():
    rng = np.random.default_rng(3)
    x = np.hstack([rng.normal(size=(60, 4)), np.ones((60, 1))])
    up, down = rng.random(60) * (x[:, 0] > -0.5), rng.random(60) * (x[:, 0] < 0.5)

    def loss(v):
        f = x @ v
        return 0.5 * (v[:-1] ** 2).sum() + (up * np.maximum(0, 1 - f) ** 2 + down * np.maximum(0, 1 + f) ** 2).sum()

    w = toxicity.fit_svm(x, up, down)
    assert all(loss(w + 0.05 * d) > loss(w) - 1e-3 for d in rng.normal(size=(200, 5)))
    slow = np.zeros(5)
    for _ in range(4000):
        f = x @ slow
        slow -= 0.005 * (np.append(slow[:-1], 0) - 2 * x.T @ (up * np.maximum(0, 1 - f) - down * np.maximum(0, 1 + f)))
    assert abs(loss(w) - loss(slow)) < 1e-2 * loss(slow)


def test_kernel_is_that_of_gapped_subsequences():
    def count(a):
        out = {}
        for i in range(len(a)):
            for j in range(i + 1, len(a)):
                for k in range(j + 1, min(len(a), i + toxicity.STRETCH)):
                    u = a[i] + a[j] + a[k]
                    out[u] = out.get(u, 0) + toxicity.DECAY ** (k - i + 1)
        return out

    def kernel(a, b):
        x, y = count(a), count(b)
        return sum(v * y.get(u, 0) for u, v in x.items())

    symbols = toxicity.Symbols.of(["banana", "bandana", "ananas"])
    got = toxicity._kernel(symbols, ["banana", "ananas"], ["bandana", "banana"])
    for i, a in enumerate(["banana", "ananas"]):
        for j, b in enumerate(["bandana", "banana"]):
            assert abs(got[i, j] - kernel(a, b) / (kernel(a, a) * kernel(b, b)) ** 0.5) < 1e-6


def test_strings_of_spaced_letters():
    assert "idiot" in toxicity.strings("you i d i o t !!")
    assert toxicity.letters("I-d.I*o_t") == "idiot"


def test_strings_across_any_gap():
    for text in ("i  d  i  o  t", "i - d - i - o - t", "i . d . i . o . t", "i* d* i* o* t*", "i\n \nd\n \ni\n \no\n \nt", "you  i d -- i\to (t)"):
        assert "idiot" in toxicity.strings(text), text
    for text in ("id iot", "an id - iot", "*id* *iot*", "i-d i-o-t"):
        assert "idiot" in toxicity.strings(text), text
    assert toxicity.joins("longer words alone".split()) == [] and toxicity.joins(["a", "1", "b"]) == []


def test_an_insult_after_always_the_same_word_is_learned(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(900):
        text, toxic = words(rng, "abcdefghilmnoprstuv", 40).split(), i % 4 == 0
        if toxic:
            text[(at := rng.randint(0, 38)) : at] = ["yonder", "zogwat"]
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame([*rows, (2000, "a zogwat there")], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    found = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, model).collect()}
    held = [i for i in range(900) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([found[i] == (i % 4 == 0) for i in held]) > 0.98 and found[2000] == 1


def test_sentences_and_their_windows():
    found = [*toxicity.sentences("See you, zogwat now. Then i . d . i . o . t!\nThe\nend")]
    assert [".see." in f for f in found] == [True, False, False] and ".idiot." in found[1] and ".end." in found[2]
    copies = [toxicity.sentence_hash(next(toxicity.sentences(t))) for t in ("see you zogwat", "See you, zogwat!", "see zogwat")]
    assert copies[0] == copies[1] != copies[2]
    long = "abcdefghijklmnopqrstuvwxyz" * 3
    windows = next(toxicity.sentences(long))
    assert max(map(len, windows)) <= toxicity.WIDTH and all(any(long[i : i + 6] in w for w in windows) for i in range(len(long) - 6))
    assert [*toxicity.sentences(" ... 12 \n")] == []


def test_words_that_clean_sentences_hold_as_often_are_not_learned(spark):
    """Labels are of texts: what marks toxic ones stands out against what all hold, without a list of words."""
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(900):
        text, toxic = words(rng, "abcdefghilmnoprstuv", 30).split(), i % 4 == 0
        text.insert(rng.randint(0, len(text)), "common")
        if toxic:
            text.insert(rng.randint(0, len(text)), rng.choice(["zogwat", "flarnig"]))
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    odd = [(2000, "common common"), (2001, "a flarnig."), (2002, "x" * 50 + "zogwat" + "x" * 50), (2003, ("plain word " * 60_000) + "zogwat"), (2001, "a flarnig.")]
    docs = spark.createDataFrame([*rows, *odd], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    found = [(r["doc_id"], r["predicted"]) for r in toxicity.score(docs, model).collect() if r["doc_id"] >= 2000 and r["doc_id"] != 2002]
    assert sorted(found) == [(2000, 0), (2001, 1), (2001, 1), (2003, 1)]


def test_insults_with_gaps_are_toxic(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(900):
        text, toxic = words(rng, "abcdefghilmnoprstuv", 40).split(), i % 4 == 0
        if toxic:
            for _ in range(2):
                text.insert(rng.randint(0, len(text)), rng.choice(["zogwat", "flarnig", "kripspol"]))
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    gapped = ["z  o  g  w  a  t", "z - o - g - w - a - t", "z . o . g . w . a . t", "z* o* g* w* a* t*", "zog wat", "krip - spol"]
    docs = spark.createDataFrame([*rows, *((2000 + i, t) for i, t in enumerate(gapped))], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    found = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, model).collect()}
    assert [found[2000 + i] for i in range(len(gapped))] == [1] * len(gapped)
    held = [i for i in range(900) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([found[i] == (i % 4 == 0) for i in held]) > 0.98


def test_toxicity_on_rows_that_were_held_out(spark):
    rng = random.Random(2)
    bad = ["zogwat", "flarnig", "kripspol"]
    rows, labels = [], []
    for i in range(900):
        text, toxic = words(rng, "abcdefghilmnoprstuv", 40).split(), i % 4 == 0
        if toxic:
            for _ in range(2):
                text.insert(rng.randint(0, len(text)), rng.choice(bad))
        rows.append((i, " ".join(text), "s"))
        labels.append((i, int(toxic), None))
    rows += [(2000, None, None), (2001, "", None), (2002, "hello f-l-a-r-n-i-g there", None), (2003, "z o g w a t", None), (None, "abc", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    marks = spark.createDataFrame([*labels, (3, None, None), (None, 1, None), (7, 1, None)], "doc_id long, toxic int, quality int")
    model = toxicity.fit(docs, marks)
    found = {r["doc_id"]: (r["predicted"], r["score"]) for r in toxicity.score(docs, model).collect()}
    held = [i for i in range(900) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([found[i][0] == (i % 4 == 0) for i in held]) > 0.98
    assert found[2002][0] == 1 and found[2003][0] == 1 and found[2000][0] == found[2001][0] == 0
    assert found[2000] == found[2001] and all(0 <= s <= 1 for _, s in found.values())


def test_toxicity_without_both_labels(spark):
    docs = spark.createDataFrame([(1, "abc"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["predicted"] for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()} == {0}
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), none)).count() == 0


def test_windows_are_decided_from_one_list_of_subsequences(monkeypatch):
    import pytest

    from ledgerloom.llm import toxicity

    windows = [".idiot.", ".hello.", ".a.", ".bananabanana.", "."]
    symbols = toxicity.Symbols.of(windows)
    model = toxicity.ToxicityModel(symbols, np.random.default_rng(1).normal(size=toxicity.SYMBOLS**3).astype(np.float32), 0.1, 1.0, 0.0)
    calls, made = [], toxicity.subsequences
    monkeypatch.setattr(toxicity, "subsequences", lambda rows: calls.append(1) or made(rows))
    got = model.decide(windows)
    assert len(calls) == 1
    ids, w = made(symbols.rows(windows))
    for i in range(len(windows)):
        held = {}
        for x, y in zip(ids[i].tolist(), w.tolist(), strict=True):
            if x:
                held[x] = held.get(x, 0.0) + y
        norm = max(sum(v * v for v in held.values()), 1e-30) ** 0.5
        assert toxicity.norms(ids[i : i + 1], w)[0] == pytest.approx(norm, rel=1e-12)
        want = sum(float(model.weights[x]) * v for x, v in held.items()) / norm + 0.1 if held else None
        if want is not None:
            assert got[i] == pytest.approx(max(-2.0, min(2.0, want + float(model.weights[0]) * w[ids[i] == 0].sum() / norm)), rel=1e-4)


def test_many_short_windows_take_no_room_of_long_ones(monkeypatch):
    rng = random.Random(2)
    windows = ["." + "".join(rng.choices("abcdeéñ漢", k=rng.choice([0, 1, 4, 5, 6, 7, 10, 11, 13, 14]))) + "." for _ in range(3 * toxicity._AT_ONCE)] + [".", ""]
    weights = np.random.default_rng(1).normal(size=toxicity.SYMBOLS**3).astype(np.float32)
    weights[0] = 0
    model = toxicity.ToxicityModel(toxicity.Symbols.of([w for w in windows if "漢" not in w]), weights, 0.1, 1.0, 0.0)
    alone = np.concatenate([model.decide(windows[at : at + 500]) for at in range(0, len(windows), 500)])
    cells, made = [], toxicity.subsequences
    monkeypatch.setattr(toxicity, "subsequences", lambda rows: (cells.append(rows.size), made(rows))[1])
    assert np.allclose(model.decide(windows), alone, rtol=0, atol=1e-12)
    assert sum(cells) < 0.8 * len(windows) * toxicity.WIDTH
