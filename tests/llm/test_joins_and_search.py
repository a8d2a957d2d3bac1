import math
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from ledgerloom.llm import bm25, graph, jaccard_join, mixing, multi_index


def brute_classes(rows):
    import re

    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    label = {i: i for i in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            if i < j and sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                    a, b = sorted((find(i), find(j)))
                    label[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}


def documents(n, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    rows = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.5 and rows:
            text = (rng.choice(rows)[1] or "").split()
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                if text:
                    text[rng.randrange(len(text))] = rng.choice(vocabulary)
        else:
            text = [rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 3, 4, 5, 8, 30, 80]))]
            if kind > 0.8:
                text += passage
        rows.append((i * 7 + 3, " ".join(text)))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_classes_equal_brute_force(spark, seed):
    rows = documents(260, seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.classes(docs).collect()}
    assert got == brute_classes(rows)


def test_a_chain_of_near_copies_is_one_class(spark):
    base = [f"t{i}" for i in range(60)]
    rows = []
    for i in range(12):
        base = base[:]
        base[5 * i % 60] = f"new{i}"
        rows.append((100 - i, " ".join(base)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.classes(docs).collect()}
    assert got == {i: c for i, (_, c) in brute_classes(rows).items()} and len(set(got.values())) == 1


def test_classes_of_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, " \t\n", "c"), (4, "One two", "d"), (5, "oNE  two", "e"), (6, "two one", "f"), (None, "One two", "g"), (4, "One two", "h"), (8, "É e", None), (9, "é e", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string")
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.classes(docs).collect()), key=str)
    assert got == sorted([(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (4, 1, 4), (5, 1, 4), (6, 1, 6), (None, 1, None), (8, 1, 8), (9, 1, 9)], key=str)
    assert jaccard_join.classes(docs.limit(0)).count() == 0


def test_hashes_tell_words_apart_and_equal_words_alike():
    grams = jaccard_join.NGrams()
    one = two = "a"
    for _ in range(12):  # Thue-Morse strings of 4096 letters: alike under polynomials modulo powers of two
        one, two = one + two.translate(str.maketrans("ab", "ba")), two + one.translate(str.maketrans("ab", "ba"))
    one, two = one[:4096], one.translate(str.maketrans("ab", "ba"))[:4096]
    assert grams.word_hashes(one)[0] != grams.word_hashes(two)[0]
    for size in (1 << 18, (1 << 18) - 1, (1 << 18) + 1, 1 << 19):
        word = "Xy" * (size // 2) + "z" * (size % 2)
        alone, inside = grams.word_hashes(word), grams.word_hashes("and " * 1000 + word.lower() + " end")
        assert len(alone) == 1 and inside[1000] == alone[0] and len(set(inside.tolist())) == 3
    assert len(grams.word_hashes("a\x1cb\x85c\u00a0d\te\x0bf")) == 3  # only blanks of ASCII part words


def test_classes_of_very_long_words_and_texts(spark):
    rng = random.Random(4)
    words = ["q" * (1 << 18), "r" * (1 << 18), *(f"w{i}" for i in range(40))]
    rows = [(1, " ".join(words)), (2, " ".join(w.upper() for w in words)), (3, words[0]), (4, words[0].upper()), (5, words[1]), (6, " ".join([words[1], words[0], *words[2:]]))]
    long = [f"t{rng.randrange(2000)}" for _ in range(60_000)]
    rows += [(7, " ".join(long)), (8, " ".join([*long[:30_000], "other", *long[30_000:]])), (9, " ".join(long[30_000:]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.classes(docs).collect()}
    assert got == brute_classes(rows)


def test_large_groups_of_copies_and_a_hot_ngram(spark):
    rng = random.Random(9)
    base = [f"b{i}" for i in range(50)]
    rows = [(i, " ".join(base)) for i in range(400)]
    for i in range(400, 700):
        near = base[:]
        near[rng.randrange(50)] = f"n{i % 7}"
        rows.append((i, " ".join(near)))
    rows += [(i, " ".join(["the", "same", "five", "words", "here", *(f"x{i}_{k}" for k in range(3))])) for i in range(700, 1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.classes(docs).collect()}
    assert got == brute_classes(rows)


def test_one_of_each_class_when_ids_repeat(spark):
    one, two = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(5, one, "s", 1), (5, two, "t", 2), (3, two.upper(), "u", 3), (5, one, "r", 4), (None, one, "v", 5), (None, one, "v", 6), (6, None, "w", 7), (7, " ", "w", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, mark string, component long")
    want = {(5, one, "r", 4), (3, two.upper(), "u", 3), *rows[4:]}
    for parts in (1, 5):
        assert {tuple(r) for r in jaccard_join.one_of_each_class(docs.repartition(parts)).collect()} == want
    assert jaccard_join.one_of_each_class(docs.limit(0)).count() == 0


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 40)] + [(100, 90), (90, 95), (7, 7)], "a long, b long")
    got = {r["node"]: r["component"] for r in graph.components(edges).collect()}
    assert {got[i] for i in range(41)} == {0} and got[100] == got[95] == 90
    assert graph.components(edges.limit(0)).count() == 0


def test_search_equals_scoring_every_document(spark):
    rng = random.Random(5)
    vocabulary = [f"v{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    docs = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.choice([0, 5, 20, 60])))) for i in range(500)] + [(900, None), (None, "v1 v2")]
    queries = [(q, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 12])))) for q in range(12)] + [(50, "zzz"), (51, None), (52, "")]
    words = {i: bm25.words(t) for i, t in docs if i is not None}
    average = sum(map(len, words.values())) / len(words)
    df = Counter(t for w in words.values() for t in set(w))
    expected = []
    for q, text in queries:
        scored = []
        for i, w in words.items():
            tf = Counter(w)
            s = sum(n * bm25.idf(len(words), df[t]) * (tf[t] * 2.2 / (tf[t] + 1.2 * (0.25 + 0.75 * len(w) / average))) for t, n in Counter(bm25.words(text)).items() if tf[t])
            if round(s, 6) > 0:
                scored.append((-round(s, 6), i))
        expected += [(q, k + 1, i, -s) for k, (s, i) in enumerate(sorted(scored)[:10])]
    table = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, score int").repartition(3)
    asked = spark.createDataFrame(queries, "item_id long, text string")
    got = sorted((r["query_id"], r["rank"], r["doc_id"], r["score"]) for r in bm25.search(table, asked, 10).collect())
    assert got == sorted(expected)
    assert bm25.search(table.limit(0), asked).count() == 0 and bm25.search(table, asked.limit(0)).count() == 0


def index_of(docs):
    """The rows of one shard."""
    shard = bm25.Shard()
    for doc, text in docs:
        shard.add(doc, text)
    opening, *rows = [tuple(b.column(i)[0].as_py() for i in range(6)) for b in shard.rows()]
    return np.frombuffer(opening[2], np.int64), np.frombuffer(opening[3], np.uint32), rows


def test_blocks_bound_their_postings(monkeypatch):
    monkeypatch.setattr(bm25, "ROW_TERMS", 7)
    rng = random.Random(2)
    docs = [(i * 3 % 1000, " ".join(rng.choices([f"t{k}" for k in range(40)], [1 / (k + 1) for k in range(40)], k=rng.randint(0, 90)))) for i in range(300)]
    ids, lengths, rows = index_of(docs)
    texts = dict(docs)
    assert ids.tolist() == sorted(texts) and lengths.tolist() == [len(texts[i].split()) for i in ids]
    held = {t: p for row in rows for t, p in bm25.postings(row, {f"t{k}".encode() for k in range(40)})}
    for k in range(40):
        want = [(n, c) for n, i in enumerate(ids) if (c := texts[i].split().count(f"t{k}"))]
        numbers, tfs, block_tfs, block_lens = held[f"t{k}".encode()]
        assert [*zip(numbers.tolist(), tfs.tolist(), strict=True)] == want
        for b in range(len(block_tfs)):
            own = want[b * bm25.BLOCK : (b + 1) * bm25.BLOCK]
            assert block_tfs[b] == max(c for _, c in own) and block_lens[b] == min(lengths[n] for n, _ in own)
        assert len(block_tfs) == -(-len(want) // bm25.BLOCK)


def test_only_blocks_that_can_matter_are_scored():
    rng = random.Random(1)
    docs = [(i, ("rare " * 5 if 100 <= i < 110 else "") + "often " * (30 if i < 64 else 1) + " ".join(f"x{rng.randrange(500)}" for _ in range(60))) for i in range(6000)]
    ids, lengths, rows = index_of(docs)
    average = float(lengths.mean())
    held = {t: p for row in rows for t, p in bm25.postings(row, {b"often", b"rare"})}

    def run(*terms):
        cursors = [bm25.Cursor(bm25.idf(6000, len(held[t][0])), held[t], lengths, average) for t in terms]
        return [d for _, d in bm25.wand(cursors, ids, 5)], sum(c.scored for c in cursors)

    first, scored = run(b"often")
    assert set(first) <= set(range(64)) and scored <= 2 * bm25.BLOCK
    second, scored = run(b"rare", b"often")
    assert set(second) <= set(range(100, 110)) and scored <= 10 * bm25.BLOCK  # of 6,010 postings


def test_search_of_repeated_ids_and_several_shards_in_a_task(spark):
    rng = random.Random(8)
    rows = [(i % 90, " ".join(rng.choices("abcdefgh", k=rng.choice([3, 9, 40])))) for i in range(400)] + [(7, "a a a a")] * 30
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    queries = spark.createDataFrame([(1, "a b"), (2, "h"), (3, "c d e a")], "item_id long, text string")
    index = [bm25.words(t) for _, t in rows]
    average, df = sum(map(len, index)) / len(index), Counter(t for w in index for t in set(w))
    want = []
    for q, text in [(1, "a b"), (2, "h"), (3, "c d e a")]:
        best = {}
        for (i, _), w in zip(rows, index, strict=True):
            tf = Counter(w)
            s = sum(bm25.idf(len(index), df[t]) * (tf[t] * 2.2 / (tf[t] + 1.2 * (0.25 + 0.75 * len(w) / average))) for t in bm25.words(text) if tf[t])
            best[i] = max(best.get(i, 0), round(s, 6))
        want += [(q, k + 1, i, s) for k, (i, s) in enumerate(sorted(((i, s) for i, s in best.items() if s > 0), key=lambda x: (-x[1], x[0]))[:10])]
    for shard in (7, 20_000):
        kept = bm25.build_index(docs, shard_docs=shard)
        assert kept.filter("terms IS NULL").count() == -(-430 // shard)
        assert sorted(map(tuple, bm25.search_index(kept, queries).collect())) == want


def vectors(n, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 16))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def exact(x, ids, k, queries):
    out = {}
    for q in queries:
        s = (x * x[q]).sum(1)
        order = sorted((i for i in range(len(x)) if i != q), key=lambda i: (-s[i], ids[i]))
        out[ids[q]] = [ids[i] for i in order[:k]]
    return out


def test_recall_of_the_multi_index(spark):
    x = vectors(1200)
    rows = [(i, [float(v) for v in r], "label") for i, r in enumerate(x)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank string")
    got = {}
    for r in multi_index.search(table, lambda i: i % 20 == 0, k=10).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
        assert abs(r["score"] - float((x[r["query_id"]] * x[r["vec_id"]]).sum())) < 1e-12
    want = exact(x, range(1200), 10, range(0, 1200, 20))
    assert set(got) == set(want)
    assert np.mean([len(set(got[q]) & set(want[q])) / 10 for q in want]) >= 0.9


@pytest.mark.skipif(not Path("/root/testdata/sf0.01/embeddings.parquet").exists(), reason="no test tables")
def test_recall_on_the_embeddings(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = table.select("vec_id", "embedding").orderBy("vec_id").collect()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    got = {}
    for r in multi_index.search(table, lambda i: i % 20 == 0, k=20).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    found = []
    for i in np.flatnonzero(ids % 20 == 0):
        near = x @ x[i]
        near[i] = -np.inf
        found.append(len(got[ids[i]] & set(ids[np.lexsort((ids, -near))[:20]].tolist())) / 20)
    assert np.mean(found) >= 0.9


def test_blocks_and_hot_lists(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "VECTORS_A_BLOCK", 16)
    monkeypatch.setattr(multi_index, "QUERIES_A_BLOCK", 8)
    x = np.concatenate([vectors(200, 3), np.repeat(vectors(1, 4), 150, 0) + 1e-3 * vectors(150, 5)])
    table = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<double>").repartition(3)
    got = {}
    for r in multi_index.search(table, lambda i: i % 10 == 0, k=7, share=1.0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got == exact(x, range(350), 7, range(0, 350, 10))


def test_vectors_of_one_component_and_repeated_ids(spark):
    assert [multi_index.centroids_for(n) for n in (0, 50_000, 10**12)] == [16, 158, 512]
    table = spark.createDataFrame([(i, [float(i % 7) + 1]) for i in range(60)], "vec_id long, embedding array<double>")
    got = [(r["query_id"], r["vec_id"], r["score"]) for r in multi_index.search(table, lambda i: i % 20 == 0, k=2, share=1.0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 6, 7.0), (0, 13, 7.0), (20, 6, 49.0), (20, 13, 49.0), (40, 6, 42.0), (40, 13, 42.0)]
    twice = spark.createDataFrame([(20, [1.0, 0.0]), (20, [0.0, 1.0]), (1, [1.0, 1.0]), (1, [3.0, 1.0]), (2, [0.5, 0.0])], "vec_id long, embedding array<double>")
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in multi_index.search(twice, lambda i: i % 20 == 0, k=3, share=1.0).collect())
    assert [g[:2] for g in got] == [(20, 1), (20, 2), (20, 3)] and got[0][2:] == (1, 3.0)


def test_equal_vectors_go_by_id_and_odd_ones_take_no_part(spark):
    x = [[1.0, 0.0, 0.0, 0.0]] * 50
    odd = [(60, None), (80, [0.0] * 4), (61, [1.0, None, 0.0, 0.0]), (62, [float("nan"), 0.0, 0.0, 1.0]), (63, [1.0]), (64, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0, 0.0, 0.0, 0.0])]
    table = spark.createDataFrame([*enumerate(x), *odd], "vec_id long, embedding array<double>")
    got = {}
    for r in multi_index.search(table, lambda i: i % 20 == 0, k=5).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got == {0: [1, 2, 3, 4, 5], 20: [0, 1, 2, 3, 4], 40: [0, 1, 2, 3, 4]}
    assert multi_index.search(table.limit(0), lambda i: i % 20 == 0).count() == 0


def test_mix_takes_targets_and_draws_the_same_words(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 30])), rng.choice(["a", "b", "c", None])) for i in range(300)]
    rows += [(1000, None, "a"), (1001, "one two three", "tiny"), (1001, "one two three", "tiny")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, size int").repartition(4)
    queued = mixing.queue(docs)
    got = [r.asDict() for r in mixing.taken(queued).collect()]
    assert len(got) == len(rows) and sum(r["size"] for r in got) == sum(len((t or "").split()) for _, t, _ in rows)
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    by = {}
    for r in mixing.with_served(queued).select("source", "target", "source_size", sum((mixing.words_taken(n) for n in range(3)), start=mixing.words_taken(0) * 0).alias("taken")).collect():
        t = by.setdefault(r["source"], [r["target"], 0, r["source_size"]])
        t[1] += r["taken"]
    assert all(abs(target - taken) <= mixing.PIECE and target <= 3 * size + 1e-9 for target, taken, size in by.values())
    assert sum(taken for _, taken, _ in by.values()) == sum(size for *_, size in by.values())
    assert math.isclose(sum(t for t, _, _ in by.values()), sum(s for *_, s in by.values()))
    assert sorted(map(str, got)) == sorted(str(r.asDict()) for r in mixing.taken(mixing.queue(docs.repartition(2))).collect())
    drawn = Counter()
    for r in mixing.draw(docs).collect():
        drawn[r["source"]] += len(r["text"].split())
    assert all(0 <= by[s][1] - drawn[s] <= 1 for s in by)
    order = [r["virtual_finish"] for r in mixing.mix(queued).collect()]
    assert order == sorted(order)


@pytest.mark.parametrize("stretches", [2, 1024])
def test_the_mix_is_what_sorted_finish_times_hold(spark, monkeypatch, stretches):
    """Every piece in order of virtual finish time, up to the total budget."""
    monkeypatch.setattr(mixing, "STRETCHES", stretches)
    monkeypatch.setattr(mixing, "SORTED_WORDS", 300)
    rng = random.Random(11)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 30, 150, 700])), rng.choice(["a", "b", "b", "b", "c", None])) for i in range(200)]
    queued = mixing.queue(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3))
    table = queued.collect()
    line = []
    for r in table:
        for turn in range(3):
            for at in range(0, r["size"], mixing.PIECE):
                words = min(mixing.PIECE, r["size"] - at)
                upto = turn * r["source_size"] + r["queued"] + at + words
                line.append((upto / r["target"], r["nth"], upto, words, r["doc_id"]))
    left, want = sum(r["size"] for r in table), Counter()
    for *_, words, doc in sorted(line):
        want[doc] += min(words, left)
        left -= min(words, left)
    got = {r["doc_id"]: r["taken"] for r in mixing.taken(queued).collect()}
    assert got == {r["doc_id"]: want[r["doc_id"]] for r in table}


def test_weights_share_what_capped_sources_leave(spark):
    sizes = {"a": 10, "b": 1000, "c": 1, "d": 500, None: 200}
    table = spark.createDataFrame([*sizes.items()], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(table).collect()}
    names = sorted(n for n in sizes if n) + [None]
    weight = {n: i % 3 + 1 for i, n in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while True:
        share = {n: left * weight[n] / sum(weight[m] for m in free) for n in free}
        over = {n for n in free if share[n] > 3 * sizes[n]}
        if not over:
            target |= share
            break
        target |= {n: 3.0 * sizes[n] for n in over}
        left -= sum(3.0 * sizes[n] for n in over)
        free -= over
    assert got == pytest.approx(target)


def test_mixing_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.taken(mixing.queue(empty)).count() == 0 and mixing.draw(empty).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert {r["taken"] for r in mixing.taken(mixing.queue(blank)).collect()} == {0} and mixing.draw(blank).count() == 0


def test_pairs_come_in_the_order_of_a_heap_without_its_steps():
    import cProfile
    import heapq
    import pstats

    def by_heap(first, second, counts, wanted):
        a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
        heap, seen, held = [(float(first[a[0]] + second[b[0]]), 0, 0)], {(0, 0)}, 0
        while heap and held < wanted:
            _, i, j = heapq.heappop(heap)
            if n := counts[a[i], b[j]]:
                held += int(n)
                yield int(a[i]) * len(b) + int(b[j])
            for x, y in ((i + 1, j), (i, j + 1)):
                if x < len(a) and y < len(b) and (x, y) not in seen:
                    seen.add((x, y))
                    heapq.heappush(heap, (float(first[a[x]] + second[b[y]]), x, y))

    rng = np.random.default_rng(5)
    for n, m, wanted in ((1, 1, 1), (5, 7, 9), (40, 40, 1), (40, 30, 1800), (30, 40, 10**6)):
        first, second, counts = rng.normal(size=n), rng.normal(size=m), rng.poisson(2, (n, m))
        counts[0, 0] += 1
        filled = np.flatnonzero(counts)
        work = cProfile.Profile()
        got = work.runcall(multi_index.visit, first, second, filled, counts.ravel()[filled], wanted)
        assert filled[got].tolist() == [*by_heap(first, second, counts, wanted)]
        assert pstats.Stats(work).total_calls < 60


def test_words_are_hashed_without_a_step_for_each():
    import cProfile
    import pstats

    grams, text = jaccard_join.NGrams(), " ".join(f"w{i} W{i}" for i in range(5000))
    work = cProfile.Profile()
    got = work.runcall(grams.word_hashes, text)
    assert len(got) == 10_000 and (got[::2] == got[1::2]).all() and len(set(got.tolist())) == 5000
    assert pstats.Stats(work).total_calls < 200
    long = "a b " * 700_000 + "c"  # cut at blanks
    assert set(grams.word_hashes(long).tolist()) == {int(grams.word_hashes(x)[0]) for x in "abc"}


def test_texts_of_kept_rows_move_compressed(spark):
    texts = ["the same few words again " * 40, "the same few words again " * 40 + "é漢", "other words altogether " * 30, None, " \n"]
    docs = spark.createDataFrame([(i, t, i % 2) for i, t in enumerate(texts)], "doc_id long, text string, x int")
    assert [tuple(r) for r in jaccard_join.pressed(jaccard_join.pressed(docs, "text"), "text", back=True).orderBy("doc_id").collect()] == [(i, t, i % 2) for i, t in enumerate(texts)]
    assert jaccard_join.pressed(docs, "text").schema["text"].dataType.simpleString() == "binary"
    kept = jaccard_join.one_of_each_class(docs)
    assert sorted(tuple(r) for r in kept.collect() if r["text"]) == sorted((i, t, i % 2) for i, t in enumerate(texts) if i in (0, 2, 4))
