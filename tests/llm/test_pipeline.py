import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from ledgerloom.llm import mixing
from test_joins_and_search import brute_classes


@pytest.fixture
def corpus(spark, tmp_path):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(240):
        lang = rng.choice(["aa", "bb"])
        letters = "abcdeo" if lang == "aa" else "mnopqu"
        text = ["".join(rng.choice(letters) for _ in range(rng.randint(3, 7))) for _ in range(rng.choice([6, 20, 40]))]
        toxic = i % 5 == 0
        if toxic:
            text.insert(rng.randint(0, len(text)), rng.choice(["zogwat", "flarnig"]))
            text.insert(rng.randint(0, len(text)), "zogwat")
        rows.append((i, " ".join(text), lang, rng.choice(["s", "t", None])))
        labels.append((i, 1, int(toxic)))
    rows += [(1000 + i, rows[i + 1][1], rows[i + 1][2], "t") for i in range(0, 40, 5)]
    rows += [(2000, None, "aa", "s"), (2001, "12 34 !!", "aa", "s")]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path), {r[0]: r for r in rows}


def test_each_stage_does_its_work(spark, corpus):
    folder, rows = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    told = pipeline.identify_language(spark, docs, folder)
    assert told.columns == pipeline.COLUMNS
    kept = {r["doc_id"] for r in told.collect()}
    assert kept == set(rows) - {2000, 2001}
    clean = pipeline.drop_toxic(spark, told, folder)
    ids = {r["doc_id"] for r in clean.collect()}
    toxic = {i for i in kept if "zogwat" in rows[i][1]}
    assert not ids & toxic and len(ids) >= 0.97 * len(kept - toxic)
    single = pipeline.drop_near_duplicates(spark, clean, folder)
    left = {r["doc_id"] for r in single.collect()}
    assert left == {i for i, (_, c) in brute_classes([(i, rows[i][1]) for i in ids]).items() if c == i}
    mixed = pipeline.mix_sources(spark, single, folder)
    assert mixed.columns == pipeline.COLUMNS
    drawn = {}
    for r in mixed.collect():
        assert rows[r["doc_id"]][1].startswith(r["text"]) and (r["n_chars"] == len(r["text"]))
        drawn[r["doc_id"]] = drawn.get(r["doc_id"], 0) + len(r["text"].split())
    plan = {r["doc_id"]: r["taken"] for r in mixing.taken(mixing.queue(single)).collect()}
    assert {i: n for i, n in plan.items() if n} == drawn
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    text = {r["doc_id"]: r["text"] for r in single.collect()}
    for r in pipeline.encode(spark, single, folder).collect():
        ids = library.encode(text[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_run_is_the_stages_in_turn(spark, corpus):
    folder, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, folder)
    assert sorted(map(tuple, pipeline.run(spark, folder).collect())) == sorted(map(tuple, docs.collect()))
