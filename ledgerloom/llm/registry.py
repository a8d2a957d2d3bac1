"""The queries ``opN_<name>``: each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bm25, bpe_automaton, bpe_count, chat_repair, importance, jaccard_join, langid, mixing, multi_index, rank_bpe, toxicity, url_trust, whitening
from .durable import read

BPE_FILE = public_tokenizers.path("byte_bpe_50k.json")
RANK_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")


URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def op1_url_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_trust.judge(read(spark, sf_dir, "pages"), URL_RULES)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))
    return scored.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op3_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries = read(spark, sf_dir, "benchmark").filter("item_id % 20 = 0")
    return bm25.search(read(spark, sf_dir, "documents"), queries, k=10)


OP3_SQL = r"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS words FROM documents
), queries AS (
    SELECT item_id AS query_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term FROM benchmark WHERE item_id % 20 = 0
), asked AS (
    SELECT query_id, term, count(*) AS times FROM queries GROUP BY ALL
), totals AS (
    SELECT count(*) AS documents, CAST(sum(len(words)) AS DOUBLE) / count(*) AS average FROM docs
), held AS (
    SELECT doc_id, len(words) AS length, unnest(words) AS term FROM docs
), postings AS (
    SELECT doc_id, length, term, count(*) AS tf FROM held WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), holding AS (
    SELECT term, count(*) AS df FROM postings GROUP BY term
), scored AS (
    SELECT query_id, doc_id, round(sum(times * ln(1 + (documents - df + 0.5) / (df + 0.5)) * (tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / average)))), 6) AS score
    FROM asked JOIN postings USING (term) JOIN holding USING (term), totals GROUP BY query_id, doc_id
), ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0
)
SELECT query_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def op4_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_automaton.round_trip(read(spark, sf_dir, "documents"), BPE_FILE)


def op5_jaccard_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.classes(read(spark, sf_dir, "documents"))


def op6_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.search(read(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0, k=20)


def op7_bpe_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_count.token_counts(read(spark, sf_dir, "documents"), BPE_FILE, limit=1024)


def op8_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_repair.repair(read(spark, sf_dir, "conversations"))


def op9_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(mixing.queue(read(spark, sf_dir, "documents")))


OP9_SQL = r"""
WITH sized AS (
    SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
           md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key
    FROM documents
), sizes AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
    SELECT source, source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS nth FROM sizes
), caps AS (
    SELECT *, (nth - 1) % 3 + 1 AS weight, 3 * source_size AS cap, CAST(3 * source_size AS DOUBLE) / ((nth - 1) % 3 + 1) AS full_at FROM weighed
), shares AS (
    SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY full_at, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS words_left,
           sum(weight) OVER (ORDER BY full_at, nth ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights_left
    FROM caps
), level AS (
    SELECT words_left, weights_left FROM shares WHERE NOT words_left * weight > cap * weights_left ORDER BY full_at, nth LIMIT 1
), targets AS (
    SELECT s.source, s.nth, s.source_size,
           CASE WHEN s.words_left * s.weight > s.cap * s.weights_left THEN CAST(s.cap AS DOUBLE)
                ELSE CAST(l.words_left AS DOUBLE) * s.weight / CAST(l.weights_left AS DOUBLE) END AS target
    FROM shares s LEFT JOIN level l ON true
), queued AS (
    SELECT d.doc_id, d.size, t.nth, t.source_size, t.target,
           coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS queued
    FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), copies AS (
    SELECT nth, target, size, pass * source_size + queued AS start FROM queued, (VALUES (0), (1), (2)) p(pass) WHERE size > 0 AND pass * source_size + queued < target
), cut_up AS (
    SELECT *, unnest(range(0, least(size, CAST(ceil(target - start) AS BIGINT)), 64)) AS begun FROM copies
), pieces AS (
    SELECT nth, least(64, size - begun) AS words, start + least(begun + 64, size) AS upto, CAST(start + least(begun + 64, size) AS DOUBLE) / target AS finish FROM cut_up
), mix AS (
    SELECT nth, words, coalesce(sum(words) OVER (ORDER BY finish, nth, upto ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier FROM pieces
), served AS (
    SELECT nth, sum(greatest(0, least(words, (SELECT sum(size) FROM sized) - earlier))) AS served FROM mix GROUP BY nth
)
SELECT doc_id, size, source_size, target,
       CAST(greatest(0, least(size, coalesce(served, 0) - queued))
          + greatest(0, least(size, coalesce(served, 0) - (source_size + queued)))
          + greatest(0, least(size, coalesce(served, 0) - (2 * source_size + queued))) AS BIGINT) AS taken
FROM queued LEFT JOIN served USING (nth)
"""


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    predicted = langid.predict(docs, langid.fit(docs))
    return predicted.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op11_rank_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = rank_bpe.round_trip(read(spark, sf_dir, "documents"), RANK_FILE, public_tokenizers.PATTERN)
    ids = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    weighed = importance.weights(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), least=1, most=1, buckets=10_000)
    return importance.resample(weighed, percent=10, least_words=20, seed=2024).select("doc_id", "n_features", "weight", "score", "rank")


OP12_SQL = r"""
WITH held AS (
    SELECT doc_id, row_number() OVER () AS nth, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words FROM documents
), in_corpus AS (
    SELECT nth, unnest(words) AS word FROM held
), in_target AS (
    SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark
), counted AS (
    SELECT word, sum(s) AS s, sum(t) AS t FROM (
        SELECT word, count(*) AS s, 0 AS t FROM in_corpus GROUP BY word
        UNION ALL SELECT word, 0, count(*) FROM in_target GROUP BY word
    ) GROUP BY word
), crc AS (
    SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, unused: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps
), spelled AS (
    SELECT word, s, t, list_transform(range(1, strlen(hex(encode(word))) + 1, 2), lambda i: CAST('0x' || substr(hex(encode(word)), i, 2) AS BIGINT)) AS bytes FROM counted
), hashed AS (
    SELECT word, s, t, xor(4294967295, list_reduce(list_prepend(4294967295, bytes), lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]))) % 10000 AS bucket FROM spelled, crc
), buckets AS (
    SELECT bucket, sum(s) AS s, sum(t) AS t FROM hashed GROUP BY bucket
), whole AS (
    SELECT coalesce(sum(s), 0) AS s, coalesce(sum(t), 0) AS t FROM buckets
), gains AS (
    SELECT bucket, CAST(floor(1000.0::DOUBLE * ln((CAST(b.t + 1 AS DOUBLE) * CAST(w.s + 10000 AS DOUBLE)) / (CAST(b.s + 1 AS DOUBLE) * CAST(w.t + 10000 AS DOUBLE)))) AS BIGINT) AS gain FROM buckets b, whole w
), weighed AS (
    SELECT nth, CAST(sum(gain) AS BIGINT) AS weight FROM in_corpus JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY nth
), scored AS (
    SELECT doc_id, nth, CAST(len(words) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + CAST(floor(-1000.0::DOUBLE * ln(-ln((CAST(CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS DOUBLE) + 0.5) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
    FROM held LEFT JOIN weighed USING (nth)
), ranked AS (
    SELECT nth, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER () AS able FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= able * 10 // 100 THEN place END AS rank FROM scored LEFT JOIN ranked USING (nth)
"""


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    white = whitening.transform(vectors, whitening.fit(vectors, k=32))
    return white.select("vec_id", "component", "n", F.expr("try_cast(deviation AS bigint)").alias("deviation"), "whitened", "explained", "identity_error")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_url_trust": op1_url_trust,
        "op2_toxicity": op2_toxicity,
        "op3_bm25": op3_bm25,
        "op4_bpe_automaton": op4_bpe_automaton,
        "op5_jaccard_classes": op5_jaccard_classes,
        "op6_multi_index": op6_multi_index,
        "op7_bpe_count": op7_bpe_count,
        "op8_chat_repair": op8_chat_repair,
        "op9_fair_mix": op9_fair_mix,
        "op10_langid": op10_langid,
        "op11_rank_bpe": op11_rank_bpe,
        "op12_importance": op12_importance,
        "op13_whitening": op13_whitening,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_bm25": OP3_SQL,
        "op9_fair_mix": OP9_SQL,
        "op12_importance": OP12_SQL,
    }
