"""From raw documents to token digests: five stages over the whole corpus.

Each stage takes (spark, docs, sf_dir) and gives the documents that it keeps, with the
columns of ``documents``; the last gives the digests of the encoded texts.  All stages take
whole texts of any length, rows without an id, rows that repeat one, and empty tables, which
give no rows; columns beyond those of ``documents`` are dropped.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bpe_automaton, jaccard_join, langid, mixing, toxicity
from ledgerloom.llm.durable import checkpoint_dir, read, remove
from ledgerloom.llm.registry import BPE_FILE

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A language that is less likely than this is rejected.
LEAST_LANGUAGE_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language can't be told: null or empty texts, no letter, or no language likely enough.

    Repeated rows share one fate.  Without a labelled row nothing can be told and nothing stays.
    """
    model = langid.fit(docs)
    return langid.annotate(docs.select(COLUMNS), model).filter((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("lang_score") >= LEAST_LANGUAGE_SCORE)).select(COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents predicted toxic; null and empty texts hold nothing toxic.

    Repeated rows share one fate.  Without labels of both kinds every document has one score,
    the share of toxic labels, and so all stay unless most labels are toxic.
    """
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    return toxicity.annotate(docs.select(COLUMNS), model).filter("toxic_predicted = 0").select(COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near duplicates: that with the smallest id.

    Documents without an id or a word are linked with nothing and stay, each row of them.  Of
    rows that share the smallest id of their class one stays, whatever the order of rows; where
    one id stands on texts of several classes, each class keeps its own.
    """
    return jaccard_join.one_of_each_class(docs.select(COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, once for each time; a cut one keeps the words taken.

    Documents without a word take no part in a mix of words and go; a null source is one of its own.
    """
    return mixing.draw(docs.select(COLUMNS))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each row; a null text is an empty one."""
    return bpe_automaton.round_trip(docs, BPE_FILE)


STAGES = [
    ("language ID", identify_language),
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("mixing", mix_sources),
    ("BPE encoding and decoding", encode),
]

#: The first two stages are fitted models, which SQL doesn't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next.

    What a stage read is removed when the next has been written; the last is left to the caller.
    """
    docs = read(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{i}")
            docs = spark.read.parquet(f"{folder}/{i}")
            if i:
                remove(spark, f"{folder}/{i - 1}")
    return docs
