"""Mixing sources to target weights by weighted fair queueing.

A source's documents are shuffled (by a seeded hash of their ids) and queue up; a source
may be gone through up to three times.  A document is served in pieces of at most ``PIECE``
words, so that a very long one doesn't hold up its source or run far over its target.  A
piece's virtual finish time is the number of its source's words up to its end over the
source's target.  The mix is all pieces in order of virtual finish time, cut off where their
words reach the total budget, all words of the corpus; the piece there is cut to the words
left.  So each source's words come within a piece or so of its target.

The order is global but no global sort is needed to cut it: equal stretches of virtual time
hold about equal words, so words are summed by stretch, the stretch in which the budget runs
out is divided again until it's short, and only its pieces are sorted.

Running totals never need one source in one task: rows fall into buckets by the shuffled
order, buckets are summed and offset, and only the rows of one source and bucket are
ordered together.  There is one row for each source when targets are set, in one task.

Null texts have size 0 and take nothing; a null source is a source of its own, after all
others; repeated rows are rows of their own, and tie; empty tables give no rows; very long
texts are counted whole; columns of any name may stand beside those used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .durable import cut

#: Rows of all sources that share a bucket, on average.
ROWS_A_BUCKET = 256
_SLOTS = 65536
#: Sources whose cuts are broadcast; more are joined by shuffling.
MOST_BROADCAST = 10_000
#: Most words that are served at once.
PIECE = 64
#: Stretches of virtual time in which words are summed, and words of a stretch that is sorted as it is.
STRETCHES, SORTED_WORDS = 1024, 1_000_000
_MOST_DIVISIONS = 5  # beyond the resolution of a double
#: Times that a source, and so a document, can be gone through.
MOST_PASSES = 3


def word_count(text: Column) -> Column:
    """The number of runs of characters other than blanks; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """source, source_size -> and nth (by code point, null last) and target, from one row for each source.

    Sources weigh 1, 2, 3, repeating, by code point.  In order of the share at which a
    source meets its cap, a source is capped if the words left, shared by weight among it
    and those after it, would give it more than its cap.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_cap = Window.orderBy("full_at", "nth")
    before, after = by_cap.rowsBetween(Window.unboundedPreceding, -1), by_cap.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    return (
        sizes.withColumn("nth", F.row_number().over(by_name))
        .withColumn("weight", (F.col("nth") - 1) % 3 + 1)
        .withColumn("cap", MOST_PASSES * F.col("source_size"))
        .withColumn("full_at", F.col("cap").cast("double") / F.col("weight"))
        .withColumn("left", F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("weights_left", F.sum("weight").over(after))
        .withColumn("capped", F.col("left") * F.col("weight") > F.col("cap") * F.col("weights_left"))
        .withColumn("shared", F.min(F.when(~F.col("capped"), F.struct("full_at", "nth", "left", "weights_left"))).over(whole))
        .select(
            "source",
            "nth",
            "source_size",
            F.when(F.col("capped"), F.col("cap").cast("double"))
            .otherwise(F.col("shared.left").cast("double") * F.col("weight") / F.col("shared.weights_left"))
            .alias("target"),
        )
    )


def shuffle_key(seed: int, id_col: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))


def queue(docs: DataFrame, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row a document: id, source, nth, size, source_size, target, queued, and key, same, same_queued.

    queued: the words of its source ahead of it in the shuffled order; same: how many rows
    of the source have its key and size; same_queued: the words ahead of the first of them.
    """
    key = shuffle_key(seed, id_col)
    sized = cut(docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"), key.alias("key")))
    buckets = min(_SLOTS, max(1, sized.count() // ROWS_A_BUCKET))
    slot = F.conv(F.substring("key", 1, 4), 16, 10).cast("long")
    sized = sized.withColumn("bucket", F.floor(slot * buckets / _SLOTS).cast("int"))

    sums = sized.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    targets = source_targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")))
    offsets = sums.withColumn("offset", F.coalesce(F.sum("words").over(ahead), F.lit(0))).alias("o").join(targets.alias("t"), F.col("o.source").eqNullSafe(F.col("t.source"))).select("o.source", "bucket", "offset", "nth", "source_size", "target")

    within = Window.partitionBy("source", "bucket").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    alike = Window.partitionBy("source", "bucket", "key", "size")
    ranked = sized.withColumn("earlier", F.coalesce(F.sum("size").over(within), F.lit(0))).withColumn("same", F.count("*").over(alike)).withColumn("same_earlier", F.min("earlier").over(alike))
    return cut(
        ranked.alias("r")
        .join(offsets.alias("f"), (F.col("r.bucket") == F.col("f.bucket")) & F.col("r.source").eqNullSafe(F.col("f.source")))
        .select(F.col("id").alias(id_col), F.col("r.source").alias("source"), "nth", "size", "source_size", "target", (F.col("offset") + F.col("earlier")).alias("queued"), "key", "same", (F.col("offset") + F.col("same_earlier")).alias("same_queued"))
    )


def pieces(queued: DataFrame) -> DataFrame:
    """nth (of the source), words, upto (the source's words up to its end) and finish of the pieces that begin before virtual time 1.

    These hold the total budget: what a source would lack by then, its next piece holds.
    """
    copies = queued.filter("size > 0").withColumn("nth_pass", F.explode(F.array(*map(F.lit, range(MOST_PASSES)))))
    copies = copies.withColumn("start", F.col("nth_pass") * F.col("source_size") + F.col("queued")).filter("start < target")
    begun = F.least(F.col("size"), F.ceil(F.col("target") - F.col("start")))
    cut_up = copies.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), begun - 1, F.lit(PIECE).cast("long"))))
    upto = F.col("start") + F.least(F.col("at") + PIECE, F.col("size"))
    return cut_up.select("nth", F.least(F.lit(PIECE), F.col("size") - F.col("at")).cast("long").alias("words"), upto.alias("upto"), (upto.cast("double") / F.col("target")).alias("finish"))


def served(queued: DataFrame) -> DataFrame:
    """nth and served of each source: its words among the pieces, by virtual finish time, that the budget holds."""
    total = queued.agg(F.sum("size").alias("budget")).first()
    left, rows = total["budget"] or 0, pieces(queued)
    before, here = F.lit(False), F.lit(True)
    for _ in range(_MOST_DIVISIONS):
        held = rows.filter(here)
        ends = held.agg(F.min("finish").alias("low"), F.max("finish").alias("high"), F.sum("words").alias("words")).first()
        if (ends["words"] or 0) <= SORTED_WORDS or ends["low"] == ends["high"]:
            break
        low, width = ends["low"], (ends["high"] - ends["low"]) / STRETCHES
        if not width > 0:
            break
        stretch = F.floor((F.col("finish") - F.lit(low)) / F.lit(width))
        sums = held.groupBy(stretch.alias("stretch")).agg(F.sum("words").alias("words")).orderBy("stretch").collect()  # at most STRETCHES + 1
        for r in sums[:-1]:
            if r["words"] >= left:
                break
            left -= r["words"]
        else:
            r = sums[-1]
        before, here = before | (here & (stretch < r["stretch"])), here & (stretch == r["stretch"])
    order = Window.orderBy("finish", "nth", "upto").rowsBetween(Window.unboundedPreceding, -1)
    last = rows.filter(here).withColumn("earlier", F.coalesce(F.sum("words").over(order), F.lit(0)))
    last = last.select("nth", F.greatest(F.lit(0), F.least(F.col("words"), F.lit(left) - F.col("earlier"))).alias("words"))
    whole = rows.filter(before).groupBy("nth").agg(F.sum("words").alias("words"))
    return cut(whole.union(last.groupBy("nth").agg(F.sum("words").alias("words"))).groupBy("nth").agg(F.sum("words").cast("long").alias("served")))


def with_served(queued: DataFrame) -> DataFrame:
    """``queued`` with the served words of each row's source."""
    each = served(queued)
    each = F.broadcast(each) if each.count() <= MOST_BROADCAST else each
    return queued.join(each, "nth", "left").withColumn("served", F.coalesce("served", F.lit(0)))


def words_taken(nth_pass: int) -> Column:
    """Of a row of ``with_served``: the words that the mix takes in that pass (from 0)."""
    rest = F.col("served") - (F.lit(nth_pass) * F.col("source_size") + F.col("queued"))
    return F.greatest(F.lit(0), F.least(F.col("size"), rest)).cast("long")


def mix(queued: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The mix: id, source, pass, words, virtual_finish, range-sorted by virtual finish time.

    A row of ``queue`` gives a row for each copy that is taken, whole or cut.
    """
    copies = with_served(queued).withColumn("copy", F.explode(F.array(*(F.struct(F.lit(n).alias("pass"), words_taken(n).alias("words")) for n in range(MOST_PASSES))))).filter("copy.words > 0")
    finish = (F.col("copy.pass") * F.col("source_size") + F.col("queued") + F.col("size")) / F.col("target")
    return copies.select(id_col, "source", "copy.pass", "copy.words", finish.alias("virtual_finish")).orderBy("virtual_finish", id_col, "pass")


def taken(queued: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Every document with its size, source_size, target and the words of it that the mix takes."""
    return with_served(queued).select(id_col, "size", "source_size", "target", (words_taken(0) + words_taken(1) + words_taken(2)).alias("taken"))


def fresh(name: str, taken: list[str]) -> str:
    """A column name that isn't taken."""
    low = {c.lower() for c in taken}
    while (name := f"_{name}").lower() in low:
        pass
    return name


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"), 1), F.lit(1), n.cast("int")), "")


def draw(docs: DataFrame, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` as the mix takes them: a row for each copy; a cut copy keeps the words served.

    In the shuffled order a source is gone through some times wholly and then up to one
    document, so a row for each source says what is taken of any document: texts needn't
    move.  Of repeated rows at the cut each keeps an equal share.  A column n_chars, where
    there is one, follows the text.
    """
    mine = {n: fresh(n, docs.columns) for n in ("source", "cut", "size", "at", "words")}
    cuts = (
        with_served(queue(docs, seed, id_col, text_col, source_col))
        .filter("source_size > 0")
        .withColumn("passes", F.floor(F.col("served") / F.col("source_size")))
        .withColumn("rest", F.col("served") - F.col("passes") * F.col("source_size"))
        .filter("queued <= rest AND rest < queued + size")
        .select(F.col("source").alias(mine["source"]), F.struct(F.col("passes").cast("int").alias("passes"), F.struct("key", "size").alias("at"), F.floor((F.col("rest") - F.col("same_queued")) / F.col("same")).alias("words")).alias(mine["cut"]))
        .distinct()
    )
    cuts = cut(cuts)
    size, at, words, taken_by = (F.col(mine[n]) for n in ("size", "at", "words", "cut"))
    rows = docs.withColumn(mine["size"], word_count(F.col(text_col))).withColumn(mine["at"], F.struct(shuffle_key(seed, id_col).alias("key"), size.alias("size")))
    met = rows.join(F.broadcast(cuts) if cuts.count() <= MOST_BROADCAST else cuts, F.col(source_col).cast("string").eqNullSafe(F.col(mine["source"])))
    extra = F.when(at < taken_by["at"], size).when(at == taken_by["at"], taken_by["words"]).otherwise(F.lit(0))
    copies = F.filter(F.concat(F.array_repeat(size, taken_by["passes"]), F.array(extra.cast("long"))), lambda n: n > 0)
    rows = met.withColumn(mine["words"], F.explode(copies)).withColumn(text_col, F.when(words < size, first_words(F.col(text_col), words)).otherwise(F.col(text_col)))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(words < size, F.length(text_col).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return rows.select(docs.columns)
