"""URL filter: path rules, and trust and distrust spread over links between hosts.

A page that a rule covers (the longest rule whose host is the page's or above it and whose
path begins the page's) has that rule's verdict.  Other pages have their host's: allowed
rules make trusted seeds and blocking rules distrusted ones, by the share of a host's pages
that they cover.  Trust flows along links by personalised PageRank, distrust from a host to
those that link to it by PageRank over the reversed links.  A host is blocked where its
distrust exceeds its trust by ``margin``, in units of a host's whole share of pages.  Rounds go
on until no score has changed by ``SETTLED`` or more in ``ROUNDS_A_CHECK`` rounds; as each
round passes on no more than ``damping`` of what it got, what is still to come is then less
than that times ``damping``^5 / (1 - ``damping``^5) for a host, 8e-7.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path:
from there up to ``?``, ``#`` or the end; both empty for null urls and those without
``://``.  Only links that name a host count, each pair of hosts weighted by its number of
links; links within a host pass nothing on, and what a host without links to others has
stays with it.  Null and empty html has no links, and very long html is read whole; hosts
that nothing reaches are allowed; rules of one length go by code point; repeated pages count
as often; an empty table gives no rows; columns other than the id, url and html are ignored,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .durable import cut

DAMPING, SETTLED = 0.85, 1e-6
#: Rounds between checks of what has changed.
ROUNDS_A_CHECK = 5
#: Rules become one expression; their list is bounded.
MOST_RULES = 1000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A tag ends at the next angle of either kind, so that tags that never close are each read once; blanks aren't given back.
_LINK = r"""(?is)<a\s[^<>]*?href\s*+=\s*+["']?+\s*+((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)"""


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"^(?s).*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s).*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def covering_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The rule that covers a page and its verdict, or nulls; rules: (verdict, host/path)."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"at most {MOST_RULES} rules")
    rule = verdict = F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the longest is asked first
        if said not in ("allow", "block"):
            raise ValueError(f"verdict {said!r}")
        top, _, below = text.partition("/")
        covers = ((host == top) | host.endswith(f".{top}")) & path.startswith(f"/{below}")
        rule, verdict = F.when(covers, text).otherwise(rule), F.when(covers, said).otherwise(verdict)
    return rule, verdict


def host_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """src, dst, links between different hosts."""
    found = pages.select(host_of(F.col(url_col)).alias("src"), F.explode(F.regexp_extract_all(F.col(html_col), F.lit(_LINK), 1)).alias("url"))
    target = F.when(F.col("url").startswith("//"), F.concat(F.lit("http:"), "url")).otherwise(F.col("url"))
    return found.select("src", host_of(target).alias("dst")).filter("src <> '' AND dst <> '' AND src <> dst").groupBy("src", "dst").agg(F.count("*").alias("links"))


def spread(seeds: DataFrame, links: DataFrame, damping: float = DAMPING, settled: float = SETTLED) -> DataFrame:
    """host, trust, distrust from seeds (host, trust, distrust) over links (src, dst, links)."""
    flows = links.select(F.lit("trust").alias("kind"), "src", "dst", "links").unionByName(links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "links"))
    totals = flows.groupBy("kind", "src").agg(F.sum("links").alias("total"))
    flows = cut(flows.join(totals, ["kind", "src"]).select("kind", "src", "dst", (F.col("links") / F.col("total")).alias("share")))
    start = cut(seeds.select("host", F.explode(F.create_map(F.lit("trust"), F.col("trust").cast("double"), F.lit("distrust"), F.col("distrust").cast("double"))).alias("kind", "seed")).filter("seed > 0"))
    scores = kept = start.select("kind", "host", F.col("seed").alias("score"))
    moves = not flows.isEmpty()
    while moves:
        for _ in range(ROUNDS_A_CHECK):
            met = scores.alias("s").join(flows.alias("f"), (F.col("s.kind") == F.col("f.kind")) & (F.col("s.host") == F.col("f.src")))
            moved = met.select(F.col("f.kind").alias("kind"), F.col("f.dst").alias("host"), (F.lit(damping) * F.col("s.score") * F.col("f.share")).alias("score"))
            scores = moved.union(start.select("kind", "host", F.col("seed").alias("score"))).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        scores = cut(scores)
        change = scores.join(kept.withColumnRenamed("score", "was"), ["kind", "host"], "left").agg(F.max(F.abs(F.col("score") - F.coalesce("was", F.lit(0.0))))).first()[0]
        kept, moves = scores, change is not None and change >= settled
    pick = lambda kind: F.round(F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0.0)), 9).alias(kind)
    return scores.groupBy("host").agg(pick("trust"), pick("distrust"))


def judge(pages: DataFrame, rules: list[tuple[str, str]], margin: float = 0.5, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, host, path, rule, verdict, trust and distrust of every page."""
    parts = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    rule, said = covering_rule(F.col("host"), F.col("path"), rules)
    judged = parts.withColumn("rule", rule).withColumn("said", said)
    share = lambda verdict: (F.sum(F.when(F.col("said") == verdict, 1).otherwise(0)) / F.count("*"))
    seeds = judged.filter("host <> ''").groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust"))
    scores = spread(seeds, host_links(pages, url_col, html_col))
    found = judged.join(scores, "host", "left").withColumns({k: F.coalesce(k, F.lit(0.0)) for k in ("trust", "distrust")})
    by_host = F.when(F.col("distrust") - F.col("trust") >= margin, "block").otherwise("allow")
    return found.select(id_col, "host", "path", "rule", F.coalesce("said", by_host).alias("verdict"), "trust", "distrust")
