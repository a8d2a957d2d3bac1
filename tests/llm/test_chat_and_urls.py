import itertools
import random
import re

import numpy as np

from ledgerloom.llm import chat_repair as chat
from ledgerloom.llm import url_trust

ROLES = ["system", "user", "assistant"]


def cheapest(roles):
    """Least cost over all legal results, by search over (turns read, state)."""
    best = {(0, "start"): 0.0}
    frontier = [(0.0, 0, "start")]
    follows = {"start": ["system", "user"], "system": ["user"], "user": ["assistant"], "assistant": ["user"]}
    least = float("inf")
    while frontier:
        cost, i, state = min(frontier)
        frontier.remove((cost, i, state))
        if best[i, state] < cost:
            continue
        if i == len(roles):
            end = {"start": 0 if not roles else float("inf"), "system": 2 * chat.INSERT, "user": chat.INSERT, "assistant": 0}[state]
            least = min(least, cost + end)
            continue
        steps = []
        for taken in ROLES:
            relabel = 0 if taken == roles[i] else chat.RELABEL if roles[i] in ROLES else chat.RELABEL_UNKNOWN
            if taken in follows[state]:
                steps.append((relabel, taken))
            if taken == state:
                steps.append((relabel + chat.MERGE, taken))
            for between in follows[state]:
                if between != "system" and taken in follows[between]:
                    steps.append((relabel + chat.INSERT, taken))
        for more, taken in steps:
            if cost + more < best.get((i + 1, taken), float("inf")):
                best[i + 1, taken] = cost + more
                frontier.append((cost + more, i + 1, taken))
    return least


def legal(rendered):
    said = [p.split("|>")[0] for p in rendered.split("<|") if not p.startswith("end|>")][1:]
    if said and said[0] == "system":
        said = said[1:]
    return said and len(said) % 2 == 0 and all(r == ROLES[1 + i % 2] for i, r in enumerate(said))


def test_every_short_conversation_is_repaired_at_least_cost(spark):
    cases = [list(c) for n in range(1, 5) for c in itertools.product([*ROLES, "tool"], repeat=n)]
    rows = [(i, t, r, f"{i}.{t}") for i, c in enumerate(cases) for t, r in enumerate(c)]
    random.Random(0).shuffle(rows)
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    got = {}
    for r in chat.repair(turns, run_rows=2).orderBy("conv_id", "place").collect():
        got.setdefault(r["conv_id"], []).append(r)
    assert set(got) == set(range(len(cases)))
    for i, c in enumerate(cases):
        assert [r["place"] for r in got[i]] == list(range(len(c)))
        assert sum(r["cost"] for r in got[i]) == cheapest(c), c
        whole = "".join(r["rendered"] for r in got[i])
        assert legal(whole), (c, whole)
        assert all(f"{i}.{t}" in whole for t in range(len(c)))


def test_a_conversation_over_many_tasks_is_the_same(spark):
    rng = random.Random(4)
    rows = [(1, t, rng.choice([*ROLES, None]), None if t % 50 == 0 else str(t)) for t in range(1500)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    one = chat.repair(turns.coalesce(1), run_rows=10_000).orderBy("place").collect()
    many = chat.repair(turns.repartition(6), run_rows=7).orderBy("place").collect()
    assert sum(r["cost"] for r in one) == sum(r["cost"] for r in many) == cheapest([r[2] for r in rows])
    assert legal("".join(r["rendered"] for r in many))


def test_repeated_turns_and_very_long_texts(spark):
    rows = [(1, 1, "user", "same"), (1, 1, "user", "same"), (1, 2, "assistant", "x" * 2_000_000), (2, 1, "assistant", "")]
    turns = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "conv_id long, turn long, role string, text string, action string, part string")
    got = {c: [r for r in chat.repair(turns.repartition(3)).orderBy("place").collect() if r["conv_id"] == c] for c in (1, 2)}
    assert [r["action"] for r in got[1]] == ["keep", "merge", "keep"] and len(got[1][2]["rendered"]) > 2_000_000
    assert sum(r["cost"] for r in got[1]) == chat.MERGE and legal("".join(r["rendered"] for r in got[2]))


def test_odd_turns(spark):
    rows = [(None, None, None, None, 1), (None, 3, " User ", "x", 2), (2, 1, "user", "same", 3), (2, 1, "user", "same", 4)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, place int")
    got = chat.repair(turns).collect()
    assert len(got) == 4 and all(r["role"] in ROLES for r in got)
    assert chat.repair(turns.limit(0)).count() == 0


RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def test_parts_and_rules(spark):
    rows = [
        (1, "HTTP://WWW.Example.com/en/1?x#y", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
        (2, "http://a.example.com/en/1", "a.example.com", "/en/1", "example.com/en/", "block"),
        (3, "http://a.example.com/de/1", "a.example.com", "/de/1", "com/", "allow"),
        (4, "http://b.net/es/1", "b.net", "/es/1", "net/es/", "block"),
        (5, "http://notexample.com/en/1", "notexample.com", "/en/1", "com/", "allow"),
        (6, "http://x.com", "x.com", "", None, "allow"),
        (7, "no scheme", "", "", None, "allow"),
        (8, None, "", "", None, "allow"),
        (9, "http://É.org?q", "É.org", "", None, "allow"),
        (10, "a://b://c.net/es/", "b:", "//c.net/es/", None, "allow"),
    ]
    pages = spark.createDataFrame([(i, u, None, "x") for i, u, *_ in rows], "page_id long, url string, html string, trust string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_trust.judge(pages, RULES).collect()}
    assert got == {i: tuple(rest) for i, _, *rest in rows}
    assert url_trust.judge(pages.limit(0), RULES).count() == 0


def test_very_long_pages_of_unclosed_tags_are_read_once(spark):
    import time

    html = ["<a " * 350_000, "<a href " * 130_000, "<a href=" + " " * 1_000_000, '<a href="' + "x:" * 500_000, "<a " * 1000 + 'title=x href="http://b.org/x">', None]
    pages = spark.createDataFrame([(i, "http://a.org/", h) for i, h in enumerate(html)], "page_id long, url string, html string")
    url_trust.host_links(pages.filter("html IS NULL"), "url", "html").collect()
    begun = time.time()
    got = [(r["src"], r["dst"]) for r in url_trust.host_links(pages, "url", "html").collect()]
    assert got == [("a.org", "b.org")] and time.time() - begun < 20


def dense(names, links, seeds):
    """Trust and distrust by solving the equations that the rounds approach."""
    at = {n: i for i, n in enumerate(names)}
    m = np.zeros((len(names), len(names)))
    for a, b, n in links:
        m[at[a], at[b]] += n

    def solve(w, s):
        out = w.sum(1, keepdims=True)
        p = np.divide(w, out, out=np.zeros_like(w), where=out > 0)
        return np.linalg.solve(np.eye(len(names)) - url_trust.DAMPING * p.T, s)

    return solve(m, np.array([s[1] for s in seeds])), solve(m.T, np.array([s[2] for s in seeds]))


def made_links(rng, hosts):
    """A hub that a third of all hosts link to, a chain, hosts without links and random links."""
    links = [(h, hosts[0], 1) for h in hosts[1 : len(hosts) // 3]] + [(hosts[0], h, 2) for h in hosts[1:9]]
    links += [*zip(hosts[10:40], hosts[11:41], [1] * 30, strict=True)]
    links += [(*rng.sample(hosts[: -len(hosts) // 5], 2), rng.randint(1, 4)) for _ in range(2 * len(hosts))]
    return links


def test_spread_settles_at_the_solution(spark):
    rng = random.Random(1)
    names = [f"h{i}" for i in range(300)]
    links = made_links(rng, names)
    seeds = [(n, float(rng.random() < 0.1), rng.random() * (rng.random() < 0.1)) for n in names]
    seed_table = spark.createDataFrame(seeds, "host string, trust double, distrust double")
    link_table = spark.createDataFrame(links, "src string, dst string, links long").groupBy("src", "dst").sum("links").withColumnRenamed("sum(links)", "links")
    got = {r["host"]: (r["trust"], r["distrust"]) for r in url_trust.spread(seed_table, link_table).collect()}
    trust, distrust = dense(names, links, seeds)
    for i, n in enumerate(names):
        assert np.allclose(got.get(n, (0, 0)), (trust[i], distrust[i]), atol=2e-6)


def test_a_whole_table_of_linked_pages_is_judged_as_by_hand(spark):
    """Hosts, rules, links, spread and threshold, each by plain Python."""
    rng = random.Random(3)
    hosts = ["www.example.com", "example.com", "a.example.com", "shop.net", "net", *(f"s{i}.org" for i in range(60))]
    linked = made_links(rng, hosts)
    rows = []
    for i in range(900):
        host = rng.choice(hosts[3:5] if rng.random() < 0.34 else hosts)
        path = rng.choice(["/en/1", "/es/2", "/fr/3", "/", "", "/de/x?q=/es/"])
        html = "".join(f'<a href="{rng.choice(["http:", "https:", ""])}//{b}/p">' * n for a, b, n in linked if a == host and rng.random() < 0.3) or None
        rows.append((i, f"http://{host}{path}", html))
    rows += [(2000 + i, "http://farm.org/x", '<a href="//shop.net/">' * 60) for i in range(30)] + [(3000 + i, "http://shop.net/es/9", None) for i in range(900)]
    rows += [rows[5], (1000, None, "<a href='//net/'>"), (1001, "ftp:nothing", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)

    def parts(url):
        rest = (url or "").partition("://")[2]
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        return host.lower(), re.split("[?#]", rest[len(host) :], maxsplit=1)[0]

    def covering(host, path):
        fits = [(len(r), r, v) for v, r in RULES for h, _, p in [r.partition("/")] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
        return max(fits)[1:] if fits else (None, None)

    judged = [(i, *parts(u), *covering(*parts(u)), h or "") for i, u, h in rows]
    names = sorted({h for _, h, *_ in judged if h} | {*hosts, "farm.org"})
    share = lambda n, v: np.mean([j[4] == v for j in judged if j[1] == n]) if any(j[1] == n for j in judged) else 0.0
    links = [(h, b.lower(), 1) for _, h, _, _, _, html in judged if h for b in re.findall(r'href="(?:https?:)?//([^/"]+)', html) if b != h]
    trust, distrust = dense(names, links, [(n, share(n, "allow"), share(n, "block")) for n in names])
    bad = {n for n, t, d in zip(names, trust, distrust, strict=True) if d - t >= 0.5}
    want = sorted((i, h, p, r, v or ("block" if h in bad else "allow")) for i, h, p, r, v, _ in judged)
    got = sorted(tuple(r)[:5] for r in url_trust.judge(pages, RULES).collect())
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert any(r is None and v == "block" for *_, r, v in want) and any(r is None and v == "allow" and h for _, h, _, r, v in want)


def test_a_host_that_links_to_blocked_hosts_is_blocked(spark):
    link = '<p><A class="x" HREF=\'//bad.net/es/1\'>x</a> <a href="/own">y</a> <a href="https://good.com/z">z</a>'
    rows = [(i, f"http://bad.net/es/{i}", None) for i in range(5)] + [(9, "http://farm.org/1", link.replace("https://good.com/z", "http://bad.net/es/2")), (10, "http://fair.org/1", '<a href="https://good.com/">'), (11, "http://good.com/1", '<a href="http://fair.org/">')]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_trust.judge(pages, RULES).collect()}
    assert got[9] == (None, "block") and got[10] == (None, "allow") and got[11] == ("com/", "allow") and got[0] == ("net/es/", "block")
