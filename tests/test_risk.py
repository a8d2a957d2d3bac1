"""Risk and suppression on small tables whose results are known."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import risk, suppress

KEYS = ["gender", "age_group", "race"]
# Rows whose risks are known.
R1 = [
    ("male", "10 to 17", "white", "misdemeanor"),
    ("male", "10 to 17", "white", "misdemeanor"),
    ("male", "18 to 19", "white", "misdemeanor"),
    ("male", "18 to 19", "white", "felony"),
    ("female", "20 to 29", "black", "misdemeanor"),
]
R2 = [("male", "10 to 17", "white", "felony")] * 2 + [("male", "10 to 17", None, "misdemeanor"), ("male", "10 to 17", "black", "felony")]


def table(spark, rows, strata=None):
    strata = strata or ["all"] * len(rows)
    data = [(i, s, *r) for i, (s, r) in enumerate(zip(strata, rows, strict=True))]
    return spark.createDataFrame(data, "id int, stratum string, gender string, age_group string, race string, offense_level string")


def risks(spark, rows, strata=None, by=(), **options):
    found = risk.calc_risk(table(spark, rows, strata), KEYS, list(by), **options)
    return [r["risk"] for r in found.orderBy("id").collect()]


def test_rows_without_nulls(spark):
    level = {"div": "offense_level"}
    assert risks(spark, R1) == [2, 2, 2, 2, 1]
    assert risks(spark, R1, **level, risk=risk.diversity) == [1, 1, 2, 2, 1]
    assert risks(spark, R1, **level, risk=risk.present("misdemeanor"), within_completions=True) == [1, 1, 1, 1, 1]
    assert risks(spark, R1, **level, risk=risk.share_of("misdemeanor")) == [1, 1, 0.5, 0.5, 1]
    assert risks(spark, R1, ["g1", "g1", "g1", "g2", "g2"], ["stratum"]) == [2, 2, 1, 1, 1]
    assert risks(spark, R1, **level, risk=risk.custom(lambda n: n.get("misdemeanor", 0) / sum(n.values()))) == [1, 1, 0.5, 0.5, 1]


@pytest.mark.parametrize("n, k, diverse, share", [(3, [3, 3, 3], [2, 2, 2], [1 / 3] * 3), (4, [3, 3, 4, 2], [2] * 4, [1 / 3] * 3 + [1 / 2])])
def test_a_null_fits_anything(spark, n, k, diverse, share):
    rows = R2[:n]
    assert risks(spark, rows) == k
    assert risks(spark, rows, div="offense_level", risk=risk.diversity) == diverse
    got = risks(spark, rows, div="offense_level", risk=risk.share_of("misdemeanor"), within_completions=True)
    assert got == pytest.approx(share)


def test_all_compatible_without_a_known_age(spark):
    rows = [(g, None, r, o) for g, _, r, o in R2]
    assert risks(spark, [("male", None, "white", o) for *_, o in rows]) == [4] * 4


@pytest.mark.parametrize("seed", range(2))
def test_risk_equals_comparing_all_pairs(spark, seed):
    rng = random.Random(seed)
    rows = [tuple(rng.choice(["a", "b", "c", None]) for _ in KEYS) + ("x",) for _ in range(60)]
    assert risks(spark, rows) == risk.brute_force_k([r[:3] for r in rows])
    strata = [rng.choice(["s", "t"]) for _ in rows]
    got = risks(spark, rows, strata, ["stratum"])
    for s in "st":
        own = [i for i, x in enumerate(strata) if x == s]
        assert [got[i] for i in own] == risk.brute_force_k([rows[i][:3] for i in own])


@pytest.mark.parametrize("seed, values, n", [(5, ["a", "b", None], 25), (6, ["a", "b", "c", None, None, None], 12), (7, ["a", None, None], 9), (8, ["a", "b", "c", "d", None, None], 8)])
def test_risk_within_completions_equals_going_through_them(spark, seed, values, n):
    rng = random.Random(seed)
    rows = [tuple(rng.choice(values) for _ in KEYS) + ("x",) for _ in range(n)]
    strata = [rng.choice(["s", "t", None]) for _ in rows]
    got = risks(spark, rows, strata, ["stratum"], within_completions=True)
    for s in ("s", "t", None):
        keys = [r[:3] for r, own in zip(rows, strata, strict=True) if own == s]
        levels = [sorted({k[i] for k in keys if k[i]}) for i in range(3)]
        pool = {}
        for full in itertools.product(*(x or [None] for x in levels)):
            own = [k for k in keys if all(v is None or v == f for v, f in zip(k, full, strict=True))]
            if own:
                pool[full] = (len(own), max(sum(v is not None for v in k) for k in own))
        want = []
        for k in keys:
            mine = [pool[f] for f in risk.completions(k, levels) if f in pool]
            most = max(known for _, known in mine)
            want.append(1 if k == (None,) * 3 else min(n for n, known in mine if known == most))
        assert [r for r, own in zip(got, strata, strict=True) if own == s] == want


def test_no_completion_is_made_that_no_pattern_supports(spark):
    """Many levels of each key: their product isn't made, and nothing is compared but by equality."""
    rows = [(f"g{i}", f"a{i}", f"r{i}", "x") for i in range(300)] + [(None, "a7", "r7", "x"), ("g8", None, None, "x"), ("g9", None, "r4", "x")]
    found = risk.calc_risk(table(spark, rows), KEYS, within_completions=True)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    got = {r["id"]: r["risk"] for r in found.filter("id >= 300 OR id IN (7, 8, 9, 4)").collect()}
    assert got == {7: 2, 8: 2, 300: 2, 301: 2, 9: 1, 4: 1, 302: 1}


def test_bad_columns_are_refused(spark):
    rows = table(spark, R1)
    for options in ({"keys": ["nothing"]}, {"keys": KEYS, "div": "nothing"}, {"keys": KEYS, "strata": ["nothing"]}, {"keys": KEYS, "div": "race"}, {"keys": KEYS, "strata": ["race"]}, {"keys": KEYS, "strata": ["stratum"], "div": "stratum"}, {"keys": KEYS, "div": "offense_level", "risk": 3}, {"keys": []}):
        with pytest.raises(ValueError):
            risk.calc_risk(rows, **options)


@pytest.mark.parametrize("threshold, n", [(3, 5), (2, 1), (1, 0)])
def test_subset_at_risk(spark, threshold, n):
    assert risk.at_risk_subset(table(spark, R1), KEYS, threshold).count() == n


def test_thresholds_must_be_positive_numbers(spark):
    for threshold in (0, -1, "a"):
        with pytest.raises(ValueError):
            risk.at_risk_subset(table(spark, R1), KEYS, threshold)


def nulls(found):
    return [sum(r[k] is None for k in KEYS) for r in found.orderBy("id").collect()]


@pytest.mark.parametrize("k, each", [(2, 3), (1, 0), (6, 3)])
def test_suppression_without_a_choice(spark, k, each):
    rows = table(spark, R1)
    found = suppress.suppress(rows, KEYS, "id", threshold=k, chains=2)
    if k == 2:  # one row shares no value with the others: three open keys are enough (SURVEY section 8)
        assert sum(nulls(found)) == each
        assert all(r["risk"] >= 2 for r in risk.calc_risk(found, KEYS).collect())
    else:
        assert nulls(found) == [each] * 5


def test_one_null_suffices(spark):
    rows = table(spark, [("male", a, r, "x") for a, r in (("10", "white"), ("10", "white"), ("18", "white"), ("18", "white"), ("18", "black"))])
    found = suppress.suppress(rows, KEYS, "id", threshold=2, chains=4)
    assert all(r["risk"] >= 2 for r in risk.calc_risk(found, KEYS).collect())
    assert sum(nulls(found)) == 1


def test_strata_are_made_safe_one_by_one(spark):
    rows = [("male", "10 to 17", "white"), ("male", "10 to 17", "white"), ("male", "18 to 19", "white"), ("male", "18 to 19", "white"), ("male", "18 to 19", "black"), ("female", "18 to 19", "white"), ("male", "18 to 19", "white")]
    found = suppress.suppress(table(spark, [(*r, "x") for r in rows], ["g1", "g1", "g2", "g2", "g2", "g3", "g3"]), KEYS, "id", ["stratum"], threshold=2, chains=4)
    assert all(r["risk"] >= 2 for r in risk.calc_risk(found, KEYS, ["stratum"]).collect())
    # Of two rows that differ in one key, one open cell makes both fit.
    assert nulls(found)[:2] == [0, 0] and sum(nulls(found)[2:5]) == 1 and sum(nulls(found)[5:]) == 1


def test_rounds_find_what_a_task_finds(spark):
    """The same tables as above, their strata searched by rounds as if they were large: groups apart, all at once."""
    one_null = [("male", a, r) for a, r in (("10", "white"), ("10", "white"), ("18", "white"), ("18", "white"), ("18", "black"))]
    strata = {"one": one_null, "alone": [r[:3] for r in R1], "few": [("female", "10", "white")], "safe": [("male", "10", "white")] * 2, "pair": [("female", "18", "white"), ("male", "18", "white")]}
    rows = table(spark, [(*r, "x") for own in strata.values() for r in own], [s for s, own in strata.items() for _ in own])
    found = suppress.suppress(rows, KEYS, "id", ["stratum"], threshold=2, chains=3, task_rows=0)
    got = found.groupBy("stratum").agg(F.sum("n_nulled").alias("n")).collect()
    assert {r["stratum"]: r["n"] for r in got} == {"one": 1, "alone": 3, "few": 3, "safe": 0, "pair": 1}
    assert found.columns == suppress.suppress(rows, KEYS, "id", ["stratum"], threshold=2, chains=1).columns
    after = risk.calc_risk(found.filter("stratum <> 'few'"), KEYS, ["stratum"]).collect()
    assert len(after) == 14 and all(r["risk"] >= 2 for r in after)


def test_rounds_reach_a_share_by_one_null(spark):
    found = suppress.suppress(table(spark, SHARES), KEYS, "id", threshold=0.5, chains=3, div="offense_level", measure=misdemeanors, within_completions=True, task_rows=0)
    assert [r["n_nulled"] for r in found.filter("offense_level <> 'misdemeanor'").collect()] == [0, 0] and sum(nulls(found)) == 1
    assert found.filter("age_group IS NULL").count() == 1


def test_a_large_stratum_with_a_hot_pattern_and_infinite_weights(spark):
    rng = random.Random(4)
    rows = [("m", "1", "w", "x")] * 60 + [(rng.choice("mf"), rng.choice(["1", "2", None]), rng.choice("wba"), "x") for _ in range(60)] + [("m", "9", "w", "x"), ("f", "8", "b", "x")]
    before = table(spark, rows, ["s"] * 100 + ["t"] * 22)
    found = suppress.suppress(before, KEYS, "id", ["stratum"], threshold=4, chains=2, weights={"gender": float("inf")}, task_rows=50).collect()
    assert sorted(r["id"] for r in found) == [*range(122)]
    own = {i: r[:3] for i, r in enumerate(rows)}
    for r in found:
        assert all(new is None or new == old for new, old in zip((r[k] for k in KEYS), own[r["id"]], strict=True)) and r["gender"] is not None
        assert r["n_nulled"] == sum(r[k] is None and old is not None for k, old in zip(KEYS, own[r["id"]], strict=True))
    for s in "st":
        part = [tuple(r[k] for k in KEYS) for r in found if r["stratum"] == s]
        assert min(risk.brute_force_k(part)) >= 4
    assert sum(r["n_nulled"] for r in found) < 60


@pytest.mark.parametrize("div", [False, True])
def test_counts_kept_cell_by_cell_are_those_of_all_pairs(div):
    rng = np.random.default_rng(int(div))
    codes, levels = rng.integers(0, 4, (40, 3)), rng.integers(0, 2, 40)
    measure = (lambda n: float(len(n))) if div else None
    stratum = suppress.Stratum(codes, levels, ["a", "b"], measure, 2 if div else 5, set())
    held = suppress.Held(stratum)
    for _ in range(200):
        i, k = rng.integers(40), rng.integers(3)
        if codes[i, k]:
            held.put(i, k, 0 if held.codes[i, k] else codes[i, k])
        assert (held.unsafe == stratum.unsafe(held.codes)).all() and (held.fits == stratum.fits(held.codes)).all()
    assert stratum.fits(codes).sum(1).tolist() == risk.brute_force_k([tuple(int(c) or None for c in row) for row in codes])


misdemeanors = lambda n: n.get("misdemeanor", 0) / sum(n.values())  # noqa: E731  workers can't import this module


SHARES = [("male", "18 to 19", "white", "misdemeanor"), ("male", "18 to 19", "white", "felony"), ("male", "18 to 19", "white", "felony"), ("male", "10 to 17", "white", "misdemeanor")]


@pytest.mark.parametrize("search", [suppress.suppress, suppress.suppress_at_risk])
def test_a_share_is_reached_by_one_null(spark, search):
    options = {"div": "offense_level", "measure": misdemeanors, "within_completions": True}
    found = search(table(spark, SHARES), KEYS, "id", threshold=0.5, chains=4, **options)
    got = found.orderBy("id").collect()
    assert sum(r["age_group"] is None for r in got if r["offense_level"] == "misdemeanor") == 1
    assert not any(r["age_group"] is None for r in got if r["offense_level"] != "misdemeanor") and sum(nulls(found)) == 1
    after = risk.calc_risk(found, KEYS, (), "offense_level", risk.custom(misdemeanors), within_completions=True)
    assert [r["risk"] for r in after.collect()] == [0.5] * 4


def test_shares_are_looked_at_when_only_rows_at_risk_are_searched(spark):
    rows = [("m", "1", "w", "misdemeanor"), ("m", "1", "w", "felony"), ("m", "1", "w", "felony"), ("m", "2", "w", "misdemeanor"), ("f", "9", "b", "other")]
    found = suppress.suppress_at_risk(table(spark, rows), KEYS, "id", threshold=0.5, div="offense_level", measure=misdemeanors, chains=4)
    assert found.count() == 5 and sum(nulls(found)) >= 1
    low = risk.calc_risk(found, KEYS, (), "offense_level", risk.custom(misdemeanors)).filter("risk < 0.5 AND offense_level = 'felony'")
    assert low.count() == 0


# Rows with many nulls whose risks are known.
R6 = [(None, None, "white"), ("male", "40 to 69", None), (None, None, None), ("male", None, None), (None, "30 to 39", None), ("male", "30 to 39", "black"), (None, "30 to 39", "white"), ("male", None, None), ("male", "40 to 69", "black"), ("male", "30 to 39", None), ("male", None, None), (None, "30 to 39", "black"), (None, None, "white"), ("male", "40 to 69", "black"), ("male", "40 to 69", "black"), (None, "30 to 39", "white")]
R7 = [("male", None, None), ("male", None, "white"), ("male", None, None), (None, "40 to 69", None), ("male", None, "white"), ("male", None, None), ("male", "40 to 69", None), (None, None, None), (None, None, "white"), (None, None, "white")]
R8 = [("misdemeanor", "male", None, "black"), ("misdemeanor", None, "40 to 69", "other"), ("juvenile", "female", None, "other"), ("misdemeanor", "male", None, "black"), ("misdemeanor", "female", "40 to 69", None), ("misdemeanor", None, "70 and over", "white"), ("juvenile", "male", None, "Asian or Pac Isl"), ("misdemeanor", None, "20 to 29", None), ("juvenile", "female", "10 to 17", None), ("felony", None, None, None)]


def test_many_nulls(spark):
    assert risks(spark, [(*r, "x") for r in R6])[:2] == [11, 10]
    assert risks(spark, [(*r, "x") for r in R7]) == [10] * 10
    rows = [(*r[1:], r[0]) for r in R8]
    got = risks(spark, rows, div="offense_level", risk=risk.share_of("misdemeanor", "juvenile"), within_completions=True)
    assert got[-1] == 1.0


@pytest.mark.parametrize("seed", range(3))
def test_both_ways_to_take_risk_within_completions_agree(spark, seed):
    rng = random.Random(seed)
    rows = [tuple(rng.choice(["a", "b", None]) for _ in KEYS) + (rng.choice(["misdemeanor", "felony"]),) for _ in range(20)]
    want = risks(spark, rows, div="offense_level", risk=risk.custom(misdemeanors), within_completions=True)
    codes = np.array([[0 if v is None else "ab".index(v) + 1 for v in r[:3]] for r in rows])
    stratum = suppress.Stratum(codes, np.array([int(r[3] == "felony") for r in rows]), ["misdemeanor", "felony"], misdemeanors, 0.5, set(), True)
    assert stratum.risk(codes).tolist() == pytest.approx(want)


def test_an_infinite_weight_is_never_nulled(spark):
    rows = table(spark, [("male", a, "white", "x") for a in ("10", "11", "12", "13")])
    found = suppress.suppress(rows, KEYS, "id", threshold=2, chains=2, weights={"gender": float("inf")})
    kept = found.filter(F.col("race").isNotNull())
    assert kept.filter(F.col("gender").isNull()).count() == 0
    with pytest.raises(ValueError):
        suppress.key_weights(KEYS, {"nothing": 1.0})
    assert list(suppress.key_weights(KEYS, ["race", "gender", "age_group"])) == [1.0, 0.5, 1.5]


def test_many_rare_patterns_do_not_cost_the_stratum_its_keys():
    n, k = 500, 350
    codes = np.repeat(np.arange(1, n + 1)[:, None], 3, 1)
    stratum = suppress.Stratum(codes, np.zeros(n, int), ["all"], None, k, set())
    found = stratum.search(np.ones(3), np.random.default_rng(0))
    assert found is not None and not stratum.unsafe(found).any()
    assert ((found == codes) | (found == 0)).all() and (found != 0).any()


def test_strata_are_apart_and_other_rows_stay(spark):
    rows = table(spark, [("m", "1", "w", "x"), ("m", "1", "w", "x"), ("f", "2", "b", "x"), ("f", "2", "w", "x")], ["g1", "g1", "g2", "g2"])
    found = suppress.suppress_at_risk(rows, KEYS, "id", threshold=2, strata=["stratum"], chains=2)
    got = {r["id"]: r for r in found.collect()}
    assert len(got) == 4 and got[0]["n_nulled"] == 0 and got[0]["race"] == "w"
    assert all(r["risk"] >= 2 for r in risk.calc_risk(found, KEYS, ["stratum"]).collect())


def test_cells(spark):
    rows = table(spark, [*R1, (None, "10 to 17", "white", "felony"), (None, "10 to 17", "white", "felony")])
    small = risk.suppress_small(rows, ["stratum"], ["gender"], "race", 2).orderBy("id").collect()
    assert [r["race"] for r in small] == ["white"] * 4 + [None, "white", "white"]
    uniform = risk.suppress_uniform(rows, ["stratum"], ["gender", "age_group"], "race", ["offense_level"], 2).orderBy("id").collect()
    assert [r["race"] for r in uniform] == [None, None, "white", "white", None, None, None]
    ordered = risk.suppress_ordered(rows, ["stratum"], ["gender"], "race", "offense_level", "felony", "misdemeanor").orderBy("id").collect()
    assert [r["race"] for r in ordered] == ["white"] * 4 + ["black", None, None]
    counts = risk.suppression_counts(rows, risk.suppress_small(rows, [], ["gender"], "race", 2), "id", ["race"]).first()
    assert (counts["n_rows"], counts["n_race"]) == (7, 1) and counts["pct_race"] == pytest.approx(100 / 7)
