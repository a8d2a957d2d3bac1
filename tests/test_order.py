"""Quantiles, profiles and scans that hold no group in one task."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import profile
from ledgerloom.operators.quantiles import quantiles

AT = {"least": 0.0, "tenth": 0.1, "quarter": 0.25, "middle": 0.5, "high": 0.99, "most": 1.0}


@pytest.mark.parametrize("bins, few", [(4, 1), (8, 3), (4096, 4096)])
def test_quantiles_are_those_of_sorted_groups(spark, bins, few):
    rng = random.Random(bins)
    groups = {"hot": [rng.gauss(0, 1) for _ in range(900)], "equal": [7.5] * 40, "wide": [10.0 ** rng.randint(-12, 12) * rng.choice([-1, 1]) for _ in range(60)], None: [float(rng.randint(0, 3)) for _ in range(50)], "one": [3.25], "huge": [-1.7e308, 1.7e308, 0.0, 5e-324], "none": []}
    rows = [(g, v) for g, values in groups.items() for v in values] + [("hot", None), ("none", None), ("hot", float("nan")), ("hot", float("inf"))]
    rng.shuffle(rows)
    found = quantiles(spark.createDataFrame(rows, "g string, v double").repartition(5), ["g"], "v", AT, bins, few)
    assert found.columns == ["g", *AT]
    got = {r["g"]: r for r in found.collect()}
    assert set(got) == set(groups)
    for g, values in groups.items():
        for name, p in AT.items():
            want = np.quantile(values, p) if values and g != "huge" else sorted(values)[round(p * 3)] if values and p in (0.0, 1.0) else None
            if want is not None:
                assert got[g][name] == pytest.approx(want, rel=1e-12), (g, name)
    assert got["none"]["middle"] is None and got["one"]["tenth"] == 3.25


def test_quantiles_of_everything_and_nothing(spark):
    rows = spark.createDataFrame([(i, float(i)) for i in range(11)], "i int, v double")
    assert quantiles(rows, [], "v", {"m": 0.5}).collect()[0]["m"] == 5.0
    assert quantiles(rows, [], "i", {"m": 0.25}).collect()[0]["m"] == 2.5
    assert [r["m"] for r in quantiles(rows.limit(0), [], "v", {"m": 0.5}).collect()] in ([], [None])
    assert quantiles(rows.limit(0), ["i"], "v", {"m": 0.5}).count() == 0


def test_a_profile_of_sixty_columns_of_every_kind(spark):
    kinds = {"n": "id % 7", "b": "id % 2", "t": "concat('x', id % 5)", "d": "date_add(date'2020-01-01', cast(id % 3 as int))", "z": "id % 2 = 0", "f": "if(id % 2 = 0, 0.0D, -0.0D)", "a": "array(id % 4)", "s": "struct(id % 6 as q)", "m": "map('k', id % 3)", "y": "cast(concat('y', id % 9) as binary)", "u": "id", "e": "cast(null as string)"}
    wide = spark.range(200).selectExpr(*(f"{expr} AS `{name}.{i}`" for i in range(5) for name, expr in kinds.items()))
    found = {r["column"]: r for r in profile.column_profile(wide, masked=["t.0"]).collect()}
    assert len(found) == 60
    want = {"n": 7, "b": 2, "t": 5, "d": 3, "z": 2, "f": 1, "a": 4, "s": 6, "m": 3, "y": 9, "u": 200, "e": 0}
    assert {c: r["n_distinct"] for c, r in found.items()} == {f"{k}.{i}": n for k, n in want.items() for i in range(5)}
    assert found["b.1"]["kind"] == "binary" and found["z.0"]["kind"] == "boolean" and found["d.0"]["kind"] == "date" and found["n.0"]["kind"] == "number"
    assert found["t.0"]["least"] is None and (found["t.1"]["least"], found["t.1"]["most"]) == ("x0", "x4") and (found["u.0"]["least"], found["u.0"]["most"]) == ("0", "199")
    assert found["e.3"]["n_null"] == 200 and all(r["n_rows"] == 200 for r in found.values())
    plan = profile.column_profile(wide)._jdf.queryExecution().executedPlan().toString()
    assert "count(distinct" not in plan and "Expand" not in plan


def test_a_profile_of_no_rows(spark):
    found = profile.column_profile(spark.createDataFrame([], "a int, b string")).collect()
    assert sorted((r["column"], r["n_rows"], r["n_distinct"]) for r in found) == [("a", 0, 0), ("b", 0, 0)]


def test_values_are_carried_over_any_ranges(spark):
    from ledgerloom.operators.ordering import carried

    rng = random.Random(2)
    rows = [(rng.choice(["a", "a", "a", "b", None]), i, rng.choice([None, None, None, rng.randint(0, 9)])) for i in range(400)]
    rows += [("z", i, 5 if i == 400 else None) for i in range(400, 500)]
    want, last = {}, {}
    for g, i, v in rows:
        last[g] = last.get(g) if v is None else v
        want[i] = last[g]
    table = spark.createDataFrame(rows, "g string, i int, v int").repartition(9)
    found = carried(table, ["g"], "i", "v", "filled")
    assert found.columns == ["g", "i", "v", "filled"]
    assert {r["i"]: r["filled"] for r in found.collect()} == want
    alone = {r["i"]: r["filled"] for r in carried(table.select("i", "v"), [], "i", "v", "filled").collect()}
    last = None
    for _, i, v in rows:
        last = last if v is None else v
        assert alone[i] == last
    assert carried(table.limit(0), ["g"], "i", "v", "filled").count() == 0
