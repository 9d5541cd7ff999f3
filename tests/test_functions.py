import math
import random
from functools import partial

import numpy as np
import pytest
from hypothesis import given, settings as hyp
from hypothesis import strategies as st
from pyspark.sql import functions as F

from holdfast.functions import expressions as X
from holdfast.functions.ordering import row_numbers, running_totals
from holdfast.functions import selection
from holdfast.functions.selection import exact_quantiles, order_statistics


def one(spark, column, **cells):
    kinds = {str: "string", int: "int", float: "double", type(None): "string"}
    schema = ", ".join(f"{k} {kinds[type(v)]}" for k, v in cells.items())
    return spark.createDataFrame([tuple(cells.values())], schema).select(column).first()[0]


@pytest.mark.parametrize("text,want", [
    ("1560.0", 1560.0), (" 12 ", 12.0), ("\t4", 4.0), (".5", 0.5), ("5.", 5.0), ("+3", 3.0), ("1e5", 1e5),
    (" ", None), ("", None), ("12d", None), ("5f", None), ("1,000", None), ("0x10", None), ("nan", None),
    ("1_000", None), ("1e", None), ("inf", math.inf), ("-Infinity", -math.inf), (None, None)])
def test_to_number(spark, text, want):
    assert one(spark, X.to_number(F.col("c")), c=text) == want


def test_round_follows_the_scaled_value(spark):
    assert one(spark, X.round_to(F.col("c"), 4), c=0.00015) == 0.0001
    assert one(spark, X.round_to(F.col("c"), 0), c=2.5) == 2.0


@pytest.mark.parametrize("value,want", [("Yes", 1), (" yes ", 1), ("DSL", 1), ("Fiber optic", 1), ("No", 0),
                                        ("No internet service", 0), (None, 0), (1, 1), (0, 0), (2.5, 1),
                                        (float("nan"), 1)])
def test_service_active(spark, value, want):
    kind = {str: "string", int: "int", float: "double", type(None): "string"}[type(value)]
    df = spark.createDataFrame([(value,)], f"c {kind}")
    assert df.select(X.service_active(df, "c")).first()[0] == want


def test_service_active_missing_number(spark):
    df = spark.createDataFrame([(None,)], "c int")
    assert df.select(X.service_active(df, "c")).first()[0] == 1


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (-5.0,), (5.0,), (50.0,)], "c double")
    assert [r[0] for r in df.select(X.clip(F.col("c"), 0.0, 10.0)).collect()] == [None, 0.0, 5.0, 10.0]


def test_cut_edges(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 12.0, 12.5, 73.0, 73.1, -1.0, None)], "c double")
    got = [r[0] for r in df.select(X.cut(F.col("c"), [0, 12, 73], ["a", "b"])).collect()]
    assert got == ["a", "a", "b", "b", "nan", "nan", "nan"]
    assert df.select(X.cut(F.col("c"), [5.0], [])).first()[0] == "nan"


def test_label_text_and_number(spark):
    df = spark.createDataFrame([("Yes",), ("No",), ("1",), ("0",), ("x",), (None,)], "c string")
    assert [r[0] for r in df.select(X.label_text(F.col("c"))).collect()] == [
        "Churn", "No Churn", "Churn", "No Churn", None, None]
    assert [r[0] for r in df.select(X.label_number(F.col("c"))).collect()] == [1, 0, 1, 0, None, None]


def test_stream_tier_uses_the_rounded_score(spark):
    df = spark.createDataFrame([(0.6999996,)], "s double")
    row = df.select(X.risk_tier(F.col("s")), X.stream_tier(X.round_to(F.col("s"), 6))).first()
    assert tuple(row) == ("Medium", "HIGH")


def test_hash_orders_are_below_two_to_52(spark):
    df = spark.range(200)
    for method in ("xxhash64", "md5"):
        got = [r[0] for r in df.select(X.hash_order(F.col("id"), 7, method)).collect()]
        assert len(set(got)) == 200 and min(got) >= 0 and max(got) < 2**52
    with pytest.raises(ValueError):
        X.hash_order(F.col("id"), 7, "crc")


def _skewed(n, seed):
    rnd = random.Random(seed)
    return [7.25 if i % 3 == 0 else float(rnd.choice([rnd.gauss(0, 50), rnd.randint(0, 9)])) for i in range(n)]


@pytest.mark.parametrize("few, slices", [(10, 5), (100_000, None)])
def test_quantiles_by_brackets_equal_numpy(spark, monkeypatch, few, slices):
    monkeypatch.setattr(selection, "few_sketched", partial(selection.few_sketched, accuracy=500, reach=0.004, few=few))
    data = _skewed(4000, 3)
    df = spark.createDataFrame([(v, None if i % 7 == 0 else -v, float("nan")) for i, v in enumerate(data)],
                               "a double, b double, c double").repartition(6)
    probs = [0.0, 0.1, 0.25, 0.333, 0.5, 0.75, 0.99, 1.0]
    got = exact_quantiles(df, {c: F.col(c) for c in "abc"}, probs, slices)
    assert np.allclose(got["a"], np.quantile(data, probs))
    assert np.allclose(got["b"], np.quantile([-v for i, v in enumerate(data) if i % 7], probs))
    assert got["c"] == [None] * len(probs)


def test_quantiles_of_many_groups(spark):
    """One group holds half of the rows, one value half of that group; others have few rows, or only nulls."""
    rnd = random.Random(5)
    rows = [("hot", 7.5 if i % 2 else rnd.gauss(0, 9)) for i in range(6000)]
    rows += [(f"g{i}", float(rnd.randint(0, 50))) for i in range(1500) for _ in range(rnd.randint(1, 6))] + [("none", None)]
    df = spark.createDataFrame(rows, "name string, value double").repartition(5)
    probs = [0.25, 0.5, 0.9]
    groups = {}
    for g, v in rows:
        groups.setdefault(g, []).append(v)
    got = {r["name"]: (r["n"], r["quantiles"]) for r in selection.group_quantiles(df, probs, slices=6).collect()}
    assert set(got) == set(groups) - {"none"}
    for g, (n, q) in got.items():
        assert n == len(groups[g]) and np.allclose(q, np.quantile(groups[g], probs))


def test_a_sketch_that_misleads_is_made_good(spark):
    """Brackets that lie far from the values they should be give the same positions."""
    rows = spark.createDataFrame([("a", i) for i in range(500)] + [("b", i % 3) for i in range(300)], "name string, value long")
    groups = spark.createDataFrame([("a", 500, [400, 410], [420, 430], [0, 250, 499]), ("b", 300, [2, 2], [2, None], [0, 99, 100, 299])],
                                   "name string, n long, lows array<long>, highs array<long>, ranks array<long>")
    got = {(r["name"], r["rank"]): (r["value"], r["below"], r["equal"]) for r in selection.positions(rows, groups, 2, 4).collect()}
    assert got == {("a", 0): (0, 0, 1), ("a", 250): (250, 250, 1), ("a", 499): (499, 499, 1), ("b", 0): (0, 0, 100),
                   ("b", 99): (0, 0, 100), ("b", 100): (1, 100, 100), ("b", 299): (2, 200, 100)}


def test_quantiles_of_few_rows(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), (10.0,)], "a double")
    assert exact_quantiles(df, {"a": F.col("a")}, [0.25, 0.5, 0.75])["a"] == [1.5, 2.0, 6.0]
    assert exact_quantiles(df, {}, [0.5]) == {}


@hyp(max_examples=12, deadline=None)
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=60), st.data())
def test_order_statistics_property(spark, data, draw):
    ranks = draw.draw(st.lists(st.integers(0, len(data) - 1), min_size=1, max_size=4))
    df = spark.createDataFrame([(v,) for v in data], "v long")
    got = order_statistics(df, {"v": F.col("v")}, {"v": ranks}, {"v": len(data)}, slices=3)
    ordered = sorted(data)
    for r in ranks:
        spot = got[("v", r)]
        assert (spot.value, spot.below, spot.equal) == (
            ordered[r], sum(v < ordered[r] for v in data), data.count(ordered[r]))


def test_order_statistics_rejects_positions_outside(spark):
    with pytest.raises(IndexError):
        order_statistics(spark.range(3), {"v": F.col("id")}, {"v": [3]}, {"v": 3})


def test_row_numbers_in_slices(spark):
    keys = [f"k{random.Random(1).random():.9f}-{i}" for i in range(500)]
    df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(5)
    got = {r["k"]: r["n"] for r in row_numbers(df, [F.asc("k")], "n", slices=9).collect()}
    assert got == {k: i + 1 for i, k in enumerate(sorted(keys))}


@pytest.mark.parametrize("slices", [11, None])
def test_running_totals_in_slices(spark, slices):
    data = [(i, (i * 7919) % 101) for i in range(400)]
    df = spark.createDataFrame(data, "k long, v long").repartition(6)
    got = running_totals(df, [F.desc("k")], {"t": "v"}, slices=slices).select("k", "t").collect()
    total, want = 0, {}
    for k, v in sorted(data, reverse=True):
        total += v
        want[k] = total
    assert {r["k"]: r["t"] for r in got} == want


def test_running_totals_of_groups(spark):
    """Groups that fill several slices, share one, or have no name."""
    rnd = random.Random(3)
    data = [(rnd.choice(["hot"] * 8 + ["a", "b", None]), k, rnd.randint(-5, 9)) for k in range(600)] + [("x", k, 1) for k in range(3)]
    df = spark.createDataFrame(data, "g string, k long, v long").repartition(6)
    got = running_totals(df, [F.asc("k")], {"t": "v", "u": "k"}, "g", slices=13)
    assert got.columns == ["g", "k", "v", "t", "u"]
    want, sums = set(), {}
    for g, k, v in sorted(data, key=lambda r: r[1]):
        t, u = sums.get(g, (0, 0))
        sums[g] = t + v, u + k
        want.add((g, k, v, *sums[g]))
    assert {tuple(r) for r in got.collect()} == want
    assert running_totals(df.limit(0), [F.asc("k")], {"t": "v"}, "g").count() == 0


def test_rows_of_a_few_large_groups_do_not_meet_in_one_task(spark, monkeypatch):
    plans, write = {}, selection.stage

    def watched(df, name="stage", by=None):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name, by)

    monkeypatch.setattr(selection, "stage", watched)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(40).select((F.col("id") % 2).cast("string").alias("name"), F.col("id").cast("double").alias("value"))
        assert exact_quantiles(df, {"a": F.col("value"), "b": -F.col("value")}, [0.5]) == {"a": [19.5], "b": [-19.5]}
        assert "BroadcastHashJoin" in plans["counts"]
        got = {r["name"]: r["quantiles"] for r in selection.group_quantiles(df, [0.5]).collect()}
        assert got == {"0": [19.0], "1": [20.0]} and "BroadcastHashJoin" in plans["counts"]
        # Many groups are met by the group instead.
        monkeypatch.setattr(selection, "SENT", 1)
        assert {r["name"]: r["quantiles"] for r in selection.group_quantiles(df, [0.5]).collect()} == got
        assert "BroadcastHashJoin" not in plans["counts"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
