import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from holdfast.operators import correlation, eda, neighbours
from holdfast.operators.neighbours import knn_fill, nearest
from holdfast.operators.oversample import oversample
from holdfast.operators.segments import cluster_rows


def points_frame(spark, points):
    return spark.createDataFrame([([float(x) for x in p], [float(i)]) for i, p in enumerate(points)],
                                 "point array<double>, payload array<double>").repartition(4)


@pytest.mark.parametrize("kind", ["spread", "lattice", "hot"])
def test_boxes_find_the_exact_neighbours(spark, kind):
    rng = np.random.default_rng(7)
    points = {"spread": rng.normal(0, 10, (600, 3)),
              "lattice": np.array([(a, b, c) for a in range(9) for b in range(9) for c in range(7)], dtype=float),
              "hot": np.column_stack([np.where(np.arange(600) < 250, 1.0, rng.normal(0, 5, 600)),
                                      rng.normal(0, 1, 600), rng.normal(0, 1, 600)])}[kind]
    points = np.unique(points, axis=0)
    queries = rng.normal(2, 6, (80, 3))
    q = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(queries)],
                              "qid long, q array<double>")
    near = nearest(q, points_frame(spark, points), 3, 5, box_points=40, query_chunk=30, fan=3)
    got = {}
    for r in near.collect():
        got.setdefault(r["qid"], []).append(r["distance2"])
    for i, row in enumerate(queries):
        want = np.sort(((points - row) ** 2).sum(axis=1))[:5]
        assert np.allclose(sorted(got[i]), want)


def test_queries_go_only_to_boxes_within_their_radius(spark, monkeypatch):
    points = np.random.default_rng(3).random((600, 10))
    q = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(points)], "qid long, q array<double>")
    sent, write = [], neighbours.stage

    def watched(df, name="stage", by=None):
        out = write(df, name, by)
        if name == "front":
            sent.append(out.count())
        return out

    monkeypatch.setattr(neighbours, "stage", watched)
    # Each query is a point, so its radius for one neighbour is 0.
    near = nearest(q, points_frame(spark, points), 10, 1, box_points=40, fan=4).collect()
    assert len(near) == 600 and all(r["distance2"] == 0 and r["point"] == points[r["qid"]].tolist() for r in near)
    assert max(sent) == 600
    near = nearest(q.where("qid < 20"), points_frame(spark, points), 10, 5, box_points=40, fan=4)
    got = {r["qid"]: r["ds"] for r in near.groupBy("qid").agg(F.sort_array(F.collect_list("distance2")).alias("ds")).collect()}
    assert all(np.allclose(got[i], np.sort(((points - points[i]) ** 2).sum(axis=1))[:5]) for i in range(20))


def test_products_of_matrices_leave_out_no_neighbour():
    rng = np.random.default_rng(5)
    for shift, limited in ((0.0, False), (1e7, False), (1e7, True), (1e200, False)):
        # Lattices have many equal distances; far from zero a product of matrices tells them apart wrongly.
        points = np.unique(rng.integers(0, 4, (400, 9)) * 0.1 + shift, axis=0)
        queries, first = points[rng.integers(0, len(points), 60)], rng.integers(0, 3, len(points)).astype(float)
        exact = np.zeros((len(queries), len(points)))
        with np.errstate(over="ignore"):
            for d in range(9):
                exact += (queries[:, d, None] - points[None, :, d]) ** 2
        limit = np.sort(exact, axis=1)[:, 3] if limited else np.full(len(queries), np.nan)
        got = [np.concatenate(c) for c in zip(*neighbours._closest(queries, points, first, 6, limit))]
        for i, row in enumerate(exact):
            order = [j for j in np.lexsort((np.arange(len(points)), first, row)) if not limited or row[j] <= limit[i]][:6]
            assert got[1][got[0] == i].tolist() == order and got[2][got[0] == i].tolist() == row[order].tolist()


def brute_knn(rows, t, k):
    """Mean target of the k nearest donors over shared columns, ties to the smaller target."""
    data = np.array(rows, dtype=float)
    width, out = data.shape[1], {}
    for i, r in enumerate(data):
        if not math.isnan(r[t]):
            continue
        found = []
        for d in data:
            if math.isnan(d[t]):
                continue
            shared = ~np.isnan(r) & ~np.isnan(d)
            if shared.any():
                found.append((width / shared.sum() * ((r[shared] - d[shared]) ** 2).sum(), d[t]))
        found.sort()
        if found:
            out[i] = float(np.mean([y for _, y in found[:k]]))
    return out


@pytest.mark.parametrize("limits,gappy", [({}, 3), ({"box_points": 10, "fan": 4}, 3)])
def test_knn_fill(spark, limits, gappy):
    rng = np.random.default_rng(1)
    data = np.round(rng.normal(0, 4, (150, 3)), 1)
    data[:, :gappy][rng.random((150, gappy)) < 0.2] = np.nan
    rows = [tuple(None if math.isnan(v) else float(v) for v in r) for r in data]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a double, b double, c double")
    full = {r["i"]: r for r in knn_fill(df, df, ["a", "b", "c"], 5, **limits).collect()}
    for t, name in enumerate("abc"):
        for i, v in brute_knn(data, t, 5).items():
            assert full[i][name] == pytest.approx(v)
    known = {(i, n): v for i, r in enumerate(rows) for n, v in zip("abc", r) if v is not None}
    assert all(full[i][n] == v for (i, n), v in known.items())


def test_oversampling(spark):
    rng = np.random.default_rng(5)
    rows = [(i, int(i % 5 == 0), float(a), float(b)) for i, (a, b) in enumerate(rng.normal(0, 1, (103, 2)))]
    df = spark.createDataFrame(rows, "k long, y int, a double, b double").repartition(3)
    out = oversample(df, "k", "y", ["a", "b"], 5)
    assert {r["y"]: r["count"] for r in out.groupBy("y").count().collect()} == {0: 82, 1: 82}
    minority = np.array([(a, b) for _, y, a, b in rows if y == 1])
    made = out.where(F.col("k").isNull()).collect()
    assert len(made) == 61 and all(r["y"] == 1 for r in made)
    for r in made:
        # On a segment from a minority row to one of its five nearest neighbours.
        p = np.array([r["a"], r["b"]])
        hit = False
        for base in minority:
            order = np.argsort(((minority - base) ** 2).sum(axis=1))[1:6]
            for other in minority[order]:
                step = other - base
                u = float((p - base) @ step / (step @ step))
                hit = hit or (-1e-9 <= u <= 1 + 1e-9 and np.allclose(base + u * step, p, atol=1e-9))
        assert hit
    again = oversample(df.repartition(5), "k", "y", ["a", "b"], 5)
    assert sorted(map(str, again.collect())) == sorted(map(str, out.collect()))


def test_only_drawn_rows_ask_for_neighbours(spark, monkeypatch):
    from holdfast.operators import oversample as module
    rng = np.random.default_rng(8)
    df = spark.createDataFrame([(i, int(i < 100), float(a), float(b)) for i, (a, b) in enumerate(rng.random((220, 2)))],
                               "k long, y int, a double, b double")
    asked, search = [], module.nearest

    def watched(queries, *others, **limits):
        asked.append(queries.count())
        return search(queries, *others, **limits)

    monkeypatch.setattr(module, "nearest", watched)
    made = oversample(df, "k", "y", ["a", "b"], 5).where("k IS NULL").collect()
    # 120 rows against 100: 20 are drawn, each once.
    assert len(made) == 20 and asked == [20]
    assert len(oversample(df.where("y = 0 OR k < 50"), "k", "y", ["a", "b"], 5).where("k IS NULL").collect()) == 70 and asked == [20, 50]


def test_oversampling_many_equal_rows(spark):
    rows = [(i, 1, 1.0) for i in range(8)] + [(8, 1, 5.0)] + [(100 + i, 0, float(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "k long, y int, a double")
    out = oversample(df, "k", "y", ["a"], 5)
    made = [r["a"] for r in out.where(F.col("k").isNull()).collect()]
    assert len(made) == 31 and all(1.0 <= v <= 5.0 for v in made)
    with pytest.raises(ValueError, match="more than 5"):
        oversample(df.where("k > 3"), "k", "y", ["a"], 5)


def derived(spark, n=60):
    """Customers by an expression that a plan shows, to see whether they are derived again."""
    rows = spark.createDataFrame([(i, float(i % 71), float(i * 7 % 31), float(i * 5 % 43)) for i in range(n)],
                                 "customer_id long, tenure double, monthly_charges double, total_charges double")
    return rows.where(F.sha2(F.col("customer_id").cast("string"), 256) != "")


def test_oversampling_and_fill_derive_their_rows_once(spark, monkeypatch):
    from holdfast.catalog import QUERIES, preparation, training  # noqa: F401
    for module in (preparation, training):
        monkeypatch.setattr(module, "customer_base", lambda spark, sf: derived(spark, 200))
    for name, rows in (("m8_oversampled_classes", 2), ("i4_knn_three_gaps", 200)):
        out = QUERIES[name](spark, "")
        assert "sha2" not in out._jdf.queryExecution().executedPlan().toString()
        assert out.count() == rows


# ---- correlation --------------------------------------------------------------------------

def columns(n=300, seed=2):
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 12, n).astype(float)
    b = np.round(a + rng.normal(0, 4, n), 1)
    c = np.where(rng.random(n) < 0.4, 0.0, rng.normal(0, 1, n))
    y = (rng.random(n) < 0.4).astype(float)
    return pd.DataFrame({"a": a, "b": b, "c": c, "y": y})


def brute_tau(x, y):
    sx, sy = np.sign(x[:, None] - x[None, :]), np.sign(y[:, None] - y[None, :])
    return float((sx * sy).sum() / math.sqrt((sx != 0).sum() * (sy != 0).sum()))


@pytest.mark.parametrize("limits", [{}, {"slices": 7}])
@pytest.mark.parametrize("method", ["pearson", "spearman", "kendall"])
def test_correlation(spark, method, limits):
    data = columns()
    rows = [tuple(r) for r in data.itertuples(index=False)] + [(None, 1.0, 2.0, 0.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y double").repartition(4)
    got = {(r["x"], r["y"]): r["r"] for r in correlation.correlation(df, list("abcy"), method, **limits).collect()}
    assert len(got) == 16
    ranks = data.rank() if method == "spearman" else data
    for x in "abcy":
        for z in "abcy":
            want = 1.0 if x == z else brute_tau(data[x].to_numpy(), data[z].to_numpy()) if method == "kendall" \
                else float(np.corrcoef(ranks[x], ranks[z])[0, 1])
            assert got[(x, z)] == pytest.approx(want, abs=1e-9)


def test_label_correlation_order(spark):
    df = spark.createDataFrame([(float(i), float(-i % 7), float(i > 20)) for i in range(40)], "a double, b double, y double")
    got = correlation.label_correlation(df, ["a", "b"], "y").collect()
    assert [r["x"] for r in got] == ["a", "b"] and abs(got[0]["r"]) >= abs(got[1]["r"])
    with pytest.raises(ValueError):
        correlation.correlation(df, ["a", "b"], "cosine")


# ---- distributions ---------------------------------------------------------------------------

def test_histogram_equals_numpy(spark):
    data = np.round(np.random.default_rng(3).normal(0, 1, 500), 2)
    df = spark.createDataFrame([(float(v),) for v in data] + [(None,)], "v double")
    rows = eda.histogram(df, "v").orderBy("bin").collect()
    counts, edges = np.histogram(data, 40)
    assert [r["n"] for r in rows] == list(counts)
    assert [r["low"] for r in rows] == pytest.approx(list(edges[:-1]))
    assert rows[0]["median"] == pytest.approx(np.median(data))
    flat = eda.histogram(spark.createDataFrame([(2.0,)] * 3, "v double"), "v", 4).orderBy("bin").collect()
    assert [r["n"] for r in flat] == list(np.histogram([2.0] * 3, 4)[0])


def test_box_stats(spark):
    data = {0: [1.0, 2.0, 3.0, 4.0, 100.0], 1: [5.0, 5.0, 6.0]}
    df = spark.createDataFrame([(k, v) for k, vs in data.items() for v in vs], "y int, v double")
    rows = {r["category"]: r for r in eda.box_stats(df, "v", "y").collect()}
    assert (rows[0]["q1"], rows[0]["median"], rows[0]["q3"]) == (2.0, 3.0, 4.0)
    assert (rows[0]["whisker_low"], rows[0]["whisker_high"], rows[0]["n_fliers"]) == (1.0, 4.0, 1)
    assert rows[1]["n"] == 3


def test_box_stats_neither_sort_nor_gather_the_rows_of_a_class(spark):
    df = spark.createDataFrame([(k, float(v)) for k in "ab" for v in range(5)], "y string, v double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = eda.box_stats(df, "v", "y")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "SortMergeJoin" not in plan
        assert sorted((r["category"], r["median"], r["n"]) for r in out.collect()) == [("a", 2.0, 5), ("b", 2.0, 5)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_kernel_density(spark):
    rng = np.random.default_rng(9)
    data = {"a": np.round(rng.normal(0, 1, 80), 1), "b": rng.normal(5, 2, 60)}
    df = spark.createDataFrame([(k, float(v)) for k, vs in data.items() for v in vs], "g string, v double")
    got = eda.kernel_density(df, "v", "g", points=50).toPandas().sort_values("i")
    for k, v in data.items():
        part = got[got.category == k]
        reach = 0.5 * (v.max() - v.min())
        grid = np.linspace(v.min() - reach, v.max() + reach, 50)
        width = v.std(ddof=1) * len(v) ** -0.2
        want = np.exp(-0.5 * ((grid[:, None] - v[None, :]) / width) ** 2).sum(axis=1) / (len(v) * width * math.sqrt(2 * math.pi))
        assert np.allclose(part["x"], grid) and np.allclose(part["density"], want)
    violin = eda.violin_stats(df, "v", "g").where("category = 'a' and i = 0").first()
    assert (violin["low"], violin["high"]) == (data["a"].min(), data["a"].max()) and violin["x"] == violin["low"]
    with pytest.raises(ValueError):
        eda.kernel_density(df.withColumn("v", F.lit(1.0)), "v", "g")


def test_rates(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 0), ("b", "x", 1), (None, "x", 0)], "c string, d string, y int")
    rows = eda.rate_by(df, "c", "y").collect()
    assert [(r["category"], r["n"], r["rate_pct"], r["overall_pct"]) for r in rows] == [
        ("b", 1, 100.0, 50.0), ("a", 2, 50.0, 50.0)]
    pivot = {r["c"]: (r["x"], r["y"]) for r in eda.rate_pivot(df, "c", "d", "y").collect()}
    assert pivot == {"a": (100.0, 0.0), "b": (100.0, None)}
    counts = [tuple(r) for r in eda.value_counts(df, ["c", "d"]).collect()]
    assert counts == [("c", "a", 2), ("c", "b", 1), ("d", "x", 3), ("d", "y", 1)]
    classes = {r["label_text"]: (r["n"], r["pct"], r["imbalance_ratio"]) for r in eda.class_distribution(df, "y").collect()}
    assert classes == {"Churn": (2, 50.0, 1.0), "No Churn": (2, 50.0, 1.0)}


def test_clusters(spark):
    rows = [(i, float(i % 3) * 100 + i * 0.01, float(i % 3) * -50) for i in range(60)] + [(60, None, 1.0)]
    df = spark.createDataFrame(rows, "k int, a double, b double")
    out = cluster_rows(df, ["a", "b"], 3).collect()
    assert len(out) == 60
    for part in range(3):
        assert len({r["cluster"] for r in out if r["k"] % 3 == part}) == 1
