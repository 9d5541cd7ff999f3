
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from holdfast import settings
from holdfast.operators import binning, encode, impute, models, outliers, quality, scale
from holdfast.operators.base import FittedOperator, NotFittedError
from holdfast.operators.features import FEATURES, derive_features
from tests.conftest import values


def frame(spark, name, data, kind="double"):
    """Rows in a known order: the column and an index."""
    return spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, {name} {kind}")


def column(df, name):
    return [r[name] for r in df.orderBy("i").collect()]


# ---- quality ------------------------------------------------------------------------

def test_null_report(spark):
    df = spark.createDataFrame([(1, None, float("nan")), (2, "x", 1.0), (3, None, 2.0)], "a int, b string, c double")
    assert [tuple(r) for r in quality.null_report(df).collect()] == [("b", 2, 66.67), ("c", 1, 33.33)]
    assert quality.null_report(df, only_missing=False).count() == 3
    assert quality.total_nulls(df).first()[0] == 3


def test_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "x"), (2, "x"), (1, None)], "k int, v string")
    assert quality.duplicate_rows(df).first()[0] == 2
    assert quality.duplicate_keys(df, "k").first()[0] == 3


def test_profile_and_label_rate(spark):
    df = spark.createDataFrame([(1, "b", None), (1, "a", None), (0, None, None)], "y int, s string, e double")
    for approximate in (False, True):
        got = {r["column"]: (r["dtype"], r["n_unique"], r["sample"])
               for r in quality.column_profile(df, approximate).collect()}
        assert got == {"y": ("int", 2, "0"), "s": ("string", 2, "a"), "e": ("double", 0, None)}
    row = quality.label_rate(df, "y").first()
    assert (row["n_rows"], row["n_columns"], round(row["label_rate_pct"], 4)) == (3, 3, 66.6667)


def test_quality_report(spark):
    df = spark.createDataFrame([(1, 0.0), (1, 1.0), (2, None)], "k int, y double")
    report = quality.quality_report(df, "y", "k")
    assert set(report) == {"nulls", "duplicate_rows", "label", "duplicate_keys"}
    assert report["label"].first()["label_rate_pct"] == 50.0 and report["duplicate_keys"].first()[0] == 1


def test_describe_matches_pandas(spark):
    data = [float(v) for v in np.random.default_rng(3).normal(50, 20, 101)]
    got = quality.describe(frame(spark, "v", data), ["v", "absent"]).first().asDict()
    want = pd.Series(data).describe().round(2)
    assert [got[k] for k in ("count", "mean", "std", "min", "q25", "q50", "q75", "max")] == pytest.approx(list(want))


def test_z_outliers_use_the_population_deviation(spark):
    data = [1.0, 2.0, 3.0, 4.0, 5.0, None, 100.0]
    df = frame(spark, "v", data)
    kept = np.array([v for v in data if v is not None])
    limit = abs((100.0 - kept.mean()) / kept.std()) - 1e-9
    assert values(quality.z_outlier_rows(df, ["v"], limit), "v") == [100.0]
    assert quality.z_outlier_rows(df, ["v"], limit + 1e-6).count() == 0
    assert quality.z_outlier_summary(df, ["v"], limit).first()["n_outliers"] == 1
    assert quality.z_outlier_rows(frame(spark, "v", [3.0, 3.0]), ["v"]).count() == 0


def test_expectations(spark, raw_df):
    df = raw_df.withColumn("Churn", (F.col("Churn") == "Yes").cast("int"))
    got = {r["check"]: r["passed"] for r in quality.expectations(
        df, settings.EXPECTED_COLUMNS, ["Churn", "SeniorCitizen"], "Churn", ["customerID", "Churn", "tenure"]).collect()}
    assert all(got.values()) and len(got) == 7
    bad = df.drop("gender").withColumn("Churn", F.lit(2)).withColumn("tenure", F.lit(None).cast("int"))
    failed = {r["check"] for r in quality.expectations(
        bad, settings.EXPECTED_COLUMNS, ["Churn"], "Churn", ["tenure"]).collect() if not r["passed"]}
    assert failed == {"missing_columns", "label_rate:Churn", "not_binary:Churn", "nulls:tenure"}


# ---- imputation ------------------------------------------------------------------------

def test_mean_and_median(spark):
    data = [float(v) for v in np.random.default_rng(0).normal(50, 10, 20)]
    data[0] = data[10] = None
    df = frame(spark, "value", data)
    kept = [v for v in data if v is not None]
    for cls, want in ((impute.MeanImputer, np.mean(kept)), (impute.MedianImputer, np.median(kept))):
        filled = column(cls(["value"]).fit_transform(df), "value")
        assert filled[0] == pytest.approx(want) and filled[10] == pytest.approx(want)
        assert filled[1] == data[1]


def test_nan_counts_as_missing(spark):
    df = frame(spark, "v", [1.0, float("nan"), 3.0])
    assert column(impute.MeanImputer(["v"]).fit_transform(df), "v") == [1.0, 2.0, 3.0]


def test_mode(spark):
    df = frame(spark, "label", ["red", None, "tin", "red", "oak", "tin", "red", None], "string")
    filled = column(impute.ModeImputer(["label"]).fit_transform(df), "label")
    assert filled[1] == filled[7] == "red" and filled[4] == "oak"
    tie = frame(spark, "label", ["b", "a", None], "string")
    assert column(impute.ModeImputer(["label"]).fit_transform(tie), "label")[2] == "a"
    empty = frame(spark, "label", [None, None], "string")
    assert column(impute.ModeImputer(["label"]).fit_transform(empty), "label") == [None, None]


def test_train_fill_values_are_applied_to_test_rows(spark):
    train = frame(spark, "x", [10.0, 10.0, 10.0, None])
    test = frame(spark, "x", [None, 90.0, 90.0])
    assert column(impute.MedianImputer(["x"]).fit(train).transform(test), "x") == [10.0, 90.0, 90.0]


def test_handler(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, None), (3.0, "a")], "n double, c string")
    for strategy, want in (("median", 2.0), ("MEAN", 2.0), ("mode", 1.0), ("knn", 2.0)):
        handler = impute.MissingValueHandler(strategy, ["n"], ["c"])
        assert [tuple(r) for r in handler.fit_transform(df).collect()][1] == (want, "a")
    with pytest.raises(ValueError):
        impute.MissingValueHandler("guess", ["n"])
    with pytest.raises(NotFittedError):
        impute.MissingValueHandler("mean", ["n"]).transform(df)


# ---- outliers ---------------------------------------------------------------------------

def clean_values():
    return [float(v) for v in np.random.default_rng(1).normal(50, 5, 50)]


@pytest.mark.parametrize("extreme", [9999.0, -9999.0])
@pytest.mark.parametrize("method", ["iqr", "zscore"])
def test_caps_with_bounds_of_the_clean_rows(spark, method, extreme):
    clean = clean_values()
    dirty = [extreme, *clean[1:], None]
    handler = outliers.OutlierHandler(method, "cap", ["value"]).fit(frame(spark, "value", clean))
    low, high = handler.state["value"]
    got = column(handler.transform(frame(spark, "value", dirty)), "value")
    assert got[0] == (high if extreme > 0 else low) and got[-1] is None
    if method == "iqr":
        q1, q3 = np.quantile(clean, [0.25, 0.75])
        assert (low, high) == pytest.approx((q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)))
    else:
        assert high == pytest.approx(np.mean(clean) + 3 * np.std(clean, ddof=1))


def test_remove_drops_extremes_and_missing(spark):
    handler = outliers.OutlierHandler("zscore", "remove", ["value", "absent"]).fit(
        frame(spark, "value", clean_values()))
    got = handler.transform(frame(spark, "value", [9999.0, 50.0, None]))
    assert values(got, "value") == [50.0]


def test_outlier_names(spark):
    with pytest.raises(ValueError):
        outliers.OutlierHandler("magic")
    with pytest.raises(ValueError):
        outliers.OutlierHandler(action="hide")
    row = outliers.outlier_counts(frame(spark, "v", [1.0, 5.0, 9.0, None]), {"v": [2.0, 8.0]}).first()
    assert tuple(row) == ("v", 2.0, 8.0, 2)


# ---- derived features ----------------------------------------------------------------------

@pytest.mark.parametrize("tenure,want", [(0, "New"), (6, "New"), (18, "Developing"), (36, "Established"),
                                         (55, "Loyal"), (65, "Champion"), (74, "nan")])
def test_tenure_segments(rows_of, tenure, want):
    assert derive_features(rows_of({"tenure": tenure})).first()["tenure_category"] == want


def test_ratio(rows_of):
    got = derive_features(rows_of({"tenure": 0, "TotalCharges": 500.0}, {"tenure": 10, "TotalCharges": 650.0}))
    assert values(got, "charge_to_tenure_ratio") == [0.0, 65.0]


def test_services(rows_of):
    every = {c: "Yes" for c in settings.SERVICE_COLUMNS} | {"InternetService": "Fiber optic"}
    all_on, base = derive_features(rows_of(every, {})).collect()
    assert all_on["service_adoption_score"] == 1.0
    assert (all_on["num_streaming_services"], all_on["num_security_services"], all_on["intl_usage_flag"]) == (2, 3, 1)
    assert base["service_adoption_score"] == 0.2222
    # 0.2222 * 9 + 1 = 2.9998: the rounded score is used.
    assert base["avg_monthly_charge_per_service"] == round(65 / 2.9998, 4)


def test_payment_contract_internet(rows_of):
    methods = [*settings.AUTO_PAYMENT_METHODS, "Electronic check", "Mailed check"]
    got = derive_features(rows_of(*[{"PaymentMethod": m} for m in methods]))
    assert values(got, "payment_reliability") == [1, 1, 0, 0]
    got = derive_features(rows_of(*[{"Contract": c} for c in ("Month-to-month", "One year", "Two year")]))
    assert values(got, "is_long_term_contract") == [0, 0, 1]
    got = derive_features(rows_of({"InternetService": "No"}, {"InternetService": "DSL"}))
    assert values(got, "has_internet") == [0, 1]


def test_missing_inputs(spark, rows_of):
    names = ["tenure", "TotalCharges", "PaymentMethod", "Contract", "InternetService", "MultipleLines"]
    df = rows_of({})
    df = df.withColumns({n: F.lit(None).cast(dict(df.dtypes)[n]) for n in names})
    row = derive_features(df).first()
    assert [row[c] for c in ("tenure_category", "charge_to_tenure_ratio", "payment_reliability", "has_internet",
                             "is_long_term_contract", "intl_usage_flag")] == ["nan", 0.0, 0, 1, 0, 0]
    few = derive_features(rows_of({}).drop(*settings.SERVICE_COLUMNS[3:], "MultipleLines"))
    assert few.first()["intl_usage_flag"] == 0 and few.first()["service_adoption_score"] == 0.5
    assert list(derive_features(rows_of({})).columns[-10:]) == list(FEATURES)


# ---- encoding --------------------------------------------------------------------------------

PLANS = ["trial", "basic", "gold", "gold", "trial", "trial"]


def test_onehot(spark):
    df = frame(spark, "plan", PLANS, "string")
    dropped = encode.OneHotEncoder(["plan"]).fit_transform(df)
    assert dropped.columns == ["i", "plan_gold", "plan_trial"]
    assert column(dropped, "plan_gold") == [int(p == "gold") for p in PLANS]
    assert column(dropped, "plan_trial") == [int(p == "trial") for p in PLANS]
    full = encode.OneHotEncoder(["plan"], drop_first=False).fit(df)
    assert full.transform(df).columns == ["i", "plan_basic", "plan_gold", "plan_trial"]
    unseen = full.transform(frame(spark, "plan", ["silver", None], "string"))
    assert [tuple(r)[1:] for r in unseen.collect()] == [(0, 0, 0), (0, 0, 0)]


def test_onehot_of_numbers_sorts_by_value(spark):
    df = frame(spark, "n", [10, 9, 100], "int")
    assert encode.OneHotEncoder(["n"], drop_first=False).fit_transform(df).columns == ["i", "n_9", "n_10", "n_100"]


def test_onehot_of_dates(spark):
    days = spark.sql("SELECT id, date_add(DATE'2024-01-01', CAST(id AS INT)) AS d FROM range(3)")
    assert encode.OneHotEncoder(["d"]).fit_transform(days).columns == ["id", "d_2024-01-02", "d_2024-01-03"]


def test_one_hot_vectors_of_any_width(spark):
    df = spark.range(3000).select(F.col("id"), F.when(F.col("id") != 7, F.col("id") % 2500).alias("k"), (F.col("id") % 2).alias("y"))
    fitted = encode.OneHotEncoder(["k"], output="vector").fit(df)
    out = fitted.transform(df.unionByName(spark.sql("SELECT 9000L AS id, -1L AS k, 0L AS y")))
    assert out.columns == ["id", "y", "k_onehot"] and models.feature_columns(out, "y", "id") == ["k_onehot"]
    order = {w: i for i, w in enumerate(sorted({str(i % 2500) for i in range(3000) if i != 7}))}
    for r in out.collect():
        code = order.get(str(r["id"] % 2500)) if r["id"] not in (7, 9000) else None
        v = r["k_onehot"]
        assert v.size == len(order) - 1 and v.indices.tolist() == ([] if not code else [code - 1])
    model = models.fit_model(out, "logistic_regression", ["k_onehot"], "y", {"max_iter": 3})
    assert models.with_score(out, model).where("score BETWEEN 0 AND 1").count() == 3001


def test_label_codes(spark):
    df = frame(spark, "tier", ["t9", "t10", None, "t1", "t10", "t9"], "string")
    fitted = encode.LabelEncoder(["tier"]).fit(df)
    # In the order of texts; a missing one counts as "None".
    assert column(fitted.transform(df), "tier") == [3, 2, 0, 1, 2, 3]
    other = frame(spark, "tier", ["t2"], "string")
    with pytest.raises(Exception, match="unseen category"):
        fitted.transform(other).collect()
    kept = encode.LabelEncoder(["tier"], unseen="keep").fit(df)
    assert column(kept.transform(other), "tier") == [None]


def test_target_means(spark):
    df = spark.createDataFrame([(i, p, int(i in (1, 2, 5))) for i, p in enumerate(PLANS)], "i int, plan string, y int")
    fitted = encode.TargetEncoder(["plan"], "y").fit(df)
    assert column(fitted.transform(df), "plan") == pytest.approx([1 / 3, 1.0, 0.5, 0.5, 1 / 3, 1 / 3])
    other = frame(spark, "plan", ["silver", None], "string")
    assert column(fitted.transform(other), "plan") == [0.5, 0.5]
    with pytest.raises(ValueError):
        encode.TargetEncoder(["plan"]).fit(df)


def test_encoder_by_name(spark, raw_df):
    few = raw_df.limit(3)
    out = encode.create_encoder("onehot").fit_transform(few)
    assert "gender" not in out.columns and not set(settings.CATEGORICAL_COLUMNS) & set(out.columns)
    with pytest.raises(ValueError):
        encode.create_encoder("hashing")


# ---- scaling ----------------------------------------------------------------------------------

def test_scalers(spark):
    data = [1.0, 2.0, None, 4.0, 10.0]
    kept = np.array([1.0, 2.0, 4.0, 10.0])
    df = frame(spark, "v", data)
    q1, q3 = np.quantile(kept, [0.25, 0.75])
    for name, want in {"standard": (kept - kept.mean()) / kept.std(), "minmax": (kept - 1) / 9,
                       "robust": (kept - np.median(kept)) / (q3 - q1)}.items():
        got = column(scale.create_scaler(name, ["v", "absent"]).fit_transform(df), "v")
        assert got[2] is None and [g for g in got if g is not None] == pytest.approx(list(want))
    with pytest.raises(ValueError):
        scale.create_scaler("log")


@pytest.mark.parametrize("name", ["standard", "minmax", "robust"])
def test_constant_and_empty_columns(spark, name):
    constant = frame(spark, "v", [5.0, 5.0])
    assert column(scale.create_scaler(name, ["v"]).fit_transform(constant), "v") == [0.0, 0.0]
    empty = frame(spark, "v", [None, None])
    assert column(scale.create_scaler(name, ["v"]).fit_transform(empty), "v") == [None, None]


# ---- binning ------------------------------------------------------------------------------------

def pandas_bins(train, test, n, strategy, labels):
    cut = pd.cut(pd.Series(train).dropna(), n, retbins=True, include_lowest=True) if strategy == "uniform" else \
        pd.qcut(pd.Series(train).dropna(), n, retbins=True, duplicates="drop")
    edges = cut[1]
    k = len(edges) - 1
    use = labels[:k] if labels and len(labels) >= k else None
    return pd.cut(pd.Series(test), edges, labels=use, include_lowest=True).astype(str).tolist()


DATASETS = {
    "spread": [float(v) for v in np.random.default_rng(4).normal(0, 3, 60)],
    "small": [float(v) for v in np.random.default_rng(5).uniform(0, 0.01, 40)],
    "repeated": [1.0] * 30 + [2.0, 3.0, 4.0, 50.5],
    "constant": [7.0] * 5,
    "integers": [float(v) for v in range(100)],
}


@pytest.mark.parametrize("strategy", ["quantile", "uniform"])
@pytest.mark.parametrize("labels", [None, ["a", "b", "c", "d"], ["a"]])
def test_bins_match_pandas(spark, strategy, labels):
    def wide(columns):
        """One column per data set, shorter ones filled up with nulls."""
        n = max(len(v) for v in columns.values())
        rows = list(zip(range(n), *[v + [None] * (n - len(v)) for v in columns.values()]))
        return spark.createDataFrame(rows, "i int, " + ", ".join(f"{c} double" for c in columns))

    tests = {c: [*v[:5], min(v), max(v), max(v) + 1e6, min(v) - 1e6, None] for c, v in DATASETS.items()}
    fitted = binning.FeatureBinner([binning.BinConfig(c, 4, strategy, labels) for c in DATASETS]).fit(wide(DATASETS))
    got = fitted.transform(wide(tests)).orderBy("i").collect()
    for c, train in DATASETS.items():
        assert [r[f"{c}_bin"] for r in got] == pandas_bins(train, tests[c], 4, strategy, labels)


def test_binning_switch_and_absent_column(spark):
    df = frame(spark, "v", [1.0, 2.0])
    off = binning.FeatureBinner([binning.BinConfig("v", 2)], enabled=False)
    assert off.fit_transform(df).columns == ["i", "v"]
    assert binning.FeatureBinner([binning.BinConfig("w", 2)]).fit_transform(df).columns == ["i", "v"]


# ---- saved state -----------------------------------------------------------------------------------

def test_operators_restore_from_their_state(spark):
    df = frame(spark, "v", [1.0, 2.0, None, 40.0])
    for fitted in (impute.MissingValueHandler("mean", ["v"]).fit(df), outliers.OutlierHandler(columns=["v"]).fit(df),
                   scale.create_scaler("robust", ["v"]).fit(df),
                   binning.FeatureBinner([binning.BinConfig("v", 2)]).fit(df)):
        again = FittedOperator.from_dict(fitted.to_dict())
        assert again.transform(df).collect() == fitted.transform(df).collect()
    with pytest.raises(TypeError):
        FittedOperator.from_dict({"kind": "something else"})
