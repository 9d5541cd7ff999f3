import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast import settings
from holdfast.operators import models
from holdfast.operators.base import NotFittedError
from holdfast.operators.encode import create_encoder
from holdfast.operators.impute import MissingValueHandler
from holdfast.operators.outliers import OutlierHandler
from holdfast.plans import report
from holdfast.plans import search
from holdfast.plans.prepare import Preprocessor, PrepareSettings, prepare
from holdfast.plans.score import predict, score_rows
from holdfast.plans.train import run_training
from holdfast.session import scratch_path, shared_folder
from holdfast.sources import artefacts, files
from holdfast.streaming import scoring
from tests.conftest import values

LABEL, KEY = settings.LABEL, settings.ID
GRIDS = {"logistic_regression": {"C": [1.0], "max_iter": [20]}, "decision_tree": {"max_depth": [2, 3]}}


@pytest.fixture(scope="module")
def prepared(spark, raw_df):
    done = prepare(raw_df, Preprocessor(PrepareSettings(fit_scope="all")))
    return done.parts(), done.preprocessor


@pytest.fixture(scope="module")
def store(spark, prepared, tmp_path_factory):
    parts, fitted = prepared
    features = models.feature_columns(parts["train"])
    model = models.fit_model(parts["train"], "decision_tree", features, LABEL)
    store = artefacts.ModelStore(spark, str(tmp_path_factory.mktemp("store")))
    assert store.latest() is None
    store.publish(fitted, model, {"model_name": "decision_tree", "features": features})
    return store


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) and scratch_path(spark, "x").startswith(shared_folder(spark))


def test_prepare(prepared):
    parts, fitted = prepared
    sizes = [df.count() for df in parts.values()]
    assert sizes == [140, 20, 40]
    assert len({tuple(df.columns) for df in parts.values()}) == 1
    columns = parts["train"].columns
    assert not set(settings.CATEGORICAL_COLUMNS) & set(columns)
    assert {"tenure_bin", "MonthlyCharges_bin", "tenure_category", "Contract_Two year"} <= set(columns)
    assert set(values(parts["test"], LABEL)) == {0, 1}
    row = parts["train"].agg(F.avg("tenure"), F.stddev_pop("tenure")).first()
    assert row[0] == pytest.approx(0, abs=1e-9) and row[1] == pytest.approx(1)
    assert sum(df.where(F.col("TotalCharges").isNull()).count() for df in parts.values()) == 0


def test_fit_scope_train_ignores_other_rows(raw_df):
    done = prepare(raw_df)
    train_keys = values(done.train, KEY)
    clean = files.coerce_numbers(raw_df, ["TotalCharges"]).where(F.col(KEY).isin(train_keys))
    want = clean.agg(F.percentile("TotalCharges", 0.5)).first()[0]
    assert done.preprocessor.imputer.state["numeric"]["TotalCharges"] == pytest.approx(want)
    with pytest.raises(ValueError):
        prepare(raw_df, Preprocessor(PrepareSettings(fit_scope="some")))


def test_row_limit(raw_df):
    done = prepare(raw_df, Preprocessor(PrepareSettings(limit_rows=100)))
    keys = values(done.train, KEY) + values(done.val, KEY) + values(done.test, KEY)
    assert sorted(keys) == [f"CUST-{i:04d}" for i in range(100)]


@pytest.mark.parametrize("method", ["onehot", "label", "target"])
def test_state_round_trip(spark, raw_df, tmp_path, method):
    fitted = Preprocessor(encoder=create_encoder(method, target=LABEL))
    fitted.fit(fitted.clean(raw_df))
    artefacts.save_preprocessor(spark, fitted, str(tmp_path / "p"))
    again = artefacts.load_preprocessor(spark, str(tmp_path / "p"))
    one = raw_df.limit(1)
    assert again.transform(one).collect() == fitted.transform(one).collect()
    assert again.transform_prepared(again.clean(one)).count() == 1
    artefacts.write_json(spark, {"kind": "other"}, str(tmp_path / "q/state"))
    with pytest.raises(TypeError):
        artefacts.load_preprocessor(spark, str(tmp_path / "q"))
    with pytest.raises(FileNotFoundError):
        artefacts.load_preprocessor(spark, str(tmp_path / "none"))


def test_knn_state_round_trip(spark, raw_df, tmp_path):
    numeric = settings.NUMERIC_COLUMNS
    fitted = Preprocessor(imputer=MissingValueHandler("knn", numeric))
    fitted.fit(fitted.clean(raw_df))
    artefacts.save_preprocessor(spark, fitted, str(tmp_path / "p"))
    again = artefacts.load_preprocessor(spark, str(tmp_path / "p"))
    gaps = raw_df.where("TotalCharges = ' '")
    assert sorted(again.transform(gaps).collect()) == sorted(fitted.transform(gaps).collect())


def test_unfitted_and_empty(raw_df, prepared):
    with pytest.raises(NotFittedError):
        Preprocessor().transform(raw_df)
    with pytest.raises(NotFittedError):
        Preprocessor().transform_prepared(raw_df)
    fitted = prepared[1]
    with pytest.raises(ValueError):
        fitted.transform_prepared(fitted.clean(raw_df).where("false"))


# ---- models ---------------------------------------------------------------------------

def test_model_names_and_defaults():
    assert models.list_models() == ["catboost", "decision_tree", "logistic_regression", "random_forest", "xgboost"]
    assert models.default_params("decision_tree")["max_depth"] == 3
    for name in models.list_models():
        assert models.create_model(f" {name} ") is not None
    for wrong in ("Random_Forest", "svm", ""):
        with pytest.raises(ValueError):
            models.create_model(wrong)


def test_class_weight_switch():
    for name in models.list_models():
        weighted = models.create_model(name, class_weight=True).isDefined("weightCol")
        assert weighted == (name != "xgboost")
    assert models.create_model("decision_tree", {"class_weight": "balanced"}).isDefined("weightCol")
    lr = models.create_model("logistic_regression", {"C": 0.5}, rows=100)
    assert lr.getRegParam() == pytest.approx(1 / 50) and not lr.getStandardization()
    assert models.create_model("decision_tree", {"max_depth": None}).getMaxDepth() == 30


def test_feature_choice(spark):
    df = spark.createDataFrame([(1, "t", 2.0, 1)], f"{KEY} int, s string, x double, {LABEL} int")
    assert models.feature_columns(df) == ["x"]
    with pytest.raises(KeyError):
        models.feature_columns(df.drop(LABEL))
    assert models.aligned(df, None) == ["x"] and models.aligned(df, ["x"]) == ["x"]
    with pytest.raises(KeyError):
        models.aligned(df, ["x", "z"])


@pytest.mark.parametrize("name,params", [("logistic_regression", {"max_iter": 20}), ("random_forest", {"n_estimators": 5}),
                                         ("xgboost", {"n_estimators": 3}), ("catboost", {"iterations": 3})])
def test_scores_are_probabilities(prepared, name, params):
    parts, _ = prepared
    features = models.feature_columns(parts["train"])
    model = models.fit_model(parts["train"], name, features, LABEL, params)
    got = values(models.with_score(parts["val"], model), "score")
    assert len(got) == 20 and all(0 <= s <= 1 for s in got)
    top = models.feature_importance(model, features, parts["val"].sparkSession, 5).collect()
    assert len(top) == 5 and top[0]["importance"] >= top[-1]["importance"] >= 0


def test_grid_draws():
    grid = {"a": [1, 2, 3], "b": ["x", "y"]}
    assert len(search.drawn_params(grid, 20, 1)) == 6 == len(search.drawn_params(grid, None, 1))
    drawn = search.drawn_params(grid, 4, 1)
    assert len({str(d) for d in drawn}) == 4 and drawn == search.drawn_params(grid, 4, 1)


def test_training_run(prepared, spark, tmp_path):
    parts, fitted = prepared
    run = run_training(parts["train"], parts["val"], parts["test"], models=list(GRIDS), grids=GRIDS, search_folds=2,
                       folds=2)
    rows = run.results.collect()
    assert [r["model_name"] for r in rows] == list(GRIDS) and run.champion in GRIDS
    assert max(r["roc_auc"] for r in rows) == next(r["roc_auc"] for r in rows if r["model_name"] == run.champion)
    assert {"model_name", "best_params", "val_metrics", "test_metrics", "optimal_threshold", "trained_at",
            "champion_metric"} <= set(run.metadata)
    assert run.metadata["test_metrics"]["threshold"] == run.metadata["optimal_threshold"]
    artefacts.save_metadata(spark, run.metadata, str(tmp_path / "m"))
    assert artefacts.load_metadata(spark, str(tmp_path / "m")) == json.loads(json.dumps(run.metadata))
    own = artefacts.ModelStore(spark, str(tmp_path / "store"))
    where = report.save_run(run, fitted, own, str(tmp_path / "runs"), LABEL)
    tables, facts = report.read_tables(spark, where)
    assert set(tables) == {"results", "roc", "pr", "confusion", "calibration", "thresholds", "importance"}
    assert facts["version"] == own.latest() and own.metadata()["model_name"] == run.champion
    n = run.scores.where("score IS NOT NULL").count()
    assert tables["confusion"].agg(F.sum("n")).first()[0] == tables["calibration"].agg(F.sum("n")).first()[0] == n
    with pytest.raises(FileNotFoundError):
        report.read_tables(spark, str(tmp_path / "runs" / "unfinished"))
    with pytest.raises(ValueError):
        run_training(parts["train"], parts["val"], parts["test"], models=[])
    with pytest.raises(ValueError):
        search.Task("decision_tree", [], LABEL, KEY, "guess")


# ---- scoring -----------------------------------------------------------------------------

def test_predict(raw_df, store):
    fitted, model, metadata = store.load()
    out = predict(raw_df, fitted, model, features=metadata["features"])
    assert out.columns == [c for c in raw_df.columns if c != LABEL] + ["churn_probability", "prediction", "risk_tier"]
    rows = out.collect()
    assert len(rows) == 200
    for r in rows:
        assert r["prediction"] == int(r["churn_probability"] >= 0.5)
        assert r["risk_tier"] == ("High" if r["churn_probability"] >= 0.7 else
                                  "Medium" if r["churn_probability"] >= 0.4 else "Low")
    assert score_rows(raw_df.limit(1), fitted, model, metadata["features"]).count() == 1
    with pytest.raises(ValueError):
        predict(raw_df.where("false"), fitted, model)


def test_scoring_refuses_row_removal(raw_df, store):
    _, model, metadata = store.load()
    fitted = Preprocessor(outliers=OutlierHandler(action="remove"))
    fitted.fit(fitted.clean(raw_df))
    with pytest.raises(ValueError, match="removal"):
        score_rows(raw_df, fitted, model, metadata["features"])


def scored_schema(raw_df):
    return T.StructType([f for f in raw_df.schema.fields if f.name != LABEL] + [
        T.StructField("churn_probability", T.DoubleType()), T.StructField("prediction", T.IntegerType()),
        T.StructField("risk_tier", T.StringType()), T.StructField("batch_index", T.IntegerType())])


def test_stream_equals_batch(spark, raw_df, store, tmp_path):
    raw_df.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = scoring.file_stream(spark, str(tmp_path / "in"), raw_df.schema)
    query = scoring.run_stream(stream, scoring.ModelScorer(store), str(tmp_path / "out"), str(tmp_path / "c"))
    query.awaitTermination()
    got = scoring.read_scored(spark, str(tmp_path / "out"), scored_schema(raw_df))
    assert sorted(set(values(got, "batch_index"))) == [1, 2, 3, 4]
    fitted, model, metadata = store.load()
    want = score_rows(raw_df, fitted, model, metadata["features"])
    columns = [KEY, "churn_probability", "prediction"]
    assert sorted(got.select(columns).collect()) == sorted(want.select(columns).collect())
    assert set(values(got, "risk_tier")) <= {"HIGH", "MEDIUM", "LOW"}
    summary = scoring.run_summary(got, scoring.query_seconds(query)).first()
    assert summary["total"] == 200 and summary["rows_per_second"] > 0
    # A second run of the same query finds nothing new.
    again = scoring.run_stream(stream, scoring.ModelScorer(store), str(tmp_path / "out"), str(tmp_path / "c"))
    again.awaitTermination()
    assert scoring.read_scored(spark, str(tmp_path / "out"), scored_schema(raw_df)).count() == 200


def test_failed_batch_is_kept_and_the_rest_goes_on(spark, raw_df, store, tmp_path):
    scorer = scoring.ModelScorer(store)
    seen = []

    def flaky(df):
        seen.append(1)
        if len(seen) == 2:
            raise RuntimeError("broken batch")
        return scorer(df)

    raw_df.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = scoring.file_stream(spark, str(tmp_path / "in"), raw_df.schema)
    scoring.run_stream(stream, flaky, str(tmp_path / "out"), str(tmp_path / "c"),
                       str(tmp_path / "failed")).awaitTermination()
    good = scoring.read_scored(spark, str(tmp_path / "out"), scored_schema(raw_df))
    bad = spark.read.json(f"{tmp_path}/failed/batch=*")
    assert sorted(set(values(good, "batch_index"))) == [1, 3] and set(values(bad, "batch_index")) == {2}
    assert good.count() + bad.count() == 200 and "broken batch" in bad.first()["error"]


def test_newer_model_is_picked_up_and_a_broken_one_is_not(spark, prepared, store, tmp_path):
    parts, fitted = prepared
    features = models.feature_columns(parts["train"])
    own = artefacts.ModelStore(spark, str(tmp_path / "store"))
    scorer = scoring.ModelScorer(own)
    with pytest.raises(FileNotFoundError):
        scorer.refresh()
    model = models.fit_model(parts["train"], "decision_tree", features, LABEL)
    first = own.publish(fitted, model, {"features": features})
    scorer.refresh()
    assert scorer.version == first
    second = own.publish(None, model, {"features": features})
    scorer.refresh()
    assert scorer.version == second and own.metadata()["has_preprocessor"] is False
    own.commit("absent")
    scorer.refresh()
    assert scorer.version == second


def test_two_publishers_get_two_positions(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    stores = [artefacts.ModelStore(spark, str(tmp_path / "store")) for _ in range(2)]
    assert stores[0].latest() is None
    with ThreadPoolExecutor(2) as pool:
        got = list(pool.map(lambda i: stores[i % 2].commit(f"v{i}"), range(12)))
    assert sorted(got) == list(range(1, 13)) and stores[0].positions() == list(range(12, 0, -1))
    assert {stores[1].version_at(p): p for p in range(1, 13)} == {f"v{i}": p for i, p in enumerate(got)}
    # A commit that is still being written does not count.
    fs, path = stores[0]._commits(13)
    fs.create(path, False).close()
    assert stores[1].latest() == stores[1].version_at(12)


def test_a_repeated_batch_replaces_its_outcome(spark, tmp_path):
    df = spark.range(6).select("id", (F.col("id") / 10).alias("churn_probability"))
    out, failed = str(tmp_path / "out"), str(tmp_path / "failed")
    schema = T.StructType([T.StructField("id", T.LongType())])

    def broken(rows):
        return rows.withColumn("x", F.raise_error(F.concat(F.lit("odd row "), F.col("id").cast("string"))).cast("int"))

    scoring.batch_writer(lambda rows: rows, out, failed)(df, 0)
    scoring.batch_writer(broken, out, failed)(df, 1)
    assert {(r["batch_index"], r["outcome"], r["rows_in"], r["rows_out"], r["error_class"]) for r in scoring.read_ledger(spark, out).collect()} == {
        (1, "scored", 6, 6, None), (2, "failed", 6, 0, "USER_RAISED_EXCEPTION")}
    assert scoring.read_scored(spark, out, schema).count() == scoring.read_failed(spark, out, failed).count() == 6
    # The failed batch is repeated and scored, the scored one fails: each row is in one place.
    scoring.batch_writer(lambda rows: rows, out, failed)(df, 1)
    scoring.batch_writer(broken, out, failed)(df, 0)
    assert scoring.read_scored(spark, out, schema).count() == scoring.read_failed(spark, out, failed).count() == 6
    assert {r["batch_index"] for r in scoring.read_failed(spark, out, failed).collect()} == {1}


def test_errors_of_the_machines_end_the_query(spark, tmp_path):
    def lost(rows):
        raise OSError("No space left on device")

    with pytest.raises(OSError):
        scoring.batch_writer(lost, str(tmp_path / "out"), str(tmp_path / "failed"))(spark.range(3), 0)
    assert scoring.error_class(RuntimeError("Job aborted: ExecutorLostFailure (executor 3 exited)")) is None
    assert scoring.error_class(ValueError("bad row")) == "ValueError"
