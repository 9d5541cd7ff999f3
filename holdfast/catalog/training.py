"""Queries for sources, sinks, model training, scoring and streams."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.catalog import query
from holdfast.catalog.common import NUMERIC, on_base, on_raw, sql_number, sql_yes_no
from holdfast.catalog.evaluation import KEY, LABEL, _SERVED_SQL, _served, _serving_ctes, _split_sql, preprocessor
from holdfast.operators import evaluate, models
from holdfast.operators.oversample import oversample
from holdfast.operators.scale import StandardScaler
from holdfast.operators.segments import cluster_rows
from holdfast.plans import search
from holdfast.plans.prepare import prepare
from holdfast.plans.score import predict
from holdfast.plans.train import run_training
from holdfast.session import scratch_path, stage
from holdfast.sources import artefacts, files, kafka
from holdfast.sources.tables import customer360, customer_base, read_table
from holdfast.streaming import scoring

# Small grids keep the registered training queries short; run_training takes the full ones by default.
SMALL_GRIDS = {
    "logistic_regression": {"C": [0.01, 1.0], "max_iter": [50]},
    "decision_tree": {"max_depth": [3, 5], "min_samples_leaf": [4]},
}


# ---- sources and sinks ----------------------------------------------------------------------

_RAW_SQL = on_raw("SELECT customer_id, segment, tenure, monthly_charges, " + sql_number("total_charges")
                  + " AS total_charges, svc_urgent, contract, " + sql_yes_no("churn") + " AS churn FROM customer360")
_RAW_COLUMNS = ["customer_id", "segment", "tenure", "monthly_charges", "total_charges", "svc_urgent", "contract",
                "churn"]


@query("s1_csv_scan", _RAW_SQL)
def s1(spark, sf):
    path = scratch_path(spark, "customers-csv")
    customer360(spark, sf).select(*_RAW_COLUMNS).write.option("header", True).option(
        "ignoreTrailingWhiteSpace", False).option("ignoreLeadingWhiteSpace", False).csv(path)
    raw = files.read_raw_csv(spark, path, ["customer_id", "tenure"], ["monthly_charges"])
    files.check_columns(raw, _RAW_COLUMNS)
    return files.map_yes_no(files.coerce_numbers(raw, ["total_charges"]), ["churn"])


@query("s2_split_files", on_base("SELECT split, count(*) AS n_rows, CAST(sum(churn) AS BIGINT) AS positives FROM marked "
                                 "GROUP BY split", _split_sql("base", "churn")))
def s2(spark, sf):
    done = prepare(customer360(spark, sf), preprocessor(fit_scope="all", hash_method="md5"))
    folder = scratch_path(spark, "splits")
    files.write_splits(done.parts(), folder, "csv")
    parts = [df.agg(F.lit(name).alias("split"), F.count("*").alias("n_rows"), F.sum(LABEL).alias("positives"))
             for name, df in files.load_splits(spark, folder, "csv").items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("s4_json_lines", on_base("SELECT customer_id, contract, monthly_charges, total_charges, churn FROM base"))
def s4(spark, sf):
    path = scratch_path(spark, "json-lines")
    rows = customer_base(spark, sf).select("customer_id", "contract", "monthly_charges", "total_charges", "churn")
    files.append_json_lines(rows, path)
    return files.read_json_lines(spark, path, rows.schema)


@query("s5_message_columns", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k FROM events""")
def s5(spark, sf):
    events = read_table(spark, sf, "events")
    return events.select("event_id", F.from_json("props", T.StructType([T.StructField("k", T.StringType())]))["k"]
                         .alias("k"))


@query("s6_messages", on_base("SELECT customer_id, segment, tenure, total_charges, churn FROM base"))
def s6(spark, sf):
    rows = customer_base(spark, sf).select("customer_id", "segment", "tenure", "total_charges", "churn")
    return kafka.decode_messages(kafka.encode_messages(rows, "customer_id"), rows.schema)


@query("s8_restored_state", on_base(_SERVED_SQL, *_serving_ctes("SELECT * FROM flagged")))
def s8(spark, sf):
    raw = customer360(spark, sf)
    fitted = preprocessor()
    fitted.fit(fitted.clean(raw))
    path = scratch_path(spark, "preprocessor")
    artefacts.save_preprocessor(spark, fitted, path)
    return _served(artefacts.load_preprocessor(spark, path).transform(raw))


# ---- training ---------------------------------------------------------------------------------

def _prepared(spark, sf):
    done = prepare(customer360(spark, sf), preprocessor())
    return done.parts()


def _fitted(spark, sf, name, params=None, class_weight=False):
    """Validation metrics of one preset on the prepared splits."""
    parts = _prepared(spark, sf)
    features = models.feature_columns(parts["train"], LABEL, KEY)
    model = models.fit_model(parts["train"], name, features, LABEL, params, class_weight=class_weight)
    scored = models.with_score(parts["val"], model)
    return evaluate.evaluate(scored, LABEL, "score")


@query("m1_logistic_regression")
def m1(spark, sf):
    return _fitted(spark, sf, "logistic_regression", class_weight=True)


@query("m2_decision_tree")
def m2(spark, sf):
    return _fitted(spark, sf, "decision_tree")


@query("m3_random_forest")
def m3(spark, sf):
    return _fitted(spark, sf, "random_forest", {"n_estimators": 20})


@query("m4_boosted_trees")
def m4(spark, sf):
    return _fitted(spark, sf, "xgboost", {"n_estimators": 10, "learning_rate": 0.1})


@query("m5_boosted_trees_deep")
def m5(spark, sf):
    return _fitted(spark, sf, "catboost", {"iterations": 10, "learning_rate": 0.1})


@query("m8_oversampled_classes", on_base("""SELECT high AS label, (SELECT max(count(*)) OVER () FROM
  (SELECT CASE WHEN tenure > 60 THEN 1 ELSE 0 END AS h FROM base WHERE tenure IS NOT NULL AND total_charges IS NOT NULL)
  GROUP BY h LIMIT 1) AS n FROM (VALUES (0), (1)) t(high)"""))
def m8(spark, sf):
    base = stage(customer_base(spark, sf).dropna(subset=NUMERIC).select(
        KEY, (F.col("tenure") > 60).cast("int").alias("label"), "monthly_charges", "total_charges"), "base")
    scaled = StandardScaler(["monthly_charges", "total_charges"]).fit_transform(base)
    out = oversample(scaled, KEY, "label", ["monthly_charges", "total_charges"])
    return out.groupBy("label").agg(F.count("*").alias("n"))


@query("m6_estimator_by_name", on_base("""SELECT name, count(*) AS n_rows, count(*) AS n_in_range
  FROM base, (VALUES ('decision_tree'), ('logistic_regression')) t(name)
  WHERE tenure IS NOT NULL AND monthly_charges IS NOT NULL AND total_charges IS NOT NULL GROUP BY name"""))
def m6(spark, sf):
    """Estimators are known by name, blanks around it do not matter; every complete row gets a probability."""
    rows = stage(customer_base(spark, sf).dropna(subset=NUMERIC).select(KEY, LABEL, *NUMERIC), "rows")
    parts = []
    for name in (" decision_tree ", "logistic_regression"):
        model = models.fit_model(rows, name, NUMERIC, LABEL)
        parts.append(models.with_score(rows, model).agg(
            F.lit(name.strip()).alias("name"), F.count("*").alias("n_rows"), F.count_if(F.col("score").between(0, 1)).alias("n_in_range")))
    return parts[0].unionByName(parts[1])


@query("m9_parameter_search")
def m9(spark, sf):
    parts = _prepared(spark, sf)
    task = search.Task("decision_tree", models.feature_columns(parts["train"], LABEL, KEY), LABEL, KEY, "none")
    params, score = search.search(parts["train"], task, SMALL_GRIDS["decision_tree"], folds=3)
    return spark.createDataFrame([(str(sorted(params.items())), score)], "params string, roc_auc double")


@query("m10_cross_validation")
def m10(spark, sf):
    parts = _prepared(spark, sf)
    task = search.Task("logistic_regression", models.feature_columns(parts["train"], LABEL, KEY), LABEL, KEY, "smote")
    scores = search.fold_scores(parts["train"], task, [{"C": 1.0, "max_iter": 50}], 3)[0]
    return spark.createDataFrame([(i, s) for i, s in enumerate(scores)], "fold int, roc_auc double")


@query("m14_training_run")
def m14(spark, sf):
    parts = _prepared(spark, sf)
    run = run_training(parts["train"], parts["val"], parts["test"], label=LABEL, key=KEY, models=list(SMALL_GRIDS),
                       grids=SMALL_GRIDS, imbalance="class_weight", draws=2, search_folds=2, folds=2)
    return run.results.withColumn("champion", F.col("model_name") == run.champion)


@query("v12_feature_importance")
def v12(spark, sf):
    parts = _prepared(spark, sf)
    features = models.feature_columns(parts["train"], LABEL, KEY)
    model = models.fit_model(parts["train"], "random_forest", features, LABEL, {"n_estimators": 20})
    return models.feature_importance(model, features, spark)


@query("v13_learning_curve")
def v13(spark, sf):
    parts = _prepared(spark, sf)
    task = search.Task("decision_tree", models.feature_columns(parts["train"], LABEL, KEY), LABEL, KEY, "none")
    return search.learning_curve(parts["train"], task, {"max_depth": 3}, steps=3, folds=2)


@query("a11_customer_clusters")
def a11(spark, sf):
    base = customer_base(spark, sf).select(KEY, LABEL, *NUMERIC)
    return cluster_rows(base, NUMERIC)


# ---- scoring and streams -------------------------------------------------------------------------

def _published(spark, sf):
    """A model store with one small champion, and the raw rows it was trained on."""
    raw = stage(customer360(spark, sf), "raw")
    done = prepare(raw, preprocessor())
    features = models.feature_columns(done.train, LABEL, KEY)
    model = models.fit_model(done.train, "decision_tree", features, LABEL)
    store = artefacts.ModelStore(spark, scratch_path(spark, "store"))
    store.publish(done.preprocessor, model, {"model_name": "decision_tree", "features": features})
    return raw, store


@query("n1_batch_scores")
def n1(spark, sf):
    raw, store = _published(spark, sf)
    fitted, model, metadata = store.load()
    return predict(raw, fitted, model, features=metadata["features"], label=LABEL, key=KEY)


@query("s7_champion_metadata", on_base("""SELECT 'decision_tree' AS model_name,
  CAST(16 + count(DISTINCT contract) - 1 + count(DISTINCT internet_service) - 1 AS INTEGER) AS n_features FROM base"""))
def s7(spark, sf):
    _, store = _published(spark, sf)
    metadata = store.metadata()
    return spark.createDataFrame([(metadata["model_name"], len(metadata["features"]))],
                                 "model_name string, n_features int")


def _streamed(spark, sf):
    raw, store = _published(spark, sf)
    folder = scratch_path(spark, "arrivals")
    raw.repartition(4, KEY).write.parquet(folder)
    scorer = scoring.ModelScorer(store, LABEL, KEY)
    output = scratch_path(spark, "scored")
    stream = scoring.file_stream(spark, folder, raw.schema)
    scoring.run_stream(stream, scorer, output, scratch_path(spark, "progress"),
                       scratch_path(spark, "failed")).awaitTermination()
    return scoring.read_scored(spark, output, _scored_schema(raw))


def _scored_schema(raw, numbered=True):
    fields = [f for f in raw.schema.fields if f.name != LABEL] + [
        T.StructField("churn_probability", T.DoubleType()), T.StructField("prediction", T.IntegerType()),
        T.StructField("risk_tier", T.StringType())]
    return T.StructType(fields + ([T.StructField("batch_index", T.IntegerType())] if numbered else []))


@query("n4_stream_scores")
def n4(spark, sf):
    return _streamed(spark, sf)


@query("n6_stream_summary")
def n6(spark, sf):
    return scoring.run_summary(_streamed(spark, sf))


@query("n8_message_scores")
def n8(spark, sf):
    raw, store = _published(spark, sf)
    messages = kafka.encode_messages(raw, KEY)
    folder = scratch_path(spark, "messages")
    messages.repartition(4, "key").write.parquet(folder)
    stream = scoring.file_stream(spark, folder, messages.schema)
    output = scratch_path(spark, "scored")
    scoring.run_stream(kafka.decode_messages(stream, raw.schema), scoring.ModelScorer(store, LABEL, KEY), output,
                       scratch_path(spark, "progress"), numbered=False).awaitTermination()
    return scoring.read_scored(spark, output, _scored_schema(raw, numbered=False))


def _agreement(scored, batch):
    """Rows of a stream, and those whose score and prediction are the batch's."""
    mine = scored.select(KEY, "churn_probability", "prediction")
    theirs = batch.select(KEY, F.col("churn_probability").alias("p"), F.col("prediction").alias("q"))
    same = (F.abs(F.col("churn_probability") - F.col("p")) < 1e-9) & (F.col("prediction") == F.col("q")) & F.col("p").between(0, 1) & (
        F.col("q") == (F.col("p") >= 0.5).cast("int"))
    return mine.join(theirs, KEY, "left").agg(F.count("*").alias("n_rows"), F.count_if(same).alias("n_same"))


_ALL_SAME = on_raw("SELECT count(*) AS n_rows, count(*) AS n_same FROM customer360")


def _batch(store, raw):
    fitted, model, metadata = store.load()
    return predict(raw, fitted, model, features=metadata["features"], label=LABEL, key=KEY)


@query("n4_stream_equals_batch", _ALL_SAME)
def n4_agreement(spark, sf):
    raw, store = _published(spark, sf)
    folder, output = scratch_path(spark, "arrivals"), scratch_path(spark, "scored")
    raw.repartition(4, KEY).write.parquet(folder)
    stream = scoring.file_stream(spark, folder, raw.schema)
    scoring.run_stream(stream, scoring.ModelScorer(store, LABEL, KEY), output, scratch_path(spark, "progress")).awaitTermination()
    return _agreement(scoring.read_scored(spark, output, _scored_schema(raw)), _batch(store, raw))


@query("n8_messages_equal_batch", _ALL_SAME)
def n8_agreement(spark, sf):
    raw, store = _published(spark, sf)
    folder, output = scratch_path(spark, "messages"), scratch_path(spark, "scored")
    messages = kafka.encode_messages(raw, KEY)
    messages.repartition(4, "key").write.parquet(folder)
    stream = kafka.decode_messages(scoring.file_stream(spark, folder, messages.schema), raw.schema)
    scoring.run_stream(stream, scoring.ModelScorer(store, LABEL, KEY), output, scratch_path(spark, "progress"),
                       numbered=False).awaitTermination()
    return _agreement(scoring.read_scored(spark, output, _scored_schema(raw, numbered=False)), _batch(store, raw))


@query("n7_failed_batches", on_raw("""SELECT CASE WHEN total_charges = ' ' THEN 'failed' ELSE 'scored' END AS outcome,
  count(*) AS rows_in, count(*) FILTER (total_charges <> ' ') AS rows_out, count(*) AS n_rows,
  CASE WHEN total_charges = ' ' THEN 'CAST_INVALID_INPUT' END AS error_class FROM customer360 GROUP BY 1, 5"""))
def n7(spark, sf):
    raw = stage(customer360(spark, sf), "raw")
    folder, output = scratch_path(spark, "arrivals"), scratch_path(spark, "scored")
    blank = F.col("total_charges") == " "
    for part in (raw.where(blank), raw.where(~blank)):
        part.repartition(2).write.mode("append").parquet(folder)

    def score(rows):
        # Blank charges are no number, so their batches cannot be scored.
        return rows.withColumn("churn_probability", F.least(F.col("total_charges").cast("double") / 1e9, F.lit(1.0)))

    scoring.run_stream(scoring.file_stream(spark, folder, raw.schema), score, output, scratch_path(spark, "progress")).awaitTermination()
    schema = T.StructType([T.StructField(KEY, raw.schema[KEY].dataType)])
    kept = scoring.read_scored(spark, output, schema).agg(F.lit("scored").alias("outcome"), F.count("*").alias("n_rows")).unionByName(
        scoring.read_failed(spark, output).agg(F.lit("failed").alias("outcome"), F.count("*").alias("n_rows")))
    ledger = scoring.read_ledger(spark, output).groupBy("outcome", "error_class").agg(
        F.sum("rows_in").alias("rows_in"), F.sum("rows_out").alias("rows_out"))
    return ledger.join(kept, "outcome").select("outcome", "rows_in", "rows_out", "n_rows", "error_class")


@query("n9_champion_change", on_raw("""SELECT CASE WHEN customer_id % 2 = 0 THEN 1 ELSE 2 END AS run, count(*) AS n_rows,
  count(*) AS n_same FROM customer360 GROUP BY 1"""))
def n9(spark, sf):
    """A new champion is published between two runs of one stream; each run agrees with its own champion."""
    raw, store = _published(spark, sf)
    folder, output, progress = (scratch_path(spark, n) for n in ("arrivals", "scored", "progress"))
    scorer, runs = scoring.ModelScorer(store, LABEL, KEY), []
    for run in (1, 2):
        if run == 2:
            done = prepare(raw, preprocessor())
            features = models.feature_columns(done.train, LABEL, KEY)
            model = models.fit_model(done.train, "logistic_regression", features, LABEL, {"max_iter": 5})
            store.publish(done.preprocessor, model, {"model_name": "logistic_regression", "features": features})
        part = raw.where(F.col(KEY) % 2 == run - 1)
        part.repartition(2, KEY).write.mode("append").parquet(folder)
        scoring.run_stream(scoring.file_stream(spark, folder, raw.schema), scorer, output, progress).awaitTermination()
        scored = scoring.read_scored(spark, output, _scored_schema(raw)).where(F.col(KEY) % 2 == run - 1)
        runs.append(_agreement(scored, _batch(store, part)).withColumn("run", F.lit(run)))
    return runs[0].unionByName(runs[1])
