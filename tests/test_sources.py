import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast import settings
from holdfast.sources import files, kafka, slices
from tests.conftest import raw_rows, values


def write_csv(path, rows, columns):
    lines = [",".join(columns)] + [",".join(str(r[c]) for c in columns) for r in rows]
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_ingest(spark, tmp_path):
    path = write_csv(tmp_path / "raw.csv", raw_rows(50), settings.EXPECTED_COLUMNS)
    df = files.ingest(spark, path)
    assert df.count() == 50
    types = dict(df.dtypes)
    assert (types["TotalCharges"], types["tenure"], types["Churn"]) == ("double", "int", "int")
    assert df.where(F.col("TotalCharges").isNull()).count() == 5
    assert set(values(df, "Churn")) == {0, 1}


def test_columns_match_by_name_not_by_position(spark, tmp_path):
    columns = list(reversed(settings.EXPECTED_COLUMNS))
    path = write_csv(tmp_path / "raw.csv", raw_rows(10), columns)
    assert values(files.ingest(spark, path), "customerID") == [f"CUST-{i:04d}" for i in range(10)]


def test_missing_column_and_missing_file(spark, tmp_path):
    short = [c for c in settings.EXPECTED_COLUMNS if c != "tenure"]
    path = write_csv(tmp_path / "short.csv", raw_rows(10), short)
    with pytest.raises(files.SchemaError, match="tenure"):
        files.ingest(spark, path)
    (tmp_path / "empty.csv").write_text("col1,col2\n")
    with pytest.raises(files.SchemaError):
        files.ingest(spark, str(tmp_path / "empty.csv"))
    with pytest.raises(FileNotFoundError):
        files.ingest(spark, str(tmp_path / "nowhere.csv"))


def test_extra_columns_are_kept_and_reported(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert files.check_columns(df, ["a", "b"]) == ["c"]


def test_missing_value_texts(spark, tmp_path):
    (tmp_path / "na.csv").write_text('id,x,y\n1,NA,"a,""b"""\n2,null,N/A\n3,,None\n4,7,nan\n5, ,x\n')
    df = files.read_raw_csv(spark, str(tmp_path / "na.csv"), ["id", "x"], [])
    assert [tuple(r) for r in df.collect()] == [(1, None, 'a,"b"'), (2, None, None), (3, None, None), (4, 7, None),
                                               (5, None, "x")]


def test_yes_no_leaves_numbers_alone(spark):
    df = spark.createDataFrame([("Yes", 1), ("No", 0), ("maybe", 5), (None, None)], "a string, b int")
    out = files.map_yes_no(df, ["a", "b", "absent"])
    assert [tuple(r) for r in out.collect()] == [(1, 1), (0, 0), (None, 5), (None, None)]


@pytest.mark.parametrize("file_format", ["csv", "parquet"])
def test_split_files_round_trip(spark, tmp_path, file_format):
    parts = {n: spark.createDataFrame([(i, 0.1, f"{n} text", None)], "a int, b double, `c d` string, e double")
             for i, n in enumerate(settings.SPLITS)}
    files.write_splits(parts, str(tmp_path / "s"), file_format)
    back = files.load_splits(spark, str(tmp_path / "s"), file_format)
    for name, df in parts.items():
        assert back[name].schema == df.schema and back[name].collect() == df.collect()
    with pytest.raises(FileNotFoundError):
        files.load_splits(spark, str(tmp_path / "none"), file_format)
    with pytest.raises(FileNotFoundError):
        files.load_splits(spark, str(tmp_path / "s"), file_format, ["train", "absent"])["absent"].count()
    with pytest.raises(ValueError):
        files.write_splits(parts, str(tmp_path / "s"), "orc")


def test_json_lines_append(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, None)], "a int, b string")
    files.append_json_lines(df, str(tmp_path / "j"))
    files.append_json_lines(df, str(tmp_path / "j"))
    assert files.read_json_lines(spark, str(tmp_path / "j"), df.schema).count() == 4


def test_messages(spark):
    df = spark.createDataFrame([("c1", 1, None), ("c2", None, 2.5)], "id string, a int, b double")
    sent = kafka.encode_messages(df, "id")
    assert sent.columns == ["key", "value"]
    assert json.loads(sent.first()["value"]) == {"id": "c1", "a": 1, "b": None}
    assert sorted(kafka.decode_messages(sent, df.schema).collect()) == sorted(df.collect())
    broken = spark.createDataFrame([(bytearray(b"no json"),)], "value binary")
    assert tuple(kafka.decode_messages(broken, df.schema).first()) == (None, None, None)


@pytest.mark.parametrize("kind", ["long", "string"])
def test_head_and_rest_are_disjoint(spark, kind):
    df = spark.range(0, 3000, 3).select(
        (F.col("id") if kind == "long" else F.format_string("k%06d", "id")).alias("k")).repartition(7)
    head = values(slices.first_rows(df, "k", 400), "k")
    rest = values(slices.rows_after(df, "k", 400), "k")
    ordered = sorted(values(df, "k"))
    assert sorted(head) == ordered[:400] and sorted(rest) == ordered[400:]
    assert slices.first_rows(df, "k", 5000).count() == 1000
    assert slices.rows_after(df, "k", 1000).count() == 0
    assert slices.first_rows(df, "k", 0).count() == 0
    assert slices.rows_after(df, "k", 0).count() == 1000


def test_head_needs_a_unique_key(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (3,)], "k long")
    with pytest.raises(ValueError, match="unique"):
        slices.first_rows(df, "k", 2)


@pytest.mark.parametrize("parts", [5, None])
def test_batches(spark, parts):
    df = spark.range(205).repartition(4)
    got = {r["id"]: r["batch_index"] for r in slices.number_batches(df, "id", 10, parts).collect()}
    assert got == {i: i // 10 + 1 for i in range(205)}
    with pytest.raises(ValueError):
        slices.number_batches(df, "id", 0)
    some = df.select(F.when(F.col("id") != 3, F.col("id")).alias("k"))
    last = {r["k"]: r["batch_index"] for r in slices.number_batches(some, "k", 10, parts).collect()}
    assert last[None] == 21 and last[0] == 1
    with pytest.raises(ValueError, match="several rows"):
        slices.number_batches(df.select(F.when(F.col("id") > 3, F.col("id")).alias("k")), "k", 10)


def test_topic_reader_needs_the_connector(spark):
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka.read_topic(spark, "127.0.0.1:1", "t", schema)


def test_slices_with_null_and_large_keys(spark):
    from holdfast.sources.slices import first_rows, rows_after

    rows = [(i if i != 4 else None,) for i in range(10)]
    df = spark.createDataFrame(rows, "k long")
    assert first_rows(df, "k", 3).count() == 3 and rows_after(df, "k", 3).count() == 7
    assert first_rows(df, "k", 9).count() == 9 and rows_after(df, "k", 9).count() == 1
    large = spark.range(1 << 60, (1 << 60) + 3000).withColumnRenamed("id", "k")
    for n in (1, 1500, 2999):
        head = first_rows(large, "k", n)
        assert head.agg({"k": "max"}).first()[0] == (1 << 60) + n - 1 and head.count() == n
        assert rows_after(large, "k", n).count() == 3000 - n


def test_cut_between_null_keys_is_refused(spark):
    import pytest

    from holdfast.sources.slices import first_rows

    df = spark.createDataFrame([(1,), (None,), (None,)], "k long")
    with pytest.raises(ValueError, match="null in 2 rows"):
        first_rows(df, "k", 2)


def test_each_load_has_a_quality_report(spark, raw_df, tmp_path):
    raw_df.unionByName(raw_df.limit(1)).write.option("header", True).csv(str(tmp_path / "raw"))
    df, report = files.ingest_with_report(spark, str(tmp_path / "raw"))
    assert df.count() == 201 and set(report) == {"nulls", "duplicate_rows", "label", "duplicate_keys"}
    assert report["duplicate_rows"].first()[0] == report["duplicate_keys"].first()[0] == 1
    assert report["label"].first()["n_rows"] == 201


def test_the_package_travels_to_the_workers(spark):
    from holdfast.session import ship_package

    name = ship_package(spark)
    assert any(f.endswith(name) for f in spark.sparkContext.listFiles)
