from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast import settings
from holdfast.session import local_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    # Many short jobs: the quick compiler alone starts faster.
    session = local_session("tests", "4", 4, {"spark.driver.extraJavaOptions": "-XX:TieredStopAtLevel=1 -XX:ReservedCodeCacheSize=240m"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


NO_INTERNET = ["No", "Yes", "No internet service"]

RAW_SCHEMA = T.StructType([
    T.StructField(c, T.IntegerType() if c in settings.INTEGER_COLUMNS else
                  T.DoubleType() if c in settings.DOUBLE_COLUMNS else T.StringType())
    for c in settings.EXPECTED_COLUMNS])


def raw_rows(n=200, seed=42):
    """Synthetic raw customers with 5 blank totals and about a quarter positive."""
    rnd = random.Random(seed)
    blanks = set(rnd.sample(range(n), 5))
    rows = []
    for i in range(n):
        tenure = rnd.randint(1, 72)
        monthly = min(max(rnd.gauss(65, 20), 18), 120)
        total = max(round(tenure * monthly + rnd.uniform(-50, 50), 2), 0.0)
        service = {c: rnd.choice(NO_INTERNET) for c in settings.SERVICE_COLUMNS[3:]}
        rows.append({
            "customerID": f"CUST-{i:04d}", "gender": rnd.choice(["Male", "Female"]),
            "SeniorCitizen": int(rnd.random() < 0.16), "Partner": rnd.choice(["Yes", "No"]),
            "Dependents": "Yes" if rnd.random() < 0.7 else "No", "tenure": tenure,
            "PhoneService": "Yes" if rnd.random() < 0.1 else "No",
            "MultipleLines": rnd.choice(["No", "Yes", "No phone service"]),
            "InternetService": rnd.choice(["DSL", "Fiber optic", "No"]), **service,
            "Contract": rnd.choices(["Month-to-month", "One year", "Two year"], [55, 25, 20])[0],
            "PaperlessBilling": rnd.choice(["Yes", "No"]),
            "PaymentMethod": rnd.choice(["Electronic check", "Mailed check", *settings.AUTO_PAYMENT_METHODS]),
            "MonthlyCharges": round(float(monthly), 2), "TotalCharges": " " if i in blanks else str(total),
            "Churn": "Yes" if rnd.random() < 0.26 else "No",
        })
    return rows


@pytest.fixture(scope="session")
def raw_df(spark):
    rows = [tuple(r[c] for c in settings.EXPECTED_COLUMNS) for r in raw_rows()]
    return spark.createDataFrame(rows, RAW_SCHEMA)


@pytest.fixture(scope="session")
def base_row():
    return {
        "customerID": "CUST-0001", "gender": "Male", "SeniorCitizen": 0, "Partner": "Yes", "Dependents": "No",
        "tenure": 24, "PhoneService": "No", "MultipleLines": "No", "InternetService": "DSL", "OnlineSecurity": "No",
        "OnlineBackup": "Yes", "DeviceProtection": "No", "TechSupport": "No", "StreamingTV": "No",
        "StreamingMovies": "No", "Contract": "Month-to-month", "PaperlessBilling": "No",
        "PaymentMethod": "Electronic check", "MonthlyCharges": 65.0, "TotalCharges": 1560.0, "Churn": 0}


@pytest.fixture
def rows_of(spark, base_row):
    """A frame of the base row with the given overrides, one row each."""
    kinds = {str: "string", int: "int", float: "double"}

    def make(*overrides):
        schema = ", ".join(f"{k} {kinds[type(v)]}" for k, v in base_row.items())
        return spark.createDataFrame([tuple({**base_row, **o}.values()) for o in overrides], schema)

    return make


def values(df, name):
    return [r[0] for r in df.select(F.col(f"`{name}`")).collect()]
