"""Default settings of a churn job.

Every operator takes these as plain arguments; nothing reads a configuration
file.  The values in this module are fixed values: column names, category
texts, thresholds and parameter grids that results depend on.
"""

from __future__ import annotations

LABEL = "Churn"
ID = "customerID"
SEED = 42
TRAINING_ROWS = 5000

# The raw customer table.
EXPECTED_COLUMNS = [
    "customerID", "gender", "SeniorCitizen", "Partner", "Dependents", "tenure",
    "PhoneService", "MultipleLines", "InternetService", "OnlineSecurity",
    "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV",
    "StreamingMovies", "Contract", "PaperlessBilling", "PaymentMethod",
    "MonthlyCharges", "TotalCharges", "Churn",
]
INTEGER_COLUMNS = ["SeniorCitizen", "tenure"]
DOUBLE_COLUMNS = ["MonthlyCharges"]
NUMERIC_COLUMNS = ["tenure", "MonthlyCharges", "TotalCharges"]
CATEGORICAL_COLUMNS = [
    "gender", "MultipleLines", "InternetService", "OnlineSecurity",
    "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV",
    "StreamingMovies", "Contract", "PaymentMethod",
]
YES_NO_COLUMNS = ["Partner", "Dependents", "PhoneService", "PaperlessBilling", "Churn"]
COERCED_COLUMNS = ["TotalCharges"]

# Texts that a CSV reader takes for a missing value.
CSV_MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Imputation, outliers, encoding, scaling, binning.
IMPUTED_COLUMNS = ["TotalCharges"]
NEIGHBOURS = 5
IQR_FACTOR = 1.5
Z_THRESHOLD = 3.0
OUTLIER_COLUMNS = ["tenure", "MonthlyCharges", "TotalCharges"]
SCALED_COLUMNS = [
    "tenure", "MonthlyCharges", "TotalCharges", "service_adoption_score",
    "avg_monthly_charge_per_service", "charge_to_tenure_ratio",
]
TENURE_BIN_LABELS = ["0-20%ile", "20-40%ile", "40-60%ile", "60-80%ile", "80-100%ile"]
CHARGE_BIN_LABELS = ["Budget", "Standard", "Premium", "Ultra"]

# Derived features.
TENURE_EDGES = [0, 12, 24, 48, 60, 73]
TENURE_LABELS = ["New", "Developing", "Established", "Loyal", "Champion"]
SERVICE_COLUMNS = [
    "PhoneService", "MultipleLines", "InternetService", "OnlineSecurity",
    "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV",
    "StreamingMovies",
]
STREAMING_COLUMNS = ["StreamingTV", "StreamingMovies"]
SECURITY_COLUMNS = ["OnlineSecurity", "OnlineBackup", "DeviceProtection"]
AUTO_PAYMENT_METHODS = ["Bank transfer (automatic)", "Credit card (automatic)"]
ACTIVE_SERVICE_TEXTS = ["yes", "dsl", "fiber optic"]

# Splitting, evaluation, tiers, business figures.
TEST_SHARE = 0.20
VALIDATION_SHARE = 0.125
SPLITS = ["train", "val", "test"]
THRESHOLD_START, THRESHOLD_STOP, THRESHOLD_STEP = 0.10, 0.90, 0.05
FALSE_POSITIVE_COST = 10.0
FALSE_NEGATIVE_COST = 500.0
HIGH_RISK = 0.70
MEDIUM_RISK = 0.40
MONTHLY_REVENUE = 65.0
LIFETIME_MONTHS = 32.0
OFFER_COST = 50.0
OFFER_SUCCESS = 0.35
CHAMPION_METRIC = "roc_auc"
CV_FOLDS = 5
SEARCH_FOLDS = 3
SEARCH_DRAWS = 20

# Parameter grids; the first value of a list is the default.
GRIDS = {
    "logistic_regression": {
        "C": [0.001, 0.01, 0.1, 1.0, 10.0, 100.0],
        "solver": ["lbfgs", "liblinear"],
        "max_iter": [500],
        "penalty": ["l2"],
    },
    "decision_tree": {
        "max_depth": [3, 5, 7, 10, 15, None],
        "min_samples_split": [2, 5, 10, 20],
        "min_samples_leaf": [1, 2, 4, 8],
        "criterion": ["gini", "entropy"],
        "class_weight": [None, "balanced"],
    },
    "random_forest": {
        "n_estimators": [100, 200, 300, 500],
        "max_depth": [5, 10, 15, 20, None],
        "min_samples_split": [2, 5, 10],
        "min_samples_leaf": [1, 2, 4],
        "max_features": ["sqrt", "log2"],
        "bootstrap": [True],
    },
    "xgboost": {
        "n_estimators": [100, 200, 300, 500],
        "max_depth": [3, 4, 5, 6, 7],
        "learning_rate": [0.005, 0.01, 0.05, 0.1, 0.2],
        "subsample": [0.6, 0.7, 0.8, 0.9, 1.0],
        "colsample_bytree": [0.6, 0.7, 0.8, 0.9, 1.0],
        "gamma": [0, 0.05, 0.1, 0.2, 0.3],
        "min_child_weight": [1, 3, 5],
        "reg_alpha": [0, 0.01, 0.1],
        "reg_lambda": [0.5, 1.0, 2.0],
    },
    "catboost": {
        "iterations": [100, 200, 300, 500],
        "depth": [4, 5, 6, 7, 8],
        "learning_rate": [0.01, 0.03, 0.05, 0.1, 0.2],
        "l2_leaf_reg": [1, 3, 5, 7, 10],
        "border_count": [32, 64, 128],
        "bagging_temperature": [0.0, 0.5, 1.0],
    },
}
