"""Column lists, sentinel values and table schemas of the retention data model.

Every table is a monthly panel keyed by (customerID, Snapshot_Date).
"""

from __future__ import annotations

from pyspark.sql import types as T

KEYS = ["customerID", "Snapshot_Date"]

# --- fixed values: must equal the source pipeline for identical results ---
# Sentinels are compared after lower-casing and without trimming.
DROP_SENTINELS = ["not specified", "unknown"]
# Raw feed column orders (CSV headers).
RAW_FEATURE_COLUMNS = [
    "customerID", "tenure", "PhoneService", "MultipleLines", "InternetService",
    "OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport",
    "StreamingTV", "StreamingMovies", "Contract", "PaperlessBilling",
    "PaymentMethod", "MonthlyCharges", "TotalCharges", "Snapshot_Date",
]
RAW_META_COLUMNS = ["customerID", "gender", "SeniorCitizen", "Partner", "Dependents", "Snapshot_Date"]
RAW_LABEL_COLUMNS = ["customerID", "Churn", "Snapshot_Date"]
# String features cleaned by dropping sentinels; the first collapses
# 'No phone service', the six "internet" ones collapse 'No internet service'.
SIMPLE_STRING_FEATURES = [
    "MultipleLines", "InternetService", "OnlineSecurity", "OnlineBackup",
    "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies", "Contract",
]
NO_PHONE_COLUMNS = ["MultipleLines"]
NO_INTERNET_COLUMNS = [
    "OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport",
    "StreamingTV", "StreamingMovies",
]
TENURE_MIN, TENURE_MAX = 0, 73
MONTHLY_CHARGES_MAX = 124.0
NUMBER_PATTERN = r"(\d+\.?\d*)"
# Heuristic risk score (deterministic part of the monitoring score).
CONTRACT_FACTORS = {"Month-to-month": 1.5, "One year": 1.0, "Two year": 0.5}
CONTRACT_FACTOR_DEFAULT = 1.0
SCORE_BASE, SCORE_TENURE_W, SCORE_CHARGE_W, SCORE_CONTRACT_W = 0.2, 0.3, 0.2, 0.3
SCORE_TENURE_SCALE, SCORE_CHARGE_SCALE = 100.0, 120.0
SCORE_CLIP = (0.01, 0.99)
# Constant fills used before the heuristic score.
CONSTANT_FILLS = {"MonthlyCharges": 50.0, "tenure": 12.0, "TotalCharges": 600.0}
# Model tenure groups: right-closed bins (0,12], (12,24], ..., (72, inf).
TENURE_GROUP_EDGES = [0, 12, 24, 36, 48, 60, 72]
TENURE_GROUP_LABELS = ["0-1yr", "1-2yr", "2-3yr", "3-4yr", "4-5yr", "5-6yr", "6+yr"]
# Exploration tenure bins: (0,12], (12,24], (24,48], (48,73].
EDA_TENURE_EDGES = [0, 12, 24, 48, 73]
EDA_TENURE_LABELS = ["0–12", "13–24", "25–48", "49–73"]
# Monitoring thresholds.
AUC_ALERT = 0.65
AUC_PASS_MEAN = 0.8
PSI_WARNING, PSI_CRITICAL = 0.1, 0.25
PSI_ZERO_SHARE = 0.0001
PSI_DECILES = [0, 10, 20, 30, 40, 50, 60, 70, 80, 90, 100]
TARGET_CUT = 0.7
KDE_GRID_SIZE, KDE_CUT = 200, 3.0
# Training calendar and split.
TRAIN_TEST_MONTHS, OOT_MONTHS = 3, 1
TRAIN_RATIO = 0.8
SPLIT_SEED = 88
# Columns after cleaning.
SILVER_FEATURE_COLUMNS = RAW_FEATURE_COLUMNS
SILVER_META_COLUMNS = RAW_META_COLUMNS
SILVER_LABEL_COLUMNS = RAW_LABEL_COLUMNS
# --- end of fixed values ---

GOLD_FEATURE_COLUMNS = (
    KEYS
    + [c for c in SILVER_FEATURE_COLUMNS if c not in KEYS]
    + [c for c in SILVER_META_COLUMNS if c not in KEYS]
)
# Explicit model feature lists (the source picks these by dtype accident).
NUMERIC_FEATURES = [
    "tenure", "MonthlyCharges", "TotalCharges", "PhoneService", "PaperlessBilling",
    "gender", "SeniorCitizen", "Partner", "Dependents",
]
CATEGORICAL_FEATURES = SIMPLE_STRING_FEATURES + ["PaymentMethod"]
BINARY_COLUMNS = ["gender", "SeniorCitizen", "Partner", "Dependents", "PhoneService", "PaperlessBilling"]


def all_string_schema(columns: list[str]) -> T.StructType:
    """Raw feeds are read with every column as a nullable string."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


RAW_FEATURE_SCHEMA = all_string_schema(RAW_FEATURE_COLUMNS)
RAW_META_SCHEMA = all_string_schema(RAW_META_COLUMNS)
RAW_LABEL_SCHEMA = all_string_schema(RAW_LABEL_COLUMNS)
RAW_SCHEMAS = {"features": RAW_FEATURE_SCHEMA, "meta": RAW_META_SCHEMA, "labels": RAW_LABEL_SCHEMA}

SILVER_FEATURE_SCHEMA = T.StructType(
    [T.StructField("customerID", T.StringType()), T.StructField("tenure", T.IntegerType()),
     T.StructField("PhoneService", T.IntegerType())]
    + [T.StructField(c, T.StringType()) for c in SIMPLE_STRING_FEATURES]
    + [T.StructField("PaperlessBilling", T.IntegerType()), T.StructField("PaymentMethod", T.StringType()),
       T.StructField("MonthlyCharges", T.DoubleType()), T.StructField("TotalCharges", T.DoubleType()),
       T.StructField("Snapshot_Date", T.DateType())]
)
SILVER_META_SCHEMA = T.StructType(
    [T.StructField("customerID", T.StringType())]
    + [T.StructField(c, T.IntegerType()) for c in ["gender", "SeniorCitizen", "Partner", "Dependents"]]
    + [T.StructField("Snapshot_Date", T.DateType())]
)
SILVER_LABEL_SCHEMA = T.StructType(
    [T.StructField("customerID", T.StringType()), T.StructField("Churn", T.IntegerType()),
     T.StructField("Snapshot_Date", T.DateType())]
)
SILVER_SCHEMAS = {"features": SILVER_FEATURE_SCHEMA, "meta": SILVER_META_SCHEMA, "labels": SILVER_LABEL_SCHEMA}
_SILVER_FIELDS = {f.name: f for f in [*SILVER_FEATURE_SCHEMA.fields, *SILVER_META_SCHEMA.fields]}
GOLD_FEATURE_SCHEMA = T.StructType([_SILVER_FIELDS[c] for c in GOLD_FEATURE_COLUMNS])
