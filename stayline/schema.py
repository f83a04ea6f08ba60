"""Column lists, types and data rules of the subscriber tables.

Every operator takes these as parameters; the values below are the defaults.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Column names, labels, bounds and tokens that results depend on.
# ---------------------------------------------------------------------------

RAW_SCHEMA = T.StructType(
    [
        T.StructField("customerID", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("SeniorCitizen", T.IntegerType()),
        T.StructField("Partner", T.StringType()),
        T.StructField("Dependents", T.StringType()),
        T.StructField("tenure", T.IntegerType()),
        T.StructField("PhoneService", T.StringType()),
        T.StructField("MultipleLines", T.StringType()),
        T.StructField("InternetService", T.StringType()),
        T.StructField("OnlineSecurity", T.StringType()),
        T.StructField("OnlineBackup", T.StringType()),
        T.StructField("DeviceProtection", T.StringType()),
        T.StructField("TechSupport", T.StringType()),
        T.StructField("StreamingTV", T.StringType()),
        T.StructField("StreamingMovies", T.StringType()),
        T.StructField("Contract", T.StringType()),
        T.StructField("PaperlessBilling", T.StringType()),
        T.StructField("PaymentMethod", T.StringType()),
        T.StructField("MonthlyCharges", T.DoubleType()),
        T.StructField("TotalCharges", T.StringType()),
        T.StructField("Churn", T.StringType()),
    ]
)

ID_COLUMN = "customer_id"
TARGET_COLUMN = "churn"

# tenure and senior_citizen are deliberately categorical: they are one-hot encoded.
CATEGORICAL_FEATURES = (
    "gender",
    "senior_citizen",
    "partner",
    "dependents",
    "tenure",
    "phone_service",
    "multiple_lines",
    "internet_service",
    "online_security",
    "online_backup",
    "device_protection",
    "tech_support",
    "streaming_tv",
    "streaming_movies",
    "contract",
    "paperless_billing",
    "payment_method",
)
NUMERIC_FEATURES = ("monthly_charges", "total_charges", "total_services")
FEATURES = CATEGORICAL_FEATURES + NUMERIC_FEATURES

# Columns coerced from text to numbers by the cleaning step.
COERCED_COLUMNS = ("total_charges", "monthly_charges", "tenure", "senior_citizen")

# Columns with a declared value domain after cleaning.
DOMAIN_COLUMNS = (
    "gender",
    "partner",
    "dependents",
    "phone_service",
    "multiple_lines",
    "internet_service",
    "online_security",
    "online_backup",
    "device_protection",
    "tech_support",
    "streaming_tv",
    "streaming_movies",
    "contract",
    "paperless_billing",
    "payment_method",
    "churn",
)

SERVICE_COLUMNS = (
    "phone_service",
    "multiple_lines",
    "internet_service",
    "online_security",
    "online_backup",
    "device_protection",
    "tech_support",
    "streaming_tv",
    "streaming_movies",
)
RAW_SERVICE_COLUMNS = (
    "PhoneService",
    "MultipleLines",
    "InternetService",
    "OnlineSecurity",
    "OnlineBackup",
    "DeviceProtection",
    "TechSupport",
    "StreamingTV",
    "StreamingMovies",
)

# Labels that mean "the parent service is absent"; cleaning turns them into "No".
NO_SERVICE_LABELS = ("No internet service", "No phone service")

TEXT_FILL = "Unknown"

# Values outside these rules are impossible and become NULL.
IMPOSSIBLE_RULES = {
    "tenure": {"min": 0},
    "monthly_charges": {"min": 0},
    "total_charges": {"min": 0},
    "senior_citizen": {"allowed": (0, 1)},
}

OUTLIER_COLUMNS = ("tenure", "monthly_charges", "total_charges")
IQR_FACTOR = 1.5

# Below the minimum is an issue, above the maximum only a warning.
NUMERIC_RANGES = {
    "tenure": (0, 100),
    "monthly_charges": (0, 500),
    "total_charges": (0, 10000),
    "senior_citizen": (0, 1),
    "total_services": (0, 9),
}

EXPECTED_VALUES = {
    "gender": ("Male", "Female"),
    "partner": ("Yes", "No"),
    "dependents": ("Yes", "No"),
    "phone_service": ("Yes", "No"),
    "churn": ("Yes", "No"),
    "internet_service": ("Dsl", "Fiber Optic", "No"),
    "contract": ("Month-To-Month", "One Year", "Two Year"),
}

# Spark type names accepted for a cleaned column.
EXPECTED_TYPES = {
    "tenure": ("int", "bigint", "double"),
    "monthly_charges": ("double",),
    "total_charges": ("double",),
    "senior_citizen": ("int", "bigint", "double"),
    "total_services": ("int", "bigint"),
    "customer_id": ("string",),
    "gender": ("string",),
    "partner": ("string",),
    "dependents": ("string",),
    "phone_service": ("string",),
    "internet_service": ("string",),
    "contract": ("string",),
    "churn": ("string",),
}

# Two-valued text columns with an agreed coding; others are coded alphabetically from 0.
KNOWN_BINARY_CODES = {
    ("No", "Yes"): {"Yes": 1, "No": 0},
    ("Female", "Male"): {"Male": 1, "Female": 0},
}

# Decision threshold, risk band edges and labels.
DECISION_THRESHOLD = 0.5
RISK_LOW = 0.40
RISK_HIGH = 0.70
RISK_GROUPS = ("Low", "Medium", "High")
PROBABILITY_PREFIX = "churn_probability_"

TEST_SHARE = 0.2
SPLIT_SEED = 42
FOLDS = 5

# Tokens a delimited file uses for "missing".
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Every character a full whitespace trim removes.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
