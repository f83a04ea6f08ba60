import pytest

from stayline import schema
from tests.compare import session


@pytest.fixture(scope="session")
def spark():
    return session("8")


@pytest.fixture
def make(spark):
    """Small table from rows and a schema string."""

    def build(rows, columns):
        return spark.createDataFrame(rows, columns)

    return build


@pytest.fixture
def raw(spark):
    """Three raw customers: complete, partner without internet add-ons, blank total."""
    first = (
        "1111-AAAAA", "Female", 0, "Yes", "No", 1, "No", "No phone service", "DSL", "No", "Yes", "No",
        "No", "No", "No", "Month-to-month", "Yes", "Electronic check", 29.85, "29.85", "No",
    )
    second = (
        "2222-BBBBB", "Male", 0, "No", "No", 34, "Yes", "No", "Fiber optic", "Yes", "No", "Yes",
        "No", "No", "No", "One year", "No", "Mailed check", 56.95, "1889.5", "No",
    )
    third = (
        "3333-CCCCC", "Male", 1, "No", "Yes", 2, "Yes", "Yes", "No", "No internet service",
        "No internet service", "No internet service", "No internet service", "No internet service",
        "No internet service", "Two year", "Yes", "Bank transfer (automatic)", 53.85, " ", "Yes",
    )
    return spark.createDataFrame([first, second, third], schema.RAW_SCHEMA)


@pytest.fixture
def customers(spark):
    """Cleaned-like table: text categories, numbers 0..n-1, churn on a chosen rule."""

    def build(n, churns=lambda i: i % 2 == 0):
        columns = ", ".join(
            [f"{schema.ID_COLUMN} string"]
            + [f"{c} {'double' if c in ('tenure', 'senior_citizen') else 'string'}" for c in schema.CATEGORICAL_FEATURES]
            + [f"{c} double" for c in schema.NUMERIC_FEATURES]
            + ["churn string"]
        )
        rows = []
        for i in range(n):
            categories = [
                float(i % 2) if c in ("tenure", "senior_citizen") else f"v{i % 3}" for c in schema.CATEGORICAL_FEATURES
            ]
            rows.append((f"id-{i}", *categories, float(i), float(2 * i), float(i % 9), "Yes" if churns(i) else "No"))
        return spark.createDataFrame(rows, columns)

    return build
