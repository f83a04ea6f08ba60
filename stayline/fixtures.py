"""Subscriber tables derived from the star-schema tables, in Spark.

``churn_raw`` is a dirty raw extract with one row per customer plus planted
duplicates, ``scored`` carries fixed model scores, ``runs`` a training history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _yes(condition: Column) -> Column:
    return F.when(condition, "Yes").otherwise("No")


def churn_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw extract. Duplicates are exploded, so the inputs are read once."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    spend = orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.min("o_orderdate").alias("first_dt"),
        F.max("o_orderdate").alias("last_dt"),
        F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"),
    )
    k = F.col("c_custkey")
    months = (
        (F.year("last_dt") - F.year("first_dt")) * 12 + F.month("last_dt") - F.month("first_dt")
    )

    def addon(condition: Column) -> Column:
        return F.when(k % 5 == 0, "No internet service").otherwise(_yes(condition))

    cents = F.col("cents").cast("double")
    base = customer.join(spend, k == F.col("o_custkey"), "left").select(
        "c_custkey",
        F.col("c_name").alias("customerID"),
        F.when(k % 22 == 0, "  female ").when(k % 2 == 0, "Female").otherwise("Male").alias("gender"),
        F.when(k % 301 == 0, 5).when(k % 6 == 0, 1).otherwise(0).alias("SeniorCitizen"),
        _yes(F.col("c_nationkey") % 2 == 0).alias("Partner"),
        _yes(F.col("c_nationkey") % 3 == 0).alias("Dependents"),
        F.when(k % 211 == 0, -3).otherwise(months).alias("tenure"),
        F.when(k % 10 == 0, "No").otherwise("Yes").alias("PhoneService"),
        F.when(k % 10 == 0, "No phone service")
        .when(k % 10 < 5, "No")
        .otherwise("Yes")
        .alias("MultipleLines"),
        F.when(k % 5 == 0, "No").when(k % 5 < 3, "DSL").otherwise("Fiber optic").alias("InternetService"),
        addon(k % 3 == 0).alias("OnlineSecurity"),
        addon(k % 4 == 0).alias("OnlineBackup"),
        addon(k % 7 < 3).alias("DeviceProtection"),
        addon(k % 9 < 4).alias("TechSupport"),
        addon(k % 11 < 5).alias("StreamingTV"),
        addon(k % 13 < 6).alias("StreamingMovies"),
        F.when(k % 3 == 0, "Month-to-month")
        .when(k % 3 == 1, "One year")
        .otherwise("Two year")
        .alias("Contract"),
        F.when(k % 101 == 0, None).when(k % 8 < 5, "yes").otherwise("No").alias("PaperlessBilling"),
        F.when(k % 4 == 0, "Electronic check")
        .when(k % 4 == 1, "Mailed check")
        .when(k % 4 == 2, "Bank transfer (automatic)")
        .otherwise("Credit card (automatic)")
        .alias("PaymentMethod"),
        F.when(k % 97 == 0, None)
        .otherwise(F.floor(cents / F.col("n_orders") / 1000) / 100)
        .alias("MonthlyCharges"),
        F.when(k % 89 == 0, " ")
        .otherwise(F.floor(cents / 100000).cast("bigint").cast("string"))
        .alias("TotalCharges"),
        F.when(F.col("last_dt") < F.lit("2001-01-01").cast("timestamp_ntz"), "Yes")
        .otherwise("No")
        .alias("Churn"),
    )
    copies = F.when(k % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return base.withColumn("_copy", F.explode(copies)).drop("c_custkey", "_copy")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed scores of three models, the primary's score and a segment per customer."""
    k = F.col("c_custkey")

    def score(factor: int, shift: int) -> Column:
        return ((k * factor + shift) % 100).cast("double") / 100

    return table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("customer_id"),
        score(37, 0).alias("churn_probability_logistic_regression"),
        score(53, 11).alias("churn_probability_random_forest"),
        score(71, 29).alias("churn_probability_gradient_boosting"),
        score(71, 29).alias("churn_probability"),
        (k % 4).cast("int").alias("segment"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training history with missing scores and ties: run_seq, model_name, cv_score."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("run_seq"),
        F.col("p_brand").alias("model_name"),
        F.when(F.col("p_partkey") % 13 != 0, F.col("p_size").cast("double") / 100).alias("cv_score"),
    )
