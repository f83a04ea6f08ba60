"""Feature encoding, as plain tables and as an MLlib pipeline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    ElementwiseProduct,
    OneHotEncoder,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, functions as F

from stayline import schema
from stayline.functions.numeric import nan_to_null

#: Category that stands for a missing value, as it would be spelled in text.
MISSING_CATEGORY = "nan"


def one_hot_long(df: DataFrame, id_column: str, columns: Sequence[str]) -> DataFrame:
    """(id, feature, value) with one row per set indicator; nothing is dropped as a base level.

    The sparse long form never grows with the number of categories.
    """
    texts = df.select(
        id_column, *[F.coalesce(F.col(c).cast("string"), F.lit(MISSING_CATEGORY)).alias(c) for c in columns]
    )
    return texts.unpivot([id_column], list(columns), "_c", "_v").select(
        id_column, F.concat("_c", F.lit("="), "_v").alias("feature"), F.lit(1).alias("value")
    )


def scale_statistics(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column, from one aggregation."""
    values = {c: nan_to_null(F.col(c).cast("double")) for c in columns}
    row = df.agg(
        *[F.avg(v).alias(f"m_{c}") for c, v in values.items()],
        *[F.stddev_pop(v).alias(f"s_{c}") for c, v in values.items()],
    ).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in columns}


def standard_scale(
    df: DataFrame, columns: Sequence[str], statistics: dict[str, tuple[float, float]] | None = None
) -> DataFrame:
    """Centre and scale columns; a constant column is only centred.

    Pass the statistics of the training rows to scale other rows alike.
    """
    statistics = scale_statistics(df, columns) if statistics is None else statistics

    def scaled(c: str) -> Column:
        mean, deviation = statistics[c]
        return (F.col(c).cast("double") - F.lit(mean)) / F.lit(deviation if deviation else 1.0)

    return df.withColumns({c: scaled(c) for c in columns})


def preprocessor(
    rows: int,
    categorical: Sequence[str] = schema.CATEGORICAL_FEATURES,
    numeric: Sequence[str] = schema.NUMERIC_FEATURES,
    output: str = "features",
) -> Pipeline:
    """Unfitted pipeline: scaled numbers followed by one-hot categories, kept sparse.

    A category not seen in training gives all zeros, and no seen category is
    dropped: the slot the encoder drops is the indexer's bucket for unseen
    values. ``rows`` is the number of training rows; it turns the sample
    deviation of the scaler into the population one.
    """
    texts = ", ".join(
        f"coalesce(cast(`{c}` as string), '{MISSING_CATEGORY}') as `_t_{c}`" for c in categorical
    )
    prepare = SQLTransformer(statement=f"SELECT *, {texts} FROM __THIS__")
    index = StringIndexer(
        inputCols=[f"_t_{c}" for c in categorical],
        outputCols=[f"_i_{c}" for c in categorical],
        handleInvalid="keep",
        stringOrderType="alphabetAsc",
    )
    encode = OneHotEncoder(
        inputCols=[f"_i_{c}" for c in categorical],
        outputCols=[f"_o_{c}" for c in categorical],
        handleInvalid="error",
        dropLast=True,
    )
    gather = VectorAssembler(inputCols=list(numeric), outputCol="_numbers")
    scale = StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=True, withStd=True)
    correction = (rows / (rows - 1)) ** 0.5 if rows > 1 else 1.0
    correct = ElementwiseProduct(
        scalingVec=Vectors.dense([correction] * len(numeric)), inputCol="_scaled", outputCol="_population"
    )
    assemble = VectorAssembler(
        inputCols=["_population", *[f"_o_{c}" for c in categorical]], outputCol=output
    )
    return Pipeline(stages=[prepare, index, encode, gather, scale, correct, assemble])


def transformed(model: PipelineModel, df: DataFrame, output: str = "features") -> DataFrame:
    """Apply a fitted preprocessor and keep only the input columns and the features."""
    return model.transform(df).select(*df.columns, output)
