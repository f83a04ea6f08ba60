"""Value domains, binary flags, ordinal codes and target encoding."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from stayline import schema
from stayline.operators.columns import present, text_columns, value_frequencies
from stayline.operators.services import YES_NO_CODES, recode

#: Columns estimated to have more distinct values than this are never coded.
CANDIDATE_LIMIT = 100


def category_domain(df: DataFrame, columns: Sequence[str] = schema.DOMAIN_COLUMNS) -> DataFrame:
    """(column, value, ordinal): the sorted distinct values of each named column."""
    values = value_frequencies(df, present(df, columns)).where(F.col("value").isNotNull())
    # Runs over distinct values of declared categories, so a window per column is short.
    order = W.partitionBy("column").orderBy("value")
    return values.select("column", "value", F.row_number().over(order).alias("ordinal"))


def low_cardinality(
    df: DataFrame, limit: int, exclude: Sequence[str] = (schema.ID_COLUMN,)
) -> dict[str, list[str]]:
    """Sorted distinct values of every text column with at most ``limit`` of them.

    A sketch first rules out wide columns such as ids, so that their values are
    never shuffled; the exact count then decides. The driver receives at most
    ``limit`` values per column.
    """
    names = [c for c in text_columns(df) if c not in set(exclude)]
    if not names:
        return {}
    estimate = df.agg(*[F.approx_count_distinct(c).alias(c) for c in names]).first()
    candidates = [c for c in names if estimate[c] <= max(CANDIDATE_LIMIT, 2 * limit)]
    if not candidates:
        return {}
    values = value_frequencies(df, candidates).where(F.col("value").isNotNull())
    sizes = values.groupBy("column").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") <= limit)
    rows = (
        values.join(sizes, "column", "left_semi")
        .groupBy("column")
        .agg(F.array_sort(F.collect_list("value")).alias("values"))
        .collect()
    )
    found = {r["column"]: list(r["values"]) for r in rows}
    return {c: found[c] for c in names if c in found}


def binary_mappings(df: DataFrame, exclude: Sequence[str] = (schema.ID_COLUMN,)) -> dict[str, dict]:
    """Coding of every text column with exactly two values: flag name → value → 0/1."""
    result = {}
    for column, values in low_cardinality(df, 2, exclude).items():
        if len(values) == 2:
            known = schema.KNOWN_BINARY_CODES.get(tuple(values))
            result[column] = dict(known) if known else {values[0]: 0, values[1]: 1}
    return result


def multiclass_mappings(
    df: DataFrame,
    min_unique: int = 3,
    max_unique: int = 10,
    exclude: Sequence[str] = (schema.ID_COLUMN,),
) -> dict[str, dict]:
    """Alphabetical codes from 1 for text columns with a middling number of values."""
    return {
        column: {value: i for i, value in enumerate(values, start=1)}
        for column, values in low_cardinality(df, max_unique, exclude).items()
        if min_unique <= len(values) <= max_unique
    }


def apply_mappings(df: DataFrame, mappings: Mapping[str, Mapping], suffix: str) -> DataFrame:
    """Add ``<column><suffix>`` per mapping. Pass stored mappings for a fixed schema."""
    if not mappings:
        return df
    return df.withColumns(
        {f"{c}{suffix}": recode(F.col(c), mapping).cast("int") for c, mapping in mappings.items()}
    )


def binary_flags(df: DataFrame, exclude: Sequence[str] = (schema.ID_COLUMN,)) -> DataFrame:
    return apply_mappings(df, binary_mappings(df, exclude), "_flag")


def multiclass_codes(
    df: DataFrame,
    min_unique: int = 3,
    max_unique: int = 10,
    exclude: Sequence[str] = (schema.ID_COLUMN,),
) -> DataFrame:
    return apply_mappings(df, multiclass_mappings(df, min_unique, max_unique, exclude), "_encoded")


def mapping_table(df: DataFrame, mappings: Mapping[str, Mapping], suffix: str) -> DataFrame:
    """(encoded_column, source_column, value, code) report of a mapping."""
    rows = [
        (f"{c}{suffix}", c, value, code) for c, m in mappings.items() for value, code in m.items()
    ]
    return df.sparkSession.createDataFrame(
        rows, "encoded_column string, source_column string, value string, code int"
    )


def target_code(column: Column) -> Column:
    """Yes → 1, No → 0, anything else NULL."""
    return recode(column, YES_NO_CODES)
