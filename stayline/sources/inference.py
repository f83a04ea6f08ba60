"""Delimited extracts without a declared schema: types found in one pass, misfits set aside.

Types form a lattice: integer < double < text and timestamp < text. Per column one
aggregation counts the values that are known and those that read as each type, so
the counts of any split of the file add up and the type is their least upper bound.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from stayline import schema
from stayline.session import staged

#: Narrowest first; text takes everything.
LATTICE = (("integer", T.LongType()), ("double", T.DoubleType()), ("timestamp", T.TimestampNTZType()))
_WHOLE = r"^[+-]?[0-9]+$"
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_MOMENT = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ T][0-9]{1,2}:[0-9]{1,2}(:[0-9]{1,2}(\.[0-9]+)?)?)?$"
_FORMS = {"integer": _WHOLE, "double": _NUMBER, "timestamp": _MOMENT}
#: While a file is read: a line with too many or too few fields, and why a row is rejected.
_BROKEN, _REASONS = "_broken_line", "_reject_reasons"


@dataclass(frozen=True)
class Extract:
    """``rows`` typed by ``types``; ``rejected``: ``fields`` (a struct of the columns as text), ``reasons`` and ``line``."""

    rows: DataFrame
    rejected: DataFrame
    types: T.StructType


def parsed(text: Column, kind: str) -> Column:
    """``text`` as a type of the lattice, null where it does not read as one. Surrounding blanks are ignored."""
    value = F.trim(text)
    return F.when(value.rlike(_FORMS[kind]), value.try_cast(dict(LATTICE)[kind]))


def infer_types(texts: DataFrame, columns: Sequence[str], tolerance: float = 0.0) -> T.StructType:
    """Per column the narrowest type that all but a share of ``tolerance`` of its known values read as.

    A column without a known value is text. Whole numbers beyond 64 bits are doubles.
    """
    if not columns:
        return T.StructType([])
    counts = [F.count(f"`{c}`").alias(f"n{i}") for i, c in enumerate(columns)]
    counts += [
        F.count(parsed(F.col(f"`{c}`"), kind)).alias(f"{kind}{i}") for i, c in enumerate(columns) for kind, _ in LATTICE
    ]
    found = texts.agg(*counts).first()
    fields = []
    for i, name in enumerate(columns):
        known = found[f"n{i}"]
        fits = [t for kind, t in LATTICE if known and known - found[f"{kind}{i}"] <= tolerance * known]
        fields.append(T.StructField(name, fits[0] if fits else T.StringType()))
    return T.StructType(fields)


def read_inferred_csv(
    spark: SparkSession, path: str, tolerance: float = 0.0, na_tokens: Sequence[str] = schema.NA_TOKENS
) -> Extract:
    """Read a delimited extract with a header whose types are not known.

    Tokens for "missing" become null and fit any type; a blank is a value. A line
    with too many or too few fields is rejected (reason ``fields``) and has no say in
    the types. With a ``tolerance`` a column may be typed although a few values do
    not fit; rows that hold such a value are rejected, with the column as reason.
    Nothing is dropped: every line is in ``rows`` or in ``rejected``. The file is read
    once as text and staged, so that both tables and the types come from the same rows.
    """
    source = spark.read.option("header", True).option("inferSchema", False)
    columns = source.csv(path).columns
    if {_BROKEN, _REASONS} & set(columns):
        raise ValueError(f"{_BROKEN} and {_REASONS} cannot be columns of an extract")
    text = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, _BROKEN]])
    # Without column pruning, or lines would be judged by the columns asked for only.
    lines = source.schema(text).option("columnNameOfCorruptRecord", _BROKEN).option("columnPruning", False).csv(path)
    known = {c: F.when(~F.col(f"`{c}`").isin(*na_tokens), F.col(f"`{c}`")).alias(c) for c in columns}
    table = staged(lines.select(*known.values(), _BROKEN), "inferred")
    whole = table.where(F.col(_BROKEN).isNull())
    types = infer_types(whole, columns, tolerance)
    kinds = {t.typeName(): kind for kind, t in LATTICE}
    typed = {f.name: parsed(F.col(f"`{f.name}`"), kinds[f.dataType.typeName()]) for f in types if f.dataType.typeName() in kinds}
    misfit = [F.when(F.col(f"`{c}`").isNotNull() & v.isNull(), F.lit(c)) for c, v in typed.items()]
    reasons = F.when(F.col(_BROKEN).isNotNull(), F.array(F.lit("fields"))).otherwise(
        F.array_compact(F.array(*misfit)) if misfit else F.array().cast("array<string>")
    )
    judged = table.withColumn(_REASONS, reasons)
    fine = judged.where(F.size(_REASONS) == 0)
    rows = fine.select(*[typed.get(c, F.col(f"`{c}`")).alias(c) for c in columns])
    rejected = judged.where(F.size(_REASONS) > 0).select(
        F.struct(*[f"`{c}`" for c in columns]).alias("fields"), F.col(_REASONS).alias("reasons"), F.col(_BROKEN).alias("line")
    )
    return Extract(rows, rejected, types)
