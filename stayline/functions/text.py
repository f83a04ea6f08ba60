"""Text expressions: identifiers, trimming, title case, guarded numbers."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from stayline.schema import WHITESPACE

# Fixed values: (pattern, replacement) steps that turn an identifier into snake_case.
SNAKE_STEPS = (
    (r"([a-z0-9])([A-Z])", r"$1_$2"),
    (r"([A-Z]+)([A-Z][a-z])", r"$1_$2"),
    (r"[\s\-]+", "_"),
    (r"[^\w]", ""),
    (r"_+", "_"),
)
# Fixed value: text that counts as a number.
NUMBER_PATTERN = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"


def snake_case(text: str) -> str:
    """snake_case of one identifier, for column names."""
    for pattern, replacement in SNAKE_STEPS:
        text = re.sub(pattern, replacement.replace("$", "\\"), text)
    return text.lower().strip("_")


def snake_case_column(column: Column) -> Column:
    """snake_case of every value of a text column."""
    for pattern, replacement in SNAKE_STEPS:
        column = F.regexp_replace(column, pattern, replacement)
    return F.trim(F.lower(column), F.lit("_"))


def strip(column: Column) -> Column:
    """Trim every kind of whitespace, not only blanks."""
    return F.trim(column, F.lit(WHITESPACE))


def title_case(column: Column) -> Column:
    """Upper-case the first letter after every non-letter, lower-case the rest.

    ``initcap`` alone only splits at blanks, so values with other separators
    are cut into letter and non-letter runs first.
    """
    runs = F.regexp_extract_all(F.lower(column), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.when(column.rlike("^[A-Za-z ]*$"), F.initcap(column)).otherwise(
        F.array_join(F.transform(runs, F.initcap), "")
    )


def is_number(column: Column) -> Column:
    """True where the text reads as a number; NULL for NULL."""
    return column.rlike(NUMBER_PATTERN)


def to_number(column: Column) -> Column:
    """Double value of numeric text, NULL for anything else.

    The pattern guard matters: a bare ``try_cast`` would also accept Java
    suffixes such as ``1d``.
    """
    return F.when(is_number(column), F.trim(column, F.lit(WHITESPACE)).try_cast("double"))
