"""Text to number conversion that accepts what a SQL database accepts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_DECIMAL_TEXT = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*\z"


def is_number_text(text: Column) -> Column:
    """True for plain decimal text; Spark's own cast would also take ``1.0d``."""
    return text.rlike(_DECIMAL_TEXT)


def to_double(text: Column, permissive: bool = False) -> Column:
    """Number in ``text``; malformed text fails the query, or gives null if ``permissive``."""
    parsed = F.when(is_number_text(text), F.trim(text).try_cast("double"))
    if permissive:
        return parsed
    bad = F.concat(F.lit("not a number: "), text)
    return F.when(text.isNull() | parsed.isNotNull(), parsed).otherwise(
        F.raise_error(bad).cast("double")
    )
