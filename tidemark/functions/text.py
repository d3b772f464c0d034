"""String expressions: masks, padding, JSON text, deterministic hashing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def partial_mask(value: Column, prefix: int, padding: str, suffix: int) -> Column:
    """Show ``prefix`` leading and ``suffix`` trailing characters around a pad.

    A value too short to keep both ends apart shows the pad alone; NULL stays
    NULL.
    """
    shown = F.concat(F.substring(value, 1, prefix), F.lit(padding), F.right(value, F.lit(suffix)))
    return F.when(F.length(value) >= prefix + suffix, shown).when(
        value.isNotNull(), F.lit(padding))


def zero_padded(number: Column, width: int) -> Column:
    """Left-pad with zeros; numbers wider than ``width`` are kept whole."""
    digits = number.cast("string")
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0"))


def json_text(df: DataFrame, column: str) -> Column:
    """The column as text: strings as they are, anything nested as JSON."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return F.col(column)
    return F.to_json(F.col(column)).alias(column)


def surrogate_key(natural_key: str | Column) -> Column:
    return F.xxhash64(natural_key)
