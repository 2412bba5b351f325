"""Cleaning: empty text, blanks, missing numbers, missing required values."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str):
    """A column by its exact name, also when the name holds dots or brackets."""
    return F.col("`" + name.replace("`", "``") + "`")


def clean_strings(df: DataFrame, blank_is_null: bool = False) -> DataFrame:
    """Empty text becomes null, then text is trimmed.

    A text of blanks only is therefore kept as empty text, as in the source feed's rule; ``blank_is_null`` makes it
    null as well. Columns of other types pass through.
    """
    def cleaned(field: T.StructField):
        column = quoted(field.name)
        if not isinstance(field.dataType, T.StringType):
            return column
        text = F.trim(F.nullif(column, F.lit("")))
        return (F.nullif(text, F.lit("")) if blank_is_null else text).alias(field.name)

    return df.select(*[cleaned(field) for field in df.schema])


def fill_zero(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.fillna(0, subset=list(columns))


def require(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Rows that hold a value in each of the columns."""
    return df.dropna(subset=list(columns))
