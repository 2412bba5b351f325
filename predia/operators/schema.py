"""Schema operators: conform, complete, map, rename, surrogate keys, text dates."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from predia.fixed_values import LONG_TIME_PATTERN, TEXT_DATE_LENGTH
from predia.operators.cleaning import quoted


def parse_schema(schema: Iterable[T.StructField] | str) -> Iterable[T.StructField]:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def conform(df: DataFrame, schema: Iterable[T.StructField] | str) -> DataFrame:
    """The columns of ``schema``, by name, in its order and types; values that do not fit become null."""
    return df.select(*[quoted(f.name).try_cast(f.dataType).alias(f.name) for f in parse_schema(schema)])


def complete_columns(df: DataFrame, schema: Iterable[T.StructField] | str) -> DataFrame:
    """``df`` plus every column of ``schema`` it lacks, as typed nulls."""
    missing = [f for f in parse_schema(schema) if f.name not in df.columns]
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])


def apply_mapping(df: DataFrame, mapping: Mapping[str, Mapping] | Iterable[tuple[str, str, str, str]]) -> DataFrame:
    """Keep, cast and rename the mapped columns in one projection.

    ``mapping`` holds (source, source type, target, target type), or the configuration form
    ``{any: {"old": {"name", "type"}, "new": {"name", "type"}}}``. The source type is applied first, which settles a
    column that was read with another type.
    """
    if isinstance(mapping, Mapping):
        mapping = [(m["old"]["name"], m["old"]["type"], m["new"]["name"], m["new"]["type"]) for m in mapping.values()]
    return df.select(*[
        quoted(source).try_cast(source_type).try_cast(target_type).alias(target)
        for source, source_type, target, target_type in mapping
    ])


def rename_by_text(df: DataFrame, old: str, new: str) -> DataFrame:
    """Every column name with ``old`` replaced by ``new``."""
    return df.toDF(*[name.replace(old, new) for name in df.columns])


def add_surrogate_key(df: DataFrame, name: str, natural_key: Iterable[str] | None = None) -> DataFrame:
    """A numeric key.

    With a natural key it is a hash of it, the same in every run and after a lost executor. Without one it counts up
    within each partition, from 1, and holds only for this run.
    """
    if natural_key is not None:
        return df.withColumn(name, F.xxhash64(*[quoted(c) for c in natural_key]))
    return df.withColumn(name, F.monotonically_increasing_id() + 1)


def dates_as_text(df: DataFrame, columns: Iterable[str], length: int = TEXT_DATE_LENGTH) -> DataFrame:
    """The columns, those of them that exist, as text.

    A time whose text is longer than ``length``, which one with microseconds is, is written by a pattern that fits and
    loses nothing. Text stays as it is.
    """
    def text(name: str):
        plain = quoted(name).cast("string")
        if not isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType)):
            return plain
        return F.when(F.length(plain) > length, F.date_format(quoted(name), LONG_TIME_PATTERN)).otherwise(plain)

    return df.withColumns({c: text(c) for c in columns if c in df.columns})
