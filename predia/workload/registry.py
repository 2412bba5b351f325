"""The list of registered queries, and the types in which they are compared."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from predia.operators.cleaning import quoted
from predia.session import own_session, size_shuffles

Runner = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Runner] = {}
ORACLES: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Decimals and floats as doubles, timestamps without zone: types every comparison reads alike."""
    def plain(field: T.StructField):
        if isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            return quoted(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return quoted(field.name).cast("timestamp_ntz").alias(field.name)
        return quoted(field.name)

    return df.select(*[plain(field) for field in df.schema])


def query(name: str, oracle: str | None = None) -> Callable[[Runner], Runner]:
    """Register a query under ``name``, with the SQL that must give the same rows."""
    def register(run: Runner) -> Runner:
        def tuned(spark: SparkSession, folder: str) -> DataFrame:
            rows = portable(run(own_session(spark), folder))
            size_shuffles(rows)
            return rows

        QUERIES[name] = tuned
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return register
