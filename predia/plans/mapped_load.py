"""Mapped load: read, map, add a key, run the caller's step, overwrite."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from predia.operators.schema import add_surrogate_key, apply_mapping
from predia.sources.config import TableConfig, load_table_config
from predia.sources.keyed_table import KeyedTable
from predia.sources.readers import read_table


def prepare(
    df: DataFrame, key: str, mapping: Mapping | None = None, create_key: bool = False,
    natural_key: Iterable[str] | None = None, step: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    if mapping:
        df = apply_mapping(df, mapping)
    if create_key:
        df = add_surrogate_key(df, key, natural_key)
    return df if step is None else df.transform(step)


def run_mapped_load(
    spark: SparkSession, source: str, target: str, fmt: str, key: str, mapping: Mapping | None = None,
    create_key: bool = False, natural_key: Iterable[str] | None = None,
    step: Callable[[DataFrame], DataFrame] | None = None,
) -> KeyedTable:
    rows = prepare(read_table(spark, source, fmt), key, mapping, create_key, natural_key, step)
    table = KeyedTable(spark, target, key)
    table.overwrite(rows)
    return table


def run_configured_load(
    spark: SparkSession, source: str, target: str, fmt: str, config: TableConfig | str, **kwargs
) -> KeyedTable:
    """The same, with key and mapping from a table configuration or its JSON file."""
    if isinstance(config, str):
        config = load_table_config(spark, config)
    return run_mapped_load(spark, source, target, fmt, config.primary_key, config.columns or None, **kwargs)
