"""Configuration of tables and jobs."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from predia.fixed_values import CUSTOMER_TABLES, DEFAULT_KEY, MARKETPLACE_TABLES, OTHER_KEYS
from predia.sources import files


class ConfigError(ValueError):
    """A configuration that lacks a required entry or holds one of the wrong type."""


@dataclass(frozen=True)
class TableConfig:
    """Key of a table, and optionally its partition column, ordering column and column mapping.

    ``read_options`` are the options of the format in which its files come, ``buckets`` and ``write_options`` how the
    curated table is laid out and written. ``rules`` are the types of its columns and which of them are required, see
    ``quarantine``; of a delivery ``most_bad`` rows may break them.
    """

    primary_key: str
    partition_key: str | None = None
    precomb_key: str | None = None
    columns: Mapping[str, Mapping] = field(default_factory=dict)
    read_options: Mapping[str, object] = field(default_factory=dict)
    buckets: int | None = None
    write_options: Mapping[str, str] = field(default_factory=dict)
    rules: Mapping[str, str] = field(default_factory=dict)
    most_bad: int | None = None

    @classmethod
    def parse(cls, entries: Mapping) -> TableConfig:
        if not isinstance(entries, Mapping) or not isinstance(entries.get("primary_key"), str):
            raise ConfigError("a table configuration needs primary_key, a text")
        for name in ("partition_key", "precomb_key"):
            if name in entries and not isinstance(entries[name], str):
                raise ConfigError(f"{name} must be a text")
        for name in ("columnas", "read_options", "write_options", "rules"):
            if not isinstance(entries.get(name, {}), Mapping):
                raise ConfigError(f"{name} must hold entries")
        buckets = entries.get("buckets")
        if buckets is not None and (not isinstance(buckets, int) or isinstance(buckets, bool) or buckets < 1):
            raise ConfigError("buckets must be a number from 1 on")
        return cls(
            entries["primary_key"], entries.get("partition_key"), entries.get("precomb_key"),
            entries.get("columnas", {}), entries.get("read_options", {}), buckets, entries.get("write_options", {}),
            entries.get("rules", {}), entries.get("most_bad"),
        )


def load_table_config(spark: SparkSession, path: str) -> TableConfig:
    """A table configuration from a JSON file."""
    return TableConfig.parse(json.loads(files.read_text(spark, path)))


def table_config(table: str) -> TableConfig:
    """The built-in configuration of a marketplace table."""
    return TableConfig(OTHER_KEYS.get(table, DEFAULT_KEY))


@dataclass(frozen=True)
class JobConfig:
    """Where a job reads and writes, and how it names its tables.

    ``mappings`` is a folder of table configurations. With ``catalog``, every write is followed in the session's
    catalog, in the job's database.
    """

    source_root: str
    target_root: str
    route: str = ""
    database: str = ""
    prefix: str = ""
    suffix: str = ""
    file_format: str = "parquet"
    mappings: str | None = None
    catalog: bool = False

    def table_config(self, spark: SparkSession, table: str) -> TableConfig:
        """The configuration ``mapping_<table>.json`` of the job's folder, else the built-in one."""
        path = f"{self.mappings}/mapping_{table}.json" if self.mappings else None
        return load_table_config(spark, path) if path and files.exists(spark, path) else table_config(table)

    def catalog_name(self, schema: str, table: str) -> str | None:
        """The name under which a table is published, if the job publishes any."""
        if not self.catalog:
            return None
        return f"{self.database}.{self.table_name(table)}" if self.database else f"{schema}_{self.table_name(table)}"

    def source(self, schema: str, table: str) -> str:
        return "/".join(p for p in (self.source_root, self.route, schema, table) if p)

    def target(self, schema: str, table: str) -> str:
        """Targets keep the source schema in the path: two schemas may hold tables of one name."""
        return "/".join(p for p in (self.target_root, self.route, self.database, schema, self.table_name(table)) if p)

    def table_name(self, table: str) -> str:
        return f"{self.prefix}{table}{self.suffix}"


def selected_tables(marketplace_schema: str, customer_schema: str) -> list[tuple[str, str]]:
    """The (schema, table) pairs that are ingested."""
    return [(marketplace_schema, t) for t in MARKETPLACE_TABLES] + [(customer_schema, t) for t in CUSTOMER_TABLES]


def discover_tables(spark: SparkSession, root: str) -> list[tuple[str, str]]:
    """The (schema, table) pairs found as folders ``root/schema/table``."""
    return [(s, t) for s in files.folders(spark, root) for t in files.folders(spark, f"{root}/{s}")]
