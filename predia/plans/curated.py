"""Raw to curated: a full load or the change files of every table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from predia.fixed_values import FEED_STAMP, STAMP, TEXT_DATES
from predia.operators.changes import stamp
from predia.operators.cleaning import clean_strings
from predia.operators.schema import dates_as_text
from predia.plans.quarantine import without_bad_rows
from predia.plans.together import run_together
from predia.sources import files
from predia.sources.config import ConfigError, JobConfig, TableConfig, discover_tables, selected_tables
from predia.sources.keyed_table import KeyedTable, MissingTableError
from predia.sources.readers import read_table
from predia.streaming.change_stream import stream_files


def curate(raw: DataFrame, feed_stamp: str = FEED_STAMP, text_dates: Iterable[str] = ()) -> DataFrame:
    """Clean text, then turn the feed's time into the transaction time. Works on batches and streams."""
    return stamp(clean_strings(dates_as_text(raw, text_dates)), feed_stamp)


def curated_table(
    spark: SparkSession, job: JobConfig, schema: str, table: str, config: TableConfig | None = None,
) -> KeyedTable:
    config = config or job.table_config(spark, table)
    layout = {} if config.buckets is None else {"buckets": config.buckets}
    return KeyedTable(spark, job.target(schema, table), config.primary_key, config.partition_key, **layout,
                      write_options=config.write_options, catalog_name=job.catalog_name(schema, table))


def bad_rows_folder(job: JobConfig, schema: str, table: str) -> str:
    """Where the rows of a table lie that break its rules; ``quarantine.quarantined`` reads them."""
    return f"{job.target(schema, table)}-bad-rows"


def load_table(
    spark: SparkSession, job: JobConfig, schema: str, table: str, mode: str, config: TableConfig | None = None,
    guard_late: bool = False, max_files: int | None = None,
) -> str | None:
    """One table in one mode; gives the last commit, or None when there was nothing to write.

    ``fl`` takes the full-load files, all of them each time. ``cdc`` takes the change files that no earlier run took:
    a stream's checkpoint beside the table remembers them, so a run costs what is new. A change counts whatever its
    time, also after a fresh full load; with ``guard_late`` one that is older than the stored row is left out.

    Rows that break the rules of the table's configuration are put aside; more than it allows end the load, of changes
    before their files count as taken.
    """
    config = config or job.table_config(spark, table)
    source, target = job.source(schema, table), curated_table(spark, job, schema, table, config)
    feed_stamp, text_dates = config.precomb_key or FEED_STAMP, TEXT_DATES.get(table, ())
    if mode != "cdc":
        raw = read_table(spark, source, job.file_format, mode, **config.read_options)
        if config.primary_key not in raw.columns:
            raise ConfigError(f"{source} has no column {config.primary_key}, the key of {table}")
        commit, rows = target.new_commit(), curate(raw, feed_stamp, text_dates)
        if config.rules:
            rows = without_bad_rows(rows, config.rules, bad_rows_folder(job, schema, table), commit, config.most_bad)
        return target.write(rows, mode, [STAMP], commit)
    before = target.last_commit()
    if before is None:
        raise MissingTableError(target.path)
    check = None
    if config.rules:
        def check(rows: DataFrame, commit: str) -> DataFrame:
            return without_bad_rows(rows, config.rules, bad_rows_folder(job, schema, table), commit, config.most_bad)

    stream_files(
        spark, source, job.file_format, mode, target, [STAMP], f"{target.path}/checkpoint",
        prepare=lambda batch: curate(batch, feed_stamp, text_dates), max_files=max_files,
        read_options=config.read_options, guard_late=guard_late, check=check,
    ).awaitTermination()
    after = target.last_commit()
    return after if after != before else None


def load_all(
    spark: SparkSession, job: JobConfig, mode: str, tables: Iterable[tuple[str, str]] | None = None,
    guard_late: bool = False, parallel: int = 4,
) -> dict[tuple[str, str], str | None]:
    """Every listed table, or every table found in the source folders, a few at a time.

    Key, partition column and ordering column of a table come from its file in the job's configuration folder, if
    there is one, else from the built-in list.
    """
    if tables is None:
        tables = discover_tables(spark, "/".join(p for p in (job.source_root, job.route) if p))
    return run_together(spark, {
        (schema, table): lambda schema=schema, table=table: load_table(
            spark, job, schema, table, mode, guard_late=guard_late)
        for schema, table in tables
    }, parallel)


def load_selected(
    spark: SparkSession, job: JobConfig, mode: str, marketplace_schema: str, customer_schema: str, **kwargs,
) -> tuple[dict[tuple[str, str], str | None], list[tuple[str, str]]]:
    """The tables that are to be ingested, of those that the source has; and the others, which it lacks."""
    tables = selected_tables(marketplace_schema, customer_schema)
    there = [t for t in tables if files.exists(spark, job.source(*t))]
    return load_all(spark, job, mode, there, **kwargs), [t for t in tables if t not in there]
