"""Table readers for parquet, CSV, JSON and keyed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from predia.operators.cleaning import quoted
from predia.sources.split_csv import can_split, read_split_csv


class UnknownFormatError(ValueError):
    """No reader for the asked format."""


# Full-load files are named LOAD…, change files start with their date; each mode skips the other's files. The first
# pattern is "does not start with LOAD". Other files are not even listed, so they do not decide the schema either.
_FILES = {None: None, "cdc": "{[^L]*,L[^O]*,LO[^A]*,LOA[^D]*}", "fl": "[^2]*"}


# What each format is read with, in batch and in streams alike.
FORMATS = {
    "parquet": {},
    "csv": {"header": True, "quote": '"', "escape": '"', "sep": ","},
    "json": {"multiLine": True},
}


def reader_of(reader, fmt: str, mode: str | None, **options):
    """A batch or stream reader of a format and an ingestion mode."""
    if fmt not in FORMATS:
        raise UnknownFormatError(fmt)
    return of_mode(reader, mode).format(fmt).options(**{**FORMATS[fmt], **options})


def of_mode(reader, mode: str | None):
    """A batch or stream reader of the files that belong to an ingestion mode, in all subfolders."""
    if mode not in _FILES:
        raise ValueError(f"unknown ingestion mode {mode!r}: use 'cdc', 'fl' or None")
    reader = reader.option("recursiveFileLookup", True)
    return reader if _FILES[mode] is None else reader.option("pathGlobFilter", _FILES[mode])


def read_table(
    spark: SparkSession, path: str | list[str], fmt: str = "parquet", mode: str | None = None,
    schema: T.StructType | str | None = None, record_path: str | None = "id", **options,
) -> DataFrame:
    """All files under ``path``, its subfolders too.

    CSV has a header, commas and double quotes, and may have line breaks inside quotes, see ``split_csv``. With
    ``multiLine`` set, true or false, or an option that reading in splits does not know, Spark's reader takes the files;
    where a value may hold a line break that is a task a file. JSON files hold one document each, its records under the field
    ``record_path`` (a record, or a list of them); with ``None`` the document is the record. ``keyed`` reads the
    current rows of a keyed table.
    """
    if fmt == "keyed":
        from predia.sources.keyed_table import KeyedTable

        return KeyedTable(spark, path).snapshot()
    if fmt == "csv" and "multiLine" not in options:
        if can_split(wanted := {**FORMATS["csv"], **options}):
            return read_split_csv(spark, lambda: of_mode(spark.read, mode), path, wanted, schema)
        options["multiLine"] = True
    reader = reader_of(spark.read, fmt, mode, **options)
    if schema is not None:
        reader = reader.schema(schema)
    rows = reader.load(path)
    return records(rows, record_path) if fmt == "json" and record_path is not None else rows


def records(documents: DataFrame, path: str) -> DataFrame:
    found = documents.select(quoted(path).alias("record"))
    if isinstance(found.schema["record"].dataType, T.ArrayType):
        found = found.select(F.explode("record").alias("record"))
    if isinstance(found.schema["record"].dataType, T.StructType):
        return found.select("record.*")
    return found.withColumnRenamed("record", path)


def query_view(spark: SparkSession, df: DataFrame, view: str, sql: str) -> DataFrame:
    """Register ``df`` as a temporary view and run SQL over it."""
    df.createOrReplaceTempView(view)
    return spark.sql(sql)
