"""A folder of change files, applied to a keyed table by Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from predia.sources.keyed_table import KeyedTable, MissingTableError
from predia.sources.readers import of_mode, read_table, reader_of

# So many files a batch, where the caller does not say.
MOST_FILES = 10_000


def read_new_files(
    spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet", mode: str | None = "cdc",
    max_files: int | None = None,
) -> DataFrame:
    """A streaming frame over the files of an ingestion mode; a query's checkpoint remembers which were read.

    JSON gives documents; ``readers.records`` takes their records out.
    """
    options = {"multiLine": True} if fmt == "csv" else {}
    reader = reader_of(spark.readStream, fmt, mode, **options).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def stream_files(
    spark: SparkSession, path: str, fmt: str, mode: str | None, table: KeyedTable, order: Iterable[str],
    checkpoint: str, prepare: Callable[[DataFrame], DataFrame], max_files: int | None = None,
    read_options: Mapping[str, object] | None = None, **kwargs,
) -> StreamingQuery:
    """Apply the files that no earlier run took, read as a batch reads them.

    A batch takes ``max_files`` at most, so that the names on the driver stay bounded; a run goes on until all are taken.

    The stream only lists names: the content column of ``binaryFile`` is never read. The files of a batch are then
    read together, with all columns that any of them has. What a batch reader refuses ends the batch before the
    checkpoint moves, so no file counts as taken that was not applied.
    """
    reader = of_mode(spark.readStream, mode).format("binaryFile").schema(
        "path string, modificationTime timestamp, length long, content binary")
    reader = reader.option("maxFilesPerTrigger", max_files or MOST_FILES)
    options = {**({"mergeSchema": True} if fmt == "parquet" else {}), **(read_options or {})}

    def read(batch: DataFrame) -> DataFrame | None:
        names = sorted(r["path"] for r in batch.collect())
        return prepare(read_table(batch.sparkSession, names, fmt, **options)) if names else None

    return stream_changes(reader.load(path).select("path"), table, order, checkpoint, prepare=read, **kwargs)


def stream_changes(
    changes: DataFrame, table: KeyedTable, order: Iterable[str], checkpoint: str, op: str = "Op",
    guard_late: bool = False, prepare: Callable[[DataFrame], DataFrame | None] | None = None,
    check: Callable[[DataFrame, str], DataFrame] | None = None,
) -> StreamingQuery:
    """Start a query that applies every new file to ``table`` and ends (trigger ``availableNow``).

    Each micro-batch is one commit named after the batch. A batch that is replayed after a crash writes the same rows
    by key, so it counts once. The checkpoint moves only after the commit is written. ``check`` gets the rows and the
    name of the commit, and gives those that are to be applied.
    """
    order = list(order)
    last = table.last_commit()
    if last is None:
        raise MissingTableError(table.path)
    origin = last.split("-")[0]

    def apply(batch: DataFrame, batch_id: int) -> None:
        # Streams run without adaptive execution; a batch in here is an ordinary frame and gets it back.
        batch.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
        commit = f"{origin}-{batch_id:012d}"
        rows = batch if prepare is None else prepare(batch)
        if rows is not None and check is not None:
            rows = check(rows, commit)
        if rows is not None:
            table.apply_changes(rows, order, op, guard_late, commit=commit)

    return (
        changes.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
