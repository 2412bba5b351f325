"""Latest row per key as the state of a stream.

A streaming aggregation keeps the newest change of every key in the state store, so a late change falls out there and the
stored table is not read to find out. A batch passes on only the keys whose newest change came with it. The state is
Spark's own RocksDB store: it lies on the executors' disks, its checkpoint in the shared folder.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from predia.operators.changes import DELETE, change_strength, known_operation, strip_envelope
from predia.operators.cleaning import quoted
from predia.session import scratch_path
from predia.sources import files
from predia.sources.keyed_table import KeyedTable

STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextlib.contextmanager
def state_settings(spark: SparkSession, partitions: int | None):
    """A query that starts in here keeps its state in RocksDB, in so many partitions for as long as it lives."""
    wanted = {**STATE_CONF, **({"spark.sql.shuffle.partitions": str(partitions)} if partitions else {})}
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def newest_moves(changes: DataFrame, keys: Iterable[str], order: Iterable[str], op: str = "Op") -> DataFrame:
    """Of a stream of changes the newest per key over all batches; a batch gives the keys whose newest came with it.

    Ties go as in ``settle_changes``: a delete beats a write, a write a row without operation, then the other columns
    decide. An equal change that comes again is passed on again, which changes nothing.
    """
    keys, order = list(keys), list(order)
    rest = [c for c in changes.columns if c not in keys and c not in order]
    names = {c: f"c{i}" for i, c in enumerate(order + rest)}
    changes = changes.withColumn(op, known_operation(op))
    # All rows of a batch have one time of arrival.
    arriving = changes.withColumn("_arrived", F.current_timestamp())
    packed = F.struct(
        *[quoted(c).alias(names[c]) for c in order], change_strength(op).alias("strength"),
        *[quoted(c).alias(names[c]) for c in rest], F.col("_arrived").alias("arrived"))
    newest = arriving.groupBy(*[quoted(k) for k in keys]).agg(
        F.max(packed).alias("_newest"), F.max("_arrived").alias("_last"))
    moved = newest.where(F.col("_newest.arrived") == F.col("_last"))
    return moved.select(*[F.col("_newest")[names[c]].alias(c) if c in names else quoted(c) for c in changes.columns])


def stream_latest(
    changes: DataFrame, table: KeyedTable, order: Iterable[str], checkpoint: str, op: str = "Op",
    partitions: int | None = None, prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Keep ``table`` at the newest change per key of a stream, full load included, and end when all is taken.

    Batches may come in any order of time. A table that does not exist is made by the first batch. A batch that is
    replayed counts once: its commit has its name.
    """
    order, spark = list(order), changes.sparkSession
    last = table.last_commit()
    origin = (last or table.new_commit()).split("-")[0]
    prepared = changes if prepare is None else prepare(changes)

    def apply(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        session.conf.set("spark.sql.adaptive.enabled", "true")
        # Written once, so that the state is asked once.
        path = scratch_path(session, "stream-latest")
        batch.write.parquet(path)
        rows = session.read.schema(batch.schema).parquet(path).where(quoted(op).isNotNull())
        written = strip_envelope(rows.where(quoted(op) != DELETE).drop(op))
        commit = f"{origin}-{batch_id:012d}"
        if table.exists():
            table.merge(written, rows.where(quoted(op) == DELETE), commit)
        else:
            table.overwrite(written, commit)
        files.delete(session, path)

    with state_settings(spark, partitions):
        return (
            newest_moves(prepared, table.keys, order, op).writeStream.outputMode("update").foreachBatch(apply)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
