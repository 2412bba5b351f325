"""Change application: stamp, precombine, upsert, delete, and all of them for a change feed."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from predia.fixed_values import ENVELOPE, STAMP
from predia.functions import parse_time
from predia.operators.cleaning import quoted
from predia.operators.latest import one_per_key

DELETE = "D"
OPERATIONS = ("I", "U", DELETE)


def strip_envelope(df: DataFrame, columns: Iterable[str] = ENVELOPE) -> DataFrame:
    return df.drop(*columns)


def stamp(df: DataFrame, source: str | None = None, in_place: bool = False, as_of: Column | None = None) -> DataFrame:
    """The transaction time of each row.

    It comes from ``source``, which is dropped, or converted under its own name when ``in_place``; without a source
    it is the clock.
    """
    if source is None:
        return df.withColumn(STAMP, F.current_timestamp() if as_of is None else as_of)
    moment = parse_time(quoted(source))
    if in_place:
        return df.withColumn(source, moment)
    return df.withColumn(STAMP, moment).drop(source)


def upsert(target: DataFrame, source: DataFrame, keys: Iterable[str], order: Iterable[str] = ()) -> DataFrame:
    """``target`` with the rows of ``source`` added, or put in place of the row with the same key.

    Source rows that share a key are first combined into the one with the greatest ``order``. A source row wins over
    the stored one whatever their times; a column the other side lacks is null.
    """
    keys = list(keys)
    rows = one_per_key(source, keys, order)
    kept = hard_delete(target, rows, keys)
    return kept.unionByName(rows, allowMissingColumns=True)


def hard_delete(target: DataFrame, removed: DataFrame, keys: Iterable[str]) -> DataFrame:
    """``target`` without the keys in ``removed``; unknown keys do nothing. A null key equals a null key."""
    keys = list(keys)
    names = [f"_key{i}" for i in range(len(keys))]
    gone = removed.select(*[quoted(k).alias(n) for k, n in zip(keys, names)])
    return target.join(gone, [target[k].eqNullSafe(F.col(n)) for k, n in zip(keys, names)], "left_anti")


def known_operation(op: str = "Op", operations: Iterable[str] = OPERATIONS) -> Column:
    """The operation, where it is a declared one or none. Any other ends the job that reads it."""
    unknown = F.raise_error(F.concat(F.lit(f"unknown operation in {op}: "), quoted(op).cast("string")))
    return F.when(quoted(op).isNull() | quoted(op).isin(*operations), quoted(op)).otherwise(unknown)


def change_strength(op: str = "Op") -> Column:
    """What counts among equally new changes: a delete before a write, a write before a row without an operation."""
    return F.when(quoted(op) == DELETE, 2).when(quoted(op).isNotNull(), 1).otherwise(0)


def settle_changes(
    changes: DataFrame, keys: Iterable[str], order: Iterable[str], op: str = "Op", null_op_is_upsert: bool = False
) -> DataFrame:
    """The one change per key that counts, ``op`` included. An operation that is not a declared one is an error.

    It is the newest; among equally new ones a delete beats a write, and a write beats a row without an operation.
    A key whose newest change has no operation is left out, also when older changes of that key have one.
    """
    keys, order = list(keys), list(order)
    changes = changes.withColumn(op, known_operation(op))
    if null_op_is_upsert:
        changes = changes.withColumn(op, F.coalesce(quoted(op), F.lit("U")))
    newest = one_per_key(changes.withColumn("_strength", change_strength(op)), keys, [*order, "_strength"])
    return newest.where(quoted(op).isNotNull()).drop("_strength")


def without_late(settled: DataFrame, target: DataFrame, keys: Iterable[str], order: Iterable[str]) -> DataFrame:
    """Changes that are not older than the stored row of their key.

    First the stored rows of the changed keys are picked: there the changes are the side that Spark may broadcast, so
    the stored table is not shuffled for a small batch.
    """
    keys, order = list(keys), list(order)
    names = [f"_key{i}" for i in range(len(keys))]
    stored = target.select(*[quoted(k).alias(n) for k, n in zip(keys, names)],
                           F.struct(*[quoted(c) for c in order]).alias("_stored"))
    same = [F.col(n).eqNullSafe(settled[k]) for k, n in zip(keys, names)]
    old = stored.join(settled.select(*keys), same, "left_semi")
    fresh = F.col("_stored").isNull() | (F.struct(*[quoted(c) for c in order]) >= F.col("_stored"))
    return settled.join(old, same, "left").where(fresh).drop("_stored", *names)


def apply_changes(
    target: DataFrame,
    changes: DataFrame,
    keys: Iterable[str],
    order: Iterable[str],
    op: str = "Op",
    guard_late: bool = False,
    null_op_is_upsert: bool = False,
) -> DataFrame:
    """``target`` after a batch of a change feed.

    A change replaces the stored row even when it is older, unless ``guard_late``. The changes are settled once;
    Spark reuses that shuffle for the rows to remove and the rows to add.
    """
    keys, order = list(keys), list(order)
    settled = settle_changes(changes, keys, order, op, null_op_is_upsert)
    if guard_late:
        settled = without_late(settled, target, keys, order)
    written = strip_envelope(settled.where(quoted(op) != DELETE), {*ENVELOPE, op})
    return hard_delete(target, settled, keys).unionByName(written, allowMissingColumns=True)
