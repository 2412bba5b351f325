"""Two tables compared by fingerprints: which keys were added, changed or are missing.

Both tables are cut into ranges of a key. Per range an order-free fingerprint of the whole rows is compared: their number
and the sum of their hashes, which each task adds up where it reads. Ranges that differ are cut into finer ones and read again,
with the ranges as filters that reach the scan; equal ranges are not read again. In the end only the keys of the ranges
that still differ are compared one by one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from predia.operators.cleaning import quoted

ADDED, CHANGED, MISSING = "added", "changed", "missing"


def row_hash(columns: list[str]) -> Column:
    """A hash of whole rows. A null and its column's place count, so rows that only swap values differ."""
    nulls = F.concat_ws(",", *[F.when(quoted(c).isNull(), str(i)) for i, c in enumerate(columns)])
    return F.xxhash64(*[quoted(c) for c in columns], nulls)


def _range_of(key: Column, bounds: list) -> Column:
    """The number of bounds below a key; no keys but null ones are in range -1."""
    below = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b < key)) if bounds else F.lit(0)
    return F.when(key.isNull(), -1).otherwise(below)


def _prints(df: DataFrame, key: str, columns: list[str], bounds: list) -> DataFrame:
    hashed = row_hash(columns)
    return df.groupBy(_range_of(quoted(key), bounds).alias("range")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(hashed.cast("decimal(38, 0)")).alias("sum"), F.bit_xor(hashed).alias("xor"))


def _inside(key: Column, ranges: list[tuple]) -> Column:
    """Whether a key lies in one of the ranges (low, high]; None is open, and (None, None, True) asks for nulls."""
    def one(span: tuple) -> Column:
        low, high, nulls = span
        if nulls:
            return key.isNull()
        parts = [key > F.lit(low)] if low is not None else []
        parts += [key <= F.lit(high)] if high is not None else []
        return reduce(lambda a, b: a & b, parts) if parts else key.isNotNull()

    return reduce(lambda a, b: a | b, [one(s) for s in ranges])


def differing_ranges(left: DataFrame, right: DataFrame, key: str, columns: list[str], ranges: int = 64) -> list[tuple]:
    """The ranges of ``key``, at most so many, in which the tables differ."""
    shares = [i / ranges for i in range(1, ranges)]
    # Bounds from both sides, so that a side without rows in a range does not hide the other's.
    both = left.select(quoted(key)).unionAll(right.select(quoted(key)))
    found = both.agg(F.percentile_approx(quoted(key), shares, 10_000)).first()[0] if _is_number(left, key) else None
    bounds = sorted(set(found or []))
    mine, theirs = (_prints(df, key, columns, bounds) for df in (left, right))
    other = theirs.select(*[F.col(c).alias(f"o_{c}") for c in theirs.columns])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"o_{c}")) for c in ("rows", "sum", "xor")])
    rows = mine.join(other, F.col("range") == F.col("o_range"), "full").where(~same).select(
        F.coalesce("range", "o_range").alias("range")).collect()
    numbers = sorted(r["range"] for r in rows)
    return [(None, None, True) if n < 0 else
            (bounds[n - 1] if n else None, bounds[n] if n < len(bounds) else None, False) for n in numbers]


def _is_number(df: DataFrame, key: str) -> bool:
    return df.schema[key].dataType.typeName() in ("byte", "short", "integer", "long", "float", "double", "date",
                                                  "timestamp", "timestamp_ntz", "decimal")


def reconcile(left: DataFrame, right: DataFrame, key: str, levels: int = 2, ranges: int = 64) -> DataFrame:
    """key and ``difference`` of every key whose rows differ: added in ``right``, missing there, or changed.

    A key may stand on several rows: then all of them together are compared. ``key`` is a number or a time where ranges
    are to be found; other keys are compared one by one.
    """
    columns = list(left.columns)
    if sorted(columns) != sorted(right.columns):
        raise ValueError(f"the tables have other columns: {sorted(set(columns) ^ set(right.columns))}")
    for _ in range(levels if _is_number(left, key) else 0):
        spans = differing_ranges(left, right, key, columns, ranges)
        if not spans:
            left, right = left.limit(0), right.limit(0)
            break
        left, right = (df.where(_inside(quoted(key), spans)) for df in (left, right))

    def per_key(df: DataFrame, name: str) -> DataFrame:
        hashed = row_hash(columns)
        return df.groupBy(quoted(key).alias(f"{name}_key")).agg(F.struct(
            F.count(F.lit(1)).alias("rows"), F.sum(hashed.cast("decimal(38, 0)")).alias("sum"),
            F.bit_xor(hashed).alias("xor")).alias(name))

    both = per_key(left, "mine").join(
        per_key(right, "theirs"), F.col("mine_key").eqNullSafe(F.col("theirs_key")), "full")
    found = F.when(F.col("mine").isNull(), ADDED).when(F.col("theirs").isNull(), MISSING).otherwise(CHANGED)
    return both.where(~F.col("mine").eqNullSafe(F.col("theirs"))).select(
        F.coalesce("mine_key", "theirs_key").alias(key), found.alias("difference"))
