"""Dense surrogate keys that last: known natural keys keep their number, new ones go on after the greatest."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from predia.operators.cleaning import quoted
from predia.session import scratch_path, sized
from predia.sources import files

NUMBER = "_number"
KEYS_PER_PARTITION = 1_000_000


def numbered(keys: DataFrame, after: int = 0) -> DataFrame:
    """Distinct rows numbered without gaps in their order, from ``after`` + 1 on, without sorting them in one task.

    They are cut into ranges and sorted there; a number is the place in the range and the rows of the ranges before.
    """
    spark, columns = keys.sparkSession, keys.columns
    path = scratch_path(spark, "dense-keys")
    with sized(keys):
        keys.write.parquet(f"{path}/keys")
    keys = spark.read.schema(keys.schema).parquet(f"{path}/keys")
    ranges = max(math.ceil(keys.count() / KEYS_PER_PARTITION), int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = [quoted(c) for c in columns]
    placed = keys.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn(
        "_at", F.monotonically_increasing_id())
    placed.withColumn("_range", F.shiftright("_at", 33)).write.parquet(f"{path}/sorted")
    placed = spark.read.parquet(f"{path}/sorted")
    # One row per range.
    counts = placed.groupBy("_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_range", "_first", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    number = F.col("_at") - F.col("_first") + F.col("_before") + 1 + after
    return placed.join(starts, "_range").select(*order, number.alias(NUMBER))


class KeyRegistry:
    """The numbers given so far, one row per natural key, in one folder of parquet that only grows."""

    def __init__(self, spark: SparkSession, path: str, natural_key: Iterable[str]):
        self.spark, self.path, self.natural_key = spark, path.rstrip("/"), list(natural_key)

    def known(self) -> DataFrame | None:
        return self.spark.read.parquet(self.path) if files.exists(self.spark, self.path) else None

    def add(self, rows: DataFrame) -> DataFrame:
        """Give numbers to the natural keys that have none, then return all. A null is a value like others."""
        keys = rows.select(*[quoted(c) for c in self.natural_key]).distinct()
        known, after = self.known(), 0
        if known is not None:
            same = [keys[c].eqNullSafe(known[c]) for c in self.natural_key]
            keys = keys.join(known, same, "left_anti")
            after = known.agg(F.coalesce(F.max(NUMBER), F.lit(0))).first()[0]
        numbered(keys, after).write.mode("append").parquet(self.path)
        return self.known()

    def keyed(self, rows: DataFrame, name: str) -> DataFrame:
        """``rows`` with their number in the column ``name``; new natural keys are registered first."""
        known = self.add(rows)
        asked = known.select(*[quoted(c).alias(f"_k{i}") for i, c in enumerate(self.natural_key)],
                             F.col(NUMBER).alias("_key_number"))
        same = [quoted(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(self.natural_key)]
        kept = [quoted(c) for c in rows.columns if c != name]
        return rows.join(asked, same).select(*kept, F.col("_key_number").alias(name))
