"""Keys that hold a large share of a table's rows, found by a sketch, and a left join that deals them out."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from predia.operators.cleaning import quoted

# A key with more rows than this is dealt out. One with fewer is work that a single task can do.
SPLIT_ROWS = 1_000_000
# Most keys that are dealt out, and the counters of the sketch in each task. A key is missed only where its rows are
# about 3.5 / COUNTERS of all rows or fewer.
MOST, COUNTERS = 10_000, 200_000

# What the sketch can hold, and where keys are equal just when their values are. Keys of other types are joined as they are.
_COUNTED = (T.IntegralType, T.DecimalType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _type(df: DataFrame, column: str) -> T.DataType:
    return df.select(quoted(column)).schema[0].dataType


def hot_keys(df: DataFrame, key: str, split_rows: int = SPLIT_ROWS) -> list[tuple]:
    """(key, rows at most) of the keys that stand on more than ``split_rows`` rows; null is none.

    One pass over the key column, combined before its only shuffle: a task sends its counters, not its rows. What is
    collected is bounded by ``MOST``. Every key named stands on at least one row, its number may be too large.
    """
    if not isinstance(_type(df, key), _COUNTED):
        return []
    keys = df.select(quoted(key).alias("k")).where("k IS NOT NULL")
    top = keys.agg(F.expr(f"approx_top_k(k, {MOST}, {COUNTERS})").alias("top")).first()["top"]
    return [(item["item"], item["count"]) for item in top if item["count"] > split_rows]


def left_fan_out(df: DataFrame, many: DataFrame, key: str, many_key: str, split_rows: int = SPLIT_ROWS) -> DataFrame:
    """Left join to a side with many rows per key, of which one key may hold a large share.

    Spark can split a hot key of an outer join only on the kept side. The hot keys of ``many`` are therefore dealt out
    here: each of their rows goes to one of several splits by the hash of its columns, and the rows of ``df`` with such
    a key are repeated for every split. A hot key has rows in ``many``, so what a repeated row does not find in one split
    is dropped; keys that are not hot are joined as in any left join. Either side is read once, beside the pass over
    the key column. Rows of ``many`` that are equal in every column of a plain type share a split. Keys of two
    different types, or of one that the sketch cannot hold, are joined as they are.
    """
    kind = _type(many, many_key)
    hot = hot_keys(many, many_key, split_rows) if kind == _type(df, key) else []
    if not hot:
        return df.join(many, quoted(key) == quoted(many_key), "left")
    spark = df.sparkSession
    schema = T.StructType([T.StructField("_hot", kind), T.StructField("_splits", T.IntegerType())])
    # At most MOST rows: this side has a proven bound.
    splits = F.broadcast(spark.createDataFrame([(k, math.ceil(n / split_rows)) for k, n in hot], schema))

    repeated = (df.join(splits, quoted(key) == F.col("_hot"), "left").drop("_hot")
                .withColumn("_split", F.explode(F.sequence(F.lit(0), F.coalesce("_splits", F.lit(1)) - 1))))
    side = many.join(splits.withColumnRenamed("_splits", "_n"), quoted(many_key) == F.col("_hot"), "left").drop("_hot")
    plain = [quoted(f.name) for f in many.schema if isinstance(f.dataType, (*_COUNTED, T.FractionalType, T.BinaryType))]
    dealt = F.when(F.col("_n").isNull(), 0).otherwise(F.pmod(F.xxhash64(*plain), F.col("_n")))
    side = side.withColumn("_place", dealt.cast("int")).drop("_n").withColumn("_there", F.lit(True))
    joined = repeated.join(side, (quoted(key) == quoted(many_key)) & (F.col("_split") == F.col("_place")), "left")
    return (joined.where(F.col("_there").isNotNull() | F.col("_splits").isNull())
            .drop("_splits", "_split", "_place", "_there"))
