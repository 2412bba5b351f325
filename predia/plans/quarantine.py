"""Rows that break a rule of their table go to a table of their own, with the reasons; too many of them end the load."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from predia.operators.changes import OPERATIONS
from predia.operators.cleaning import quoted
from predia.session import scratch_path, sized
from predia.sources import files

REASONS = "_reasons"
RECORD = "_record"


class TooManyBadRowsError(RuntimeError):
    """A delivery of which more rows break a rule than its table allows."""


def broken_rules(rows: DataFrame, rules: Mapping[str, str], op: str = "Op") -> Column:
    """Why a row cannot be taken: a sorted list of reasons, empty for a good row.

    ``rules`` holds ``{column: "type"}`` or ``{column: "type required"}``: a value that is not of the type, or none where one is
    required, is a reason, and so is a column that the delivery lacks. A row with an operation that is not a declared
    one is bad too. A row that deletes needs no more than what is required.
    """
    reasons = []
    for name, rule in rules.items():
        kind, _, required = rule.partition(" ")
        if name not in rows.columns:
            if required:
                reasons.append(F.lit(f"{name}: missing column"))
            continue
        value = quoted(name)
        reasons.append(F.when(value.isNotNull() & value.try_cast(kind).isNull(), F.lit(f"{name}: no {kind}")))
        if required:
            reasons.append(F.when(value.isNull(), F.lit(f"{name}: missing")))
    if op in rows.columns:
        known = quoted(op).isNull() | quoted(op).isin(*OPERATIONS)
        reasons.append(F.when(~known, F.lit(f"{op}: unknown operation")))
    return F.array_sort(F.array_compact(F.array(*reasons))) if reasons else F.array().cast("array<string>")


def without_bad_rows(
    rows: DataFrame, rules: Mapping[str, str], folder: str, batch: str, most: int | None = None, op: str = "Op",
) -> DataFrame:
    """The good rows. The bad ones are written under ``folder``, those of a ``batch`` that is read again in their old place.

    With more than ``most`` bad rows nothing is written and the load ends with an error. The rows are written once, so
    that both sides and the count come from one reading.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "checked")
    with sized(rows):
        rows.withColumn(REASONS, broken_rules(rows, rules, op)).write.parquet(path)
    checked = spark.read.parquet(path)
    bad = checked.where(F.size(REASONS) > 0)
    count = bad.count()
    if most is not None and count > most:
        reasons = bad.select(F.explode(REASONS).alias("r")).groupBy("r").count().orderBy(F.desc("count"), "r").limit(5)
        told = ", ".join(f"{r['r']} ({r['count']})" for r in reasons.collect())
        raise TooManyBadRowsError(f"{count} bad rows, {most} are allowed: {told}")
    target = f"{folder}/batch={batch}"
    if count:
        record = F.to_json(F.struct(*[quoted(c) for c in rows.columns]), {"ignoreNullFields": "false"})
        bad.select(record.alias(RECORD), REASONS).write.mode("overwrite").parquet(target)
    elif files.exists(spark, target):
        files.delete(spark, target)
    return checked.where(F.size(REASONS) == 0).drop(REASONS)


def quarantined(spark, folder: str) -> DataFrame:
    """All bad rows so far: the batch, the row as JSON, its reasons."""
    schema = f"{RECORD} string, {REASONS} array<string>, batch string"
    if not files.exists(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder)
