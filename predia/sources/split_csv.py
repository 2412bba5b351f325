"""CSV with line breaks inside quotes, read in splits.

Whether a line starts inside quotes is the parity of the quotes before it, a prefix sum: quotes are counted per split,
the sums are carried over the splits of a file in order, and within a split they run from line to line. Lines that
belong together are joined, so a file of any size is as many tasks as it has splits. Files in which no line ends inside
quotes, which one pass over the text tells, go to Spark's own reader, which splits them too.

Quotes must be used as the format says: in quoted values only, escaped there by the quote itself or by another character.
"""

from __future__ import annotations

import contextlib
import csv
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from predia.operators.enrich import union_branches
from predia.session import scratch_path, sized

# Options that both the parser of single records and the reading in splits know.
RECORD_OPTIONS = {
    "sep", "delimiter", "quote", "escape", "header", "nullValue", "emptyValue", "ignoreLeadingWhiteSpace",
    "ignoreTrailingWhiteSpace", "mode", "columnNameOfCorruptRecord", "dateFormat", "timestampFormat",
    "timestampNTZFormat", "locale", "maxCharsPerColumn", "maxColumns", "unescapedQuoteHandling", "multiLine",
}
MOST_HEADERS = 100


class BrokenFileError(ValueError):
    """Files whose quotes do not close."""


def can_split(options: dict) -> bool:
    """Whether the options leave the lines to this reader; others go to Spark's reader, a task a file."""
    header = str(options.get("header", "true")).lower() == "true"
    return header and RECORD_OPTIONS.issuperset(options) and len(options.get("quote", '"')) == 1


@contextlib.contextmanager
def same_splits(spark: SparkSession):
    """Files are cut alike by every scan, whatever the number of executors meanwhile."""
    name = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(name, None)
    spark.conf.set(name, before or spark.sparkContext.defaultParallelism)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _quotes(line: Column, options: dict) -> Column:
    quote, escape = options.get("quote", '"'), options.get("escape", "\\")
    if escape and escape != quote:
        line = F.regexp_replace(line, f"(?s){re.escape(escape)}.", "")
    return F.char_length(line) - F.char_length(F.replace(line, F.lit(quote), F.lit("")))


def numbered_lines(text: DataFrame, options: dict) -> DataFrame:
    """file, block, at, line, odd: every line, where its split starts, its place in it, and whether it turns the parity."""
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"),
        (_quotes(F.col("value"), options) % 2).cast("long").alias("odd"))


def counted_blocks(lines: DataFrame) -> DataFrame:
    """file, block, odds, header: of every split its turns of parity, of a file's first split also the first line.

    Only lines of first splits are compared, so that the aggregation does not sort the text.
    """
    first = F.when(F.col("block") == 0, F.col("line"))
    return lines.groupBy("file", "block").agg(F.sum("odd").alias("odds"), F.min_by(first, "at").alias("header"))


def joined_records(lines: DataFrame, blocks: DataFrame) -> DataFrame:
    """file, place, record: the records of all files, each with the place of its first line.

    A record of one line is that line. Of the others, the lines carry the number of openings before them.
    """
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select("file", "block", F.coalesce(F.sum("odds").over(earlier), F.lit(0)).alias("carried"))
    above = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    marked = (lines.withColumn("inside", F.coalesce(F.sum("odd").over(above), F.lit(0)))
              .join(carried, ["file", "block"]).withColumn("before", F.col("inside") + F.col("carried"))
              .withColumn("place", F.struct("block", "at")))
    alone = (F.col("odd") == 0) & (F.col("before") % 2 == 0)
    single = marked.where(alone & (F.trim("line") != "")).select("file", "place", F.col("line").alias("record"))
    parts = F.array_sort(F.collect_list(F.struct("place", "line")))
    joined = (marked.where(~alone).groupBy("file", F.floor(F.col("before") / 2).alias("number"))
              .agg(parts.alias("parts"))
              .select("file", F.col("parts")[0]["place"].alias("place"),
                      F.array_join(F.transform("parts", lambda p: p["line"]), "\n").alias("record")))
    return single.unionAll(joined).withColumn("record", F.regexp_replace("record", "\r$", ""))


def parsed(records: DataFrame, options: dict, schema: T.StructType | str | None = None) -> DataFrame:
    """The columns of the records. Each file's first record names its columns; a column that a file lacks is null there.

    With ``schema`` the columns are read by position, whatever the files call them.
    """
    spark = records.sparkSession
    # A header starts in the first split of its file.
    first = records.where(F.col("place.block") == 0).groupBy("file").agg(F.min_by("record", "place").alias("header"), F.min("place").alias("first"))
    rows = records.join(first, "file").where(F.col("place") != F.col("first"))
    settings = {k: str(v) for k, v in options.items() if k not in ("header", "multiLine")}

    def columns(of: DataFrame, ddl: T.StructType) -> DataFrame:
        return of.select(F.from_csv("record", _ddl(ddl), settings).alias("row")).select("row.*")

    if schema is not None:
        return columns(rows, T.StructType.fromDDL(schema) if isinstance(schema, str) else schema)
    headers = [r["header"] for r in first.select("header").distinct().limit(MOST_HEADERS + 1).collect()]
    if len(headers) > MOST_HEADERS:
        raise BrokenFileError(f"more than {MOST_HEADERS} different header lines: the files have none, or are no one table")
    if not headers:
        return spark.createDataFrame([], T.StructType())
    branches = []
    for header in sorted(headers):
        names = next(csv.reader([header], delimiter=options.get("sep", options.get("delimiter", ",")),
                                quotechar=options.get("quote", '"')))
        fields = T.StructType([T.StructField(name, T.StringType()) for name in names])
        branches.append(columns(rows.where(F.col("header") == header), fields))
    return union_branches(*branches)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)


def read_split_csv(
    spark: SparkSession, reader, path: str | list[str], options: dict, schema: T.StructType | str | None = None,
) -> DataFrame:
    """All files under ``path``; ``reader`` makes a batch reader of the files that count."""
    with same_splits(spark):
        lines = numbered_lines(reader().option("lineSep", "\n").text(path), options)
        # One row per split, kept: the text is read once to count and once to join.
        counted = scratch_path(spark, "csv-blocks")
        with sized(lines):
            counted_blocks(lines).write.parquet(counted)
        blocks = spark.read.parquet(counted)
        per_file = blocks.groupBy("file").agg(F.sum("odds").alias("odds"), F.max("header").alias("header"))
        seen = per_file.agg(
            F.sum("odds").alias("odds"), F.count_if(F.col("odds") % 2 == 1).alias("open"),
            F.min(F.when(F.col("odds") % 2 == 1, F.col("file"))).alias("example"),
            F.min("header").alias("least"), F.max("header").alias("greatest")).first()
        if seen["open"]:
            raise BrokenFileError(f"{seen['open']} files have a quote that does not close, {seen['example']} for one")
        if not seen["odds"] and (schema is not None or seen["least"] == seen["greatest"]):
            plain = reader().format("csv").options(**{**options, "header": True, "multiLine": False})
            return (plain if schema is None else plain.schema(schema)).load(path)
        target = scratch_path(spark, "csv-records")
        with sized(lines):
            joined_records(lines, blocks).write.parquet(target)
    return parsed(spark.read.parquet(target), options, schema)
