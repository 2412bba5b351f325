"""Queries that write to the shared folder and read back: readers, sinks, curated tables, incremental and streamed
change application, mapped loads. All of them process their whole input table."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from predia.fixed_values import STAMP
from predia.operators.dense_keys import KeyRegistry
from predia.operators.enrich import union_branches
from predia.operators.latest import one_per_key
from predia.operators.reconcile import reconcile
from predia.plans.curated import bad_rows_folder, curate, curated_table, load_all, load_selected, load_table
from predia.plans.mapped_load import run_configured_load, run_mapped_load
from predia.plans.quarantine import quarantined
from predia.session import MEASURED_BROADCASTS, scratch_path
from predia.sources import files
from predia.sources.bucketed_table import BucketedTable
from predia.sources.config import JobConfig, TableConfig, discover_tables, load_table_config
from predia.sources.incremental import IncrementalReader
from predia.sources.keyed_table import COMMIT, KeyedTable
from predia.sources.readers import read_table
from predia.streaming.change_stream import read_new_files, stream_changes
from predia.streaming.latest_state import stream_latest
from predia.workload.operator_queries import (
    CDC_SQL, EVENT_CHANGES, EVERY_OP_SQL, LATE_SQL, event_base, event_changes,
)
from predia.workload.registry import query
from predia.workload.standins import read

FIRST, SECOND, THIRD = "20240101000000000", "20240102000000000", "20240103000000000"


def feed_files(df: DataFrame, folder: str, prefix: str, fmt: str = "parquet") -> None:
    """Write ``df`` as files whose names start with ``prefix``, as a replication feed names them.

    JSON files hold one document each, with the records of one part of the rows.
    """
    spark = df.sparkSession
    writer = df.write
    if fmt == "json":
        record = F.struct(*df.columns)
        part = F.pmod(F.xxhash64(*df.columns), F.lit(20))
        documents = df.groupBy(part.alias("part")).agg(F.collect_list(record).alias("id"))
        writer = documents.select(F.to_json(F.struct("id")).alias("value")).write.option("maxRecordsPerFile", 1)
    options = {"header": True, "quoteAll": True, "escape": '"'} if fmt == "csv" else {}
    writer.mode("append").format("text" if fmt == "json" else fmt).options(**options).save(f"{folder}.writing")
    fs, target = files.file_system(spark, folder)
    fs.mkdirs(target)
    _, written = files.file_system(spark, f"{folder}.writing")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for status in fs.listStatus(written):
        if status.getPath().getName().startswith("part-"):
            fs.rename(status.getPath(), path(f"{folder}/{prefix}{status.getPath().getName()}"))
    fs.delete(written, True)


# Readers

@query("file_mode_select", """
    SELECT 'cdc' AS mode, event_type, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-16 00:00:00' GROUP BY 2
    UNION ALL SELECT 'fl', event_type, count(*) FROM events WHERE ts < TIMESTAMP '2024-01-16 00:00:00' GROUP BY 2
    UNION ALL SELECT 'all', event_type, count(*) FROM events GROUP BY 2""")
def _(spark, folder):
    events = read(spark, folder, "events")
    path = scratch_path(spark, "file-mode") + "/shop/events"
    middle = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    feed_files(events.where(F.col("ts") < middle), path, "LOAD")
    feed_files(events.where(F.col("ts") >= middle), path, "20240116-")
    counts = [
        read_table(spark, path, "parquet", mode).groupBy("event_type").agg(F.count("*").alias("n"))
        .select(F.lit(mode or "all").alias("mode"), "event_type", "n") for mode in ("cdc", "fl", None)
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("csv_round_trip", """
    SELECT CAST(doc_id AS VARCHAR) AS doc_id, CASE WHEN text = '' THEN NULL ELSE text END AS text, source FROM documents""")
def _(spark, folder):
    path = scratch_path(spark, "csv")
    rows = read(spark, folder, "documents").select("doc_id", "text", "source")
    rows.write.option("header", True).option("quoteAll", True).option("escape", '"').option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{path}/a/b")
    return read_table(spark, path, "csv", multiLine=True)


@query("csv_line_breaks_split", """
    SELECT CAST(doc_id AS VARCHAR) AS doc_id, CASE WHEN text = '' THEN NULL ELSE text END AS text, source FROM documents""")
def _(spark, folder):
    """Texts with line breaks, a file per part of the input, read in many small splits."""
    path = scratch_path(spark, "csv-split")
    rows = read(spark, folder, "documents").select("doc_id", "text", "source")
    rows.write.option("header", True).option("quoteAll", True).option("escape", '"').option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    return read_table(spark, path, "csv")


@query("json_round_trip", "SELECT event_id, user_id, event_type, value FROM events")
def _(spark, folder):
    path = scratch_path(spark, "json")
    # A document of the feed holds the events of one user and minute.
    record = F.struct("event_id", "user_id", "event_type", "value")
    documents = read(spark, folder, "events").groupBy("user_id", F.date_trunc("minute", "ts").alias("minute")).agg(
        F.collect_list(record).alias("id"))
    documents.select(F.to_json(F.struct("id")).alias("value")).write.text(path)
    schema = "id ARRAY<STRUCT<event_id: BIGINT, user_id: BIGINT, event_type: STRING, value: DOUBLE>>"
    return read_table(spark, path, "json", schema=schema, multiLine=False)


@query("discover_and_configure", """
    SELECT 'shop' AS schema_name, 'orders' AS table_name, 'o_orderkey' AS primary_key, count(*) AS n FROM orders
    UNION ALL SELECT 'shop', 'part', 'p_partkey', count(*) FROM part""")
def _(spark, folder):
    root = scratch_path(spark, "discover")
    for table, key in (("orders", "o_orderkey"), ("part", "p_partkey")):
        read(spark, folder, table).write.parquet(f"{root}/raw/shop/{table}")
        files.write_text(spark, f"{root}/mappings/{table}.json", json.dumps({"primary_key": key}))
    counts = []
    for schema, table in discover_tables(spark, f"{root}/raw"):
        config = load_table_config(spark, f"{root}/mappings/{table}.json")
        counts.append(read_table(spark, f"{root}/raw/{schema}/{table}").agg(F.count("*").alias("n")).select(
            F.lit(schema).alias("schema_name"), F.lit(table).alias("table_name"),
            F.lit(config.primary_key).alias("primary_key"), "n"))
    return counts[0].unionByName(counts[1])


# Keyed tables

@query("full_load_overwrite", "SELECT * FROM orders WHERE o_orderstatus <> 'P'")
def _(spark, folder):
    orders = read(spark, folder, "orders")
    table = KeyedTable(spark, scratch_path(spark, "full-load"), "o_orderkey")
    table.write(orders.withColumns({"Op": F.lit("I"), "db": F.lit("shop")}), "fl")
    table.write(orders.where("o_orderstatus <> 'P'").withColumn("Op", F.lit("I")), "fl")
    return table.snapshot()


@query("append_insert", "SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'F'")
def _(spark, folder):
    orders = read(spark, folder, "orders")
    table = KeyedTable(spark, scratch_path(spark, "append"), "o_orderkey")
    table.append(orders)
    table.append(orders.where("o_orderstatus = 'F'"))
    return table.snapshot()


@query("partitioned_write", "SELECT * FROM orders")
def _(spark, folder):
    table = KeyedTable(spark, scratch_path(spark, "partitioned"), "o_orderkey", partition_by="o_orderstatus")
    table.overwrite(read(spark, folder, "orders"))
    return table.snapshot()


@query("catalog_register", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority")
def _(spark, folder):
    table = KeyedTable(spark, scratch_path(spark, "catalog"), "o_orderkey")
    table.overwrite(read(spark, folder, "orders"))
    table.register("predia_registered_orders")
    return spark.table("predia_registered_orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"))


def _stored_events(
    spark: SparkSession, folder: str, purpose: str, every_op: bool = False
) -> tuple[KeyedTable, DataFrame]:
    """A table loaded with the first half of the feed, and the changes of the second half."""
    events = read(spark, folder, "events")
    table = KeyedTable(spark, scratch_path(spark, purpose), "user_id")
    table.overwrite(event_base(events))
    return table, event_changes(events, every_op)


@query("cdc_copy_on_write", CDC_SQL)
def _(spark, folder):
    table, changes = _stored_events(spark, folder, "copy-on-write")
    table.write(changes, "cdc", ["ts", "event_id"])
    return table.snapshot()


@query("cdc_merge_on_read", EVERY_OP_SQL)
def _(spark, folder):
    """Changes in deliveries, one after the other; the last has no end."""
    table, changes = _stored_events(spark, folder, "merge-on-read", every_op=True)
    for first, last in (("2024-01-16", "2024-01-21"), ("2024-01-21", "2024-01-26"), ("2024-01-26", None)):
        days = changes.where(F.col("ts") >= F.lit(first).cast("timestamp_ntz"))
        if last:
            days = days.where(F.col("ts") < F.lit(last).cast("timestamp_ntz"))
        table.write(days, "cdc", ["ts", "event_id"])
    return table.snapshot()


def _bucketed_events(spark, folder, purpose):
    events = read(spark, folder, "events")
    table = BucketedTable(spark, f"predia_{purpose}", scratch_path(spark, purpose), "user_id", buckets=8)
    table.load(event_base(events))
    return table, events


@query("bucketed_merge", CDC_SQL)
def _(spark, folder):
    """Changes merged into a bucketed catalog table, whose stored rows are not shuffled."""
    table, events = _bucketed_events(spark, folder, "bucketed_merge")
    table.merge(event_changes(events), ["ts", "event_id"])
    return table.rows()


@query("bucketed_merge_late", CDC_SQL)
def _(spark, folder):
    """Two merges, the second of changes that the first has already passed: those come too late."""
    table, events = _bucketed_events(spark, folder, "bucketed_merge_late")
    table.merge(event_changes(events), ["ts", "event_id"], guard_late=True)
    deleted = event_changes(events).groupBy("user_id").agg(F.max_by("Op", F.struct("ts", "event_id")).alias("last"))
    kept = table.rows().join(deleted.where("last = 'D'").select("user_id"), "user_id", "left_anti").select("user_id")
    late = event_base(events).withColumns({"Op": F.lit("U"), "value": F.col("value") - 1, "ts": F.col("ts") - F.expr("INTERVAL 1 DAY")})
    table.merge(late.join(kept, "user_id", "left_semi"), ["ts", "event_id"], guard_late=True)
    return table.rows()


@query("upsert_then_delete_stored", """
    SELECT * FROM (SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END
        AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders) WHERE o_orderpriority <> '5-LOW'""")
def _(spark, folder):
    orders = read(spark, folder, "orders")
    table = KeyedTable(spark, scratch_path(spark, "upsert"), "o_orderkey")
    table.upsert(orders)
    table.upsert(orders.where("o_orderstatus = 'P'").withColumn("o_orderstatus", F.lit("F")), ["o_orderdate"])
    table.delete(orders.where("o_orderpriority = '5-LOW'"))
    return table.snapshot()


@query("incremental_since_commit", """
    SELECT 'first' AS pass, o_orderkey, o_orderstatus FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
    UNION ALL SELECT 'second', o_orderkey, o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'""")
def _(spark, folder):
    orders = read(spark, folder, "orders")
    year = F.lit("1998-01-01").cast("timestamp_ntz")
    path = scratch_path(spark, "incremental")
    table = KeyedTable(spark, f"{path}/orders", "o_orderkey")
    reader = IncrementalReader(table, f"{path}/state", "orders")

    def take(name: str) -> None:
        rows = reader.read().select(F.lit(name).alias("pass"), "o_orderkey", "o_orderstatus")
        rows.write.mode("append").parquet(f"{path}/passes")
        reader.acknowledge()

    table.upsert(orders.where(F.col("o_orderdate") < year), commit=FIRST)
    take("first")
    table.upsert(orders.where(F.col("o_orderdate") >= year), commit=SECOND)
    take("second")
    take("third")
    return spark.read.parquet(f"{path}/passes")


@query("incremental_with_deletes", """
    SELECT CASE WHEN o_orderstatus = 'F' THEN 'kept' WHEN o_orderpriority = '5-LOW' THEN 'deleted' ELSE 'changed' END AS news,
        o_orderkey, CASE WHEN o_orderstatus = 'F' OR o_orderpriority = '5-LOW' THEN o_totalprice ELSE o_totalprice + 1 END
        AS o_totalprice FROM orders""")
def _(spark, folder):
    """What a consumer learns in two reads: first all rows, then those that changed or went in two commits."""
    orders = read(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    path = scratch_path(spark, "with-deletes")
    table = KeyedTable(spark, f"{path}/orders", "o_orderkey")
    reader = IncrementalReader(table, f"{path}/state", "orders")
    table.overwrite(orders, FIRST)
    reader.read(deletes=True).write.parquet(f"{path}/first")
    reader.acknowledge()
    later = orders.where("o_orderstatus <> 'F'")
    table.upsert(later.withColumn("o_totalprice", F.col("o_totalprice") + 1), commit=SECOND)
    table.delete(later.where("o_orderpriority = '5-LOW'"), commit=THIRD)
    news = reader.read(deletes=True)
    # The news come from compressed files: whether they are few enough to be broadcast, a shuffle tells.
    for name, value in MEASURED_BROADCASTS.items():
        spark.conf.set(name, value)
    kept = spark.read.parquet(f"{path}/first").join(news.select("o_orderkey"), "o_orderkey", "left_anti")
    # A deleted row is told as it stood last.
    price = F.when(F.col("_deleted"), F.col("o_totalprice") - 1).otherwise(F.col("o_totalprice"))
    return kept.select(F.lit("kept").alias("news"), "o_orderkey", "o_totalprice").unionByName(
        news.select(F.when(F.col("_deleted"), "deleted").otherwise("changed").alias("news"), "o_orderkey",
                    price.alias("o_totalprice")))


@query("commit_times", f"""
    SELECT CASE WHEN o_orderstatus = 'F' THEN '{SECOND}' ELSE '{FIRST}' END AS commit_time, count(*) AS n,
           '{FIRST}' AS first_commit, '{SECOND}' AS last_commit FROM orders GROUP BY 1""")
def _(spark, folder):
    orders = read(spark, folder, "orders")
    table = KeyedTable(spark, scratch_path(spark, "commits"), "o_orderkey")
    table.overwrite(orders, FIRST)
    table.upsert(orders.where("o_orderstatus = 'F'"), commit=SECOND)
    # One pass: the ends are those of the few counts, kept as a list of commits.
    times = table.rows().groupBy(F.col(COMMIT).alias("commit_time")).agg(F.count("*").alias("n"))
    every = times.agg(F.sort_array(F.collect_list(F.struct("commit_time", "n"))).alias("commits"))
    return every.select(F.explode("commits").alias("c"), F.element_at("commits", 1)["commit_time"].alias("first_commit"),
                        F.element_at("commits", -1)["commit_time"].alias("last_commit")).select(
        "c.commit_time", "c.n", "first_commit", "last_commit")


# Curated tables

RAW_SQL = """SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END
    AS o_orderpriority, o_totalprice"""


def _raw_orders(orders: DataFrame, op: str, moment: str, change: float = 0.0) -> DataFrame:
    """Orders as a feed brings them: text not trimmed or empty, time as text, envelope columns."""
    priority = F.expr("CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE '  ' || o_orderpriority || ' ' END")
    return orders.select(
        F.expr(op).alias("Op"), F.lit("shop").alias("db"), "o_orderkey", priority.alias("o_orderpriority"),
        (F.col("o_totalprice") + change).alias("o_totalprice"), F.lit(moment).alias("field_timestamp"))


def _curated_job(spark: SparkSession, folder: str, purpose: str) -> JobConfig:
    root = scratch_path(spark, purpose)
    job = JobConfig(f"{root}/raw", f"{root}/curated", "lake", "market", "curated_", "_tb")
    source = job.source("shop", "pedidos")
    orders = read(spark, folder, "orders")
    feed_files(_raw_orders(orders.where("o_orderstatus <> 'O'"), "'I'", "2024-01-01 00:00:00"), source, "LOAD")
    op = "CASE o_orderpriority WHEN '1-URGENT' THEN 'D' ELSE 'U' END"
    feed_files(_raw_orders(orders.where("o_orderstatus <> 'F'"), op, "2024-01-02 00:00:00", 1.0), source, "20240102-")
    return job


@query("curated_full_load", f"{RAW_SQL}, TIMESTAMP '2024-01-01' AS {STAMP} FROM orders WHERE o_orderstatus <> 'O'")
def _(spark, folder):
    job = _curated_job(spark, folder, "curated-full")
    config = TableConfig("o_orderkey")
    load_table(spark, job, "shop", "pedidos", "fl", config)
    return read_table(spark, job.target("shop", "pedidos"), "keyed")


@query("curated_change_load", f"""
    {RAW_SQL}, TIMESTAMP '2024-01-01' AS {STAMP} FROM orders WHERE o_orderstatus = 'F'
    UNION ALL {RAW_SQL} + 1, TIMESTAMP '2024-01-02' FROM orders
    WHERE o_orderstatus <> 'F' AND o_orderpriority <> '1-URGENT'""")
def _(spark, folder):
    job = _curated_job(spark, folder, "curated-changes")
    config = TableConfig("o_orderkey")
    for mode in ("fl", "cdc"):
        load_table(spark, job, "shop", "pedidos", mode, config)
    return curated_table(spark, job, "shop", "pedidos", config).snapshot()


def _deliveries(
    spark: SparkSession, folder: str, fmt: str, added: bool = False, line_breaks: bool = False,
) -> DataFrame:
    """A full load and two deliveries of changes, each taken by its own run; the second may bring a new column."""
    root = scratch_path(spark, f"deliveries-{fmt}")
    job = JobConfig(f"{root}/raw", f"{root}/curated", "lake", "market", "curated_", "_tb", fmt)
    config, source = TableConfig("o_orderkey"), job.source("shop", "pedidos")
    orders = read(spark, folder, "orders")
    if line_breaks:
        orders = orders.withColumn("o_orderpriority", F.replace("o_orderpriority", F.lit("-"), F.lit('",\n"')))
    feed_files(_raw_orders(orders.where("o_orderstatus <> 'O'"), "'I'", "2024-01-01 00:00:00"), source, "LOAD", fmt)
    load_table(spark, job, "shop", "pedidos", "fl", config)
    op = "CASE WHEN o_orderpriority LIKE '1%' THEN 'D' ELSE 'U' END"
    for day in (2, 3):
        part = orders.where(f"o_orderstatus <> 'F' AND o_orderkey % 2 = {day - 2}")
        rows = _raw_orders(part, op, f"2024-01-0{day} 00:00:00", 1.0)
        if added and day == 3:
            rows = rows.withColumn("added", F.col("o_orderkey") * 2)
        feed_files(rows, source, f"2024010{day}-", fmt)
        load_table(spark, job, "shop", "pedidos", "cdc", config)
    return curated_table(spark, job, "shop", "pedidos", config).snapshot()


DELIVERIES_SQL = f"""
    {RAW_SQL}, TIMESTAMP '2024-01-01' AS {STAMP}, NULL::BIGINT AS added FROM orders WHERE o_orderstatus = 'F'
    UNION ALL {RAW_SQL} + 1, CASE o_orderkey % 2 WHEN 0 THEN TIMESTAMP '2024-01-02' ELSE TIMESTAMP '2024-01-03' END,
        CASE o_orderkey % 2 WHEN 1 THEN o_orderkey * 2 END
    FROM orders WHERE o_orderstatus <> 'F' AND o_orderpriority <> '1-URGENT'"""


@query("curated_change_load_csv", f"SELECT * EXCLUDE (added) FROM ({DELIVERIES_SQL})")
def _(spark, folder):
    """CSV carries text only, so the curated table does too."""
    rows = _deliveries(spark, folder, "csv")
    return rows.select(F.col("o_orderkey").cast("long"), "o_orderpriority", F.col("o_totalprice").cast("double"), STAMP)


@query("curated_change_load_csv_line_breaks", f"""
    SELECT * EXCLUDE (added) REPLACE (replace(coalesce(o_orderpriority, '5-LOW'), '-', '",' || chr(10) || '"') AS o_orderpriority)
    FROM ({DELIVERIES_SQL})""")
def _(spark, folder):
    """Priorities with quotes, commas and line breaks, in the full load and in the changes."""
    rows = _deliveries(spark, folder, "csv", line_breaks=True)
    return rows.select(F.col("o_orderkey").cast("long"), "o_orderpriority", F.col("o_totalprice").cast("double"), STAMP)


@query("curated_change_load_json", f"SELECT * EXCLUDE (added) FROM ({DELIVERIES_SQL})")
def _(spark, folder):
    return _deliveries(spark, folder, "json")


@query("curated_change_load_new_column", DELIVERIES_SQL)
def _(spark, folder):
    return _deliveries(spark, folder, "parquet", added=True)


@query("quarantine_bad_records", f"""
    {RAW_SQL}, TIMESTAMP '2024-01-01' AS {STAMP}, NULL AS reasons FROM orders WHERE o_orderkey % 10 > 2
    UNION ALL SELECT CASE o_orderkey % 10 WHEN 1 THEN NULL ELSE o_orderkey END, NULL, NULL, NULL,
        CASE o_orderkey % 10 WHEN 0 THEN 'o_totalprice: no double' WHEN 1 THEN 'o_orderkey: missing'
        ELSE 'Op: unknown operation,o_totalprice: missing' END FROM orders WHERE o_orderkey % 10 <= 2""")
def _(spark, folder):
    """A full load of text in which three rows of ten are broken by rule, then what was kept and what was put aside."""
    root = scratch_path(spark, "quarantine")
    job = JobConfig(f"{root}/raw", f"{root}/curated", file_format="csv")
    broken = F.col("o_orderkey") % 10
    orders = read(spark, folder, "orders")
    rows = _raw_orders(orders, "CASE o_orderkey % 10 WHEN 2 THEN 'X' ELSE 'I' END", "2024-01-01 00:00:00").withColumns({
        "o_totalprice": F.when(broken == 0, "12,x").when(broken != 2, F.col("o_totalprice").cast("string")),
        "o_orderkey": F.when(broken != 1, F.col("o_orderkey"))})
    feed_files(rows, job.source("shop", "pedidos"), "LOAD", "csv")
    config = TableConfig("o_orderkey", rules={"o_orderkey": "bigint required", "o_totalprice": "double required"})
    load_table(spark, job, "shop", "pedidos", "fl", config)
    kept = curated_table(spark, job, "shop", "pedidos", config).snapshot().select(
        F.col("o_orderkey").cast("long"), "o_orderpriority", F.col("o_totalprice").cast("double"), STAMP,
        F.lit(None).cast("string").alias("reasons"))
    bad = quarantined(spark, bad_rows_folder(job, "shop", "pedidos"))
    return kept.unionByName(bad.select(
        F.get_json_object("_record", "$.o_orderkey").cast("long").alias("o_orderkey"),
        F.array_join("_reasons", ",").alias("reasons")), allowMissingColumns=True)


@query("surrogate_key_dense", """
    WITH first AS (SELECT o_custkey, o_orderpriority, row_number() OVER (ORDER BY o_custkey, o_orderpriority) AS k
                   FROM (SELECT DISTINCT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F')),
    later AS (SELECT o_custkey, o_orderpriority, (SELECT count(*) FROM first)
                     + row_number() OVER (ORDER BY o_custkey, o_orderpriority) AS k
              FROM (SELECT DISTINCT o_custkey, o_orderpriority FROM orders
                    EXCEPT SELECT o_custkey, o_orderpriority FROM first)),
    every AS (SELECT * FROM first UNION ALL SELECT * FROM later)
    SELECT o_orderkey, every.k AS customer_key FROM orders JOIN every USING (o_custkey, o_orderpriority)""")
def _(spark, folder):
    """Two runs: the second has more rows, whose new keys go on after those of the first."""
    orders = read(spark, folder, "orders")
    registry = KeyRegistry(spark, scratch_path(spark, "registry"), ["o_custkey", "o_orderpriority"])
    registry.add(orders.where("o_orderstatus = 'F'"))
    return registry.keyed(orders, "customer_key").select("o_orderkey", "customer_key")


@query("reconcile_full_load", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 500 = 3 THEN 'missing' ELSE 'changed' END AS difference FROM orders
    WHERE o_orderkey % 500 = 3 OR (o_orderkey % 400 = 7 AND o_orderkey < (SELECT max(o_orderkey) / 8 FROM orders))
    UNION ALL SELECT -1 - o_orderkey, 'added' FROM orders WHERE o_orderkey % 700 = 5""")
def _(spark, folder):
    """A stored table against a copy in which rows were changed, left out and added."""
    orders = read(spark, folder, "orders")
    table = KeyedTable(spark, scratch_path(spark, "reconcile"), "o_orderkey")
    table.overwrite(orders)
    top = orders.agg(F.max("o_orderkey")).first()[0]
    changed = (F.col("o_orderkey") % 400 == 7) & (F.col("o_orderkey") < top / 8)
    copy = orders.where("o_orderkey % 500 <> 3").withColumn(
        "o_totalprice", F.when(changed, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))).unionByName(
        orders.where("o_orderkey % 700 = 5").withColumn("o_orderkey", -1 - F.col("o_orderkey")))
    return reconcile(table.snapshot(), copy, "o_orderkey")


@query("load_selected_tables", """
    SELECT 'usuario' AS table_name, count(*) AS n FROM customer UNION ALL SELECT 'proyectos', count(*) FROM part""")
def _(spark, folder):
    """Of the tables that are to be ingested the source has two, and one that is not to be."""
    root = scratch_path(spark, "selected")
    job = JobConfig(f"{root}/raw", f"{root}/curated")
    sources = {"usuario": read(spark, folder, "customer").withColumnRenamed("c_custkey", "id"),
               "proyectos": read(spark, folder, "part").withColumnRenamed("p_partkey", "id_proyecto"),
               "unwanted": read(spark, folder, "nation").withColumnRenamed("n_nationkey", "id")}
    for table, rows in sources.items():
        feed_files(rows.withColumns({"field_timestamp": F.lit("2024-01-01 00:00:00"), "Op": F.lit("I")}),
                   job.source("shop", table), "LOAD")
    loaded, _ = load_selected(spark, job, "fl", "shop", "crm")
    counts = [read_table(spark, job.target(*t), "keyed").agg(F.count("*").alias("n")).select(
        F.lit(t[1]).alias("table_name"), "n") for t in sorted(loaded)]
    return union_branches(*counts)


@query("load_all_configured", """
    SELECT 'clientes' AS table_name, c_custkey AS key, upper(c_name) AS name FROM customer WHERE c_custkey % 3 <> 0
    UNION ALL SELECT 'piezas', p_partkey, CASE p_partkey % 3 WHEN 1 THEN upper(p_name) ELSE p_name END FROM part
    WHERE p_partkey % 3 <> 0""")
def _(spark, folder):
    """Two tables with keys of their own, one also with a partition and an ordering column, loaded and then changed."""
    root = scratch_path(spark, "configured-all")
    job = JobConfig(f"{root}/raw", f"{root}/curated", mappings=f"{root}/mappings")
    customer, part = read(spark, folder, "customer"), read(spark, folder, "part")
    configs = {"clientes": {"primary_key": "c_custkey"},
               "piezas": {"primary_key": "p_partkey", "partition_key": "p_brand", "precomb_key": "changed_at"}}
    for table, config in configs.items():
        files.write_text(spark, f"{root}/mappings/mapping_{table}.json", json.dumps(config))
    moments = {"clientes": "field_timestamp", "piezas": "changed_at"}

    def deliver(table: str, rows: DataFrame, op: str, moment: str, prefix: str) -> None:
        feed = rows.withColumns({"Op": F.expr(op), moments[table]: F.lit(moment)})
        feed_files(feed, job.source("shop", table), prefix)

    for table, rows in (("clientes", customer.select("c_custkey", "c_name")),
                        ("piezas", part.select("p_partkey", "p_name", "p_brand"))):
        key, name = rows.columns[:2]
        deliver(table, rows, "'I'", "2024-01-01 00:00:00", "LOAD")
        changed = rows.withColumn(name, F.upper(name))
        if table == "piezas":  # a key that moves to another partition
            changed = changed.where(f"{key} % 3 <> 2").withColumn("p_brand", F.lit("moved"))
        deliver(table, changed, f"CASE {key} % 3 WHEN 0 THEN 'D' ELSE 'U' END", "2024-01-02 00:00:00", "20240102-")
    load_all(spark, job, "fl")
    load_all(spark, job, "cdc", guard_late=True)
    results = [
        curated_table(spark, job, "shop", table).snapshot().select(
            F.lit(table).alias("table_name"), F.col(config["primary_key"]).alias("key"), F.col(name).alias("name"))
        for (table, config), name in zip(configs.items(), ("c_name", "p_name"))
    ]
    return results[0].unionByName(results[1])


@query("catalog_follows_commits", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'changed' ELSE o_orderpriority END AS o_orderpriority,
        CASE WHEN o_orderstatus = 'P' THEN 1 END AS note FROM orders WHERE o_orderstatus <> 'F'""")
def _(spark, folder):
    """The catalog's table after a second full load, an upsert with a new column, and a delete."""
    orders = read(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    table = KeyedTable(spark, scratch_path(spark, "follow"), "o_orderkey")
    table.overwrite(orders.limit(1))
    table.register("predia_followed_orders")
    table.overwrite(orders)
    changed = orders.where("o_orderstatus = 'P'").withColumns({"o_orderpriority": F.lit("changed"), "note": F.lit(1)})
    table.upsert(changed)
    table.delete(orders.where("o_orderstatus = 'F'"))
    return spark.table("predia_followed_orders").select("o_orderkey", "o_orderpriority", "note")


@query("load_all_tables", """
    SELECT 'usuario' AS table_name, count(*) AS n, max(id) AS top FROM (SELECT c_custkey AS id FROM customer)
    UNION ALL SELECT 'proyectos', count(*), max(p_partkey) FROM part""")
def _(spark, folder):
    root = scratch_path(spark, "load-all")
    job = JobConfig(f"{root}/raw", f"{root}/curated")
    sources = {"usuario": read(spark, folder, "customer").withColumnRenamed("c_custkey", "id"),
               "proyectos": read(spark, folder, "part").withColumnRenamed("p_partkey", "id_proyecto")}
    for table, rows in sources.items():
        feed = rows.withColumns({"field_timestamp": F.lit("2024-01-01 00:00:00"), "Op": F.lit("I")})
        feed_files(feed, job.source("shop", table), "LOAD")
    load_all(spark, job, "fl")
    keys = {"usuario": "id", "proyectos": "id_proyecto"}
    counts = [
        read_table(spark, job.target("shop", table), "keyed").agg(F.count("*").alias("n"), F.max(key).alias("top"))
        .select(F.lit(table).alias("table_name"), "n", "top") for table, key in keys.items()
    ]
    return counts[0].unionByName(counts[1])


# Streams

@query("stream_cdc_equals_batch", EVERY_OP_SQL)
def _(spark, folder):
    """The feed in two deliveries: each run of the query sees only the files it has not read."""
    table, changes = _stored_events(spark, folder, "stream", every_op=True)
    landing, checkpoint = f"{table.path}-landing", f"{table.path}-checkpoint"
    feed = changes.withColumn("field_timestamp", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    middle = F.lit("2024-01-24").cast("timestamp_ntz")
    for prefix, rows in (("20240116-", feed.where(F.col("ts") < middle)), ("20240124-", feed.where(F.col("ts") >= middle))):
        feed_files(rows, landing, prefix)
        arriving = read_new_files(spark, landing, feed.schema)
        stream_changes(arriving, table, ["ts", "event_id"], checkpoint,
                       prepare=lambda batch: curate(batch).drop(STAMP)).awaitTermination()
    return table.snapshot()


@query("stream_state_latest", LATE_SQL)
def _(spark, folder):
    """The full load, then the newer changes, then the older ones, each in a run of its own."""
    events = read(spark, folder, "events")
    root = scratch_path(spark, "state")
    table, landing = KeyedTable(spark, f"{root}/table", "user_id"), f"{root}/landing"
    stored = one_per_key(events.where("event_type <> 'error'"), ["user_id"], ["ts", "event_id"])
    changes = events.where("event_type IN ('view', 'error')").withColumn("Op", F.expr(EVENT_CHANGES))
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    deliveries = [stored.withColumn("Op", F.lit("I")), changes.where(F.col("ts") >= middle),
                  changes.where(F.col("ts") < middle)]
    for number, rows in enumerate(deliveries):
        feed_files(rows.select(changes.columns), landing, f"2024-{number}-")
        arriving = read_new_files(spark, landing, changes.schema)
        stream_latest(arriving, table, ["ts", "event_id"], f"{root}/checkpoint").awaitTermination()
    return table.snapshot()


# Mapped loads

SUPPLIER_MAPPING = {
    "key": {"old": {"name": "s_suppkey", "type": "bigint"}, "new": {"name": "id", "type": "string"}},
    "name": {"old": {"name": "s_name", "type": "string"}, "new": {"name": "name", "type": "string"}},
    "place": {"old": {"name": "s_nationkey", "type": "int"}, "new": {"name": "place", "type": "bigint"}},
}


@query("mapped_load_with_hook", """
    SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, CAST(s_nationkey AS BIGINT) AS place, s_name || '!' AS shout
    FROM supplier""")
def _(spark, folder):
    table = run_mapped_load(
        spark, f"{folder}/supplier.parquet", scratch_path(spark, "mapped"), "parquet", "id", SUPPLIER_MAPPING,
        step=lambda df: df.withColumn("shout", F.concat("name", F.lit("!"))))
    return table.snapshot()


@query("mapped_load_with_config_file", """
    SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, CAST(s_nationkey AS BIGINT) AS place FROM supplier""")
def _(spark, folder):
    path = scratch_path(spark, "configured")
    config = {"primary_key": "key", "columnas": SUPPLIER_MAPPING}
    files.write_text(spark, f"{path}/config.json", json.dumps(config))
    table = run_configured_load(spark, f"{folder}/supplier.parquet", f"{path}/table", "parquet", f"{path}/config.json",
                                create_key=True, natural_key=["id"])
    return table.snapshot().drop("key")
