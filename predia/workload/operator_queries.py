"""Queries of single operators on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from predia.fixed_values import DOCUMENT_TYPES, LOCAL_ZONE, STAMP
from predia.functions import (
    chosen_by_class, clock_text, days_since, decode, first_positive, fold_accents, grouped_code, is_known_flag,
    one_of_flag, or_constant, pad_city_code, parse_time, part_of, presence_flag, price_per_unit, slug, state_code,
    to_int, yes_no,
)
from predia.operators.changes import apply_changes, hard_delete, stamp, strip_envelope, upsert
from predia.operators.cleaning import clean_strings, fill_zero, require
from predia.operators.enrich import lookup, observe_count, pivot_attributes, select_constants, union_branches
from predia.operators.hot_keys import left_fan_out
from predia.operators.json_flatten import explode_keys, flatten_json
from predia.operators.latest import newest_rows, one_per_key
from predia.operators.schema import (
    add_surrogate_key, apply_mapping, complete_columns, conform, dates_as_text, rename_by_text,
)
from predia.plans.marts import shape_dataset
from predia.session import scratch_path
from predia.sources.readers import query_view
from predia.workload.registry import query
from predia.workload.standins import read

# Latest rows per key

EVENT_CHANGES = "CASE event_type WHEN 'error' THEN 'D' WHEN 'signup' THEN NULL ELSE 'U' END"
MIDDLE = "2024-01-16 00:00:00"


def event_base(events: DataFrame) -> DataFrame:
    """The current event per user from the first half of the feed."""
    return one_per_key(events.where(F.col("ts") < F.lit(MIDDLE).cast("timestamp_ntz")), ["user_id"], ["ts", "event_id"])


def event_changes(events: DataFrame, every_op: bool = False) -> DataFrame:
    """The second half of the feed: errors delete, other events write, and sign-ups carry no operation unless
    ``every_op``."""
    later = events.where(F.col("ts") >= F.lit(MIDDLE).cast("timestamp_ntz"))
    op = F.expr(EVENT_CHANGES)
    return later.withColumn("Op", F.coalesce(op, F.lit("I")) if every_op else op)


BASE_SQL = f"""
    base AS (SELECT * FROM events WHERE ts < TIMESTAMP '{MIDDLE}'
             QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
    newest AS (SELECT *, {EVENT_CHANGES} AS op FROM events WHERE ts >= TIMESTAMP '{MIDDLE}'
               QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
    settled AS (SELECT * FROM newest WHERE op IS NOT NULL)"""
EVERY_OP_SQL = f"""WITH {BASE_SQL.replace("WHEN 'signup' THEN NULL", "WHEN 'signup' THEN 'I'")}
    SELECT * FROM base WHERE user_id NOT IN (SELECT user_id FROM settled)
    UNION ALL SELECT event_id, ts, user_id, event_type, value, props FROM settled WHERE op <> 'D'"""
CDC_SQL = f"""WITH {BASE_SQL}
    SELECT * FROM base WHERE user_id NOT IN (SELECT user_id FROM settled)
    UNION ALL SELECT event_id, ts, user_id, event_type, value, props FROM settled WHERE op <> 'D'"""


@query("latest_per_key", "SELECT * FROM events QUALIFY dense_rank() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1")
def _(spark, folder):
    return newest_rows(read(spark, folder, "events"), ["user_id"], ["ts"])


@query("latest_per_key_ties", """
    SELECT * FROM lineitem
    QUALIFY dense_rank() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC NULLS LAST) = 1""")
def _(spark, folder):
    return newest_rows(read(spark, folder, "lineitem"), ["l_orderkey"], ["l_shipdate"])


@query("latest_per_key_two_orders", """
    SELECT l_suppkey, l_shipdate, l_linenumber, l_orderkey, l_quantity FROM lineitem
    QUALIFY dense_rank() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC, l_linenumber DESC) = 1""")
def _(spark, folder):
    rows = newest_rows(read(spark, folder, "lineitem"), ["l_suppkey"], ["l_shipdate", "l_linenumber"])
    return rows.select("l_suppkey", "l_shipdate", "l_linenumber", "l_orderkey", "l_quantity")


@query("precombine_one_per_key", """
    SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC,
        l_partkey DESC, l_suppkey DESC, l_linenumber DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC,
        l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1""")
def _(spark, folder):
    return one_per_key(read(spark, folder, "lineitem"), ["l_orderkey"], ["l_shipdate"])


# Change application

@query("cdc_apply", CDC_SQL)
def _(spark, folder):
    events = read(spark, folder, "events")
    return apply_changes(event_base(events), event_changes(events), ["user_id"], ["ts", "event_id"])


@query("cdc_apply_null_op_as_upsert", f"""
    WITH {BASE_SQL.replace("WHERE op IS NOT NULL", "WHERE true")}
    SELECT * FROM base WHERE user_id NOT IN (SELECT user_id FROM settled)
    UNION ALL SELECT event_id, ts, user_id, event_type, value, props FROM settled WHERE op IS NULL OR op <> 'D'""")
def _(spark, folder):
    events = read(spark, folder, "events")
    return apply_changes(event_base(events), event_changes(events), ["user_id"], ["ts", "event_id"],
                         null_op_is_upsert=True)


LATE_SQL = """
    WITH later AS (SELECT * FROM events WHERE event_type <> 'error'
                   QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
    views AS (SELECT * FROM events WHERE event_type IN ('view', 'error')
              QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
    fresh AS (SELECT v.* FROM views v LEFT JOIN later l ON v.user_id = l.user_id
              WHERE l.user_id IS NULL OR (v.ts, v.event_id) >= (l.ts, l.event_id))
    SELECT * FROM later WHERE user_id NOT IN (SELECT user_id FROM fresh)
    UNION ALL SELECT * FROM fresh WHERE event_type <> 'error'"""


@query("cdc_late_changes", LATE_SQL)
def _(spark, folder):
    events = read(spark, folder, "events")
    order = ["ts", "event_id"]
    stored = one_per_key(events.where("event_type <> 'error'"), ["user_id"], order)
    changes = events.where("event_type IN ('view', 'error')").withColumn("Op", F.expr(EVENT_CHANGES))
    return apply_changes(stored, changes, ["user_id"], order, guard_late=True)


@query("upsert_by_key", """
    WITH src AS (
        SELECT o_orderkey, o_custkey, 'F' AS o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate,
               o_orderpriority FROM orders WHERE o_orderstatus = 'P'
        UNION ALL SELECT -1 - o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
        FROM orders WHERE o_orderpriority = '1-URGENT')
    SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM src) UNION ALL SELECT * FROM src""")
def _(spark, folder):
    orders = read(spark, folder, "orders")
    closed = orders.where("o_orderstatus = 'P'").withColumns(
        {"o_orderstatus": F.lit("F"), "o_totalprice": F.col("o_totalprice") + 1})
    new = orders.where("o_orderpriority = '1-URGENT'").withColumn("o_orderkey", -1 - F.col("o_orderkey"))
    return upsert(orders, union_branches(closed, new), ["o_orderkey"], ["o_orderdate"])


@query("hard_delete", """
    SELECT * FROM orders WHERE NOT EXISTS (
        SELECT 1 FROM events WHERE event_type IN ('error', 'signup') AND event_id = o_orderkey)""")
def _(spark, folder):
    removed = read(spark, folder, "events").where("event_type IN ('error', 'signup')")
    return hard_delete(read(spark, folder, "orders"), removed.withColumnRenamed("event_id", "o_orderkey"),
                       ["o_orderkey"])


@query("filter_operations", """
    SELECT op AS operation, event_id, user_id FROM (SELECT *, CASE event_type WHEN 'error' THEN 'D'
    WHEN 'signup' THEN NULL ELSE 'U' END AS op FROM events) WHERE op <> 'D' OR op = 'D'""")
def _(spark, folder):
    events = read(spark, folder, "events").withColumn("Op", F.expr(EVENT_CHANGES))
    kept = union_branches(events.where("Op <> 'D'"), events.where("Op = 'D'"))
    return kept.select(F.col("Op").alias("operation"), "event_id", "user_id")


@query("envelope_and_stamp", f"""
    SELECT o_orderkey, o_totalprice, o_orderdate AS {STAMP}, o_orderdate AS updated FROM orders""")
def _(spark, folder):
    feed = read(spark, folder, "orders").select(
        "o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("field_timestamp"),
        F.col("o_orderdate").cast("string").alias("updated"), F.lit("I").alias("Op"), F.lit("shop").alias("db"),
        F.lit("orders").alias("table_name"))
    return strip_envelope(stamp(stamp(feed, "field_timestamp"), "updated", in_place=True))


# Cleaning

@query("blank_to_null_trim", """
    SELECT doc_id, trim(nullif(text, '')) AS text, CASE lang WHEN 'fr' THEN NULL WHEN 'de' THEN '' ELSE lang END AS lang,
           n_chars FROM documents""")
def _(spark, folder):
    lang = F.expr("CASE lang WHEN 'fr' THEN '' WHEN 'de' THEN '   ' ELSE '  ' || lang || ' ' END")
    return clean_strings(read(spark, folder, "documents").select("doc_id", "text", lang.alias("lang"), "n_chars"))


@query("blank_to_null_strict", """
    SELECT p_partkey, nullif(trim(p_name), '') AS p_name,
           CASE WHEN p_type IN ('PROMO', 'LARGE') THEN NULL ELSE p_type END AS p_type FROM part""")
def _(spark, folder):
    kind = F.expr("CASE p_type WHEN 'PROMO' THEN '' WHEN 'LARGE' THEN '   ' ELSE p_type || '  ' END")
    return clean_strings(read(spark, folder, "part").select("p_partkey", "p_name", kind.alias("p_type")), True)


@query("fill_zero", """
    SELECT l_orderkey, l_linenumber, l_partkey, coalesce(nullif(l_discount, 0.05), 0) AS l_discount,
           CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_suppkey END AS l_suppkey, nullif(l_tax, 0.02) AS l_tax
    FROM lineitem""")
def _(spark, folder):
    rows = read(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.expr("nullif(l_discount, 0.05D)").alias("l_discount"),
        F.expr("CASE WHEN l_returnflag <> 'R' THEN l_suppkey END").alias("l_suppkey"),
        F.expr("nullif(l_tax, 0.02D)").alias("l_tax"))
    return fill_zero(rows, ["l_discount", "l_suppkey"])


@query("require_columns", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_discount, l_tax FROM lineitem
    WHERE l_discount <> 0.05 AND l_returnflag <> 'R'""")
def _(spark, folder):
    rows = read(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.expr("nullif(l_discount, 0.05D)").alias("l_discount"), "l_tax",
        F.expr("nullif(l_returnflag, 'R')").alias("flag"))
    return require(rows, ["l_discount", "flag"]).drop("flag")


@query("null_state_before_projection", """
    SELECT c_custkey, c_name FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""")
def _(spark, folder):
    customers = read(spark, folder, "customer").withColumn(
        "estado", F.expr("CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN c_mktsegment END"))
    return customers.where(F.isnull("estado")).select("c_custkey", "c_name")


# Codes and flags

@query("decode_status", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Activo' WHEN 'O' THEN 'Inactivo' ELSE 'Eliminado' END
           AS status FROM orders""")
def _(spark, folder):
    label = decode(F.col("o_orderstatus"), {"F": "Activo", "O": "Inactivo"}, "Eliminado")
    return read(spark, folder, "orders").select("o_orderkey", label.alias("status"))


SPELLINGS = """CASE user_id % 12 WHEN 0 THEN '1-cc' WHEN 1 THEN 'Nit' WHEN 2 THEN 'cédula de extranjerí'
    WHEN 3 THEN 'pasaporte' WHEN 4 THEN '4-TI' WHEN 5 THEN 'te' WHEN 6 THEN 'otro' WHEN 7 THEN 'pep' WHEN 8 THEN '01'
    WHEN 9 THEN 'Side' WHEN 10 THEN 'RC' END"""


@query("normalise_codes", f"""
    SELECT event_id, CASE
        WHEN s IN ('1-CC', '01') THEN 'CC' WHEN s = 'CÉDULA DE EXTRANJERÍ' THEN 'CE' WHEN s = 'PASAPORTE' THEN 'PA'
        WHEN s = '4-TI' THEN 'TI' ELSE s END AS document_type
    FROM (SELECT event_id, upper({SPELLINGS}) AS s FROM events)""")
def _(spark, folder):
    events = read(spark, folder, "events")
    return events.select("event_id", grouped_code(F.upper(F.expr(SPELLINGS)), DOCUMENT_TYPES).alias("document_type"))


@query("flag_si_no", """
    SELECT doc_id, CASE WHEN quality = 1 THEN 'Si' ELSE 'No' END AS quality,
           CASE WHEN toxic = 1 THEN 'Si' ELSE 'No' END AS toxic, CASE WHEN quality = 1 THEN 'Si' ELSE 'No' END AS text_flag,
           CASE WHEN quality + toxic IN (1, 2) THEN 'Si' ELSE 'No' END AS in_list,
           CASE WHEN toxic = 1 THEN 'Si' ELSE 'No' END AS known,
           CASE WHEN quality = 1 OR toxic = 1 THEN 'Si' ELSE 'No' END AS present FROM labels""")
def _(spark, folder):
    quality, toxic = F.col("quality"), F.col("toxic")
    return read(spark, folder, "labels").select(
        "doc_id", yes_no(quality).alias("quality"), one_of_flag(toxic, ["1"]).alias("toxic"),
        yes_no(F.expr("CASE quality WHEN 1 THEN 'true' WHEN 0 THEN 'false' END")).alias("text_flag"),
        one_of_flag(quality + toxic, ["1", "2"]).alias("in_list"),
        is_known_flag(F.expr("CASE toxic WHEN 1 THEN 'gas' ELSE '0' END")).alias("known"),
        presence_flag(F.nullif(quality, F.lit(0)), F.nullif(toxic, F.lit(0))).alias("present"))


@query("first_positive_area", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_quantity - 20 > 0 THEN l_quantity - 20
           WHEN l_linenumber - 4 > 0 THEN CAST(l_linenumber - 4 AS DOUBLE) WHEN l_tax > 0 THEN l_tax
           ELSE l_quantity - 20 END AS area, abs(l_quantity - 20) AS distance FROM lineitem""")
def _(spark, folder):
    built = F.col("l_quantity") - 20
    area = first_positive(built, (F.col("l_linenumber") - 4).cast("double"), F.col("l_tax"))
    return read(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", area.alias("area"), F.abs(built).alias("distance"))


@query("choose_by_class", """
    SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_name
           WHEN c_mktsegment <> 'AUTOMOBILE' THEN 'NIT ' || CAST(c_nationkey AS VARCHAR) END AS shown FROM customer""")
def _(spark, folder):
    kind = F.nullif(F.col("c_mktsegment"), F.lit("AUTOMOBILE"))
    shown = chosen_by_class(kind, "BUILDING", F.col("c_name"), F.concat(F.lit("NIT "), F.col("c_nationkey").cast("string")))
    return read(spark, folder, "customer").select("c_custkey", shown.alias("shown"))


# Joins

@query("lookup_enrich", """
    SELECT c_custkey, c_nationkey, n_name AS city, n_regionkey AS state_key, r_name AS state FROM customer
    LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey AND r_name <> 'ASIA'""")
def _(spark, folder):
    regions = read(spark, folder, "region").where("r_name <> 'ASIA'")
    rows = lookup(read(spark, folder, "customer"), read(spark, folder, "nation"), "c_nationkey", "n_nationkey",
                  {"city": "n_name", "state_key": "n_regionkey"})
    rows = lookup(rows, regions, "state_key", "r_regionkey", {"state": "r_name"})
    return rows.select("c_custkey", "c_nationkey", "city", "state_key", "state")


@query("lookup_same_names", """
    SELECT a.n_nationkey, a.n_name, b.n_name AS other FROM nation a LEFT JOIN nation b ON a.n_regionkey = b.n_nationkey""")
def _(spark, folder):
    nations = read(spark, folder, "nation")
    return lookup(nations, nations, "n_regionkey", "n_nationkey", {"other": "n_name"}).drop("n_regionkey")


@query("owner_required", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, s_name AS owner FROM lineitem
    JOIN supplier ON l_suppkey = s_suppkey AND s_acctbal > 0""")
def _(spark, folder):
    owners = read(spark, folder, "supplier").where("s_acctbal > 0")
    rows = read(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return lookup(rows, owners, "l_suppkey", "s_suppkey", {"owner": "s_name"}, "inner")


@query("left_then_required", """
    SELECT o_orderkey, c_name AS customer, n_name AS nation FROM orders
    JOIN customer ON o_custkey = c_custkey AND c_acctbal > 1000 JOIN nation ON c_nationkey = n_nationkey""")
def _(spark, folder):
    customers = read(spark, folder, "customer").where("c_acctbal > 1000")
    rows = lookup(read(spark, folder, "orders"), customers, "o_custkey", "c_custkey",
                  {"customer": "c_name", "place": "c_nationkey"})
    rows = lookup(rows, read(spark, folder, "nation"), "place", "n_nationkey", {"nation": "n_name"})
    return require(rows, ["customer", "nation"]).select("o_orderkey", "customer", "nation")


@query("fan_out_classes", """
    SELECT o_orderkey, l_linenumber, l_partkey, l_suppkey,
           CAST(o_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS publication FROM orders
    JOIN lineitem ON o_orderkey = l_orderkey""")
def _(spark, folder):
    lines = read(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.concat_ws("-", F.lit("class"), F.col("l_linenumber").cast("string")).alias("code"))
    rows = lookup(lines, read(spark, folder, "orders"), "l_orderkey", "o_orderkey", {"o_orderkey": "o_orderkey"}, "inner")
    publication = F.concat_ws("-", F.col("o_orderkey").cast("string"), part_of(F.col("code"), 1))
    return rows.select("o_orderkey", "l_linenumber", "l_partkey", "l_suppkey", publication.alias("publication"))


@query("left_fan_out", """
    SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer LEFT JOIN orders ON c_custkey = o_custkey
    AND o_orderstatus = 'F'""")
def _(spark, folder):
    orders = read(spark, folder, "orders").where("o_orderstatus = 'F'").select("o_custkey", "o_orderkey", "o_totalprice")
    customers = read(spark, folder, "customer").select("c_custkey", "c_name")
    return left_fan_out(customers, orders, "c_custkey", "o_custkey").drop("o_custkey")


@query("fan_out_hot_keys", """
    SELECT l_linestatus, n_lines, o_orderkey, o_totalprice
    FROM (SELECT l_linestatus, count(*) AS n_lines FROM lineitem GROUP BY ALL
          UNION ALL SELECT o_orderpriority, count(*) FROM orders GROUP BY ALL)
    LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') ON l_linestatus = o_orderstatus""")
def _(spark, folder):
    """Two keys hold all rows of the other side, and some keys hold none; hot is what fills a hundredth of it."""
    orders = read(spark, folder, "orders")
    groups = union_branches(
        read(spark, folder, "lineitem").groupBy("l_linestatus").agg(F.count("*").alias("n_lines")),
        orders.groupBy(F.col("o_orderpriority").alias("l_linestatus")).agg(F.count("*").alias("n_lines")))
    placed = orders.where("o_orderstatus <> 'P'").select("o_orderstatus", "o_orderkey", "o_totalprice")
    rows = left_fan_out(groups, placed, "l_linestatus", "o_orderstatus", split_rows=max(1, orders.count() // 100))
    return rows.drop("o_orderstatus")


@query("chained_left", """
    SELECT event_id, c_name AS client, n_name AS place, r_name AS area FROM events
    LEFT JOIN customer ON user_id * 20 = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey""")
def _(spark, folder):
    rows = read(spark, folder, "events").withColumn("client_key", F.col("user_id") * 20)
    rows = lookup(rows, read(spark, folder, "customer"), "client_key", "c_custkey", {"client": "c_name", "n": "c_nationkey"})
    rows = lookup(rows, read(spark, folder, "nation"), "n", "n_nationkey", {"place": "n_name", "r": "n_regionkey"})
    rows = lookup(rows, read(spark, folder, "region"), "r", "r_regionkey", {"area": "r_name"})
    return rows.select("event_id", "client", "place", "area")


@query("offer_enrich", """
    SELECT o_orderkey, r_name AS reason, c_name AS listing FROM orders
    LEFT JOIN region ON CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 END = r_regionkey
    JOIN customer ON o_custkey = c_custkey AND c_mktsegment = 'BUILDING'""")
def _(spark, folder):
    code = F.when(F.col("o_orderpriority") == "1-URGENT", 0).when(F.col("o_orderpriority") == "2-HIGH", 1)
    rows = read(spark, folder, "orders").withColumn("reason_key", code)
    rows = lookup(rows, read(spark, folder, "region"), "reason_key", "r_regionkey", {"reason": "r_name"})
    listed = read(spark, folder, "customer").where("c_mktsegment = 'BUILDING'")
    return lookup(rows, listed, "o_custkey", "c_custkey", {"listing": "c_name"}, "inner").select(
        "o_orderkey", "reason", "listing")


# Aggregations and set operations

KINDS = ("click", "purchase", "signup", "view")


@query("eav_pivot", "SELECT user_id, " + ", ".join(
    f"arg_min(value, event_id) FILTER (event_type = '{k}') AS {k}" for k in KINDS) + " FROM events GROUP BY user_id")
def _(spark, folder):
    events = read(spark, folder, "events")
    kinds = events.select("event_type").distinct().withColumn("alias", F.col("event_type"))
    return pivot_attributes(events, kinds, KINDS, "user_id", "event_type", "value", "alias", "event_id")


@query("distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber, l_suppkey FROM lineitem")
def _(spark, folder):
    return read(spark, folder, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber", "l_suppkey").distinct()


@query("observed_row_count", "SELECT DISTINCT event_type, (SELECT count(*) FROM events) AS n FROM events")
def _(spark, folder):
    """The count comes with the first action, here a write, not from a second scan."""
    rows, seen = observe_count(read(spark, folder, "events"), "events_read")
    kinds = scratch_path(spark, "observed")
    rows.select("event_type").distinct().write.parquet(kinds)
    return spark.read.parquet(kinds).withColumn("n", F.lit(seen.get["rows"]).cast("bigint"))


@query("union_branches", """
    SELECT p_partkey AS id, p_name AS name, 'Plan' AS kind, p_size AS validity FROM part
    UNION ALL SELECT s_suppkey, s_name, 'Producto', NULL FROM supplier""")
def _(spark, folder):
    plans = read(spark, folder, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
                                               F.lit("Plan").alias("kind"), F.col("p_size").alias("validity"))
    products = read(spark, folder, "supplier").select(F.lit("Producto").alias("kind"), F.col("s_name").alias("name"),
                                                      F.col("s_suppkey").alias("id"))
    return union_branches(plans, products)


@query("union_distinct", """
    SELECT l_suppkey AS id, l_returnflag AS flag FROM lineitem UNION SELECT s_suppkey, 'S' FROM supplier""")
def _(spark, folder):
    lines = read(spark, folder, "lineitem").select(F.col("l_suppkey").alias("id"), F.col("l_returnflag").alias("flag"))
    owners = read(spark, folder, "supplier").select(F.col("s_suppkey").alias("id"), F.lit("S").alias("flag"))
    return union_branches(lines, owners, distinct=True)


# Schema

@query("conform_schema", """
    SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CAST(c_nationkey AS INT) AS place, NULL::TIMESTAMP AS since
    FROM customer UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, s_nationkey, NULL FROM supplier""")
def _(spark, folder):
    people = read(spark, folder, "customer").select(F.col("c_nationkey").alias("place"), F.col("c_custkey").alias("id"),
                                                    F.col("c_name").alias("name"), F.lit("x").alias("since"))
    owners = read(spark, folder, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                                                    F.col("s_nationkey").alias("place"))
    schema = "id STRING NOT NULL, name STRING, place INT, since TIMESTAMP"
    return conform(union_branches(people, owners), schema)


@query("complete_columns", """
    SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL::VARCHAR AS s_phone, NULL::INT AS s_rank FROM supplier""")
def _(spark, folder):
    return complete_columns(read(spark, folder, "supplier"), "s_name STRING, s_phone STRING, s_rank INT")


@query("map_columns", """
    SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, CAST(floor(abs(s_acctbal)) * sign(s_acctbal) AS INT) AS balance
    FROM supplier""")
def _(spark, folder):
    return apply_mapping(read(spark, folder, "supplier"), {
        "a": {"old": {"name": "s_suppkey", "type": "bigint"}, "new": {"name": "id", "type": "string"}},
        "b": {"old": {"name": "s_name", "type": "string"}, "new": {"name": "name", "type": "string"}},
        "c": {"old": {"name": "s_acctbal", "type": "double"}, "new": {"name": "balance", "type": "int"}},
    })


@query("rename_by_text", """
    SELECT s_suppkey AS owner_suppkey, s_name AS owner_name, s_nationkey AS owner_nationkey, s_acctbal AS owner_acctbal
    FROM supplier""")
def _(spark, folder):
    return rename_by_text(read(spark, folder, "supplier"), "s_", "owner_")


@query("rename_drop_constant", """
    SELECT o_orderkey AS id, o_totalprice AS price, 'Nuevo' AS site, NULL::INT AS age, o_totalprice > 100000 AS high
    FROM orders""")
def _(spark, folder):
    rows = read(spark, folder, "orders").withColumnsRenamed({"o_orderkey": "id", "o_totalprice": "price"})
    rows = select_constants(rows.drop("o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"),
                            {"site": "Nuevo", "age": None}, {"age": "int"})
    return rows.select("*", (F.col("price") > 100000).alias("high"))


@query("surrogate_key", "SELECT count(*) AS n_rows, count(*) AS n_keys, count(*) AS n_same FROM customer")
def _(spark, folder):
    """The key of a row is the same after the rows are dealt anew."""
    customer = read(spark, folder, "customer")
    keyed = add_surrogate_key(customer, "key", ["c_custkey", "c_name"]).select("c_custkey", "key")
    again = add_surrogate_key(customer.repartition(7, "c_nationkey"), "key", ["c_custkey", "c_name"])
    both = keyed.join(again.select("c_custkey", F.col("key").alias("other")), "c_custkey")
    return both.agg(F.count("*").alias("n_rows"), F.count_distinct("key").alias("n_keys"),
                    F.count_if(F.col("key") == F.col("other")).alias("n_same"))


@query("surrogate_key_counted", """
    SELECT count(*) AS n_rows, count(*) AS n_keys, CAST(1 AS BIGINT) AS least, CAST(0 AS BIGINT) AS n_null FROM lineitem""")
def _(spark, folder):
    keyed = add_surrogate_key(read(spark, folder, "lineitem"), "key")
    return keyed.agg(F.count("*").alias("n_rows"), F.count_distinct("key").alias("n_keys"), F.min("key").alias("least"),
                     F.count_if(F.col("key").isNull()).alias("n_null"))


@query("dates_as_text", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate FROM orders")
def _(spark, folder):
    return dates_as_text(read(spark, folder, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "absent"])


# Text, numbers, times

def initcap_sql(text: str) -> str:
    return f"array_to_string(list_transform(string_split({text}, ' '), lambda w: upper(w[1:1]) || lower(w[2:])), ' ')"


@query("initcap_lower_upper", f"""
    SELECT p_partkey, {initcap_sql("p_name || ' DE ' || p_type")} AS title, lower(p_brand) AS low, upper(p_name) AS up,
           CAST(length(p_name) AS INT) AS n FROM part""")
def _(spark, folder):
    return read(spark, folder, "part").select(
        "p_partkey", F.initcap(F.concat("p_name", F.lit(" DE "), "p_type")).alias("title"),
        F.lower("p_brand").alias("low"), F.upper("p_name").alias("up"), F.length("p_name").alias("n"))


@query("slug_url", """
    SELECT p_partkey, coalesce(translate('https://www.example.com/inmueble/' || replace(trim(lower(name)), ' ', '-')
           || '-en-' || replace(lower(city), ' ', '-') || '-' || CAST(p_partkey AS VARCHAR), 'áéíóú', 'aeiou'),
           'https://www.example.com/') AS url
    FROM (SELECT p_partkey, ' ' || p_name || ' Ñandú' AS name,
          CASE WHEN p_type <> 'PROMO' THEN ' Bogotá ' || p_type END AS city FROM part)""")
def _(spark, folder):
    parts = read(spark, folder, "part").select(
        "p_partkey", F.concat(F.lit(" "), "p_name", F.lit(" Ñandú")).alias("name"),
        F.expr("CASE WHEN p_type <> 'PROMO' THEN ' Bogotá ' || p_type END").alias("city"))
    url = F.concat(F.lit("https://www.example.com/inmueble/"), slug(F.col("name")), F.lit("-en-"),
                   slug(F.col("city"), trimmed=False), F.lit("-"), F.col("p_partkey").cast("string"))
    return parts.select("p_partkey", or_constant(fold_accents(url), "https://www.example.com/").alias("url"))


@query("pad_code_prefix", """
    SELECT o_orderkey, CASE WHEN length(code) = 4 THEN '0' || code ELSE code END AS city_code,
           substring(CASE WHEN length(code) = 4 THEN '0' || code ELSE code END, 1, 2) AS state_code
    FROM (SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS code FROM orders)""")
def _(spark, folder):
    city = pad_city_code(F.col("o_orderkey"))
    return read(spark, folder, "orders").select("o_orderkey", city.alias("city_code"), state_code(city).alias("state_code"))


@query("split_and_join_codes", """
    SELECT event_id, string_split(code, '-')[2] AS second, nullif(concat_ws('-', event_type, string_split(code, '-')[2]), '')
           AS joined FROM (SELECT event_id, event_type, CASE WHEN event_type = 'view' THEN 'plain'
           ELSE event_type || '-' || CAST(user_id AS VARCHAR) END AS code FROM events)""")
def _(spark, folder):
    code = F.when(F.col("event_type") == "view", F.lit("plain")).otherwise(
        F.concat_ws("-", "event_type", F.col("user_id").cast("string")))
    second = part_of(code, 1)
    return read(spark, folder, "events").select(
        "event_id", second.alias("second"), F.concat_ws("-", "event_type", second).alias("joined"))


@query("price_per_unit", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST((2 * CAST(round(l_extendedprice * 100) AS BIGINT)
                + CAST(l_quantity AS BIGINT)) // (2 * CAST(l_quantity AS BIGINT)) AS DOUBLE) / 100 END AS unit_price
    FROM lineitem""")
def _(spark, folder):
    units = F.when(F.col("l_returnflag") == "R", F.lit(0.0)).otherwise(F.col("l_quantity"))
    return read(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        price_per_unit(F.col("l_extendedprice"), units).alias("unit_price"))


@query("safe_casts", """
    SELECT c_custkey, CASE WHEN c_nationkey < 10 THEN CAST(trunc(c_acctbal) AS INT) END AS whole,
           CASE WHEN c_nationkey < 10 THEN c_acctbal END AS money FROM customer""")
def _(spark, folder):
    text = F.expr("CASE WHEN c_nationkey < 10 THEN CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS STRING) ELSE 'n/a' END")
    return read(spark, folder, "customer").select(
        "c_custkey", to_int(text).alias("whole"), text.try_cast("decimal(18,2)").alias("money"))


@query("parse_timestamp", "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS t FROM orders")
def _(spark, folder):
    moment = F.col("o_orderdate").cast("timestamp")
    text = (
        F.when(F.col("o_orderstatus") == "F", F.date_format(moment, "yyyy-MM-dd HH:mm:ss"))
        .when(F.col("o_orderstatus") == "O", F.date_format(moment, "yyyy-MM-ddHH:mm:ss.SSSZ"))
        .otherwise(F.lit("no time"))
    )
    return read(spark, folder, "orders").select("o_orderkey", parse_time(text).alias("t"))


@query("days_since", """
    SELECT o_orderkey, CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2024-06-30') AS INT) AS days FROM orders""")
def _(spark, folder):
    as_of = F.lit("2024-06-30").cast("date")
    return read(spark, folder, "orders").select("o_orderkey", days_since(as_of, F.col("o_orderdate")).alias("days"))


@query("local_clock_text", "SELECT event_id, strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:%S') AS t FROM events")
def _(spark, folder):
    instant = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("ts")).cast("timestamp")
    return read(spark, folder, "events").select("event_id", clock_text(instant, LOCAL_ZONE).alias("t"))


# JSON

@query("json_flatten", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS props_k FROM events")
def _(spark, folder):
    events = read(spark, folder, "events").select("event_id", "event_type", "props")
    return flatten_json(events, "props", partition_column="event_type")


@query("json_flatten_nested", """
    SELECT event_id, event_type AS j_kind, value AS j_m_v, CAST(user_id AS BIGINT) AS j_m_u, tag AS j_tags, item.n AS j_items_n
    FROM (SELECT event_id, event_type, value, user_id,
          unnest(CASE WHEN event_type = 'view' THEN [NULL] ELSE ['a', event_type] END) AS tag, items
          FROM (SELECT *, [{'n': event_id}, {'n': user_id}] AS items FROM events)), unnest(items) AS t(item)""")
def _(spark, folder):
    tags = F.when(F.col("event_type") != "view", F.array(F.lit("a"), "event_type"))
    items = F.array(F.struct(F.col("event_id").alias("n")), F.struct(F.col("user_id").alias("n")))
    documents = read(spark, folder, "events").select("event_id", F.to_json(F.struct(
        F.struct(F.col("value").alias("v"), F.col("user_id").alias("u")).alias("m"), tags.alias("tags"),
        items.alias("items"), F.col("event_type").alias("_doc_kind"))).alias("j"))
    return flatten_json(documents, "j")


@query("json_variant_keys", """
    SELECT event_type, CAST(user_id AS VARCHAR) AS user_id, CAST(event_id AS VARCHAR) AS event_id, value,
           strftime(ts, '%Y-%m-%d') AS day FROM events""")
def _(spark, folder):
    """Objects whose keys are users, of objects whose keys are events; one document holds an event type's minute."""
    event = F.struct("value", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    users = read(spark, folder, "events").withColumn("event", F.to_json(event)).groupBy(
        "event_type", F.date_trunc("minute", "ts").alias("minute"), "user_id").agg(
        F.concat_ws(",", F.collect_list(F.concat(F.lit('"'), "event_id", F.lit('":'), "event"))).alias("events"))
    documents = users.groupBy("event_type", "minute").agg(F.concat(F.lit("{"), F.concat_ws(",", F.collect_list(
        F.concat(F.lit('"'), "user_id", F.lit('":{'), "events", F.lit("}")))), F.lit("}")).alias("document"))
    return explode_keys(documents.drop("minute"), "document", ["user_id", "event_id"],
                        fields={"value": "$.value double", "day": "$.day string"})


# Views and dataset preparation

@query("temp_view_sql", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def _(spark, folder):
    return query_view(spark, read(spark, folder, "orders"), "predia_orders",
                      "SELECT o_orderstatus, count(*) AS n FROM predia_orders GROUP BY o_orderstatus")


@query("dataset_steps", """
    SELECT n_name AS ds_city_name, CAST(c_custkey AS VARCHAR) AS id, upper(c_mktsegment) || '!' AS "Company Name"
    FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def _(spark, folder):
    rows = lookup(read(spark, folder, "customer"), read(spark, folder, "nation"), "c_nationkey", "n_nationkey",
                  {"city": "n_name"}, "inner")
    return shape_dataset(rows, {"c_custkey": "string"}, {"c_custkey": "id", "city": "ds_city_name"},
                         {"Company Name": F.concat(F.upper("c_mktsegment"), F.lit("!"))},
                         ["ds_city_name", "id", "Company Name"], {"ds_city_name": "CITY"})
