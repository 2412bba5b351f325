import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from predia.operators.changes import apply_changes, hard_delete, settle_changes, stamp, strip_envelope, upsert
from predia.operators.cleaning import clean_strings, fill_zero, require
from predia.operators.enrich import lookup, observe_count, pivot_attributes, union_branches
from predia.operators.hot_keys import hot_keys, left_fan_out
from predia.operators.json_flatten import (
    WideSchemaError, autoflatten, explode_keys, flatten_json, infer_json_schema,
)
from predia.operators.latest import newest_rows, one_per_key
from predia.operators.schema import (
    add_surrogate_key, apply_mapping, complete_columns, conform, dates_as_text, rename_by_text,
)


# Cleaning

def test_empty_text_is_null_and_blanks_stay_as_empty_text(spark, rows):
    df = spark.createDataFrame([("", 1), ("  ", 2), (" a b ", 3), (None, 4)], "t string, n int")
    assert rows(clean_strings(df).orderBy("n")) == rows(
        spark.createDataFrame([(None, 1), ("", 2), ("a b", 3), (None, 4)], "t string, n int"))
    assert [r.t for r in clean_strings(df, blank_is_null=True).orderBy("n").collect()] == [None, None, "a b", None]


def test_cleaning_keeps_other_types_and_odd_names(spark):
    df = spark.createDataFrame([(" x ", 1.5, True, [""])], "`a.b` string, d double, b boolean, l array<string>")
    assert clean_strings(df).collect()[0] == ("x", 1.5, True, [""])


def test_fill_zero_and_require(spark, rows):
    df = spark.createDataFrame([(1, None, None), (2, 5, "x")], "id int, n int, t string")
    assert rows(fill_zero(df, ["n"])) == [(1, 0, None), (2, 5, "x")]
    assert rows(require(df, ["n", "t"])) == [(2, 5, "x")]


# Latest rows

def test_ties_are_all_kept_and_null_times_come_last(spark, rows):
    df = spark.createDataFrame(
        [("a", 2, "x"), ("a", 2, "y"), ("a", 1, "z"), ("b", None, "n"), ("b", 1, "m"), ("c", None, "k"), (None, 3, "q")],
        "k string, t int, v string")
    assert rows(newest_rows(df, ["k"], ["t"])) == sorted(
        [("a", 2, "x"), ("a", 2, "y"), ("b", 1, "m"), ("c", None, "k"), (None, 3, "q")], key=repr)


def test_one_per_key_has_a_total_order(spark, rows):
    data = [("a", 2, "x"), ("a", 2, "y"), ("a", 1, "z"), ("b", None, None), ("b", None, "m")]
    for _ in range(3):
        random.shuffle(data)
        df = spark.createDataFrame(data, "k string, t int, v string").repartition(3)
        assert rows(one_per_key(df, ["k"], ["t"])) == [("a", 2, "y"), ("b", None, "m")]
        assert rows(one_per_key(df, ["k"], ["t"], largest=False)) == [("a", 1, "z"), ("b", None, None)]


def test_latest_operators_match_a_window_on_a_hot_key(spark, rows):
    generator = random.Random(3)
    data = [(0 if generator.random() < 0.4 else generator.randrange(50), generator.randrange(9), i) for i in range(2000)]
    df = spark.createDataFrame(data, "k int, t int, v int")
    best = {}
    for k, t, _ in data:
        best[k] = max(best.get(k, -1), t)
    assert rows(newest_rows(df, ["k"], ["t"])) == sorted([d for d in data if d[1] == best[d[0]]], key=repr)
    assert rows(one_per_key(df, ["k"], ["t"])) == sorted(
        [max((d for d in data if d[0] == k), key=lambda d: d[1:]) for k in best], key=repr)


# Changes

SCHEMA = "id int, v string, t int"
FEED = "id int, v string, t int, Op string"


def changed(spark, stored, feed, **kwargs):
    return apply_changes(spark.createDataFrame(stored, SCHEMA), spark.createDataFrame(feed, FEED), ["id"], ["t"], **kwargs)


def test_insert_update_delete_of_one_key_in_one_batch(spark, rows):
    feed = [(1, "i", 1, "I"), (1, "u", 2, "U"), (1, "d", 3, "D"), (2, "i", 1, "I"), (2, "u", 2, "U"), (4, "x", 1, "D")]
    assert rows(changed(spark, [(1, "old", 0), (3, "keep", 0)], feed)) == [(2, "u", 2), (3, "keep", 0)]


def test_delete_wins_a_tie_and_insert_after_delete_brings_the_key_back(spark, rows):
    feed = [(1, "u", 5, "U"), (1, "d", 5, "D"), (2, "d", 1, "D"), (2, "back", 2, "I")]
    assert rows(changed(spark, [(1, "old", 0), (2, "old", 0)], feed)) == [(2, "back", 2)]


def test_a_null_operation_hides_older_changes_of_its_key(spark, rows):
    feed = [(1, "u", 1, "U"), (1, "n", 2, None), (2, "n", 1, None), (2, "u", 1, "U"), (3, "n", 1, None)]
    assert rows(changed(spark, [(1, "old", 0)], feed)) == [(1, "old", 0), (2, "u", 1)]
    assert rows(changed(spark, [(1, "old", 0)], feed, null_op_is_upsert=True)) == [(1, "n", 2), (2, "u", 1), (3, "n", 1)]


def test_late_changes_overwrite_unless_guarded(spark, rows):
    feed = [(1, "late", 3, "U"), (2, "late", 1, "D"), (3, "same", 9, "U"), (4, "new", 0, "U")]
    stored = [(1, "old", 9), (2, "old", 9), (3, "old", 9)]
    assert rows(changed(spark, stored, feed)) == [(1, "late", 3), (3, "same", 9), (4, "new", 0)]
    assert rows(changed(spark, stored, feed, guard_late=True)) == [
        (1, "old", 9), (2, "old", 9), (3, "same", 9), (4, "new", 0)]


def test_same_batch_twice_equals_once(spark, rows):
    stored = spark.createDataFrame([(i, "s", 0) for i in range(20)], SCHEMA)
    feed = spark.createDataFrame([(i % 13, f"c{i}", i // 3, "UID"[i % 3]) for i in range(60)], FEED)
    once = apply_changes(stored, feed, ["id"], ["t"])
    assert rows(apply_changes(once, feed, ["id"], ["t"])) == rows(once)


def test_a_feed_split_in_time_order_gives_the_same_table(spark, rows):
    generator = random.Random(11)
    feed = [(generator.randrange(15), f"c{i}", i, generator.choice("IUD")) for i in range(120)]
    stored = [(i, "s", -1) for i in range(0, 20, 2)]
    expected = {i: (i, v, t) for i, v, t in stored}
    for key, value, time, op in feed:
        expected.pop(key, None)
        if op != "D":
            expected[key] = (key, value, time)
    for cuts in ([120], [1, 60, 120], sorted(generator.sample(range(1, 120), 3)) + [120]):
        table, start = spark.createDataFrame(stored, SCHEMA), 0
        for end in cuts:
            table = apply_changes(table, spark.createDataFrame(feed[start:end], FEED), ["id"], ["t"])
            table = spark.createDataFrame(table.collect(), SCHEMA)
            start = end
        assert rows(table) == sorted(expected.values(), key=repr)


def test_settled_changes_are_one_per_key(spark, rows):
    feed = spark.createDataFrame([(1, "a", 1, "I"), (1, "b", 2, "U"), (2, "c", 1, "D")], FEED)
    assert rows(settle_changes(feed, ["id"], ["t"])) == [(1, "b", 2, "U"), (2, "c", 1, "D")]


def test_upsert_combines_source_rows_and_adds_columns(spark, rows):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    source = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (3, "z", 1)], "id int, v string, t int")
    assert rows(upsert(target, source, ["id"], ["t"])) == [(1, "a", None), (2, "y", 2), (3, "z", 1)]


def test_hard_delete_ignores_unknown_keys(spark, rows):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert rows(hard_delete(target, spark.createDataFrame([(2,), (9,)], "id int"), ["id"])) == [(1, "a")]


def test_stamp_and_envelope(spark):
    feed = spark.createDataFrame([("2024-01-02 03:04:05", "I", "d", 7)], "field_timestamp string, Op string, db string, id int")
    stamped = strip_envelope(stamp(feed, "field_timestamp"))
    assert stamped.columns == ["id", "transaction_date_time"]
    assert str(stamped.first()[1]) == "2024-01-02 03:04:05"
    assert "field_timestamp" in stamp(feed, "field_timestamp", in_place=True).columns
    assert stamp(feed).first()["transaction_date_time"] is not None


# Schema

def test_conform_orders_casts_and_drops(spark):
    df = spark.createDataFrame([("7", "x", 1.25)], "n string, extra string, price double")
    out = conform(df, "price DECIMAL(18,2), n INT NOT NULL")
    assert out.dtypes == [("price", "decimal(18,2)"), ("n", "int")]
    assert [str(v) for v in out.first()] == ["1.25", "7"]


def test_complete_columns_adds_all_and_accepts_none_missing(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert complete_columns(df, "a INT, b STRING, c DATE").dtypes == [("a", "int"), ("b", "string"), ("c", "date")]
    assert complete_columns(df, "a INT").columns == ["a"]


def test_mapping_keeps_only_mapped_columns(spark):
    df = spark.createDataFrame([("1", "x", 2)], "a string, b string, c int")
    out = apply_mapping(df, [("a", "string", "id", "bigint"), ("c", "int", "c", "string")])
    assert out.dtypes == [("id", "bigint"), ("c", "string")] and tuple(out.first()) == (1, "2")


def test_rename_by_text_and_text_dates(spark):
    df = spark.createDataFrame([(1, 2)], "old_a int, b_old int")
    assert rename_by_text(df, "old", "new").columns == ["new_a", "b_new"]
    stamps = spark.sql("SELECT TIMESTAMP '2024-01-01 10:00:00' AS fecha, 1 AS id")
    assert dates_as_text(stamps, ["fecha", "other"]).first()["fecha"] == "2024-01-01 10:00:00"
    fine = spark.sql("SELECT TIMESTAMP '2024-01-01 10:00:00.123456' AS fecha, '2024-01-01T10:00:00.123456789' AS texto")
    text = dates_as_text(fine, ["fecha", "texto"]).first()
    assert text["fecha"] == "2024-01-0110:00:00.123456" and len(text["fecha"]) == 25
    assert text["texto"] == "2024-01-01T10:00:00.123456789"


def test_surrogate_keys(spark):
    df = spark.range(100).repartition(4)
    counted = [r.key for r in add_surrogate_key(df, "key").collect()]
    assert len(set(counted)) == 100 and min(counted) == 1
    hashed = {r.id: r.key for r in add_surrogate_key(df, "key", ["id"]).collect()}
    assert hashed == {r.id: r.key for r in add_surrogate_key(df.repartition(7), "key", ["id"]).collect()}


# Enrichment

def test_lookup_keeps_the_left_key_and_allows_equal_names(spark, rows):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "id int, valor string")
    dim = spark.createDataFrame([(1, "one")], "id int, valor string")
    assert rows(lookup(left, dim, "id", "id", {"name": "valor"})) == sorted(
        [(1, "a", "one"), (2, "b", None), (None, "c", None)], key=repr)
    assert rows(lookup(left, dim, "id", "id", {"name": F.upper("valor")}, "inner")) == [(1, "a", "ONE")]


def test_left_fan_out_equals_a_left_join(spark, rows):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    many = spark.createDataFrame([(1, 10), (1, 11), (3, 12), (None, 13)], "m int, n int")
    assert rows(left_fan_out(left, many, "k", "m")) == rows(left.join(many, F.col("k") == F.col("m"), "left"))


@pytest.mark.parametrize("split_rows", [1, 3, 50, 1000])
def test_left_fan_out_deals_out_hot_keys(spark, rows, split_rows):
    """Hot on one side, on both, on the kept side alone; rows that are equal; null keys; keys without rows."""
    left = spark.createDataFrame(
        [(1, "a"), (1, "b"), (1, "b"), (2, "c"), (3, "d"), (4, "e"), (None, "n")] + [(5, "same")] * 40, "k long, v string")
    many = spark.createDataFrame(
        [(1, i, {"x": i}) for i in range(60)] + [(2, 7, None)] * 20 + [(3, 1, None), (None, 2, None), (None, 2, None)]
        + [(9, i, None) for i in range(30)], "m long, n long, extra map<string,int>")
    plain = left.join(many, F.col("k") == F.col("m"), "left")
    got = left_fan_out(left, many, "k", "m", split_rows)
    assert got.columns == plain.columns and got.schema == plain.schema
    assert rows(got) == rows(plain)
    assert len(hot_keys(many, "m", split_rows)) == {1: 3, 3: 3, 50: 1, 1000: 0}[split_rows]


def test_hot_keys_of_other_types_are_joined_as_they_are(spark, rows):
    left = spark.createDataFrame([(7, "a"), (8, "b")], "k int, v string")
    many = spark.createDataFrame([("7", 1), ("07", 2), ("7", 3)], "m string, n int")
    assert rows(left_fan_out(left, many, "k", "m", 1), "k", "n") == [(7, 1), (7, 2), (7, 3), (8, None)]
    parts = spark.createDataFrame([(bytearray(b"x"),)] * 3, "m binary")
    assert hot_keys(parts, "m", 1) == []
    assert rows(left_fan_out(parts, parts.withColumnRenamed("m", "o"), "m", "o", 1).selectExpr("hex(o)")) == [("78",)] * 9
    none = many.limit(0)
    assert hot_keys(none, "m", 1) == [] and left_fan_out(left.withColumn("k", F.col("k").cast("string")), none, "k", "m").count() == 2


def test_pivot_takes_the_first_detail_and_keeps_null_values(spark, rows):
    details = spark.createDataFrame(
        [(5, 1, 10, "late"), (4, 1, 10, "first"), (6, 1, 20, None), (7, 2, 30, "other"), (8, 3, 99, "lost")],
        "d int, e int, a int, v string")
    names = spark.createDataFrame([(10, "x"), (20, "y"), (30, "z")], "a int, alias string")
    wide = pivot_attributes(details, names, ["x", "y"], "e", "a", "v", "alias", "d")
    assert rows(wide) == [(1, "first", None), (2, None, None)]


def test_union_matches_names_and_can_be_distinct(spark, rows):
    a = spark.createDataFrame([(1, "p"), (1, "p")], "id int, kind string")
    b = spark.createDataFrame([("q", 2)], "kind string, id int")
    assert rows(union_branches(a, b)) == [(1, "p"), (1, "p"), (2, "q")]
    assert rows(union_branches(a, b, distinct=True)) == [(1, "p"), (2, "q")]


def test_observed_count(spark):
    df, seen = observe_count(spark.range(123), "seen")
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 123}


# JSON

def test_flatten_nested_documents(spark, rows):
    docs = [
        ('{"a": {"b": 1, "c d": "x"}, "l": [1, 2], "m": [{"n": 1}, {"n": 2}]}', 1),
        ('{"a": {"b": 2.5}}', 2), (None, 3), ('{"l": [], "_doc_z": true}', 4),
    ]
    flat = flatten_json(spark.createDataFrame(docs, "j string, id int"), "j")
    assert set(flat.columns) == {"id", "j_a_b", "j_a_c d", "j_l", "j_m_n", "j_z"}
    got = rows(flat, "id", "j_a_b", "`j_a_c d`", "j_l", "j_m_n", "j_z")
    assert got == sorted([(1, 1.0, "x", i, n, None) for i in (1, 2) for n in (1, 2)] + [
        (2, 2.5, None, None, None, None), (3, None, None, None, None, None), (4, None, None, None, None, True)], key=repr)


def test_schema_of_mixed_kinds_is_text(spark):
    docs = spark.createDataFrame([('{"k": 1, "VOID": null, "n": 12345678901}',), ('{"k": "one"}',)], "j string")
    assert infer_json_schema(docs, "j") == T.StructType.fromDDL("`VOID` STRING, k STRING, n BIGINT")
    assert sorted(r.j_k for r in flatten_json(docs, "j").collect()) == ["1", "one"]


def test_given_schema_partition_column_and_root_array(spark, rows):
    docs = spark.createDataFrame([("p", '[{"x": 1}, {"x": 2}]')], "part string, j string")
    assert rows(flatten_json(docs, "j", "ARRAY<STRUCT<x: INT>>", partition_column="part")) == [(1,), (2,)]
    assert autoflatten(spark.range(1)).columns == ["id"]


def test_json_keys_become_rows(spark, rows):
    data = [(1, '{"u1": {"a": {"n": 1}, "b": {"n": "x"}}, "u2": [{"n": 2.5}, {"m": 0}]}'), (2, "{}"), (3, None),
            (4, "no json"), (5, '{"u": null}'), (6, '{"deep": {"k": {"n": {"o": 7}}}}')]
    df = spark.createDataFrame(data, "id int, j string")
    found = explode_keys(df, "j", ["user", "item"], fields={"n": "$.n double", "o": "$.n.o int", "t": "$.n string"})
    assert found.columns == ["id", "user", "item", "n", "o", "t"]
    assert rows(found) == sorted([
        (1, "u1", "a", 1.0, None, "1"), (1, "u1", "b", None, None, "x"), (1, "u2", "0", 2.5, None, "2.5"),
        (1, "u2", "1", None, None, None), (2, None, None, None, None, None), (3, None, None, None, None, None),
        (4, None, None, None, None, None), (5, "u", None, None, None, None),
        (6, "deep", "k", None, 7, '{"o":7}')], key=repr)
    kept = explode_keys(df.where("id = 6"), "j", ["user"], "rest").selectExpr("id", "user", "to_json(rest) AS rest")
    assert rows(kept) == [(6, "deep", '{"k":{"n":{"o":7}}}')]


def test_a_schema_whose_keys_are_data_is_an_error(spark):
    wide = spark.range(300).selectExpr("concat('{\"user', id, '\": 1}') AS j")
    with pytest.raises(WideSchemaError, match="explode_keys"):
        infer_json_schema(wide, "j", widest=2000)
    assert len(infer_json_schema(wide, "j")) == 300
