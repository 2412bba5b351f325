"""Dense keys, reconciliation and quarantine."""

import json
import random

import pytest
from pyspark.sql import functions as F

from predia.operators.dense_keys import NUMBER, KeyRegistry, numbered
from predia.operators.reconcile import differing_ranges, reconcile
from predia.plans.curated import bad_rows_folder, curated_table, load_table
from predia.plans.quarantine import TooManyBadRowsError, broken_rules, quarantined
from predia.session import scratch_path
from predia.sources import files
from predia.sources.config import JobConfig


@pytest.fixture
def path(spark):
    return scratch_path(spark, "test")


def test_numbers_have_no_gaps_and_stay(spark, path, rows):
    keys = spark.createDataFrame([("b", 1), ("a", 2), (None, 1), ("a", None), ("a", 2)], "k string, n int")
    registry = KeyRegistry(spark, path, ["k", "n"])
    first = rows(registry.keyed(keys, "id"), "k", "n", "id")
    assert first == sorted([("a", 2, 3), ("a", 2, 3), ("a", None, 2), ("b", 1, 4), (None, 1, 1)], key=repr)
    more = spark.createDataFrame([("a", 1, 9), ("b", 1, 9), ("c", 0, 9)], "k string, n int, id int")
    assert rows(registry.keyed(more, "id"), "k", "id") == [("a", 5), ("b", 4), ("c", 6)]
    assert rows(registry.keyed(keys, "id"), "k", "n", "id") == first
    assert registry.add(keys.where("false")).count() == 6


def test_numbers_follow_the_order_over_many_ranges(spark):
    found = numbered(spark.range(10_000).select((F.col("id") * 7 % 10_007).alias("k")), after=100).collect()
    assert [r[NUMBER] for r in sorted(found, key=lambda r: r["k"])] == list(range(101, 10_101))


@pytest.mark.parametrize("seed", range(3))
def test_reconcile_names_what_differs(spark, rows, seed):
    rng = random.Random(seed)
    mine = {i: (i, rng.choice(["a", None, "b"]), rng.choice([1.5, None])) for i in range(-50, 400)}
    theirs, expected = dict(mine), []
    for i in rng.sample(sorted(mine), 12):
        if i % 3 == 0:
            del theirs[i]
            expected.append((i, "missing"))
        else:
            theirs[i] = (i, "changed", mine[i][2])
            expected.append((i, "changed"))
    theirs[9999] = (9999, None, None)
    expected.append((9999, "added"))
    schema = "k long, v string, w double"
    left, right = (spark.createDataFrame(list(t.values()), schema) for t in (mine, theirs))
    assert rows(reconcile(left, right, "k", ranges=8)) == sorted(expected, key=repr)
    assert reconcile(left, left, "k").count() == 0
    named = [df.withColumn("k", F.concat(F.lit("x"), "k")) for df in (left, right)]
    assert reconcile(*named, "k").count() == len(expected)


def test_reconcile_edges(spark, rows):
    schema = "k long, v string, w string"
    left = spark.createDataFrame([(1, "a", None), (1, "a", None), (None, "n", "n"), (2, None, "x"), (3, "s", "s")], schema)
    right = spark.createDataFrame([(1, "a", None), (None, "m", "n"), (2, "x", None), (3, "s", "s")], schema)
    assert rows(reconcile(left, right, "k")) == [(1, "changed"), (2, "changed"), (None, "changed")]
    empty = left.where("false")
    assert rows(reconcile(empty, right, "k")) == [(1, "added"), (2, "added"), (3, "added"), (None, "added")]
    assert reconcile(empty, empty, "k").count() == 0
    with pytest.raises(ValueError):
        reconcile(left, right.drop("w"), "k")


def test_equal_ranges_are_not_read_again(spark, path):
    spark.range(100_000).select("id", (F.col("id") * 2).alias("v")).repartitionByRange(8, "id").write.parquet(path)
    left = spark.read.parquet(path)
    right = left.withColumn("v", F.when(F.col("id") == 77_000, -1).otherwise(F.col("v")))
    spans = differing_ranges(left, right, "id", ["id", "v"], 16)
    assert len(spans) == 1 and spans[0][0] < 77_000 <= spans[0][1] and spans[0][1] - spans[0][0] < 10_000
    plan = reconcile(left, right, "id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id" in plan or "GreaterThan(id" in plan


RULES = {"id": "bigint required", "price": "double", "day": "date required"}


def test_reasons(spark, rows):
    data = [("1", "2.5", "2024-01-01", "U"), ("x", "2,5", "2024-13-01", "U"), (None, None, None, "Z"), ("2", None, "2024-01-01", None)]
    df = spark.createDataFrame(data, "id string, price string, day string, Op string")
    found = [r[0] for r in df.select(broken_rules(df, RULES)).collect()]
    assert found == [[], ["day: no date", "id: no bigint", "price: no double"],
                     ["Op: unknown operation", "day: missing", "id: missing"], []]
    assert df.drop("day").select(broken_rules(df.drop("day"), RULES)).first()[0] == ["day: missing column"]
    assert df.select(broken_rules(df.drop("Op"), {})).first()[0] == []


def test_bad_rows_of_a_delivery_are_put_aside_or_end_the_load(spark, path, rows):
    job = JobConfig(f"{path}/raw", f"{path}/lake", file_format="csv", mappings=f"{path}/mappings")
    config = {"primary_key": "id", "rules": {"id": "bigint required", "price": "double"}, "most_bad": 2}
    files.write_text(spark, f"{path}/mappings/mapping_t.json", json.dumps(config))
    head = "Op,id,price,field_timestamp\n"
    files.write_text(spark, f"{path}/raw/s/t/LOAD1.csv", head + "I,1,1.0,2024-01-01 00:00:00\nI,,2.0,2024-01-01 00:00:00\n")
    load_table(spark, job, "s", "t", "fl")
    bad = bad_rows_folder(job, "s", "t")
    assert rows(quarantined(spark, bad), "_reasons") == [(["id: missing"],)]
    file = f"{path}/raw/s/t/20240102-1.csv"
    files.write_text(spark, file, head + "".join(f"U,{i},much,2024-01-02 00:00:00\n" for i in range(3)))
    with pytest.raises(Exception, match="3 bad rows, 2 are allowed: price: no double"):
        load_table(spark, job, "s", "t", "cdc")
    assert quarantined(spark, bad).count() == 1
    files.write_text(spark, file, head + 'U,1,3.0,2024-01-02 00:00:00\nU,2,much,2024-01-02 00:00:00\n')
    load_table(spark, job, "s", "t", "cdc")
    assert rows(curated_table(spark, job, "s", "t").snapshot(), "id", "price") == [("1", "3.0")]
    found = quarantined(spark, bad).where("_reasons[0] = 'price: no double'").first()
    assert json.loads(found["_record"])["id"] == "2"
    assert quarantined(spark, f"{bad}-none").count() == 0
