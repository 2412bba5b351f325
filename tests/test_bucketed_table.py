"""Bucketed tables: merges equal the change application on frames, and leave what is stored where it lies."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from predia.operators.changes import apply_changes
from predia.sources import files
from predia.sources.bucketed_table import BucketedTable
from predia.sources.keyed_table import MissingTableError
from predia.workload.standins import read

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture
def table(spark, tmp_path):
    name = f"bucketed_{uuid.uuid4().hex}"
    yield lambda keys, buckets=4: BucketedTable(spark, name, str(tmp_path / "t"), keys, buckets)
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def feed(spark, *rows):
    return spark.createDataFrame(list(rows), "Op string, k long, v string, t int")


def test_changes_of_every_kind(spark, table, rows):
    stored = table("k")
    stored.load(spark.createDataFrame([(1, "a", 5), (2, "b", 5), (3, "c", 5), (3, "older", 4)], "k long, v string, t int"),
                ["t"])
    stored.merge(feed(spark, ("U", 1, "A", 6), ("D", 2, None, 6), ("I", 4, "d", 6), ("D", 9, None, 6),
                      (None, 3, "nothing", 7), ("U", 1, "old", 5)), ["t"])
    assert rows(stored.rows()) == [(1, "A", 6), (3, "c", 5), (4, "d", 6)]
    stored.upsert(spark.createDataFrame([(4, "up", 1), (5, "e", 1)], "k long, v string, t int"))
    assert rows(stored.rows()) == [(1, "A", 6), (3, "c", 5), (4, "up", 1), (5, "e", 1)]


def test_late_changes(spark, table, rows):
    stored = table("k")
    stored.load(spark.createDataFrame([(1, "a", 5), (2, "b", 5), (3, "c", None)], "k long, v string, t int"))
    late = feed(spark, ("U", 1, "late", 4), ("D", 2, None, 4), ("U", 3, "new", 1), ("U", 4, "d", 0))
    stored.merge(late, ["t"], guard_late=True)
    assert rows(stored.rows()) == [(1, "a", 5), (2, "b", 5), (3, "new", 1), (4, "d", 0)]
    stored.merge(feed(spark, ("D", 1, None, 5)), ["t"], guard_late=True)
    assert rows(stored.rows(), "k") == [(2,), (3,), (4,)], "an equally new change counts"


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("guard_late", [False, True])
def test_merges_equal_the_change_application(spark, table, rows, seed, guard_late):
    rng = random.Random(seed)
    now = spark.createDataFrame([(k, f"b{k}", rng.randrange(9)) for k in range(40)], "k long, v string, t int")
    stored = table("k")
    stored.load(now)
    for batch in range(2):
        changes = feed(spark, *[(rng.choice(["I", "U", "D", None]), rng.randrange(60), f"{batch}-{i}", rng.randrange(9))
                                for i in range(80)])
        now = spark.createDataFrame(apply_changes(now, changes, ["k"], ["t"], guard_late=guard_late).collect(), now.schema)
        stored.merge(changes, ["t"], guard_late=guard_late)
        assert rows(stored.rows(), "k", "v", "t") == rows(now, "k", "v", "t")


def test_columns_types_keys_and_empty_batches(spark, table, rows):
    stored = table(["a", "b"])
    with pytest.raises(MissingTableError):
        stored.merge(feed(spark), ["t"])
    stored.load(spark.createDataFrame([(1, "x", 1), (1, "y", 2)], "a long, b string, t int"))
    wider = spark.createDataFrame([("U", 1, "y", 3, "n"), ("I", 2, "x", 3, "m")], "Op string, a int, b string, t int, note string")
    stored.merge(wider, ["t"])
    assert rows(stored.rows(), "a", "b", "t", "note") == [(1, "x", 1, None), (1, "y", 3, "n"), (2, "x", 3, "m")]
    assert dict(stored.rows().dtypes)["a"] == "bigint", "the stored type of a key stays"
    stored.merge(wider.drop("note").limit(0), ["t"])
    assert stored.rows().count() == 3
    stored.merge(spark.createDataFrame([("U", 1, "y", 4)], "Op string, a long, b string, t int"), ["t"])
    assert (1, "y", 4, None) in rows(stored.rows(), "a", "b", "t", "note"), "a column that a change lacks is null"
    with pytest.raises(TypeError, match="note"):
        stored.merge(spark.createDataFrame([("U", 1, "y", 4, 7)], "Op string, a long, b string, t int, note int"), ["t"])
    with pytest.raises(Exception, match="has no b"):
        stored.merge(spark.createDataFrame([("U", 1, None, 5)], "Op string, a long, b string, t int"), ["t"])
    with pytest.raises(ValueError, match="lack the key"):
        stored.merge(spark.createDataFrame([("U", 1, 5)], "Op string, a long, t int"), ["t"])
    assert stored.rows().count() == 3


def test_a_merge_that_dies_changes_nothing_and_old_folders_go(spark, table, rows, monkeypatch):
    stored = table("k")
    stored.load(spark.createDataFrame([(1, "a", 1)], "k long, v string, t int"))
    change = feed(spark, ("U", 1, "b", 2))
    with monkeypatch.context() as patch:
        patch.setattr(BucketedTable, "exists", lambda self: (_ for _ in ()).throw(RuntimeError("killed")) if
                      spark.catalog.tableExists(f"{self.name}_staged") else True)
        with pytest.raises(RuntimeError, match="killed"):
            stored.merge(change, ["t"])
    assert rows(stored.rows()) == [(1, "a", 1)]
    stored.merge(change, ["t"])
    before = stored.rows()
    assert rows(before) == [(1, "b", 2)]
    stored.merge(feed(spark, ("U", 1, "c", 3)), ["t"])
    assert rows(before) == [(1, "b", 2)], "who reads the folder before can finish"
    assert len(files.folders(spark, stored.path)) == 2


def test_the_stored_side_is_neither_shuffled_nor_sorted(spark, table):
    stored = table("o_orderkey", 6)
    orders = read(spark, FOLDER, "orders")
    stored.load(orders)
    changes = orders.where("o_orderstatus = 'F'").withColumn("Op", F.lit("U"))
    stored.merge(changes, ["o_orderdate"])
    with stored._layout(6):
        plan = stored.merged(stored.rows(), changes, ["o_orderdate"], "Op", True)
        text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text
    kept = text.split("FullOuter")[1].split("SortAggregate")[0]
    assert "Bucketed: true" in kept, "the stored side comes first, and no exchange above it"
    assert "Sort [" not in kept and text.count("Exchange") == 1, "only the changes are shuffled, once"
    # A bucket stays one file, so the next merge finds it sorted again.
    current = stored._described()["Location"]
    assert len([f for f in files.matches(spark, f"{current}/part-*")]) == 6
