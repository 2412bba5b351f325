import csv
import datetime as dt
import io
import json
import pathlib
import random

import pytest
from pyspark.sql import functions as F

from predia.plans.curated import curate, curated_table, load_all, load_table
from predia.plans.mapped_load import run_configured_load, run_mapped_load
from predia.plans.together import run_together
from predia.session import scratch_path, sized
from predia.sources import files
from predia.sources.config import (
    ConfigError, JobConfig, TableConfig, discover_tables, load_table_config, selected_tables, table_config,
)
from predia.sources.incremental import IncrementalReader
from predia.sources.keyed_table import COMMIT, FeedGoneError, KeyedTable, MissingTableError, _pruned
from predia.sources.readers import UnknownFormatError, query_view, read_table
from predia.sources.split_csv import BrokenFileError, counted_blocks, numbered_lines
from predia.streaming import change_stream
from predia.streaming.change_stream import read_new_files, stream_changes
from predia.streaming.latest_state import stream_latest
from predia.workload import QUERIES
from predia.workload.storage_queries import feed_files

SCHEMA = "id int, v string, t int"
FEED = "id int, v string, t int, Op string"


@pytest.fixture
def path(spark):
    return scratch_path(spark, "test")


# Readers and configuration

def test_modes_choose_files_by_name(spark, path, rows):
    feed_files(spark.range(3).coalesce(1), f"{path}/t/deep", "LOAD")
    feed_files(spark.range(10, 12).coalesce(1), f"{path}/t/deep", "20240101-")
    feed_files(spark.range(20, 21).coalesce(1), f"{path}/t", "Lima-")
    assert rows(read_table(spark, path, mode="fl")) == [(0,), (1,), (2,), (20,)]
    assert rows(read_table(spark, path, mode="cdc")) == [(10,), (11,), (20,)]
    assert read_table(spark, path).count() == 6
    with pytest.raises(ValueError):
        read_table(spark, path, mode="incremental")


def test_unknown_format(spark, path):
    with pytest.raises(UnknownFormatError):
        read_table(spark, path, "xml")


def test_csv_with_quotes_commas_and_line_breaks(spark, path, rows):
    files.write_text(spark, f"{path}/a/x.csv", 'id,text\n1,"a, ""b""\nc"\n2,\n')
    assert rows(read_table(spark, path, "csv", multiLine=True)) == [("1", 'a, "b"\nc'), ("2", None)]
    files.write_text(spark, f"{path}/a/x.csv", 'id,text\n1,"a, ""b"""\n')
    assert rows(read_table(spark, path, "csv")) == [("1", 'a, "b"')]


def write_plain(spark, path, name, rows, **kwargs):
    text = io.StringIO()
    csv.writer(text, lineterminator=kwargs.pop("end", "\n"), **kwargs).writerows(rows)
    files.write_text(spark, f"{path}/{name}", text.getvalue())


@pytest.fixture
def tiny_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "1"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("seed", range(4))
def test_csv_splits_hold_any_line_breaks(spark, path, rows, tiny_splits, seed):
    rng = random.Random(seed)
    values = ["", "a", "a,b", 'say "x"', "two\nlines", "\n", '"', '",\n"', "\n\n\nlong " * 30, "é\nü", "a\r\nb", " x "]
    expected = []
    for file in range(3):
        table = [(str(i + 100 * file), rng.choice(values), rng.choice(values)) for i in range(rng.randrange(1, 60))]
        write_plain(spark, path, f"{file}.csv", [("id", "a", "b"), *table], quoting=csv.QUOTE_ALL,
                    end="\r\n" if file == 1 else "\n")
        expected += [tuple(v or None for v in row) for row in table]
    df = read_table(spark, path, "csv", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    assert rows(df) == sorted(expected, key=repr)


def test_a_csv_file_is_many_tasks(spark, path, tiny_splits):
    table = [(i, f"line\nbreak {i}") for i in range(200)]
    write_plain(spark, path, "x.csv", [("id", "text"), *table])
    lines = numbered_lines(spark.read.option("lineSep", "\n").text(path), {"quote": '"', "escape": '"'})
    splits = lines.groupBy("block").count()
    assert splits.count() > 20 and splits.agg(F.max("count")).first()[0] < 20
    assert read_table(spark, path, "csv").count() == 200


def test_csv_headers_of_their_own_and_schemas(spark, path, rows, tiny_splits):
    write_plain(spark, path, "a.csv", [("id", "text"), (1, "x\ny")])
    write_plain(spark, path, "b.csv", [("text", "id", "more\nof it"), ("z", 2, "w")])
    write_plain(spark, path, "empty.csv", [])
    df = read_table(spark, path, "csv")
    assert df.columns == ["id", "text", "more\nof it"] or set(df.columns) == {"id", "text", "more\nof it"}
    assert rows(df, "id", "text") == [("1", "x\ny"), ("2", "z")]
    write_plain(spark, f"{path}/typed", "a.csv", [("id", "text"), (1, "x\ny"), ("no", "")])
    typed = read_table(spark, f"{path}/typed", "csv", schema="number int, said string")
    assert rows(typed) == [(1, "x\ny"), (None, None)]
    files.write_text(spark, f"{path}/back/a.csv", 'id,text\n1,"a \\" b\nc"\n2,d\n')
    assert rows(read_table(spark, f"{path}/back", "csv", escape="\\")) == [("1", 'a " b\nc'), ("2", "d")]


def test_a_quote_that_does_not_close_is_an_error(spark, path):
    files.write_text(spark, f"{path}/a.csv", 'id,text\n1,"open\n2,x\n')
    with pytest.raises(BrokenFileError, match="a.csv"):
        read_table(spark, path, "csv")


def test_json_records_of_every_shape(spark, path, rows):
    files.write_text(spark, f"{path}/many/x.json", '{"id": [{"a": 1},\n {"a": 2}], "other": 3}')
    files.write_text(spark, f"{path}/one/x.json", '{\n"id": {"a": 5}}')
    files.write_text(spark, f"{path}/plain/x.json", '{"id": 9}')
    assert rows(read_table(spark, f"{path}/many", "json")) == [(1,), (2,)]
    assert rows(read_table(spark, f"{path}/one", "json")) == [(5,)]
    assert rows(read_table(spark, f"{path}/plain", "json")) == [(9,)]
    assert read_table(spark, f"{path}/plain", "json", record_path=None).columns == ["id"]


def test_configuration_is_checked(spark, path):
    files.write_text(spark, f"{path}/good.json", '{"primary_key": "id_x", "partition_key": "p"}')
    files.write_text(spark, f"{path}/bad.json", '{"partition_key": "p"}')
    assert load_table_config(spark, f"{path}/good.json") == TableConfig("id_x", "p")
    with pytest.raises(ConfigError):
        load_table_config(spark, f"{path}/bad.json")
    with pytest.raises(FileNotFoundError):
        load_table_config(spark, f"{path}/none.json")
    assert table_config("proyectos").primary_key == "id_proyecto"
    assert table_config("usuario").primary_key == "id"
    assert len(selected_tables("a", "b")) == len(set(selected_tables("a", "b"))) == 34


def test_view_and_discovery(spark, path):
    assert query_view(spark, spark.range(5), "predia_test_view", "SELECT max(id) AS m FROM predia_test_view").first().m == 4
    spark.range(1).write.parquet(f"{path}/shop/a")
    spark.range(1).write.parquet(f"{path}/crm/b")
    assert discover_tables(spark, path) == [("crm", "b"), ("shop", "a")]
    assert discover_tables(spark, f"{path}/absent") == []


# Keyed tables

def make(spark, path, **kwargs):
    table = KeyedTable(spark, path, "id", **kwargs)
    table.overwrite(spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 1)], SCHEMA))
    return table


def listing(spark, path):
    """Data files of a table, not those of its feed, with their times of change."""
    jvm = spark.sparkContext._jvm
    fs, location = files.file_system(spark, path)
    found, walk = {}, fs.listFiles(location, True)
    while walk.hasNext():
        status = walk.next()
        if status.getPath().getName().endswith(".parquet") and "/feed/" not in status.getPath().toString():
            found[status.getPath().toString()] = status.getModificationTime()
    assert jvm is not None
    return found


def test_changes_upserts_and_deletes(spark, path, rows):
    table = make(spark, path)
    table.write(spark.createDataFrame([(1, "u", 2, "U"), (2, "d", 2, "D"), (4, "i", 2, "I"), (5, "n", 2, None)], FEED),
                "cdc", ["t"])
    assert rows(table.snapshot()) == [(1, "u", 2), (3, "c", 1), (4, "i", 2)]
    table.write(spark.createDataFrame([(2, "back", 3), (1, "x", 3), (1, "w", 2)], SCHEMA), None, ["t"])
    table.delete(spark.createDataFrame([(3,), (77,)], "id int"))
    assert rows(table.snapshot()) == [(1, "x", 3), (2, "back", 3), (4, "i", 2)]
    table.delete(spark.createDataFrame([(1,), (2,), (4,)], "id int"))
    assert rows(table.snapshot()) == [] and table.exists()


def test_guarded_late_change_and_replay(spark, path, rows):
    table = make(spark, path)
    late = spark.createDataFrame([(1, "late", 0, "U"), (2, "new", 5, "U")], FEED)
    commit = table.apply_changes(late, ["t"], guard_late=True)
    assert rows(table.snapshot()) == [(1, "a", 1), (2, "new", 5), (3, "c", 1)]
    table.apply_changes(late, ["t"], guard_late=True, commit=commit)
    assert rows(table.snapshot()) == [(1, "a", 1), (2, "new", 5), (3, "c", 1)]
    assert table.last_commit() == commit


def test_append_does_not_look_at_keys_and_later_changes_do(spark, path, rows):
    table = make(spark, path)
    table.append(spark.createDataFrame([(1, "again", 1)], SCHEMA))
    assert rows(table.snapshot()) == [(1, "a", 1), (1, "again", 1), (2, "b", 1), (3, "c", 1)]
    table.apply_changes(spark.createDataFrame([(1, "one", 2, "U")], FEED), ["t"])
    assert rows(table.snapshot()) == [(1, "one", 2), (2, "b", 1), (3, "c", 1)]


def test_guards(spark, path):
    table = KeyedTable(spark, path, "id")
    feed = spark.createDataFrame([(1, "u", 2, "U")], FEED)
    with pytest.raises(MissingTableError):
        table.write(feed, "cdc", ["t"])
    with pytest.raises(MissingTableError):
        table.snapshot()
    with pytest.raises(ValueError):
        table.write(feed, "sync")
    for method in ("fl", None):
        assert table.write(feed.limit(0), method) is None
    assert not table.exists()
    commit = make(spark, path).last_commit()
    assert table.write(feed.limit(0), "cdc", ["t"]) is None and table.last_commit() == commit
    with pytest.raises(ValueError, match="lack the columns"):
        table.write(feed.drop("Op"), "cdc", ["t"])
    with pytest.raises(TypeError, match="other types"):
        table.write(feed.withColumn("v", F.lit(1)), "cdc", ["t"])


def test_a_change_leaves_other_partitions_alone_and_one_copy(spark, path, rows):
    table = KeyedTable(spark, path, "id", buckets=8)
    table.overwrite(spark.range(200).selectExpr("CAST(id AS INT) AS id", "'a' AS v", "1 AS t"))
    before = listing(spark, path)
    table.apply_changes(spark.createDataFrame([(7, "u", 2, "U")], FEED), ["t"])
    after = listing(spark, path)
    gone = {f.split("_part=")[1].split("/")[0] for f in before.keys() - after.keys()}
    assert len(gone) == 1 and {f for f in before if before[f] == after.get(f)} == before.keys() & after.keys()
    for i in range(10):
        table.apply_changes(spark.createDataFrame([(i, f"v{i}", 3 + i, "U"), (100 + i, "", 3, "D")], FEED), ["t"])
    assert table.snapshot().count() == 190
    assert sum(1 for _ in listing(spark, path)) <= 8 and not [f for f in files.folders(spark, path) if "pending" in f]
    table.overwrite(spark.range(5).selectExpr("CAST(id AS INT) AS id", "'b' AS v", "1 AS t"))
    assert len([f for f in files.folders(spark, path) if f != "feed"]) == 1, "the folder of the older load is gone"


@pytest.mark.parametrize("step", ["_put", "delete_partition", "_save"])
def test_a_killed_batch_is_replayed_to_the_same_rows(spark, path, rows, monkeypatch, step):
    table = KeyedTable(spark, path, "id", buckets=2)
    table.overwrite(spark.range(6).selectExpr("CAST(id AS INT) AS id", "'a' AS v", "1 AS t"))
    changes = spark.createDataFrame([(0, "u", 2, "U"), (9, "n", 2, "I")] + [(i, "", 2, "D") for i in range(1, 6)], FEED)

    def lost(*args, **kwargs):
        raise RuntimeError("lost")

    calls = {"n": 0}
    for at in range(3):
        with monkeypatch.context() as patch:
            if step == "delete_partition":
                patch.setattr(files, step, lost)
            else:
                real = getattr(table, step)
                calls["n"] = 0

                def sometimes(*args, **kwargs):
                    calls["n"] += 1
                    return lost() if calls["n"] > at else real(*args, **kwargs)

                patch.setattr(table, step, sometimes)
            try:
                table.apply_changes(changes, ["t"], commit="90000000000000000")
            except RuntimeError:
                pass
    table.apply_changes(changes, ["t"], commit="90000000000000000")
    assert rows(KeyedTable(spark, path, "id").snapshot()) == [(0, "u", 2), (9, "n", 2)]


def test_null_keys_are_one_key(spark, path, rows):
    table = make(spark, path)
    for moment in (1, 2, 2):
        table.upsert(spark.createDataFrame([(None, "x", moment)], SCHEMA), ["t"])
    assert rows(table.snapshot()) == [(1, "a", 1), (2, "b", 1), (3, "c", 1), (None, "x", 2)]
    table.apply_changes(spark.createDataFrame([(None, "late", 0, "U")], FEED), ["t"], guard_late=True)
    table.delete(spark.createDataFrame([(None,)], "id int"))
    assert rows(table.snapshot()) == [(1, "a", 1), (2, "b", 1), (3, "c", 1)]


def test_partitioned_table_keeps_types_nulls_and_empty_text(spark, path, rows):
    data = [(1, "01"), (2, "02"), (3, None), (4, ""), (5, "a/b=c d")]
    table = KeyedTable(spark, path, "id", partition_by="state", write_options={"compression": "snappy"})
    table.overwrite(spark.createDataFrame(data, "id int, state string"))
    assert rows(table.snapshot(), "id", "state") == sorted(data, key=repr)
    table.upsert(spark.createDataFrame([(1, "02"), (5, "")], "id int, state string"))
    moved = [(1, "02"), (2, "02"), (3, None), (4, ""), (5, "")]
    assert rows(table.snapshot(), "id", "state") == sorted(moved, key=repr)
    assert len(files.folders(spark, f"{path}/{table._state()['folder']}")) == 3, "emptied partitions are gone"
    table.delete(spark.createDataFrame([(3,)], "id int"))
    assert table.snapshot().count() == 4


def test_new_columns_join_the_table(spark, path, rows):
    table = make(spark, path)
    table.upsert(spark.createDataFrame([(2, "b2", 2, True)], f"{SCHEMA}, w boolean"), ["t"])
    table.append(spark.createDataFrame([(8, 2.5)], "id int, z double"))
    assert rows(table.snapshot(), "id", "v", "w", "z") == sorted(
        [(1, "a", None, None), (2, "b2", True, None), (3, "c", None, None), (8, None, None, 2.5)], key=repr)


def test_catalog_follows(spark, path, rows):
    table = make(spark, path, catalog_name="predia_test_table")
    assert rows(spark.table("predia_test_table"), "id") == [(1,), (2,), (3,)]
    table.upsert(spark.createDataFrame([(7, "x", 1, 9)], f"{SCHEMA}, w int"))
    table.delete(spark.createDataFrame([(2,)], "id int"))
    assert rows(spark.table("predia_test_table"), "id", "w") == [(1, None), (3, None), (7, 9)]
    table.overwrite(spark.createDataFrame([(5, "n", 1)], SCHEMA))
    assert rows(spark.table("predia_test_table"), "id") == [(5,)]
    spark.sql("DROP TABLE predia_test_table")


def test_incremental_reader(spark, path, rows):
    table = make(spark, f"{path}/t")
    reader = IncrementalReader(table, f"{path}/state", "t")
    assert reader.read().count() == 3
    assert reader.read().count() == 3, "nothing is lost before the read is acknowledged"
    reader.acknowledge()
    assert reader.read().count() == 0
    for i in (0, 59):
        table.upsert(spark.createDataFrame([(1, f"v{i}", i), (100 + i, "n", i)], SCHEMA), ["t"])
    table.apply_changes(spark.createDataFrame([(2, "d", 9, "D")], FEED), ["t"])
    assert rows(reader.read(), "id", "v", "t") == [(1, "v59", 59), (100, "n", 0), (159, "n", 59)]
    reader.acknowledge()
    assert reader.read().count() == 0
    table.append(spark.createDataFrame([(500, "m", 1)], SCHEMA))
    assert rows(reader.read(), "id") == [(500,)]
    reader.reset()
    assert rows(reader.read(), "id") == [(1,), (100,), (159,), (3,), (500,)]
    with pytest.raises(MissingTableError):
        IncrementalReader(KeyedTable(spark, f"{path}/none", "id"), path).read()


def test_the_feed_names_deleted_rows(spark, path, rows):
    table = make(spark, f"{path}/t")
    reader = IncrementalReader(table, f"{path}/state", "t")
    assert rows(reader.read(deletes=True), "id", "_deleted") == [(1, False), (2, False), (3, False)]
    reader.acknowledge()
    assert reader.read(deletes=True).count() == 0
    table.apply_changes(spark.createDataFrame([(1, "u", 5, "U"), (2, "", 5, "D"), (77, "", 5, "D")], FEED), ["t"])
    table.upsert(spark.createDataFrame([(1, "u2", 6, True), (9, "n", 6, False)], f"{SCHEMA}, w boolean"), ["t"])
    table.append(spark.createDataFrame([(10, "x", 1)], SCHEMA))
    table.delete(spark.createDataFrame([(9,)], "id int"))
    found = rows(reader.read(deletes=True), "id", "v", "w", "_deleted")
    assert found == [(1, "u2", True, False), (10, "x", None, False), (2, "b", None, True), (9, "n", False, True)]
    reader.acknowledge()
    table.overwrite(spark.createDataFrame([(3, "c", 1), (10, "y", 9)], SCHEMA))
    found = rows(reader.read(deletes=True), "id", "v", "_deleted")
    assert found == [(1, None, True), (10, "y", False), (3, "c", False)]
    reader.acknowledge()
    table.upsert(spark.createDataFrame([(3, "d", 2)], SCHEMA), ["t"])
    assert rows(table.images(reader.last_processed()), "id", "v", "_image") == [(3, "c", "before"), (3, "d", "after")]
    seen = reader.last_processed()
    table.forget_feed(table.last_commit())
    with pytest.raises(FeedGoneError):
        table.changed_rows(seen)


def test_only_the_folders_of_new_commits_are_read(spark, path):
    table = make(spark, path)
    for i in range(4):
        table.upsert(spark.createDataFrame([(i, "x", i)], SCHEMA), ["t"], commit=f"9000000000000000{i}")
    read = {f.split(f"{COMMIT}=")[1].split("/")[0] for f in table.images("90000000000000001").inputFiles()}
    assert read == {"90000000000000002", "90000000000000003"}


def test_ten_small_batches_write_little_more_than_what_they_touch(spark, path):
    table = KeyedTable(spark, path, "id", buckets=16)
    table.overwrite(spark.range(200_000).selectExpr("id", "sha2(CAST(id AS STRING), 256) AS v", "1 AS t"))
    written = []
    put = table._put
    touched = sum(f.stat().st_size for f in pathlib.Path(path).rglob("*.parquet")) / 16
    table._put = lambda df, folder, *args, **kwargs: (put(df, folder, *args, **kwargs), written.append(folder))
    for i in range(10):
        table.apply_changes(spark.createDataFrame([(i, "u", 2, "U")], "id long, v string, t int, Op string"), ["t"])
    feed = sum(f.stat().st_size for f in pathlib.Path(f"{path}/feed").rglob("*.parquet"))
    assert len(written) == 10 and feed < 0.2 * 10 * touched


def test_a_part_is_read_only_where_a_change_lies(spark, path):
    table = KeyedTable(spark, path, "id", buckets=16)
    table.overwrite(spark.range(2000).selectExpr("id", "1 AS t"))
    table.upsert(spark.createDataFrame([(1, 2)], "id long, t int"), ["t"])
    state = table._state()
    feed = table._read_feed(state, [state["commit"]]).where("_image IN ('before', 'after')")
    plan = _pruned(table._stored(state), feed)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_a_small_file_is_replaced_at_once(spark, path):
    for text in ("one", "two"):
        files.write_text(spark, f"{path}/x.json", text)
        assert files.read_text(spark, f"{path}/x.json") == text
    assert not files.exists(spark, f"{path}/x.json.part")


# Curated tables

def raw(spark, data):
    return spark.createDataFrame(data, "Op string, id int, name string, field_timestamp string")


def test_full_load_then_changes(spark, path, rows):
    job = JobConfig(f"{path}/raw", f"{path}/lake", "r", "db", "p_", "_tb")
    source = job.source("shop", "usuario")
    feed_files(raw(spark, [("I", 1, " a ", "2024-01-01 00:00:00"), ("I", 2, "", "2024-01-01 00:00:00")]), source, "LOAD")
    feed_files(raw(spark, [
        ("U", 1, "x ", "2024-01-02 00:00:00"), ("D", 1, "x", "2024-01-02 00:00:00"),
        ("I", 3, "  ", "2024-01-02 00:00:00")]), source, "20240102-")
    assert load_all(spark, job, "fl").keys() == {("shop", "usuario")}
    table = curated_table(spark, job, "shop", "usuario")
    first = dt.datetime(2024, 1, 1)
    assert rows(table.snapshot(), "id", "name", "transaction_date_time") == [(1, "a", first), (2, None, first)]
    load_table(spark, job, "shop", "usuario", "cdc")
    assert rows(table.snapshot(), "id", "name") == [(2, None), (3, "")]
    with pytest.raises(ExceptionGroup) as failed:
        load_all(spark, job, "cdc", [("shop", "rol"), ("shop", "usuario")])
    assert len(failed.value.exceptions) == 1, "the other table was loaded all the same"
    assert load_table(spark, job, "shop", "usuario", "cdc") is None, "no new file"
    feed_files(raw(spark, [("I", 1, "back", "2024-01-03 00:00:00"), ("U", 2, "old", "2023-01-01 00:00:00")]), source,
               "20240103-")
    assert load_table(spark, job, "shop", "usuario", "cdc", guard_late=True) == table.last_commit()
    assert rows(table.snapshot(), "id", "name") == [(1, "back"), (2, None), (3, "")]
    assert "p_usuario_tb" in table.path and set(table.snapshot().columns) == {"id", "name", "transaction_date_time"}


def test_full_load_files_without_envelope_and_no_change_files(spark, path, rows):
    job = JobConfig(f"{path}/raw", f"{path}/lake")
    source = job.source("shop", "rol")
    feed_files(raw(spark, [("I", 1, "a", "2024-01-01")]).drop("Op"), source, "LOAD")
    with pytest.raises(MissingTableError):
        load_table(spark, job, "shop", "rol", "cdc")
    load_table(spark, job, "shop", "rol", "fl")
    assert load_table(spark, job, "shop", "rol", "cdc") is None
    feed_files(raw(spark, [("D", 1, "a", "2024-01-02"), ("I", 2, "b", "2024-01-02")]), source, "20240102-")
    load_table(spark, job, "shop", "rol", "cdc")
    assert rows(curated_table(spark, job, "shop", "rol").snapshot(), "id", "name") == [(2, "b")]


def test_batches_of_a_stream_are_planned_adaptively(spark, path):
    table = make(spark, f"{path}/t")
    deliver(spark, f"{path}/landing", [(1, "u", 2, "U")], "2024-a-")
    plans = []

    def look(batch):
        plans.append(batch.groupBy("id").count()._jdf.queryExecution())
        return batch

    start(spark, path, table, prepare=look).awaitTermination()
    assert "AdaptiveSparkPlan" in plans[0].executedPlan().toString()


def test_mapped_loads(spark, path, rows):
    spark.createDataFrame([("1", "x"), ("2", "y")], "n string, t string").write.parquet(f"{path}/in")
    mapping = {"a": {"old": {"name": "n", "type": "string"}, "new": {"name": "id", "type": "int"}}}
    table = run_mapped_load(spark, f"{path}/in", f"{path}/out", "parquet", "id", mapping,
                            step=lambda df: df.withColumn("twice", F.col("id") * 2))
    assert rows(table.snapshot()) == [(1, 2), (2, 4)]
    configured = run_configured_load(spark, f"{path}/in", f"{path}/out2", "parquet", TableConfig("key"), create_key=True)
    assert rows(configured.snapshot(), "n", "t") == [("1", "x"), ("2", "y")]


# Streams

def deliver(spark, path, data, prefix):
    feed_files(spark.createDataFrame(data, FEED).coalesce(1), path, prefix)


def start(spark, path, table, **kwargs):
    arriving = read_new_files(spark, f"{path}/landing", FEED)
    return stream_changes(arriving, table, ["t"], f"{path}/checkpoint", **kwargs)


def test_stream_reads_each_file_once_over_restarts(spark, path, rows):
    table = make(spark, f"{path}/t")
    deliver(spark, f"{path}/landing", [(9, "skipped", 1, "I")], "LOAD")
    deliver(spark, f"{path}/landing", [(1, "u", 2, "U"), (2, "d", 2, "D")], "2024-a-")
    start(spark, path, table).awaitTermination()
    assert rows(table.snapshot()) == [(1, "u", 2), (3, "c", 1)]
    commit = table.last_commit()
    start(spark, path, table).awaitTermination()
    assert table.last_commit() == commit, "no new file, no new commit"
    deliver(spark, f"{path}/landing", [(2, "back", 3, "I")], "2024-b-")
    start(spark, path, table).awaitTermination()
    assert rows(table.snapshot()) == [(1, "u", 2), (2, "back", 3), (3, "c", 1)]


def test_a_failed_batch_is_replayed_and_counts_once(spark, path, rows):
    table = make(spark, f"{path}/t")
    deliver(spark, f"{path}/landing", [(1, "u", 2, "U")], "2024-a-")
    apply = table.apply_changes

    def fail_after_commit(*args, **kwargs):
        apply(*args, **kwargs)
        raise RuntimeError("lost")

    table.apply_changes = fail_after_commit
    with pytest.raises(Exception, match="lost"):
        start(spark, path, table).awaitTermination()
    commit = table.last_commit()
    table.apply_changes = apply
    start(spark, path, table, prepare=lambda batch: curate(batch.withColumn("field_timestamp", F.lit("2024-01-01")))
          .drop("transaction_date_time")).awaitTermination()
    assert table.last_commit() == commit and rows(table.snapshot()) == [(1, "u", 2), (2, "b", 1), (3, "c", 1)]


# One reader for batches and streams

CSV_FULL = 'Op,id,v,field_timestamp\nI,1,a,2024-01-01 00:00:00\nI,2,b,2024-01-01 00:00:00\n'


def csv_job(spark, path, fmt="csv"):
    job = JobConfig(f"{path}/raw", f"{path}/lake", file_format=fmt)
    return job, job.source("shop", "rol")


def test_csv_changes_have_no_header_row_and_keep_their_quotes(spark, path, rows):
    job, source = csv_job(spark, path)
    files.write_text(spark, f"{source}/LOAD1.csv", CSV_FULL)
    files.write_text(spark, f"{source}/20240102-1.csv",
                     'Op,id,v,field_timestamp\nU,1,"x, ""y""",2024-01-02 00:00:00\nD,2,b,2024-01-02 00:00:00\n')
    load_table(spark, job, "shop", "rol", "fl")
    load_table(spark, job, "shop", "rol", "cdc")
    table = curated_table(spark, job, "shop", "rol")
    assert rows(table.snapshot(), "id", "v") == [("1", 'x, "y"')]
    files.write_text(spark, f"{source}/20240103-1.csv", 'field_timestamp,extra,id,Op\n2024-01-03 00:00:00,e,3,I\n')
    load_table(spark, job, "shop", "rol", "cdc")
    assert rows(table.snapshot(), "id", "v", "extra") == sorted([("1", 'x, "y"', None), ("3", None, "e")], key=repr)


def csv_table(spark, path, sep=",", **entries):
    job = JobConfig(f"{path}/raw", f"{path}/lake", file_format="csv", mappings=f"{path}/mappings")
    files.write_text(spark, f"{path}/mappings/mapping_t.json", json.dumps({"primary_key": "id", **entries}))
    files.write_text(spark, f"{path}/raw/s/t/LOAD1.csv", "id,text,field_timestamp\n1,a,2024-01-01 00:00:00\n".replace(",", sep))
    load_table(spark, job, "s", "t", "fl")
    return job


def test_a_line_break_in_a_csv_change_stays_in_its_row(spark, path, rows):
    job = csv_table(spark, path)
    files.write_text(spark, f"{path}/raw/s/t/20240102-1.csv",
                     'Op,id,text,field_timestamp\nU,1,"two\nlines",2024-01-02 00:00:00\n')
    load_table(spark, job, "s", "t", "cdc")
    assert rows(curated_table(spark, job, "s", "t").snapshot(), "id", "text") == [("1", "two\nlines")]


def test_an_unknown_operation_ends_the_run_before_anything_moves(spark, path, rows):
    job = csv_table(spark, path)
    file = f"{path}/raw/s/t/20240102-1.csv"
    files.write_text(spark, file, "Op,id,text,field_timestamp\nX,1,b,2024-01-02 00:00:00\nU,2,c,2024-01-02 00:00:00\n")
    with pytest.raises(Exception, match="unknown operation in Op: X"):
        load_table(spark, job, "s", "t", "cdc")
    assert rows(curated_table(spark, job, "s", "t").snapshot(), "id", "text") == [("1", "a")]
    files.write_text(spark, file, "Op,id,text,field_timestamp\nD,1,b,2024-01-02 00:00:00\nU,2,c,2024-01-02 00:00:00\n")
    load_table(spark, job, "s", "t", "cdc")
    assert rows(curated_table(spark, job, "s", "t").snapshot(), "id", "text") == [("2", "c")]


def test_reader_options_and_layout_come_from_the_configuration(spark, path, rows):
    job = csv_table(spark, path, ";", read_options={"sep": ";"}, buckets=3, write_options={"compression": "zstd"})
    files.write_text(spark, f"{path}/raw/s/t/LOAD1.csv", "id;text;field_timestamp\n1;a,b;2024-01-01 00:00:00\n")
    load_table(spark, job, "s", "t", "fl")
    files.write_text(spark, f"{path}/raw/s/t/20240102-1.csv",
                     'Op;id;text;field_timestamp\nU;2;"c;\nd";2024-01-02 00:00:00\n')
    load_table(spark, job, "s", "t", "cdc")
    table = curated_table(spark, job, "s", "t")
    assert rows(table.snapshot(), "id", "text") == [("1", "a,b"), ("2", "c;\nd")]
    assert table.buckets == 3 and table._state()["buckets"] == 3 and table.write_options["compression"] == "zstd"
    for wrong in ({"buckets": 0}, {"buckets": "4"}, {"read_options": "x"}):
        with pytest.raises(ConfigError):
            TableConfig.parse({"primary_key": "id", **wrong})


def test_a_batch_takes_a_bounded_number_of_files(spark, path, rows, monkeypatch):
    job = csv_table(spark, path)
    for i in range(5):
        files.write_text(spark, f"{path}/raw/s/t/20240102-{i}.csv",
                         f"Op,id,text,field_timestamp\nU,{i},new,2024-01-02 00:00:0{i}\n")
    monkeypatch.setattr(change_stream, "MOST_FILES", 2)
    load_table(spark, job, "s", "t", "cdc")
    table = curated_table(spark, job, "s", "t")
    assert rows(table.snapshot(), "id") == [(str(i),) for i in range(5)]
    assert table.last_commit().endswith(f"{2:012d}")


def test_state_drops_late_changes_and_passes_on_what_moved(spark, path, rows):
    table = KeyedTable(spark, f"{path}/t", "id")
    seen = []
    merge = table.merge
    table.merge = lambda written, gone, commit: (
        seen.append((rows(written, "id"), rows(gone, "id"))), merge(written, gone, commit))

    def run(*deliveries):
        for name, data in deliveries:
            feed_files(spark.createDataFrame(data, FEED).coalesce(1), f"{path}/landing", name)
        arriving = read_new_files(spark, f"{path}/landing", FEED)
        stream_latest(arriving, table, ["t"], f"{path}/checkpoint", partitions=2).awaitTermination()
        return rows(table.snapshot(), "id", "v", "t")

    assert run(("2024-1-", [(1, "a", 5, "I"), (2, "b", 5, "I"), (3, "c", 5, "I")])) == [(1, "a", 5), (2, "b", 5), (3, "c", 5)]
    commit = table.last_commit()
    assert run(("2024-2-", [(1, "late", 3, "U"), (2, "", 6, "D"), (4, "n", 1, "I"), (3, "", 4, "D")])) == [
        (1, "a", 5), (3, "c", 5), (4, "n", 1)]
    assert seen == [([(4,)], [(2,)])], "late changes of 1 and 3 are not passed on"
    assert run(("2024-3-", [(2, "back", 5, "U"), (4, None, 2, None)])) == [(1, "a", 5), (3, "c", 5), (4, "n", 1)]
    assert run(("2024-4-", [(2, "back", 7, "U"), (1, "w", 5, "U"), (1, "z", 5, "D")])) == [
        (2, "back", 7), (3, "c", 5), (4, "n", 1)]
    assert table.last_commit().split("-")[0] == commit.split("-")[0]
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    with pytest.raises(Exception, match="unknown operation"):
        run(("2024-5-", [(9, "x", 9, "X")]))
    assert rows(table.snapshot(), "id") == [(2,), (3,), (4,)]


def test_json_changes_are_unwrapped(spark, path, rows):
    job, source = csv_job(spark, path, "json")
    files.write_text(spark, f"{source}/LOAD1.json",
                     '{"id": [{"Op": "I", "id": 1, "v": "a", "field_timestamp": "2024-01-01 00:00:00"},\n'
                     '{"Op": "I", "id": 2, "v": "b", "field_timestamp": "2024-01-01 00:00:00"}]}')
    files.write_text(spark, f"{source}/20240102.json",
                     '{"id":\n{"Op": "D", "id": 2, "v": "b", "field_timestamp": "2024-01-02 00:00:00"}}')
    load_table(spark, job, "shop", "rol", "fl")
    load_table(spark, job, "shop", "rol", "cdc")
    assert rows(curated_table(spark, job, "shop", "rol").snapshot(), "id", "v") == [(1, "a")]


@pytest.mark.parametrize("fault", ["no operation", "other type"])
def test_what_cannot_be_applied_is_not_taken(spark, path, rows, fault):
    """A delivery without operations, or of other types, ends the run; mended, it is applied."""
    job, source = csv_job(spark, path, "parquet")
    feed_files(raw(spark, [("I", 1, "a", "2024-01-01")]), source, "LOAD")
    load_table(spark, job, "shop", "rol", "fl")
    table = curated_table(spark, job, "shop", "rol")
    good = raw(spark, [("U", 1, "x", "2024-01-02")])
    feed_files(good.drop("Op") if fault == "no operation" else good.withColumn("name", F.lit(7)), source, "20240102-")
    for _ in range(2):
        with pytest.raises(Exception, match="lack the columns|other types"):
            load_table(spark, job, "shop", "rol", "cdc")
        assert rows(table.snapshot(), "id", "name") == [(1, "a")]
    for name in files.matches(spark, f"{source}/2024*"):
        files.delete(spark, name)
    feed_files(good, source, "20240102-mended-")
    load_table(spark, job, "shop", "rol", "cdc")
    assert rows(table.snapshot(), "id", "name") == [(1, "x")]


def test_columns_of_several_new_files_are_joined(spark, path, rows):
    job, source = csv_job(spark, path, "parquet")
    feed_files(raw(spark, [("I", 1, "a", "2024-01-01"), ("I", 2, "b", "2024-01-01")]), source, "LOAD")
    load_table(spark, job, "shop", "rol", "fl")
    feed_files(raw(spark, [("U", 1, "x", "2024-01-02")]), source, "20240102-")
    feed_files(raw(spark, [("U", 2, "y", "2024-01-02")]).withColumn("w", F.lit(5)), source, "20240103-")
    load_table(spark, job, "shop", "rol", "cdc")
    assert rows(curated_table(spark, job, "shop", "rol").snapshot(), "id", "name", "w") == sorted(
        [(1, "x", None), (2, "y", 5)], key=repr)


def test_key_is_checked_before_a_full_load(spark, path):
    job, source = csv_job(spark, path, "parquet")
    feed_files(spark.createDataFrame([("I", 1, "2024-01-01")], "Op string, codigo int, field_timestamp string"), source, "LOAD")
    with pytest.raises(ConfigError, match="no column id"):
        load_table(spark, job, "shop", "rol", "fl")
    configured = JobConfig(job.source_root, job.target_root, mappings=f"{path}/mappings")
    files.write_text(spark, f"{path}/mappings/mapping_rol.json", '{"primary_key": "codigo"}')
    assert load_table(spark, configured, "shop", "rol", "fl")


def test_changes_after_the_last_delivery_are_found(spark, tmp_path, rows):
    """The last delivery of the feed has no end."""
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    later = events.limit(1).withColumns({
        "ts": F.lit("2025-03-01 00:00:00").cast("timestamp_ntz").cast(events.schema["ts"].dataType),
        "event_type": F.lit("view"), "user_id": F.lit(987654321).cast("long"), "event_id": F.lit(99_999_999).cast("long")})
    events.unionByName(later).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    found = QUERIES["cdc_merge_on_read"](spark, str(tmp_path))
    assert found.where("user_id = 987654321").count() == 1


def test_a_session_of_the_caller_keeps_its_settings(spark):
    before = dict(spark.conf.getAll.items())
    QUERIES["dates_as_text"](spark, "/root/testdata/sf0.001").count()
    assert dict(spark.conf.getAll.items()) == before
    with sized(spark.read.parquet("/root/testdata/sf0.001/orders.parquet")):
        assert int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")) >= 1
    assert dict(spark.conf.getAll.items()) == before


def test_stream_needs_a_loaded_table(spark, path):
    spark.createDataFrame([], FEED).write.parquet(f"{path}/landing")
    with pytest.raises(MissingTableError):
        start(spark, path, KeyedTable(spark, f"{path}/t", "id"))


def test_commits_are_stamped_on_rows(spark, path, rows):
    table = make(spark, path)
    table.upsert(spark.createDataFrame([(1, "x", 2)], SCHEMA))
    stamps = {r.id: r[COMMIT] for r in table.rows().collect()}
    assert stamps[1] > stamps[2] == stamps[3]


def test_scratch_folder_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(f"{root}/") and scratch_path(spark, "x") != scratch_path(spark, "x")


class FakeSession:
    """Only the settings of a session."""

    def __init__(self, **settings):
        self.conf = self
        self.settings = settings

    def get(self, name, default=None):
        return self.settings.get(name.replace(".", "_"), default)


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(FakeSession(spark_master="yarn"), "x")
    shared = FakeSession(spark_master="yarn", spark_checkpoint_dir="hdfs:///shared/")
    assert scratch_path(shared, "x").startswith("hdfs:///shared/predia/x-")
    assert scratch_path(FakeSession(spark_master="local[2]"), "x").startswith("/")


def test_jobs_run_together_and_all_failures_are_raised(spark):
    def fail(text):
        raise ValueError(text)

    assert run_together(spark, {n: lambda n=n: spark.range(n).count() for n in (1, 2, 3)}, 2) == {1: 1, 2: 2, 3: 3}
    with pytest.raises(ExceptionGroup) as failed:
        run_together(spark, {1: lambda: fail("a"), 2: lambda: 2, 3: lambda: fail("c")}, 1)
    assert [str(e) for e in failed.value.exceptions] == ["a", "c"]


def test_csv_of_a_large_table_is_written_by_many_tasks(spark, path, rows):
    texts = spark.range(40).selectExpr("id AS doc_id", "concat('a \"', id, '\",\n', repeat('x', 200)) AS text", "'web' AS source")
    texts.repartition(4).write.parquet(f"{path}/documents.parquet")
    root = pathlib.Path(spark.conf.get("spark.checkpoint.dir")) / "predia"
    known = set(root.glob("csv-split-*"))
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(64 << 20))
    try:
        found = QUERIES["csv_line_breaks_split"](spark, path)
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    written, = set(root.glob("csv-split-*")) - known
    assert len(list(written.glob("part-*.csv"))) == 4
    assert rows(found) == rows(texts.withColumn("doc_id", F.col("doc_id").cast("string")))


def test_splits_are_counted_with_the_first_line_of_each_file_only(spark, rows):
    lines = spark.createDataFrame(
        [("f", 0, 5, "a,b", 0), ("f", 0, 6, '"x', 1), ("f", 9, 7, 'y",2', 1), ("g", 0, 8, "", 0)],
        "file string, block long, at long, line string, odd long")
    assert rows(counted_blocks(lines)) == [("f", 0, 1, "a,b"), ("f", 9, 1, None), ("g", 0, 0, "")]
