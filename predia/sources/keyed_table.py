"""Keyed tables as partitioned parquet, rewritten partition by partition.

A table is one folder of parquet, partitioned by ``_part``: the text of the configured partition column, or a hash
bucket of the key. A batch of changes is settled to one row per key, and only the partitions that hold a changed key
are read, merged and written again, with Spark's dynamic partition overwrite. There is one copy of the table; nothing
has to be compacted or cleaned.

A batch is first written to the table's change feed: one folder per commit, with the rows as they were before and as they
are after. The partitions are then merged from there, so a batch that dies while they are written is finished by the next
use of the table, and one that dies earlier has changed nothing. A reader that asks for changes reads the folders of the
commits it has not seen, and learns of deleted rows too. While a batch is written, a reader of the table may see some
partitions before and others after it. Where the session offers a lakehouse format, feed the settled changes to its MERGE
instead.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from predia.operators.changes import DELETE, hard_delete, settle_changes, strip_envelope, without_late
from predia.operators.cleaning import quoted
from predia.operators.enrich import union_branches
from predia.operators.latest import newest_rows, one_per_key
from predia.session import measured_broadcasts, sized
from predia.sources import files

COMMIT = "_commit_time"
DELETED = "_deleted"
PART = "_part"
IMAGE = "_image"
BEFORE, AFTER = "before", "after"
METHODS = ("cdc", "fl", None)


class MissingTableError(RuntimeError):
    """Changes for a table that was never loaded."""

    def __init__(self, path: str):
        super().__init__(f"no table at {path}: load it in full before changes are applied")


class FeedGoneError(RuntimeError):
    """Changes were asked for from a commit whose feed is no longer kept."""


class KeyedTable:
    """A table with one current row per key.

    ``buckets`` is the number of parts of a table without partition column, kept with the table from its first load:
    choose it so that a part has a few gigabytes. ``catalog_name`` keeps a table of the session's catalog up to date.
    """

    def __init__(
        self, spark: SparkSession, path: str, keys: str | Iterable[str] = (), partition_by: str | None = None,
        buckets: int = 16, write_options: Mapping[str, str] | None = None, catalog_name: str | None = None,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = [keys] if isinstance(keys, str) else list(keys)
        self.partition_by = partition_by
        self.buckets = buckets
        self.catalog_name = catalog_name
        # Free options come last and overwrite the defaults.
        self.write_options = {"compression": "gzip", **(write_options or {})}

    # State: one small file

    def _state(self) -> dict | None:
        if not files.exists(self.spark, f"{self.path}/_table.json"):
            return None
        return json.loads(files.read_text(self.spark, f"{self.path}/_table.json"))

    def _loaded(self) -> dict:
        """The state, after a batch that died half way is finished."""
        state = self._state()
        if state is None:
            raise MissingTableError(self.path)
        if "pending" in state:
            state = self._finish(state)
        return state

    def _save(self, state: dict) -> dict:
        files.write_text(self.spark, f"{self.path}/_table.json", json.dumps(state))
        return state

    def exists(self) -> bool:
        return self._state() is not None

    def last_commit(self) -> str | None:
        state = self._state()
        return state and state["commit"]

    def new_commit(self) -> str:
        """The clock in milliseconds as digits, always after the last commit."""
        now = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d%H%M%S%f")[:-3]
        last = (self.last_commit() or "0").split("-")[0]
        return max(now, str(int(last) + 1).zfill(len(now)))

    # Reading

    def _read(self, state: dict, folder: str) -> DataFrame:
        schema = T.StructType.fromJson(state["schema"]).add(PART, T.StringType())
        if not files.exists(self.spark, folder):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", folder).parquet(folder)

    def _stored(self, state: dict) -> DataFrame:
        return self._read(state, f"{self.path}/{state['folder']}")

    def rows(self) -> DataFrame:
        """Current rows with the commit that wrote them."""
        return self._stored(self._loaded()).drop(PART)

    def snapshot(self) -> DataFrame:
        return self.rows().drop(COMMIT)

    def changes_since(self, commit: str | None, until: str | None = None) -> DataFrame:
        """Rows written after one commit, up to another; all current rows when ``commit`` is None.

        Deleted rows are not in it.
        """
        rows = self.rows()
        if commit is not None:
            rows = rows.where(quoted(COMMIT) > commit)
        return rows if until is None else rows.where(quoted(COMMIT) <= until)

    def changed_rows(self, commit: str | None, until: str | None = None) -> DataFrame:
        """Rows that changed after one commit, up to another, as they are now, and the keys of deleted rows.

        ``_deleted`` tells them apart; of a deleted row the other columns hold what was there last, as far as it is
        known. All current rows when ``commit`` is None. Only the feed of the new commits is read, but after a full
        load in between the whole table.
        """
        state = self._loaded()
        until = until or state["commit"]
        if commit is None:
            return self.rows().withColumn(DELETED, F.lit(False))
        if commit < state.get("feed_from", state["commit"]):
            raise FeedGoneError(f"the changes of {self.path} after {commit} are no longer kept")
        images = self.images(commit, until)
        if state.get("full", "") > commit:
            rows = self.rows().where(quoted(COMMIT) <= until)
            gone = one_per_key(images.where(quoted(IMAGE) == BEFORE), self.keys, [COMMIT]).drop(IMAGE)
            gone = hard_delete(gone, rows, self.keys)
            return union_branches(rows.withColumn(DELETED, F.lit(False)), gone.withColumn(DELETED, F.lit(True)))
        last = newest_rows(images.withColumn(DELETED, quoted(IMAGE) == BEFORE).withColumn("_written", ~quoted(DELETED)),
                           self.keys, [COMMIT, "_written"])
        return last.drop(IMAGE, "_written")

    def images(self, commit: str, until: str | None = None) -> DataFrame:
        """The feed after one commit, up to another: rows as they were before a commit and as they were after it."""
        state = self._loaded()
        names = [f for f in self._feed_commits() if commit < f <= (until or state["commit"])]
        return self._read_feed(state, names).drop(PART)

    def forget_feed(self, commit: str) -> None:
        """Drop the feed up to a commit that every reader has seen."""
        state = self._loaded()
        self._save({**state, "feed_from": max(commit, state.get("feed_from", ""))})
        for name in self._feed_commits():
            if name <= commit:
                files.delete(self.spark, self._feed(name))

    def _feed(self, commit: str) -> str:
        return f"{self.path}/feed/{COMMIT}={commit}"

    def _feed_commits(self) -> list[str]:
        return [f.split("=", 1)[1] for f in files.folders(self.spark, f"{self.path}/feed") if f.startswith(f"{COMMIT}=")]

    def _read_feed(self, state: dict, commits: list[str]) -> DataFrame:
        """Feed rows of the listed commits; only their folders are listed."""
        schema = T.StructType.fromJson(state["schema"]).add(PART, T.StringType()).add(IMAGE, T.StringType())
        if not commits:
            return self.spark.createDataFrame([], schema)
        stored = T.StructType([f for f in schema if f.name != COMMIT]).add(COMMIT, T.StringType())
        reader = self.spark.read.schema(stored).option("basePath", f"{self.path}/feed")
        return reader.parquet(*[self._feed(c) for c in commits]).select(*[quoted(f.name) for f in schema])

    def _write_feed(self, rows: DataFrame, commit: str) -> bool:
        """Write a commit's feed, in place of one that a batch left that came to nothing; whether it has rows."""
        last = self.last_commit() or ""
        for name in self._feed_commits():
            if name > last:
                files.delete(self.spark, self._feed(name))
        with sized(rows), measured_broadcasts(rows):
            rows.drop(COMMIT).write.options(**self.write_options).mode("overwrite").parquet(self._feed(commit))
        written = self.spark.read.schema(f"{IMAGE} string").parquet(self._feed(commit))
        if written.isEmpty():
            files.delete(self.spark, self._feed(commit))
            return False
        return True

    # Writing

    def _part(self, state: Mapping) -> Column:
        """Where a row lies. Never empty or null, so it can name a folder; the column itself stays as it is."""
        if state["partition_by"]:
            return F.coalesce(F.concat(F.lit("="), quoted(state["partition_by"]).cast("string")), F.lit("null"))
        if self._one_part(state):
            return F.lit("0")
        return F.pmod(F.xxhash64(*[quoted(k) for k in self.keys]), F.lit(state["buckets"])).cast("string")

    def _one_part(self, state: Mapping) -> bool:
        return not state["partition_by"] and state["buckets"] == 1

    def _put(self, df: DataFrame, folder: str, mode: str = "overwrite", spread: bool = True, **options: str) -> None:
        # Rebalance brings a partition's rows together for few files, and splits a partition that is too large. Rows that
        # all go to one part are written as they come: nothing is to be brought together, and Spark sorts nothing.
        with sized(df):
            ((df.hint("rebalance", PART) if spread else df).write.mode(mode).partitionBy(PART)
             .options(**self.write_options, **options).parquet(folder))

    def overwrite(self, df: DataFrame, commit: str | None = None) -> str | None:
        """Full load: the rows of ``df``, envelope removed, become the table; nothing happens for no rows."""
        before = self._state()
        if before and "pending" in before:
            before = self._loaded()
        commit = commit or self.new_commit()
        rows = strip_envelope(df).withColumn(COMMIT, F.lit(commit))
        state = {"commit": commit, "folder": f"rows-{commit}", "schema": json.loads(rows.schema.json()), "full": commit,
                 "feed_from": before["feed_from"] if before and "feed_from" in before else commit,
                 "partition_by": self.partition_by, "buckets": self.buckets}
        folder = f"{self.path}/{state['folder']}"
        self._put(rows.withColumn(PART, self._part(state)), folder, spread=not self._one_part(state))
        if not files.folders(self.spark, folder):
            files.delete(self.spark, folder)
            return None
        if before and self._same_keys(before, state):
            gone = hard_delete(self._stored(before), self._stored(state), self.keys).select(*self.keys, PART)
            self._write_feed(gone.withColumn(IMAGE, F.lit(BEFORE)), commit)
        else:
            state["feed_from"] = commit
        self._save(state)
        if before and before["folder"] != state["folder"]:
            files.delete(self.spark, f"{self.path}/{before['folder']}")
        self._follow(state)
        return commit

    def append(self, df: DataFrame, commit: str | None = None) -> str | None:
        """Add rows without looking at their keys; only they are written."""
        if not self.exists():
            return self.overwrite(df, commit)
        state = self._loaded()
        commit = commit or self.new_commit()
        rows = strip_envelope(df).withColumn(COMMIT, F.lit(commit))
        if rows.isEmpty():
            return None
        state = self._widened(state, rows)
        placed = rows.withColumn(PART, self._part(state))
        self._write_feed(placed.withColumn(IMAGE, F.lit(AFTER)), commit)
        self._put(self._read_feed(state, [commit]).drop(IMAGE), f"{self.path}/{state['folder']}", "append")
        self._follow(self._save({**state, "commit": commit}))
        return commit

    def _widened(self, state: dict, rows: DataFrame) -> dict:
        """The state with the columns that the table does not have yet; a column of another type is an error."""
        known = {f["name"]: f["type"] for f in state["schema"]["fields"]}
        clashes = [f["name"] for f in json.loads(rows.schema.json())["fields"]
                   if f["name"] in known and f["type"] not in (known[f["name"]], "void")]
        if clashes:
            raise TypeError(f"{self.path} has other types for the columns {clashes}")
        added = [f for f in json.loads(rows.schema.json())["fields"] if f["name"] not in known]
        return {**state, "schema": {**state["schema"], "fields": [*state["schema"]["fields"], *added]}}

    def _same_keys(self, before: Mapping, after: Mapping) -> bool:
        """Whether two loads have the table's key columns, of the same types."""
        types = [{f["name"]: f["type"] for f in state["schema"]["fields"]} for state in (before, after)]
        return bool(self.keys) and all(k in types[0] and types[0][k] == types[1].get(k) for k in self.keys)

    def _change(self, changed: DataFrame, commit: str) -> str | None:
        """Write settled changes to the feed, then merge them into the partitions that hold their keys."""
        state = self._loaded()
        if state["commit"] == commit:  # a batch that is replayed although it was written
            return commit
        state = self._widened(state, changed.drop(DELETED).withColumn(COMMIT, F.lit(commit)))
        keys = changed.select(*self.keys)
        # A key that is written lies in one part, or may come from another one when the parts are not made of keys.
        stored = self._stored(state)
        places = changed if self._parts_of_keys(state) else _matching(stored.select(*self.keys, PART), keys, self.keys)
        parts = places.withColumn(PART, self._part(state)) if self._parts_of_keys(state) else places
        before = _matching(_pruned(stored, parts), keys, self.keys).withColumn(IMAGE, F.lit(BEFORE))
        written = changed.where(~quoted(DELETED)).drop(DELETED)
        after = union_branches(self._stored(state).drop(PART, COMMIT).limit(0), written)
        after = after.withColumn(PART, self._part(state)).withColumn(IMAGE, F.lit(AFTER))
        if not self._write_feed(union_branches(before.drop(COMMIT), after), commit):
            return None
        state = self._save({**state, "pending": {"commit": commit, "keys": self.keys}})
        self._follow(self._finish(state))
        return commit

    def _parts_of_keys(self, state: Mapping) -> bool:
        return not state["partition_by"] or state["partition_by"] in self.keys

    def _finish(self, state: dict) -> dict:
        """Merge the pending commit's feed into the table; doing so again gives the same table."""
        commit, keys, folder = state["pending"]["commit"], state["pending"]["keys"], f"{self.path}/{state['folder']}"
        feed = self._read_feed(state, [commit])
        # Which parts are read is known once the feed is: Spark prunes them by the distinct names.
        parts = feed.where(quoted(IMAGE).isin(BEFORE, AFTER))
        kept = hard_delete(_pruned(self._stored(state), parts), feed, keys)
        written = feed.where(quoted(IMAGE) == AFTER).drop(IMAGE)
        merged = union_branches(kept, written)
        with measured_broadcasts(merged):
            self._put(merged, folder, partitionOverwriteMode="dynamic")
        # Overwriting leaves partitions alone that have no row any more: those that only lost rows are looked at.
        lost = parts.select(PART).distinct().join(written.select(PART).distinct(), PART, "left_anti")
        still = hard_delete(_pruned(self._stored(state), lost), feed, keys).select(PART).distinct()
        with measured_broadcasts(lost):
            emptied = lost.join(still, PART, "left_anti").collect()
        for row in emptied:
            files.delete_partition(self.spark, folder, PART, row[PART])
        return self._save({**{k: v for k, v in state.items() if k != "pending"}, "commit": commit})

    def upsert(self, df: DataFrame, order: Iterable[str] = (), commit: str | None = None) -> str | None:
        """Insert or replace by key, of rows with one key the greatest by ``order``. A missing table is made."""
        rows = one_per_key(strip_envelope(df), self.keys, order)
        if not self.exists():
            return self.overwrite(rows, commit)
        return self._change(rows.withColumn(DELETED, F.lit(False)), commit or self.new_commit())

    def merge(self, rows: DataFrame, removed: DataFrame, commit: str | None = None) -> str | None:
        """Insert or replace rows, one per key, and remove other keys, in one commit."""
        gone = removed.select(*self.keys).withColumn(DELETED, F.lit(True))
        changed = union_branches(strip_envelope(rows).withColumn(DELETED, F.lit(False)), gone)
        return self._change(changed, commit or self.new_commit())

    def apply_changes(
        self, changes: DataFrame, order: Iterable[str], op: str = "Op", guard_late: bool = False,
        commit: str | None = None,
    ) -> str | None:
        """Apply a batch of a change feed to the loaded table."""
        state = self._loaded()
        missing = [c for c in (*self.keys, *order, op) if c not in changes.columns]
        if missing:
            raise ValueError(f"changes for {self.path} lack the columns {missing}")
        settled = settle_changes(changes, self.keys, order, op)
        if guard_late:
            settled = without_late(settled, self._stored(state), self.keys, order)
        settled = strip_envelope(settled.withColumn(DELETED, quoted(op) == DELETE).drop(op))
        return self._change(settled, commit or self.new_commit())

    def delete(self, removed: DataFrame, commit: str | None = None) -> str | None:
        """Remove keys."""
        gone = removed.select(*self.keys).distinct().withColumn(DELETED, F.lit(True))
        return self._change(gone, commit or self.new_commit())

    def write(
        self, df: DataFrame, method: str | None, order: Iterable[str] = (), commit: str | None = None, **kwargs
    ) -> str | None:
        """One entry for the three ways a job writes: ``fl`` overwrite, ``cdc`` changes, ``None`` upsert."""
        if method not in METHODS:
            raise ValueError(f"{method!r} is not one of {METHODS}")
        if method == "cdc":
            return self.apply_changes(df, order, commit=commit, **kwargs)
        if method == "fl":
            return self.overwrite(df, commit)
        return self.upsert(df, order, commit)

    # Catalog

    def register(self, name: str) -> None:
        """Publish the table in the session's catalog, and keep it up to date with every commit of this object."""
        self.catalog_name = name
        self._follow(self._loaded())

    def _follow(self, state: dict) -> None:
        """Point the catalog's table at the current folder, with its columns and partitions."""
        if not self.catalog_name:
            return
        name, folder = self.catalog_name, f"{self.path}/{state['folder']}"
        schema = T.StructType.fromJson(state["schema"]).add(PART, T.StringType())
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        if not self.spark.catalog.tableExists(name):
            self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({PART}) LOCATION '{folder}'")
        else:
            known = {c.lower() for c in self.spark.table(name).columns}
            added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name.lower() not in known)
            if added:
                self.spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({added})")
            self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        # A full load has a folder of its own: partitions that point elsewhere are dropped and found again.
        self.spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
        self.spark.catalog.refreshTable(name)


def _matching(stored: DataFrame, changed: DataFrame, keys: list[str]) -> DataFrame:
    """Stored rows of the changed keys; the changes are the side that Spark may broadcast."""
    names = [f"_key{i}" for i in range(len(keys))]
    asked = changed.select(*[quoted(k).alias(n) for k, n in zip(keys, names)])
    return stored.join(asked, [stored[k].eqNullSafe(F.col(n)) for k, n in zip(keys, names)], "left_semi")


def _pruned(stored: DataFrame, parts: DataFrame) -> DataFrame:
    """Stored rows of the parts that ``parts`` names; other parts are not read where these names are few."""
    return stored.join(parts.select(PART).distinct(), PART, "left_semi")
