"""Keyed tables in buckets that Spark's catalog knows, merged without shuffling what is stored.

Spark deals a bucketed table's rows out by the key when it writes them, and knows this layout when it reads them: a join
on the key shuffles the changes to the buckets, and neither shuffles nor sorts the stored rows. A merge is that join,
written as buckets again, so it costs one scan and one write of the table and a shuffle of the changes. Take it where
batches touch most of a table; where they touch little of it, ``KeyedTable`` rewrites less.

A merge writes a folder of its own and then points the catalog's table at it, so readers see the table before or after
a merge. The folder before is kept for readers that still read it, until the next merge.
"""

from __future__ import annotations

import contextlib
import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from predia.operators.changes import DELETE, settle_changes, strip_envelope
from predia.operators.cleaning import quoted
from predia.operators.latest import one_per_key
from predia.session import INITIAL_PARTITIONS
from predia.sources import files
from predia.sources.keyed_table import MissingTableError


class BucketedTable:
    """A catalog table with one row per key, bucketed and sorted by the key.

    ``buckets`` is kept with the table from its first load: choose it so that a bucket has about a gigabyte, which is
    what one task joins and writes. Keys are never null.
    """

    def __init__(
        self, spark: SparkSession, name: str, path: str, keys: str | Iterable[str], buckets: int = 200,
        write_options: Mapping[str, str] | None = None,
    ):
        self.spark = spark
        self.name = name
        self.path = path.rstrip("/")
        self.keys = [keys] if isinstance(keys, str) else list(keys)
        self.buckets = buckets
        self.write_options = dict(write_options or {})

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def rows(self) -> DataFrame:
        if not self.exists():
            raise MissingTableError(self.path)
        return self.spark.table(self.name)

    def load(self, df: DataFrame, order: Iterable[str] = ()) -> None:
        """Full load: of rows with one key the greatest by ``order``; they become the table."""
        rows = one_per_key(self._with_keys(strip_envelope(df)), self.keys, order)
        with self._layout(self.buckets):
            self._replace(rows.repartition(self.buckets, *map(quoted, self.keys)), self.buckets, anew=True)

    def merge(self, changes: DataFrame, order: Iterable[str], op: str = "Op", guard_late: bool = False) -> None:
        """Apply a batch of a change feed: the newest change of a key replaces, adds or removes its row.

        With ``guard_late`` a change older than the stored row does nothing. Columns that one side lacks are null there.
        """
        stored, order = self.rows(), list(order)
        buckets = self._stored_buckets()
        with self._layout(buckets):
            self._replace(self.merged(stored, changes, order, op, guard_late), buckets)

    def upsert(self, df: DataFrame, order: Iterable[str] = ()) -> None:
        """Insert or replace by key, of rows with one key the greatest by ``order``."""
        stored, buckets = self.rows(), self._stored_buckets()
        rows = one_per_key(self._with_keys(strip_envelope(df), stored), self.keys, order)
        with self._layout(buckets):
            self._replace(self._joined(stored, rows.withColumn("_op", F.lit("U")), [], False), buckets)

    def merged(self, stored: DataFrame, changes: DataFrame, order: list[str], op: str, guard_late: bool) -> DataFrame:
        """The rows of the table after a batch."""
        settled = settle_changes(self._with_keys(changes, stored), self.keys, order, op).withColumnRenamed(op, "_op")
        return self._joined(stored, strip_envelope(settled), order, guard_late)

    def _joined(self, stored: DataFrame, settled: DataFrame, order: list[str], guard_late: bool) -> DataFrame:
        types = {f.name: f.dataType for f in stored.schema}
        clashes = [f.name for f in settled.schema if f.name in types and f.name not in self.keys
                   and f.dataType.typeName() != "void" and f.dataType != types[f.name]]
        if clashes:
            raise TypeError(f"{self.name} has other types for the columns {clashes}")
        side = settled.select(*[quoted(c).alias(f"_new_{c}") for c in settled.columns])
        there = stored.withColumn("_there", F.lit(True))
        both = there.join(side, [stored[k] == quoted(f"_new_{k}") for k in self.keys], "full")
        taken = F.col("_new__op").isNotNull()
        if guard_late:
            late = F.struct(*[quoted(f"_new_{c}") for c in order]) < F.struct(*[quoted(c) for c in order])
            taken &= F.col("_there").isNull() | ~F.coalesce(late, F.lit(False))
        new = [c for c in settled.columns if c != "_op"]
        both = both.withColumn("_taken", taken).where(~F.col("_taken") | (F.col("_new__op") != DELETE))

        def value(column: str):
            ours = quoted(column) if column in types else F.lit(None)
            theirs = quoted(f"_new_{column}") if column in new else F.lit(None)
            return F.when(F.col("_taken"), theirs).otherwise(ours).alias(column)

        return both.select(*[value(c) for c in [*types, *[c for c in new if c not in types]]])

    def _with_keys(self, df: DataFrame, stored: DataFrame | None = None) -> DataFrame:
        """The rows, their keys of the stored type; one without a key ends the job.

        The keys are cast here, before the changes are settled, so that they are shuffled once, and the stored keys stay
        bare columns: with a cast around them Spark would no longer know where they lie.
        """
        missing = [k for k in self.keys if k not in df.columns]
        if missing:
            raise ValueError(f"rows for {self.name} lack the key columns {missing}")
        types = {f.name: f.dataType for f in (df if stored is None else stored).schema}
        return df.withColumns({
            k: F.coalesce(quoted(k).cast(types[k]), F.raise_error(F.lit(f"a row for {self.name} has no {k}")).cast(types[k]))
            for k in self.keys})

    @contextlib.contextmanager
    def _layout(self, buckets: int):
        """Shuffles have as many partitions as the table has buckets, and a bucket in one file is known to be sorted."""
        conf = self.spark.conf
        wanted = {"spark.sql.shuffle.partitions": str(buckets), INITIAL_PARTITIONS: str(buckets),
                  "spark.sql.legacy.bucketedTableScan.outputOrdering": "true"}
        before = {name: conf.get(name, None) for name in wanted}
        for name, value in wanted.items():
            conf.set(name, value)
        try:
            yield
        finally:
            for name, value in before.items():
                conf.unset(name) if value is None else conf.set(name, value)

    def _described(self) -> dict[str, str]:
        return {r["col_name"]: r["data_type"] for r in self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}").collect()}

    def _stored_buckets(self) -> int:
        return int(self._described()["Num Buckets"])

    def _replace(self, rows: DataFrame, buckets: int, anew: bool = False) -> None:
        """Write the rows into a folder of their own, then point the table at it."""
        moment = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d%H%M%S%f")
        folder, staged = f"rows-{moment}", f"{self.name}_staged"
        # What a merge left that died. Its table has a location of its own, so only the name goes here.
        self.spark.sql(f"DROP TABLE IF EXISTS {staged}")
        (rows.write.format("parquet").options(**self.write_options).option("path", f"{self.path}/{folder}")
         .bucketBy(buckets, *self.keys).sortBy(*self.keys).saveAsTable(staged))
        known = self.exists()
        before = self._described()["Location"].rstrip("/").rsplit("/", 1)[-1] if known else folder
        if known and not anew:
            have = {c.lower() for c in self.spark.table(self.name).columns}
            added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name.lower() not in have)
            if added:
                self.spark.sql(f"ALTER TABLE {self.name} ADD COLUMNS ({added})")
            self.spark.sql(f"ALTER TABLE {self.name} SET LOCATION '{self.path}/{folder}'")
            self.spark.sql(f"DROP TABLE {staged}")
        else:
            # A full load may have other columns and another layout.
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
            self.spark.sql(f"ALTER TABLE {staged} RENAME TO {self.name}")
        self.spark.catalog.refreshTable(self.name)
        for old in files.folders(self.spark, self.path):
            if old.startswith("rows-") and old not in (folder, before):
                files.delete(self.spark, f"{self.path}/{old}")
