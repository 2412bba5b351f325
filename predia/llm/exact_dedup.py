"""Exact dedup: a sharded cuckoo-filter index of live digests.

A text's digest is the SHA-256 of the text without white space. Digests are spread over shards by their hash. A shard
is a cuckoo filter (four fingerprints to a bucket, two buckets to a fingerprint) and the stored keys behind it. A
digest that the filter does not know is new, without a look at the keys; a hit is verified against the stored keys,
and a false hit counts as new. A filter that finds no free place is built anew, twice as large, from the stored keys.
Deleting a digest takes its fingerprint and its key away.

Rows of one digest are combined where they are read, before the shuffle, so a text that makes up a third of all rows
reaches its shard as one entry per batch of rows. The number of shards follows the number of rows.

Defined results: a null text counts as empty and empty texts are equal to each other; of equal texts the row with the
most code points stays, then the smallest doc_id, a null doc_id last; a row that is there twice stays once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from predia.llm.common import WHITE_SPACE, new_name, settle

ENTRY = "shard int, digest binary, n_rows long, chars long, doc_id long, row long"
STATE = f"kind string, {ENTRY}, slots binary"
STATE_ARROW = pa.schema([("kind", pa.string()), ("shard", pa.int32()), ("digest", pa.binary()), ("n_rows", pa.int64()),
                         ("chars", pa.int64()), ("doc_id", pa.int64()), ("row", pa.int64()), ("slots", pa.binary())])
SLOTS = 4
KICKS = 500
NO_ID = 2 ** 63 - 1


class Full(Exception):
    """No free place was found for a fingerprint."""


class CuckooFilter:
    """Fingerprints of digests; a digest counts as known if either of its two buckets holds its fingerprint."""

    def __init__(self, buckets: int, table: np.ndarray | None = None):
        self.buckets = buckets
        self.table = np.zeros((buckets, SLOTS), np.uint32) if table is None else table
        self.turn = 0

    def places(self, digest: bytes) -> tuple[int, int, int]:
        print_ = int.from_bytes(digest[:4], "little") or 1
        first = int.from_bytes(digest[8:16], "little") & (self.buckets - 1)
        return print_, first, self.other(first, print_)

    def other(self, bucket: int, print_: int) -> int:
        return bucket ^ ((print_ * 0x5BD1E995) & (self.buckets - 1))

    def __contains__(self, digest: bytes) -> bool:
        print_, a, b = self.places(digest)
        return print_ in self.table[a].tolist() or print_ in self.table[b].tolist()

    def add(self, digest: bytes) -> None:
        print_, a, b = self.places(digest)
        if self._put(a, print_) or self._put(b, print_):
            return
        at = b
        for _ in range(KICKS):
            self.turn = (self.turn + 1) % SLOTS
            print_, self.table[at, self.turn] = int(self.table[at, self.turn]), print_
            at = self.other(at, print_)
            if self._put(at, print_):
                return
        raise Full

    def _put(self, bucket: int, print_: int) -> bool:
        row = self.table[bucket].tolist()
        if 0 not in row:
            return False
        self.table[bucket, row.index(0)] = print_
        return True

    def remove(self, digest: bytes) -> None:
        print_, a, b = self.places(digest)
        for bucket in (a, b):
            row = self.table[bucket].tolist()
            if print_ in row:
                self.table[bucket, row.index(print_)] = 0
                return


class Shard:
    """A filter and its stored keys: digest to [rows, most code points, smallest id, its row]."""

    def __init__(self, buckets: int = 64):
        self.filter = CuckooFilter(buckets)
        self.keys: dict[bytes, list] = {}
        self.resizes = 0

    def insert(self, digest: bytes, n_rows: int, chars: int, doc_id: int, row: int) -> None:
        if digest in self.filter and (entry := self.keys.get(digest)) is not None:
            entry[0] += n_rows
            entry[1:] = min(entry[1:], [chars, doc_id, row], key=lambda e: (-e[0], e[1], e[2]))
            return
        self.keys[digest] = [n_rows, chars, doc_id, row]
        try:
            self.filter.add(digest)
        except Full:
            self.resize()

    def delete(self, digest: bytes) -> None:
        if digest in self.filter and self.keys.pop(digest, None) is not None:
            self.filter.remove(digest)

    def resize(self) -> None:
        size = self.filter.buckets
        while True:
            size *= 2
            self.resizes += 1
            self.filter = CuckooFilter(size)
            try:
                for digest in self.keys:
                    self.filter.add(digest)
                return
            except Full:
                continue


def combined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One entry per digest and batch of rows: the row that would stay, and how many there are."""
    for batch in batches:
        batch = batch.sort_values(["chars", "doc_id", "row"], ascending=[False, True, True], kind="stable")
        groups = batch.groupby("digest", sort=False)
        best = groups.first().reset_index()
        best["n_rows"] = groups.size().to_numpy()
        yield best[["shard", "digest", "n_rows", "chars", "doc_id", "row"]]


def kept_state(shard: int, state: Shard) -> pa.RecordBatch:
    """The filter and the keys of a shard as rows."""
    keys = [("key", shard, digest, *entry, None) for digest, entry in state.keys.items()]
    rows = [("filter", shard, None, None, None, None, None, state.filter.table.tobytes()), *keys]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), STATE_ARROW)], STATE_ARROW.names)


def worked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Apply the entries of a partition, which come sorted by shard and step, one shard after the other."""
    number, state = None, Shard()
    for batch in batches:
        for kind, shard, digest, n_rows, chars, doc_id, row, slots in zip(
                *(batch[name].to_pylist() for name in STATE_ARROW.names)):
            if shard != number:
                if number is not None:
                    yield kept_state(number, state)
                number, state = shard, Shard()
            if kind == "filter":
                stored = np.frombuffer(slots, np.uint32).reshape(-1, SLOTS).copy()
                state.filter = CuckooFilter(len(stored), stored)
            elif kind == "key":
                state.keys[digest] = [n_rows, chars, doc_id, row]
            elif kind == "delete":
                state.delete(digest)
            else:
                state.insert(digest, n_rows, chars, doc_id, row)
    if number is not None:
        yield kept_state(number, state)


@dataclass(frozen=True)
class CuckooIndex:
    """An index of live digests in the shared folder. Each change gives a new index; the old one stays readable."""

    spark: SparkSession
    shards: int
    state: DataFrame | None = None

    @staticmethod
    def for_rows(spark: SparkSession, rows: int, per_shard: int = 100_000) -> "CuckooIndex":
        return CuckooIndex(spark, max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                                      math.ceil(rows / per_shard)))

    def shard_of(self, digest) -> F.Column:
        return F.pmod(F.xxhash64(digest), F.lit(self.shards)).cast("int")

    def insert(self, rows: DataFrame) -> "CuckooIndex":
        """Add rows with columns digest, chars, doc_id, row."""
        entries = (rows.select(self.shard_of("digest").alias("shard"), "digest", F.lit(1).cast("long").alias("n_rows"),
                               "chars", F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "row")
                   .mapInPandas(combined, ENTRY))
        return self._with(entries.select(F.lit("insert").alias("kind"), "*", F.lit(None).cast("binary").alias("slots")))

    def delete(self, digests: DataFrame) -> "CuckooIndex":
        """Forget digests; those that are not live are left alone."""
        none = [F.lit(None).cast("long").alias(c) for c in ("n_rows", "chars", "doc_id", "row")]
        return self._with(digests.select(F.lit("delete").alias("kind"), self.shard_of("digest").alias("shard"),
                                         "digest", *none, F.lit(None).cast("binary").alias("slots")).distinct())

    def _with(self, change: DataFrame) -> "CuckooIndex":
        steps = change if self.state is None else self.state.unionByName(change)
        first = F.when(F.col("kind") == "filter", 0).when(F.col("kind") == "key", 1).otherwise(2)
        done = (steps.withColumn("step", first).repartition(self.shards, "shard")
                .sortWithinPartitions("shard", "step").drop("step").mapInArrow(worked, STATE))
        return CuckooIndex(self.spark, self.shards, settle(done, "cuckoo-index"))

    def keys(self) -> DataFrame:
        """The live digests: digest, n_rows, and the chars, doc_id and row of the one that stays."""
        return (self.state.where("kind = 'key'")
                .select("digest", "n_rows", "chars", F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "row"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, code points, digest, and a number for the row, settled so that the number stays the same."""
    text = F.coalesce("text", F.lit(""))
    return settle(docs.select(
        "doc_id", F.length(text).cast("long").alias("chars"),
        F.unhex(F.sha2(F.translate(text, WHITE_SPACE, ""), 256)).alias("digest"),
        F.monotonically_increasing_id().alias("row")), "fingerprints")


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = fingerprints(docs)
    index = CuckooIndex.for_rows(docs.sparkSession, rows.count()).insert(rows)
    groups = index.keys().select("digest", F.col("doc_id").alias("keep_id"), F.col("n_rows").alias("group_size"),
                                 F.col("row").alias("keep_row"))
    return rows.join(groups, "digest").select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def without_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay, with their own columns.

    Ids decide. Only where an id stands on several rows, some of which stay, do id and text decide, and one row of
    each text remains.
    """
    rows = settle(exact_dedup(docs), "dedup-decisions")
    ids = settle(rows.groupBy("doc_id").agg(F.sum(F.col("kept").cast("int")).alias("stay"),
                                            F.count("*").alias("listed")), "dedup-ids")
    # The ids that go grow with the documents, so the join is planned for their size from the start.
    gone = ids.where("stay = 0").hint("merge")
    clean = docs.join(gone, docs["doc_id"].eqNullSafe(gone["doc_id"]), "left_anti")
    mixed = ids.where("stay > 0 and stay < listed").select("doc_id")
    if mixed.isEmpty():
        return clean
    wanted = rows.where("kept").join(mixed, rows["doc_id"].eqNullSafe(mixed["doc_id"]), "left_semi")
    norm = new_name(docs, "normalised_digest")
    digest = F.sha2(F.translate(F.coalesce("text", F.lit("")), WHITE_SPACE, ""), 256)
    several = (clean.join(mixed, clean["doc_id"].eqNullSafe(mixed["doc_id"]), "left_semi").withColumn(norm, digest))
    several = several.join(wanted, several["doc_id"].eqNullSafe(wanted["doc_id"])
                           & (several[norm] == wanted["text_sha256"]), "left_semi").dropDuplicates(["doc_id", norm])
    single = clean.join(mixed, clean["doc_id"].eqNullSafe(mixed["doc_id"]), "left_anti")
    return single.unionByName(several.drop(norm))
