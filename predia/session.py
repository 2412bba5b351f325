"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import functools
import math
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

# How large a side of a join may be to be broadcast: as estimated from its files, and as a shuffle measured its rows. Files
# are compressed and a join asks for few of their columns: 1 MB by that estimate was up to 78 MB in the hash table, which is
# built in the driver, and 6 MB of measured rows were 40 MB. These sizes stand for some 20 MB each, as several jobs run
# side by side.
MEASURED_BROADCASTS = {
    "spark.sql.autoBroadcastJoinThreshold": "256k",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "2m",
}

# Run-time settings the operators rely on. Joins carry no broadcast hint: Spark broadcasts a side only when its
# size, estimated from the files or measured after a shuffle, is under the threshold, and sort-merges beyond it.
# A hot key in a sort-merge join is split by AQE, also where the next operator would have reused the partitioning.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    **MEASURED_BROADCASTS,
    "spark.sql.parquet.datetimeRebaseModeInRead": "CORRECTED",
    "spark.sql.parquet.datetimeRebaseModeInWrite": "CORRECTED",
    "spark.sql.avro.datetimeRebaseModeInWrite": "CORRECTED",
}

# Settings a session takes only when it is built. Spark makes one Java method of a wide projection; the JVM by default
# leaves methods of that size to its interpreter, which made the widest product three times slower. Call sites kept for
# every column cost more than they tell.
COMPILE_WIDE_PROJECTIONS = "-XX:-DontCompileHugeMethods"
STATIC_CONF = {
    "spark.driver.extraJavaOptions": COMPILE_WIDE_PROJECTIONS,
    "spark.executor.extraJavaOptions": COMPILE_WIDE_PROJECTIONS,
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session that somebody else built."""
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    return spark


def build_session(app: str = "predia", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above and any extra ones."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**STATIC_CONF, **RUNTIME_CONF, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def own_session(spark: SparkSession) -> SparkSession:
    """A session of the same application with the caller's settings and those above; the caller's stay as they are."""
    session = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if name.startswith("spark.sql.") and session.conf.isModifiable(name):
            session.conf.set(name, value)
    return tune(session)


def size_shuffles(df: DataFrame, file_bytes: int = 16 << 20) -> int:
    """Start the shuffles of a frame's session with one partition per ``file_bytes`` that the frame reads.

    Files are compressed: 16 MB of them are some 100 MB of rows, which a task sorts without spilling. Never with fewer
    than the session asks. Adaptive execution merges partitions that turn out small but cannot split
    one that is too large for a task, so the start has to follow the size of the data: of what this frame reads, as
    Spark knows it from listing the files.
    """
    spark = df.sparkSession
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    read = sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))
    # A source that does not know its size says so with a number beyond any.
    known = read if read < 1 << 60 else 0
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(known / file_bytes))
    spark.conf.set(INITIAL_PARTITIONS, partitions)
    return partitions


@contextlib.contextmanager
def sized(df: DataFrame):
    """Shuffles start with the size of what the frame reads; afterwards the session is as it was."""
    conf = df.sparkSession.conf
    before = conf.get(INITIAL_PARTITIONS, None)
    size_shuffles(df)
    try:
        yield
    finally:
        conf.unset(INITIAL_PARTITIONS) if before is None else conf.set(INITIAL_PARTITIONS, before)


_measuring: dict[int, tuple[int, dict[str, str | None]]] = {}
_lock = threading.Lock()


@contextlib.contextmanager
def measured_broadcasts(df: DataFrame):
    """Sides are broadcast by what a shuffle measured, or from files of up to 256 KB; then the session is as it was.

    Before a shuffle Spark takes a side's size from its files. A key column of a compressed file can be forty times as
    large in the hash table of a join, so that the usual threshold lets more than a gigabyte through the driver. Threads
    that share a session share the setting: the last one puts it back.
    """
    spark = df.sparkSession
    with _lock:
        users, before = _measuring.get(id(spark), (0, {}))
        if not users:
            before = {name: spark.conf.get(name, None) for name in MEASURED_BROADCASTS}
            for name, value in MEASURED_BROADCASTS.items():
                spark.conf.set(name, value)
        _measuring[id(spark)] = users + 1, before
    try:
        yield
    finally:
        with _lock:
            users, before = _measuring.pop(id(spark))
            if users > 1:
                _measuring[id(spark)] = users - 1, before
            else:
                for name, value in before.items():
                    spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="predia-")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name under the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine: executors elsewhere cannot read it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = _local_root()
    return f"{root.rstrip('/')}/predia/{purpose}-{uuid.uuid4().hex}"
