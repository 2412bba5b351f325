"""What several operators share: input tables, tables in the shared folder, words and their hashes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from predia.session import scratch_path

WHITE_SPACE = " \t\n\x0b\x0c\r"

# Bytes of a word keep their value, A-Z become a-z, all other ASCII becomes a space. Bytes from 0x80 on belong to
# characters beyond ASCII, which are word characters, so this works on UTF-8 byte by byte.
FOLD = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 32
    for b in range(256)
)

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
PERIOD = 1 << 16


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame into the shared folder and read it back.

    It is computed once, its lineage ends there, lost executors do not lose it, and Spark knows its size when it
    plans a join. The files belong to the result that reads them, so they live as long as the shared folder keeps them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{purpose}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id) -> F.Column:
    """The fixed fifth of the rows that no classifier learns from; rows without id are not in it."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def new_name(df: DataFrame, wanted: str) -> str:
    """A column name that the frame does not use yet, in any spelling."""
    used = {c.lower() for c in df.columns}
    while wanted.lower() in used:
        wanted += "_"
    return wanted


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers() -> np.ndarray:
    """Powers of an odd multiplier modulo 2^64; beyond the period they start again."""
    out = np.full(PERIOD, MULTIPLIER, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(text: str, power: np.ndarray, prefix: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word of a text in order, and of each word's first ``prefix`` bytes."""
    data = np.frombuffer(b" " + text.lower().encode("utf-8", "replace").translate(FOLD) + b" ", np.uint8)
    inside = data != 32
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    sizes = ends - starts
    at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    part = data[inside].astype(np.uint64) * power[at & (PERIOD - 1)]
    first = np.cumsum(sizes) - sizes
    whole = mixed(np.add.reduceat(part, first) + sizes.astype(np.uint64))
    if not prefix:
        return whole, whole
    return whole, mixed(np.add.reduceat(np.where(at < prefix, part, np.uint64(0)), first))


def shingle_set(text: str, power: np.ndarray, size: int = 5) -> np.ndarray:
    """The sorted distinct hashes of all runs of ``size`` words; a shorter text is one run, one without words none."""
    words, _ = word_hashes(text, power)
    if not len(words):
        return words
    size = min(size, len(words))
    count = len(words) - size + 1
    run = np.full(count, size, np.uint64)
    for k in range(size):
        run = mixed(run * MULTIPLIER + words[k:k + count])
    return np.unique(run)
