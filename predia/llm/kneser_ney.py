"""Quality classifier: an interpolated modified Kneser-Ney model of character n-grams, trained on trusted text.

Trusted are the texts labelled good, without the held-out fifth, on which the thresholds are set. Every document gets
the perplexity of its characters given the four before them; per language, a text is kept if its perplexity is at most
the ``keep`` quantile of the held-out good texts.

How it is spread over the cluster:

1. Documents are shuffled once, compressed, in batches of about ``batch_bytes`` of text (by a hash of the id, as are the
   labels). A batch unpacks a chunk at a time, and counts its different n-grams, and how often each stands in trusted text.
2. N-grams are shuffled by themselves: the sum over batches is the corpus count. Lower orders, contexts, discounts and
   probabilities follow by count joins on n-grams and contexts, all spread by a hash. The most frequent n-gram is one
   row per batch.
3. Each batch gets back the probabilities of its own n-grams and sums them up per document.

The model has no bound: all n-grams of all trusted texts are in it. Nothing is collected. Steps 1 and 3 read the same
shuffle of the documents.

Defined results: a null text counts as empty; an empty text has no perplexity and is not kept; white space counts as
one space; rows without id are scored but never trusted; a null language is a language of its own, and one without
held-out good texts takes the threshold of all languages together; without any, every text with characters is kept.
"""

from __future__ import annotations

import contextlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from predia.llm.common import held_out, settle
from predia.session import INITIAL_PARTITIONS

ORDER = 5
START = "\x02"
PACKED = "batch int, doc_id long, lang string, packed binary"
SCORED = "doc_id long, lang string, n_chars long, log_prob double"


@dataclass(frozen=True)
class Settings:
    keep: float = 0.99
    batch_bytes: int = 64 << 20
    chunk: int = 1 << 20


def normalised(text: str | None) -> str:
    return " ".join((text or "").replace(START, " ").split())


def multipliers() -> np.ndarray:
    return np.random.default_rng(41).integers(1, 1 << 63, ORDER, dtype=np.uint64) | np.uint64(1)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")


def gram_hashes(codes: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """A hash of each run of ORDER code points."""
    n = max(0, len(codes) - ORDER + 1)
    out = np.zeros(n, np.uint64)
    for k in range(ORDER):
        out += codes[k:k + n].astype(np.uint64) * factors[k]
    return out


def chunks(packed: pa.ChunkedArray, size: int) -> Iterator[tuple[int, list[int], str]]:
    """Unpacks texts, about ``size`` characters at a time: first text, lengths, joined text with starts before each."""
    unpack = zstandard.ZstdDecompressor().decompress
    begin, part, total = 0, [], 0
    for i, data in enumerate(packed):
        part.append(normalised(unpack(data.as_py()).decode()))
        total += len(part[-1]) + ORDER - 1
        if total >= size or i == len(packed) - 1:
            yield begin, [len(t) for t in part], "".join(START * (ORDER - 1) + t for t in part)
            begin, part, total = i + 1, [], 0


def places(lengths: list[int]) -> np.ndarray:
    """Where the n-grams of a joined text begin: as many per text as it has characters."""
    sizes = np.array(lengths, np.int64)
    starts = np.cumsum(sizes + ORDER - 1) - (sizes + ORDER - 1)
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def merged(parts: list[tuple]) -> list[tuple]:
    """Several lists of n-grams (hash, count, characters), each sorted by hash, as one."""
    hashes, counts, grams = (np.concatenate(column) for column in zip(*parts))
    unique, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    return [(unique, np.bincount(inverse, counts, len(unique)).astype(np.int64), grams[first])]


def counted(docs: pa.Table, trusted: pa.Table, settings: Settings) -> pa.Table:
    """The different n-grams of a batch; batch number and count in trusted text packed in one number."""
    factors, good = multipliers(), set(trusted["doc_id"].to_pylist())
    ids = docs["doc_id"].to_pylist()
    found: list[tuple] = []
    for begin, lengths, text in chunks(docs["packed"], settings.chunk):
        codes, at = code_points(text), places(lengths)
        h = gram_hashes(codes, factors)[at]
        known = np.repeat([ids[begin + i] in good for i in range(len(lengths))], lengths)
        unique, first = np.unique(h, return_index=True)
        seen, times = np.unique(h[known], return_counts=True)
        count = np.zeros(len(unique), np.int64)
        count[np.searchsorted(unique, seen)] = times
        found.append((unique, count, codes[at[first][:, None] + np.arange(ORDER)].reshape(-1, ORDER)))
        if len(found) == 8:
            found = merged(found)
    schema = pa.schema([("gram", pa.string()), ("packed", pa.int64())])
    if not found:
        return schema.empty_table()
    _, total, grams = merged(found)[0]
    line = grams.tobytes().decode("utf-32-le")
    batch = docs["batch"][0].as_py()
    return pa.table([pa.array([line[i:i + ORDER] for i in range(0, len(line), ORDER)], pa.string()),
                     pa.array((batch << 32) + total)], schema=schema)


def summed(docs: pa.Table, known: pa.Table, settings: Settings) -> pa.Table:
    """The log probability of each document of a batch."""
    factors = multipliers()
    line = code_points("".join(known["gram"].to_pylist())).reshape(-1, ORDER)
    h = np.zeros(len(line), np.uint64)
    for k in range(ORDER):
        h += line[:, k].astype(np.uint64) * factors[k]
    order = np.argsort(h)
    h, value = h[order], known["log_p"].to_numpy()[order]
    sums, sizes = np.zeros(docs.num_rows), np.zeros(docs.num_rows, np.int64)
    for begin, lengths, text in chunks(docs["packed"], settings.chunk):
        sizes[begin:begin + len(lengths)] = lengths
        got = gram_hashes(code_points(text), factors)[places(lengths)]
        if len(got):
            owner = np.repeat(np.arange(len(lengths)), lengths)
            sums[begin:begin + len(lengths)] = np.bincount(owner, value[np.searchsorted(h, got)], len(lengths))
    return pa.table({"doc_id": docs["doc_id"], "lang": docs["lang"], "n_chars": pa.array(sizes), "log_prob": pa.array(sums)})


def counts_by_order(grams: DataFrame) -> dict[int, DataFrame]:
    """gram, c for each order: occurrences in the highest, different characters before in the lower ones."""
    tables = {ORDER: grams.where("c > 0").select("gram", "c")}
    for k in range(ORDER - 1, 0, -1):
        tables[k] = (tables[k + 1].groupBy(F.right("gram", F.lit(k)).alias("gram")).agg(F.count("*").alias("c")))
    return tables


def discounts(tables: dict[int, DataFrame]) -> DataFrame:
    """One row per order: the discounts of n-grams counted once, twice and more often, from the counts of counts.

    Where these are too few to tell, the discount is three quarters.
    """
    rows = None
    for k, table in tables.items():
        one = table.agg(*[F.sum((F.col("c") == i).cast("long")).cast("double").alias(f"n{i}") for i in (1, 2, 3, 4)])
        one = one.select(F.lit(k).alias("order"), "*")
        rows = one if rows is None else rows.unionAll(one)
    y = F.col("n1") / F.expr("nullif(n1 + 2 * n2, 0)")

    def discount(i: int):
        ratio = i - (i + 1) * y * F.col(f"n{i + 1}") / F.expr(f"nullif(n{i}, 0)")
        return F.when((ratio > 0) & (ratio < i), ratio).otherwise(F.lit(0.75))

    return rows.select("order", discount(1).alias("d1"), discount(2).alias("d2"), discount(3).alias("d3"))


def probabilities(grams: DataFrame) -> DataFrame:
    """gram, log_p for every n-gram of any document; ``grams`` has gram, c (its count in trusted text)."""
    tables = counts_by_order(grams)
    cut = F.broadcast(discounts(tables))  # five rows
    # Beside the characters of trusted text, one for all others.
    size = tables[1].agg((F.count("*") + 1).cast("double").alias("alphabet"), F.lit(1).alias("order"))
    lower = None
    for k in range(1, ORDER + 1):
        wanted = grams.select(F.right("gram", F.lit(k)).alias("gram")).distinct() if k < ORDER else grams.select("gram")
        wanted = wanted.withColumn("order", F.lit(k)).withColumn("context", F.substring("gram", 1, k - 1)).withColumn(
            "shorter", F.right("gram", F.lit(k - 1)))
        c = F.col("c")
        contexts = tables[k].groupBy(F.substring("gram", 1, k - 1).alias("context")).agg(
            F.sum("c").alias("all"), F.sum((c == 1).cast("long")).alias("t1"), F.sum((c == 2).cast("long")).alias("t2"),
            F.sum((c >= 3).cast("long")).alias("t3"))
        rows = wanted.join(tables[k], "gram", "left").join(cut, "order")
        if k == 1:  # one context, the empty one: one row
            rows = rows.join(F.broadcast(contexts), "context", "left").join(F.broadcast(size), "order").withColumn(
                "below", 1 / F.col("alphabet"))
        else:
            rows = rows.join(contexts, "context", "left").join(
                lower.select(F.col("gram").alias("shorter"), F.col("p").alias("below")), "shorter")
        seen = F.coalesce(c, F.lit(0))
        less = F.when(seen == 1, F.col("d1")).when(seen == 2, F.col("d2")).when(seen >= 3, F.col("d3")).otherwise(0.0)
        freed = F.col("d1") * F.col("t1") + F.col("d2") * F.col("t2") + F.col("d3") * F.col("t3")
        lower = rows.select("gram", F.when(F.col("all").isNull(), F.col("below")).otherwise(
            (F.greatest(seen - less, F.lit(0.0)) + freed * F.col("below")) / F.col("all")).alias("p"))
    return lower.select("gram", F.log("p").alias("log_p"))


def packed_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts compressed, which is what is shuffled."""
    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        texts = [pack((t.as_py() or "").encode("utf-8", "replace")) for t in batch["text"]]
        yield pa.RecordBatch.from_arrays([batch["batch"], batch["doc_id"], batch["lang"], pa.array(texts, pa.binary())],
                                         ["batch", "doc_id", "lang", "packed"])


def batched(docs: DataFrame, labels: DataFrame, batches: int) -> tuple[DataFrame, DataFrame]:
    """Documents, and ids of trusted ones, with the number of their batch."""
    known = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id")).otherwise(F.xxhash64("text"))
    where = F.pmod(known, F.lit(batches)).cast("int")
    rows = docs.select(where.alias("batch"), "doc_id", "lang", "text").mapInArrow(packed_texts, PACKED)
    good = labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    return rows, good.select(F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int").alias("batch"), "doc_id")


def scores(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, lang, n_chars, log_prob of every document."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batches = max(1, math.ceil(size / settings.batch_bytes))
    # The shuffles grow with the data: twice as many partitions as batches, so few batches share a task.
    partitions = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2 * batches)
    rows, good = batched(docs, labels, batches)
    rows = rows.repartition(partitions, "batch")
    asked = (rows.groupBy("batch").cogroup(good.groupBy("batch"))
             .applyInArrow(lambda a, b: counted(a, b, settings) if a.num_rows else
                           pa.table({"gram": pa.array([], pa.string()), "packed": pa.array([], pa.int64())}),
                           "gram string not null, packed long not null").repartition(partitions, "gram"))
    # Every reader needs both columns (hence the filter) and no null checks, so all read one and the same shuffle.
    grams = asked.groupBy("gram").agg(F.sum(F.col("packed").bitwiseAND(F.lit(0xFFFFFFFF))).alias("c")).where("c >= 0")
    answers = (asked.join(probabilities(grams), "gram")
               .select(F.shiftright("packed", 32).cast("int").alias("batch"), "gram", "log_p"))
    scored = (rows.groupBy("batch").cogroup(answers.groupBy("batch"))
              .applyInArrow(lambda a, b: summed(a, b, settings), SCORED))
    with shuffles_of(docs.sparkSession, partitions):
        return settle(scored, "perplexity")


@contextlib.contextmanager
def shuffles_of(spark: SparkSession, partitions: int):
    """Shuffles without a number of their own start with so many partitions; afterwards the session is as it was."""
    before = spark.conf.get(INITIAL_PARTITIONS, None)
    spark.conf.set(INITIAL_PARTITIONS, partitions)
    try:
        yield
    finally:
        spark.conf.unset(INITIAL_PARTITIONS) if before is None else spark.conf.set(INITIAL_PARTITIONS, before)


def quality_classifier(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: doc_id, lang, n_chars, log_prob, perplexity, threshold, kept."""
    rows = scores(docs, labels, settings).withColumn(
        "perplexity", F.when(F.col("n_chars") > 0, F.exp(-F.col("log_prob") / F.col("n_chars"))))
    bounds = settle(thresholds(rows, labels, settings), "perplexity-thresholds")
    overall = bounds.where("stratum is null").select(F.max("threshold")).first()[0]
    own = bounds.where("stratum is not null").withColumnRenamed("threshold", "own")
    limit = F.coalesce("own", F.lit(overall).cast("double"), F.lit(float("inf")))
    return (rows.withColumn("stratum", F.coalesce("lang", F.lit(""))).join(own, "stratum", "left")
            .select("doc_id", "lang", "n_chars", "log_prob", "perplexity", limit.alias("threshold"),
                    F.coalesce(F.col("perplexity") <= limit, F.lit(False)).alias("kept")))


def thresholds(rows: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """stratum (null: all together), threshold: the quantile of held-out good texts.

    Perplexities are counted in steps of a hundredth, rounded up, so a quantile is a running sum over few values.
    """
    good = labels.where((F.col("quality") == 1) & held_out(F.col("doc_id"))).select("doc_id").distinct()
    steps = (rows.where("perplexity is not null").join(good, "doc_id")
             .select(F.coalesce("lang", F.lit("")).alias("stratum"), F.ceil(F.col("perplexity") * 100).alias("step")))
    counts = steps.groupBy("stratum", "step").agg(F.count("*").alias("n"))
    counts = counts.unionAll(counts.groupBy("step").agg(F.sum("n").alias("n")).select(
        F.lit(None).cast("string").alias("stratum"), "step", "n"))
    up = Window.partitionBy("stratum").orderBy("step")
    return (counts.withColumn("below", F.sum("n").over(up))
            .withColumn("total", F.sum("n").over(Window.partitionBy("stratum")))
            .where(F.col("below") >= settings.keep * F.col("total"))
            .groupBy("stratum").agg((F.min("step") / 100).alias("threshold")))
