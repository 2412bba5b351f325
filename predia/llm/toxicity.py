"""Toxicity: a factorization machine over hashed terms.

Score of a text with the set T of hashed terms: ``w0 + sum w[t] + sum over pairs <v[t], v[u]>``, through the logistic
function. The pair term catches what no sum of single weights can: a word that harms only next to another.

Terms are the lower-cased words and their first bytes, each hashed into a fixed number of slots; presence counts, not
frequency. Labels, language, source and id are never inputs.

Defined results: a null text counts as empty; an empty text has the score of the intercept; without a usable label,
or with labels of one class only, the score is that class's share (0 without labels). Repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from predia.llm.common import held_out, mixed, new_name, powers, word_hashes


@dataclass(frozen=True)
class Settings:
    """``per_class`` bounds the rows per label that the model is fitted on; all else covers all rows.

    Rows of a class that has more are drawn by a hash of the id, and each drawn row stands for as many as were left
    out, so the share of the classes in the loss is that of all labelled rows.
    """

    per_class: int = 8000
    slots: int = 1 << 18
    rank: int = 8
    prefix: int = 5
    least_rows: int = 3
    least_chi2: float = 12.0
    common_share: float = 0.05
    epochs: int = 12
    batch: int = 64
    rate: float = 0.15
    decay: float = 1e-5
    seed: int = 17


@dataclass(frozen=True)
class Model:
    """Terms without a weight are left out: ``terms`` is sorted, ``weights`` and ``factors`` run along it."""

    intercept: float
    terms: np.ndarray
    weights: np.ndarray
    factors: np.ndarray


def hashed_terms(text: str | None, power: np.ndarray, settings: Settings) -> np.ndarray:
    """The sorted distinct slots of a text's words and of their first bytes."""
    words, starts = word_hashes(text or "", power, settings.prefix)
    both = np.concatenate([words, mixed(starts + np.uint64(1))])
    return np.unique((both & np.uint64(settings.slots - 1)).astype(np.int32))


def sample_rows(docs: DataFrame, labels: DataFrame, settings: Settings) -> tuple[DataFrame, dict[int, int]]:
    """Texts of at most ``per_class`` labelled rows of either class, and the size of the classes."""
    usable = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
              .select("doc_id", F.col("toxic").cast("int").alias("label")).distinct())
    sizes = {r["label"]: r["count"] for r in usable.groupBy("label").count().collect()}
    drawn = [usable.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.per_class)
             for c in (0, 1)]
    # At most two times per_class rows of 12 bytes: this side has a proven bound.
    picked = F.broadcast(drawn[0].unionAll(drawn[1]))
    return docs.select("doc_id", "text").join(picked, "doc_id"), sizes


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Fit the machine on the bounded sample of labelled rows outside the held-out fifth."""
    rows, sizes = sample_rows(docs, labels, settings)
    if len(sizes) < 2:
        share = float(sum(c * n for c, n in sizes.items()) / sum(sizes.values())) if sizes else 0.0
        return constant(share, settings)

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        power = powers()
        for batch in batches:
            found = [hashed_terms(t, power, settings).tobytes() for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["label"], pa.array(found, pa.binary())],
                                             ["doc_id", "label", "terms"])

    got = rows.mapInArrow(featured, "doc_id long, label int, terms binary").toPandas()
    got = got.sort_values(["doc_id", "label", "terms"], kind="stable")
    return train([np.frombuffer(t, np.int32) for t in got["terms"]], got["label"].to_numpy(), sizes, settings)


def constant(share: float, settings: Settings) -> Model:
    share = min(max(share, 1e-9), 1 - 1e-9)
    none = np.empty(0, np.float32)
    return Model(float(np.log(share / (1 - share))), np.empty(0, np.int32), none, none.reshape(0, settings.rank))


def train(texts: list[np.ndarray], label: np.ndarray, sizes: dict[int, int], settings: Settings) -> Model:
    """Adaptive gradient steps over mini-batches; rows are weighted so that the classes keep their true sizes."""
    drawn = {c: max(1, int((label == c).sum())) for c in (0, 1)}
    total = sum(sizes.values())
    weight = np.where(label == 1, sizes[1] / drawn[1], sizes[0] / drawn[0]) * (len(label) / total)
    terms = telling_terms(texts, label, settings)
    place = np.full(settings.slots, -1, np.int32)
    place[terms] = np.arange(len(terms), dtype=np.int32)
    texts = [p[p >= 0] for p in (place[t] for t in texts)]

    random = np.random.default_rng(settings.seed)
    w0 = float(np.log(sizes[1] / sizes[0]))
    w = np.zeros(len(terms), np.float32)
    v = random.normal(0, 0.01, (len(terms), settings.rank)).astype(np.float32)
    w_seen, v_seen, w0_seen = np.full_like(w, 1e-2), np.full_like(v, 1e-2), 1e-2
    for _ in range(settings.epochs):
        order = random.permutation(len(texts))
        for begin in range(0, len(order), settings.batch):
            chosen = order[begin:begin + settings.batch]
            flat = np.concatenate([texts[i] for i in chosen])
            lengths = np.array([len(texts[i]) for i in chosen])
            owner = np.repeat(np.arange(len(chosen)), lengths)
            used, inverse = np.unique(flat, return_inverse=True)
            vs = v[flat]
            sums = summed(vs, owner, len(chosen))
            y = w0 + np.bincount(owner, w[flat], len(chosen)) + 0.5 * (
                (sums ** 2).sum(1) - np.bincount(owner, (vs ** 2).sum(1), len(chosen)))
            slope = (weight[chosen] * (sigmoid(y) - label[chosen]) / len(chosen)).astype(np.float32)
            gw = np.bincount(inverse, slope[owner], len(used)).astype(np.float32) + settings.decay * w[used]
            gv = summed(slope[owner, None] * (sums[owner] - vs), inverse, len(used)) + settings.decay * v[used]
            w_seen[used] += gw ** 2
            v_seen[used] += gv ** 2
            w[used] -= settings.rate * gw / np.sqrt(w_seen[used])
            v[used] -= settings.rate * 0.3 * gv / np.sqrt(v_seen[used])
            g0 = float(slope.sum())
            w0_seen += g0 * g0
            w0 -= settings.rate * g0 / np.sqrt(w0_seen)
    return Model(w0, terms, w, v)


def telling_terms(texts: list[np.ndarray], label: np.ndarray, settings: Settings) -> np.ndarray:
    """Terms worth a weight: those that go with a label (chi-square), and common ones, for their pairs.

    A term of few rows that tells nothing would only be learnt by heart.
    """
    owner = np.repeat(label, [len(t) for t in texts])
    flat = np.concatenate([*texts, np.empty(0, np.int32)])
    ones = np.bincount(flat[owner == 1], minlength=settings.slots).astype(float)
    rows = np.bincount(flat, minlength=settings.slots).astype(float)
    n, positive = len(label), float((label == 1).sum())
    expected = rows * positive / n
    spread = expected * (1 - positive / n) * (1 - rows / n)
    chi2 = (ones - expected) ** 2 / np.maximum(spread, 1e-9)
    keep = (rows >= settings.least_rows) & ((chi2 >= settings.least_chi2) | (rows >= settings.common_share * n))
    return np.flatnonzero(keep).astype(np.int32)


def summed(rows: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
    """Sums of rows per owner."""
    return np.stack([np.bincount(owner, rows[:, k], count) for k in range(rows.shape[1])], 1).astype(np.float32)


def sigmoid(y):
    return 1 / (1 + np.exp(-np.clip(y, -30, 30)))


def text_score(terms: np.ndarray, place: np.ndarray, model: Model) -> float:
    at = place[terms]
    at = at[at >= 0]
    vs = model.factors[at]
    total = vs.sum(0, dtype=np.float64)
    pairs = 0.5 * float((total ** 2).sum() - (vs.astype(np.float64) ** 2).sum())
    return float(sigmoid(model.intercept + model.weights[at].sum(dtype=np.float64) + pairs))


def score(docs: DataFrame, model: Model, column: str = "score", settings: Settings = Settings(),
          below: float | None = None) -> DataFrame:
    """All columns and the score of each row's ``text``; with ``below``, only rows that score less.

    One pass without a shuffle. The model that goes to every task holds at most ``slots`` terms.
    """
    spark = docs.sparkSession
    # Plain arrays: a broadcast class would have to be importable on the executors.
    shared = spark.sparkContext.broadcast((model.intercept, model.terms, model.weights, model.factors))
    schema = docs.withColumn(column, F.lit(0.0)).schema

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        power, own = powers(), Model(*shared.value)
        place = np.full(settings.slots, -1, np.int32)
        place[own.terms] = np.arange(len(own.terms), dtype=np.int32)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            got = pa.array([text_score(hashed_terms(t.as_py(), power, settings), place, own) for t in texts],
                           pa.float64())
            out = pa.RecordBatch.from_arrays([*batch.columns, got], [*batch.schema.names, column])
            yield out if below is None else out.filter(pa.array(np.asarray(got) < below))

    return docs.mapInArrow(scored, schema)


def toxicity(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = fit(docs, labels, settings)
    rows = docs.select("doc_id", "text")
    return score(rows, model, settings=settings).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents that score under one half, with their own columns."""
    column = new_name(docs, "toxicity_score")
    return score(docs, fit(docs, labels, settings), column, settings, below=0.5).drop(column)
