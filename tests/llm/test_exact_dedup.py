import hashlib
import random

from pyspark.sql import functions as F

from predia.llm import exact_dedup as X



def test_groups_ties_nulls_and_repeated_rows(documents):
    docs = documents((5, "a b\n"), (3, "ab"), (4, "a  b "), (7, "a  b "), (9, None), (8, " \t\v"), (1, "c"), (1, "c"),
                     (None, "d"), (2, "d"), (6, "x" * 50_000))
    rows = X.exact_dedup(docs).collect()
    found = sorted((r["doc_id"] or -1, r["keep_id"], r["group_size"], r["kept"]) for r in rows)
    assert found == [(-1, 2, 2, False), (1, 1, 2, False), (1, 1, 2, True), (2, 2, 2, True), (3, 4, 4, False),
                     (4, 4, 4, True), (5, 4, 4, False), (6, 6, 1, True), (7, 4, 4, False), (8, 8, 2, True),
                     (9, 8, 2, False)]
    assert {r["text_sha256"] for r in rows if r["doc_id"] == 3} == {hashlib.sha256(b"ab").hexdigest()}


def test_stage_keeps_one_row_of_each_text_and_all_columns(documents):
    docs = documents((1, "c"), (1, "c"), (1, "e"), (2, "e "), (10, "f"), (None, "g"), (None, "g"), (None, "h"))
    kept = X.without_copies(docs)
    assert kept.columns == docs.columns
    # The longer "e " stays, and with it goes the "e" of id 1, whose "c" stays once.
    assert sorted((r["doc_id"] or -1, r["text"]) for r in kept.collect()) == [
        (-1, "g"), (-1, "h"), (1, "c"), (2, "e "), (10, "f")]


def test_empty_table(documents, spark):
    none = documents((1, "a")).where("false")
    assert X.exact_dedup(none).count() == 0 and X.without_copies(none).count() == 0


def test_filter_against_a_set():
    random.seed(3)
    state, live = X.Shard(buckets=2), {}
    keys = [hashlib.sha256(bytes([i % 256, i // 256])).digest() for i in range(3000)]
    for step in range(12_000):
        key = random.choice(keys)
        if random.random() < 0.4:
            state.delete(key)
            live.pop(key, None)
        else:
            state.insert(key, 1, step, step, step)
            live[key] = live.get(key, 0) + 1
    assert {k: e[0] for k, e in state.keys.items()} == live
    assert all(k in state.filter for k in live) and state.resizes > 3
    assert int((state.filter.table > 0).sum()) == len(live)
    false_hits = sum(hashlib.sha256(b"no%d" % i).digest() in state.filter for i in range(20_000))
    assert false_hits <= 2


def test_false_hit_is_a_new_digest():
    state = X.Shard()
    one = bytes(range(32))
    twin = one[:16] + b"\xff" * 16  # the same fingerprint in the same buckets
    state.insert(one, 1, 5, 1, 1)
    assert twin in state.filter
    state.insert(twin, 1, 5, 2, 2)
    assert set(state.keys) == {one, twin}
    state.delete(one)
    assert twin in state.filter and set(state.keys) == {twin}


def test_index_takes_batches_and_forgets(documents, spark):
    rows = X.fingerprints(documents(*[(i, f"text {i % 40}") for i in range(200)]))
    index = X.CuckooIndex(spark, 3).insert(rows.where("doc_id < 100")).insert(rows.where("doc_id >= 100"))
    assert {(r["n_rows"], r["doc_id"]) for r in index.keys().collect()} == {(5, i) for i in range(40)}
    gone = index.delete(rows.where("doc_id < 10").select("digest"))
    assert {r["doc_id"] for r in gone.keys().collect()} == set(range(10, 40))
    assert index.keys().count() == 40
    again = gone.insert(rows.where("doc_id = 41").select("digest", "chars", "doc_id", "row"))
    assert {r["doc_id"] for r in again.keys().collect()} == set(range(10, 40)) | {41}


def test_hot_text_is_combined_before_the_shuffle(documents):
    docs = documents(*[(i, "same" if i % 3 else f"own {i}") for i in range(3000)])
    rows = X.fingerprints(docs)
    entries = rows.select(F.lit(0).alias("shard"), "digest", F.lit(1).cast("long").alias("n_rows"), "chars", "doc_id",
                          "row").mapInPandas(X.combined, X.ENTRY)
    assert entries.count() < 1000 + 50
