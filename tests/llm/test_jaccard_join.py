import random

import pytest
from pyspark.sql import functions as F

from predia.llm import jaccard_join as X
from predia.llm.common import powers, shingle_set
from tests_brute import near_classes


def brute(texts):
    """Least id of each document's class, over all pairs."""
    return near_classes({i: shingle_set(t or "", powers()).tolist() for i, t in texts})


def text(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(n))


def changed(rng, words, n):
    words = words.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = "changed" + str(rng.randrange(1000))
    return " ".join(words)


def test_classes_against_all_pairs(documents):
    rng = random.Random(5)
    rows, n = [], 0
    for _ in range(30):
        base = text(rng, rng.choice([30, 120, 300]))
        for _ in range(rng.randrange(1, 7)):
            rows.append((n, changed(rng, base, rng.choice([0, 0, 1, 2, 4, 8]))))
            n += 1
    rng.shuffle(rows)
    got = {r["doc_id"]: r["class_id"] for r in X.near_duplicates(documents(*rows)).collect()}
    assert got == brute(rows)


def test_chains_reach_beyond_the_leader(documents):
    """Each link of the chain is near the next; its ends are far apart."""
    rng = random.Random(8)
    words = text(rng, 200).split()
    rows = []
    for i in range(12):
        rows.append((i, " ".join(words)))
        words[i * 15 + 3] = f"new{i}"
        words[i * 15 + 9] = f"more{i}"
    found = X.near_duplicates(documents(*rows)).collect()
    assert {r["class_id"] for r in found} == {0} and brute(rows)[11] == 0


def test_pairs_hidden_behind_a_leader_that_is_far(spark, documents):
    """Two members of a bucket are near each other, and both too far from its leader."""
    buckets = spark.createDataFrame([(bucket, r, 0) for bucket in (1, 2) for r in (0, 7, 9, 20, 30)],
                                    "bucket long, rep long, leader long")
    # 30 has many shingles of its own, so it shares too little with any other.
    sizes = spark.createDataFrame([(r, 100, [1, 2], 80 if r == 30 else 99) for r in (0, 7, 9, 20, 30)],
                                  "rep long, n_shingles long, buckets array<long>, common long")
    # Distances to the leader: 0.3, 0.35 and 0.7; only the first two can be near each other.
    checked = spark.createDataFrame([(7, 0, 82, 200), (9, 0, 79, 200), (20, 0, 46, 200)],
                                    "a long, b long, shared long, both long")
    parts = spark.createDataFrame([], "node long, component long")
    pairs = X.hidden_pairs(buckets, sizes, parts, checked, 4, 5).collect()
    assert [tuple(r) for r in pairs] == [(9, 7)]
    together = spark.createDataFrame([(7, 7), (9, 7)], "node long, component long")
    assert not X.hidden_pairs(buckets, sizes, together, checked, 4, 5).collect()


def test_edge_texts(documents):
    same = "one two three four five six seven"
    docs = documents((1, None), (2, ""), (3, "!!"), (4, "Hello, World"), (5, "hello world"), (6, same), (6, same),
                     (None, same), (8, same.upper() + "."), (9, "w" * 200_000))
    rows = X.near_duplicates(docs).collect()
    assert len(rows) == 10
    found = {r["doc_id"]: (r["class_id"], r["n_links"], r["n_shingles"]) for r in rows}
    assert found[4] == found[5] == (4, 0, 1)
    assert found[6] == found[8] == (6, 0, 3)
    assert found[None] == (None, 0, 3)
    assert found[1] == (1, 0, 0) and found[2] == (2, 0, 0) and found[9] == (9, 0, 1)
    kept = X.one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, 1, 2, 3, 4, 6, 6, 9]


def test_empty_table(documents):
    none = documents((1, "a")).where("false")
    assert X.near_duplicates(none).count() == 0 and X.one_per_group(none).count() == 0


def test_large_group_makes_few_pairs(spark, documents):
    """A group of near copies is compared with its leaders, not with itself."""
    rng = random.Random(1)
    base = text(rng, 150)
    docs = documents(*[(i, changed(rng, base, 1)) for i in range(300)])
    made = []
    real = X.verified
    X.verified = lambda pairs, sets: made.append(pairs.count()) or real(pairs, sets)
    try:
        rows = X.near_duplicates(docs).collect()
    finally:
        X.verified = real
    assert {r["class_id"] for r in rows} == {0} and sum(made) < 300 * 24


def all_links(rows):
    """How many other sets are at the threshold to each document's set, over all pairs."""
    sets = {i: frozenset(shingle_set(t or "", powers()).tolist()) for i, t in rows}
    different = set(sets.values())
    return {i: sum(5 * len(s & o) >= 4 * len(s | o) for o in different if o != s) for i, s in sets.items()}


def test_links_are_counted_behind_the_leader(documents):
    """Three texts that are all near each other have two links each, whichever leads."""
    rng = random.Random(4)
    base = text(rng, 200)
    rows = [(i, changed(rng, base, 1)) for i in range(3)]
    assert all_links(rows) == {0: 2, 1: 2, 2: 2}
    assert {r["doc_id"]: r["n_links"] for r in X.near_duplicates(documents(*rows)).collect()} == all_links(rows)


def test_links_against_all_pairs(documents):
    rng = random.Random(12)
    rows = []
    for _ in range(12):
        base = text(rng, rng.choice([60, 150, 300]))
        rows += [(len(rows) + k, changed(rng, base, rng.choice([0, 1, 2, 4, 8]))) for k in range(rng.randrange(1, 25))]
    got = {r["doc_id"]: r["n_links"] for r in X.near_duplicates(documents(*rows)).collect()}
    assert got == all_links(rows)


@pytest.mark.parametrize("limits", [(4, 1 << 20), (512, 900), (512, 1 << 20)])
def test_links_of_blocks(spark, limits):
    """Sets of many sizes in one component, dealt over blocks and parts of sizes or not."""
    rng = random.Random(3)
    sets = {r: sorted(rng.sample(range(60), rng.randrange(20, 60))) + [1000 + r] * (r % 2) for r in range(50)}
    sets |= {r: list(range(5000, 5000 + r)) for r in range(60, 100, 2)} | {200: [1, 2], 201: [1, 2, 3]}
    frame = spark.createDataFrame(list(sets.items()), "rep long, shingles array<long>")
    parts = spark.createDataFrame([(r, 200 if r >= 200 else 0) for r in sets], "node long, component long")
    got = {r["rep"]: r["n_links"] for r in X.link_counts(frame, parts, 4, 5, *limits).collect()}
    want = {r: sum(5 * len(set(s) & set(o)) >= 4 * len(set(s) | set(o)) for q, o in sets.items() if q != r and
                   (q < 200) == (r < 200)) for r, s in sets.items() if r < 200} | {200: 1, 201: 1}
    assert got == want and sum(want.values()) > 100


@pytest.mark.parametrize("recall", [0.9, 0.99, 0.9999])
def test_banding_reaches_its_recall(recall):
    banding = X.Banding.for_recall(recall=recall)
    assert 1 - (1 - 0.8 ** banding.rows) ** banding.bands >= recall
    assert banding.rows * banding.bands <= 128


def test_components_of_a_long_chain(spark):
    links = spark.range(1, 60).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
    assert {r["component"] for r in X.components(links).collect()} == {0}
