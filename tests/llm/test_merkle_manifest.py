import hashlib
import zlib

import pytest

from predia.llm import merkle_manifest as X


def hashed(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return hashed("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def tree_of(nodes):
    """The levels of a tree, leaves first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([hashed(last[i:i + 3]) for i in range(0, len(last), 3)])
    return levels


def steps_of(levels, place):
    """Siblings before and after, level by level."""
    out = []
    for level in levels[:-1]:
        start = place // 3 * 3
        out.append((level[start:place], level[place + 1:start + 3]))
        place //= 3
    return out


def plain(rows):
    """The whole manifest by plain lists."""
    by_source = {}
    for row in rows:
        by_source.setdefault(row["source"], []).append((leaf_of(row, row["text"]), row))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source, found in by_source.items():
        found.sort(key=lambda f: (f[1]["doc_id"] is not None, f[1]["doc_id"] or 0, f[0]))
        trees[source] = tree_of([leaf for leaf, _ in found])
    top = tree_of([trees[s][-1][0] for s in order])
    out = []
    for number, source in enumerate(order):
        for place, (leaf, row) in enumerate(by_source[source]):
            steps = steps_of(trees[source], place) + steps_of(top, number)
            doc_id, text = row["doc_id"], row["text"]
            digest = leaf
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0 and text is not None:
                digest = leaf_of(row, text.replace("\n", ""))
            for before, after in steps:
                digest = hashed([*before, digest, *after])
            out.append((doc_id, leaf, trees[source][-1][0], top[-1][0],
                        hashed(d for before, after in steps for d in [*before, *after]), digest, digest == top[-1][0]))
    return sorted(out, key=repr)


def found(docs):
    rows = X.digests(X.manifest(docs)).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.fixture
def small_blocks(monkeypatch):
    """Blocks of nine nodes, so that small trees take several rounds."""
    monkeypatch.setattr(X, "HEIGHT", 2)
    monkeypatch.setattr(X, "BLOCK", 9)


def test_against_plain_lists(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = found(docs)
    assert rows == plain(docs.collect())
    assert {r[-1] for r in rows} == {True, False}


@pytest.mark.parametrize("count", [1, 2, 3, 4, 9, 10, 27, 28, 82, 244])
def test_rounds(spark, small_blocks, count):
    docs = spark.range(count).selectExpr(
        "id * 7 AS doc_id", "IF(id % 5 = 0, concat('s', id % 40), 'hot') AS source", "'en' AS lang",
        "id AS n_chars", "concat('line', char(10), id) AS text")
    assert found(docs) == plain(docs.collect())


def test_edges(spark, small_blocks):
    long = "word\n" * 100_000
    rows = [(1, "a", "en", 1, None), (1, "a", "en", 1, None), (1, "a", None, 1, "x\ny"), (None, "a", "en", None, "t\n"),
            (None, None, None, None, None), (None, None, None, None, None), (2, None, "de", 3, ""), (3, "", "de", 0, "-"),
            (4, "é", "", 0, "\n\n"), (5, "z", "-", 0, long), (6, "Z", "en", -1, "1:a"), *[(9, "a", "en", 2, "same")] * 30]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    clashing = docs.selectExpr("*", "'own' AS place", "'own' AS tree", "'own' AS digest", "'own' AS levels", "1 AS block")
    assert found(clashing) == plain(docs.collect())
    assert X.manifest(docs.where("false")).count() == 0
    lone = docs.where("source = 'z'")
    assert found(lone) == plain(lone.collect())
    row = X.digests(X.manifest(lone)).first()
    assert row["leaf"] == row["subroot"] == row["root"] and row["proof_sha256"] == hashlib.sha256(b"").hexdigest()


def test_a_proof_needs_no_other_row(spark, small_blocks):
    docs = spark.range(100).selectExpr(
        "id AS doc_id", "concat('s', id % 2) AS source", "'en' AS lang", "id AS n_chars", "'t' AS text")
    for row in X.manifest(docs).collect():
        proof = [bytes(step) for step in row["proof"]]
        assert X.folded(bytes(row["leaf"]), proof) == bytes(row["root"])
        assert X.folded(bytes(row["leaf"][::-1]), proof) != bytes(row["root"])
