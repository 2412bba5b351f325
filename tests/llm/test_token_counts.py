import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from predia.llm import token_counts as X


def test_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    lengths = np.array([len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) for r in docs.collect()])
    table = X.length_table(docs)
    rows = table.collect()
    assert sorted(r["n_tokens"] for r in rows) == sorted(set(lengths.tolist()))
    for r in rows:
        n = r["n_tokens"]
        assert (r["n_docs"], r["docs_from"], r["tokens_from"], r["docs_to"], r["tokens_within"]) == (
            (lengths == n).sum(), (lengths >= n).sum(), lengths[lengths >= n].sum(), (lengths <= n).sum(),
            np.minimum(lengths, n).sum())
    limits = [0, 1, 100, 512, 513, 4096, 10 ** 7, int(lengths.max()), int(np.median(lengths))]
    for r in X.within_limits(table, limits).collect():
        assert (r["docs_to"], r["tokens_within"]) == ((lengths <= r["context"]).sum(),
                                                      np.minimum(lengths, r["context"]).sum())
    ordered = np.sort(lengths)
    for r in X.quantiles(table, [0.1, 0.5, 0.9, 1.0]).collect():
        assert r["n_tokens"] == ordered[int(np.ceil(r["share"] * len(ordered))) - 1]


def test_edges(documents):
    docs = documents((1, None), (2, ""), (3, "a"), (3, "a"), (None, "x y " * 40_000))
    rows = sorted((r["n_tokens"], r["n_docs"], r["docs_from"]) for r in X.length_table(docs).collect())
    assert rows[:2] == [(0, 2, 5), (1, 2, 3)] and rows[2][0] > 40_000
    none = X.length_table(docs.where("false"))
    assert none.count() == 0 and X.within_limits(none, [5]).first()["tokens_within"] == 0
    assert X.quantiles(none, [0.5]).first()["n_tokens"] is None
