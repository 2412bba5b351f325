import itertools
import random

import numpy as np
import pytest
import sentencepiece

from predia.llm import sentencepiece_fst as X


@pytest.fixture(scope="module")
def machine():
    with open(X.model_file(), "rb") as file:
        return X.Machine(file.read(), remembered=50)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=X.model_file())


TEXTS = ["", " ", "  a  b ", "Hello  world\n x <s> a", "aaaaaaa" * 50, "éé 漢字 🎉\x00\t", "   ", "a\n\n\nb   c",
         "======= ----- .....  1234567890", "<0x0A> <unk>", "́e", "x" * 3000, "word. Word, (word) ...!", "﻿​"]


def test_ids_are_the_library_s(spark, machine, library):
    docs = [r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rng = random.Random(6)
    mixed = ["".join(rng.choice("ab tion.,!é \n#▁") for _ in range(60)) for _ in range(300)]
    for text in TEXTS + docs + mixed:
        assert machine.encode(text).tolist() == library.encode(text), text[:80]
        assert machine.decode(machine.encode(text)) == text.replace(X.MARK, " ")


def test_unigram_path_is_the_least_of_all():
    machine = X.Machine.__new__(X.Machine)
    machine.kind, machine.front, machine.byte_ids = X.UNIGRAM, False, {b: 1000 + b for b in range(256)}
    pieces = {"a": 0, "b": 1, "ab": 2, "ba": 3, "aba": 4, "bb": 5}
    scores = {0: -2.0, 1: -2.5, 2: -3.1, 3: -3.9, 4: -5.05, 5: -4.2}
    machine.compile(pieces, scores)
    names = {i: p for p, i in pieces.items()}
    for n in range(1, 8):
        for text in map("".join, itertools.product("ab", repeat=n)):
            costs = []
            for cuts in itertools.product([0, 1], repeat=n - 1):
                at = [0, *[i + 1 for i, c in enumerate(cuts) if c], n]
                parts = [text[x:y] for x, y in zip(at, at[1:])]
                if all(p in pieces for p in parts):
                    costs.append(-sum(scores[pieces[p]] for p in parts))
            path = machine.shortest_path(text)
            assert "".join(names[i] for i in path) == text
            assert -sum(scores[i] for i in path) == pytest.approx(min(costs))
    assert machine.shortest_path("aé") == [0, 1000 + 0xC3, 1000 + 0xA9]


def test_seams_against_merging(machine, library):
    """Two pieces are apart if merging their joined text leaves exactly these two."""
    rng = random.Random(2)
    plain = [p for p in machine.pieces if X.MARK not in p and len(p) < 6]
    merges = machine.merges

    def merged(text):
        parts = [machine.pieces[c] for c in text]
        while True:
            best = min(((merges.joined[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in merges.joined), default=None)
            if best is None:
                return parts
            parts[best[1]:best[1] + 2] = [merges.at_rank[best[0]]]

    for _ in range(3000):
        a, b = rng.choice(plain), rng.choice(plain)
        ids = machine.pieces[a], machine.pieces[b]
        assert merges.apart(*ids) == (merged(a + b) == list(ids)), (a, b)


def test_query_rows(documents, library):
    docs = documents((1, None), (2, ""), (3, "Some words."), (3, "Some words."), (None, "n ▁ id"), (4, "long " * 30_000))
    rows = X.encode_decode(docs).collect()
    assert len(rows) == 6 and all(r["restored"] for r in rows)
    found = {r["doc_id"]: r for r in rows}
    assert found[1]["n_ids"] == found[2]["n_ids"] == 0
    assert found[3]["n_ids"] == len(library.encode("Some words."))
    assert found[4]["n_ids"] == len(library.encode("long " * 30_000))
    assert X.encode_decode(docs.where("false")).count() == 0


def test_tables_of_ids_and_texts(documents, library, monkeypatch):
    monkeypatch.setattr(X, "PORTION", 50)  # several portions of a batch
    texts = {i: t for i, t in enumerate([None, *TEXTS])}
    docs = documents(*texts.items(), (None, "no id"))
    ids = {r["doc_id"]: r["ids"] for r in X.encode(docs).collect()}
    assert ids == {i: library.encode(t or "") for i, t in texts.items()} | {None: library.encode("no id")}
    plain = {i: (t or "").replace(X.MARK, " ") for i, t in texts.items()} | {None: "no id"}
    assert {r["doc_id"]: r["text"] for r in X.decode(X.encode(docs)).collect()} == plain
    rows = {r["doc_id"]: r for r in X.encode_decode(docs).collect()}
    assert {i: r["ids"] for i, r in rows.items()} == ids and {i: r["decoded"] for i, r in rows.items()} == plain
    assert all(r["n_ids"] == len(r["ids"]) for r in rows.values())
    nothing = X.encode(docs.where("false"))
    assert nothing.count() == 0 and X.decode(nothing).count() == 0


def test_memory_of_parts_is_bounded(machine):
    machine.encode(" ".join(f"w{i}" for i in range(500)))
    assert len(machine.paths) <= 50
    assert machine.encode("w1 w1").dtype == np.dtype("<u4")
