import zlib

import numpy as np
import pytest

from predia.llm import toxicity as X
from predia.llm.common import powers

WORDS = [f"w{i}" for i in range(300)]


@pytest.fixture(scope="module")
def rows():
    """Toxic is an insult together with a group; each alone is clean."""
    random = np.random.default_rng(2)
    out = []
    for i in range(2400):
        words = list(random.choice(WORDS, 30))
        kind = i % 4
        words += ["idiot"] * (kind in (1, 3)) + ["strangers"] * (kind in (2, 3))
        random.shuffle(words)
        out.append((i, " ".join(words), int(kind == 3)))
    return out


def test_learns_the_pair(documents, labelled, rows):
    docs = documents(*[(i, t) for i, t, _ in rows])
    labels = labelled(*[(i, 1, y) for i, _, y in rows])
    settings = X.Settings(common_share=0.2, least_chi2=20)
    got = {r["doc_id"]: r for r in X.toxicity(docs, labels, settings).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    test = [(i, y) for i, _, y in rows if got[i]["held_out"]]
    right = sum(got[i]["predicted"] == y for i, y in test)
    assert right / len(test) > 0.97
    assert all(r["predicted"] == int(r["score"] >= 0.5) for r in got.values())
    kept = X.without_toxic(docs, labels, settings)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if not r["predicted"]}


def test_score_is_the_formula():
    random = np.random.default_rng(4)
    settings = X.Settings()
    terms = X.hashed_terms("Some words, some OTHER words", powers(), settings)
    model = X.Model(-0.3, terms, random.normal(size=len(terms)).astype(np.float32),
                    random.normal(size=(len(terms), 8)).astype(np.float32))
    place = np.full(settings.slots, -1, np.int32)
    place[terms] = np.arange(len(terms))
    y = model.intercept + float(model.weights.sum(dtype=float)) + sum(
        float(model.factors[i].astype(float) @ model.factors[j].astype(float))
        for i in range(len(terms)) for j in range(i))
    assert X.text_score(terms, place, model) == pytest.approx(1 / (1 + np.exp(-y)))


def test_case_and_repetition_do_not_count():
    power, settings = powers(), X.Settings()
    assert (X.hashed_terms("A b b", power, settings) == X.hashed_terms("b a", power, settings)).all()
    assert len(X.hashed_terms(None, power, settings)) == len(X.hashed_terms("... !", power, settings)) == 0


def test_edges(documents, labelled):
    docs = documents((1, None), (2, ""), (None, "x"), (4, "y" * 100_000), (4, "z"))
    for labels, share in ((labelled(), 0.0), (labelled((1, 1, 0), (4, None, 0)), 0.0), (labelled((1, 1, 1), (4, 0, 1)), 1.0)):
        rows = X.toxicity(docs, labels).collect()
        assert len(rows) == 5 and {round(r["score"], 6) for r in rows} == {share}
    assert X.toxicity(docs.where("false"), labelled((1, 1, 1))).count() == 0


def test_held_out_labels_change_nothing(documents, labelled, rows):
    docs = documents(*[(i, t) for i, t, _ in rows[:400]])
    plain = labelled(*[(i, 1, y) for i, _, y in rows[:400]])
    turned = labelled(*[(i, 1, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, _, y in rows[:400]])
    a, b = (sorted((r["doc_id"], r["score"]) for r in X.toxicity(docs, x).collect()) for x in (plain, turned))
    assert a == b
