import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from predia.llm import packing as X


@pytest.fixture(scope="module")
def reference_ids():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def check(rows, ids_of, capacity=1024):
    """Every id in exactly one piece, windows without gaps and not over the capacity."""
    for doc, ids in ids_of.items():
        own = sorted((r for r in rows if r["doc_id"] == doc), key=lambda r: r["start"])
        assert [r["start"] for r in own] == list(np.cumsum([0, *[r["length"] for r in own]])[:-1])
        assert sum(r["length"] for r in own) == len(ids) and {r["doc_tokens"] for r in own} == {len(ids)}
        for r in own:
            part = np.array(ids[r["start"]:r["start"] + r["length"]], "<u4")
            assert zlib.crc32(part.tobytes()) == r["ids_crc32"]
    windows = {}
    for r in rows:
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return windows


def test_pieces_are_the_documents(documents, reference_ids):
    texts = {1: None, 2: "", 3: "word " * 5000, 4: "a<|endoftext|> b", 5: "é漢字🎉\x00 \n\n\t ", 6: "x" * 30_000,
             7: " ".join(map(str, range(1500)))}
    rows = X.pack(documents(*texts.items())).collect()
    check(rows, {i: reference_ids(t) for i, t in texts.items()})


def test_windows_hold_the_ids(documents, reference_ids):
    """From the windows alone every document's ids come back; the rest is padding."""
    texts = {1: None, 2: "", 3: "word " * 5000, 4: "a<|endoftext|> b", 6: "x" * 30_000, 7: " ".join(map(str, range(900)))}
    settings = X.Settings(pad_id=7)
    found = X.sequences(documents(*texts.items()), settings).collect()
    back = {i: {} for i in texts}
    for window in found:
        n = window["n_ids"]
        assert len(window["ids"]) == (settings.capacity if n & (n - 1) else n)
        assert window["n_ids"] == sum(p["length"] for p in window["pieces"])
        assert set(window["ids"][window["n_ids"]:]) <= {7}
        for p in window["pieces"]:
            back[p["doc_id"]][p["start"]] = window["ids"][p["offset"]:p["offset"] + p["length"]]
    assert {i: sum((parts[a] for a in sorted(parts)), []) for i, parts in back.items()} == {
        i: reference_ids(t) for i, t in texts.items()}
    assert len({w["sequence_id"] for w in found}) == len(found)
    empty = X.sequences(documents(*texts.items()).where("false"))
    assert empty.count() == 0


def test_little_padding_on_given_documents(spark, reference_ids):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = X.pack(docs).collect()
    windows = check(rows, {r["doc_id"]: reference_ids(r["text"]) for r in docs.collect()})
    assert sum(r["length"] for r in rows) / (1024 * len(windows)) > 0.98


def test_repeated_rows_and_rows_without_id(documents):
    docs = documents((1, "same words"), (1, "same words"), (None, "no id"), (None, "no id"))
    rows = X.pack(docs).collect()
    assert len(rows) == 4 and len({r["sequence_id"] for r in rows}) == 1
    assert sorted(r["offset"] for r in rows)[0] == 0 and len({r["offset"] for r in rows}) == 4
    assert X.pack(docs.where("false")).count() == 0


@pytest.mark.parametrize("k", [1, 2, 3, 7])
def test_differencing_beats_no_bound_it_must_keep(k):
    rng = random.Random(k)
    for n in (0, 1, k, k + 1, 40):
        sizes = [rng.randrange(1, 300) for _ in range(n)]
        slots = X.differenced(sizes, k)
        assert len(slots) == n and all(0 <= s < k for s in slots)
        loads = np.bincount(slots, sizes, k) if n else np.zeros(k)
        assert loads.max() - loads.min() <= max(sizes, default=0)


def test_known_differencing_result():
    """The textbook case: 4 5 6 7 8 in two parts by differencing gives 14 and 16."""
    slots = X.differenced([4, 5, 6, 7, 8], 2)
    assert sorted(np.bincount(slots, [4, 5, 6, 7, 8]).tolist()) == [14, 16]


def test_windows_rise_until_they_hold():
    sizes = [600] * 7 + [500] * 3
    slots = X.windows(sizes, 1024)
    assert np.bincount(slots, sizes).max() <= 1024 and len(set(slots)) >= 9


def test_cuts():
    settings = X.Settings()
    assert X.cuts(1, settings) == [(0, 1)]
    assert X.cuts(1024, settings) == [(0, 1024)]
    assert X.cuts(2600, settings) == [(0, 1024), (1024, 1024), (2048, 256), (2304, 256), (2560, 40)]


def test_a_power_of_two_is_not_padded_and_full_windows_stand_alone(documents):
    settings = X.Settings(pad_id=7)
    docs = documents((1, " a" * 511), (2, " a" * 2047))
    rows = sorted(X.sequences(docs, settings).collect(), key=lambda r: r["n_ids"])
    assert [(r["n_ids"], len(r["ids"])) for r in rows] == [(512, 512), (1024, 1024), (1024, 1024)]
    assert len({r["sequence_id"] for r in rows}) == 3 and all(r["sequence_id"] >= 0 for r in rows)
    (odd,) = X.sequences(documents((1, " a" * 599)), settings).collect()
    assert (odd["n_ids"], len(odd["ids"]), set(odd["ids"][600:])) == (600, 1024, {7})
