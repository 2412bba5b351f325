import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from predia.llm import spelling_variants as X


def counted(docs):
    """Words and occurrences, one run after the other."""
    words = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= 7:
                words[run] += 1
    return {w: n for w, n in words.items() if n >= 2}


def one_edit_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(words):
    """All rows by comparing all pairs."""
    near = {w: [v for v in words if one_edit_apart(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 10 * words[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, n, len(near[w]), form[w], words.get(form[w]), root(w)) for w, n in words.items())


def found(df):
    return sorted(tuple(r) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect())


@pytest.fixture(scope="module")
def vocabulary():
    """Words of few letters, so that many are near each other, with all kinds of edits."""
    rng = random.Random(7)
    words = set()
    while len(words) < 900:
        word = "".join(rng.choice("abéz") for _ in range(rng.randint(7, 9)))
        words.add(word)
        at = rng.randrange(len(word))
        words |= {word[:at] + "a" + word[at:], word[:at] + "y" + word[at + 1:], word + "b", "b" + word}
    return {w: rng.choice((2, 3, 20, 30, 200, 2500)) for w in sorted(words)}


@pytest.mark.parametrize("bin_symbols", [100_000, 60])
def test_against_all_pairs(spark, vocabulary, bin_symbols):
    """With small bins, halves that more words share are dealt over bins of their own."""
    rows = [(w, n) for w, n in vocabulary.items()]
    words = spark.createDataFrame(rows, "word string, n long")
    near = {r["word"]: r for r in X.near_words(words, bin_symbols).collect()}
    for word, _, n_near, _, _, _ in plain(vocabulary):
        assert (near[word]["n_near"] if word in near else 0) == n_near
    if bin_symbols == 60:
        assert X.binned(words, bin_symbols).where(F.col("bin").contains("/")).count() > 0


def test_query_against_all_pairs(documents, vocabulary):
    rng = random.Random(3)
    words = list(vocabulary)[:300]
    docs = [(i, " ".join(rng.choices(words, [vocabulary[w] for w in words], k=400)) + ". Ünterwegs ÜNTERWEGS") for i in range(20)]
    assert found(X.variants(documents(*docs))) == plain(counted(docs))


def test_index_knows_every_substring():
    words = sorted({"abcabca", "abcabcb", "bcabcab", "zzzzzzz", "zzzzzzzz"})
    index = X.BidirectionalIndex(words, "".join(words))
    text = "".join("\0" + w for w in words) + "\0"
    for size in (1, 2, 3, 5):
        for start in range(1, len(text) - size):
            part = text[start:start + size]
            if "\0\0" in part:
                continue
            symbols = [0 if c == "\0" else int(index.letters.searchsorted(ord(c))) + 1 for c in part]
            middle = size // 2
            state = index.everywhere(1)
            for s in symbols[middle:]:
                state = index.extend(state, X.np.array([s]), False)
            for s in symbols[:middle][::-1]:
                state = index.extend(state, X.np.array([s]), True)
            places = [i for i in range(len(text)) if text.startswith(part, i)]
            low, _, count = (int(x[0]) for x in state)
            assert sorted(index.left.order[low:low + count].tolist()) == places


def test_forms_follow_to_the_last(spark):
    chain = [("w" + str(i), "w" + str(i + 1)) for i in range(9)]
    ends = X.roots(spark.createDataFrame(chain, "word string, form string"), 9).collect()
    assert {r["word"]: r["root"] for r in ends} == {"w" + str(i): "w9" for i in range(9)}


def test_edges(spark, documents):
    long = "x" * 20_000
    docs = [(1, None), (2, ""), (None, "standing standing"), (3, "Standing STANDING é ÷÷÷÷÷÷÷ ÷÷÷÷÷÷÷"), (4, "once only"),
            (5, long), (5, long), (5, long + "y " + long + "y"), (6, "short words are not it"), (6, "stand1ng")]
    assert found(X.variants(documents(*docs))) == plain(counted(docs))
    assert X.variants(documents(*docs).where("false")).count() == 0
