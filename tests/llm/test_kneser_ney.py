import math
import random
import zlib
from collections import Counter, defaultdict

import pytest

from predia.llm import kneser_ney as X

N = X.ORDER


class Brute:
    """Interpolated modified Kneser-Ney by plain counting."""

    def __init__(self, texts):
        self.counts = {N: Counter(g for t in texts for g in self.grams(t))}
        for k in range(N - 1, 0, -1):
            self.counts[k] = Counter(g[1:] for g in self.counts[k + 1])
        self.contexts = {k: defaultdict(list) for k in self.counts}
        self.d = {}
        for k, counts in self.counts.items():
            for g, c in counts.items():
                self.contexts[k][g[:-1]].append(c)
            n = Counter(counts.values())
            y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else None
            raw = [i - (i + 1) * y * n[i + 1] / n[i] if y is not None and n[i] else None for i in (1, 2, 3)]
            self.d[k] = [x if x is not None and 0 < x < i else 0.75 for i, x in zip((1, 2, 3), raw)]

    @staticmethod
    def grams(text):
        text = X.START * (N - 1) + X.normalised(text)
        return [text[i:i + N] for i in range(len(text) - N + 1)]

    def p(self, gram):
        k = len(gram)
        if not k:
            return 1 / (len(self.counts[1]) + 1)
        below, around = self.p(gram[1:]), self.contexts[k].get(gram[:-1])
        if not around:
            return below
        c, d = self.counts[k][gram], self.d[k]
        less = d[min(c, 3) - 1] if c else 0
        return (max(c - less, 0) + sum(d[min(x, 3) - 1] for x in around) * below) / sum(around)

    def log_prob(self, text):
        return sum(math.log(self.p(g)) for g in self.grams(text))


def words(rng, alphabet, n):
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 5))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    return [(i, words(rng, "abc" if i % 2 else "ab", rng.randrange(5, 60)), "en" if i % 3 else "de") for i in range(60)]


def test_against_plain_counting(documents, labelled, corpus):
    texts = [*corpus, (100, None), (101, ""), (102, " \n"), (103, "zzz unseen é漢"), (None, "abab"), (104, "ab " * 20_000)]
    labels = labelled(*[(i, int(i % 4 > 0), 0) for i, _, _ in corpus], (None, 1, 0))
    trusted = [t for i, t, _ in corpus if i % 4 and zlib.crc32(str(i).encode()) % 5]
    model = Brute(trusted)
    rows = X.scores(documents(*texts), labels, X.Settings(batch_bytes=2000, chunk=100)).collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(texts)
    for i, text, *_ in texts:
        assert got[i]["n_chars"] == len(X.normalised(text))
        assert got[i]["log_prob"] == pytest.approx(model.log_prob(text), rel=1e-9, abs=1e-9)


def test_probabilities_sum_to_one(spark, corpus):
    model = Brute([t for _, t, _ in corpus])
    letters = sorted(model.counts[1])
    for context in ("abab", "a ba", "xyzw", X.START * 4):
        total = sum(model.p(context + c) for c in letters) + model.p(context + "☃")
        assert total == pytest.approx(1)


def test_thresholds_and_verdict(documents, labelled, corpus):
    rows = [*corpus, (200, "qqqq wwww zzzz kkkk", "en"), (201, corpus[5][1], "it"), (202, "", "en"), (203, None, None)]
    labels = labelled(*[(i, 1, 0) for i, _, _ in corpus])
    got = {r["doc_id"]: r for r in X.quality_classifier(documents(*rows), labels).collect()}
    held = [i for i, _, _ in corpus if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i]["kept"] for i in held)
    for lang in ("en", "de"):
        own = [got[i]["perplexity"] for i, _, x in corpus if x == lang and i in held]
        limit = {r["threshold"] for r in got.values() if r["lang"] == lang}
        assert len(limit) == 1 and limit.pop() == pytest.approx(math.ceil(max(own) * 100) / 100)
    assert not got[200]["kept"] and got[201]["kept"] and not got[202]["kept"] and not got[203]["kept"]
    assert got[201]["threshold"] == max(r["threshold"] for r in got.values())


def test_without_labels_or_documents(documents, labelled):
    docs = documents((1, "some text"), (2, ""))
    got = {r["doc_id"]: r["kept"] for r in X.quality_classifier(docs, labelled()).collect()}
    assert got == {1: True, 2: False}
    assert X.quality_classifier(docs.where("false"), labelled((1, 1, 0))).count() == 0
