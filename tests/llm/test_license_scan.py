import random
import re

from predia.llm import license_scan as X


def brute(text, settings):
    words = [w.encode() for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+",
                                            re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))]
    places = [(i, label) for phrase, label in settings.phrases for i in range(len(words))
              if words[i:i + len(phrase.split())] == [w.encode() for w in phrase.split()]]
    blocks = set()
    for notice, label in settings.notices:
        tokens = X.words_of(notice)
        size = X.block_words(len(tokens), settings)
        for start in range(0, len(words), size // 2):
            block = words[start:start + size]
            share = len(set(tokens) & set(block)) / len(set(tokens))
            line = " " + " ".join(w.decode() for w in block) + " "
            marked = all(any(f" {p} " in line for p in group) for group in settings.marks.get(label, ()))
            if share >= settings.threshold - 1e-12 and marked:
                blocks.add((label, start, len(block), share))
    return words, places, sorted(blocks)


def test_against_all_blocks(documents):
    rng = random.Random(4)
    settings = X.Settings(threshold=0.7)
    pool = sorted({w.decode() for n, _ in X.NOTICES for w in X.words_of(n)}) + ["other"] * 40
    texts = [None, "", "MIT License mit license", "cc by cc by cc by", "Cc-BY.4", "xmit license", "É MIT LICENSEÉ",
             "Apache\nLicense", "the " * 30_000 + "Released under the MIT License."]
    for _ in range(60):
        words = [rng.choice(pool) for _ in range(rng.randrange(5, 150))]
        notice = rng.choice(X.NOTICES)[0].split()
        for _ in range(rng.randrange(4)):
            notice[rng.randrange(len(notice))] = "changed"
        texts.append(" ".join(words + notice + words[:10]))
    got = {r["doc_id"]: r for r in X.scan(documents(*enumerate(texts)), settings).collect()}
    for i, text in enumerate(texts):
        words, places, blocks = brute(text, settings)
        r = got[i]
        assert (r["n_words"], r["n_base"]) == (len(words), len(places))
        assert r["first_word"] == min((p for p, _ in places), default=None)
        assert r["last_word"] == max((p for p, _ in places), default=None)
        assert r["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert r["labels"] == ",".join(sorted({x for _, x in places} | {b[0] for b in blocks}))
        assert sorted(set(map(tuple, r["blocks"]))) == blocks
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(places or blocks)


def test_notice_in_several_lines_is_found(documents):
    notice = next(n for n, label in X.NOTICES if label == "mit").replace(" ", "\n")
    r = X.scan(documents((1, "intro words here\n" + notice + "\nmore words"))).collect()[0]
    assert (r["base_labels"], r["labels"]) == ("", "mit") and r["score"] == 1.0


def test_siblings_are_told_apart(documents):
    gpl = next(n for n, label in X.NOTICES if label == "gpl-2.0")
    texts = {
        "gpl-2.0": gpl, "lgpl-2.1": gpl.replace("GNU General", "GNU Lesser General").replace("version 2", "version 2.1"),
        "cc-by-4.0": "Licensed under CC BY 4.0.", "cc-by-nc-4.0": "This work is licensed under a Creative Commons "
        "Attribution NonCommercial 4.0 International License.", "": "Licensed under the Apache License, Version 1.0.",
        "gpl-3.0": gpl.replace("version 2", "version 3"), "agpl-3.0": gpl.replace("GNU", "GNU Affero").replace("2", "3"),
    }
    base = {"gpl", "apache", "cc-by", "mit"}
    for i, before in enumerate(("", "some words that say nothing of it " * 5)):
        docs = documents(*((n, before + text + " and more words") for n, text in enumerate(texts.values())))
        got = {r["doc_id"]: r["labels"] for r in X.scan(docs).collect()}
        for n, label in enumerate(texts):
            assert set(got[n].split(",")) - base - {""} == ({label} if label else set()), (label, got[n])


def test_every_notice_gets_its_own_label_alone(documents):
    notices = [(n, text) for n, (text, _) in enumerate(X.NOTICES)]
    got = {r["doc_id"]: {b["label"] for b in r["blocks"]} for r in X.scan(documents(*notices)).collect()}
    for n, (_, label) in enumerate(X.NOTICES):
        assert got[n] == ({"bsd", label} if label == "bsd-3-clause" else {label})


def test_edges(documents):
    docs = documents((1, "plain"), (1, "plain"), (None, "apache license"))
    rows = X.scan(docs).collect()
    assert sorted((r["doc_id"] or -1, r["labels"], r["score"]) for r in rows) == [
        (-1, "apache", 1.0), (1, "", 0.0), (1, "", 0.0)]
    assert X.scan(docs.where("false")).count() == 0
    assert X.scan(docs, X.Settings(notices=())).where("labels <> ''").count() == 1
