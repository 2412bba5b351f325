"""License scans: phrases, and an exact set-similarity join of text blocks with notice templates.

Words are runs of ASCII letters and digits, lower-cased, and of all characters beyond ASCII. A template of t different
words is looked for in blocks of ``block_words(t)`` consecutive words, each beginning half a block after the one before,
so a notice of the template's length lies whole in a block. A block matches if it holds at least ``threshold`` of the
template's different words. The join finds every such block and no other:

* Tokens are ordered by how often they occur in all documents, the rarest first (one pass counts the templates' words).
* Prefix: to share ``need`` words with a block, one of the template's ``t - need + 1`` rarest words must be in it.
  Texts without any such word are passed over, and only blocks around one are looked at.
* Length: a block with fewer than ``need`` different template words is passed over.
* Positional: the first shared word's places in both orders bound what can still be shared.
* What remains is counted in full.

Notices of sibling licenses share nearly all words: a version, "Lesser" or "NonCommercial" is one word of many. So a
block that reaches the threshold gets the label only if it also has the phrases that tell it from its siblings.

Templates are an argument of a few kilobytes and go to every task; texts are not shuffled and nothing is collected but
one count per template word.

Defined results: a null text counts as empty: no words, no labels, score 0; repeated rows are scanned each; without
templates only phrases count.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from predia.llm.common import FOLD

# The phrases and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

GPL_TEXT = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {}General "
            "Public License as published by the Free Software Foundation, either version {} of the License, or (at your "
            "option) any later version.")
CC_NAMES = {"by": "Attribution", "by-sa": "Attribution-ShareAlike", "by-nc": "Attribution-NonCommercial",
            "by-nd": "Attribution-NoDerivatives", "by-nc-sa": "Attribution-NonCommercial-ShareAlike",
            "by-nc-nd": "Attribution-NonCommercial-NoDerivatives"}
REDISTRIBUTION = ("Redistribution and use in source and binary forms, with or without modification, are permitted "
                  "provided that the following conditions are met")

# Notices of public licenses in the forms that people put into their texts, and the label of each.
NOTICES = (
    (GPL_TEXT.format("", "2"), "gpl-2.0"),
    (GPL_TEXT.format("", "3"), "gpl-3.0"),
    ("This work is licensed under the GNU General Public License, version 2.", "gpl-2.0"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl-3.0"),
    (GPL_TEXT.format("Lesser ", "2.1"), "lgpl-2.1"),
    (GPL_TEXT.format("Lesser ", "3"), "lgpl-3.0"),
    (GPL_TEXT.format("Affero ", "3"), "agpl-3.0"),
    ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
     "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "apache-2.0"),
    ("Licensed under the Apache License, Version 2.0.", "apache-2.0"),
    ("This software is licensed under the Apache Software License, Version 1.1.", "apache-1.1"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
     "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software", "mit"),
    ("Released under the MIT License.", "mit"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice and this permission notice appear in all copies.", "isc"),
    (REDISTRIBUTION, "bsd"),
    (f"{REDISTRIBUTION}: Neither the name of the copyright holder nor the names of its contributors may be used to "
     "endorse or promote products derived from this software", "bsd-3-clause"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mpl-2.0"),
    *((f"Licensed under CC {kind.upper()} 4.0.", f"cc-{kind}-4.0") for kind in CC_NAMES),
    *((f"This work is licensed under a Creative Commons {name} 4.0 International License.", f"cc-{kind}-4.0")
      for kind, name in CC_NAMES.items()),
)

# What tells a label from its siblings, whose notices share nearly all words: phrases of which a block must have one of
# each group. Fixed values.
MARKS = {
    "gpl-2.0": (("gnu general public license",), ("version 2",)),
    "gpl-3.0": (("gnu general public license",), ("version 3",)),
    "lgpl-2.1": (("gnu lesser general public license",), ("version 2 1",)),
    "lgpl-3.0": (("gnu lesser general public license",), ("version 3",)),
    "agpl-3.0": (("gnu affero general public license",), ("version 3",)),
    "apache-2.0": (("apache license version 2 0",),),
    "apache-1.1": (("apache software license version 1 1", "apache license version 1 1"),),
    "mit": (("mit license", "permission is hereby granted free of charge"),),
    "isc": (("permission to use copy modify and or distribute",),),
    "bsd-3-clause": (("neither the name",),),
    "mpl-2.0": (("mozilla public license",),),
    **{f"cc-{kind}-4.0": ((f"cc {kind.replace('-', ' ')} 4 0",
                           f"creative commons {name.lower().replace('-', ' ')} 4 0"),) for kind, name in CC_NAMES.items()},
}

RESULT = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double, n_blocks long, blocks array<struct<label:string,start:long,words:long,containment:double>>")


@dataclass(frozen=True)
class Settings:
    threshold: float = 0.85
    phrases: tuple[tuple[str, str], ...] = PHRASES
    notices: tuple[tuple[str, str], ...] = NOTICES
    marks: Mapping[str, tuple[tuple[str, ...], ...]] = field(default_factory=lambda: MARKS)
    shortest_block: int = 16


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(FOLD).split()


def block_words(t: int, settings: Settings) -> int:
    """The least power of two that is at least twice the template's length."""
    return max(settings.shortest_block, 1 << math.ceil(math.log2(2 * t)))


def least_shared(t: int, threshold: float) -> int:
    """The fewest shared words that reach the threshold."""
    return max(1, math.ceil(threshold * t - 1e-9))


@dataclass(frozen=True)
class Notice:
    label: str
    size: int
    need: int
    tokens: tuple[bytes, ...]
    marks: tuple[tuple[bytes, ...], ...]

    def marked(self, words: list[bytes]) -> bool:
        """Whether a block has one phrase of every group."""
        line = b" " + b" ".join(words) + b" "
        return all(any(phrase in line for phrase in group) for group in self.marks)


class NoticeIndex:
    """Templates in the order of the corpus, and an inverted list of their prefixes."""

    def __init__(self, settings: Settings, frequency: dict[bytes, int]):
        self.notices: list[Notice] = []
        self.prefixes: dict[bytes, list[int]] = defaultdict(list)
        used = {w for text, _ in settings.notices for w in words_of(text)}
        order = {w: i for i, w in enumerate(sorted(used, key=lambda w: (frequency.get(w, 0), w)))}
        self.order = order
        by_size: dict[int, set[bytes]] = defaultdict(set)
        for text, label in settings.notices:
            words = words_of(text)
            tokens = sorted(set(words), key=order.__getitem__)
            size, need = block_words(len(words), settings), least_shared(len(tokens), settings.threshold)
            number = len(self.notices)
            marks = tuple(tuple(b" " + p.encode() + b" " for p in group) for group in settings.marks.get(label, ()))
            self.notices.append(Notice(label, size, need, tuple(tokens), marks))
            by_size[size].update(tokens)
            for word in tokens[:len(tokens) - need + 1]:
                self.prefixes[word].append(number)
        self.by_size = dict(by_size)

    def matches(self, words: list[bytes]) -> Iterator[tuple[str, int, int, float]]:
        """label, first word, words and containment of every block that reaches a template's threshold."""
        prefixes = self.prefixes
        if prefixes.keys().isdisjoint(words):
            return
        seen: set[tuple[int, int]] = set()
        blocks: dict[tuple[int, int], list[bytes]] = {}
        for at, word in enumerate(words):
            for number in prefixes.get(word, ()):
                notice = self.notices[number]
                half = notice.size // 2
                for start in {max(0, at // half - 1) * half, at // half * half}:
                    if (number, start) in seen:
                        continue
                    seen.add((number, start))
                    tokens = blocks.get((notice.size, start))
                    if tokens is None:
                        found = self.by_size[notice.size].intersection(words[start:start + notice.size])
                        tokens = blocks[notice.size, start] = sorted(found, key=self.order.__getitem__)
                    shared = shared_words(notice.tokens, tokens, notice.need)
                    if shared and notice.marked(words[start:start + notice.size]):
                        yield (notice.label, start, len(words[start:start + notice.size]), shared / len(notice.tokens))


def shared_words(template: tuple[bytes, ...], block: list[bytes], need: int) -> int:
    """How many words a template and a block share, both in the corpus order; 0 if that is less than ``need``."""
    if len(block) < need:
        return 0
    inside = set(block)
    first = next((i for i, word in enumerate(template) if word in inside), len(template))
    if first == len(template) or min(len(template) - first, len(block) - block.index(template[first])) < need:
        return 0
    shared = sum(word in inside for word in template)
    return shared if shared >= need else 0


def phrase_places(words: list[bytes], phrases: list[tuple[bytes, int, str]]) -> list[tuple[int, str]]:
    """Where a phrase's words stand consecutively: the first word's place, and the label."""
    line = b" " + b" ".join(words) + b" "
    found = []
    for phrase, _, label in phrases:
        at = line.find(phrase)
        place, counted = 0, 0
        while at >= 0:
            place += line.count(b" ", counted, at)
            counted = at
            found.append((place, label))
            at = line.find(phrase, at + 1)
    return found


def word_frequencies(docs: DataFrame, settings: Settings) -> dict[bytes, int]:
    """How often each template word occurs in all documents: one number per template word reaches the driver."""
    wanted = {w for text, _ in settings.notices for w in words_of(text)}

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: Counter = Counter()
            for text in batch["text"]:
                total.update(filter(wanted.__contains__, words_of(text.as_py())))
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())],
                                             ["word", "n"])

    rows = docs.select("text").mapInArrow(counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r["word"]): r["n"] for r in rows.collect()}


def scan(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: phrases found and matching blocks, see ``RESULT``."""
    index = NoticeIndex(settings, word_frequencies(docs, settings))
    phrases = [(b" " + b" ".join(words_of(p)) + b" ", len(words_of(p)), label) for p, label in settings.phrases]

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()),
                            ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()),
                            ("labels", pa.string()), ("score", pa.float64()), ("n_blocks", pa.int64()),
                            ("blocks", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()),
                                                           ("words", pa.int64()), ("containment", pa.float64())])))])
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                words = words_of(text.as_py())
                places = phrase_places(words, phrases)
                blocks = sorted(index.matches(words))
                starts, base = [p for p, _ in places], {label for _, label in places}
                rows.append({
                    "doc_id": doc_id, "n_words": len(words), "n_base": len(places),
                    "first_word": min(starts, default=None), "last_word": max(starts, default=None),
                    "base_labels": ",".join(sorted(base)),
                    "labels": ",".join(sorted(base | {b[0] for b in blocks})),
                    "score": 1.0 if base else max((b[3] for b in blocks), default=0.0), "n_blocks": len(blocks),
                    "blocks": [dict(zip(("label", "start", "words", "containment"), b)) for b in blocks]})
            yield pa.RecordBatch.from_pylist(rows, schema)

    return docs.select("doc_id", "text").mapInArrow(scanned, RESULT)
