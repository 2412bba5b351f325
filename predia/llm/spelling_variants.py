"""Spelling variants: words of the corpus that differ by one edit, found in bidirectional FM-indexes.

A search scheme for one error: of a word's two halves one is free of errors, so it is matched exactly and the match is
then extended across the other half with one error allowed. Both are steps on intervals of suffix ranks over the
delimited vocabulary: an index keeps the intervals of a string and of its reverse in step, so a match grows to the right
and to the left.

The vocabulary is dealt out by halves. A word is looked for by its first half and by its second; a word that it may
find is no more than one code point shorter or longer, so each word is indexed under the first and the last code points
of as many as a word of such a length may ask for. Halves are hashed into bins of bounded size, each bin is one index
over its words, and only per word the number of near words and the best of them leave it. A half that more words share
than a bin takes has bins of its own: its words are dealt over them, and its questions go to each. A pair whose first
halves agree counts in the search by first halves only, so no pair counts twice.

Defined results: a null or empty text has no words; runs of a document that are spelled alike meet the same fate, and a
null id is the text "null"; repeated rows count each; very long texts and runs are read whole; ties of the largest near
word go to the smallest in code-point order; a word nobody is near to has no form and is its own root; no documents give
no rows.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from predia.llm.common import settle

RUN = "[A-Za-zÀ-ÿ]"
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
DAMAGE = 31
SHORTEST = 7
LEAST_COUNT = 2
FORM_FACTOR = 10
BIN_SYMBOLS = 100_000
FLUSH_WORDS = 200_000
MERGE_TURNS = 16
DELIMITER = 0


def damaged(doc_id: object, run: str) -> str:
    """The run, lower-cased, and one code point shorter where its checksum with the document's id says so."""
    run = run.translate(LOWER)
    check = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
    if check % DAMAGE:
        return run
    at = check % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n: the words of all whole texts that count, each with its occurrences."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = re.compile(RUN + "{" + str(SHORTEST) + ",}")
        words: Counter = Counter()

        def rows() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], ["word", "n"])
            words.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                for run, n in Counter(runs.findall(text.as_py() or "")).items():
                    word = damaged(doc_id, run)
                    if len(word) >= SHORTEST:
                        words[word] += n
                if len(words) >= FLUSH_WORDS:
                    yield rows()
        yield rows()

    counts = docs.select(F.col("doc_id").cast("string"), "text").mapInArrow(counted, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def routes(words: DataFrame) -> DataFrame:
    """side, half, word, n, asks: under which halves each word is indexed, and whether it asks there itself."""
    size = F.char_length("word")
    longest = F.array(F.greatest(size - 1, F.lit(SHORTEST)), size, size + 1)
    first = F.array_distinct(F.transform(longest, lambda m: F.floor(m / 2).cast("int")))
    second = F.array_distinct(F.transform(longest, lambda m: (m - F.floor(m / 2)).cast("int")))

    def side(name: str, sizes, own, cut) -> F.Column:
        return F.transform(sizes, lambda k: F.struct(
            F.lit(name).alias("side"), cut(k).alias("half"), (k == own).alias("asks")))

    every = F.concat(side("<", first, F.floor(size / 2), lambda k: F.expr("word").substr(F.lit(1), k)),
                     side(">", second, size - F.floor(size / 2), lambda k: F.expr("word").substr(size - k + 1, k)))
    return words.select("word", "n", F.explode(every).alias("r")).select("r.side", "r.half", "word", "n", "r.asks")


def binned(words: DataFrame, bin_symbols: int = BIN_SYMBOLS) -> DataFrame:
    """bin, side, word, n, indexed, asks: what every bin indexes and is asked.

    Halves share bins of about ``bin_symbols`` code points. A half whose words have more of them has its own bins.
    """
    rows = settle(routes(words), "spelling-routes")
    size = F.sum(F.char_length("word") + 1)
    bins = max(1, math.ceil((rows.agg(size).first()[0] or 0) / bin_symbols))
    hot = (rows.groupBy("side", "half").agg(size.alias("size")).where(F.col("size") > bin_symbols)
           .select(F.col("side").alias("_side"), F.col("half").alias("_half"),
                   F.ceil(F.col("size") / bin_symbols).cast("int").alias("blocks")))
    dealt = rows.join(hot, (F.col("side") == F.col("_side")) & (F.col("half") == F.col("_half")), "left")
    own = F.when(F.col("blocks").isNotNull(), F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    # A question goes to every block of its half, a word is indexed in one.
    spread = F.when(F.col("blocks").isNotNull() & F.col("asks"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(
        F.array(F.coalesce(own, F.lit(0))))
    placed = dealt.withColumn("own", own).withColumn("block", F.explode(spread))
    shared = F.pmod(F.xxhash64("side", "half"), F.lit(bins)).cast("string")
    name = F.when(F.col("blocks").isNull(), shared).otherwise(F.concat("side", "half", F.lit("/"), F.col("block")))
    indexed = F.col("own").isNull() | (F.col("own") == F.col("block"))
    return placed.select(name.alias("bin"), "side", "word", "n", indexed.alias("indexed"), "asks")


def suffix_order(text: np.ndarray) -> np.ndarray:
    """The suffixes of a text in order, by doubling the length up to which they are sorted."""
    size = len(text)
    rank, step = text.astype(np.int64), 1
    while True:
        after = np.zeros(size, np.int64)
        after[:size - step] = rank[step:] + 1
        key = rank * (size + 256) + after
        order = np.argsort(key, kind="stable")
        changed = np.empty(size, np.int64)
        changed[order] = np.concatenate(([0], np.cumsum(key[order][1:] != key[order][:-1])))
        rank, step = changed, step * 2
        if rank[order[-1]] == size - 1 or step >= size:
            return order


class Side:
    """Ranks of one direction: how often each symbol stands before a row of the sorted suffixes."""

    def __init__(self, text: np.ndarray, symbols: int):
        self.order = suffix_order(text)
        last = text[self.order - 1]
        counts = np.zeros((len(text) + 1, symbols), np.int32)
        counts[np.arange(1, len(text) + 1), last] = 1
        self.before = np.cumsum(counts, axis=0, dtype=np.int32, out=counts)


class BidirectionalIndex:
    """FM-indexes of the delimited vocabulary and of its reverse, searched in step.

    A state is (low, low_reversed, size): the suffixes that begin with a string, and those of the reversed text that
    begin with the reversed string; both intervals have one size.
    """

    def __init__(self, words: list[str], letters: str):
        """Over different ``words`` in order, each after a delimiter, and one more at the end.

        ``letters`` are those of the words and of all that will be asked.
        """
        self.letters = np.unique(np.frombuffer(letters.encode("utf-32-le"), np.uint32))
        delimited, starts, sizes = self.encoded(words)
        text = np.concatenate((np.array([DELIMITER], np.uint8), delimited))
        self.starts = np.concatenate((starts, [len(text) - 1]))
        self.symbols = len(self.letters) + 1
        self.text = text
        self.left, self.right = Side(text, self.symbols), Side(text[::-1].copy(), self.symbols)
        total = np.bincount(text, minlength=self.symbols)
        self.first = (np.cumsum(total) - total).astype(np.int64)

    def encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All words as symbols, each with a delimiter after it, where each starts, and their lengths."""
        sizes = np.array([len(w) for w in words], np.int64)
        starts = np.cumsum(sizes + 1) - sizes - 1
        out = np.full(int(sizes.sum()) + len(words), DELIMITER, np.uint8)
        inside = np.ones(len(out), bool)
        inside[starts + sizes] = False
        out[inside] = np.searchsorted(self.letters, np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)) + 1
        return out, starts, sizes

    def everywhere(self, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        zero = np.zeros(count, np.int64)
        return zero, zero.copy(), np.full(count, len(self.text), np.int64)

    def extend(self, state, symbol: np.ndarray, leftwards: bool):
        """The states after one more symbol at one end of the matched string."""
        side = self.left if leftwards else self.right
        low, other, size = state if leftwards else (state[1], state[0], state[2])
        above, below = side.before[low + size], side.before[low]
        at = np.arange(len(symbol))
        inside = above - below
        fewer = np.cumsum(inside, axis=1) - inside
        new = (self.first[symbol] + below[at, symbol], other + fewer[at, symbol], inside[at, symbol].astype(np.int64))
        return new if leftwards else (new[1], new[0], new[2])

    def extend_all(self, state, leftwards: bool):
        """The states after every symbol but the delimiter that goes on: (row of the state, symbol, new states)."""
        side = self.left if leftwards else self.right
        low, other, size = state if leftwards else (state[1], state[0], state[2])
        below = side.before[low]
        inside = side.before[low + size] - below
        fewer = np.cumsum(inside, axis=1) - inside
        row, symbol = np.nonzero(inside[:, 1:])
        symbol = symbol + 1
        new = (self.first[symbol] + below[row, symbol], other[row] + fewer[row, symbol],
               inside[row, symbol].astype(np.int64))
        return row, symbol, (new if leftwards else (new[1], new[0], new[2]))

    def near(self, words: list[str], first_half: bool, chunk: int = 1024) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (asked word, indexed word), by place, that are one edit apart and agree in the asked one's half.

        The exact half is matched outwards from the middle, to the word's end with its delimiter; then the match is
        extended over the other half, where one symbol may be replaced, skipped or put in, up to the other delimiter.
        Searches by second halves leave out pairs whose first halves agree too.
        """
        found = [self._near(words[i:i + chunk], i, first_half) for i in range(0, len(words), chunk)]
        pairs = np.concatenate([np.empty((0, 2), np.int64), *found])
        return pairs[:, 0], pairs[:, 1]

    def _near(self, words: list[str], offset: int, first_half: bool) -> np.ndarray:
        symbols, starts, sizes = self.encoded(words)
        middle = sizes // 2
        query = np.arange(len(words))
        state = self.everywhere(len(words))
        # The exact half: from the middle to its end of the word, the delimiter included.
        steps = middle + 1 if first_half else sizes - middle + 1
        for step in range(int(steps.max(initial=0))):
            on = np.flatnonzero((step < steps[query]) & (state[2] > 0))
            if not len(on):
                continue
            asked = query[on]
            place = middle[asked] - 1 - step if first_half else middle[asked] + step
            symbol = np.where(place < 0, DELIMITER, symbols[starts[asked] + np.maximum(place, 0)])
            moved = self.extend(tuple(s[on] for s in state), symbol, first_half)
            for old, new in zip(state, moved):
                old[on] = new
        alive = state[2] > 0
        query, state = query[alive], tuple(s[alive] for s in state)
        # The other half, away from the middle: ``done`` symbols of it are used up.
        rest = sizes - middle if first_half else middle
        done, erred = np.zeros(len(query), np.int64), np.zeros(len(query), bool)
        hits = []

        def symbol_at(asked: np.ndarray, used: np.ndarray) -> np.ndarray:
            place = middle[asked] + used if first_half else middle[asked] - 1 - used
            return np.where(used >= rest[asked], DELIMITER, symbols[starts[asked] + np.clip(place, 0, sizes[asked])])

        turns = 0
        while len(query):
            turns += 1
            if turns % MERGE_TURNS == 0:
                # In a long word of repeated letters many errors lead to one state.
                _, first = np.unique(np.column_stack([query, done, erred, *state]), axis=0, return_index=True)
                query, done, erred, state = query[first], done[first], erred[first], tuple(s[first] for s in state)
            left = rest[query] - done
            # Next symbol as it is; at the end it is the delimiter, which ends a match.
            exact = self.extend(state, symbol_at(query, done), not first_half)
            ended = (left == 0) & erred & (exact[2] > 0)
            if ended.any():
                hits.append(self._words_of(query[ended] + offset, tuple(s[ended] for s in exact), first_half))
            go = (left > 0) & (exact[2] > 0)
            parts = [(query[go], tuple(s[go] for s in exact), done[go] + 1, erred[go])]
            clean = np.flatnonzero(~erred)
            if len(clean):
                # Skipped: a symbol of the asked word that the other lacks.
                skip = clean[left[clean] > 0]
                parts.append((query[skip], tuple(s[skip] for s in state), done[skip] + 1, np.ones(len(skip), bool)))
                row, symbol, wider = self.extend_all(tuple(s[clean] for s in state), not first_half)
                at = clean[row]
                # Put in: a symbol that the asked word lacks. Replaced: another symbol in place of the next.
                parts.append((query[at], wider, done[at], np.ones(len(at), bool)))
                other = (left[at] > 0) & (symbol != symbol_at(query[at], done[at]))
                parts.append((query[at[other]], tuple(s[other] for s in wider), done[at[other]] + 1,
                              np.ones(int(other.sum()), bool)))
            query = np.concatenate([p[0] for p in parts])
            state = tuple(np.concatenate([p[1][i] for p in parts]) for i in range(3))
            done = np.concatenate([p[2] for p in parts])
            erred = np.concatenate([p[3] for p in parts])
        pairs = np.unique(np.concatenate([np.empty((0, 2), np.int64), *hits]), axis=0)
        if not first_half:
            asked, size = pairs[:, 0] - offset, middle[pairs[:, 0] - offset]
            ends = np.cumsum(size)
            within = np.arange(size.sum()) - np.repeat(ends - size, size)
            other = np.repeat(self.starts[pairs[:, 1]] + 1, size) + within
            # A shorter word ends with a delimiter, which no first half holds.
            same = symbols[np.repeat(starts[asked], size) + within] == self.text[np.minimum(other, len(self.text) - 1)]
            differing = np.concatenate(([0], np.cumsum(~same)))
            pairs = pairs[differing[ends] > differing[ends - size]]
        return pairs

    def _words_of(self, query: np.ndarray, state, first_half: bool) -> np.ndarray:
        """(asked word, place of the word) for every row of the final intervals; each holds a whole delimited word."""
        low, _, size = state
        row = np.repeat(np.arange(len(query)), size)
        within = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        start = self.left.order[low[row] + within]
        return np.column_stack([query[row], np.searchsorted(self.starts, start)])


NEAR = "word string, n_near long, best_n long, best string"
EMPTY = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def near_in_bin(table: pa.Table) -> pa.Table:
    """Of each asked word of a bin: how many words of its index are near, the largest of them and its occurrences."""
    table = table.combine_chunks()
    counts = dict(zip(table["word"].to_pylist(), table["n"].to_pylist()))
    words = sorted(set(table.filter(table["indexed"])["word"].to_pylist()))
    index = BidirectionalIndex(words, "".join(counts)) if words else None
    count = np.array([counts[w] for w in words], np.int64)
    out = []
    for side in "<>" if words else "":
        asked = sorted(set(table.filter(pc.and_(table["asks"], pc.equal(table["side"], side)))["word"].to_pylist()))
        query, place = index.near(asked, side == "<")
        # Per asked word the largest first, then the first in order, which is the order of the index.
        order = np.lexsort((place, -count[place], query))
        query, place = query[order], place[order]
        names, first, sizes = np.unique(query, return_index=True, return_counts=True)
        out.append(pa.table({
            "word": pa.array([asked[i] for i in names], pa.string()), "n_near": pa.array(sizes, pa.int64()),
            "best_n": pa.array(count[place[first]], pa.int64()),
            "best": pa.array([words[i] for i in place[first]], pa.string())}))
    return pa.concat_tables(out) if out else EMPTY.empty_table()


def near_words(words: DataFrame, bin_symbols: int = BIN_SYMBOLS) -> DataFrame:
    """word, n_near, best_n, best of every word that has near ones: their number, the largest and its occurrences."""
    bins = settle(binned(words, bin_symbols), "spelling-bins")
    found = bins.groupBy("bin").applyInArrow(near_in_bin, NEAR)
    largest = F.min(F.struct((-F.col("best_n")).alias("n"), "best"))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), largest.alias("b"))
            .select("word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.best").alias("best")))


def roots(forms: DataFrame, longest: int) -> DataFrame:
    """word, root: where the links (word, form) of at most ``longest`` steps end. Each round doubles the steps taken."""
    ends = forms.select("word", F.col("form").alias("root"))
    for turn in range(max(0, longest - 1).bit_length()):
        ends = settle(ends, f"spelling-roots-{turn}")
        further = ends.select(F.col("word").alias("_from"), F.col("root").alias("_to"))
        ends = (ends.join(further, F.col("root") == F.col("_from"), "left")
                .select("word", F.coalesce("_to", "root").alias("root")))
    return ends


def variants(docs: DataFrame, bin_symbols: int = BIN_SYMBOLS) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of the documents.

    A word's form is its largest near word, if that one is ten times as frequent; its root is the last of its forms.
    """
    words = settle(word_counts(docs), "spelling-words")
    near = near_words(words, bin_symbols)
    is_form = F.col("best_n") >= FORM_FACTOR * F.col("n")
    judged = settle(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best")).alias("form"),
            F.when(is_form, F.col("best_n")).alias("form_n")), "spelling-forms")
    # Every step multiplies the occurrences, so the largest word bounds the steps.
    largest, longest = judged.agg(F.max("n")).first()[0] or 0, 0
    while LEAST_COUNT * FORM_FACTOR ** (longest + 1) <= largest:
        longest += 1
    ends = roots(judged.where(F.col("form").isNotNull()), longest).withColumnRenamed("word", "_word")
    return judged.join(ends, F.col("word") == F.col("_word"), "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
