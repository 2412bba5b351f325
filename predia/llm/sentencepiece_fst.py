"""SentencePiece encoding and decoding by a weighted finite-state transducer.

Three machines are compiled from a model file and composed with each input:

* the normaliser writes a space as the model's space mark and puts one mark in front,
* the pieces are a loop of all vocabulary pieces, each arc writes its id,
* the byte fallback writes a character that no piece holds as the ids of its UTF-8 bytes.

The result is the shortest path in the tropical semiring. For a unigram model an arc weighs the negative score of its
piece. A merge (BPE) model has no such weights: its encoding is the one path on which every two neighbours are what
merging would leave apart, so a fourth machine weighs neighbours 0 or infinite. Every prefix has one finite path, so
one state per place is enough. Whether merging leaves two neighbours apart follows from the pieces' own merges along
the seam (see ``Merges.apart``).

No piece has a space mark after another character (checked when compiling), and characters that stand side by side in
no piece have a seam between them, so every path has seams at known places. Composition runs from seam to seam, and
each worker keeps the paths of parts it has met, as many as ``remembered``; then it starts anew.

Defined results: a null text counts as empty and has no ids; texts are taken whole, however long; the mark itself in a
text reads as a space; repeated rows are encoded each.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MARK = "▁"
UNIGRAM, MERGE = 1, 2
BYTE_WEIGHT = 1e6
PORTION = 4_000_000
ENCODED = "doc_id long, ids array<int>"
DECODED = "doc_id long, text string"
RESULT = "doc_id long, n_ids long, n_bytes long, ids array<int>, decoded string, restored boolean"


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of the fields of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        number, kind = divmod(varint(), 8)
        if kind == 0:
            yield number, varint()
            continue
        size = {1: 8, 2: None, 5: 4}[kind]
        size = varint() if size is None else size
        yield number, data[at:at + size]
        at += size


def settings_of(data: bytes) -> tuple[int, bool, bool, bytes]:
    """Of a model file: kind of model, mark in front, squeezed spaces, compiled character map."""
    kind, front, squeeze, characters = UNIGRAM, True, True, b""
    for number, value in fields(data):
        if number == 2:
            kind = next((v for n, v in fields(value) if n == 3), kind)
        elif number == 3:
            for n, v in fields(value):
                if n == 2:
                    characters = v
                elif n == 3:
                    front = bool(v)
                elif n == 4:
                    squeeze = bool(v)
    return kind, front, squeeze, characters


class Merges:
    """What merging does inside each piece, and whether it leaves two neighbouring pieces apart.

    A pair of neighbours merges into the piece that both spell, pieces of better score first, the leftmost of equals
    first. ``rank`` is the place of a piece by score; single characters are there from the start, at rank -1.
    """

    def __init__(self, pieces: dict[str, int], scores: dict[int, float]):
        self.pieces = pieces
        order = sorted((p for p in pieces if len(p) > 1), key=lambda p: -scores[pieces[p]])
        self.rank = {pieces[p]: i for i, p in enumerate(order)} | {i: -1 for p, i in pieces.items() if len(p) == 1}
        self.at_rank = [pieces[p] for p in order]
        self.halves: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        for p in order:
            for cut in range(1, len(p)):
                a, b = pieces.get(p[:cut]), pieces.get(p[cut:])
                if a is not None and b is not None:
                    self.joined[a, b] = self.rank[pieces[p]]
        for p in order:
            halves = self.last_merge(p)
            if halves is not None:
                if max(self.rank[h] for h in halves) >= self.rank[pieces[p]]:
                    raise ValueError(f"piece {p!r} is made from a piece of worse score")
                self.halves[pieces[p]] = halves
        self.reachable = {p: i for p, i in pieces.items() if len(p) == 1 or i in self.halves}
        # Along the seam: piece, when it was made, when it went into the next larger one.
        self.right = {i: self.side(i, 1) for i in self.reachable.values()}
        self.left = {i: self.side(i, 0) for i in self.reachable.values()}
        self.known: dict[tuple[int, int], bool] = {}

    def last_merge(self, piece: str) -> tuple[int, int] | None:
        """The two pieces whose merge makes this one, or none if merging its characters ends elsewhere."""
        parts = [self.pieces.get(c) for c in piece]
        if None in parts:
            return None
        while len(parts) > 1:
            best = min(((self.joined[pair], at) for at, pair in enumerate(zip(parts, parts[1:])) if pair in self.joined),
                       default=None)
            if best is None:
                return None
            at = best[1]
            halves = parts[at], parts[at + 1]
            parts[at:at + 2] = [self.at_rank[best[0]]]
        return halves if parts[0] == self.pieces[piece] else None

    def side(self, piece: int, end: int) -> list[tuple[int, int, float]]:
        out, until = [], float("inf")
        while True:
            out.append((piece, self.rank[piece], until))
            if piece not in self.halves:
                return out
            until = self.rank[piece]
            piece = self.halves[piece][end]

    def apart(self, a: int, b: int) -> bool:
        """Whether no merge crosses the seam of a and b.

        Going back in time, the pieces at the seam fall into their halves. Two that stand there at one time would merge
        if their merge comes before either goes into its next larger piece; of equal ranks the leftmost merges first.
        """
        key = a, b
        if key in self.known:
            return self.known[key]
        xs, ys, i, j, answer = self.right[a], self.left[b], 0, 0, True
        while True:
            x, x_made, x_until = xs[i]
            y, y_made, y_until = ys[j]
            rank = self.joined.get((x, y))
            if rank is not None and rank < x_until and rank <= y_until:
                answer = False
                break
            if x_made < 0 and y_made < 0:
                break
            if x_made > y_made:
                i += 1
            else:
                j += 1
        if len(self.known) >= 1_000_000:
            self.known.clear()
        self.known[key] = answer
        return answer


def part_pattern(pieces: Iterable[str]) -> str:
    """A pattern of parts between which no piece spans: characters that stand side by side in a piece keep together."""
    group: dict[str, str] = {}

    def root(c: str) -> str:
        while group.setdefault(c, c) != c:
            c = group[c]
        return c

    for piece in pieces:
        plain = piece.lstrip(MARK)
        for a, b in zip(plain, plain[1:]):
            group[root(a)] = root(b)
    classes: dict[str, list[str]] = {}
    for c in sorted(group):
        classes.setdefault(root(c), []).append(c)
    runs = [f"[{re.escape(''.join(cs))}]+" for cs in sorted(classes.values(), key=len, reverse=True)]
    return f"{MARK}*(?:{'|'.join([*runs, f'[^{MARK}]'])})|{MARK}+"


class Paths(dict):
    """The ids of parts met before, as little-endian bytes; a new part is composed when it is asked for."""

    def __init__(self, machine: "Machine", remembered: int):
        super().__init__()
        self.machine, self.remembered = machine, remembered

    def __missing__(self, part: str) -> bytes:
        if len(self) >= self.remembered:
            self.clear()
        ids = np.array(self.machine.shortest_path(part), "<u4").tobytes()
        self[part] = ids
        return ids


class Machine:
    """The composed transducer of a model file."""

    def __init__(self, model: bytes, remembered: int = 400_000):
        processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.kind, self.front, squeeze, characters = settings_of(model)
        if squeeze or characters:
            raise ValueError("this normaliser squeezes spaces or maps characters; only the identity is compiled")
        if self.kind not in (UNIGRAM, MERGE):
            raise ValueError("only unigram and merge models have pieces that are arcs")
        n = processor.get_piece_size()
        text_of, plain, scores, self.byte_ids = {}, {}, {}, {}
        for i in range(n):
            piece = processor.id_to_piece(i)
            if processor.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                text_of[i] = bytes([int(piece[3:5], 16)])
            elif processor.is_unknown(i) or processor.is_control(i) or processor.is_unused(i):
                text_of[i] = b""
            else:
                plain[piece], scores[i] = i, processor.get_score(i)
                text_of[i] = piece.replace(MARK, " ").encode()
        if any(MARK in p.lstrip(MARK) for p in plain):
            raise ValueError("a piece has a space mark after another character")
        self.text_of = [text_of[i] for i in range(n)]
        self.compile(plain, scores)
        self.paths = Paths(self, remembered)

    def compile(self, pieces: dict[str, int], scores: dict[int, float]) -> None:
        self.scores = scores
        self.merges = Merges(pieces, scores) if self.kind == MERGE else None
        self.pieces = self.merges.reachable if self.merges else pieces
        self.longest = max(map(len, self.pieces), default=1)
        # The longest piece that begins with these three characters.
        self.reach: dict[str, int] = {}
        for piece in self.pieces:
            self.reach[piece[:3]] = max(self.reach.get(piece[:3], 0), len(piece))
        self.part = re.compile(part_pattern(pieces), re.DOTALL)

    def parts(self, text: str) -> list[str]:
        """The normalised text, cut at the places that no piece spans."""
        if not text:
            return []
        return self.part.findall((MARK if self.front else "") + text.replace(" ", MARK))

    def shortest_path(self, part: str) -> list[int]:
        """Ids along the path of least weight; characters without a piece become their bytes."""
        ids: list[int] = []
        for start, piece in self.finite_path(part) if self.merges else self.least_path(part):
            if piece >= 0:
                ids.append(piece)
            else:
                ids.extend(map(self.byte_ids.__getitem__, part[start].encode("utf-8")))
        return ids

    def finite_path(self, part: str) -> list[tuple[int, int]]:
        """Neighbours weigh 0 or infinite: the only finite path, found depth first, long arcs first.

        A prefix has one finite path, so a place that led nowhere once is never tried again.
        """
        end, reach, piece_of, apart = len(part), self.reach.get, self.pieces.get, self.merges.apart
        path: list[tuple[int, int]] = []
        dead: set[int] = set()
        at, stop, before = 0, min(end, reach(part[:3], 2)), -1
        while at < end:
            while stop > at:
                piece = piece_of(part[at:stop])
                if piece is None and stop == at + 1:
                    piece = -1
                if piece is not None and stop not in dead and (before < 0 or piece < 0 or apart(before, piece)):
                    path.append((at, piece))
                    at, before = stop, piece
                    stop = min(end, at + reach(part[at:at + 3], 2))
                    break
                stop -= 1
            else:
                dead.add(at)
                stop = at - 1
                at, _ = path.pop()
                before = path[-1][1] if path else -1
        return path

    def least_path(self, part: str) -> list[tuple[int, int]]:
        """The path of least summed weight, place by place."""
        end = len(part)
        cost, came = [0.0] + [float("inf")] * end, [(0, -1)] * (end + 1)
        for stop in range(1, end + 1):
            for start in range(max(0, stop - self.longest), stop):
                piece = self.pieces.get(part[start:stop])
                if piece is None and stop - start > 1:
                    continue
                weight = cost[start] + (BYTE_WEIGHT if piece is None else -self.scores[piece])
                if weight < cost[stop]:
                    cost[stop], came[stop] = weight, (start, -1 if piece is None else piece)
        path = []
        while end:
            path.append(came[end])
            end = came[end][0]
        return path[::-1]

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.paths.__getitem__, self.parts(text))), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        """The reverse machine: pieces to text, bytes to characters, without the mark in front."""
        text = b"".join(map(self.text_of.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.front and text.startswith(" ") else text


def model_file(name: str = "piece_bpe_32k.model") -> str:
    return public_tokenizers.path(name)


def shared_model(spark: SparkSession, path: str | None) -> Broadcast:
    """The model file, read on the driver and sent to every task; its size is that of a vocabulary."""
    with open(path or model_file(), "rb") as file:
        return spark.sparkContext.broadcast({"model": file.read()})


def machine_of(shared: Broadcast) -> Machine:
    kept = shared.value  # a worker keeps it between tasks, and with it the compiled machine
    return kept.get("machine") or kept.setdefault("machine", Machine(kept["model"]))


def portions(batches: Iterator[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """The batches in portions of about ``size`` bytes of a column, one row at least, so that no result grows large."""
    for batch in batches:
        begin = held = 0
        for i, width in enumerate(pc.binary_length(batch[column]).to_pylist() if pa.types.is_string(batch[column].type)
                                  else pc.list_value_length(batch[column]).to_pylist()):
            if held >= size:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += width or 0
        yield batch.slice(begin)


def lists_of(ids: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, np.concatenate([*ids, np.empty(0, "<u4")]).astype(np.int32))


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and the ids of each row's ``text``. One pass, no shuffle."""
    shared = shared_model(docs.sparkSession, path)

    def worked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = machine_of(shared)
        for batch in portions(batches, "text", PORTION):
            ids = [machine.encode(text.as_py() or "") for text in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], lists_of(ids)], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(worked, ENCODED)


def decode(rows: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and the text of each row's ``ids``; a null list counts as empty. One pass, no shuffle."""
    shared = shared_model(rows.sparkSession, path)

    def worked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = machine_of(shared)
        for batch in portions(batches, "ids", PORTION):
            texts = [machine.decode(ids.values.to_numpy()) if ids.is_valid else "" for ids in batch["ids"]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.select("doc_id", F.col("ids").cast("array<int>").alias("ids")).mapInArrow(worked, DECODED)


def encode_decode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per document: its ids, how many there are and are bytes, their text, and whether that is the document's.

    ``restored`` compares with the text in which the mark itself reads as a space. One pass, no shuffle.
    """
    shared = shared_model(docs.sparkSession, path)

    def worked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = machine_of(shared)
        in_bytes = np.zeros(len(machine.text_of), bool)
        in_bytes[list(machine.byte_ids.values())] = True
        for batch in portions(batches, "text", PORTION):
            texts = [text.as_py() or "" for text in batch["text"]]
            ids = [machine.encode(text) for text in texts]
            back = [machine.decode(i) for i in ids]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(map(len, ids), pa.int64()),
                 pa.array([int(in_bytes[i].sum()) for i in ids], pa.int64()), lists_of(ids),
                 pa.array(back, pa.string()),
                 pa.array([b == t.replace(MARK, " ") for b, t in zip(back, texts)], pa.bool_())],
                ["doc_id", "n_ids", "n_bytes", "ids", "decoded", "restored"])

    return docs.select("doc_id", "text").mapInArrow(worked, RESULT)
