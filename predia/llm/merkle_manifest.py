"""Merkle manifest of a dataset: a digest per row, a tree per source, a tree over the sources, and a proof per row.

Time-forward processing. A node's label is its height and place; digests are messages to the parent's label, proofs are
messages to the children's. Rows of a source are numbered by one sort over all rows (range partitions, then the sums of
their counts), so a source that holds most rows lies in many partitions. The trees are then swept in blocks of 3^8
neighbouring nodes, which hold whole subtrees of eight levels: a round sends every block's digests to it through a
shuffle ordered by label, the block hands digests to parents through a priority queue ordered by label, and what is left
goes to the block above. The reversed sweep goes down through the same blocks: each gets what a proof holds above it,
and gives every child the siblings it lacks. A round leaves a 6,561st of the nodes, so a hundred thousand million rows
take three rounds, and no task holds more than a block.

Defined results: a null differs from an empty text in every column; a null source is a source of its own, before all
others; rows without id come first in their source, and are not tampered with; rows of a source with one id follow
their leaf digest, so repeated rows stand side by side as leaves of their own, with a proof each; very long texts
are hashed whole; a source of one row has that leaf as its subroot, with nothing to prove below it; columns other than
the five of the leaf do not count; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from predia.llm.common import settle

FAN = 3
HEIGHT = 8
BLOCK = FAN ** HEIGHT
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
ROWS_PER_PARTITION = 200_000

NODES = "tree binary, place long, digest binary, levels long"
PROOFS = "tree binary, place long, proof array<binary>"


def digest_of(parts: list[bytes]) -> bytes:
    """H: the digests as hex text, one after the other, hashed."""
    return hashlib.sha256("".join(p.hex() for p in parts).encode()).digest()


def leaf(columns: dict[str, F.Column]) -> F.Column:
    """H of a row's values, each with its length in bytes before it."""
    def part(value: F.Column) -> F.Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*[part(columns[c]) for c in COLUMNS]), 256))


def levels_of(count: F.Column) -> F.Column:
    """How many levels of parents stand above so many nodes: the least l with 3^l of at least that number."""
    reached = F.lit(0)
    for level in range(40):
        reached = reached + (count > FAN ** level).cast("long")
    return reached


def numbered(rows: DataFrame, tree: str, order: list[str], purpose: str) -> DataFrame:
    """``rows`` with their place within each tree by ``order``, and ``leaves``, the number of rows of that tree.

    One sort over all rows, then a place is the place in the partition plus the rows of that tree in the partitions
    before. A tree may be null. Equal rows get places of their own.
    """
    rows = settle(rows, f"{purpose}-rows")
    partitions = max(1, math.ceil(rows.count() / ROWS_PER_PARTITION))
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Equal rows may be a third of all, so their place where they were read settles how the range is cut.
    sorted_rows = (rows.withColumn("_read", F.monotonically_increasing_id())
                   .repartitionByRange(max(partitions, least), tree, *order, "_read")
                   .sortWithinPartitions(tree, *order, "_read").drop("_read"))
    at = F.monotonically_increasing_id()
    placed = settle(sorted_rows.withColumn("_at", at).withColumn("_part", F.shiftright("_at", 33)), f"{purpose}-sorted")
    per_part = placed.groupBy(tree, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    parts = Window.partitionBy(tree).orderBy("_part")
    before = F.sum("_rows").over(parts.rowsBetween(Window.unboundedPreceding, -1))
    every = F.sum("_rows").over(parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    starts = per_part.select(F.col(tree).alias("_tree"), F.col("_part").alias("_p"), "_first",
                             F.coalesce(before, F.lit(0)).alias("_before"), every.alias("leaves"))
    places = placed.join(starts, placed[tree].eqNullSafe(F.col("_tree")) & (F.col("_part") == F.col("_p")))
    return (places.withColumn("place", F.col("_at") - F.col("_first") + F.col("_before"))
            .drop("_at", "_part", "_tree", "_p", "_first", "_before"))


def sweep_up(digests: list[bytes], levels: int) -> dict[tuple[int, int], bytes]:
    """All nodes of a block by label (height, place), from its leaves up through ``levels`` levels.

    The queue holds digests under the label of the parent they are sent to; the least label has got all its messages
    when it comes to the front.
    """
    nodes = {(0, place): digest for place, digest in enumerate(digests)}
    queue = [((1, place // FAN), place, digest) for place, digest in enumerate(digests)] if levels else []
    while queue:
        label, _, digest = heapq.heappop(queue)
        children = [digest]
        while queue and queue[0][0] == label:
            children.append(heapq.heappop(queue)[2])
        nodes[label] = digest_of(children)
        height, place = label
        if height < levels:
            heapq.heappush(queue, ((height + 1, place // FAN), place, nodes[label]))
    return nodes


def sweep_down(nodes: dict[tuple[int, int], bytes], levels: int, above: list[bytes]) -> dict[int, list[bytes]]:
    """The proof of every leaf of a block, given the proof of its top: parents first, each to its children.

    A step of a proof is one byte, how many siblings stand left, and the siblings' digests in order.
    """
    proofs = {(levels, 0): above}
    for height, place in sorted((label for label in nodes if label[0]), reverse=True):
        proof = proofs.pop((height, place))
        children = [p for p in range(place * FAN, place * FAN + FAN) if (height - 1, p) in nodes]
        for child in children:
            siblings = b"".join(nodes[height - 1, p] for p in children if p != child)
            proofs[height - 1, child] = [bytes([child - children[0]]) + siblings, *proof]
    return {place: proof for (_, place), proof in proofs.items()}


def siblings_of(step: bytes) -> list[bytes]:
    return [step[i:i + 32] for i in range(1, len(step), 32)]


def folded(digest: bytes, proof: list[bytes]) -> bytes:
    """The root that a leaf and its proof lead to."""
    for step in proof:
        siblings = siblings_of(step)
        digest = digest_of([*siblings[:step[0]], digest, *siblings[step[0]:]])
    return digest


def _blocks(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("place") / BLOCK))


def _in_order(table: pa.Table) -> tuple[bytes | None, pa.Table, int]:
    """A block's tree, its rows by place, and the levels it spans."""
    table = table.sort_by("place")
    return table["tree"][0].as_py(), table, min(HEIGHT, table["levels"][0].as_py())


def _parents(table: pa.Table) -> pa.Table:
    tree, table, levels = _in_order(table)
    nodes = sweep_up(table["digest"].to_pylist(), levels)
    return pa.table({
        "tree": pa.array([tree], pa.binary()), "place": pa.array([table["block"][0].as_py()], pa.int64()),
        "digest": pa.array([nodes[levels, 0]], pa.binary()),
        "levels": pa.array([table["levels"][0].as_py() - levels], pa.int64())})


def _children(nodes: pa.Table, above: pa.Table) -> tuple[pa.Table, list[list[bytes]]]:
    """The rows of a block by place, and the proof of each."""
    _, table, levels = _in_order(nodes)
    top = above["proof"][0].as_py() if above.num_rows else []
    proofs = sweep_down(sweep_up(table["digest"].to_pylist(), levels), levels, top)
    return table, [proofs[i] for i in range(table.num_rows)]


def _proofs(nodes: pa.Table, above: pa.Table) -> pa.Table:
    if not nodes.num_rows:
        return pa.table({"tree": pa.array([], pa.binary()), "place": pa.array([], pa.int64()),
                         "proof": pa.array([], pa.list_(pa.binary()))})
    table, proofs = _children(nodes, above)
    return pa.table({"tree": table["tree"], "place": table["place"], "proof": pa.array(proofs, pa.list_(pa.binary()))})


def tree_tops(nodes: DataFrame, purpose: str) -> list[DataFrame]:
    """The nodes of every round, leaves first; in the last one every tree has one node, its root."""
    highest = nodes.agg(F.max("levels")).first()[0] or 0
    rounds = [nodes]
    for turn in range(math.ceil(highest / HEIGHT)):
        above = _blocks(rounds[-1]).groupBy("tree", "block").applyInArrow(_parents, NODES)
        rounds.append(settle(above, f"{purpose}-{turn}"))
    return rounds


def proofs_down(rounds: list[DataFrame], proofs: DataFrame) -> DataFrame:
    """The proofs that the rows of the first round need from the round above, given those of the last round's rows."""
    for nodes in rounds[-2:0:-1]:
        proofs = delivered(nodes, proofs, _proofs, PROOFS)
    return proofs


def delivered(nodes: DataFrame, proofs: DataFrame, work, schema: str) -> DataFrame:
    """``work`` on every block of nodes and the proof of its top."""
    above = proofs.withColumnRenamed("place", "block")
    return _blocks(nodes).groupBy("tree", "block").cogroup(above.groupBy("tree", "block")).applyInArrow(work, schema)


MANIFEST = ("doc_id long, source string, leaf binary, subroot binary, root binary, proof array<binary>, "
            "folded_root binary, verified boolean")


def _manifest_rows(nodes: pa.Table, above: pa.Table) -> pa.Table:
    if not nodes.num_rows:
        nodes, proofs = nodes.append_column("proof", pa.array([], pa.list_(pa.binary()))), []
        subroot = root = None
    else:
        nodes, proofs = _children(nodes, above)
        subroot, root = above["subroot"][0].as_py(), above["root"][0].as_py()
    count = nodes.num_rows
    reached = [folded(digest, proof) for digest, proof in zip(nodes["tampered"].to_pylist(), proofs)]
    return pa.table({
        "doc_id": nodes["doc_id"], "source": nodes["source"], "leaf": nodes["digest"],
        "subroot": pa.array([subroot] * count, pa.binary()), "root": pa.array([root] * count, pa.binary()),
        "proof": pa.array(proofs, pa.list_(pa.binary())), "folded_root": pa.array(reached, pa.binary()),
        "verified": pa.array([r == root for r in reached], pa.bool_())})


def manifest(docs: DataFrame) -> DataFrame:
    """Every row with its leaf, the roots, its proof, and the root that the row as it may have been tampered with gives.

    doc_id, source, leaf, subroot, root (digests), proof (from the leaf up, a step a level: the number of siblings to
    the left in one byte, then the siblings), folded_root, verified: whether that is the root.
    """
    values = {"doc_id": "long", "source": "string", "lang": "string", "n_chars": "long", "text": "string"}
    rows = docs.select(*[F.col(c).cast(kind).alias(c) for c, kind in values.items()])
    given = {c: F.col(c) for c in COLUMNS}
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    without_lines = leaf({**given, "text": F.translate("text", "\n", "")})
    leaves = rows.select(
        "doc_id", "source", F.when(F.col("source").isNotNull(), F.col("source").cast("binary")).alias("tree"),
        leaf(given).alias("digest"), F.when(tampered, without_lines).alias("tampered"))
    leaves = leaves.withColumn("tampered", F.coalesce("tampered", "digest"))
    places = numbered(leaves, "tree", ["doc_id", "digest"], "merkle")
    leaves = settle(places.withColumn("levels", levels_of(F.col("leaves"))).drop("leaves"), "merkle-leaves")

    below = tree_tops(leaves, "merkle-source")
    subroots = below[-1].select(F.col("tree").alias("of"), "digest", F.lit(b"").alias("tree"))
    placed = numbered(subroots, "tree", ["of"], "merkle-sources")
    subroots = settle(placed.withColumn("levels", levels_of(F.col("leaves"))), "merkle-subroots")
    over = tree_tops(subroots.select("tree", "place", "digest", "levels"), "merkle-root")
    root = over[-1].select(F.col("tree").alias("_top"), F.col("digest").alias("root"))

    # From the root down to the sources, then down each source's tree.
    nothing = over[-1].select("tree", "place", F.array().cast("array<binary>").alias("proof"))
    if len(over) > 1:
        nothing = delivered(over[0], proofs_down(over, nothing), _proofs, PROOFS)
    top = nothing.select(F.col("place").alias("_place"), "proof")
    named = settle(
        subroots.join(top, F.col("place") == F.col("_place")).join(root, F.col("tree") == F.col("_top"))
        .select(F.col("of").alias("tree"), F.lit(0).cast("long").alias("place"), "proof",
                F.col("digest").alias("subroot"), "root"), "merkle-tops")
    above = proofs_down(below, named.select("tree", "place", "proof")) if len(below) > 1 else named
    if len(below) > 1:
        roots = named.select(F.col("tree").alias("_tree"), "subroot", "root")
        above = above.join(roots, F.col("tree").eqNullSafe(F.col("_tree"))).drop("_tree")
    return delivered(leaves, above, _manifest_rows, MANIFEST)


def proof_text(proof: F.Column) -> F.Column:
    """The siblings of a proof as hex text, from the leaf to the root."""
    return F.lower(F.array_join(F.transform(proof, lambda step: F.hex(F.substring(step, 2, 64))), ""))


def digests(rows: DataFrame) -> DataFrame:
    """A manifest with its digests as lowercase hex and the proof as one digest."""
    text = {c: F.lower(F.hex(c)).alias(c) for c in ("leaf", "subroot", "root", "folded_root")}
    return rows.select("doc_id", text["leaf"], text["subroot"], text["root"],
                       F.sha2(proof_text(F.col("proof")), 256).alias("proof_sha256"), text["folded_root"], "verified")
