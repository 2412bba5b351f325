"""N-gram Jaccard join: MinHash banding, verified on full n-gram sets.

A document's set holds its runs of five lower-cased words. Documents of equal sets form one class of copies, and one
of them stands for all. ``Banding.for_recall`` chooses rows per band and bands so that a pair at the threshold shares a
band with the wanted probability, then:

1. Representatives are shuffled on their band hashes. In each bucket the smallest id leads, and every other member is
   verified against its leader on the full sets: as many pairs as members, however large the bucket.
2. Links join representatives into components.
3. Buckets whose members lie in different components still hide pairs: those not verified yet. Two exact bounds rule
   most of them out. A shingle that no other candidate has cannot be shared, so two sets share at most what the smaller
   count of other shingles allows. And Jaccard distance is a metric, so the known distances to a leader bound the
   distance of two members. What remains is verified as well, and components are built again.

So every candidate pair of the banding is verified, ruled out by a bound, or lies in one component anyway. A pair that
shares no band at all is missed with the probability that the recall states.

4. Links are counted inside the components, all sets against all: the sets of a component are dealt over blocks, and for
two blocks at a time a product of their incidence matrices says what each two sets share. Only counts leave a task, so
the pairs of a group are never rows, but the work on a group does grow with its square.

Defined results: null and empty texts have no set and link to nothing; a text of one to four words is one run; a row
without id is its own class (class_id null) and links to nothing; repeated rows are copies of each other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from predia.llm.common import MULTIPLIER, mixed, powers, settle, shingle_set


@dataclass(frozen=True)
class Banding:
    """A link is a pair with at least ``threshold`` = ``above`` / ``below`` of Jaccard similarity."""

    rows: int
    bands: int
    above: int = 4
    below: int = 5
    words: int = 5
    seed: int = 5

    @staticmethod
    def for_recall(above: int = 4, below: int = 5, recall: float = 0.9999, most_hashes: int = 128) -> "Banding":
        """The most selective banding (most rows) whose bands reach the recall at the threshold."""
        similarity = above / below
        best = None
        for rows in range(1, most_hashes + 1):
            bands = math.ceil(math.log(1 - recall) / math.log(1 - similarity ** rows))
            if rows * bands <= most_hashes:
                best = Banding(rows, bands, above, below)
        if best is None:
            raise ValueError("no banding reaches this recall with so few hashes")
        return best


def permutations(banding: Banding) -> np.ndarray:
    """An odd multiplier for each hash: multiplying permutes the 64-bit numbers."""
    count = banding.rows * banding.bands
    return mixed(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(banding.seed)) | np.uint64(1)


def band_hashes(shingles: np.ndarray, banding: Banding, odd: np.ndarray) -> np.ndarray:
    """One hash per band of the least permuted shingles; bands differ by their number."""
    least = np.full(len(odd), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 1024):
        np.minimum(least, (shingles[None, at:at + 1024] * odd[:, None]).min(axis=1), out=least)
    out = np.arange(banding.bands, dtype=np.uint64)
    for row in least.reshape(banding.bands, banding.rows).T:
        out = mixed(out * MULTIPLIER + mixed(row))
    return out


def sketches(docs: DataFrame, banding: Banding) -> DataFrame:
    """doc_id, set_key (128 bits of the whole set), n_shingles, buckets; documents without words or id have none."""
    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        power = powers()
        odd = permutations(banding)
        for batch in batches:
            keys, sizes, buckets = [], [], []
            for text in batch["text"]:
                s = shingle_set(text.as_py() or "", power, banding.words)
                sizes.append(len(s))
                keys.append(set_key(s) if len(s) else None)
                buckets.append(band_hashes(s, banding, odd).view(np.int64) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.array(buckets, pa.list_(pa.int64()))], ["doc_id", "set_key", "n_shingles", "buckets"])

    return docs.select("doc_id", "text").mapInArrow(
        sketched, "doc_id long, set_key binary, n_shingles long, buckets array<long>")


def set_key(s: np.ndarray) -> bytes:
    return mixed(s).sum().tobytes() + mixed(s ^ MULTIPLIER).sum().tobytes()


def set_rows(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, set_key and the full set of each document with words."""
    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        power = powers()
        for batch in batches:
            sets = [shingle_set(t.as_py() or "", power, words) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([set_key(s) for s in sets], pa.binary()),
                 pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["doc_id", "set_key", "shingles"])

    return docs.select("doc_id", "text").mapInArrow(full, "doc_id long, set_key binary, shingles array<long>")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) with the sizes of their sets and of what the sets share."""
    a = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("set_a"))
    b = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("set_b"))
    return (pairs.join(a, "a").join(b, "b")
            .select("a", "b", F.size(F.array_intersect("set_a", "set_b")).cast("long").alias("shared"),
                    (F.size("set_a") + F.size("set_b")).cast("long").alias("both")))


def components(links: DataFrame) -> DataFrame:
    """node, component: the smallest node that each node reaches over the links (a, b).

    Least labels spread over the links, and every label is replaced by its label's label, so the number of rounds grows
    with the logarithm of a component's width. Every round is written to the shared folder.
    """
    both = settle(links.select("a", "b").unionAll(links.select("b", "a")).distinct(), "links")
    labels = settle(both.groupBy(F.col("a").alias("node"))
                    .agg(F.least(F.min("b"), F.first("a")).alias("component")), "labels")
    while True:
        near = (both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("near")))
        low = labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        up = labels.select(F.col("node").alias("via"), F.col("component").alias("root"))
        moved = settle(low.join(up, F.col("component") == F.col("via")).select(
            "node", F.least("component", "root").alias("component"), "old"), "labels")
        if moved.where("component <> old").isEmpty():
            return moved.select("node", "component")
        labels = moved.select("node", "component")


def near_duplicates(docs: DataFrame, banding: Banding | None = None) -> DataFrame:
    """One row per document: doc_id, class_id, copy_id, n_links, n_shingles.

    class_id is the smallest doc_id that the document reaches over links, copy_id the smallest with the same set, and
    n_links how many other sets of the class are at the threshold or above.
    """
    banding = banding or Banding.for_recall()
    above, below = banding.above, banding.below
    near = F.col("shared") * (above + below) >= F.col("both") * above
    rows = settle(sketches(docs, banding), "sketches")
    named = rows.where("set_key is not null and doc_id is not null")
    first = named.groupBy("set_key").agg(F.min("doc_id").alias("rep"))
    members = settle(named.select("doc_id", "set_key").distinct().join(first, "set_key"), "copies")
    reps = settle(named.join(first, ["set_key"]).where("doc_id = rep")
                  .select("rep", "set_key", "n_shingles", "buckets").dropDuplicates(["rep"]), "representatives")

    spread = reps.select("rep", F.explode("buckets").alias("bucket"))
    leaders = spread.groupBy("bucket").agg(F.min("rep").alias("leader"), F.count("*").alias("n")).where("n > 1")
    in_bucket = settle(spread.join(leaders.drop("n"), "bucket"), "buckets")
    keys = settle(in_bucket.select("rep").distinct().join(reps, "rep"), "candidates")
    # Candidates grow with the documents, so the join is planned for their size from the start.
    wanted = keys.select(F.col("rep").alias("doc_id")).hint("merge")
    sets = settle(set_rows(docs.join(wanted, "doc_id", "left_semi"), banding.words)
                  .join(keys.select("rep", "set_key"), "set_key").where("doc_id = rep").select("rep", "shingles")
                  .dropDuplicates(["rep"]), "sets")
    sizes = settle(shareable(sets, keys.select("rep", "n_shingles", "buckets")), "sizes")

    star = in_bucket.where("rep <> leader").select("rep", "leader").distinct()
    led = sizes.select(F.col("rep").alias("leader"), F.struct("n_shingles", "common").alias("y"))
    star = (star.join(sizes.select("rep", F.struct("n_shingles", "common").alias("x")), "rep").join(led, "leader")
            .where(may_reach(F.col("x"), F.col("y"), above, below)))
    checked = settle(verified(star.select(F.col("rep").alias("a"), F.col("leader").alias("b")), sets), "verified")
    links = checked.where(near).select("a", "b")

    parts = components(links)
    hidden = hidden_pairs(in_bucket, sizes, parts, checked, above, below)
    more = settle(verified(hidden, sets).where(near).select("a", "b"), "verified-hidden")
    if not more.isEmpty():
        links = links.unionAll(more)
        parts = components(links)

    degree = link_counts(sets, parts, above, below)
    classes = (members.join(parts.withColumnRenamed("node", "rep"), "rep", "left").join(degree, "rep", "left")
               .select(F.col("doc_id").alias("id"), F.col("set_key").alias("key"), "rep", "component", "n_links"))
    # A bucket's leader is its smallest id, and so is a component's label: the class id is a document's id.
    return rows.join(classes, (rows["doc_id"] == classes["id"]) & (rows["set_key"] == classes["key"]), "left").select(
        "doc_id", F.coalesce("component", "rep", "doc_id").alias("class_id"),
        F.coalesce("rep", "doc_id").alias("copy_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), "n_shingles")


def link_counts(sets: DataFrame, parts: DataFrame, above: int, below: int, block: int = 256,
                block_shingles: int = 1 << 20) -> DataFrame:
    """rep, n_links: how many sets of its component each set is linked to, for all sets of ``parts``.

    Two sets that are linked and alone have one link each. A larger component is one block, or several if it has more
    than ``block`` sets or ``block_shingles`` shingles. Then sets are first parted by size, so that linked sets are in
    one part or in two neighbouring ones, and dealt over the blocks of a part by a hash.
    """
    totals = parts.groupBy("component").agg(F.count("*").alias("members"))
    rows = parts.join(totals, "component")
    pairs = rows.where("members = 2").select(F.col("node").alias("rep"), F.lit(1).cast("long").alias("n_links"))
    nodes = rows.where("members > 2").select(F.col("node").alias("rep"), "component").hint("merge")
    placed = settle(sets.join(nodes, "rep").withColumn("size", F.size("shingles").cast("long")), "component-sets")

    def needed():
        return F.ceil(F.greatest(F.count("*") / block, F.sum("size") / block_shingles)).cast("int")

    # A hair wider than the ratio of linked sizes, so that rounding never parts linked sets by two.
    part = F.floor(F.log(F.col("size").cast("double")) / (math.log(below / above) * (1 + 1e-9))).cast("int")
    whole = placed.groupBy("component").agg(needed().alias("all_blocks"))
    placed = placed.join(whole, "component").withColumn("part", F.when(F.col("all_blocks") > 1, part).otherwise(0))
    blocks = placed.groupBy("component", "part").agg(needed().alias("blocks"))
    lower = blocks.select("component", (F.col("part") + 1).alias("part"), F.col("blocks").alias("below"))
    upper = blocks.select("component", (F.col("part") - 1).alias("part"), F.col("blocks").alias("above"))
    around = settle(blocks.join(lower, ["component", "part"], "left").join(upper, ["component", "part"], "left")
                    .na.fill(0, ["below", "above"]), "component-blocks")

    def cells(count, make):
        numbers = F.filter(F.sequence(F.lit(0), count), lambda i: i < count)
        return F.transform(numbers, lambda i: F.struct(F.col("component"), *[c.alias(n) for c, n in zip(
            make(i), ("part_a", "block_a", "part_b", "block_b"))]))

    own, at = F.col("block"), F.col("part")
    dealt = (placed.join(around, ["component", "part"])
             .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
             .withColumn("cell", F.explode(F.concat(
                 cells(F.col("blocks"), lambda i: (at, F.least(own, i), at, F.greatest(own, i))),
                 cells(F.col("above"), lambda i: (at, own, at + 1, i)),
                 cells(F.col("below"), lambda i: (at - 1, i, at, own)))))
             .select("cell", "rep", ((at == F.col("cell.part_a")) & (own == F.col("cell.block_a")))
                     .alias("in_a"), "shingles"))

    def counted(key: tuple, cell: pa.Table) -> pa.Table:
        at_cell = key[0].as_py()
        lists = cell["shingles"].combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
        in_a = cell["in_a"].to_numpy()
        one = (at_cell["part_a"], at_cell["block_a"]) == (at_cell["part_b"], at_cell["block_b"])
        a, b = np.flatnonzero(in_a), np.flatnonzero(in_a if one else ~in_a)
        shared = shared_counts(lists.flatten().to_numpy(), sizes, a, b)
        near = shared * (above + below) >= (sizes[a][:, None] + sizes[b][None]) * above
        links = np.zeros(len(sizes), np.int64)
        links[a] += near.sum(1)
        if one:
            links -= 1  # each set is as near as can be to itself
        else:
            links[b] += near.sum(0)
        return pa.table({"rep": cell["rep"], "n_links": pa.array(links)})

    # One key, not its fields: rows that lie together by component are dealt anew, each cell for itself.
    found = (dealt.groupBy("cell")
             .applyInArrow(counted, "rep long, n_links long").groupBy("rep").agg(F.sum("n_links").alias("n_links")))
    return found.unionAll(pairs)


def shared_counts(flat: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray, width: int = 2048) -> np.ndarray:
    """How many shingles the sets ``a`` and ``b`` share, each with each, by products over ``width`` shingles."""
    _, column, n = np.unique(flat, return_inverse=True, return_counts=True)
    # A shingle that one set alone has counts for that set with itself only.
    alone = np.bincount(np.repeat(np.arange(len(sizes)), sizes), n[column] == 1, len(sizes)).astype(np.int64)
    several = n > 1
    stays = several[column]
    row, column = np.repeat(np.arange(len(sizes)), sizes)[stays], (np.cumsum(several) - 1)[column[stays]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    shared = (a[:, None] == b[None]) * alone[a][:, None]
    for first in range(0, int(several.sum()), width):
        begin, end = np.searchsorted(column, (first, first + width))
        strip = np.zeros((len(sizes), width), np.float32)
        strip[row[begin:end], column[begin:end] - first] = 1
        shared += (strip[a] @ strip[b].T).astype(np.int64)
    return shared


def shareable(sets: DataFrame, keys: DataFrame) -> DataFrame:
    """Beside each representative's size, how many of its shingles any other candidate has too: ``common``."""
    alone = (sets.select("rep", F.explode("shingles").alias("shingle")).groupBy("shingle")
             .agg(F.count("*").alias("n"), F.min("rep").alias("rep")).where("n = 1")
             .groupBy("rep").agg(F.count("*").alias("alone")))
    return keys.join(alone, "rep", "left").select(
        "rep", "n_shingles", "buckets", (F.col("n_shingles") - F.coalesce("alone", F.lit(0))).alias("common"))


def may_reach(x, y, above: int, below: int) -> F.Column:
    """Whether two sets can reach the threshold, by their sizes and by what they may share at most."""
    return F.least(x["common"], y["common"]) * (above + below) >= (x["n_shingles"] + y["n_shingles"]) * above


def hidden_pairs(in_bucket: DataFrame, sizes: DataFrame, parts: DataFrame, checked: DataFrame, above: int,
                 below: int) -> DataFrame:
    """Pairs of one bucket that lie in different components and that no bound rules out.

    The bounds are exact: what two sets can share, and the metric where both distances to the leader are known. A pair
    that shares several buckets is taken in the least of them.
    """
    placed = (in_bucket.join(parts, F.col("rep") == F.col("node"), "left")
              .withColumn("component", F.coalesce("component", "rep")).drop("node"))
    split = (placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"),
                                          F.count("*").alias("n"))
             .where("low <> high and n > 2").select("bucket"))
    known = checked.select(F.col("a").alias("rep"), F.col("b").alias("leader"),
                           (1 - F.col("shared") / (F.col("both") - F.col("shared"))).alias("distance"))
    rows = settle(placed.where("rep <> leader").join(split, "bucket").join(known, ["rep", "leader"], "left")
                  .join(sizes, "rep"), "split-buckets")
    x, y = rows.alias("x"), rows.alias("y")

    def side(name):
        return {c: F.col(f"{name}.{c}") for c in ("n_shingles", "common")}

    allowed = 1 - above / below + 1e-9
    apart = F.coalesce(F.abs(F.col("x.distance") - F.col("y.distance")) > allowed, F.lit(False))
    first = F.array_min(F.array_intersect("x.buckets", "y.buckets")) == F.col("x.bucket")
    return (x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.component") < F.col("y.component"))
                   & may_reach(side("x"), side("y"), above, below) & ~apart & first)
            .select(F.greatest("x.rep", "y.rep").alias("a"), F.least("x.rep", "y.rep").alias("b")).distinct())


def one_per_group(docs: DataFrame, banding: Banding | None = None) -> DataFrame:
    """The documents that stand for their class, and those without words or id, with their own columns."""
    found = settle(near_duplicates(docs, banding).where("doc_id <> class_id").select("doc_id").distinct(), "near-copies")
    return docs.join(found.hint("merge"), "doc_id", "left_anti").select(docs.columns)
