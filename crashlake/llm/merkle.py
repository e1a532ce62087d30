"""Merkle manifest of a document table as a postorder append log with closed-form addresses.

Every language has a binary tree over its documents' leaves; a tree over the languages' roots
gives the root of the table. The nodes of a tree are written in the order in which they are
complete (postorder), so a node's place depends on the leaves up to it alone:

    place of leaf i                = 2 i - (ones in i)
    nodes of a subtree, m leaves   = m + ceil(m / 2) + ... up to its height
    place of node j of height h    = place of leaf j 2^h + nodes of its subtree - 1

Aligned builders each complete ``2**bits`` neighbouring nodes and write them as one page of
the log; the pages' roots are the leaves of the next round of builders. A proof reads the
siblings from the page by their places, and continues with the page's own proof.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from crashlake.llm.common import ship, store

#: A builder completes this many neighbouring nodes, as a power of two.
PAGE_BITS = 10
#: Bytes of a digest.
SIZE = 32
PAGES = ("tree string, block long, n long, ids array<long>, changed array<binary>, log binary, root binary")


def digest(*parts: bytes) -> bytes:
    """sha256 of digests that are concatenated as hex text."""
    return hashlib.sha256("".join(p.hex() for p in parts).encode()).digest()


def leaf_place(i: np.ndarray) -> np.ndarray:
    """Place of leaf ``i``: the nodes that are complete before it."""
    i = np.asarray(i, np.int64)
    return 2 * i - np.bitwise_count(i).astype(np.int64)


def subtree_size(leaves: np.ndarray, height: int) -> np.ndarray:
    """Nodes of a subtree of this height over so many leaves; a lone last node has a parent too."""
    return sum(-(-np.asarray(leaves, np.int64) // (1 << h)) for h in range(height + 1))


def node_place(height: int, j: np.ndarray, n: int) -> np.ndarray:
    """Place of node ``j`` of a height in the log of a tree of ``n`` leaves."""
    first = np.asarray(j, np.int64) << height
    return leaf_place(first) + subtree_size(np.minimum(1 << height, n - first), height) - 1


def height_of(n: int) -> int:
    """Height of a tree of ``n`` leaves."""
    return max(n - 1, 0).bit_length()


def complete(nodes: list[bytes], height: int) -> bytes:
    """All nodes above and with ``nodes``, in postorder."""
    out = np.empty((int(subtree_size(len(nodes), height)), SIZE), np.uint8)
    level = nodes
    for h in range(height + 1):
        if h:
            level = [digest(*level[i:i + 2]) for i in range(0, len(level), 2)]
        places = node_place(h, np.arange(len(level)), len(nodes))
        out[places] = np.frombuffer(b"".join(level), np.uint8).reshape(-1, SIZE)
    return out.tobytes()


def _page_height(n: int, bits: int) -> int:
    return height_of(n) if n <= 1 << bits else bits


def _builder(bits: int):
    def build(batches):
        """Rows in the order of tree, block and place -> a page for every block."""
        key, held = None, []

        def page():
            tree, block, n = key
            log = complete([h[1] for h in held], _page_height(n, bits))
            return pa.record_batch([pa.array([tree]), pa.array([block], pa.int64()), pa.array([n], pa.int64()),
                                    pa.array([[h[0] for h in held]], pa.list_(pa.int64())),
                                    pa.array([[h[2] for h in held]], pa.list_(pa.binary())),
                                    pa.array([log], pa.binary()), pa.array([log[-SIZE:]], pa.binary())],
                                   ["tree", "block", "n", "ids", "changed", "log", "root"])

        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("tree", "block", "n", "id", "digest", "changed")]
            for row in zip(*columns):
                if row[:3] != key:
                    if held:
                        yield page()
                    key, held = row[:3], []
                held.append(row[3:])
        if held:
            yield page()
    return build


def _siblings(log: bytes, m: int, n: int, bits: int) -> list[list[bytes]]:
    """For each of a page's ``m`` nodes its siblings, lowest first, read at their places.

    ``n`` is the number of nodes in the whole round: only the round's last node may be alone.
    """
    found: list[list[bytes]] = [[] for _ in range(m)]
    for h in range(_page_height(n, bits)):
        other = (np.arange(m) >> h) ^ 1
        there = np.flatnonzero(other < -(-m // (1 << h)))
        places = node_place(h, other[there], m)
        for i, p in zip(there.tolist(), (places * SIZE).tolist()):
            found[i].append(log[p:p + SIZE])
    return found


def fold(leaf: bytes, siblings: list[bytes], steps: list[tuple[int, int]]) -> bytes:
    """The root that a leaf and its siblings give; ``steps`` are (place, number of leaves) of
    the trees on the way."""
    rest, node = iter(siblings), leaf
    for i, n in steps:
        while n > 1:
            if i ^ 1 < n:
                node = digest(next(rest), node) if i & 1 else digest(node, next(rest))
            else:
                node = digest(node)
            i, n = i >> 1, (n + 1) >> 1
    return node


def _prover(bits: int):
    def prove(batches):
        """Pages with their own proofs -> the proof of every node of theirs."""
        for batch in batches:
            for row in batch.to_pylist():
                m = len(row["ids"])
                own = _siblings(row["log"], m, row["n"], bits)
                yield pa.record_batch([
                    pa.array([row["tree"]] * m), pa.array(range(row["block"] << bits, (row["block"] << bits) + m), pa.int64()),
                    pa.array([b"".join(s) + row["up"] for s in own], pa.binary()), pa.array([row["subroot"]] * m, pa.binary()),
                    pa.array([row["top_place"]] * m, pa.int64()), pa.array([row["tops"]] * m, pa.int64())],
                    ["tree", "block", "up", "subroot", "top_place", "tops"])
    return prove


def _verifier(bits: int, root: bytes):
    def verify(batches):
        for batch in batches:
            for row in batch.to_pylist():
                m, first = len(row["ids"]), row["block"] << bits
                above = [row["up"][i:i + SIZE] for i in range(0, len(row["up"]), SIZE)]
                own = _siblings(row["log"], m, row["n"], bits)
                leaves = [row["log"][p:p + SIZE] for p in (leaf_place(np.arange(m)) * SIZE).tolist()]
                out = []
                for i in range(m):
                    siblings = own[i] + above
                    folded = fold(row["changed"][i] or leaves[i], siblings, [(first + i, row["n"]), (row["top_place"], row["tops"])])
                    out.append((row["ids"][i], leaves[i].hex(), row["subroot"].hex(), root.hex(), digest(*siblings).hex(),
                                folded.hex(), folded == root, len(siblings)))
                names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "n_siblings"]
                kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_(), pa.int32()]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
    return verify


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaves_of(docs: DataFrame) -> DataFrame:
    """tree, id, digest of every document, and the digest with n_chars one more where 7 divides
    the crc32 of its doc_id."""
    def leaf(n_chars: Column) -> Column:
        return F.unhex(F.sha2(F.concat(_field(F.col("doc_id")), _field(F.col("source")), _field(F.col("lang")),
                                       _field(n_chars), _field(F.col("text"))), 256))
    hit = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull()
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    return docs.select(F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("-")).alias("tree"),
                       F.col("doc_id").cast("long").alias("id"), leaf(F.col("n_chars")).alias("digest"),
                       F.when(hit, leaf(more)).alias("changed"))


def ranked(rows: DataFrame, name: str, *keys: str) -> DataFrame:
    """Add ``place`` (gapless from 0 in its tree, by the keys, nulls first) and ``n``, the tree's size.

    Rows are dealt over ranges of tree and keys, so that no tree is one task; equal rows are
    dealt by their number. A place is the row's number in its part and the sizes of the parts
    before; parts and trees, not rows, are summed.
    """
    order = [F.col(c).asc_nulls_first() for c in ("tree", *keys, "_copy")]
    parts = (rows.withColumn("_copy", F.monotonically_increasing_id())
             .repartitionByRange(*order).sortWithinPartitions(*order).drop("_copy")
             .withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}))
    parts = store(parts, f"{name}-ordered")
    heads = parts.groupBy("_part", "tree").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    heads = store(heads.select("_part", "tree", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"),
                               F.sum("_n").over(Window.partitionBy("tree")).alias("n")), f"{name}-parts")
    return (parts.join(heads, ["_part", "tree"])
            .withColumn("place", F.col("_row") - F.col("_first") + F.col("_base")).drop("_part", "_row", "_first", "_base"))


def write_log(nodes: DataFrame, name: str, bits: int = PAGE_BITS) -> list[DataFrame]:
    """Pages of every round of builders over ranked nodes (tree, place, n, id, digest, changed)."""
    ship(nodes.sparkSession)
    rounds = []
    while True:
        blocks = nodes.withColumn("block", F.shiftright("place", bits)).repartition("tree", "block")
        pages = blocks.sortWithinPartitions("tree", "block", "place").select("tree", "block", "n", "id", "digest", "changed")
        rounds.append(store(pages.mapInArrow(_builder(bits), PAGES), f"{name}-{len(rounds)}"))
        more = rounds[-1].where(F.col("n") > (1 << bits))
        if more.isEmpty():
            return rounds
        nodes = more.select("tree", F.col("block").alias("place"), F.ceil(F.col("n") / (1 << bits)).cast("long").alias("n"),
                            F.col("block").alias("id"), F.col("root").alias("digest"), F.lit(None).cast("binary").alias("changed"))


def roots(rounds: list[DataFrame], bits: int = PAGE_BITS) -> DataFrame:
    """tree and root of every tree of a log."""
    return reduce(DataFrame.unionByName, [r.where(F.col("n") <= (1 << bits)).select("tree", "root") for r in rounds])


def page_proofs(rounds: list[DataFrame], above: DataFrame, bits: int = PAGE_BITS) -> DataFrame:
    """Pages of the lowest round, each with ``up``: the siblings above it, in its tree and then
    in ``above``, the proofs of the trees' roots, whose other columns are carried down."""
    proofs = "tree string, block long, up binary, subroot binary, top_place long, tops long"
    tops = [r.where(F.col("n") <= (1 << bits)).join(above, "tree") for r in rounds]
    pages = tops[-1]
    for lower, top in zip(rounds[-2::-1], tops[-2::-1]):
        own = pages.mapInArrow(_prover(bits), proofs)
        pages = top.unionByName(lower.where(F.col("n") > (1 << bits)).join(own, ["tree", "block"]))
    return pages


def prove_documents(docs: DataFrame, bits: int = PAGE_BITS) -> DataFrame:
    """Leaf, subroot, root, proof and its check for every document.

    Returns doc_id, leaf, subroot, root, proof_sha256 (of the siblings from the leaf up, those
    on either side alike), folded_root and verified; documents whose crc32 is a multiple of 7
    are folded from a leaf with n_chars one more, and so do not verify. ``n_siblings`` counts
    the proof.

    Equal doc_ids are ordered by leaf; a null doc_id comes first, is never tampered with and
    hashes as ``-`` as every null does; a null lang is a tree of its own, the first one. Other
    columns are not read. An empty table gives no rows.

    A text is read once, for its leaf; what is shuffled and kept has about 150 bytes a
    document. A page holds at most ``2**bits`` leaves, however many a language has.
    """
    spark = docs.sparkSession
    rounds = write_log(ranked(store(leaves_of(docs), "leaves"), "leaves", "id", "digest"), "log", bits)
    subroots = roots(rounds, bits).select(F.lit("").alias("tree"), F.col("tree").alias("of"), F.col("root").alias("digest"))
    trees = store(ranked(subroots, "trees", "of"), "subroots")
    top = write_log(trees.select("tree", "place", "n", F.col("place").alias("id"), "digest", F.lit(None).cast("binary").alias("changed")),
                    "top", bits)
    root = roots(top, bits).first()
    seed = spark.createDataFrame([("", b"", None, None, None)], "tree string, up binary, subroot binary, top_place long, tops long")
    proofs = page_proofs(top, seed, bits).mapInArrow(
        _prover(bits), "tree string, block long, up binary, subroot binary, top_place long, tops long")
    above = store(trees.select(F.col("of").alias("tree"), F.col("place").alias("top_place"), F.col("n").alias("tops"),
                               F.col("digest").alias("subroot"))
                  .join(proofs.select(F.col("block").alias("top_place"), "up"), "top_place"), "above")
    return page_proofs(rounds, above, bits).mapInArrow(
        _verifier(bits, root.root if root else b""), "doc_id long, leaf string, subroot string, root string, "
        "proof_sha256 string, folded_root string, verified boolean, n_siblings int")


def proof_places(place: int, n: int, bits: int = PAGE_BITS) -> list[tuple[int, int, int, int]]:
    """(round, block, place in the page's log, place in the tree's log) of each sibling of a leaf.

    What a reader of one proof asks the pages for: one page a round, found by its number.
    """
    out, round_, i, size, height = [], 0, place, n, 0
    while size > 1:
        block, m = i >> bits, min(1 << bits, size - (i >> bits << bits))
        for h in range(_page_height(size, bits)):
            other = ((i & ((1 << bits) - 1)) >> h) ^ 1
            if other < -(-m // (1 << h)):
                whole = (block << bits >> h) + other
                out.append((round_, block, int(node_place(h, other, m)), int(node_place(height + h, whole, n))))
        height += _page_height(size, bits)
        i, size, round_ = block, -(-size // (1 << bits)) if size > 1 << bits else 1, round_ + 1
    return out
