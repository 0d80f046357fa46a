"""Merkle manifest of a dataset as a postorder append log.

Every row is a leaf: SHA-256 over its fields, each `-` when null, else byte count, colon and value.
The leaves of a tree (one for each language) stand in id order; every 8 consecutive nodes become the
hash of their hex digests until one is left, and the trees' roots, in tree order, are the leaves of
the dataset's tree.

The log lists nodes in the order in which they are complete (postorder).  The place of node
(level, index) in a tree of n leaves follows from the sizes of the subtrees before it alone
(`postorder`), so builders need not know of each other: each takes 4096 leaves that stand on a
multiple of 4096, writes their subtree's nodes at their places, and the next round of builders goes
on from the subtrees' roots.  A proof needs the siblings on the way to the root: their places come
from the same closed form, and they are looked up in the log there.

Edge cases: null fields are `-` in the leaf; a null group is a tree of its own, before all others;
null ids come first; rows with equal ids are ordered by leaf, equal rows stand side by side; an empty table has an empty
log and no proofs; other columns of the table are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbering import numbered, written

WAYS = 8
LEVELS = 4
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOG_SCHEMA = "tree string, block long, level int, index long, place long, digest string, total long"
PROOF_SCHEMA = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
# rows of a block's path beyond its own subtree: the dataset tree's levels follow the tree's own
DATASET_LEVEL = 64
SUBROOT, ROOT = 126, 127


# ------------------------------------------------------------------------------------ positions
def height(n: int, ways: int = WAYS) -> int:
    """Levels above the leaves."""
    h = 0
    while n > 1:
        n, h = -(-n // ways), h + 1
    return h


def postorder(level: np.ndarray | int, index: np.ndarray, n: int, ways: int = WAYS) -> np.ndarray:
    """Places of nodes (level, index) in the log of a tree of n leaves.

    Before a node stand all nodes that are complete with it, of its level and below, and those
    above it whose leaves all end before its first one.
    """
    level, index = np.broadcast_arrays(np.asarray(level, np.int64), np.asarray(index, np.int64))
    first = index * ways**level
    end = np.minimum(first + ways**level, n)
    place = np.full(index.shape, -1, np.int64)
    for j in range(height(n, ways) + 1):
        complete = np.where(end < n, end // ways**j, -(-n // ways**j))
        place += np.where(j <= level, complete, first // ways**j)
    return place


# ------------------------------------------------------------------------------------ leaves
def leaf_digest(fields: Sequence[Column]) -> Column:
    """Hex SHA-256 over the fields (JVM only)."""
    parts = []
    for field in fields:
        text = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def tree_key(group: Column) -> Column:
    """A text that is never null and sorts as the group does, null first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def leaves(table: DataFrame, group: str, key: str, fields: Sequence[str], tampered: dict[str, Column] | None = None) -> DataFrame:
    """(tree, doc_id, leaf, found): `found` is the leaf with the `tampered` columns in place, as a reader would meet it."""
    changed = tampered or {}
    now = leaf_digest([changed.get(f, F.col(f"`{f}`")) for f in fields])
    return table.select(tree_key(F.col(f"`{group}`")).alias("tree"), F.col(f"`{key}`").cast("long").alias("doc_id"),
                        leaf_digest([F.col(f"`{f}`") for f in fields]).alias("leaf"), now.alias("found"))


# ------------------------------------------------------------------------------------ building
def subtree(digests: list[str], levels: int, ways: int = WAYS) -> list[list[str]]:
    """The nodes of each level over `digests`, up to `levels` above."""
    out = [digests]
    for _ in range(levels):
        below = out[-1]
        out.append([sha256("".join(below[at : at + ways]).encode()).hexdigest() for at in range(0, len(below), ways)])
    return out


def _builder(base: int, levels: int, ways: int):
    """Nodes over one block whose members are nodes of level `base`; `total` counts the tree's leaves."""

    def run(rows: pa.Table) -> pa.Table:
        order = np.argsort(rows.column("index").to_numpy())
        digests = np.array(rows.column("digest").to_pylist(), object)[order].tolist()
        tree, block, total = rows.column("tree")[0].as_py(), rows.column("block")[0].as_py(), rows.column("total")[0].as_py()
        up = min(levels, height(total, ways) - base)
        built = subtree(digests, up, ways)
        out: dict[str, list] = {"level": [], "index": [], "digest": []}
        for j, nodes in enumerate(built):
            if j or not base:  # the members of later rounds are in the log already
                out["level"] += [base + j] * len(nodes)
                out["index"] += range(block * ways ** (levels - j), block * ways ** (levels - j) + len(nodes))
                out["digest"] += nodes
        place = postorder(np.array(out["level"], np.int64), np.array(out["index"], np.int64), total, ways)
        written_order = np.argsort(place)
        n = len(place)
        columns = [pa.array([tree] * n, pa.string()), pa.array([block] * n, pa.int64()), pa.array(out["level"], pa.int32()), pa.array(out["index"], pa.int64()),
                   pa.array(place), pa.array(out["digest"], pa.string()), pa.array([total] * n, pa.int64())]
        return pa.Table.from_arrays(columns, names=["tree", "block", "level", "index", "place", "digest", "total"]).take(pa.array(written_order))

    return run


def build(nodes: DataFrame, levels: int = LEVELS, ways: int = WAYS) -> list[DataFrame]:
    """The log of every tree, one table for each round of builders.

    `nodes`: (tree, index, digest, total), the leaves.  A block holds at most ways^levels nodes.
    The driver learns the largest tree's size, no more.
    """
    largest = nodes.agg(F.max("total")).first()[0] or 0
    size, base, out = ways**levels, 0, []
    while True:
        members = nodes.select("tree", F.floor(F.col("index") / size).cast("long").alias("block"), "index", "digest", "total")
        out.append(written(members.groupBy("tree", "block").applyInArrow(_builder(base, levels, ways), LOG_SCHEMA), "log"))
        base += levels
        if ways**base >= largest:
            return out
        nodes = out[-1].where((F.col("level") == base) & (F.col("total") > ways**base)).select("tree", "index", "digest", "total")


# ------------------------------------------------------------------------------------ proofs
def _ways_up(index: int, base: int, n: int, ways: int) -> Iterator[tuple[int, range, int]]:
    """(level, the run's indexes, own index) on the way from node (base, index) to the root."""
    at, level, count = index, base, -(-n // ways**base)
    while count > 1:
        first = at // ways * ways
        yield level, range(first, min(first + ways, count)), at
        at, level, count = at // ways, level + 1, -(-count // ways)


def _addresses(base: int, ways: int):
    """For each (tree, block, total): the places of the members of the runs above the block's root."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[str, list] = {"tree": [], "block": [], "level": [], "side": [], "place": []}
            for tree, block, total in zip(*(batch.column(c).to_pylist() for c in ("tree", "block", "total"))):
                for level, members, own in _ways_up(block, base, total, ways):
                    rows["tree"] += [tree] * len(members)
                    rows["block"] += [block] * len(members)
                    rows["level"] += [level] * len(members)
                    rows["side"] += [(i > own) - (i < own) for i in members]
                    rows["place"] += postorder(level, np.array(members), total, ways).tolist()
            yield pa.RecordBatch.from_arrays([pa.array(rows["tree"], pa.string()), pa.array(rows["block"], pa.int64()), pa.array(rows["level"], pa.int32()),
                                              pa.array(rows["side"], pa.int32()), pa.array(rows["place"], pa.int64())], names=list(rows))

    return run


def block_paths(log: list[DataFrame], levels: int = LEVELS, ways: int = WAYS) -> DataFrame:
    """(tree, block, level, side, place, digest): siblings (side -1 left, 1 right) above each block's root, found in the log by place."""
    blocks = log[0].where(F.col("total") > ways**levels).select("tree", "block", "total").distinct()
    wanted = blocks.mapInArrow(_addresses(levels, ways), "tree string, block long, level int, side int, place long").where("side <> 0")
    upper = united(log).where(F.col("level") >= levels).select("tree", "place", "digest")
    return wanted.join(upper, ["tree", "place"]).select("tree", "block", "level", "side", "place", "digest")


def united(log: list[DataFrame]) -> DataFrame:
    """All rounds of a log as one table."""
    return reduce(DataFrame.unionByName, log)


def roots(log: list[DataFrame], ways: int = WAYS) -> DataFrame:
    """(tree, digest): the root of each tree."""
    return united(log).where(F.expr(f"level = {_height_sql(ways)}")).select("tree", "digest")


def _height_sql(ways: int) -> str:
    """The height of a tree of `total` leaves: how many powers of `ways` are below it."""
    powers = [ways**k for k in range(63) if ways**k < 1 << 63]
    return "(" + " + ".join(f"CAST(total > {p}L AS INT)" for p in powers) + ")"


def prove(table: DataFrame, group: str = "lang", key: str = "doc_id", fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
          tampered: dict[str, Column] | None = None, levels: int = LEVELS, ways: int = WAYS) -> DataFrame:
    """Proof of every row and whether the row as found (with `tampered` in place) still folds to the root."""
    found = written(leaves(table, group, key, fields, tampered), "leaves")
    rows = written(numbered(found, ["tree"], ["doc_id", "leaf"], "index", "total"), "numbered-leaves")
    log = build(rows.select("tree", "index", F.col("leaf").alias("digest"), "total"), levels, ways)
    tops = written(roots(log, ways), "roots")
    over = written(numbered(tops.withColumn("dataset", F.lit("")), ["dataset"], ["tree"], "index", "total"), "numbered-roots")
    dataset = build(over.select(F.col("dataset").alias("tree"), "index", "digest", "total"), levels, ways)
    above = _dataset_paths(over, dataset, ways)
    blocks = log[0].select("tree", "block").distinct()
    tree_rows = above.unionByName(tops.select("tree", F.lit(SUBROOT).alias("level"), F.lit(0).alias("side"), F.lit(0).cast("long").alias("place"), "digest"))
    own = log[0].where(F.col("level") < levels).select("tree", "block", "level", F.lit(0).alias("side"), "place", "digest")
    known = own.unionByName(block_paths(log, levels, ways)).unionByName(blocks.join(tree_rows, "tree"))
    members = rows.select("tree", F.floor(F.col("index") / ways**levels).cast("long").alias("block"), "index", "total", "doc_id", "leaf", "found")
    return members.groupBy("tree", "block").cogroup(known.groupBy("tree", "block")).applyInArrow(_prover(levels, ways), PROOF_SCHEMA)


def _dataset_paths(over: DataFrame, dataset: list[DataFrame], ways: int) -> DataFrame:
    """(tree, level, side, place, digest): the siblings of each tree's root up to the dataset's, and that root itself."""
    whole = united(dataset)
    at = over.select("tree", F.col("index").alias("block"), "total")
    wanted = at.mapInArrow(_addresses(0, ways), "tree string, block long, level int, side int, place long").where("side <> 0")
    beside = wanted.join(whole.select("place", "digest"), "place").select("tree", (F.col("level") + DATASET_LEVEL).alias("level"), "side", "place", "digest")
    root = whole.where(F.expr(f"level = {_height_sql(ways)}")).select("digest").first()  # one node
    top = over.select("tree", F.lit(ROOT).alias("level"), F.lit(0).alias("side"), F.lit(0).cast("long").alias("place"), F.lit(root.digest if root else None).cast("string").alias("digest"))
    return beside.unionByName(top)


def fold(digest: str, path: list[tuple[str, str]]) -> str:
    """The root that a node and the (left, right) siblings of each level give."""
    for left, right in path:
        digest = sha256((left + digest + right).encode()).hexdigest()
    return digest


def _prover(levels: int, ways: int):
    def run(rows: pa.Table, known: pa.Table) -> pa.Table:
        total = rows.column("total")[0].as_py()
        level, side, place = (known.column(c).to_numpy() for c in ("level", "side", "place"))
        digest = np.array(known.column("digest").to_pylist(), object)
        subroot, root = digest[level == SUBROOT][0], digest[level == ROOT][0]
        upper: list[tuple[str, str]] = []
        total_up = height(total, ways)
        dataset_up = int(level[(level >= DATASET_LEVEL) & (level < SUBROOT)].max(initial=DATASET_LEVEL - 1)) + 1
        for j in [*range(levels, total_up), *range(DATASET_LEVEL, dataset_up)]:
            here = np.flatnonzero((level == j) & (side != 0))
            here = here[np.argsort(place[here])]
            upper.append(("".join(digest[here[side[here] < 0]]), "".join(digest[here[side[here] > 0]])))
        own = (level < levels) & (side == 0)
        order = np.argsort(place[own])
        places, nodes = place[own][order], digest[own][order]
        index = rows.column("index").to_numpy()
        up = min(levels, total_up)
        runs: list[tuple[np.ndarray, list[list[str]]]] = []
        for j in range(up):  # each run of the block once, its members taken from the log by their places
            count = -(-total // ways**j)
            run_of = index // ways ** (j + 1)
            members = {}
            for r in np.unique(run_of):
                at = np.searchsorted(places, postorder(j, np.arange(r * ways, min((r + 1) * ways, count)), total, ways))
                members[int(r)] = nodes[at].tolist()
            runs.append((index // ways**j, members))
        out: list[list] = [[], [], [], []]
        for n, (leaf, found) in enumerate(zip(rows.column("leaf").to_pylist(), rows.column("found").to_pylist())):
            path = []
            for at, members in runs:
                r, k = divmod(int(at[n]), ways)
                path.append(("".join(members[r][:k]), "".join(members[r][k + 1 :])))
            path += upper
            folded = fold(found, path)
            for column, value in zip(out, (leaf, sha256("".join(a + b for a, b in path).encode()).hexdigest(), folded, folded == root)):
                column.append(value)
        n = rows.num_rows
        columns = [rows.column("doc_id"), pa.array(out[0], pa.string()), pa.array([subroot] * n, pa.string()), pa.array([root] * n, pa.string()),
                   pa.array(out[1], pa.string()), pa.array(out[2], pa.string()), pa.array(out[3], pa.bool_())]
        return pa.Table.from_arrays(columns, names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    return run
