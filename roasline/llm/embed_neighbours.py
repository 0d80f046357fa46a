"""Embedding near-duplicates by NN-descent.

Equal vectors of a label collapse to one node with a multiplicity.  Every node keeps a list of its
best `k` neighbours, started from random-projection buckets and refined by joining neighbours of
neighbours: each node gathers its neighbours and reverse neighbours, all pairs among them are
compared, and a pair that beats a list's last entry enters it.  Rounds end when few entries change.
Links are pairs with cosine >= threshold; they are joined to components.

A list whose last entry is still a link is saturated: it may miss links.  Saturated lists are
enlarged to the whole component, compared block against block, and only link counts leave the
tasks, so the count is exact and no list grows without bound in memory.

Recall is audited against brute force: one node in fifty is compared with all nodes, block against
block.  Where fewer than `ENOUGH` of the asked nodes have a link, nothing is measured yet and more are
asked, in the end all.  Below `min_recall` the descent goes on from fresh random buckets twice as
large and with lists twice as long; at last a bucket is a whole label and the lists are exact.

Edge cases: null, empty, zero or non-finite vectors, vectors with null components and null labels
link with nothing; vectors of different length never link; repeated rows are vectors of their own
that link with each other; null ids belong to a component but never name it; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .components import components

THRESHOLD = 0.93
LIST = 16
TREES = 4
BUCKET = 128
SETTLED = 0.002
BLOCK = 512
# One node in so many is asked by the audit; each set holds the one before.
AUDIT = (50, 10, 2, 1)
ENOUGH = 200
ASKED = 4096
TILE = 32768
MIN_RECALL = 0.98
SEED = 42


def _vectors(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _runs(batches: Iterator[pa.RecordBatch], keys: int, limit: int) -> Iterator[list[pa.Array]]:
    """Rows that share their first `keys` columns, in parts of at most `limit` rows.  Input is sorted by them."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        rest = table if rest is None else pa.concat_tables([rest, table])
        cuts = _cuts(rest, keys)
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield from _parts(rest, a, b, limit)
        rest = rest.slice(cuts[-1])
        while rest.num_rows > limit:
            yield from _parts(rest, 0, limit, limit)
            rest = rest.slice(limit)
    if rest is not None and rest.num_rows:
        yield from _parts(rest, 0, rest.num_rows, limit)


def _cuts(table: pa.Table, keys: int) -> list[int]:
    """Where runs start; the last start belongs to the run that may go on."""
    change = np.zeros(max(table.num_rows - 1, 0), bool)
    for c in range(keys):
        key = table.column(c).to_numpy()
        change |= key[1:] != key[:-1]
    return [0, *(np.flatnonzero(change) + 1).tolist()]


def _parts(table: pa.Table, start: int, stop: int, limit: int) -> Iterator[list[pa.Array]]:
    for a in range(start, stop, limit):
        part = table.slice(a, min(limit, stop - a))
        yield [c.combine_chunks() for c in part.columns]


def nodes_of(embeddings: DataFrame, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows, nodes): rows (vec_id, node or null) and nodes (node, label, unit vector, size, least id)."""
    v = F.transform(F.col(f"`{vector_col}`"), lambda x: x.cast("double"))
    rows = embeddings.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").alias("label"), v.alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    rows = rows.withColumn("ok", F.coalesce(F.col("label").isNotNull() & (F.size("v") > 0) & fine, F.lit(False)))
    largest = F.array_max(F.transform("v", lambda x: F.abs(x)))
    # scaled by the largest component first, so that squares neither vanish nor overflow
    rows = rows.withColumn("top", F.when(F.col("ok"), largest)).withColumn("ok", F.col("ok") & (F.col("top") > 0))
    rows = rows.withColumn("v", F.when(F.col("ok"), F.transform("v", lambda x: x / F.col("top"))))
    rows = rows.withColumn("norm", F.when(F.col("ok"), F.sqrt(square))).withColumn("v", F.transform("v", lambda x: x / F.col("norm")))
    rows = rows.withColumn("node", F.when(F.col("ok"), F.xxhash64("label", "v")))
    rows = rows.select("vec_id", "node", "label", "v").checkpoint()
    nodes = (
        rows.where("node is not null").groupBy("node").agg(F.first("label").alias("label"), F.first("v").alias("v"), F.count("*").alias("size"), F.min("vec_id").alias("least"))
        .withColumn("label", F.xxhash64("label", F.size("v"))).checkpoint()
    )
    return rows.select("vec_id", "node"), nodes


def _best(a: np.ndarray, b: np.ndarray, sims: np.ndarray, k: int, floor: np.ndarray) -> pa.RecordBatch | None:
    """Each row's best k of `sims` that beat its floor."""
    k = min(k, sims.shape[1])
    top = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    value = np.take_along_axis(sims, top, axis=1)
    r, c = np.nonzero(value > floor[:, None])
    if not len(r):
        return None
    return pa.RecordBatch.from_arrays([pa.array(a[r]), pa.array(b[top[r, c]]), pa.array(value[r, c])], names=["a", "b", "sim"])


def _joined(k: int, limit: int):
    """Compare the rows of each run with each other; rows are (run, node, floor, v)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _runs(batches, 1, limit):
            node, floor, v = part[1].to_numpy(), part[2].to_numpy(), _vectors(part[3])
            if len(node) > 1:
                for at in range(0, len(node), BLOCK):
                    sims = v[at : at + BLOCK] @ v.T
                    own = np.arange(len(sims))
                    sims[own, at + own] = -2.0
                    found = _best(node[at : at + BLOCK], node, sims, k, floor[at : at + BLOCK])
                    if found is not None:
                        yield found

    return run


def _top(edges: DataFrame, k: int, of: str = "a") -> DataFrame:
    other = "b" if of == "a" else "a"
    place = F.row_number().over(Window.partitionBy(of).orderBy(F.desc("sim"), other))
    return edges.withColumn("_p", place).where(F.col("_p") <= k).drop("_p")


def _gather(members: DataFrame, nodes: DataFrame, k: int, limit: int) -> DataFrame:
    """Edges found inside each run of `members` (run, node, floor)."""
    rows = members.join(nodes.select("node", "v"), "node").select("run", "node", "floor", "v")
    return rows.repartition("run").sortWithinPartitions("run", "node").mapInArrow(_joined(k, limit), "a long, b long, sim double")


def seed_lists(nodes: DataFrame, k: int, trees: int = TREES, bucket: int = BUCKET, seed: int = SEED) -> DataFrame:
    """First lists: signs of random projections, as many as halve a label down to about `bucket` rows."""
    counts = nodes.groupBy("label").agg(F.count("*").alias("n"))
    sized = nodes.join(counts, "label").select("node", "label", "n", "v")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width = np.array([len(x) for x in batch.column("v")])
            for w in np.unique(width):
                part = batch.filter(pa.array(width == w))
                v, n = _vectors(part.column("v")), part.column("n").to_numpy()
                planes = np.random.default_rng(seed).standard_normal((int(w), trees * 20))
                signs = (v @ planes) > 0
                used = np.clip(np.ceil(np.log2(np.maximum(n / bucket, 1))), 0, 20).astype(int)
                for t in range(trees):
                    bits = signs[:, t * 20 : t * 20 + 20] & (np.arange(20)[None, :] < used[:, None])
                    code = (bits * (1 << np.arange(20))).sum(axis=1) + (t << 20)
                    yield pa.RecordBatch.from_arrays([part.column("label"), pa.array(code.astype(np.int64)), part.column("node"), pa.array(np.full(len(n), -2.0)), part.column("v")], names=["label", "code", "node", "floor", "v"])

    rows = sized.mapInArrow(place, "label long, code long, node long, floor double, v array<double>").select(F.xxhash64("label", "code").alias("run"), "node", "floor", "v")
    # a bucket over the limit is compared in parts; the rounds join the parts
    found = rows.repartition("run").sortWithinPartitions("run", "v").mapInArrow(_joined(k, 4 * bucket), "a long, b long, sim double")
    return _top(found.distinct(), k)


def descend(lists: DataFrame, nodes: DataFrame, k: int, settled: float = SETTLED) -> DataFrame:
    """Refine the lists through neighbours of neighbours until few entries change."""
    total = max(nodes.count(), 1)
    lists = lists.checkpoint()
    while True:
        back = _top(lists, k, of="b").select(F.col("b").alias("run"), F.col("a").alias("node"))
        ahead = lists.select(F.col("a").alias("run"), F.col("b").alias("node"))
        own = nodes.select(F.col("node").alias("run"), "node")
        worst = lists.groupBy("a").agg(F.min("sim").alias("low"), F.count("*").alias("n")).select(F.col("a").alias("node"), F.when(F.col("n") >= k, F.col("low")).otherwise(-2.0).alias("floor"))
        members = ahead.unionByName(back).unionByName(own).distinct().join(worst, "node", "left").select("run", "node", F.coalesce("floor", F.lit(-2.0)).alias("floor"))
        found = _gather(members, nodes, k, 4 * k).distinct()
        fresh = found.join(lists.select("a", "b"), ["a", "b"], "left_anti")
        after = _top(lists.withColumn("new", F.lit(0)).unionByName(fresh.withColumn("new", F.lit(1))), k).checkpoint()
        changed = after.agg(F.sum("new")).first()[0] or 0
        lists = after.drop("new")
        if changed <= settled * k * total:
            return lists


def _blocks(members: DataFrame, nodes: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """(node, links): exact link counts inside each component of `members` (node, root), block against block."""
    sizes = members.groupBy("root").agg(F.ceil(F.count("*") / block).alias("blocks"))
    placed = members.join(sizes, "root").join(nodes.select("node", "size", "v"), "node")
    placed = placed.withColumn("own", F.expr("pmod(xxhash64(node), blocks)"))
    paired = placed.withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
    rows = paired.select(F.xxhash64("root", F.least("own", "other"), F.greatest("own", "other")).alias("run"), "root", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "node", "size", "v")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _runs(batches, 4, 1 << 30):
            x, y, own = part[2].to_numpy(), part[3].to_numpy(), part[4].to_numpy()
            node, size, v = part[5].to_numpy(), part[6].to_numpy(), _vectors(part[7])
            left, right = np.flatnonzero(own == x), np.flatnonzero(own == y)
            near = (v[left] @ v[right].T) >= threshold
            if x[0] == y[0]:
                np.fill_diagonal(near, False)
                links = {"node": node[left], "links": near @ size[right]}
            else:
                links = {"node": np.concatenate([node[left], node[right]]), "links": np.concatenate([near @ size[right], size[left] @ near])}
            yield pa.RecordBatch.from_pydict({k: pa.array(v.astype(np.int64)) for k, v in links.items()})

    counts = rows.repartition("run").sortWithinPartitions("run", "root", "x", "y").mapInArrow(compare, "node long, links long")
    return counts.groupBy("node").agg(F.sum("links").alias("links"))


def _true_links(nodes: DataFrame, every: int, threshold: float) -> DataFrame:
    """(node, links): exact link counts of one node in `every`, each block of them against each tile of its label."""
    count = F.count("*")
    sizes = nodes.groupBy("label").agg(F.ceil(count / (every * ASKED)).alias("blocks"), F.ceil(count / TILE).alias("tiles"))
    placed = nodes.join(sizes, "label").withColumn("block", F.expr("pmod(xxhash64(node, 11), blocks)")).withColumn("tile", F.expr("pmod(xxhash64(node, 13), tiles)"))
    asked = placed.where(F.expr(f"pmod(xxhash64(node, 7), {every}) = 0")).withColumn("tile", F.explode(F.expr("sequence(0L, tiles - 1)"))).withColumn("role", F.lit(0))
    against = placed.withColumn("block", F.explode(F.expr("sequence(0L, blocks - 1)"))).withColumn("role", F.lit(1))
    rows = asked.unionByName(against).select(F.xxhash64("label", "block", "tile").alias("run"), "label", "block", "tile", "role", "node", "size", "v")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, own, v, links = None, np.zeros(0, np.int64), None, np.zeros(0, np.int64)
        for part in _runs(batches, 5, 2 * ASKED):
            now, node = tuple(c[0].as_py() for c in part[:4]), part[5].to_numpy()
            if now != run:
                if len(own):
                    yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(links)], names=["node", "links"])
                run, own, v, links = now, node[:0], None, np.zeros(0, np.int64)
            if part[4][0].as_py() == 0:
                own, v = np.concatenate([own, node]), _vectors(part[7]) if v is None else np.concatenate([v, _vectors(part[7])])
                links = np.zeros(len(own), np.int64)
            elif len(own):
                size, other = part[6].to_numpy(), _vectors(part[7])
                for at in range(0, len(node), BLOCK):
                    near = (v @ other[at : at + BLOCK].T) >= threshold
                    _, mine, same = np.intersect1d(own, node[at : at + BLOCK], return_indices=True)
                    near[mine, same] = False
                    links += near @ size[at : at + BLOCK]
        if len(own):
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(links)], names=["node", "links"])

    counts = rows.repartition("run").sortWithinPartitions("run", "label", "block", "tile", "role").mapInArrow(compare, "node long, links long")
    return counts.groupBy("node").agg(F.sum("links").alias("links"))


def audit(nodes: DataFrame, links: DataFrame, threshold: float, enough: int = ENOUGH) -> float:
    """Mean share of its true links found for a node that has any, over sets that grow until `enough` such nodes are asked."""
    for every in AUDIT:
        true = _true_links(nodes, every, threshold).where("links > 0").withColumnRenamed("links", "true")
        share = F.least(F.coalesce("links", F.lit(0)), "true") / F.col("true")
        linked, found = true.join(links, "node", "left").agg(F.count("*"), F.avg(share)).first()
        if linked >= enough:
            break
    # the last set is all nodes: without a link there, none is lost
    return found if linked else 1.0


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD, k: int = LIST, min_recall: float = MIN_RECALL, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    rows, nodes = nodes_of(embeddings, id_col, vector_col, label_col)
    lists, bucket, seed = seed_lists(nodes, k), BUCKET, SEED
    while True:
        lists = descend(lists, nodes, k)
        near = lists.where(F.col("sim") >= threshold)
        links = near.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().checkpoint()
        member = components(links).checkpoint()
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        plain = both.join(nodes.select(F.col("node").alias("b"), "size"), "b").groupBy(F.col("a").alias("node")).agg(F.sum("size").alias("links"))
        full = near.groupBy("a").agg(F.count("*").alias("n")).where(F.col("n") >= k).select(F.col("a").alias("node"))
        roots = member.join(full, "node", "left_semi").select("root").distinct()
        exact = _blocks(member.join(roots, "root", "left_semi"), nodes, threshold)
        counts = plain.join(exact.withColumnRenamed("links", "all_links"), "node", "left").select("node", F.coalesce("all_links", "links").alias("links")).checkpoint()
        if audit(nodes, counts, threshold) >= min_recall:
            break
        k, bucket, seed = 2 * k, 2 * bucket, seed + 1
        lists = _top(lists.unionByName(seed_lists(nodes, k, bucket=bucket, seed=seed)).distinct(), k)
    named = nodes.join(member, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = named.join(named.groupBy("root").agg(F.min("least").alias("component_id")), "root").join(counts, "node", "left")
    named = named.select("node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"))
    alone = rows.where("node is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    linked = rows.where("node is not null").join(named, "node").select("vec_id", "n_links", "component_id")
    out = linked.unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
