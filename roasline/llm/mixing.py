"""Mixing sources to target weights by pivotal dependent rounding.

A source that shall give `target` words out of `source_size` takes every document
``target / source_size`` times: a whole number of copies plus a fractional copy probability.
Pivotal rounding pairs two fractional documents of a source and moves probability mass between
them until one becomes integral; mass is counted in words, so each transfer keeps the source's
expected words exactly, and the direction is drawn so that every document keeps its expected
copies.  Blocks of a source are rounded in parallel; each leaves at most one fractional document,
and these residuals are combined in the next level of a reduction tree until one is left per
source, which a last draw rounds.  Blocks take large documents first, so the residuals are small
ones and a source's words end within one document of its target.

All draws come from hashes of the document id and a seed, so reruns agree.  Sizes and copies are
small rows without text.

Edge cases: a null or blank text has size zero and is taken whole numbers of times only; a null
source is a source of its own, last in the order; sources with no words have target zero; repeated
rows are separate documents; null ids draw like any value; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .flat import U64, mix

WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
BLOCK_ROWS = 8192
SEED = 42


def word_count(column: str) -> F.Column:
    return F.coalesce(F.regexp_count(F.col(column), F.lit("[^ \\t-\\r]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, source_size, docs, target): weights repeat over sources by code point, null last.

    A target above `max_repeat` times its source's size stops there and the excess is shared again by
    weight.  Water level: with r = max_repeat * size / weight, sources of small r are capped first; a
    source is capped when the level per weight that remains for it and all later ones is at least r.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    ordered = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    w = F.array(*[F.lit(float(x)) for x in weights])
    ranked = by_source.withColumn("weight", F.element_at(w, (F.row_number().over(ordered) - 1) % len(weights) + 1))
    ranked = ranked.withColumn("cap", F.col("source_size") * F.lit(float(max_repeat))).withColumn("r", F.col("cap") / F.col("weight"))
    rising = Window.orderBy("r", F.col("source").isNull(), F.encode("source", "UTF-8"))
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    ranked = (
        ranked.withColumn("words", F.sum("source_size").over(everything).cast("double") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("weights", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", F.col("words") / F.col("weights"))
        .withColumn("capped", F.col("level") >= F.col("r"))
    )
    level = F.min(F.when(~F.col("capped"), F.struct("r", "level"))).over(everything)["level"]
    return ranked.withColumn("free", level).select(
        "source", "source_size", "docs",
        F.when(F.col("capped"), F.col("cap")).otherwise(F.col("free") * F.col("weight")).alias("target"),
    )


def _draws(keys: np.ndarray, level: int, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(keys.view(U64) + U64((seed * 1_000_003 + level * 7919) % (1 << 63))) >> U64(11)).astype(np.float64) / float(1 << 53)


def pivot(size: np.ndarray, part: np.ndarray, draw: np.ndarray) -> tuple[np.ndarray, int]:
    """Round `part` (fractions in (0, 1)) pairwise; returns the rounded fractions and the residual's place (-1: none).

    Moving words a from one document to the other keeps size * part in total.
    """
    out = part.astype(float).copy()
    held = -1
    for i in range(len(out)):
        if not 0.0 < out[i] < 1.0:
            continue
        if held < 0:
            held = i
            continue
        j = held
        up = min((1.0 - out[i]) * size[i], out[j] * size[j])
        down = min(out[i] * size[i], (1.0 - out[j]) * size[j])
        # i gains `up` words with probability down / (up + down), else loses `down`
        move = up if draw[i] * (up + down) < down else -down
        if move > 0:
            full, empty = (1.0 - out[i]) * size[i] <= out[j] * size[j], out[j] * size[j] <= (1.0 - out[i]) * size[i]
            out[i] = 1.0 if full else out[i] + move / size[i]
            out[j] = 0.0 if empty else out[j] - move / size[j]
        else:
            full, empty = (1.0 - out[j]) * size[j] <= out[i] * size[i], out[i] * size[i] <= (1.0 - out[j]) * size[j]
            out[j] = 1.0 if full else out[j] - move / size[j]
            out[i] = 0.0 if empty else out[i] + move / size[i]
        open_ = [k for k in (i, j) if 0.0 < out[k] < 1.0]
        held = open_[0] if open_ else -1
    return out, held


def _round_block(level: int, seed: int):
    def one(block: pd.DataFrame) -> pd.DataFrame:
        # large documents first, so that the document left over is a small one
        block = block.assign(draw=_draws(block["key"].to_numpy(np.int64), level, seed))
        block = block.sort_values(["size", "key"], ascending=[False, True], kind="stable")
        block["part"], _ = pivot(block["size"].to_numpy(float), block["part"].to_numpy(float), block["draw"].to_numpy())
        return block.drop(columns="draw")

    return one


def _source_key() -> F.Column:
    return F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))


def copies_of(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT, block_rows: int = BLOCK_ROWS, seed: int = SEED) -> DataFrame:
    """The plan for `sizes` (doc_id, source, size): one row per distinct document.

    Returns doc_id, source, size, source_size, target, rows (how many equal rows there are), whole
    (copies that each takes) and extra (how many of them take one more).  Equal rows are rounded
    together: their fractions add up to whole extra copies and one fraction, so a document that
    holds a large share of all rows is one row here.
    """
    want = targets(sizes, weights, max_repeat).withColumn("s", _source_key()).drop("source")
    counted = sizes.groupBy("doc_id", "source", "size").agg(F.count("*").alias("rows")).withColumn("s", _source_key())
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    placed = (
        counted.join(want, "s").withColumn("ratio", ratio).withColumn("whole", F.floor("ratio"))
        .withColumn("parts", F.when(F.col("size") > 0, F.col("rows") * (F.col("ratio") - F.col("whole"))).otherwise(0.0))
        .withColumn("sure", F.floor("parts")).withColumn("part", F.col("parts") - F.col("sure"))
        .withColumn("key", F.xxhash64("s", "doc_id", "size"))
        .withColumn("blocks", F.ceil(F.col("docs") / block_rows))
    )
    schema = "key long, s string, size long, blocks long, block long, part double"
    state = placed.where("part > 0").select("key", "s", "size", "blocks", F.expr("pmod(key, blocks)").alias("block"), "part")
    most = want.agg(F.max("docs")).first()[0] or 0
    level, blocks, settled = 0, math.ceil(most / block_rows), None
    while True:
        # dealt by block: the join before leaves all blocks of a source in one partition
        state = state.repartition("s", "block").groupBy("s", "block").applyInPandas(_round_block(level, seed), schema).checkpoint()
        done = state.where("part <= 0 or part >= 1").select("key", "s", "part")
        settled = done if settled is None else settled.unionByName(done)
        state = state.where("part > 0 and part < 1")
        if blocks <= 1:
            break
        # one residual a block at most: the next level's blocks hold block_rows of them
        blocks = math.ceil(blocks / block_rows)
        state = state.withColumn("blocks", F.ceil(F.col("blocks") / block_rows)).withColumn("block", F.expr("pmod(block, blocks)"))
        level += 1
    # the one document left of a source: a plain draw
    draw = F.expr(f"pmod(xxhash64(key, {seed}), 1000003) / 1000003.0D")
    last = state.select("key", "s", F.when(draw < F.col("part"), 1.0).otherwise(0.0).alias("part"))
    won = settled.unionByName(last).where("part >= 1").select("key", "s", F.lit(1).alias("won"))
    return placed.join(won, ["key", "s"], "left").select(
        "doc_id", "source", "size", "source_size", "target", "rows", F.col("whole").cast("long").alias("whole"),
        (F.col("sure") + F.coalesce("won", F.lit(0))).cast("long").alias("extra"),
    )


def mix_sources(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The plan (see `copies_of`) for `documents`; their sizes are counted once and written small."""
    sizes = documents.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{source_col}`").alias("source"), word_count(text_col).alias("size"))
    return copies_of(sizes.checkpoint(), **options)


def expand(plan: DataFrame, run: int = 1 << 14) -> DataFrame:
    """One row per row of the input: the plan's columns and `copies` of that row."""
    runs = plan.withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("rows") - 1) / run))))
    low, high = F.col("_run") * run, F.least(F.col("rows"), (F.col("_run") + 1) * run) - 1
    numbered = runs.withColumn("_n", F.explode(F.sequence(low, high)))
    return numbered.withColumn("copies", F.col("whole") + (F.col("_n") < F.col("extra")).cast("long")).drop("_run", "_n")


def _match(doc_id: str, source: str, size: str) -> F.Column:
    return F.concat_ws("|", F.coalesce(F.col(doc_id).cast("string"), F.lit("n")), F.col(size), F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("n")))


def mixed(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: every row of `documents` as many times as it has copies (columns unchanged, whatever their names).

    Among rows of equal id, source and size the extra copies go by text hash, then by the other
    columns, so reruns agree.
    """
    plan = mix_sources(documents, id_col, text_col, source_col, **options).where("whole > 0 or extra > 0")
    plan = plan.select(_match("doc_id", "source", "size").alias("_key"), F.col("whole").alias("_whole"), F.col("extra").alias("_extra"))
    names = [f"__{n}" for n in range(len(documents.columns))]
    id_, text, source = (names[documents.columns.index(c)] for c in (id_col, text_col, source_col))
    sized = documents.toDF(*names).withColumn("_words", word_count(text)).withColumn("_key", _match(id_, source, "_words"))
    others = F.to_json(F.struct(*[n for n in names if n != text]))
    nth = F.row_number().over(Window.partitionBy("_key").orderBy(F.xxhash64(text), others)) - 1
    copies = (F.col("_whole") + (nth < F.col("_extra")).cast("long")).cast("int")
    taken = sized.join(plan, "_key").withColumn("_copies", copies).where("_copies > 0")
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies"))).select(*names).toDF(*documents.columns)
