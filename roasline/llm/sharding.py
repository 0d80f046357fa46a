"""Sharding by rendezvous hashing of stable record keys (DataFrame functions only).

Every (key, shard) pair gets a uniform number from a hash; the record goes to the shard with the
least ``-ln(u) / weight``, so a shard's share follows its weight and a changed shard count moves
only the records that the new shard wins (or that the removed one held).  The decision needs the
key and the shard list alone: no shuffle, no state.

Slots number the records of a shard without gaps: equal rows are counted first, rows are ordered by
the hash of their key, hash prefixes split a shard into ranges, a running sum over the ranges gives
each its first slot, and only inside a range are rows numbered one by one.

Edge cases: a null key hashes as the text 'null' and stays stable; a null text has size 1 and CRC
0; repeated rows share a shard and get slots of their own; an empty table gives an empty result;
extra columns stay with `assign`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

SHARDS = 16
RUN = 1 << 14


def _uniform(key: Column, shard: int) -> Column:
    """In (0, 1): 52 bits of an MD5 over key and shard number."""
    bits = F.conv(F.substring(F.md5(F.concat_ws(":", key, F.lit(str(shard))).cast("binary")), 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / F.lit(float(1 << 52))


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard (its place in `weights`) that wins `key`; shards of weight zero win nothing."""
    text = F.coalesce(key.cast("string"), F.lit("null"))
    scores = [F.struct((-F.ln(_uniform(text, n)) / float(w)).alias("score"), F.lit(n).alias("shard")) for n, w in enumerate(weights) if w > 0]
    best = F.least(*scores) if len(scores) > 1 else scores[0]
    return best["shard"].cast("int")


def assign(records: DataFrame, weights: Sequence[float] = (1.0,) * SHARDS, key_col: str = "doc_id", shard_col: str = "shard") -> DataFrame:
    """All columns of `records` plus the shard of each."""
    return records.withColumn(shard_col, rendezvous(F.col(f"`{key_col}`"), weights))


def number(rows: DataFrame, group: str, order: Sequence[str], spread: Column, run: int = RUN) -> DataFrame:
    """`rows` with slot: gapless from 0 inside each `group`.

    `spread` is a hex hash by which rows are ordered before `order`.  Equal rows are counted map-side
    and expanded at the end in runs of `run`, so a key that holds a large share of all rows is one
    row here.  Ranges of the hash prefix (four digits: 65,536 to a group) are numbered apart; the
    table of range totals is the only thing ordered per group.
    """
    columns = rows.columns
    counted = rows.groupBy(*columns).agg(F.count("*").alias("_n")).withColumn("_h", spread)
    ranged = counted.withColumn("_range", F.substring("_h", 1, 4))
    totals = ranged.groupBy(group, "_range").agg(F.sum("_n").alias("_total"))
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(group, "_range", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(group, "_range").orderBy("_h", *order).rowsBetween(Window.unboundedPreceding, -1)
    first = ranged.withColumn("_at", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(starts, [group, "_range"])
    runs = first.withColumn("_slot", F.col("_start") + F.col("_at")).withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / run))))
    low, high = F.col("_slot") + F.col("_run") * run, F.col("_slot") + F.least(F.col("_n"), (F.col("_run") + 1) * run) - 1
    return runs.withColumn("slot", F.explode(F.sequence(low, high))).select(*columns, F.col("slot").cast("long"))
