"""SimHash near-duplicates with pivot distance tables.

Every document gets a 64-bit fingerprint from the XXH64 values of its word shingles.  Documents
with one fingerprint collapse to one row, so a group of copies costs one fingerprint.  Different
fingerprints are linked when they differ in at most `max_bits` bits.

Candidate search is exact: two fingerprints within `max_bits` bits agree on at least one of
``max_bits + 1`` bit blocks, so they meet in a bucket (block, value).  Each fingerprint carries its
Hamming distances to the reference fingerprints (the pivot table).  Inside a bucket rows are sorted
by the first pivot distance; by the triangle inequality a pair whose distances to any pivot differ
by more than `max_bits` is discarded, survivors are verified by their exact distance.  A bucket
reports a spanning forest of its links, never all pairs.  A bucket with more than `bucket_rows`
members is not compared: its members go on to finer buckets, in which the bits not yet shared are
split again by the same rule, until every bucket is small; nothing is capped or dropped.

Edge cases: a null or blank text has fingerprint zero and links like any other; fewer words than
the shingle length make one shingle; repeated rows and ties share a fingerprint; null ids belong to
a class but never name it (the class of null ids alone is null); an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .components import components
from .flat import SPACE_BYTES, U64, Words, column_bytes, mix, slices

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
PIVOTS = 16
BUCKET_ROWS = 4096
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# Reference fingerprints by rule: all zero first, then mixed counters.
REFERENCES = np.concatenate([np.zeros(1, U64), mix(np.arange(1, PIVOTS, dtype=U64) * U64(0x9E3779B97F4A7C15))])


def shingle_hashes(data: bytes, words: int = SHINGLE_WORDS, seed: int = SEED) -> np.ndarray:
    """XXH64 of every word shingle of one lower-cased text, repeats included."""
    parts = data.split()
    if not parts:
        return np.zeros(0, U64)
    if len(parts) <= words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(parts), seed)], U64)
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(parts) - words + 1].tolist(), ends[words - 1 :].tolist())
    return np.fromiter((digest(joined[a:b], seed) for a, b in spans), U64, len(parts) - words + 1)


def majority(hashes: np.ndarray, block: int = 1 << 16) -> int:
    """The 64-bit word whose bits are set in over half of `hashes` (zero for none)."""
    votes = np.zeros(64, np.int64)
    for k in range(0, len(hashes), block):
        bits = np.unpackbits(hashes[k : k + block].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.uint32)
    up = 2 * votes > len(hashes)
    return int(np.packbits(up, bitorder="little").view(U64)[0])


def fingerprints(documents: DataFrame, words: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp long) for every row."""

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = column_bytes(part.column("text"))
                low = LOWER[data].tobytes()
                bounds = offsets.tolist()
                found = [majority(shingle_hashes(low[a:b], words)) for a, b in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.array(found, U64).view(np.int64))], names=["doc_id", "fp"])

    return documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(prints, "doc_id long, fp long")


def _bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int16)


def pivot_table(prints: np.ndarray) -> np.ndarray:
    """Hamming distances of each fingerprint to the reference fingerprints."""
    return np.bitwise_count(prints[:, None] ^ REFERENCES[None, :]).astype(np.int16)


def bucket_links(prints: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest (pairs of positions) of the links among distinct fingerprints."""
    table = pivot_table(prints)
    order = np.argsort(table[:, 0], kind="stable")
    prints, table = prints[order], table[order]
    stop = np.searchsorted(table[:, 0], table[:, 0] + max_bits, side="right")
    group = np.arange(len(prints))
    left, right = [], []
    for i in range(len(prints)):
        near = np.arange(i + 1, stop[i])
        for j in range(1, table.shape[1]):
            if len(near) < 32:
                break
            near = near[np.abs(table[near, j] - table[i, j]) <= max_bits]
        if len(near):
            hit = near[_bits(prints[near] ^ prints[i]) <= max_bits]
            _, first = np.unique(group[hit], return_index=True)
            for k in hit[first]:
                if group[k] != group[i]:
                    group[group == group[k]] = group[i]
                    left.append(order[i])
                    right.append(order[k])
    return np.array(left, np.int64), np.array(right, np.int64)


def _blocks(mask: np.ndarray, parts: int) -> np.ndarray:
    """Split the set bits of each mask into `parts` runs: (len(mask), parts) masks."""
    bits = np.unpackbits(mask.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int64)
    rank = np.cumsum(bits, axis=1) - 1
    size = np.maximum(bits.sum(axis=1, keepdims=True), 1)
    which = np.where(bits > 0, rank * parts // size, -1)
    out = [np.packbits((which == k).astype(np.uint8), axis=1, bitorder="little").view(U64).reshape(-1) for k in range(parts)]
    return np.stack(out, axis=1)


def _spread(prints: np.ndarray, free: np.ndarray, key: np.ndarray, parts: int) -> pa.RecordBatch:
    """A row per fingerprint and block of its free bits: the bucket key, and the bits still free."""
    masks = _blocks(free, parts)
    keys = mix(mix(key[:, None] + masks) ^ (prints[:, None] & masks))
    left = free[:, None] & ~masks
    arrays = [keys.reshape(-1), np.repeat(prints, parts), left.reshape(-1)]
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x).view(np.int64)) for x in arrays], names=["key", "fp", "free"])


def links(distinct: DataFrame, max_bits: int = MAX_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(a, b): links that connect every pair of distinct fingerprints within `max_bits` bits."""
    parts = max_bits + 1

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column("fp").to_numpy(zero_copy_only=False).view(U64)
            if len(prints):
                yield _spread(prints, np.full(len(prints), ~U64(0)), np.zeros(len(prints), U64), parts)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by key; a bucket is held up to `bucket_rows`, a larger one is spread on row by row."""
        key, held, large = None, [], False
        count = 0

        def spread(rows: list[np.ndarray]) -> pa.RecordBatch:
            part = np.concatenate(rows, axis=1)
            out = _spread(np.ascontiguousarray(part[1]), np.ascontiguousarray(part[2]), np.ascontiguousarray(part[0]), parts)
            return pa.RecordBatch.from_arrays([*out.columns, pa.nulls(out.num_rows, pa.int64())], names=["key", "fp", "free", "other"])

        pending: list[tuple[np.ndarray, np.ndarray]] = []

        def finish() -> None:
            if count > 1 and not large:
                prints = np.unique(np.concatenate(held, axis=1)[1])
                a, b = bucket_links(prints, max_bits)
                if len(a):
                    pending.append((prints[a], prints[b]))

        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy(zero_copy_only=False).view(U64) for c in ("key", "fp", "free")])
            cuts = np.flatnonzero(rows[0, 1:] != rows[0, :-1]) + 1
            for part in np.split(rows, cuts, axis=1):
                if part.shape[1] == 0:
                    continue
                if part[0, 0] != key:
                    finish()
                    key, held, large, count = part[0, 0], [], False, 0
                count += part.shape[1]
                held.append(part)
                if count > bucket_rows:
                    large = True
                    yield spread(held)
                    held = []
            if pending:
                yield _pairs(pending)
                pending = []
        finish()
        if pending:
            yield _pairs(pending)

    def _pairs(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        a = np.concatenate([x[0] for x in found]).view(np.int64)
        b = np.concatenate([x[1] for x in found]).view(np.int64)
        none = pa.nulls(len(a), pa.int64())
        return pa.RecordBatch.from_arrays([none, pa.array(a), none, pa.array(b)], names=["key", "fp", "free", "other"])

    rows = distinct.select("fp").mapInArrow(first, "key long, fp long, free long")
    found = None
    while True:
        out = rows.repartition("key").sortWithinPartitions("key").mapInArrow(compare, "key long, fp long, free long, other long").checkpoint()
        pairs = out.where("other is not null").select(F.col("fp").alias("a"), F.col("other").alias("b"))
        found = pairs if found is None else found.unionByName(pairs)
        rows = out.where("other is null").select("key", "fp", "free")
        if rows.isEmpty():
            return found.distinct()


def classes(documents: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, bucket_rows: int = BUCKET_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp long, component_id): the class of each row is its smallest reachable doc_id."""
    prints = fingerprints(documents, words, id_col, text_col).checkpoint()
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    member = components(links(distinct, max_bits, bucket_rows))
    labelled = distinct.join(member, distinct.fp == member.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = labelled.join(named, "root").select("fp", "component_id")
    return prints.join(of_print, "fp").select("doc_id", "fp", "component_id")


def hex_text(column: str) -> F.Column:
    return F.lpad(F.lower(F.hex(F.col(column))), 16, "0")


def keep_one(documents: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `documents` with one row per class: the one with the smallest id, of equal ids the least text hash.

    A row with a null id stays only where its class has no other.  Of rows with equal id and text
    the one whose other columns come first as text stays.  Columns are unchanged, whatever their names.
    """
    names = [f"__{n}" for n in range(len(documents.columns))]
    text = names[documents.columns.index(text_col)]
    keyed = documents.toDF(*names).withColumns({"_id": F.col(names[documents.columns.index(id_col)]).cast("long"), "_text": F.xxhash64(text)})
    # classes of texts: here the text hash stands for the id
    of_text = classes(keyed, words, max_bits, id_col="_text", text_col=text).select(F.col("doc_id").alias("_text"), "component_id").distinct()
    row = F.struct(F.col("_id").isNull().alias("none"), "_id", "_text")
    least = keyed.groupBy("_text").agg(F.min(row).alias("row")).join(of_text, "_text").groupBy("component_id").agg(F.min("row").alias("row"))
    reps = least.select(F.col("row._id").alias("_keep"), F.col("row._text").alias("_kept"))
    kept = keyed.join(reps, F.col("_id").eqNullSafe(F.col("_keep")) & (F.col("_text") == F.col("_kept")), "left_semi")
    others = F.to_json(F.struct(*[n for n in names if n != text]))
    one = kept.groupBy("_id", "_text").agg(F.min_by(F.struct(*names), others).alias("row"))
    return one.select("row.*").toDF(*documents.columns)
