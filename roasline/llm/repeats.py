"""Exact removal of long byte repeats: every byte that a string of `span` bytes covers which also starts elsewhere.

Suffixes are not sorted byte by byte.  Each string of `span` bytes is filed under its anchor, the
position of the least hash among its first `window` short grams; equal strings have equal anchors at
equal offsets, so only suffixes that start at anchors (about two in `window`) are compared.  They
are put into blocks of equal prefixes, and the blocks are refined level by level: `window` starts at
once, then `step`, then single starts.  At each level a block is keyed by the prefix that all its
starts share (I) and split by the bytes that all its starts cover (O):

* a block with one member is unique and ends here;
* members with equal O are repeats at every start of the block and end here, too;
* of the rest, one member for each O goes on to the next level, where I and O are narrower.

At the last level I and O are the string itself, so the result is exact.  Only counts by key move at
first (minimum and maximum, combined map-side, so a passage that a third of all rows holds is one
row per task); text moves twice, once to cut the windows of the members that go on and once to cut
the spans out, and only texts that may have such members or spans: a bit table of their hashes, of
bounded size, sifts the others out before the shuffle (`sifted`).  Equal texts are one text here: windows are cut from one of them, and if it is long
enough, all of it is a repeat.

Blocks are keyed by 64-bit hashes, and I and O of a member must both agree with another's to be
called a repeat.

Edge cases: a null or empty text has no bytes; texts shorter than `span` keep all bytes; repeated rows
are copies of each other; null ids are carried; an empty table gives an empty result; extra columns
are carried by `cut` unless their names clash with its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .flat import RangeHash, U64, column_bytes, mix, slices

SPAN = 400
WINDOW = 192
STEP = 16
GRAM = 16
LOW32 = U64(0xFFFFFFFF)
WORDS = 1 << 17     # 64-bit words of a sieve
ROWS = "i long, o long, k1 long, k2 long, place long"


def _pack(p: np.ndarray, most: np.ndarray, least: np.ndarray) -> np.ndarray:
    """An anchor and the largest and least distance of its starts before it."""
    return (p << 16) | (most << 8) | least


def _window_min(key: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` values in a row, by doubling."""
    have = 1
    while have < width:
        more = min(have, width - have)
        key = np.minimum(key[:-more], key[more:])
        have += more
    return key


def anchored(data: np.ndarray, offsets: np.ndarray, span: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, first start, last start) of every run of starts that share an anchor; flat positions."""
    none = np.zeros(0, np.int64)
    if len(data) < span or np.diff(offsets).max(initial=0) < span:
        return none, none, none, none
    hashes = RangeHash(data, 5)
    at = np.arange(len(data) - GRAM + 1)
    grams = mix((hashes.sums[GRAM:] - hashes.sums[:-GRAM]) * hashes.down[: len(at)])
    # the least hash, of equal ones the rightmost
    least = _window_min((grams & ~LOW32) | (LOW32 - at.astype(U64)), window)
    long_enough = np.diff(offsets) >= span
    edge = np.zeros(len(data) + 1, np.int64)
    np.add.at(edge, offsets[:-1][long_enough], 1)
    np.add.at(edge, offsets[1:][long_enough] - span + 1, -1)
    start = np.flatnonzero(np.cumsum(edge)[: len(least)] > 0)
    anchor = (LOW32 - (least[start] & LOW32)).astype(np.int64)
    row = np.searchsorted(offsets, start, side="right") - 1
    opens = np.ones(len(start), bool)
    opens[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(opens)
    last = np.append(first[1:] - 1, len(start) - 1)
    return row[first], anchor[first], start[first], start[last]


def _keys(hashes: RangeHash, p: np.ndarray, low: np.ndarray, high: np.ndarray, width: int, span: int) -> tuple[np.ndarray, np.ndarray]:
    """I and O of the block of starts low..high, whose distances to anchor p lie in one run of `width`."""
    base = (p - high) // width * width
    shared = hashes.of(p - base, p - base - (width - 1) + span)
    inner = mix(shared + base.astype(U64))
    outer = mix(hashes.of(low, high + span) ^ mix((p - low).astype(U64)))
    return inner, outer


def _batch(inner: np.ndarray, outer: np.ndarray, k1: np.ndarray, k2: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    arrays = [pa.array(inner.view(np.int64)), pa.array(outer.view(np.int64)), pa.array(k1), pa.array(k2), pa.array(place)]
    return pa.RecordBatch.from_arrays(arrays, names=["i", "o", "k1", "k2", "place"])


def first_level(texts: DataFrame, span: int, window: int) -> DataFrame:
    """Rows of all anchors of `texts` (k1, k2, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = column_bytes(part.column("text"))
                row, p, low, high = anchored(data, offsets, span, window)
                if len(row):
                    inner, outer = _keys(RangeHash(data), p, low, high, window, span)
                    k1, k2 = (part.column(c).to_numpy() for c in ("k1", "k2"))
                    yield _batch(inner, outer, k1[row], k2[row], _pack(p - offsets[row], p - low, p - high))

    return texts.mapInArrow(run, ROWS)


def next_level(windows: DataFrame, width: int, span: int) -> DataFrame:
    """Rows of narrower blocks inside `windows` (k1, k2, place, bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "bytes"):
                data, offsets = column_bytes(part.column("bytes"))
                k1, k2, place = (part.column(c).to_numpy() for c in ("k1", "k2", "place"))
                most, least = (place >> 8) & 255, place & 255
                blocks = most // width - least // width + 1
                row = np.repeat(np.arange(len(place)), blocks)
                base = (least // width)[row] * width + (np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)) * width
                far, near = np.minimum(base + width - 1, most[row]), np.maximum(base, least[row])
                p = offsets[row] + most[row]
                inner, outer = _keys(RangeHash(data), p, p - far, p - near, width, span)
                yield _batch(inner, outer, k1[row], k2[row], _pack(place[row] >> 16, far, near))

    return windows.mapInArrow(run, ROWS)


def refine(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(repeats, open): rows known to be repeats, and one row for each O of the blocks still mixed."""
    at = F.xxhash64("k1", "k2", "place")     # made anew where needed: a hash is dear to ship
    blocks = rows.withColumn("at", at).groupBy("i").agg(F.min("at").alias("a0"), F.max("at").alias("a1"), F.min("o").alias("o0"), F.max("o").alias("o1"))
    # written first: a join of plain shuffles, whose large blocks Spark can split
    blocks = blocks.where("a0 <> a1").select("i", (F.col("o0") != F.col("o1")).alias("mixed")).checkpoint()
    members = rows.join(blocks, "i").select("i", "o", "k1", "k2", "place", "mixed").checkpoint().withColumn("at", at)
    split = members.where("mixed").groupBy("i", "o").agg(F.min("at").alias("a0"), F.max("at").alias("a1")).checkpoint()
    judged = members.where("mixed").join(split, ["i", "o"])
    repeats = members.where("not mixed").select("k1", "k2", "place").unionByName(judged.where("a0 <> a1").select("k1", "k2", "place"))
    # copies of a text bring the chosen member once each
    return repeats, judged.where("at = a0").select("k1", "k2", "place").distinct()


def sifted(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """`texts` with a column hit: false only where k1 is not among `keys`.

    One bit for each residue of k1, at most WORDS words broadcast whatever the size of `keys`: more keys let more
    texts pass, never fewer.
    """
    word, bit = F.expr(f"shiftright(k1, 6) & {WORDS - 1}L"), F.expr("shiftleft(1L, cast(k1 & 63 as int))")
    words = keys.groupBy(word.alias("__word")).agg(F.bit_or(bit).alias("__bits"))
    found = texts.withColumn("__word", word).join(F.broadcast(words), "__word", "left")
    return found.withColumn("hit", F.coalesce(F.col("__bits").bitwiseAND(bit) != 0, F.lit(False))).drop("__word", "__bits")


def cut_windows(texts: DataFrame, members: DataFrame, span: int) -> DataFrame:
    """(k1, k2, place, bytes): the text that the starts of each member cover."""
    wanted = members.groupBy("k1", "k2").agg(F.collect_set("place").alias("places")).checkpoint()
    # one row a text, copies dropped map-side; the join needs no further shuffle of text
    joined = sifted(texts, wanted).where("hit").drop("hit").dropDuplicates(["k1", "k2"]).join(wanted.hint("shuffle_hash"), ["k1", "k2"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                k1, k2, place, found = [], [], [], []
                columns = (part.column(c).to_pylist() for c in ("k1", "k2", "text", "places"))
                for one, two, text, places in zip(*columns):
                    data = text.encode()
                    for x in places:
                        p = x >> 16
                        k1.append(one), k2.append(two), place.append(x)
                        found.append(data[p - ((x >> 8) & 255) : p - (x & 255) + span])
                yield pa.RecordBatch.from_arrays([pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(place, pa.int64()), pa.array(found, pa.binary())], names=["k1", "k2", "place", "bytes"])

    return joined.select("k1", "k2", "text", "places").mapInArrow(run, "k1 long, k2 long, place long, bytes binary")


def _keyed(documents: DataFrame, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return documents.withColumn("k1", F.xxhash64(text)).withColumn("k2", F.xxhash64(F.lit(1), text))


def repeated_places(documents: DataFrame, span: int = SPAN, window: int = WINDOW, step: int = STEP, text_col: str = "text") -> DataFrame:
    """(k1, k2, places): for each text (by hash) the blocks of starts that are repeats."""
    texts = _keyed(documents, text_col).select("k1", "k2", F.col(f"`{text_col}`").alias("text")).where(F.octet_length("text") >= span)
    found, members = refine(first_level(texts, span, window))
    windows = cut_windows(texts, members, span).checkpoint()
    for width in (step, 1):
        repeats, members = refine(next_level(windows, width, span))
        found = found.unionByName(repeats)
        if width > 1:
            # a narrower block lies inside one window: the bytes are cut from there
            whole = windows.withColumn("p", F.shiftright("place", 16)).withColumnRenamed("place", "outer")
            inner = members.withColumn("p", F.shiftright("place", 16))
            skip = F.expr("cast(((outer >> 8) & 255) - ((place >> 8) & 255) as int)")
            size = F.expr(f"cast(((place >> 8) & 255) - (place & 255) as int) + {span}")
            narrow = whole.join(inner, ["k1", "k2", "p"]).where("((outer >> 8) & 255) >= ((place >> 8) & 255) and (outer & 255) <= (place & 255)")
            windows = narrow.select("k1", "k2", "place", F.substring("bytes", skip + 1, size).alias("bytes")).checkpoint()
    return found.groupBy("k1", "k2").agg(F.collect_set("place").alias("places"))


def kept_spans(size: int, places: list[int] | None, span: int) -> list[tuple[int, int]]:
    """Byte ranges that stay, in order."""
    if not places:
        return [(0, size)] if size else []
    x = np.array(places, np.int64)
    p = x >> 16
    gone = np.stack([p - ((x >> 8) & 255), p - (x & 255) + span], axis=1)
    gone = gone[np.argsort(gone[:, 0], kind="stable")]
    out, at = [], 0
    for a, b in gone.tolist():
        if a > at:
            out.append((at, a))
        at = max(at, b)
    if at < size:
        out.append((at, size))
    return out


def cut(documents: DataFrame, span: int = SPAN, window: int = WINDOW, step: int = STEP, text_col: str = "text", with_kept: bool = True) -> DataFrame:
    """All columns of `documents` but the text, plus n_bytes, n_removed, n_spans, kept_sha256, n_kept, removed and, if asked, kept (binary).

    `removed` lists the maximal removed byte ranges as start:end, comma-joined.  Columns of
    `documents` that clash with these are replaced by them; any other name is carried.
    """
    own = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "n_kept", "removed", *(["kept"] if with_kept else [])]
    carried = [c for c in documents.columns if c not in own and c != text_col]
    inner = [f"__{n}" for n in range(len(carried))]  # so that no name of a caller meets one used here
    plain = documents.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(carried, inner)], F.col(f"`{text_col}`").alias("__text"))
    keyed = _keyed(plain, "__text")
    copies = keyed.where(F.octet_length("__text") >= span).groupBy("k1", "k2").agg(F.count("*").alias("n")).where("n > 1").select("k1", "k2", F.lit(True).alias("copied"))
    marks = repeated_places(plain, span, window, step, "__text").join(copies, ["k1", "k2"], "full_outer").checkpoint()
    keyed = sifted(keyed, marks)
    joined = keyed.where("hit").join(marks.hint("shuffle_hash"), ["k1", "k2"], "left").select(*inner, "__text", "places", "copied")
    # texts without a mark stay where they are
    joined = joined.unionByName(keyed.where("not hit").select(*inner, "__text"), allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__text", 1 << 20):
                facts: list[tuple] = []
                for text, places, copied in zip(*(part.column(c).to_pylist() for c in ("__text", "places", "copied"))):
                    data = (text or "").encode()
                    stay = [] if copied else kept_spans(len(data), places, span)
                    kept = b"".join(data[a:b] for a, b in stay)
                    gone = [(a, b) for a, b in zip([0, *(b for _, b in stay)], [*(a for a, _ in stay), len(data)]) if a < b]
                    ranges = ",".join(f"{a}:{b}" for a, b in gone)
                    facts.append((len(data), len(data) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), len(kept), ranges, kept))
                columns = list(zip(*facts))[: len(own)]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in inner] + [pa.array(c, k) for c, k in zip(columns, kinds)], names=[*inner, *own])

    kinds = {f.name: f.dataType.simpleString() for f in documents.schema.fields}
    schema = ", ".join([f"`{n}` {kinds[c]}" for c, n in zip(carried, inner)] + ["n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_kept long, removed string"] + (["kept binary"] if with_kept else []))
    return joined.mapInArrow(run, schema).toDF(*carried, *own)
