"""Best-two-fit packing of token sequences into bins of fixed length.

Documents become token ids (by the given tokenizer file) with an end id; longer ones are cut into
full pieces and a rest.  Which sizes go together depends on the number of pieces of each size only,
a table of at most `length` rows: best-two-fit runs on it.  A bin is filled greedily with the
largest unpacked sizes that fit; then its smallest piece is replaced by the two unpacked pieces
that fill the expanded gap best, if they fill it better.  The same bin is repeated as often as its
sizes last, so a plan has some thousand patterns at most, however many pieces there are.

Pieces are numbered by size in one distributed sort, and the plan's ranges of these numbers (sorted
arrays, broadcast: at most 64 distinct sizes in a pattern) say where each piece goes.  Nothing is
grouped by bin, and a size that holds most pieces is no hot key.

The file's pre-tokenizer never joins what white space separates (`tokenizer_is_split_by_space`
holds what that rests on), so each distinct word is encoded once; with the known pattern, words are
cut further at ends of its matches (`atoms`), and ASCII ones are lower-cased before, as the file does.
A slice that holds one of the file's added tokens is encoded by whole words.

Edge cases: a null or empty text is its end id alone; null and repeated ids keep a row for each
piece; rows equal in all columns may swap places; an empty table gives an empty result; extra
columns of `documents` are not read, so their names cannot clash.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .flat import U64, Words, column_bytes, mix, slices
from .merges import Merges
from ..functions.numbering import numbered, written
from .spans import strings

LENGTH = 2048
END_ID = 0
KNOWN_WORDS = 1 << 20
LATIN_END, DOTTED_I = "\u0250", "\u0130"
# Fixed value: the pattern whose matches the public file keeps.
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LETTER, DIGIT, OTHER, HIGH = 1, 2, 3, 4
KIND = np.full(256, OTHER, np.uint8)
KIND[128:] = HIGH
KIND[48:58] = DIGIT
KIND[65:91] = KIND[97:123] = LETTER
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)

PIECE_COLUMNS = ["doc_id", "piece", "start", "length", "ids_crc32"]
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenizer_is_split_by_space(text: str) -> bool:
    """Whether the file's pre-tokenizer removes white space, so that words between spaces are encoded apart.

    True for normalisers that work inside words (NFC, white space to a blank, lower case) before a
    split that keeps only matches of a pattern; such a pattern must not match white space.
    """
    import regex

    spec = json.loads(text)
    steps = (spec.get("normalizer") or {}).get("normalizers", [spec["normalizer"]] if spec.get("normalizer") else [])
    plain = all(s["type"] in ("NFC", "Lowercase") or s == {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "} for s in steps)
    first = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    if not plain or first.get("type") != "Split" or first.get("behavior") != "Removed" or not first.get("invert"):
        return False
    pattern = first["pattern"].get("Regex", "")
    rest = spec["pre_tokenizer"]["pretokenizers"][1:]
    return not regex.search(pattern, " \t\n\v\f\r") and all(s["type"] == "ByteLevel" and not s["add_prefix_space"] and not s["use_regex"] for s in rest)


def atoms(data: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the words cut further where the pattern's matches must end: between ASCII
    letters, digits and other characters, but not behind an apostrophe, which may begin a match."""
    kind = KIND[data]
    cut = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    cut &= words.inside[1:] & words.inside[:-1] & (kind[1:] != HIGH) & (kind[:-1] != HIGH) & ~((data[:-1] == 39) & (kind[1:] == LETTER))
    more = np.flatnonzero(cut) + 1
    start = np.sort(np.concatenate([words.start, more]))
    end = np.sort(np.concatenate([words.end, more]))
    return start, end, words.row[np.searchsorted(words.start, start, side="right") - 1]


class Encoder:
    """Token ids of a flat byte array's rows, each distinct part of a word encoded once."""

    def __init__(self, text: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(text)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(text)
        self.added = [t["content"].encode() for t in spec["added_tokens"]]
        self.merges = Merges(text)
        lowers = any(x["type"] == "Lowercase" for x in (spec["normalizer"] or {}).get("normalizers", []))
        self.split = self.merges.usable and lowers and spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] == SPLIT_PATTERN
        self.forget()

    def forget(self) -> None:
        self.key = self.low = self.high = np.zeros(0, U64)
        self.number = np.zeros(0, np.int64)
        self.long: dict[str, int] = {}
        self.first, self.size, self.table = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def learn(self, new: list[str], cut: bool) -> np.ndarray:
        """The numbers of newly encoded parts; of those that are `cut`, the ones of plain letters are one match of the pattern and go through the merges, all at once."""
        is_plain = [cut and (w.isascii() and w.isprintable() and "'" not in w or w.isalpha() and max(w) < LATIN_END and DOTTED_I not in w) for w in new]
        plain = [w.lower().encode() for w, p in zip(new, is_plain) if p]
        ids, size = self.merges.encode(np.frombuffer(b"".join(plain), np.uint8), np.fromiter(map(len, plain), np.int64, len(plain))) if plain else (np.zeros(0, np.int64),) * 2
        other = [x.ids for x in self.tokenizer.encode_batch_fast([w for w, p in zip(new, is_plain) if not p], add_special_tokens=False)]
        size = np.concatenate([size, np.array([len(x) for x in other], np.int64)])
        known = len(self.size)
        self.first = np.append(self.first, len(self.table) + np.cumsum(size) - size)
        self.size = np.append(self.size, size)
        self.table = np.concatenate([self.table, ids.astype(np.uint32), np.array([n for x in other for n in x], np.uint32)])
        numbers, is_plain = np.empty(len(new), np.int64), np.array(is_plain, bool)
        numbers[is_plain] = known + np.arange(len(plain))
        numbers[~is_plain] = known + len(plain) + np.arange(len(other))
        return numbers

    def short_numbers(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, cut: bool) -> np.ndarray:
        """Numbers of parts of at most 16 bytes: told apart by these bytes, as two words."""
        view = np.ndarray((len(data) + 9,), "<u8", np.append(data, np.zeros(16, np.uint8)), strides=(1,))
        size = end - start
        low = view[start] & FIRST_BYTES[np.minimum(size, 8)]
        high = np.where(size > 8, view[np.minimum(start + 8, len(data))] & FIRST_BYTES[np.clip(size - 8, 0, 8)], U64(0))
        key = low ^ mix(high) ^ (size.astype(U64) << U64(56))  # up to 7 bytes the key is the part itself
        distinct, at, code = np.unique(key, return_index=True, return_inverse=True)
        if ((low[at][code] != low) | (high[at][code] != high)).any():
            raise LookupError
        place = np.minimum(np.searchsorted(self.key, distinct), max(len(self.key) - 1, 0))
        known = self.key[place] == distinct if len(self.key) else np.zeros(len(distinct), bool)
        if ((self.low[place[known]] != low[at[known]]) | (self.high[place[known]] != high[at[known]])).any():
            raise LookupError
        numbers = np.empty(len(distinct), np.int64)
        numbers[known] = self.number[place[known]]
        if not known.all():
            fresh = at[~known]
            found = self.learn(strings(data, start[fresh], end[fresh]).to_pylist(), cut)
            where = np.searchsorted(self.key, distinct[~known])
            self.key, self.low, self.high = (np.insert(old, where, more) for old, more in ((self.key, distinct[~known]), (self.low, low[fresh]), (self.high, high[fresh])))
            self.number = np.insert(self.number, where, found)
            numbers[~known] = found
        return numbers[code]

    def long_numbers(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, cut: bool) -> np.ndarray:
        coded = strings(data, start, end).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        new = [w for w in distinct if w not in self.long]
        self.long.update(zip(new, self.learn(new, cut).tolist()))
        return np.array([self.long[w] for w in distinct], np.int64)[coded.indices.to_numpy()]

    def rows(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows one after another, offsets)."""
        if len(self.size) > KNOWN_WORDS:  # a cache: what comes again is encoded again
            self.forget()
        words = Words(data, offsets)
        start, end, row = words.start, words.end, words.row
        cut = self.split and not any(t in data.tobytes() for t in self.added)
        if cut:
            start, end, row = atoms(data, words)
            above = np.append(0, np.cumsum(data >= 128))
            ascii_only = np.zeros(len(data) + 1, np.int8)
            ascii_only[start] += above[end] == above[start]
            ascii_only[end] -= above[end] == above[start]
            data = np.where(np.cumsum(ascii_only[:-1], dtype=np.int8) > 0, LOWER[data], data)
        code = np.empty(len(start), np.int64)
        short = end - start <= 16
        try:
            code[short] = self.short_numbers(data, start[short], end[short], cut)
        except LookupError:  # two parts under one key
            code[short] = self.long_numbers(data, start[short], end[short], cut)
        if not short.all():
            code[~short] = self.long_numbers(data, start[~short], end[~short], cut)
        length = self.size[code]
        ends = np.cumsum(length)
        place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.first[code] - (ends - length), length)
        bounds = np.zeros(words.rows + 1, np.int64)
        np.cumsum(np.bincount(row, weights=length, minlength=words.rows).astype(np.int64), out=bounds[1:])
        return self.table[place], bounds


_ENCODERS: dict[int, Encoder] = {}


def encoder_of(text: str) -> Encoder:
    """The worker's encoder of a tokenizer file; it stays for later tasks of the same worker."""
    key = zlib.crc32(text.encode())
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(text)
    return _ENCODERS[key]


def pieces(documents: DataFrame, tokenizer_text: str, length: int = LENGTH, end_id: int = END_ID, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every document's pieces; one pass, no shuffle."""
    if not tokenizer_is_split_by_space(tokenizer_text):
        raise ValueError("the tokenizer may join words over white space")
    shared = documents.sparkSession.sparkContext.broadcast(tokenizer_text)  # one file of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared.value)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, bounds = encoder.rows(*column_bytes(part.column("text")))
                yield cut(part.column("doc_id"), ids, bounds, length, end_id, with_ids)

    rows = documents.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(run, PIECE_SCHEMA + (", ids array<long>" if with_ids else ""))


def cut(doc_ids: pa.Array, ids: np.ndarray, bounds: np.ndarray, length: int, end_id: int, with_ids: bool) -> pa.RecordBatch:
    """Pieces of at most `length` ids of each row, its end id included."""
    row, piece, start, size, crc, own = [], [], [], [], [], []
    for r in range(len(bounds) - 1):
        whole = np.append(ids[bounds[r] : bounds[r + 1]], np.uint32(end_id)).astype("<u4")
        for n, at in enumerate(range(0, len(whole), length)):
            part = whole[at : at + length]
            row.append(r)
            piece.append(n)
            start.append(at)
            size.append(len(part))
            crc.append(zlib.crc32(part.tobytes()))
            if with_ids:
                own.append(part.astype(np.int64))
    columns = [doc_ids.take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, size, crc))]
    if with_ids:
        columns.append(pa.array(own, pa.list_(pa.int64())))
    return pa.RecordBatch.from_arrays(columns, names=[*PIECE_COLUMNS, *["ids"] * with_ids])


# ------------------------------------------------------------------------------------ the plan
def fill(left: np.ndarray, length: int) -> dict[int, int]:
    """One bin, size -> pieces, by best-two-fit from `left` (pieces of each size that are unpacked)."""
    sizes = np.arange(len(left))
    below = np.maximum.accumulate(np.where(left > 0, sizes, 0))  # the largest unpacked size up to each size
    used: dict[int, int] = {}
    gap, size = length, int(below[min(length, len(left) - 1)])
    while size:
        used[size] = min(int(left[size]), gap // size)
        gap -= used[size] * size
        size = int(below[min(gap, size - 1)])
    if gap and sum(used.values()) > 1:
        smallest = min(used)
        room = gap + smallest
        spare = left.copy()
        spare[list(used)] -= list(used.values())
        best = np.maximum.accumulate(np.where(spare > 0, sizes, 0))
        larger = sizes[(spare > 0) & (sizes < min(room, smallest))]
        smaller = best[np.minimum(room - larger, larger)]
        alone = (smaller == larger) & (spare[larger] < 2)
        smaller = np.where(alone, best[np.maximum(larger - 1, 0)], smaller)
        pair = np.where(smaller > 0, larger + smaller, 0)
        if len(pair) and pair.max() > smallest:
            at = len(pair) - 1 - int(np.argmax(pair[::-1]))
            used[smallest] -= 1
            for x in (int(larger[at]), int(smaller[at])):
                used[x] = used.get(x, 0) + 1
    return {s: n for s, n in used.items() if n}


def plan(counts: np.ndarray, length: int = LENGTH) -> list[tuple[dict[int, int], int]]:
    """(bin, how often) until no piece is left; counts[s] pieces have size s."""
    left, out = np.asarray(counts, np.int64).copy(), []
    while left.any():
        used = fill(left, length)
        times = min(int(left[s]) // n for s, n in used.items())
        for s, n in used.items():
            left[s] -= n * times
        out.append((used, times))
    return out


@dataclass(frozen=True)
class Places:
    """Ranges of piece numbers (by size): the first number, pieces a bin, first bin, offset and size."""

    first: np.ndarray
    each: np.ndarray
    bin: np.ndarray
    offset: np.ndarray
    size: np.ndarray

    def of(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.first, number, side="right") - 1
        turn, place = np.divmod(number - self.first[at], self.each[at])
        return self.bin[at] + turn, self.offset[at] + place * self.size[at]


def places(counts: np.ndarray, length: int = LENGTH) -> Places:
    following = np.cumsum(counts) - counts  # the first number of each size that is not placed yet
    rows, bins = [], 0
    for used, times in plan(counts, length):
        offset = 0
        for size in sorted(used, reverse=True):
            rows.append((following[size], used[size], bins, offset, size))
            following[size] += used[size] * times
            offset += used[size] * size
        bins += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return Places(*table.T)


def pack(cut_pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """`cut_pieces` (of `pieces`) with sequence_id and offset.  The driver gets the number of pieces of each size."""
    stored = written(cut_pieces, "pieces")
    counts = np.zeros(length + 1, np.int64)
    for size, n in stored.groupBy("length").count().collect():
        counts[size] = n
    shared = stored.sparkSession.sparkContext.broadcast(places(counts, length))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where, offset = shared.value.of(batch.column("__number").to_numpy())
            kept = batch.drop_columns(["__number"])
            yield kept.append_column("sequence_id", pa.array(where)).append_column("offset", pa.array(offset))

    ranked = numbered(stored, [], ["length", "doc_id", "piece", "ids_crc32"], "__number")
    schema = ", ".join(f"{n} {t}" for n, t in cut_pieces.dtypes)
    return ranked.select(*cut_pieces.columns, "__number").mapInArrow(run, f"{schema}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token sequences themselves, from pieces that carry their ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))
