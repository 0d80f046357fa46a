"""Phrase collocation mining: frequent phrases of 2 to 5 words and their weakest cut, per language.

Texts become blocks of word symbols (0 for a word that is not frequent and between pieces).  The
phrases grow a word at a time.  The state of a text position at level k is the frequent phrase of k
words that begins there, or 0; numpy moves the states of a whole block at once, one table step for
all positions (`Trie.step`).  A phrase of k + 1 words can only be frequent where the phrases of k words at its
position and at the next are: these candidates are counted by state pair in every block, Spark sums
the blocks, and the pairs that reach the least count become the next level's nodes.  So candidates
are never listed by joining phrases with phrases: only those that occur exist.

The tries are double arrays: the children of node s stand at base[s] + symbol, `check` names the
owner of a slot.  Nodes of a level are numbered in order and cut into shards of at most `SHARD`
nodes; a shard is collected, built and broadcast alone, and each takes one pass over the blocks, so what
is broadcast has a bound whatever the number of phrases.

Frequent words are looked up the same way, in shards of the sorted word list.

Edge cases: a null text is empty, a null language is `und`; empty texts and tables give nothing;
repeated rows count each time; a very long text is a block of its own; other columns are not read,
so their names cannot clash.  Counts stay below 1e14, beyond any table's number of words here.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from ..session import remove_folder, shared_folder
from .flat import column_bytes, slices
from ..functions.numbering import numbered, written
from .spans import strings

LEAST = 100
WORDS = 5
TOP = 2000
KEPT_PERCENT = 100
NO_LANG = "und"
SHARD = 1 << 20
BLOCK = 1 << 19
POSITIONS = 1 << 20
# The characters that end a piece, and those that separate words.
PIECE_END = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"

ENDS = np.isin(np.arange(256), np.frombuffer(PIECE_END, np.uint8))
BLANK = np.isin(np.arange(256), np.frombuffer(BLANKS, np.uint8))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


# ------------------------------------------------------------------------------------ blocks
def packed(ids: np.ndarray) -> bytes:
    """Ids as four or eight bytes each, told by the first byte."""
    return b"8" + ids.astype("<i8").tobytes() if len(ids) and ids.max() >= 1 << 31 else b"4" + ids.astype("<i4").tobytes()


def unpacked(block: pa.Scalar) -> np.ndarray:
    held = block.as_buffer()
    return np.frombuffer(held, "<i8" if held[0] == 56 else "<i4", offset=1).astype(np.int64)


# ------------------------------------------------------------------------------------ words
def _by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """(language, bytes, offsets) of the texts of each language in each slice, A-Z lower-cased."""
    for batch in batches:
        for part in slices(batch, "text", BLOCK):
            lang = part.column("lang")
            for name in pc.unique(lang).to_pylist():
                data, offsets = column_bytes(part.column("text").filter(pc.equal(lang, name)))
                yield name, LOWER[data], offsets


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All words and, for each, whether it opens a piece."""
    row_start = np.zeros(len(data) + 1, bool)
    row_start[offsets] = True
    inside = ~(ENDS | BLANK)[data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | row_start[1:-1]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:] | row_start[1:-1]
    start, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    breaks = np.cumsum(ENDS[data] | row_start[:-1])
    piece = breaks[start]
    return strings(data, start, end), np.append(True, piece[1:] != piece[:-1])[: len(start)]


def _texts(documents: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return documents.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(NO_LANG)).alias("lang"), F.col(f"`{text_col}`").alias("text"))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for lang, data, offsets in _by_lang(batches):
        found = pc.value_counts(_words(data, offsets)[0])
        word, count = found.field(0).cast(pa.string()), found.field(1)
        # the empty word stands for all of them
        names = pa.concat_arrays([word, pa.array([""], pa.string())])
        counts = np.append(count.to_numpy(), pc.sum(count).as_py() or 0)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(names), pa.string()), names, pa.array(counts.astype(np.int64))], names=["lang", "word", "a"])


def word_counts(texts: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, word, a) of the words with `least` occurrences; the word '' has n, all of them."""
    counted = texts.mapInArrow(_count_words, "lang string, word string, a long").groupBy("lang", "word").agg(F.sum("a").alias("a"))
    return written(counted.where((F.col("a") >= least) | (F.col("word") == "")), "words")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each language of each slice: its distinct words and, for every place, the word's number there (0 opens a piece)."""
    for lang, data, offsets in _by_lang(batches):
        words, opens = _words(data, offsets)
        coded = words.dictionary_encode()
        places = np.insert(coded.indices.to_numpy().astype(np.int32) + 1, np.flatnonzero(opens), 0)
        distinct = coded.dictionary.cast(pa.string())
        listed = pa.ListArray.from_arrays(pa.array([0, len(distinct)], pa.int32()), distinct)
        yield pa.RecordBatch.from_arrays([pa.array([lang], pa.string()), pa.array([packed(places)], pa.binary()), listed, pa.array([packed(np.zeros(len(distinct) + 1, np.int64))], pa.binary())],
                                         names=["lang", "places", "words", "ids"])


def _look_up(shared):
    """Ids of the words that one shard of the word list knows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for lang, words, ids in zip(batch.column("lang").to_pylist(), batch.column("words"), batch.column("ids")):
                own, (known, number) = unpacked(ids), shared.value.get(lang, (pa.array([], pa.string()), np.zeros(0, np.int64)))
                place = pc.index_in(words.values, known).fill_null(-1).to_numpy()
                own[1:] = np.where(place < 0, own[1:], np.append(number, 0)[place])
                out.append(packed(own))
            yield batch.set_column(3, "ids", pa.array(out, pa.binary()))

    return run


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Symbols of every place; runs of zeros become one."""
    for batch in batches:
        out = []
        for places, ids in zip(batch.column("places"), batch.column("ids")):
            found = unpacked(ids)[unpacked(places)]
            out.append(packed(found[(found > 0) | np.append(True, found[:-1] > 0)]))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), pa.array(out, pa.binary())], names=["symbols", "states"])


def _shards(nodes: DataFrame, columns: list[str], shard: int):
    """The rows of consecutive ids, at most `shard` at a time, and whether there are several parts."""
    last = nodes.agg(F.max("id")).first()[0] or 0
    for low in range(1, last + 1, shard):
        yield nodes.where(F.col("id").between(low, low + shard - 1)).select(*columns).toPandas(), last > shard


def symbols(texts: DataFrame, words: DataFrame, shard: int = SHARD) -> DataFrame:
    """Blocks (symbols, states): the id in `words` (lang, phrase, id from 1) of every word, 0 for a rare one and between pieces."""
    schema, steps, blocks = "lang string, places binary, words array<string>, ids binary", [_cut], texts
    for part, several in _shards(words, ["lang", "phrase", "id"], shard):
        table = {lang: (pa.array(rows["phrase"], pa.string()), rows["id"].to_numpy(np.int64)) for lang, rows in part.groupby("lang")}
        steps.append(_look_up(texts.sparkSession.sparkContext.broadcast(table)))  # at most `shard` words
        if several:
            blocks, steps = written(blocks.mapInArrow(_one_after_another(steps), schema), "words-of-blocks"), []
    return blocks.mapInArrow(_one_after_another([*steps, _settle]), "symbols binary, states binary")


def _one_after_another(steps: list):
    """Batch functions as one, so that they share a Python worker."""
    return lambda batches: reduce(lambda out, step: step(out), steps, batches)


@dataclass(frozen=True)
class Trie:
    """Double array of one shard of nodes: base of each parent from `low` on, owner and child of each slot."""

    low: int
    base: np.ndarray
    symbol: np.ndarray  # the symbols of this shard, sorted
    owner: np.ndarray
    child: np.ndarray

    @classmethod
    def build(cls, parent: np.ndarray, symbol: np.ndarray, child: np.ndarray) -> "Trie":
        """From edges (parent, symbol) -> child, each once."""
        low = int(parent.min())
        known, code = np.unique(symbol, return_inverse=True)
        order = np.lexsort((code, parent))
        parent, code, child = parent[order] - low, code[order], child[order]
        first = np.flatnonzero(np.append(True, parent[1:] != parent[:-1]))
        count = np.diff(np.append(first, len(parent)))
        width = len(known)
        base = np.zeros(int(parent[-1]) + 1, np.int64)
        owner = np.zeros(2 * width + 2 * len(parent) + 1024, np.int64)
        values = np.zeros(len(owner), np.int64)

        def grown(size: int) -> None:
            nonlocal owner, values
            if size > len(owner):
                more = np.zeros(max(size, 2 * len(owner)) - len(owner), np.int64)
                owner, values = np.append(owner, more), np.append(values, more)

        lowest = width  # slots before `width` stay free, so that no base is below zero
        for at in np.argsort(-count, kind="stable"):
            codes = code[first[at] : first[at] + count[at]]
            if count[at] == 1:
                break
            start, found = lowest, -1
            while found < 0:
                grown(start + 4096 + 2 * width)
                tries = start + np.flatnonzero(owner[start : start + 4096] == 0) - codes[0]
                if start == lowest and len(tries) < 64:
                    lowest += 4096
                for c in codes[1:]:
                    tries = tries[owner[tries + c] == 0]
                    if not len(tries):
                        break
                found, start = int(tries[0]) if len(tries) else -1, start + 4096
            slots = found + codes
            base[parent[first[at]]] = found
            owner[slots] = parent[first[at]] + 1
            values[slots] = child[first[at] : first[at] + count[at]]
        single = first[count == 1]
        if len(single):  # any free slot will do
            grown(len(owner) + len(single))
            slots = width + np.flatnonzero(owner[width:] == 0)[: len(single)]
            base[parent[single]] = slots - code[single]
            owner[slots] = parent[single] + 1
            values[slots] = child[single]
        last = int(np.flatnonzero(owner)[-1]) + 1 + width
        grown(last)
        return cls(low, base, known, owner[:last], values[:last])

    def step(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The child of every state by every symbol, 0 where there is none."""
        out = np.zeros(len(state), np.int64)
        own = state - self.low
        code = np.minimum(np.searchsorted(self.symbol, symbol), len(self.symbol) - 1)
        at = np.flatnonzero((state > 0) & (own >= 0) & (own < len(self.base)) & (self.symbol[code] == symbol))
        slot = self.base[own[at]] + code[at]
        mine = self.owner[slot] == own[at] + 1
        out[at[mine]] = self.child[slot[mine]]
        return out


# ------------------------------------------------------------------------------------ levels
def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """States of several blocks at a time, a zero between them."""
    held: list[np.ndarray] = []
    for batch in batches:
        for states in batch.column("states"):
            held += [unpacked(states), np.zeros(1, np.int64)]
            if sum(map(len, held)) >= POSITIONS:
                yield np.concatenate(held)
                held = []
    if held:
        yield np.concatenate(held)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each state is followed by each state."""
    for state in _joined(batches):
        at = np.flatnonzero((state[:-1] > 0) & (state[1:] > 0))
        if len(at):
            known, code = np.unique(state, return_inverse=True)  # the accepting states here
            pair, count = np.unique(code[at] * len(known) + code[at + 1], return_counts=True)
            i, j = np.divmod(pair, len(known))
            yield pa.RecordBatch.from_arrays([pa.array(known[i]), pa.array(known[j]), pa.array(count.astype(np.int64))], names=["i", "j", "a"])


def _frequent_pairs(blocks: DataFrame, nodes: DataFrame, least: int) -> DataFrame:
    """(i, j, a) of the state pairs that occur `least` times.  Both numbers travel as one: half the shuffle."""
    width = (nodes.agg(F.max("id")).first()[0] or 0) + 1
    whole = "long" if width**2 < 1 << 63 else "decimal(38,0)"
    both = (F.col("i").cast(whole) * F.lit(width).cast(whole) + F.col("j")).cast(whole)
    counted = blocks.select("states").mapInArrow(_pairs, "i long, j long, a long").groupBy(both.alias("both")).agg(F.sum("a").alias("a")).where(F.col("a") >= least)
    return counted.select(F.expr(f"CAST(both div {width}L AS LONG) AS i"), F.expr(f"CAST(both % {width}L AS LONG) AS j"), "a")


def _mover(shared, k: int):
    """Next states of all positions by one shard of the trie, added to those of other shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = shared.value
        for batch in batches:
            for r in range(batch.num_rows):  # a block at a time: blocks may be as long as a text
                symbol, state, before = (batch.column(c)[r] for c in ("symbols", "states", "next"))
                held = unpacked(symbol)
                found = trie.step(unpacked(state), np.append(held[k:], np.zeros(min(k, len(held)), np.int64)))
                if before.is_valid:
                    found += unpacked(before)
                yield batch.slice(r, 1).set_column(2, "next", pa.array([packed(found)], pa.binary()))

    return run


def advance(blocks: DataFrame, phrases: DataFrame, k: int, shard: int = SHARD) -> DataFrame:
    """`blocks` with the states of level k + 1 in place of those of level k; `phrases` are that level's nodes."""
    moved = blocks.withColumn("next", F.lit(None).cast("binary"))
    for part, several in _shards(phrases, ["i", "last", "id"], shard):
        trie = Trie.build(*(part[c].to_numpy(np.int64) for c in ("i", "last", "id")))  # at most `shard` edges
        moved = moved.mapInArrow(_mover(blocks.sparkSession.sparkContext.broadcast(trie), k), moved.schema)
        if several:
            moved = written(moved, "moved")
    return moved.select("symbols", F.col("next").alias("states"))


def _grown(pairs: DataFrame, phrases: DataFrame) -> DataFrame:
    """The nodes of pairs (i, j, a): phrase i and the last word of phrase j, with the counts of their first parts and rests."""
    first = phrases.select(F.col("id").alias("i"), "lang", "phrase", F.concat("firsts", F.array("a")).alias("firsts"))
    rest = phrases.select(F.col("id").alias("j"), "last", "word", F.concat(F.array("a"), "rests").alias("rests"))
    return pairs.join(first, "i").join(rest, "j").select("id", "i", "j", "a", "lang", F.concat_ws(" ", "phrase", "word").alias("phrase"), "last", "word", "firsts", "rests")


def levels(documents: DataFrame, least: int = LEAST, words: int = WORDS, shard: int = SHARD, lang_col: str = "lang", text_col: str = "text") -> tuple[DataFrame, list[DataFrame]]:
    """((lang, n), the frequent phrases of 1, 2, ... words with their counts, as tables)."""
    spark = documents.sparkSession
    texts = _texts(documents, lang_col, text_col)
    counted = word_counts(texts, least)
    totals = counted.where("word = ''").select("lang", F.col("a").alias("n"))
    none = F.array().cast("array<long>")
    listed = numbered(counted.where("word <> ''"), [], ["lang", "word"], "at").withColumn("id", F.col("at") + 1)
    nodes = listed.select("id", F.lit(0).cast("long").alias("i"), F.lit(0).cast("long").alias("j"), "a", "lang", F.col("word").alias("phrase"), F.col("id").alias("last"), "word", none.alias("firsts"), none.alias("rests"))
    out = [written(nodes, "phrases")]
    path = shared_folder(spark, "blocks")
    symbols(texts, out[0], shard).write.parquet(path)
    for k in range(1, words):
        blocks = spark.read.parquet(path)
        pairs = numbered(written(_frequent_pairs(blocks, out[-1], least), "pairs"), [], ["i", "j"], "at").withColumn("id", F.col("at") + 1).drop("at")
        out.append(written(_grown(pairs, out[-1]), "phrases"))
        if k + 1 < words:
            older, path = path, shared_folder(spark, "blocks")
            advance(blocks, out[-1], k, shard).write.parquet(path)
            remove_folder(spark, older)
    remove_folder(spark, path)
    return totals, out


def mine(documents: DataFrame, least: int = LEAST, words: int = WORDS, top: int = TOP, kept_percent: int = KEPT_PERCENT, shard: int = SHARD,
         lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """The `top` collocations of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase goes when a longer one that holds it is as frequent (`kept_percent` of it).  Counts
    fall with length, so it is enough to look at phrases one word longer.
    """
    totals, found = levels(documents, least, words, shard, lang_col, text_col)
    parts = []
    for k in range(1, len(found)):
        own = found[k].select("id", "lang", "phrase", "a", "firsts", "rests")
        if k + 1 < len(found):
            longer = found[k + 1].select(F.explode(F.array_distinct(F.array("i", "j"))).alias("id"), "a").groupBy("id").agg(F.max("a").alias("longer"))
            own = own.join(longer, "id", "left").where(F.coalesce(100 * F.col("longer") < kept_percent * F.col("a"), F.lit(True))).drop("longer")
        parts.append(own)
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    # exact: at most 35 digits above, 28 below
    cut = F.expr("""array_min(transform(firsts, (l, m) -> named_struct(
        'score', (CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(14,0)) * CAST(n AS DECIMAL(15,0))) div (CAST(l AS DECIMAL(14,0)) * CAST(rests[m] AS DECIMAL(14,0))),
        'm', m, 'l', l, 'r', rests[m])))""")
    scored = every.join(totals, "lang").withColumn("cut", cut)
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").cast("long").alias("score"))
