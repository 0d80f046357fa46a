"""Quality rules: hashed n-gram log-likelihood ratio between a trusted target and the raw corpus.

Words and word pairs are hashed to 64 bits.  The target multinomial (quality 1 and not toxic) is fitted
on at most `TRUSTED` trusted rows, a documented bound: its vocabulary is the n-grams that occur at least
twice there, at most `VOCABULARY` of them, the most frequent ones; all other words are one class, all other pairs another.  The raw multinomial counts these classes over every n-gram of every document: each
task adds up one array over the broadcast vocabulary and sends the counts that are not zero.  A
document's score is the mean of ``log(p_target / p_raw)`` over its n-grams, in one pass; it is kept when
it passes the base rules and its score reaches the threshold.  The n-grams that occur once in the
target give the other classes their target mass, which is the usual estimate of what is unseen.

One trusted document in `HELD_OUT` is no part of the target: the threshold is set where the scores of
these and of the documents labelled bad (at most `TRUSTED` of each) part best.  Ratios are whole numbers of 2**-20, so sums do
not depend on the order of rows.

Edge cases: a null or empty text has no words and fails the base rules; null ids never match a
label and pass through; repeated rows are scored each; an empty corpus or no trusted rows gives
score 0 for every document; without labels of both kinds to part, the threshold is `THRESHOLD`;
extra columns are carried, those named like a result column are replaced by it (`keep_good` returns
all columns as they were); columns that begin with `__` are the operator's own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .flat import RangeHash, U64, Words, column_bytes, mix, per_row, slices
from ..functions.numbering import written

TRUSTED = 20_000
VOCABULARY = 1 << 20
LEAST = 2
SLICE = 1 << 19
HELD_OUT = 5
THRESHOLD = -0.12
PRIOR_SHARE = 1e-6
SCALE = float(1 << 20)
MIN_WORDS = 50
# Characters counted as symbols.
SYMBOL_BYTES = b"#*$%&|<>"

IS_SYMBOL = np.isin(np.arange(256), np.frombuffer(SYMBOL_BYTES, np.uint8))
FACTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FACT_SCHEMA = ", ".join(f"{name} long" for name in FACTS)


@dataclass(frozen=True)
class Model:
    """log(p_target / p_raw) in units of 1 / SCALE: of each n-gram hash of the sorted vocabulary, at the end of other words and of other pairs."""

    vocabulary: np.ndarray
    ratio: np.ndarray
    threshold: float


def _grams(words: Words, hashes: RangeHash) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash) of every word and word pair, and the words' own hashes."""
    one = hashes.of(words.start, words.end)
    joined = words.row[1:] == words.row[:-1]
    two = mix(one[:-1] * U64(0x9E3779B97F4A7C15) + one[1:])[joined]
    rows = np.concatenate([words.row, words.row[1:][joined]])
    return rows, np.concatenate([one, two]).view(np.int64), one


def _repeat_words(words: Words, one: np.ndarray) -> np.ndarray:
    """Per row: words inside 3-word windows that the row holds at least twice."""
    n = len(one)
    if n < 3:
        return np.zeros(words.rows, np.int64)
    whole = words.row[2:] == words.row[:-2]
    at = np.flatnonzero(whole)
    key = mix(mix(one[at] * U64(3) + one[at + 1]) * U64(5) + one[at + 2]) ^ mix(words.row[at].astype(U64) + U64(1))
    order = np.argsort(key)
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    hit = at[twice]
    for k in range(3):
        covered[hit + k] = True
    return np.bincount(words.row[covered], minlength=words.rows)


def _dup_lines(data: np.ndarray, offsets: np.ndarray, words: Words, hashes: RangeHash) -> np.ndarray:
    """Per row: lines with a word that equal an earlier line of the row."""
    breaks = np.flatnonzero(data == 10)
    start = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    start = start[start < len(data)]
    row = np.searchsorted(offsets, start, side="right") - 1
    end = np.minimum(offsets[row + 1], np.append(start[1:] - 1, len(data)))
    # the next start is one past a line break unless it opens another row
    end = np.where(np.append(row[1:] != row[:-1], True), offsets[row + 1], end)
    last_is_break = (end > start) & (data[np.maximum(end, 1) - 1] == 10)
    end = end - last_is_break
    has_word = np.searchsorted(words.start, end) > np.searchsorted(words.start, start)
    start, end, row = start[has_word], end[has_word], row[has_word]
    key = hashes.of(start, end) ^ mix(row.astype(U64) + U64(7))
    _, kept = np.unique(key, return_index=True)
    return np.bincount(row, minlength=words.rows) - np.bincount(row[kept], minlength=words.rows)


def _facts(data: np.ndarray, offsets: np.ndarray, words: Words, hashes: RangeHash, one: np.ndarray) -> dict[str, np.ndarray]:
    return {
        "n_words": words.count,
        "word_chars": per_row(words.inside & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": per_row(IS_SYMBOL[data], offsets),
        "n_dup_lines": _dup_lines(data, offsets, words, hashes),
        "n_repeat_words": _repeat_words(words, one),
    }


def judged_ids(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, kind): trusted ids, of them the held-out ones, and ids labelled bad."""
    good = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)
    rows = labels.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.coalesce(good, F.lit(False)).alias("good"), F.coalesce(F.col("quality") == 0, F.lit(False)).alias("bad"))
    by_id = rows.groupBy("id").agg(F.max("good").alias("good"), F.max("bad").alias("bad")).where("good or bad")
    held = F.expr(f"pmod(xxhash64(id, 3), {HELD_OUT}) = 0")
    return by_id.select("id", F.when(F.col("good") & held, "held").when(F.col("good"), "trusted").otherwise("bad").alias("kind"))


def _target_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            data, offsets = column_bytes(part.column("text"))
            _, grams, one = _grams(Words(data, offsets), RangeHash(data))
            for size, own in ((1, grams[: len(one)]), (2, grams[len(one) :])):
                found, n = np.unique(own, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n.astype(np.int64)), pa.array([size] * len(found), pa.int32())], names=["gram", "n", "size"])


def _places(vocabulary: np.ndarray, grams: np.ndarray, words: int) -> np.ndarray:
    """Where each n-gram stands in the vocabulary; one behind its end: another word, two: another pair.  The first `words` are words."""
    other = np.where(np.arange(len(grams)) < words, len(vocabulary), len(vocabulary) + 1)
    if not len(vocabulary):
        return other
    place = np.minimum(np.searchsorted(vocabulary, grams), len(vocabulary) - 1)
    return np.where(vocabulary[place] == grams, place, other)


def raw_counts(documents: DataFrame, vocabulary: np.ndarray, text_col: str = "text") -> np.ndarray:
    """How often each n-gram of the vocabulary, and at the end any other word and pair, occurs in all documents.  At most a row for each of them reaches the driver."""
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary)  # at most VOCABULARY numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(shared.value) + 2, np.int64)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                data, offsets = column_bytes(part.column("text"))
                _, grams, one = _grams(Words(data, offsets), RangeHash(data))
                counts += np.bincount(_places(shared.value, grams, len(one)), minlength=len(counts))
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(counts[found])], names=["place", "n"])

    summed = documents.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(run, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(vocabulary) + 2, np.int64)
    out[summed.column("place").to_numpy()] = summed.column("n").to_numpy()
    return out


def parting(scores: np.ndarray, good: np.ndarray, bad: np.ndarray) -> float:
    """Where the counts of good and bad rows at ascending `scores` part best; of equal places the widest gap."""
    below = np.cumsum(good)[:-1] / good.sum()
    above = 1 - np.cumsum(bad)[:-1] / bad.sum()
    lost = np.round(below + above, 12)
    gap = np.where(lost == lost.min(), np.diff(scores), -1.0)
    at = int(np.argmax(gap))
    return float((scores[at] + scores[at + 1]) / 2)


def fit(documents: DataFrame, labels: DataFrame, prior_share: float = PRIOR_SHARE, trusted: int = TRUSTED, vocabulary: int = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Count both multinomials and set the threshold.  The driver receives the vocabulary's counts and a histogram of labelled scores."""
    rows = documents.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    ids = judged_ids(labels, id_col)
    chosen = [ids.where(F.col("kind") == kind).orderBy(F.xxhash64("id", F.lit(5)), "id").limit(trusted) for kind in ("trusted", "held", "bad")]
    judged = written(rows.join(F.broadcast(chosen[0].unionByName(chosen[1]).unionByName(chosen[2])), "id").select("kind", "text"), "judged")  # at most 3 * trusted ids
    seen = judged.where("kind = 'trusted'").select("text").mapInArrow(_target_counts, "gram long, n long, size int").groupBy("gram", "size").agg(F.sum("n").alias("n"))
    counted = written(seen, "target-grams")
    mass = {r["size"]: r.n for r in counted.groupBy("size").agg(F.sum("n").alias("n")).collect()}
    total = sum(mass.values())
    if not total:
        return Model(np.zeros(0, np.int64), np.zeros(2), THRESHOLD)
    steps = counted.where(F.col("n") >= LEAST).groupBy(F.floor(F.log2("n") * 8).alias("step")).agg(F.count("*").alias("grams"), F.min("n").alias("least")).orderBy(F.desc("step")).toPandas()
    fits = steps["least"][steps["grams"].cumsum() <= vocabulary]  # a sorted limit would send as many rows from every task
    table = counted.where(F.col("n") >= int(fits.min()) if len(fits) else F.lit(False)).toArrow()
    gram, n, size = (table.column(c).to_numpy() for c in ("gram", "n", "size"))
    order = np.argsort(gram)
    gram, target = gram[order], np.append(n[order], [mass.get(k, 0) - n[size == k].sum() for k in (1, 2)]).astype(float)
    raw = raw_counts(rows, gram)
    prior = prior_share * total
    ratio = np.log((target + prior) / (raw * (total / max(raw.sum(), 1)) + prior))
    model = Model(gram, np.rint(ratio * SCALE), THRESHOLD)
    scored = score(judged.where("kind <> 'trusted'"), model).where("not base_failed")
    found = scored.groupBy(F.round("llr", 3).alias("at")).agg(F.count_if(F.col("kind") == "held").alias("good"), F.count_if(F.col("kind") == "bad").alias("bad")).orderBy("at").toPandas()
    if not found["good"].sum() or not found["bad"].sum() or len(found) < 2:
        return model
    return replace(model, threshold=parting(*(found[c].to_numpy(float) for c in ("at", "good", "bad"))))


def _judged(documents: DataFrame, model: Model, carried: list[str], least: float, min_words: int, text_col: str) -> DataFrame:
    """The `carried` columns of every row, then the base facts, base_failed, llr and kept; one pass."""
    shared = documents.sparkSession.sparkContext.broadcast((model.vocabulary, model.ratio))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, ratio = shared.value
        for batch in batches:
            for part in slices(batch, "__text", SLICE):
                data, offsets = column_bytes(part.column("__text"))
                words, hashes = Words(data, offsets), RangeHash(data)
                rows, grams, one = _grams(words, hashes)
                total = np.bincount(rows, weights=ratio[_places(vocabulary, grams, len(one))], minlength=words.rows)
                llr = total / np.maximum(np.bincount(rows, minlength=words.rows), 1) / SCALE
                facts = _facts(data, offsets, words, hashes, one)
                failed = (facts["n_words"] < min_words) | (100 * facts["n_repeat_words"] > 50 * facts["n_words"])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], *[pa.array(facts[c].astype(np.int64)) for c in FACTS], pa.array(failed), pa.array(llr), pa.array(~failed & (llr >= least))],
                    names=[*carried, *FACTS, "base_failed", "llr", "kept"],
                )

    kinds = {f.name: f.dataType.simpleString() for f in documents.schema.fields}
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in carried], FACT_SCHEMA, "base_failed boolean, llr double, kept boolean"])
    return documents.select(*[F.col(f"`{c}`") for c in carried], F.col(f"`{text_col}`").alias("__text")).mapInArrow(judge, schema)


def score(documents: DataFrame, model: Model, threshold: float | None = None, min_words: int = MIN_WORDS, text_col: str = "text") -> DataFrame:
    """All columns of `documents` but the text, plus the base facts, base_failed, llr and kept.

    Columns of `documents` that clash with the operator's own are replaced by them.
    """
    own = [*FACTS, "base_failed", "llr", "kept"]
    carried = [c for c in documents.columns if c not in own and c != text_col]
    return _judged(documents, model, carried, model.threshold if threshold is None else threshold, min_words, text_col)


def keep_good(documents: DataFrame, model: Model, threshold: float | None = None, min_words: int = MIN_WORDS, text_col: str = "text") -> DataFrame:
    """The rows of `documents` that the rules keep, with all their columns unchanged."""
    names = [f"__{n}" for n in range(len(documents.columns))]
    judged = _judged(documents.toDF(*names), model, names, model.threshold if threshold is None else threshold, min_words, names[documents.columns.index(text_col)])
    return judged.where("kept").select(*names).toDF(*documents.columns)
