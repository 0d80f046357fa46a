"""Packing against the tokenizers library and the rules of a packing."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from roasline.llm import packing, queries

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, piece int, length long, ids string"


@pytest.fixture(scope="module")
def file():
    return queries.tokenizer_path("word_bpe_49k.json")


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def check(rows, docs, file, length=2048):
    """Every document's ids in its pieces, every sequence gapless and no longer than allowed."""
    tokenizer = Tokenizer.from_file(file)
    want = []
    for doc_id, text in docs:
        ids = ids_of(tokenizer, text)
        for n, at in enumerate(range(0, len(ids), length)):
            part = np.array(ids[at : at + length], "<u4")
            want.append((doc_id, n, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=str) == sorted(want, key=str)
    bins: dict[int, list] = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        end = 0
        for offset, size in sorted(parts):
            assert offset == end
            end += size
        assert end <= length
    return len(bins)


def test_query_equals_the_library(spark, file):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = queries.QUERIES["op13_two_fit_packing"](spark, SF).collect()
    bins = check(rows, docs, file)
    assert bins <= 1.01 * -(-sum(r.length for r in rows) // 2048) + 1


def test_reruns_agree(spark):
    one, two = (queries.QUERIES["op13_two_fit_packing"](spark, SF) for _ in range(2))
    assert one.exceptAll(two).count() == 0 and one.count() == two.count()


def test_edge_rows_and_sequences(spark, file):
    odd = "ǅ é é a b <|endoftext|>x it's 12ab\x85c d İI " + "가 \U0001f600"
    rows = [(1, None, 9, 9, "x"), (1, "", 9, 9, "x"), (None, odd, 9, 9, "x"), (2, "word " * 9000, 9, 9, "x"), (2, "word " * 9000, 9, 9, "x"), (3, " \t\n", 9, 9, "x"), (4, "a" * 5000, 9, 9, "x")]
    documents = spark.createDataFrame(rows, COLUMNS)
    with open(file, encoding="utf-8") as f:
        text = f.read()
    out = packing.pack(packing.pieces(documents, text, length=100, with_ids=True), 100)
    got = out.collect()
    check(got, [r[:2] for r in rows], file, 100)
    whole = {r.sequence_id: r.ids for r in packing.sequences(out).collect()}
    for r in got:
        assert whole[r.sequence_id][r.offset : r.offset + r.length] == r.ids
    assert packing.pack(packing.pieces(documents.limit(0), text)).count() == 0


def test_one_size_holds_most_rows(spark):
    sizes = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"), F.when(F.col("id") % 10 > 0, 3).otherwise(F.col("id") % 97 + 1).cast("long").alias("length"), F.lit(7).cast("long").alias("ids_crc32"))
    rows = packing.pack(sizes, 100).collect()
    bins: dict[int, int] = {}
    for r in rows:
        bins[r.sequence_id] = bins.get(r.sequence_id, 0) + r.length
    assert len(rows) == 20_000 and max(bins.values()) <= 100
    assert len(bins) <= 1.01 * sum(bins.values()) / 100 + 1


def test_best_two_fit_takes_a_better_pair():
    """60 + 25 leaves 15; 22 and 18 in place of the 25 leave nothing."""
    left = np.zeros(101, np.int64)
    left[[60, 25, 22, 18]] = 1
    assert packing.fill(left, 100) == {60: 1, 22: 1, 18: 1}
    left[18] = 0  # a lone 22 is no pair
    assert packing.fill(left, 100) == {60: 1, 25: 1}


def test_plan_places_every_piece():
    r = np.random.default_rng(4)
    for top in (3, 40, 2048):
        counts = np.bincount(r.integers(1, top + 1, 50_000), minlength=2049)
        used = np.zeros(2049, np.int64)
        for bin_, times in packing.plan(counts):
            assert sum(s * n for s, n in bin_.items()) <= 2048 and times > 0
            for s, n in bin_.items():
                used[s] += n * times
        assert (used == counts).all()


def test_other_tokenizers_are_refused(spark):
    with open(queries.tokenizer_path("byte_bpe_50k.json"), encoding="utf-8") as f:
        assert not packing.tokenizer_is_split_by_space(f.read())
