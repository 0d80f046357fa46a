"""The Merkle log against a tree built level by level in plain Python."""

import hashlib
import zlib

import numpy as np
from pyspark.sql import functions as F

from roasline.llm import manifest, queries

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, leaf string, tree string, index long"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def walk(n: int, ways: int) -> list[tuple[int, int]]:
    """(level, index) in the order in which a recursive walk completes nodes."""
    out = []

    def visit(level, index):
        if level:
            below = -(-n // ways ** (level - 1))
            for k in range(index * ways, min((index + 1) * ways, below)):
                visit(level - 1, k)
        out.append((level, index))

    visit(manifest.height(n, ways), 0)
    return out


def grown(nodes: list[str]) -> list[list[str]]:
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest("".join(out[-1][k : k + 8])) for k in range(0, len(out[-1]), 8)])
    return out


def siblings(levels: list[list[str]], index: int) -> list[tuple[str, str]]:
    out = []
    for nodes in levels[:-1]:
        first = index // 8 * 8
        out.append(("".join(nodes[first:index]), "".join(nodes[index + 1 : first + 8])))
        index //= 8
    return out


def brute(docs: list[dict]) -> list[tuple]:
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, text: digest("".join(map(part, (r["doc_id"], r["source"], r["lang"], r["n_chars"], text))))
    trees: dict = {}
    for r in docs:
        trees.setdefault(r["lang"], []).append(r)
    names = sorted(trees, key=lambda k: (k is not None, (k or "").encode()))
    levels = {}
    for name in names:
        trees[name].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        levels[name] = grown([leaf(r, r["text"]) for r in trees[name]])
    top = grown([levels[name][-1][0] for name in names])
    out = []
    for place, name in enumerate(names):
        for index, r in enumerate(trees[name]):
            path = siblings(levels[name], index) + siblings(top, place)
            text = r["text"]
            if text is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            folded = leaf(r, text)
            for left, right in path:
                folded = digest(left + folded + right)
            root = top[-1][0]
            out.append((r["doc_id"], leaf(r, r["text"]), levels[name][-1][0], root, digest("".join(a + b for a, b in path)), folded, folded == root))
    return sorted(out, key=str)


def proofs(documents, **options) -> list[tuple]:
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lowered = F.when(hit, F.translate("text", manifest.UPPER, manifest.UPPER.lower())).otherwise(F.col("text"))
    return sorted((tuple(r) for r in manifest.prove(documents, tampered={"text": lowered}, **options).collect()), key=str)


def test_places_follow_the_walk():
    for ways in (2, 3, 8):
        for n in (*range(1, 70), 511, 512, 513):
            level, index = np.array(walk(n, ways)).T
            assert manifest.postorder(level, index, n, ways).tolist() == list(range(len(level)))


def test_query_equals_brute_force(spark):
    docs = [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in queries.QUERIES["op11_merkle_log"](spark, SF).collect()), key=str)
    assert got == brute(docs)
    assert {r[-1] for r in got} == {True, False}


def test_several_rounds_of_builders_and_log_places(spark):
    """Blocks of 8 leaves: upper nodes come from later rounds; the log has every place once."""
    documents = spark.range(700).select(F.col("id").alias("doc_id"), F.concat(F.lit("Text "), "id").alias("text"), F.when(F.col("id") % 3 > 0, "en").alias("lang"), F.lit("s").alias("source"), F.col("id").alias("n_chars"))
    assert proofs(documents, levels=1) == brute([r.asDict() for r in documents.collect()])
    nodes = spark.range(700).select(F.lit("=a").alias("tree"), F.col("id").alias("index"), F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("digest"), F.lit(700).cast("long").alias("total"))
    log = manifest.united(manifest.build(nodes, levels=1)).collect()
    assert sorted(r.place for r in log) == list(range(700 + 88 + 11 + 2 + 1))
    assert [(r.level, r["index"]) for r in sorted(log, key=lambda r: r.place)] == walk(700, 8)


def test_nulls_ties_and_clashing_names(spark):
    rows = [(None, None, None, None, None, "x", "x", 1), (None, "A", "en", "s", 1, "x", "x", 1), (1, "", "", "s", 0, "x", "x", 1), (1, "", "", "s", 0, "x", "x", 1), (1, "B", "", "s", 0, "x", "x", 1),
            (2, "W " * 300_000, "en", "s", 600_000, "x", "x", 1), (3, None, "en", None, None, "x", "x", 1), (3, "Zü", "zz", None, None, "x", "x", 1)]
    documents = spark.createDataFrame(rows, COLUMNS)
    assert proofs(documents) == brute([r.asDict() for r in documents.collect()])
    assert proofs(documents.limit(0)) == []
    alone = spark.createDataFrame(rows[5:6], COLUMNS)
    (one,) = proofs(alone)
    assert one[1] == one[2] == one[3] and one[4] == digest("")
