"""Collocations against counts by hand, and the double array against a dictionary."""

import re
from collections import Counter

import numpy as np
import pytest

from roasline.llm import collocations, queries

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, phrase string, word string, a long"


def brute(docs, least=100, top=2000) -> list[tuple]:
    counts: dict[str, Counter] = {}
    totals: Counter = Counter()
    for r in docs:
        lang = "und" if r.lang is None else r.lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r.text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 6):
                counts.setdefault(lang, Counter()).update(tuple(words[n : n + k]) for n in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        longest: dict[tuple, int] = {}
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for at in range(len(p) - size + 1):
                    longest[p[at : at + size]] = max(longest.get(p[at : at + size], 0), a)
        rows = []
        for p, a in candidates.items():
            if 100 * longest.get(p, 0) < 100 * a:
                score, k = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def found(frame) -> list[tuple]:
    return sorted(tuple(r) for r in frame.collect())


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = brute(docs)
    assert want and found(queries.QUERIES["op12_trie_collocations"](spark, SF)) == want


def test_small_shards_give_the_same(spark):
    """Word list and tries in many shards of 50 nodes, and a lower least count."""
    documents = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    assert found(collocations.mine(documents, least=12, shard=50)) == brute(documents.collect(), least=12)


def test_edge_rows(spark):
    x = ("a", "b", 1)
    rows = [(1, None, "en", *x), (2, "", "en", *x), (3, "New York, new york! NEW\tYORK\nnew", "en", *x), (3, "New York, new york! NEW\tYORK\nnew", "en", *x), (None, "new york", None, *x),
            (4, "go go go go", "", *x), (5, "é É é É", "fr", *x), (6, "new york new york " * 50_000, "und", *x), (7, ",;:  \t\r", "en", *x)]
    documents = spark.createDataFrame(rows, COLUMNS)
    for least in (2, 3):
        assert found(collocations.mine(documents, least=least)) == brute(documents.collect(), least=least)
    assert found(collocations.mine(documents, least=2, top=1)) == brute(documents.collect(), least=2, top=1)
    assert found(collocations.mine(documents.limit(0))) == []


@pytest.mark.parametrize(("edges", "parents", "words"), [(1, 1, 1), (50, 10, 20), (5000, 900, 300), (20000, 15000, 3000), (3000, 2, 5000)])
def test_trie_steps(edges, parents, words):
    r = np.random.default_rng(edges)
    pairs = np.unique(np.stack([r.integers(5, 5 + parents, edges), r.integers(1, words + 1, edges) * 7], 1), axis=0)
    child = np.arange(len(pairs)) + 101
    trie = collocations.Trie.build(pairs[:, 0], pairs[:, 1], child)
    known = {tuple(p): int(c) for p, c in zip(pairs.tolist(), child)}
    state, symbol = r.integers(0, parents + 9, 20_000), r.integers(0, words * 7 + 9, 20_000)
    assert trie.step(state, symbol).tolist() == [known.get(x, 0) for x in zip(state.tolist(), symbol.tolist())]
    assert trie.step(pairs[:, 0], pairs[:, 1]).tolist() == child.tolist()
