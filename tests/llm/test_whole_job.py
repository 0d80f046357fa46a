"""Cases in which an operator once did less than the whole job."""

import numpy as np


def test_audit_finds_the_few_links_of_a_large_table(spark):
    """One linked pair among 3,000 vectors, not found: the audit must not pass on an empty sample."""
    from roasline.llm.embed_neighbours import audit, near_duplicates, nodes_of

    r = np.random.default_rng(11)
    v = r.standard_normal((3000, 32))
    v[10] = v[11] + 0.02 * r.standard_normal(32)
    table = spark.createDataFrame([(n, x.tolist(), 1) for n, x in enumerate(v)], "vec_id long, embedding array<double>, label int")
    _, nodes = nodes_of(table, "vec_id", "embedding", "label")
    assert audit(nodes, spark.createDataFrame([], "node long, links long"), 0.93) == 0.0
    linked = {x.vec_id: x.n_links for x in near_duplicates(table).collect() if x.n_links}
    assert linked == {10: 1, 11: 1}


def test_windows_of_copied_texts_are_cut_once(spark):
    """Twenty copies that share a passage with another text: each window is built once, not 20 x 20 times."""
    from roasline.llm import repeats

    r = np.random.default_rng(5)
    word = lambda n: " ".join(f"w{x}" for x in r.integers(0, 10**6, n))
    passage = word(120)
    one, two = word(60) + passage + word(60), word(90) + passage + word(30)
    documents = spark.createDataFrame([(n, one) for n in range(20)] + [(20, two)], "doc_id long, text string")
    texts = repeats._keyed(documents, "text").select("k1", "k2", "text")
    _, members = repeats.refine(repeats.first_level(texts, repeats.SPAN, repeats.WINDOW))
    windows = repeats.cut_windows(texts, members, repeats.SPAN)
    assert 0 < members.count() == members.distinct().count() == windows.count() == windows.distinct().count()
    out = {x.doc_id: x for x in repeats.cut(documents).collect()}
    assert len(out) == 21 and all(out[n].n_removed == len(one) for n in range(20))
    gone = {k for n in range(len(two) - 399) if two[n : n + 400] in one for k in range(n, n + 400)}
    assert gone and bytes(out[20].kept).decode() == "".join(c for n, c in enumerate(two) if n not in gone)


def test_quality_counts_grow_with_the_corpus(spark):
    """Filler of ever new words must not wash out the verdict: junk goes at eighty thousand distinct words as at few."""
    from roasline.llm import quality_ngrams

    r = np.random.default_rng(7)
    prose = lambda: " ".join(f"good{x}" for x in r.integers(0, 300, 120))
    junk = lambda: " ".join(f"junk{x}" for x in r.integers(0, 300, 120))
    rows = [(n, prose() if n % 4 else junk()) for n in range(400)]
    filler = [(1000 + n, " ".join(f"x{n}y{x}" for x in range(8000))) for n in range(100)]
    documents = spark.createDataFrame(rows + filler, "doc_id long, text string")
    labels = spark.createDataFrame([(n, int(n % 4 > 0), 0) for n in range(0, 200)], "doc_id long, quality int, toxic int")
    out = {x.doc_id: x.kept for x in quality_ngrams.score(documents, quality_ngrams.fit(documents, labels)).where("doc_id between 200 and 399").collect()}
    assert out == {n: n % 4 > 0 for n in range(200, 400)}


def test_text_of_math_and_object_is_judged():
    """Formulas and an object's fallback text are text of their block; an unclosed one hides nothing after it."""
    from roasline.llm.html_blocks import leaves

    page = "<article><p>where <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p><div><object data=a>fallback</object> after</div><div><math><mi>y</mi> rest</div></article>"
    assert [leaf.text for leaf in leaves(page)] == ["where x=2 holds", "fallback after", "y rest"]


def test_one_row_of_each_class_stays_with_null_and_shared_ids(spark):
    """Copies with null ids are one class, and an id shared with another class brings no rejected text back."""
    from roasline.llm import simhash

    r = np.random.default_rng(9)
    a, b, x, y = (" ".join(f"w{n}" for n in r.integers(0, 10**6, 80)) for _ in range(4))
    rows = [(None, a), (None, a), (None, b), (1, b), (2, x), (9, x), (9, y), (9, y)]
    out = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(out, key=lambda q: q.text) == sorted([(None, a), (1, b), (2, x), (9, y)], key=lambda q: q[1])
