"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing extra columns."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from roasline.llm import bpe, embed_neighbours, html_blocks, line_spread, mixing, quality_ngrams, repeats, secret_scan, sharding, simhash
from roasline.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, row long, size long, spans string"
LONG = " ".join(f"word{n % 977}" for n in range(60_000))
ROWS = [
    (1, None, None, None, None, None, None, None, None), (2, "", "en", "a", 0, "x", 1, 1, "s"), (None, "one two three four", "en", "b", 1, "x", 1, 1, "s"),
    (3, LONG, "en", "a", 1, "x", 1, 1, "s"), (4, LONG, "en", None, 1, "x", 1, 1, "s"), (5, " \t\n ", "en", "c", 1, "x", 1, 1, "s"),
    (6, "same same", "en", "a", 1, "x", 1, 1, "s"), (6, "same same", "en", "a", 1, "x", 1, 1, "s"), (7, "token=abcdefgh12\nline of text here", "en", "b", 1, "x", 1, 1, "s"),
]
LABELS = "doc_id long, quality int, toxic int"


def docs(spark, rows=ROWS):
    return spark.createDataFrame(rows, DOCS)


def queries(spark, rows):
    d = docs(spark, rows)
    labels = spark.createDataFrame([(3, 1, 0), (None, 1, None), (2, 0, 1)] if rows else [], LABELS)
    model = quality_ngrams.fit(d, labels)
    return {
        "quality": quality_ngrams.score(d, model), "lines": line_spread.remove_boilerplate(d, F.col("source"), count_col="gone"),
        "secrets": secret_scan.digest(secret_scan.judge(d, F.col("source"), F.col("lang"))), "mix": mixing.expand(mixing.mix_sources(d)),
        "shards": sharding.assign(d), "repeats": repeats.cut(d), "bpe": bpe.encode(d, tokenizer_path()), "simhash": simhash.classes(d),
    }


def test_every_row_comes_back_once(spark):
    for name, frame in queries(spark, ROWS).items():
        assert frame.count() == len(ROWS), name


def test_empty_tables(spark):
    for name, frame in queries(spark, []).items():
        assert frame.count() == 0, name
    d = docs(spark, [])
    assert mixing.mixed(d).count() == 0 and simhash.keep_one(d).count() == 0
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embed_neighbours.near_duplicates(empty).count() == 0
    assert html_blocks.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_null_and_blank_texts(spark):
    found = queries(spark, ROWS)
    nothing = hashlib.sha256(b"").hexdigest()
    assert {(r.n_tokens, r.ids_sha256) for r in found["bpe"].where("doc_id in (1, 2)").collect()} == {(0, nothing)}
    assert {(r.n_bytes, r.n_removed, r.kept_sha256) for r in found["repeats"].where("doc_id in (1, 2)").collect()} == {(0, 0, nothing)}
    assert {r.component_id for r in found["simhash"].where("doc_id in (1, 2, 5)").collect()} == {1}
    assert {(r.fp, r.component_id) for r in found["simhash"].where("doc_id in (1, 2)").collect()} == {(0, 1)}
    assert not any(r.kept for r in found["quality"].where("doc_id in (1, 2, 5)").collect())
    assert found["lines"].where("doc_id = 1 and text is null").count() == 1


def test_copies_are_repeats_and_short_texts_stay(spark):
    rows = {r.doc_id: r for r in repeats.cut(docs(spark)).collect()}
    assert rows[3].n_removed == rows[3].n_bytes == len(LONG) and rows[3].n_spans == 1 and rows[4].n_removed == len(LONG)
    assert rows[6].n_removed == 0 and bytes(rows[6].kept) == b"same same"


def test_mix_repeats_rows_as_planned(spark):
    d = docs(spark)
    plan = mixing.expand(mixing.mix_sources(d))
    wanted = plan.agg(F.sum("copies")).first()[0]
    out = mixing.mixed(d)
    assert out.count() == wanted and out.columns == d.columns
    assert plan.agg(F.max("copies")).first()[0] <= 3


def test_vectors_without_direction_link_with_nothing(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [0.999, 0.01], 1), (4, [1.0, 0.0], 2), (5, [0.0, 0.0], 1), (6, None, 1), (7, [float("nan"), 1.0], 1),
            (8, [1.0, 0.0], None), (9, [1.0, None], 1), (10, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1), (11, [], 1), (12, [float("inf"), 1.0], 1)]
    out = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embed_neighbours.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert len(out) == len(rows)
    assert out[1] == (3, 1, True) and out[2] == (3, 1, False) and out[3] == (3, 1, False) and out[None][:2] == (3, 1)
    for alone in (4, 5, 6, 7, 8, 9, 10, 11, 12):
        assert out[alone] == (0, alone, True)


def test_pages(spark):
    page = "<html><body><nav><a href=x>Home</a></nav><article><h1>A &amp; B</h1><p>one\n two <b>three</b><p>four</article><footer>f</footer>"
    rows = [(1, "u", page), (2, "u", None), (3, "u", ""), (None, None, page), (1, "u", page), (4, "u", page + "<scr"), (5, "u", "<p" * 3), (6, "u", "<article><p>" + "long " * 200_000 + "</p></article>")]
    out = html_blocks.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    text = "A & B\n\none two three\n\nfour"
    assert [r.text for r in out[:6]] == [text, "", "", text, text, text]
    assert all(r.n_chars == len(r.text) for r in out) and out[7].text == ("long " * 200_000).strip()


def test_slots_and_growth(spark):
    d = docs(spark, ROWS + [(9, f"t{n % 3}", "en", "a", 1, "x", 1, 1, "s") for n in range(500)])
    rows = d.select("doc_id", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("crc"))
    placed = sharding.assign(sharding.assign(rows), (1.0,) * 17, shard_col="grown")
    out = sharding.number(placed, "shard", ["doc_id", "crc"], F.md5(F.col("crc").cast("string")), run=64).collect()
    assert len(out) == len(ROWS) + 500
    for shard in {r.shard for r in out}:
        slots = sorted(r.slot for r in out if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert all(r.grown in (r.shard, 16) for r in out)
    assert {r.crc for r in out if r.doc_id == 9} == {zlib.crc32(f"t{n}".encode()) for n in range(3)}


def test_weights_share_records(spark):
    keys = spark.range(20_000).withColumnRenamed("id", "doc_id")
    counts = {r.shard: r["count"] for r in sharding.assign(keys, (1.0, 3.0, 0.0)).groupBy("shard").count().collect()}
    assert 2 not in counts and counts[1] / counts[0] == pytest.approx(3, rel=0.1)


def test_lines_are_judged_by_spread_alone(spark):
    """Short lines and documents that are mostly boilerplate are cleaned; copies, blank lines, null and shared ids."""
    rows = [(None if n % 2 else 1, f"Menu\n\nHome  \nown words {n}", f"s{n}") for n in range(10)]
    rows += [(2, "Menu\n \nHome", f"s{n}") for n in range(3)] + [(None, "x\n" * 50 + "y", "s0"), (None, None, "s1"), (3, "", None), (4, "Home\nlast", None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"_key": F.lit("mine"), "line": F.lit(7), "_flagged": F.lit("f"), "words": F.lit(1)})
    out = line_spread.remove_boilerplate(d, F.col("source"), count_col="gone")
    assert out.columns == [*d.columns, "gone"] and out.where("_key = 'mine' and line = 7 and _flagged = 'f' and words = 1").count() == len(rows)
    got = sorted(((r.doc_id, r.text, r.source, r.gone) for r in out.collect()), key=repr)
    wanted = [(None if n % 2 else 1, f"\nown words {n}", f"s{n}", 2) for n in range(10)]
    wanted += [(i, t, s, 0) for i, t, s in rows[10:-1]] + [(4, "last", None, 1)]
    assert got == sorted(wanted, key=repr)
    with pytest.raises(ValueError, match="__line_"):
        line_spread.remove_boilerplate(d.withColumn("__line_k1", F.lit(1)), F.col("source"))


def test_names_used_inside_are_carried(spark):
    names = ["k1", "k2", "places", "copied", "__0", "__text", "_key", "_words", "_id", "_text", "_n"]
    d = docs(spark).select("doc_id", "text", "source", *[F.lit(f"my {c}").alias(c) for c in names])
    for name, out in {"repeats": repeats.cut(d), "keep": simhash.keep_one(d), "mix": mixing.mixed(d)}.items():
        rows = out.select(*names).distinct().collect()
        assert [tuple(r) for r in rows] == [tuple(f"my {c}" for c in names)], name


def test_choices_among_unequal_rows_are_repeatable(spark):
    """Equal ids, sources and sizes but other texts or columns: the same rows however they are dealt."""
    rows = [(None, f"word{n % 7} and more words here {n % 7}", "a" if n % 3 else "b", n % 5) for n in range(60)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, extra int")
    for call in (mixing.mixed, simhash.keep_one):
        one, two = (sorted((tuple(r) for r in call(d.repartition(parts, *cols)).collect()), key=repr) for parts, cols in ((1, []), (5, [F.rand(3)])))
        assert one == two and one


def test_removed_ranges_add_up(spark):
    rows = {r.doc_id: r for r in repeats.cut(spark.createDataFrame(
        [(1, "a b c " + LONG[:900] + " d e f"), (2, LONG[:900]), (3, "short")], "doc_id long, text string")).collect()}
    assert rows[1].removed == "6:906" and rows[2].removed == "0:900" and rows[3].removed == ""
    assert all(r.n_kept == len(r.kept) == r.n_bytes - r.n_removed for r in rows.values())
