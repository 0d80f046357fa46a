"""The registered queries: each applies one operator with production parameters to its whole table."""

from __future__ import annotations

import importlib.util
import os
import sys

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import ensure_checkpoint_dir
from . import bpe, collocations, embed_neighbours, html_blocks, line_spread, manifest, mixing, packing, quality_ngrams, repeats, secret_scan, sharding, simhash

TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> str:
    """The checkpoint folder, made known to the session; Python workers are told where this library lies."""
    known = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in known:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, known)])
    return ensure_checkpoint_dir(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json", folder: str = TOKENIZERS) -> str:
    """Where the public tokenizer file lies: asked of its package if it can be imported, else below `folder`."""
    if importlib.util.find_spec("public_tokenizers"):
        import public_tokenizers

        return public_tokenizers.path(name)
    return os.path.join(folder, name)


def op1_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op2_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    cleaned = line_spread.remove_boilerplate(documents, F.col("source"), count_col="n_removed_lines")
    return cleaned.select("doc_id", "source", "text", F.col("n_removed_lines"))


def op3_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    # the table names no repositories: a source stands for the owner, its languages for the owner's repositories
    repository = F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")))
    return secret_scan.digest(secret_scan.judge(documents, F.col("source"), repository))


def op4_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.expand(mixing.mix_sources(table(spark, sf_dir, "documents")))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op5_rendezvous_shards(spark: SparkSession, sf_dir: str, shards: int = sharding.SHARDS) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    text = F.col("text")
    rows = documents.select("doc_id", F.coalesce(F.octet_length(text) + 1, F.lit(1)).cast("long").alias("size"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), F.lit("key").alias("law"))
    placed = sharding.assign(sharding.assign(rows, (1.0,) * shards), (1.0,) * (shards + 1), shard_col="grown_shard")
    spread = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("text_crc32")).cast("binary"))
    return sharding.number(placed, "shard", ["doc_id", "text_crc32", "size"], spread)


def op6_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.cut(table(spark, sf_dir, "documents").select("doc_id", "text"), with_kept=False)


def op7_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_neighbours.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(documents, tokenizer_path(), with_ids=False)


def op9_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_text("fp").alias("fingerprint"), "component_id")


def op10_ngram_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_ngrams.fit(documents, table(spark, sf_dir, "labels"))
    return quality_ngrams.score(documents, model)


def op11_merkle_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lowered = F.when(hit, F.translate("text", manifest.UPPER, manifest.UPPER.lower())).otherwise(F.col("text"))
    return manifest.prove(documents, "lang", "doc_id", ("doc_id", "source", "lang", "n_chars", "text"), tampered={"text": lowered})


def op12_trie_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


def op13_two_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(tokenizer_path("word_bpe_49k.json"), encoding="utf-8") as file:
        tokenizer = file.read()
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), tokenizer))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    if ROOT not in sys.path:
        sys.path.insert(0, ROOT)
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_html_main_text": op1_html_main_text, "op2_line_spread": op2_line_spread, "op3_secret_ownership": op3_secret_ownership,
    "op4_pivotal_mix": op4_pivotal_mix, "op5_rendezvous_shards": op5_rendezvous_shards, "op6_repeat_removal": op6_repeat_removal,
    "op7_nn_descent": op7_nn_descent, "op8_bpe_automaton": op8_bpe_automaton, "op9_simhash_pivots": op9_simhash_pivots,
    "op10_ngram_quality": op10_ngram_quality, "op11_merkle_log": op11_merkle_log, "op12_trie_collocations": op12_trie_collocations,
    "op13_two_fit_packing": op13_two_fit_packing, "pipeline": pipeline,
}

# DuckDB texts where SQL can express the result; the others are tested against brute force in tests/llm.
ORACLE_SQL = {
    "op2_line_spread": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, text FROM documents),
        l AS (SELECT r, source, unnest(string_split(text, chr(10))) AS words, generate_subscripts(string_split(text, chr(10)), 1) AS place FROM d),
        k AS (SELECT *, trim(words, chr(32) || chr(9) || chr(13)) AS line,
              trim(words, chr(32) || chr(9) || chr(13)) <> '' AS judged FROM l),
        b AS (SELECT line FROM k WHERE judged GROUP BY line HAVING count(DISTINCT coalesce('s' || source, 'n')) >= 10),
        m AS (SELECT k.*, judged AND k.line IN (SELECT line FROM b) AS gone FROM k),
        n AS (SELECT r, coalesce(string_agg(words, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '') AS kept, count(*) FILTER (WHERE gone) AS lines,
              coalesce(bool_or(judged AND NOT gone), false) AS own FROM m GROUP BY r)
        SELECT doc_id, source,
          CASE WHEN own THEN kept ELSE text END AS text, CASE WHEN own THEN lines ELSE 0 END AS n_removed_lines
        FROM d LEFT JOIN n USING (r)""",
    "op12_trie_collocations": r"""
        WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
        p AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\n\x0B\x0C\r]')) AS piece FROM d),
        w AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS words FROM p),
        t AS (SELECT lang, sum(len(words))::HUGEINT AS n FROM w GROUP BY lang),
        pos AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS place FROM w),
        g AS (SELECT lang, words, place, unnest(range(1, 6)) AS k FROM pos),
        f AS (SELECT lang, k, array_to_string(words[place:place + k - 1], ' ') AS phrase, count(*) AS a FROM g WHERE place + k - 1 <= len(words) GROUP BY ALL HAVING count(*) >= 100),
        c AS (SELECT * FROM f WHERE k > 1),
        s AS (SELECT lang, k, phrase, a, unnest(range(1, k)) AS m, string_split(phrase, ' ') AS words FROM c),
        v AS (SELECT s.lang, s.k, s.phrase, s.a, m, x.a AS l, y.a AS r, t.n, (1000::HUGEINT * s.a * t.n) // (x.a::HUGEINT * y.a) AS score
              FROM s JOIN f x ON x.lang = s.lang AND x.phrase = array_to_string(words[1:m], ' ') JOIN f y ON y.lang = s.lang AND y.phrase = array_to_string(words[m + 1:], ' ') JOIN t ON t.lang = s.lang),
        best AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, m) = 1),
        held AS (SELECT c.lang, array_to_string(string_split(c.phrase, ' ')[i:i + j - 1], ' ') AS phrase, max(c.a) AS longer
                 FROM c, range(2, 5) AS sizes(j), range(1, 5) AS places(i) WHERE j < c.k AND i + j - 1 <= c.k GROUP BY ALL),
        kept AS (SELECT best.* FROM best LEFT JOIN held ON held.lang = best.lang AND held.phrase = best.phrase WHERE held.longer IS NULL OR 100 * held.longer < 100 * best.a),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
        SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000""",
}
