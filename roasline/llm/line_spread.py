"""Line deduplication by distinct-site spread.

Every line is hashed; a HyperLogLog sketch of the sites that hold it is built map-side and merged
by aggregation, so a line that a third of all rows repeat is one sketch per task.  Lines whose
estimate is clearly below `min_sites` are left, clearly above are boilerplate, and only lines near
the threshold get an exact distinct count.  Boilerplate lines are removed from every document.

Lines are compared after trimming blanks; blank lines are layout, not lines to judge, and stay.
Every other line is judged by its spread alone, whatever its length and however much of a document
it makes up.  A document without a line of its own (every line is held by `min_sites` sites) is a copy
and stays whole: removing its lines from every copy would lose the text altogether, and copies are the
business of document deduplication.  Equality is by 64-bit hash; an unequal line is mistaken for boilerplate with a chance of (boilerplate lines) / 2**64.

Edge cases: a null text stays null, an empty one empty; a null site counts as one site; repeated
rows and ties add nothing to a spread; null and shared ids are cleaned like others (rows meet their
lines by hashes of text and id); an empty table gives an empty result;
all columns of the input are returned unchanged but the text, and may have any name but those that
begin with `__line_`, which raise an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

MIN_SITES = 10
LOG_K = 12
# Six standard errors of a sketch with 2**12 registers, and one site for small counts.
BAND = 6 * 1.04 / 64
OWN = "__line_"  # reserved beginning of column names used inside


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def line_sites(documents: DataFrame, site: Column, text_col: str = "text") -> DataFrame:
    """(line, site) for every line that is not blank; `line` is its hash."""
    rows = documents.select(F.coalesce(F.concat(F.lit("s"), site.cast("string")), F.lit("n")).alias("site"), F.explode(F.split(F.col(f"`{text_col}`"), "\n")).alias("words"))
    return rows.select(_trimmed(F.col("words")).alias("words"), "site").where("words != ''").select(F.xxhash64("words").alias("line"), "site")


def boilerplate(documents: DataFrame, site: Column, min_sites: int = MIN_SITES, text_col: str = "text") -> DataFrame:
    """(line): hashes of lines that at least `min_sites` distinct sites hold."""
    held = line_sites(documents, site, text_col)
    spread = held.groupBy("line").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LOG_K))).alias("sites"))
    low, high = min_sites * (1 - BAND) - 1, min_sites * (1 + BAND) + 1
    likely = spread.where(F.col("sites") >= low).checkpoint()
    near = likely.where(F.col("sites") <= high).select("line")
    # one row for each line and site before the join, so that no line brings more rows than there are sites
    exact = held.distinct().join(near, "line", "left_semi").groupBy("line").agg(F.count("*").alias("sites")).where(F.col("sites") >= min_sites)
    return likely.where(F.col("sites") > high).select("line").unionByName(exact.select("line"))


def remove_boilerplate(documents: DataFrame, site: Column, min_sites: int = MIN_SITES, id_col: str = "doc_id", text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """`documents` with boilerplate lines removed from the text; `count_col` names an added count of removed lines.

    A document is joined with the hashes of its own boilerplate lines (at most its line count) by a
    hash of the text and one of text and id, so a group of copies is spread by its ids and rows that
    share both share one list, which is right for each of them.
    """
    if taken := [c for c in documents.columns if c.startswith(OWN)]:
        raise ValueError(f"column names that begin with {OWN} are reserved: {taken}")
    flagged = boilerplate(documents, site, min_sites, text_col).checkpoint()
    text = F.col(f"`{text_col}`")
    one, two, mark = f"{OWN}k1", f"{OWN}k2", f"{OWN}flagged"
    keyed = documents.withColumns({one: F.xxhash64(text), two: F.xxhash64(F.lit(1), F.col(f"`{id_col}`"), text)})
    split = keyed.select(one, two, F.explode(F.array_distinct(F.transform(F.split(text, "\n"), _trimmed))).alias("words"))
    mine = split.where("words != ''").select(one, two, F.xxhash64("words").alias("line"))
    mine = mine.join(flagged, "line").groupBy(one, two).agg(F.collect_set("line").alias(mark))
    joined = keyed.join(mine.hint("shuffle_hash"), [one, two], "left")
    all_lines = F.split(text, "\n")
    stay = F.filter(all_lines, lambda x: (_trimmed(x) == "") | ~F.array_contains(mark, F.xxhash64(_trimmed(x))))
    joined = joined.withColumn(f"{OWN}stay", F.when(F.col(mark).isNotNull(), stay))
    has_own = F.exists(f"{OWN}stay", lambda x: _trimmed(x) != "")  # null where nothing is flagged
    out = [F.when(has_own, F.array_join(f"{OWN}stay", "\n")).otherwise(text).alias(c) if c == text_col else F.col(f"`{c}`") for c in documents.columns]
    if count_col:
        out.append(F.when(has_own, F.size(all_lines) - F.size(f"{OWN}stay")).otherwise(0).cast("long").alias(count_col))
    return joined.select(*out)
