"""Secret scans with corpus-wide ownership frequency.

Each whole text is scanned for candidate secrets.  The hash of every candidate value is aggregated
over the corpus by distinct repositories and distinct owners: a value that many owners hold is a
widely copied example, a value that one owner holds looks live.  The judgement is joined back to
the spans.  Beside the base kinds (assign, access, hex) the method adds kind ``owned``: a mixed
letter-and-digit token that no base span covers and that belongs to one owner only.

Values are hashed (SHA-256 prefix) in the scan, so raw secrets never reach a shuffle.  Frequency
is a map-side combined two-step distinct count: one row per (value, repository, owner) and task.

Edge cases: a null or empty text has no spans; rows with null ids are scanned like others; a null
owner or repository counts as one owner of its own; repeated rows add no owner; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# Kinds in their listed order, patterns and least lengths.
KINDS = ("assign", "access", "hex", "owned")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
OWNED = re.compile(r"[A-Za-z0-9+/_-]{24,}")
ASSIGN_LEAST = 8
HINTS = ("password", "passwd", "secret", "token", "api")

MAX_LIVE_OWNERS = 1
JUDGED = "array<struct<start:bigint,end:bigint,kind:string,owners:bigint,repositories:bigint,live:boolean>>"
SPAN = "struct<kind:string,start:long,end:long,value:string>"


def scan_text(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of one text, by start and then kind; code points, end exclusive."""
    spans = []
    low = text.lower()
    if any(hint in low for hint in HINTS):
        spans += [("assign", m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text)]
    spans += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    base = list(spans)
    for m in OWNED.finditer(text):
        value = m[0]
        if any(c.isdigit() for c in value) and any(c.islower() for c in value) and any(c.isupper() for c in value):
            if not any(start < m.end() and m.start() < end for _, start, end, _ in base):
                spans.append(("owned", m.start(), m.end(), value))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def scan(documents: DataFrame, owner: Column, repository: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, row (a key of the row), owner, repository, spans (values hashed)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]))
        for batch in batches:
            found = []
            for text in batch.column("text").to_pylist():
                spans = scan_text(text or "")
                found.append([{"kind": k, "start": a, "end": b, "value": hashlib.sha256(v.encode()).hexdigest()[:32]} for k, a, b, v in spans])
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("doc_id", "row", "owner", "repository")] + [pa.array(found, kind)], names=["doc_id", "row", "owner", "repository", "spans"])

    rows = documents.select(
        F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"),
        owner.cast("string").alias("owner"), repository.cast("string").alias("repository"), F.col(text_col).alias("text"),
    )
    return rows.mapInArrow(find, f"doc_id long, row long, owner string, repository string, spans array<{SPAN}>")


def ownership(scanned: DataFrame) -> DataFrame:
    """(value, owners, repositories) over the whole corpus; a null owner or repository counts as one."""
    held = scanned.select("owner", "repository", F.explode("spans").alias("s")).select(F.col("s.value").alias("value"), "owner", "repository").distinct()
    by_owner = held.groupBy("value", "owner").agg(F.count("*").alias("repositories"))
    return by_owner.groupBy("value").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))


def judge(documents: DataFrame, owner: Column, repository: Column, max_live_owners: int = MAX_LIVE_OWNERS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id and its spans with owners, repositories and a live flag.

    The scan is written once with checkpoint(); only rows with spans take part in the joins.
    """
    found = scan(documents, owner, repository, id_col, text_col).checkpoint()
    spans = found.where(F.size("spans") > 0).select("row", F.explode("spans").alias("s")).select("row", "s.*")
    judged = (
        spans.join(ownership(found), "value")
        .withColumn("live", F.col("owners") <= max_live_owners)
        .where((F.col("kind") != "owned") | F.col("live"))
        .groupBy("row").agg(F.collect_list(F.struct("start", "end", "kind", "owners", "repositories", "live")).alias("judged"))
    )
    return found.select("doc_id", "row").join(judged, "row", "left").select("doc_id", F.coalesce("judged", F.expr(f"cast(array() as {JUDGED})")).alias("spans"))


def digest(judged: DataFrame) -> DataFrame:
    """The per-document digest: counts, sha256 of the base spans, text of all spans, live and copied counts."""
    order = F.expr(f"transform(spans, s -> struct(s.start, array_position(array({', '.join(repr(k) for k in KINDS)}), s.kind) as place, s.end, s.kind, s.live))")
    text = "array_join(transform({}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
    base = "filter(spans, s -> s.kind <> 'owned')"
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in KINDS]
    return judged.withColumn("spans", F.array_sort(order)).select(
        "doc_id", *counts,
        F.sha2(F.expr(text.format(base)), 256).alias("base_sha256"),
        F.expr(text.format("spans")).alias("spans"),
        F.expr("cast(size(filter(spans, s -> s.live)) as long)").alias("n_live"),
        F.expr("cast(size(filter(spans, s -> not s.live)) as long)").alias("n_copied"),
    )
