"""Gapless positions of rows in a given order, without a window over a whole group.

Rows are dealt by ranges of (group, order), sorted inside their partition and written; the written
table is counted per group and partition, and running sums over those few counts (a row for each
partition that a group reaches) give every partition its first position.  A group that holds most
rows spreads over most partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roasline.session import shared_folder


def written(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` as a table in the session's shared folder, read back: the lineage ends there."""
    path = shared_folder(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def numbered(rows: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "position", total: str | None = None) -> DataFrame:
    """``rows`` with ``name``: 0, 1, ... inside each group by ``order``, and with ``total``, the group's rows.

    Group columns must not be NULL.  Rows equal in all ``order`` columns stand in any order (spread by
    the place they are read from, so that copies of one row are no hot key).  Reads ``rows`` twice:
    hand in a written table.  Columns that begin with ``__`` are the function's own.
    """
    keys = [*group, *order]
    spread = rows.withColumn("__tie", F.xxhash64(F.monotonically_increasing_id()))
    dealt = spread.repartitionByRange(*keys, "__tie").sortWithinPartitions(*keys, "__tie")
    stored = written(dealt.withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id()}).drop("__tie"), "numbered")
    runs = stored.groupBy(*group, "__part").agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    same = Window.partitionBy(*group)
    before = same.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")
    columns = [*group, "__part", shift.alias("__shift")] + ([F.sum("__n").over(same).alias(total)] if total else [])
    # a written table has a size that Spark knows when it picks the join
    shifts = written(runs.select(*columns), "numbered-runs")
    return stored.join(shifts, [*group, "__part"]).withColumn(name, F.col("__at") + F.col("__shift")).drop("__part", "__at", "__shift")
