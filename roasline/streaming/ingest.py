"""Incremental ingestion: the normalisers applied to a file stream of exports.

Normalisation is a set of narrow projections, so the very same functions run on
a streaming DataFrame.  New daily export files landing in a folder are picked
up by the file source, normalised and appended to the unified table; the
checkpoint location makes the sink exactly-once.  No stateful operator is
needed: features and forecasts are batch jobs over the unified table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roasline.operators import normalize as N
from roasline.sources.csv_io import header_of, text_schema

def read_export_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A file stream whose columns are named by the header of the files already in ``path``.

    A stream has one column list, so the folder's files must share one header; a later file with
    another one stops the query (``enforceSchema=false``) instead of swapping columns.  Exports with
    several layouts go to one folder each, or through the batch reader, which unites them by name.
    """
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = [st.getPath().toString() for st in fs.listStatus(folder) if st.isFile() and st.getPath().getName().lower().endswith(".csv")]
    headers = {h for h in (header_of(spark, f) for f in files) if h}
    if len(headers) != 1:
        raise ValueError(f"{path} needs files of one header, it has {len(headers)}")
    reader = spark.readStream.schema(text_schema(headers.pop())).option("header", True).option("enforceSchema", False).option("escape", "\"").option("pathGlobFilter", "*.csv")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(path)


def normalized_stream(spark: SparkSession, paths: dict[str, str], **options) -> DataFrame:
    """Unified rows from one file stream per platform (a streaming union)."""
    streams = {p: read_export_stream(spark, path) for p, path in paths.items()}
    return N.normalize_all(streams, **options)


def start_ingest(unified_stream: DataFrame, table_path: str, checkpoint: str, available_now: bool = True):
    """Append the unified stream to a Parquet table, partitioned by channel."""
    writer = (unified_stream.writeStream.format("parquet").option("path", table_path)
              .option("checkpointLocation", checkpoint).partitionBy("channel").outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
