"""Export discovery, CSV scans, table sinks and the loaded-dataset summary."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# File-name keywords of each platform (any one matches).
PLATFORM_KEYWORDS = {
    "google": ("google", "google_ads", "google-ads"),
    "bing": ("bing", "microsoft", "ms_ads", "msads"),
    "meta": ("meta", "facebook", "fb_ads", "meta_ads"),
}


def export_files(spark: SparkSession, data_dir: str) -> dict[str, list[str]]:
    """Every CSV file directly inside ``data_dir``, by platform.

    The session's Hadoop file system does the listing, so a local folder, HDFS and an object
    store work alike; only names travel to the driver.  A daily export folder holds many files a
    platform: all of them count.  A file that no platform claims is left out, one that two claim
    is an error, and so is a platform without files.
    """
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(data_dir)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not (fs.exists(folder) and fs.getFileStatus(folder).isDirectory()):
        raise FileNotFoundError(f"{data_dir} is no folder")
    names = {st.getPath().getName(): st.getPath().toString() for st in fs.listStatus(folder) if st.isFile()}
    return by_platform({name: path for name, path in names.items() if name.lower().endswith(".csv")}, data_dir)


def by_platform(names: dict[str, str], where: str = "the folder", keywords: dict[str, tuple[str, ...]] = PLATFORM_KEYWORDS) -> dict[str, list[str]]:
    """``names`` (file name -> path) dealt to platforms by the keywords in the file names."""
    found: dict[str, list[str]] = {platform: [] for platform in keywords}
    for name in sorted(names):
        claims = [p for p, words in keywords.items() if any(w in name.lower() for w in words)]
        if len(claims) > 1:
            raise ValueError(f"{name} fits more than one platform: {claims}")
        for platform in claims:
            found[platform].append(names[name])
    if lacking := [p for p, files in found.items() if not files]:
        raise FileNotFoundError(f"no export of {', '.join(lacking)} in {where}; it holds {sorted(names) or 'no CSV file'}")
    return found


def platform_of(files: DataFrame, name: str, keywords: dict[str, tuple[str, ...]] = PLATFORM_KEYWORDS) -> DataFrame:
    """``files`` with the platform whose keywords the file name holds; NULL for none, an error for two."""
    low = F.lower(F.col(name))
    claims = F.array_compact(F.array(*[
        F.when(F.concat_ws("", *[F.when(low.contains(w), F.lit("x")) for w in words]) != "", F.lit(p))
        for p, words in keywords.items()]))
    two = F.raise_error(F.concat(F.col(name), F.lit(" fits more than one platform"))).cast("string")
    return files.withColumn("platform", F.when(F.size(claims) > 1, two).otherwise(F.try_element_at(claims, F.lit(1))))


def header_line(spark: SparkSession, path: str) -> str:
    """The first line of one file, without a byte order mark."""
    jvm = spark.sparkContext._jvm
    file = jvm.org.apache.hadoop.fs.Path(path)
    stream = file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(file)
    try:
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()
    return (line or "").lstrip("\ufeff")


def header_of(spark: SparkSession, path: str) -> tuple[str, ...]:
    """The column names in the first line of one CSV file."""
    return tuple(next(csv.reader([header_line(spark, path)]), ()))


def text_schema(columns: tuple[str, ...]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


# Columns of a scan beside the file's own: the line as it stands where it can't be read, and its file.
CORRUPT, FILE = "_corrupt_line", "_file"
# A field in quotes (quotes inside it doubled), or one that does not begin with a quote; and a line of such fields.
FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"|(?!")[^,]*+)'
CLOSED_LINE = f"^{FIELD}(?:,{FIELD})*+$"


def parse_lines(lines: DataFrame, header: tuple[str, ...], value: str = "value") -> DataFrame:
    """``lines`` with the text ``value`` parsed to the columns of ``header``, and ``CORRUPT``; other columns are kept.

    ``CORRUPT`` is the whole line where it has fewer or more fields than the header or leaves a
    quoted field open, else NULL.  A quote inside a quoted field is doubled.
    """
    ddl = ", ".join(f"`{c.replace('`', '``')}` string" for c in (*header, CORRUPT))
    line = F.col(f"`{value}`")
    row = F.from_csv(line, ddl, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "escape": '"'})
    # the parser closes a last field itself; an odd number of quotes is the cheap sign of one
    quotes = F.length(line) - F.length(F.translate(line, '"', ""))
    still_open = F.col(f"_row.{CORRUPT}").isNull() & (quotes % 2 == 1) & ~line.rlike(CLOSED_LINE)
    corrupt = F.when(still_open, line).otherwise(F.col(f"_row.{CORRUPT}"))
    kept = [F.col(f"`{c}`") for c in lines.columns if c != value]
    return lines.withColumn("_row", row).select(*[F.col("_row").getField(c).alias(c) for c in header], corrupt.alias(CORRUPT), *kept)


def scan_layouts(spark: SparkSession, files: list[str]) -> dict[tuple[str, ...], DataFrame]:
    """One scan for each header among ``files``, with ``CORRUPT`` and ``FILE`` beside its text columns.

    An export has one row a line, so files are split between tasks; a quoted line break is an open
    quote here (``parse_lines``).  Blank lines are no
    rows, and a line equal to the header is a header wherever it stands (exports put one after another).
    """
    groups: dict[tuple[str, ...], tuple[list[str], set[str]]] = {}
    for path in files:
        line = header_line(spark, path)
        if header := tuple(next(csv.reader([line]), ())):
            paths, lines = groups.setdefault(header, ([], set()))
            paths.append(path)
            lines.add(line)
    if not groups:
        raise ValueError(f"no header in {files}")
    scans = {}
    for header, (paths, lines) in sorted(groups.items()):
        if taken := {CORRUPT, FILE} & set(header):
            raise ValueError(f"{sorted(taken)} is a reserved column name; found in {paths[0]}")
        text = spark.read.text(paths).where((F.trim("value") != "") & ~F.col("value").isin(*sorted(lines)))
        scans[header] = parse_lines(text.select("value", F.col("_metadata.file_path").alias(FILE)), header)
    return scans


def _united(scans: list[DataFrame]) -> DataFrame:
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), scans)


def read_exports(spark: SparkSession, files: list[str]) -> DataFrame:
    """One DataFrame of the readable rows of all ``files``, columns matched by header name; every column is text.

    Files with the same header are one scan; scans are united by name, a column that a file lacks
    is NULL there.  Lines that can't be read are left out here; ``quarantined`` has them.  Typing
    happens in the normalisers with lenient casts.
    """
    return _united([scan.where(F.col(CORRUPT).isNull()).drop(CORRUPT, FILE) for scan in scan_layouts(spark, files).values()])


def quarantined(spark: SparkSession, files: list[str]) -> DataFrame:
    """(file, n_fields, line): every line that ``read_exports`` leaves out, as it stands; n_fields is its header's."""
    return _united([
        scan.where(F.col(CORRUPT).isNotNull()).select(F.col(FILE).alias("file"), F.lit(len(header)).alias("n_fields"), F.col(CORRUPT).alias("line"))
        for header, scan in scan_layouts(spark, files).items()])


def quarantine_counts(spark: SparkSession, files: list[str]) -> DataFrame:
    """(file, rows, bad_rows) of every file with a data line, from one pass."""
    marks = [scan.select(F.col(FILE).alias("file"), F.col(CORRUPT).alias("line")) for scan in scan_layouts(spark, files).values()]
    return _united(marks).groupBy("file").agg(F.count("*").alias("rows"), F.count("line").alias("bad_rows"))


def load_exports(spark: SparkSession, data_dir: str | None = None,
                 paths: dict[str, list[str] | str] | None = None) -> dict[str, DataFrame]:
    """``{google, bing, meta}`` DataFrames: all files of a folder, or the files given for each platform."""
    if paths is None:
        if data_dir is None:
            raise ValueError("data_dir or paths is needed")
        paths = export_files(spark, data_dir)
    return {platform: read_exports(spark, [p] if isinstance(p, str) else list(p)) for platform, p in paths.items()}


def dataset_summary(frames: dict[str, DataFrame]) -> DataFrame:
    """Per platform: row count, column count and the comma-joined column names."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(platform).alias("platform"),
            F.col("rows").cast("bigint").alias("rows"),
            F.lit(len(df.columns)).cast("int").alias("columns"),
            F.lit(", ".join(map(str, df.columns))).alias("column_names"),
        )
        for platform, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                mode: str = "overwrite", sort_by: list | None = None) -> None:
    """Table sink.  ``sort_by`` orders rows inside each output file only."""
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)
