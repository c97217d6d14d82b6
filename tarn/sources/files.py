"""Files on disk or in an object store."""

from __future__ import annotations

import re
from urllib.parse import unquote

import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FORMATS = {"parquet": "parquet", "csv": "csv"}


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Paths below ``path`` whose name matches ``glob``; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(path)
        .select("path", F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1)).alias("suffix"))
    )


# Spark's names for "no such folder" and "no file to take the columns from"
NOTHING_THERE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _if_any(read, *args):
    """The result of a read, or None where there is no file to read."""
    try:
        return read(*args)
    except AnalysisException as error:
        if error.getCondition() in NOTHING_THERE:
            return None
        raise


def _listed(spark: SparkSession, path: str, glob: str = "*") -> dict[str, list[str]]:
    """Paths by lower-case suffix. Names only come to the driver, which lists them for any read."""
    listing = _if_any(list_files, spark, path, glob)
    found: dict[str, list[str]] = {}
    for r in [] if listing is None else listing.collect():
        found.setdefault(r["suffix"], []).append(r["path"])
    return found


def _literal(path: str) -> str:
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _read(spark: SparkSession, fmt: str, paths, glob: str | None, merge_schema: bool) -> DataFrame:
    reader = spark.read.format(fmt).option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if fmt == "csv":
        reader = reader.option("header", "true").option("inferSchema", "true").option("enforceSchema", "false")
    else:
        reader = reader.option("mergeSchema", str(merge_schema).lower())
    return reader.load(paths)


def _by_header(spark: SparkSession, paths: list[str]) -> list[list[str]]:
    """CSV files grouped by their first line with text; files without one have no rows and are left out."""

    def first_lines(batches):
        seen = set()
        for batch in batches:
            names = batch.column("path")
            for name in pc.unique(names).to_pylist():
                if name not in seen:
                    seen.add(name)
                    yield batch.slice(pc.index(names, name).as_py(), 1)

    # a file's first split lies in one task, in the order of its lines
    lines = (
        spark.read.option("recursiveFileLookup", "true")
        .text([_literal(p) for p in paths])
        .filter((F.col("_metadata.file_block_start") == 0) & (F.trim("value") != ""))
        .select(F.col("_metadata.file_path").alias("path"), "value")
    )
    groups: dict[str, list[str]] = {}
    for r in lines.mapInArrow(first_lines, "path string, value string").collect():
        groups.setdefault(r["value"], []).append(unquote(r["path"]))
    return [sorted(groups[header]) for header in sorted(groups)]


def _read_listed(spark: SparkSession, paths: dict[str, list[str]], merge_schema: bool) -> list[DataFrame]:
    """``paths`` by format; one read per format, and for CSV one per header."""
    frames = []
    for fmt in FORMATS.values():
        held = paths.get(fmt, [])
        groups = _by_header(spark, held) if held and fmt == "csv" else [held]
        frames += [_read(spark, fmt, [_literal(p) for p in same], None, merge_schema) for same in groups if same]
    return frames


def _union(frames: list[DataFrame], spark: SparkSession) -> DataFrame:
    """Rows of all frames by column name; a column that is text in one of them is text in all."""
    if not frames:
        return spark.createDataFrame([], T.StructType())
    texts = {f.name for frame in frames for f in frame.schema if isinstance(f.dataType, T.StringType)}
    out = None
    for frame in frames:
        frame = frame.select(*[F.col(f"`{c}`").cast("string").alias(c) if c in texts else F.col(f"`{c}`") for c in frame.columns])
        out = frame if out is None else out.unionByName(frame, allowMissingColumns=True)
    return out


def read_directory(
    spark: SparkSession,
    path: str,
    glob: str = "*.parquet",
    merge_schema: bool = True,
    with_path: bool = False,
) -> DataFrame:
    """Every Parquet and CSV file below ``path`` that matches ``glob``, as one table.

    Other suffixes are skipped. Columns are the union over all files, matched by name,
    also between CSV files with different headers; a header is one line. A folder that
    does not exist, or holds no such file, gives no rows and no columns.
    """
    if glob.endswith(".parquet"):
        frame = _if_any(_read, spark, "parquet", path, glob, merge_schema)
        frames = [] if frame is None else [frame]
    else:
        listed = _listed(spark, path, glob)
        frames = _read_listed(spark, {fmt: listed.get(suffix, []) for suffix, fmt in FORMATS.items()}, merge_schema)
    if with_path:
        frames = [f.withColumn("_file", F.col("_metadata.file_path")) for f in frames]
    return _union(frames, spark)


def prefix_format(key_suffix: str, glob: str) -> str:
    """Format of an object: from its key, else from the glob, else Parquet."""
    return FORMATS.get(key_suffix) or FORMATS.get(glob.rpartition(".")[2].lower(), "parquet")


def read_prefix(
    spark: SparkSession, root: str, prefix: str, glob: str = "*.parquet", merge_schema: bool = True
) -> DataFrame:
    """Every object under ``root`` whose key starts with ``prefix`` (``s3a://bucket`` or a folder), each read once."""
    paths: dict[str, list[str]] = {}
    for suffix, held in _listed(spark, f"{root.rstrip('/')}/{prefix.lstrip('/')}*").items():
        paths.setdefault(prefix_format(suffix, glob), []).extend(held)
    return _union(_read_listed(spark, paths, merge_schema), spark)


def read_raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """Fallback for files nothing else can read: one nullable ``_raw`` column."""
    return spark.read.text(path).withColumnRenamed("value", "_raw")


def read_nanosecond_parquet(
    spark: SparkSession, path: str, schema: T.StructType, nanos: dict[str, str]
) -> DataFrame:
    """Parquet with nanosecond timestamps, brought to microseconds.

    ``nanos`` maps each such column to ``timestamptz`` or ``timestamp``. They are
    stored as 64-bit counts and read as such, then cut (toward the past) to
    Spark's precision. ``schema`` lists every column of the file, with long
    for the nanosecond ones.
    """
    df = spark.read.schema(schema).parquet(path)
    for name, kind in nanos.items():
        micros = F.floor(F.col(name) / F.lit(1000).cast("decimal(10,0)")).cast("long")
        instant = F.timestamp_micros(micros)
        if kind == "timestamp":
            zone = F.current_timezone()
            instant = F.convert_timezone(zone, F.lit("UTC"), instant.cast("timestamp_ntz"))
        df = df.withColumn(name, instant)
    return df
