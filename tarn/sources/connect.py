"""Sources by type: a reader is a function of a session and an option dict."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.sources import database, envelopes, files, landed
from tarn.sources.schemas import describe_columns, infer_json_columns

Reader = Callable[[SparkSession, Mapping], DataFrame]
READERS: dict[str, Reader] = {}

FALLBACK = [{"name": "_raw", "type": "string", "nullable": True}]


def register_reader(kind: str, reader: Reader) -> None:
    READERS[kind] = reader


def read_source(spark: SparkSession, kind: str, options: Mapping) -> DataFrame:
    """All records of a source, lazily. An unknown type is an error."""
    if kind not in READERS:
        raise ValueError(f"unsupported source type {kind!r}, known: {sorted(READERS)}")
    return READERS[kind](spark, options)


def _filesystem(spark: SparkSession, o: Mapping) -> DataFrame:
    return files.read_directory(spark, o["path"], o.get("file_glob", "*.parquet"))


def _object_store(spark: SparkSession, o: Mapping) -> DataFrame:
    root = o.get("root") or f"s3a://{o['bucket']}"
    return files.read_prefix(spark, root, o.get("prefix", ""), o.get("file_glob", "*.parquet"))


def _responses(spark: SparkSession, o: Mapping) -> DataFrame:
    """Landed response bodies, one file each, as variant records."""
    return envelopes.unwrap_responses(envelopes.read_documents(spark, o["path"]), "body")


def _landed(spark: SparkSession, o: Mapping) -> DataFrame:
    """Landed bodies, many to a file, as variant records; the source plans its own partitions."""
    options = {k: v for k, v in o.items() if k != "path"}
    return envelopes.unwrap_responses(landed.read_landed(spark, o["path"], ["body"], **options), "body")


register_reader("filesystem", _filesystem)
register_reader("s3", _object_store)
register_reader("rest", _responses)
register_reader("landed", _landed)
register_reader("postgres", database.read_database)


def discover(spark: SparkSession, kind: str, options: Mapping) -> list[dict]:
    """Columns of a source, from its reader's own inference; ``_raw`` if it cannot be probed."""
    try:
        df = read_source(spark, kind, options)
        if "record" in df.columns and df.schema["record"].dataType == T.VariantType():
            found = infer_json_columns(df.select(F.to_json("record").alias("body")), "body")
            # as many rows as the records have field names
            columns = [
                {"name": r["column_name"], "type": r["table_type"], "nullable": True}
                for r in found.orderBy("column_name").collect()
            ]
        else:
            columns = [{**c, "nullable": True} for c in describe_columns(df)]
    except PySparkException:
        return FALLBACK
    return columns or FALLBACK
