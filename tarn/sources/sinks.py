"""Writing Bronze, Silver and Gold tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.session import stage
from tarn.sources.schemas import PARTITION_COLUMN, TableSchema, apply_schema

REJECTED_TABLE = "rejected_records"
REJECTED_DAY = "ingested_day"  # its partitions


def with_lineage(df: DataFrame, source: str, batch_ts: dt.datetime) -> DataFrame:
    """Add the two lineage columns: one time for the whole batch, and the source name."""
    return df.withColumn("_ingestion_timestamp", F.lit(batch_ts).cast("timestamp")).withColumn(
        "_source", F.lit(source)
    )


def _rebalanced(df: DataFrame, partition: str | None) -> DataFrame:
    """Even output files: small partitions are merged, a day holding most rows is split."""
    return df.hint("rebalance", f"`{partition}`") if partition else df.hint("rebalance")


def append_table(df: DataFrame, namespace: str, table: str, schema: TableSchema) -> None:
    """Append to a table, creating database and table on first use; never rewrites.

    Columns the schema does not declare are an error, absent ones become null. A value
    that is not of its declared type is an error, and the table stays as it was.
    """
    spark = df.sparkSession
    unknown = set(df.columns) - set(schema.names) - {PARTITION_COLUMN}
    if unknown:
        raise ValueError(f"columns {sorted(unknown)} are not declared for {namespace}.{table}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {namespace}")
    partition = PARTITION_COLUMN if schema.partition_field else None
    writer = _rebalanced(apply_schema(df, schema, strict=True), partition).write.mode("append").format("parquet")
    if partition:
        writer = writer.partitionBy(partition)
    writer.saveAsTable(f"{namespace}.{table}")


def overwrite_table(
    df: DataFrame, namespace: str, table: str, partition_by: Sequence[str] = ()
) -> None:
    """Replace a Silver or Gold table; running twice gives the same table.

    The new content goes to a folder of its own and the table is then pointed
    at it, so the input may be read from the table it replaces, nothing is
    written twice, and a run that fails before that leaves the old content in place. A
    partitioned table has its partitions pointed at the new content one by one, each at
    once, and loses those that are not there any more: it is never absent, but a reader
    may meet new partitions beside old ones. Only a table with other columns than before
    is made anew. Old folders stay until ``drop_old_versions``.
    """
    spark, name = df.sparkSession, f"{namespace}.{table}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {namespace}")
    path = _version_path(spark, namespace, table)
    writer = _rebalanced(df, partition_by[0] if partition_by else None).write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    if spark.catalog.tableExists(name):
        if _same_layout(spark, name, df, partition_by):
            if partition_by:
                _point_partitions(spark, name, _written_partitions(spark, df, path, partition_by), drop_others=True)
            spark.sql(f"ALTER TABLE {name} SET LOCATION {_literal(path)}")
            return
        spark.sql(f"DROP TABLE {name}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    layout = "PARTITIONED BY (" + ", ".join(f"`{c}`" for c in partition_by) + ")" if partition_by else ""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {layout} LOCATION '{path}'")
    if partition_by:
        spark.catalog.recoverPartitions(name)


def replace_partitions(df: DataFrame, namespace: str, table: str, partition_by: str, values: Sequence) -> None:
    """Replace the partitions of ``values`` (days, numbers or texts) with the rows of ``df``, which has no others.

    The rows are written beside the table; each partition is then pointed at its new
    folder, which is one step. Of the values without rows the partition goes. Other
    partitions are neither read nor written.
    """
    spark, name = df.sparkSession, f"{namespace}.{table}"
    if not spark.catalog.tableExists(name):
        overwrite_table(df, namespace, table, [partition_by])
        return
    if not _same_layout(spark, name, df, [partition_by]):
        raise ValueError(f"{name} has other columns or partitions")
    path = _version_path(spark, namespace, table)
    _rebalanced(df, partition_by).write.partitionBy(partition_by).parquet(path)
    written = _written_partitions(spark, df, path, [partition_by])
    gone = [[v] for v in values if (str(v),) not in {tuple(map(str, p)) for p, _ in written}]
    _point_partitions(spark, name, written, gone)


def drop_old_versions(spark: SparkSession, namespace: str, table: str) -> list[str]:
    """Delete the folders of earlier versions that neither the table nor a partition points at; their paths.

    To be run when nobody reads or writes the table: a reader may still use an old version, and a
    version that is being written is not pointed at yet.
    """
    name = f"{namespace}.{table}"
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    used = {described["Location"]}
    columns = spark.catalog.listColumns(name)
    if any(c.isPartition for c in columns):
        for row in spark.sql(f"SHOW PARTITIONS {name}").collect():
            used.add(_location(spark, name, row["partition"]))
    base = spark._jvm.org.apache.hadoop.fs.Path(_versions(spark, namespace, table))
    files = base.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    for status in files.listStatus(base) if files.exists(base) else []:
        folder = status.getPath()
        if not any(_below(u, folder.getName()) for u in used):
            files.delete(folder, True)
            gone.append(folder.toString())
    return gone


def _below(location: str, version: str) -> bool:
    return version in location.rstrip("/").split("/")


def _versions(spark: SparkSession, namespace: str, table: str) -> str:
    return f"{spark.catalog.getDatabase(namespace).locationUri.rstrip('/')}/{table}_versions"


def _version_path(spark: SparkSession, namespace: str, table: str) -> str:
    return f"{_versions(spark, namespace, table)}/{uuid.uuid4().hex}"


def _same_layout(spark: SparkSession, name: str, df: DataFrame, partition_by: Sequence[str]) -> bool:
    """Whether the table has the columns of ``df`` and is partitioned by ``partition_by``."""
    held = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    # partition columns stand last in a table
    ordered = [*[c for c in df.columns if c not in partition_by], *partition_by]
    return held == list(partition_by) and spark.table(name).dtypes == df.select(*[F.col(f"`{c}`") for c in ordered]).dtypes


def _literal(value) -> str:
    return "NULL" if value is None else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _written_partitions(spark: SparkSession, df: DataFrame, path: str, partition_by: Sequence[str]) -> list[tuple[list, str]]:
    """Values and folders of the partitions below ``path``; one row per partition comes to the driver, from file footers."""
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    read = spark.read.schema(df.schema).option("basePath", path).parquet(path)
    values = [F.col(f"`{c}`").cast("string").alias(f"v{k}") for k, c in enumerate(partition_by)]
    found = read.select(*values, folder.alias("folder")).distinct().collect()
    return [([r[f"v{k}"] for k in range(len(partition_by))], unquote(r["folder"])) for r in found]


def _spec(spark: SparkSession, name: str, values: Sequence) -> str:
    names = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    return ", ".join(f"`{n}` = {_literal(v)}" for n, v in zip(names, values))


def _location(spark: SparkSession, name: str, shown: str) -> str:
    spec = ", ".join(f"`{k}` = {_literal(unquote(v))}" for k, _, v in (part.partition("=") for part in shown.split("/")))
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name} PARTITION ({spec})").collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Location")


def _point_partitions(
    spark: SparkSession, name: str, written: list[tuple[list, str]], gone: Sequence[Sequence] = (), drop_others: bool = False
) -> None:
    shown = {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    names = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    held = {tuple(unquote(part.partition("=")[2]) for part in s.split("/")) for s in shown}
    for values, folder in written:
        spec = _spec(spark, name, values)
        if tuple(_shown(v) for v in values) in held:
            spark.sql(f"ALTER TABLE {name} PARTITION ({spec}) SET LOCATION {_literal(folder)}")
        else:
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION {_literal(folder)}")
    kept = {tuple(_shown(v) for v in values) for values, _ in written}
    others = [h for h in held if h not in kept] if drop_others else [g for g in (tuple(_shown(v) for v in g) for g in gone) if g in held]
    for values in others:
        spec = ", ".join(f"`{n}` = {_literal(None if v == _NO_VALUE else v)}" for n, v in zip(names, values))
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec})")


# fixed value: how Spark names the partition of null
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _shown(value) -> str:
    return _NO_VALUE if value is None else str(value)


def rejected_rows(
    df: DataFrame, source: str, batch_ts: dt.datetime, reason: str = "rejection_reason"
) -> DataFrame:
    """Quarantine form of rejected records: source, reason, JSON of the other fields, time."""
    rest = [c for c in df.columns if c != reason]
    return df.select(
        F.lit(source).alias("source"),
        F.col(reason).alias("rejection_reason"),
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in rest]), {"ignoreNullFields": "false"}).alias(
            "payload"
        ),
        F.lit(batch_ts).cast("timestamp").alias("_ingested_at"),
    )


def write_rejected(
    df: DataFrame,
    namespace: str,
    source: str,
    batch_ts: dt.datetime,
    reason: str = "rejection_reason",
) -> int:
    """Append rejected records to the quarantine table, by day, and return their number.

    Every record needs a reason that is not blank. No records: no table.
    """
    blank = F.col(reason).isNull() | (F.trim(F.col(reason).cast("string")) == "")
    found = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(blank).alias("blank")).first()
    if found["blank"]:
        raise ValueError("each rejected record needs a rejection reason that is not blank")
    if found["n"]:
        spark = df.sparkSession
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {namespace}")
        dated = rejected_rows(df, source, batch_ts, reason).withColumn(REJECTED_DAY, F.to_date("_ingested_at"))
        dated.write.mode("append").format("parquet").partitionBy(REJECTED_DAY).saveAsTable(f"{namespace}.{REJECTED_TABLE}")
    return found["n"]


def _matched(target: DataFrame, source: DataFrame, key: Sequence[str], how: str) -> DataFrame:
    """Rows of ``target`` with (or, as an anti join, without) a key of ``source``; null equals null."""
    keys = source.select(*[F.col(f"`{k}`").alias(f"_key{i}") for i, k in enumerate(key)])
    equal = [F.col(f"_target.`{k}`").eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(key)]
    return target.alias("_target").join(keys, equal, how)


def upserted(target: DataFrame, source: DataFrame, key: Sequence[str]) -> DataFrame:
    """``target`` with the rows of ``source`` put in place of, or added to, those of equal key; null equals null."""
    kept = _matched(target, source, key, "left_anti")
    return kept.select(target.columns).unionByName(source.select(target.columns))


def upsert_table(
    source: DataFrame,
    namespace: str,
    table: str,
    key: Sequence[str],
    partition_by: str | None = None,
) -> None:
    """Keyed merge into a table: matched rows are replaced, the rest inserted.

    A key occurring twice in ``source`` is an error. Of a partitioned table only
    the partitions are rewritten that the source has or that hold one of its keys,
    which are found from the key columns alone. If a partition would be left without
    rows, the whole table is written anew.
    """
    spark, name, key = source.sparkSession, f"{namespace}.{table}", list(key)
    if not spark.catalog.tableExists(name):
        overwrite_table(_single(source, key), namespace, table, [partition_by] if partition_by else ())
        return
    source = _single(source, key)
    target = spark.table(name)
    if not partition_by:
        overwrite_table(upserted(target, source, key), namespace, table)
        return
    touched = source.select(partition_by)
    if partition_by not in key:
        touched = touched.union(_matched(target, source, key, "left_semi").select(partition_by))
    touched = stage(touched.distinct(), "touched")
    # a plain equality, so that Spark prunes the other partitions
    held = target.join(touched, partition_by, "left_semi").select(target.columns)
    if not touched.filter(F.col(partition_by).isNull()).isEmpty():
        held = held.unionByName(target.filter(F.col(partition_by).isNull()))
    merged = stage(upserted(held, source, key), "upsert").select(target.columns)
    if not _matched(touched, merged.select(partition_by).distinct(), [partition_by], "left_anti").isEmpty():
        overwrite_table(upserted(target, source, key), namespace, table, [partition_by])
        return
    replacement = _rebalanced(merged, partition_by)
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        replacement.write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(mode, before)


def _single(source: DataFrame, key: Sequence[str]) -> DataFrame:
    source = stage(source, "merge")
    if not source.groupBy(*key).count().filter("count > 1").isEmpty():
        raise ValueError(f"merge source holds several rows for one key {list(key)}")
    return source


def archive_runs(runs: DataFrame, namespace: str, table: str, started: str) -> None:
    """Append run history to a table of daily Parquet folders."""
    spark = runs.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {namespace}")
    dated = runs.withColumn("run_date", F.to_date(started))
    _rebalanced(dated, "run_date").write.mode("append").format("parquet").partitionBy(
        "run_date"
    ).saveAsTable(f"{namespace}.{table}")


def table_exists(spark: SparkSession, namespace: str, table: str) -> bool:
    return spark.catalog.tableExists(f"{namespace}.{table}")
