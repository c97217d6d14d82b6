"""Projection to declared columns, field rules, and the valid / rejected split."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from tarn.functions.skew import salted_join
from tarn.sources.schemas import LINEAGE, PARTITION_COLUMN, TABLE_TYPES, TableSchema, apply_schema, describe_columns
from tarn.sources.sinks import REJECTED_DAY, REJECTED_TABLE, append_table, with_lineage, write_rejected

REASON = "rejection_reason"


@dataclass(frozen=True)
class Rule:
    """A reason, and the condition under which a record is rejected for it."""

    reason: str
    broken: Column


def _named(column: str) -> Column:
    """The column of this name, dots included."""
    return F.col(f"`{column}`")


def required(column: str) -> Rule:
    return Rule(f"missing:{column}", _named(column).isNull())


def castable(column: str, data_type: str) -> Rule:
    value = _named(column)
    return Rule(f"type:{column}", value.isNotNull() & value.try_cast(data_type).isNull())


def non_negative(column: str) -> Rule:
    return Rule(f"negative:{column}", _named(column).try_cast("double") < 0)


def at_most(column: str, bound: float) -> Rule:
    return Rule(f"above:{column}", _named(column).try_cast("double") > bound)


def one_of(column: str, values: Sequence[str]) -> Rule:
    return Rule(f"value:{column}", ~_named(column).isin(*values))


def project(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Declared columns only: extras and incoming lineage columns go, absent ones are null."""
    return df.select(
        *[
            F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in declared.fields
            if f.name not in LINEAGE
        ]
    )


def tag(df: DataFrame, rules: Sequence[Rule], out: str = REASON) -> DataFrame:
    """Add the reason of the first broken rule, or null. One pass, no shuffle."""
    reasons = [F.when(F.coalesce(r.broken, F.lit(False)), F.lit(r.reason)) for r in rules]
    return df.withColumn(out, F.coalesce(*reasons, F.lit(None).cast("string")))


def split(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Valid records, and rejected ones with their reason."""
    tagged = tag(df, rules)
    return (
        tagged.filter(F.col(REASON).isNull()).drop(REASON),
        tagged.filter(F.col(REASON).isNotNull()),
    )


def rejected_payload(df: DataFrame) -> DataFrame:
    """Rejects as reason and the text of the whole record, which can be read again."""
    rest = [c for c in df.columns if c != REASON]
    text = F.to_json(F.struct(*[_named(c) for c in rest]), {"ignoreNullFields": "false"})
    return df.select(REASON, text.alias("payload"))


def summary(tagged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Numbers of valid and rejected records."""
    return tagged.groupBy(*by).agg(
        F.count_if(F.col(REASON).isNull()).alias("valid"),
        F.count_if(F.col(REASON).isNotNull()).alias("rejected"),
    )


def ingest(
    raw: DataFrame,
    source: str,
    schema: TableSchema | None,
    batch_ts: dt.datetime,
    rules: Sequence[Rule] = (),
    namespace: str = "bronze",
    read_once: bool = True,
) -> dict[str, int]:
    """Project, validate, append the valid records and quarantine the rest.

    The tagged input is kept on executor disks across the two writes, so the
    source is read once. For files and tables, which give the same rows again,
    ``read_once=False`` reads twice instead of copying a large batch. Casts
    that fail reject the record with its original values.

    A source and ``batch_ts`` name a batch. Of a batch that was stored in part,
    because the run before failed, only the missing part is written, so a repeat
    neither loses nor doubles rows. (A driver lost while it moves one write's files
    into place can leave part of them; that is not noticed.) Without a ``schema`` the
    columns are those the records have, nested ones as JSON text; columns new to the
    table are added to it.
    """
    spark, table = raw.sparkSession, f"{namespace}.{source}"
    if schema is None:
        raw, schema = _undeclared(raw, source, table)
    columns = [f for f in schema.columns.fields if f.name not in LINEAGE]
    declared = T.StructType(columns)
    types = [castable(f.name, f.dataType.simpleString()) for f in columns if f.name in raw.columns]
    tagged = tag(raw, [*types, *rules])
    if read_once:
        tagged = tagged.persist(StorageLevel.DISK_ONLY)
    try:
        seen = Observation()
        good = tagged.filter(F.col(REASON).isNull()).drop(REASON)
        valid = apply_schema(project(good, declared), TableSchema(source, declared))
        counted = with_lineage(valid, source, batch_ts).observe(
            seen, F.count(F.lit(1)).alias("valid")
        )
        stored = _stored(spark, table, batch_ts, "_source", source, "_ingestion_timestamp", PARTITION_COLUMN)
        if not stored:
            append_table(counted, namespace, source, schema.bronze())
            stored = seen.get["valid"]
        held = _stored(spark, f"{namespace}.{REJECTED_TABLE}", batch_ts, "source", source, "_ingested_at", REJECTED_DAY)
        if not held:
            held = write_rejected(tagged.filter(F.col(REASON).isNotNull()), namespace, source, batch_ts)
        return {"valid": stored, "rejected": held}
    finally:
        tagged.unpersist()


def _stored(
    spark: SparkSession, table: str, batch_ts: dt.datetime, named: str, source: str, ts: str, day: str | None = None
) -> int:
    """Rows of this batch that the table holds. Its day, where there is one, prunes the rest."""
    if not spark.catalog.tableExists(table):
        return 0
    stamp = F.lit(batch_ts).cast("timestamp")
    rows = spark.table(table)
    if day in rows.columns:
        rows = rows.filter(F.col(day) == F.to_date(stamp))
    return rows.filter((F.col(ts) == stamp) & (F.col(named) == source)).count()


def _undeclared(raw: DataFrame, source: str, table: str) -> tuple[DataFrame, TableSchema]:
    """The records in table types, and a schema of their columns and those the table has."""
    spark, added = raw.sparkSession, {PARTITION_COLUMN, *LINEAGE}
    simple = {c["name"]: TABLE_TYPES[c["type"]] for c in describe_columns(raw) if c["name"] not in added}
    as_text = (T.StructType, T.ArrayType, T.MapType, T.VariantType)
    flat = raw.select(
        *[
            (F.to_json(_named(f.name)) if isinstance(f.dataType, as_text) else _named(f.name)).alias(f.name)
            for f in raw.schema.fields
        ]
    )
    if spark.catalog.tableExists(table):
        known = {f.name: f.dataType for f in spark.table(table).schema.fields if f.name not in added}
        new = [f"`{n}` {t.simpleString()}" for n, t in simple.items() if n not in known]
        if new:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(new)})")
        simple = {**simple, **known}
    return flat, TableSchema(source, T.StructType([T.StructField(n, t) for n, t in simple.items()]))


def skip_ingested(raw: DataFrame, table: DataFrame, key: Sequence[str]) -> DataFrame:
    """Drop records whose release key the table already holds."""
    known = table.select(*key).distinct()
    return salted_join(raw, known, key, "left_anti")


def fingerprint(columns: Sequence[str]) -> Column:
    """SHA-256 of the record's JSON text, columns in name order."""
    text = F.to_json(F.struct(*[_named(c) for c in sorted(columns)]), {"ignoreNullFields": "false"})
    return F.sha2(text, 256)


def skip_redelivered(
    raw: DataFrame, table: DataFrame, columns: Sequence[str], out: str = "content_sha256"
) -> DataFrame:
    """Drop records whose content the table holds, and repeats within the delivery."""
    fresh = raw.withColumn(out, fingerprint(columns)).dropDuplicates([out])
    # a table that keeps the fingerprint is not hashed again
    known = table.select(out if out in table.columns else fingerprint(columns).alias(out)).distinct()
    return fresh.join(known, out, "left_anti")


def deduplicate(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each business key in ``order``, which must be total.

    Spark turns the rank filter into a limit per key that already runs before
    the shuffle, so a hot key sends one row per task.
    """
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def business_days(df: DataFrame, day: str) -> DataFrame:
    """Drop Saturdays and Sundays."""
    return df.filter(F.dayofweek(day).between(2, 6))


def only_series(df: DataFrame, column: str, names: Sequence[str]) -> DataFrame:
    return df.filter(F.col(column).isin(*names))


def on_demand(df: DataFrame, term: str, scenario: str | None = None, scenario_column: str = "scenario",
              term_column: str = "term") -> DataFrame:
    """Keep on-demand prices and, if given, one benchmark scenario."""
    df = df.filter(F.col(term_column) == term)
    return df.filter(F.col(scenario_column) == scenario) if scenario else df
