"""Incremental Bronze ingest of newly arrived files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.operators.validate import REASON, Rule, ingest, tag
from tarn.sources.schemas import TableSchema
from tarn.sources.sinks import rejected_rows


def read_arrivals(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
    glob: str | None = None, files_per_batch: int | None = None,
) -> DataFrame:
    """Stream of the files that appear below ``path``."""
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def ingest_arrivals(
    stream: DataFrame,
    source: str,
    rules: Sequence[Rule],
    valid_path: str,
    rejected_path: str,
    checkpoint: str,
) -> dict[str, int]:
    """Split all files not seen before into valid and rejected rows, then stop.

    A batch may run twice after a failure. Its rows go to folders named after
    the batch, which are overwritten, so a repeat replaces and never adds. All
    rows of a batch get one ingestion time.
    """

    counted: dict[int, int] = {}

    def write(batch: DataFrame, batch_id: int) -> None:
        tagged = tag(batch, rules).persist()
        try:
            # the query keeps the progress of its last batches only
            counted[batch_id] = tagged.count()
            stamped = F.lit(dt.datetime.now(dt.UTC))
            good = tagged.filter(F.col(REASON).isNull()).drop(REASON)
            good = good.withColumn("_ingestion_timestamp", stamped).withColumn("_source", F.lit(source))
            good.write.mode("overwrite").parquet(f"{valid_path}/batch_id={batch_id}")
            bad = rejected_rows(tagged.filter(F.col(REASON).isNotNull()), source, None)
            bad.withColumn("_ingested_at", stamped).write.mode("overwrite").parquet(
                f"{rejected_path}/batch_id={batch_id}"
            )
        finally:
            tagged.unpersist()

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return {"rows": sum(counted.values()), "batches": len(counted)}


def ingest_arrivals_to_bronze(
    stream: DataFrame,
    source: str,
    schema: TableSchema,
    checkpoint: str,
    rules: Sequence[Rule] = (),
    namespace: str = "bronze",
) -> dict[str, int]:
    """Ingest all files not seen before into the Bronze table of a source, then stop.

    Gives the table a batch ingest gives: typed columns, lineage, days, quarantine.
    The time of a batch is written beside the checkpoint before its rows, so a
    batch that runs again has the same time and is stored once.
    """
    totals: dict[int, dict[str, int]] = {}

    def write(batch: DataFrame, batch_id: int) -> None:
        stamp = _time_of_batch(batch.sparkSession, f"{checkpoint}/times/batch_id={batch_id}")
        totals[batch_id] = ingest(batch, source, schema, stamp, rules, namespace, read_once=False)

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{checkpoint}/offsets")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return {name: sum(t[name] for t in totals.values()) for name in ("valid", "rejected")}


def _time_of_batch(spark: SparkSession, path: str) -> dt.datetime:
    """The time written for a batch when it first ran; written now if there is none."""
    now = spark.createDataFrame([(dt.datetime.now(dt.UTC),)], "t timestamp")
    now.write.mode("ignore").parquet(path)
    kept = spark.read.schema(now.schema).parquet(path).first()
    if kept is None:
        # the run before failed within this small write
        now.write.mode("overwrite").parquet(path)
        kept = spark.read.schema(now.schema).parquet(path).first()
    return kept["t"].astimezone(dt.UTC)


def run_to_files(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Write a stream to Parquet files until all present input is used up."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def guard_redelivery(stream: DataFrame, key: Sequence[str], ts: str, within: str) -> DataFrame:
    """Drop rows whose key was delivered before, within the bound of the watermark."""
    return stream.withWatermark(ts, within).dropDuplicatesWithinWatermark(list(key))
