"""Landed API responses and market documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.functions.fixed_values import ENVELOPE_KEYS


def unwrap_responses(df: DataFrame, body: str, out: str = "record") -> DataFrame:
    """One row per record of each JSON response body.

    A list gives its elements. An object gives the first of its record lists
    that is a list, or else itself. Any other body gives nothing. ``out`` is a
    variant column; the other columns of ``df`` are kept.
    """
    doc = F.try_parse_json(F.col(body))
    lists = [F.try_variant_get(doc, "$", "array<variant>")]
    lists += [F.try_variant_get(doc, f"$.{key}", "array<variant>") for key in ENVELOPE_KEYS]
    whole = F.when(F.schema_of_variant(doc).startswith("OBJECT"), F.array(doc))
    keep = [c for c in df.columns if c != body]
    return df.select(*keep, F.explode(F.coalesce(*lists, whole)).alias(out))


def record_fields(df: DataFrame, schema: T.StructType, record: str = "record") -> DataFrame:
    """Read declared fields out of the variant records; absent ones are null."""
    fields = [
        F.try_variant_get(F.col(record), f"$.{f.name}", f.dataType.simpleString()).alias(f.name)
        for f in schema.fields
    ]
    return df.select(*[c for c in df.columns if c != record], *fields)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


_POINT = _struct(position=T.IntegerType(), quantity=T.DoubleType())
_PERIOD = _struct(
    timeInterval=_struct(start=T.StringType()),
    resolution=T.StringType(),
    Point=T.ArrayType(_POINT),
)
_SERIES = (
    _struct(MktPSRType=_struct(psrType=T.StringType()))
    .add("inBiddingZone_Domain.mRID", T.StringType())
    .add("outBiddingZone_Domain.mRID", T.StringType())
    .add("Period", T.ArrayType(_PERIOD))
)
MARKET_DOCUMENT = _struct(TimeSeries=T.ArrayType(_SERIES))


def document_points(df: DataFrame, body: str) -> DataFrame:
    """One row per point of the time series in generation and load XML documents.

    A point's time is the start of its period plus (position - 1) resolutions;
    the resolution is PT15M or PT60M, any other text of the form PTnM works.
    """
    parsed = F.from_xml(F.col(body), MARKET_DOCUMENT, {"ignoreNamespace": "true"})
    series = df.select(F.explode(parsed["TimeSeries"]).alias("s"))
    points = series.select(
        F.col("s.`inBiddingZone_Domain.mRID`").alias("in_zone"),
        F.col("s.`outBiddingZone_Domain.mRID`").alias("out_zone"),
        F.col("s.MktPSRType.psrType").alias("psr_type"),
        F.explode("s.Period").alias("p"),
    ).select(
        "in_zone",
        "out_zone",
        "psr_type",
        F.try_to_timestamp(
            "p.timeInterval.start", F.lit("yyyy-MM-dd'T'HH:mm[:ss]XXX")
        ).alias("start"),
        F.col("p.resolution").alias("resolution"),
        F.explode("p.Point").alias("point"),
    )
    minutes = F.regexp_extract("resolution", r"^PT(\d+)M$", 1).try_cast("int")
    after = F.make_dt_interval(mins=(F.col("point.position") - F.lit(1)) * minutes)
    return points.select(
        (F.col("start") + after).alias("timestamp_utc"),
        "in_zone",
        "out_zone",
        "psr_type",
        F.col("point.quantity").alias("quantity_mw"),
        "resolution",
    )


def unreadable_documents(df: DataFrame, body: str) -> DataFrame:
    """Bodies that are no market document, such as error pages: they give no point."""
    parsed = F.from_xml(F.col(body), MARKET_DOCUMENT, {"ignoreNamespace": "true"})
    return df.filter(parsed["TimeSeries"].isNull())


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Landed response files, one document each, as a ``body`` column."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "body")
