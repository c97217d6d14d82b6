"""Declared, inferred and checked table schemas."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LINEAGE = ("_ingestion_timestamp", "_source")
PARTITION_COLUMN = "ingestion_day"

# Declared type names and the Spark types they stand for.
TABLE_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamptz": T.TimestampType(),
    "timestamp": T.TimestampNTZType(),
    "decimal(38,18)": T.DecimalType(38, 18),
}

# Type names reported by sources, by table type.
SOURCE_TYPES = {
    "text": "string",
    "varchar": "string",
    "bigint": "long",
    "integer": "int",
    "smallint": "int",
    "boolean": "boolean",
    "double": "double",
    "float": "float",
    "timestamp": "timestamp",
    "date": "date",
    "decimal": "decimal(38,18)",
    "json": "string",
    "complex": "string",
}


def columns(**types: str) -> T.StructType:
    """Nullable columns from names and table types."""
    return T.StructType([T.StructField(n, TABLE_TYPES[t], True) for n, t in types.items()])


@dataclass(frozen=True)
class TableSchema:
    """Columns of a table and, for Bronze, the column its days are cut from."""

    source: str
    columns: T.StructType
    partition_field: str | None = None

    @property
    def names(self) -> list[str]:
        return self.columns.names

    def bronze(self) -> TableSchema:
        """The same table with lineage columns and day partitioning."""
        extra = {
            "_ingestion_timestamp": T.TimestampType(),
            "_source": T.StringType(),
        }
        fields = list(self.columns.fields)
        fields += [T.StructField(n, t) for n, t in extra.items() if n not in self.names]
        return TableSchema(self.source, T.StructType(fields), "_ingestion_timestamp")


def declared_schema(config: Mapping) -> TableSchema:
    """Build a schema from ``{source, columns: [{name, type}], partition?: {field, transform}}``."""
    source = config.get("source", "?")
    fields = []
    for column in config["columns"]:
        if column["type"] not in TABLE_TYPES:
            raise ValueError(
                f"unknown type {column['type']!r} of column {column['name']!r} in {source!r}"
            )
        fields.append(T.StructField(column["name"], TABLE_TYPES[column["type"]], True))
    partition = config.get("partition")
    if not partition:
        return TableSchema(source, T.StructType(fields))
    if partition["transform"] != "day":
        raise ValueError(f"unknown partition transform {partition['transform']!r} in {source!r}")
    if partition["field"] not in {f.name for f in fields}:
        raise ValueError(f"partition field {partition['field']!r} is not a column of {source!r}")
    return TableSchema(source, T.StructType(fields), partition["field"])


def resolve_schema(source: str, schemas: Mapping[str, Mapping]) -> TableSchema:
    """Schema declared for ``source``; an unknown source is an error, never a default."""
    if source not in schemas:
        raise KeyError(f"no schema declared or inferred for source {source!r}")
    return declared_schema({"source": source, **schemas[source]})


def day_column(schema: TableSchema) -> Column:
    return F.to_date(F.col(schema.partition_field)).alias(PARTITION_COLUMN)


def apply_schema(
    df: DataFrame, schema: TableSchema, failures: str | None = None, strict: bool = False
) -> DataFrame:
    """Cast to the declared columns, fill absent ones with null, add the day column.

    A value that cannot be cast becomes null, or an error if ``strict``; with ``failures`` the names of
    the columns that failed are kept in an array column of that name.
    """
    present = set(df.columns)
    casted, failed = [], []
    for f in schema.columns.fields:
        if f.name not in present:
            casted.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        value = F.col(f"`{f.name}`").try_cast(f.dataType)
        broken = value.isNull() & F.col(f"`{f.name}`").isNotNull()
        if strict:
            told = F.raise_error(F.lit(f"a value of {f.name} is no {f.dataType.simpleString()}"))
            casted.append(F.when(broken, told.cast(f.dataType)).otherwise(value).alias(f.name))
        else:
            casted.append(value.alias(f.name))
        failed.append(F.when(broken, F.lit(f.name)))
    if failures is not None:
        casted.append(F.array_compact(F.array(*failed)).alias(failures))
    out = df.select(*casted)
    if schema.partition_field:
        out = out.withColumn(PARTITION_COLUMN, day_column(schema))
    return out


def source_type(name: str) -> str:
    """Table type for a type name reported by a source; unknown names become string."""
    return SOURCE_TYPES.get(name.lower(), "string")


def table_type(data_type: T.DataType) -> str:
    """Table type for a Spark type; nested values are kept as JSON text."""
    names = {type(t): n for n, t in TABLE_TYPES.items()}
    names[T.ShortType] = names[T.ByteType] = "int"
    return names.get(type(data_type), "string")


def describe_columns(df: DataFrame) -> list[dict]:
    return [
        {"name": f.name, "type": table_type(f.dataType), "nullable": f.nullable}
        for f in df.schema.fields
    ]


def discovered_rows(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per column of each table: the inferred schema as data."""
    rows = [
        (table, i, c["name"], c["type"])
        for table, df in tables.items()
        for i, c in enumerate(describe_columns(df))
    ]
    return spark.createDataFrame(
        rows, "table_name string, ordinal int, column_name string, table_type string"
    )


def infer_json_columns(df: DataFrame, body: str) -> DataFrame:
    """Column names and table types of JSON object records, from every row.

    Whole numbers give long, other numbers double, true/false boolean; text
    and anything nested give string. Over several rows long and double meet in
    double, any other mixture in string; nulls say nothing. Only the few kinds
    per name leave the map side.
    """
    spark = df.sparkSession
    records = df.select(F.try_parse_json(F.col(body)).alias("v"))
    fields = records.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
    kinds = fields.filter("key is not null").select(
        F.col("key").alias("column_name"), F.schema_of_variant("value").alias("kind")
    )
    table_kind = (
        F.when(F.col("kind") == "BIGINT", "long")
        .when(F.col("kind").rlike("^(DOUBLE|FLOAT|DECIMAL)"), "double")
        .when(F.col("kind") == "BOOLEAN", "boolean")
        .when(F.col("kind") != "VOID", "string")
    )
    found = F.collect_set(table_kind)
    return kinds.groupBy("column_name").agg(found.alias("k")).select(
        "column_name",
        F.when(F.size("k") == 1, F.element_at("k", 1))
        .when((F.size("k") == 2) & F.array_contains("k", "long") & F.array_contains("k", "double"), "double")
        .otherwise("string")
        .alias("table_type"),
    )


# The shape of a governed dataset id and the fields of its record.
DATASET_ID = r"^[a-z][a-z0-9]*\.[a-z][a-z0-9]*(_[a-z0-9]+)*_(bronze|silver|gold|iceberg)$"
CONTRACT_FIELDS = (
    "dataset_id",
    "product_id",
    "dataset_namespace",
    "domain",
    "layer",
    "owner",
    "physical_locations",
)


@dataclass(frozen=True)
class Contract:
    dataset_id: str
    columns: Sequence[tuple[str, str]]
    record: Mapping[str, str] = field(default_factory=dict)


def schema_violations(spark: SparkSession, df: DataFrame, contract: Contract) -> DataFrame:
    """Rows for columns that are missing, unexpected or of another type than declared."""
    actual = spark.createDataFrame(
        [(c["name"], c["type"]) for c in describe_columns(df)], "column_name string, actual string"
    )
    declared = spark.createDataFrame(
        list(contract.columns), "column_name string, declared string"
    )
    return (
        declared.join(actual, "column_name", "full")
        .withColumn(
            "violation",
            F.when(F.col("actual").isNull(), "missing")
            .when(F.col("declared").isNull(), "unexpected")
            .when(F.col("declared") != F.col("actual"), "type"),
        )
        .filter(F.col("violation").isNotNull())
        .select(
            F.lit(contract.dataset_id).alias("dataset_id"),
            "column_name",
            "declared",
            "actual",
            "violation",
        )
    )


def contract_violations(contracts: DataFrame) -> DataFrame:
    """Rows for contract records with a blank required field or a malformed dataset id."""
    checks = [
        F.when(F.col(c).isNull() | (F.trim(F.col(c)) == ""), F.concat(F.lit("blank:"), F.lit(c)))
        for c in CONTRACT_FIELDS
    ]
    checks.append(F.when(~F.col("dataset_id").rlike(DATASET_ID), F.lit("malformed:dataset_id")))
    return contracts.select(
        "dataset_id", F.explode(F.array_compact(F.array(*checks))).alias("violation")
    )


def valid_dataset_id(dataset_id: str) -> bool:
    return re.match(DATASET_ID, dataset_id) is not None
