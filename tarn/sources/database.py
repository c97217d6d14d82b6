"""Relational databases over JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def table_options(config: Mapping) -> dict[str, str]:
    """Reader options for ``{host, port, database, user, password, schema?, table?}``.

    Without a table the database's own table list is read. ``column``,
    ``lower``, ``upper`` and ``partitions`` split the read into ranges of a
    numeric, date or timestamp column; each range is one task.
    """
    url = config.get("url") or (
        f"jdbc:postgresql://{config['host']}:{config.get('port', 5432)}/{config['database']}"
    )
    schema = config.get("schema") or "public"
    if config.get("table"):
        relation = f'"{schema}"."{config["table"]}"'
    else:
        relation = "(SELECT * FROM information_schema.tables) t"
    options = {"url": url, "dbtable": relation, "fetchsize": str(config.get("fetchsize", 10_000))}
    for key in ("user", "password", "driver"):
        if config.get(key):
            options[key] = config[key]
    if config.get("column"):
        options |= {
            "partitionColumn": config["column"],
            "lowerBound": str(config["lower"]),
            "upperBound": str(config["upper"]),
            "numPartitions": str(config["partitions"]),
        }
    return options


def read_database(spark: SparkSession, config: Mapping) -> DataFrame:
    """``SELECT * FROM schema.table``, lazy: filters and columns reach the database."""
    reader = spark.read.format("jdbc").options(**table_options(config))
    return reader.load()
