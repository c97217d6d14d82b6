"""Exact deduplication by distributed MSD radix partitioning.

Documents are split by successive bytes until every group has one member or
its texts have ended. A level takes the next bytes of the texts that are still
in a group with others, as one digit, and splits the groups by it in one
``groupBy``; digits get wider level by level, so that a text of any length ends
after a few levels. The length is part of the first digit: a shorter text has
ended where a longer one goes on. Equality needs no digest: members of a group
agree on every byte.

Counting a level combines on the map side, so a hot group sends one row per
task; only the join back to the rows meets a hot key, and that join is one that
adaptive execution splits. What a level carries is the rest of the texts that
are still undecided.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import SPACE, column, columns_of, small_join, text_of, whole_row
from tarn.session import stage

FIRST_DIGIT = 64
WIDEN = 8


def _radix_groups(rows: DataFrame, first: int, widen: int) -> DataFrame:
    """Groups of more than one equal text, as (_row, _best, _size) for each member.

    ``rows`` has _row (unique), _id and _bytes. ``_best`` is (id is null, id, row)
    of the member that stays.
    """
    spark = rows.sparkSession
    settled = []
    width, start = first, 0
    # the first digit is looked at without the texts, which most rows need no longer after it
    heads = rows.select(
        "_row", "_id", F.lit(0).cast("long").alias("_group"), F.octet_length("_bytes").alias("_length"),
        F.substring("_bytes", 1, first).alias("_digit"),
    )
    split = _split(heads).select("_row", "_id", "_length", "_group", "_best", "_size")
    level = stage(split, "radix")
    while True:
        end = start + width
        settled.append(level.filter(F.col("_length") <= end).select("_row", "_best", "_size"))
        active = level.filter(F.col("_length") > end).drop("_best", "_size")
        if active.isEmpty():
            break
        if start == 0:
            rest = F.substring(F.col("_bytes"), end + 1, 2**31 - 1)
            active = active.hint("merge").join(rows.select("_row", rest.alias("_rest")), "_row")
        start, width = end, width * widen
        digits = active.withColumn("_digit", F.substring("_rest", 1, width)).withColumn(
            "_rest", F.substring("_rest", width + 1, 2**31 - 1)
        )
        level = stage(_split(digits).drop("_digit"), "radix")
    return reduce(DataFrame.unionAll, settled) if settled else spark.createDataFrame([], split.schema)


def _split(rows: DataFrame) -> DataFrame:
    """Split groups by their next digit; rows left alone are dropped, others get the new group."""
    key = ["_group", "_length", "_digit"]
    shared = (
        rows.groupBy(*key)
        .agg(
            F.min("_row").alias("_next"),
            F.min(F.struct(F.isnull("_id").alias("none"), F.col("_id").alias("id"), F.col("_row").alias("row"))).alias("_best"),
            F.count(F.lit(1)).alias("_size"),
        )
        .filter("_size > 1")
    )
    # a sort-merge join at every size, so that small runs show the plan that large ones get
    return rows.join(shared.hint("merge"), key).drop("_group").withColumnRenamed("_next", "_group")


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows with a number that later passes can rely on, written once."""
    return stage(rows.withColumn("_row", F.monotonically_increasing_id()), "texts")


def _normal(text) -> Column:
    return F.regexp_replace(text, SPACE, " ").cast("binary").alias("_bytes")


def exact_dedup(
    docs: DataFrame, id: str = "doc_id", text: str = "text", first: int = FIRST_DIGIT, widen: int = WIDEN
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are identical after each run of white space became one
    space; null is empty. The row with the smallest id stays; a null id comes last,
    and of repeated ids one row stays. Other columns of ``docs`` are not read. An
    empty table gives an empty result.
    """
    rows = _numbered(docs.select(column(id).alias("_id"), _normal(text_of(text))))
    groups = _radix_groups(rows, first, widen)
    sha = F.sha2(F.col("_bytes"), 256)
    joined = rows.select("_row", "_id", sha.alias("text_sha256")).join(groups, "_row", "left")
    single = F.col("_size").isNull()
    return joined.select(
        F.col("_id").alias(id),
        F.when(single, F.col("_id")).otherwise(F.col("_best.id")).alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        (single | (F.col("_best.row") == F.col("_row"))).alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(
    docs: DataFrame, id: str = "doc_id", text: str = "text", first: int = FIRST_DIGIT, widen: int = WIDEN
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; see ``exact_dedup``."""
    rows = _numbered(docs.select(whole_row(docs).alias("_doc")))
    body = F.coalesce(F.col("_doc").getField(text), F.lit(""))
    texts = rows.select("_row", F.col("_doc").getField(id).alias("_id"), _normal(body))
    copies = _radix_groups(texts, first, widen).filter("_best.row != _row").select("_row")
    return columns_of(small_join(rows, stage(copies, "copies"), ["_row"], "left_anti"), "_doc", docs)
