"""Mixing sources to target weights by capped water-filling.

A budget of words is shared among sources by weight. A source whose share is
above its limit (so many epochs) is clamped there, and what it leaves is shared
again among the others, until no share is above its limit. A source is then
taken whole as often as its target holds it, and for the rest a seeded part of
its documents is taken once more.

The seeded order of a source is never sorted as a whole: its documents are
summed into narrow ranges of a hash, the range in which the target is reached is
found from those sums, and only the documents of that range are looked at one
by one. Whether a document is taken follows from its own hash and one cut per
source, so reruns and lost executors change nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarn.llm.common import column, columns_of, n_words, small_join, text_of, whole_row
from tarn.session import stage

EPOCHS = 2.0
SEED = 17
RANGES = 4096
_SPAN = 2**40  # a draw is a whole number below this


def water_fill(sources: DataFrame, budget: float, epochs: float = EPOCHS) -> DataFrame:
    """``sources`` (with ``weight`` and ``source_size``) and each one's ``target``.

    A round shares what clamped sources left among the others by weight and clamps
    those above ``epochs`` times their size; it is one aggregate over the sources,
    and the last round clamps none. No source is clamped twice, so it ends. Where
    no source with weight is left, the rest of the budget is not placed.
    """
    limit = F.col("source_size") * F.lit(float(epochs))
    clamped = F.lit(False)
    while True:
        sums = sources.agg(
            F.sum(F.when(clamped, limit)).alias("placed"),
            F.sum(F.when(~clamped, F.col("weight").cast("double"))).alias("weights"),
            F.count(F.when(clamped, 1)).alias("clamped"),
        ).first()
        weights = sums["weights"] or 0.0
        level = max(0.0, budget - (sums["placed"] or 0.0)) / weights if weights > 0 else 0.0
        share = F.col("weight") * F.lit(level)
        # a source stays clamped: the level never falls
        above = (F.col("weight") > 0) & (limit <= share)
        if sources.filter(above).count() <= sums["clamped"]:
            return sources.withColumn("target", F.when(clamped, limit).otherwise(share).cast("double"))
        clamped = above


def _draw(id: Column, text: Column, seed: int) -> Column:
    """A number that depends on the document and the seed alone; without an id, on its text."""
    return F.pmod(F.when(id.isNull(), F.xxhash64(text, F.lit(seed))).otherwise(F.xxhash64(id, F.lit(seed))), F.lit(_SPAN))


def _cuts(sized: DataFrame, ranges: int) -> DataFrame:
    """Per source (_source): how often it is taken whole, and the draw up to which once more.

    ``sized`` has _source, _draw, _size, target and source_size.
    """
    part = F.floor(F.col("_draw") / F.lit(_SPAN // ranges))
    target = F.when(F.col("source_size") > 0, F.col("target")).otherwise(F.lit(0.0))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    by_range = (
        sized.groupBy("_source", part.alias("_range"))
        .agg(F.sum("_size").alias("_sum"), F.first("target").alias("target"), F.first("source_size").alias("source_size"))
        .withColumn("_whole", whole.cast("long"))
        .withColumn("_part", target - F.col("_whole") * F.col("source_size"))
    )
    upto = Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = stage(by_range.withColumn("_before", F.coalesce(F.sum("_sum").over(upto), F.lit(0))), "ranges")
    # the range in which the part ends; those before it are taken whole
    last = before.filter((F.col("_part") > F.col("_before")) & (F.col("_part") <= F.col("_before") + F.col("_sum")))
    inside = small_join(
        sized.withColumn("_range", part).select("_source", "_range", "_draw", "_size"),
        last.select("_source", "_range", "_before", "_part"), ["_source", "_range"], "inner",
    )
    # documents of equal draws are taken together
    draws = inside.groupBy("_source", "_draw", "_before", "_part").agg(F.sum("_size").alias("_size"))
    running = Window.partitionBy("_source").orderBy("_draw").rowsBetween(Window.unboundedPreceding, 0)
    reached = draws.withColumn("_upto", F.col("_before") + F.sum("_size").over(running))
    # the document that crosses the target is taken if that comes nearer to it
    taken = F.col("_upto") - F.col("_part") <= F.col("_part") - (F.col("_upto") - F.col("_size"))
    cut = (
        reached.groupBy("_source")
        .agg(F.max(F.when(taken, F.col("_draw"))).alias("_cut"), F.min("_draw").alias("_least"))
        .withColumn("_cut", F.coalesce("_cut", F.col("_least") - 1))
    )
    every = before.groupBy("_source").agg(F.first("_whole").alias("_whole"), F.first("_part").alias("_part"))
    return every.join(cut, "_source", "left").select("_source", "_whole", F.coalesce("_cut", F.lit(-1)).alias("_cut"))


def _plan(docs: DataFrame, weights, share: float, id: str, text: str, source: str, epochs: float, seed: int, ranges: int):
    """Sizes and draws of all documents, and per source its size, target and cut."""
    body = text_of(text)
    sized = stage(
        docs.select(
            column(id).alias("_id"), _key(column(source)).alias("_source"), n_words(body).alias("_size"),
            _draw(column(id), body, seed).alias("_draw"),
        ),
        "sizes",
    )
    sizes = stage(sized.groupBy("_source").agg(F.sum("_size").alias("source_size")), "sources")
    total = sizes.agg(F.sum("source_size")).first()[0] or 0
    targets = stage(water_fill(weights(sizes), share * total, epochs), "targets").select("_source", "source_size", "target")
    sized = small_join(sized, targets, ["_source"])
    return sized, small_join(targets, stage(_cuts(sized, ranges), "cuts"), ["_source"])


def _key(source: Column) -> Column:
    """Source names as keys that are never null; null comes last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def weights_in_order(cycle: tuple[float, ...]):
    """Weights dealt out to the sources in the order of their names, null last.

    The order is that of one row per source.
    """

    def give(sizes: DataFrame) -> DataFrame:
        rank = F.row_number().over(Window.orderBy("_source")) - 1
        pick = F.array(*[F.lit(float(w)) for w in cycle])
        return sizes.withColumn("weight", F.element_at(pick, (rank % len(cycle) + 1).cast("int")))

    return give


def weights_by_name(table: DataFrame, source: str = "source", weight: str = "weight"):
    """Weights from a table with one row per source; a source that it lacks has none."""

    def give(sizes: DataFrame) -> DataFrame:
        named = table.select(_key(column(source)).alias("_source"), column(weight).cast("double").alias("weight"))
        return sizes.join(named, "_source", "left").fillna(0.0, ["weight"])

    return give


def mix_sources(
    docs: DataFrame, weights, share: float, id: str = "doc_id", text: str = "text", source: str = "source",
    epochs: float = EPOCHS, seed: int = SEED, ranges: int = RANGES,
) -> DataFrame:
    """One row per document: id, size, source_size, target, copies and taken (copies x size).

    ``share`` times all words is the budget; see the module text. Null text has size
    0, a null source is a source of its own. A source without words has target 0 and
    none of it is taken. Rows with the same id are taken together. Other columns of
    ``docs`` are not read.
    """
    sized, cuts = _plan(docs, weights, share, id, text, source, epochs, seed, ranges)
    rows = small_join(sized.drop("source_size", "target"), cuts, ["_source"])
    copies = (F.col("_whole") + (F.col("_draw") <= F.col("_cut")).cast("long")).alias("copies")
    return rows.select("_id", "_size", "source_size", "target", copies).select(
        F.col("_id").alias(id), F.col("_size").alias("size"), F.col("source_size").cast("long").alias("source_size"), "target",
        "copies", (F.col("copies") * F.col("_size")).alias("taken"),
    )


def mixed_documents(
    docs: DataFrame, weights, share: float, id: str = "doc_id", text: str = "text", source: str = "source",
    epochs: float = EPOCHS, seed: int = SEED, ranges: int = RANGES,
) -> DataFrame:
    """The mix itself: every row as often as ``mix_sources`` takes it, with all its columns."""
    _, cuts = _plan(docs, weights, share, id, text, source, epochs, seed, ranges)
    rows = docs.select(
        whole_row(docs).alias("_doc"), _key(column(source)).alias("_source"),
        _draw(column(id), text_of(text), seed).alias("_draw"),
    )
    copies = F.col("_whole") + (F.col("_draw") <= F.col("_cut")).cast("long")
    taken = small_join(rows, cuts.select("_source", "_whole", "_cut"), ["_source"]).filter(copies > 0)
    return columns_of(taken.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), copies))), "_doc", docs)
