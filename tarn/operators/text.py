"""Personal data in text, and chunks for retrieval. JVM expressions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Entity types and their patterns, in the order they are applied.
# Only syntax that Java and RE2 read alike is used.
ENTITIES = {
    "EMAIL_ADDRESS": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "IBAN_CODE": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "CREDIT_CARD": r"\b(?:[0-9]{4}[ -]?){3}[0-9]{4}\b",
    "IP_ADDRESS": r"\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b",
    "PHONE_NUMBER": r"\+?\b[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-]?[0-9]{2,4}\b",
}


# A character every match holds: texts without it are not searched, as an address has no
# left boundary and each place of a long word would be tried to its end.
HELD = {"EMAIL_ADDRESS": "@"}


def _matches(text: Column, pattern: str, allow: Sequence[str]) -> Column:
    """Number of matches, terms of the allowlist left out."""
    if not allow:
        return F.regexp_count(text, F.lit(pattern)).cast("long")
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.size(F.filter(found, lambda x: ~x.isin(*allow))).cast("long")


def detect_entities(
    df: DataFrame, keys: Sequence[str], text: str, allow: Sequence[str] = ()
) -> DataFrame:
    """Entity types and their number of matches per record, whole text searched.

    Types are looked for in order, each in what the ones before it left, so a
    piece of text counts once. A match equal to an allowed term does not
    count. Records without any entity give no row.
    """
    left, counts = df.withColumn("_rest", F.col(text)), []
    for i, (name, pattern) in enumerate(ENTITIES.items()):
        # a step of its own, so that no pattern runs twice over a text
        found = _matches(F.col("_rest"), pattern, allow)
        if name in HELD:
            found = F.when(F.contains(F.col("_rest"), F.lit(HELD[name])), found).otherwise(F.lit(0))
        left = left.withColumn(f"_n{i}", found)
        tagged = _tagged(F.col("_rest"), name, pattern, allow)
        left = left.withColumn("_rest", F.when(F.col(f"_n{i}") > 0, tagged).otherwise(F.col("_rest")))
        counts.append(F.struct(F.lit(name).alias("entity_type"), F.col(f"_n{i}").alias("n")))
    found = F.filter(F.array(*counts), lambda c: c["n"] > 0)
    return left.select(*keys, F.inline(found))


def _tagged(text: Column, name: str, pattern: str, allow: Sequence[str]) -> Column:
    tag = f"<{name}>"
    if not allow:
        return F.regexp_replace(text, F.lit(pattern), F.lit(tag))
    # what stands between the matches, each followed by its match or the tag; only a
    # whole match can be allowed
    def rebuilt(whole: Column) -> Column:
        between = F.split(whole, pattern, -1)
        matches = F.regexp_extract_all(whole, F.lit(pattern), F.lit(0))
        shown = F.transform(matches, lambda m: F.when(m.isin(*allow), m).otherwise(F.lit(tag)))
        return F.array_join(F.zip_with(between, shown, lambda b, m: F.concat(b, F.coalesce(m, F.lit("")))), "")

    # the text is itself such an expression; inside an array it is worked out once, not twice per type
    return F.transform(F.array(text), rebuilt)[0]


def anonymise(text: Column, allow: Sequence[str] = ()) -> Column:
    """Replace each entity by its tag, types in order; allowed terms stay."""
    for name, pattern in ENTITIES.items():
        tagged = _tagged(text, name, pattern, allow)
        held = F.contains(text, F.lit(HELD[name])) if name in HELD else None
        text = tagged if held is None else F.when(held, tagged).otherwise(text)
    return text


def chunk(df: DataFrame, keys: Sequence[str], text: str, size: int = 500, overlap: int = 50) -> DataFrame:
    """Chunks of at most ``size`` characters that overlap, with their place in the document.

    The citation is the document key, the chunk number and the character range
    [start, end). Every character is in some chunk; the last chunk is never
    only an overlap of the one before it.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be smaller than the chunk size")
    stride = size - overlap
    length = F.length(text)
    last = F.greatest(F.lit(0), F.ceil((length - F.lit(size)) / F.lit(stride))).cast("int")
    # the text is cut once; a chunk is a piece and as much of those behind it as it overlaps
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{stride}}}"), F.lit(0))
    behind = -(-overlap // stride) + 1
    cut = df.filter(length > 0).select(*keys, length.alias("_length"), F.sequence(F.lit(0), last).alias("_numbers"), pieces.alias("_pieces"))
    chunks = F.transform("_numbers", lambda k: F.substring(F.array_join(F.slice("_pieces", k + 1, F.lit(behind)), ""), 1, size))
    start = F.col("chunk_no") * stride
    return cut.select(*keys, "_length", F.posexplode(chunks).alias("chunk_no", "chunk")).select(
        *keys, "chunk_no", start.alias("start"), F.least(start + size, F.col("_length")).alias("end"), "chunk"
    )
