"""Quality rules with thresholds that follow the data.

A text gets four counts and from them four signals: symbols per character of its
words, repeated lines per line, repeated words per word, and the length of its
words. A fixed base rule drops what no language or source should hold. Beyond
it, cutoffs are not fixed: each (language, source) gets a mergeable quantile
sketch of every signal over the texts that pass the base rule, and a text is dropped
if a signal lies far outside the quartiles and the upper eighth of its own group.
Groups of few documents use the merged sketches of
their language, and small languages those of all documents.

Signals are rounded before they are sketched and cutoffs after, so that the
sketches' random compaction does not move a verdict. Sketching is a partial
aggregate; a hot source sends one sketch per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import SPACE, column, columns_of, let, small_join, text_of, whole_row, words
from tarn.session import stage

SYMBOLS = "#*$%&|<>"
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED = 20  # percent of words in repeated windows

SKETCH_SIZE = 2000
LEAST_ROWS = 50
# a cutoff lies this many spreads above the upper quartile: the distance of the quartiles, or that
# to the upper eighth where most of a group is equal. It lies at least the given distance from it,
# the resolution of a signal: a symbol in fifty characters, a line in ten, a window and its copy in
# two hundred words, half a character of the mean length
FAR_OUT = 3.0
EIGHTH = 0.125
SIGNALS = {"symbols": 0.02, "lines": 0.1, "repeats": 0.05, "long_words": 0.5, "short_words": 0.5}


def _repeated_words(tokens: Column, size: int) -> Column:
    """Words covered by windows that occur twice or more in the same text.

    Windows are first compared by hash, which can only find too many; the texts in
    which hashes repeat then compare the words themselves.
    """
    none = F.lit(0).cast("long")

    def hashes(hashed: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(hashed) - size + 1)
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(hashed, i + (k - 1)) for k in range(size)]))

    maybe = let(F.transform(tokens, lambda w: F.xxhash64(w)), hashes)
    repeats = let(maybe, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(F.size(tokens) < size, none).when(repeats, _covered(tokens, size)).otherwise(none)


def _covered(tokens: Column, size: int) -> Column:
    starts = F.sequence(F.lit(1), F.size(tokens) - size + 1)
    windows = F.transform(
        starts, lambda i: F.struct(F.concat_ws(" ", F.slice(tokens, i, size)).alias("w"), i.alias("i"))
    )

    def found_twice(ordered: Column) -> Column:
        same = F.filter(
            ordered,
            lambda x, k: (F.get(ordered, k - 1).getField("w") == x.getField("w"))
            | (F.get(ordered, k + 1).getField("w") == x.getField("w")),
        )
        return F.sort_array(F.transform(same, lambda x: x.getField("i")))

    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-size).alias("last"))
    return F.aggregate(
        let(F.sort_array(windows), found_twice),
        start,
        lambda seen, i: F.struct(
            (seen.getField("n") + F.least(F.lit(size), i - seen.getField("last"))).alias("n"), i.alias("last")
        ),
        lambda seen: seen.getField("n"),
    )


def text_counts(docs: DataFrame, text: str, symbols: str = SYMBOLS, window: int = WINDOW) -> DataFrame:
    """``docs`` with one more column, ``_counts``: the counts of each whole text; null counts as empty."""
    body = text_of(text)
    lines = F.filter(F.split(body, "\n"), lambda line: F.regexp_replace(line, SPACE, "") != "")
    with_words = docs.withColumn("_words", words(body)).withColumn("_lines", lines)
    tokens = F.col("_words")
    return with_words.withColumn(
        "_counts",
        F.struct(
            F.size(tokens).cast("long").alias("n_words"),
            F.length(F.array_join(tokens, "")).cast("long").alias("word_chars"),
            (F.length(body) - F.length(F.translate(body, symbols, ""))).cast("long").alias("n_symbols"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
            _repeated_words(tokens, window).alias("n_repeat_words"),
            F.size("_lines").cast("long").alias("n_lines"),
        ),
    ).drop("_words", "_lines")


def _signals(counts: str = "_counts") -> dict[str, Column]:
    def ratio(part: str, whole: str) -> Column:
        of = F.col(f"{counts}.{whole}")
        return F.when(of > 0, F.round(F.col(f"{counts}.{part}") / of, 3)).otherwise(F.lit(0.0))

    length = ratio("word_chars", "n_words")
    return {
        "symbols": ratio("n_symbols", "word_chars"),
        "lines": ratio("n_dup_lines", "n_lines"),
        "repeats": ratio("n_repeat_words", "n_words"),
        "long_words": length,
        "short_words": -length,
    }


def _cutoffs(scored: DataFrame, keys: list[str]) -> DataFrame:
    """Per group of ``keys``: ``_cutoff``, a struct with the highest accepted value of each signal."""
    sketched = ["symbols", "lines", "repeats", "long_words"]
    sketches = stage(
        scored.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("_rows"),
            *[F.kll_sketch_agg_double(F.col(f"_signals.{s}"), F.lit(SKETCH_SIZE)).alias(s) for s in sketched],
        ),
        "sketches",
    )

    def merged(by: list[str]) -> DataFrame:
        return sketches.groupBy(*by).agg(
            F.sum("_rows").alias("_rows"), *[F.kll_merge_agg_double(F.col(s), F.lit(SKETCH_SIZE)).alias(s) for s in sketched]
        )

    def limits(table: DataFrame, name: str) -> DataFrame:
        def quantile(s: str, q: float) -> Column:
            return F.kll_sketch_get_quantile_double(F.col(s), F.lit(q))

        fields = []
        for s, least in SIGNALS.items():
            # short words are long words seen from the other side
            of, low, high, far, sign = (s, 0.25, 0.75, 1 - EIGHTH, 1) if s != "short_words" else ("long_words", 0.75, 0.25, EIGHTH, -1)
            middle, tail = (quantile(of, high) - quantile(of, low)) * sign, (quantile(of, far) - quantile(of, high)) * sign
            reach = F.greatest(middle * FAR_OUT, tail * FAR_OUT, F.lit(least))
            fields.append(F.round(quantile(of, high) * sign + reach, 2).alias(s))
        kept = [c for c in (*keys, "_one") if c in table.columns]
        return table.select(*kept, F.struct(*fields).alias(name), (F.col("_rows") >= LEAST_ROWS).alias(f"{name}_ok"))

    # grouped by a constant, so that an empty table gives no row
    sketches = sketches.withColumn("_one", F.lit(1))
    table = limits(sketches, "_own").join(limits(merged(keys[:1]), "_first"), keys[:1], "left")
    table = table.join(limits(merged(["_one"]), "_all").drop("_all_ok"), "_one")
    chosen = F.when(F.col("_own_ok"), F.col("_own")).when(F.col("_first_ok"), F.col("_first")).otherwise(F.col("_all"))
    return table.select(*keys, chosen.alias("_cutoff"))


def _judge(docs: DataFrame, text: str, lang: str, source: str, keep: list[Column]) -> DataFrame:
    def key(name: str) -> Column:
        return F.when(column(name).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), column(name)))

    counted = text_counts(
        docs.select(*keep, text_of(text).alias("_text"), key(lang).alias("_lang"), key(source).alias("_source")), "_text"
    ).drop("_text")
    n_words, repeated = F.col("_counts.n_words"), F.col("_counts.n_repeat_words")
    base_failed = (n_words < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * n_words)
    counted = counted.withColumn("_base_failed", base_failed)
    scored = stage(
        counted.withColumn("_signals", F.struct(*[c.alias(s) for s, c in _signals().items()])), "counts"
    )
    keys = ["_lang", "_source"]
    # what the base rule drops must not widen the cutoffs of the rest
    judged = small_join(scored, stage(_cutoffs(scored.filter("not _base_failed"), keys), "cutoffs"), keys)
    too_far = F.lit(False)
    for s in SIGNALS:
        too_far = too_far | (F.col(f"_signals.{s}") > F.col(f"_cutoff.{s}"))
    return judged.withColumn("_kept", ~F.col("_base_failed") & ~F.coalesce(too_far, F.lit(False)))


def quality_rules(
    docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source"
) -> DataFrame:
    """One row per document: id, the counts, base_failed and kept.

    Null text is empty and fails the base rule; a null language or source is a group
    of its own. Repeated rows are judged alike. An empty table gives an empty result.
    Other columns of ``docs`` are not read.
    """
    judged = _judge(docs, text, lang, source, [column(id).alias("_id")])
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select(
        F.col("_id").alias(id), *[F.col(f"_counts.{c}").alias(c) for c in counts],
        F.col("_base_failed").alias("base_failed"), F.col("_kept").alias("kept"),
    )


def keep_good(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source"
) -> DataFrame:
    """The rows of ``docs`` that ``quality_rules`` keeps, with all their columns."""
    judged = _judge(docs, text, lang, source, [whole_row(docs).alias("_doc")])
    return columns_of(judged.filter("_kept"), "_doc", docs)
