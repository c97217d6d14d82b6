"""Cutoffs of the quality rules follow the spread of each group."""

import pytest
from pyspark.sql import functions as F
from test_native import docs_of

from tarn.llm import quality
from tarn.llm.quality import quality_rules


def text(i, symbols=0, lines=0, repeats=0, size=5):
    """100 distinct words of ``size`` letters on 20 lines; some end in symbols, are replaced by copies or belong to a repeated line."""
    words = [f"{i % 1000:03d}{k:02d}".rjust(5, "x").ljust(size, "y")[-max(size, 5):] for k in range(100)]
    words = [w[:size] if size >= 5 else f"{k:02d}{i % 10}"[:size] for k, w in enumerate(words)]
    for k in range(symbols):
        words[k] = words[k][:-1] + "#"
    words[50 : 50 + repeats] = words[:repeats]
    rows = [" ".join(words[k : k + 5]) for k in range(0, 100, 5)]
    return "\n".join(rows + ["one line"] * (lines + 1))


STEPS = {"symbols": ("symbols", 6), "lines": ("lines", 1), "repeats": ("repeats", 2), "long_words": ("size", 1), "short_words": ("size", 1)}


def spread(kind, wide):
    """200 texts of which each fifth deviates by another number of steps."""
    part, step = STEPS[kind]
    at = 5 if part == "size" else 0
    return [(i, text(i, **{part: at + step * wide * (i % 5)}), "en", f"{kind}{wide}", 0) for i in range(200)]


def signals(spark, rows):
    docs = quality.text_counts(docs_of(spark, rows), "text")
    return docs.withColumn("_signals", F.struct(*[c.alias(s) for s, c in quality._signals().items()]))


def test_spread_decides_the_reach_of_every_signal(spark):
    scored = signals(spark, [row for kind in STEPS for wide in (1, 2) for row in spread(kind, wide)])
    exact = {
        r["source"]: r for r in scored.groupBy("source").agg(
            *[F.expr(f"percentile(_signals.{s}, 0.75)").alias(s) for s in quality.SIGNALS]
        ).collect()
    }
    cutoffs = {r["source"]: r["_cutoff"] for r in quality._cutoffs(scored, ["lang", "source"]).collect()}
    for s, least in quality.SIGNALS.items():
        narrow, wide = (cutoffs[f"{s}{k}"][s] - exact[f"{s}{k}"][s] for k in (1, 2))
        assert wide > narrow + 0.01 and wide > least + 0.01, s


@pytest.mark.parametrize("odd", [{"symbols": 20}, {"lines": 5}, {"repeats": 8}, {"size": 7}, {"size": 3}])
def test_far_texts_of_even_groups_are_dropped(spark, odd):
    rows = [(i, text(i), "en", "a", 0) for i in range(100)] + [(500, text(500, **odd), "en", "a", 0)]
    # texts that the base rule drops do not make room for others
    rows += [(900 + i, "a b c d e " * 20, "en", "a", 0) for i in range(60)]
    got = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in quality_rules(docs_of(spark, rows)).collect()}
    assert got[500] == (False, False)
    assert all(got[i] == (False, True) for i in range(100)) and all(got[900 + i] == (True, False) for i in range(60))
