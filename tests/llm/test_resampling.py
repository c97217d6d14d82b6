"""Importance resampling against a plain version; its SQL is compared with the other queries'."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from test_native import EDGE, clashing, docs_of, key

from tarn.llm.resampling import SlotTable, bucket_counts, resample

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BENCH = ["The words, the WORDS; x y", None, "", "é ß word1x1 a b c"]


def grams(text, most):
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return [" ".join(words[i : i + n]) for n in range(1, most + 1) for i in range(len(words) - n + 1)], len(words)


def plain(rows, bench, buckets=10_000, most=1, least=20):
    def bucket(g):
        return zlib.crc32(g.encode()) % buckets

    source = Counter(bucket(g) for _, t in rows for g in grams(t, most)[0])
    target = Counter(bucket(g) for t in bench for g in grams(t, most)[0])
    s_all, t_all = sum(source.values()), sum(target.values())

    def gain(b):
        return math.floor(1000 * math.log((target[b] + 1) * (s_all + buckets) / ((source[b] + 1) * (t_all + buckets))))

    out = []
    for one, text in rows:
        mine, n_words = grams(text, most)
        weight = sum(gain(bucket(g)) for g in mine) // len(mine) if mine else 0
        h = int(hashlib.sha256(f"2024:{'' if one is None else one}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([one, len(mine), weight, score, None, n_words])
    fit = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for k, r in enumerate(fit[: 10 * len(fit) // 100]):
        r[4] = k + 1
    return [tuple(r[:5]) for r in out]


def many(n=300):
    """Texts with ties of all kinds: repeated rows, one text under many ids."""
    rows = [(k % 250, " ".join(f"w{(k * j) % 41}" for j in range(k % 37)), "en", "a", 0) for k in range(n)]
    return rows + [(k, "the same twenty words " * 6, "en", "a", 0) for k in range(1000, 1200)] + [(1000, "the same twenty words " * 6, "en", "a", 0)] * 3


@pytest.mark.parametrize("rows,most", [("edge", 1), ("many", 1), ("many", 3), ("table", 1)])
def test_resampling(spark, sf, rows, most):
    docs = spark.read.parquet(f"{sf}/documents.parquet") if rows == "table" else docs_of(spark, EDGE if rows == "edge" else many()).repartition(5)
    bench = [(i, t) for i, t in enumerate(BENCH)]
    given = [(r["doc_id"], r["text"]) for r in docs.collect()]
    clash = clashing(docs).selectExpr("*", "'x' AS id", "'x' AS bucket", "'x' AS `rank`", "'x' AS n")
    target = spark.createDataFrame(bench, "item_id long, text string")
    got = resample(clash, target, most=most)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert key(tuple(r) for r in got.collect()) == key(plain(given, BENCH, most=most))


def test_none(spark):
    nothing = docs_of(spark, [])
    some = docs_of(spark, EDGE[:4])
    assert resample(nothing, some).collect() == []
    assert key(tuple(r) for r in resample(some, nothing).collect()) == key(plain([r[:2] for r in EDGE[:4]], []))


@pytest.mark.parametrize("hashed", [len, lambda s: 7, zlib.crc32])
def test_strings_with_one_hash_have_slots_of_their_own(hashed):
    table = SlotTable(100, size=4, hashed=hashed)
    strings = [f"s{(k * k) % 97}".encode() for k in range(500)]
    first = table.intern(strings[:100])
    slots = table.intern(strings)
    assert [table.strings[s] for s in slots] == strings and len(first) == 100
    held = Counter(strings) + Counter(strings[:100])
    at = np.flatnonzero(table.strings != None)  # noqa: E711
    assert {table.strings[k]: table.count[k] for k in at} == dict(held)
    assert all(table.bucket[k] == zlib.crc32(table.strings[k]) % 100 for k in at)


def test_counts_do_not_depend_on_partitions(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert key(bucket_counts(docs.repartition(7)).collect()) == key(bucket_counts(docs.coalesce(1)).collect())
