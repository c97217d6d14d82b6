"""Substring, window and n-gram deduplication against plain versions."""

import hashlib
import random

import numpy as np
import pytest
from brute import components, repeated_bytes, repeated_words
from test_native import EDGE, clashing, docs_of, key

from tarn.llm import chunks, jaccard
from tarn.llm.components import connected
from tarn.llm.jaccard import drop_near_copies, near_copies
from tarn.llm.repeated_bytes import COVERS, remove_repeats
from tarn.llm.repeated_words import remove_repeated_words


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def passages(n=120, seed=3):
    """Short texts that share passages of many lengths, copies and near copies."""
    pick = random.Random(seed)
    shared = [" ".join(f"p{k}w{i}" for i in range(40)) for k in range(6)]
    rows = []
    for i in range(n):
        own = [f"d{i}x{k}" for k in range(pick.randrange(3, 40))]
        at = pick.randrange(len(own))
        part = pick.choice(shared).split()
        cut = pick.randrange(1, len(part))
        rows.append((i, " ".join([*own[:at], *part[: cut + 1], *own[at:]]), "en", "a", 0))
    for i in range(n, n + 40):
        words = rows[i % 5][1].split()
        for _ in range(i % 4):
            words[pick.randrange(len(words))] = f"new{i}"
        rows.append((i, " ".join(words), "en", "a", 0))
    return rows


ROWS = {"edge": EDGE, "passages": passages(), "mixed": EDGE + passages(30, seed=9)}


@pytest.mark.parametrize("rows", [*ROWS, "table"])
def test_repeated_bytes(spark, table, rows):
    docs = table if rows == "table" else clashing(docs_of(spark, ROWS[rows]).repartition(3))
    given = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = remove_repeats(docs).collect()
    want = [(d, *x) for (d, _), x in zip(given, repeated_bytes([t for _, t in given]))]
    assert key(tuple(r)[:5] for r in got) == key(want)
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in got)


@pytest.mark.parametrize("length,period", [(20, 7), (40, 31), (15, 13)])
def test_short_strings(spark, length, period):
    given = [(r[0], r[1]) for r in ROWS["mixed"] if not r[1] or len(r[1]) < 10_000]
    docs = spark.createDataFrame(given, "doc_id long, text string")
    want = [(d, *x) for (d, _), x in zip(given, repeated_bytes([t for _, t in given], length))]
    assert key(tuple(r)[:5] for r in remove_repeats(docs, length=length, period=period).collect()) == key(want)


def test_covers_are_difference_covers():
    for period, cover in COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


@pytest.mark.parametrize("rows", [*ROWS, "table"])
def test_repeated_words(spark, table, rows):
    docs = table if rows == "table" else clashing(docs_of(spark, ROWS[rows]).coalesce(1))
    given = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = [tuple(r)[:4] for r in remove_repeated_words(docs).collect()]
    assert key(got) == key(repeated_words(given))


@pytest.mark.parametrize("rows", [*ROWS, "table"])
def test_near_copies(spark, table, rows):
    docs = table if rows == "table" else clashing(docs_of(spark, ROWS[rows]).repartition(3))
    given = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert key(tuple(r) for r in near_copies(docs).collect()) == key(components(given))


def test_blocks_of_a_large_group(spark, monkeypatch):
    """Chains of near copies: pivots miss links, and blocks are so small that pairs meet over several."""
    monkeypatch.setattr(jaccard, "BLOCK_NGRAMS", 300)
    rows, words = [], [f"w{k}" for k in range(60)]
    for i in range(60):
        rows.append((i, " ".join(words)))
        words[(i * 7) % 60 : (i * 7) % 60 + 1] = [f"n{i}"]
    rows += [(100 + i, " ".join(f"other{i}z{k}" for k in range(30))) for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert key(tuple(r) for r in near_copies(docs).collect()) == key(components(rows))


def test_range_keys_meet():
    """Sets at the bound share a key, whatever their size and however they differ."""
    pick = np.random.default_rng(4)
    for n in [*range(1, 60), 100, 333, 1000, 5000]:
        for _ in range(6):
            pool = np.unique(pick.integers(0, 2**63, 2 * n + 10, dtype=np.uint64))
            pick.shuffle(pool)
            lost = int(pick.integers(0, n // 10 + 1))
            a, b = np.sort(pool[:n]), pool[lost:n]
            room = n // 9 + 1
            b = np.sort(np.concatenate([b, pool[n : n + int(pick.integers(0, room))]]))
            shared = len(np.intersect1d(a, b))
            if 100 * shared >= 90 * (len(a) + len(b) - shared):
                assert set(jaccard._range_keys(a, 90).tolist()) & set(jaccard._range_keys(b, 90).tolist())


def test_one_of_each_group_stays(spark):
    docs = clashing(docs_of(spark, ROWS["mixed"]))
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    given = [(k, r["text"]) for k, r in enumerate(docs.collect())]
    groups = {c for _, _, c in components(given)}
    assert kept.count() == len(groups)


def test_kept_rows_are_the_rows_given(spark):
    """All columns come back as they were, of any type, in any place, null texts as null."""
    docs = spark.sql("""
        SELECT id AS k, struct(id, 'x') AS `a.b`, CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN '' ELSE concat('t é ', id) END AS text,
            CASE WHEN id % 5 = 0 THEN NULL ELSE id END AS doc_id, DATE'2020-01-01' AS chunk, array(id) AS rest, CAST(id AS DECIMAL(20, 3)) AS none
        FROM range(40)
    """)
    kept = drop_near_copies(docs.repartition(3))
    assert kept.schema.simpleString() == docs.schema.simpleString()
    assert key(kept.collect()) == key(docs.collect())


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (103, 101), (7, 7), (200, 200)]
    got = {tuple(r) for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(i, 0) for i in range(41)} | {(100, 100), (101, 100), (103, 100)}


@pytest.mark.parametrize("buckets", [64, 1024, 1 << 14])
def test_buckets_hold_all_keys(buckets):
    """Every key is in the bucket of its leading bits; only buckets that hold any are looked at."""
    keys = np.unique(np.random.default_rng(1).integers(0, 2**64, 5000, dtype=np.uint64))
    for some in (keys, keys[:1], keys[:0], np.array([0, 1, 2**64 - 1], dtype=np.uint64)):
        held, edges = chunks.held_buckets(some, buckets)
        assert edges[-1] == len(some) and len(held) == len(edges) - 1 <= len(some)
        assert (np.diff(edges) > 0).all() and (not len(some) or edges[0] == 0)
        assert all(int(k) * buckets >> 64 == b for b, x, y in zip(held, edges[:-1], edges[1:]) for k in some[x:y])
    assert (chunks.unpacked(chunks.packed(keys, 5), 5) == keys & np.uint64(2**40 - 1)).all()
    asked = chunks.questions(7, keys, buckets, 6)
    bits = {b: np.packbits(chunks.unpacked(k, 6) % 2 == 1).tobytes() for b, k in zip(*(asked.column(c).to_pylist() for c in ("bucket", "keys")))}
    assert (chunks.bits_of(bits, keys, buckets, 1)[:, 0] == (keys % 2 == 1)).all()


def doubled(letters: int) -> tuple[str, str]:
    """A word that doubles itself with a and b swapped, and its complement: sums of powers cannot tell them apart."""
    word = "a"
    swap = str.maketrans("ab", "ba")
    while len(word) < letters:
        word += word.translate(swap)
    return word, word.translate(swap)


@pytest.mark.parametrize("letters", [512, 1024, 4096])
def test_structured_words_are_told_apart(spark, letters):
    one, other = doubled(letters)
    few = " ".join(f"w{k}" for k in range(19))
    rows = [(1, f"{few} {one}"), (2, f"{few} {other}"), (3, one), (4, other)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r["n_removed"] for r in remove_repeated_words(docs).collect()] == [0, 0, 0, 0]
    assert {(r["doc_id"], r["component_id"]) for r in near_copies(docs).collect()} == {(k, k) for k in range(1, 5)}
    want = [(d, *x) for (d, _), x in zip(rows, repeated_bytes([t for _, t in rows]))]
    assert key(tuple(r)[:5] for r in remove_repeats(docs).collect()) == key(want)


def test_hashes_of_stretches():
    """Equal stretches agree wherever they stand, others do not, at every size and for both kinds of values."""
    one, other = doubled(2048)
    data = np.frombuffer((one + other + one).encode(), dtype=np.uint8)
    for size in (1, 3, 7, 8, 9, 15, 16, 90, 110, 2048):
        starts = np.arange(len(data) - size + 1)
        got = chunks.Stretches(data).of(starts, size)
        texts = [data[k : k + size].tobytes() for k in starts]
        assert len(set(got.tolist())) == len(set(texts)) == len(set(zip(got.tolist(), texts)))
    starts, stops, _ = chunks.split_words(*(lambda d: (d, np.array([0, len(d)])))(np.frombuffer(b"a b a " + one.encode() + b" " + other.encode() + b" b", dtype=np.uint8)))
    for salt in (0, 1):
        got = chunks.word_hashes(np.frombuffer(b"a b a " + one.encode() + b" " + other.encode() + b" b", dtype=np.uint8), starts, stops, salt)
        assert got[0] == got[2] and got[1] == got[5] and len(set(got.tolist())) == 4


def test_empty_tables(spark):
    docs = docs_of(spark, [])
    for df in (remove_repeats(docs), remove_repeated_words(docs), near_copies(docs), drop_near_copies(docs)):
        assert df.collect() == []
