"""Importance resampling of documents towards a target, by hashed n-grams.

Documents and target texts are bags of word n-grams, each in one of a fixed number of
buckets. What a bucket gains says how much more often the target holds it than the
documents do; a document's weight is the mean gain of its n-grams. With Gumbel noise from
a hash of the id on top, the highest scores are a draw without replacement in proportion
to the weights, which comes out alike in every run.

1. Counting: each task interns the n-grams of a portion of texts in an open-addressed
   table and adds their counts to the buckets, so a bucket and a word are hashed once
   per portion. Tasks send their bucket counts, which Spark adds up.
2. Gains: a number per bucket, as many as the parameter says, whatever the input.
3. Scoring: portions are interned again; the slot of each occurrence gathers its gain.
4. Drawing: scores are whole numbers within a bounded range, so their histogram is
   small. It gives the score down to which documents are drawn, and how many have a
   higher one; only documents with that score or a higher one are ordered, each score by
   itself. The noise spreads equal weights over thousands of scores.
"""

from __future__ import annotations

import hashlib
import math
import sys
import zlib
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarn.llm.batches import portions
from tarn.llm.common import column, text_of
from tarn.session import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 10_000
MOST_WORDS = 1  # of an n-gram
LEAST_WORDS = 20  # of a document that may be drawn
SHARE = (10, 100)  # of those that are drawn
SEED = 2024
PORTION = 4 << 20  # bytes of text that are interned together

# bytes of words: digits, a-z and all of characters beyond ASCII; A-Z count as a-z
_FOLD = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in bytes(range(256)).lower())

COUNTS = pa.schema([("bucket", pa.int64()), ("n", pa.int64())])
SCORED = pa.schema([("id", pa.int64()), ("n_features", pa.int64()), ("n_words", pa.int64()), ("weight", pa.int64()), ("score", pa.int64())])


class SlotTable:
    """Byte strings in open addressing with linear probing: a slot has the key, the string, a bucket and a count.

    A slot is found by the 64-bit hash; the bytes are compared before a string takes
    part in it, so strings with one hash get slots of their own.
    """

    def __init__(self, buckets: int, size: int = 1 << 16, hashed=xxhash.xxh64_intdigest):
        self.buckets, self.hashed = buckets, hashed
        self._make(size)

    def _make(self, size: int) -> None:
        self.size = size
        self.keys = np.zeros(size, dtype=np.uint64)
        self.strings = np.full(size, None, dtype=object)
        self.owner = np.full(size, -1, dtype=np.int64)  # which occurrence brought the string; below 0: a free slot
        self.bucket = np.zeros(size, dtype=np.int64)
        self.count = np.zeros(size, dtype=np.int64)
        self.used = 0

    def intern(self, strings: list[bytes]) -> np.ndarray:
        """The slot of every occurrence, which it counts."""
        keys = np.fromiter(map(self.hashed, strings), dtype=np.uint64, count=len(strings))
        given = np.empty(len(strings), dtype=object)
        given[:] = strings
        while True:
            slots = self._place(keys, given)
            if slots is not None:
                self.count += np.bincount(slots, minlength=self.size)
                return slots
            self._grow()

    def _grow(self) -> None:
        held = np.flatnonzero(self.count)
        keys, strings, count = self.keys[held], self.strings[held], self.count[held]
        self._make(self.size * 4)
        if len(held):
            self.count[self._place(keys, strings)] = count

    def _place(self, keys: np.ndarray, given: np.ndarray) -> np.ndarray | None:
        """Slots of the strings, new ones included; None if the table becomes half full, and must grow."""
        slots = np.empty(len(keys), dtype=np.int64)
        left = np.arange(len(keys))
        at = (keys & np.uint64(self.size - 1)).astype(np.int64)
        while len(left):
            free = self.owner[at] < 0
            if free.any():
                # of the strings that meet at a free slot, the last one takes it
                slot, one = at[free], left[free]
                self.owner[slot] = one
                takes = self.owner[slot] == one
                slot, one = slot[takes], one[takes]
                self.used += len(slot)
                if 2 * self.used > self.size:
                    return None
                self.keys[slot], self.strings[slot] = keys[one], given[one]
                self.bucket[slot] = [zlib.crc32(s) % self.buckets for s in given[one]]
            same = self.keys[at] == keys[left]
            same[same] = np.fromiter(map(eq, self.strings[at[same]], given[left[same]]), dtype=bool, count=int(same.sum()))
            slots[left[same]] = at[same]
            left, at = left[~same], (at[~same] + 1) & (self.size - 1)
        return slots


def _grams(text: bytes | None, most: int) -> tuple[list[bytes], int]:
    """All runs of 1 to ``most`` words of a text, and the number of its words."""
    words = (text or b"").translate(_FOLD).split()
    grams = list(words)
    for n in range(2, most + 1):
        grams += [b" ".join(words[k : k + n]) for k in range(len(words) - n + 1)]
    return grams, len(words)


def _interned(batches: Iterator[pa.RecordBatch], buckets: int, most: int):
    """Per portion: its rows, the numbers of n-grams and of words of each text, the table and the slots in order."""
    for batch in batches:
        for part in portions(batch, "text", PORTION):
            found = [_grams(t, most) for t in part.column("text").to_pylist()]
            table = SlotTable(buckets)
            slots = table.intern([g for grams, _ in found for g in grams])
            yield part, [len(grams) for grams, _ in found], [n for _, n in found], table, slots


def bucket_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS, most: int = MOST_WORDS) -> DataFrame:
    """How many n-grams of all texts are in each bucket: bucket and n, for those that hold any."""

    def run(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for _, _, _, table, _ in _interned(batches, buckets, most):
            held = np.flatnonzero(table.count)
            np.add.at(total, table.bucket[held], table.count[held])
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], schema=COUNTS)

    counts = texts.select(text_of(text).cast("binary").alias("text")).mapInArrow(run, "bucket long, n long")
    return counts.groupBy("bucket").agg(F.sum("n").alias("n"))


def _as_vector(counts: DataFrame, buckets: int) -> np.ndarray:
    out = np.zeros(buckets, dtype=np.int64)
    for row in counts.collect():  # one row per bucket at most
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's share of the target over its share of the source, smoothed by one."""
    buckets, all_source, all_target = len(source), float(source.sum()), float(target.sum())
    return np.array(
        [math.floor(1000 * math.log((t + 1.0) * (all_source + buckets) / ((s + 1.0) * (all_target + buckets)))) for s, t in zip(source.tolist(), target.tolist())],
        dtype=np.int64,
    )


def _noise(one: int | None, seed: int) -> int:
    """Gumbel noise in thousandths, from a hash of the seed and the id; a null id is written as nothing."""
    h = int(hashlib.sha256(f"{seed}:{'' if one is None else one}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score_documents(
    docs: DataFrame, gain: np.ndarray, id: str = "doc_id", text: str = "text", most: int = MOST_WORDS, seed: int = SEED
) -> DataFrame:
    """id, n_features, n_words, weight and score of every document."""
    buckets = len(gain)

    def run(batches):
        for part, sizes, n_words, table, slots in _interned(batches, buckets, most):
            mine = gain[table.bucket[slots]]
            sums = np.concatenate([[0], np.cumsum(mine)])
            ends = np.cumsum(sizes)
            total = sums[ends] - sums[ends - np.array(sizes, dtype=np.int64)]
            weight = [int(t) // n if n else 0 for t, n in zip(total, sizes)]
            ids = part.column("id").to_pylist()
            score = [w + _noise(one, seed) for w, one in zip(weight, ids)]
            yield pa.RecordBatch.from_pydict({"id": ids, "n_features": sizes, "n_words": n_words, "weight": weight, "score": score}, schema=SCORED)

    picked = docs.select(column(id).cast("long").alias("id"), text_of(text).cast("binary").alias("text"))
    return picked.mapInArrow(run, "id long, n_features long, n_words long, weight long, score long")


def draw(scored: DataFrame, least_words: int = LEAST_WORDS, share: tuple[int, int] = SHARE) -> DataFrame:
    """``scored`` (written once) with rank: 1, 2, 3 ... for the drawn ones by falling score, else null.

    Of N rows with enough words floor(N x share) are drawn. Equal scores are ordered by
    id, a null id last.
    """
    fit = F.col("n_words") >= least_words
    # as many rows as there are scores: the range of the gains and of the noise
    held = sorted(((r["score"], r["n"]) for r in scored.filter(fit).groupBy("score").agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    wanted = sum(n for _, n in held) * share[0] // share[1]
    above, higher = [], 0
    for score, n in held:
        if higher >= wanted:
            break
        above.append((score, higher))
        higher += n
    offsets = scored.sparkSession.createDataFrame(above, "score long, _higher long")
    last = above[-1][0] if above else None
    low = F.lit(True) if last is None else ~fit | (F.col("score") < last)
    order = Window.partitionBy("score").orderBy(F.col("id").asc_nulls_last(), "n_features", "weight", "n_words")
    drawn = scored.filter(~low).withColumn("_place", F.row_number().over(order)).join(F.broadcast(offsets), "score")
    rank = (F.col("_higher") + F.col("_place")).cast("long")
    drawn = drawn.select(*scored.columns, F.when(rank <= wanted, rank).alias("rank"))
    return drawn.unionByName(scored.filter(low).withColumn("rank", F.lit(None).cast("long")))


def resample(
    docs: DataFrame, target: DataFrame, id: str = "doc_id", text: str = "text", target_text: str = "text",
    buckets: int = BUCKETS, most: int = MOST_WORDS, least_words: int = LEAST_WORDS, share: tuple[int, int] = SHARE, seed: int = SEED,
) -> DataFrame:
    """One row per document: id, n_features, weight, score and rank (null unless drawn).

    Words are runs of digits, letters a-z (A-Z count as a-z) and characters beyond ASCII;
    null and empty texts have none, and weight 0. Repeated rows are documents of their own
    with the same score. Without target texts all gains come from the documents alone. The
    id must be a whole number or null. An empty table gives an empty result; other
    columns are not read.
    """
    source = _as_vector(bucket_counts(docs, text, buckets, most), buckets)
    aim = _as_vector(bucket_counts(target, target_text, buckets, most), buckets)
    scored = stage(score_documents(docs, gains(source, aim), id, text, most, seed), "scored")
    return draw(scored, least_words, share).select(F.col("id").alias(id), "n_features", "weight", "score", "rank")
