"""Removal of repeated substrings, by cover samples and buckets of suffixes.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere
else. That is a question about suffixes that agree on ``length`` bytes, and the
suffixes of a corpus are too many to sort. As in difference-cover suffix
sorting, a sample decides first: places whose offset in the document, modulo
``period``, is in a difference cover. Any two places of a corpus have a distance
below the period after which both are in the sample. So two suffixes that agree
on ``length`` bytes have sample places, at one distance from them, whose next
``length - period + 1`` bytes agree.

1. Rank the sample: blocks of that length are sorted bucket by bucket, and a block
   learns whether it has an equal one. A suffix stays a candidate if a block with
   an equal one starts within its first ``period`` bytes. Whole documents that
   occur twice are found on the way, and one of each speaks for all.
2. Sort the candidate suffixes, one bucket at a time, by their first ``period - 1``
   bytes and, for ties of that length, by the rank of the block behind them.
   Suffixes that tie on both agree on ``length`` bytes.

Only agreement counts, not the order of unequal suffixes, so keys are 64-bit
fingerprints of the bytes rather than the bytes, and what crosses the network is
4 bytes per sample place and 7 per candidate. See ``chunks`` for how hot
strings stay small.
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from tarn.llm.chunks import (
    Stretches, answered, asked, bits_of, bucket_count, covered, groups_of_equal, mixed, opened, questions, rows_of,
    spark_schema, total_bytes, windows, with_answers, write_chunks,
)
from tarn.session import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LENGTH = 200
# fixed values: perfect difference sets, whose differences give every remainder once
COVERS = {7: (0, 1, 3), 13: (0, 1, 3, 9), 31: (0, 1, 3, 8, 12, 18), 91: (0, 1, 3, 9, 27, 49, 56, 61, 77, 81)}
PERIOD = 91
_SAMPLE_BYTES, _SUFFIX_BYTES = 4, 7

RESULT = pa.schema(
    [("id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
     ("kept_sha256", pa.string()), ("kept", pa.binary())]
)


class _Chunk:
    """What the steps look at in one chunk; each step derives it anew from the bytes."""

    def __init__(self, row: dict, length: int, period: int):
        self.data, self.ends = opened(row)
        self.length, self.period = length, period
        self.prints = Stretches(self.data)
        self.block = length - period + 1

    def sample(self) -> np.ndarray:
        """Keys of the blocks that start at the places of the cover."""
        starts = windows(self.ends, self.block)
        origin = self.ends[np.searchsorted(self.ends, starts, side="right") - 1]
        in_cover = np.zeros(self.period, dtype=bool)
        in_cover[list(COVERS[self.period])] = True
        self.samples = starts[in_cover[(starts - origin) % self.period]]
        self.keys, self.key_of, self.times = np.unique(
            self.prints.of(self.samples, self.block), return_inverse=True, return_counts=True
        )
        return self.keys

    def documents(self) -> np.ndarray:
        """Keys of the whole documents that could hold a string of the length; ``other`` is their second half."""
        self.docs = np.flatnonzero(np.diff(self.ends) >= self.length)
        digests = [xxhash.xxh3_128_digest(self.data[self.ends[d] : self.ends[d + 1]]) for d in self.docs]
        halves = np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 2)
        order, group = groups_of_equal(halves[:, 0], halves[:, 1])
        self.first_doc = order[np.flatnonzero(np.diff(group, prepend=-1))]
        self.doc_key_of = np.empty(len(order), dtype=np.int64)
        self.doc_key_of[order] = group
        self.doc_times = np.bincount(group, minlength=len(self.first_doc))
        self.other = halves[self.first_doc, 1]
        return halves[self.first_doc, 0]

    def copies(self, elsewhere: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents that occur twice, and those for which another speaks. ``elsewhere``: any, earlier."""
        twice = (self.doc_times > 1) | elsewhere[:, 0]
        speaks = np.zeros(len(self.docs), dtype=bool)
        speaks[self.first_doc] = ~elsewhere[:, 1]
        return self.docs[twice[self.doc_key_of]], self.docs[~speaks]

    def candidates(self, repeated: np.ndarray, silent: np.ndarray) -> np.ndarray:
        """Starts of suffixes that may agree with another one on the whole length."""
        hit = self.samples[((self.times > 1) | repeated)[self.key_of]]
        # a block that starts at p speaks for the suffixes that start at most a period before it
        near = np.zeros(len(self.data) + 1, dtype=np.int32)
        np.add.at(near, np.maximum(hit - self.period + 1, 0), 1)
        np.add.at(near, hit + 1, -1)
        starts = windows(self.ends, self.length)
        quiet = np.zeros(len(self.ends), dtype=bool)
        quiet[silent] = True
        of = np.searchsorted(self.ends, starts, side="right") - 1
        return starts[(np.cumsum(near)[starts] > 0) & ~quiet[of]]

    def suffix_keys(self, starts: np.ndarray) -> np.ndarray:
        head = self.prints.of(starts, self.period - 1)
        rank = self.prints.of(starts + self.period - 1, self.block)
        return mixed(head + rank * np.uint64(3))


def _elsewhere(keys: np.ndarray, chunk: np.ndarray, second: np.ndarray | None) -> np.ndarray:
    """Per key: does another chunk have it, and does one with a smaller number."""
    order, group = groups_of_equal(keys, second)
    counts = np.bincount(group)
    least = np.full(len(counts), np.iinfo(np.int64).max)
    np.minimum.at(least, group, chunk[order])
    out = np.zeros((len(keys), 2), dtype=bool)
    out[order, 0] = counts[group] > 1
    out[order, 1] = chunk[order] > least[group]
    return out


def remove_repeats(
    docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH, period: int = PERIOD
) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the bytes that stay).

    Texts are UTF-8 bytes, null is empty; strings do not cross documents, overlaps
    count, and all strings are judged on the input. Removed runs may end within a
    character, so what stays is bytes. Repeated rows are documents of their own. An
    empty table gives an empty result; other columns are not read.
    """
    chunks = write_chunks(docs, id, text)
    total = total_bytes(chunks)
    n_samples = bucket_count(total * len(COVERS[period]) / period)
    n_suffixes = bucket_count(total / 4)

    def ask_samples(row):
        c = _Chunk(row, length, period)
        return questions(row["chunk"], c.sample(), n_samples, _SAMPLE_BYTES)

    def ask_documents(row):
        c = _Chunk(row, length, period)
        return questions(row["chunk"], c.documents(), n_samples, 8, c.other)

    def any_elsewhere(keys, chunk, more):
        return _elsewhere(keys, chunk, more)[:, :1]

    samples = answered(asked(chunks, ask_samples), _SAMPLE_BYTES, any_elsewhere)
    whole = answered(asked(chunks, ask_documents), 8, _elsewhere, "<u8")
    first = stage(
        samples.withColumnRenamed("bits", "samples").join(whole.withColumnRenamed("bits", "whole"), "chunk", "full"), "ranks"
    )

    def known(row):
        c = _Chunk(row, length, period)
        copied, silent = c.copies(bits_of(row["whole"], c.documents(), n_samples, 2))
        starts = c.candidates(bits_of(row["samples"], c.sample(), n_samples, 1)[:, 0], silent)
        keys, key_of, times = np.unique(c.suffix_keys(starts), return_inverse=True, return_counts=True)
        return c, copied, starts, keys, key_of, times

    def ask_suffixes(row):
        keys = known(row)[3]
        return questions(row["chunk"], keys, n_suffixes, _SUFFIX_BYTES)

    def decide(batches):
        for row in rows_of(batches):
            c, copied, starts, keys, key_of, times = known(row)
            again = (times > 1) | bits_of(row["suffixes"], keys, n_suffixes, 1)[:, 0]
            gone = covered(starts[again[key_of]], length, len(c.data))
            for d in copied:
                gone[c.ends[d] : c.ends[d + 1]] = True
            out = []
            for k, one in enumerate(row["ids"]):
                mine, data = gone[c.ends[k] : c.ends[k + 1]], c.data[c.ends[k] : c.ends[k + 1]]
                kept = data[~mine].tobytes()
                spans = int(np.count_nonzero(mine[1:] & ~mine[:-1])) + int(len(mine) > 0 and mine[0])
                out.append(
                    {"id": one, "n_bytes": len(mine), "n_removed": int(mine.sum()), "n_spans": spans,
                     "kept_sha256": hashlib.sha256(kept).hexdigest(), "kept": kept}
                )
            yield pa.RecordBatch.from_pylist(out, schema=RESULT)

    suffixes = answered(asked(with_answers(chunks, first), ask_suffixes), _SUFFIX_BYTES, any_elsewhere)
    second = first.join(suffixes.withColumnRenamed("bits", "suffixes"), "chunk", "left")
    done = with_answers(chunks, second).mapInArrow(decide, spark_schema(RESULT))
    return done.withColumnRenamed("id", id)
