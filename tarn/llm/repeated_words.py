"""Removal of repeated word sequences, by fixed-block anchors.

A window is ``length`` consecutive words. It goes if its words also start
earlier: in a document with a smaller id, or before it in the same one.

1. Index: every document is cut into non-overlapping reference blocks of half the
   length, so that each window holds one whole block. Probe: every rolling stretch
   of a block's size asks whether it equals a reference block elsewhere. Two equal
   windows each hold a block, which the other one's stretch at the same distance
   meets; so a window can only repeat if a stretch of its first words is a hit.
2. Extend: the windows around hits are joined to maximal runs of candidates. Each
   window of a run asks for the first place with its words, in the order of
   documents; the windows that are not first are the exact repeats, and their union
   is what is removed.

Probes are 4 bytes of a hash, which may let a window through for nothing. What decides
a removal is 128 bits: two independent hashes of the words of a window. See ``chunks`` for how buckets and hot windows stay small.
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from tarn.llm.chunks import (
    Stretches, answered, asked, bits_of, bucket_count, covered, groups_of_equal, opened, questions, rows_of,
    spark_schema, split_words, total_bytes, windows, with_answers, word_hashes, write_chunks,
)
from tarn.session import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LENGTH = 20
_PROBE_BYTES = 4
_LAST = np.iinfo(np.int64).max  # the place of documents without an id
_MORE = np.dtype([("other", "<u8"), ("place", "<i8")])

RESULT = pa.schema(
    [("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())]
)


class _Chunk:
    """The words of a chunk; each step derives them anew from the bytes."""

    def __init__(self, row: dict, length: int):
        self.data, byte_ends = opened(row)
        self.starts, self.stops, self.ends = split_words(self.data, byte_ends)
        # a probe needs one hash; what decides a removal needs two that know nothing of each other
        self.prints = Stretches(word_hashes(self.data, self.starts, self.stops))
        self.length, self.block = length, (length + 1) // 2
        self.order = np.array([_LAST if i is None else i for i in row["ids"]], dtype=np.int64)
        self.row = row

    def doc_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, places, side="right") - 1

    def probes(self) -> np.ndarray:
        """Unique keys of all rolling stretches; ``held``: in how many reference blocks, up to two."""
        self.places = windows(self.ends, self.block)
        keys, self.key_of = np.unique(self.prints.of(self.places, self.block), return_inverse=True)
        self.reference = (self.places - self.ends[self.doc_of(self.places)]) % self.block == 0
        self.held = np.minimum(np.bincount(self.key_of[self.reference], minlength=len(keys)), 2).astype(np.uint8)
        self.keys = keys
        return keys

    def candidates(self, indexed: np.ndarray) -> np.ndarray:
        """Starts of the windows around hits. ``indexed``: is the key in one reference block, in two."""
        mine = indexed[self.key_of]
        hits = self.places[np.where(self.reference, mine[:, 1], mine[:, 0])]
        near = np.zeros(len(self.starts) + 1, dtype=np.int32)
        np.add.at(near, np.maximum(hits - (self.length - self.block), 0), 1)
        np.add.at(near, hits + 1, -1)
        starts = windows(self.ends, self.length)
        return starts[np.cumsum(near)[starts] > 0]

    def window_keys(self, starts: np.ndarray):
        """Unique keys in two parts, the key of each window, and for each key its first window in the order of documents."""
        places = self.order[self.doc_of(starts)]
        by_place = np.lexsort((starts, places))
        second = Stretches(word_hashes(self.data, self.starts, self.stops, 1), 1)
        keys, others = self.prints.of(starts[by_place], self.length), second.of(starts[by_place], self.length)
        order, group = groups_of_equal(keys, others)  # stable: the first of a group is first by place
        back = np.empty(len(starts), dtype=np.int64)
        back[by_place[order]] = group
        first = order[np.flatnonzero(np.diff(group, prepend=-1))]
        return keys[first], others[first], back, by_place[first], places[by_place[first]]


def _indexed(keys: np.ndarray, chunk: np.ndarray, held: np.ndarray) -> np.ndarray:
    order, group = groups_of_equal(keys)
    blocks = np.bincount(group, weights=held[order])[group]
    out = np.zeros((len(keys), 2), dtype=bool)
    out[order, 0], out[order, 1] = blocks >= 1, blocks >= 2
    return out


def _earlier(keys: np.ndarray, chunk: np.ndarray, more: np.ndarray) -> np.ndarray:
    """Does another chunk have the key at an earlier document; rows with one id are in the order of their chunks."""
    order = np.lexsort((chunk, more["place"], more["other"], keys))
    out = np.ones((len(keys), 1), dtype=bool)
    first = np.ones(len(keys), dtype=bool)
    first[1:] = (keys[order][1:] != keys[order][:-1]) | (more["other"][order][1:] != more["other"][order][:-1])
    out[order[first], 0] = False
    return out


def remove_repeated_words(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per document: id, n_words, n_removed, kept_sha256 and kept (the words that stay, joined by a space).

    Null text has no words; a null id comes last, and rows with the same id are
    ordered as they were read. All windows are judged on the input. An empty table
    gives an empty result; other columns are not read.
    """
    chunks = write_chunks(docs, id, text)
    total = total_bytes(chunks)
    # a word and the space behind it take two bytes at least
    n_probes, n_windows = bucket_count(total / 4), bucket_count(total / 8)

    def ask_probes(row):
        c = _Chunk(row, length)
        return questions(row["chunk"], c.probes(), n_probes, _PROBE_BYTES, c.held)

    def known(row):
        c = _Chunk(row, length)
        starts = c.candidates(bits_of(row["probes"], c.probes(), n_probes, 2))
        return c, starts, *c.window_keys(starts)

    def ask_windows(row):
        _, _, keys, others, _, _, places = known(row)
        more = np.empty(len(keys), dtype=_MORE)
        more["other"], more["place"] = others, places
        return questions(row["chunk"], keys, n_windows, 8, more)

    def decide(batches):
        for row in rows_of(batches):
            c, starts, keys, _, key_of, first, _ = known(row)
            # a window stays if it is the first of its chunk and no other chunk has an earlier one
            repeats = np.ones(len(starts), dtype=bool)
            repeats[first] = bits_of(row["windows"], keys, n_windows, 1)[:, 0]
            gone = covered(starts[repeats], length, len(c.starts))
            out = []
            for k, one in enumerate(row["ids"]):
                words = range(int(c.ends[k]), int(c.ends[k + 1]))
                kept = b" ".join(c.data[c.starts[w] : c.stops[w]].tobytes() for w in words if not gone[w])
                removed = int(gone[words.start : words.stop].sum())
                out.append(
                    {"id": one, "n_words": len(words), "n_removed": removed, "kept_sha256": hashlib.sha256(kept).hexdigest(), "kept": kept}
                )
            yield pa.RecordBatch.from_pylist(out, schema=RESULT)

    probes = stage(answered(asked(chunks, ask_probes), _PROBE_BYTES, _indexed, "u1").withColumnRenamed("bits", "probes"), "probes")
    found = answered(asked(with_answers(chunks, probes), ask_windows), 8, _earlier, _MORE).withColumnRenamed("bits", "windows")
    done = with_answers(chunks, probes.join(found, "chunk", "left")).mapInArrow(decide, spark_schema(RESULT))
    return done.withColumnRenamed("id", id)
