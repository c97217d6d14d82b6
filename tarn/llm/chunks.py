"""Chunks of documents, fingerprints of their pieces, and questions between chunks.

Operators that look for equal pieces over the whole corpus share this scheme.
Documents are written once as chunks of a few MB, compressed. A chunk
hashes its pieces, keeps each hash once, and sends them to buckets by their leading
bits. A bucket, which holds a bounded number of fingerprints, is sorted by
itself in one task, and answers each chunk with a bit per fingerprint. So every
piece crosses the network as a few bytes, a piece found in a third of all
documents costs a bucket one entry per chunk, and no text is compared twice.

A chunk number is given when the chunks are written and stays with them, so a
task that runs again asks the same questions in the same order.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
import zstandard
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import column, small_join, text_of
from tarn.session import stage

# task functions travel with their code, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(sys.modules["tarn.llm.common"])

CHUNK_BYTES = 2 * 1024 * 1024
CHUNK_DOCUMENTS = 1 << 20
BUCKET_ENTRIES = 2_000_000
LEAST_BUCKETS = 64
_LEVEL = 6

CHUNKS = pa.schema(
    [("chunk", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("blob", pa.binary()), ("rest", pa.binary())]
)
QUESTIONS = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("keys", pa.binary()), ("more", pa.binary())])
ANSWERS = pa.schema([("chunk", pa.int64()), ("bucket", pa.int64()), ("bits", pa.binary())])


def spark_schema(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary", pa.string(): "string", pa.list_(pa.int64()): "array<long>"}
    return ", ".join(f"`{f.name}` {names[f.type]}" for f in schema)


def write_chunks(docs: DataFrame, id: str, text: str, chunk_bytes: int = CHUNK_BYTES, whole: bool = False) -> DataFrame:
    """Documents as chunks of about ``chunk_bytes``; a longer document is a chunk of its own.

    Null text is empty. The id must be a whole number or null. With ``whole``, ``rest``
    has all other columns, so that ``kept_rows`` can give the documents back.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        zip_ = zstandard.ZstdCompressor(level=_LEVEL)
        ids, texts, rest, total = [], [], [], 0

        def chunk():
            blob = zip_.compress(b"".join(texts))
            others = None
            if whole:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rest[0].schema) as writer:
                    for part in rest:
                        writer.write_batch(part)
                others = zip_.compress(sink.getvalue())
            return pa.RecordBatch.from_pylist(
                [{"chunk": number, "ids": list(ids), "sizes": [len(t) for t in texts], "blob": blob, "rest": others}], schema=CHUNKS
            )

        for batch in batches:
            first = 0  # of the rows of this batch that are not in a chunk yet
            for k, (one, data) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                if texts and (total + len(data) > chunk_bytes or len(texts) == CHUNK_DOCUMENTS):
                    rest.append(batch.slice(first, k - first).drop_columns(["text"]))
                    yield chunk()
                    number += 1
                    first, ids, texts, rest, total = k, [], [], [], 0
                ids.append(one)
                texts.append(data)
                total += len(data)
            rest.append(batch.slice(first).drop_columns(["text"]))
        if texts:
            yield chunk()

    picked = [column(id).cast("long").alias("id"), text_of(text).cast("binary").alias("text")]
    if whole:
        others = [column(c) for c in docs.columns if c != text]
        picked += [F.isnull(column(text)).alias("none"), *[c.alias(f"c{k}") for k, c in enumerate(others)]]
    return stage(docs.select(*picked).mapInArrow(pack, spark_schema(CHUNKS)), "chunks")


def kept_rows(chunks: DataFrame, gone: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """The documents of chunks that were written whole, but for those in ``gone`` (chunk and ``k``, lists of places)."""
    names, at = docs.columns, docs.columns.index(text)

    def run(batches):
        for row in rows_of(batches):
            stays = np.ones(len(row["sizes"]), dtype=bool)
            stays[np.asarray(row["k"] or [], dtype=np.int64)] = False
            if not stays.any():
                continue
            data, ends = opened(row)
            with pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(row["rest"], max_output_size=1 << 31)) as reader:
                rest = reader.read_all()
            texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(stays), [None, pa.py_buffer(ends), pa.py_buffer(data)])
            texts = pa.compute.if_else(rest.column("none").combine_chunks(), pa.scalar(None, pa.large_binary()), texts)
            columns = [rest.column(f"c{k}") for k in range(len(names) - 1)]
            columns.insert(at, pa.chunked_array([texts.cast(pa.string())]))
            yield from pa.table(columns, names=names).filter(pa.array(stays)).to_batches()

    return small_join(chunks, gone, ["chunk"]).mapInArrow(run, docs.schema)


def opened(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a chunk, and where its documents begin and the last one ends."""
    ends = np.concatenate([[0], np.cumsum(np.asarray(row["sizes"], dtype=np.int64))])
    data = zstandard.ZstdDecompressor().decompress(row["blob"], max_output_size=max(1, int(ends[-1])))
    return np.frombuffer(data, dtype=np.uint8), ends


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one at a time, so that one chunk is open at a time."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield {name: batch.column(name)[k].as_py() for name in batch.schema.names}


# Hashes join two neighbours at a time, with a shift between the products, so that no
# arithmetic identity of sums and powers makes structured texts agree. ``salt`` picks one
# of several independent functions; where a hash decides by itself, two are used.
_MULTIPLY = np.uint64(0xD6E8FEB86659FD93)
_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
_LONG_WORD = 512  # bytes; longer ones are hashed one by one


def mixed(h: np.ndarray) -> np.ndarray:
    h = np.asarray(h, dtype=np.uint64)
    h = (h ^ (h >> np.uint64(32))) * _MULTIPLY
    h = (h ^ (h >> np.uint64(32))) * _MULTIPLY
    return h ^ (h >> np.uint64(32))


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = a * _LEFT
    h ^= h >> np.uint64(29)
    h += b * _RIGHT
    h ^= h >> np.uint64(32)
    return h


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number; behind the end there are zeros."""
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    return np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit hash of the bytes of each word."""
    eight, sizes = eights(data), stops - starts
    out = mixed(sizes.astype(np.uint64) + np.uint64(salt << 32))
    left = np.flatnonzero(sizes <= _LONG_WORD)
    at, size, h = starts[left], sizes[left], out[left]
    while len(left):
        h = _joined(h, eight[at] & _MASKS[np.minimum(size, 8)])
        more = size > 8
        out[left[~more]] = h[~more]
        left, at, size, h = left[more], at[more] + 8, size[more] - 8, h[more]
    for k in np.flatnonzero(sizes > _LONG_WORD):
        out[k] = xxhash.xxh64_intdigest(data[starts[k] : stops[k]].tobytes(), salt)
    return mixed(out)


class Stretches:
    """Hashes of stretches of given sizes of a sequence, of bytes or of 64-bit values.

    Level k has the hashes of all stretches of 2**k values (of 8 x 2**k bytes); two that
    overlap make up any size between.
    """

    def __init__(self, values: np.ndarray, salt: int = 0):
        self.unit = 8 if values.dtype == np.uint8 else 1
        self.first = np.ascontiguousarray(eights(values)) if self.unit == 8 else values
        self.salt = np.uint64(salt << 32)
        self.levels = [mixed(self.first ^ self.salt) if salt else np.asarray(self.first, dtype=np.uint64)]

    def of(self, starts: np.ndarray, size: int) -> np.ndarray:
        """Hashes of the stretches of ``size`` from each start on, which must lie inside."""
        if size < self.unit:
            return mixed((self.first[starts] & _MASKS[size]) + np.uint64(size) + self.salt)
        k = (size // self.unit).bit_length() - 1
        while len(self.levels) <= k:
            last, step = self.levels[-1], self.unit << (len(self.levels) - 1)
            self.levels.append(_joined(last[:-step], last[step:]) if len(last) > step else last[:0])
        level, held = self.levels[k], self.unit << k
        h = level[starts] if held == size else _joined(level[starts], level[starts + (size - held)])
        return mixed(h + np.uint64(size))


def windows(ends: np.ndarray, size: int) -> np.ndarray:
    """Starts of all stretches of ``size`` that lie within one document."""
    if not len(ends) or ends[-1] < size:
        return np.zeros(0, dtype=np.int64)
    inside = np.zeros(int(ends[-1]) + 1, dtype=np.int64)
    lengths = np.diff(ends)
    fits = lengths >= size
    np.add.at(inside, ends[:-1][fits], 1)
    np.add.at(inside, ends[1:][fits] - size + 1, -1)
    return np.flatnonzero(np.cumsum(inside) > 0)


def held_buckets(sorted_keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that hold any of the sorted keys, and where each one's keys begin (and the last ones end)."""
    number = sorted_keys >> np.uint64(64 - (buckets.bit_length() - 1))
    first = np.flatnonzero(np.diff(number, prepend=np.uint64(0)).astype(bool))
    if len(number) and (not len(first) or first[0] != 0):
        first = np.concatenate([[0], first])
    return number[first].astype(np.int64), np.append(first, len(sorted_keys))


def packed(keys: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of each key; what lies above them partly follows from the bucket."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def unpacked(data: bytes, width: int) -> np.ndarray:
    raw = np.frombuffer(data, dtype=np.uint8).reshape(-1, width)
    out = np.zeros((len(raw), 8), dtype=np.uint8)
    out[:, :width] = raw
    return out.view("<u8").ravel()


def bucket_count(entries: float) -> int:
    """A power of two; a bucket is then a number of leading bits of the key."""
    return max(LEAST_BUCKETS, 1 << max(0, int(-(-entries // BUCKET_ENTRIES)) - 1).bit_length())


def questions(chunk: int, keys: np.ndarray, buckets: int, width: int, more: np.ndarray | None = None) -> pa.RecordBatch:
    """Sorted unique keys of a chunk, with a value each in ``more``, as one row per bucket that holds any."""
    held, edges = held_buckets(keys, buckets)
    runs = list(zip(edges[:-1], edges[1:]))
    return pa.RecordBatch.from_pydict(
        {
            "bucket": held,
            "chunk": [chunk] * len(held),
            "keys": [packed(keys[a:b], width) for a, b in runs],
            "more": [None if more is None else np.ascontiguousarray(more[a:b]).tobytes() for a, b in runs],
        },
        schema=QUESTIONS,
    )


def asked(chunks: DataFrame, ask: Callable[[dict], pa.RecordBatch]) -> DataFrame:
    def run(batches):
        for row in rows_of(batches):
            out = ask(row)
            if out.num_rows:
                yield out

    return chunks.mapInArrow(run, spark_schema(QUESTIONS))


def answered(rows: DataFrame, width: int, answer: Callable, more: str | None = None) -> DataFrame:
    """One sorted bucket at a time: ``answer(keys, chunk of each, more of each)`` gives a row of bits per key.

    Returns per chunk all its answers, as maps from bucket to packed bits.
    """

    def run(table: pa.Table) -> pa.Table:
        chunk = table.column("chunk").to_pylist()
        keys = [unpacked(k, width) for k in table.column("keys").to_pylist()]
        values = None
        if more is not None:
            values = np.concatenate([np.frombuffer(m, dtype=more) for m in table.column("more").to_pylist()])
        sizes = [len(k) for k in keys]
        bits = answer(np.concatenate(keys), np.repeat(np.asarray(chunk, dtype=np.int64), sizes), values)
        cuts = np.cumsum(sizes)[:-1]
        return pa.table(
            {
                "chunk": chunk,
                "bucket": table.column("bucket"),
                "bits": [np.packbits(part, axis=None).tobytes() for part in np.split(bits, cuts)],
            },
            schema=ANSWERS,
        )

    bits = rows.groupBy("bucket").applyInArrow(run, spark_schema(ANSWERS))
    # as many answers per chunk as there are buckets at most
    return bits.groupBy("chunk").agg(F.map_from_entries(F.collect_list(F.struct("bucket", "bits"))).alias("bits"))


def bits_of(answers: list | dict | None, keys: np.ndarray, buckets: int, per_key: int) -> np.ndarray:
    """A chunk's answers in the order of its sorted keys, ``per_key`` bits each."""
    held, edges = held_buckets(keys, buckets)
    out = np.zeros((len(keys), per_key), dtype=bool)
    answers = dict(answers or {})
    for bucket, a, b in zip(held.tolist(), edges[:-1], edges[1:]):
        if bucket in answers:
            found = np.unpackbits(np.frombuffer(answers[bucket], dtype=np.uint8), count=int(b - a) * per_key)
            out[a:b] = found.reshape(-1, per_key)
    return out


def with_answers(chunks: DataFrame, answers: DataFrame) -> DataFrame:
    """Chunks with their answers; a chunk without questions has none. A sort-merge join at every size."""
    return chunks.join(answers.hint("merge"), "chunk", "left")


def total_bytes(chunks: DataFrame) -> int:
    sizes = F.aggregate("sizes", F.lit(0).cast("long"), lambda total, x: total + x)
    return chunks.select(F.sum(sizes)).first()[0] or 0


def groups_of_equal(keys: np.ndarray, second: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal keys together, and for each place in it the number of its group.

    With ``second``, keys are equal if both parts are.
    """
    order = np.argsort(keys, kind="stable") if second is None else np.lexsort((second, keys))
    new = np.ones(len(keys), dtype=bool)
    for part in [keys] if second is None else [keys, second]:
        ordered = part[order]
        new[1:] &= ordered[1:] == ordered[:-1]
    new[1:] = ~new[1:]
    return order, np.cumsum(new) - 1


def covered(starts: np.ndarray, size: int, total: int) -> np.ndarray:
    """Which of ``total`` places a stretch of ``size`` from one of the starts covers."""
    step = np.zeros(total + 1, dtype=np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + size, total), -1)
    return np.cumsum(step[:-1]) > 0


def split_words(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and where the words of each document begin (and the last ones end)."""
    space = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = ~space
    first = inside[1:-1] & ~inside[:-2]
    last = inside[1:-1] & ~inside[2:]
    # a document's first word begins where the document does, whatever stands before it
    edges = ends[(ends > 0) & (ends < len(data))]
    first[edges] |= ~space[edges]
    last[edges - 1] |= ~space[edges - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, ends)
