"""Alignment of two tokenizers over a corpus, each distinct text once.

Tokens of a byte-level tokenizer (A) and of a piece tokenizer (B) cover the same
bytes, a space and then the text. Where tokens of both end, the bytes are cut into
groups; tokens whose bytes overlap are linked. How often two ids are linked in the
whole corpus says how well a link fits.

1. Texts are shuffled in full and grouped by equality, which Spark combines on the map
   side first; so a text that a third of all rows hold is tokenised once, and its
   links count as often as it occurs.
2. A task tokenises and aligns its texts and writes them as chunks: what can be said of
   a text alone, its pairs of ids as places in the sorted list of the chunk's distinct
   pairs, and that list with its counts.
3. The lists are summed over all chunks; the highest count of each B id follows, over
   at most as many pairs as A has ids.
4. A chunk asks for the counts of its distinct pairs, by a shuffled join, and finishes
   the measures of its texts. Nothing is broadcast but the two tokenizers.
5. Measures go to the documents by the SHA-256 of the text, with hot texts spread.
"""

from __future__ import annotations

import hashlib
import json
import sys

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarn.functions.skew import salted_join
from tarn.llm.batches import portions
from tarn.llm.common import column, worker_memo
from tarn.session import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(sys.modules["tarn.llm.common"])

CHUNK_BYTES = 4 << 20  # of text
_PAIR_BITS = 40  # of a pair of ids; 23 are left for the texts of a portion
_MARK = "▁"  # how pieces write a space

# fixed value: the published pattern of byte-level BPE, which cuts a text before merges
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
CHUNKS = pa.schema(
    [("chunk", pa.int64()), ("keys", pa.binary()), ("groups", pa.list_(pa.string())), ("pairs", pa.binary()),
     ("counts", pa.binary()), ("texts", pa.binary())]
)
PAIRS = pa.schema([("chunk", pa.int64()), ("pair", pa.int64()), ("n", pa.int64())])
RESULT = pa.schema([("key", pa.binary()), *[(m, pa.int64()) for m in MEASURES], ("groups_sha256", pa.string())])
_CHUNKS = "chunk long, keys binary, groups array<string>, pairs binary, counts binary, texts binary"
_PAIRS = "chunk long, pair long, n long"
_RESULT = "key binary, " + ", ".join(f"{m} long" for m in MEASURES) + ", groups_sha256 string"


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable bytes
    stand for themselves, the others follow in order from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteTokens:
    """Tokenizer A, from the text of its file (JSON): ids of a text, and the bytes of each id.

    Where the ids are in the order of the merges, as ranks are, the merges are done by
    ``tiktoken``, which is faster; else by ``tokenizers``.
    """

    def __init__(self, source: str):
        model = json.loads(source)["model"]
        of = byte_alphabet()
        self.pieces = [b""] * (max(model["vocab"].values()) + 1)
        for piece, number in model["vocab"].items():
            if all(c in of for c in piece):
                self.pieces[number] = bytes(of[c] for c in piece)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ranked = all(model["vocab"].get(a + b) == 256 + k for k, (a, b) in enumerate(merges))
        if ranked:
            import tiktoken

            ranks = {self.pieces[k]: k for k in range(256 + len(merges))}
            self.encode = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        else:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_str(source)
            tokenizer.encode_special_tokens = True
            self.encode = lambda text: tokenizer.encode(text, add_special_tokens=False).ids

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [self.encode(" " + t) for t in texts]


class PieceTokens:
    """Tokenizer B, from the bytes of its model, which adds the space itself."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.pieces = []
        for k in range(self.processor.get_piece_size()):
            piece = self.processor.id_to_piece(k)
            self.pieces.append(bytes([int(piece[3:5], 16)]) if self.processor.is_byte(k) else piece.replace(_MARK, " ").encode())

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.processor.encode(texts, num_threads=1)


class _Ends:
    """Ends of stretches that cover bytes 1 to ``total``: at which there is one, and how many until there."""

    def __init__(self, ends: np.ndarray, total: int):
        self.mark = np.zeros(total + 1, dtype=bool)
        self.mark[ends] = True
        self.count = np.cumsum(self.mark, dtype=np.int64)

    def before(self, at: np.ndarray) -> np.ndarray:
        """How many end before a place, which is the number of the stretch that holds its byte."""
        return self.count[at] - self.mark[at]


class Aligner:
    """Aligns texts; made once per worker."""

    def __init__(self, byte_source: str, piece_model: bytes):
        self.a, self.b = ByteTokens(byte_source), PieceTokens(piece_model)
        self.size_a = np.array([len(p) for p in self.a.pieces], dtype=np.int64)
        self.size_b = np.array([len(p) for p in self.b.pieces], dtype=np.int64)
        if len(self.size_a) * len(self.size_b) >= 1 << _PAIR_BITS:
            raise ValueError("the vocabularies have too many pairs")
        # what a token adds to the written groups: its id, and what stands behind it
        numbers_a, numbers_b = range(len(self.a.pieces)), range(len(self.b.pieces))
        self.words = [f"{k},".encode() for k in numbers_a] + [f"{k}|".encode() for k in numbers_a]
        self.words += [f"{k},".encode() for k in numbers_b] + [f"{k};".encode() for k in numbers_b]

    def align(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """(n_a, n_b, n_groups) per text, the digests of its groups, and the text and the pair (A id x size of B + B id) of every link."""
        tokens_a, tokens_b = self.a.ids(texts), self.b.ids(texts)
        counts = np.zeros((len(texts), 3), dtype=np.int64)
        digests = [""] * len(texts)
        piece_a, piece_b = self.a.pieces.__getitem__, self.b.pieces.__getitem__
        good = []
        for k, text in enumerate(texts):
            whole = b" " + text.encode()
            if text and b"".join(map(piece_a, tokens_a[k])) == whole and b"".join(map(piece_b, tokens_b[k])) == whole:
                good.append(k)
        if not good:
            return counts, digests, np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        number = np.array(good)
        n_a, n_b = (np.array([len(t[k]) for k in good]) for t in (tokens_a, tokens_b))
        a = np.concatenate([np.array(tokens_a[k], dtype=np.int64) for k in good])
        b = np.concatenate([np.array(tokens_b[k], dtype=np.int64) for k in good])
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        last_a, last_b = np.cumsum(n_a), np.cumsum(n_b)
        whole = end_a[last_a - 1]  # ends of the texts, the same in both
        ends_a, ends_b, ends = (_Ends(e, int(whole[-1])) for e in (end_a, end_b, whole))

        # every end of either kind closes one link: that of the two tokens around it
        cuts = np.flatnonzero(ends_a.mark | ends_b.mark)
        link = a[ends_a.before(cuts)] * len(self.size_b) + b[ends_b.before(cuts)]
        text_of = number[ends.before(cuts)]

        common = _Ends(np.flatnonzero(ends_a.mark & ends_b.mark), int(whole[-1]))
        counts[number] = np.stack([n_a, n_b, np.diff(common.count[whole], prepend=0)], axis=1)

        # all tokens in the order in which groups are written: A's of a group, then B's
        words = np.empty(len(a) + len(b), dtype=np.int64)
        closes_a, closes_b = common.mark[end_a], common.mark[end_b]
        # tokens up to the end of each group
        until_a, until_b = np.flatnonzero(closes_a) + 1, np.concatenate([[0], np.flatnonzero(closes_b) + 1])
        words[np.arange(len(a)) + until_b[common.before(end_a)]] = a + len(self.size_a) * closes_a
        words[np.arange(len(b)) + until_a[common.before(end_b)]] = 2 * len(self.size_a) + b + len(self.size_b) * closes_b
        word, bounds = self.words.__getitem__, np.concatenate([[0], last_a + last_b])
        for i, k in enumerate(good):
            written = b"".join(map(word, words[bounds[i] : bounds[i + 1]].tolist()))
            digests[k] = hashlib.sha256(written[:-1]).hexdigest()
        return counts, digests, text_of, link


class _Texts:
    """Aligned texts of one chunk, gathered."""

    def __init__(self, b_ids: int):
        self.keys, self.times, self.groups, self.counts = [], [], [], []
        self.b_ids = b_ids
        self.text, self.link, self.n, self.size = [], [], [], 0

    def add(self, texts: list[str], times: list[int], aligned) -> None:
        counts, digests, text_of, link = aligned
        # equal links of a text become one with a count
        both = np.sort((text_of << _PAIR_BITS) | link)
        new = np.ones(len(both), dtype=bool)
        new[1:] = both[1:] != both[:-1]
        at = np.flatnonzero(new)
        self.text.append((both[at] >> _PAIR_BITS) + len(self.keys))
        self.link.append(both[at] & ((1 << _PAIR_BITS) - 1))
        self.n.append(np.diff(at, append=len(both)))
        data = [t.encode() for t in texts]
        self.keys += [hashlib.sha256(d).digest() for d in data]
        self.size += sum(map(len, data))
        self.times += times
        self.groups += digests
        self.counts.append(counts)

    def row(self, chunk: int) -> pa.RecordBatch:
        text, link, n = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (self.text, self.link, self.n))
        pairs, place = np.unique(link, return_inverse=True)
        totals = np.zeros(len(pairs), dtype=np.int64)
        np.add.at(totals, place, n * np.array(self.times, dtype=np.int64)[text])
        pairs = (pairs // self.b_ids << 32) | (pairs % self.b_ids)
        held = np.bincount(text, minlength=len(self.keys))
        texts = [np.concatenate(self.counts).astype("<i8"), held.astype("<i8"), place.astype("<u4"), n.astype("<u4")]
        return pa.RecordBatch.from_pydict(
            {
                "chunk": [chunk], "keys": [b"".join(self.keys)], "groups": [self.groups], "pairs": [pairs.astype("<i8").tobytes()],
                "counts": [totals.astype("<i8").tobytes()], "texts": [zstandard.compress(b"".join(x.tobytes() for x in texts), 3)],
            },
            schema=CHUNKS,
        )


def _finish(row: dict, n: np.ndarray, best: np.ndarray) -> pa.Table:
    """The measures of a chunk's texts from the corpus-wide counts of its pairs, in their order."""
    many = len(row["groups"])
    raw = zstandard.decompress(row["texts"])
    counts = np.frombuffer(raw, dtype="<i8", count=3 * many).reshape(many, 3)
    held = np.frombuffer(raw, dtype="<i8", count=many, offset=24 * many)
    rest = np.frombuffer(raw, dtype="<u4", offset=32 * many).reshape(2, -1)
    place, times = rest[0].astype(np.int64), rest[1].astype(np.int64)
    of = np.repeat(np.arange(many), held)
    out = np.zeros((3, many), dtype=np.int64)
    np.add.at(out[0], of, times)
    np.add.at(out[1], of, times * best[place])
    np.add.at(out[2], of, times * n[place])
    measures = [*counts.T, *out]
    keys = [row["keys"][32 * k : 32 * k + 32] for k in range(many)]
    return pa.table(
        {"key": keys, **{m: v for m, v in zip(MEASURES, measures)}, "groups_sha256": row["groups"]}, schema=RESULT
    )


def align_tokens(
    docs: DataFrame, byte_tokenizer: str, piece_tokenizer: str, id: str = "doc_id", text: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    ``byte_tokenizer`` is the path of a byte-level BPE in JSON (A), ``piece_tokenizer``
    that of a piece model (B); strings of special tokens are plain text. ``n_best``
    counts links whose count is the highest of their B id, ``count_sum`` adds the counts
    of all links, and both count over all documents, repeated rows included. A null or
    empty text, and one whose tokens do not give back a space and the text, has zeros
    and an empty ``groups_sha256``. The id must be a whole number or null. An empty
    table gives an empty result; other columns are not read.
    """
    context = docs.sparkSession.sparkContext
    with open(byte_tokenizer, encoding="utf-8") as a, open(piece_tokenizer, "rb") as b:
        files = context.broadcast((a.read(), b.read()))  # two vocabularies, whatever the input
    picked = docs.select(column(id).cast("long").alias("id"), column(text).alias("text"))
    distinct = picked.filter("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("times"))

    def describe(batches):
        memo = worker_memo("aligners")
        known = hash(files.value)
        if known not in memo:
            memo[known] = Aligner(*files.value)
        aligner = memo[known]
        number, texts = TaskContext.get().partitionId() << 32, _Texts(len(aligner.size_b))
        for batch in batches:
            for part in portions(batch, "text"):
                given = part.column("text").to_pylist()
                texts.add(given, part.column("times").to_pylist(), aligner.align(given))
                if texts.size >= chunk_bytes:
                    yield texts.row(number)
                    number, texts = number + 1, _Texts(len(aligner.size_b))
        if texts.keys:
            yield texts.row(number)

    aligned = stage(distinct.mapInArrow(describe, _CHUNKS), "aligned")

    def listed(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                pairs, counts = (np.frombuffer(batch.column(c)[k].as_py(), dtype="<i8") for c in ("pairs", "counts"))
                chunk = np.full(len(pairs), batch.column("chunk")[k].as_py(), dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(chunk), pa.array(pairs), pa.array(counts)], schema=PAIRS)

    asked = aligned.select("chunk", "pairs", "counts").mapInArrow(listed, _PAIRS)
    total = asked.groupBy("pair").agg(F.sum("n").alias("n"))
    # as many pairs per B id as A has ids at most
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)))
    total = stage(total.withColumn("best", F.col("n") == F.max("n").over(of_b)), "pairs")

    def finish(chunks: pa.Table, answers: pa.Table) -> pa.Table:
        row = {c: chunks.column(c)[0].as_py() for c in ("keys", "groups", "texts")}
        order = np.argsort(answers.column("pair").to_numpy())
        n, best = (answers.column(c).to_numpy()[order].astype(np.int64) for c in ("n", "best"))
        return _finish(row, n, best)

    # a pair is asked for once per chunk, so no pair has a share of the rows worth splitting
    answers = asked.select("chunk", "pair").join(total.hint("merge"), "pair")
    texts = aligned.select("chunk", "keys", "groups", "texts")
    measured = texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(finish, _RESULT)

    # documents to texts
    wanted = F.when(F.col("text") != "", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    keyed = stage(picked.select("id", wanted.alias("key")), "keyed")
    joined = salted_join(keyed, measured, ["key"])
    zeros = [F.coalesce(m, F.lit(0).cast("long")).alias(m) for m in MEASURES]
    return joined.select(F.col("id").alias(id), *zeros, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
