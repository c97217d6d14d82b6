"""Token ids of documents, cut into pieces of bounded length."""

from __future__ import annotations

import json
import re
import sys
import zlib

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.llm.alignment import byte_alphabet
from tarn.llm.chunks import spark_schema
from tarn.llm.common import column, text_of, worker_memo
from tarn.session import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(sys.modules["tarn.llm.common"])
cloudpickle.register_pickle_by_value(sys.modules["tarn.llm.chunks"])

END = 0
KNOWN_WORDS = 300_000  # and as many parts, of one worker; beyond it the memo starts anew
_MARK = "\x01"

PIECES = pa.schema(
    [("id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())]
)


# How a tokenizer file says that it folds and cuts texts in the way that
# ``_PARTS`` does, and the signs for which Python's folding and cutting surely agree
# with it: printable ASCII and the letters of Latin-1.
_FOLDS = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_CUT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
_PLAIN = re.compile("[\x21-\x7eÀ-ÖØ-öø-ÿ]+")


class WordIds:
    """Ids of words as little-endian 32-bit bytes, by the tokenizer, remembered by word.

    The tokenizer must drop white space and treat what lies between it by itself; then
    the ids of a text are those of its words one after the other. Where its file folds
    and cuts as expected, plain words are cut here, and only parts that are new go to
    its merges; other new words are encoded together with a mark between them, whose
    single id shows where each ends.
    """

    def __init__(self, vocabulary: str, memo: dict):
        from tokenizers import Tokenizer

        if "tokenizer" not in memo:
            memo["tokenizer"] = Tokenizer.from_str(vocabulary)
            memo["cuts"] = self._cuts(json.loads(vocabulary))
        self.tokenizer, self.cuts = memo["tokenizer"], memo["cuts"]
        self.words = memo.setdefault("words", {})
        self.parts = memo.setdefault("parts", {})
        self.mark = self._ids([_MARK])[0]
        alphabet = {byte: sign for sign, byte in byte_alphabet().items()}
        self.signs = [alphabet[b] for b in range(256)]
        if "four" not in memo:
            memo["four"] = [k.to_bytes(4, "little") for k in range(self.tokenizer.get_vocab_size())]
        self.four = memo["four"]

    @staticmethod
    def _cuts(file: dict) -> bool:
        """Whether the file says that ``_PARTS`` are the parts of a plain word in lower case."""
        steps = (file.get("pre_tokenizer") or {}).get("pretokenizers") or [{}, {}]
        split, bytes_ = steps[0], steps[-1]
        return (
            file.get("normalizer") == _FOLDS and len(steps) == 2
            and (split.get("type"), split.get("pattern"), split.get("invert"), split.get("behavior")) == ("Split", {"Regex": _CUT}, True, "Removed")
            and (bytes_.get("type"), bytes_.get("use_regex"), bytes_.get("add_prefix_space")) == ("ByteLevel", False, False)
            and not any(_PLAIN.fullmatch(t["content"]) and not t.get("special") for t in file.get("added_tokens", []))
        )

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _part(self, part: str) -> bytes:
        written = part if part.isascii() else "".join(map(self.signs.__getitem__, part.encode()))
        four = self.four
        ids = b"".join([four[t.id] for t in self.tokenizer.model.tokenize(written)])
        self.parts[part] = ids
        return ids

    def _learn(self, words: set[bytes], keep: bool = False) -> bool:
        """Whether the memo started anew, so that words known before may be missing; with ``keep`` it does not."""
        anew = not keep and len(self.words) + len(words) > KNOWN_WORDS
        if anew:
            self.words.clear()
        if len(self.parts) > KNOWN_WORDS:
            self.parts.clear()
        others = []
        for word in words:
            text = word.decode()
            if self.cuts and text.isascii() and (text.isalpha() or (text[-1] in ".," and text[:-1].isalpha())):
                # letters, perhaps with a stop behind them: the most frequent kind
                cut = (text.lower(),) if text[-1].isalpha() else (text[:-1].lower(), text[-1])
                self.words[word] = b"".join([self.parts[p] if p in self.parts else self._part(p) for p in cut])
            # special tokens are written with < and >
            elif self.cuts and _PLAIN.fullmatch(text) and "<" not in text:
                known = self.parts
                self.words[word] = b"".join([known[p] if p in known else self._part(p) for p in _PARTS.findall(text.lower())])
            else:
                others.append(word)
        if others:
            self._encode(others)
        return anew

    def _encode(self, words: list[bytes]) -> None:
        new = [w for w in words if b"\x01" not in w]
        parts: list[list[int]] = [[]]
        if len(self.mark) == 1:
            for one in self._ids([f" {_MARK} ".join(w.decode() for w in new)])[0]:
                if one == self.mark[0]:
                    parts.append([])
                else:
                    parts[-1].append(one)
        if len(parts) != len(new):
            parts = self._ids([w.decode() for w in new])
        rest = [w for w in words if b"\x01" in w]
        for word, ids in zip(new + rest, parts + self._ids([w.decode() for w in rest])):
            self.words[word] = b"".join(i.to_bytes(4, "little") for i in ids)

    def of(self, text: bytes) -> bytes:
        words = text.split()  # at ASCII white space, which the tokenizer drops as well
        try:
            return b"".join(map(self.words.__getitem__, words))
        except KeyError:
            distinct = set(words)
            if self._learn(distinct.difference(self.words)):
                self._learn(distinct.difference(self.words), keep=True)
            return b"".join(map(self.words.__getitem__, words))


def cut_documents(
    docs: DataFrame, tokenizer: str, length: int, id: str = "doc_id", text: str = "text", keep_ids: bool = False
) -> DataFrame:
    """Pieces of at most ``length`` ids: id, piece, start, length, ids_crc32, ids and _row, a number of its own.

    A document's ids are those of the tokenizer file (a path) without special tokens,
    then ``END``; a longer document is cut every ``length`` ids. ``ids`` holds the ids
    as little-endian 32-bit numbers if they are asked for, else null. Null text is empty.
    """
    with open(tokenizer, encoding="utf-8") as file:
        vocabulary = docs.sparkSession.sparkContext.broadcast(file.read())  # one vocabulary, whatever the input

    def run(batches):
        ids_of = WordIds(vocabulary.value, worker_memo(f"ids {hash(vocabulary.value)}"))
        for batch in batches:
            out = {name: [] for name in PIECES.names}
            for one, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = ids_of.of(data) + END.to_bytes(4, "little")
                for k, at in enumerate(range(0, len(ids), 4 * length)):
                    part = ids[at : at + 4 * length]
                    out["id"].append(one)
                    out["piece"].append(k)
                    out["start"].append(at // 4)
                    out["length"].append(len(part) // 4)
                    out["ids_crc32"].append(zlib.crc32(part))
                    out["ids"].append(part if keep_ids else None)
            yield pa.RecordBatch.from_pydict(out, schema=PIECES)

    picked = docs.select(column(id).cast("long").alias("id"), text_of(text).cast("binary").alias("text"))
    pieces = picked.mapInArrow(run, spark_schema(PIECES)).withColumn("_row", F.monotonically_increasing_id())
    return stage(pieces, "pieces")
