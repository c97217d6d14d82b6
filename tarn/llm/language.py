"""Language of texts by error-correcting output codes over character n-grams.

Each language has a codeword of bits; a binary classifier per bit reads the n-grams of
a text, and the codeword that suffers the least loss from all of them is chosen. A few
classifiers that err leave the nearest codeword unchanged.

1. Codewords: rows of a Hadamard matrix with at least twice as many columns as there are
   languages, so that two codewords differ in half of the matrix's columns. Columns
   that do not tell the languages apart, or do so as another one does, are left out.
2. Counting: one pass over the labelled texts adds up hashed n-grams of 1 to 3 letters by
   language and fold. Nothing is sampled. A task adds up its own texts first.
3. Classifiers: the weight of an n-gram for a bit is the logarithm of how much more often
   the languages with the bit use it than those without. Every language counts alike,
   whatever its share of the texts. The margin of a bit is the mean weight of a text.
4. Calibration: every labelled text is judged with the counts of the other folds. Per
   bit, the spread of the margins gives their unit and the share of errors the weight of
   the loss, as in boosting.
5. Decoding: the loss of a codeword is the weighted logistic loss of its bits. The score
   is the share of the best codeword in the sum of exponentiated losses. A text is marked
   as ambiguous if a bit that tells the best two codewords apart could not decide alone.

The model has a number per bucket, bit and fold: it grows with the number of languages,
not with the texts.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarn.llm.batches import portions
from tarn.llm.common import column, worker_memo

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(sys.modules["tarn.llm.common"])

BUCKET_BITS = 15
ORDERS = (1, 2, 3)  # letters of an n-gram
FOLDS = 3
PRIOR = 0.5  # added to each bucket's count of n-grams per BASE
BASE = 1e6  # n-grams that every language is scaled to
UNKNOWN = "und"
PORTION = 256 * 1024  # bytes of text at a time
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)

COUNTS = pa.schema([("lang", pa.string()), ("fold", pa.int64()), ("bucket", pa.int64()), ("n", pa.int64())])
MARGINS = pa.schema([("lang", pa.string()), ("margins", pa.list_(pa.float64()))])
RESULT = pa.schema([("id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()), ("ambiguous", pa.bool_())])


def _letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    memo = worker_memo("letters")
    if "is" not in memo:
        memo["is"] = np.array([chr(c).isalpha() for c in range(0x110000)])
    return memo["is"]


def ngrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Text and bucket of every n-gram, as text << BUCKET_BITS | bucket, and which texts have a letter.

    Letters are in lower case; all that stands between two words is one mark, and each
    word has one on both sides.
    """
    lower = [f" {(t or '').lower()} " for t in texts]
    points = np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    of = np.repeat(np.arange(len(texts)), [len(t) for t in lower])
    letter = _letters()[points]
    # a mark after each run of letters; a text begins with one
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    kept[np.flatnonzero(np.diff(of, prepend=-1))] = True
    codes = np.where(letter, points, 0)[kept].astype(np.uint64)
    of = of[kept]
    found = []
    h = np.zeros(len(codes), dtype=np.uint64)
    for n in range(1, max(ORDERS) + 1):
        # the hash of n letters is that of n - 1 with the next one mixed in
        h = h[: len(codes) - n + 1]
        h = (h ^ (codes[n - 1 :] + np.uint64(n))) * _MULTIPLY
        h ^= h >> np.uint64(29)
        if n in ORDERS:
            inside = of[n - 1 :] == of[: len(of) - n + 1]
            if n == 1:
                inside = codes > 0  # a mark alone says nothing
            bucket = (h[inside] * _MULTIPLY >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
            found.append(of[: len(h)][inside] << BUCKET_BITS | bucket)
    has = np.zeros(len(texts), dtype=bool)
    has[of[codes > 0]] = True
    return np.concatenate(found), has


def codewords(languages: int) -> np.ndarray:
    """A row of -1 and 1 per language: rows 0, 1, 2, 4 ... of a Hadamard matrix, then the others."""
    if languages < 2:
        return np.zeros((languages, 0), dtype=np.int64)
    size = 1
    while size < 2 * languages:
        size *= 2
    rows = sorted(range(size), key=lambda r: (r & (r - 1) > 0, r))[:languages]
    bits = np.array([[(r & c).bit_count() % 2 for c in range(size)] for r in rows]).reshape(languages, size)
    bits ^= bits[:1]  # a column and its complement are one
    bits = np.unique(bits[:, bits.any(axis=0)], axis=1)
    return 2 * bits - 1


class Model:
    """Languages, their codewords, and the weights of the n-grams for each fold left out and for none."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        """``counts``: by language, fold and bucket."""
        self.languages = np.array(languages, dtype=object)
        self.words = codewords(len(languages))
        total = counts.sum(axis=1)
        self.weights = self._weights(total)
        self.folded = np.stack([self._weights(total - counts[:, f]) for f in range(counts.shape[1])])
        bits = self.words.shape[1]
        self.unit, self.trust = np.ones(bits), np.ones(bits)

    def _weights(self, counts: np.ndarray) -> np.ndarray:
        """By bucket and bit."""
        sums = counts.sum(axis=1, keepdims=True)
        rates = counts * (BASE / np.maximum(sums, 1)) + PRIOR
        out = np.zeros((counts.shape[1], self.words.shape[1]))
        for b, bit in enumerate(self.words.T):
            with_, without = rates[(bit > 0) & (sums[:, 0] > 0)], rates[(bit < 0) & (sums[:, 0] > 0)]
            if len(with_) and len(without):
                out[:, b] = np.log(with_.mean(axis=0)) - np.log(without.mean(axis=0))
        return out.astype(np.float32)

    def margins(self, grams: np.ndarray, texts: int, fold: np.ndarray | None = None) -> np.ndarray:
        """By text and bit: the mean weight of its n-grams, with its fold left out if one is given."""
        out = np.zeros((texts, self.words.shape[1]))
        if not len(grams) or not self.words.shape[1]:
            return out
        # equal n-grams of a text are weighed together
        grams = np.sort(grams)
        at = np.flatnonzero(np.diff(grams, prepend=-1))
        times = np.diff(at, append=len(grams))
        owner, bucket = grams[at] >> BUCKET_BITS, grams[at] & ((1 << BUCKET_BITS) - 1)
        weights = self.weights[bucket] if fold is None else self.folded[fold[owner], bucket]
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        total = np.add.reduceat(times, starts)
        out[owner[starts]] = np.add.reduceat(weights * times[:, None], starts, axis=0) / total[:, None]
        return out

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The language of each text, its score, and whether it is ambiguous."""
        scaled = margins / self.unit
        losses = np.zeros((len(margins), len(self.languages)))
        for k, word in enumerate(self.words):
            losses[:, k] = (self.trust * np.logaddexp(0, -2 * scaled * word)).sum(axis=1)
        order = np.argsort(losses, axis=1, kind="stable")
        share = np.exp(losses.min(axis=1, keepdims=True) - losses)
        score = 1 / share.sum(axis=1)
        unclear = np.zeros(len(margins), dtype=bool)
        if len(self.languages) > 1 and self.words.shape[1]:
            each = np.arange(len(margins))
            # in loss, less than a bit of middling trust and one unit of margin would add
            least = np.median(self.trust) * 2
            unclear = losses[each, order[:, 1]] - losses[each, order[:, 0]] < least
        return self.languages[order[:, 0]], score, unclear


def fold_of(id: str) -> Column:
    """The remainder of the id's CRC by which texts are held out: 0 to 3."""
    return F.pmod(F.crc32(F.coalesce(column(id).cast("string"), F.lit("")).cast("binary")), F.lit(4))


HELD_OUT = 2


def count_ngrams(learn: DataFrame) -> DataFrame:
    """lang, fold, bucket and n of labelled texts (columns text, lang and fold)."""

    def run(batches):
        found: dict[tuple[str, int], np.ndarray] = {}
        for batch in batches:
            for part in portions(batch, "text", PORTION):
                grams, _ = ngrams(part.column("text").to_pylist())
                keys = list(zip(part.column("lang").to_pylist(), part.column("fold").to_pylist()))
                kinds = sorted(set(keys))
                kind = np.array([kinds.index(k) for k in keys], dtype=np.int64)
                bucket = grams & ((1 << BUCKET_BITS) - 1)
                together = np.bincount(kind[grams >> BUCKET_BITS] << BUCKET_BITS | bucket, minlength=len(kinds) << BUCKET_BITS)
                for k, held in zip(kinds, together.reshape(len(kinds), -1)):
                    found[k] = found[k] + held if k in found else held
        for (lang, fold), n in found.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(at), "fold": [fold] * len(at), "bucket": at, "n": n[at]}, schema=COUNTS)

    counts = learn.mapInArrow(run, "lang string, fold long, bucket long, n long")
    return counts.groupBy("lang", "fold", "bucket").agg(F.sum("n").alias("n"))


def train(learn: DataFrame) -> Model:
    """The model of labelled texts (columns text, lang and fold, none null)."""
    # a row per language, fold and bucket at most
    counted = count_ngrams(learn).toPandas()
    languages = sorted(counted["lang"].unique())
    counts = np.zeros((len(languages), FOLDS, 1 << BUCKET_BITS))
    place = counted["lang"].map({lang: k for k, lang in enumerate(languages)}).to_numpy(dtype=np.int64, na_value=0)
    counts[place, counted["fold"].to_numpy(dtype=np.int64), counted["bucket"].to_numpy(dtype=np.int64)] = counted["n"].to_numpy()
    model = Model(languages, counts)
    if len(languages) < 2:
        return model

    sent = learn.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = sent.value
        sign = dict(zip(model.languages, model.words))
        for batch in batches:
            for part in portions(batch, "text", PORTION):
                grams, has = ngrams(part.column("text").to_pylist())
                margins = model.margins(grams, part.num_rows, np.array(part.column("fold").to_pylist()))
                langs = part.column("lang").to_pylist()
                # times the true bit: above 0 where the classifier is right
                right = np.array([sign[lang] for lang in langs]) * margins
                yield pa.RecordBatch.from_pydict(
                    {"lang": [lang for lang, h in zip(langs, has) if h], "margins": list(right[has])}, schema=MARGINS
                )

    judged = learn.mapInArrow(run, "lang string, margins array<double>")
    bits = range(model.words.shape[1])
    measures = [F.count(F.lit(1)).alias("n")]
    for b in bits:
        margin = F.col("margins")[b]
        measures += [F.sum(F.abs(margin)).alias(f"spread{b}"), F.sum((margin <= 0).cast("long")).alias(f"errors{b}")]
    # a row per language; every language has the same say
    rows = judged.groupBy("lang").agg(*measures).collect()
    for b in bits:
        spread = np.mean([r[f"spread{b}"] / r["n"] for r in rows]) if rows else 1.0
        error = np.mean([(r[f"errors{b}"] + 1) / (r["n"] + 2) for r in rows]) if rows else 0.25
        model.unit[b] = spread or 1.0
        model.trust[b] = max(0.0, 0.5 * np.log((1 - error) / error))
    if not model.trust.any():
        model.trust[:] = 1.0
    model.folded = None  # not needed to predict
    return model


def identify_languages(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per document: id, held_out, lang_pred, score (0 to 1) and ambiguous.

    Documents whose id (as text) has a CRC-32 of remainder 2 by 4 are held out; of the
    others, those with a text and a language teach. The prediction looks at the text only.
    A null text and one without a letter is ``und`` with score 0, as is every text where
    nothing teaches. Repeated rows teach as often as they occur; a null id is hashed as an
    empty text and stays null. The id must be a whole number or null. An empty table
    gives an empty result; other columns are not read.
    """
    picked = docs.select(column(id).cast("long").alias("id"), column(text).alias("text"), column(lang).alias("lang"), fold_of(id).alias("fold"))
    fold = F.when(F.col("fold") == 0, 0).when(F.col("fold") == 1, 1).otherwise(2).cast("long")
    learn = picked.filter((F.col("fold") != HELD_OUT) & F.col("text").isNotNull() & F.col("lang").isNotNull())
    sent = docs.sparkSession.sparkContext.broadcast(train(learn.select("text", "lang", fold.alias("fold"))))

    def run(batches):
        model = sent.value
        for batch in batches:
            for part in portions(batch, "text", PORTION):
                grams, has = ngrams(part.column("text").to_pylist())
                has &= len(model.languages) > 0
                langs, score, unclear = np.full(len(has), UNKNOWN, dtype=object), np.zeros(len(has)), np.zeros(len(has), dtype=bool)
                if has.any():
                    found = model.decode(model.margins(grams, part.num_rows)[has])
                    langs[has], score[has], unclear[has] = found
                yield pa.RecordBatch.from_pydict(
                    {"id": part.column("id"), "held_out": part.column("held_out"), "lang_pred": list(langs), "score": score, "ambiguous": unclear},
                    schema=RESULT,
                )

    given = picked.select("id", "text", (F.col("fold") == HELD_OUT).alias("held_out"))
    found = given.mapInArrow(run, "id long, held_out boolean, lang_pred string, score double, ambiguous boolean")
    return found.withColumnRenamed("id", id)
