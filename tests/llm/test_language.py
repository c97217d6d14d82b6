"""Language identification: codewords, n-grams, and accuracy on texts that were held out."""

import zlib
from collections import Counter

import numpy as np
import pytest
from test_native import EDGE, clashing, docs_of, key

from tarn.llm import language
from tarn.llm.language import Model, codewords, identify_languages, ngrams


def held_out(one):
    return zlib.crc32(b"" if one is None else str(one).encode()) % 4 == 2


@pytest.mark.parametrize("languages", [2, 3, 4, 5, 9, 17, 40])
def test_codewords(languages):
    words = codewords(languages)
    assert len(words) == languages and np.isin(words, (-1, 1)).all()
    assert all(len(set(column)) == 2 for column in words.T)
    assert len(np.unique(words, axis=1).T) == words.shape[1]
    apart = [int((a != b).sum()) for i, a in enumerate(words) for b in words[:i]]
    if languages >= 4:
        assert min(apart) >= max(4, languages // 2)  # one wrong bit at least can be corrected


def test_any_wrong_bit_is_corrected():
    words = codewords(4)
    model = Model(["a", "b", "c", "d"], np.ones((4, 3, 1 << language.BUCKET_BITS)))
    for k, word in enumerate(words):
        for b in range(words.shape[1]):
            margins = word.astype(float)[None, :].copy()
            assert model.decode(margins)[0][0] == model.languages[k] and not model.decode(margins)[2][0]
            margins[0, b] *= -1
            assert model.decode(margins)[0][0] == model.languages[k]
    assert model.decode(np.zeros((1, words.shape[1])))[2][0]  # nothing known: ambiguous


def test_ngrams():
    """Equal n-grams share a bucket, texts do not reach into each other, and other signs only part words."""
    def of(*texts):
        grams, has = ngrams(list(texts))
        buckets, owner = grams & ((1 << language.BUCKET_BITS) - 1), grams >> language.BUCKET_BITS
        return [sorted(buckets[owner == k].tolist()) for k in range(len(texts))], has.tolist()

    got, has = of("Abc, d", "abc   d", None, "", "12 #", "x", "abc d!?!")
    assert got[0] == got[1] == got[6]
    assert has == [True, True, False, False, False, True, True]
    assert got[2] == got[3] == got[4] == []
    for k, text in enumerate(["Abc, d", "x", "abc d!?!"]):
        assert of(text)[0][0] == got[(0, 5, 6)[k]]
    assert len(of("abc")[0][0]) == 3 + 4 + 3  # letters; pairs and triples with the marks around


def test_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = identify_languages(docs)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score", "ambiguous"]
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    rows = got.collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(truth)
    assert all(r["held_out"] == held_out(r["doc_id"]) and 0 <= r["score"] <= 1 for r in rows)
    asked = [r for r in rows if r["held_out"]]
    for lang in set(truth.values()):
        mine = [r for r in asked if truth[r["doc_id"]] == lang]
        assert sum(r["lang_pred"] == lang for r in mine) >= 0.98 * len(mine) - 1
    clear = [r for r in asked if not r["ambiguous"]]
    assert len(clear) > 0.9 * len(asked) and sum(r["lang_pred"] == truth[r["doc_id"]] for r in clear) >= 0.99 * len(clear)


def test_only_labels_of_learned_texts_matter(spark, sf):
    """Held-out labels, sources and the order of rows change nothing."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    changed = docs.selectExpr(
        "doc_id", "text", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2 THEN 'xx' ELSE lang END AS lang", "'s' AS source"
    )
    clash = clashing(changed.repartition(5)).selectExpr("*", "'x' AS id", "'x' AS fold", "'x' AS lang_pred")
    assert key(tuple(r) for r in identify_languages(docs).collect()) == key(tuple(r) for r in identify_languages(clash).collect())


def test_edges(spark):
    rows = [(i, t, lang, s, n) for i, t, lang, s, n in EDGE] + [(20, "12345 !!", "en", "a", 0), (21, "été", None, None, None)]
    got = {(r["doc_id"], r["lang_pred"] == "und", r["held_out"]) for r in identify_languages(docs_of(spark, rows)).collect()}
    assert got == {(i, not any(c.isalpha() for c in t or ""), held_out(i)) for i, t, *_ in rows}
    assert identify_languages(docs_of(spark, [])).collect() == []
    untaught = docs_of(spark, [(1, "some words", None, None, None), (2, None, "en", None, None)])
    assert {(r["lang_pred"], r["score"]) for r in identify_languages(untaught).collect()} == {("und", 0.0)}
    one = docs_of(spark, [(k, "some words", "en", None, None) for k in range(12)])
    assert {(r["lang_pred"], r["score"], r["ambiguous"]) for r in identify_languages(one).collect()} == {("en", 1.0, False)}


def test_a_language_with_few_texts(spark):
    """One language has nearly all rows, another one text per fold or less."""
    rows = [(k, "the quick brown fox and the lazy dog", "en", "a", 0) for k in range(300)]
    rows += [(k, "zażółć gęślą jaźń po polsku", "pl", "a", 0) for k in range(300, 306)]
    got = {r["doc_id"]: r["lang_pred"] for r in identify_languages(docs_of(spark, rows)).collect()}
    assert Counter(got.values()) == {"en": 300, "pl": 6}
