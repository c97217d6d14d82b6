"""Word ids against the tokenizer itself, text by text."""

import random

import duckdb
import numpy as np
from tokenizers import Tokenizer

from tarn.llm import tokens
from tarn.llm.queries import tokenizer_path
from tarn.llm.tokens import WordIds


def test_words_as_the_tokenizer_has_them(sf, monkeypatch):
    monkeypatch.setattr(tokens, "KNOWN_WORDS", 3_000)  # the memo starts anew now and then
    path = tokenizer_path()
    with open(path, encoding="utf-8") as file:
        vocabulary = file.read()
    whole, memo = Tokenizer.from_file(path), {}
    mine = WordIds(vocabulary, memo)
    assert mine.cuts
    pick = random.Random(2)
    signs = "abcXYZ019'\".,;<>|-_/\\éÉßÄÿ÷×µªº\u0301İΣς\u00a0\u3000🙂日\x00\x01\x7f\x85 \n\t"
    texts = ["".join(pick.choice(signs) for _ in range(pick.randrange(40))) for _ in range(4000)]
    texts += [f"{chr(c)} a{chr(c)}b 1{chr(c)}" for c in range(0x2000) if not 0xD800 <= c < 0xE000]
    texts += [" ".join(f"v{k}" for k in range(2_500)), " ".join(f"v{k}" for k in range(2_000, 9_000)), "v1 v2500"]  # more than the memo holds
    texts += ["<|endoftext|> <|startoftext|>x", "don't WE'LL I'm 'S 's's", "x" * 5000, "É" * 300, "1" * 300]
    texts += [r[0] for r in duckdb.sql(f"SELECT text FROM '{sf}/documents.parquet' WHERE text IS NOT NULL").fetchall()]
    for text in texts:
        assert np.frombuffer(mine.of(text.encode()), dtype="<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)


def test_another_tokenizer_is_not_cut():
    path = tokenizer_path()
    with open(path, encoding="utf-8") as file:
        vocabulary = file.read()
    other = WordIds(vocabulary.replace("Lowercase", "NFKC"), {})
    assert not other.cuts
    whole = Tokenizer.from_str(vocabulary.replace("Lowercase", "NFKC"))
    for text in ("Some Words, ﬁne 12", "\x01 a\x01b"):
        assert np.frombuffer(other.of(text.encode()), dtype="<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
