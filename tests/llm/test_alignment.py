"""Token alignment against a plain version that walks token by token."""

import hashlib
from collections import Counter

import pytest
import sentencepiece
from test_native import EDGE, clashing, docs_of, key
from tokenizers import Tokenizer

from tarn.llm.alignment import ByteTokens, align_tokens, byte_alphabet
from tarn.llm.queries import BYTES, PIECES, tokenizer_path

TEXTS = [
    "<|endoftext|> <s> </s> <unk>", "▁x is not a space", " leading  and   many spaces ", "tab\tline\nline\r\n", "a\x00b",
    "ﬁ Å é ① 　  ", "日本語のテキスト", "🙂🙃", "don't we'll I'm", "1234567 89", "x" * 3000, " ", "\n", "plain words here",
    "plain words here", "plain words here", "words plain", "Éauxment oienai réai",
]
MORE = EDGE + [(100 + k, t, "en", "a", 0) for k, t in enumerate(TEXTS)]


def plain(rows):
    byte, piece = Tokenizer.from_file(tokenizer_path(BYTES)), sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECES))
    byte.encode_special_tokens = True
    alphabet = byte_alphabet()
    aligned, total = [], Counter()
    for one, text in rows:
        a = byte.encode(" " + (text or ""), add_special_tokens=False).ids
        b = piece.encode(text or "")
        bytes_a = [bytes(alphabet[c] for c in byte.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(piece.id_to_piece(i)[3:5], 16)]) if piece.is_byte(i) else piece.id_to_piece(i).replace("▁", " ").encode() for i in b]
        whole = b" " + (text or "").encode()
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            aligned.append((one, [], [], [], ""))
            continue
        links, groups, group_a, group_b = [], [], [], []
        i = j = at_a = at_b = 0
        while i < len(a) or j < len(b):
            links.append((a[i], b[j]))
            next_a, next_b = at_a + len(bytes_a[i]), at_b + len(bytes_b[j])
            if next_a <= next_b:
                group_a.append(a[i])
            if next_b <= next_a:
                group_b.append(b[j])
            if next_a == next_b:
                groups.append(",".join(map(str, group_a)) + "|" + ",".join(map(str, group_b)))
                group_a, group_b = [], []
            i, at_a, j, at_b = (i + (next_a <= next_b), next_a if next_a <= next_b else at_a, j + (next_b <= next_a), next_b if next_b <= next_a else at_b)
        total.update(links)
        aligned.append((one, a, b, links, ";".join(groups)))
    best = Counter()
    for (_, b), n in total.items():
        best[b] = max(best[b], n)
    return [
        (one, len(a), len(b), groups.count(";") + bool(groups), len(links), sum(total[x] == best[x[1]] for x in links),
         sum(total[x] for x in links), hashlib.sha256(groups.encode()).hexdigest() if groups else "")
        for one, a, b, links, groups in aligned
    ]


@pytest.mark.parametrize("rows,chunk_bytes", [("edge", 500), ("table", 1 << 22)])
def test_alignment(spark, sf, rows, chunk_bytes):
    docs = spark.read.parquet(f"{sf}/documents.parquet") if rows == "table" else docs_of(spark, MORE).repartition(3)
    clash = clashing(docs).selectExpr("*", "'x' AS id", "'x' AS `key`", "'x' AS pair", "'x' AS n_a", "'x' AS times")
    given = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = align_tokens(clash, tokenizer_path(BYTES), tokenizer_path(PIECES), chunk_bytes=chunk_bytes)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert key(tuple(r) for r in got.collect()) == key(plain(given))


def test_no_documents(spark):
    assert align_tokens(docs_of(spark, []), tokenizer_path(BYTES), tokenizer_path(PIECES)).collect() == []
    only = docs_of(spark, [(1, None, None, None, None), (2, "", None, None, None)])
    assert key(tuple(r) for r in align_tokens(only, tokenizer_path(BYTES), tokenizer_path(PIECES)).collect()) == [
        (1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")
    ]


def test_merges_as_the_tokenizer_file_says():
    """The faster merges give the ids of the file's own library, on every kind of character and on long runs."""
    with open(tokenizer_path(BYTES), encoding="utf-8") as file:
        mine = ByteTokens(file.read())
    theirs = Tokenizer.from_file(tokenizer_path(BYTES))
    theirs.encode_special_tokens = True
    texts = [f"a{chr(c)}b {chr(c)}1 {chr(c)} x" for c in range(0, 0x30000, 3) if not 0xD800 <= c < 0xE000]
    texts += [c * 20_000 for c in ("a", " ", "1", "^", "é", "\n")] + TEXTS
    assert mine.ids(texts) == [theirs.encode(" " + t, add_special_tokens=False).ids for t in texts]
