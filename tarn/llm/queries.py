"""The operators bound to the test tables: one query per operator, over whole tables and texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.llm.alignment import align_tokens
from tarn.llm.common import read
from tarn.llm.exact_dedup import exact_dedup
from tarn.llm.jaccard import near_copies
from tarn.llm.language import identify_languages
from tarn.llm.licenses import scan_licenses
from tarn.llm.mixing import mix_sources, weights_in_order
from tarn.llm.packing import pack_documents
from tarn.llm.quality import quality_rules
from tarn.llm.registry import ORACLES, QUERIES, query  # noqa: F401
from tarn.llm.repeated_bytes import remove_repeats
from tarn.llm.repeated_words import remove_repeated_words
from tarn.llm.resampling import resample
from tarn.llm.secret_scan import find_secrets
from tarn.llm.url_filter import filter_urls

TOKENIZER = "word_bpe_49k.json"
BYTES, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# every third source counts three times, then once, then twice; the mix has 150 % of all words
WEIGHTS, SHARE = (3.0, 1.0, 2.0), 1.5


@query("op1_quality_rules")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read(spark, sf_dir, "documents"))


@query("op2_substring_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents")).drop("kept")


@query("op3_secret_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(read(spark, sf_dir, "documents"))


@query("op4_word_window_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_words(read(spark, sf_dir, "documents")).drop("kept")


@query("op5_best_fit_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"), tokenizer_path()).drop("ids")


@query("op6_url_filter")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(read(spark, sf_dir, "pages"))


@query("op7_license_scan")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents have no path; source / language / id stands for one."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", F.concat_ws("/", "source", "lang", "doc_id").alias("path"))
    return scan_licenses(docs, "doc_id", "path", "text")


@query("op8_mix_sources")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read(spark, sf_dir, "documents"), weights_in_order(WEIGHTS), SHARE)


@query("op9_ngram_jaccard")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(read(spark, sf_dir, "documents"))


EXACT_DEDUP = r"""
    WITH normal AS (
        SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS normal FROM documents
    )
    SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
        row_number() OVER (PARTITION BY normal ORDER BY doc_id) = 1 AS kept, sha256(normal) AS text_sha256
    FROM normal WINDOW same AS (PARTITION BY normal)
"""


@query("op10_exact_dedup", EXACT_DEDUP)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents"))


RESAMPLING = r"""
    WITH crc_step AS (
        SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
            lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS step
    ),
    doc_words AS (
        SELECT row_number() OVER () AS doc, doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
        FROM documents
    ),
    aim_words AS (
        SELECT unnest(regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
        FROM benchmark
    ),
    held AS (SELECT doc, unnest(words) AS word FROM doc_words),
    per_doc AS (SELECT doc, word, count(*) AS n FROM held GROUP BY ALL),
    counted AS (
        SELECT word, sum(s) AS s, sum(t) AS t FROM (
            SELECT word, n AS s, 0 AS t FROM per_doc UNION ALL SELECT word, 0, 1 FROM aim_words
        ) GROUP BY word
    ),
    hashed AS (
        SELECT word, s, t, xor(list_reduce(list_concat([4294967295], list_transform(range(1, length(digits) + 1, 2),
            lambda i: 16 * (strpos('0123456789ABCDEF', substr(digits, i, 1)) - 1) + strpos('0123456789ABCDEF', substr(digits, i + 1, 1)) - 1)),
            lambda c, b: xor(c >> 8, step[1 + (xor(c, b) & 255)])), 4294967295) % 10000 AS bucket
        FROM (SELECT *, hex(encode(word)) AS digits FROM counted), crc_step
    ),
    buckets AS (
        SELECT bucket, sum(s)::DOUBLE AS s, sum(t)::DOUBLE AS t, (SELECT sum(s) FROM counted)::DOUBLE AS all_s, (SELECT sum(t) FROM counted)::DOUBLE AS all_t
        FROM hashed GROUP BY bucket
    ),
    gain AS (
        SELECT word, floor(1000 * ln((b.t + 1) * (all_s + 10000) / ((b.s + 1) * (all_t + 10000))))::BIGINT AS gain FROM hashed JOIN buckets b USING (bucket)
    ),
    weighed AS (SELECT doc, floor(sum(n * gain)::DOUBLE / sum(n))::BIGINT AS weight FROM per_doc JOIN gain USING (word) GROUP BY doc),
    scored AS (
        SELECT doc_id, len(words) AS n_features, coalesce(weight, 0) AS weight,
            list_reduce(list_concat([0], list_transform(range(1, 9), lambda i: strpos('0123456789abcdef', substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), i, 1)) - 1)),
                lambda h, d: 16 * h + d) AS h
        FROM doc_words LEFT JOIN weighed USING (doc)
    ),
    drawn AS (
        SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score, n_features >= 20 AS fit FROM scored
    ),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY fit ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS place, count(*) OVER (PARTITION BY fit) AS n FROM drawn
    )
    SELECT doc_id, n_features::BIGINT AS n_features, weight, score, CASE WHEN fit AND place <= 10 * n // 100 THEN place END AS rank FROM ranked
"""


@query("op11_importance_resampling", RESAMPLING)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op12_language_id")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(read(spark, sf_dir, "documents"))


@query("op13_token_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(read(spark, sf_dir, "documents"), tokenizer_path(BYTES), tokenizer_path(PIECES))
