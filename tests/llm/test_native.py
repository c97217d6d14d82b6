"""Quality rules, URL filter, mixing and exact deduplication against plain versions."""

from collections import Counter, defaultdict

import pytest
from brute import SPACE, base_counts, sha, url_rule, water_fill

from tarn.llm.exact_dedup import drop_exact_copies, exact_dedup
from tarn.llm.mixing import mix_sources, mixed_documents, weights_by_name, weights_in_order
from tarn.llm.quality import keep_good, quality_rules
from tarn.llm.url_filter import filter_urls

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 7919}x{i}" for i in range(60_000))
EDGE = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n\x0b\x0c\r ", "en", "a", 7), (4, "one", "en", None, 3),
    (5, "a b c d e a b c d e f g", "en", "a", 20), (6, "a b c d e a b c d e f g", "en", "a", 20),
    (6, "a b c d e a b c d e f g", "en", "a", 20), (None, "x y\nx y\n\nx y", "de", "b", 11), (None, "x y x  y x y", "de", "b", 11),
    (7, LONG, "en", "a", len(LONG)), (8, LONG + " end", "en", "a", 0), (9, LONG, "en", "c", 0), (10, "é\u00a0ß # $ <b>|x|", "fr", "a", 3),
    (11, "x " * 40, "en", "a", 80), (12, "same start " + "q" * 70, "en", "a", 1), (13, "same start " + "q" * 70 + "r", "en", "a", 1),
]


def docs_of(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def key(rows):
    return sorted(rows, key=repr)


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def clashing(df):
    """The same rows with columns whose names the operators also use."""
    extra = ("kept", "size", "_row", "_doc", "_text", "target", "_draw", "weight", "host", "score", "n_words", "_source", "_id", "_words")
    return df.selectExpr("*", *[f"'other' AS `{c}`" for c in extra], "1 AS `a.b`")


@pytest.mark.parametrize("rows", ["edge", "table"])
def test_base_counts(spark, table, rows):
    docs = docs_of(spark, EDGE) if rows == "edge" else table
    got = [tuple(r)[:7] for r in quality_rules(docs).collect()]
    want = [(r["doc_id"], *base_counts(r["text"])) for r in docs.collect()]
    assert key(got) == key(want)
    assert not [r for r in quality_rules(docs).collect() if r["base_failed"] and r["kept"]]


def test_outliers_of_a_group_are_dropped(spark):
    plain = [(i, " ".join(f"w{i}a{k}" for k in range(40)), "en", "a", 0) for i in range(200)]
    noisy = [(1000 + i, " ".join(f"w{i}a{k}###" for k in range(40)), "en", "a", 0) for i in range(5)]
    # the same symbols are usual in another source
    usual = [(2000 + i, " ".join(f"w{i}a{k}###" for k in range(40)), "en", "tables", 0) for i in range(200)]
    kept = {r["doc_id"] for r in quality_rules(docs_of(spark, plain + noisy + usual)).collect() if r["kept"]}
    assert kept == set(range(200)) | set(range(2000, 2200))


def test_kept_documents_are_the_rows(spark, table):
    docs = clashing(table)
    kept = keep_good(docs)
    assert kept.columns == docs.columns
    want = {r["doc_id"] for r in quality_rules(docs).collect() if r["kept"]}
    assert {r["doc_id"] for r in kept.collect()} == want and 0 < len(want) < table.count()


@pytest.mark.parametrize("rows", ["edge", "table"])
def test_exact_dedup(spark, table, rows):
    docs = docs_of(spark, EDGE) if rows == "edge" else table
    groups = defaultdict(list)
    for r in docs.collect():
        groups[SPACE.sub(" ", r["text"] or "")].append(r["doc_id"])
    want = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        first = ids.index(keep)
        want += [(i, keep, len(ids), k == first, sha(text)) for k, i in enumerate(ids)]
    got = [tuple(r) for r in exact_dedup(clashing(docs), first=8, widen=3).collect()]
    assert key(got) == key(want)


def test_dropped_copies(spark):
    docs = clashing(docs_of(spark, EDGE))
    kept = drop_exact_copies(docs)
    assert kept.columns == docs.columns
    texts = [SPACE.sub(" ", r["text"] or "") for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({SPACE.sub(" ", r[1] or "") for r in EDGE})


def test_targets_and_sizes(spark, table):
    rows = mix_sources(clashing(table), weights_in_order((3.0, 1.0, 2.0)), 1.5).collect()
    words, source = {}, {}
    for r in table.collect():
        words[r["doc_id"]], source[r["doc_id"]] = len([w for w in SPACE.split(r["text"] or "") if w]), r["source"]
    sizes = Counter()
    for d, n in words.items():
        sizes[source[d]] += n
    weights = {s: (3.0, 1.0, 2.0)[k % 3] for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    target = water_fill(dict(sizes), weights, 1.5 * sum(sizes.values()))
    taken = Counter()
    for r in rows:
        s = source[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (words[r["doc_id"]], sizes[s]) and r["taken"] <= 2 * r["size"]
        assert r["target"] == pytest.approx(target[s])
        taken[s] += r["taken"]
    largest = max(words.values())
    assert all(abs(taken[s] - target[s]) <= largest for s in sizes)
    again = mix_sources(table.repartition(5), weights_in_order((3.0, 1.0, 2.0)), 1.5).collect()
    assert key(map(tuple, rows)) == key(map(tuple, again))


def test_mix_of_edge_rows(spark):
    docs = clashing(docs_of(spark, EDGE))
    rows = mix_sources(docs, weights_in_order((1.0,)), 1.0).collect()
    mixed = mixed_documents(docs, weights_in_order((1.0,)), 1.0)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r["copies"] for r in rows)
    named = spark.createDataFrame([(None, 1.0), ("a", 0.0)], "source string, weight double")
    by_source = defaultdict(int)
    for r in mix_sources(docs_of(spark, EDGE), weights_by_name(named), 0.001).collect():
        by_source[r["target"] > 0] += r["taken"]
    assert by_source[False] == 0


def test_urls(spark):
    urls = [None, "", "no scheme", "http://A.Example.ORG/es/1", "https://example.org/en/12?x=1", "http://org", "http://org/",
            "ftp://notorg.net/a#b", "http://www.shop.com/de/9", "http://www.shop.com/fr/9", "http://x.com", "http://a://b/c", "://h/p?q",
            "http://\u00e9.net/\u00e9"]
    pages = spark.createDataFrame([(k, u, "html") for k, u in enumerate(urls * 2)], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in filter_urls(clashing(pages)).collect()}
    assert len(got) == 2 * len(urls)
    for k, u in enumerate(urls * 2):
        host, path, rule, verdict = url_rule(u)
        assert (got[k]["host"], got[k]["path"], got[k]["rule"]) == (host, path, rule)
        assert got[k]["verdict"] in ({verdict} if verdict else {"allow", "block"})
        assert got[k]["verdict"] == got[k % len(urls)]["verdict"]


def test_url_model_on_held_out_pages(spark):
    """Rules stand for the two classes; the model must tell them apart on pages without a rule."""
    pages = [(i, f"http://site{i % 37}.org/news/article-{i}") for i in range(300)]
    pages += [(1000 + i, f"http://site{i % 41}.com/de/cheap-pills-{i}") for i in range(300)]
    asked = [(5000 + i, f"http://other{i % 7}.net/news/article-{i}") for i in range(100)]
    asked += [(6000 + i, f"http://other{i % 7}.net/de/cheap-pills-{i}") for i in range(100)]
    got = {r["page_id"]: r["verdict"] for r in filter_urls(spark.createDataFrame(pages + asked, "page_id long, url string")).collect()}
    right = sum(got[5000 + i] == "allow" for i in range(100)) + sum(got[6000 + i] == "block" for i in range(100))
    assert right >= 180


def test_empty_tables(spark):
    docs = docs_of(spark, [])
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    for df in (quality_rules(docs), keep_good(docs), exact_dedup(docs), drop_exact_copies(docs), filter_urls(pages),
               mix_sources(docs, weights_in_order((1.0,)), 1.5), mixed_documents(docs, weights_in_order((1.0,)), 1.5)):
        assert df.collect() == []


@pytest.mark.parametrize("names", [("aaa", "zzz"), ("mmm", "qqq")])
def test_every_decided_host_counts(spark, names):
    """A class may have one host only: its URLs count, whatever fold the host is in; and long and odd URLs have a verdict."""
    good, bad = (n + ".net" for n in names)
    rules = (("allow", good, "/"), ("block", bad, "/"))
    urls = [f"https://{good}/kitten/garden{k}" for k in range(60)] + [f"https://{bad}/xxcasino/zz9{k}" for k in range(60)]
    asked = ["https://other.info/kitten/garden7", "https://else.info/xxcasino/zz9x", "https://l.info/" + "kitten/garden" * 3000, "https://l.info/" + "xxcasino/zz9" * 3000]
    more = [None, "", "no scheme", "https://", "https://other.info/kitten/garden7"]
    pages = spark.createDataFrame(list(enumerate(urls + asked + more)), "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in filter_urls(pages, rules=rules).collect()}
    assert [got[k] for k in range(120)] == ["allow"] * 60 + ["block"] * 60
    assert [got[k] for k in range(120, 124)] == ["allow", "block", "allow", "block"]
    assert len(got) == 129 and got[128] == got[120] and set(got.values()) == {"allow", "block"}
    assert filter_urls(pages.filter("page_id < 0"), rules=rules).collect() == []
