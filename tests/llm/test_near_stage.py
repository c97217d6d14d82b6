"""The pipeline's near deduplication: 5-word sets that share four fifths."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from brute import WORD
from test_copies import ROWS, passages
from test_native import clashing, docs_of

from tarn.llm import jaccard

SIZE, PERCENT = 5, 80


def groups(texts):
    """Indices by component, every pair compared."""
    sets = []
    for text in texts:
        words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(words[i : i + SIZE]) for i in range(max(1, len(words) - SIZE + 1))} if words else set())
    label = list(range(len(texts)))
    holders = defaultdict(list)
    for k, s in enumerate(sets):
        for g in s:
            holders[g].append(k)
    overlap = Counter((a, b) for held in holders.values() for i, a in enumerate(held) for b in held[i + 1 :])
    for (a, b), n in overlap.items():
        if 100 * n >= PERCENT * (len(sets[a]) + len(sets[b]) - n):
            old, new = max(label[a], label[b]), min(label[a], label[b])
            label = [new if x == old else x for x in label]
    return label


def edited():
    """Texts of 50 and 1,000 words, and copies with one and 20 changed words."""
    rows = []
    for i, (n, changes) in enumerate([(50, 1), (1000, 20), (50, 4), (1000, 60)]):
        words = [f"d{i}w{k}" for k in range(n)]
        copy = list(words)
        for k in range(changes):
            copy[(2 * k + 1) * n // (2 * changes)] = f"d{i}new{k}"
        rows += [(10 * i + 1, " ".join(words), "en", "a", 0), (10 * i + 2, " ".join(copy), "en", "a", 0)]
    return rows


@pytest.mark.parametrize("rows", ["edited", "passages", "mixed", "table"])
def test_stage_keeps_one_of_each_group(spark, sf, rows):
    import corpus_pipeline as pipeline

    given = {"edited": edited, "passages": lambda: passages(80, seed=5), "mixed": lambda: ROWS["mixed"], "table": None}[rows]
    docs = spark.read.parquet(f"{sf}/documents.parquet") if given is None else clashing(docs_of(spark, given()).repartition(3))
    step = dict(pipeline.STAGES)["near_dedup"]
    held = [(r["doc_id"], r["text"]) for r in docs.collect()]
    label = groups([t for _, t in held])
    want = Counter()
    for one in set(label):
        ids = [held[k][0] for k in range(len(held)) if label[k] == one]
        want[min((i for i in ids if i is not None), default=None)] += 1
    assert Counter(r["doc_id"] for r in step(spark, docs, sf).collect()) == want
    if rows == "edited":
        assert set(want) == {1, 11, 21, 22, 31, 32}


@pytest.mark.parametrize("percent", [80, 90])
def test_range_keys_meet(percent):
    """Sets at the bound share a key; sets without a common n-gram share none."""
    pick = np.random.default_rng(6)
    for n in [*range(1, 60), 100, 333, 1000, 5000]:
        for _ in range(6):
            pool = np.unique(pick.integers(0, 2**64, 3 * n + 10, dtype=np.uint64))
            pick.shuffle(pool)
            lost = int(pick.integers(0, n * (100 - percent) // 100 + 1))
            more = int(pick.integers(0, n * (100 - percent) // percent + 1))
            a, b = np.sort(pool[:n]), np.sort(np.concatenate([pool[lost:n], pool[n : n + more]]))
            shared = n - lost
            if 100 * shared >= percent * (n + len(b) - shared):
                assert set(jaccard._range_keys(a, percent).tolist()) & set(jaccard._range_keys(b, percent).tolist())
            if n >= 1000:
                other = np.sort(pool[2 * n : 3 * n])
                assert not set(jaccard._range_keys(a, percent).tolist()) & set(jaccard._range_keys(other, percent).tolist())


@pytest.mark.parametrize("percent", [80, 90])
def test_outlines_never_drop_a_link(percent):
    """Of sets around the bound all that link stay partners, in one block and in two; strangers are none."""
    pick = np.random.default_rng(8)
    dropped = strangers = 0
    for n in [*range(1, 40), 100, 333, 1000]:
        pool = np.unique(pick.integers(0, 2**64, 4 * n + 40, dtype=np.uint64))
        pick.shuffle(pool)
        sets = [np.sort(pool[:n])]
        for _ in range(8):
            lost, more = (int(x) for x in pick.integers(0, n * (100 - percent) // 80 + 2, 2))
            sets.append(np.sort(np.concatenate([pool[min(lost, n - 1) : n], pool[n : n + more]])))
        sets.append(np.sort(pool[3 * n : 4 * n]))
        rows = [(len(s), *jaccard._outline(s, percent)) for s in sets]
        linked = np.zeros((len(sets), len(sets)), dtype=bool)
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                shared = len(np.intersect1d(a, b))
                linked[i, j] = i != j and 100 * shared >= percent * (len(a) + len(b) - shared)
        together, _ = jaccard._partners(rows, None, percent)
        assert not (linked.any(axis=1) & ~together).any()
        left, right = jaccard._partners(rows[:4], rows[4:], percent)
        assert not (linked[:4, 4:].any(axis=1) & ~left).any() and not (linked[:4, 4:].any(axis=0) & ~right).any()
        if n >= 100:
            strangers, dropped = strangers + 1, dropped + (not together[-1])
    assert dropped == strangers > 0
