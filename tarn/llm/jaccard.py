"""Join of documents by n-gram Jaccard similarity, as a blocked sparse matrix product.

The matrix has a row per document and a column per n-gram; the product of the
matrix with itself has the overlap of every two documents. Only entries that reach
a bound given by the two sizes matter, and they are found without the others:

1. Columns are cut into ranges so many that two documents that link must agree on
   all columns of one range: documents of sizes a and b that link differ in at most
   (a + b)(1 - t) / (1 + t) columns, and there are more ranges than that. Documents
   meet for one size class and the next, since sizes that link are near. So a
   document sends one key per range, and only documents with equal keys can link.
   Ranges that hold few n-grams say little; they are left out where enough others
   remain, and there are spare ranges to allow that.
2. Of the documents with equal keys the first is the pivot of the others, so a group
   of any size gives as many candidate edges as it has members, not pairs.
3. Each document's row is multiplied with that of its best pivot; overlaps are
   accumulated and compared with the bound given by the sizes. Most copies of a
   text are then connected. Before a row is sent for that, its outline is: a byte per
   range. Documents that link have few unequal ranges, and most others are dropped by
   that; it never drops a link.
4. Members of one pivot that are still in different components are multiplied with
   each other, in blocks of bounded size: those outside the pivot's component with
   each other and with those inside. Pairs within a component need no product: they
   are connected already. So no link between components is lost.

Equal sets within a chunk of documents are one row from the start.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.llm.chunks import (
    Stretches, bucket_count, groups_of_equal, held_buckets, kept_rows, mixed, opened, packed, rows_of, spark_schema,
    split_words, total_bytes, unpacked, windows, word_hashes, write_chunks,
)
from tarn.llm.common import small_join, worker_memo
from tarn.llm.components import connected
from tarn.session import drop_staged, stage, staged_paths

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORDS = 3
PERCENT = 90
STRONG = 3  # n-grams that make a range tell something
BLOCK_NGRAMS = 400_000  # of one block of rows
_KEY_BYTES = 5
_SEND_BYTES = 4 << 20

ROWS = pa.schema([("row", pa.int64()), ("id", pa.int64()), ("n", pa.int64()), ("same", pa.int64())])
KEYS = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("keys", pa.binary()), ("more", pa.binary())])
EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])
SETS = pa.schema([("task", pa.string()), ("side", pa.string()), ("row", pa.int64()), ("grams", pa.binary())])
_SETS = "task string, side string, row long, grams binary"
OUTLINES = pa.schema([*SETS][:3] + [pa.field("n", pa.int64()), pa.field("class", pa.int64()), pa.field("first", pa.binary()), pa.field("second", pa.binary())])
_OUTLINES = "task string, side string, row long, n long, class long, first binary, second binary"


def _sets(row: dict, words: int) -> list[np.ndarray]:
    """The sorted n-gram hashes of each document of a chunk; a shorter text is one n-gram."""
    data, byte_ends = opened(row)
    upper = (data >= 0x41) & (data <= 0x5A)
    data = np.where(upper, data + 0x20, data).astype(np.uint8)
    starts, stops, ends = split_words(data, byte_ends)
    prints = Stretches(word_hashes(data, starts, stops))
    places = windows(ends, words)
    grams = prints.of(places, words)
    cuts = np.searchsorted(places, ends)
    out = []
    for k in range(len(ends) - 1):
        if 0 < ends[k + 1] - ends[k] < words:
            out.append(prints.of(ends[k : k + 1], int(ends[k + 1] - ends[k])))
        else:
            out.append(np.unique(grams[cuts[k] : cuts[k + 1]]))
    return out


def _size_classes(most: int, percent: int) -> list[int]:
    """Least sizes of the classes: sizes that link are in one class or in neighbouring ones."""
    least = [1]
    while least[-1] <= most:
        least.append(least[-1] * 100 // percent + 1)
    return least + [least[-1] * 100 // percent + 1]


def _spare(differ: int, fewest: int) -> int:
    """Ranges beyond those needed: enough for the empty ranges of all but few sets of ``fewest`` n-grams,
    and for large sets for those with one n-gram, which many strangers share."""
    spare = differ // 6
    for _ in range(3):
        ranges = differ + 1 + spare
        empty = ranges * math.exp(-fewest / ranges)
        spare = min(differ, max(spare, int(empty + 3 * math.sqrt(empty))))
    return spare


def _range_edges(sorted_grams: np.ndarray, ranges: int) -> np.ndarray:
    """Where each of equal ranges of hashes begins in the sorted n-grams, and where the last one ends."""
    memo = worker_memo("firsts")  # an entry per size class
    if ranges not in memo:
        memo[ranges] = np.array([-(-(k << 64) // ranges) for k in range(ranges)], dtype=np.uint64)
    return np.append(np.searchsorted(sorted_grams, memo[ranges]), len(sorted_grams))


def _ranges(grams: np.ndarray, percent: int) -> list[tuple[int, np.ndarray, np.ndarray, int]]:
    """For its own size class and the next: the class, a hash and the size of each range, and how many may be left out."""
    classes = _size_classes(len(grams), percent)
    own = int(np.searchsorted(classes, len(grams), side="right")) - 1
    spread = mixed(grams ^ np.uint64(0x5851F42D4C957F2D))
    sums = np.zeros(len(grams) + 1, dtype=np.uint64)
    np.cumsum(spread, out=sums[1:])
    found = []
    for c in (own, own + 1):
        largest = classes[c + 1] - 1 if c + 1 < len(classes) else classes[c] * 100 // percent
        differ = 2 * largest * (100 - percent) // (100 + percent)
        spare = _spare(differ, classes[c - 1] if c else 1)
        ranges = differ + 1 + spare
        edges = _range_edges(grams, ranges)
        held = np.diff(edges)
        key = mixed(sums[edges[1:]] - sums[edges[:-1]] + held.astype(np.uint64))
        found.append((c, mixed(key + mixed(np.arange(ranges, dtype=np.uint64) + np.uint64((c + 1) << 32))), held, spare))
    return found


def _range_keys(grams: np.ndarray, percent: int) -> np.ndarray:
    """The keys of one document, for its own size class and the next."""
    found = []
    for _, key, held, spare in _ranges(grams, percent):
        # the weakest go, as many sizes as the spare ranges allow; empty ones would let strangers meet
        least = next((n for n in range(STRONG, 0, -1) if np.count_nonzero(held < n) <= spare), 0)
        found.append(key[held >= least])
    return np.concatenate(found)


def _outline(grams: np.ndarray, percent: int) -> tuple[int, bytes, bytes]:
    """The size class, and a byte of each range's hash for that class and the next."""
    (own, first, *_), (_, second, *_) = _ranges(grams, percent)
    return own, *((key >> np.uint64(56)).astype(np.uint8).tobytes() for key in (first, second))


def _partners(left: list[tuple], right: list[tuple] | None, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of two blocks (or of one with itself) have a partner that they may link to.

    A row is (n, class, outline, outline for the next class). Every n-gram that only one
    of two documents has makes one range at most unequal, so those that link have at
    most as many unequal ranges as their sizes allow for n-grams.
    """
    others = left if right is None else right
    found_left, found_right = np.zeros(len(left), dtype=bool), np.zeros(len(others), dtype=bool)
    held: dict[int, list[int]] = {}
    for k, (_, c, *_) in enumerate(others):
        held.setdefault(c, []).append(k)
    blocks = {
        c: (np.array(at), np.array([others[k][0] for k in at]), *(np.frombuffer(b"".join(others[k][v] for k in at), dtype=np.uint8).reshape(len(at), -1) for v in (2, 3)))
        for c, at in held.items()
    }
    for k, (n, c, first, second) in enumerate(left):
        # the smaller of two neighbouring classes is seen as the larger one
        for other, mine, theirs in ((c, first, 2), (c - 1, first, 3), (c + 1, second, 2)):
            if other in blocks:
                at, sizes = blocks[other][:2]
                unequal = (blocks[other][theirs] != np.frombuffer(mine, dtype=np.uint8)).sum(axis=1)
                may = unequal * (100 + percent) <= (sizes + n) * (100 - percent)
                if right is None:
                    may &= at != k
                found_left[k] |= may.any()
                found_right[at[may]] = True
    return (found_left | found_right, found_right) if right is None else (found_left, found_right)


def _row_number(chunk: int, k: int) -> int:
    """A chunk has fewer than 2**22 documents, and a task writes fewer than 2**18 chunks."""
    return ((chunk >> 32) << 40) | ((chunk & 0xFFFFFFFF) << 22) | k


def _first_of_equal(sets: list[np.ndarray]) -> list[int]:
    seen: dict[bytes, int] = {}
    return [seen.setdefault(s.tobytes(), k) if len(s) else k for k, s in enumerate(sets)]


def _linked(a: np.ndarray, sizes: np.ndarray, grams: np.ndarray, owner: np.ndarray, percent: int) -> np.ndarray:
    """Which of the documents, given as one sorted list of (n-gram, owner), link to the set ``a``."""
    low, high = np.searchsorted(grams, a, side="left"), np.searchsorted(grams, a, side="right")
    counts = high - low
    places = np.arange(int(counts.sum())) + np.repeat(low - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
    overlap = np.bincount(owner[places], minlength=len(sizes))
    # sizes bound the overlap that is needed; what is below is dropped
    return np.flatnonzero((overlap > 0) & (100 * overlap >= percent * (len(a) + sizes - overlap)))


def _product(left: list[tuple[int, bytes]], right: list[tuple[int, bytes]] | None, percent: int) -> list[tuple[int, int]]:
    """Links between the rows of two blocks, or of one with itself, as edges to the first row of each local component."""
    rows = [r for r, _ in left] + [r for r, _ in (right or [])]
    sets = [np.frombuffer(g, dtype="<u8") for _, g in [*left, *(right or [])]]
    first = len(left) if right is not None else 0
    others = sets[first:]
    sizes = np.array([len(s) for s in others], dtype=np.int64)
    grams = np.concatenate(others) if others else np.zeros(0, dtype=np.uint64)
    owner = np.repeat(np.arange(len(others)), sizes)
    order = np.argsort(grams, kind="stable")
    grams, owner = grams[order], owner[order]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for k in range(len(left)):
        for j in _linked(sets[k], sizes, grams, owner, percent):
            parent[root(first + int(j))] = root(k)
    least: dict[int, int] = {}
    for k, r in enumerate(rows):
        least[root(k)] = min(least.get(root(k), r), r)
    return [(r, least[root(k)]) for k, r in enumerate(rows) if least[root(k)] != r]


def _chunk_and_place(row: str):
    return F.shiftleft(F.shiftright(row, 40), 32).bitwiseOR(F.shiftright(row, 22).bitwiseAND((1 << 18) - 1)), F.col(row).bitwiseAND((1 << 22) - 1)


def _sent(tasks: DataFrame, chunks: DataFrame, words: int, schema: pa.Schema, spark_fields: str, what) -> DataFrame:
    """For each task what it wants of its rows: a chunk learns which rows those are, and sends ``what`` of their sets."""

    def take(batches):
        for row in rows_of(batches):
            sets = _sets(row, words)
            out, size = [], 0
            for want in row["wanted"]:
                found = what(sets[want["k"]])
                out.append({"task": want["task"], "side": want["side"], "row": _row_number(row["chunk"], want["k"]), **found})
                size += sum(len(v) for v in found.values() if isinstance(v, bytes))
                if size > _SEND_BYTES:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out, size = [], 0
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    chunk, k = _chunk_and_place("row")
    wanted = tasks.groupBy(chunk.alias("chunk")).agg(F.collect_list(F.struct(k.alias("k"), "task", "side")).alias("wanted"))
    return small_join(chunks, stage(wanted, "wanted"), ["chunk"], "inner").mapInArrow(take, spark_fields)


def _two_sides(side: list[str], rows: list) -> tuple[list, list | None]:
    left = [r for s, r in zip(side, rows) if s in "ls"]
    return left, None if "s" in side else [r for s, r in zip(side, rows) if s == "r"]


def _possible(tasks: DataFrame, chunks: DataFrame, words: int, percent: int) -> DataFrame:
    """The rows of tasks that may link to another one there, by their outlines, which are small beside the sets."""

    def what(grams: np.ndarray) -> dict:
        own, first, second = _outline(grams, percent)
        return {"n": len(grams), "class": own, "first": first, "second": second}

    def run(table: pa.Table) -> pa.Table:
        side = table.column("side").to_pylist()
        rows = list(zip(*(table.column(c).to_pylist() for c in ("n", "class", "first", "second"))))
        marked = dict(zip("lr", _partners(*_two_sides(side, rows), percent)))
        marked["s"] = marked["l"]
        seen = dict.fromkeys("lrs", 0)
        keep = []
        for s in side:
            keep.append(bool(marked[s][seen[s]]))
            seen[s] += 1
        return table.filter(pa.array(keep)).select(["task", "side", "row"])

    return _sent(tasks, chunks, words, OUTLINES, _OUTLINES, what).groupBy("task").applyInArrow(run, "task string, side string, row long")


def _multiply(tasks: DataFrame, chunks: DataFrame, words: int, percent: int) -> DataFrame:
    """Links found by the tasks: ``task`` (a name), ``side`` ("l", "r", or "s" for a block with itself) and ``row``."""

    def run(table: pa.Table) -> pa.Table:
        side, row, grams = (table.column(c).to_pylist() for c in ("side", "row", "grams"))
        links = _product(*_two_sides(side, list(zip(row, grams))), percent)
        return pa.table({"a": [a for a, _ in links], "b": [b for _, b in links]}, schema=EDGES)

    possible = stage(_possible(tasks, chunks, words, percent), "possible")
    sent = _sent(possible, chunks, words, SETS, _SETS, lambda grams: {"grams": grams.astype("<u8").tobytes()})
    return sent.groupBy("task").applyInArrow(run, spark_schema(EDGES))


def _near(chunks: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """All documents with the size of their set, and links that connect those which links connect."""
    buckets = bucket_count(total_bytes(chunks) / 16)

    def describe(batches):
        for row in rows_of(batches):
            sets = _sets(row, words)
            same = _first_of_equal(sets)
            numbers = [_row_number(row["chunk"], k) for k in range(len(sets))]
            yield pa.RecordBatch.from_pydict(
                {"row": numbers, "id": row["ids"], "n": [len(s) for s in sets], "same": [numbers[k] for k in same]}, schema=ROWS
            )

    def ask(batches):
        for row in rows_of(batches):
            sets = _sets(row, words)
            same = _first_of_equal(sets)
            alone = [k for k, s in enumerate(sets) if same[k] == k and len(s)]
            if not alone:
                continue
            per_doc = [_range_keys(sets[k], percent) for k in alone]
            keys = np.concatenate(per_doc)
            owner = np.repeat(np.array(alone, dtype="<u4"), [len(k) for k in per_doc])
            order = np.argsort(keys, kind="stable")
            keys, owner = keys[order], owner[order]
            held, edges = held_buckets(keys, buckets)
            runs = list(zip(edges[:-1], edges[1:]))
            yield pa.RecordBatch.from_pydict(
                {
                    "bucket": held, "chunk": [row["chunk"]] * len(held),
                    "keys": [packed(keys[a:b], _KEY_BYTES) for a, b in runs], "more": [owner[a:b].tobytes() for a, b in runs],
                },
                schema=KEYS,
            )

    def meet(table: pa.Table) -> pa.Table:
        keys = [unpacked(k, _KEY_BYTES) for k in table.column("keys").to_pylist()]
        owner = np.concatenate([np.frombuffer(m, dtype="<u4") for m in table.column("more").to_pylist()]).astype(np.int64)
        start = np.array([_row_number(c, 0) for c in table.column("chunk").to_pylist()], dtype=np.int64)
        row = np.repeat(start, [len(k) for k in keys]) | owner
        order, group = groups_of_equal(np.concatenate(keys))
        pivot = np.full(int(group[-1]) + 1, np.iinfo(np.int64).max)
        np.minimum.at(pivot, group, row[order])
        a, b = row[order], pivot[group]
        met = a != b
        return pa.table({"a": a[met], "b": b[met]}, schema=EDGES)

    described = stage(chunks.mapInArrow(describe, spark_schema(ROWS)), "rows")
    met = chunks.mapInArrow(ask, spark_schema(KEYS)).groupBy("bucket").applyInArrow(meet, spark_schema(EDGES))
    edges = stage(met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("times")), "candidates")

    # each row with its best pivot; a pivot of many is copied to each share of them
    sizes = described.select(F.col("row").alias("a"), "n")
    best = edges.groupBy("a").agg(F.max_by("b", F.struct("times", -F.col("b"))).alias("b"))
    best = stage(best.join(sizes, "a"), "best")
    shares = F.greatest(F.lit(1), F.ceil(F.sum("n") / F.lit(BLOCK_NGRAMS))).cast("long")
    pivots = stage(best.groupBy("b").agg(shares.alias("shares")), "pivots")
    share = F.pmod(F.xxhash64("a"), F.col("shares"))
    members = best.join(pivots, "b").select(F.concat_ws(":", "b", share).alias("task"), F.lit("r").alias("side"), F.col("a").alias("row"))
    heads = pivots.select("b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)).alias("share"))
    heads = heads.select(F.concat_ws(":", "b", "share").alias("task"), F.lit("l").alias("side"), F.col("b").alias("row"))
    links = stage(_multiply(members.unionAll(heads), chunks, words, percent), "links")

    # members of one pivot that are in different components
    label = connected(links).select(F.col("v").alias("row"), "label")
    groups = edges.select("b", F.col("a").alias("row")).unionAll(edges.select("b", F.col("b").alias("row")).distinct())
    groups = groups.join(label, "row", "left").withColumn("label", F.coalesce("label", "row"))
    groups = groups.join(described.select("row", "n"), "row")
    own = F.max(F.when(F.col("row") == F.col("b"), F.col("label")))
    split = groups.groupBy("b").agg(F.min("label").alias("low"), F.max("label").alias("high"), own.alias("main")).filter("low < high")
    open_ = stage(groups.join(split.select("b", "main"), "b").withColumn("inside", F.col("label") == F.col("main")), "open")

    def blocks(inside: bool):
        total = F.sum(F.when(F.col("inside") == inside, F.col("n")))
        return F.greatest(F.lit(1), F.ceil(F.coalesce(total, F.lit(0)) / F.lit(BLOCK_NGRAMS))).cast("long")

    counts = open_.groupBy("b").agg(blocks(True).alias("ins"), blocks(False).alias("outs"))
    placed = open_.join(counts, "b")
    zero, none = F.lit(0).cast("long"), F.lit(-1).cast("long")
    number = F.pmod(F.xxhash64("row", F.lit(7)), F.when(F.col("inside"), F.col("ins")).otherwise(F.col("outs")))
    placed = placed.withColumn("block", number)
    every_out = F.sequence(zero, F.col("outs") - 1)
    # blocks outside with each other, and each of them with each block inside
    pairs_out = F.transform(every_out, lambda j: F.struct(F.least("block", j).alias("i"), F.greatest("block", j).alias("j"),
        F.when(F.col("block") == j, "s").when(F.col("block") < j, "l").otherwise("r").alias("side"), F.lit(False).alias("cross")))
    cross_out = F.transform(F.sequence(zero, F.col("ins") - 1), lambda j: F.struct(F.col("block").alias("i"), j.alias("j"),
        F.lit("l").alias("side"), F.lit(True).alias("cross")))
    cross_in = F.transform(every_out, lambda i: F.struct(i.alias("i"), F.col("block").alias("j"), F.lit("r").alias("side"), F.lit(True).alias("cross")))
    tasks = placed.withColumn("t", F.explode(F.when(F.col("inside"), cross_in).otherwise(F.concat(pairs_out, cross_out))))
    tasks = tasks.select(F.concat_ws(":", "b", "t.i", "t.j", "t.cross").alias("task"), F.col("t.side").alias("side"), "row")
    more = stage(_multiply(tasks, chunks, words, percent), "links")

    equal = described.filter("same != row").select(F.col("row").alias("a"), F.col("same").alias("b"))
    return described, links.unionAll(more).unionAll(equal)


def near_copies(
    docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """One row per document: id, n_shingles and component_id, the smallest id that links lead to.

    A document's set has its distinct n-grams of ``words`` words, A-Z in lower case; a
    text with fewer words is one n-gram, and a text without words has none and links
    to nothing. Two documents link if 100 x intersection >= ``percent`` x union.
    Repeated rows link as documents of their own; a component of null ids only has a
    null component_id. An empty table gives an empty result; other columns are not read.
    """
    named = _named(*_near(write_chunks(docs, id, text), words, percent))
    in_links = named.filter("v is not null")
    names = in_links.groupBy("label").agg(F.min("id").alias("component_id"))
    # components of one document need no join
    linked = in_links.join(names, "label").select("id", "n", "component_id")
    alone = named.filter("v is null").select("id", "n", F.col("id").alias("component_id"))
    return linked.unionAll(alone).select(F.col("id").alias(id), F.col("n").alias("n_shingles"), "component_id")


def _named(rows: DataFrame, links: DataFrame) -> DataFrame:
    """Rows with the label of their component, and v, which is null if nothing links to them."""
    label = connected(links)
    return rows.join(label, rows["row"] == label["v"], "left").withColumn("label", F.coalesce("label", "row"))


def drop_near_copies(
    docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each component the one with the smallest id.

    A null id comes last, and of repeated ids one row stays.
    """
    known = set(staged_paths())
    chunks = write_chunks(docs, id, text, whole=True)
    kept = set(staged_paths())
    linked = _named(*_near(chunks, words, percent)).filter("v is not null").select("row", "id", "label")
    first = F.min(F.struct(F.isnull("id").alias("none"), "id", "row"))
    stays = linked.groupBy("label").agg(first.alias("first")).select(F.col("first.row").alias("row"))
    chunk, k = _chunk_and_place("row")
    gone = linked.select("row").join(stays, "row", "left_anti").groupBy(chunk.alias("chunk")).agg(F.collect_list(k).alias("k"))
    gone = stage(gone, "gone")
    # only the chunks and what is gone are read from now on
    last = staged_paths()[-1]
    drop_staged(docs.sparkSession, [p for p in staged_paths() if p not in known and p not in kept and p != last])
    return kept_rows(chunks, gone, docs, text)
