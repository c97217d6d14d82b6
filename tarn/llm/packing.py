"""Best-fit packing of pieces into sequences, from the histogram of their lengths.

The plan needs nothing but how many pieces there are of each length, which is as
many numbers as a sequence has places, whatever the input.

1. Patterns: the ways to fill a sequence with one to three lengths, in steps of a
   128th of it, are enumerated. Non-negative least squares fits how often each is
   used to the histogram, and the fitted counts are rounded down.
2. Each pattern is laid out in real lengths; its last place takes the longest piece
   there is that fits, so a pattern's rounding leaves no gap.
3. What is left is packed by best fit, longest first, into the gaps and then into
   new sequences. Equal sequences are handled as one group with a count.

The plan says which ranks of a length go where. Pieces are numbered within their
length, in blocks of bounded size, and each looks its place up.
"""

from __future__ import annotations

import bisect
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarn.llm.tokens import cut_documents
from tarn.session import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LENGTH = 2048
STEPS = 128
MOST_PARTS = 3
RANK_BLOCK = 100_000


def patterns(steps: int = STEPS, most: int = MOST_PARTS) -> list[tuple[int, ...]]:
    """All falling sequences of one to ``most`` whole numbers with the sum ``steps``."""

    def parts(left: int, largest: int, places: int):
        if left == 0:
            yield ()
        elif places:
            for part in range(min(left, largest), 0, -1):
                if part * places >= left:
                    for rest in parts(left - part, part, places - 1):
                        yield (part, *rest)

    return list(parts(steps, steps, most))


def least_squares(matrix: np.ndarray, target: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """x >= 0 with the least |matrix x - target|, by the active-set method."""
    gram, aim = matrix.T @ matrix, matrix.T @ target
    x = np.zeros(matrix.shape[1])
    used = np.zeros(len(x), dtype=bool)
    slope = aim.copy()
    enough = 1e-9 * max(1.0, float(np.abs(aim).max(initial=0)))
    while rounds and not used.all() and slope[~used].max() > enough:
        used[np.argmax(np.where(used, -np.inf, slope))] = True
        while rounds:
            rounds -= 1
            at = np.flatnonzero(used)
            solved = np.linalg.lstsq(gram[np.ix_(at, at)], aim[at], rcond=None)[0]
            if (solved > 0).all():
                x[:] = 0
                x[at] = solved
                break
            # go as far as no value turns negative, and let go of those that reach 0
            low = solved <= 0
            step = (x[at][low] / np.maximum(x[at][low] - solved[low], 1e-300)).min()
            x[at] += step * (solved - x[at])
            used[at[low & (x[at] <= 1e-12 * max(1.0, x.max()))]] = False
            used[at[x[at] <= 0]] = False
            x[~used] = 0
        slope = aim - gram @ x
    return x


def plan_groups(counts: np.ndarray, length: int = LENGTH, steps: int = STEPS) -> list[tuple[int, tuple[int, ...]]]:
    """Groups of equal sequences, as (how many, lengths in order), that hold ``counts[l]`` pieces of each length l."""
    left = counts.astype(np.int64).copy()
    unit = max(1, length // steps)
    steps = -(-length // unit)
    bins = np.clip((np.arange(length + 1) + unit // 2) // unit, 1, steps)
    ways = patterns(steps)
    matrix = np.zeros((steps, len(ways)))
    for k, way in enumerate(ways):
        for part in way:
            matrix[part - 1, k] += 1
    target = np.bincount(bins, weights=left, minlength=steps + 1)[1:]
    scale = max(1.0, float(target.max(initial=0)))
    times = np.floor(least_squares(matrix, target / scale) * scale + 1e-6).astype(np.int64)

    done: list[tuple[int, tuple[int, ...]]] = []
    gaps: dict[int, list[list]] = {}
    held = [n for n in range(1, length + 1) if left[n] > 0]  # lengths that are left, in order

    def spend(size: int, n: int) -> None:
        left[size] -= n
        if left[size] == 0:
            held.pop(bisect.bisect_left(held, size))

    def keep(n: int, lengths: tuple[int, ...]) -> None:
        gap = length - sum(lengths)
        if gap:
            gaps.setdefault(gap, []).append([n, lengths])
        else:
            done.append((n, lengths))

    def longest(most: int, least: int) -> int:
        k = bisect.bisect_right(held, most) - 1
        return held[k] if k >= 0 and held[k] >= least else 0

    for way, n in sorted(zip(ways, times.tolist()), reverse=True):
        while n > 0:
            chosen: list[int] = []
            gap = length
            for k, part in enumerate(way):
                last = k == len(way) - 1
                # the places before the last take lengths of their step, the last takes what fits best
                most = gap if last else min(gap - (len(way) - 1 - k), part * unit + unit // 2)
                least = max(1, part * unit - unit - unit // 2 if last else part * unit - unit // 2)
                size = longest(most, least)
                while size and left[size] <= chosen.count(size):
                    size = longest(size - 1, least)
                if not size:
                    break
                chosen.append(size)
                gap -= size
            if len(chosen) < len(way):
                break
            many = min(n, *(int(left[s]) // chosen.count(s) for s in chosen))
            for size in chosen:
                spend(size, many)
            keep(many, tuple(chosen))
            n -= many

    open_gaps = sorted(gaps)
    while held:
        size = held[-1]
        n = int(left[size])
        spend(size, n)
        while n:
            k = bisect.bisect_left(open_gaps, size)
            if k == len(open_gaps):
                # new sequences, each with as many of this length as it holds
                each = length // size
                full, rest = divmod(n, each)
                fresh = [(full, (size,) * each)] * bool(full) + [(1, (size,) * rest)] * bool(rest)
                n = 0
            else:
                gap = open_gaps[k]
                many, lengths = gaps[gap][-1]
                taken = min(many, n)
                gaps[gap][-1][0] -= taken
                if taken == many:
                    gaps[gap].pop()
                    if not gaps[gap]:
                        open_gaps.pop(k)
                n -= taken
                fresh = [(taken, (*lengths, size))]
            for many, lengths in fresh:
                rest = length - sum(lengths)
                if rest and not gaps.get(rest):
                    bisect.insort(open_gaps, rest)
                keep(many, lengths)
    return done + [(n, lengths) for groups in gaps.values() for n, lengths in groups]


class Places:
    """Where the piece of a rank among those of its length goes."""

    def __init__(self, groups: list[tuple[int, tuple[int, ...]]], length: int):
        used = np.zeros(length + 1, dtype=np.int64)
        rows, sequence = [], 0
        for n, lengths in groups:
            offset = 0
            for size in lengths:
                rows.append((size, int(used[size]), sequence, offset))
                used[size] += n
                offset += size
            sequence += n
        self.sequences = sequence
        rows.sort()
        table = np.array(rows, dtype=np.int64).reshape(-1, 4)
        self.key = (table[:, 0] << 48) + table[:, 1]
        self.rank, self.sequence, self.offset = table[:, 1], table[:, 2], table[:, 3]

    def of(self, size: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, (size << 48) + rank, side="right") - 1
        return self.sequence[at] + rank - self.rank[at], self.offset[at]


def pack(pieces: DataFrame, length: int = LENGTH, steps: int = STEPS, block: int = RANK_BLOCK) -> DataFrame:
    """``pieces`` (written once, with ``length`` and a unique ``_row``) and each one's sequence_id and offset.

    A piece of the whole length is a sequence by itself; the others follow the plan.
    """
    spark = pieces.sparkSession
    counts = np.zeros(length + 1, dtype=np.int64)
    # at most one row per length
    for row in pieces.groupBy("length").count().collect():
        counts[row["length"]] = row["count"]
    full = pieces.filter(F.col("length") == length).withColumn("sequence_id", -1 - F.col("_row")).withColumn("offset", F.lit(0).cast("long"))
    counts[length] = 0
    places = Places(plan_groups(counts, length, steps), length)  # travels with the task's code; its size has a bound

    # ranks within a length: blocks of bounded size are numbered by themselves
    shares = [(size, int(-(-counts[size] // block))) for size in range(1, length) if counts[size]]
    table = spark.createDataFrame(shares, "length long, _shares long")
    short = pieces.filter(F.col("length") < length).join(F.broadcast(table), "length")
    short = short.withColumn("_block", F.pmod(F.xxhash64("_row"), F.col("_shares")))
    upto = Window.partitionBy("length").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = short.groupBy("length", "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = before.select("length", "_block", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("length", "_block").orderBy("_row")) - 1
    ranked = short.withColumn("_rank", inside.cast("long")).join(before.hint("merge"), ["length", "_block"])
    ranked = ranked.select(*pieces.columns, (F.col("_rank") + F.col("_before")).alias("_rank"))

    def run(batches):
        for batch in batches:
            size, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
            sequence, offset = places.of(size, rank)
            names = [n for n in batch.schema.names if n != "_rank"]
            columns = [batch.column(n) for n in names] + [pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    placed = ranked.mapInArrow(run, f"{schema}, sequence_id long, offset long")
    return placed.unionByName(full)


def pack_documents(
    docs: DataFrame, tokenizer: str, length: int = LENGTH, id: str = "doc_id", text: str = "text", keep_ids: bool = False,
    steps: int = STEPS, block: int = RANK_BLOCK,
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, ids (if kept), sequence_id and offset.

    See ``cut_documents`` for the pieces. An empty text is one piece with the end id
    alone; repeated rows are documents of their own. An empty table gives an empty
    result. Other columns are not read.
    """
    placed = pack(cut_documents(docs, tokenizer, length, id, text, keep_ids), length, steps, block).drop("_row")
    return placed.withColumnRenamed("id", id)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves: sequence_id, n_pieces, length and ids, from pieces that kept their ids.

    A sequence has a bounded number of pieces, as each has one id at least.
    """
    ordered = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    ids = F.aggregate(ordered, F.lit(b""), lambda all_ids, part: F.concat(all_ids, part.getField("ids")))
    return packed.groupBy("sequence_id").agg(
        F.count(F.lit(1)).alias("n_pieces"), F.sum("length").alias("length"), ids.alias("ids")
    )
