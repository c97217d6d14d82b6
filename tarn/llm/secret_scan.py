"""Secret scan with one combined automaton for all rules.

All rules, read backwards, are compiled into one minimal automaton that may begin
anywhere. One pass over the bytes of a text from its end then tells for each place
which rules have a match that starts there. From those few places the rule's own
automaton finds the longest end. Matches of a rule are leftmost and do not
overlap; a match whose value is too short is dropped after it was found.

A rule is a kind, a head, a body and the least number of characters of the body.
"""

from __future__ import annotations

import hashlib
import sys
from itertools import accumulate
from operator import getitem, itemgetter

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from tarn.llm.automaton import Automaton, compile_rules, parse, reverse
from tarn.llm.chunks import spark_schema
from tarn.llm.common import column, text_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(sys.modules["tarn.llm.automaton"])
cloudpickle.register_pickle_by_value(sys.modules["tarn.llm.chunks"])

# fixed values: the base rules, then those that the method adds
BASE = (
    ("assign", r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?", r"[A-Za-z0-9+/_.=-]+", 6),
    ("access", r"AKIA", r"[A-Z0-9]+", 16),
    ("hex", r"", r"[0-9a-f]{24,}", 24),
)
ADDED = (
    ("github", r"gh[pousr]_", r"[A-Za-z0-9]+", 36),
    ("slack", r"xox[abprs]-", r"[A-Za-z0-9-]+", 20),
    ("jwt", r"eyJ", r"[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 20),
    ("pem", r"-----BEGIN\x20([A-Z]+\x20)*PRIVATE\x20KEY-----", r"", 0),
)
RULES = BASE + ADDED


class Scanner:
    """The automata as linked rows: ``row[byte]`` is the next row and ``row[256]`` what the state accepts."""

    def __init__(self, starts: Automaton, ends: list[tuple[Automaton, Automaton]], rules):
        self.rules, self.accepted = rules, starts.rules
        self.first = self._linked(starts)
        self.ends = [tuple(self._linked(a) for a in pair) for pair in ends]

    @staticmethod
    def _linked(automaton: Automaton) -> list:
        rows = [[] for _ in automaton.step]
        for row, targets, accepts in zip(rows, automaton.step.tolist(), automaton.accepts.tolist()):
            row.extend(rows[t] for t in targets)
            row.append(accepts)
        return rows[0]

    @staticmethod
    def _longest(row: list, data: bytes, at: int) -> int:
        """End of the longest match from ``at``; -1 if there is none. A row that leads only to itself is dead."""
        end = at if row[256] else -1
        for k in range(at, len(data)):
            row = row[data[k]]
            if row[256]:
                end = k + 1
            elif row[0] is row and all(nxt is row for nxt in row[:256]):
                break
        return end

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule, end) of all matches, in bytes, by start and then rule."""
        marks = bytes(map(itemgetter(256), accumulate(data[::-1], getitem, initial=self.first)))
        marks = np.frombuffer(marks, dtype=np.uint8)[:0:-1]
        free, found = [0] * len(self.rules), []
        for at in np.flatnonzero(marks).tolist():
            for k in self.accepted[marks[at]]:
                if at < free[k]:
                    continue
                head, whole = self.ends[k]
                end = self._longest(whole, data, at)
                free[k] = end
                if end - self._longest(head, data, at) >= self.rules[k][3]:
                    found.append((at, k, end))
        return sorted(found)


def build(rules=RULES) -> tuple:
    """The automata of the rules, made once on the driver."""
    whole = [parse(head + body) for _, head, body, _ in rules]
    starts = compile_rules([reverse(t) for t in whole], search=True)
    if len(starts.rules) > 256:
        raise ValueError("too many combinations of rules for one byte")
    pairs = [(compile_rules([parse(r[1])], search=False), compile_rules([t], search=False)) for r, t in zip(rules, whole)]
    return starts, pairs, rules


def find_secrets(docs: DataFrame, id: str = "doc_id", text: str = "text", base=BASE, added=ADDED) -> DataFrame:
    """One row per document: id, matches of each base kind (``n_<kind>``), base_sha256 and spans.

    ``spans`` has kind:start:end of every match by start and then kind as listed, in
    code points with the end exclusive, joined by commas; base_sha256 is the digest of
    the base kinds' part of it. Null text is empty. No shuffle: documents stay where
    they are read. Other columns are not read.
    """
    automata, n_base = build((*base, *added)), len(base)
    counts = [f"n_{rule[0]}" for rule in base]
    schema = pa.schema(
        [("id", pa.int64()), *[(c, pa.int64()) for c in counts], ("base_sha256", pa.string()), ("spans", pa.string())]
    )

    def run(batches):
        scanner = Scanner(*automata)
        for batch in batches:
            out = []
            for one, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                spans = scanner.spans(data)
                # a code point begins at every byte that does not continue one
                points = None
                if spans and not data.isascii():
                    points = np.cumsum((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80).tolist()
                named = []
                for start, k, end in spans:
                    if points is not None:
                        start, end = points[start] - 1, points[end - 1]
                    named.append((k, f"{scanner.rules[k][0]}:{start}:{end}"))
                kinds = [k for k, _ in named]
                base_text = ",".join(s for k, s in named if k < n_base)
                out.append(
                    {"id": one, **{c: kinds.count(k) for k, c in enumerate(counts)},
                     "base_sha256": hashlib.sha256(base_text.encode()).hexdigest(), "spans": ",".join(s for _, s in named)}
                )
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    picked = docs.select(column(id).cast("long").alias("id"), text_of(text).cast("binary").alias("text"))
    return picked.mapInArrow(run, spark_schema(schema)).withColumnRenamed("id", id)
