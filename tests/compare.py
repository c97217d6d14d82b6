"""Run bound queries next to their oracle SQL in DuckDB and compare all values."""

from __future__ import annotations

import datetime as dt
import math
import sys
import tempfile
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tarn.plans.bindings import ORACLES, QUERIES  # noqa: E402
from tarn.plans.bindings.registry import TABLES  # noqa: E402


SPILL = tempfile.mkdtemp(prefix="run-")
TIMES: dict[str, float] = {}


def _cell(value):
    if value is None:
        return "<null>"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    if isinstance(value, int):
        return f"i{value}"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def oracle(sf_dir: str, name: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    con.execute(f"SET temp_directory = '{SPILL}'")
    con.execute("SET max_temp_directory_size = '1GB'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    return columns, _rows(columns, cursor.fetchall())


def actual(spark, sf_dir: str, name: str):
    df = QUERIES[name](spark, sf_dir)
    return df.columns, _rows(df.columns, [tuple(r) for r in df.collect()])


def difference(spark, sf_dir: str, name: str) -> str | None:
    started = time.time()
    got_columns, got = actual(spark, sf_dir, name)
    TIMES[name] = time.time() - started
    if name not in ORACLES:
        return None if got else "no rows"
    want_columns, want = oracle(sf_dir, name)
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} instead of {sorted(want_columns)}"
    if got == want:
        return None
    missing, extra = list(set(want) - set(got)), list(set(got) - set(want))
    return (
        f"rows {len(got)} instead of {len(want)}; {len(missing)} missing {missing[:3]}; "
        f"{len(extra)} extra {extra[:3]}"
    )


if __name__ == "__main__":
    from tarn.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    wanted = sys.argv[2:] or list(QUERIES)
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in [q for q in QUERIES if any(q.startswith(w) for w in wanted)]:
        try:
            found = difference(spark, sf_dir, name)
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:700]}"
        bad += found is not None
        print(f"{'ok  ' if found is None else 'FAIL'} {TIMES.get(name, 0):6.2f}s {name} {found or ''}", flush=True)
    print(f"{bad} differ")
