"""Task functions run on executors that do not have this package."""

import subprocess
import sys
import tempfile
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
from tarn.plans.bindings import QUERIES
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("rows", QUERIES["vec1_top_k_cosine"](spark, {sf!r}).count() > 0)
"""


def test_vector_search_away_from_the_repository(sf):
    repo = str(Path(__file__).resolve().parents[1])
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(repo=repo, sf=sf)],
        cwd=tempfile.mkdtemp(prefix="run-"), capture_output=True, text=True, timeout=120,
    )
    assert "rows True" in done.stdout, done.stderr[-2000:]
