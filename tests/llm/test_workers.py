"""Every query where the workers cannot import the package, and searches of small tables."""

import os
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerleaf.llm import neighbours

ROOT = Path(__file__).resolve().parents[2]

SCRIPT = """
import importlib.util, sys
sys.path.insert(0, {root!r})
import __spark_entry__ as entry
from ledgerleaf.session import build_session

spark = build_session("apart", "4")
spark.sparkContext.setLogLevel("ERROR")

def absent(batches):
    yield from []
    for _ in batches:
        assert importlib.util.find_spec("ledgerleaf") is None, "the workers can import the package"

spark.range(1).mapInArrow(absent, "id long").collect()
for name, query in entry.queries().items():
    if name.startswith("op") or name == "pipeline":
        query(spark, {base!r}).write.format("noop").mode("overwrite").save()
        print("done", name, flush=True)
"""


def test_all_queries_without_the_package_on_the_workers(tmp_path, sf_dir):
    found = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(root=str(ROOT), base=sf_dir)], cwd=tmp_path, capture_output=True, text=True,
        env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}, timeout=900,
    )
    done = [line.split()[1] for line in found.stdout.splitlines() if line.startswith("done")]
    assert found.returncode == 0, found.stderr[-3000:]
    assert len(done) == len({n.split("_")[0] for n in done}) == 14


@pytest.mark.parametrize("rows", [1, 2, 5, 12, 21, 40, 60])
@pytest.mark.parametrize("crowded", [False, True])
def test_small_tables_give_whole_lists(spark, rows, crowded):
    rng = np.random.default_rng(rows)
    x = rng.standard_normal((rows, 6))
    if crowded:
        x[: rows * 6 // 7] = x[0] + 1e-3 * rng.standard_normal((rows * 6 // 7, 6))  # nearly all in one leaf
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 5 == 0, 20).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    wanted = min(20, rows - 1)
    assert set(got) == (set(range(0, rows, 5)) if wanted else set())
    for q, found in got.items():
        assert sorted(r for r, _ in found) == list(range(1, wanted + 1))
        assert len({v for _, v in found} - {q}) == wanted
