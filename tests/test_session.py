"""Where intermediate tables live, and that they go."""

import os
import subprocess
import sys
from pathlib import Path

from ledgerleaf.session import shared_dir

ROOT = Path(__file__).resolve().parents[1]

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from ledgerleaf.session import build_session, shared_dir
spark = build_session("apart", "1", spark__checkpoint__dir={base!r})
paths = [shared_dir(spark, "t") for _ in range(2)]
for p in paths:
    spark.range(3).write.parquet(p)
assert len(set(paths)) == 2 and all(spark.read.parquet(p).count() == 3 for p in paths)
print("at", paths[0])
spark.stop()
"""


def test_tables_go_with_the_session(tmp_path):
    base = str(tmp_path / "shared")
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(root=str(ROOT), base=base)], capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr[-2000:]
    where = next(line for line in out.stdout.splitlines() if line.startswith("at ")).split()[1]
    assert where.startswith(base) and not os.path.exists(os.path.dirname(where))


def test_folders_are_new(spark):
    assert shared_dir(spark, "x") != shared_dir(spark, "x")
