"""Executors need not have the package on their path."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
from casegrid.session import local_session
spark = local_session(2, "elsewhere")
from casegrid.operators.places import similarity_kernel
import pandas as pd
def seen(batches):
    for b in batches:
        yield pd.DataFrame({"found": [sum(p == ROOT for p in sys.path)]})
texts = spark.createDataFrame([("manila", False, 1)], "norm string, hint boolean, k int")
aliases = spark.createDataFrame([("o", "city", "manila", True, 1)], "ordinal string, level string, alias string, home boolean, k int")
rows = texts.groupBy("k").cogroup(aliases.groupBy("k")).applyInPandas(
    similarity_kernel, "norm string, hint boolean, level string, score double, ordinal string").collect()
found = sum(r.found for r in spark.range(1).mapInPandas(seen, "found long").collect())
print("SCORE", rows[0].score, found)
"""


def test_kernels_run_where_the_package_is_not(tmp_path):
    code = f"import sys; ROOT = {ROOT!r}; sys.path.insert(0, ROOT)\n" + SCRIPT
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=200
    )
    assert "SCORE 1.0 0" in run.stdout, run.stdout[-500:] + run.stderr[-1500:]
