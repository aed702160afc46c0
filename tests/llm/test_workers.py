"""Queries run where the Python workers cannot import the package."""

import os
import subprocess
import sys

import pytest

SF = "/root/testdata/sf0.001"
REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = """
import sys, tempfile
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(dir=".")).getOrCreate())
def importable(_):
    import importlib.util
    return [importlib.util.find_spec("skyframe") is not None]
assert not any(spark.sparkContext.parallelize([1], 1).mapPartitions(importable).collect())
sys.path.insert(0, {repo!r})
from skyframe.llm.queries import QUERIES
for name in {names!r}:
    print(name, QUERIES[name](spark, {sf!r}).count())
"""


@pytest.mark.skipif(not os.path.isdir(SF), reason="shared tables not present")
def test_queries_run_without_the_package_on_the_workers(tmp_path):
    names = ["op1_quality", "op3_hilbert_neighbours", "op4_toxicity", "op11_pii", "op12_spelling_variants", "op13_hard_negatives"]
    script = tmp_path / "run.py"
    script.write_text(SCRIPT.format(repo=REPO, names=names, sf=SF))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert [line.split()[0] for line in out.stdout.splitlines()] == names
