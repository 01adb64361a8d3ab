import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as e
from pyspark.sql import SparkSession
builder = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
spark = builder.config("spark.sql.shuffle.partitions", "2").getOrCreate()
for name in ("iforest_score", "stream_features", "lof_score"):
    assert e.queries()[name](spark, "/root/testdata/sf0.001").count() > 0
print("done")
"""


def test_workers_need_no_package_on_their_path(tmp_path):
    """Python workers start elsewhere and know nothing of this repository."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(repo=REPO)],
        cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300,
    )
    assert out.stdout.strip().endswith("done"), out.stderr[-2000:]
