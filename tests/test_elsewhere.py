"""The entry file works from any folder: the package is not importable in the Python workers."""

import os
import subprocess
import sys

ENTRY = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
SCRIPT = """
import importlib.util, sys
spec = importlib.util.spec_from_file_location("__spark_entry__", sys.argv[1])
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").getOrCreate()
for name in ("batch_generate", "mcq_prompt"):
    print(name, len(entry.queries()[name](spark, "/root/testdata/sf0.001").collect()))
"""


def test_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run(
        [sys.executable, "-c", SCRIPT, ENTRY], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert out.returncode == 0, out.stderr[-2000:]
    assert "mcq_prompt 200" in out.stdout
