"""The entry file works when loaded by path from another directory,
including queries whose Python workers run the page job."""

import os
import subprocess
import sys
import tempfile

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = f"""
import importlib.util
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
spec = importlib.util.spec_from_file_location("entrymod", {os.path.join(HERE, "__spark_entry__.py")!r})
m = importlib.util.module_from_spec(spec)
spec.loader.exec_module(m)
print("ROWS", m.queries()["product_cards_alcampo"](spark, "/root/testdata/sf0.001").count())
"""


def test_entry_loaded_by_path_elsewhere():
    cwd = tempfile.mkdtemp(prefix="pricelake-cwd-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True, text=True,
                         timeout=600)
    assert "ROWS 200" in out.stdout, out.stderr[-2000:]
