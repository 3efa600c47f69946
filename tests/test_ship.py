"""Python workers find the package although it is on the driver's path alone."""

import os
import subprocess
import sys

from paths import ROOT, SF001

CODE = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
         .config("spark.checkpoint.dir", {scratch!r}).getOrCreate())
import __spark_entry__ as entry
assert entry.queries()["item_similarity"](spark, {sf!r}).count() > 0
"""


def test_queries_run_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    code = CODE.format(root=ROOT, scratch=str(tmp_path / "scratch"), sf=SF001)
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
