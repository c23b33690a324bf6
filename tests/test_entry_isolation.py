"""The driver may load __spark_entry__.py by path from any folder; executors still need
the package (functions of mapInArrow / mapInPandas are imported by module name)."""

import os
import subprocess
import sys
import tempfile

from conftest import ROOT, SF_SMALL

SCRIPT = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("entry_by_path", {os.path.join(ROOT, "__spark_entry__.py")!r})
E = importlib.util.module_from_spec(spec)
spec.loader.exec_module(E)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
print("ENTRY", E.entry(spark).count())
print("ING", E.queries()["ing"](spark, {SF_SMALL!r}).count())
spark.stop()
"""


def test_entry_loaded_by_path_from_another_folder():
    cwd = tempfile.mkdtemp(prefix="run-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True,
                         text=True, timeout=600)
    assert "ENTRY 100" in out.stdout, out.stderr[-2000:]
    assert "ING 2289" in out.stdout, out.stderr[-2000:]
