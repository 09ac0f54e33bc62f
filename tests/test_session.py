"""A session that names no checkpoint folder runs the queries all the same."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent

SCRIPT = """
import sys
from pyspark.sql import SparkSession
spark = (
    SparkSession.builder.master("local[2]")
    .config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "2")
    .config("spark.sql.warehouse.dir", sys.argv[1])
    .getOrCreate()
)
if spark.conf.get("spark.checkpoint.dir", None):
    print("named")
import __spark_entry__ as entry
for name in ("active_sites", "case_uom_ratios", "site_report"):
    print(name, entry.queries()[name](spark, "/root/testdata/sf0.001").count())
print(spark.conf.get("spark.checkpoint.dir", None))
"""


def test_without_checkpoint_folder(tmp_path):
    conf = tmp_path / "conf"
    conf.mkdir()
    import os

    env = os.environ | {"SPARK_CONF_DIR": str(conf), "PYTHONPATH": str(ROOT)}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, str(tmp_path / "warehouse")],
        cwd=ROOT, env=env, capture_output=True, text=True, timeout=300,
    )
    assert done.returncode == 0, done.stderr[-3000:]
    lines = done.stdout.split("\n")
    assert "named" not in lines and lines[-2] == "None"
    assert (tmp_path / "warehouse" / "_staging").is_dir()
