import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
from docketry import model
from docketry.operators import attribution, balance
import numpy as np
rows = spark.range(60).selectExpr(
    *[f"cast(id % {{k + 2}} as int) AS {{c}}" for k, c in enumerate(model.FEATURES)],
    "cast(id < 10 as int) AS is_resolved", "cast(id as string) AS ddl_case_id")
print("balanced", balance.smote_balance(rows).count())
leaf = attribution.Leaves(np.array([1.0, 3.0]), np.zeros((2, 1), int), np.array([[-np.inf], [0.5]]),
                          np.array([[0.5], [np.inf]]), np.array([[0.5], [0.5]]))
print("explained", attribution.shapley_values(rows, leaf).count())
"""


def test_workers_need_no_installed_package(tmp_path):
    """Started in another folder, without the repository in the environment of the workers."""
    repo = str(Path(__file__).resolve().parents[1])
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_HOME")}
    run = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(repo=repo)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert "balanced 100" in run.stdout and "explained 60" in run.stdout, run.stderr[-2000:]
