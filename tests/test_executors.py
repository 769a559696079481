"""Executors in processes of their own, which don't share the driver's working folder."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pyspark

SCORED = """
import sys
from pyspark.sql import SparkSession
from helioflow.operators import forecast

folder, shared = sys.argv[1:]
conf = {"spark.master": "local-cluster[2,1,1024]", "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.driver.host": "127.0.0.1", "spark.sql.warehouse.dir": shared}
spark = SparkSession.builder.config(map=conf).getOrCreate()


def load(path):
    import glob
    import numpy as np

    weights = sum(np.loadtxt(name, ndmin=1) for name in glob.glob(f"{path}/**/_w*.txt", recursive=True))
    return lambda rows: rows @ weights[:, None]


rows = spark.range(100).selectExpr("id", "array(id * 1.0D, 2.0D) as values").repartition(4)
for name, factor in (("a", 1), ("b", 2)):
    found = forecast.score_features(rows, f"{folder}/{name}/model", load, 2, 1).collect()
    assert len(found) == 100 and all(r["scores"] == [factor * (10.0 * r["id"] + 2)] for r in found), found[:3]
spark.stop()
"""


def test_a_predictors_folder_reaches_executors(tmp_path):
    """Two folders of the same name with files of the same names, some below others and hidden ones."""
    for name, factor in (("a", 1), ("b", 2)):
        for part, weights in (("_w0.txt", (4, 1)), ("deeper/_w1.txt", (6, 0))):
            path = tmp_path / name / "model" / part
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_text("\n".join(str(factor * x) for x in weights))
    home = tmp_path / "home"  # the executors' folders are below Spark's home
    home.mkdir()
    for part in Path(pyspark.__file__).parent.iterdir():
        if part.name != "work":
            (home / part.name).symlink_to(part)
    repo = str(Path(__file__).resolve().parents[1])
    own = {"PYTHONPATH": os.pathsep.join([repo, os.environ.get("PYTHONPATH", "")]), "PYSPARK_PYTHON": sys.executable, "SPARK_HOME": str(home), "SPARK_SCALA_VERSION": "2.13"}
    env = os.environ | own | {"TMPDIR": str(tmp_path), "SPARK_LOCAL_IP": "127.0.0.1"}
    run = subprocess.run([sys.executable, "-c", SCORED, str(tmp_path), str(tmp_path / "warehouse")], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[:3000]
