"""The shared folder on sessions that do not name one."""

import os
import subprocess
import sys

from agrimill import session

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

STOCK = """
from pyspark.sql import SparkSession
from agrimill.session import configure, shared_dir, stored
spark = configure(SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate())
assert spark.conf.get("spark.checkpoint.dir", None) is None
assert shared_dir(spark) == shared_dir(spark)
print("rows", stored(spark.range(3), "x").count())
"""


def test_stock_session_gets_a_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k not in ("SPARK_CONF_DIR", "PYSPARK_SUBMIT_ARGS")}
    env |= {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": os.pathsep.join([ROOT, env.get("PYTHONPATH", "")]), "TMPDIR": str(tmp_path)}
    out = subprocess.run([sys.executable, "-c", STOCK], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=180)
    assert "rows 3" in out.stdout, out.stderr[-2000:]


def test_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master, applicationId = "spark://somewhere:7077", "app"

    class Session:
        conf, sparkContext = Conf(), Context()

    try:
        session.shared_dir(Session())
    except ValueError as refused:
        assert "spark.checkpoint.dir" in str(refused)
    else:
        raise AssertionError("a local folder was taken on a cluster")
