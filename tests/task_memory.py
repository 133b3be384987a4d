"""Runs a function in a Spark session of its own and tells what its tasks held."""

import json
import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def peak_mb(code: str, folder, timeout: int = 240, **conf: str) -> float:
    """The peak execution memory of any task of ``code`` (it finds ``spark`` and ``folder``), from Spark's event log."""
    events = folder / "events"
    events.mkdir()
    conf = {
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "3g", "spark.local.dir": f"{folder}/local",
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": events.as_uri(), "spark.eventLog.compress": "false",
        "spark.eventLog.rolling.enabled": "false", "spark.checkpoint.dir": f"{folder}/kept",
    } | conf
    start = f"""
        from windrow.session import open_session
        from pyspark.sql import functions as F
        folder = {str(folder)!r}
        spark = open_session("memory", "local[4]", **{ {k.replace(".", "__"): v for k, v in conf.items()} !r})
    """
    script = textwrap.dedent(start) + textwrap.dedent(code) + "\nspark.stop()\n"
    # The session of the tests has settings of its own in the environment.
    env = {k: v for k, v in os.environ.items() if not k.startswith(("PYSPARK_", "SPARK_"))} | {"PYTHONPATH": ROOT, "PYSPARK_PYTHON": sys.executable}
    subprocess.run([sys.executable, "-c", script], env=env, check=True, timeout=timeout)
    (log,) = events.iterdir()
    ends = [e for e in map(json.loads, log.read_text().splitlines()) if e["Event"] == "SparkListenerTaskEnd"]
    return max(e["Task Metrics"]["Peak Execution Memory"] for e in ends) / 1e6
