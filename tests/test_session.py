"""Session defaults the package relies on."""
import os
import subprocess
import sys
from pathlib import Path

from rosterflow.session import ensure_checkpoint_dir


def test_session_defaults(spark):
    conf = spark.conf
    assert conf.get("spark.sql.adaptive.enabled") == "true"
    assert conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    assert conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.sparkContext.getConf().get("spark.ui.enabled") == "false"
    path = ensure_checkpoint_dir(spark)
    assert path and spark.sparkContext.getCheckpointDir() is not None


def _in_process(code: str, submit_args: str) -> str:
    env = {**os.environ, "PYSPARK_SUBMIT_ARGS": submit_args, "PYTHONPATH": str(Path(__file__).resolve().parents[1])}
    return subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=180, check=True).stdout.strip().splitlines()[-1]


def test_a_submitted_configuration_wins():
    code = ("from rosterflow.session import get_session; s = get_session(); "
            "print(s.sparkContext.master, s.conf.get('spark.sql.adaptive.enabled'), s.conf.get('spark.sql.session.timeZone'))")
    assert _in_process(code, "--master local[2] --conf spark.sql.adaptive.enabled=false pyspark-shell") == "local[2] false UTC"
