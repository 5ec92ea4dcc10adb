"""The oracle SQL needs neither Spark nor any of its files."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_sql_texts_build_without_a_session_or_jars():
    code = (
        "import builtins, glob, zipfile\n"
        "def refuse(*a, **k): raise AssertionError('file lookup')\n"
        "glob.glob = refuse; zipfile.ZipFile = refuse\n"
        "from termite.plans.oracle import ORACLE\n"
        "texts = dict(ORACLE)\n"
        "from pyspark.sql import SparkSession\n"
        "assert SparkSession.getActiveSession() is None\n"
        "assert len(texts) >= 83 and all(t.strip() for t in texts.values())\n"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
