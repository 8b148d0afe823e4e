"""The driver's entry imports in a fresh process that has no Spark session."""

import subprocess
import sys
from pathlib import Path

SAYS = "import __spark_entry__ as e; from pyspark import SparkContext; assert SparkContext._active_spark_context is None; print(len(e.queries()), len(e.oracle_sql()))"


def test_entry_imports_without_a_session():
    ran = subprocess.run([sys.executable, "-B", "-c", SAYS], cwd=Path(__file__).parent.parent, capture_output=True, text=True, timeout=120)
    assert ran.returncode == 0, ran.stderr[-2000:]
    n_queries, n_sql = map(int, ran.stdout.split()[-2:])
    assert n_queries >= n_sql >= 90
