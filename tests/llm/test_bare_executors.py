"""Queries on workers that cannot import the package: the driver finds it by its own path only."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from vocabspark.session import local_session
import __spark_entry__
spark = local_session(4, 4)

def importable(_):
    import importlib.util
    return [importlib.util.find_spec("vocabspark") is not None]

assert spark.sparkContext.parallelize([0], 1).mapPartitions(importable).collect() == [False]
for name in sys.argv[2:]:
    assert __spark_entry__.queries()[name](spark, sys.argv[1]).count() > 0, name
print("all ran")
"""


def test_queries_run_without_the_package(sf, tmp_path):
    names = [n for n in __import__("__spark_entry__").queries() if n.startswith(("op2_", "op5_", "op6_", "op9_", "op10_", "op11_", "op12_", "op13_"))]
    names += ["encode_unigram", "train_bpe"]
    bare = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(root=ROOT), sf, *names], cwd=tmp_path, env=bare, capture_output=True, text=True, timeout=600
    )
    assert "all ran" in done.stdout, done.stderr[-3000:]
