"""Shared folders, removal of part-way tables, and the package in Python workers."""

import os
import subprocess
import sys

import pytest

from ledgerlight import session


class Elsewhere:
    """A session on a cluster that names no shared folder."""

    class conf:
        get = staticmethod(lambda key, default=None: default)

    class sparkContext:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Elsewhere)


def test_scope_removes_its_tables(spark):
    with session.scratch_scope(spark):
        kept = session.cut(spark.range(5))
        path = kept.inputFiles()[0].removeprefix("file://")
        assert kept.count() == 5 and os.path.exists(path)
    assert not os.path.exists(os.path.dirname(path))
    outside = session.cut(spark.range(3))
    assert outside.count() == 3


def test_workers_find_the_package_from_any_folder(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from ledgerlight import configure
spark = configure(SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate())
def where(_):
    import ledgerlight.session
    return ledgerlight.session.__file__
print('FOUND', spark.sparkContext.parallelize([1]).map(where).first())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert "ledgerlight.zip" in done.stdout, done.stderr[-2000:]
