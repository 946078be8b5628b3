"""Session settings the library relies on."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings: results need UTC, the plans rely on run-time skew splitting.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A join on a hot merchant or account is split even if that costs one more exchange later.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows on their way to Python are bounded by bytes as well as by number: texts can be long.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8388608",
    # Keyed state of any kind; it may outgrow an executor's memory.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session; memory, cores and shuffle counts stay the caller's."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each Spark context, wherever it was imported from."""
    context = spark.sparkContext
    if getattr(context, "_ledgerlight_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    above = os.path.dirname(package)
    archive = os.path.join(tempfile.mkdtemp(prefix="ledgerlight-"), "ledgerlight.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as packed:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    packed.write(path, os.path.relpath(path, above))
    context.addPyFile(archive)
    context._ledgerlight_shipped = True


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for cut lineage: the cluster's own; a temporary one only in local mode, where none is named."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if root is None:
        local = spark.sparkContext.master.split("[")[0] == "local"
        if current is None and not local:
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        root = current or tempfile.mkdtemp(prefix="ledgerlight-")
    if current is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


_open_scopes: list[list[str]] = []


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the checkpoint folder for a table written part-way through a job."""
    path = os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex}")
    if _open_scopes:
        _open_scopes[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Removes the part-way tables written inside it on leaving. Results that read them have to be written before."""
    paths: list[str] = []
    _open_scopes.append(paths)
    try:
        yield
    finally:
        _open_scopes.remove(paths)
        jvm = spark.sparkContext._jvm
        for path in paths:
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write a DataFrame as a table in the shared checkpoint folder and go on from there.

    The table survives lost executors, ends the lineage, and later steps read only the columns they use.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of jobs that have ended: it does when the driver's JVM collects what they hung on."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def stored_file(uri: str):
    """(file system, path) of a file in the shared folder for pyarrow, from the name that Spark gives it."""
    from urllib.parse import unquote

    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + unquote(uri[5:]).lstrip("/")
    return fs.FileSystem.from_uri(uri)
