"""A stored table as a stream in the order of its times: a data source whose offsets are ranges of time."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from ledgerlight.session import scratch_dir

FILE_ROWS = 250_000  # rows of a range, which is one task of a batch
BATCH_FILES = 8  # ranges of a batch
MARKER_DAYS = 3


def ranges(rows: DataFrame, time: Column, file_rows: int = FILE_ROWS) -> tuple[str, list[str]]:
    """The rows written as files of about `file_rows` rows, each a range of time; the folder and the files in time order.

    All ranges are written at once. Ranges are cut by (time, a hash of the row), so rows of one instant may be in several
    files, which then follow one another; rows without a time come last. A bound of the range cut is a sample's, so the
    driver holds one row for each range.
    """
    spark = rows.sparkSession
    path = scratch_dir(spark, "feed")
    files = max(1, math.ceil(rows.count() / file_rows))
    us = F.unix_micros(time)
    keyed = rows.withColumns({"_late": us.isNull(), "_us": us, "_mix": F.xxhash64(*rows.columns)})
    cut = keyed.repartitionByRange(files, "_late", "_us", "_mix") if files > 1 else keyed.coalesce(1)
    cut.write.parquet(path)
    stored = spark.read.schema(cut.schema).parquet(path)
    # Rows of one range at most share a bound with the next one, so the least key orders the files.
    least = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min(F.struct("_late", "_us", "_mix")).alias("least"))
    return path, [r["file"] for r in least.orderBy("least").select("file").collect()]


def marker(rows: DataFrame, time: str, path: str) -> list[str]:
    """A file of one row, null but for a time days behind all others: it takes the watermark past the table's last row."""
    last = rows.agg(F.max(F.col(time)).alias("last"))
    kind = rows.schema[time].dataType
    late = (F.col("last") + F.expr(f"INTERVAL {MARKER_DAYS} DAYS")).cast(kind)
    row = last.select(*[late.alias(f.name) if f.name == time else F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema])
    row.where(F.col(time).isNotNull()).coalesce(1).write.parquet(f"{path}-marker")
    stored = rows.sparkSession.read.schema(rows.schema).parquet(f"{path}-marker")
    return [r["file"] for r in stored.select(F.col("_metadata.file_path").alias("file")).distinct().collect()]


def _source() -> type:
    # Made inside a function so that it is pickled whole: the planning worker on the driver need not import the package.
    from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

    class Reader(DataSourceStreamReader):
        """Offsets count files; each call for the latest one moves on by a batch, up to the last file."""

        def __init__(self, schema, options: dict):
            self.schema = schema
            self.batches = json.loads(options["batches"])
            self.at = 0

        def initialOffset(self) -> dict:
            return {"batch": 0}

        def latestOffset(self) -> dict:
            self.at = min(self.at + 1, len(self.batches))
            return {"batch": self.at}

        def partitions(self, start: dict, end: dict) -> list:
            self.at = max(self.at, end["batch"])
            return [InputPartition(f) for batch in self.batches[start["batch"] : end["batch"]] for f in batch]

        def read(self, partition) -> Iterator:
            import pyarrow.parquet as pq
            from pyarrow import fs
            from pyspark.sql.pandas.types import to_arrow_schema

            from urllib.parse import unquote

            uri = partition.value
            if uri.startswith("file:"):
                store, path = fs.LocalFileSystem(), "/" + unquote(uri[5:]).lstrip("/")
            else:
                store, path = fs.FileSystem.from_uri(uri)
            wanted = to_arrow_schema(self.schema)
            with pq.ParquetFile(path, filesystem=store) as f:
                for batch in f.iter_batches(10_000, columns=wanted.names):
                    yield batch.select(wanted.names).cast(wanted)

    class TableReplay(DataSource):
        @classmethod
        def name(cls) -> str:
            return "table_replay"

        def schema(self) -> str:
            return self.options["table"]

        def streamReader(self, schema) -> Reader:
            return Reader(schema, self.options)

    return TableReplay


def replayed(spark: SparkSession, rows: DataFrame, time: str, to_the_end: bool = False, file_rows: int | None = None) -> DataFrame:
    """A stream of the rows in the order of `time`, BATCH_FILES ranges a batch, each range a task.

    `to_the_end` adds a row that is null but for a time behind all others, in a batch of its own, for operators that wait
    for the watermark. The ranges are written once, into the shared folder, which pyarrow has to be able to read.
    A query that is started anew begins with the first range again.
    """
    path, files = ranges(rows, F.col(time).cast("timestamp"), file_rows or FILE_ROWS)
    batches = [files[i : i + BATCH_FILES] for i in range(0, len(files), BATCH_FILES)]
    if to_the_end:
        batches.append(marker(rows, time, path))
    spark.dataSource.register(_source())
    schema = StructType([StructField(f.name, f.dataType) for f in rows.schema])  # the last row has nulls
    options = {"table": schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), "batches": json.dumps(batches)}
    return spark.readStream.format("table_replay").schema(schema).options(**options).load()
