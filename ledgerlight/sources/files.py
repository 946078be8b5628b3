"""File scans and sinks."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerlight.session import cut
from ledgerlight.sources.schemas import ACCOUNTS, EVALUATION_LOG, TRANSACTIONS

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).option("timestampFormat", TIME_FORMAT).csv(path)
    return path


REJECTED = "_rejected"


def scan_csv(spark: SparkSession, path: str, schema: StructType = TRANSACTIONS) -> tuple[DataFrame, DataFrame]:
    """Rows of a folder of CSV files, and (file, line) of the lines that do not fit the schema.

    Every file's columns are found by its own header: files may order them differently and leave some out (nulls).
    Columns that the schema does not know stay as text. A line is rejected if a value is not of its column's type or
    the number of values is wrong; it is parsed whole whatever columns are read, so both tables always agree. Lines
    equal to their file's header and empty lines are no rows. Values do not span lines. A first pass finds the headers;
    only the different ones reach the driver.
    """
    lines = spark.read.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at")
    ).where("trim(line) != ''")
    first = lines.where("at = 0").withColumn("place", F.monotonically_increasing_id())
    first = cut(first.groupBy("file").agg(F.min_by("line", "place").alias("header")), "headers")
    headers = [r["header"] for r in first.groupBy("header").agg(F.min("file").alias("f")).orderBy("f").collect()]
    known = {f.name: StructField(f.name, f.dataType) for f in schema.fields}
    if not headers:
        empty = spark.createDataFrame([], StructType(list(known.values())))
        return empty, spark.createDataFrame([], "file string, line string")
    shapes = {h: [c.strip() for c in next(csv.reader([h.lstrip("\ufeff")]))] for h in headers}
    for names in shapes.values():
        if len(set(names)) < len(names):
            raise ValueError(f"a header names a column twice: {names}")
    every = list(dict.fromkeys(c for names in shapes.values() for c in names))
    fields = [known.get(c, StructField(c, StringType())) for c in every]

    def parsed(names: list[str]):
        own = [known.get(c, StructField(c, StringType())) for c in names] + [StructField(REJECTED, StringType())]
        ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in own)
        return F.from_csv("line", ddl, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECTED})

    rows = lines.join(first, "file").where("line != header")
    out = None
    for h, names in shapes.items():
        row = parsed(names)
        same = F.struct(
            *[(row[f.name] if f.name in names else F.lit(None).cast(f.dataType)).alias(f.name) for f in fields], row[REJECTED].alias(REJECTED)
        )
        out = F.when(F.col("header") == h, same) if out is None else out.when(F.col("header") == h, same)
    rows = rows.select("file", "line", out.alias("row"))
    bad = F.col(f"row.{REJECTED}").isNotNull()
    return rows.where(~bad).select(*[F.col("row").getField(f.name).alias(f.name) for f in fields]), rows.where(bad).select("file", "line")


def read_transactions_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The rows of `scan_csv`, without those that do not fit."""
    return scan_csv(spark, path, schema or TRANSACTIONS)[0]


def read_accounts_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ACCOUNTS).option("header", True).csv(path)


def first_n(df: DataFrame, key: str, n: int) -> DataFrame:
    """First n rows in key order."""
    return df.orderBy(key).limit(n)


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows in an order given by a hash of key and seed: the same rows on any cluster."""
    return df.orderBy(F.md5(F.concat(F.col(key), F.lit(str(seed)))), key).limit(n)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Parquet table partitioned by transaction date, so date filters prune files.

    Rows are brought together by date first, so a date has few files; busy dates are split into even parts.
    """
    dated = df.withColumn("txn_date", F.to_date("timestamp")).hint("rebalance", "txn_date")
    dated.write.mode(mode).partitionBy("txn_date").parquet(path)
    return path


def append_evaluation(results: DataFrame, path: str) -> str:
    """One row per method with the run's time; columns that the results lack are null."""
    stamped = results.withColumn("run_at", F.current_timestamp())
    columns = [F.col(f.name) if f.name in stamped.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in EVALUATION_LOG]
    stamped.select(*columns).write.mode("append").parquet(path)
    return path


SCORED_COLUMNS = [
    "transaction_id",
    "timestamp",
    "account_id",
    "amount",
    "merchant_name",
    "is_anomaly_enhanced",
    "anomaly_score_enhanced",
    "risk_score",
]


def write_scored(df: DataFrame, path: str) -> str:
    """Scored rows with the published columns; a missing risk score is 0.5."""
    if "risk_score" not in df.columns:
        df = df.withColumn("risk_score", F.lit(0.5))
    df.select(*SCORED_COLUMNS).write.mode("overwrite").parquet(path)
    return path
