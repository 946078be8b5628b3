"""Structured Streaming versions of velocity, rapid-fire, cooldown, deduplication and scoring.

Streams run until their sources have no more; sinks and state are below the checkpoint folder.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from ledgerlight.operators import alerts
from ledgerlight.operators.cells import cell_of
from ledgerlight.session import configure, cut, scratch_dir
from ledgerlight.sources.canonical import table, transactions_from_events
from ledgerlight.streaming.replay import replayed

RAPID_HOURS = 0.083
RAPID_CELL = 1800  # seconds of a cell whose rows wait together
RAPID_GROUPS = 4  # groups of accounts in a cell, at least
WATERMARK_SECONDS = 3600
WATERMARK = f"{WATERMARK_SECONDS} seconds"
PROGRESS_KEPT = "spark.sql.streaming.numRecentProgressUpdates"
# Rows that stateful operators dropped as late, in the last run of each name.
dropped_rows: dict[str, int] = {}


def event_stream(spark: SparkSession, sf_dir: str, to_the_end: bool = False) -> DataFrame:
    """The stored events table replayed in the order of event time, so that no row is late."""
    return replayed(spark, table(spark, sf_dir, "events"), "ts", to_the_end)


def transaction_stream(spark: SparkSession, sf_dir: str, to_the_end: bool = False) -> DataFrame:
    configure(spark)
    return transactions_from_events(event_stream(spark, sf_dir, to_the_end), table(spark, sf_dir, "nation"))


def _finish(writer: DataStreamWriter, spark: SparkSession, name: str, whole: bool, more_dropped: Callable[[], int] = lambda: 0) -> None:
    """Run what there is to its end and count the rows that came behind the watermark; `whole` makes them an error."""
    kept = spark.conf.get(PROGRESS_KEPT)
    spark.conf.set(PROGRESS_KEPT, "100000")
    try:
        # Batch after batch until the sources have no more; `availableNow` would take a replay as one batch.
        q = writer.trigger(processingTime="0 seconds").start()
        try:
            q.processAllAvailable()
        finally:
            q.stop()
        dropped_rows[name] = sum(o.numRowsDroppedByWatermark for p in q.recentProgress for o in p.stateOperators) + more_dropped()
    finally:
        spark.conf.set(PROGRESS_KEPT, kept)
    if dropped_rows[name]:
        said = f"{name}: {dropped_rows[name]} rows came behind the watermark and were dropped"
        if whole:
            raise ValueError(said)
        warnings.warn(said, stacklevel=3)


def run_append(stream: DataFrame, name: str, whole: bool = False) -> DataFrame:
    """Run what is available into a Parquet table and read it back."""
    spark = stream.sparkSession
    path = scratch_dir(spark, name)
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", f"{path}/rows")
    _finish(writer.option("checkpointLocation", f"{path}/state"), spark, name, whole)
    return spark.read.schema(stream.schema).parquet(f"{path}/rows")


def run_update(stream: DataFrame, name: str, keys: list[str], whole: bool = False) -> DataFrame:
    """Run changing aggregates: each batch writes its changed rows, a key's latest version counts.

    A repeated batch overwrites its own folder, so a restart changes nothing.
    """
    spark = stream.sparkSession
    path = scratch_dir(spark, name)

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/rows/batch={batch_id}")

    writer = stream.writeStream.foreachBatch(store).outputMode("update")
    _finish(writer.option("checkpointLocation", f"{path}/state"), spark, name, whole)
    rows = spark.read.parquet(f"{path}/rows")
    values = [c for c in stream.columns if c not in keys]
    return rows.groupBy(*keys).agg(*[F.max_by(c, "batch").alias(c) for c in values])


def hourly_counts(stream: DataFrame) -> DataFrame:
    """Tumbling hourly count and sum per account."""
    return _windowed(stream, F.window("timestamp", "1 hour"))


def sliding_velocity(counts: DataFrame, hours: int = 24) -> DataFrame:
    """Counts in windows of `hours` that begin every hour, from the counts of their hours.

    The stream keeps one row of state for each account and hour; only these rows are added up to windows, so no
    transaction is copied into the windows that it lies in.
    """
    starts = F.sequence(F.col("window_start") - F.expr(f"INTERVAL {hours - 1} HOURS"), F.col("window_start"), F.expr("INTERVAL 1 HOUR"))
    panes = counts.select("account_id", F.explode(starts).alias("window_start"), "txn_count")
    return panes.groupBy("account_id", "window_start").agg(F.sum("txn_count").alias("txn_count"))


def _windowed(stream: DataFrame, window: Column) -> DataFrame:
    # Spark combines rows per window before the exchange, so a busy account arrives as one row per task.
    counts = stream.withWatermark("timestamp", WATERMARK).groupBy(window.alias("w"), "account_id").count()
    return counts.select("account_id", F.col("w.start").alias("window_start"), F.col("count").alias("txn_count"))


HELD = pa.schema([("us", pa.int64()), ("account_id", pa.string()), ("transaction_id", pa.string()), ("own", pa.bool_())])


def _to_bytes(rows: pd.DataFrame) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, HELD) as w:
        w.write_table(pa.Table.from_pandas(rows[HELD.names], HELD, preserve_index=False).replace_schema_metadata())
    return out.getvalue().to_pybytes()


class _RapidFire(StatefulProcessor):
    """Holds the rows of a cell of some accounts until the watermark has passed its end, then goes through them in order."""

    def __init__(self, hours: float, cell_seconds: int):
        self.hours, self.cell_seconds = hours, cell_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "held binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if key[1] is None or pd.isna(key[1]):
            # Rows without a time have no previous one.
            for part in rows:
                yield pd.DataFrame({"transaction_id": part["transaction_id"], "rapid_fire": 0}).astype({"rapid_fire": "int32"})
            return
        # One state row for all that came, as each row is a call to the state.
        for part in rows:
            self.rows.appendValue((_to_bytes(part),))
        self.handle.registerTimer((int(key[1]) + 1) * self.cell_seconds * 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = pa.concat_tables(pa.ipc.open_stream(bytes(r[0])).read_all() for r in self.rows.get()).to_pandas()
        held = held.sort_values(["account_id", "us", "transaction_id"])
        account = held["account_id"]
        same = (account == account.shift()) | (account.isna() & account.shift().isna())
        gap = held["us"].diff() / 3.6e9
        held["rapid_fire"] = (same & (gap < self.hours)).astype("int32")
        self.rows.clear()
        yield held.loc[held["own"], ["transaction_id", "rapid_fire"]]

    def close(self) -> None:
        pass


def rapid_fire(stream: DataFrame, hours: float = RAPID_HOURS, cell_seconds: int = RAPID_CELL, groups: int | None = None) -> DataFrame:
    """Flags a transaction that follows the account's previous one, by time and id, within the limit.

    State is the rows of a group of accounts and cell of time, which is a few times the limit long. A cell also gets the
    rows of the one before that lie within the limit of its end, so cells need nothing else from one another and a busy
    account is the work of many tasks. A cell waits until the watermark has passed its end: rows may come in any order
    before that, and every row of a cell that is not late is flagged exactly as the batch operator flags it.

    Accounts are dealt over `groups` by hash: an account alone has few rows in a cell, and each key costs several calls
    between Spark and Python. By default there are an eighth as many groups as shuffle partitions, RAPID_GROUPS at least.
    """
    groups = groups or max(RAPID_GROUPS, int(stream.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 8)
    limit = int(hours * 3.6e9)
    us = F.unix_micros("timestamp")
    rows = stream.withWatermark("timestamp", WATERMARK).select(
        "transaction_id", "account_id", "timestamp", us.alias("us"), cell_of(us, cell_seconds).alias("home")
    )
    copies = F.when(F.col("home").isNull(), F.array(F.col("home"))).otherwise(
        F.sequence(F.col("home"), cell_of(F.col("us") + F.lit(limit), cell_seconds))
    )
    spread = rows.withColumn("cell", F.explode(copies)).withColumn("own", F.col("cell").eqNullSafe(F.col("home"))).drop("home")
    spread = spread.withColumn("part", F.pmod(F.xxhash64("account_id"), F.lit(groups)).cast("int"))
    return spread.groupBy("part", "cell").transformWithStateInPandas(
        _RapidFire(hours, cell_seconds), StructType.fromDDL("transaction_id string, rapid_fire int"), "append", "EventTime"
    )


class InOrder:
    """Runs a batch step on the rows of a stream in the order of their times, as the watermark passes them.

    `step(closed, state)` gets the rows that the watermark has just passed, all later than those of the calls before, and
    the state table that the last call returned; it returns result rows and the next state. Both are ordinary
    DataFrames, so joins and windows deal a busy account over many tasks. Rows wait in a table in the shared folder;
    every batch writes folders of its own number, so a repeated batch changes nothing.
    """

    def __init__(self, spark: SparkSession, name: str, step: Callable, state_schema: str, delay_seconds: int = WATERMARK_SECONDS):
        self.spark, self.step, self.state_schema = spark, step, state_schema
        self.delay = delay_seconds * 1_000_000
        self.path = scratch_dir(spark, name)
        self.passed: dict[int, tuple[int | None, int]] = {}  # batch -> watermark behind it, late rows up to it
        self.schema = self.out_schema = None

    def _stored(self, kind: str, batch: int, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{kind}/{batch}")

    def advance(self, new: DataFrame, batch: int, last: bool = False) -> None:
        before, late = self.passed.get(batch - 1, (None, 0))
        us = F.unix_micros("timestamp")
        timely = new if before is None else new.where(us.isNull() | (us > before))
        self.schema = self.schema or new.schema
        rows = timely
        if batch > 0:
            held = self._stored("rows", batch - 1, self.schema)
            rows = rows.unionByName(held if before is None else held.where(us > before))
        rows.write.mode("overwrite").parquet(f"{self.path}/rows/{batch}")
        rows = self._stored("rows", batch, self.schema)
        if before is not None:
            late += new.where(us <= before).count()
        newest = rows.agg(F.max(us)).first()[0]
        mark = max((x for x in (before, None if newest is None else newest - self.delay) if x is not None), default=None)
        self.passed[batch] = (mark, late)
        if last:
            closed = rows
        else:
            closed = rows.where(us.isNull() | (us <= mark)) if mark is not None else rows.where(us.isNull())
        state = self._stored("state", batch - 1, self.state_schema) if batch > 0 else self.spark.createDataFrame([], self.state_schema)
        out, state = self.step(closed, state)
        out.write.mode("overwrite").parquet(f"{self.path}/out/batch={batch}")
        self.out_schema = out.schema
        state.write.mode("overwrite").parquet(f"{self.path}/state/{batch}")

    def run(self, stream: DataFrame, name: str, whole: bool = False) -> DataFrame:
        """Run the stream to its end, close what still waits, and read the results back."""
        writer = stream.writeStream.foreachBatch(self.advance).option("checkpointLocation", f"{self.path}/checkpoint")
        _finish(writer, self.spark, name, whole, lambda: max((n for _, n in self.passed.values()), default=0))
        if not self.passed:
            return self.spark.createDataFrame([], self.step(self.spark.createDataFrame([], stream.schema), self.spark.createDataFrame([], self.state_schema))[0].schema)
        self.advance(self.spark.createDataFrame([], self.schema), max(self.passed) + 1, last=True)
        return self.spark.read.schema(self.out_schema).parquet(f"{self.path}/out").drop("batch")


def _cooldown_step(hours: int) -> Callable:
    wait = hours * 3600 * 1_000_000

    def step(closed: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
        rows = closed.where("timestamp IS NOT NULL").join(state, "account_id", "left")
        ready = cut(rows.where((F.col("last_us") + wait <= F.unix_micros("timestamp")) | F.col("last_us").isNull()).drop("last_us"), "ready")
        passed = cut(alerts.cooldown(ready, hours).select("transaction_id", "account_id", F.unix_micros("timestamp").alias("last_us")), "passed")
        last = state.unionByName(passed.select("account_id", "last_us")).groupBy("account_id").agg(F.max("last_us").alias("last_us"))
        return passed.select("transaction_id", "account_id"), last

    return step


def cooldown(stream: DataFrame, name: str = "cooldown", hours: int = alerts.COOLDOWN_HOURS, whole: bool = False) -> DataFrame:
    """At most one alert per account within the cooldown, counted from the last alert let through, as in the batch operator.

    An alert's fate rests on all alerts of its account before it, so no key smaller than an account can hold the state,
    and a busy account must not be one task's. Each batch therefore follows the chains of the rows that the watermark
    has passed with the batch operator, from a stored table of each account's last alert. Alerts may come in any order
    within the watermark; later ones are dropped and counted. Alerts without a time are let through by neither.
    """
    spark = stream.sparkSession
    rows = stream.select("transaction_id", "account_id", "timestamp")
    return InOrder(spark, name, _cooldown_step(hours), "account_id string, last_us bigint").run(rows, name, whole)


def deduplicated(stream: DataFrame, key: str = "transaction_id", within: str = WATERMARK) -> DataFrame:
    """First arrival of each id within the watermark."""
    return stream.withWatermark("timestamp", within).dropDuplicatesWithinWatermark([key])


def score(stream: DataFrame, model, name: str = "score") -> DataFrame:
    """Stateless scoring with a fitted pipeline."""
    from ledgerlight.ml.supervised import score_random_forest

    return score_random_forest(stream, model, name)
