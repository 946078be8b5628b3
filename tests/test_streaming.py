import pytest
from pyspark.sql import functions as F

from ledgerlight.streaming import streams as st

SCHEMA = "transaction_id string, account_id string, timestamp timestamp"


def feed(spark, folder, batches):
    """One file per batch, read one per trigger."""
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "transaction_id string, account_id string, timestamp string")
        df.withColumn("timestamp", F.col("timestamp").cast("timestamp")).coalesce(1).write.mode("append").parquet(str(folder))
        if i < len(batches) - 1:
            import time

            time.sleep(1.1)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder))


def test_repeats_and_late_rows_are_dropped(spark, tmp_path):
    stream = feed(spark, tmp_path / "in", [
        [("a", "x", "2024-01-01 10:00:00"), ("a", "x", "2024-01-01 10:00:00")],
        [("b", "x", "2024-01-01 15:00:00"), ("a", "x", "2024-01-01 10:00:00")],
        [("c", "x", "2024-01-01 15:30:00"), ("late", "x", "2024-01-01 09:00:00")],
    ])
    out = st.run_append(st.deduplicated(stream), "dedup")
    assert sorted(r["transaction_id"] for r in out.collect()) == ["a", "b", "c"]


def test_counts_over_several_batches(spark, tmp_path):
    stream = feed(spark, tmp_path / "in", [
        [("a", "x", "2024-01-01 10:00:00"), ("b", "x", "2024-01-01 10:10:00")],
        [("c", "x", "2024-01-01 10:20:00"), ("d", "y", "2024-01-01 10:59:59")],
    ])
    out = st.run_update(st.hourly_counts(stream), "hourly", ["account_id", "window_start"])
    assert {(r["account_id"], r["txn_count"]) for r in out.collect()} == {("x", 3), ("y", 1)}


END = [(None, None, "2030-01-01 00:00:00")]


def test_rapid_fire_across_batches_and_cells(spark, tmp_path):
    stream = feed(spark, tmp_path / "in", [
        [("a", "x", "2024-01-01 23:00:00"), ("b", "x", "2024-01-01 23:58:00")],
        [("c", "x", "2024-01-02 00:01:00"), ("d", "x", "2024-01-02 00:10:00"), ("e", "x", "2024-01-02 00:10:00"), ("f", "x", None)],
        END,
    ])
    out = st.run_append(st.rapid_fire(stream), "rapid")
    assert {r["transaction_id"]: r["rapid_fire"] for r in out.collect()} == {"a": 0, "b": 0, "c": 1, "d": 0, "e": 1, "f": 0}


def test_rapid_fire_tells_the_accounts_of_a_group_apart(spark, tmp_path):
    stream = feed(spark, tmp_path / "in", [
        [("a", "x", "2024-01-01 10:00:00"), ("b", "y", "2024-01-01 10:01:00"), ("n", None, "2024-01-01 10:02:00")],
        [("c", "x", "2024-01-01 10:03:00"), ("d", "y", "2024-01-01 10:20:00"), ("m", None, "2024-01-01 10:04:00"), ("f", "y", None)],
        END,
    ])
    out = st.run_append(st.rapid_fire(stream, groups=1), "grouped")
    assert {r["transaction_id"]: r["rapid_fire"] for r in out.collect()} == {"a": 0, "b": 0, "c": 1, "d": 0, "n": 0, "m": 1, "f": 0}


def test_cooldown_across_batches(spark, tmp_path):
    stream = feed(spark, tmp_path / "in", [
        [("a", "x", "2024-01-01 10:00:00"), ("b", "x", "2024-01-01 20:00:00")],
        [("c", "x", "2024-01-02 09:00:00"), ("d", "x", "2024-01-02 10:00:00"), ("e", "y", "2024-01-02 10:00:00"), ("f", "y", None)],
    ])
    out = st.cooldown(stream)
    assert sorted(r["transaction_id"] for r in out.collect()) == ["a", "d", "e"]


def test_cooldown_drops_and_counts_late_alerts(spark, tmp_path):
    stream = feed(spark, tmp_path / "in", [
        [("a", "x", "2024-01-01 10:00:00")], [("b", "x", "2024-01-03 15:00:00")], [("late", "x", "2024-01-01 09:00:00"), ("c", "x", "2024-01-03 14:30:00")],
    ])
    with pytest.warns(UserWarning, match="1 rows"):
        out = st.cooldown(stream, "late_alerts")
    # The earlier alert that arrives second, within the watermark, comes first.
    assert sorted(r["transaction_id"] for r in out.collect()) == ["a", "c"]


@pytest.fixture(scope="module")
def arrivals(spark, tmp_path_factory):
    """1,500 transactions, a third in one account, in 6 batches; each arrives up to 50 minutes out of order."""
    import random

    rng = random.Random(8)
    rows = []
    for i in range(1500):
        at = rng.randrange(4 * 86400)
        rows.append((f"t{i:04d}", "hot" if i % 3 == 0 else f"a{rng.randrange(12)}", at - at % rng.choice([1, 60, 600])))
    rows.sort(key=lambda r: r[2] + rng.randrange(3000))

    def text(s):
        return f"2024-01-{1 + s // 86400:02d} {s // 3600 % 24:02d}:{s // 60 % 60:02d}:{s % 60:02d}"

    rows = [(a, b, text(s)) for a, b, s in rows]
    folder = tmp_path_factory.mktemp("arrivals")
    stream = feed(spark, folder / "in", [rows[k : k + 250] for k in range(0, 1500, 250)] + [END])
    whole = spark.createDataFrame(rows, "transaction_id string, account_id string, timestamp string")
    return stream, whole.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withColumn("amount", F.lit(1.0))


def test_shuffled_arrivals_are_flagged_as_the_batch_operator_flags_them(spark, arrivals):
    from ledgerlight.operators import velocity as vel
    from ledgerlight.operators.cells import with_time_cell

    stream, whole = arrivals
    got = {r["transaction_id"]: r["rapid_fire"] for r in st.run_append(st.rapid_fire(stream, cell_seconds=400), "live", whole=True).collect()}
    rows = vel.number_rows(with_time_cell(whole), vel.ACCOUNT)
    rows = vel.with_recent(rows).withColumn("gap", vel.hours_since_previous(24.0))
    want = {r["transaction_id"]: int(r["gap"] < st.RAPID_HOURS) for r in rows.select("transaction_id", "gap").collect()}
    assert got == want and 100 < sum(want.values()) < 1400


def test_shuffled_arrivals_cool_down_as_in_the_batch_operator(spark, arrivals):
    from ledgerlight.operators import alerts

    stream, whole = arrivals
    got = sorted(r["transaction_id"] for r in st.cooldown(stream.where("account_id IS NOT NULL"), "live_cooldown", hours=2, whole=True).collect())
    want = sorted(r["transaction_id"] for r in alerts.cooldown(whole, 2).collect())
    assert got == want and len(want) > 100


def test_sinks_live_in_the_shared_folder(spark):
    from ledgerlight.session import scratch_dir

    assert scratch_dir(spark, "t").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_ranges_come_in_order_and_equal_times_span_files(spark):
    """150 ranges of shuffled rows, half of them at one instant: all rows once, no range before the one ahead of it."""
    from ledgerlight.streaming import replay

    late = F.timestamp_seconds(F.lit(1_704_100_000) + F.pmod(F.xxhash64("id"), F.lit(100_000)))
    rows = spark.range(6000).select("id", F.when(F.col("id") % 2 == 0, F.timestamp_seconds(F.lit(1_704_150_000))).otherwise(late).alias("at"))
    rows = rows.withColumn("at", F.when(F.col("id") != 5, F.col("at")))
    path, files = replay.ranges(rows.repartition(7), F.col("at"), 40)
    assert len(files) > 100
    seen, last = [], None
    for k, f in enumerate(files):
        part = spark.read.parquet(f).select("id", F.unix_micros("at").alias("us")).collect()
        times = [r["us"] for r in part if r["us"] is not None]
        assert not times or last is None or min(times) >= last
        assert all(r["us"] is not None for r in part) or k == len(files) - 1
        last = max(times, default=last)
        seen += [r["id"] for r in part]
    assert sorted(seen) == list(range(6000))
    at_once = sum(1 for f in files if spark.read.parquet(f).where(F.unix_seconds("at") == 1_704_150_000).count())
    assert at_once > 20


def test_replay_goes_batch_by_batch(spark, monkeypatch):
    from ledgerlight.streaming import replay

    monkeypatch.setattr(replay, "BATCH_FILES", 3)
    rows = spark.range(500).select("id", F.timestamp_seconds(F.lit(1_704_100_000) + F.col("id") * 60).alias("at"))
    batches = {}
    q = replay.replayed(spark, rows.repartition(4), "at", to_the_end=True, file_rows=50).writeStream
    q = q.foreachBatch(lambda df, k: batches.update({k: df.collect()})).start()
    q.processAllAvailable()
    q.stop()
    ordered = [batches[k] for k in sorted(batches)]
    assert sorted(r["id"] for b in ordered[:-1] for r in b) == list(range(500)) and len(ordered) >= 4
    assert all(max(r["at"] for r in a) <= min(r["at"] for r in b) for a, b in zip(ordered[:-1], ordered[1:], strict=True))
    assert [r["id"] for r in ordered[-1]] == [None]


def test_source_reads_a_table_folder(spark, tmp_path):
    from ledgerlight.streaming import streams

    for name in ("events", "nation"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    got = streams.run_append(streams.transaction_stream(spark, str(tmp_path)), "folder")
    want = streams.run_append(streams.transaction_stream(spark, "/root/testdata/sf0.001"), "file")
    assert sorted(got.collect()) == sorted(want.collect()) and got.count() == 1000


@pytest.fixture(scope="module")
def shuffled(spark, tmp_path_factory):
    """The events in 200 files, not in order of time: with 64 a batch, rows of the third batch come behind the watermark."""
    folder = tmp_path_factory.mktemp("shuffled")
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").repartition(200).write.parquet(f"{folder}/events.parquet")
    spark.read.parquet("/root/testdata/sf0.001/nation.parquet").write.parquet(f"{folder}/nation.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["stream_hourly_counts", "stream_rapid_fire", "stream_cooldown", "stream_dedup"])
def test_shuffled_files_lose_no_rows(spark, shuffled, monkeypatch, name):
    from ledgerlight.streaming import replay
    from ledgerlight.plans.streams import stream_cooldown, stream_dedup, stream_hourly_counts, stream_rapid_fire

    run = {f.__name__: f for f in (stream_hourly_counts, stream_rapid_fire, stream_cooldown, stream_dedup)}[name]
    want = sorted(run(spark, "/root/testdata/sf0.001").collect())
    monkeypatch.setattr(replay, "FILE_ROWS", 60)
    monkeypatch.setattr(replay, "BATCH_FILES", 4)
    assert sorted(run(spark, shuffled).collect()) == want


def test_dropped_rows_are_counted(spark, tmp_path):
    stream = feed(spark, tmp_path / "in", [[("a", "x", "2024-01-01 10:00:00")], [("b", "x", "2024-01-01 15:00:00")], [("late", "x", "2024-01-01 09:00:00")]])
    with pytest.warns(UserWarning, match="1 rows"):
        st.run_append(st.deduplicated(stream), "late")
    assert st.dropped_rows["late"] == 1
    with pytest.raises(ValueError, match="behind the watermark"):
        st.run_append(st.deduplicated(stream), "late", whole=True)
