import pytest
from pyspark.sql import functions as F

from ledgerlight.operators import evaluate as ev
from ledgerlight.operators import quality as dq


def scores(spark, rows):
    return spark.createDataFrame(rows, "y int, p int, s double")


def test_auc_gives_half_credit_for_ties(spark):
    df = scores(spark, [(0, 0, 0.5), (0, 0, 0.1), (1, 0, 0.5), (1, 0, 0.9)])
    assert ev.roc_auc(df, "y", "s").first()[0] == pytest.approx(0.875)


def test_auc_without_one_class(spark):
    assert ev.roc_auc(scores(spark, [(0, 0, 0.5)]), "y", "s").first()[0] == 0


def test_zero_division(spark):
    row = ev.precision_recall(scores(spark, [(0, 0, 0.5), (0, 0, 0.1)]), "y", "p").first()
    assert (row["precision"], row["recall"], row["f1"], row["alert_rate"]) == (0, 0, 0, 0)


@pytest.mark.parametrize("p,r,f,band", [(0.9, 0.8, 0.85, "excellent"), (0.9, 0.5, 0.64, "good"), (0.1, 0.1, 0.1, "needs improvement")])
def test_bands(spark, p, r, f, band):
    df = spark.createDataFrame([(p, r, f)], "precision double, recall double, f1 double")
    assert ev.status_band(df).first()["status"] == band


def test_best_method(spark):
    df = spark.createDataFrame([("a", 0.2), ("b", 0.7)], "method string, f1_score double")
    assert ev.best_method(df).first()["method"] == "b"


def test_histogram_keeps_the_maximum(spark):
    df = spark.range(101).withColumn("x", F.col("id").cast("double"))
    rows = {r["bin"]: r["n"] for r in ev.histogram(df, "x", 50).collect()}
    assert sum(rows.values()) == 101 and rows[50] == 3 and max(rows) == 50


def test_accuracy_drops_incomplete_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0), (3.0, float("nan")), (4.0, 2.0)], "actual double, predicted double")
    row = ev.forecast_accuracy(df).first()
    assert row["mae"] == pytest.approx(1.5) and row["mean_actual"] == pytest.approx(2.5)


def test_duplicates_and_nulls(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1), ("c", 2)], "k string, v int")
    row = dq.duplicate_rate(df).first()
    assert (row["row_count"], row["duplicate_rows"], row["duplicate_rate"]) == (4, 1, 0.25)
    missing = {r["column_name"]: (r["missing_rate"], r["too_high"]) for r in dq.missing_rates(df).collect()}
    assert missing == {"k": (0.0, 0), "v": (0.5, 1)}


def test_schema_checks(spark):
    assert dq.schema_checks(spark.createDataFrame([("a", "b")], "timestamp string, amount string")) == {
        "has_required_columns": False,
        "timestamp_is_datetime": False,
        "amount_is_numeric": False,
    }


def test_time_gaps(txns):
    t = txns([("a", "x", "2024-01-01 00:00:00", 1.0), ("b", "y", "2024-01-01 01:00:00", 1.0), ("c", "x", "2024-01-01 04:00:00", 1.0)])
    row = dq.time_gaps(t).first()
    assert (row["avg_time_gap_hours"], row["max_time_gap_hours"]) == (2.0, 3.0)


def test_time_gaps_within_and_between_hours(skewed, txns):
    t, frame = skewed
    steps = frame["timestamp"].sort_values().diff().dropna().dt.total_seconds() / 3600
    row = dq.time_gaps(t).first()
    assert row["avg_time_gap_hours"] == pytest.approx(steps.mean()) and row["max_time_gap_hours"] == pytest.approx(steps.max())
    row = dq.time_gaps(txns([("a", "x", "2024-01-01 00:01:00", 1.0), ("b", "y", "2024-01-01 00:31:00", 1.0), ("c", "y", "2024-01-01 00:31:00", 1.0)])).first()
    assert row["max_time_gap_hours"] == 0.5
    assert dq.time_gaps(t.limit(1)).first()["max_time_gap_hours"] is None
    assert dq.time_gaps(t.limit(0)).first()["max_time_gap_hours"] is None


def test_duplicates_where_fingerprints_tie(spark, skewed):
    t, frame = skewed
    rows = t.select("merchant_name", "city", "channel", F.when(F.col("is_fraud") == 1, None).otherwise(F.col("amount") % 1).alias("x"))
    pandas = rows.toPandas()
    want = int(pandas.duplicated().sum())
    assert want > 0
    for mark in (dq.fingerprint, lambda c: F.pmod(F.xxhash64(*c), F.lit(3)), lambda c: F.lit(1)):
        row = dq.duplicate_rate(rows, mark).first()
        assert (row["row_count"], row["duplicate_rows"]) == (len(frame), want) and row["duplicate_rate"] == want / len(frame)
    assert dq.duplicate_rate(t).first()["duplicate_rows"] == 0
    zeros = spark.createDataFrame([(0.0, None, 1), (-0.0, None, 1), (float("nan"), 1, None), (float("nan"), None, 1)], "a double, b int, c int")
    assert dq.duplicate_rate(zeros).first()["duplicate_rows"] == 1
    assert tuple(dq.duplicate_rate(zeros.limit(0)).first()) == (None, None, None)


def test_ingest_writes_the_table_and_evaluates_its_source_once(spark, skewed, tmp_path):
    t, frame = skewed
    calls = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            calls.add(len(b))
            yield b

    source = t.mapInPandas(count, t.schema)
    table, metrics = dq.ingest(source, str(tmp_path / "t"))
    got = {r["metric"]: r["value"] for r in metrics.collect()}
    assert calls.value == len(frame) == table.count()
    assert got["amount_mean"] == pytest.approx(frame["amount"].mean()) and got["amount_std"] == pytest.approx(frame["amount"].std())
    assert got["negative_amount_rate"] == pytest.approx((frame["amount"] < 0).mean()) and got["duplicate_rate"] == 0
    empty = {r["metric"]: r["value"] for r in dq.ingest(t.limit(0), str(tmp_path / "e"))[1].collect()}
    assert empty["amount_mean"] is None and empty["duplicate_rate"] is None


def test_key_quality(txns):
    t = txns([("a", "x", "2024-01-01", 1.0), ("a", None, "2024-01-01", 1.0)])
    rows = {r["check_name"]: r["violations"] for r in dq.key_quality(t).collect()}
    assert rows["transaction_id_repeated"] == 1 and rows["account_id_null"] == 1 and rows["amount_null"] == 0


def test_bad_amounts_are_missing_and_break_nothing(spark, txns):
    from ledgerlight.operators import quality as dq
    from ledgerlight.operators.cells import quantile

    rows = [(f"t{i}", "a", "2024-01-01 10:00:00", x) for i, x in enumerate([1.0, 3.0, float("nan"), float("inf"), float("-inf"), None, 1e300])]
    t = txns(rows)
    missing = {r["column_name"]: r["missing_rate"] for r in dq.missing_rates(t).collect()}
    assert missing["amount"] == pytest.approx(4 / 7) and missing["account_id"] == 0
    row = dq.amount_quality(t).first()
    assert row["amount_mean"] == 2.0 and row["amount_std"] == pytest.approx(2**0.5)
    assert row["amount_out_of_bounds_rate"] == pytest.approx(1 / 7)
    assert quantile(t.where("amount < 100 OR isnan(amount)"), "amount", 0.5).first()[0] == 2.0
    assert dq.ingest_metrics(t).count() > 5


def test_deviation_at_a_million_million_rows(spark):
    from pyspark.sql import functions as F

    from ledgerlight.functions.scalar import unit_std

    n, x = 10**12, 10**8
    rows = spark.range(1).select(
        F.lit(n).alias("n"), F.lit(str(n * x)).cast("decimal(38,0)").alias("s"), F.lit(str(n * x * x)).cast("decimal(38,0)").alias("q"),
        F.lit(str(n * x * x + n * 10**4)).cast("decimal(38,0)").alias("q2"),
    )
    same, other = rows.select(unit_std(F.col("n"), F.col("s"), F.col("q")), unit_std(F.col("n"), F.col("s"), F.col("q2"))).first()
    assert same == 0.0 and other == pytest.approx(0.01)
