import pytest
from pyspark.sql import functions as F

from ledgerlight.functions import scalar as fn
from ledgerlight.operators import marts
from ledgerlight.operators import forecast as fc
from ledgerlight.operators import merchant as mer
from ledgerlight.operators.cells import with_time_cell
from ledgerlight.plans import profiles
from ledgerlight.sources import canonical as src
from ledgerlight.sources import files


def test_amount_bins(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 25.0, 25.01, -500.0, 2000.01)], "amount double")
    assert [r[0] for r in df.select(fn.amount_category(F.abs("amount"))).collect()] == [None, "micro", "small", "medium", "xlarge"]


def test_hours(txns):
    hours = (5, 6, 9, 17, 18, 21, 22)
    t = fn.time_features(txns([(str(h), "x", f"2024-01-06 {h:02d}:30:00", 1.0) for h in hours]))
    rows = {r["hour_of_day"]: r for r in t.collect()}
    assert [h for h in hours if rows[h]["is_night"]] == [5, 6, 22]
    assert [h for h in hours if rows[h]["is_business_hours"]] == [9, 17]
    assert rows[5]["is_weekend"] == 1 and rows[5]["day_of_week"] == 5


def test_calendar(spark):
    days = spark.sql("SELECT explode(array(date'2024-02-28', date'2024-02-29', date'2024-12-25')) AS date")
    rows = {str(r["date"]): r for r in src.calendar_attributes(days).collect()}
    assert [rows[d]["is_month_end"] for d in sorted(rows)] == [0, 1, 0]
    assert rows["2024-12-25"]["holiday_name"] == "Christmas" and rows["2024-02-29"]["is_holiday"] == 0


def test_long_keys_stay_distinct(spark):
    df = spark.createDataFrame([(7,), (12340,), (12341,)], "k long")
    assert [r[0] for r in df.select(fn.padded(F.col("k"), 4)).collect()] == ["0007", "12340", "12341"]


def test_card_data(spark):
    raw = spark.createDataFrame(
        [("2019-01-01 00:00:18", "42", "shop", "misc_net", 4.97, "ab", 0), ("2019-01-01 00:00:19", "43", "x", "travel", 1.0, "cd", 1)],
        "trans_date_trans_time string, cc_num string, merchant string, category string, amt double, trans_num string, is_fraud int",
    )
    rows = src.canonical_card(raw).orderBy("transaction_id").collect()
    assert [r["transaction_id"] for r in rows] == ["txn_000000ab", "txn_000000cd"]
    assert [r["channel"] for r in rows] == ["online", "pos"] and rows[0]["account_id"] == "acc_42"


def test_csv_with_missing_and_reordered_columns(spark, tmp_path):
    df = spark.createDataFrame([(1.5, "a", "2024-01-01 10:00:00", "x", 0.25)], "amount double, transaction_id string, timestamp string, account_id string, V1 double")
    back = files.read_transactions_csv(spark, files.write_csv(df, str(tmp_path / "c")))
    row = back.first()
    assert row["amount"] == 1.5 and row["timestamp"].hour == 10 and "V1" in back.columns


def test_csv_files_by_their_own_headers_with_rejects(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    head = "transaction_id,account_id,timestamp,amount"
    (folder / "a.csv").write_text(f"{head}\nt1,x,2024-01-01 10:00:00,1.5\nt2,x,soon,2.5\n\nt3,x,2024-01-01 10:00:00\n{head}\nt4,x,,\n")
    (folder / "b.csv").write_text('\ufeffamount,note,transaction_id\n-2.25,"a, b",t5\nmuch,c,t6\n3,d,t7,extra\n')
    (folder / "c.csv").write_text(head + "\n")
    (folder / "d.csv").write_text("")
    rows, rejects = files.scan_csv(spark, str(folder))
    got = {r["transaction_id"]: (r["account_id"], r["amount"], r["note"], r["timestamp"] is not None) for r in rows.collect()}
    assert got == {"t1": ("x", 1.5, None, True), "t4": ("x", None, None, False), "t5": (None, -2.25, "a, b", False)}
    bad = {(r["file"][-5:], r["line"]) for r in rejects.collect()}
    assert bad == {("a.csv", "t2,x,soon,2.5"), ("a.csv", "t3,x,2024-01-01 10:00:00"), ("b.csv", "much,c,t6"), ("b.csv", "3,d,t7,extra")}
    # The same whatever columns are read.
    assert rows.count() == 3 and rejects.count() == 4 and rows.select("account_id").count() == 3
    assert rows.schema["amount"].dataType.simpleString() == "double" and rows.schema["timestamp"].dataType.simpleString() == "timestamp"
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "e.csv").write_text("")
    rows, rejects = files.scan_csv(spark, str(tmp_path / "none"))
    assert rows.count() == rejects.count() == 0 and "amount" in rows.columns


def test_account_card_with_and_without_balances(spark, txns):
    t = txns([("a", "x", "2024-01-01", 10.25), ("b", "x", "2024-01-03", -4.0), ("c", "y", "2024-01-02", 1.0)])
    days = spark.sql("SELECT * FROM VALUES ('x', DATE '2024-01-01', 5.0D), ('x', DATE '2024-01-03', 7.0D), ('y', DATE '2024-01-02', 2.0D) AS t(account_id, ds, balance)")
    ahead = spark.sql("SELECT 'x' AS account_id, DATE '2024-01-05' AS date, -1.0D AS forecast, 1 AS overdraft_risk")
    want = {"min_forecast": -1.0, "overdraft_risk": 1, "days_to_overdraft": 2, "account_id": "x"}
    assert [r.asDict() for r in marts.account_card(days, ahead, "2024-01-03").collect()] == [want | {"current_balance": 7.0}]
    assert [r.asDict() for r in marts.account_card(days, ahead, "2024-01-03", t).collect()] == [want | {"current_balance": 6.25}]


def test_anomaly_mart_holds_its_histogram(spark):
    scores = [0.0, 0.1, 0.1, 0.55, 1.0, None]
    df = spark.createDataFrame([(s, int(s == 1.0), int(i == 4)) for i, s in enumerate(scores)], "anomaly_score double, is_anomaly int, is_fraud int")
    row = marts.anomaly_overview(df, bins=10).first()
    assert row["score_histogram"] == [1, 2, 0, 0, 0, 1, 0, 0, 0, 1] and row["precision"] == 1.0 and row["anomaly_count"] == 1
    assert marts.anomaly_overview(df.limit(0), bins=3).first()["score_histogram"] == [0, 0, 0]


def test_enrich_keeps_rows_without_account_or_time(spark, txns):
    t = txns([("a", "x", "2024-01-01 10:00:00", 1.0), ("b", None, "2024-01-01 10:00:00", 1.0), ("c", "x", None, 1.0), ("d", "z", "2024-01-06 10:00:00", 1.0)])
    accounts = spark.createDataFrame([("x", "s1"), ("y", "s2")], "account_id string, segment string")
    got = {r["transaction_id"]: (r["segment"], r["is_weekend"]) for r in src.enrich(t, src.calendar_of(t), accounts).collect()}
    assert got == {"a": ("s1", 0), "b": (None, 0), "c": ("s1", None), "d": (None, 1)}


def test_single_transaction_account(txns):
    columns = ("transaction_id", "account_id", "timestamp", "amount", "merchant_name", "merchant_category", "is_fraud")
    t = txns([("a", "x", "2024-01-01 12:00:00", 10.0, "m", "c", 0)], columns)
    basic = profiles.basic(t).first()
    assert (basic["std_amount"], basic["amount_zscore"], basic["txn_count"]) == (0, 0, 1)
    risk = profiles.with_risk(t).first()
    assert risk["time_since_last"] == 24 and risk["amount_zscore"] == 0


def test_basic_profile_passes_optional_columns(txns):
    columns = ("transaction_id", "account_id", "timestamp", "amount", "merchant_name", "merchant_category", "V1", "Vx")
    t = txns([("a", "x", "2024-01-01 12:00:00", 10.0, "m", "c", 0.5, 1.0)], columns)
    out = profiles.basic(t)
    assert "V1" in out.columns and "Vx" not in out.columns and "is_fraud" not in out.columns


def test_first_seen_differs_from_only_one(txns):
    columns = ("transaction_id", "account_id", "timestamp", "amount", "merchant_name")
    t = txns([("a", "x", "2024-01-01", 1.0, "m"), ("b", "x", "2024-01-02", 1.0, "m")], columns)
    assert {r[0]: r[1] for r in mer.first_seen_merchant(t).select("transaction_id", "is_new_merchant").collect()} == {"a": 1, "b": 0}
    assert {r[0] for r in mer.account_merchant_frequency(t).select("is_new_merchant").collect()} == {0}


def test_gap_days(txns):
    rows = [("a", "x", "2024-01-01", 10.0), ("b", "x", "2024-01-02", 5.0), ("c", "x", "2024-01-05", 1.0)]
    t = txns(rows)
    opening = t.select("account_id").distinct().withColumn("opening_balance", F.lit(100.0))
    out = fc.filled_series(fc.daily_series(t, opening)).orderBy("ds").collect()
    assert [r["balance"] for r in out] == [90, 85, 85, 85, 84]
    assert [r["net_flow"] for r in out] == [10, 5, 0, 0, 1]


def test_daily_series_from_a_balance_column(txns):
    columns = ("transaction_id", "account_id", "timestamp", "amount", "balance")
    t = txns([("a", "x", "2024-01-01 09:00:00", 1.0, 50.0), ("b", "x", "2024-01-01 10:00:00", 1.0, 49.0)], columns)
    assert fc.daily_series(t).first()["balance"] == 49.0


def test_trend_forecast(txns):
    rows = [(f"t{i}", "x", f"2024-01-{i + 1:02d}", 10.0) for i in range(20)]
    t = txns(rows)
    opening = t.select("account_id").distinct().withColumn("opening_balance", F.lit(1000.0))
    out = fc.trend_forecast(fc.daily_series(t, opening), horizon=3, min_transactions=20, min_days=15).orderBy("date").collect()
    # 2024-01-21 is a Sunday.
    assert [round(r["forecast"], 6) for r in out] == [790.0, 760.0, 750.0]
    assert fc.trend_forecast(fc.daily_series(t, opening)).count() == 0


@pytest.mark.parametrize("kind", ["additive", "seasonal_ar"])
def test_fitted_forecasts(spark, kind):
    days = spark.range(120).selectExpr(
        "'x' AS account_id",
        "date_add(date'2024-01-01', cast(id AS int)) AS ds",
        "1000 - 2 * id + 30 * sin(2 * pi() * id / 7) AS balance",
        "2.0 AS net_flow",
        "1 AS txn_count",
        "cast(weekday(date_add(date'2024-01-01', cast(id AS int))) >= 5 AS int) AS is_weekend",
        "0 AS is_holiday",
    )
    out = fc.forecast(kind, days, days).withColumn("i", F.datediff("date", F.lit("2024-01-01").cast("date")))
    miss = out.select(F.max(F.abs(F.col("forecast") - (1000 - 2 * F.col("i") + 30 * F.sin(2 * F.pi() * F.col("i") / 7))))).first()[0]
    assert out.count() == 30 and miss < 15


def test_overdraft(spark):
    f = spark.createDataFrame(
        [("x", "2024-02-01", 5.0, 6.0), ("x", "2024-02-03", -5.0, -4.0), ("y", "2024-02-01", 5.0, 6.0)],
        "account_id string, date string, forecast double, upper_bound double",
    ).withColumn("date", F.col("date").cast("date"))
    rows = {(r["account_id"], str(r["date"])): r for r in fc.overdraft_risk(f, "2024-01-31").collect()}
    assert rows[("x", "2024-02-01")]["days_to_overdraft"] == 3 and rows[("x", "2024-02-03")]["high_overdraft_risk"] == 1
    assert rows[("y", "2024-02-01")]["days_to_overdraft"] is None
    assert {r["days_to_overdraft"] for r in fc.overdraft_risk(f.filter("account_id = 'x'"), "2024-03-01").collect()} == {0}


def test_catalogues_are_produced(spark, skewed):
    t, _ = skewed
    t = t.limit(200).cache()
    adv = profiles.advanced(t, declared_windows=True)
    assert set(profiles.ADVANCED_CATALOGUE) <= set(adv.columns)
    assert with_time_cell(t).count() == 200


def test_full_profile_in_slices_of_accounts(spark, skewed, monkeypatch):
    """A long table is worked on slice by slice: the same rows, a hot account and a null one among them."""
    t, _ = skewed
    t = t.limit(600).withColumn("account_id", F.when(F.col("account_id") != "a3", F.col("account_id"))).cache()
    opening = t.select("account_id").distinct().where("account_id IS NOT NULL").withColumn("opening_balance", F.lit(100.0))
    accounts = opening.select("account_id", F.lit("s").alias("segment"), F.lit(None).cast("string").alias("pay_cycle"))
    from ledgerlight.sources.canonical import calendar_of

    whole = profiles.full(t, opening, calendar_of(t), accounts)
    monkeypatch.setattr(profiles, "FULL_ROWS", 150)
    sliced = profiles.full(t, opening, calendar_of(t), accounts)
    assert sliced.columns == whole.columns and "full-" in sliced.inputFiles()[0]
    rows = {r["transaction_id"]: r for r in sliced.collect()}
    assert len(rows) == 600 and all(rows[r["transaction_id"]] == r for r in whole.collect())
