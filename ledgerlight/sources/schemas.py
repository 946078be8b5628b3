"""Explicit schemas of the tables the library reads and writes."""

from pyspark.sql import types as T

_S, _D, _I, _L, _TS, _DT = (
    T.StringType(),
    T.DoubleType(),
    T.IntegerType(),
    T.LongType(),
    T.TimestampType(),
    T.DateType(),
)


def _struct(required, optional):
    fields = [T.StructField(n, t, False) for n, t in required]
    return T.StructType(fields + [T.StructField(n, t, True) for n, t in optional])


V_COLUMNS = [f"V{i}" for i in range(1, 29)]

TRANSACTIONS = _struct(
    [("transaction_id", _S), ("account_id", _S), ("timestamp", _TS), ("amount", _D)],
    [
        ("merchant_name", _S),
        ("merchant_category", _S),
        ("channel", _S),
        ("city", _S),
        ("is_fraud", _I),
        ("balance", _D),
    ],
)

ACCOUNTS = _struct(
    [("account_id", _S)], [("segment", _S), ("pay_cycle", _S), ("created_date", _DT)]
)

CALENDAR = _struct(
    [("date", _DT)],
    [
        ("year", _I),
        ("month", _I),
        ("day", _I),
        ("weekday", _I),
        ("is_weekend", _I),
        ("is_month_end", _I),
        ("is_holiday", _I),
        ("holiday_name", _S),
    ],
)

# The public card data set before it is made canonical.
CARD_RAW = _struct(
    [],
    [
        ("trans_date_trans_time", _S),
        ("cc_num", _S),
        ("merchant", _S),
        ("category", _S),
        ("amt", _D),
        ("first", _S),
        ("last", _S),
        ("gender", _S),
        ("job", _S),
        ("dob", _DT),
        ("trans_num", _S),
        ("unix_time", _L),
        ("is_fraud", _I),
    ],
)

EVALUATION_LOG = _struct(
    [("run_at", _TS), ("method", _S)],
    [("precision", _D), ("recall", _D), ("f1_score", _D), ("auc", _D)]
    # Time ranges that models were fitted and compared on, where the caller knows them.
    + [("train_from", _S), ("train_to", _S), ("test_from", _S), ("test_to", _S)],
)

BALANCE_FORECASTS = _struct(
    [("account_id", _S), ("date", _DT)],
    [
        ("forecast", _D),
        ("lower_bound", _D),
        ("upper_bound", _D),
        ("model_type", _S),
        ("overdraft_risk", _I),
        ("low_balance_risk", _I),
    ],
)

# Required by the validator.
REQUIRED_COLUMNS = [
    "transaction_id",
    "account_id",
    "timestamp",
    "amount",
    "merchant_name",
    "merchant_category",
]

# Columns the staging schema declares as keys or NOT NULL.
NOT_NULL_COLUMNS = ["transaction_id", "account_id", "timestamp", "amount"]
