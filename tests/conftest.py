import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlight import configure  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return configure(session)


@pytest.fixture(scope="session")
def txns(spark):
    """Build transactions from short rows: (id, account, time, amount, then optional named columns)."""

    def build(rows, columns=("transaction_id", "account_id", "timestamp", "amount")):
        df = spark.createDataFrame(rows, list(columns))
        return df.withColumns(
            {"timestamp": df["timestamp"].cast("timestamp"), "amount": df["amount"].cast("double")}
        )

    return build


@pytest.fixture(scope="session")
def skewed(spark):
    """3,000 transactions, a third of them in one account, a third of those at one merchant, some ties in time."""
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(7)
    n = 3000
    account = np.where(np.arange(n) % 3 == 0, "hot", [f"a{i}" for i in rng.integers(0, 40, n)])
    minutes = rng.integers(0, 45 * 24 * 60, n)
    minutes[:60:2] = minutes[1:60:2]
    frame = pd.DataFrame(
        {
            "transaction_id": [f"t{i:05d}" for i in range(n)],
            "account_id": account,
            "timestamp": pd.Timestamp("2024-01-01") + pd.to_timedelta(minutes, unit="min"),
            "amount": np.round(rng.normal(20, 300, n), 2),
            "merchant_name": np.where(rng.random(n) < 0.33, "m0", [f"m{i}" for i in rng.integers(0, 30, n)]),
            "merchant_category": [f"c{i}" for i in rng.integers(0, 6, n)],
            "channel": [f"ch{i}" for i in rng.integers(0, 3, n)],
            "city": [f"y{i}" for i in rng.integers(0, 5, n)],
            "is_fraud": (rng.random(n) < 0.05).astype(int),
        }
    )
    return spark.createDataFrame(frame).repartition(8).cache(), frame
