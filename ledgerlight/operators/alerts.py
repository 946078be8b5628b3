"""Alert queue, tiers, daily cap and cooldown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlight.operators.cells import Measure, cell_of, running, with_time_cell
from ledgerlight.session import cut

# The declared alert policy.
HIGH_RISK = 0.8
MEDIUM_RISK = 0.6
AUTO_CLOSE = 0.3
MAX_ALERTS_PER_DAY = 100
COOLDOWN_HOURS = 24
OPEN_STATES = ("open", "investigating")


def priority(score: Column) -> Column:
    return F.when(score >= HIGH_RISK, "high").when(score >= MEDIUM_RISK, "medium").otherwise("low")


def status(score: Column) -> Column:
    return F.when(score < AUTO_CLOSE, "closed").otherwise("open")


def with_tiers(df: DataFrame, score: str) -> DataFrame:
    return df.withColumns({"priority": priority(F.col(score)), "status": status(F.col(score))})


def alert_queue(
    df: DataFrame, score: str, states=OPEN_STATES, priorities=("high", "medium", "low")
) -> DataFrame:
    """Fraud rows numbered in time order, tiered by score, restricted to the wanted states and priorities."""
    fraud = with_tiers(with_time_cell(df.filter(F.col("is_fraud") == 1)), score)
    numbered = running(fraud, [], [Measure("alert_id", F.lit(1))]).drop("alert_id_all", "_us", "_cell")
    return numbered.filter(F.col("status").isin(*states) & F.col("priority").isin(*priorities))


def queue_summary(queue: DataFrame) -> DataFrame:
    def having(column, value):
        return F.count(F.when(F.col(column) == value, 1))

    return queue.agg(
        having("status", "open").alias("open_alerts"),
        having("status", "investigating").alias("investigating"),
        having("priority", "high").alias("high_priority"),
        F.avg("amount").alias("avg_amount"),
    )


def daily_cap(alerts: DataFrame, score: str, cap: int = MAX_ALERTS_PER_DAY) -> DataFrame:
    """Best `cap` alerts of each day. Each task keeps at most `cap` rows per day before the exchange."""
    best = Window.partitionBy(F.to_date("timestamp")).orderBy(F.col(score).desc(), "transaction_id")
    return alerts.withColumn("day_rank", F.row_number().over(best)).filter(F.col("day_rank") <= cap)


def cooldown(alerts: DataFrame, hours: int = COOLDOWN_HOURS) -> DataFrame:
    """At most one alert per account within the cooldown, counted from the last alert let through.

    Every alert points to the first one at least a cooldown later. Those let through are the chain of pointers
    that starts at an account's first alert. The chain is followed with pointers of doubling length, so a chain
    of n alerts takes log2(n) rounds and no account is ever handled in one piece.
    """
    rows = with_time_cell(alerts)
    # One alert per instant stands for its peers.
    at = rows.groupBy("account_id", "_us").agg(F.min("transaction_id").alias("transaction_id"))
    wait = hours * 3600 * 1_000_000
    # Searching forward in time is a running maximum over negated time.
    points = at.select("account_id", (-F.col("_us")).alias("_us"), F.lit(0).alias("probe"), F.lit(None).cast("long").alias("origin"))
    probes = at.select("account_id", (-(F.col("_us") + wait)).alias("_us"), F.lit(1).alias("probe"), F.col("_us").alias("origin"))
    both = points.unionByName(probes).withColumn("_cell", cell_of(F.col("_us")))
    seen = running(
        both, ["account_id"], [Measure("_next", F.when(F.col("probe") == 0, F.col("_us")), "max")], order=["_us"], peers=True
    )
    jump = cut(
        seen.filter((F.col("probe") == 1) & F.col("_next").isNotNull()).select(
            "account_id", F.col("origin").alias("_us"), (-F.col("_next")).alias("_to")
        )
    )
    passed = cut(at.groupBy("account_id").agg(F.min("_us").alias("_us")))
    while not jump.isEmpty():
        reached = passed.join(jump, ["account_id", "_us"]).select("account_id", F.col("_to").alias("_us"))
        passed = cut(passed.unionByName(reached).distinct())
        onward = jump.select("account_id", F.col("_us").alias("_to"), F.col("_to").alias("_further"))
        jump = cut(jump.join(onward, ["account_id", "_to"]).select("account_id", "_us", F.col("_further").alias("_to")))
    let_through = at.join(passed, ["account_id", "_us"]).select("transaction_id")
    return alerts.join(let_through, "transaction_id")
