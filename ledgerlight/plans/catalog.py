"""All registered queries."""

from ledgerlight.plans import checks, features, models, reports, scans, streams  # noqa: F401
from ledgerlight.plans import profiles
from ledgerlight.plans.registry import ORACLES, QUERIES
from ledgerlight.sources import canonical as src

__all__ = ["ORACLES", "QUERIES", "flagship"]


def flagship(spark, sf_dir):
    t = src.transactions(spark, sf_dir)
    risk = profiles.with_risk(t).select("transaction_id", "risk_time", "risk_velocity", "risk_new_merchant", "risk_score")
    return profiles.basic(t).join(risk, "transaction_id")
