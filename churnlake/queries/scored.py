"""Frames that several registered queries share."""

from pyspark.sql import functions as F

from churnlake.functions import scoring
from churnlake.sources.subscriptions import subscriptions as subs

CORE = ["customer_id", "contract", "internet_service", "payment_method", "monthly_charges", "tenure", "churn"]


def scored(spark, base, *more):
    """Subscriptions with the full risk score, its label and the lifetime value."""
    df = subs(spark, base, *CORE, *more)
    return df.withColumn("risk_score", scoring.risk_score_full()).withColumns(
        {"risk_label": scoring.risk_label_753(F.col("risk_score")), "lifetime_value": scoring.lifetime_value()}
    )


def interventions(spark, base):
    """Retained customers with their score and action."""
    return (
        scored(spark, base)
        .filter("churn = 0")
        .withColumn("action", scoring.action_864(F.col("risk_score")))
    )
