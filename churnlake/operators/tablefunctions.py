"""Reports as SQL table functions with parameters, to be called from SQL text.

A parameter left out sets no condition. The analyzer puts the function's text in the place of the
call, so conditions with constants are folded and reach the scan as those of a plain query do.
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


def _name(given: str) -> str:
    """A plain identifier; anything else would become part of the statement."""
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", given):
        raise ValueError(f"not a plain name: {given!r}")
    return given


def create_risk_report(spark: SparkSession, name: str, view: str) -> None:
    """``name(min_monthly, min_risk_score)`` over a view of interventions: retained customers
    above a charge and, when given and not 0, a risk score. The caller orders and limits."""
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION {_name(name)}(min_monthly DOUBLE DEFAULT 50, min_risk_score INT DEFAULT NULL)
        RETURNS TABLE (customer_id BIGINT, contract STRING, internet_service STRING, monthly_charges DECIMAL(18,2), risk_score INT, action STRING)
        RETURN SELECT customer_id, contract, internet_service, monthly_charges, risk_score, action FROM {_name(view)}
        WHERE monthly_charges >= CAST(min_monthly AS DECIMAL(18,2)) AND (COALESCE(min_risk_score, 0) = 0 OR risk_score >= min_risk_score)"""
    )


def create_segment_performance(spark: SparkSession, name: str, view: str) -> None:
    """``name(only_contract, only_internet)`` over a view of subscriptions: churn and revenue per
    segment, of one contract or service where given and not empty."""
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION {_name(name)}(only_contract STRING DEFAULT NULL, only_internet STRING DEFAULT NULL)
        RETURNS TABLE (contract STRING, internet_service STRING, customers BIGINT, churn_rate DOUBLE, avg_monthly DOUBLE, total_revenue DOUBLE)
        RETURN SELECT contract, internet_service, COUNT(*), CAST(ROUND(CAST(SUM(churn) AS DECIMAL(20,0)) * 100 / COUNT(*), 1) AS DOUBLE),
          CAST(ROUND(SUM(monthly_charges) / COUNT(monthly_charges), 2) AS DOUBLE), CAST(SUM(monthly_charges) AS DOUBLE)
        FROM {_name(view)}
        WHERE (COALESCE(only_contract, '') = '' OR contract = only_contract) AND (COALESCE(only_internet, '') = '' OR internet_service = only_internet)
        GROUP BY contract, internet_service"""
    )
