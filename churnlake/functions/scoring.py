"""Churn risk scores, labels and retention actions.

Every score is a sum of CASE expressions, so it stays inside whole-stage codegen and
costs no shuffle. The points, thresholds and labels are parameters; the defaults below
are the values the reported results depend on.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from churnlake.functions.ladders import at_least, at_most, first_match, map_values
from churnlake.functions.numbers import money

# Points per contract, payment method and tenure.
CONTRACT_POINTS = {"Month-to-month": 3, "One year": 1, "Two year": 0}
PAYMENT_POINTS = {"Electronic check": 3, "Mailed check": 2}
TENURE_STEPS = [(12, 3), (24, 2), (48, 1)]
TENURE_STEPS_RECOVERY = [(12, 3), (24, 2)]

# Label thresholds of the scores.
LABELS_753 = [(7, "Critical"), (5, "High"), (3, "Medium")]
LABELS_742 = [(7, "🔴 Critical"), (4, "🟡 High"), (2, "🟠 Medium")]
LABELS_742_DEFAULT = "🟢 Low"
LABELS_531 = [(5, "Critical"), (3, "High"), (1, "Medium")]
SEGMENT_LABELS = [(50, "🔴 Critical"), (30, "🟡 High Risk"), (15, "🟠 Medium Risk")]
SEGMENT_LABELS_DEFAULT = "🟢 Low Risk"

# Retention actions.
ACTIONS_864 = [(8, "🔴 Immediate call"), (6, "🟡 Email campaign"), (4, "🟠 Auto-pay offer")]
ACTIONS_864_DEFAULT = "🟢 Standard programme"
ACTIONS_753 = [
    (7, "Immediate call + discount offer"),
    (5, "Email campaign + contract upgrade"),
    (3, "Auto-pay migration offer"),
]
ACTIONS_753_DEFAULT = "Standard retention programme"
RATE_PRIORITIES = [(40, "Immediate"), (20, "High")]

# Churn probability by contract, and the bump of a first-year customer.
CONTRACT_PROBABILITY = {"Month-to-month": 0.43, "One year": 0.11}
CONTRACT_PROBABILITY_DEFAULT = 0.03
FIRST_YEAR_BUMP = 0.15

# Lifecycle stages by month of tenure.
LIFECYCLE_5 = [(6, "1-New"), (12, "2-Early"), (24, "3-Growing"), (48, "4-Established")]
LIFECYCLE_5_DEFAULT = "5-Loyal"
LIFECYCLE_5_LONG = [
    (6, "1. New (0-6m)"),
    (12, "2. Early (7-12m)"),
    (24, "3. Growing (13-24m)"),
    (48, "4. Established (25-48m)"),
]
LIFECYCLE_5_LONG_DEFAULT = "5. Loyal (49m+)"
LIFECYCLE_4 = [(12, "1-New (0-12m)"), (24, "2-Early (13-24m)"), (48, "3-Mid (25-48m)")]
LIFECYCLE_4_DEFAULT = "4-Loyal (49m+)"

# Tenure and charge bands.
TENURE_EDGES = [0, 12, 24, 48, 72]
TENURE_LABELS = ["0-12 months", "13-24 months", "25-48 months", "49+ months"]
YEAR_EDGES = [0, 12, 24, 36, 48, 60, 72]
YEAR_LABELS = ["0-12", "13-24", "25-36", "37-48", "49-60", "61-72"]
CHARGE_EDGES = [0, 35, 65, 90, 200]
CHARGE_LABELS = ["Low (<$35)", "Medium ($35-65)", "High ($65-90)", "Premium (>$90)"]

# Size classes of projects, satisfaction and salaries.
PROJECT_SIZES = [(50000, "Large Project"), (25000, "Medium Project"), (10000, "Small Project")]
PROJECT_SIZE_DEFAULT = "Micro Project"
SATISFACTION = [(4.5, "⭐ Excellent"), (3.5, "✅ Good"), (2.5, "🟡 Average")]
SATISFACTION_DEFAULT = "🔴 Poor"
SALARY_BANDS = [(8000, "Senior"), (5000, "Mid")]
SALARY_BAND_DEFAULT = "Junior"

# Weather code ranges.
WEATHER_CODES = [
    (0, 0, "Clear sky ☀️"),
    (1, 3, "Cloudy ⛅"),
    (51, 67, "Rainy 🌧️"),
    (80, 82, "Showers 🌦️"),
    (95, 99, "Thunderstorm ⛈️"),
]
RAIN_CODES = [(51, 67), (80, 82)]


def contract_points(unknown: int | None = 0, contract: str = "contract") -> Column:
    """Points of the contract; ``unknown=None`` leaves an unlisted contract null."""
    return map_values(F.col(contract), CONTRACT_POINTS, unknown)


def payment_points(payment: str = "payment_method") -> Column:
    return map_values(F.col(payment), PAYMENT_POINTS, 0)


def tenure_points(steps: Sequence[tuple[int, int]] = tuple(TENURE_STEPS), tenure: str = "tenure") -> Column:
    return at_most(F.col(tenure), steps, 0)


def risk_score_full() -> Column:
    """Contract, payment and tenure points, 0 to 9."""
    return contract_points() + payment_points() + tenure_points()


def risk_score_short() -> Column:
    """Contract and tenure points only, 0 to 6."""
    return contract_points() + tenure_points()


def risk_score_recovery() -> Column:
    """The full score without the point for 25 to 48 months."""
    return contract_points() + payment_points() + tenure_points(TENURE_STEPS_RECOVERY)


def risk_score_null_contract() -> Column:
    """The full score, null when the contract is not one of the three known."""
    return contract_points(unknown=None) + payment_points() + tenure_points()


def risk_label_753(score: Column) -> Column:
    return at_least(score, LABELS_753, "Low")


def risk_label_742(score: Column) -> Column:
    return at_least(score, LABELS_742, LABELS_742_DEFAULT)


def risk_label_531(score: Column) -> Column:
    return at_least(score, LABELS_531, "Low")


def risk_level_view() -> Column:
    """Critical for a flexible contract paid by electronic check in the first year; High
    for any other flexible contract. It has no points for mailed checks or later years.
    """
    flexible = F.col("contract") == "Month-to-month"
    by_check = F.col("payment_method") == "Electronic check"
    first_year = F.col("tenure") <= 12
    points = sum((F.when(c, 3).otherwise(0) for c in (by_check, first_year)), F.when(flexible, 3).otherwise(0))
    return first_match([(points >= 7, "Critical"), (flexible, "High")], "Low")


def segment_risk_label(rate: Column) -> Column:
    return at_least(rate, SEGMENT_LABELS, SEGMENT_LABELS_DEFAULT)


def lookup_risk_label(a: Column, b: Column, labels: Sequence[str] = ("Critical", "Elevated", "Low")) -> Column:
    """Both sides High, one side High, or neither; a null side counts as not High."""
    high_a, high_b = a.eqNullSafe("High"), b.eqNullSafe("High")
    return first_match([(high_a & high_b, labels[0]), (high_a | high_b, labels[1])], labels[2])


def action_864(score: Column, retained: Column | None = None) -> Column:
    """Action of a score; with ``retained`` the churned rows fall to the default."""
    steps = [(score >= edge, label) for edge, label in ACTIONS_864]
    if retained is not None:
        steps = [(cond & retained, label) for cond, label in steps]
    return first_match(steps, ACTIONS_864_DEFAULT)


def action_753(score: Column) -> Column:
    return at_least(score, ACTIONS_753, ACTIONS_753_DEFAULT)


def churn_probability() -> Column:
    """Half of the contract's probability plus the first-year bump, to 3 digits."""

    def fixed(v: float) -> Column:
        return F.lit(v).cast("decimal(4,3)")

    by_contract = map_values(
        F.col("contract"),
        {k: fixed(v) for k, v in CONTRACT_PROBABILITY.items()},
        fixed(CONTRACT_PROBABILITY_DEFAULT),
    )
    bump = F.when(F.col("tenure") <= 12, fixed(FIRST_YEAR_BUMP)).otherwise(fixed(0))
    return F.round((by_contract + bump) / 2, 3).cast("double")


def action_scored() -> Column:
    """Intervention for a flexible contract, urgent when it is also in its first year."""
    flexible = F.col("contract") == "Month-to-month"
    return first_match(
        [
            (flexible & (F.col("tenure") <= 12), "Immediate intervention"),
            (flexible, "Email campaign"),
        ],
        "Standard programme",
    )


def action_priority_rate(rate: Column) -> Column:
    return first_match([(rate > edge, label) for edge, label in RATE_PRIORITIES], "Standard")


def lifecycle_5(tenure: str = "tenure", long_names: bool = False) -> Column:
    if long_names:
        return at_most(F.col(tenure), LIFECYCLE_5_LONG, LIFECYCLE_5_LONG_DEFAULT)
    return at_most(F.col(tenure), LIFECYCLE_5, LIFECYCLE_5_DEFAULT)


def lifecycle_4(tenure: str = "tenure") -> Column:
    return at_most(F.col(tenure), LIFECYCLE_4, LIFECYCLE_4_DEFAULT)


def tenure_group(tenure: str = "tenure") -> Column:
    """Four bands without an upper end."""
    steps = list(zip(TENURE_EDGES[1:4], TENURE_LABELS))
    return at_most(F.col(tenure), steps, TENURE_LABELS[-1])


def charge_band(charge: Column, unit: float = 1) -> Column:
    """Bands that are closed on the left; ``unit`` scales the edges to the data."""
    edges = [e * unit for e in CHARGE_EDGES[1:4]]
    return first_match([(charge < e, label) for e, label in zip(edges, CHARGE_LABELS)], CHARGE_LABELS[-1])


def lifetime_value(charge: str = "monthly_charges", tenure: str = "tenure") -> Column:
    return F.round(money(charge) * F.col(tenure), 2)


def value_over(months: int, charge: str = "monthly_charges") -> Column:
    return F.round(money(charge) * months, 2)


def value_columns() -> Mapping[str, Column]:
    """Lifetime, one-year and two-year value of a subscription."""
    return {"lifetime_value": lifetime_value(), "annual_value": value_over(12), "two_year_value": value_over(24)}


def discounted_price(charge: str | Column = "monthly_charges", pct: str | Column = "discount_pct") -> Column:
    """Charge less the percentage, rounded half up to cents."""
    pct = F.col(pct) if isinstance(pct, str) else pct
    return F.round(money(charge) * (100 - pct.cast("decimal(5,2)")) / 100, 2)


def weather_condition(code: Column) -> Column:
    steps = [(code.between(lo, hi), label) for lo, hi, label in WEATHER_CODES]
    return first_match(steps, F.concat(F.lit("Code "), code.cast("string")))


def is_raining(code: Column) -> Column:
    (a, b), (c, d) = RAIN_CODES
    return code.between(a, b) | code.between(c, d)


def churn_flag_truthy(c: Column) -> Column:
    """Text flag: '1', 'True' and 'Yes' count as churned; null does not."""
    return F.coalesce(F.trim(c).isin("1", "True", "Yes"), F.lit(False))
