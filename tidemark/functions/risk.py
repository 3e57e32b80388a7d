"""Risk scoring of account windows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


# Thresholds (all strict), score parts and labels of the screening rules.
@dataclass(frozen=True)
class RiskRules:
    high_value: float = 50000
    velocity: int = 10
    cumulative: float = 100000
    alert_above: int = 70
    high_value_points: int = 40
    velocity_points: int = 30
    cumulative_points: int = 25
    max_score: int = 100
    critical_from: int = 90
    high_from: int = 80
    medium_from: int = 70


ALERT_TYPES = (
    "HIGH_VALUE_TRANSACTION",
    "VELOCITY_ATTACK",
    "CUMULATIVE_THRESHOLD_EXCEEDED",
    "SUSPICIOUS_PATTERN",
)
RISK_FACTORS = ("HIGH_VALUE", "HIGH_VELOCITY", "HIGH_CUMULATIVE")

RULES = RiskRules()


def rule_hits(rules: RiskRules = RULES) -> list[Column]:
    """The three rules in order of precedence; a null measure is not a hit."""
    return [
        F.coalesce(F.col(measure) > F.lit(limit), F.lit(False))
        for measure, limit in (
            ("max_amount", rules.high_value),
            ("transaction_count", rules.velocity),
            ("total_amount", rules.cumulative),
        )
    ]


def risk_score(rules: RiskRules = RULES) -> Column:
    points = (rules.high_value_points, rules.velocity_points, rules.cumulative_points)
    score = F.lit(0)
    for hit, value in zip(rule_hits(rules), points):
        score = score + F.when(hit, value).otherwise(0)
    return F.least(F.lit(rules.max_score), score).cast("int")


def alert_type(rules: RiskRules = RULES) -> Column:
    labelled = [F.when(hit, label) for hit, label in zip(rule_hits(rules), ALERT_TYPES)]
    return F.coalesce(*labelled, F.lit(ALERT_TYPES[-1]))


def severity(score: Column, rules: RiskRules = RULES) -> Column:
    return (
        F.when(score >= rules.critical_from, "CRITICAL")
        .when(score >= rules.high_from, "HIGH")
        .when(score >= rules.medium_from, "MEDIUM")
        .otherwise("LOW")
    )


def risk_factors(rules: RiskRules = RULES) -> Column:
    named = [F.when(hit, label) for hit, label in zip(rule_hits(rules), RISK_FACTORS)]
    return F.array_compact(F.array(*named))


def alert_id() -> Column:
    return F.concat_ws("-", F.lit("AML"), "account_id", F.col("window_start").cast("long"))
