"""Risk rules as data, risk score, decision and alerts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``condition`` is a SQL boolean over feature columns; NULL counts as not triggered."""

    reason_code: str
    condition: str
    risk_delta: Decimal
    severity: str


# --- Fixed values: the candidate rules and the decision policy --------------
DEFAULT_RULES = (
    Rule("IMPOSSIBLE_TRAVEL", "impossible_travel", Decimal("0.25"), "HIGH"),
    Rule("HIGH_TXN_VELOCITY", "txn_count_5m >= 5", Decimal("0.15"), "MEDIUM"),
    Rule("EXTREME_AMOUNT_DEVIATION", "abs(amount_zscore) >= 3", Decimal("0.20"), "HIGH"),
    Rule(
        "NEW_DEVICE_HIGH_VALUE",
        "new_device_for_account and is_high_amount",
        Decimal("0.20"),
        "HIGH",
    ),
    Rule("HIGH_RISK_MERCHANT", "merchant_fraud_rate >= 0.10", Decimal("0.15"), "MEDIUM"),
    Rule("RAPID_COUNTRY_CHANGE", "country_count >= 3", Decimal("0.15"), "MEDIUM"),
    Rule("DEVICE_SHARED_ACROSS_ACCOUNTS", "device_account_count >= 3", Decimal("0.10"), "LOW"),
)
MODEL_WEIGHT = 0.75
REVIEW_FROM = 0.50
BLOCK_FROM = 0.80
APPROVE, REVIEW, BLOCK = "APPROVE", "REVIEW", "BLOCK"
# Reason given when the model alone reaches the review threshold.
MODEL_REASON = "MODEL_SCORE"
# ----------------------------------------------------------------------------


def _hit(rule: Rule) -> Column:
    return F.coalesce(F.expr(rule.condition).cast("boolean"), F.lit(False))


def apply_rules(features: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES) -> DataFrame:
    """Add ``rule_hits`` (code, delta, severity in rule order) and ``rule_risk_total``."""
    entries = [
        F.when(
            _hit(rule),
            F.struct(
                F.lit(rule.reason_code).alias("reason_code"),
                F.lit(rule.risk_delta).cast("decimal(4,2)").alias("risk_delta"),
                F.lit(rule.severity).alias("severity"),
            ),
        )
        for rule in rules
    ]
    total = sum(
        (F.when(_hit(rule), F.lit(rule.risk_delta)).otherwise(F.lit(Decimal("0.00"))) for rule in rules),
        F.lit(Decimal("0.00")),
    )
    return features.withColumns(
        {"rule_hits": F.array_compact(F.array(*entries)), "rule_risk_total": total.cast("decimal(6,2)")}
    )


def risk_score(probability: Column, rule_total: Column, weight: float = MODEL_WEIGHT) -> Column:
    """Weighted model probability plus rule contributions, at most 1."""
    return F.least(F.lit(1.0), probability * F.lit(weight) + rule_total.cast("double"))


def decide(
    scored: DataFrame,
    review_from: float = REVIEW_FROM,
    block_from: float = BLOCK_FROM,
) -> DataFrame:
    """Add ``decision`` and ``reason_codes`` from ``risk_score`` and ``rule_hits``.

    A decision other than APPROVE always carries at least one reason.
    """
    score = F.col("risk_score")
    decision = (
        F.when(score >= block_from, BLOCK).when(score >= review_from, REVIEW).otherwise(APPROVE)
    )
    codes = F.col("rule_hits.reason_code")
    explained = F.when(
        (F.size(codes) == 0) & (score >= review_from), F.array(F.lit(MODEL_REASON))
    ).otherwise(codes)
    return scored.withColumns({"decision": decision, "reason_codes": explained})


def alerts(
    decided: DataFrame,
    decision: str | None = None,
    min_risk: float | None = None,
    account_id: str | None = None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Reviewed and blocked transactions, optionally narrowed; plain filters that push down."""
    found = decided.where(F.col("decision").isin(REVIEW, BLOCK))
    if decision is not None:
        found = found.where(F.col("decision") == decision)
    if min_risk is not None:
        found = found.where(F.col("risk_score") >= min_risk)
    if account_id is not None:
        found = found.where(F.col("account_id") == account_id)
    if start is not None:
        found = found.where(F.col("event_timestamp") >= F.lit(start).cast("timestamp"))
    if end is not None:
        found = found.where(F.col("event_timestamp") < F.lit(end).cast("timestamp"))
    return found
