"""One table of headline figures per workflow stage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linewarden.config import risk as cfg
from linewarden.functions.text import rounded
from linewarden.operators.compliance import STATUSES, compliance_totals
from linewarden.operators.evaluation import ratio
from linewarden.operators.validation import FAIL, WARNING, quality_rows


def _cards(one_row: DataFrame, stage: str, values: dict[str, Column]) -> DataFrame:
    """(stage, metric, value) rows of a one-row table."""
    cells = [
        F.struct(
            F.lit(stage).alias("stage"),
            F.lit(metric).alias("metric"),
            value.cast("string").alias("value"),
        )
        for metric, value in values.items()
    ]
    return one_row.select(F.inline(F.array(*cells)))


def quality_card(raw: DataFrame) -> DataFrame:
    report = quality_rows(raw).agg(
        F.max("overall_status").alias("status"),
        F.max("row_count").alias("row_count"),
        F.count_if(F.col("status") == WARNING).alias("warnings"),
        F.count_if(F.col("status") == FAIL).alias("errors"),
        F.max("scrap_rate").alias("scrap_rate"),
    )
    return _cards(
        report,
        "data_quality",
        {
            "status": F.col("status"),
            "row_count": F.col("row_count"),
            "column_count": F.lit(len(raw.columns)),
            "warning_count": F.col("warnings"),
            "error_count": F.col("errors"),
            "scrap_rate": F.col("scrap_rate"),
        },
    )


def review_card(reviewed: DataFrame) -> DataFrame:
    decision, level = F.col("review_decision"), F.col("risk_level")
    levels = [name for name, _ in cfg.LEVEL_CUTS] + [cfg.LOWEST_LEVEL]
    sums = reviewed.agg(
        F.count(F.lit(1)).alias("n"),
        F.max("review_threshold").alias("threshold"),
        *[F.count_if(decision == d).alias(d) for d in cfg.DECISIONS],
        *[F.count_if(level == name).alias(name) for name in levels],
    )
    return _cards(
        sums,
        "batch_review",
        {
            "row_count": F.col("n"),
            "review_threshold": F.col("threshold"),
            **{d: F.col(d) for d in cfg.DECISIONS},
            **{f"risk_{name}": F.col(name) for name in levels},
        },
    )


def compliance_card(df: DataFrame) -> DataFrame:
    """Totals and the most common violated requirement as a whole record."""
    worst = F.try_element_at("violations_by_requirement", F.lit(1))
    name = "most_common_violated_requirement"
    return _cards(
        compliance_totals(df),
        "spec_compliance",
        {
            "row_count": F.col("row_count"),
            "requirement_count": F.col("requirement_count"),
            **{s: F.col(s.lower()) for s in STATUSES},
            name: worst["requirement_id"],
            f"{name}_parameter": worst["parameter"],
            f"{name}_severity": worst["severity"],
            f"{name}_count": worst["violation_count"],
        },
    )


def feedback_card(cases: DataFrame) -> DataFrame:
    """Class counts of valid cases, and the two rates that follow from them."""
    outcome = F.col("feedback_classification")
    classes = tuple(cfg.FEEDBACK_PRIORITY)
    counts = cases.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(outcome == c).alias(c) for c in classes],
    )
    caught, alarms, missed = (F.col(c) for c in (cfg.TRUE_POSITIVE, cfg.FALSE_ALARM, cfg.MISSED))
    return _cards(
        counts,
        "feedback_loop",
        {
            "row_count": F.col("n"),
            **{c: F.col(c) for c in classes},
            "issue_capture_rate": rounded(ratio(caught, caught + missed), 4),
            "false_alarm_rate_among_reviews": rounded(ratio(alarms, caught + alarms), 4),
        },
    )


def workflow_overview(*cards: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, cards)
