"""Review a scored production batch: level, routing decision, causes and summaries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linewarden.config import production as shape
from linewarden.functions.risk import (
    decision_reason,
    review_decision,
    risk_level,
    scorecard,
    sigmoid,
)
from linewarden.functions.text import array_rounded
from linewarden.operators.rootcause import driver_counts, with_root_causes
from linewarden.operators.summary import value_counts
from linewarden.operators.validation import require_columns, require_numbers, scoring_warnings
from linewarden.sources.rulebook import CauseRules
from linewarden.sources.tables import coerce_numeric, require_rows


def require_scoring_batch(df: DataFrame) -> DataFrame:
    """The batch itself, unless columns, rows or readable numbers are missing."""
    require_columns(df, shape.SCORING_COLUMNS, "Scoring batch")
    require_rows(df, "Scoring batch")
    require_numbers(df, shape.NUMERIC, "Scoring batch")
    return df


def with_scorecard(df: DataFrame, score: Column | None = None) -> DataFrame:
    """Model-free probability from the additive scorecard, four decimals."""
    value = scorecard() if score is None else score
    return coerce_numeric(df).withColumn("scrap_probability", array_rounded(sigmoid(value), 4))


def with_decision(scored: DataFrame, threshold: float | Column) -> DataFrame:
    """Risk level, decision and reason of rows that carry `scrap_probability`."""
    cut = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    probability = F.col("scrap_probability")
    return scored.withColumn("risk_level", risk_level(probability)).withColumns(
        {
            "review_threshold": cut,
            "review_decision": review_decision(probability, F.col("risk_level"), cut),
            "decision_reason": decision_reason(probability, F.col("risk_level"), cut),
        }
    )


def batch_review(
    scored: DataFrame, threshold: float | Column, rules: CauseRules | None = None
) -> DataFrame:
    """Decision and root causes of every row: one narrow projection, no shuffle."""
    decided = with_decision(scored, threshold)
    return with_root_causes(decided, rules, level=F.col("risk_level"))


def review_summary(reviewed: DataFrame) -> DataFrame:
    """Decision counts, level counts and driver counts as (section, name, row_count).

    Decisions and levels come from one grouped pass over their combinations.
    """
    pairs = reviewed.groupBy("review_decision", "risk_level").agg(
        F.count(F.lit(1)).alias("rows")
    )
    sections = F.array(
        F.struct(F.lit("decision").alias("section"), F.col("review_decision").alias("name")),
        F.struct(F.lit("risk_level").alias("section"), F.col("risk_level").alias("name")),
    )
    counts = (
        pairs.select("rows", F.inline(sections))
        .groupBy("section", "name")
        .agg(F.sum("rows").alias("row_count"))
    )
    drivers = driver_counts(reviewed).select(
        F.lit("driver").alias("section"), F.col("driver").alias("name"), "row_count"
    )
    return counts.unionByName(drivers)


def decision_counts(reviewed: DataFrame) -> DataFrame:
    return value_counts(reviewed, "review_decision")


def risk_level_counts(reviewed: DataFrame) -> DataFrame:
    return value_counts(reviewed, "risk_level")


@dataclass(frozen=True)
class BatchReview:
    """Lazy tables of one review; reading one runs only what it needs."""

    results: DataFrame
    summary: DataFrame
    warnings: DataFrame


def review_job(
    batch: DataFrame,
    threshold: DataFrame | float,
    score: Callable[[DataFrame], DataFrame] = with_scorecard,
    rules: CauseRules | None = None,
) -> BatchReview:
    """Gate, score and review a batch.

    `score` adds `scrap_probability`, for instance a fitted model; `threshold` is a number
    or the one-row table of the threshold choice, whose value enters as a scalar subquery.
    """
    require_scoring_batch(batch)
    cut = (
        threshold.select("review_threshold").scalar()
        if isinstance(threshold, DataFrame)
        else threshold
    )
    results = batch_review(score(batch), cut, rules)
    return BatchReview(results, review_summary(results), scoring_warnings(batch))
