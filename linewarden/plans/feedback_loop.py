"""Evaluate review routing against later feedback."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from linewarden.operators import feedback as ops
from linewarden.operators.summary import value_counts


@dataclass(frozen=True)
class FeedbackEvaluation:
    """Lazy tables of one evaluation; reading one runs only what it needs."""

    cases: DataFrame
    coverage: DataFrame
    missing: DataFrame
    extra: DataFrame
    class_counts: DataFrame
    effectiveness: DataFrame
    confirmed_drivers: DataFrame
    scenarios: DataFrame


def evaluate_feedback(review: DataFrame, feedback: DataFrame) -> FeedbackEvaluation:
    """All feedback tables, after the one-to-one and label gates."""
    ops.require_feedback(review, feedback)
    cases = ops.feedback_cases(review, feedback)
    return FeedbackEvaluation(
        cases=cases,
        coverage=ops.feedback_coverage(review, feedback),
        missing=ops.without_feedback(review, feedback),
        extra=ops.extra_feedback(review, feedback),
        class_counts=value_counts(cases, "feedback_classification"),
        effectiveness=ops.review_effectiveness(cases),
        confirmed_drivers=ops.confirmed_driver_counts(cases),
        scenarios=ops.threshold_scenarios(cases),
    )
