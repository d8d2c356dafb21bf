"""Follow parts through review, limits and feedback, and pick one case to show."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linewarden.config import production as shape
from linewarden.config import risk as cfg
from linewarden.operators.compliance import CRITICAL, with_compliance
from linewarden.operators.feedback import outcome_label, with_feedback_class, with_matches
from linewarden.plans.batch_review import batch_review, with_decision

# Columns each stage contributes to a trace.
REVIEW_PART = (
    "part_id", "scrap_probability", "risk_level", "review_threshold", "review_decision",
    "decision_reason", "root_cause_summary", "suspected_driver_count",
    "top_suspected_drivers", "engineering_recommendations",
)
SPEC_PART = (
    "part_id", "spec_compliance_status", "violation_count", "critical_violation_count",
    "warning_violation_count", "violated_requirement_ids", "violation_summary",
    "recommended_actions",
)
FEEDBACK_PART = (
    "part_id", "actual_scrap", "engineer_review_outcome", "feedback_classification",
    "feedback_priority", "feedback_interpretation", "review_notes",
)


def _keep(df: DataFrame, columns) -> DataFrame:
    return df.select(*[c for c in columns if c in df.columns])


def trace_table(review: DataFrame, spec: DataFrame, feedback: DataFrame) -> DataFrame:
    """Stored review rows with their stored limit results and feedback, where they exist; one to one.

    A repeated key in any of them fails the read. All joins use the same key.
    """
    others = [(_keep(spec, SPEC_PART), "Limit results"), (_keep(feedback, FEEDBACK_PART), "Feedback cases")]
    return with_matches(review, "Review results", others)


def _with_feedback(rows: DataFrame, feedback: DataFrame) -> DataFrame:
    """Rows with the class of their feedback, where they have any."""
    notes = [c for c in ("engineer_review_outcome", "review_notes") if c in feedback.columns]
    key = F.col("part_id").cast("string").alias("part_id")
    labelled = feedback.select(key, outcome_label(feedback).alias("actual_scrap"), *notes)
    known = rows.drop("actual_scrap", *notes)
    joined = with_matches(known, "Batch", [(labelled, "Feedback")])
    classes = {c: F.col(c) for c in FEEDBACK_PART if c.startswith("feedback_")}
    judged = with_feedback_class(joined)
    return judged.withColumns({c: F.when(F.col("actual_scrap").isNotNull(), v) for c, v in classes.items()})


def trace_rows(scored: DataFrame, feedback: DataFrame, threshold: float | Column) -> DataFrame:
    """Review, limits and feedback of every scored row: all but the feedback are functions of the row itself."""
    return _with_feedback(with_compliance(batch_review(scored, threshold)), feedback)


def _preference() -> Column:
    shown = (F.col("feedback_classification") == cfg.TRUE_POSITIVE) & (
        F.col("spec_compliance_status") == CRITICAL
    )
    return (
        F.when(shown, 0).when(F.col("review_decision") == cfg.REVIEW, 1).otherwise(2)
    )


def _most_telling(rows: DataFrame) -> DataFrame:
    risk = F.coalesce(F.nanvl("scrap_probability", F.lit(-1.0)), F.lit(-1.0))
    return rows.orderBy(_preference(), risk.desc(), "part_id").limit(1)


def _words(name: str) -> Column:
    return F.replace(F.lower(name), F.lit("_"), F.lit(" "))


def trace_sentence() -> Column:
    routed = (
        F.when(
            F.col("review_decision") == cfg.REVIEW,
            F.lit("the model routed it for engineering review with "),
        )
        .otherwise(
            F.concat(F.lit("the model routed it to "), _words("review_decision"), F.lit(" with "))
        )
    )
    drivers = F.col("top_suspected_drivers")
    return F.concat(
        F.lit("This record was selected as a traceable engineering review example because "),
        routed,
        F.col("risk_level"),
        F.lit(" predicted risk, "),
        F.when(
            drivers.isNull() | (drivers == ""),
            "RCA did not identify configured suspected drivers",
        ).otherwise(F.concat(F.lit("RCA highlighted "), drivers)),
        F.lit(", "),
        F.coalesce(
            F.concat(F.lit("specification checks reported "), _words("spec_compliance_status")),
            F.lit("specification compliance data is not available"),
        ),
        F.lit(", "),
        F.coalesce(
            F.concat(
                F.lit("later feedback classified the case as "), _words("feedback_classification")
            ),
            F.lit("later feedback is not available"),
        ),
        F.lit("."),
    )


def _shown(traced: DataFrame) -> DataFrame:
    return _keep(
        traced.withColumn("trace_summary", trace_sentence()),
        (*REVIEW_PART[:1], *shape.FEATURES, *REVIEW_PART[1:], *SPEC_PART[1:],
         *FEEDBACK_PART[1:], "trace_summary"),
    )


def case_trace(review: DataFrame, spec: DataFrame, feedback: DataFrame) -> DataFrame:
    """One representative case of stored results with everything known about it."""
    return _shown(_most_telling(trace_table(review, spec, feedback)))


def case_trace_job(scored: DataFrame, feedback: DataFrame, threshold: float | Column) -> DataFrame:
    """One representative case of a scored batch, with everything known about it.

    The case is chosen in one join on the decision, the limit status and the feedback; the texts are worked out for
    the chosen row only.
    """
    decided = with_compliance(with_decision(scored, threshold)).select(
        *scored.columns, "review_decision", "spec_compliance_status"
    )
    chosen = _most_telling(_with_feedback(decided, feedback)).drop(
        "review_decision", "spec_compliance_status"
    )
    return _shown(with_compliance(batch_review(chosen, threshold)))
