"""The ten-row batch: decisions, causes, limits and feedback with known results."""

import pytest
from pyspark.sql import functions as F

from linewarden.operators import compliance, feedback, rootcause
from linewarden.plans import batch_review as review_plan
from linewarden.plans import spec_compliance as spec_plan
from linewarden.operators.validation import DataQualityError
from linewarden.plans.case_trace import case_trace, case_trace_job
from linewarden.plans.feedback_loop import evaluate_feedback


def by_part(df):
    return {r.part_id: r for r in df.collect()}


def test_review(batch):
    rows = by_part(review_plan.batch_review(batch, 0.4))
    expected = {
        "NB000001": ("High", "ENG", 12, "Very high temperature; High vibration; Abnormal cycle time"),
        "NB000002": ("Low", "STA", 0, ""),
        "NB000003": ("Low", "STA", 5, "High temperature; Elevated vibration; Long cycle time"),
        "NB000004": ("Low", "STA", 1, "Low temperature"),
        "NB000005": ("Medium", "ENG", 2, "Machine M2 risk pattern; Night shift production"),
        "NB000006": ("Medium", "ADD", 1, "Material batch B4"),
        "NB000007": ("Low", "STA", 2, "Night shift production; High humidity"),
        "NB000008": ("Medium", "ENG", 8, "High temperature; High pressure; Elevated vibration"),
        "NB000009": ("Low", "STA", 0, ""),
        "NB000010": ("Medium", "ENG", 8, "High temperature; Low pressure; Elevated vibration"),
    }
    for part, (level, decision, drivers, top) in expected.items():
        row = rows[part]
        assert row.risk_level == level
        assert row.review_decision[:3] == decision
        assert row.suspected_driver_count == drivers
        assert row.top_suspected_drivers == top
    assert rows["NB000001"].root_cause_summary == (
        "The batch shows high scrap risk mainly due to very high temperature, "
        "high vibration, and abnormal cycle time."
    )
    assert rows["NB000005"].root_cause_summary == (
        "The batch shows medium scrap risk mainly due to machine m2 risk pattern "
        "and night shift production."
    )
    assert rows["NB000004"].root_cause_summary.endswith("mainly due to low temperature.")
    assert rows["NB000002"].engineering_recommendations.startswith("No immediate engineering")
    assert rows["NB000001"].engineering_recommendations.count("; ") == 11
    assert rows["NB000001"].decision_reason.startswith("Probability exceeds")


def test_review_summary(batch):
    found = {
        (r.section, r.name): r.row_count
        for r in review_plan.review_summary(review_plan.batch_review(batch, 0.4)).collect()
    }
    assert found["decision", "ENGINEERING_REVIEW_REQUIRED"] == 4
    assert found["decision", "ADDITIONAL_MONITORING"] == 1
    assert found["decision", "STANDARD_MONITORING"] == 5
    assert [found["risk_level", v] for v in ("High", "Medium", "Low")] == [1, 4, 5]
    drivers = rootcause.driver_counts(review_plan.batch_review(batch, 0.4)).collect()
    assert [(d.driver, d.row_count) for d in drivers[:3]] == [
        ("Elevated vibration", 3),
        ("High temperature", 3),
        ("Night shift production", 2),
    ]
    assert len(drivers) == 13


def test_limits(batch):
    rows = by_part(spec_plan.spec_compliance(batch))
    counts = {p: (r.violation_count, r.critical_violation_count) for p, r in rows.items()}
    assert counts == {
        "NB000001": (9, 3), "NB000002": (0, 0), "NB000003": (3, 0), "NB000004": (0, 0),
        "NB000005": (0, 0), "NB000006": (0, 0), "NB000007": (1, 0), "NB000008": (5, 0),
        "NB000009": (0, 0), "NB000010": (6, 0),
    }
    assert rows["NB000007"].violation_summary == (
        "HUMIDITY_MAX_WARNING: humidity_percent=64.5 does not satisfy <= 60"
    )
    assert "humidity_percent=62 does" in rows["NB000001"].violation_summary
    assert "pressure_bar=5.05 does not satisfy >= 5.1" in rows["NB000010"].violation_summary
    assert rows["NB000002"].violation_summary == rows["NB000002"].recommended_actions == ""
    summary = spec_plan.compliance_summary(batch).first()
    assert (summary.compliant, summary.warning_violation, summary.critical_violation) == (5, 4, 1)
    per_limit = [(v.requirement_id, v.violation_count) for v in summary.violations_by_requirement]
    assert per_limit == [
        ("CYCLE_TIME_MAX_WARNING", 4), ("TEMP_MAX_WARNING", 4), ("VIBRATION_MAX_WARNING", 4),
        ("HUMIDITY_MAX_WARNING", 3), ("LOW_OPERATOR_EXPERIENCE_WARNING", 3),
        ("PRESSURE_MAX_WARNING", 2), ("CYCLE_TIME_MAX_CRITICAL", 1), ("PRESSURE_MIN_WARNING", 1),
        ("TEMP_MAX_CRITICAL", 1), ("VIBRATION_MAX_CRITICAL", 1),
    ]
    critical = compliance.critical_records(compliance.with_compliance(batch)).collect()
    assert [c.part_id for c in critical] == ["NB000001"]
    assert len(critical[0].violated_requirement_ids) == 9
    facts = compliance.violation_facts(batch)
    assert facts.count() == 24


def test_feedback(batch, outcomes):
    found = evaluate_feedback(review_plan.batch_review(batch, 0.4), outcomes)
    classes = {r.feedback_classification: r.row_count for r in found.class_counts.collect()}
    assert classes == {
        "FALSE_ALARM_REVIEW": 1, "MISSED_ISSUE": 1,
        "TRUE_NEGATIVE_MONITORING": 5, "TRUE_POSITIVE_REVIEW": 3,
    }
    cases = by_part(found.cases)
    assert cases["NB000003"].feedback_classification == "MISSED_ISSUE"
    assert cases["NB000003"].feedback_priority == "highest"
    assert cases["NB000008"].feedback_classification == "FALSE_ALARM_REVIEW"
    assert tuple(found.coverage.first()) == (10, 10, 10, 0, 0)
    assert found.missing.isEmpty() and found.extra.isEmpty()
    assert tuple(found.effectiveness.first()) == (4, 4, 1, 1, 0.75, 0.25)
    assert [tuple(r) for r in found.scenarios.collect()] == [
        (0.3, 3, 2, 1, 4, 5, 0.75, 0.4),
        (0.4, 3, 1, 1, 5, 4, 0.75, 0.25),
        (0.5, 2, 0, 2, 6, 2, 0.5, 0.0),
        (0.6, 1, 0, 3, 6, 1, 0.25, 0.0),
    ]
    drivers = [(r.driver, r.row_count) for r in found.confirmed_drivers.collect()]
    assert drivers[:2] == [("Elevated vibration", 2), ("High temperature", 2)]
    assert len(drivers) == 9


def test_trace(batch, outcomes):
    review = review_plan.batch_review(batch, 0.4)
    cases = feedback.feedback_cases(review, outcomes)
    traced = case_trace(review, compliance.with_compliance(batch), cases).collect()
    assert [t.part_id for t in traced] == ["NB000001"]
    assert traced[0].trace_summary == (
        "This record was selected as a traceable engineering review example because the model "
        "routed it for engineering review with High predicted risk, RCA highlighted Very high "
        "temperature; High vibration; Abnormal cycle time, specification checks reported "
        "critical violation, later feedback classified the case as true positive review."
    )
    without = case_trace(review, compliance.with_compliance(batch), cases.filter("false")).first()
    assert without.part_id == "NB000001"
    assert without.trace_summary.endswith("later feedback is not available.")


def test_trace_job_agrees_with_stored_results(batch, outcomes):
    review = review_plan.batch_review(batch, 0.4)
    cases = feedback.feedback_cases(review, outcomes)
    stored = case_trace(review, compliance.with_compliance(batch), cases).first()
    assert case_trace_job(batch, outcomes, 0.4).first().asDict() == stored.asDict()


def test_joins_refuse_repeated_keys_and_bad_labels(batch, outcomes):
    review = review_plan.batch_review(batch, 0.4)
    for left, right in ((review.union(review.limit(1)), outcomes), (review, outcomes.union(outcomes.limit(1)))):
        with pytest.raises(Exception, match="repeats part_id"):
            feedback.feedback_cases(left, right).collect()
        with pytest.raises(DataQualityError, match=r"\(1\)"):
            feedback.require_feedback(left, right)
    wrong = outcomes.withColumn("actual_scrap", F.lit("bad"))
    with pytest.raises(Exception, match="invalid actual_scrap"):
        feedback.feedback_cases(review, wrong).collect()
    unreadable = review.withColumn("scrap_probability", F.lit("abc"))
    assert {r.scrap_probability for r in feedback.feedback_cases(unreadable, outcomes).collect()} == {None}
