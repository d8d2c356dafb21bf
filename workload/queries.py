"""Registered queries: one per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linewarden.config import production as shape
from linewarden.functions import risk as scales
from linewarden.operators import compliance, evaluation, feedback, model, rootcause, summary
from linewarden.operators import validation as quality
from linewarden.functions.text import (
    array_rounded,
    drivers_in_summary,
    join_list,
    percent_text,
    rounded,
    title_case,
)
from linewarden.plans import batch_review as review_plan
from linewarden.plans import case_trace as trace_plan
from linewarden.plans import feedback_loop as loop_plan
from linewarden.plans import gated, overview, running_quality as running, spec_compliance as spec_plan
from linewarden.session import configure
from linewarden.sources.tables import (
    coerce_numeric,
    project_existing,
    read_parquet,
    shared_path,
    write_rows,
    write_summary,
)
from workload import views
from workload.views import EXPORT_THRESHOLD, THRESHOLD

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    QUERIES[function.__name__] = run
    return function


def reviewed(spark, d) -> DataFrame:
    return review_plan.batch_review(views.scored(spark, d), THRESHOLD)


def checked(spark, d) -> DataFrame:
    return compliance.with_compliance(views.plain(spark, d))


def results(spark, d) -> DataFrame:
    return summary.prediction_results(views.scored(spark, d), EXPORT_THRESHOLD)


def cases(spark, d) -> DataFrame:
    return feedback.feedback_cases(reviewed(spark, d), views.feedback(spark, d))


def sweep(spark, d) -> DataFrame:
    return evaluation.threshold_sweep(views.scored(spark, d))


def costs(spark, d) -> DataFrame:
    return evaluation.threshold_costs(sweep(spark, d))


# --- scans, projections, scales --------------------------------------------------------


@query
def scan_production(spark, d):
    return views.plain(spark, d)


@query
def project_features(spark, d):
    return project_existing(
        views.plain(spark, d), ("part_id", *shape.FEATURES, "not_in_the_table")
    )


@query
def coerce_numeric_columns(spark, d):
    raw = views.raw(spark, d)
    return coerce_numeric(raw).select("part_id", *shape.NUMERIC)


@query
def scorecard_score(spark, d):
    score = scales.scorecard(intercept=views.INTERCEPT)
    return views.plain(spark, d).select(
        "part_id",
        array_rounded(score, 6).alias("risk_score"),
        array_rounded(scales.sigmoid(score), 4).alias("scrap_probability"),
    )


@query
def risk_levels(spark, d):
    p = F.col("scrap_probability")
    return views.scored(spark, d).select(
        "part_id",
        "scrap_probability",
        scales.risk_level(p).alias("risk_level"),
        scales.calibration_band(p).alias("risk_band"),
        percent_text(p).alias("risk_text"),
    )


@query
def review_decisions(spark, d):
    return review_plan.with_decision(views.scored(spark, d), THRESHOLD).select(
        "part_id", "scrap_probability", "risk_level", "review_threshold", "review_decision",
        "decision_reason",
    )


@query
def decision_counts(spark, d):
    return review_plan.decision_counts(reviewed(spark, d))


@query
def risk_level_counts(spark, d):
    return review_plan.risk_level_counts(reviewed(spark, d))


@query
def prediction_confidence(spark, d):
    return summary.prediction_confidence(views.scored(spark, d))


# --- engineering limits ------------------------------------------------------------------


@query
def spec_flags(spark, d):
    p = views.plain(spark, d)
    flags = compliance.spec_flags(p)
    return p.select("part_id", *[f.cast("int").alias(n.lower()) for n, f in flags.items()])


@query
def spec_compliance(spark, d):
    """Through the gated job."""
    return spec_plan.spec_compliance(views.plain(spark, d)).select("part_id", *trace_plan.SPEC_PART[1:])


@query
def violation_text(spark, d):
    """Texts over raw readings, so missing values and long decimals occur too."""
    raw = views.raw(spark, d).withColumn(
        "vibration_mm_s", (F.col("vibration_mm_s").cast("double") / 0.7).cast("string")
    )
    return compliance.with_compliance(raw).select("part_id", "violation_summary")


@query
def compliance_counts(spark, d):
    return spec_plan.compliance_counts(checked(spark, d))


@query
def violations_by_requirement(spark, d):
    return compliance.violation_counts(views.plain(spark, d))


@query
def top_violated_requirement(spark, d):
    return compliance.top_violated(views.plain(spark, d))


@query
def critical_records(spark, d):
    records = compliance.critical_records(checked(spark, d))
    return records.withColumn(
        "violated_requirement_ids", join_list(F.col("violated_requirement_ids"))
    )


@query
def violation_facts(spark, d):
    return compliance.violation_facts(views.plain(spark, d))


@query
def rules_dim(spark, d):
    """Every limit with its labels and how often it is violated, zero included."""
    p = views.plain(spark, d)
    counts = compliance.violation_counts(p)
    return (
        compliance.limits_table(spark)
        .join(counts.select("requirement_id", "violation_count"), "requirement_id", "left")
        .withColumn("violation_count", F.coalesce("violation_count", F.lit(0)))
    )


@query
def compliance_summary(spark, d):
    """The summary document, its per-limit array flattened."""
    return spec_plan.compliance_summary(views.plain(spark, d)).select(
        "row_count", "requirement_count", "compliant", "warning_violation",
        "critical_violation",
        F.array_join(
            F.transform(
                "violations_by_requirement",
                lambda v: F.concat(
                    v["requirement_id"], F.lit("="), v["violation_count"].cast("string")
                ),
            ),
            "; ",
        ).alias("violations_by_requirement"),
    )


# --- root causes -------------------------------------------------------------------------


@query
def alias_resolution(spark, d):
    """Rules over a table whose signals go by other names, in mixed case."""
    p = views.plain(spark, d).select(
        "part_id",
        F.col("temperature_c").cast("string").alias("Process_Temperature"),
        F.when(F.col("pressure_bar") > 6, F.col("pressure_bar")).alias("pressure"),
        F.col("pressure_bar").alias("process_pressure"),
        F.col("vibration_mm_s").alias("VIBRATION_LEVEL"),
        F.concat(F.lit(" machine "), F.substring("machine_id", 2, 1)).alias("Machine"),
        F.upper("shift").alias("production_shift"),
    )
    flags = rootcause.cause_flags(p)
    return p.select("part_id", *[f.cast("int").alias(n) for n, f in flags.items()])


@query
def rca_flags(spark, d):
    p = views.plain(spark, d)
    flags = rootcause.cause_flags(p)
    return p.select("part_id", *[f.cast("int").alias(n) for n, f in flags.items()])


@query
def rca_drivers(spark, d):
    p = views.scored(spark, d)
    drivers = rootcause.suspected_drivers(p)
    return p.select("part_id", drivers.alias("drivers")).select(
        "part_id",
        F.size("drivers").alias("driver_count"),
        F.array_join(F.transform("drivers", lambda x: x["driver"]), "; ").alias("drivers"),
        F.array_join(F.transform("drivers", lambda x: x["severity"]), "; ").alias("severities"),
    )


@query
def rca_fallback(spark, d):
    """High-risk rows with no fired rule: two signals left, level given for every row."""
    p = views.scored(spark, d).select("part_id", "temperature_c", "pressure_bar")
    return rootcause.with_root_causes(p, level=F.lit("High")).select(
        "part_id", "suspected_driver_count", "top_suspected_drivers", "root_cause_summary",
        "engineering_recommendations",
    )


@query
def rca_recommendations(spark, d):
    return rootcause.with_root_causes(views.scored(spark, d)).select(
        "part_id", "engineering_recommendations"
    )


@query
def rca_summary(spark, d):
    return rootcause.with_root_causes(views.scored(spark, d)).select(
        "part_id", "root_cause_summary"
    )


@query
def rca_enriched(spark, d):
    return rootcause.with_root_causes(views.plain(spark, d)).select(
        "part_id", "suspected_driver_count", "top_suspected_drivers", "root_cause_summary",
        "engineering_recommendations",
    )


@query
def export_rca(spark, d):
    return results(spark, d).select(
        "part_id", "predicted_scrap_risk", "root_cause_summary", "engineering_recommendations"
    )


@query
def part_recommendations(spark, d):
    return views.scored(spark, d).select(
        "part_id",
        rootcause.part_recommendations(F.col("scrap_probability")).alias("recommendations"),
    )


@query
def sensor_evidence(spark, d):
    return views.plain(spark, d).select(
        "part_id", rootcause.sensor_evidence().alias("evidence")
    )


@query
def driver_counts(spark, d):
    return rootcause.driver_counts(reviewed(spark, d))


@query
def recurring_drivers(spark, d):
    return rootcause.recurring_drivers(results(spark, d))


@query
def summary_drivers(spark, d):
    """Drivers read back from each stored sentence, title-cased."""
    named = title_case(join_list(drivers_in_summary(F.col("root_cause_summary"))))
    return results(spark, d).select("part_id", named.alias("drivers"))


@query
def recommendation_counts(spark, d):
    return rootcause.recommendation_counts(results(spark, d))


@query
def representative_rca(spark, d):
    return rootcause.representative_rows(results(spark, d))


@query
def batch_review(spark, d):
    return reviewed(spark, d)


@query
def review_with_chosen_threshold(spark, d):
    """The review job on the threshold chosen from the same table's outcomes."""
    score = lambda df: review_plan.with_scorecard(
        df, scales.scorecard(intercept=views.INTERCEPT)
    )
    choice = QUERIES["review_threshold_choice"](spark, d)
    job = review_plan.review_job(views.plain(spark, d).drop("scrap"), choice, score)
    return job.results.select(
        "part_id", "scrap_probability", "review_threshold", "review_decision",
        "root_cause_summary",
    )


@query
def review_summary(spark, d):
    return review_plan.review_summary(reviewed(spark, d))


@query
def review_queue(spark, d):
    return summary.review_queue(reviewed(spark, d))


@query
def dominant_driver(spark, d):
    return summary.dominant_driver(results(spark, d))


# --- data quality ------------------------------------------------------------------------


@query
def schema_check(spark, d):
    """A table lacking the target and carrying two columns it should not."""
    return quality.schema_check(views.production(spark, d).drop("scrap", "has_feedback"))


@query
def missing_profile(spark, d):
    return quality.missing_profile(views.raw(spark, d))


@query
def numeric_validity(spark, d):
    return quality.numeric_validity(views.raw(spark, d))


@query
def invalid_examples(spark, d):
    return quality.invalid_examples(views.raw(spark, d))


@query
def invalid_target_examples(spark, d):
    return quality.invalid_target_examples(views.raw(spark, d))


@query
def unexpected_categories(spark, d):
    return quality.unexpected_categories(views.raw(spark, d))


@query
def target_profile(spark, d):
    return quality.target_profile(views.raw(spark, d))


@query
def range_violations(spark, d):
    return quality.range_violations(views.raw(spark, d))


@query
def duplicate_keys(spark, d):
    return quality.duplicate_keys(views.duplicates(spark, d))


@query
def duplicate_summary(spark, d):
    return quality.duplicate_summary(views.duplicates(spark, d))


@query
def dq_report(spark, d):
    return quality.quality_report(views.raw(spark, d))


@query
def running_quality(spark, d):
    """The quality report from the stored states of four batches, dealt by the digest of key and temperature."""
    raw, folder = views.raw(spark, d), shared_path(spark, "quality")
    for number in range(4):
        mine = F.pmod(F.xxhash64("part_id", "temperature_c"), F.lit(4)) == number
        running.add_batch(raw.where(mine), folder, f"part {number}")
    return running.running_report(spark, folder)


@query
def scoring_warnings(spark, d):
    return quality.scoring_warnings(views.raw(spark, d))


# --- thresholds, costs, calibration ------------------------------------------------------


@query
def confusion_metrics(spark, d):
    routed = views.scored(spark, d).withColumn(
        "prediction", (F.col("scrap_probability") >= 0.5).cast("int")
    )
    return evaluation.confusion_metrics(routed, "prediction")


@query
def threshold_sweep(spark, d):
    return sweep(spark, d)


@query
def selected_threshold(spark, d):
    return evaluation.selected_threshold(sweep(spark, d))


@query
def threshold_costs(spark, d):
    return costs(spark, d)


@query
def cost_optimal_threshold(spark, d):
    return evaluation.cost_optimal_threshold(costs(spark, d))


@query
def cost_summary(spark, d):
    return evaluation.cost_summary(costs(spark, d))


@query
def threshold_deltas(spark, d):
    return evaluation.threshold_deltas(sweep(spark, d))


@query
def threshold_tradeoff(spark, d):
    return evaluation.threshold_tradeoff(costs(spark, d))


@query
def risk_band_eval(spark, d):
    return evaluation.risk_band_evaluation(views.scored(spark, d))


@query
def roc_auc(spark, d):
    ranked = evaluation.ranking_metrics(evaluation.score_histogram(views.scored(spark, d)))
    return ranked.select(rounded(F.col("roc_auc"), 6).alias("roc_auc"))


@query
def average_precision(spark, d):
    ranked = evaluation.ranking_metrics(evaluation.score_histogram(views.scored(spark, d)))
    return ranked.select(rounded(F.col("average_precision"), 6).alias("average_precision"))


@query
def ranking_unrounded(spark, d):
    """Both ranking metrics over scores with unbounded distinct values."""
    exact = views.production(spark, d).select(
        "scrap", scales.sigmoid(array_rounded(F.col("risk_score"), 9)).alias("scrap_probability")
    )
    ranked = evaluation.ranking_metrics(evaluation.score_histogram(exact))
    return ranked.select(
        rounded(F.col("roc_auc"), 6).alias("roc_auc"),
        rounded(F.col("average_precision"), 6).alias("average_precision"),
    )


@query
def evaluation_summary(spark, d):
    return evaluation.evaluation_summary(views.scored(spark, d))


@query
def review_threshold_choice(spark, d):
    return evaluation.review_threshold_choice(
        evaluation.cost_optimal_threshold(costs(spark, d)),
        evaluation.selected_threshold(sweep(spark, d)),
    )


# --- feedback ------------------------------------------------------------------------------


@query
def feedback_cases(spark, d):
    return cases(spark, d).select(
        "part_id", "scrap_probability", "review_decision", "actual_scrap",
        "engineer_review_outcome", "feedback_classification", "feedback_priority",
        "feedback_interpretation",
    )


@query
def feedback_job(spark, d):
    """The gated feedback job as a whole: its classes, its coverage and its scenarios, one name and count a row."""
    job = loop_plan.evaluate_feedback(reviewed(spark, d), views.feedback(spark, d))
    coverage = job.coverage.select(
        F.inline(F.array(*[
            F.struct(F.lit("coverage").alias("section"), F.lit(c).alias("name"), F.col(c).alias("row_count"))
            for c in job.coverage.columns
        ]))
    )
    classes = job.class_counts.select(
        F.lit("class").alias("section"), F.col("feedback_classification").alias("name"), "row_count"
    )
    scenarios = job.scenarios.select(
        F.lit("missed_at").alias("section"), F.format_number("threshold", 1).alias("name"),
        F.col("missed_issues").alias("row_count"),
    )
    return coverage.unionByName(classes).unionByName(scenarios)


@query
def stored_predictions(spark, d):
    """The exported predictions, written and read again."""
    path = shared_path(spark, "predictions")
    write_rows(results(spark, d), path)
    return read_parquet(spark, path, "Predictions")


@query
def stored_compliance(spark, d):
    """The limit check with its gate measured in the pass that writes it, read again."""
    path = shared_path(spark, "compliance")
    gated.write_compliance(views.plain(spark, d), path)
    return read_parquet(spark, path, "Limit results").select(
        "part_id", "spec_compliance_status", "violation_count", "violated_requirement_ids"
    )


@query
def stored_summary(spark, d):
    """The review effectiveness as a stored document, read again."""
    path = shared_path(spark, "effectiveness")
    found = feedback.review_effectiveness(cases(spark, d))
    write_summary(found, path)
    return spark.read.schema(found.schema).json(path)


@query
def feedback_class_counts(spark, d):
    return summary.value_counts(cases(spark, d), "feedback_classification")


@query
def feedback_coverage(spark, d):
    return feedback.feedback_coverage(views.scored(spark, d), views.feedback(spark, d))


@query
def feedback_missing(spark, d):
    return feedback.without_feedback(views.scored(spark, d), views.feedback(spark, d))


@query
def feedback_extra(spark, d):
    return feedback.extra_feedback(views.scored(spark, d), views.feedback(spark, d))


@query
def feedback_invalid_labels(spark, d):
    return feedback.invalid_labels(views.raw_feedback(spark, d))


@query
def review_effectiveness(spark, d):
    return feedback.review_effectiveness(cases(spark, d))


@query
def threshold_scenarios(spark, d):
    return feedback.threshold_scenarios(cases(spark, d))


@query
def confirmed_driver_counts(spark, d):
    return feedback.confirmed_driver_counts(cases(spark, d))


# --- descriptive tables and exports ------------------------------------------------------


@query
def machine_summary(spark, d):
    return summary.machine_summary(views.plain(spark, d))


@query
def scrap_by_machine(spark, d):
    return summary.scrap_rate_by(views.plain(spark, d), "machine_id")


@query
def scrap_by_shift(spark, d):
    return summary.scrap_rate_by(views.plain(spark, d), "shift")


@query
def scrap_by_category(spark, d):
    return summary.scrap_rate_by_category(views.plain(spark, d))


@query
def scrap_by_temperature(spark, d):
    return summary.scrap_rate_by_temperature(views.plain(spark, d))


@query
def rule_count_levels(spark, d):
    return summary.rule_count_levels(views.plain(spark, d))


@query
def dataset_totals(spark, d):
    return summary.dataset_totals(views.plain(spark, d))


@query
def highest_risk_machine(spark, d):
    return summary.highest_risk_category(views.plain(spark, d))


@query
def export_predictions(spark, d):
    return summary.export_predictions(views.scored(spark, d), EXPORT_THRESHOLD)


@query
def export_without_flagged(spark, d):
    """No row reaches the threshold, so the whole table is ranked."""
    return summary.export_predictions(views.scored(spark, d), 0.99)


@query
def sample_prediction(spark, d):
    return summary.sample_prediction(views.scored(spark, d), EXPORT_THRESHOLD)


@query
def prediction_kpis(spark, d):
    return summary.prediction_kpis(results(spark, d))


@query
def case_trace_table(spark, d):
    rows = trace_plan.trace_rows(views.scored(spark, d), views.feedback(spark, d), THRESHOLD)
    return rows.select(
        "part_id", "scrap_probability", "review_decision", "spec_compliance_status",
        "violation_count", "actual_scrap", "feedback_classification",
        trace_plan.trace_sentence().alias("trace_summary"),
    )


@query
def trace_case(spark, d):
    batch = views.scored(spark, d).drop("scrap")
    return trace_plan.case_trace_job(batch, views.feedback(spark, d), THRESHOLD)


@query
def workflow_overview(spark, d):
    return overview.workflow_overview(
        overview.quality_card(views.raw(spark, d)),
        overview.review_card(reviewed(spark, d)),
        overview.compliance_card(views.plain(spark, d)),
        overview.feedback_card(cases(spark, d)),
    )


# --- models --------------------------------------------------------------------------------

_FITTED: dict[tuple, dict] = {}


def fitted(spark, d, names):
    """Models fitted once per session and data folder, shared by the queries below."""
    known = _FITTED.setdefault((spark.sparkContext.applicationId, d), {})
    absent = [n for n in names if n not in known]
    if absent:
        known.update(model.fit(views.plain(spark, d), names=absent))
    return {n: known[n] for n in names}


@query
def split_profile(spark, d):
    return model.split_profile(views.plain(spark, d))


@query
def stratified_split_profile(spark, d):
    return model.stratified_split_profile(views.plain(spark, d))


@query
def training_profile(spark, d):
    profile = model.training_profile(views.plain(spark, d))
    return profile.withColumn("value", rounded(F.col("value"), 6))


@query
def model_checks(spark, d):
    """What must hold for every model, whatever it has learned."""
    names = [model.LOGISTIC, model.FOREST, model.BOOSTING]
    return model.model_checks(views.plain(spark, d), fitted(spark, d, names))


@query
def scored_batch(spark, d):
    forest = fitted(spark, d, [model.FOREST])[model.FOREST]
    batch = views.plain(spark, d).drop("scrap")
    return review_plan.batch_review(model.score(batch, forest), THRESHOLD)


@query
def feature_importance(spark, d):
    return model.feature_importance(fitted(spark, d, [model.FOREST])[model.FOREST], 8)


@query
def model_evaluation(spark, d):
    """Curves, base rate and thresholds of the forest on the test side."""
    forest = fitted(spark, d, [model.FOREST])[model.FOREST]
    return evaluation.evaluation_summary(
        model.score(model.test_rows(views.plain(spark, d)), forest, decimals=6)
    )


@query
def model_comparison(spark, d):
    names = [model.LOGISTIC, model.FOREST, model.BOOSTING]
    return model.model_comparison(views.plain(spark, d), fitted(spark, d, names))


@query
def best_model(spark, d):
    names = [model.LOGISTIC, model.FOREST, model.BOOSTING]
    table = views.plain(spark, d)
    return model.best_models(model.model_comparison(table, fitted(spark, d, names)))
