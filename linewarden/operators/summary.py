"""Descriptive tables, exports and single-case extracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linewarden.config import production as shape
from linewarden.config import risk as cfg
from linewarden.functions.risk import (
    confidence,
    export_flag,
    flag_count,
    flag_level,
    temperature_bin,
)
from linewarden.functions.text import percent_value, rounded
from linewarden.operators.rootcause import recurring_drivers, with_flagged_causes
from linewarden.sources.rulebook import CauseRules
from linewarden.sources.tables import project_existing

EXPORT_COLUMNS = (
    "part_id", "machine_id", "shift", "material_batch", *shape.NUMERIC, "scrap",
    "scrap_probability", "predicted_scrap_risk", "root_cause_summary",
    "engineering_recommendations",
)
EXPORT_ROWS = 25


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Observed values of a column with their row counts, ordered by value."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(column)
    )


def machine_summary(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col("machine_id").isNotNull())
        .groupBy("machine_id")
        .agg(
            F.count("part_id").alias("total_parts"),
            F.coalesce(F.sum("scrap"), F.lit(0)).alias("scrap_parts"),
            rounded(F.avg("scrap"), 6).alias("scrap_rate"),
            rounded(F.avg("temperature_c"), 4).alias("avg_temperature_c"),
            rounded(F.avg("cycle_time_s"), 4).alias("avg_cycle_time_s"),
            rounded(F.avg("vibration_mm_s"), 4).alias("avg_vibration_mm_s"),
        )
        .orderBy(F.desc("scrap_rate"), "machine_id")
    )


def _category_groups(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row and scrap counts per combination of the category columns.

    Category combinations are few, so this short table answers every question about single
    categories and distinct counts without multiplying the rows first.
    """
    return df.groupBy(*columns).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("scrap").alias("known"),
        F.sum("scrap").alias("scrap"),
    )


def _rate() -> Column:
    return percent_value(
        F.try_divide(F.sum("scrap").cast("double"), F.sum("known"))
    ).alias("scrap_rate")


def scrap_rate_by(df: DataFrame, column: str) -> DataFrame:
    """Scrap rate in percent per value of one category, highest first."""
    return (
        _category_groups(df.filter(F.col(column).isNotNull()), [column])
        .groupBy(F.col(column).cast("string").alias("label"))
        .agg(_rate())
        .orderBy(F.desc("scrap_rate"), "label")
    )


def scrap_rate_by_category(
    df: DataFrame, columns: Sequence[str] = shape.CATEGORICAL
) -> DataFrame:
    """Scrap rate of every category column from one scan."""
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("category"), F.col(c).cast("string").alias("label"))
            for c in columns
        ]
    )
    return (
        _category_groups(df, columns)
        .select("scrap", "known", F.inline(cells))
        .filter(F.col("label").isNotNull())
        .groupBy("category", "label")
        .agg(_rate())
        .orderBy("category", F.desc("scrap_rate"), "label")
    )


def dataset_totals(df: DataFrame) -> DataFrame:
    """Row, scrap and distinct category counts."""
    machine, shift, batch = shape.CATEGORICAL
    return _category_groups(df, shape.CATEGORICAL).agg(
        F.coalesce(F.sum("rows"), F.lit(0).cast("long")).alias("total_parts"),
        F.coalesce(F.sum("scrap"), F.lit(0).cast("long")).alias("scrap_parts"),
        rounded(F.try_divide(F.sum("scrap").cast("double"), F.sum("known")), 6).alias(
            "scrap_rate"
        ),
        F.count_distinct(machine).alias("machines"),
        F.count_distinct(shift).alias("shifts"),
        F.count_distinct(batch).alias("material_batches"),
    )


def highest_risk_category(df: DataFrame, column: str = "machine_id") -> DataFrame:
    """The category value with the highest scrap rate and its gap to the whole table."""
    groups = _category_groups(df, [column]).withColumn(
        "rate", F.try_divide(F.col("scrap").cast("double"), F.col("known"))
    )
    named = F.when(F.col(column).isNotNull(), F.col("rate"))
    best = F.max(named)
    overall = F.try_divide(F.sum("scrap").cast("double"), F.sum("known"))
    return groups.agg(
        best.alias("best"),
        overall.alias("overall"),
        # Equal rates: the smallest name, as in the sorted table.
        F.min_by(F.col(column), F.struct(-named, F.col(column))).alias(column),
    ).select(
        column,
        percent_value(F.col("best")).alias("scrap_rate"),
        percent_value(F.col("overall")).alias("overall_scrap_rate"),
        rounded((F.col("best") - F.col("overall")) * 100, 2).alias("gap_points"),
    )


def _fixed_labels(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    return df.sparkSession.createDataFrame(
        list(enumerate(labels, start=1)), "label_order int, label string"
    )


def scrap_rate_by_temperature(df: DataFrame) -> DataFrame:
    """Scrap rate per temperature bin in bin order; an empty bin has no rate."""
    groups = (
        df.select(temperature_bin(F.col("temperature_c")).alias("label"), "scrap")
        .filter(F.col("label").isNotNull())
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("rows"), F.avg("scrap").alias("rate"))
    )
    return (
        _fixed_labels(df, [name for name, *_ in cfg.TEMPERATURE_BINS])
        .join(groups, "label", "left")
        .select(
            "label_order",
            "label",
            F.coalesce("rows", F.lit(0).cast("long")).alias("row_count"),
            percent_value(F.col("rate")).alias("scrap_rate"),
        )
        .orderBy("label_order")
    )


def rule_count_levels(df: DataFrame) -> DataFrame:
    """Rows per warning-sign level in fixed order, zero where none."""
    groups = df.groupBy(flag_level(flag_count()).alias("label")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    return (
        _fixed_labels(df, cfg.FLAG_LEVELS)
        .join(groups, "label", "left")
        .select(
            "label_order",
            "label",
            F.coalesce("rows", F.lit(0).cast("long")).alias("row_count"),
        )
        .orderBy("label_order")
    )


# --- scored exports ------------------------------------------------------------------------


def with_export_flag(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.withColumn(
        "predicted_scrap_risk", export_flag(F.col("scrap_probability"), threshold)
    )


def prediction_results(
    scored: DataFrame, threshold: float, rules: CauseRules | None = None
) -> DataFrame:
    """Every row with its flag, and the root causes of flagged rows."""
    return with_flagged_causes(with_export_flag(scored, threshold), threshold, rules)


def filter_or_all(df: DataFrame, condition: Column) -> DataFrame:
    """Rows meeting the condition, or all rows when none does."""
    some = df.filter(condition).select(F.lit(1)).limit(1).exists()
    return df.filter(condition | ~some)


def export_predictions(
    scored: DataFrame,
    threshold: float,
    limit: int = EXPORT_ROWS,
    rules: CauseRules | None = None,
) -> DataFrame:
    """The riskiest flagged rows, or the riskiest rows when none is flagged.

    Flagged rows sort first, so the fallback is settled among the rows taken; causes are
    worked out for those rows only.
    """
    flagged = (F.col("predicted_scrap_risk") == "High").cast("int")
    taken = (
        with_export_flag(scored, threshold)
        .orderBy(flagged.desc(), F.desc("scrap_probability"), "part_id")
        .limit(limit)
    )
    # The window spans the `limit` rows just taken.
    best = F.max(flagged).over(Window.partitionBy())
    kept = taken.withColumn("best", best).filter(flagged == F.col("best")).drop("best")
    return project_existing(with_flagged_causes(kept, threshold, rules), EXPORT_COLUMNS)


def sample_prediction(
    scored: DataFrame, threshold: float, rules: CauseRules | None = None
) -> DataFrame:
    """The riskiest row with its causes and advice."""
    top = (
        with_export_flag(scored, threshold)
        .orderBy(F.desc("scrap_probability"), "part_id")
        .limit(1)
    )
    advice = F.col("engineering_recommendations")
    return with_flagged_causes(top, threshold, rules).select(
        "part_id",
        percent_value(F.col("scrap_probability")).alias("scrap_probability"),
        F.col("predicted_scrap_risk").alias("risk_level"),
        *[c for c in shape.FEATURES if c in scored.columns],
        "root_cause_summary",
        "engineering_recommendations",
        F.when(F.trim(advice) == "", cfg.NO_ACTION).otherwise(advice).alias("recommendations"),
    )


def prediction_confidence(scored: DataFrame) -> DataFrame:
    """Rows per display confidence."""
    return (
        scored.groupBy(confidence(F.col("scrap_probability")).alias("confidence"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy("confidence")
    )


def prediction_kpis(results: DataFrame) -> DataFrame:
    probability = F.col("scrap_probability")
    return results.agg(
        F.count(F.lit(1)).alias("total_predictions"),
        F.count_if(F.lower("predicted_scrap_risk") == "high").alias("high_risk_rows"),
        rounded(F.avg(F.nanvl(probability, F.lit(None).cast("double"))), 6).alias(
            "average_predicted_risk"
        ),
    )


def dominant_driver(results: DataFrame) -> DataFrame:
    return recurring_drivers(results, 1)


def review_queue(reviewed: DataFrame) -> DataFrame:
    """Rows routed to engineering review, riskiest first."""
    return (
        reviewed.filter(F.col("review_decision") == cfg.REVIEW)
        .select(
            "part_id",
            "scrap_probability",
            "risk_level",
            "review_decision",
            "root_cause_summary",
            "engineering_recommendations",
        )
        .orderBy(F.desc("scrap_probability"), "part_id")
    )
