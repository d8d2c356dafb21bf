"""Risk scales, routing decisions and the additive scorecard, each as a Column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from linewarden.config import risk as cfg


def known(value: Column) -> Column:
    """The value with NaN as null, since Spark orders NaN above every number."""
    return F.nanvl(value.cast("double"), F.lit(None).cast("double"))


def _by_cuts(value: Column, cuts: Sequence[tuple[str, float]], lowest: str) -> Column:
    """Label of the first cut (highest first) that `value` reaches; null falls to lowest."""
    value = known(value)
    name, cut = cuts[0]
    label = F.when(value >= cut, name)
    for name, cut in cuts[1:]:
        label = label.when(value >= cut, name)
    return label.otherwise(lowest)


def _by_ranges(value: Column, ranges: Sequence[tuple]) -> Column:
    """Label of the half-open range [lower, upper) holding `value`, else null."""
    value = known(value)
    return F.coalesce(
        *[F.when((value >= low) & (value < high), label) for label, low, high, *_ in ranges]
    )


def _lookup(key: Column, table: Mapping[str, str]) -> Column:
    return F.coalesce(*[F.when(key == k, v) for k, v in table.items()])


def risk_level(probability: Column) -> Column:
    return _by_cuts(probability, cfg.LEVEL_CUTS, cfg.LOWEST_LEVEL)


def calibration_band(probability: Column, bands=cfg.BANDS) -> Column:
    """Band label; values outside every band fall to the last one."""
    return F.coalesce(_by_ranges(probability, bands), F.lit(bands[-1][0]))


def strict_band(probability: Column, bands=cfg.BANDS) -> Column:
    """Band label; null outside every band."""
    return _by_ranges(probability, bands)


def export_flag(probability: Column, threshold: float) -> Column:
    return F.when(known(probability) >= threshold, "High").otherwise("Low")


def confidence(probability: Column) -> Column:
    return F.when(probability.isNull() | F.isnan(probability), "Unknown").otherwise(
        _by_cuts(probability, cfg.CONFIDENCE_CUTS, "Watch")
    )


def temperature_bin(temperature: Column) -> Column:
    return _by_ranges(temperature, cfg.TEMPERATURE_BINS)


def review_decision(probability: Column, level: Column, threshold: Column) -> Column:
    return (
        F.when((known(probability) >= known(threshold)) | (level == "High"), cfg.REVIEW)
        .when(level == "Medium", cfg.WATCH)
        .otherwise(cfg.ROUTINE)
    )


def decision_reason(probability: Column, level: Column, threshold: Column) -> Column:
    return (
        F.when(known(probability) >= known(threshold), cfg.REASON_THRESHOLD)
        .when(level == "High", cfg.REASON_HIGH)
        .when(level == "Medium", cfg.REASON_MEDIUM)
        .otherwise(cfg.REASON_LOW)
    )


def outcome_class(routed: Column, actual: Column) -> Column:
    """Two-by-two class of a routed flag against the later outcome."""
    issue = actual == 1
    return (
        F.when(routed & issue, cfg.TRUE_POSITIVE)
        .when(routed, cfg.FALSE_ALARM)
        .when(issue, cfg.MISSED)
        .otherwise(cfg.TRUE_NEGATIVE)
    )


def feedback_class(decision: Column, actual: Column) -> Column:
    return outcome_class(decision == cfg.REVIEW, actual)


def feedback_priority(outcome: Column) -> Column:
    return _lookup(outcome, cfg.FEEDBACK_PRIORITY)


def feedback_reading(outcome: Column) -> Column:
    return _lookup(outcome, cfg.FEEDBACK_READING)


def flag_count() -> Column:
    """How many of the five fixed warning signs a production row shows."""
    signs = (
        F.col("temperature_c") > 190,
        F.col("cycle_time_s") > 50,
        F.col("vibration_mm_s") > 2.7,
        F.col("machine_id") == "M2",
        F.col("shift") == "night",
    )
    return reduce(Column.__add__, [F.coalesce(s, F.lit(False)).cast("int") for s in signs])


def flag_level(count: Column) -> Column:
    low, medium, high = cfg.FLAG_LEVELS
    return F.when(count >= 3, high).when(count == 2, medium).otherwise(low)


def sigmoid(score: Column) -> Column:
    return 1 / (1 + F.exp(-score))


def clip(value: Column, low: float, high: float) -> Column:
    """Bounded value; `least` and `greatest` skip nulls, so null is kept explicitly."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def scorecard(
    intercept: float = cfg.SCORE_INTERCEPT,
    offsets: Mapping[str, Mapping[str, float]] = cfg.SCORE_OFFSETS,
    ramps: Sequence[tuple] = cfg.SCORE_RAMPS,
) -> Column:
    """Risk score: points per category plus clipped linear terms."""
    score = F.lit(intercept)
    for column, points in offsets.items():
        term = F.lit(0.0)
        for value, amount in points.items():
            term = F.when(F.col(column) == value, F.lit(amount)).otherwise(term)
        score = score + term
    for column, start, slope, cap, sign in ramps:
        term = clip((F.col(column) - start) * slope, 0.0, cap)
        score = score + term if sign > 0 else score - term
    return score
