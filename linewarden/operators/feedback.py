"""Compare review routing with what was found later."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linewarden.config import production as shape
from linewarden.config import risk as cfg
from linewarden.functions.risk import (
    feedback_class,
    feedback_priority,
    feedback_reading,
    known,
)
from linewarden.functions.text import as_double, rounded
from linewarden.operators.evaluation import ratio
from linewarden.operators.rootcause import driver_counts
from linewarden.operators.validation import DataQualityError, duplicate_keys, require_columns

KEY = shape.KEY


def _key(df: DataFrame) -> Column:
    return F.col(KEY).cast("string").alias(KEY)


def invalid_labels(feedback: DataFrame) -> DataFrame:
    """Feedback rows whose outcome is missing or neither 0 nor 1."""
    valid = F.coalesce(as_double(feedback, "actual_scrap").isin(0.0, 1.0), F.lit(False))
    return feedback.filter(~valid)


def require_feedback(review: DataFrame, feedback: DataFrame) -> None:
    """Refuse inputs that would not join one to one or carry invalid outcomes."""
    require_columns(review, shape.REVIEW_COLUMNS, "Review results")
    require_columns(feedback, shape.FEEDBACK_COLUMNS, "Feedback")
    for df, label in ((feedback, "Feedback"), (review, "Review results")):
        repeated = duplicate_keys(df).select(F.col(KEY).cast("string").alias("x")).distinct()
        _refuse(repeated, f"{label} repeats {KEY} values")
    wrong = invalid_labels(feedback).select(F.col("actual_scrap").cast("string").alias("x")).distinct()
    _refuse(wrong, "Feedback has invalid actual_scrap values")


def _refuse(values: DataFrame, problem: str, shown: int = 10) -> None:
    """Raise with how many values there are and the first few of them, if there are any."""
    first = [str(r.x) for r in values.orderBy("x").limit(shown).collect()]
    if first:
        raise DataQualityError(f"{problem} ({values.count()}): {', '.join(first)}")


#: Spreads rows without a key over the tasks of an exchange by key.
SPREAD = "_keyless_part"


def _once(df: DataFrame, label: str, *keys: str) -> DataFrame:
    copies = "_copies_of_key"
    counted = df.withColumn(copies, F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    single = F.col(KEY).isNull() | (F.col(copies) == 1)
    message = F.concat(F.lit(f"{label} repeats {KEY} "), KEY)
    return counted.filter(F.assert_true(single, message).isNull()).drop(copies)


def unique_by_key(df: DataFrame, label: str) -> DataFrame:
    """The rows that have a key; reading them fails where two share one.

    Copies are counted within the exchange that a join on the key needs anyway, in groups of one row unless the read
    fails. Rows without a key can't join, so they are gone before that exchange.
    """
    return _once(df.where(F.col(KEY).isNotNull()), label, KEY)


def with_matches(rows: DataFrame, label: str, others: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """All rows, each with the match of its key in every other table; reading fails where a table repeats a key.

    Rows without a key match nothing, may be any number and stay: they are exchanged by the number of their input
    partition, so a task gets what one input task held of them. The counts and all joins share one exchange of `rows`.
    """
    keys = [KEY, SPREAD]
    placed = rows.withColumn(SPREAD, F.when(F.col(KEY).isNull(), F.spark_partition_id()).otherwise(0))
    joined = _once(placed, label, *keys)
    for other, name in others:
        # Always 0, but not a constant to the optimizer, which would take it out of the join's keys.
        known = other.where(F.col(KEY).isNotNull()).withColumn(SPREAD, F.pmod(F.hash(KEY), F.lit(1)))
        joined = joined.join(_once(known, name, *keys), keys, "left")
    return joined.drop(SPREAD)


def outcome_label(feedback: DataFrame) -> Column:
    """0 or 1; reading any other outcome fails."""
    value = as_double(feedback, "actual_scrap")
    shown = F.coalesce(F.col("actual_scrap").cast("string"), F.lit("nothing"))
    wrong = F.raise_error(F.concat(F.lit("Feedback has an invalid actual_scrap value: "), shown))
    return F.when(value.isin(0.0, 1.0), value.cast("int")).otherwise(wrong.cast("int"))


def feedback_cases(review: DataFrame, feedback: DataFrame) -> DataFrame:
    """Review results with their feedback, classified; one to one.

    A repeated key on either side or an outcome other than 0 and 1 fails the read. The probability and the threshold
    become numbers, null where they can't. A plain equi-join: neither side has a size bound, so the join strategy
    is left to the planner. Columns present on both sides get the suffixes `_x` and `_y`.
    """
    clash = (set(review.columns) & set(feedback.columns)) - {KEY}
    numbers = {
        c: as_double(review, c) for c in ("scrap_probability", "review_threshold") if c in review.columns
    }
    left = unique_by_key(
        review.withColumns({KEY: _key(review), **numbers}), "Review results"
    ).withColumnsRenamed({c: f"{c}_x" for c in clash})
    right = unique_by_key(
        feedback.withColumns({KEY: _key(feedback), "actual_scrap": outcome_label(feedback)}), "Feedback"
    ).withColumnsRenamed({c: f"{c}_y" for c in clash})
    return with_feedback_class(left.join(right, KEY, "inner"))


def with_feedback_class(cases: DataFrame) -> DataFrame:
    return cases.withColumn(
        "feedback_classification", feedback_class(F.col("review_decision"), F.col("actual_scrap"))
    ).withColumns(
        {
            "feedback_priority": feedback_priority(F.col("feedback_classification")),
            "feedback_interpretation": feedback_reading(F.col("feedback_classification")),
        }
    )


def without_feedback(review: DataFrame, feedback: DataFrame) -> DataFrame:
    """Reviewed part ids for which no feedback exists."""
    return (
        review.select(_key(review))
        .distinct()
        .join(feedback.select(_key(feedback)).distinct(), KEY, "left_anti")
    )


def extra_feedback(review: DataFrame, feedback: DataFrame) -> DataFrame:
    """Part ids with feedback that were never reviewed."""
    return without_feedback(feedback, review)


def feedback_coverage(review: DataFrame, feedback: DataFrame) -> DataFrame:
    """Row and id counts of both sides.

    The ids of both tables are stacked and counted per id: one exchange with map-side
    counting, and no id is ever paired with another.
    """
    sided = review.select(_key(review), F.lit(1).alias("r"), F.lit(0).alias("f")).unionByName(
        feedback.select(_key(feedback), F.lit(0).alias("r"), F.lit(1).alias("f"))
    )
    per_id = sided.groupBy(KEY).agg(
        F.sum("r").alias("review_rows"), F.sum("f").alias("feedback_rows")
    )
    zero = F.lit(0).cast("long")
    matched = F.when(F.col(KEY).isNotNull(), F.col("review_rows") * F.col("feedback_rows"))
    return per_id.agg(
        F.coalesce(F.sum("review_rows"), zero).alias("review_rows"),
        F.coalesce(F.sum("feedback_rows"), zero).alias("feedback_rows"),
        F.coalesce(F.sum(matched), zero).alias("matched_rows"),
        F.count_if(F.col("feedback_rows") == 0).alias("missing_feedback_rows"),
        F.count_if(F.col("review_rows") == 0).alias("extra_feedback_rows"),
    )


def review_effectiveness(cases: DataFrame) -> DataFrame:
    """How many issues the routing caught and how many reviews were in vain."""
    outcome = F.col("feedback_classification")
    counts = cases.agg(
        F.count_if(F.col("actual_scrap") == 1).alias("actual_issue_count"),
        F.count_if(F.col("review_decision") == cfg.REVIEW).alias("review_required_count"),
        F.count_if(outcome == cfg.MISSED).alias("missed_issue_count"),
        F.count_if(outcome == cfg.FALSE_ALARM).alias("false_alarm_count"),
        F.count_if(outcome == cfg.TRUE_POSITIVE).alias("caught"),
    )
    return counts.select(
        "actual_issue_count",
        "review_required_count",
        "missed_issue_count",
        "false_alarm_count",
        rounded(ratio(F.col("caught"), F.col("actual_issue_count")), 4).alias(
            "issue_capture_rate"
        ),
        rounded(ratio(F.col("false_alarm_count"), F.col("review_required_count")), 4).alias(
            "false_alarm_rate_among_reviews"
        ),
    )


def threshold_scenarios(
    cases: DataFrame, thresholds: Sequence[float] = cfg.SCENARIOS
) -> DataFrame:
    """Review outcomes had another threshold been used: one scan for all thresholds."""
    issue, clean = F.col("actual_scrap") == 1, F.col("actual_scrap") == 0
    sums = [F.count_if(issue).alias("issues"), F.count(F.lit(1)).alias("n")]
    rows = []
    for i, threshold in enumerate(thresholds):
        reached = known(F.col("scrap_probability")) >= threshold
        below = known(F.col("scrap_probability")) < threshold
        sums += [
            F.count_if(reached & issue).alias(f"tp{i}"),
            F.count_if(reached & clean).alias(f"fa{i}"),
            F.count_if(below & issue).alias(f"miss{i}"),
            F.count_if(reached).alias(f"hit{i}"),
        ]
        tp, fa, miss, hit = (F.col(f"{k}{i}") for k in ("tp", "fa", "miss", "hit"))
        rows.append(
            F.struct(
                F.lit(threshold).alias("threshold"),
                tp.alias("true_positive_reviews"),
                fa.alias("false_alarm_reviews"),
                miss.alias("missed_issues"),
                (F.col("n") - tp - fa - miss).alias("true_negative_monitoring"),
                hit.alias("review_required_count"),
                rounded(ratio(tp, F.col("issues")), 4).alias("issue_capture_rate"),
                rounded(ratio(fa, hit), 4).alias("false_alarm_rate_among_reviews"),
            )
        )
    return cases.agg(*sums).select(F.inline(F.array(*rows)))


def confirmed_driver_counts(cases: DataFrame) -> DataFrame:
    """Driver frequency among rows later confirmed as issues."""
    return driver_counts(cases.filter(F.col("actual_scrap") == 1))
