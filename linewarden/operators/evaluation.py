"""Score a classifier: confusion metrics, threshold sweep, costs, bands and ranking curves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linewarden.config import risk as cfg
from linewarden.functions.risk import known, strict_band
from linewarden.functions.text import array_rounded, as_double, parse_number, rounded

CELLS = ("true_negative", "false_positive", "false_negative", "true_positive")
#: Ranges into which the distinct scores are cut for running sums, about equally many in each.
RANGES = 256
SCORES = ("accuracy", "precision", "recall", "f1_score")


def ratio(part: Column, whole: Column) -> Column:
    """Quotient, zero when the denominator is zero."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def _total(condition: Column) -> Column:
    return F.coalesce(F.sum(condition.cast("long")), F.lit(0).cast("long"))


def metric_columns(tn: Column, fp: Column, fn: Column, tp: Column) -> list[Column]:
    """Accuracy, precision, recall and F1 (four decimals) followed by the four cells."""
    return [
        rounded(ratio(tp + tn, tp + tn + fp + fn), 4).alias("accuracy"),
        rounded(ratio(tp, tp + fp), 4).alias("precision"),
        rounded(ratio(tp, tp + fn), 4).alias("recall"),
        rounded(ratio(2 * tp, 2 * tp + fp + fn), 4).alias("f1_score"),
        tn.alias("true_negative"),
        fp.alias("false_positive"),
        fn.alias("false_negative"),
        tp.alias("true_positive"),
    ]


def confusion_metrics(
    df: DataFrame, prediction: str, label: str = "scrap", by: Sequence[str] = ()
) -> DataFrame:
    """Confusion cells and metrics of a hard 0/1 prediction, overall or per group."""
    hit, issue = F.col(prediction) == 1, F.col(label) == 1
    cells = df.groupBy(*by).agg(
        _total(~hit & ~issue).alias("tn"),
        _total(hit & ~issue).alias("fp"),
        _total(~hit & issue).alias("fn"),
        _total(hit & issue).alias("tp"),
    )
    return cells.select(
        *by, *metric_columns(F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp"))
    )


def threshold_sweep(
    df: DataFrame,
    probability: str = "scrap_probability",
    label: str = "scrap",
    thresholds: Sequence[float] = cfg.SWEEP,
    weight: str | None = None,
) -> DataFrame:
    """Metrics at every threshold from one scan.

    Two conditional sums per threshold in one aggregation without keys; negatives follow
    from the totals. `weight` sweeps a table that holds counts instead of single rows.
    """
    one = F.col(weight) if weight else F.lit(1).cast("long")
    issue, labelled = F.col(label) == 1, F.col(label).isNotNull()

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, one)), F.lit(0).cast("long"))

    sums = [total(labelled).alias("n"), total(issue).alias("pos")]
    for i, threshold in enumerate(thresholds):
        reached = known(F.col(probability)) >= threshold
        sums += [
            total(reached & labelled).alias(f"hit{i}"),
            total(reached & issue).alias(f"tp{i}"),
        ]
    rows = []
    for i, threshold in enumerate(thresholds):
        tp = F.col(f"tp{i}")
        fp = F.col(f"hit{i}") - tp
        fn = F.col("pos") - tp
        tn = F.col("n") - F.col("pos") - fp
        rows.append(
            F.struct(F.lit(threshold).alias("threshold"), *metric_columns(tn, fp, fn, tp))
        )
    return df.agg(*sums).select(F.inline(F.array(*rows)))


# --- everything below works on the few rows of a sweep ---------------------------------


def threshold_costs(
    sweep: DataFrame,
    missed_cost: float = cfg.MISSED_SCRAP_COST,
    alarm_cost: float = cfg.FALSE_ALARM_COST,
) -> DataFrame:
    missed = F.col("false_negative") * F.lit(missed_cost)
    alarms = F.col("false_positive") * F.lit(alarm_cost)
    return sweep.select(
        "*",
        array_rounded(missed, 2).alias("missed_scrap_cost"),
        array_rounded(alarms, 2).alias("false_alarm_cost"),
        array_rounded(missed + alarms, 2).alias("total_cost"),
    ).orderBy("total_cost", "threshold")


def _reaches_target() -> Column:
    return F.col("recall") >= cfg.RECALL_TARGET


def _selection_key() -> Column:
    """Sort key whose largest value marks the selected threshold."""
    tie = F.when(_reaches_target(), F.col("precision")).otherwise(F.col("recall"))
    return F.struct(_reaches_target(), "f1_score", tie, -F.col("threshold"))


def selected_threshold(sweep: DataFrame) -> DataFrame:
    """The threshold with the best F1 among those reaching the recall target, else overall."""
    reason = F.when(_reaches_target(), cfg.SELECTED_ON_TARGET).otherwise(
        cfg.SELECTED_OFF_TARGET
    )
    row = F.struct("threshold", *SCORES, *CELLS, reason.alias("selection_reason"))
    return sweep.agg(F.max_by(row, _selection_key()).alias("best")).select(
        F.col("best.threshold").alias("selected_threshold"),
        *[F.col(f"best.{c}") for c in (*SCORES, *CELLS)],
        "best.selection_reason",
    )


def cost_optimal_threshold(costs: DataFrame) -> DataFrame:
    return costs.orderBy("total_cost", "threshold").limit(1)


def threshold_tradeoff(costs: DataFrame, limit: int = 5) -> DataFrame:
    """The cheapest thresholds."""
    return (
        costs.orderBy("total_cost", "threshold")
        .limit(limit)
        .select("threshold", "recall", "false_positive", "false_negative", "total_cost")
    )


def _at(cut: float, name: str) -> Column:
    return F.max(F.when(F.abs(F.col("threshold") - cut) < 1e-9, F.col(name)))


def cost_summary(costs: DataFrame) -> DataFrame:
    """The cheapest threshold against the default and the recall-tuned one."""
    kept = (
        "threshold", "total_cost", "missed_scrap_cost", "false_alarm_cost", "false_negative",
        "false_positive", "recall", "precision", "f1_score",
    )
    order = F.struct("total_cost", "threshold")
    compared = ("total_cost", "false_negative", "false_positive", "recall")
    return costs.agg(
        F.min_by(F.struct(*kept), order).alias("best"),
        *[_at(cfg.DEFAULT_CUT, c).alias(f"default_{c}") for c in compared],
        *[_at(cfg.RECALL_TUNED_CUT, c).alias(f"recall_tuned_{c}") for c in compared],
    ).select(
        *[F.col(f"best.{c}").alias(f"best_{c}") for c in kept],
        *[f"default_{c}" for c in compared],
        *[f"recall_tuned_{c}" for c in compared],
        (F.col("default_total_cost") - F.col("best.total_cost")).alias("savings_vs_default"),
    )


def threshold_deltas(sweep: DataFrame) -> DataFrame:
    """What the selected threshold gains and costs against the default one."""
    kept = ("threshold", "recall", "false_negative", "false_positive")
    return sweep.agg(
        F.max_by(F.struct(*kept), _selection_key()).alias("best"),
        *[_at(cfg.DEFAULT_CUT, c).alias(f"default_{c}") for c in kept[1:]],
    ).select(
        F.lit(cfg.DEFAULT_CUT).alias("default_threshold"),
        F.col("best.threshold").alias("selected_threshold"),
        "default_recall",
        F.col("best.recall").alias("selected_recall"),
        rounded((F.col("best.recall") - F.col("default_recall")) * 100, 2).alias(
            "recall_gain_points"
        ),
        "default_false_negative",
        F.col("best.false_negative").alias("selected_false_negative"),
        (F.col("default_false_negative") - F.col("best.false_negative")).alias(
            "missed_scrap_reduction"
        ),
        "default_false_positive",
        F.col("best.false_positive").alias("selected_false_positive"),
        (F.col("best.false_positive") - F.col("default_false_positive")).alias(
            "additional_false_alarms"
        ),
    )


def stored_threshold(payload: DataFrame) -> DataFrame:
    """The threshold held by a stored one-row result, whichever of its known shapes it has.

    Looked for as `threshold`, `selected_threshold` and `cost_optimized_threshold.threshold`,
    in this order; values that are no numbers are passed over.
    """
    found = [as_double(payload, c) for c in ("threshold", "selected_threshold") if c in payload.columns]
    nested = "cost_optimized_threshold"
    if nested in payload.columns and isinstance(payload.schema[nested].dataType, T.StructType):
        inner = payload.select(f"{nested}.*")
        if "threshold" in inner.columns:
            text = F.col(f"{nested}.threshold").cast("string")
            found.append(parse_number(text))
    if not found:
        found = [F.lit(None).cast("double")]
    return payload.select(F.coalesce(*found).alias("threshold")).limit(1)


def review_threshold_choice(
    cost_optimal: DataFrame | None, selected: DataFrame | None, spark=None
) -> DataFrame:
    """One row: the cost-optimal threshold, else the selected one, else the fixed fallback.

    Each source is a one-row table (or None, or empty) and enters as a scalar subquery.
    """
    missing = F.lit(None).cast("double")
    first, second = (
        missing if source is None else stored_threshold(source).scalar()
        for source in (cost_optimal, selected)
    )
    source = cost_optimal if cost_optimal is not None else selected
    spark = spark or source.sparkSession
    return (
        spark.range(1)
        .select(first.alias("first"), second.alias("second"))
        .select(
            F.coalesce("first", "second", F.lit(cfg.FALLBACK_THRESHOLD)).alias(
                "review_threshold"
            ),
            F.when(F.col("first").isNotNull(), "cost_optimized_threshold")
            .when(F.col("second").isNotNull(), "selected_threshold")
            .otherwise("fallback_0_50")
            .alias("threshold_source"),
        )
    )


# --- calibration and ranking -------------------------------------------------------------


def risk_band_evaluation(
    df: DataFrame,
    probability: str = "scrap_probability",
    label: str = "scrap",
    bands=cfg.BANDS,
) -> DataFrame:
    """Outcome and mean prediction per calibration band; empty bands count zero."""
    per_band = (
        df.select(
            strict_band(F.col(probability), bands).alias("risk_band"), label, probability
        )
        .filter(F.col("risk_band").isNotNull())
        .groupBy("risk_band")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum(label).alias("scrap"),
            F.avg(label).alias("rate"),
            F.avg(probability).alias("risk"),
        )
    )
    every_band = df.sparkSession.createDataFrame(
        [(i, name, priority) for i, (name, _, _, priority) in enumerate(bands, start=1)],
        "band_order int, risk_band string, review_priority string",
    )
    zero = F.lit(0).cast("long")
    return (
        every_band.join(per_band, "risk_band", "left")
        .select(
            "band_order",
            "risk_band",
            F.coalesce("rows", zero).alias("row_count"),
            F.coalesce("scrap", zero).alias("actual_scrap_count"),
            F.coalesce(rounded(F.col("rate"), 4), F.lit(0.0)).alias("actual_scrap_rate"),
            F.coalesce(rounded(F.col("risk"), 4), F.lit(0.0)).alias("average_predicted_risk"),
            "review_priority",
        )
        .orderBy("band_order")
    )


def score_histogram(
    df: DataFrame, probability: str = "scrap_probability", label: str = "scrap"
) -> DataFrame:
    """Positives and negatives per distinct score: (score, pos, neg)."""
    issue = F.col(label) == 1
    return (
        df.filter(known(F.col(probability)).isNotNull() & F.col(label).isNotNull())
        .groupBy(known(F.col(probability)).alias("score"))
        .agg(_total(issue).alias("pos"), _total(~issue).alias("neg"))
    )


def score_ranges(histogram: DataFrame, ranges: int = RANGES) -> DataFrame:
    """The histogram with `range`, a number that falls with the score; about equally many rows in each range."""
    shares = [k / ranges for k in range(1, ranges)]
    bounds = sorted(set(histogram.approxQuantile("score", shares, 1 / (8 * ranges))))
    splits = [float("-inf"), *(b for b in bounds if abs(b) != float("inf")), float("inf")]
    if len(splits) < 3:
        return histogram.withColumn("range", F.lit(0).cast("double"))
    dealt = Bucketizer(splits=splits, inputCol="score", outputCol="range").transform(histogram)
    return dealt.withColumn("range", -F.col("range"))


def _running(histogram: DataFrame) -> DataFrame:
    """Histogram with the positives and negatives scored at least as high, for any number of scores.

    Bounds of about equally many distinct scores come from a quantile sketch, which tasks merge, so crowded scores
    spread over the ranges like any others. Each range is summed up within itself and shifted by the totals of the
    ranges above it, so no task sees more than its range. The bounds are at most RANGES numbers on the driver; what is
    broadcast is one row for each range. The range is a function of score and bounds alone, so both uses of it agree.
    """
    dealt = score_ranges(histogram)
    above = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        dealt.groupBy("range")
        .agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
        .select(
            "range",
            F.coalesce(F.sum("p").over(above), F.lit(0)).alias("pos_above"),
            F.coalesce(F.sum("n").over(above), F.lit(0)).alias("neg_above"),
        )
    )
    down = (
        Window.partitionBy("range")
        .orderBy(F.desc("score"))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return dealt.join(F.broadcast(shifts), "range").select(
        "pos",
        "neg",
        (F.sum("pos").over(down) + F.col("pos_above")).alias("tp"),
        (F.sum("neg").over(down) + F.col("neg_above")).alias("fp"),
    )


def ranking_metrics(histogram: DataFrame) -> DataFrame:
    """ROC-AUC and average precision of a score histogram, one row.

    ROC-AUC gives half credit to ties. Average precision is the sum of recall steps times
    precision, not the trapezoid under the precision-recall curve.
    """
    running = _running(histogram)
    before = F.col("tp") - F.col("pos")
    return running.agg(
        F.sum(F.col("neg") * (before + F.col("pos") / 2)).alias("area"),
        F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision_sum"),
        F.sum("pos").alias("pos"),
        F.sum("neg").alias("neg"),
    ).select(
        F.try_divide("area", F.col("pos").cast("double") * F.col("neg")).alias("roc_auc"),
        F.try_divide("precision_sum", F.col("pos").cast("double")).alias("average_precision"),
        ratio(F.col("pos"), F.col("pos") + F.col("neg")).alias("base_rate"),
    )


def evaluation_summary(
    df: DataFrame, probability: str = "scrap_probability", label: str = "scrap"
) -> DataFrame:
    """Ranking metrics, base rate and both chosen thresholds, all from one histogram."""
    histogram = score_histogram(df, probability, label)
    sides = histogram.select(
        "score",
        F.inline(
            F.array(
                F.struct(F.lit(1).alias("label"), F.col("pos").alias("rows")),
                F.struct(F.lit(0).alias("label"), F.col("neg").alias("rows")),
            )
        ),
    )
    sweep = threshold_sweep(sides, "score", "label", weight="rows")
    cheapest = cost_optimal_threshold(threshold_costs(sweep)).select("threshold")
    selected = selected_threshold(sweep).select("selected_threshold")
    return ranking_metrics(histogram).select(
        rounded(F.col("roc_auc"), 4).alias("roc_auc"),
        rounded(F.col("average_precision"), 4).alias("pr_auc"),
        rounded(F.col("base_rate"), 4).alias("baseline_scrap_rate"),
        selected.scalar().alias("selected_threshold"),
        cheapest.scalar().alias("cost_optimized_threshold"),
    )
