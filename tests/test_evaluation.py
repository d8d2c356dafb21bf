import random

import pytest
from pyspark.sql import functions as F

from linewarden.config import risk as cfg
from linewarden.functions import risk as scales
from linewarden.functions import text
from linewarden.operators import evaluation as ev
from linewarden.operators import summary

# True and false positives per threshold of a known test split.
TP = [88, 80, 66, 52, 43, 33, 26]
FP = [1080, 818, 525, 329, 225, 157, 102]
POSITIVES, NEGATIVES = 89, 1161


@pytest.fixture(scope="module")
def sweep(spark):
    """Counts between neighbouring thresholds, from which the known table must follow."""
    rows = []
    for label, reached, everyone in ((1, TP, POSITIVES), (0, FP, NEGATIVES)):
        steps = [everyone, *reached, 0]
        for i, threshold in enumerate([0.1, *cfg.SWEEP]):
            rows.append((threshold, label, steps[i] - steps[i + 1]))
    table = spark.createDataFrame(rows, "p double, y int, n long")
    return ev.threshold_sweep(table, "p", "y", weight="n").cache()


def test_sweep_table(sweep):
    row = {r.threshold: r for r in sweep.collect()}
    assert len(row) == 7
    assert (row[0.3].accuracy, row[0.3].precision, row[0.3].recall, row[0.3].f1_score) == (
        0.5616, 0.1117, 0.7416, 0.1941,
    )
    assert (row[0.5].true_negative, row[0.5].false_positive) == (1059, 102)
    assert (row[0.5].false_negative, row[0.5].true_positive) == (63, 26)
    recalls = [row[t].recall for t in cfg.SWEEP]
    assert recalls == sorted(recalls, reverse=True)


def test_threshold_choice(sweep, spark):
    selected = ev.selected_threshold(sweep)
    assert selected.first().selected_threshold == 0.3
    costs = ev.threshold_costs(sweep)
    assert [r.threshold for r in costs.collect()] == [0.4, 0.35, 0.45, 0.5, 0.3, 0.25, 0.2]
    cheapest = ev.cost_optimal_threshold(costs)
    assert (cheapest.first().threshold, cheapest.first().total_cost) == (0.4, 6850.0)
    total = ev.cost_summary(costs).first()
    assert (total.default_total_cost, total.recall_tuned_total_cost) == (7320.0, 7550.0)
    assert total.savings_vs_default == 470.0
    assert [r.threshold for r in ev.threshold_tradeoff(costs).collect()] == [0.4, 0.35, 0.45, 0.5, 0.3]
    delta = ev.threshold_deltas(sweep).first()
    assert (delta.missed_scrap_reduction, delta.additional_false_alarms) == (40, 423)
    assert delta.recall_gain_points == 44.95
    pick = lambda a, b: tuple(ev.review_threshold_choice(a, b, spark).first())
    assert pick(cheapest, selected) == (0.4, "cost_optimized_threshold")
    assert pick(cheapest.filter("false"), selected) == (0.3, "selected_threshold")
    assert pick(None, None) == (0.5, "fallback_0_50")


def test_stored_threshold_shapes(spark):
    shapes = {
        '{"threshold": "0.35"}': 0.35,
        '{"threshold": "none", "selected_threshold": 0.25}': 0.25,
        '{"cost_optimized_threshold": {"threshold": 0.45, "total_cost": 1}}': 0.45,
        '{"cost_optimized_threshold": 0.4}': None,
    }
    for text_, expected in shapes.items():
        schema = spark.range(1).select(F.schema_of_json(F.lit(text_))).first()[0]
        payload = spark.range(1).select(F.from_json(F.lit(text_), schema).alias("j")).select("j.*")
        assert ev.stored_threshold(payload).first().threshold == expected


def test_selection_without_target(sweep):
    low = sweep.withColumn("recall", F.col("recall") / 2)
    row = ev.selected_threshold(low).first()
    assert row.selected_threshold == 0.4  # best F1 overall
    assert row.selection_reason == cfg.SELECTED_OFF_TARGET


def test_metrics_without_positives(spark):
    table = spark.createDataFrame([(0.1, 0), (0.2, 0)], "scrap_probability double, scrap int")
    row = ev.threshold_sweep(table).first()
    assert (row.precision, row.recall, row.f1_score) == (0.0, 0.0, 0.0)
    ranked = ev.ranking_metrics(ev.score_histogram(table)).first()
    assert ranked.roc_auc is None and ranked.average_precision is None


def _brute_force(pairs):
    pos = [s for s, y in pairs if y]
    neg = [s for s, y in pairs if not y]
    auc = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    ap, before = 0.0, 0.0
    for cut in sorted({s for s, _ in pairs}, reverse=True):
        hit = [y for s, y in pairs if s >= cut]
        recall = sum(hit) / len(pos)
        ap += (recall - before) * sum(hit) / len(hit)
        before = recall
    return auc, ap


@pytest.mark.parametrize("digits, partitions", [(1, 4), (6, 7), (6, 1)])
def test_ranking_against_brute_force(spark, digits, partitions):
    rng = random.Random(7)
    pairs = [(round(rng.random(), digits), int(rng.random() < 0.3)) for _ in range(400)]
    pairs += [(0.5, 1)] * 130 + [(0.5, 0)] * 70  # one score holds a third of the rows
    table = spark.createDataFrame(pairs, "scrap_probability double, scrap int")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        row = ev.ranking_metrics(ev.score_histogram(table)).first()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    auc, ap = _brute_force(pairs)
    assert row.roc_auc == pytest.approx(auc, abs=1e-12)
    assert row.average_precision == pytest.approx(ap, abs=1e-12)


def test_bands_keep_empty_ones(spark):
    table = spark.createDataFrame(
        [(0.1, 0), (0.2, 1), (0.5, 1), (1.0, 1)], "scrap_probability double, scrap int"
    )
    rows = [tuple(r)[1:5] for r in ev.risk_band_evaluation(table).collect()]
    assert rows == [
        ("Low risk", 2, 1, 0.5), ("Medium risk", 0, 0, 0.0), ("High risk", 2, 2, 1.0),
    ]


def test_scales_at_their_edges(spark):
    values = [None, 0.0, 0.29999, 0.3, 0.5, 0.6, 0.7, 1.0, 1.5]
    df = spark.createDataFrame([(v,) for v in values], "p double")
    p = F.col("p")
    rows = df.select(
        scales.risk_level(p), scales.calibration_band(p), scales.strict_band(p),
        scales.export_flag(p, 0.5), scales.confidence(p),
    ).collect()
    assert [r[0] for r in rows] == [
        "Low", "Low", "Low", "Medium", "Medium", "High", "High", "High", "High",
    ]
    assert [r[1] for r in rows][-1] == "High risk" and rows[-1][2] is None
    assert rows[3][1] == "Medium risk" and rows[4][1] == "High risk"
    assert [r[3] for r in rows][:5] == ["Low", "Low", "Low", "Low", "High"]
    assert [r[4] for r in rows][:1] == ["Unknown"] and rows[6][4] == "High"


def test_temperature_bins(spark):
    df = spark.createDataFrame(
        [(v, 1) for v in (-1.0, 179.9, 180.0, 195.0, 1000.0, float("nan"))],
        "temperature_c double, scrap int",
    )
    rows = [(r.label, r.row_count, r.scrap_rate) for r in summary.scrap_rate_by_temperature(df).collect()]
    assert rows == [
        ("<180°C", 1, 100.0), ("180–185°C", 1, 100.0), ("185–190°C", 0, None),
        ("190–195°C", 0, None), (">195°C", 1, 100.0),
    ]


def test_export_falls_back_to_all_rows(batch):
    flagged = summary.export_predictions(batch, 0.4).collect()
    assert [r.part_id for r in flagged] == ["NB000001", "NB000005", "NB000010", "NB000008"]
    assert all(r.root_cause_summary.startswith("The batch shows high") for r in flagged)
    everyone = summary.export_predictions(batch, 0.99).collect()
    assert len(everyone) == 10 and {r.root_cause_summary for r in everyone} == {""}
    assert summary.sample_prediction(batch, 0.99).first().recommendations == cfg.NO_ACTION
    level = F.col("scrap_probability") > 0.9
    assert summary.filter_or_all(batch, level).count() == 10
    assert summary.filter_or_all(batch, F.col("scrap_probability") > 0.5).count() == 2


@pytest.mark.parametrize(
    "value, shown",
    [
        (196.2, "196.2"), (62.0, "62"), (0.0, "0"), (-3.5, "-3.5"), (123456.0, "123456"),
        (1234567.0, "1.23457e+06"), (0.00012345678, "0.000123457"), (1e-7, "1e-07"),
        (3.5714285714, "3.57143"), (100000.0, "100000"), (1e6, "1e+06"), (None, "nan"),
        (float("inf"), "inf"), (0.001, "0.001"), (199999.97, "200000"),
    ],
)
def test_general_number(spark, value, shown):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(text.general_number(F.col("x"))).first()[0] == shown


def test_lenient_numbers(spark):
    values = ["1", " 2.5 ", "1e3", "1d", "2F", "bad", "", None, "inf", "-Infinity", "nan", "+.5"]
    df = spark.createDataFrame([(v,) for v in values], "x string")
    found = [r[0] for r in df.select(text.parse_number(F.col("x"))).collect()]
    inf = float("inf")
    assert found == [1.0, 2.5, 1000.0, None, None, None, None, None, inf, -inf, None, 0.5]


def test_drivers_from_sentences(spark):
    sentences = {
        "It is mainly due to a, b, and c.": ["a", "b", "c"],
        "Mainly due to machine M2 and heat.": ["machine m2", "heat"],
        "Nothing found": ["Nothing found"],
        "  ": [],
    }
    df = spark.createDataFrame([(s,) for s in sentences], "s string")
    found = [r[0] for r in df.select(text.drivers_in_summary(F.col("s"))).collect()]
    assert found == list(sentences.values())
    assert df.filter("false").count() == 0


def values(spark, numbers, column):
    df = spark.createDataFrame([(n,) for n in numbers], "x double")
    return [r[0] for r in df.select(column(F.col("x"))).collect()]


def test_rounding(spark):
    """Four decimals of the stored value, exact ties to even: what Python's round gives."""
    numbers = [0.37875, 0.00625, 1 / 32, 3 / 32, -0.03125, 1e16, float("inf"), 0.5]
    found = values(spark, numbers, lambda x: text.rounded(x, 4))
    assert found == [round(n, 4) if n != float("inf") else n for n in numbers]
    assert found[2] == 0.0312
    assert values(spark, [None, float("nan")], lambda x: text.rounded(x, 4)) == [None, None]


def test_array_rounding(spark):
    """Scaled and rounded half to even, as array libraries do."""
    numbers = [1 / 32, 2.675, 0.125, 1e16, float("inf"), float("-inf"), -0.03125]
    found = values(spark, numbers, lambda x: text.array_rounded(x, 4))
    assert found == [0.0312, 2.675, 0.125, 1e16, float("inf"), float("-inf"), -0.0312]
    assert values(spark, [None, float("nan")], lambda x: text.array_rounded(x, 2)) == [None, None]


def test_number_texts(spark):
    """The stored value decides; an exact tie goes away from zero in a sentence and to even in a percentage."""
    numbers = [51.55, 50.25, 50.75, 2.675, 190.35, 50.15, -50.25, 0.04, 1e16, None]
    assert values(spark, numbers, lambda x: text.fixed_decimals(x, 1)) == [
        "51.5", "50.3", "50.8", "2.7", "190.3", "50.1", "-50.3", "0.0", "10000000000000000.0", None,
    ]
    assert values(spark, [2.675, 0.125, 0.375], lambda x: text.fixed_decimals(x, 2)) == ["2.67", "0.13", "0.38"]
    assert values(spark, [0.00125, 0.5], text.percent_text) == ["0.12%", "50.00%"]


def test_nan_is_never_risky(spark):
    df = spark.createDataFrame([(float("nan"), 1), (0.6, 1), (0.2, 0)], "scrap_probability double, scrap int")
    p = F.col("scrap_probability")
    flags = df.select(scales.risk_level(p), scales.export_flag(p, 0.3), scales.strict_band(p)).collect()
    assert tuple(flags[0]) == ("Low", "Low", None)
    decision = scales.review_decision(p, scales.risk_level(p), F.lit(0.4))
    reason = scales.decision_reason(p, scales.risk_level(p), F.lit(0.4))
    first = df.select(decision.alias("d"), reason.alias("r")).first()
    assert first.d == "STANDARD_MONITORING" and "threshold" not in first.r.lower().split("below")[0]
    swept = ev.threshold_sweep(df, thresholds=(0.1, 0.5)).collect()
    assert [(r.true_positive, r.false_negative) for r in swept] == [(1, 1), (1, 1)]
    ranked = ev.ranking_metrics(ev.score_histogram(df)).first()
    assert ranked.roc_auc == 1.0 and ranked.base_rate == 0.5


def test_blanks_and_hexadecimal_numbers(spark):
    cells = [" \t", "\u00a0", " 5.5\u2003", "0x1p3", "night\t", "inf", "1d"]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    found = df.select(text.is_missing(df, "c"), text.parse_number(F.col("c")), text.normalized_text(F.col("c"))).collect()
    assert [r[0] for r in found] == [True, True, False, False, False, False, False]
    assert [r[1] for r in found] == [None, None, 5.5, None, None, float("inf"), None]
    assert [r[2] for r in found][:2] == [None, None] and found[4][2] == "night"


def test_scorecard_defaults(spark):
    df = spark.createDataFrame(
        [("M2", "night", "B4", 200.0, 60.0, 3.7, 70.0, 20.0, None), ("M1", "early", "B1", 0.0, 0.0, 0.0, 0.0, 0.0, 1.0)],
        "machine_id string, shift string, material_batch string, temperature_c double, "
        "cycle_time_s double, vibration_mm_s double, humidity_percent double, "
        "operator_experience_years double, pressure_bar double",
    )
    found = [r[0] for r in df.select(scales.scorecard()).collect()]
    expected = -3.25 + 0.85 + 0.35 + 0.3 + 1.2 + 1.4 + 0.6 + 0.3 - 0.35
    assert found[0] == pytest.approx(expected) and found[1] == -3.25
    missing = df.withColumn("humidity_percent", F.lit(None).cast("double"))
    assert missing.select(scales.scorecard()).first()[0] is None


def test_crowded_scores_spread_over_the_ranges(spark):
    """Nine tenths of the scores lie below 0.002: no range has more than four times the mean."""
    draw = F.rand(5)
    table = spark.range(60_000).select(F.when(F.col("id") % 10 > 0, draw * draw * 0.002).otherwise(draw).alias("score"))
    histogram = table.groupBy("score").agg(F.sum(F.lit(1)).alias("pos"), F.sum(F.lit(0)).alias("neg")).cache()
    sizes = [r["count"] for r in ev.score_ranges(histogram).groupBy("range").count().collect()]
    assert len(sizes) > ev.RANGES / 2 and max(sizes) < 4 * sum(sizes) / len(sizes)
    order = ev.score_ranges(histogram).groupBy("range").agg(F.min("score").alias("a"), F.max("score").alias("b")).orderBy("range")
    rows = order.collect()
    assert all(high.a > low.b for high, low in zip(rows, rows[1:]))
