import json

import pytest
from pyspark.sql import functions as F

from linewarden.config import rules as texts
from linewarden.functions.rules import pack, packed_count, packed_text
from linewarden.operators import compliance, rootcause
from linewarden.plans.batch_review import require_scoring_batch, with_decision
from linewarden.plans.spec_compliance import spec_compliance
from linewarden.operators.validation import DataQualityError
from linewarden.sources.rulebook import ConfigError, load_cause_rules, load_limits
from linewarden.sources.tables import EmptyTableError

CLEAN = dict(
    part_id="C1", machine_id="M1", temperature_c=184.0, pressure_bar=5.8, cycle_time_s=46.0,
    shift="early", material_batch="B1", operator_experience_years=5.0, vibration_mm_s=2.2,
    humidity_percent=48.0,
)


def frame(spark, **changes):
    row = {**CLEAN, **changes}
    parts = []
    for name, value in row.items():
        kind = "double" if isinstance(CLEAN.get(name, value), float) else "string"
        literal = F.lit(value).cast("string" if isinstance(value, str) else kind)
        parts.append(literal.alias(name))
    return spark.range(1).select(*parts)


def analysis(spark, level=None, rules=None, **changes):
    df = frame(spark, **changes)
    return rootcause.with_root_causes(df, rules, None if level is None else F.lit(level)).first()


def test_clean_row(spark):
    row = analysis(spark)
    assert row.suspected_driver_count == 0
    assert row.root_cause_summary == "No configured root cause driver was detected for this batch."
    assert row.engineering_recommendations == texts.DEFAULT_RECOMMENDATION


@pytest.mark.parametrize(
    "change, driver",
    [
        ({"temperature_c": 195.0}, "Very high temperature"),
        ({"temperature_c": 190.0}, ""),
        ({"temperature_c": 174.9}, "Low temperature"),
        ({"pressure_bar": 5.1}, "Low pressure"),
        ({"machine_id": " machine 2 "}, "Machine M2 risk pattern"),
        ({"shift": "NIGHT"}, "Night shift production"),
        ({"temperature_c": None}, ""),
        ({"temperature_c": float("nan")}, ""),
        ({"temperature_c": "hot"}, ""),
        ({"temperature_c": "196"}, "Very high temperature"),
        ({"temperature_c": "196d"}, ""),
    ],
)
def test_single_rules(spark, change, driver):
    assert analysis(spark, **change).top_suspected_drivers.split("; ")[0] == driver


def test_fallback_only_when_high_and_clean(spark):
    high = analysis(spark, level="High")
    assert high.top_suspected_drivers == "Elevated predicted scrap risk"
    assert high.engineering_recommendations == texts.CAUSE_FALLBACK["recommendation"]
    assert analysis(spark, level="High", shift="late").suspected_driver_count == 1
    medium = analysis(spark, level="Medium")
    assert medium.root_cause_summary.startswith("The batch has medium predicted scrap risk, but")


def test_level_falls_back_to_probability(spark):
    assert "high scrap risk" in analysis(
        spark, level="odd", scrap_probability=0.6, shift="late"
    ).root_cause_summary
    assert "shows scrap risk" in analysis(spark, shift="late").root_cause_summary


def test_aliases_choose_by_presence(spark):
    df = spark.range(1).select(
        F.lit("hot").alias("Temperature"), F.lit(199.0).alias("temp_c"),
        F.lit(None).cast("double").alias("pressure_bar"), F.lit(7.0).alias("process_pressure"),
        F.lit("").alias("machine"), F.lit("M2").alias("Machine_ID"),
    )
    flags = rootcause.cause_flags(df)
    row = df.select(*[f.alias(n) for n, f in flags.items()]).first()
    assert not row.very_high_temperature  # an unreadable value does not fall through
    assert row.high_pressure  # a missing one does
    assert row.machine_m2_risk_pattern  # the configured name comes first


def test_driver_structs_match_texts(spark):
    df = frame(spark, temperature_c=196.0, shift="late", humidity_percent=61.0)
    drivers = df.select(rootcause.suspected_drivers(df).alias("d")).first().d
    assert [d.driver for d in drivers] == [
        "Very high temperature", "High temperature", "High humidity", "Late shift production",
    ]
    assert drivers[0].severity == "high" and drivers[0].evidence


def test_packed_texts_beyond_one_word(spark):
    values = [True, False, None, True, True, True, True, False, True]
    texts_ = ["a", "b", "c", "a", "d", "", "a", "e", "f"]
    df = spark.range(1).select(*[F.lit(v).cast("boolean").alias(f"f{i}") for i, v in enumerate(values)])
    words = pack([F.col(c) for c in df.columns])
    row = df.select(
        packed_count(words).alias("n"),
        packed_count(words, [True] + [False] * 7 + [True]).alias("some"),
        packed_text(words, texts_).alias("distinct"),
        packed_text(words, texts_, distinct=False).alias("every"),
    ).first()
    assert (row.n, row.some, row.distinct, row.every) == (6, 2, "a; d; f", "a; a; d; a; f")


def test_repeated_recommendation_shows_once(spark):
    config = {
        "rules": [
            {**r, "recommendation": "Look closer."} for r in texts.CAUSE_RULES
        ],
        "fallback": {},
    }
    row = analysis(
        spark, rules=load_cause_rules(config), temperature_c=196.0, humidity_percent=61.0
    )
    assert row.engineering_recommendations == "Look closer."
    assert row.suspected_driver_count == 3


@pytest.mark.parametrize(
    "op, missing_is_violation", [("<=", True), (">", True), ("==", True), ("!=", False)]
)
def test_missing_value_against_limit(spark, op, missing_is_violation):
    limits = load_limits(
        {"requirements": [{**texts.LIMITS[0], "operator": op}]}
    )
    for value in (None, float("nan")):
        row = compliance.with_compliance(frame(spark, temperature_c=value), limits).first()
        assert (row.violation_count == 1) == missing_is_violation
    if missing_is_violation:
        assert "temperature_c=nan does not satisfy" in row.violation_summary


def test_info_violation_stays_compliant(spark):
    limits = load_limits({"requirements": [{**texts.LIMITS[0], "severity": "Info", "value": 1}]})
    row = compliance.with_compliance(frame(spark), limits).first()
    assert (row.spec_compliance_status, row.violation_count) == ("COMPLIANT", 1)


def test_limit_texts_match_structs(batch):
    rows = compliance.with_compliance(batch).withColumn("v", compliance.violations(batch)).collect()
    for row in rows:
        assert "; ".join(v.requirement_id for v in row.v) == row.violated_requirement_ids
        assert len(row.v) == row.violation_count


@pytest.mark.parametrize(
    "change",
    [
        {"operator": "=>"}, {"operator": "=="}, {"value": "warm"}, {"severity": "critical"},
        {"type": "other"}, {"type": "categorical_match"},
    ],
)
def test_bad_rules_are_refused(change):
    with pytest.raises(ConfigError):
        load_cause_rules({"rules": [{**texts.CAUSE_RULES[0], **change}]})


@pytest.mark.parametrize(
    "change", [{"operator": "=>"}, {"value": None}, {"severity": "high"}, {"type": "x"}]
)
def test_bad_limits_are_refused(change):
    with pytest.raises(ConfigError):
        load_limits({"requirements": [{**texts.LIMITS[0], **change}]})
    with pytest.raises(ConfigError):
        load_limits({"requirements": [{"id": "X"}]})


def test_rules_from_file(tmp_path):
    path = tmp_path / "rules.json"
    path.write_text(json.dumps({"rules": texts.CAUSE_RULES[:2]}))
    assert [r.id for r in load_cause_rules(path).rules] == ["very_high_temperature", "high_temperature"]
    with pytest.raises(FileNotFoundError):
        load_limits(tmp_path / "none.yaml")


def test_scoring_gate(spark):
    with pytest.raises(DataQualityError):
        require_scoring_batch(frame(spark).drop("shift"))
    with pytest.raises(EmptyTableError):
        require_scoring_batch(frame(spark).filter("false"))
    with pytest.raises(DataQualityError, match="hot"):
        require_scoring_batch(frame(spark, temperature_c="hot"))
    assert require_scoring_batch(frame(spark)).count() == 1


def test_spec_gate(spark):
    with pytest.raises(DataQualityError):
        spec_compliance(frame(spark).drop("humidity_percent"))
    with pytest.raises(DataQualityError):
        spec_compliance(frame(spark, humidity_percent="wet"))


def test_high_level_is_reviewed_below_threshold(spark):
    row = with_decision(frame(spark, scrap_probability=0.65), 0.9).first()
    assert row.review_decision == "ENGINEERING_REVIEW_REQUIRED"
    assert row.decision_reason.startswith("High predicted risk")
