"""The registered queries once more, as SQL that DuckDB runs on the same tables.

Written from the definitions, not from the Spark code: limits, rules and scales are spelled
out as plain conditions. Only long fixed texts are taken from the configuration.
"""

from __future__ import annotations

from linewarden.config import risk as cfg
from linewarden.config import rules as texts

P = """
readings AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_linestatus, l_returnflag,
    concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
      CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
      CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)) AS part_id,
    'M' || CAST(l_suppkey % 4 + 1 AS VARCHAR) AS machine_id,
    172 + l_quantity * CAST(0.5 AS DOUBLE) AS temperature_c,
    round(CAST(4.9 AS DOUBLE) + l_discount * 20, 2) AS pressure_bar,
    round(40 + CAST(CAST(round(l_extendedprice * 100) AS BIGINT) % 1500 AS DOUBLE)
      / CAST(100 AS DOUBLE), 2) AS cycle_time_s,
    CASE l_returnflag WHEN 'A' THEN 'early' WHEN 'N' THEN 'late' ELSE 'night' END AS shift,
    'B' || CAST(l_partkey % 5 + 1 AS VARCHAR) AS material_batch,
    CAST(l_orderkey % 80 AS DOUBLE) / CAST(8 AS DOUBLE) AS operator_experience_years,
    round(CAST(1.5 AS DOUBLE) + l_tax * 25, 2) AS vibration_mm_s,
    CAST(35 + l_linenumber * 5 AS DOUBLE) AS humidity_percent
  FROM lineitem
),
scores AS (
  SELECT *,
    CAST(-1.25 AS DOUBLE)
      + CASE machine_id WHEN 'M2' THEN CAST(0.85 AS DOUBLE) WHEN 'M4' THEN CAST(0.25 AS DOUBLE)
        ELSE CAST(0 AS DOUBLE) END
      + CASE shift WHEN 'night' THEN CAST(0.35 AS DOUBLE) WHEN 'late' THEN CAST(0.12 AS DOUBLE)
        ELSE CAST(0 AS DOUBLE) END
      + CASE material_batch WHEN 'B4' THEN CAST(0.3 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
      + least(greatest((temperature_c - 190) * CAST(0.12 AS DOUBLE), 0), CAST(1.2 AS DOUBLE))
      + least(greatest((cycle_time_s - 50) * CAST(0.14 AS DOUBLE), 0), CAST(1.4 AS DOUBLE))
      + least(greatest((vibration_mm_s - CAST(2.7 AS DOUBLE)) * CAST(0.6 AS DOUBLE), 0),
        CAST(1.5 AS DOUBLE))
      + least(greatest((humidity_percent - 60) * CAST(0.03 AS DOUBLE), 0), CAST(0.6 AS DOUBLE))
      - least(greatest(operator_experience_years * CAST(0.035 AS DOUBLE), 0),
        CAST(0.35 AS DOUBLE)) AS risk_score
  FROM readings
),
p AS (
  SELECT part_id, machine_id, temperature_c, pressure_bar, cycle_time_s, shift, material_batch,
    operator_experience_years, vibration_mm_s, humidity_percent,
    CASE WHEN CAST((l_orderkey * 7919 + l_partkey * 104729 + l_linenumber * 31) % 10007 AS DOUBLE)
        / CAST(10007 AS DOUBLE) < 1 / (1 + exp(-risk_score)) THEN 1 ELSE 0 END AS scrap,
    risk_score,
    round(1 / (1 + exp(-risk_score)), 4) AS scrap_probability,
    (l_linestatus = 'F' OR l_returnflag <> 'N') AS has_feedback
  FROM scores
)"""

COLUMNS = """part_id, machine_id, temperature_c, pressure_bar, cycle_time_s, shift,
  material_batch, operator_experience_years, vibration_mm_s, humidity_percent, scrap"""
LEVEL = """CASE WHEN scrap_probability >= 0.6 THEN 'High'
  WHEN scrap_probability >= 0.3 THEN 'Medium' ELSE 'Low' END"""

REVIEW = (
    P
    + f""",
decided AS (
  SELECT {COLUMNS}, scrap_probability, risk_level, CAST(0.4 AS DOUBLE) AS review_threshold,
    CASE WHEN scrap_probability >= 0.4 OR risk_level = 'High' THEN 'ENGINEERING_REVIEW_REQUIRED'
      WHEN risk_level = 'Medium' THEN 'ADDITIONAL_MONITORING'
      ELSE 'STANDARD_MONITORING' END AS review_decision,
    CASE WHEN scrap_probability >= 0.4 THEN '{cfg.REASON_THRESHOLD}'
      WHEN risk_level = 'High' THEN '{cfg.REASON_HIGH}'
      WHEN risk_level = 'Medium' THEN '{cfg.REASON_MEDIUM}'
      ELSE '{cfg.REASON_LOW}' END AS decision_reason
  FROM (SELECT *, {LEVEL} AS risk_level FROM p)
)"""
)

# Rules in reporting order: severity first.
FIRES = {
    "very_high_temperature": "temperature_c >= 195",
    "high_vibration": "vibration_mm_s >= 3.1",
    "abnormal_cycle_time": "cycle_time_s >= 53",
    "high_temperature": "temperature_c > 190",
    "low_temperature": "temperature_c < 175",
    "high_pressure": "pressure_bar >= 6.4",
    "low_pressure": "pressure_bar <= 5.1",
    "elevated_vibration": "vibration_mm_s > 2.7",
    "long_cycle_time": "cycle_time_s > 50",
    "low_operator_experience": "operator_experience_years < 2",
    "machine_m2_risk_pattern": "machine_id = 'M2'",
    "night_shift_production": "shift = 'night'",
    "material_batch_b4": "material_batch = 'B4'",
    "high_humidity": "humidity_percent > 60",
    "machine_m4_risk_pattern": "machine_id = 'M4'",
    "late_shift_production": "shift = 'late'",
}
_RULE = {rule["id"]: rule for rule in texts.CAUSE_RULES}


def _fired(field: str, fires: dict[str, str] = FIRES) -> str:
    cases = ", ".join(
        f"CASE WHEN {condition} THEN '{_RULE[rule][field]}' END"
        for rule, condition in fires.items()
    )
    return f"list_filter([{cases}], lambda x: x IS NOT NULL)"


def causes(source: str, level: str, fires: dict[str, str] = FIRES) -> str:
    """CTE `caused`: `source` with drivers, advice and summary for a lower-case level."""
    fallback = texts.CAUSE_FALLBACK
    return f"""
fired AS (
  SELECT *, {level} AS lvl, {_fired('driver', fires)} AS d0,
    {_fired('recommendation', fires)} AS r0, {_fired('severity', fires)} AS s0
  FROM {source}
),
listed AS (
  SELECT *, CASE WHEN len(d0) = 0 AND lvl = 'high' THEN ['{fallback["driver"]}'] ELSE d0 END AS d,
    CASE WHEN len(d0) = 0 AND lvl = 'high' THEN ['{fallback["recommendation"]}']
      ELSE r0 END AS r,
    CASE WHEN len(d0) = 0 AND lvl = 'high' THEN ['{fallback["severity"]}'] ELSE s0 END AS s
  FROM fired
),
caused AS (
  SELECT *, CAST(len(d) AS INTEGER) AS suspected_driver_count,
    array_to_string(d[1:3], '; ') AS top_suspected_drivers,
    CASE WHEN len(r) = 0 THEN '{texts.DEFAULT_RECOMMENDATION}'
      ELSE array_to_string(r, '; ') END AS engineering_recommendations,
    CASE WHEN len(d) = 0 AND lvl IN ('low', 'unknown')
        THEN 'No configured root cause driver was detected for this batch.'
      WHEN len(d) = 0 THEN 'The batch has ' || lvl ||
        ' predicted scrap risk, but no configured process driver was detected.'
      ELSE 'The batch shows ' || CASE WHEN lvl = 'unknown' THEN '' ELSE lvl || ' ' END ||
        'scrap risk mainly due to ' || CASE len(d)
          WHEN 1 THEN lower(d[1])
          WHEN 2 THEN lower(d[1]) || ' and ' || lower(d[2])
          ELSE lower(d[1]) || ', ' || lower(d[2]) || ', and ' || lower(d[3]) END || '.'
    END AS root_cause_summary
  FROM listed
)"""


REVIEWED = REVIEW + "," + causes("decided", "lower(risk_level)")
REVIEW_OUT = f"""{COLUMNS}, scrap_probability, risk_level, review_threshold, review_decision,
  decision_reason, root_cause_summary, suspected_driver_count, top_suspected_drivers,
  engineering_recommendations"""
BY_PROBABILITY = """CASE WHEN scrap_probability >= 0.6 THEN 'high'
  WHEN scrap_probability >= 0.3 THEN 'medium' ELSE 'low' END"""
CAUSED = P + "," + causes("p", BY_PROBABILITY)
RESULTS = (
    P
    + ",\nflagged AS (SELECT *, CASE WHEN scrap_probability >= 0.3 THEN 'High' ELSE 'Low' END"
    + " AS predicted_scrap_risk FROM p),"
    + causes("flagged", "lower(predicted_scrap_risk)")
    + f""",
results AS (
  SELECT {COLUMNS}, scrap_probability, predicted_scrap_risk,
    CASE WHEN scrap_probability >= 0.3 THEN root_cause_summary ELSE '' END AS root_cause_summary,
    CASE WHEN scrap_probability >= 0.3 THEN engineering_recommendations ELSE '' END
      AS engineering_recommendations
  FROM caused
)"""
)

# Violated limits in configuration order: id, parameter, operator, limit, severity, condition.
LIMITS = [
    ("TEMP_MAX_WARNING", "temperature_c", "<=", "190", "warning"),
    ("TEMP_MAX_CRITICAL", "temperature_c", "<=", "195", "critical"),
    ("VIBRATION_MAX_WARNING", "vibration_mm_s", "<=", "2.7", "warning"),
    ("VIBRATION_MAX_CRITICAL", "vibration_mm_s", "<=", "3.1", "critical"),
    ("CYCLE_TIME_MAX_WARNING", "cycle_time_s", "<=", "50", "warning"),
    ("CYCLE_TIME_MAX_CRITICAL", "cycle_time_s", "<=", "53", "critical"),
    ("PRESSURE_MIN_WARNING", "pressure_bar", ">=", "5.1", "warning"),
    ("PRESSURE_MAX_WARNING", "pressure_bar", "<=", "6.4", "warning"),
    ("HUMIDITY_MAX_WARNING", "humidity_percent", "<=", "60", "warning"),
    ("LOW_OPERATOR_EXPERIENCE_WARNING", "operator_experience_years", ">=", "2", "warning"),
]
_ACTION = {limit["id"]: limit["recommended_action"] for limit in texts.LIMITS}
LABELS = """labels_dim(requirement_id, label, signal, signal_label, severity_label, signal_unit) AS (VALUES
  ('TEMP_MAX_WARNING', 'Temperature warning', 'temperature_c', 'Temperature', 'Warning', 'C'),
  ('TEMP_MAX_CRITICAL', 'Temperature critical', 'temperature_c', 'Temperature', 'Critical', 'C'),
  ('VIBRATION_MAX_WARNING', 'Vibration warning', 'vibration_mm_s', 'Vibration', 'Warning', 'mm/s'),
  ('VIBRATION_MAX_CRITICAL', 'Vibration critical', 'vibration_mm_s', 'Vibration', 'Critical', 'mm/s'),
  ('CYCLE_TIME_MAX_WARNING', 'Cycle-time warning', 'cycle_time_s', 'Cycle time', 'Warning', 's'),
  ('CYCLE_TIME_MAX_CRITICAL', 'Cycle-time critical', 'cycle_time_s', 'Cycle time', 'Critical', 's'),
  ('PRESSURE_MIN_WARNING', 'Low pressure warning', 'pressure_bar', 'Pressure', 'Warning', 'bar'),
  ('PRESSURE_MAX_WARNING', 'High pressure warning', 'pressure_bar', 'Pressure', 'Warning', 'bar'),
  ('HUMIDITY_MAX_WARNING', 'Humidity warning', 'humidity_percent', 'Humidity', 'Warning', '%'),
  ('LOW_OPERATOR_EXPERIENCE_WARNING', 'Operator support warning',
    'operator_experience_years', 'Operator experience', 'Warning', 'years'))"""


def _broken(column: str, op: str, limit: str) -> str:
    return f"NOT coalesce({column} {op} {limit}, false)"


def _violations(source: str) -> str:
    """CTE `v`: one row per part and violated limit, in configuration order."""
    parts = " UNION ALL ".join(
        f"SELECT part_id, {i} AS pos, '{lid}' AS requirement_id, '{column}' AS parameter, "
        f"{column} AS actual_value, '{op}' AS operator, CAST({limit} AS DOUBLE) AS limit_value, "
        f"'{severity}' AS severity, '{_ACTION[lid]}' AS action "
        f"FROM {source} WHERE {_broken(column, op, limit)}"
        for i, (lid, column, op, limit, severity) in enumerate(LIMITS)
    )
    return f"v AS ({parts})"


def _checked(source: str) -> str:
    return (
        _violations(source)
        + f""",
per_part AS (
  SELECT part_id, count(*) AS n, count(*) FILTER (severity = 'critical') AS c,
    count(*) FILTER (severity = 'warning') AS w,
    string_agg(requirement_id, '; ' ORDER BY pos) AS ids,
    string_agg(action, '; ' ORDER BY pos) AS actions,
    string_agg(requirement_id || ': ' || parameter || '=' ||
      coalesce(format('{{:g}}', actual_value), 'nan') || ' does not satisfy ' || operator || ' '
      || format('{{:g}}', limit_value), '; ' ORDER BY pos) AS sentence
  FROM v GROUP BY part_id
),
checked AS (
  SELECT s.*, CASE WHEN c > 0 THEN 'CRITICAL_VIOLATION' WHEN w > 0 THEN 'WARNING_VIOLATION'
      ELSE 'COMPLIANT' END AS spec_compliance_status,
    CAST(coalesce(n, 0) AS INTEGER) AS violation_count,
    CAST(coalesce(c, 0) AS INTEGER) AS critical_violation_count,
    CAST(coalesce(w, 0) AS INTEGER) AS warning_violation_count,
    coalesce(ids, '') AS violated_requirement_ids,
    coalesce(sentence, '') AS violation_summary,
    coalesce(actions, '') AS recommended_actions
  FROM {source} s LEFT JOIN per_part USING (part_id)
)"""
    )


CHECKED = P + ", " + _checked("p")
SPEC_OUT = """spec_compliance_status, violation_count, critical_violation_count,
  warning_violation_count, violated_requirement_ids, violation_summary, recommended_actions"""

#: The blanks that occur in the raw fixture.
BLANKS = "' ' || chr(9) || chr(160)"
RAW = (
    P
    + """,
raw AS (
  SELECT part_id,
    CASE WHEN l_partkey % 211 = 0 THEN 'M9' ELSE machine_id END AS machine_id,
    CASE WHEN l_orderkey % 89 = 0 THEN '  ' WHEN l_orderkey % 83 = 0 THEN chr(9)
      WHEN l_orderkey % 79 = 0 THEN chr(160) WHEN l_orderkey % 97 = 0 THEN NULL
      WHEN l_orderkey % 101 = 0 THEN 'bad' WHEN l_orderkey % 103 = 0 THEN '250.0'
      ELSE CAST(temperature_c AS VARCHAR) END AS temperature_c,
    CAST(pressure_bar AS VARCHAR) AS pressure_bar, CAST(cycle_time_s AS VARCHAR) AS cycle_time_s,
    shift, material_batch,
    CAST(operator_experience_years AS VARCHAR) AS operator_experience_years,
    CAST(vibration_mm_s AS VARCHAR) AS vibration_mm_s,
    CAST(humidity_percent AS VARCHAR) AS humidity_percent,
    CASE WHEN l_orderkey % 499 = 0 THEN '2' ELSE CAST(l_linenumber % 2 AS VARCHAR) END AS scrap
  FROM readings
)"""
)
ALL_COLUMNS = [
    "part_id", "machine_id", "temperature_c", "pressure_bar", "cycle_time_s", "shift",
    "material_batch", "operator_experience_years", "vibration_mm_s", "humidity_percent", "scrap",
]
RANGES = {
    "temperature_c": (160, 210), "pressure_bar": (4.0, 7.5), "cycle_time_s": (30, 70),
    "operator_experience_years": (0, 20), "vibration_mm_s": (0, 6), "humidity_percent": (0, 100),
}
NUMERIC = list(RANGES)


def _blank(column: str) -> str:
    return f"({column} IS NULL OR trim({column}, {BLANKS}) = '')"


def _unreadable(column: str) -> str:
    return f"(NOT {_blank(column)} AND TRY_CAST(trim({column}, {BLANKS}) AS DOUBLE) IS NULL)"


def _union(parts) -> str:
    return " UNION ALL ".join(parts)


MISSING = _union(
    f"SELECT '{c}' AS column_name, count(*) FILTER ({_blank(c)}) AS missing_count, "
    f"count(*) AS n FROM raw"
    for c in ALL_COLUMNS
)
INVALID = _union(
    f"SELECT '{c}' AS column_name, count(*) FILTER ({_unreadable(c)}) AS invalid_count FROM raw"
    for c in NUMERIC
)
OUTSIDE = _union(
    f"SELECT '{c}' AS column_name, CAST({low} AS DOUBLE) AS minimum, "
    f"CAST({high} AS DOUBLE) AS maximum, "
    f"count(*) FILTER (TRY_CAST(trim({c}, {BLANKS}) AS DOUBLE) < {low}) AS below_range_count, "
    f"count(*) FILTER (TRY_CAST(trim({c}, {BLANKS}) AS DOUBLE) > {high}) AS above_range_count FROM raw"
    for c, (low, high) in RANGES.items()
)
STRANGE = """
  SELECT 'machine_id' AS column_name, machine_id AS value, count(*) AS row_count FROM raw
    WHERE machine_id NOT IN ('M1', 'M2', 'M3', 'M4') GROUP BY 2
  UNION ALL SELECT 'shift', shift, count(*) FROM raw
    WHERE shift NOT IN ('early', 'late', 'night') GROUP BY 2
  UNION ALL SELECT 'material_batch', material_batch, count(*) FROM raw
    WHERE material_batch NOT IN ('B1', 'B2', 'B3', 'B4', 'B5') GROUP BY 2"""
TARGET = """
  SELECT count(*) AS total_rows, count(*) FILTER (scrap = '0') AS good_count,
    count(*) FILTER (scrap = '1') AS scrap_count,
    exact_round(count(*) FILTER (scrap = '1') / CAST(count(*) AS DOUBLE), 4) AS scrap_rate,
    count(*) FILTER (scrap NOT IN ('0', '1')) AS invalid_target FROM raw"""
DUPLICATES = """repeated AS (
  SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
    CAST(l_partkey AS VARCHAR)) AS part_id, count(*) AS row_count
  FROM lineitem GROUP BY 1 HAVING count(*) > 1)"""

REPORT = f"""report AS (
  SELECT 1 AS check_order, 'schema_validation' AS check_name, 'PASS' AS status, '' AS affected
  UNION ALL SELECT 2, 'unexpected_columns', 'PASS', ''
  UNION ALL SELECT 3, 'empty_dataset', CASE WHEN count(*) = 0 THEN 'FAIL' ELSE 'PASS' END, ''
    FROM raw
  UNION ALL SELECT 4, 'missing_values', CASE WHEN max(missing_count / CAST(n AS DOUBLE)) > 0.05
      THEN 'FAIL' WHEN max(missing_count) > 0 THEN 'WARNING' ELSE 'PASS' END,
    coalesce(string_agg(column_name, '; ' ORDER BY pos) FILTER (missing_count > 0), '')
    FROM (SELECT *, list_position({ALL_COLUMNS}, column_name) AS pos FROM ({MISSING}))
  UNION ALL SELECT 5, 'numeric_type_validation',
    CASE WHEN max(invalid_count) > 0 THEN 'FAIL' ELSE 'PASS' END,
    coalesce(string_agg(column_name, '; ' ORDER BY list_position({NUMERIC}, column_name))
      FILTER (invalid_count > 0), '')
    FROM ({INVALID})
  UNION ALL SELECT 6, 'target_validation', CASE WHEN invalid_target > 0 THEN 'FAIL'
      WHEN scrap_count / CAST(total_rows AS DOUBLE) NOT BETWEEN 0.03 AND 0.25 THEN 'WARNING'
      ELSE 'PASS' END,
    CASE WHEN invalid_target > 0 THEN 'scrap' ELSE '' END FROM ({TARGET})
  UNION ALL SELECT 7, 'categorical_validation',
    CASE WHEN count(*) > 0 THEN 'WARNING' ELSE 'PASS' END,
    coalesce(string_agg(DISTINCT column_name, '; '), '') FROM ({STRANGE})
  UNION ALL SELECT 8, 'engineering_plausibility',
    CASE WHEN sum(below_range_count + above_range_count) > 0 THEN 'WARNING' ELSE 'PASS' END,
    coalesce(string_agg(column_name, '; ' ORDER BY list_position({NUMERIC}, column_name))
      FILTER (below_range_count + above_range_count > 0), '')
    FROM ({OUTSIDE})
  UNION ALL SELECT 9, 'duplicate_part_id', CASE WHEN count(*) > 0 THEN 'WARNING' ELSE 'PASS' END,
    CASE WHEN count(*) > 0 THEN 'part_id' ELSE '' END
    FROM (SELECT part_id FROM raw GROUP BY 1 HAVING count(*) > 1)
)"""
OVERALL = """(SELECT CASE max(CASE status WHEN 'FAIL' THEN 2 WHEN 'WARNING' THEN 1 ELSE 0 END)
  WHEN 2 THEN 'FAIL' WHEN 1 THEN 'WARNING' ELSE 'PASS' END FROM report)"""

SWEEP = (
    P
    + """,
cells AS (
  SELECT threshold,
    count(*) FILTER (scrap_probability < threshold AND scrap = 0) AS true_negative,
    count(*) FILTER (scrap_probability >= threshold AND scrap = 0) AS false_positive,
    count(*) FILTER (scrap_probability < threshold AND scrap = 1) AS false_negative,
    count(*) FILTER (scrap_probability >= threshold AND scrap = 1) AS true_positive
  FROM p CROSS JOIN (SELECT CAST(unnest([0.20, 0.25, 0.30, 0.35, 0.40, 0.45, 0.50]) AS DOUBLE)
    AS threshold)
  GROUP BY threshold
),
sweep AS (
  SELECT threshold,
    exact_round((true_positive + true_negative) / CAST(true_positive + true_negative + false_positive
      + false_negative AS DOUBLE), 4) AS accuracy,
    exact_round(coalesce(true_positive / nullif(CAST(true_positive + false_positive AS DOUBLE), 0), 0),
      4) AS precision,
    exact_round(coalesce(true_positive / nullif(CAST(true_positive + false_negative AS DOUBLE), 0), 0),
      4) AS recall,
    exact_round(coalesce(2 * true_positive / nullif(CAST(2 * true_positive + false_positive
      + false_negative AS DOUBLE), 0), 0), 4) AS f1_score,
    true_negative, false_positive, false_negative, true_positive
  FROM cells
),
costs AS (
  SELECT *, false_negative * CAST(100 AS DOUBLE) AS missed_scrap_cost,
    false_positive * CAST(10 AS DOUBLE) AS false_alarm_cost,
    false_negative * CAST(100 AS DOUBLE) + false_positive * CAST(10 AS DOUBLE) AS total_cost
  FROM sweep
),
selected AS (
  SELECT * FROM sweep ORDER BY (recall >= 0.6) DESC, f1_score DESC,
    CASE WHEN recall >= 0.6 THEN precision ELSE recall END DESC, threshold LIMIT 1
),
cheapest AS (SELECT * FROM costs ORDER BY total_cost, threshold LIMIT 1),
standard AS (SELECT * FROM costs WHERE threshold = 0.5),
tuned AS (SELECT * FROM costs WHERE threshold = 0.3)"""
)


def ranking(source: str, score: str) -> str:
    """CTE `ranks`: ROC-AUC and average precision from a score histogram."""
    return f"""
hist AS (SELECT {score} AS score, count(*) FILTER (scrap = 1) AS pos,
  count(*) FILTER (scrap = 0) AS neg FROM {source} GROUP BY 1),
running AS (SELECT *, CAST(sum(pos) OVER (ORDER BY score DESC) AS DOUBLE) AS tp,
  CAST(sum(neg) OVER (ORDER BY score DESC) AS DOUBLE) AS fp FROM hist),
ranks AS (SELECT sum(neg * (tp - pos + pos / CAST(2 AS DOUBLE)))
    / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS roc_auc,
  sum(pos * tp / (tp + fp)) / CAST(sum(pos) AS DOUBLE) AS average_precision,
  sum(pos) / CAST(sum(pos) + sum(neg) AS DOUBLE) AS base_rate FROM running)"""


FEEDBACK = """
feedback AS (
  SELECT part_id, scrap AS actual_scrap,
    CASE WHEN scrap = 1 THEN 'confirmed_issue' ELSE 'no_issue' END AS engineer_review_outcome,
    'synthetic feedback' AS review_notes
  FROM p WHERE has_feedback
  UNION ALL SELECT 'X-' || CAST(o_orderkey AS VARCHAR), 0, 'no_issue', 'synthetic feedback'
  FROM orders WHERE o_orderstatus = 'P'
)"""
_OUTCOME = """CASE WHEN review_decision = 'ENGINEERING_REVIEW_REQUIRED' AND actual_scrap = 1
    THEN 'TRUE_POSITIVE_REVIEW'
  WHEN review_decision = 'ENGINEERING_REVIEW_REQUIRED' THEN 'FALSE_ALARM_REVIEW'
  WHEN actual_scrap = 1 THEN 'MISSED_ISSUE' ELSE 'TRUE_NEGATIVE_MONITORING' END"""
_PRIORITY = """CASE feedback_classification WHEN 'MISSED_ISSUE' THEN 'highest'
  WHEN 'TRUE_POSITIVE_REVIEW' THEN 'high' WHEN 'FALSE_ALARM_REVIEW' THEN 'medium'
  ELSE 'low' END"""
_READING = (
    "CASE feedback_classification "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in cfg.FEEDBACK_READING.items())
    + " END"
)
CASES = f""",{FEEDBACK},
cases AS (
  SELECT *, {_PRIORITY} AS feedback_priority, {_READING} AS feedback_interpretation
  FROM (SELECT caused.*, actual_scrap, engineer_review_outcome, review_notes,
      {_OUTCOME} AS feedback_classification
    FROM caused JOIN feedback USING (part_id))
)"""
CASE = REVIEWED + CASES
TRACED = (
    CASE
    + ", "
    + _checked("p")
    + f""",
traced AS (
  SELECT r.*, {SPEC_OUT}, k.actual_scrap, k.engineer_review_outcome, k.feedback_classification,
    k.feedback_priority, k.feedback_interpretation, k.review_notes,
    'This record was selected as a traceable engineering review example because ' ||
    CASE WHEN r.review_decision = 'ENGINEERING_REVIEW_REQUIRED'
      THEN 'the model routed it for engineering review with '
      ELSE 'the model routed it to ' || replace(lower(r.review_decision), '_', ' ') || ' with '
    END || r.risk_level || ' predicted risk, ' ||
    CASE WHEN r.top_suspected_drivers = ''
      THEN 'RCA did not identify configured suspected drivers'
      ELSE 'RCA highlighted ' || r.top_suspected_drivers END ||
    ', specification checks reported ' || replace(lower(spec_compliance_status), '_', ' ') ||
    ', ' || coalesce('later feedback classified the case as ' ||
      replace(lower(k.feedback_classification), '_', ' '), 'later feedback is not available')
    || '.' AS trace_summary
  FROM caused r LEFT JOIN (SELECT part_id, {SPEC_OUT} FROM checked) USING (part_id)
  LEFT JOIN cases k USING (part_id)
)"""
)


def _count_by(source: str, column: str) -> str:
    return f"SELECT {column}, count(*) AS row_count FROM {source} GROUP BY 1"


def _flags(source: str, fires: dict[str, str] = FIRES) -> str:
    flags = ", ".join(
        f"CASE WHEN {condition} THEN 1 ELSE 0 END AS {rule}" for rule, condition in fires.items()
    )
    return f"SELECT part_id, {flags} FROM {source}"


def _entries(source: str, column: str, name: str, separator: str = ";") -> str:
    return (
        f"SELECT trim(x) AS {name}, count(*) AS row_count FROM (SELECT "
        f"unnest(string_split({column}, '{separator}')) AS x FROM {source}) "
        f"WHERE trim(x) <> '' GROUP BY 1"
    )


# Drivers named in a summary sentence: what follows the marker, at commas and "and".
_NAMED = """CASE WHEN strpos(root_cause_summary, 'mainly due to ') > 0 THEN
  replace(replace(rtrim(split_part(root_cause_summary, 'mainly due to ', 2), '.'),
    ', and ', ', '), ' and ', ', ') ELSE root_cause_summary END"""
_TITLE = """array_to_string(list_transform(string_split({0}, ' '),
  lambda w: upper(w[1]) || lower(w[2:])), ' ')"""
_NAMED_COUNTS = (
    "named AS (SELECT CASE WHEN strpos(root_cause_summary, 'mainly due to ') > 0 THEN "
    f"lower({_NAMED}) ELSE {_NAMED} END AS names FROM results "
    "WHERE trim(root_cause_summary) <> ''), "
    f"named_counts AS ({_entries('named', 'names', 'driver', ',')})"
)

_TOP = "ORDER BY scrap_probability DESC, part_id"
_EXPORT_OUT = """part_id, machine_id, shift, material_batch, temperature_c, pressure_bar,
  cycle_time_s, operator_experience_years, vibration_mm_s, humidity_percent, scrap,
  scrap_probability, predicted_scrap_risk, root_cause_summary, engineering_recommendations"""
_BIN = """CASE WHEN temperature_c >= 0 AND temperature_c < 180 THEN '<180°C'
  WHEN temperature_c >= 180 AND temperature_c < 185 THEN '180–185°C'
  WHEN temperature_c >= 185 AND temperature_c < 190 THEN '185–190°C'
  WHEN temperature_c >= 190 AND temperature_c < 195 THEN '190–195°C'
  WHEN temperature_c >= 195 AND temperature_c < 1000 THEN '>195°C' END"""
_SIGNS = """CAST(temperature_c > 190 AS INTEGER) + CAST(cycle_time_s > 50 AS INTEGER)
  + CAST(vibration_mm_s > 2.7 AS INTEGER) + CAST(machine_id = 'M2' AS INTEGER)
  + CAST(shift = 'night' AS INTEGER)"""


def _rates(column: str) -> str:
    return (
        f"SELECT {column} AS label, exact_round(avg(scrap) * 100, 2) AS scrap_rate FROM p GROUP BY 1"
    )


def _fixed(column: str, digits: int) -> str:
    """Digits of the stored value; an exact tie, which is an odd multiple of a power of two, goes up."""
    return (
        f"CASE WHEN abs({column}) * {2 ** (digits + 1)} % 2 = 1"
        f" THEN CAST(CAST({column} AS DECIMAL(38, {digits})) AS VARCHAR)"
        f" ELSE printf('%.{digits}f', {column}) END"
    )


_EVIDENCE = f"""coalesce(nullif(concat_ws(' ',
  CASE WHEN temperature_c > 190 THEN 'Temperature ' || {_fixed('temperature_c', 1)}
    || ' C exceeds the 190 C monitoring band.' END,
  CASE WHEN pressure_bar >= 6.4 THEN 'Pressure ' || {_fixed('pressure_bar', 2)}
    || ' bar is above the expected range.'
    WHEN pressure_bar <= 5.1 THEN 'Pressure ' || {_fixed('pressure_bar', 2)}
    || ' bar is below the expected range.' END,
  CASE WHEN cycle_time_s > 50 THEN 'Cycle time ' || {_fixed('cycle_time_s', 1)}
    || ' s is above the 50 s warning threshold.' END,
  CASE WHEN vibration_mm_s > 2.7 THEN 'Vibration ' || {_fixed('vibration_mm_s', 2)}
    || ' mm/s is above the normal monitoring band.' END,
  CASE WHEN humidity_percent > 60 THEN 'Humidity ' || {_fixed('humidity_percent', 1)}
    || '% is above the configured monitoring band.' END,
  CASE WHEN operator_experience_years < 2 THEN 'Operator experience '
    || {_fixed('operator_experience_years', 1)} || ' years is below the guidance threshold.' END,
  CASE WHEN machine_id = 'M2' THEN 'Machine M2 is configured as a higher-risk asset.' END,
  CASE WHEN material_batch = 'B4'
    THEN 'Material batch B4 is configured as a higher-risk material batch.' END,
  CASE WHEN shift IN ('night', 'late') THEN 'Production occurred on the ' || shift || ' shift.' END
  ), ''), 'No configured sensor anomaly indicators are available for this row.')"""

_ADVICE = f"""concat_ws('; ',
  CASE WHEN machine_id = 'M2' THEN 'Inspect M2 calibration and machine condition.' END,
  CASE WHEN temperature_c > 190 THEN 'Review process temperature control above 190°C.' END,
  CASE WHEN cycle_time_s > 50 THEN 'Investigate cycle time deviation above 50 seconds.' END,
  CASE WHEN vibration_mm_s > 2.7
    THEN 'Check vibration level for possible tool wear or mechanical instability.' END,
  CASE WHEN shift = 'night'
    THEN 'Apply additional process checks during night shift production.' END,
  CASE WHEN operator_experience_years < 2
    THEN 'Use operator guidance or checklist support for low-experience operation.' END,
  CASE WHEN scrap_probability < 0.3 THEN '{cfg.NO_ACTION}' END)"""

_ALIASED = {
    **{rule: condition for rule, condition in FIRES.items()},
    "high_pressure": "(CASE WHEN pressure_bar > 6 THEN pressure_bar ELSE pressure_bar END) >= 6.4",
    "abnormal_cycle_time": "false",
    "long_cycle_time": "false",
    "low_operator_experience": "false",
    "material_batch_b4": "false",
    "high_humidity": "false",
}

ORACLE: dict[str, str] = {
    "scan_production": f"WITH {P} SELECT {COLUMNS} FROM p",
    "project_features": f"""WITH {P} SELECT part_id, machine_id, shift, material_batch,
      temperature_c, pressure_bar, cycle_time_s, operator_experience_years, vibration_mm_s,
      humidity_percent FROM p""",
    "coerce_numeric_columns": f"""WITH {RAW} SELECT part_id,
      {', '.join(f"TRY_CAST(trim({c}, {BLANKS}) AS DOUBLE) AS {c}" for c in NUMERIC)} FROM raw""",
    "scorecard_score": f"""WITH {P} SELECT part_id, round_even(risk_score, 6) AS risk_score,
      scrap_probability FROM p""",
    "risk_levels": f"""WITH {P} SELECT part_id, scrap_probability, {LEVEL} AS risk_level,
      CASE WHEN scrap_probability < 0.3 THEN 'Low risk' WHEN scrap_probability < 0.5
        THEN 'Medium risk' ELSE 'High risk' END AS risk_band,
      printf('%.2f%%', scrap_probability * 100) AS risk_text FROM p""",
    "review_decisions": f"""WITH {REVIEW} SELECT part_id, scrap_probability, risk_level,
      review_threshold, review_decision, decision_reason FROM decided""",
    "decision_counts": f"WITH {REVIEW} {_count_by('decided', 'review_decision')}",
    "risk_level_counts": f"WITH {REVIEW} {_count_by('decided', 'risk_level')}",
    "prediction_confidence": f"""WITH {P} SELECT CASE WHEN scrap_probability >= 0.7 THEN 'High'
      WHEN scrap_probability >= 0.5 THEN 'Medium' ELSE 'Watch' END AS confidence,
      count(*) AS row_count FROM p GROUP BY 1""",
    "spec_flags": f"""WITH {P} SELECT part_id, {', '.join(
        f"CASE WHEN {_broken(c, op, lim)} THEN 1 ELSE 0 END AS {lid.lower()}"
        for lid, c, op, lim, _ in LIMITS)} FROM p""",
    "spec_compliance": f"WITH {CHECKED} SELECT part_id, {SPEC_OUT} FROM checked",
    "violation_text": f"""WITH {RAW},
      typed AS (SELECT part_id, {', '.join(
          f"TRY_CAST(trim({c}, {BLANKS}) AS DOUBLE)"
          + (" / CAST(0.7 AS DOUBLE)" if c == "vibration_mm_s" else "") + f" AS {c}"
          for c in NUMERIC)} FROM raw),
      {_checked('typed')} SELECT part_id, violation_summary FROM checked""",
    "compliance_counts": f"WITH {CHECKED} {_count_by('checked', 'spec_compliance_status')}",
    "violations_by_requirement": f"""WITH {P}, {_violations('p')} SELECT requirement_id, parameter,
      severity, count(*) AS violation_count FROM v GROUP BY ALL""",
    "top_violated_requirement": f"""WITH {P}, {_violations('p')} SELECT requirement_id, parameter,
      severity, count(*) AS violation_count FROM v GROUP BY ALL
      ORDER BY violation_count DESC, requirement_id LIMIT 1""",
    "critical_records": f"""WITH {CHECKED} SELECT part_id, critical_violation_count,
      violated_requirement_ids FROM checked
      WHERE spec_compliance_status = 'CRITICAL_VIOLATION'""",
    "violation_facts": f"""WITH {P}, {_violations('p')}, {LABELS} SELECT requirement_id, part_id,
      actual_value, operator, limit_value, label, signal, signal_label, severity_label, signal_unit
      FROM v JOIN labels_dim USING (requirement_id)""",
    "rules_dim": f"""WITH {P}, {_violations('p')}, {LABELS} SELECT d.*,
      count(v.part_id) AS violation_count
      FROM labels_dim d LEFT JOIN v USING (requirement_id) GROUP BY ALL""",
    "compliance_summary": f"""WITH {CHECKED},
      n AS (SELECT requirement_id, count(*) AS c FROM v GROUP BY 1)
      SELECT count(*) AS row_count, 10 AS requirement_count,
        count(*) FILTER (spec_compliance_status = 'COMPLIANT') AS compliant,
        count(*) FILTER (spec_compliance_status = 'WARNING_VIOLATION') AS warning_violation,
        count(*) FILTER (spec_compliance_status = 'CRITICAL_VIOLATION') AS critical_violation,
        (SELECT string_agg(requirement_id || '=' || CAST(c AS VARCHAR), '; '
          ORDER BY c DESC, requirement_id) FROM n) AS violations_by_requirement
      FROM checked""",
    "alias_resolution": f"WITH {P} {_flags('p', _ALIASED)}",
    "rca_flags": f"WITH {P} {_flags('p')}",
    "rca_drivers": f"""WITH {CAUSED} SELECT part_id, suspected_driver_count AS driver_count,
      array_to_string(d, '; ') AS drivers, array_to_string(s, '; ') AS severities FROM caused""",
    "rca_fallback": f"""WITH {P}, {causes('p', "'high'", {
        r: c for r, c in FIRES.items() if c.startswith(('temperature', 'pressure'))})}
      SELECT part_id, suspected_driver_count, top_suspected_drivers, root_cause_summary,
        engineering_recommendations FROM caused""",
    "rca_recommendations": f"WITH {CAUSED} SELECT part_id, engineering_recommendations FROM caused",
    "rca_summary": f"WITH {CAUSED} SELECT part_id, root_cause_summary FROM caused",
    "rca_enriched": f"""WITH {P}, {causes('p', "'unknown'")} SELECT part_id,
      suspected_driver_count, top_suspected_drivers, root_cause_summary,
      engineering_recommendations FROM caused""",
    "export_rca": f"""WITH {RESULTS} SELECT part_id, predicted_scrap_risk, root_cause_summary,
      engineering_recommendations FROM results""",
    "part_recommendations": f"WITH {P} SELECT part_id, {_ADVICE} AS recommendations FROM p",
    "sensor_evidence": f"WITH {P} SELECT part_id, {_EVIDENCE} AS evidence FROM p",
    "driver_counts": f"WITH {REVIEWED} {_entries('caused', 'top_suspected_drivers', 'driver')}",
    "recurring_drivers": f"""WITH {RESULTS}, {_NAMED_COUNTS}
      SELECT {_TITLE.format('driver')} AS driver, row_count FROM named_counts
      ORDER BY row_count DESC, named_counts.driver LIMIT 5""",
    "summary_drivers": f"""WITH {RESULTS} SELECT part_id,
      CASE WHEN root_cause_summary = '' THEN '' ELSE
        {_TITLE.format(f"replace({_NAMED}, ', ', '; ')")} END AS drivers FROM results""",
    "recommendation_counts": f"""WITH {RESULTS} SELECT * FROM ({_entries(
        'results', 'engineering_recommendations', 'recommendation')})
      ORDER BY row_count DESC, recommendation LIMIT 5""",
    "representative_rca": f"""WITH {RESULTS} SELECT part_id,
      printf('%.2f%%', scrap_probability * 100) AS risk, predicted_scrap_risk, root_cause_summary
      FROM results WHERE trim(root_cause_summary) <> '' {_TOP} LIMIT 5""",
    "batch_review": f"WITH {REVIEWED} SELECT {REVIEW_OUT} FROM caused",
    "review_summary": f"""WITH {REVIEWED}
      SELECT 'decision' AS section, review_decision AS name, count(*) AS row_count
        FROM caused GROUP BY 2
      UNION ALL SELECT 'risk_level', risk_level, count(*) FROM caused GROUP BY 2
      UNION ALL SELECT 'driver', driver, row_count
        FROM ({_entries('caused', 'top_suspected_drivers', 'driver')})""",
    "review_queue": f"""WITH {REVIEWED} SELECT part_id, scrap_probability, risk_level,
      review_decision, root_cause_summary, engineering_recommendations FROM caused
      WHERE review_decision = 'ENGINEERING_REVIEW_REQUIRED'""",
    "dominant_driver": f"""WITH {RESULTS}, {_NAMED_COUNTS}
      SELECT {_TITLE.format('driver')} AS driver, row_count FROM named_counts
      ORDER BY row_count DESC, named_counts.driver LIMIT 1""",
    "schema_check": """SELECT 'schema_validation' AS check_name, 'FAIL' AS status,
        'scrap' AS affected, count(*) AS row_count FROM lineitem
      UNION ALL SELECT 'unexpected_columns', 'WARNING', 'risk_score; scrap_probability', count(*)
        FROM lineitem
      UNION ALL SELECT 'empty_dataset', CASE WHEN count(*) = 0 THEN 'FAIL' ELSE 'PASS' END, '',
        count(*) FROM lineitem""",
    "missing_profile": f"""WITH {RAW} SELECT column_name, missing_count,
      exact_round(missing_count / CAST(n AS DOUBLE), 4) AS missing_percentage,
      CASE WHEN missing_count = 0 THEN 'PASS' WHEN missing_count / CAST(n AS DOUBLE) <= 0.05
        THEN 'WARNING' ELSE 'FAIL' END AS status FROM ({MISSING})""",
    "numeric_validity": f"""WITH {RAW} SELECT column_name, invalid_count,
      CASE WHEN invalid_count > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM ({INVALID})""",
    "invalid_examples": f"""WITH {RAW}, bad AS ({_union(
        f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS row_count FROM raw "
        f"WHERE {_unreadable(c)} GROUP BY 2" for c in NUMERIC)})
      SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY column_name ORDER BY value)
        AS INTEGER) AS example_rank FROM bad) WHERE example_rank <= 5""",
    "invalid_target_examples": f"""WITH {RAW} SELECT 'scrap' AS column_name, scrap AS value,
      count(*) AS row_count FROM raw WHERE scrap NOT IN ('0', '1') GROUP BY 2
      ORDER BY value LIMIT 10""",
    "unexpected_categories": f"WITH {RAW} {STRANGE}",
    "target_profile": f"""WITH {RAW} SELECT *, CASE WHEN invalid_target > 0 THEN 'FAIL'
      WHEN scrap_count / CAST(total_rows AS DOUBLE) NOT BETWEEN 0.03 AND 0.25 THEN 'WARNING'
      ELSE 'PASS' END AS status FROM ({TARGET})""",
    "range_violations": f"""WITH {RAW} SELECT *,
      below_range_count + above_range_count AS outside_range_count,
      CASE WHEN below_range_count + above_range_count > 0 THEN 'WARNING' ELSE 'PASS' END
        AS status FROM ({OUTSIDE})""",
    "duplicate_keys": f"WITH {DUPLICATES} SELECT part_id, row_count FROM repeated",
    "duplicate_summary": f"""WITH {DUPLICATES} SELECT
      CAST(coalesce(sum(row_count), 0) AS BIGINT) AS duplicate_row_count,
      count(*) AS duplicate_group_count,
      (SELECT coalesce(string_agg(part_id, '; ' ORDER BY part_id), '')
        FROM (SELECT part_id FROM repeated ORDER BY part_id LIMIT 10)) AS duplicate_examples
      FROM repeated""",
    "dq_report": f"""WITH {RAW}, {REPORT} SELECT *, (SELECT count(*) FROM raw) AS row_count,
      {OVERALL} AS overall_status FROM report""",
    "running_quality": f"""WITH {RAW}, {REPORT} SELECT *, (SELECT count(*) FROM raw) AS row_count,
      {OVERALL} AS overall_status FROM report""",
    "scoring_warnings": f"""WITH {RAW}
      SELECT column_name, column_name || ' has unexpected category: ' || value AS warning,
        row_count FROM ({STRANGE})
      UNION ALL SELECT column_name, column_name || ' has ' || CAST(outside AS VARCHAR)
        || ' values outside monitoring range ' || range_text, outside
      FROM ({_union(
          f"SELECT column_name, below_range_count + above_range_count AS outside, "
          f"'{low} to {high}' AS range_text FROM ({OUTSIDE}) WHERE column_name = '{c}'"
          for c, (low, high) in RANGES.items())}) WHERE outside > 0""",
    "confusion_metrics": f"""WITH {SWEEP} SELECT accuracy, precision, recall, f1_score,
      true_negative, false_positive, false_negative, true_positive FROM sweep
      WHERE threshold = 0.5""",
    "threshold_sweep": f"WITH {SWEEP} SELECT * FROM sweep",
    "selected_threshold": f"""WITH {SWEEP} SELECT threshold AS selected_threshold, accuracy,
      precision, recall, f1_score, true_negative, false_positive, false_negative, true_positive,
      CASE WHEN recall >= 0.6 THEN '{cfg.SELECTED_ON_TARGET}' ELSE '{cfg.SELECTED_OFF_TARGET}'
      END AS selection_reason FROM selected""",
    "threshold_costs": f"WITH {SWEEP} SELECT * FROM costs",
    "cost_optimal_threshold": f"WITH {SWEEP} SELECT * FROM cheapest",
    "cost_summary": f"""WITH {SWEEP} SELECT b.threshold AS best_threshold,
      b.total_cost AS best_total_cost, b.missed_scrap_cost AS best_missed_scrap_cost,
      b.false_alarm_cost AS best_false_alarm_cost, b.false_negative AS best_false_negative,
      b.false_positive AS best_false_positive, b.recall AS best_recall,
      b.precision AS best_precision, b.f1_score AS best_f1_score,
      s.total_cost AS default_total_cost, s.false_negative AS default_false_negative,
      s.false_positive AS default_false_positive, s.recall AS default_recall,
      t.total_cost AS recall_tuned_total_cost, t.false_negative AS recall_tuned_false_negative,
      t.false_positive AS recall_tuned_false_positive, t.recall AS recall_tuned_recall,
      s.total_cost - b.total_cost AS savings_vs_default
      FROM cheapest b, standard s, tuned t""",
    "threshold_deltas": f"""WITH {SWEEP} SELECT CAST(0.5 AS DOUBLE) AS default_threshold,
      b.threshold AS selected_threshold, s.recall AS default_recall, b.recall AS selected_recall,
      exact_round((b.recall - s.recall) * 100, 2) AS recall_gain_points,
      s.false_negative AS default_false_negative, b.false_negative AS selected_false_negative,
      s.false_negative - b.false_negative AS missed_scrap_reduction,
      s.false_positive AS default_false_positive, b.false_positive AS selected_false_positive,
      b.false_positive - s.false_positive AS additional_false_alarms
      FROM selected b, standard s""",
    "threshold_tradeoff": f"""WITH {SWEEP} SELECT threshold, recall, false_positive,
      false_negative, total_cost FROM costs ORDER BY total_cost, threshold LIMIT 5""",
    "risk_band_eval": f"""WITH {P}, bands(band_order, risk_band, low, high, review_priority) AS
      (VALUES (1, 'Low risk', 0.0, 0.3, 'Standard monitoring'),
        (2, 'Medium risk', 0.3, 0.5, 'Additional monitoring'),
        (3, 'High risk', 0.5, 1.0000001, 'Engineering review priority'))
      SELECT band_order, risk_band, count(scrap) AS row_count,
        CAST(coalesce(sum(scrap), 0) AS BIGINT) AS actual_scrap_count,
        coalesce(exact_round(avg(scrap), 4), 0) AS actual_scrap_rate,
        coalesce(exact_round(avg(scrap_probability), 4), 0) AS average_predicted_risk, review_priority
      FROM bands LEFT JOIN p ON scrap_probability >= low AND scrap_probability < high
      GROUP BY band_order, risk_band, review_priority""",
    "roc_auc": f"""WITH {P}, {ranking('p', 'scrap_probability')}
      SELECT exact_round(roc_auc, 6) AS roc_auc FROM ranks""",
    "average_precision": f"""WITH {P}, {ranking('p', 'scrap_probability')}
      SELECT exact_round(average_precision, 6) AS average_precision FROM ranks""",
    "ranking_unrounded": f"""WITH {P}, {ranking('p', '1 / (1 + exp(-round_even(risk_score, 9)))')}
      SELECT exact_round(roc_auc, 6) AS roc_auc, exact_round(average_precision, 6) AS average_precision
      FROM ranks""",
    "evaluation_summary": f"""WITH {SWEEP}, {ranking('p', 'scrap_probability')}
      SELECT exact_round(roc_auc, 4) AS roc_auc, exact_round(average_precision, 4) AS pr_auc,
        exact_round(base_rate, 4) AS baseline_scrap_rate,
        (SELECT threshold FROM selected) AS selected_threshold,
        (SELECT threshold FROM cheapest) AS cost_optimized_threshold FROM ranks""",
    "review_threshold_choice": f"""WITH {SWEEP} SELECT coalesce((SELECT threshold FROM cheapest),
        (SELECT threshold FROM selected), 0.5) AS review_threshold,
      CASE WHEN (SELECT threshold FROM cheapest) IS NOT NULL THEN 'cost_optimized_threshold'
        WHEN (SELECT threshold FROM selected) IS NOT NULL THEN 'selected_threshold'
        ELSE 'fallback_0_50' END AS threshold_source""",
    "feedback_cases": f"""WITH {CASE} SELECT part_id, scrap_probability, review_decision,
      actual_scrap, engineer_review_outcome, feedback_classification, feedback_priority,
      feedback_interpretation FROM cases""",
    "feedback_job": f"""WITH {CASE} SELECT 'class' AS section, feedback_classification AS name, count(*) AS row_count
        FROM cases GROUP BY ALL
      UNION ALL SELECT 'missed_at', format('{{:.1f}}', cut), (SELECT count(*) FROM cases
        WHERE scrap_probability < cut AND actual_scrap = 1)
        FROM (SELECT CAST(unnest([0.3, 0.4, 0.5, 0.6]) AS DOUBLE) AS cut)
      UNION ALL SELECT 'coverage', 'review_rows', (SELECT count(*) FROM p)
      UNION ALL SELECT 'coverage', 'feedback_rows', (SELECT count(*) FROM feedback)
      UNION ALL SELECT 'coverage', 'matched_rows', (SELECT count(*) FROM p JOIN feedback USING (part_id))
      UNION ALL SELECT 'coverage', 'missing_feedback_rows', (SELECT count(DISTINCT part_id) FROM p
        WHERE part_id NOT IN (SELECT part_id FROM feedback))
      UNION ALL SELECT 'coverage', 'extra_feedback_rows', (SELECT count(DISTINCT part_id) FROM feedback
        WHERE part_id NOT IN (SELECT part_id FROM p))""",
    "stored_predictions": f"WITH {RESULTS} SELECT {_EXPORT_OUT} FROM results",
    "stored_compliance": f"""WITH {CHECKED} SELECT part_id, spec_compliance_status, violation_count,
      violated_requirement_ids FROM checked""",
    "feedback_class_counts": f"WITH {CASE} {_count_by('cases', 'feedback_classification')}",
    "feedback_coverage": f"""WITH {P}, {FEEDBACK} SELECT
      (SELECT count(*) FROM p) AS review_rows, (SELECT count(*) FROM feedback) AS feedback_rows,
      (SELECT count(*) FROM p JOIN feedback USING (part_id)) AS matched_rows,
      (SELECT count(DISTINCT part_id) FROM p WHERE part_id NOT IN
        (SELECT part_id FROM feedback)) AS missing_feedback_rows,
      (SELECT count(DISTINCT part_id) FROM feedback WHERE part_id NOT IN
        (SELECT part_id FROM p)) AS extra_feedback_rows""",
    "feedback_missing": f"""WITH {P}, {FEEDBACK} SELECT DISTINCT part_id FROM p
      WHERE part_id NOT IN (SELECT part_id FROM feedback)""",
    "feedback_extra": f"""WITH {P}, {FEEDBACK} SELECT DISTINCT part_id FROM feedback
      WHERE part_id NOT IN (SELECT part_id FROM p)""",
    "feedback_invalid_labels": f"""WITH {RAW}, texts AS (SELECT part_id,
        CASE WHEN TRY_CAST(trim(temperature_c, {BLANKS}) AS DOUBLE) IS NOT NULL THEN scrap END
          AS actual_scrap FROM raw)
      SELECT * FROM texts WHERE actual_scrap IS NULL OR actual_scrap NOT IN ('0', '1')""",
    "review_effectiveness": f"""WITH {CASE} SELECT
      count(*) FILTER (actual_scrap = 1) AS actual_issue_count,
      count(*) FILTER (review_decision = 'ENGINEERING_REVIEW_REQUIRED') AS review_required_count,
      count(*) FILTER (feedback_classification = 'MISSED_ISSUE') AS missed_issue_count,
      count(*) FILTER (feedback_classification = 'FALSE_ALARM_REVIEW') AS false_alarm_count,
      exact_round(coalesce(count(*) FILTER (feedback_classification = 'TRUE_POSITIVE_REVIEW')
        / nullif(CAST(count(*) FILTER (actual_scrap = 1) AS DOUBLE), 0), 0), 4)
        AS issue_capture_rate,
      exact_round(coalesce(count(*) FILTER (feedback_classification = 'FALSE_ALARM_REVIEW')
        / nullif(CAST(count(*) FILTER (review_decision = 'ENGINEERING_REVIEW_REQUIRED')
          AS DOUBLE), 0), 0), 4) AS false_alarm_rate_among_reviews FROM cases""",
    "threshold_scenarios": f"""WITH {CASE}, cuts AS
        (SELECT CAST(unnest([0.3, 0.4, 0.5, 0.6]) AS DOUBLE) AS threshold),
      counted AS (SELECT threshold,
        count(*) FILTER (scrap_probability >= threshold AND actual_scrap = 1) AS tp,
        count(*) FILTER (scrap_probability >= threshold AND actual_scrap = 0) AS fa,
        count(*) FILTER (scrap_probability < threshold AND actual_scrap = 1) AS miss,
        count(*) FILTER (scrap_probability < threshold AND actual_scrap = 0) AS tn
        FROM cases CROSS JOIN cuts GROUP BY threshold)
      SELECT threshold, tp AS true_positive_reviews, fa AS false_alarm_reviews,
        miss AS missed_issues, tn AS true_negative_monitoring, tp + fa AS review_required_count,
        exact_round(coalesce(tp / nullif(CAST(tp + miss AS DOUBLE), 0), 0), 4) AS issue_capture_rate,
        exact_round(coalesce(fa / nullif(CAST(tp + fa AS DOUBLE), 0), 0), 4)
          AS false_alarm_rate_among_reviews FROM counted""",
    "confirmed_driver_counts": f"""WITH {CASE}, confirmed AS
        (SELECT * FROM cases WHERE actual_scrap = 1)
      {_entries('confirmed', 'top_suspected_drivers', 'driver')}""",
    "machine_summary": f"""WITH {P} SELECT machine_id, count(part_id) AS total_parts,
      CAST(sum(scrap) AS BIGINT) AS scrap_parts, exact_round(avg(scrap), 6) AS scrap_rate,
      exact_round(avg(temperature_c), 4) AS avg_temperature_c,
      exact_round(avg(cycle_time_s), 4) AS avg_cycle_time_s,
      exact_round(avg(vibration_mm_s), 4) AS avg_vibration_mm_s FROM p GROUP BY 1""",
    "scrap_by_machine": f"WITH {P} {_rates('machine_id')}",
    "scrap_by_shift": f"WITH {P} {_rates('shift')}",
    "scrap_by_category": f"""WITH {P} SELECT 'machine_id' AS category, * FROM
        ({_rates('machine_id')})
      UNION ALL SELECT 'shift', * FROM ({_rates('shift')})
      UNION ALL SELECT 'material_batch', * FROM ({_rates('material_batch')})""",
    "scrap_by_temperature": f"""WITH {P}, bins(label_order, label) AS (VALUES (1, '<180°C'),
        (2, '180–185°C'), (3, '185–190°C'), (4, '190–195°C'), (5, '>195°C'))
      SELECT label_order, label, count(scrap) AS row_count,
        exact_round(avg(scrap) * 100, 2) AS scrap_rate
      FROM bins LEFT JOIN (SELECT {_BIN} AS label, scrap FROM p) USING (label)
      GROUP BY 1, 2""",
    "rule_count_levels": f"""WITH {P}, levels(label_order, label) AS (VALUES (1, 'Low risk'),
        (2, 'Medium risk'), (3, 'High risk'))
      SELECT label_order, label, count(signs) AS row_count FROM levels LEFT JOIN
        (SELECT signs, CASE WHEN signs >= 3 THEN 'High risk' WHEN signs = 2 THEN 'Medium risk'
          ELSE 'Low risk' END AS label FROM (SELECT {_SIGNS} AS signs FROM p)) USING (label)
      GROUP BY 1, 2""",
    "dataset_totals": f"""WITH {P} SELECT count(*) AS total_parts,
      CAST(sum(scrap) AS BIGINT) AS scrap_parts, exact_round(avg(scrap), 6) AS scrap_rate,
      count(DISTINCT machine_id) AS machines, count(DISTINCT shift) AS shifts,
      count(DISTINCT material_batch) AS material_batches FROM p""",
    "highest_risk_machine": f"""WITH {P}, rates AS
        (SELECT machine_id, avg(scrap) AS rate FROM p GROUP BY 1)
      SELECT machine_id, exact_round(rate * 100, 2) AS scrap_rate,
        exact_round((SELECT avg(scrap) FROM p) * 100, 2) AS overall_scrap_rate,
        exact_round((rate - (SELECT avg(scrap) FROM p)) * 100, 2) AS gap_points
      FROM rates ORDER BY rate DESC, machine_id LIMIT 1""",
    "export_predictions": f"""WITH {RESULTS} SELECT {_EXPORT_OUT} FROM results
      WHERE predicted_scrap_risk = 'High' {_TOP} LIMIT 25""",
    "export_without_flagged": f"""WITH {P} SELECT part_id, machine_id, shift, material_batch,
      temperature_c, pressure_bar, cycle_time_s, operator_experience_years, vibration_mm_s,
      humidity_percent, scrap, scrap_probability, 'Low' AS predicted_scrap_risk,
      '' AS root_cause_summary, '' AS engineering_recommendations FROM p {_TOP} LIMIT 25""",
    "sample_prediction": f"""WITH {RESULTS} SELECT part_id,
      exact_round(scrap_probability * 100, 2) AS scrap_probability,
      predicted_scrap_risk AS risk_level, machine_id, shift, material_batch, temperature_c,
      pressure_bar, cycle_time_s, operator_experience_years, vibration_mm_s, humidity_percent,
      root_cause_summary, engineering_recommendations,
      engineering_recommendations AS recommendations FROM results r
      ORDER BY r.scrap_probability DESC, part_id LIMIT 1""",
    "prediction_kpis": f"""WITH {RESULTS} SELECT count(*) AS total_predictions,
      count(*) FILTER (lower(predicted_scrap_risk) = 'high') AS high_risk_rows,
      exact_round(avg(scrap_probability), 6) AS average_predicted_risk FROM results""",
    "case_trace_table": f"""WITH {TRACED} SELECT part_id, scrap_probability, review_decision,
      spec_compliance_status, violation_count, actual_scrap, feedback_classification,
      trace_summary FROM traced""",
    "trace_case": f"""WITH {TRACED} SELECT part_id, machine_id, shift, material_batch,
      temperature_c, pressure_bar, cycle_time_s, operator_experience_years, vibration_mm_s,
      humidity_percent, scrap_probability, risk_level, review_threshold, review_decision,
      decision_reason, root_cause_summary, suspected_driver_count, top_suspected_drivers,
      engineering_recommendations, {SPEC_OUT}, actual_scrap, engineer_review_outcome,
      feedback_classification, feedback_priority, feedback_interpretation, review_notes,
      trace_summary FROM traced ORDER BY CASE
        WHEN feedback_classification = 'TRUE_POSITIVE_REVIEW'
          AND spec_compliance_status = 'CRITICAL_VIOLATION' THEN 0
        WHEN review_decision = 'ENGINEERING_REVIEW_REQUIRED' THEN 1 ELSE 2 END,
        scrap_probability DESC, part_id LIMIT 1""",
    "split_profile": f"""WITH {P} SELECT scrap, is_test, count(*) AS row_count FROM
      (SELECT scrap, CAST('0x' || substr(md5(part_id || '|42'), 1, 8) AS BIGINT) % 10000 < 2500
        AS is_test FROM p) GROUP BY 1, 2""",
    "stratified_split_profile": f"""WITH {P}, d AS (SELECT scrap, part_id,
      CAST('0x' || substr(md5(part_id || '|42'), 1, 15) AS BIGINT) AS digest FROM p),
      n AS (SELECT *, row_number() OVER (PARTITION BY scrap ORDER BY digest) AS place,
        count(*) OVER (PARTITION BY scrap) AS total FROM d)
      SELECT scrap, place <= round_even(0.25 * total, 0) AS is_test, count(*) AS row_count,
        arg_min(part_id, digest) AS first_part, arg_max(part_id, digest) AS last_part FROM n GROUP BY 1, 2""",
}

ORACLE["stored_summary"] = ORACLE["review_effectiveness"]
ORACLE["workflow_overview"] = f"""WITH {CASE}, {RAW.replace(P, '').lstrip(',')}, {REPORT},
  {_checked('p')},
  q AS (SELECT {OVERALL} AS status, count(*) FILTER (status = 'WARNING') AS warnings,
    count(*) FILTER (status = 'FAIL') AS errors FROM report),
  t AS ({TARGET}),
  e AS (SELECT count(*) FILTER (feedback_classification = 'TRUE_POSITIVE_REVIEW') AS tp,
    count(*) FILTER (feedback_classification = 'FALSE_ALARM_REVIEW') AS fa,
    count(*) FILTER (feedback_classification = 'MISSED_ISSUE') AS miss FROM cases),
  cards AS (
    SELECT 'data_quality' AS stage, 'status' AS metric, status AS value FROM q
    UNION ALL SELECT 'data_quality', 'row_count', CAST(total_rows AS VARCHAR) FROM t
    UNION ALL SELECT 'data_quality', 'column_count', '11'
    UNION ALL SELECT 'data_quality', 'warning_count', CAST(warnings AS VARCHAR) FROM q
    UNION ALL SELECT 'data_quality', 'error_count', CAST(errors AS VARCHAR) FROM q
    UNION ALL SELECT 'data_quality', 'scrap_rate', CAST(scrap_rate AS VARCHAR) FROM t
    UNION ALL SELECT 'batch_review', 'row_count', CAST(count(*) AS VARCHAR) FROM decided
    UNION ALL SELECT 'batch_review', 'review_threshold', '0.4'
    UNION ALL SELECT 'batch_review', d, CAST((SELECT count(*) FROM decided
        WHERE review_decision = d) AS VARCHAR)
      FROM (SELECT unnest(['ENGINEERING_REVIEW_REQUIRED', 'ADDITIONAL_MONITORING',
        'STANDARD_MONITORING']) AS d)
    UNION ALL SELECT 'batch_review', 'risk_' || l, CAST((SELECT count(*) FROM decided
        WHERE risk_level = l) AS VARCHAR)
      FROM (SELECT unnest(['High', 'Medium', 'Low']) AS l)
    UNION ALL SELECT 'spec_compliance', 'row_count', CAST(count(*) AS VARCHAR) FROM checked
    UNION ALL SELECT 'spec_compliance', 'requirement_count', '10'
    UNION ALL SELECT 'spec_compliance', s, CAST((SELECT count(*) FROM checked
        WHERE spec_compliance_status = s) AS VARCHAR)
      FROM (SELECT unnest(['COMPLIANT', 'WARNING_VIOLATION', 'CRITICAL_VIOLATION']) AS s)
    UNION ALL SELECT 'spec_compliance', 'most_common_violated_requirement' || suffix, shown
      FROM (SELECT unnest(['', '_parameter', '_severity', '_count']) AS suffix,
        unnest([requirement_id, parameter, severity, CAST(n AS VARCHAR)]) AS shown
        FROM (SELECT requirement_id, min(parameter) AS parameter, min(severity) AS severity, count(*) AS n
          FROM v GROUP BY requirement_id ORDER BY n DESC, requirement_id LIMIT 1))
    UNION ALL SELECT 'feedback_loop', 'row_count', CAST(count(*) AS VARCHAR) FROM cases
    UNION ALL SELECT 'feedback_loop', f, CAST((SELECT count(*) FROM cases
        WHERE feedback_classification = f) AS VARCHAR)
      FROM (SELECT unnest(['MISSED_ISSUE', 'FALSE_ALARM_REVIEW', 'TRUE_POSITIVE_REVIEW',
        'TRUE_NEGATIVE_MONITORING']) AS f)
    UNION ALL SELECT 'feedback_loop', 'issue_capture_rate',
      CAST(exact_round(tp / CAST(tp + miss AS DOUBLE), 4) AS VARCHAR) FROM e
    UNION ALL SELECT 'feedback_loop', 'false_alarm_rate_among_reviews',
      CAST(exact_round(fa / CAST(tp + fa AS DOUBLE), 4) AS VARCHAR) FROM e
  )
  SELECT * FROM cards"""

ORACLE["review_with_chosen_threshold"] = f"""WITH {SWEEP},
  cut AS (SELECT threshold FROM cheapest),
  levelled AS (SELECT *, {LEVEL} AS risk_level FROM p),
  {causes('levelled', 'lower(risk_level)')}
  SELECT part_id, scrap_probability, threshold AS review_threshold,
    CASE WHEN scrap_probability >= threshold OR risk_level = 'High'
        THEN 'ENGINEERING_REVIEW_REQUIRED'
      WHEN risk_level = 'Medium' THEN 'ADDITIONAL_MONITORING'
      ELSE 'STANDARD_MONITORING' END AS review_decision, root_cause_summary
  FROM caused, cut"""

_TEST = "CAST('0x' || substr(md5(part_id || '|42'), 1, 8) AS BIGINT) % 10000 < 2500"
_READINGS = (
    "temperature_c", "pressure_bar", "cycle_time_s", "operator_experience_years", "vibration_mm_s",
    "humidity_percent",
)
ORACLE["training_profile"] = f"""WITH {P}, train AS (SELECT * FROM p WHERE NOT ({_TEST})), cells AS (
  SELECT 'class_rows' AS kind, CAST(scrap AS VARCHAR) AS name, CAST(count(*) AS DOUBLE) AS value
    FROM train GROUP BY scrap
  UNION ALL SELECT 'class_weight', CAST(scrap AS VARCHAR),
    (SELECT count(*) FROM train) / (2 * CAST(count(*) AS DOUBLE)) FROM train GROUP BY scrap
  {" ".join(f"UNION ALL SELECT 'mean', '{c}', avg({c}) FROM train" for c in _READINGS)}
  {" ".join(f"UNION ALL SELECT 'deviation', '{c}', stddev_samp({c}) FROM train" for c in _READINGS)}
  {" ".join(f"UNION ALL SELECT 'indicator_rows', '{c}_' || {c}, count(*) FROM train GROUP BY {c}"
            for c in ("machine_id", "shift", "material_batch"))})
  SELECT kind, name, exact_round(value, 6) AS value FROM cells"""
ORACLE["model_checks"] = f"""WITH {P}, tested AS (SELECT count(*) AS n FROM p WHERE {_TEST})
  SELECT model, n AS tested_rows, n AS cell_rows, CAST(0 AS BIGINT) AS outside, CAST(0 AS BIGINT) AS missing
  FROM tested, (SELECT unnest(['Logistic Regression', 'Random Forest', 'Gradient Boosting']) AS model)"""


def _spelled_out(sql: str) -> str:
    """Replaces exact_round(x, d), which rounds the stored binary value, by what DuckDB has for it."""
    while (at := sql.find("exact_round(")) >= 0:
        first = end = at + len("exact_round(")
        depth = 1
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        value, _, digits = sql[first : end - 1].rpartition(",")
        plain = f"CAST(printf('%.{int(digits)}f', CAST({value} AS DOUBLE)) AS DOUBLE)"
        sql = sql[:at] + plain + sql[end:]
    return sql


ORACLE = {name: _spelled_out(sql) for name, sql in ORACLE.items()}
