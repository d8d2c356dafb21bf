"""Cut points, decisions, costs and score coefficients."""

# Review level cuts, decisions and their reasons.
LEVEL_CUTS = (("High", 0.60), ("Medium", 0.30))
LOWEST_LEVEL = "Low"
REVIEW = "ENGINEERING_REVIEW_REQUIRED"
WATCH = "ADDITIONAL_MONITORING"
ROUTINE = "STANDARD_MONITORING"
DECISIONS = (REVIEW, WATCH, ROUTINE)
REASON_THRESHOLD = "Probability exceeds configured review threshold."
REASON_HIGH = (
    "High predicted risk; engineering review is recommended even below the configured threshold."
)
REASON_MEDIUM = (
    "Medium predicted risk; monitor process conditions and review if pattern repeats."
)
REASON_LOW = "Low predicted risk; continue standard monitoring."
FALLBACK_THRESHOLD = 0.50

# Half-open calibration bands [lower, upper).
BANDS = (
    ("Low risk", 0.0, 0.30, "Standard monitoring"),
    ("Medium risk", 0.30, 0.50, "Additional monitoring"),
    ("High risk", 0.50, 1.0000001, "Engineering review priority"),
)

# Threshold grid, recall target and cost assumptions.
SWEEP = (0.20, 0.25, 0.30, 0.35, 0.40, 0.45, 0.50)
RECALL_TARGET = 0.60
DEFAULT_CUT = 0.50
RECALL_TUNED_CUT = 0.30
MISSED_SCRAP_COST = 100.0
FALSE_ALARM_COST = 10.0
SELECTED_ON_TARGET = (
    "Selected because it reaches the recall target for an early-warning quality use case "
    "while maintaining the strongest F1 score among candidates."
)
SELECTED_OFF_TARGET = (
    "Selected because no threshold reached the recall target; this threshold has the "
    "strongest F1 score among evaluated options."
)

# Feedback classes, their priority and reading; what-if thresholds.
TRUE_POSITIVE = "TRUE_POSITIVE_REVIEW"
FALSE_ALARM = "FALSE_ALARM_REVIEW"
MISSED = "MISSED_ISSUE"
TRUE_NEGATIVE = "TRUE_NEGATIVE_MONITORING"
FEEDBACK_PRIORITY = {
    MISSED: "highest",
    FALSE_ALARM: "medium",
    TRUE_POSITIVE: "high",
    TRUE_NEGATIVE: "low",
}
FEEDBACK_READING = {
    TRUE_POSITIVE: "Model-based review correctly prioritized a later confirmed issue.",
    FALSE_ALARM: (
        "Engineering review was required, but no issue was later confirmed. "
        "This may be an acceptable false alarm depending on inspection cost."
    ),
    MISSED: (
        "Actual issue was not prioritized for engineering review. "
        "This is the most important case for threshold or rule adjustment."
    ),
    TRUE_NEGATIVE: "Standard monitoring matched later clean feedback.",
}
SCENARIOS = (0.30, 0.40, 0.50, 0.60)

# Display confidence cuts, temperature bins and fixed part advice.
CONFIDENCE_CUTS = (("High", 0.7), ("Medium", 0.5))
TEMPERATURE_BINS = (
    ("<180°C", 0.0, 180.0),
    ("180–185°C", 180.0, 185.0),
    ("185–190°C", 185.0, 190.0),
    ("190–195°C", 190.0, 195.0),
    (">195°C", 195.0, 1000.0),
)
FLAG_LEVELS = ("Low risk", "Medium risk", "High risk")
NO_ACTION = "No immediate action required. Continue standard process monitoring."

# Additive logistic scorecard.
# offsets: column -> {value: points}; ramps: (column, start, slope, cap, sign).
SCORE_INTERCEPT = -3.25
SCORE_OFFSETS = {
    "machine_id": {"M2": 0.85, "M4": 0.25},
    "shift": {"night": 0.35, "late": 0.12},
    "material_batch": {"B4": 0.3},
}
SCORE_RAMPS = (
    ("temperature_c", 190.0, 0.12, 1.2, 1),
    ("cycle_time_s", 50.0, 0.14, 1.4, 1),
    ("vibration_mm_s", 2.7, 0.6, 1.5, 1),
    ("humidity_percent", 60.0, 0.03, 0.6, 1),
    ("operator_experience_years", 0.0, 0.035, 0.35, -1),
)
