"""Shape of a production table and the limits its values are monitored against."""

# Column names, expected categories and monitoring ranges.
KEY = "part_id"
TARGET = "scrap"
CATEGORICAL = ("machine_id", "shift", "material_batch")
NUMERIC = (
    "temperature_c",
    "pressure_bar",
    "cycle_time_s",
    "operator_experience_years",
    "vibration_mm_s",
    "humidity_percent",
)
FEATURES = CATEGORICAL + NUMERIC
PRODUCTION_COLUMNS = (
    "part_id",
    "machine_id",
    "temperature_c",
    "pressure_bar",
    "cycle_time_s",
    "shift",
    "material_batch",
    "operator_experience_years",
    "vibration_mm_s",
    "humidity_percent",
    "scrap",
)
SCORING_COLUMNS = tuple(c for c in PRODUCTION_COLUMNS if c != TARGET)
EXPECTED_CATEGORIES = {
    "machine_id": ("M1", "M2", "M3", "M4"),
    "shift": ("early", "late", "night"),
    "material_batch": ("B1", "B2", "B3", "B4", "B5"),
}
MONITORING_RANGES = {
    "temperature_c": (160, 210),
    "pressure_bar": (4.0, 7.5),
    "cycle_time_s": (30, 70),
    "operator_experience_years": (0, 20),
    "vibration_mm_s": (0, 6),
    "humidity_percent": (0, 100),
}
# Shares and rates that the checks tolerate.
MISSING_SHARE_TOLERATED = 0.05
SCRAP_RATE_EXPECTED = (0.03, 0.25)

# Columns of stored review results and of feedback.
REVIEW_COLUMNS = (
    "part_id",
    "scrap_probability",
    "risk_level",
    "review_threshold",
    "review_decision",
    "root_cause_summary",
    "top_suspected_drivers",
    "engineering_recommendations",
)
FEEDBACK_COLUMNS = ("part_id", "actual_scrap", "engineer_review_outcome", "review_notes")

# Cell texts a CSV reader takes for a missing value.
NULL_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Physical column names accepted for one logical signal, in lookup order.
COLUMN_ALIASES = {
    "temperature": ("temperature", "temperature_c", "temp_c", "process_temperature"),
    "pressure": ("pressure", "pressure_bar", "process_pressure"),
    "vibration": ("vibration", "vibration_mm_s", "vibration_level"),
    "cycle_time": ("cycle_time", "cycle_time_s", "cycle_seconds"),
    "machine": ("machine", "machine_id"),
    "operator": ("operator", "operator_id"),
    "operator_experience": ("operator_experience_years", "experience_years"),
    "material": ("material", "material_batch", "material_lot"),
    "shift": ("shift", "production_shift"),
    "humidity": ("humidity", "humidity_percent"),
    "scrap_probability": ("scrap_probability", "scrap_risk_probability"),
    "predicted_scrap_risk": ("predicted_scrap_risk", "risk_level"),
}

# Display labels and units.
SIGNAL_LABELS = {
    "temperature_c": "Temperature",
    "vibration_mm_s": "Vibration",
    "cycle_time_s": "Cycle time",
    "pressure_bar": "Pressure",
    "humidity_percent": "Humidity",
    "operator_experience_years": "Operator experience",
    "machine_id": "Machine",
    "shift": "Shift",
    "material_batch": "Material batch",
}
SIGNAL_UNITS = {
    "temperature_c": "C",
    "vibration_mm_s": "mm/s",
    "cycle_time_s": "s",
    "pressure_bar": "bar",
    "humidity_percent": "%",
    "operator_experience_years": "years",
}
LIMIT_LABELS = {
    "TEMP_MAX_WARNING": "Temperature warning",
    "TEMP_MAX_CRITICAL": "Temperature critical",
    "VIBRATION_MAX_WARNING": "Vibration warning",
    "VIBRATION_MAX_CRITICAL": "Vibration critical",
    "CYCLE_TIME_MAX_WARNING": "Cycle-time warning",
    "CYCLE_TIME_MAX_CRITICAL": "Cycle-time critical",
    "PRESSURE_MIN_WARNING": "Low pressure warning",
    "PRESSURE_MAX_WARNING": "High pressure warning",
    "HUMIDITY_MAX_WARNING": "Humidity warning",
    "LOW_OPERATOR_EXPERIENCE_WARNING": "Operator support warning",
}
SEVERITY_LABELS = {
    "critical": "Critical",
    "high": "Critical",
    "warning": "Warning",
    "medium": "Warning",
    "monitoring": "Monitoring",
    "low": "Monitoring",
    "info": "Informational",
    "informational": "Informational",
}
