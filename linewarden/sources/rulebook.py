"""Load cause rules and engineering limits and check them before any job starts.

The result is a handful of frozen records on the driver. Operators turn them into
Column expressions, so a rule costs nothing at run time beyond its comparison.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass
from pathlib import Path

from linewarden.config import rules as defaults

CAUSE_OPERATORS = (">", ">=", "<", "<=")
LIMIT_OPERATORS = ("<=", "<", ">=", ">", "==", "!=")
CAUSE_SEVERITIES = ("high", "medium", "low")  # strongest first
LIMIT_SEVERITIES = ("info", "warning", "critical")


class ConfigError(ValueError):
    """A rule or limit is incomplete or uses an unsupported value."""


@dataclass(frozen=True)
class Cause:
    """A suspected driver as it is reported for a row."""

    driver: str
    severity: str
    evidence: str
    interpretation: str
    recommendation: str | None = None


@dataclass(frozen=True)
class CauseRule:
    id: str
    column: str
    operator: str | None
    value: float | None
    values: tuple[str, ...]
    cause: Cause

    @property
    def is_numeric(self) -> bool:
        return self.operator is not None


@dataclass(frozen=True)
class CauseRules:
    rules: tuple[CauseRule, ...]
    fallback: Cause | None
    default_recommendation: str

    @property
    def ranked(self) -> tuple[CauseRule, ...]:
        """Rules in reporting order: severity first, configuration order second."""
        return tuple(
            sorted(self.rules, key=lambda r: CAUSE_SEVERITIES.index(r.cause.severity))
        )


@dataclass(frozen=True)
class Limit:
    id: str
    parameter: str
    operator: str
    value: float
    severity: str
    requirement_text: str
    rationale: str = ""
    action: str = ""


def _read_mapping(source: str | Path | Mapping) -> Mapping:
    if isinstance(source, Mapping):
        return source
    path = Path(source)
    if not path.exists():
        raise FileNotFoundError(f"No configuration at {path}")
    text = path.read_text(encoding="utf-8")
    if path.suffix.lower() == ".json":
        loaded = json.loads(text)
    else:
        import yaml  # optional dependency, needed for YAML files only

        loaded = yaml.safe_load(text)
    if not isinstance(loaded, Mapping):
        raise ConfigError(f"{path} must hold a mapping")
    return loaded


def _require(entry, fields: tuple[str, ...], what: str) -> None:
    if not isinstance(entry, Mapping):
        raise ConfigError(f"{what} must be a mapping")
    absent = [f for f in fields if f not in entry]
    if absent:
        raise ConfigError(f"{what} lacks required fields: {', '.join(absent)}")


def _number(entry: Mapping, what: str) -> float:
    try:
        return float(entry.get("value"))
    except (TypeError, ValueError) as error:
        raise ConfigError(f"{what} needs a numeric value") from error


def _cause(entry: Mapping, recommendation: str | None) -> Cause:
    return Cause(
        driver=entry["driver"],
        severity=entry["severity"],
        evidence=entry["evidence"],
        interpretation=entry["engineering_interpretation"],
        recommendation=recommendation,
    )


def load_cause_rules(source: str | Path | Mapping | None = None) -> CauseRules:
    """Cause rules from a YAML or JSON file, a mapping, or the built-in defaults.

    A recommendation belongs to a driver name: when several rules name the same driver,
    the last one (and the fallback after all rules) decides.
    """
    document = (
        {
            "rules": defaults.CAUSE_RULES,
            "fallback": {"high_risk_no_driver": defaults.CAUSE_FALLBACK},
            "default_recommendation": defaults.DEFAULT_RECOMMENDATION,
        }
        if source is None
        else _read_mapping(source)
    )
    entries = document.get("rules")
    if not isinstance(entries, (list, tuple)):
        raise ConfigError("Cause rules need a 'rules' list")
    fields = (
        "id", "column", "type", "driver", "severity", "evidence", "engineering_interpretation",
    )
    for position, entry in enumerate(entries, start=1):
        _require(entry, fields, f"Cause rule {position}")
        what = f"Cause rule '{entry['id']}'"
        if entry["type"] == "numeric_threshold":
            if entry.get("operator") not in CAUSE_OPERATORS:
                raise ConfigError(f"{what} has an unsupported operator")
            _number(entry, what)
        elif entry["type"] == "categorical_match":
            if not isinstance(entry.get("values"), (list, tuple)) or not entry["values"]:
                raise ConfigError(f"{what} needs a non-empty list of values")
        else:
            raise ConfigError(f"{what} has the unsupported type '{entry['type']}'")
        if entry["severity"] not in CAUSE_SEVERITIES:
            raise ConfigError(f"{what} has an unsupported severity")

    fallbacks = document.get("fallback") or {}
    if not isinstance(fallbacks, Mapping):
        raise ConfigError("'fallback' must be a mapping")
    fallback = fallbacks.get("high_risk_no_driver")

    advice = {entry["driver"]: entry.get("recommendation") for entry in entries}
    if fallback:
        advice[fallback["driver"]] = fallback.get("recommendation")

    return CauseRules(
        rules=tuple(
            CauseRule(
                id=entry["id"],
                column=entry["column"],
                operator=entry["operator"] if entry["type"] == "numeric_threshold" else None,
                value=_number(entry, "") if entry["type"] == "numeric_threshold" else None,
                values=tuple(str(v) for v in entry.get("values") or ()),
                cause=_cause(entry, advice[entry["driver"]]),
            )
            for entry in entries
        ),
        fallback=_cause(fallback, advice[fallback["driver"]]) if fallback else None,
        default_recommendation=document.get(
            "default_recommendation", defaults.DEFAULT_RECOMMENDATION
        ),
    )


def load_limits(source: str | Path | Mapping | None = None) -> tuple[Limit, ...]:
    """Engineering limits from a YAML or JSON file, a mapping, or the built-in defaults."""
    document = {"requirements": defaults.LIMITS} if source is None else _read_mapping(source)
    entries = document.get("requirements")
    if not isinstance(entries, (list, tuple)) or not entries:
        raise ConfigError("Limits need a non-empty 'requirements' list")
    fields = ("id", "parameter", "type", "operator", "value", "severity", "requirement_text")
    limits = []
    for position, entry in enumerate(entries, start=1):
        _require(entry, fields, f"Limit {position}")
        what = f"Limit '{entry['id']}'"
        severity = str(entry["severity"]).lower()
        if entry["type"] != "numeric_limit":
            raise ConfigError(f"{what} has the unsupported type '{entry['type']}'")
        if entry["operator"] not in LIMIT_OPERATORS:
            raise ConfigError(f"{what} has the unsupported operator '{entry['operator']}'")
        if severity not in LIMIT_SEVERITIES:
            raise ConfigError(f"{what} has the unsupported severity '{entry['severity']}'")
        limits.append(
            Limit(
                id=entry["id"],
                parameter=entry["parameter"],
                operator=entry["operator"],
                value=_number(entry, what),
                severity=severity,
                requirement_text=entry["requirement_text"],
                rationale=entry.get("engineering_rationale") or "",
                action=entry.get("recommended_action") or "",
            )
        )
    return tuple(limits)
