"""Check a batch against engineering limits and summarise the violations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from linewarden.operators.compliance import (
    compliance_totals,
    require_parameters,
    with_compliance,
)
from linewarden.operators.summary import value_counts
from linewarden.sources.rulebook import Limit, load_limits
from linewarden.sources.tables import require_rows


def spec_compliance(df: DataFrame, limits: Sequence[Limit] | None = None) -> DataFrame:
    """Row-level results after the input gate."""
    limits = limits or load_limits()
    require_rows(df, "Input")
    require_parameters(df, limits)
    return with_compliance(df, limits)


def compliance_counts(checked: DataFrame) -> DataFrame:
    return value_counts(checked, "spec_compliance_status")


def compliance_summary(df: DataFrame, limits: Sequence[Limit] | None = None) -> DataFrame:
    """One row: totals, rows per status, and violations per limit as an array."""
    return compliance_totals(df, limits)
