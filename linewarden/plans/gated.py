"""Jobs whose input gate is measured in the very pass that writes the result."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from linewarden.config import production as shape
from linewarden.operators import validation as quality
from linewarden.operators.compliance import with_compliance
from linewarden.sources.rulebook import Limit, load_limits
from linewarden.sources.tables import EmptyTableError, move_table, remove_table, write_rows

ROWS = "row_count"


@dataclass(frozen=True)
class Gate:
    """Counters over the input, and the refusals that follow from them as conditions over the counters."""

    label: str
    counters: dict[str, Column]
    refusals: tuple[tuple[str, Column], ...]


def numbers_gate(df: DataFrame, columns: Sequence[str], label: str) -> Gate:
    """Refuses an input without the columns at once, and one with unreadable numbers in them when it is read."""
    quality.require_columns(df, columns, label)
    counters = quality.unreadable_counters(df, columns)
    refusals = [(f"{c} has non-numeric values", F.col(f"invalid_{c}") > 0) for c in columns]
    return Gate(label, counters, tuple(refusals))


def quality_gate(df: DataFrame, label: str = "Production table") -> Gate:
    """What makes the quality report fail: missing columns at once; missing shares, numbers and targets when read."""
    quality.require_columns(df, shape.PRODUCTION_COLUMNS, label)
    return Gate(label, quality.blocking_counters(df), quality.blocking_findings())


def write_gated(df: DataFrame, result: Callable[[DataFrame], DataFrame], path: str, gate: Gate, fmt: str = "parquet") -> None:
    """Write result(df) to `path` if the gate holds for `df`, in one pass over it; else raise and leave `path` as it was.

    Rows go to a table beside `path` first, which takes its place once the counters are known to be right: readers of
    `path` see the old table or the whole new one. An empty input is refused. `result` must read its input once and
    whole. The counters are one row, whatever the size of the input, and tasks that run again don't count twice.
    """
    spark, seen = df.sparkSession, Observation(f"gate-{uuid.uuid4().hex}")
    counted = [F.count(F.lit(1)).alias(ROWS), *[c.alias(name) for name, c in gate.counters.items()]]
    staged = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}"
    try:
        write_rows(result(df.observe(seen, *counted)), staged, fmt)
        measured = seen.get
        if not measured.get(ROWS):
            raise EmptyTableError(f"{gate.label} has zero rows")
        found = refused(df, gate, measured)
        if found:
            raise quality.DataQualityError(f"{gate.label}: {', '.join(found)}")
        move_table(spark, staged, path)
    finally:
        remove_table(spark, staged)


def refused(df: DataFrame, gate: Gate, measured: dict[str, int]) -> list[str]:
    """Texts of the refusals that apply to measured counters."""
    row = df.sparkSession.range(1).select(*[F.lit(v).cast("long").alias(k) for k, v in measured.items()])
    answers = row.select(*[when.alias(f"r{i}") for i, (_, when) in enumerate(gate.refusals)]).first()
    return [text for (text, _), applies in zip(gate.refusals, answers, strict=True) if applies]


def write_compliance(df: DataFrame, path: str, limits: Sequence[Limit] | None = None, fmt: str = "parquet") -> None:
    """The limit check of a batch as a stored table; refuses as `spec_compliance` does, but reads the batch once."""
    limits = limits or load_limits()
    gate = numbers_gate(df, sorted({limit.parameter for limit in limits}), "Input")
    write_gated(df, lambda rows: with_compliance(rows, limits), path, gate, fmt)
