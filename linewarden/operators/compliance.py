"""Check production rows against engineering limits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linewarden.config.production import (
    LIMIT_LABELS,
    SEVERITY_LABELS,
    SIGNAL_LABELS,
    SIGNAL_UNITS,
)
from linewarden.functions.rules import (
    WORD,
    count_true,
    limit_broken,
    list_of_true,
    pack,
    packed_count,
    packed_text,
)
from linewarden.functions.text import LIST_SEPARATOR, as_double, general_number, split_list
from linewarden.operators.validation import require_columns, require_numbers
from linewarden.sources.rulebook import Limit, load_limits

CRITICAL, WARNED, COMPLIANT = "CRITICAL_VIOLATION", "WARNING_VIOLATION", "COMPLIANT"
STATUSES = (COMPLIANT, WARNED, CRITICAL)


def require_parameters(df: DataFrame, limits: Sequence[Limit]) -> None:
    """Refuse a table without, or with unreadable, configured parameters."""
    parameters = sorted({limit.parameter for limit in limits})
    require_columns(df, parameters, "Input")
    require_numbers(df, parameters, "Input")


def _flags(df: DataFrame, limits: Sequence[Limit]) -> list[tuple[Limit, Column]]:
    return [(limit, limit_broken(df, limit)) for limit in limits]


def spec_flags(df: DataFrame, limits: Sequence[Limit] | None = None) -> dict[str, Column]:
    """One boolean column per limit, named after it."""
    return {limit.id: flag for limit, flag in _flags(df, limits or load_limits())}


def violations(df: DataFrame, limits: Sequence[Limit] | None = None) -> Column:
    """The violated limits of a row, in configuration order, as an array of structs."""
    return list_of_true(
        [
            (
                flag,
                F.struct(
                    F.lit(limit.id).alias("requirement_id"),
                    F.lit(limit.parameter).alias("parameter"),
                    as_double(df, limit.parameter).alias("actual_value"),
                    F.lit(limit.operator).alias("operator"),
                    F.lit(limit.value).alias("limit_value"),
                    F.lit(limit.severity).alias("severity"),
                    F.lit(limit.requirement_text).alias("requirement_text"),
                    F.lit(limit.rationale).alias("engineering_rationale"),
                    F.lit(limit.action).alias("recommended_action"),
                ),
            )
            for limit, flag in _flags(df, limits or load_limits())
        ]
    )


def compliance_status(critical: Column, warned: Column) -> Column:
    return F.when(critical, CRITICAL).when(warned, WARNED).otherwise(COMPLIANT)


def with_compliance(df: DataFrame, limits: Sequence[Limit] | None = None) -> DataFrame:
    """Status, counts and texts of the violated limits of every row.

    Packed flags and number texts are columns of their own first, so that each is worked
    out once however many texts use it.
    """
    limits = limits or load_limits()
    parameters = list(dict.fromkeys(limit.parameter for limit in limits))
    words = pack([limit_broken(df, limit) for limit in limits])
    staged = df.withColumns(
        {
            **{f"_word{i}": word for i, word in enumerate(words)},
            **{
                f"_text{i}": general_number(as_double(df, parameter))
                for i, parameter in enumerate(parameters)
            },
        }
    )
    words = [F.col(f"_word{i}") for i in range(len(words))]
    critical = packed_count(words, [limit.severity == "critical" for limit in limits])
    warned = packed_count(words, [limit.severity == "warning" for limit in limits])
    sentences = [
        F.when(
            words[i // WORD].bitwiseAND(1 << i % WORD) != 0,
            F.concat(
                F.lit(f"{limit.id}: {limit.parameter}="),
                F.col(f"_text{parameters.index(limit.parameter)}"),
                F.lit(f" does not satisfy {limit.operator} {limit.value:g}"),
            ),
        )
        for i, limit in enumerate(limits)
    ]
    return staged.select(
        *df.columns,
        compliance_status(critical > 0, warned > 0).alias("spec_compliance_status"),
        packed_count(words).alias("violation_count"),
        critical.alias("critical_violation_count"),
        warned.alias("warning_violation_count"),
        packed_text(words, [limit.id for limit in limits]).alias("violated_requirement_ids"),
        F.concat_ws(LIST_SEPARATOR, *sentences).alias("violation_summary"),
        packed_text(words, [limit.action for limit in limits]).alias("recommended_actions"),
    )


def _limit_sums(
    df: DataFrame, limits: Sequence[Limit]
) -> tuple[list[Column], list[Column]]:
    """Conditional sums of the rows violating each limit, and a record of each over those sums.

    A limit id used twice counts under its last definition.
    """
    flags = _flags(df, limits)
    last = {limit.id: limit for limit, _ in flags}
    sums = [
        F.coalesce(
            F.sum(count_true([f for limit, f in flags if limit.id == limit_id]).cast("long")),
            F.lit(0).cast("long"),
        ).alias(f"n{i}")
        for i, limit_id in enumerate(last)
    ]
    records = [
        F.struct(
            F.lit(limit.id).alias("requirement_id"),
            F.lit(limit.parameter).alias("parameter"),
            F.lit(limit.severity).alias("severity"),
            F.col(f"n{i}").alias("violation_count"),
        )
        for i, limit in enumerate(last.values())
    ]
    return sums, records


def violation_counts(df: DataFrame, limits: Sequence[Limit] | None = None) -> DataFrame:
    """Rows violating each limit, most frequent first; limits never violated are left out.

    One fused pass of conditional sums; the attributes ride along as literals, so there is
    neither an explode nor a join.
    """
    sums, records = _limit_sums(df, limits or load_limits())
    return (
        df.agg(*sums)
        .select(F.inline(F.array(*records)))
        .filter(F.col("violation_count") > 0)
        .orderBy(F.desc("violation_count"), "requirement_id")
    )


def compliance_totals(df: DataFrame, limits: Sequence[Limit] | None = None) -> DataFrame:
    """One row from one aggregate: rows, rows per status, and the violated limits, most frequent first."""
    limits = limits or load_limits()
    checked = with_compliance(df, limits)
    sums, records = _limit_sums(checked, limits)
    status = F.col("spec_compliance_status")
    ordered = F.array_sort(
        F.transform(
            F.filter(F.array(*records), lambda r: r["violation_count"] > 0),
            lambda r: F.struct(
                (-r["violation_count"]).alias("order"), r["requirement_id"].alias("requirement_id"),
                r["parameter"].alias("parameter"), r["severity"].alias("severity"),
                r["violation_count"].alias("violation_count"),
            ),
        )
    )
    return checked.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(status == s).alias(s.lower()) for s in STATUSES],
        *sums,
    ).select(
        "row_count",
        *[s.lower() for s in STATUSES],
        F.lit(len(limits)).alias("requirement_count"),
        ordered.alias("violations_by_requirement"),
    )


def top_violated(df: DataFrame, limits: Sequence[Limit] | None = None) -> DataFrame:
    return violation_counts(df, limits).limit(1)


def critical_records(checked: DataFrame) -> DataFrame:
    """Rows with a critical violation and the ids of all their violated limits."""
    return checked.filter(F.col("spec_compliance_status") == CRITICAL).select(
        "part_id",
        "critical_violation_count",
        split_list(F.col("violated_requirement_ids")).alias("violated_requirement_ids"),
    )


def _title(name: str) -> str:
    return " ".join(w.capitalize() for w in name.replace("_", " ").replace("-", " ").split())


def limit_label(limit_id: str) -> str:
    return LIMIT_LABELS.get(limit_id) or (_title(limit_id) if limit_id else "Not specified")


def signal_label(column: str) -> str:
    return SIGNAL_LABELS.get(column) or (_title(column) if column else "Not specified")


def severity_label(severity: str) -> str:
    known = str(severity or "").strip().lower()
    return SEVERITY_LABELS.get(known) or (signal_label(known) if known else "Informational")


def limits_table(spark, limits: Sequence[Limit] | None = None) -> DataFrame:
    """The limits as a small dimension table with display labels."""
    return spark.createDataFrame(
        [
            (
                limit.id,
                limit_label(limit.id),
                limit.parameter,
                signal_label(limit.parameter),
                severity_label(limit.severity),
                SIGNAL_UNITS.get(limit.parameter, ""),
            )
            for limit in {limit.id: limit for limit in limits or load_limits()}.values()
        ],
        "requirement_id string, label string, signal string, signal_label string, "
        "severity_label string, signal_unit string",
    )


def violation_facts(
    df: DataFrame, limits: Sequence[Limit] | None = None, key: str = "part_id"
) -> DataFrame:
    """One row per record and violated limit, labelled.

    The dimension has one row per configured limit, which bounds the broadcast.
    """
    facts = df.select(key, F.inline(violations(df, limits))).select(
        key, "requirement_id", "actual_value", "operator", "limit_value"
    )
    labels = F.broadcast(limits_table(df.sparkSession, limits))
    return facts.join(labels, "requirement_id")
