"""Data-quality checks of a production table.

All counters of all checks are sums in one aggregation without keys: one scan, no shuffle
beyond one row per task. Only the duplicate check needs the keys exchanged, and it counts
per key on the map side first, so a key repeated in a third of the rows stays cheap.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linewarden.config import production as cfg
from linewarden.functions.rules import any_true
from linewarden.functions.text import LIST_SEPARATOR, as_double, is_missing, rounded

PASS, WARNING, FAIL = "PASS", "WARNING", "FAIL"
SEVERITY = {PASS: 0, WARNING: 1, FAIL: 2}


class DataQualityError(ValueError):
    """A table failed a check that stops the job."""


def _count(condition: Column) -> Column:
    """Rows where the condition is true; null is not."""
    return F.count_if(condition)


def _present(df: DataFrame, columns) -> list[str]:
    return [c for c in columns if c in df.columns]


def _rank(status: Column) -> Column:
    return F.when(status == FAIL, 2).when(status == WARNING, 1).otherwise(0)


def _status(rank: Column) -> Column:
    return F.when(rank >= 2, FAIL).when(rank == 1, WARNING).otherwise(PASS)


def worst_status(statuses: list[Column]) -> Column:
    """The most severe of some statuses; PASS when there are none."""
    return _status(reduce(F.greatest, map(_rank, statuses), F.lit(0)) if statuses else F.lit(0))


def _bad_number(df: DataFrame, name: str) -> Column:
    return ~is_missing(df, name) & as_double(df, name).isNull()


def _bad_category(df: DataFrame, name: str) -> Column:
    value = F.col(name).cast("string")
    return ~is_missing(df, name) & ~value.isin(*cfg.EXPECTED_CATEGORIES[name])


def _bad_target(df: DataFrame) -> Column:
    return ~is_missing(df, cfg.TARGET) & ~F.coalesce(
        as_double(df, cfg.TARGET).isin(0.0, 1.0), F.lit(False)
    )


# --- counters: names and aggregate expressions of one fused pass -----------------------
#
# Counters refer to columns of `_inspected`, where every reading is parsed once; the
# planner drops the ones a check does not count.


def _inspected(df: DataFrame) -> DataFrame:
    looked_at = {}
    for name in _present(df, cfg.PRODUCTION_COLUMNS):
        looked_at[f"is_missing_{name}"] = is_missing(df, name)
    for name in _present(df, (*cfg.NUMERIC, cfg.TARGET)):
        looked_at[f"number_{name}"] = as_double(df, name)
    for name in _present(df, cfg.EXPECTED_CATEGORIES):
        looked_at[f"strange_{name}"] = _bad_category(df, name)
    return df.select(*[column.alias(name) for name, column in looked_at.items()])


def missing_counters(df: DataFrame) -> dict[str, Column]:
    return {
        f"missing_{c}": _count(F.col(f"is_missing_{c}"))
        for c in _present(df, cfg.PRODUCTION_COLUMNS)
    }


def number_counters(df: DataFrame) -> dict[str, Column]:
    return {
        f"invalid_{c}": _count(~F.col(f"is_missing_{c}") & F.col(f"number_{c}").isNull())
        for c in _present(df, cfg.NUMERIC)
    }


def category_counters(df: DataFrame) -> dict[str, Column]:
    return {
        f"unexpected_{c}": _count(F.col(f"strange_{c}"))
        for c in _present(df, cfg.EXPECTED_CATEGORIES)
    }


def target_counters(df: DataFrame) -> dict[str, Column]:
    if cfg.TARGET not in df.columns:
        return {}
    value = F.col(f"number_{cfg.TARGET}")
    valid = F.coalesce(value.isin(0.0, 1.0), F.lit(False))
    return {
        "good_count": _count(value == 0),
        "scrap_count": _count(value == 1),
        "invalid_target": _count(~F.col(f"is_missing_{cfg.TARGET}") & ~valid),
    }


def range_counters(df: DataFrame) -> dict[str, Column]:
    counters = {}
    for name in _present(df, cfg.MONITORING_RANGES):
        low, high = cfg.MONITORING_RANGES[name]
        value = F.col(f"number_{name}")
        counters[f"below_{name}"] = _count(value < low)
        counters[f"above_{name}"] = _count(value > high)
    return counters


def profile(df: DataFrame, *counter_sets: dict[str, Column]) -> DataFrame:
    """One row with the row count and the given counters."""
    counters = {k: v for counters in counter_sets for k, v in counters.items()}
    return _inspected(df).agg(
        F.count(F.lit(1)).alias("row_count"), *[v.alias(k) for k, v in counters.items()]
    )


def _long(wide: DataFrame, rows: list[Column]) -> DataFrame:
    """Rows of a one-row profile, one struct each."""
    return wide.select(F.inline(F.array(*rows)))


# --- statuses from the counters of one profile row -------------------------------------


def _missing_status(name: str) -> Column:
    share = F.try_divide(F.col(f"missing_{name}").cast("double"), F.col("row_count"))
    return (
        F.when(F.col(f"missing_{name}") == 0, PASS)
        .when(share <= cfg.MISSING_SHARE_TOLERATED, WARNING)
        .otherwise(FAIL)
    )


def _flag_status(count: Column, raised: str) -> Column:
    return F.when(count > 0, raised).otherwise(PASS)


def _outside(name: str) -> Column:
    return F.col(f"below_{name}") + F.col(f"above_{name}")


def _scrap_rate() -> Column:
    return F.coalesce(
        F.try_divide(F.col("scrap_count").cast("double"), F.col("row_count")), F.lit(0.0)
    )


def _target_status() -> Column:
    low, high = cfg.SCRAP_RATE_EXPECTED
    unusual = (F.col("row_count") > 0) & ((_scrap_rate() < low) | (_scrap_rate() > high))
    return F.when(F.col("invalid_target") > 0, FAIL).when(unusual, WARNING).otherwise(PASS)


# --- checks as tables -------------------------------------------------------------------


def schema_check(df: DataFrame, required=cfg.PRODUCTION_COLUMNS) -> DataFrame:
    """Missing columns, unexpected columns and an empty table."""
    missing = [c for c in required if c not in df.columns]
    unexpected = [c for c in df.columns if c not in required]

    def row(name: str, status: Column, affected: list[str], rows: Column) -> Column:
        return F.struct(
            F.lit(name).alias("check_name"),
            status.alias("status"),
            F.lit(LIST_SEPARATOR.join(affected)).alias("affected"),
            rows.alias("row_count"),
        )

    rows = F.col("row_count")
    return _long(
        profile(df),
        [
            row("schema_validation", F.lit(FAIL if missing else PASS), missing, rows),
            row("unexpected_columns", F.lit(WARNING if unexpected else PASS), unexpected, rows),
            row("empty_dataset", F.when(rows == 0, FAIL).otherwise(PASS), [], rows),
        ],
    )


def missing_profile(df: DataFrame) -> DataFrame:
    counters = missing_counters(df)
    share = lambda c: F.coalesce(
        F.try_divide(F.col(f"missing_{c}").cast("double"), F.col("row_count")), F.lit(0.0)
    )
    return _long(
        profile(df, counters),
        [
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"missing_{c}").alias("missing_count"),
                rounded(share(c), 4).alias("missing_percentage"),
                _missing_status(c).alias("status"),
            )
            for c in _present(df, cfg.PRODUCTION_COLUMNS)
        ],
    )


def numeric_validity(df: DataFrame) -> DataFrame:
    return _long(
        profile(df, number_counters(df)),
        [
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"invalid_{c}").alias("invalid_count"),
                _flag_status(F.col(f"invalid_{c}"), FAIL).alias("status"),
            )
            for c in _present(df, cfg.NUMERIC)
        ],
    )


def target_profile(df: DataFrame) -> DataFrame:
    return profile(df, target_counters(df)).select(
        F.col("row_count").alias("total_rows"),
        "good_count",
        "scrap_count",
        rounded(_scrap_rate(), 4).alias("scrap_rate"),
        "invalid_target",
        _target_status().alias("status"),
    )


def range_violations(df: DataFrame) -> DataFrame:
    return _long(
        profile(df, range_counters(df)),
        [
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(float(cfg.MONITORING_RANGES[c][0])).alias("minimum"),
                F.lit(float(cfg.MONITORING_RANGES[c][1])).alias("maximum"),
                F.col(f"below_{c}").alias("below_range_count"),
                F.col(f"above_{c}").alias("above_range_count"),
                _outside(c).alias("outside_range_count"),
                _flag_status(_outside(c), WARNING).alias("status"),
            )
            for c in _present(df, cfg.MONITORING_RANGES)
        ],
    )


def _bad_values(df: DataFrame, bad: dict[str, Column]) -> DataFrame:
    """(column_name, value, row_count) of every distinct bad value.

    Rows without any bad value are dropped before the columns are unfolded, and counts
    are combined on the map side, so frequent junk does not travel.
    """
    cells = [
        F.struct(
            F.lit(c).alias("column_name"), F.when(flag, F.col(c).cast("string")).alias("value")
        )
        for c, flag in bad.items()
    ]
    return (
        df.filter(any_true(list(bad.values())))
        .select(F.inline(F.array(*cells)))
        .filter(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def invalid_examples(df: DataFrame, columns=cfg.NUMERIC, limit: int = 5) -> DataFrame:
    """Up to `limit` distinct unreadable values per numeric column, smallest first."""
    bad = {c: _bad_number(df, c) for c in _present(df, columns)}
    order = Window.partitionBy("column_name").orderBy("value")
    return (
        _bad_values(df, bad)
        .withColumn("example_rank", F.row_number().over(order))
        .filter(F.col("example_rank") <= limit)
    )


def invalid_target_examples(df: DataFrame, limit: int = 10) -> DataFrame:
    """Up to `limit` distinct target values other than 0 and 1, smallest first."""
    return _bad_values(df, {cfg.TARGET: _bad_target(df)}).orderBy("value").limit(limit)


def unexpected_categories(df: DataFrame) -> DataFrame:
    """Every category value outside the expected ones, with its row count."""
    return _bad_values(
        df, {c: _bad_category(df, c) for c in _present(df, cfg.EXPECTED_CATEGORIES)}
    )


def duplicate_keys(df: DataFrame, key: str = cfg.KEY) -> DataFrame:
    """Keys held by more than one row; null counts as a value."""
    return (
        df.groupBy(F.col(key).cast("string").alias(key))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .filter(F.col("row_count") > 1)
    )


def duplicate_summary(df: DataFrame, key: str = cfg.KEY, limit: int = 10) -> DataFrame:
    """Rows and groups with a repeated key, and the `limit` smallest such keys."""
    repeated = duplicate_keys(df, key)
    examples = (
        repeated.select(F.coalesce(F.col(key), F.lit("nan")).alias("example"))
        .orderBy("example")
        .limit(limit)
        .agg(F.array_join(F.array_sort(F.collect_list("example")), LIST_SEPARATOR))
    )
    return repeated.agg(
        F.coalesce(F.sum("row_count"), F.lit(0).cast("long")).alias("duplicate_row_count"),
        F.count(F.lit(1)).alias("duplicate_group_count"),
    ).select(
        "duplicate_row_count",
        "duplicate_group_count",
        examples.scalar().alias("duplicate_examples"),
    )


# --- whole report ------------------------------------------------------------------------


def _named_where(pairs: list[tuple[str, Column]]) -> Column:
    return F.concat_ws(LIST_SEPARATOR, *[F.when(flag, F.lit(name)) for name, flag in pairs])


def quality_report(df: DataFrame) -> DataFrame:
    """Every check in fixed order with its status, and the overall status."""
    return quality_rows(df).drop("scrap_rate")


def quality_counters(df: DataFrame) -> DataFrame:
    """One row: the row count and every counter that the quality report depends on but the repeated keys."""
    return profile(
        df,
        missing_counters(df),
        number_counters(df),
        target_counters(df),
        category_counters(df),
        range_counters(df),
    )


def quality_rows(df: DataFrame) -> DataFrame:
    """The quality report with the scrap rate of the same profile beside each check.

    The profile row takes the duplicate count in as a scalar subquery; all statuses are
    then expressions over that one row.
    """
    wide = quality_counters(df)
    if cfg.KEY in df.columns:
        wide = wide.select("*", repeated_rows(duplicate_keys(df)).scalar().alias("duplicates"))
    return status_rows(wide, df.columns)


def repeated_rows(repeated: DataFrame) -> DataFrame:
    """One row: how many rows hold these repeated keys."""
    return repeated.agg(F.coalesce(F.sum("row_count"), F.lit(0).cast("long")).alias("duplicates"))


def status_rows(wide: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The quality report of a table with these columns from the one row of its counters."""
    missing = [c for c in cfg.PRODUCTION_COLUMNS if c not in columns]
    unexpected = [c for c in columns if c not in cfg.PRODUCTION_COLUMNS]
    required, numeric, categories, ranged = (
        [c for c in names if c in columns]
        for names in (cfg.PRODUCTION_COLUMNS, cfg.NUMERIC, cfg.EXPECTED_CATEGORIES, cfg.MONITORING_RANGES)
    )
    has_target, has_key = cfg.TARGET in columns, cfg.KEY in columns

    missing_flags = [(c, F.col(f"missing_{c}") > 0) for c in required]
    number_flags = [(c, F.col(f"invalid_{c}") > 0) for c in numeric]
    category_flags = [(c, F.col(f"unexpected_{c}") > 0) for c in categories]
    range_flags = [(c, _outside(c) > 0) for c in ranged]

    def raised(pairs: list[tuple[str, Column]], status: str) -> Column:
        return F.when(any_true([flag for _, flag in pairs]), status).otherwise(PASS)

    checks: list[tuple[str, Column, Column]] = [
        (
            "schema_validation",
            F.lit(FAIL if missing else PASS),
            F.lit(LIST_SEPARATOR.join(missing)),
        ),
        (
            "unexpected_columns",
            F.lit(WARNING if unexpected else PASS),
            F.lit(LIST_SEPARATOR.join(unexpected)),
        ),
        ("empty_dataset", F.when(F.col("row_count") == 0, FAIL).otherwise(PASS), F.lit("")),
        (
            "missing_values",
            worst_status([_missing_status(c) for c in required]),
            _named_where(missing_flags),
        ),
        ("numeric_type_validation", raised(number_flags, FAIL), _named_where(number_flags)),
        (
            "target_validation",
            _target_status() if has_target else F.lit(FAIL),
            _named_where([(cfg.TARGET, F.col("invalid_target") > 0)])
            if has_target
            else F.lit(cfg.TARGET),
        ),
        (
            "categorical_validation",
            raised(category_flags, WARNING),
            _named_where(category_flags),
        ),
        ("engineering_plausibility", raised(range_flags, WARNING), _named_where(range_flags)),
    ]
    if has_key:
        checks.append(
            (
                "duplicate_part_id",
                _flag_status(F.col("duplicates"), WARNING),
                _named_where([(cfg.KEY, F.col("duplicates") > 0)]),
            )
        )
    rate = rounded(_scrap_rate(), 4) if has_target else F.lit(None).cast("double")
    wide = wide.select(
        "row_count", rate.alias("scrap_rate"), *[s.alias(f"status_{n}") for n, s, _ in checks],
        *[a.alias(f"affected_{n}") for n, _, a in checks],
    )
    overall = worst_status([F.col(f"status_{n}") for n, _, _ in checks])
    return _long(
        wide,
        [
            F.struct(
                F.lit(position).alias("check_order"),
                F.lit(name).alias("check_name"),
                F.col(f"status_{name}").alias("status"),
                F.col(f"affected_{name}").alias("affected"),
                F.col("row_count"),
                overall.alias("overall_status"),
                F.col("scrap_rate"),
            )
            for position, (name, _, _) in enumerate(checks, start=1)
        ],
    )


# --- gates --------------------------------------------------------------------------------


def unreadable_counters(df: DataFrame, columns) -> dict[str, Column]:
    """Unreadable numbers of each column, as aggregates over the table itself."""
    return {f"invalid_{c}": _count(_bad_number(df, c)) for c in columns}


def blocking_counters(df: DataFrame) -> dict[str, Column]:
    """What the failing statuses of the quality report depend on, as aggregates over the table itself."""
    missing = {f"missing_{c}": _count(is_missing(df, c)) for c in cfg.PRODUCTION_COLUMNS}
    return {**missing, **unreadable_counters(df, cfg.NUMERIC), "invalid_target": _count(_bad_target(df))}


def blocking_findings() -> tuple[tuple[str, Column], ...]:
    """Texts of the failing checks of the quality report and when they apply, over `row_count` and these counters."""
    return (
        *[(f"missing_values ({c})", _missing_status(c) == FAIL) for c in cfg.PRODUCTION_COLUMNS],
        *[(f"numeric_type_validation ({c})", F.col(f"invalid_{c}") > 0) for c in cfg.NUMERIC],
        (f"target_validation ({cfg.TARGET})", F.col("invalid_target") > 0),
    )


def require_quality(df: DataFrame) -> DataFrame:
    """The table itself, unless a check fails."""
    failed = quality_report(df).filter(F.col("status") == FAIL).collect()
    if failed:
        reasons = ", ".join(f"{r.check_name} ({r.affected})" for r in failed)
        raise DataQualityError(f"Validation failed: {reasons}")
    return df


def require_columns(df: DataFrame, columns, label: str) -> None:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise DataQualityError(f"{label} lacks required columns: {', '.join(absent)}")


def require_numbers(df: DataFrame, columns, label: str, limit: int = 5) -> None:
    """Refuse a table with unreadable numbers, naming a few of them."""
    examples = invalid_examples(df, columns, limit).collect()  # at most limit per column
    if examples:
        shown = ", ".join(f"{r.column_name}={r.value!r}" for r in examples)
        raise DataQualityError(f"{label} has non-numeric values: {shown}")


def scoring_warnings(df: DataFrame) -> DataFrame:
    """Non-blocking findings of a scoring batch: one row per value or range."""
    strange = unexpected_categories(df).select(
        "column_name",
        F.concat("column_name", F.lit(" has unexpected category: "), "value").alias("warning"),
        "row_count",
    )
    text = lambda c: f" values outside monitoring range {cfg.MONITORING_RANGES[c][0]} to {cfg.MONITORING_RANGES[c][1]}"  # noqa: E731,E501
    ranged = _long(
        profile(df, range_counters(df)),
        [
            F.struct(
                F.lit(c).alias("column_name"),
                F.concat(F.lit(c + " has "), _outside(c).cast("string"), F.lit(text(c))).alias(
                    "warning"
                ),
                _outside(c).alias("row_count"),
            )
            for c in _present(df, cfg.MONITORING_RANGES)
        ],
    ).filter(F.col("row_count") > 0)
    return strange.unionByName(ranged)
