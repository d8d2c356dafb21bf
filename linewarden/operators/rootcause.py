"""Rule-based root cause analysis: suspected drivers, advice and a summary sentence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linewarden.config import risk as cfg
from linewarden.config.production import COLUMN_ALIASES
from linewarden.functions.rules import (
    any_true,
    cause_fires,
    configured_number,
    configured_text,
    list_of_true,
    pack,
    packed_count,
    packed_text,
    physical_columns,
    text_of_true,
)
from linewarden.functions.text import (
    LIST_SEPARATOR,
    drivers_in_summary,
    fixed_decimals,
    percent_text,
    split_list,
    stripped,
    title_case,
)
from linewarden.sources.rulebook import Cause, CauseRules, load_cause_rules

SHOWN_DRIVERS = 3
# Joins driver names inside one expression; never part of a result.
MARK = "\u0001"


def row_risk(df: DataFrame, level: Column | None = None) -> Column:
    """`high`, `medium`, `low` or `unknown` from a given level, else from the probability."""
    number = configured_number(df, COLUMN_ALIASES["scrap_probability"][0])
    by_probability = (
        F.when(number.isNull(), "unknown")
        .when(number >= 0.60, "high")
        .when(number >= 0.30, "medium")
        .otherwise("low")
    )
    if level is None:
        label_name = COLUMN_ALIASES["predicted_scrap_risk"][0]
        if not physical_columns(df, label_name):
            return by_probability
        level = configured_text(df, label_name)
    else:
        level = F.lower(stripped(level))
    return F.when(level.isin("high", "medium", "low"), level).otherwise(by_probability)


def _ranked_causes(
    df: DataFrame, rules: CauseRules, risk: Column
) -> list[tuple[Column, Cause]]:
    """Every possible driver in reporting order with the flag that it applies."""
    fired = [(cause_fires(df, rule), rule.cause) for rule in rules.ranked]
    if rules.fallback is not None:
        nothing = ~any_true([flag for flag, _ in fired])
        fired.append(((risk == "high") & nothing, rules.fallback))
    return fired


def cause_flags(df: DataFrame, rules: CauseRules | None = None) -> dict[str, Column]:
    """One boolean column per rule in reporting order, named after the rule."""
    return {rule.id: cause_fires(df, rule) for rule in (rules or load_cause_rules()).ranked}


def suspected_drivers(
    df: DataFrame, rules: CauseRules | None = None, level: Column | None = None
) -> Column:
    """Drivers of a row in reporting order as an array of structs."""
    rules = rules or load_cause_rules()
    return list_of_true(
        [
            (
                flag,
                F.struct(
                    F.lit(cause.driver).alias("driver"),
                    F.lit(cause.severity).alias("severity"),
                    F.lit(cause.evidence).alias("evidence"),
                    F.lit(cause.interpretation).alias("engineering_interpretation"),
                ),
            )
            for flag, cause in _ranked_causes(df, rules, row_risk(df, level))
        ]
    )


def _summary(risk: Column, count: Column, shown: Column) -> Column:
    """The sentence naming the shown drivers (at most three, joined by `MARK`)."""
    head = F.replace(F.substring_index(shown, MARK, SHOWN_DRIVERS - 1), F.lit(MARK), F.lit(", "))
    named = (
        F.when(count == 1, shown)
        .when(count == 2, F.replace(shown, F.lit(MARK), F.lit(" and ")))
        .otherwise(F.concat(head, F.lit(", and "), F.substring_index(shown, MARK, -1)))
    )
    phrase = F.when(risk == "unknown", "").otherwise(F.concat(risk, F.lit(" ")))
    return (
        F.when(
            count > 0,
            F.concat(
                F.lit("The batch shows "), phrase, F.lit("scrap risk mainly due to "),
                F.lower(named), F.lit("."),
            ),
        )
        .when(
            risk.isin("low", "unknown"),
            "No configured root cause driver was detected for this batch.",
        )
        .otherwise(
            F.concat(
                F.lit("The batch has "), risk,
                F.lit(
                    " predicted scrap risk, but no configured process driver was detected."
                ),
            )
        )
    )


def with_root_causes(
    df: DataFrame,
    rules: CauseRules | None = None,
    level: Column | None = None,
    where: Column | None = None,
) -> DataFrame:
    """Summary, driver count, top drivers and advice of every row.

    Three short projections, each building on columns of the one before: packed flags,
    then the drivers they stand for, then the texts. With `where`, rows outside the
    condition get empty texts and no drivers, and skip the text work.
    """
    rules = rules or load_cause_rules()
    ranked = rules.ranked
    words = pack([cause_fires(df, rule) for rule in ranked])
    asked = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    packed = df.withColumns(
        {
            "_risk": row_risk(df, level),
            "_asked": asked,
            **{f"_word{i}": word for i, word in enumerate(words)},
        }
    )
    words = [F.col(f"_word{i}") for i in range(len(words))]
    causes = [rule.cause for rule in ranked]
    names = packed_names = packed_text(words, [c.driver for c in causes], MARK, distinct=False)
    advice = packed_text(words, [cause.recommendation for cause in causes])
    count = packed_count(words)
    if rules.fallback is not None:
        alone = (F.col("_risk") == "high") & (count == 0)
        names = F.when(alone, rules.fallback.driver).otherwise(packed_names)
        advice = F.when(alone, rules.fallback.recommendation or "").otherwise(advice)
        count = F.when(alone, 1).otherwise(count)
    drivers = packed.withColumns(
        {
            "_count": F.when(F.col("_asked"), count).otherwise(0),
            "_shown": F.when(F.col("_asked"), F.substring_index(names, MARK, SHOWN_DRIVERS))
            .otherwise(""),
            "_advice": F.when(F.col("_asked"), advice),
        }
    )
    texts = {
        "root_cause_summary": F.when(
            F.col("_asked"), _summary(F.col("_risk"), F.col("_count"), F.col("_shown"))
        ).otherwise(""),
        "suspected_driver_count": F.col("_count"),
        "top_suspected_drivers": F.replace("_shown", F.lit(MARK), F.lit(LIST_SEPARATOR)),
        "engineering_recommendations": F.when(
            F.col("_advice") == "", rules.default_recommendation
        ).otherwise(F.coalesce("_advice", F.lit(""))),
    }
    kept = [c for c in df.columns if c not in texts]
    return drivers.select(*kept, *[text.alias(name) for name, text in texts.items()])


def with_flagged_causes(
    df: DataFrame, threshold: float, rules: CauseRules | None = None
) -> DataFrame:
    """Summary and advice for rows at or above the threshold, empty text for the others."""
    flagged = F.col("scrap_probability") >= threshold
    return with_root_causes(df, rules, where=flagged).drop(
        "suspected_driver_count", "top_suspected_drivers"
    )


def part_advice(probability: Column) -> list[tuple[Column, str]]:
    """The fixed advice list for a scored part: conditions and texts."""
    # Advice texts and their conditions.
    return [
        (F.col("machine_id") == "M2", "Inspect M2 calibration and machine condition."),
        (F.col("temperature_c") > 190, "Review process temperature control above 190°C."),
        (F.col("cycle_time_s") > 50, "Investigate cycle time deviation above 50 seconds."),
        (
            F.col("vibration_mm_s") > 2.7,
            "Check vibration level for possible tool wear or mechanical instability.",
        ),
        (
            F.col("shift") == "night",
            "Apply additional process checks during night shift production.",
        ),
        (
            F.col("operator_experience_years") < 2,
            "Use operator guidance or checklist support for low-experience operation.",
        ),
        (probability < 0.3, cfg.NO_ACTION),
    ]


def part_recommendations(probability: Column) -> Column:
    return text_of_true(part_advice(probability))


def sensor_evidence() -> Column:
    """Sentences about the readings of a row that stand out."""
    temperature, pressure = F.col("temperature_c"), F.col("pressure_bar")
    cycle, vibration = F.col("cycle_time_s"), F.col("vibration_mm_s")
    humidity, experience = F.col("humidity_percent"), F.col("operator_experience_years")
    # Evidence sentences and their conditions.
    text = text_of_true(
        [
            (
                temperature > 190,
                F.concat(
                    F.lit("Temperature "),
                    fixed_decimals(temperature, 1),
                    F.lit(" C exceeds the 190 C monitoring band."),
                ),
            ),
            (
                pressure >= 6.4,
                F.concat(
                    F.lit("Pressure "),
                    fixed_decimals(pressure, 2),
                    F.lit(" bar is above the expected range."),
                ),
            ),
            (
                pressure <= 5.1,
                F.concat(
                    F.lit("Pressure "),
                    fixed_decimals(pressure, 2),
                    F.lit(" bar is below the expected range."),
                ),
            ),
            (
                cycle > 50,
                F.concat(
                    F.lit("Cycle time "),
                    fixed_decimals(cycle, 1),
                    F.lit(" s is above the 50 s warning threshold."),
                ),
            ),
            (
                vibration > 2.7,
                F.concat(
                    F.lit("Vibration "),
                    fixed_decimals(vibration, 2),
                    F.lit(" mm/s is above the normal monitoring band."),
                ),
            ),
            (
                humidity > 60,
                F.concat(
                    F.lit("Humidity "),
                    fixed_decimals(humidity, 1),
                    F.lit("% is above the configured monitoring band."),
                ),
            ),
            (
                experience < 2,
                F.concat(
                    F.lit("Operator experience "),
                    fixed_decimals(experience, 1),
                    F.lit(" years is below the guidance threshold."),
                ),
            ),
            (F.col("machine_id") == "M2", "Machine M2 is configured as a higher-risk asset."),
            (
                F.col("material_batch") == "B4",
                "Material batch B4 is configured as a higher-risk material batch.",
            ),
            (
                F.col("shift").isin("night", "late"),
                F.concat(F.lit("Production occurred on the "), "shift", F.lit(" shift.")),
            ),
        ],
        separator=" ",
    )
    return F.when(
        text == "", "No configured sensor anomaly indicators are available for this row."
    ).otherwise(text)


def entry_counts(df: DataFrame, column: str, name: str, split=None) -> DataFrame:
    """How often each entry of a list text occurs over all rows.

    Equal texts are counted first: there are only as many distinct ones as rule
    combinations, so the lists are taken apart on that short table, not on every row.
    """
    split = split or split_list
    return (
        df.groupBy(F.col(column).alias("text"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.explode(split(F.col("text"))).alias(name), "rows")
        .groupBy(name)
        .agg(F.sum("rows").alias("row_count"))
    )


def driver_counts(reviewed: DataFrame) -> DataFrame:
    """Frequency of the reported (top three) drivers, most frequent first."""
    return entry_counts(reviewed, "top_suspected_drivers", "driver").orderBy(
        F.desc("row_count"), "driver"
    )


def recurring_drivers(results: DataFrame, limit: int = 5) -> DataFrame:
    """The most frequent drivers named in stored summary sentences.

    Blank sentences name none, so they need no filter of their own.
    """
    return (
        entry_counts(results, "root_cause_summary", "driver", drivers_in_summary)
        .orderBy(F.desc("row_count"), "driver")
        .limit(limit)
        .select(title_case(F.col("driver")).alias("driver"), "row_count")
    )


def _analysed() -> Column:
    return F.coalesce(F.trim("root_cause_summary") != "", F.lit(False))


def recommendation_counts(results: DataFrame, limit: int = 5) -> DataFrame:
    """The most frequent recommendations of rows that have an analysis.

    Rows without one contribute an empty list instead of being filtered: a filter on a
    computed text would be pushed below the projections and repeat all their work there.
    """
    listed = results.select(
        F.when(_analysed(), F.col("engineering_recommendations")).alias("advice")
    )
    return (
        entry_counts(listed, "advice", "recommendation")
        .orderBy(F.desc("row_count"), "recommendation")
        .limit(limit)
    )


def representative_rows(results: DataFrame, limit: int = 5) -> DataFrame:
    """The riskiest rows that have an analysis.

    Analysed rows sort first; the few rows taken are then checked.
    """
    return (
        results.select(
            "part_id",
            "scrap_probability",
            "predicted_scrap_risk",
            "root_cause_summary",
            _analysed().alias("analysed"),
        )
        .orderBy(F.desc("analysed"), F.desc("scrap_probability"), "part_id")
        .limit(limit)
        .filter("analysed")
        .select(
            "part_id",
            percent_text(F.col("scrap_probability")).alias("risk"),
            "predicted_scrap_risk",
            "root_cause_summary",
        )
    )
