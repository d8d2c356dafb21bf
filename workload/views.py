"""Production views derived from the star-schema test tables (see FIXTURES.md §3).

Every row of `lineitem` is one produced part; nothing is filtered away. The remainders
below spread values over rows, they do not select rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linewarden.config.production import PRODUCTION_COLUMNS
from linewarden.functions.risk import scorecard, sigmoid
from linewarden.functions.text import parse_number

INTERCEPT = -1.25
THRESHOLD = 0.40
EXPORT_THRESHOLD = 0.30


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def half_up(value: Column, decimals: int) -> Column:
    """The rounding of the fixture definitions: scale, halves up, unscale."""
    scale = float(10**decimals)
    return F.floor(value * scale + 0.5) / scale


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").withColumn("qty", F.col("l_quantity").cast("int"))


def _part_id(*columns: str) -> Column:
    return F.concat_ws("-", *[F.col(c).cast("string") for c in columns])


def _readings() -> dict[str, Column]:
    cents = F.floor(F.col("l_extendedprice") * 100 + 0.5)
    return {
        "machine_id": F.concat(F.lit("M"), (F.col("l_suppkey") % 4 + 1).cast("string")),
        "temperature_c": 172 + F.col("l_quantity") * 0.5,
        "pressure_bar": half_up(4.9 + F.col("l_discount") * 20, 2),
        "cycle_time_s": half_up(40 + (cents % 1500).cast("double") / 100, 2),
        "shift": F.when(F.col("l_returnflag") == "A", "early")
        .when(F.col("l_returnflag") == "N", "late")
        .otherwise("night"),
        "material_batch": F.concat(F.lit("B"), (F.col("l_partkey") % 5 + 1).cast("string")),
        "operator_experience_years": (F.col("l_orderkey") % 80).cast("double") / 8,
        "vibration_mm_s": half_up(1.5 + F.col("l_tax") * 25, 2),
        "humidity_percent": (35 + F.col("l_linenumber") * 5).cast("double"),
    }


KEY_PARTS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def production(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P: typed production rows with a scorecard probability and a correlated outcome."""
    hashed = (
        F.col("l_orderkey") * 7919 + F.col("l_partkey") * 104729 + F.col("l_linenumber") * 31
    ) % 10007
    base = lines(spark, sf_dir).select(
        _part_id(*KEY_PARTS, "qty").alias("part_id"),
        *[c.alias(n) for n, c in _readings().items()],
        (hashed.cast("double") / 10007).alias("luck"),
        (
            (F.col("l_linestatus") == "F") | (F.col("l_returnflag") != "N")
        ).alias("has_feedback"),
    )
    scored = base.withColumn("risk_score", scorecard(intercept=INTERCEPT)).withColumn(
        "raw_probability", sigmoid(F.col("risk_score"))
    )
    return scored.select(
        *[c for c in PRODUCTION_COLUMNS if c != "scrap"],
        F.when(F.col("luck") < F.col("raw_probability"), 1).otherwise(0).alias("scrap"),
        "risk_score",
        half_up(F.col("raw_probability"), 4).alias("scrap_probability"),
        "has_feedback",
    )


def plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The production table proper, without any score."""
    return production(spark, sf_dir).select(*PRODUCTION_COLUMNS)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Production rows with their probability."""
    return production(spark, sf_dir).select(*PRODUCTION_COLUMNS, "scrap_probability")


def feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FB: outcomes of parts that are finished or came back, plus ids never reviewed."""
    parts = production(spark, sf_dir).filter("has_feedback").select(
        "part_id",
        F.col("scrap").alias("actual_scrap"),
        F.when(F.col("scrap") == 1, "confirmed_issue")
        .otherwise("no_issue")
        .alias("engineer_review_outcome"),
    )
    strangers = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "P").select(
        F.concat(F.lit("X-"), F.col("o_orderkey").cast("string")).alias("part_id"),
        F.lit(0).alias("actual_scrap"),
        F.lit("no_issue").alias("engineer_review_outcome"),
    )
    return parts.unionByName(strangers).withColumn("review_notes", F.lit("synthetic feedback"))


def raw_feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feedback as text, with some missing and invalid outcomes."""
    dirty = raw(spark, sf_dir)
    return dirty.select(
        "part_id",
        F.when(parse_number(F.col("temperature_c")).isNotNull(), F.col("scrap")).alias(
            "actual_scrap"
        ),
    )


def duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DUP: a coarser key that repeats."""
    return table(spark, sf_dir, "lineitem").select(
        _part_id("l_orderkey", "l_linenumber", "l_partkey").alias("part_id")
    )


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DIRTY: every column as text, with missing, unreadable and unusual values."""
    readings = _readings()
    order = F.col("l_orderkey")
    dirty = {
        **{n: c.cast("string") for n, c in readings.items()},
        "temperature_c": F.when(order % 89 == 0, "  ")
        .when(order % 83 == 0, "\t")
        .when(order % 79 == 0, "\u00a0")
        .when(order % 97 == 0, F.lit(None).cast("string"))
        .when(order % 101 == 0, "bad")
        .when(order % 103 == 0, "250.0")
        .otherwise(readings["temperature_c"].cast("string")),
        "machine_id": F.when(F.col("l_partkey") % 211 == 0, "M9").otherwise(
            readings["machine_id"]
        ),
        "scrap": F.when(order % 499 == 0, "2").otherwise(
            (F.col("l_linenumber") % 2).cast("string")
        ),
    }
    return lines(spark, sf_dir).select(
        _part_id(*KEY_PARTS, "qty").alias("part_id"), *[c.alias(n) for n, c in dirty.items()]
    ).select(*PRODUCTION_COLUMNS)
