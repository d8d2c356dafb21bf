import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from linewarden.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


# A ten-row batch with known probabilities and outcomes.
BATCH = [
    ("NB000001", "M2", 196.2, 6.55, 54.1, "night", "B4", 1.2, 3.35, 62.0, 0.7248),
    ("NB000002", "M1", 184.0, 5.75, 45.5, "early", "B1", 6.5, 2.05, 47.0, 0.2446),
    ("NB000003", "M4", 190.8, 5.95, 50.8, "late", "B2", 3.0, 2.85, 52.0, 0.2323),
    ("NB000004", "M3", 172.5, 5.35, 44.2, "early", "B5", 8.0, 2.10, 45.5, 0.2283),
    ("NB000005", "M2", 188.6, 6.20, 48.7, "night", "B3", 2.4, 2.65, 58.0, 0.5116),
    ("NB000006", "M1", 181.2, 5.60, 43.8, "early", "B4", 5.1, 1.95, 46.0, 0.3507),
    ("NB000007", "M3", 187.5, 5.90, 46.0, "night", "B1", 4.2, 2.30, 64.5, 0.2692),
    ("NB000008", "M4", 194.4, 6.42, 52.4, "late", "B4", 1.8, 3.05, 59.0, 0.4108),
    ("NB000009", "M1", 185.1, 5.82, 46.2, "early", "B2", 7.4, 2.20, 49.5, 0.2020),
    ("NB000010", "M2", 191.6, 5.05, 51.7, "late", "B5", 1.6, 2.95, 61.0, 0.4304),
]
SCHEMA = (
    "part_id string, machine_id string, temperature_c double, pressure_bar double, "
    "cycle_time_s double, shift string, material_batch string, "
    "operator_experience_years double, vibration_mm_s double, humidity_percent double, "
    "scrap_probability double"
)
ACTUAL = [1, 0, 1, 0, 1, 0, 0, 0, 0, 1]


@pytest.fixture(scope="session")
def batch(spark):
    return spark.createDataFrame(BATCH, SCHEMA).cache()


@pytest.fixture(scope="session")
def outcomes(spark):
    rows = [(r[0], a, "noted", "note") for r, a in zip(BATCH, ACTUAL)]
    return spark.createDataFrame(
        rows,
        "part_id string, actual_scrap int, engineer_review_outcome string, review_notes string",
    ).cache()


@pytest.fixture(scope="session")
def clean_table(spark):
    """Twenty unremarkable rows, two of them scrap."""
    rows = [
        (f"P{i:03d}", "M1", 184.0, 5.8, 46.0, "early", "B1", 5.0, 2.2, 48.0, int(i in (5, 10)))
        for i in range(1, 21)
    ]
    return spark.createDataFrame(
        rows, SCHEMA.replace("scrap_probability double", "scrap int")
    ).cache()
