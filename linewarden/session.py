"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Setting -> (stock value, wanted value).
SETTINGS = {
    # The JVM compiles no method above 8000 bytes; longer generated code would be interpreted.
    # With this limit Spark falls back to its split, compilable projections instead.
    "spark.sql.codegen.hugeMethodLimit": ("65535", "8000"),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a running session; values chosen by the user stay."""
    for name, (stock, wanted) in SETTINGS.items():
        if spark.conf.get(name, stock) == stock:
            spark.conf.set(name, wanted)
    return spark
