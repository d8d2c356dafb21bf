"""Read and write production tables, scoring batches, feedback and summaries."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linewarden.config.production import NULL_TEXTS, NUMERIC, TARGET
from linewarden.functions.text import as_double


class EmptyTableError(ValueError):
    """A table that must hold rows has none."""


def _existing(load, path: str, label: str) -> DataFrame:
    try:
        return load()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"{label} not found at {path}") from error
        raise


def read_csv(
    spark: SparkSession,
    path: str,
    label: str = "Table",
    columns: list[str] | None = None,
) -> DataFrame:
    """CSV with a header, every column as text, missing-value markers as null.

    Text is kept so that the quality checks can see what does not convert. With `columns`
    the header is not read ahead, and malformed lines land in `_corrupt_record`.
    """
    reader = spark.read.option("header", True)
    if columns is not None:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        reader = reader.schema(schema.add("_corrupt_record", T.StringType())).option(
            "columnNameOfCorruptRecord", "_corrupt_record"
        )
    raw = _existing(lambda: reader.csv(path), path, label)
    return raw.select(
        *[F.when(~F.col(c).isin(*NULL_TEXTS), F.col(c)).alias(c) for c in raw.columns]
    )


def read_parquet(spark: SparkSession, path: str, label: str = "Table") -> DataFrame:
    return _existing(lambda: spark.read.parquet(path), path, label)


def require_rows(df: DataFrame, label: str = "Table") -> DataFrame:
    """The table itself, after a one-row look that it is not empty."""
    if df.isEmpty():
        raise EmptyTableError(f"{label} has zero rows")
    return df


def project_existing(df: DataFrame, columns) -> DataFrame:
    """The listed columns that the table has, in list order."""
    return df.select(*[c for c in columns if c in df.columns])


def coerce_numeric(df: DataFrame, columns=NUMERIC) -> DataFrame:
    """Numeric columns as double, NaN as null; unreadable text becomes null."""
    return df.withColumns({c: as_double(df, c) for c in columns if c in df.columns})


def to_production(df: DataFrame) -> DataFrame:
    """A raw table with the typed production columns."""
    typed = coerce_numeric(df)
    if TARGET in df.columns:
        typed = typed.withColumn(TARGET, as_double(df, TARGET).cast("int"))
    return typed


def write_rows(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Row-level results, one file per task."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def write_summary(summary: DataFrame, path: str) -> None:
    """A small summary as JSON lines, one document per row."""
    document: Column = F.to_json(F.struct(*summary.columns), {"ignoreNullFields": "false"})
    summary.select(document.alias("value")).write.mode("overwrite").text(path)


def _hadoop(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove_table(spark: SparkSession, path: str) -> None:
    """Delete a stored table; nothing happens where none is."""
    where, files = _hadoop(spark, path)
    files.delete(where, True)


def move_table(spark: SparkSession, source: str, target: str) -> None:
    """Put a stored table in the place of another on the same file system.

    The old one goes first. Where a file system renames in one step, so does this; object stores copy.
    """
    where, files = _hadoop(spark, source)
    goal, _ = _hadoop(spark, target)
    files.delete(goal, True)
    if not files.rename(where, goal):
        raise OSError(f"{source} could not be moved to {target}")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the cluster shares: spark.checkpoint.dir, or the warehouse where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/stored"
    return f"{folder}/{name}-{uuid.uuid4().hex}"
