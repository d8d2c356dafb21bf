"""The quality report of a table that grows by batches, from stored counters.

Each batch leaves a state: one row of counters, which add up, and its distinct keys with their counts, for keys that
repeat across batches. The report of all batches reads these states only, never a batch that was added before.

A batch's keys are written first, in a folder of its own run; the row of counters that names the run makes them
count. A run that broke off therefore leaves nothing that is read, and adding a batch again replaces it.
"""

from __future__ import annotations

import uuid
from itertools import chain

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linewarden.config import production as cfg
from linewarden.operators.validation import quality_counters, repeated_rows, status_rows


def _filled(df: DataFrame) -> DataFrame:
    """The table with every expected column; one that it lacks is null in all rows, as in a union by name."""
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in cfg.PRODUCTION_COLUMNS if c not in df.columns])


def _counters(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each batch; no rows before the first one."""
    empty = _filled(spark.createDataFrame([], T.StructType()))
    counted = [T.StructField(f.name, T.LongType()) for f in quality_counters(empty).schema]
    schema = T.StructType([
        T.StructField("run", T.StringType()), T.StructField("columns", T.ArrayType(T.StringType())), *counted,
        T.StructField("batch", T.StringType()),
    ])
    path = f"{folder}/counters"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def add_batch(df: DataFrame, folder: str, batch: str) -> None:
    """Stores the state of a batch of production rows in `folder`; a batch of that name counts no longer.

    The keys cost an exchange of distinct keys and their counts within the batch; nothing stored before is read. The
    old keys of a batch that is added again stay in their folder without being read.
    """
    run, rows = uuid.uuid4().hex, _filled(df)
    keys = rows.groupBy(F.col(cfg.KEY).cast("string").alias(cfg.KEY)).agg(F.count(F.lit(1)).alias("row_count"))
    keys.write.parquet(f"{folder}/keys/run={run}")
    names = F.array(*map(F.lit, df.columns)) if df.columns else F.array().cast("array<string>")
    state = quality_counters(rows).select(F.lit(run).alias("run"), names.alias("columns"), "*", F.lit(batch).alias("batch"))
    writer = state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("batch").parquet(f"{folder}/counters")


def running_keys(spark: SparkSession, folder: str) -> DataFrame:
    """(part_id, row_count, batch_count): the keys that more than one row of all batches holds."""
    runs = [r.run for r in _counters(spark, folder).select("run").collect()]
    if not runs:
        return spark.createDataFrame([], f"{cfg.KEY} string, row_count long, batch_count long")
    stored = spark.read.schema(f"{cfg.KEY} string, row_count long").parquet(*[f"{folder}/keys/run={r}" for r in runs])
    total = stored.groupBy(cfg.KEY).agg(F.sum("row_count").alias("row_count"), F.count(F.lit(1)).alias("batch_count"))
    return total.where("row_count > 1")


def running_report(spark: SparkSession, folder: str) -> DataFrame:
    """The quality report of all batches together: that of their union by name.

    Columns come in the order of the batches' names. Without any batch it is the report of a table without columns.
    """
    states = _counters(spark, folder)
    shapes = states.groupBy("columns").agg(F.min("batch").alias("first")).orderBy("first").collect()
    columns = list(dict.fromkeys(chain.from_iterable(r["columns"] for r in shapes)))
    sums = [F.coalesce(F.sum(c), F.lit(0).cast("long")).alias(c) for c in states.columns if c not in ("run", "columns", "batch")]
    wide = states.agg(*sums)
    if cfg.KEY in columns:
        wide = wide.select("*", repeated_rows(running_keys(spark, folder)).scalar().alias("duplicates"))
    return status_rows(wide, columns).drop("scrap_rate")
