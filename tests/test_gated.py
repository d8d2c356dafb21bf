"""Gates measured in the pass that writes, and joins by a key that some rows lack."""

import pytest
from pyspark.sql import functions as F

from linewarden.config import production as shape
from linewarden.operators import feedback as ops
from linewarden.operators import validation as quality
from linewarden.plans import gated
from linewarden.plans.case_trace import trace_table
from linewarden.plans.spec_compliance import spec_compliance
from linewarden.sources.tables import EmptyTableError, read_parquet
from test_queries import plan_of


def stored(path) -> list[str]:
    return sorted(p.name for p in path.iterdir()) if path.exists() else []


def test_one_pass_writes_what_the_job_returns(spark, batch, tmp_path):
    source, target = str(tmp_path / "in"), tmp_path / "out" / "limits"
    batch.write.parquet(source)
    rows = spark.read.parquet(source)
    read = spark.sparkContext.accumulator(0)

    def counted(row):
        read.add(1)
        return row

    watched = spark.createDataFrame(rows.rdd.map(counted), rows.schema)
    gated.write_compliance(watched, str(target))
    assert read.value == 10
    found = read_parquet(spark, str(target))
    assert sorted(found.collect()) == sorted(spec_compliance(batch).collect())
    assert stored(target.parent) == ["limits"]


def test_refused_input_leaves_the_old_table(spark, batch, tmp_path):
    target = tmp_path / "limits"
    gated.write_compliance(batch, str(target))
    before = stored(target)
    bad = batch.withColumn("humidity_percent", F.when(F.col("part_id") == "NB000003", "wet").otherwise("40"))
    with pytest.raises(quality.DataQualityError, match="humidity_percent has non-numeric"):
        gated.write_compliance(bad, str(target))
    with pytest.raises(EmptyTableError):
        gated.write_compliance(batch.where("temperature_c < 0"), str(target))
    with pytest.raises(EmptyTableError):
        gated.write_compliance(spark.createDataFrame([], batch.schema), str(target))
    with pytest.raises(quality.DataQualityError, match="lacks"):
        gated.write_compliance(batch.drop("humidity_percent"), str(target))
    assert stored(target) == before and stored(tmp_path) == ["limits"]


def changes(table):
    """Tables with one fault each."""
    first = F.col("part_id") == "P001"
    yield table
    yield table.withColumn("scrap", F.when(first, 2).otherwise(F.col("scrap")))
    yield table.withColumn("scrap", F.when(first, None).otherwise(F.col("scrap")))
    yield table.withColumn("pressure_bar", F.when(first, "high").otherwise("5.8"))
    yield table.withColumn("shift", F.when(F.col("part_id") < "P010", None).otherwise(F.col("shift")))
    yield table.withColumn("machine_id", F.lit("M9")).withColumn("row_count", F.lit("clash"))
    yield table.where("part_id = 'nobody'")


def test_quality_gate_agrees_with_the_report(clean_table, tmp_path):
    verdicts = []
    for at, table in enumerate(changes(clean_table)):
        path = tmp_path / str(at)
        failed = quality.quality_report(table).filter(F.col("status") == quality.FAIL).count() > 0
        try:
            gated.write_gated(table, lambda df: df, str(path), gated.quality_gate(table))
            passed = True
        except (quality.DataQualityError, EmptyTableError):
            passed = False
        assert passed is not failed and path.exists() is passed
        verdicts.append(passed)
    assert True in verdicts[1:] and verdicts.count(False) >= 3


def test_rows_without_a_key_stay_spread(spark, outcomes):
    n = 40_000
    keyless = spark.range(n, numPartitions=4).select(
        F.when(F.col("id") < 10, F.format_string("NB%06d", F.col("id") + 1)).alias(shape.KEY), F.col("id").alias("value")
    )
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    before = [spark.conf.get(name) for name in names]
    try:
        spark.conf.set(names[0], "-1")
        spark.conf.set(names[1], "false")
        joined = ops.with_matches(keyless, "Rows", [(outcomes, "Feedback")])
        sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == n and max(sizes) <= 0.75 * n and len(sizes) > 1
        assert joined.where("actual_scrap IS NOT NULL").count() == 10
        assert plan_of(joined).count("Arguments: hashpartitioning") == 2
    finally:
        for name, value in zip(names, before, strict=True):
            spark.conf.set(name, value)


@pytest.mark.parametrize("repeated", [0, 1, 2])
def test_trace_refuses_repeated_keys(batch, repeated):
    tables = [batch.select("part_id", "machine_id"), batch.select("part_id"), batch.select("part_id")]
    assert trace_table(*tables).count() == 10
    tables[repeated] = tables[repeated].union(tables[repeated].where("part_id = 'NB000004'"))
    with pytest.raises(Exception, match="repeats part_id NB000004"):
        trace_table(*tables).collect()
