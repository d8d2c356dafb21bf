"""The quality report from the stored states of batches equals that of the whole table."""

import pytest
from pyspark.sql import functions as F

from linewarden.config import production as shape
from linewarden.operators.validation import duplicate_keys, quality_report
from linewarden.plans.running_quality import add_batch, running_keys, running_report
from test_queries import plan_of


def rows(df):
    return [tuple(r) for r in df.orderBy("check_order").collect()]


def parts_of(batch):
    """Four parts: as it is, a repeated and a null key, broken readings, and one without two columns, with another."""
    spoiled = batch.withColumn(shape.KEY, F.when(F.col(shape.KEY) > F.lit("P"), F.col(shape.KEY)))
    number, lost = shape.NUMERIC[0], shape.NUMERIC[1]
    broken = batch.limit(3).withColumn(number, F.lit("twelve")).withColumn(shape.TARGET, F.lit("2"))
    return [batch, spoiled, broken, batch.drop(lost).withColumn("remark", F.lit("x"))]


def test_four_parts_are_the_whole(spark, batch, tmp_path):
    parts, folder = parts_of(batch), str(tmp_path / "state")
    text = [p.select(*[F.col(c).cast("string") for c in p.columns]) for p in parts]
    for n, part in enumerate(text):
        add_batch(part, folder, f"day {n}/a=b")
    whole = text[0]
    for part in text[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    assert rows(running_report(spark, folder)) == rows(quality_report(whole))
    mine = {(r[shape.KEY], r.row_count) for r in running_keys(spark, folder).collect()}
    assert mine == {(r[shape.KEY], r.row_count) for r in duplicate_keys(whole).collect()}


def test_a_batch_added_again_replaces_itself(spark, batch, tmp_path):
    folder = str(tmp_path / "state")
    add_batch(batch.limit(2), folder, "monday")
    add_batch(batch, folder, "monday")
    assert rows(running_report(spark, folder)) == rows(quality_report(batch))


def test_a_run_that_broke_off_counts_nothing(spark, batch, tmp_path):
    folder = str(tmp_path / "state")
    add_batch(batch, folder, "monday")
    keys = batch.groupBy(shape.KEY).agg(F.count(F.lit(1)).alias("row_count"))
    keys.write.parquet(f"{folder}/keys/run=broken")
    assert rows(running_report(spark, folder)) == rows(quality_report(batch))


def test_the_report_reads_no_batch(spark, batch, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "state")
    batch.write.parquet(source)
    add_batch(spark.read.parquet(source), folder, "monday")
    plan = plan_of(running_report(spark, folder))
    assert source not in plan and "counters" in plan


@pytest.mark.parametrize("empty", [True, False])
def test_no_rows_and_no_batches(spark, batch, tmp_path, empty):
    folder = str(tmp_path / "state")
    if empty:
        add_batch(batch.limit(0), folder, "nothing")
        assert rows(running_report(spark, folder)) == rows(quality_report(batch.limit(0)))
    else:
        found = {r.check_name: r.status for r in running_report(spark, folder).collect()}
        assert found["empty_dataset"] == "FAIL" and found["schema_validation"] == "FAIL"
