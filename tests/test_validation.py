import pytest
from pyspark.sql import functions as F

from linewarden.operators import feedback
from linewarden.operators import validation as q
from linewarden.sources import tables


def report(df):
    return {r.check_name: r for r in q.quality_report(df).collect()}


def overall(df):
    return q.quality_report(df).first().overall_status


def test_clean_table_passes(clean_table):
    found = report(clean_table)
    assert {r.status for r in found.values()} == {"PASS"}
    assert [r.check_order for r in found.values()] == list(range(1, 10))
    assert q.require_quality(clean_table) is clean_table


def test_missing_column_fails(clean_table):
    df = clean_table.drop("temperature_c")
    assert report(df)["schema_validation"].affected == "temperature_c"
    assert overall(df) == "FAIL"
    with pytest.raises(q.DataQualityError):
        q.require_quality(df)


def test_missing_target_fails(clean_table):
    assert report(clean_table.drop("scrap"))["target_validation"].status == "FAIL"


def test_invalid_target_fails(clean_table):
    df = clean_table.withColumn("scrap", F.when(F.col("part_id") == "P001", 2).otherwise(0))
    assert report(df)["target_validation"].status == "FAIL"
    assert [r.value for r in q.invalid_target_examples(df).collect()] == ["2"]


def test_unknown_category_and_range_only_warn(clean_table):
    first = F.col("part_id") == "P001"
    df = clean_table.withColumn("machine_id", F.when(first, "M9").otherwise("M1"))
    assert overall(df) == "WARNING"
    df = clean_table.withColumn("temperature_c", F.when(first, 999.0).otherwise(180.0))
    assert report(df)["engineering_plausibility"].affected == "temperature_c"
    assert overall(df) == "WARNING"
    texts = [r.warning for r in q.scoring_warnings(df).collect()]
    assert texts == ["temperature_c has 1 values outside monitoring range 160 to 210"]


def test_scrap_rate_counts_missing_targets_in_the_denominator(clean_table):
    df = clean_table.withColumn("scrap", F.when(F.col("part_id") <= "P010", F.col("scrap")))
    row = q.target_profile(df).first()
    assert (row.total_rows, row.good_count, row.scrap_count, row.scrap_rate) == (20, 8, 2, 0.1)


def test_missing_share_decides_status(clean_table):
    one = F.when(F.col("part_id") != "P001", F.col("shift"))
    row = {r.column_name: r for r in q.missing_profile(clean_table.withColumn("shift", one)).collect()}
    assert (row["shift"].missing_percentage, row["shift"].status) == (0.05, "WARNING")
    two = F.when(F.col("part_id") > "P002", F.col("shift")).otherwise("  ")
    row = {r.column_name: r for r in q.missing_profile(clean_table.withColumn("shift", two)).collect()}
    assert (row["shift"].missing_count, row["shift"].status) == (2, "FAIL")


def test_empty_table(clean_table):
    found = report(clean_table.filter("false"))
    assert found["empty_dataset"].status == "FAIL"
    assert found["missing_values"].status == "PASS"
    assert q.missing_profile(clean_table.filter("false")).first().missing_percentage == 0.0
    assert q.duplicate_summary(clean_table.filter("false")).first().duplicate_examples == ""


def test_duplicates_count_rows_and_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,), (None,)], "part_id string")
    row = q.duplicate_summary(df).first()
    assert tuple(row) == (5, 2, "a; nan")


def test_skewed_key(spark):
    """A third of all rows under one key."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("part_id")
    )
    assert tuple(q.duplicate_summary(df).first()) == (10_000, 1, "hot")


def test_examples_are_limited_per_column(spark, clean_table):
    text = clean_table.select(*[F.col(c).cast("string") for c in clean_table.columns])
    bad = text.withColumn("temperature_c", F.concat(F.lit("x"), "part_id")).withColumn(
        "pressure_bar", F.lit("bad")
    )
    found = q.invalid_examples(bad).collect()
    hot = sorted(r.value for r in found if r.column_name == "temperature_c")
    assert hot == [f"xP00{i}" for i in range(1, 6)]
    assert [(r.value, r.row_count) for r in found if r.column_name == "pressure_bar"] == [("bad", 20)]


def test_csv_round_trip(spark, tmp_path, clean_table):
    path = str(tmp_path / "table.csv")
    dirty = clean_table.withColumn("shift", F.when(F.col("part_id") == "P001", "n/a").otherwise("late"))
    tables.write_rows(dirty, path, "csv")
    raw = tables.read_csv(spark, path)
    assert {f.dataType.simpleString() for f in raw.schema} == {"string"}
    assert raw.filter("shift is null").count() == 1
    typed = tables.to_production(raw)
    assert dict(typed.dtypes)["temperature_c"] == "double"
    assert typed.agg(F.sum("scrap")).first()[0] == 2
    declared = tables.read_csv(spark, path, columns=list(clean_table.columns))
    assert declared.columns[-1] == "_corrupt_record"
    with pytest.raises(FileNotFoundError):
        tables.read_csv(spark, str(tmp_path / "absent.csv"))


def test_summary_document(spark, tmp_path, clean_table):
    import json

    path = str(tmp_path / "summary")
    tables.write_summary(q.target_profile(clean_table), path)
    document = json.loads(spark.read.text(path).first().value)
    assert document["scrap_count"] == 2 and document["status"] == "PASS"


def test_feedback_gate(spark, batch, outcomes):
    from linewarden.plans.batch_review import batch_review

    review = batch_review(batch, 0.4)
    feedback.require_feedback(review, outcomes)
    with pytest.raises(q.DataQualityError, match="repeats"):
        feedback.require_feedback(review, outcomes.union(outcomes.limit(1)))
    with pytest.raises(q.DataQualityError, match="repeats"):
        feedback.require_feedback(review.union(review.limit(1)), outcomes)
    with pytest.raises(q.DataQualityError, match="invalid"):
        feedback.require_feedback(review, outcomes.withColumn("actual_scrap", F.lit("maybe")))
    with pytest.raises(q.DataQualityError, match="invalid"):
        feedback.require_feedback(
            review, outcomes.withColumn("actual_scrap", F.lit(None).cast("int"))
        )
    with pytest.raises(q.DataQualityError, match="lacks"):
        feedback.require_feedback(review, outcomes.drop("review_notes"))


def test_feedback_coverage_and_clashes(batch, outcomes):
    from linewarden.plans.batch_review import batch_review

    review = batch_review(batch, 0.4).filter("part_id <> 'NB000001'")
    some = outcomes.filter("part_id <> 'NB000002'").withColumn("risk_level", F.lit("?"))
    assert tuple(feedback.feedback_coverage(review, some).first()) == (9, 9, 8, 1, 1)
    assert [r.part_id for r in feedback.without_feedback(review, some).collect()] == ["NB000002"]
    assert [r.part_id for r in feedback.extra_feedback(review, some).collect()] == ["NB000001"]
    assert {"risk_level_x", "risk_level_y"} <= set(feedback.feedback_cases(review, some).columns)
