from functools import partial

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Observation
from pyspark.sql import functions as F

from linewarden.operators import evaluation, model, trees
from workload import queries, views

FOLDER = "/root/testdata/sf0.001"
QUICK = partial(
    model.candidate_pipelines, forest={"numTrees": 12, "maxDepth": 4}, boosting={"maxIter": 4}
)


@pytest.fixture(scope="module")
def table(spark):
    return views.plain(spark, FOLDER).cache()


@pytest.fixture(scope="module")
def models(table):
    names = (model.LOGISTIC, model.FOREST, model.BOOSTING)
    return model.fit(table, QUICK, names)


def test_split_is_stable_and_stratified(table):
    rows = {(r.scrap, r.is_test): r.row_count for r in model.split_profile(table).collect()}
    shuffled = model.split_profile(table.repartition(7)).collect()
    assert rows == {(r.scrap, r.is_test): r.row_count for r in shuffled}
    for label in (0, 1):
        share = rows[label, True] / (rows[label, True] + rows[label, False])
        assert 0.22 < share < 0.28


@pytest.mark.parametrize("few", [0, 7, 1_000])
def test_stratified_shares_are_exact(table, few, monkeypatch):
    """The k smallest digests of each class, k a quarter of its rows, whatever the partitioning; also with few cells."""
    monkeypatch.setattr(model, "STEP_BITS", 6)
    ranked = {}
    for r in table.select("scrap", "part_id", model.split_digest(F.col("part_id")).alias("d")).collect():
        ranked.setdefault(r.scrap, []).append((r.d, r.part_id))
    cuts = model.stratified_cuts(table.repartition(7), few=few)
    assert cuts == {c: sorted(rows)[round(0.25 * len(rows)) - 1][0] for c, rows in ranked.items()}


def test_stratified_split_of_odd_tables(spark):
    rows = [(f"P{i}", i % 3 if i % 5 else None) for i in range(200)] + [("X", 9), (None, 7), (None, 7), (None, 7), (None, 7)]
    df = spark.createDataFrame(rows, "part_id string, scrap int")
    found = {}
    for r in model.with_stratified_split(df).collect():
        found.setdefault(r.scrap, []).append(r.is_test)
    for label, flags in found.items():
        assert sum(flags) == round(0.25 * len(flags)) or label == 7
    # Rows of one key stay together.
    assert found[9] == [False] and len(set(found[7])) == 1
    assert model.with_stratified_split(df.where("false")).collect() == []


def test_training_rows_are_bounded_and_dealt(table):
    few = model.fit(table, QUICK, (model.FOREST,), tasks=3, rows=800)[model.FOREST]
    scored = model.score(model.test_rows(table), few, decimals=None)
    assert evaluation.ranking_metrics(evaluation.score_histogram(scored)).first().roc_auc > 0.55


def test_queries_fit_on_every_training_row(spark, monkeypatch):
    """45,000 rows on the training side, all of which the models of each query are fitted on."""
    folder, fitted_on = "/root/testdata/sf0.01", []

    def quick(rows):
        fitted_on.append(rows)
        return QUICK(rows)

    monkeypatch.setattr(model, "candidate_pipelines", quick)
    known = model.training_rows(views.plain(spark, folder)).count()
    assert known > 40_000
    for names in (("model_evaluation", "scored_batch", "feature_importance"), ("best_model", "model_comparison")):
        monkeypatch.setattr(queries, "_FITTED", {})
        for name in names:
            assert not queries.QUERIES[name](spark, folder).isEmpty()
    assert fitted_on == [known, known]


def test_tasks_follow_the_rows():
    found = {n: model.training_tasks(n) for n in (1, 30_000, 45_000, 450_000, 4_000_000, 27_000_000)}
    assert found == {1: 2, 30_000: 2, 45_000: 3, 450_000: 16, 4_000_000: 16, 27_000_000: 108}


def test_forest_grown_in_lots(table, monkeypatch, tmp_path):
    """A forest of three lots is one model: all trees, each lot its own, the mean of their shares, saved and loaded."""
    monkeypatch.setattr(model, "BAGGED", 0)
    monkeypatch.setattr(model, "TREES_AT_ONCE", 5)
    forest = model.fit(table, QUICK, (model.FOREST,))[model.FOREST]
    last = forest.stages[-1]
    assert (last.getNumTrees, last.numClasses, last.numFeatures) == (12, 2, 18)
    assert last.getLabelCol() == "scrap" and last.getOrDefault("maxDepth") == 4
    assert len({tree.toDebugString.split("\n", 1)[1] for tree in last.trees}) == 12
    few = table.limit(300).withColumn("row", F.monotonically_increasing_id()).cache()
    ready = few
    for stage in forest.stages[:-1]:
        ready = stage.transform(ready)
    rows = [r.features for r in ready.orderBy("row").select("features").collect()]
    own = [r[0] for r in trees.with_given(few, forest, "given").orderBy("row").select("given.probability").collect()]
    for features, p in list(zip(rows, own, strict=True))[:20]:
        assert p == pytest.approx(sum(t.predictProbability(features)[1] for t in last.trees) / 12)
    path = str(tmp_path / "lots")
    model.save_model(forest, path)
    again = trees.with_given(few, model.load_model(path), "given").orderBy("row").select("given.probability").collect()
    assert [r[0] for r in again] == own
    assert sum(r.importance for r in model.feature_importance(forest).collect()) == pytest.approx(1, abs=1e-4)
    scored = model.score(model.test_rows(table), forest, decimals=None)
    assert evaluation.ranking_metrics(evaluation.score_histogram(scored)).first().roc_auc > 0.55


def test_comparison(table, models):
    rows = model.model_comparison(table, models).collect()
    assert {r.model for r in rows} == set(models)
    tested = model.test_rows(table).count()
    for r in rows:
        cells = r.true_negative + r.false_positive + r.false_negative + r.true_positive
        assert cells == tested
    assert [r.f1_score for r in rows] == sorted((r.f1_score for r in rows), reverse=True)
    best = {r.role: r.model for r in model.best_models(model.model_comparison(table, models)).collect()}
    assert best == {"best_by_f1": rows[0].model, "production": model.FOREST}


def test_scores(table, models, tmp_path):
    scored = model.score(model.test_rows(table), models[model.FOREST], decimals=None)
    low, high = scored.agg(F.min("scrap_probability"), F.max("scrap_probability")).first()
    assert 0 <= low < high <= 1
    ranked = evaluation.ranking_metrics(evaluation.score_histogram(scored)).first()
    assert ranked.roc_auc > 0.55
    path = str(tmp_path / "model")
    model.save_model(models[model.FOREST], path)
    again = model.score(model.test_rows(table), model.load_model(path), decimals=None)
    keys = ["part_id", "scrap_probability"]
    assert scored.select(keys).exceptAll(again.select(keys)).isEmpty()


def test_unseen_and_missing_values(table, models):
    odd = table.limit(2).withColumn("machine_id", F.lit("M77"))
    for fitted in models.values():
        assert model.score(odd, fitted).filter("scrap_probability is null").isEmpty()
    encoded = models[model.FOREST].transform(odd).select("machine_id_onehot").collect()
    assert {r[0].size for r in encoded} == {4} and not any(r[0].indices.size for r in encoded)
    gap = table.limit(2).withColumn("temperature_c", F.lit(None).cast("double"))
    assert model.score(gap, models[model.FOREST]).filter("scrap_probability is null").count() == 2


def test_importance(models):
    rows = model.feature_importance(models[model.FOREST]).collect()
    assert len(rows) == 4 + 3 + 5 + 6
    assert sum(r.importance for r in rows) == pytest.approx(1, abs=1e-4)
    assert [r.importance for r in rows] == sorted((r.importance for r in rows), reverse=True)
    assert model.feature_importance(models[model.FOREST], 8).count() == 8
    assert {"machine_id_M2", "vibration_mm_s"} <= {r.feature for r in rows}


def test_one_class_is_refused(table):
    with pytest.raises(ValueError):
        model.fit(table.filter("scrap = 0"), QUICK, (model.FOREST,))


def test_checkpoint_folder(spark, tmp_path):
    """The folder given is used; without one, and without the setting, training only warns."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        with pytest.warns(UserWarning, match="checkpoint"):
            model.prepare_checkpoints(spark)
    model.prepare_checkpoints(spark, str(tmp_path))
    assert str(tmp_path) in context.getCheckpointDir()


def test_comparison_reads_the_test_side_once(table, models):
    plan = model.model_comparison(table, models)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") + plan.count("Relation [") <= 1
    checks = {r.model: r for r in model.model_checks(table, models).collect()}
    assert set(checks) == set(models)
    assert all(r.tested_rows == r.cell_rows and r.outside == r.missing == 0 for r in checks.values())


def test_models_work_once_the_session_has_observed_a_table(spark, table, models):
    seen = Observation("rows")
    table.limit(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 3}
    few = table.limit(20)
    for fitted in models.values():
        assert not getattr(fitted.stages[-1], "hasSummary", False)
        assert fitted.transform(few).select("prediction").count() == model.score(few, fitted).count() == 20
        fitted.transform(few).select("probability").collect()


def test_arrays_score_as_the_models_do(table, models):
    """The same bits, also for unseen categories, missing readings and readings on a split."""
    odd = table.limit(400)
    odd = odd.unionByName(odd.withColumn("machine_id", F.lit("M77")).withColumn("shift", F.lit(None).cast("string")))
    odd = odd.unionByName(odd.withColumn("temperature_c", F.lit(None).cast("double")))
    odd = odd.withColumn("row", F.monotonically_increasing_id()).cache()
    for name in (model.FOREST, model.BOOSTING):
        fitted = models[name]
        assert trees.read_trees(fitted.stages[-1]) is not None
        found = trees.with_given(odd, fitted, "given").select("row", "given.*").orderBy("row").collect()
        own = fitted.transform(odd).select("row", "prediction", vector_to_array("probability")[1]).orderBy("row").collect()
        assert [r[:2] for r in found] == [r[:2] for r in own]
        assert max(abs(a[2] - b[2]) for a, b in zip(found, own, strict=True)) < (1e-12 if name == model.BOOSTING else 1e-300)


def test_one_walk_a_row(table, models):
    """A filter on the score does not walk the trees again, and no tree is walked by MLlib."""
    scored = model.score(table, models[model.FOREST]).filter("scrap_probability > 0.5").groupBy("scrap_probability").count()
    assert scored._jdf.queryExecution().optimizedPlan().toString().count("walk(") == 1
    compared = model.compared(table, models)._jdf.queryExecution().optimizedPlan().toString()
    assert compared.count("walk(") == 2
