"""Scrap-risk models: split, features, training, scoring and comparison with MLlib."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linewarden.config.production import CATEGORICAL, FEATURES, NUMERIC, TARGET
from linewarden.functions.rules import any_true
from linewarden.functions.text import array_rounded
from linewarden.operators.evaluation import confusion_metrics
from linewarden.operators.trees import with_given
from linewarden.sources.tables import coerce_numeric, remove_table, shared_path

SEED = 42
TEST_SHARE = 0.25
#: Bits of a key's digest that order the rows of a class, and how many of them one histogram tells apart.
DIGEST_BITS, STEP_BITS = 60, 12
#: Training rows of a task, about, and the fewest tasks; many rows go to SPREAD_TASKS until each has FULL_TASK_ROWS.
TASK_ROWS, TRAINING_TASKS = 15_000, 2
FULL_TASK_ROWS, SPREAD_TASKS = 250_000, 16
#: MLlib keeps a number for each tree grown at once with every row: about how many in all, and the fewest trees.
BAGGED, TREES_AT_ONCE = 15_000_000, 20
WEIGHT = "class_weight"
#: Column of a model's answer while a table is scored.
GIVEN = "given_by_model"
# Model names and their hyper-parameters.
FOREST, LOGISTIC, BOOSTING = "Random Forest", "Logistic Regression", "Gradient Boosting"
FOREST_PARAMS = {"numTrees": 300, "maxDepth": 8, "minInstancesPerNode": 8}
BOOSTING_PARAMS = {"maxIter": 150, "stepSize": 0.05, "maxDepth": 3}
LOGISTIC_PARAMS = {"maxIter": 1000}


def is_test(key: Column, share: float = TEST_SHARE, seed: int = SEED) -> Column:
    """Deterministic split flag of a row.

    A digest of the key decides, so the split is the same on every run, partitioning and
    engine, needs no shuffle, and holds back the same share of every class in expectation.
    """
    digest = F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed))))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 10_000
    return bucket < int(round(share * 10_000))


def with_split(df: DataFrame, key: str = "part_id") -> DataFrame:
    return df.withColumn("is_test", is_test(F.col(key)))


def split_digest(key: Column, seed: int = SEED) -> Column:
    """60 bits of the key's digest as a number."""
    digest = F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, DIGEST_BITS // 4), 16, 10).cast("long")


def stratified_cuts(
    df: DataFrame, key: str = "part_id", label: str = TARGET, share: float = TEST_SHARE, seed: int = SEED, few: int = 1_000
) -> dict[int | None, int]:
    """For each class the digest up to which its rows are tested: that of its k-th smallest, k = round(share * rows).

    No table is sorted. A histogram of the digests' leading bits finds the cell that holds the k-th smallest of each
    class, the next one looks into those cells alone, and so on until at most `few` rows a class are left, whose
    digests are collected. A class of which no row is tested has the cut -1. Classes are few: one row of a histogram
    a class and cell is collected, 2^STEP_BITS cells at most each.
    """
    digests = df.select(F.col(label).alias("label"), split_digest(F.col(key), seed).alias("digest"))
    sizes = {r.label: r["count"] for r in digests.groupBy("label").count().collect()}
    # Halves go to the even number, as Python rounds.
    wanted = {c: round(share * n) for c, n in sizes.items()}
    cuts = {c: -1 for c, k in wanted.items() if k == 0}
    cells = {c: (0, n) for c, n in sizes.items() if c not in cuts}
    left = {c: wanted[c] for c in cells}
    shift = DIGEST_BITS

    def inside() -> DataFrame:
        """Digests in the cell of their class."""
        own = [F.col("label").eqNullSafe(c) & (F.shiftright("digest", shift) == cell) for c, (cell, _) in cells.items()]
        return digests.where(any_true(own))

    while shift and any(n > few for _, n in cells.values()):
        narrow = inside()
        shift = max(0, shift - STEP_BITS)
        counts: dict[int | None, dict[int, int]] = {}
        for r in narrow.groupBy("label", F.shiftright("digest", shift).alias("cell")).count().collect():
            counts.setdefault(r.label, {})[r.cell] = r["count"]
        for c, found in counts.items():
            for cell in sorted(found):
                if left[c] <= found[cell]:
                    cells[c] = (cell, found[cell])
                    break
                left[c] -= found[cell]
    if cells:
        last: dict[int | None, list[tuple[int, int]]] = {}
        for r in inside().groupBy("label", "digest").count().collect():
            last.setdefault(r.label, []).append((r.digest, r["count"]))
        for c, found in last.items():
            for digest, n in sorted(found):
                left[c] -= n
                if left[c] <= 0:
                    cuts[c] = digest
                    break
    return cuts


def with_stratified_split(
    df: DataFrame, key: str = "part_id", label: str = TARGET, share: float = TEST_SHARE, seed: int = SEED
) -> DataFrame:
    """`df` with `is_test`, true for round(share * rows) rows of each class, those with the smallest digests of their key.

    A null label is a class of its own. Rows that share a key go to one side, so a class whose last tested key repeats
    has some rows more. The flag is a comparison with one literal a class: no exchange, the same on every run.
    """
    digest, tested = split_digest(F.col(key), seed), F.lit(False)
    for c, cut in stratified_cuts(df, key, label, share, seed).items():
        tested = F.when(F.col(label).eqNullSafe(c), digest <= cut).otherwise(tested)
    return df.withColumn("is_test", tested)


def stratified_split_profile(df: DataFrame) -> DataFrame:
    """Rows per class and side of the stratified split, with the keys at the sides' ends by digest."""
    digest = split_digest(F.col("part_id"))
    return (
        with_stratified_split(df)
        .groupBy(TARGET, "is_test")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.min_by("part_id", digest).alias("first_part"),
            F.max_by("part_id", digest).alias("last_part"),
        )
        .orderBy(TARGET, "is_test")
    )


def split_profile(df: DataFrame) -> DataFrame:
    """Rows per class and side of the split."""
    return (
        with_split(df)
        .groupBy(TARGET, "is_test")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(TARGET, "is_test")
    )


def prepare_checkpoints(spark: SparkSession, folder: str | None = None) -> None:
    """Let iterative training cut its lineage in a shared folder.

    It is the folder given, else the one named in `spark.checkpoint.dir`. With neither, training keeps its whole
    lineage and says so.
    """
    context = spark.sparkContext
    if folder is None and context.getCheckpointDir() is not None:
        return
    folder = folder or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        warnings.warn("spark.checkpoint.dir is not set: boosting keeps its whole lineage", stacklevel=3)
    else:
        context.setCheckpointDir(folder)


def with_class_weights(train: DataFrame, weights: dict[int, float]) -> DataFrame:
    return train.withColumn(
        WEIGHT, F.when(F.col(TARGET) == 1, weights[1]).otherwise(weights[0])
    )


def balanced_weights(train: DataFrame) -> tuple[int, dict[int, float]]:
    """Row count and the weight n / (2 · class rows) of each class."""
    row = train.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(TARGET) == 1).alias("pos")
    ).first()
    negative = row.n - row.pos
    if not row.pos or not negative:
        raise ValueError("Training needs rows of both classes")
    return row.n, {0: row.n / (2 * negative), 1: row.n / (2 * row.pos)}


def feature_stages(scale: bool = False) -> list:
    """One-hot categories (unknown ones become all zeros) and numeric columns.

    The indexer keeps unknown values in an extra last slot, and the encoder drops exactly
    that slot, so every known category keeps its own indicator.
    """
    indexed = [f"{c}_index" for c in CATEGORICAL]
    encoded = [f"{c}_onehot" for c in CATEGORICAL]
    stages = [
        StringIndexer(
            inputCols=list(CATEGORICAL),
            outputCols=indexed,
            handleInvalid="keep",
            stringOrderType="alphabetAsc",
        ),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
    ]
    numeric = list(NUMERIC)
    if scale:
        stages += [
            VectorAssembler(inputCols=numeric, outputCol="numeric_raw", handleInvalid="keep"),
            StandardScaler(
                inputCol="numeric_raw", outputCol="numeric_scaled", withMean=True, withStd=True
            ),
        ]
        numeric = ["numeric_scaled"]
    stages.append(
        VectorAssembler(
            inputCols=[*encoded, *numeric], outputCol="features", handleInvalid="keep"
        )
    )
    return stages


def forest_pipeline(**overrides) -> Pipeline:
    """The production model."""
    forest = RandomForestClassifier(
        labelCol=TARGET,
        weightCol=WEIGHT,
        featureSubsetStrategy="sqrt",
        seed=SEED,
        maxMemoryInMB=1024,
        **{**FOREST_PARAMS, **overrides},
    )
    return Pipeline(stages=[*feature_stages(), forest])


def candidate_pipelines(rows: int, forest: dict | None = None, boosting: dict | None = None):
    """The compared models by name; `rows` turns the penalty into MLlib's mean-loss scale."""
    return {
        LOGISTIC: Pipeline(
            stages=[
                *feature_stages(scale=True),
                LogisticRegression(
                    labelCol=TARGET,
                    weightCol=WEIGHT,
                    regParam=1.0 / rows,
                    standardization=False,
                    **LOGISTIC_PARAMS,
                ),
            ]
        ),
        FOREST: forest_pipeline(**(forest or {})),
        BOOSTING: Pipeline(
            stages=[
                *feature_stages(),
                GBTClassifier(
                    labelCol=TARGET,
                    seed=SEED,
                    maxMemoryInMB=1024,
                    checkpointInterval=25,
                    **{**BOOSTING_PARAMS, **(boosting or {})},
                ),
            ]
        ),
    }


def training_rows(df: DataFrame, kept: Column | None = None) -> DataFrame:
    """Complete, labelled rows of the training side, those with `kept` where it is given."""
    labelled = coerce_numeric(df).filter(F.col(TARGET).isin(0, 1) & ~is_test(F.col("part_id")))
    return complete((labelled if kept is None else labelled.filter(kept)).select(*FEATURES, TARGET))


def test_rows(df: DataFrame) -> DataFrame:
    return coerce_numeric(df).filter(is_test(F.col("part_id")))


def complete(df: DataFrame) -> DataFrame:
    """Rows with every reading: only they are trained on, scored and counted in a comparison."""
    return df.dropna(subset=list(NUMERIC))


def fit(
    df: DataFrame,
    pipelines=None,
    names: Sequence[str] = (FOREST,),
    checkpoints: str | None = None,
    tasks: int | None = None,
    rows: int | None = None,
) -> dict[str, PipelineModel]:
    """Fit the named models on the training side of `df`, all of it.

    Only a caller that names `rows` gets a model of about so many labelled rows at most, chosen by a digest of their
    key. They are dealt over `tasks` partitions, by default as `training_tasks` has it, however the input is stored.

    `pipelines(rows)` gives the candidates. The training rows are read once and kept, since
    every model passes over them many times. `checkpoints` is a folder that all executors share.
    """
    prepare_checkpoints(df.sparkSession, checkpoints)
    known = training_rows(df).count()
    bounded = rows is not None and rows < known
    kept = split_digest(F.col("part_id"), SEED + 1) % known < rows if bounded else None
    train = training_rows(df, kept).repartition(tasks or training_tasks(min(known, rows) if bounded else known)).persist()
    try:
        count, weights = balanced_weights(train)
        weighted = with_class_weights(train, weights)
        candidates = (pipelines or candidate_pipelines)(count)
        return {name: without_summary(grown(candidates[name], weighted, count)) for name in names}
    finally:
        train.unpersist()


def training_tasks(rows: int) -> int:
    """Partitions of so many training rows.

    Every one sends statistics of all trees' nodes each level, so few rows want few. The number depends on the rows
    alone, as a forest's draws depend on it.
    """
    return max(TRAINING_TASKS, min(-(-rows // TASK_ROWS), SPREAD_TASKS), -(-rows // FULL_TASK_ROWS))


def grown(pipeline: Pipeline, train: DataFrame, rows: int) -> PipelineModel:
    """The fitted pipeline; a forest over many rows is grown some trees at a time, each lot from a seed of its own.

    So what is kept with every row, and what a task sums up for the nodes of a level, does not grow with the forest.
    """
    *stages, last = pipeline.getStages()
    at_once = max(TREES_AT_ONCE, BAGGED // rows)
    if not isinstance(last, RandomForestClassifier) or last.getNumTrees() <= at_once:
        return pipeline.fit(train)
    ready, trees = Pipeline(stages=stages).fit(train), last.getNumTrees()
    known = ready.transform(train).select(last.getFeaturesCol(), last.getLabelCol(), last.getWeightCol())
    lots = [
        last.copy({last.numTrees: min(at_once, trees - at), last.seed: last.getSeed() + at}).fit(known)
        for at in range(0, trees, at_once)
    ]
    return PipelineModel([*ready.stages, one_forest(last, lots)])


def one_forest(forest: RandomForestClassifier, lots: Sequence[RandomForestClassificationModel]) -> RandomForestClassificationModel:
    """The trees of all models as one model with the parameters of `forest`."""
    spark = SparkSession.active()
    kinds = spark.sparkContext._jvm.org.apache.spark.ml
    trees = [tree for lot in lots for tree in lot._java_obj.trees()]
    whole = spark.sparkContext._gateway.new_array(kinds.classification.DecisionTreeClassificationModel, len(trees))
    for at, tree in enumerate(trees):
        whole[at] = tree
    first = lots[0]._java_obj
    joined = kinds.classification.RandomForestClassificationModel(forest.uid, whole, first.numFeatures(), first.numClasses())
    forest._to_java().copyValues(joined, kinds.param.ParamMap())
    return forest._copyValues(RandomForestClassificationModel(joined))


def without_summary(model: PipelineModel) -> PipelineModel:
    """The model without its training summary.

    A summary holds the session, which goes to the workers with the model. Once the session has observed a table it
    can't be sent, and every use of the model would fail.
    """
    last = model.stages[-1]
    if getattr(last, "hasSummary", False):
        last = last.copy()
    if getattr(last, "hasSummary", False):
        spark = SparkSession.active()
        path = shared_path(spark, "model")
        try:
            last.write().save(path)
            last = type(last).load(path)
        finally:
            remove_table(spark, path)
    return PipelineModel([*model.stages[:-1], last])


def score(df: DataFrame, model: PipelineModel, decimals: int | None = 4) -> DataFrame:
    """The input with `scrap_probability`; rows with a missing reading get none."""
    prepared = coerce_numeric(df)
    probability = F.col(f"{GIVEN}.probability")
    if decimals is not None:
        probability = array_rounded(probability, decimals)
    incomplete = any_true([F.col(c).isNull() for c in NUMERIC])
    return with_given(prepared, model, GIVEN).select(
        *prepared.columns, F.when(~incomplete, probability).alias("scrap_probability")
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def feature_names(model: PipelineModel) -> list[str]:
    """Encoded feature names in vector order."""
    indexer = model.stages[0]
    names = [
        f"{column}_{label}"
        for column, labels in zip(CATEGORICAL, indexer.labelsArray)
        for label in labels
    ]
    return names + list(NUMERIC)


def feature_importance(model: PipelineModel, limit: int | None = None) -> DataFrame:
    """Importances by encoded feature name, largest first."""
    importances = model.stages[-1].featureImportances.toArray()
    rows = [(n, round(float(v), 6)) for n, v in zip(feature_names(model), importances)]
    table = SparkSession.active().createDataFrame(rows, "feature string, importance double")
    ranked = table.orderBy(F.desc("importance"), "feature")
    return ranked if limit is None else ranked.limit(limit)


def compared(df: DataFrame, models: dict[str, PipelineModel]) -> DataFrame:
    """(model, label, prediction, probability) of every complete, labelled test row and model, from one scan.

    The models run one after the other over the same rows, each under column names of its own.
    """
    scored = complete(test_rows(df).filter(F.col(TARGET).isin(0, 1)))
    scored = scored.select(*FEATURES, TARGET)
    for i, model in enumerate(models.values()):
        scored = with_given(scored, model, f"given_{i}")
    rows = [
        F.struct(
            F.lit(name).alias("model"),
            F.col(TARGET).alias("label"),
            F.col(f"given_{i}.prediction").alias("prediction"),
            F.col(f"given_{i}.probability").alias("probability"),
        )
        for i, name in enumerate(models)
    ]
    return scored.select(F.inline(F.array(*rows)))


def model_comparison(df: DataFrame, models: dict[str, PipelineModel]) -> DataFrame:
    """Test-side metrics of every model, best first, from one scan of the test rows."""
    return confusion_metrics(compared(df, models), "prediction", "label", by=["model"]).orderBy(
        F.desc("f1_score"), F.desc("recall"), F.desc("precision"), "model"
    )


def best_models(comparison: DataFrame, production: str = FOREST) -> DataFrame:
    """The best model by F1 and the model kept for production, from one pass over the comparison."""
    metrics = ("model", "accuracy", "precision", "recall", "f1_score")
    row = F.struct(*metrics)
    # The first name wins among equals, so the order of names is turned round.
    backwards = F.transform(F.split("model", ""), lambda c: -F.ascii(c))
    rank = F.struct("f1_score", "recall", "precision", backwards)
    both = comparison.agg(
        F.max_by(row, rank).alias("best"),
        F.max(F.when(F.col("model") == production, row)).alias("kept"),
    )
    roles = F.array(
        F.struct(F.lit("best_by_f1").alias("role"), "best.*"),
        F.struct(F.lit("production").alias("role"), "kept.*"),
    )
    return both.select(F.inline(roles)).filter(F.col("model").isNotNull())


def training_profile(df: DataFrame) -> DataFrame:
    """(kind, name, value): what the pipelines learn from the training side before any model.

    Rows and weight of each class, rows of each category indicator, mean and sample deviation of each scaled reading.
    """
    rows = training_rows(df)
    count = F.count(F.lit(1)).cast("double")
    whole = rows.agg(
        count.alias("n"),
        *[F.count_if(F.col(TARGET) == k).cast("double").alias(f"class_{k}") for k in (0, 1)],
        *[F.avg(c).alias(f"mean_{c}") for c in NUMERIC],
        *[F.stddev_samp(c).alias(f"deviation_{c}") for c in NUMERIC],
    )

    def line(kind: str, name: str, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.lit(name).alias("name"), value.alias("value"))

    cells = [
        cell
        for k in (0, 1)
        for cell in (
            line("class_rows", str(k), F.col(f"class_{k}")),
            line("class_weight", str(k), F.col("n") / (2 * F.col(f"class_{k}"))),
        )
    ]
    cells += [line(kind, c, F.col(f"{kind}_{c}")) for c in NUMERIC for kind in ("mean", "deviation")]
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in CATEGORICAL])
    categories = (
        rows.select(F.inline(pairs))
        .filter(F.col("v").isNotNull())
        .groupBy("c", "v")
        .agg(count.alias("value"))
        .select(F.lit("indicator_rows").alias("kind"), F.concat_ws("_", "c", "v").alias("name"), "value")
    )
    return whole.select(F.inline(F.array(*cells))).unionByName(categories)


def model_checks(df: DataFrame, models: dict[str, PipelineModel]) -> DataFrame:
    """Per model: tested rows, their confusion cells' sum, probabilities outside [0, 1] and missing ones."""
    p = F.col("probability")
    cells = [
        F.count_if((F.col("prediction") == hit) & (F.col("label") == label))
        for hit in (0, 1)
        for label in (0, 1)
    ]
    return compared(df, models).groupBy("model").agg(
        F.count(F.lit(1)).alias("tested_rows"),
        (cells[0] + cells[1] + cells[2] + cells[3]).alias("cell_rows"),
        F.count_if((p < 0) | (p > 1)).alias("outside"),
        F.count_if(p.isNull() | F.isnan(p)).alias("missing"),
    )
