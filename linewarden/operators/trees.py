"""Scores of tree models, many rows and trees at a time.

MLlib follows one row through one tree's node objects after the other, about a millisecond a row for 300 trees. Here
every reading becomes its place among the splits of its feature, once a row, and a block of rows walks down all trees
together, a level at a time, over arrays that stay in the processor's cache. Probabilities and predictions are those
of the model's `transform`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linewarden.sources.tables import remove_table, shared_path

#: Rows that walk together.
BLOCK = 128
GIVEN = T.StructType([T.StructField("prediction", T.DoubleType()), T.StructField("probability", T.DoubleType())])


@dataclass
class Trees:
    """Nodes of all trees, the right child behind the left one; a leaf is its own child and lets every place pass.

    `cuts` has the sorted splits of each feature and `rank` the place of a node's split among them. `values` are two
    rows by node: for a forest the shares of the classes, for boosting the weighted value and its negative.
    """

    cuts: list[np.ndarray]
    feature: np.ndarray
    rank: np.ndarray
    left: np.ndarray
    roots: np.ndarray
    values: np.ndarray
    depth: int
    boosted: bool

    def places(self, rows: np.ndarray) -> np.ndarray:
        """For each reading the number of splits below it; a missing one is above all, as no comparison holds for it."""
        return np.stack([np.searchsorted(cut, rows[:, i]) for i, cut in enumerate(self.cuts)], axis=1)

    def sums(self, rows: np.ndarray) -> np.ndarray:
        """The two sums over all trees, in the order of the trees."""
        out = np.empty((2, len(rows)))
        width = len(self.cuts)
        for at in range(0, len(rows), BLOCK):
            places = self.places(rows[at : at + BLOCK])
            first = np.arange(len(places)) * width
            flat = places.ravel()
            node = np.repeat(self.roots[:, None], len(places), axis=1)
            for _ in range(self.depth):
                above = flat.take(self.feature.take(node) + first) > self.rank.take(node)
                node = self.left.take(node)
                node += above
            for k in (0, 1):
                out[k, at : at + BLOCK] = np.add.reduce(self.values[k].take(node), axis=0)
        return out

    def given(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(prediction, probability of class 1) of rows of features."""
        zero, one = self.sums(rows)
        with np.errstate(over="ignore", invalid="ignore"):
            probability = 1 - 1 / (1 + np.exp(-2 * zero)) if self.boosted else one / (zero + one)
        return (one > zero).astype(np.float64), probability


def branch(node: dict) -> tuple[int, float, int, int] | None:
    """Feature, cut, child of readings up to the cut and child of those above; None for other than two categories."""
    split = node["split"]
    feature, given = split["featureIndex"], split["leftCategoriesOrThreshold"]
    children = node["leftChild"], node["rightChild"]
    if split["numCategories"] == -1:
        return feature, given[0], *children
    if split["numCategories"] != 2 or given not in ([0.0], [1.0]):
        return None
    # An indicator: the cut is 0, and where 1 goes left the children change places.
    return feature, 0.0, *(children if given == [0.0] else children[::-1])


def arranged(tables: list[list[dict]], weights: list[float], features: int, boosted: bool) -> Trees:
    """Trees from the stored nodes of each one, in which node 0 is the root."""
    splits: list[set[float]] = [set() for _ in range(features)]
    for nodes in tables:
        for n in nodes:
            if n["leftChild"] >= 0:
                splits[branch(n)[0]].add(branch(n)[1])
    cuts = [np.array(sorted(s)) for s in splits]
    ranks = [{cut: i for i, cut in enumerate(c.tolist())} for c in cuts]
    feature: list[int] = []
    rank: list[int] = []
    left: list[int] = []
    values: list[tuple[float, float]] = []
    roots, depth = [], 0

    def room() -> int:
        for column, empty in ((feature, 0), (rank, 1 << 40), (left, len(left)), (values, (0.0, 0.0))):
            column.append(empty)
        return len(left) - 1

    for nodes, weight in zip(tables, weights, strict=True):
        known = {n["id"]: n for n in nodes}
        level, height = [(0, room())], 0
        roots.append(level[0][1])
        while level:
            below = []
            for number, at in level:
                n = known[number]
                if n["leftChild"] < 0:
                    total = sum(n["impurityStats"])
                    shares = (n["impurityStats"][k] / total if total else 0.0 for k in (0, 1))
                    value = weight * n["prediction"]
                    values[at] = (-value, value) if boosted else tuple(shares)
                    continue
                feature[at], cut, low, high = branch(n)
                rank[at] = ranks[feature[at]][cut]
                left[at] = room()
                below += [(low, left[at]), (high, room())]
            height += bool(below)
            level = below
        depth = max(depth, height)
    whole = np.array
    return Trees(
        cuts, whole(feature, np.int64), whole(rank, np.int64), whole(left, np.int64), whole(roots, np.int64),
        np.ascontiguousarray(whole(values, np.float64).T), depth, boosted,
    )


@lru_cache(maxsize=16)
def read_trees(model: RandomForestClassificationModel | GBTClassificationModel) -> Broadcast | None:
    """The trees of a model for the workers; None if a split or the number of classes is of another kind.

    They come from its stored form, in the shared folder. The driver holds the nodes, whose number the model's
    parameters bound.
    """
    spark = SparkSession.active()
    path = shared_path(spark, "trees")
    try:
        model.write().save(path)
        nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()
    finally:
        remove_table(spark, path)
    tables: list[list[dict]] = [[] for _ in range(model.getNumTrees)]
    for r in nodes:
        tables[r.treeID].append(r.asDict(recursive=True))
    inner = [n for t in tables for n in t if n["leftChild"] >= 0]
    if model.numClasses != 2 or any(branch(n) is None for n in inner):
        return None
    boosted = isinstance(model, GBTClassificationModel)
    return spark.sparkContext.broadcast(arranged(tables, model.treeWeights, model.numFeatures, boosted))


def _walk(trees: Broadcast, features: Column) -> Column:
    @F.arrow_udf(GIVEN)
    def walk(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = batch.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(trees.value.cuts))
            yield pa.StructArray.from_arrays([pa.array(c) for c in trees.value.given(rows)], ["prediction", "probability"])

    # Otherwise a filter on the score would be moved below it together with a second walk.
    return walk.asNondeterministic()(vector_to_array(features))


def with_given(df: DataFrame, model: PipelineModel, name: str) -> DataFrame:
    """`df` with a struct(prediction, probability of class 1) of a fitted pipeline; its other columns are left out."""
    last = model.stages[-1]
    known = isinstance(last, (RandomForestClassificationModel, GBTClassificationModel))
    trees = read_trees(last) if known and not last.isDefined("thresholds") else None
    if trees is None:
        found = F.struct("prediction", vector_to_array("probability")[1].alias("probability"))
        return model.transform(df).select(*df.columns, found.alias(name))
    ready = PipelineModel(model.stages[:-1]).transform(df)
    return ready.select(*df.columns, _walk(trees, F.col(last.getFeaturesCol())).alias(name))
