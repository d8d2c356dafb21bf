"""Quality classifier: logistic regression over hashed word n-grams, trained with FTRL-proximal updates."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linewarden.llm.common import as_bytes, in_fold, labelled_sample, slices, steps
from linewarden.llm.tokens import SPACES, WordHasher, combined, marks, mixed

#: Weights, labelled rows that a model is fitted on at most, about, rounds over them, and tasks that train apart.
BUCKETS, SAMPLE_ROWS, ROUNDS, TASKS = 1 << 18, 12_000, 4, 6
#: FTRL: step size, its softening, and the L1 and L2 penalties.
ALPHA, BETA, L1, L2 = 0.3, 0.1, 0.002, 0.001
#: What a text's n-grams of one kind weigh together.
SCALE = 10.0
CAPITALS, SMALL, SIGNS = marks(bytes(range(65, 91))), marks(bytes(range(97, 123))), marks(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")


def grams(texts: list[bytes], words: WordHasher) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word's n-grams, a row for each word, and the positions at which texts start and the last ends.

    A word gives itself, itself after the word before, its form, and its form after the form before. The form holds
    capitals, small letters, signs, a coarse length, and whether the word before was the same.
    """
    found = words.spans(texts)
    h = found.hashes
    signs = found.in_words(SIGNS)
    size = found.ends - found.starts
    before = np.concatenate([np.zeros(1, np.uint64), h[:-1]])
    opens = found.bounds[:-1][np.diff(found.bounds) > 0]
    before[opens] = 1
    form = (
        np.minimum(found.in_words(CAPITALS), 2) + 3 * (found.in_words(SMALL) > 0)
        + 6 * np.minimum(signs, 3) + 24 * (signs == size) + 48 * np.minimum(size // 4, 4) + 240 * (h == before)
    ).astype(np.uint64)
    earlier = np.concatenate([np.zeros(1, np.uint64), form[:-1]])
    earlier[opens] = 999
    rows = [h, combined(before, h), mixed(form + np.uint64(1 << 40)), mixed(form * np.uint64(1000) + earlier + np.uint64(1 << 50))]
    return np.stack([(r & np.uint64(BUCKETS - 1)).astype(np.int32) for r in rows], axis=1), found.bounds


def sparse(texts: Iterator[list[bytes]], words: WordHasher) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct buckets and their values for each text; a text's n-grams of one kind add up to SCALE."""
    for some in texts:
        rows, bounds = grams(some, words)
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            at, times = np.unique(rows[a:b], return_counts=True)
            yield at, (SCALE * times / max(b - a, 1)).astype(np.float32)


@dataclass
class Ftrl:
    """State of follow-the-regularised-leader: z and n of every weight, the bias last."""

    z: np.ndarray
    n: np.ndarray

    @classmethod
    def new(cls) -> Ftrl:
        return cls(np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1))

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z = self.z[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2)

    def learn(self, at: np.ndarray, value: np.ndarray, label: float) -> None:
        at, value = np.append(at, BUCKETS), np.append(value, 1.0)
        weight = self.weights(at)
        slope = (1 / (1 + np.exp(-np.clip(weight @ value, -30, 30))) - label) * value
        change = (np.sqrt(self.n[at] + slope**2) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += slope - change * weight
        self.n[at] += slope**2


def fit(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2, rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Weights learned from `labels.quality` of about `rows` labelled documents at most, outside the held-out fold.

    Each round, every task continues from the shared state over its own rows in a fixed order; the states are
    averaged. They have a fixed size. Without labels all weights are zero and every score is 0.5.
    """
    sample = labelled_sample(docs, labels, "quality", lambda key: ~in_fold(key, folds, held), rows, TASKS)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHasher(SPACES)
        for batch in batches:
            texts = as_bytes(batch.column("text"))
            found = list(sparse((texts[a:b] for a, b in steps(texts)), words))
            columns = [batch.column("label"), pa.array([f[0] for f in found], pa.list_(pa.int32()))]
            values = pa.array([f[1] for f in found], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([*columns, values], ["label", "at", "value"])

    ordered = sample.sortWithinPartitions(F.xxhash64("doc_id"), "doc_id")
    known = ordered.select("text", "label").mapInArrow(vectors, "label double, at array<int>, value array<float>").persist()
    context = docs.sparkSession.sparkContext
    state = Ftrl.new()
    try:
        for _ in range(ROUNDS):
            shared = context.broadcast(state)

            def train(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
                own, seen = Ftrl(shared.value.z.copy(), shared.value.n.copy()), 0
                for batch in batches:
                    for label, at, value in zip(*(batch.column(i) for i in range(3)), strict=True):
                        own.learn(at.values.to_numpy(), value.values.to_numpy(), label.as_py())
                        seen += 1
                columns = [pa.array([x.tobytes()], pa.binary()) for x in (own.z, own.n)]
                yield pa.RecordBatch.from_arrays([pa.array([seen]), *columns], ["seen", "z", "n"])

            parts = [r for r in known.mapInArrow(train, "seen long, z binary, n binary").collect() if r.seen]
            shared.destroy()
            if not parts:
                break
            share = np.array([r.seen for r in parts], float) / sum(r.seen for r in parts)
            state = Ftrl(*(sum(s * np.frombuffer(r[i]) for s, r in zip(share, parts, strict=True)) for i in ("z", "n")))
    finally:
        known.unpersist()
    return state.weights()


def add_score(docs: DataFrame, weights: np.ndarray, name: str = "score") -> DataFrame:
    """`docs` with the chance of label 1 in the given column; an empty or null text scores by the bias alone."""
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    @F.arrow_udf(T.DoubleType())
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words, weight = WordHasher(SPACES), shared.value
        for batch in slices(batches):
            texts, out = as_bytes(batch), [np.zeros(0)]
            for a, b in steps(texts):
                rows, bounds = grams(texts[a:b], words)
                total = np.concatenate([[0.0], np.cumsum(weight[rows].sum(1), dtype=np.float64)])
                dots = SCALE * (total[bounds[1:]] - total[bounds[:-1]]) / np.maximum(np.diff(bounds), 1)
                out.append(1 / (1 + np.exp(-np.clip(dots + weight[BUCKETS], -30, 30))))
            yield pa.array(np.concatenate(out))

    return docs.withColumn(name, score(F.col("text").cast("string")))
