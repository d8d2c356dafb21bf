"""Toxicity: gradient-boosted trees over dense features of a whole text, with isotonic calibration.

Two lexicons give densities: a fixed one, and word stems learned from the labelled rows, since insults of one stem
take many endings.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linewarden.llm.common import LEAN_STEP, WordTable, as_bytes, in_fold, labelled_sample, slices, steps, sums, words_of

#: Labelled rows that a model is fitted on at most, about, unless a caller wants all.
SAMPLE_ROWS = 12_000
#: Words between an insult and an address that count as near.
REACH = 6
SEED = 11
#: Characters of a learned stem.
STEM_LENGTHS = range(4, 9)
#: Toxic training texts that have a stem at least, and the least share of toxic texts among all that have it.
STEM_TEXTS, STEM_PRECISION = 5, 0.7

# Insulting words, by language.
INSULTS = frozenset(
    """
    idiot idiots moron morons stupid dumb fool clown clowns loser losers scum trash garbage worthless pathetic
    disgusting filth filthy vermin imbecile cretin dimwit halfwit jerk creep freak pig rat coward liar ugly useless
    dummkopf depp trottel versager abschaum widerlich dumm
    crétin abruti imbécile ordure minable nul dégoûtant connard
    idiota estúpido imbécil basura asqueroso inútil patético payaso
    """.split()
)
# Profane words and threats, by language.
PROFANE = frozenset(
    """
    damn hell crap shit bullshit fuck fucking bitch bastard ass asshole piss kill die hate
    scheiße arschloch mist verdammt hasse merde putain salaud mierda puta cabrón odio
    """.split()
)
# Words that address the reader, by language.
ADDRESS = frozenset("you your yours yourself u ur du dich dir dein deine ihr tu toi ton ta te vous votre tú ti usted".split())
COUNTED = pa.schema([("stem", pa.string()), ("texts", pa.int64())])
#: Stems that a task counts, about, before it hands them on.
COUNTED_STEMS = 20_000
LOOKALIKES = str.maketrans("013457@$!|", "oieastasil")
FEATURES = (
    "log_words", "stems", "stem_density", "insults", "insult_density", "profane_density", "obfuscated", "near_address",
    "address_density", "capitals", "exclamation_density", "punctuation_density", "inner_symbols",
)


def folded(word: str) -> str:
    """A word as it reads once look-alike characters, inner punctuation and stretched letters are undone."""
    plain = re.sub(r"[\W_]+", "", word.translate(LOOKALIKES))
    return re.sub(r"(.)\1+", r"\1", plain)


FOLDED = {folded(w): w for w in INSULTS | PROFANE}


def core_of(word: bytes) -> str:
    """A word in lower case without signs at its ends."""
    return re.sub(r"^[\W_]+|[\W_]+$", "", word.decode("utf-8", "replace")).lower()


def stems_of(core: str) -> list[str]:
    return [core[:n] for n in STEM_LENGTHS if len(core) >= n]


def word_traits(word: bytes, stems: frozenset[str] = frozenset()) -> tuple[float, ...]:
    """Stem, insult, profanity, obfuscated, address, capitals, exclamation marks, punctuation, inner symbols."""
    text, core = word.decode("utf-8", "replace"), core_of(word)
    inner = bool(re.search(r"\w[\W\d_]+\w", core)) and any(c.isalpha() for c in core)
    insult, profane = core in INSULTS, core in PROFANE
    odd = inner or re.search(r"(.)\1\1|[@$!|]\w", text.lower()) is not None
    hidden = FOLDED.get(folded(text.lower())) if odd and len(core) > 2 and not (insult or profane) else None
    return (
        any(s in stems for s in stems_of(core)), insult or hidden in INSULTS, profane, hidden is not None,
        core in ADDRESS, len(core) > 1 and text.isupper(), text.count("!") + text.count("?"),
        sum(not c.isalnum() for c in text), inner,
    )


def learn_stems(sample: DataFrame) -> frozenset[str]:
    """Stems that mark toxic texts among rows of (text, label); equal texts count once."""
    once = sample.groupBy(F.xxhash64("text").alias("key")).agg(F.first("text").alias("text"), F.max("label").alias("label"))

    def counted(among: frozenset[str] | None):
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: Counter[str] = Counter()
            for batch in slices(batches, 200):
                for text in as_bytes(batch.column(0)):
                    own = {s for w in set(text.split()) for s in stems_of(core_of(w))}
                    seen.update(own if among is None else own & among)
                if len(seen) > COUNTED_STEMS:
                    yield pa.RecordBatch.from_pydict({"stem": list(seen), "texts": list(seen.values())}, COUNTED)
                    seen.clear()
            yield pa.RecordBatch.from_pydict({"stem": list(seen), "texts": list(seen.values())}, COUNTED)

        return count

    def totals(rows: DataFrame, among: frozenset[str] | None = None) -> DataFrame:
        each = rows.select("text").mapInArrow(counted(among), "stem string, texts long")
        return each.groupBy("stem").agg(F.sum("texts").alias("texts"))

    toxic = {r.stem: r.texts for r in totals(once.where("label = 1")).where(F.col("texts") >= STEM_TEXTS).collect()}
    clean = {r.stem: r.texts for r in totals(once.where("label = 0"), frozenset(toxic)).collect()}
    return frozenset(s for s, n in toxic.items() if n >= STEM_PRECISION * (n + clean.get(s, 0)))


def text_features(texts: list[bytes], table: WordTable) -> np.ndarray:
    words, bounds = words_of(texts)
    numbers = table.numbers(words)
    traits = table.rows(np.float32)
    n = np.diff(bounds).astype(float)
    if not len(words):
        return np.zeros((len(texts), len(FEATURES)))
    each = traits[numbers]
    total = sums(each, bounds)
    addressed = np.flatnonzero(each[:, 4] > 0)
    hits = np.flatnonzero(each[:, :3].any(axis=1))
    near = np.zeros(len(words))
    if len(addressed) and len(hits):
        doc = np.searchsorted(bounds, hits, "right") - 1
        first = np.searchsorted(addressed, np.maximum(hits - REACH, bounds[doc]))
        last = np.searchsorted(addressed, np.minimum(hits + REACH + 1, bounds[doc + 1]))
        near[hits] = last > first
    share = 100 / np.maximum(n, 1)
    return np.column_stack([
        np.log1p(n), total[:, 0], total[:, 0] * share, total[:, 1], total[:, 1] * share, total[:, 2] * share,
        total[:, 3], sums(near, bounds), *(total[:, i] * share for i in range(4, 9)),
    ])


def features(stems: frozenset[str]) -> Callable[[Column], Column]:
    """A function from a column of texts to arrays of FEATURES."""

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def measured(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = WordTable(partial(word_traits, stems=stems))
        width = len(FEATURES)
        for batch in slices(batches):
            texts = as_bytes(batch)
            parts = [text_features(texts[a:b], words) for a, b in steps(texts, LEAN_STEP)] or [np.zeros((0, width))]
            flat = np.concatenate(parts).ravel()
            yield pa.ListArray.from_arrays(np.arange(0, flat.size + 1, width, dtype=np.int32), pa.array(flat))

    return measured


def _vectors(df: DataFrame, source: str) -> DataFrame:
    columns = [F.col(source)[i].alias(f"toxic_{name}") for i, name in enumerate(FEATURES)]
    kept = [c for c in df.columns if c != source]
    spread = df.select(*kept, *columns)
    names = [f"toxic_{name}" for name in FEATURES]
    return VectorAssembler(inputCols=names, outputCol="toxic_features").transform(spread).drop(*names)


@dataclass
class ToxicityModel:
    """Trees and calibration, or a constant where the labels hold one class or none."""

    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    constant: float = 0.0
    stems: frozenset[str] = frozenset()

    def add_score(self, docs: DataFrame, name: str = "toxic_score") -> DataFrame:
        """`docs` with a score from 0 to 1 in the given column; an empty or null text gets the features of no words."""
        if self.trees is None:
            return docs.withColumn(name, F.lit(self.constant))
        rows = docs.select(F.struct("*").alias("row"), features(self.stems)(F.col("text").cast("string")).alias("raw"))
        margins = self.trees.transform(_vectors(rows, "raw")).withColumn("margin", margin("rawPrediction"))
        scored = self.calibration.transform(margins)
        return scored.select("row.*", F.least(F.greatest("calibrated", F.lit(0.0)), F.lit(1.0)).alias(name))


def margin(raw: str) -> Column:
    return vector_to_array(raw)[1]


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, rows: int | None = SAMPLE_ROWS) -> ToxicityModel:
    """Learns `labels.toxic` from about `rows` labelled documents at most (None: from all), outside the held-out fold.

    Four fifths of them grow the trees, the rest fit the calibration. Without both classes among the trees' rows
    the score is the share of toxic labels, 0 without labels.
    """
    calibrating = in_fold(F.concat(F.col("doc_id").cast("string"), F.lit("-calibration")), 5, 0)
    sample = labelled_sample(docs, labels, "toxic", lambda key: ~in_fold(key, folds, held), rows).withColumn(
        "calibrating", calibrating
    ).persist(StorageLevel.DISK_ONLY)
    try:
        growing = sample.where("NOT calibrating")
        classes = {r["label"]: r["n"] for r in growing.groupBy("label").agg(F.count("*").alias("n")).collect()}
        if len(classes) < 2:
            return ToxicityModel(None, None, max(classes, default=0.0))
        stems = learn_stems(growing)
        known = _vectors(sample.select("calibrating", "label", features(stems)("text").alias("raw")), "raw").persist()
        try:
            trees = GBTClassifier(
                featuresCol="toxic_features", labelCol="label", maxIter=20, maxDepth=3, stepSize=0.3,
                minInstancesPerNode=5, seed=SEED,
            ).fit(known.where("NOT calibrating"))
            held_back = known.where("calibrating")
            if held_back.select("label").distinct().count() < 2:
                held_back = known
            margins = trees.transform(held_back).select("label", margin("rawPrediction").alias("margin"))
            calibration = IsotonicRegression(
                featuresCol="margin", labelCol="label", predictionCol="calibrated", isotonic=True
            ).fit(margins)
        finally:
            known.unpersist()
        return ToxicityModel(trees, calibration, stems=stems)
    finally:
        sample.unpersist()
