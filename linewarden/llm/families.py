"""Language identification by hierarchical discrimination.

The language family is predicted first; one-versus-one linear support vector machines then separate the languages
within it. Families are told apart in the same way.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linewarden.llm.common import as_bytes, in_fold, slices, steps

#: Hashed runs of 2, 3 and 4 bytes; documents of each language that a model is fitted on at most, about.
BUCKETS, SAMPLE_ROWS = 2048, 500
RUNS = (2, 3, 4)
UNKNOWN = "und"
#: Passes over the rows of a pair, and the most that one row may weigh.
ROUNDS, PENALTY = 20, 1.0

# Families of language codes. A language that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "fy", "af", "lb"),
    "romance": ("fr", "es", "it", "pt", "ca", "ro", "gl", "oc"),
    "slavic": ("ru", "pl", "cs", "sk", "uk", "be", "bg", "sr", "hr", "sl", "mk"),
    "uralic": ("fi", "et", "hu"),
    "baltic": ("lt", "lv"),
    "indo_aryan": ("hi", "bn", "ur", "mr", "gu", "pa", "ne"),
    "semitic": ("ar", "he", "mt", "am"),
    "turkic": ("tr", "az", "kk", "uz"),
}
FAMILY_OF = {language: family for family, languages in FAMILIES.items() for language in languages}

#: Letters in lower case and other characters as they are; what is neither is a blank.
CODES = np.full(256, 32, np.uint8)
CODES[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
CODES[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
CODES[128:] = np.arange(128, 256)


def family(language: str) -> str:
    return FAMILY_OF.get(language, language)


def has_letter(text: bytes) -> bool:
    """Whether a character is a letter to Unicode (L), as the learned texts are chosen; numerals like \u2167 are none."""
    if re.search(rb"[A-Za-z]", text):
        return True
    return not text.isascii() and any(map(str.isalpha, text.decode("utf-8", "replace")))


def runs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte runs at each place, a row for each length, and where texts start and the last ends."""
    codes = CODES[np.frombuffer(b" " + b" ".join(texts) + b"     ", np.uint8)].astype(np.uint32)
    n = sum(len(t) + 1 for t in texts)
    key, columns = codes[:n], []
    for length in range(2, RUNS[-1] + 1):
        key = key * np.uint32(257) + codes[length - 1 : n + length - 1]
        if length in RUNS:
            spread = (key ^ np.uint32(length * 0x3C6EF372)) * np.uint32(0x9E3779B1)
            columns.append((spread >> np.uint32(21)).astype(np.int32))
    firsts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=firsts[1:])
    return np.stack(columns), firsts


def text_shares(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The share of each bucket in every text's runs."""
    rows, firsts = runs(texts)
    for start, stop in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
        yield np.bincount(rows[:, start:stop].ravel(), minlength=BUCKETS) / (len(RUNS) * (stop - start))


def machine(rows: np.ndarray, signs: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and offset of a linear support vector machine, by dual coordinate descent in a fixed order.

    Buckets are scaled by their deviation for the training, and the weights back again.
    """
    scale = rows.std(axis=0)
    scale = np.where(scale > 0, 1 / np.maximum(scale, 1e-12), 0)
    points = rows * scale
    sizes = (points**2).sum(axis=1) + 1
    order = np.random.default_rng(0).permutation(len(rows))
    weights, offset, given = np.zeros(rows.shape[1]), 0.0, np.zeros(len(rows))
    for _ in range(ROUNDS):
        for i in order:
            slope = signs[i] * (points[i] @ weights + offset) - 1
            fresh = min(max(given[i] - slope / sizes[i], 0.0), PENALTY)
            if fresh != given[i]:
                step = (fresh - given[i]) * signs[i]
                weights += step * points[i]
                offset += step
                given[i] = fresh
    return weights * scale, offset


@dataclass
class Choice:
    """One-versus-one machines between classes: for each pair the weights and the offset; positive is the first."""

    classes: list[str]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    first: int = 0

    def votes(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The class that wins most pairs, by the sum of margins among equals, and its mean chance in its pairs."""
        count, total = np.zeros((2, len(margins), len(self.classes)))
        chance = np.zeros((len(margins), len(self.classes)))
        for k, (i, j) in enumerate(self.pairs):
            m = margins[:, self.first + k]
            p = 1 / (1 + np.exp(-np.clip(2 * m, -30, 30)))
            for at, sign, own in ((i, m, p), (j, -m, 1 - p)):
                count[:, at] += sign > 0
                total[:, at] += np.clip(sign, -30, 30)
                chance[:, at] += own
        if len(self.classes) == 1:
            return np.zeros(len(margins), np.int64), np.ones(len(margins))
        best = (count + 1e-3 * np.tanh(total / 100)).argmax(1)
        return best, chance[np.arange(len(margins)), best] / (len(self.classes) - 1)


@dataclass
class LanguageModel:
    top: Choice
    within: dict[str, Choice]
    weights: np.ndarray
    offsets: np.ndarray

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        margins = np.array([share @ self.weights for share in text_shares(texts)]).reshape(-1, len(self.offsets))
        margins += self.offsets
        chosen, certain = self.top.votes(margins)
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        for number, name in enumerate(self.top.classes):
            mine = np.flatnonzero(chosen == number)
            best, chance = self.within[name].votes(margins[mine])
            for at, language, p in zip(mine.tolist(), best.tolist(), chance.tolist(), strict=True):
                if has_letter(texts[at]):
                    names[at], scores[at] = self.within[name].classes[language], certain[at] * p
        return names, scores


def fit(docs: DataFrame, folds: int = 4, held: int = 2, rows: int = SAMPLE_ROWS) -> LanguageModel | None:
    """Learns `lang` from the texts of about `rows` documents of each language at most, outside the held-out fold.

    Every pair of classes is one group of bounded size; the pairs train side by side.
    None without a document that has a language, an id and a letter.
    """
    fair = docs.where(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}") & ~in_fold(F.col("doc_id"), folds, held)
    )
    counts = {r["lang"]: r["n"] for r in fair.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("lang")), F.lit(1_000_000))
    bound = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, int(1_000_000 * rows / n) + 1)])
    sample = fair.where(place < bound[F.col("lang")]).select("lang", F.col("text").cast("string").alias("text")).repartition(6)
    by_family: dict[str, list[str]] = {}
    for language in sorted(counts):
        by_family.setdefault(family(language), []).append(language)
    sides: list[tuple[list[str], list[str]]] = []

    def choice(groups: dict[str, list[str]]) -> Choice:
        names = sorted(groups)
        made = Choice(names, list(combinations(range(len(names)), 2)), len(sides))
        sides.extend((groups[names[i]], groups[names[j]]) for i, j in made.pairs)
        return made

    top = choice(by_family)
    within = {name: choice({language: [language] for language in own}) for name, own in by_family.items()}

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            languages, texts = batch.column(0).to_pylist(), as_bytes(batch.column(1))
            for a, b in steps(texts):
                out: dict[str, list] = {"pair": [], "sign": [], "shares": []}
                for language, share in zip(languages[a:b], text_shares(texts[a:b]), strict=True):
                    for number, both in enumerate(sides):
                        for sign, own in zip((1, -1), both, strict=True):
                            if language in own:
                                out["pair"].append(number)
                                out["sign"].append(sign)
                                out["shares"].append(share.astype(np.float32).tobytes())
                yield pa.RecordBatch.from_pydict(out, pa.schema([("pair", pa.int64()), ("sign", pa.int64()), ("shares", pa.binary())]))

    def trained(table: pa.Table) -> pa.Table:
        each = sorted(zip(table.column("shares").to_pylist(), table.column("sign").to_pylist(), strict=True))
        points = np.array([np.frombuffer(x, np.float32) for x, _ in each], float)
        weights, offset = machine(points, np.array([s for _, s in each], float))
        return pa.table({"pair": table.column("pair")[:1], "weights": pa.array([weights.tobytes()], pa.binary()), "offset": pa.array([offset])})

    machines = (
        sample.mapInArrow(dealt, "pair long, sign long, shares binary")
        .groupBy("pair").applyInArrow(trained, "pair long, weights binary, offset double")
    )
    table, offsets = np.zeros((len(sides), BUCKETS)), np.zeros(len(sides))
    for r in machines.collect() if sides else []:
        table[r.pair], offsets[r.pair] = np.frombuffer(r.weights), r.offset
    return LanguageModel(top, within, np.ascontiguousarray(table.T), offsets)


def add_language(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """`docs` with struct(lang_pred, score) in `found`; `und` and 0 for a text without a letter or without a model."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in slices(batches):
            texts = as_bytes(batch)
            names, scores = [], [np.zeros(0)]
            for a, b in steps(texts):
                some = shared.value.predict(texts[a:b]) if shared.value else ([UNKNOWN] * (b - a), np.zeros(b - a))
                names += some[0]
                scores.append(some[1])
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(np.concatenate(scores))], ["lang_pred", "score"]
            )

    return docs.withColumn("found", found(F.col("text").cast("string")))
