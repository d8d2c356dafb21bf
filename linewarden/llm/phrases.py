"""Phrase collocations by top-order marginalisation.

Every word of a piece opens one window: itself and its three leads, padded at the piece's end. Only windows are
counted; as each occurrence of a phrase opens exactly one window, Spark's ROLLUP over the window's columns gives the
counts of all shorter phrases as sums over their prefixes, and the size of a language as the sum over all.

Before windows are counted, columns that can't be part of a phrase of MIN_COUNT occurrences are padded as well: words
and pairs, then triples and quadruples, are counted in hashed slots first, and a phrase whose slot holds fewer than
MIN_COUNT has fewer itself. This leaves every count of MIN_COUNT or more as it is. The slots have a fixed number, so
what is broadcast is bounded whatever the corpus; with more text fewer columns are padded and the windows' exchange
grows towards that of all windows, but results don't change.

Words are told apart by 64-bit hashes when a step of a task puts equal windows together (of n distinct windows of one
step about n^2 / 2^65 pairs collide); from there on by their text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linewarden.llm.common import as_bytes, slices, steps, written
from linewarden.llm.idfile import pack, unpack
from linewarden.llm.tokens import Spans, WordHasher, combined, marks, mixed

BREAKS = b".,;:!?\n\x0b\x0c\r"
MIN_COUNT, LONGEST = 30, 4
#: A phrase is dropped if a longer one has this many percent of its occurrences.
COVERED = 80
SCALE, TOP = 2_000_000, 2_000
UNKNOWN = "und"
#: Hashed slots of each length, 2^SLOT_BITS, in at most 2^SHARD_BITS shards.
SLOT_BITS, SHARD_BITS = 26, 8
#: Slots that a task gathers before it sends their counts, and bytes of text of one step over windows.
GATHERED, STEP_BYTES = 4_000_000, 3_000_000
#: Windows that are spelled at a time; each character of theirs takes some numbers meanwhile.
SPELLED = 50_000
WINDOW = tuple(f"w{k}" for k in range(1, LONGEST + 1))


@dataclass
class Grams:
    """Words of some texts in order: their spans, hashes by language, and how many words follow in the same piece."""

    spans: Spans
    hashes: np.ndarray
    follows: np.ndarray
    owners: np.ndarray

    def of(self, length: int) -> np.ndarray:
        """The hash of the phrase of that length which each word opens; only good where enough words follow."""
        found = mixed(self.hashes + np.uint64(length))
        for k in range(1, length):
            found[: len(found) - k] = combined(found[: len(found) - k], self.hashes[k:])
        return found


class Reader:
    """Splits texts into pieces and words."""

    def __init__(self) -> None:
        self.words = WordHasher(b" \t" + BREAKS)
        self.breaks = marks(BREAKS)

    def __call__(self, texts: Sequence[bytes], langs: Sequence[str]) -> Grams:
        spans = self.words.spans(texts)
        closed = np.zeros(len(spans.raw) + 1, np.int64)
        np.cumsum(self.breaks[spans.raw], out=closed[1:])
        owners = spans.owners()
        piece = closed[spans.starts] + owners
        follows = np.zeros(len(piece), np.int64)
        for k in range(1, LONGEST):
            follows[: max(0, len(piece) - k)] += piece[k:] == piece[: max(0, len(piece) - k)]
        salts = {lang: xxhash.xxh64_intdigest(lang.encode()) for lang in set(langs)}
        by_text = np.array([salts[lang] for lang in langs], np.uint64)
        return Grams(spans, combined(spans.hashes, by_text[owners]), follows, owners)


def text_and_lang(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text).cast("string").alias("text")
    ).where("text IS NOT NULL")


def readings(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Grams, list[str]]]:
    """The words of a task's texts, step by step, with the language of every text."""
    reader = Reader()
    for batch in batches:
        for rows in slices([batch]):
            texts, langs = as_bytes(rows.column("text")), rows.column("lang").to_pylist()
            for a, b in steps(texts, STEP_BYTES):
                yield reader(texts[a:b], langs[a:b]), langs[a:b]


@dataclass
class Filter:
    """For each length a bit a slot: whether it holds MIN_COUNT occurrences or more. Lengths without bits let all pass."""

    slot_bits: int
    bits: dict[int, np.ndarray]

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.slot_bits)).astype(np.int64)

    def passes(self, length: int, hashes: np.ndarray) -> np.ndarray:
        held = self.bits.get(length)
        if held is None:
            return np.ones(len(hashes), bool)
        slots = self.slots(hashes)
        return (held[slots >> 3] >> (slots & 7).astype(np.uint8) & 1).astype(bool)

    def reach(self, grams: Grams) -> np.ndarray:
        """For each word the number of words of its window, itself included, that a phrase may reach; 0 if none."""
        good = self.passes(1, grams.of(1))
        reach = good.astype(np.int64)
        pairs = np.zeros(len(good), bool)
        for length in range(2, LONGEST + 1):
            good = good & (grams.follows >= length - 1)
            if length == 2:
                good &= self.passes(2, grams.of(2))
                pairs = good
            else:
                later = np.zeros(len(good), bool)
                later[: max(0, len(good) - length + 2)] = pairs[length - 2 :]
                good &= later
                good &= self.passes(length, grams.of(length))
            reach += good
        return reach


def slot_counts(texts: DataFrame, lengths: Sequence[int], known: Filter) -> Filter:
    """Adds to the filter the slots of phrases of these lengths, counted over all texts.

    A task sends the slots it met, sorted and as differences, with their counts up to MIN_COUNT; the sums meet in one
    counter a slot for each shard of the slots, which stops at 255.
    """
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(known)
    low = max(3, known.slot_bits - SHARD_BITS)
    width = 1 << low

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {length: [] for length in lengths}
        size = 0
        for grams, _ in readings(batches):
            known = shared.value
            reach = known.reach(grams)
            for length in lengths:
                held[length].append(known.slots(grams.of(length)[reach >= length]))
                size += len(held[length][-1])
            if size > GATHERED:
                yield from sent(held)
                held, size = {length: [] for length in lengths}, 0
        yield from sent(held)

    def sent(held: dict[int, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for length, parts in held.items():
            slots, counts = np.unique(np.concatenate([np.zeros(0, np.int64), *parts]), return_counts=True)
            counts = np.minimum(counts, MIN_COUNT).astype(np.uint8)
            shards, firsts = np.unique(slots >> low, return_index=True)
            rows, bounds = [], np.append(firsts, len(slots))
            for shard, a, b in zip(shards.tolist(), bounds[:-1], bounds[1:], strict=True):
                control, data = pack(np.diff(slots[a:b] - (shard << low), prepend=0))
                rows.append((length, shard, control, data, counts[a:b].tobytes()))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["length", "shard", "control", "data", "counts"]
            )

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for row in slices([batch], 100):
                for length, shard, control, data, counts in zip(*(c.to_pylist() for c in row.columns), strict=True):
                    held = total.setdefault((length, shard), np.zeros(width, np.uint8))
                    spots = np.cumsum(unpack(control, data, len(counts)), dtype=np.int64)
                    more = held[spots].astype(np.uint16) + np.frombuffer(counts, np.uint8)
                    held[spots] = np.minimum(more, 255).astype(np.uint8)
        for (length, shard), counts in total.items():
            bits = np.packbits(counts >= MIN_COUNT, bitorder="little").tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([length], pa.int64()), pa.array([shard], pa.int64()), pa.array([bits], pa.binary())],
                ["length", "shard", "bits"],
            )

    found = texts.mapInArrow(gathered, "length long, shard long, control binary, data binary, counts binary")
    found = found.repartition("length", "shard").mapInArrow(summed, "length long, shard long, bits binary")
    bits = {length: np.zeros((1 << known.slot_bits) // 8, np.uint8) for length in lengths}
    for row in found.collect():
        bits[row.length][row.shard * width // 8 : (row.shard + 1) * width // 8] = np.frombuffer(row.bits, np.uint8)
    shared.destroy()
    return Filter(known.slot_bits, {**known.bits, **bits})


def spelled(spans: Spans, at: np.ndarray, reach: np.ndarray, codes: np.ndarray) -> pa.Array:
    """The windows that these words open, as many words as they reach, lower-cased and with a space between."""
    total = np.concatenate([[0], np.cumsum(reach)])
    words = np.arange(total[-1]) + np.repeat(at - total[:-1], reach)
    starts, sizes = spans.starts[words], spans.ends[words] - spans.starts[words] + 1
    ends = np.concatenate([[0], np.cumsum(sizes)])
    data = codes[spans.raw[np.arange(ends[-1]) + np.repeat(starts - ends[:-1], sizes)]]
    # Every word was taken with the character behind it, which becomes the space; a window's last one goes.
    data[ends[1:] - 1] = ord(" ")
    stays = np.ones(len(data), bool)
    full = reach > 0
    stays[ends[total[1:][full]] - 1] = False
    offsets = np.where(full, ends[total[1:]] - np.cumsum(full), 0)
    offsets = np.concatenate([[0], np.maximum.accumulate(offsets)])
    held = pa.py_buffer(data[stays].tobytes())
    return pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(offsets), held]).cast(pa.string())


def counted(grams: Grams, langs: Sequence[str], reach: np.ndarray, codes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The distinct windows of a step, with the number of words that open them, SPELLED at a time."""
    numbers = {lang: i for i, lang in enumerate(dict.fromkeys(langs))}
    key = combined(np.zeros(len(reach), np.uint64), np.array([numbers[x] for x in langs], np.uint64)[grams.owners])
    for length in range(1, LONGEST + 1):
        there = reach >= length
        key[there] = grams.of(length)[there]
    _, at, times = np.unique(key, return_index=True, return_counts=True)
    names = pa.array(langs, pa.string())
    for start in range(0, len(at), SPELLED):
        part = at[start : start + SPELLED]
        lang = names.take(pa.array(grams.owners[part]))
        window = spelled(grams.spans, part, reach[part], codes)
        yield pa.RecordBatch.from_arrays([lang, window, pa.array(times[start : start + SPELLED], pa.int64())], ["lang", "window", "a"])


def windows(texts: DataFrame, keep: Filter) -> DataFrame:
    """(lang, window, a): windows with the number of words that open them; padding, at a window's end, is left out.

    Equal windows of one step of a task are one row. Words that open no phrase have empty windows.
    """
    shared = texts.sparkSession.sparkContext.broadcast(keep)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = WordHasher().codes
        for grams, langs in readings(batches):
            if not len(grams.hashes):
                continue
            yield from counted(grams, langs, shared.value.reach(grams), codes)

    return texts.mapInArrow(found, "lang string, window string, a long")


def phrases(docs: DataFrame, text: str = "text", lang: str = "lang", slot_bits: int = SLOT_BITS) -> DataFrame:
    """(lang, size, phrase, a): phrases of up to four words with at least MIN_COUNT occurrences, in the shared folder.

    The size of each language, its number of words, is the row of size 0.
    """
    texts = text_and_lang(docs, text, lang)
    keep = slot_counts(texts, (1, 2), Filter(slot_bits, {}))
    keep = slot_counts(texts, (3, 4), keep)
    counted = windows(texts, keep).groupBy("lang", "window").agg(F.sum("a").alias("a"))
    column = lambda k: F.coalesce(F.get(F.split("window", " "), k), F.lit(""))
    longest = counted.select("lang", *[column(k).alias(w) for k, w in enumerate(WINDOW)], "a")
    prefixes = longest.rollup("lang", *WINDOW).agg(F.sum("a").alias("a"), F.grouping_id().alias("level"))
    # One bit for each column that is summed away, the last column's lowest.
    size = F.lit(LONGEST) - F.bit_count("level")
    sums = prefixes.where("lang IS NOT NULL").select("lang", size.alias("size"), *WINDOW, "a")
    # The last column of a prefix is not padding; then none of it is.
    last = F.element_at(F.array(F.lit("x"), *WINDOW), F.col("size") + 1)
    kept = sums.where((F.col("size") == 0) | ((last != "") & (F.col("a") >= MIN_COUNT)))
    return written(kept.select("lang", "size", F.concat_ws(" ", *WINDOW).alias("phrase"), "a"), "phrases")


def _words(phrase: Column, first: Column | int, size: Column | int) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), first, size), " ")


def scored(found: DataFrame) -> DataFrame:
    """(lang, phrase, size, a, l, r, score) of phrases of two words or more, at their lowest-scoring cut."""
    counts = found.where("size > 0").select("lang", "phrase", "a")
    cuts = found.where("size > 1").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select(
        "lang", "phrase", "size", "a", "k", _words(F.col("phrase"), 1, F.col("k")).alias("left"),
        _words(F.col("phrase"), F.col("k") + 1, F.col("size") - F.col("k")).alias("right"),
    )
    both = cuts.join(counts.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l")), ["lang", "left"]).join(
        counts.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r")), ["lang", "right"]
    )
    wide = "decimal(38,0)"
    # Exact to 38 digits: the quotient is floored in integers.
    score = F.expr(f"CAST({SCALE} AS {wide}) * CAST(a AS {wide}) DIV (CAST(l AS {wide}) + CAST(r AS {wide}))").cast("long")
    least = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return both.groupBy("lang", "phrase", "size", "a").agg(least).select(
        "lang", "phrase", "size", "a", "cut.l", "cut.r", "cut.score"
    )


def covered(found: DataFrame) -> DataFrame:
    """(lang, phrase, longest): the most occurrences of a longer phrase of the table that a phrase lies in."""
    inner = F.explode(
        F.expr(
            "flatten(transform(sequence(2, size - 1), s -> transform(sequence(1, size - s + 1), "
            "i -> array_join(slice(split(phrase, ' '), i, s), ' '))))"
        )
    )
    parts = found.where("size > 2").select("lang", inner.alias("phrase"), "a")
    return parts.groupBy("lang", "phrase").agg(F.max("a").alias("longest"))


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", top: int = TOP, slot_bits: int = SLOT_BITS
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best `top` phrases of two to four words of each language.

    Ordered by score, then by occurrences, both descending, then by the phrase's bytes. Texts that are null, empty or
    without words add nothing; a null language is `und`; repeated rows count each time; an empty table gives an empty
    result; very long texts are whole and other columns of `docs` are not read. A hot language is spread: windows are
    counted by their words, and only each task's best `top` of a language meet for the ranks.
    """
    found = phrases(docs, text, lang, slot_bits)
    sizes = found.where("size = 0").select("lang", F.col("a").alias("n"))
    kept = scored(found).join(covered(found), ["lang", "phrase"], "left").where(
        f"longest IS NULL OR CAST(100 AS DECIMAL(38,0)) * longest < CAST({COVERED} AS DECIMAL(38,0)) * a"
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
