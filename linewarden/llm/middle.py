"""Fill-in-middle transformation with cut positions kept as a Roaring-style set.

The ends of a text's tokens, in code points, form a set that is cut into chunks of 2^16 positions. Each chunk is held as
the smallest of three containers: a sorted array, a bitmap, or runs. Cumulative cardinalities of the containers tell
which one holds the k-th boundary, and a select within that container tells where it is, so both cut offsets of a text
are found without walking its tokens. Ends of words fall into arrays or bitmaps; with characters as units every
position is a boundary, and a chunk is one run.

Which documents are rearranged, how, and where they are cut follows from a digest of seed and id alone: it is the same
on every run and partitioning, and no exchange is needed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linewarden.llm.common import as_bytes, slices, steps
from linewarden.llm.tokens import SPACES, marks

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
#: Percent of documents that are rearranged, and of those with the suffix first.
RATE, SUFFIX_FIRST = 50, 80
CHUNK_BITS = 16
CHUNK = 1 << CHUNK_BITS
#: Bytes of a bitmap container; an array takes two a member, runs four each.
BITMAP_BYTES = CHUNK // 8
BLANK = marks(SPACES)


@dataclass(frozen=True)
class ArrayContainer:
    """Sorted members."""

    members: np.ndarray

    def select(self, k: int) -> int:
        return int(self.members[k])


@dataclass(frozen=True)
class BitmapContainer:
    """One bit a position, in 64-bit words, with the number of members up to and with each word."""

    words: np.ndarray
    totals: np.ndarray

    @classmethod
    def of(cls, members: np.ndarray) -> BitmapContainer:
        flags = np.zeros(CHUNK, bool)
        flags[members] = True
        words = np.packbits(flags, bitorder="little").view(np.uint64)
        return cls(words, np.cumsum(np.bitwise_count(words), dtype=np.int64))

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.totals, k, side="right"))
        word = int(self.words[at])
        for _ in range(k - (int(self.totals[at - 1]) if at else 0)):
            word &= word - 1
        return 64 * at + (word & -word).bit_length() - 1


@dataclass(frozen=True)
class RunContainer:
    """First positions of runs of consecutive members, with the number of members up to and with each run."""

    firsts: np.ndarray
    totals: np.ndarray

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.totals, k, side="right"))
        return int(self.firsts[at]) + k - (int(self.totals[at - 1]) if at else 0)


Container = ArrayContainer | BitmapContainer | RunContainer


def container(members: np.ndarray) -> Container:
    """The smallest container of sorted distinct positions below CHUNK; of equals the array, then the bitmap."""
    opens = np.flatnonzero(np.diff(members, prepend=-2) != 1)
    if 4 * len(opens) < min(2 * len(members), BITMAP_BYTES):
        return RunContainer(members[opens].astype(np.uint16), np.append(opens[1:], len(members)))
    if 2 * len(members) > BITMAP_BYTES:
        return BitmapContainer.of(members)
    return ArrayContainer(members.astype(np.uint16))


@dataclass(frozen=True)
class BoundarySet:
    """Chunk numbers, their containers, and the cardinality before each container and of all."""

    chunks: np.ndarray
    containers: list[Container]
    totals: np.ndarray

    @classmethod
    def of(cls, positions: np.ndarray) -> BoundarySet:
        """The set of sorted distinct positions."""
        chunk = positions >> CHUNK_BITS
        firsts = np.flatnonzero(np.diff(chunk, prepend=-1))
        bounds = np.append(firsts, len(positions))
        parts = [container(positions[a:b] & (CHUNK - 1)) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        return cls(chunk[firsts], parts, bounds)

    def __len__(self) -> int:
        return int(self.totals[-1])

    def select(self, k: int) -> int:
        """The k-th smallest position, counted from 0."""
        at = int(np.searchsorted(self.totals, k, side="right")) - 1
        return (int(self.chunks[at]) << CHUNK_BITS) + self.containers[at].select(k - int(self.totals[at]))

    def offset(self, units: int) -> int:
        """Where the first so many units end."""
        return self.select(units - 1) if units else 0


def word_ends(texts: Sequence[bytes]) -> Iterator[np.ndarray]:
    """For each text the ends of its tokens, in code points.

    A token is a word with the separators before it; separators at the end of the text are one more token.
    """
    raw = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    blank = BLANK[raw]
    points = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=points[1:])
    ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    firsts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=firsts[1:])
    cuts = np.searchsorted(ends, firsts, side="right")
    places = points[ends]
    for i, text in enumerate(texts):
        found = places[cuts[i] : cuts[i + 1]] - points[firsts[i]]
        if text and blank[firsts[i] + len(text) - 1]:
            found = np.append(found, points[firsts[i] + len(text)] - points[firsts[i]])
        yield found


def character_ends(texts: Sequence[bytes]) -> Iterator[np.ndarray]:
    for text in texts:
        yield np.arange(1, len(text.decode("utf-8", "replace")) + 1)


UNITS = {"words": word_ends, "characters": character_ends}
CUTS = T.StructType([T.StructField(f, T.LongType()) for f in ("n", "first", "second")])


def cuts(text: Column, one: Column, other: Column, units: str = "words") -> Column:
    """struct(n, first, second): units of the text and the offsets, in code points, of its two cuts.

    The cuts lie after `one` and `other` modulo n + 1 units, the smaller first. A null text has no units.
    """
    ends_of = UNITS[units]

    @F.arrow_udf(CUTS)
    def found(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for batch in batches:
            for texts, ones, others in zip(*map(slices, map(lambda x: [x], batch)), strict=True):
                yield pa.StructArray.from_arrays(list(cut(as_bytes(texts), ones, others)), ["n", "first", "second"])

    def cut(texts: list[bytes], ones: pa.Array, others: pa.Array) -> Iterator[pa.Array]:
        out = np.zeros((len(texts), 3), np.int64)
        drawn = np.stack([ones.to_numpy(), others.to_numpy()], axis=1) if len(texts) else np.zeros((0, 2), np.int64)
        for a, b in steps(texts):
            for row, ends in enumerate(ends_of(texts[a:b]), a):
                held = BoundarySet.of(ends)
                low, high = sorted((drawn[row] % (len(held) + 1)).tolist())
                out[row] = len(held), held.offset(low), held.offset(high)
        return map(pa.array, out.T.copy())

    return found(text, one, other)


def draws(doc_id: Column, seed: int = SEED) -> list[Column]:
    """Four unsigned 32-bit numbers from the digest of seed and id; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def rearranged(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", units: str = "words", seed: int = SEED,
    rate: int = RATE, suffix_first: int = SUFFIX_FIRST,
) -> DataFrame:
    """(doc_id, n, form, output, prefix_chars, middle_chars) of every row.

    `form` is plain, psm (prefix, suffix, middle) or spm (suffix, prefix, middle); `output` is the text or its parts
    behind their marks. Texts that are null (as if empty), empty or hold a mark already stay plain and have no
    `prefix_chars` and `middle_chars`. A cut before the first or after the last unit leaves parts empty. Repeated rows
    are answered each, an empty table gives an empty result, texts of any length are handled whole, and other columns
    of `docs` are not read.
    """
    one, two, three, four = draws(F.col("doc_id"), seed)
    known = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    ).withColumn("found", cuts(F.col("text"), one, two, units))
    whole, first, second = F.col("text"), F.col("found.first").cast("int"), F.col("found.second").cast("int")
    marked = F.contains(whole, F.lit(PREFIX)) | F.contains(whole, F.lit(SUFFIX)) | F.contains(whole, F.lit(MIDDLE))
    form = (
        F.when((whole == "") | marked | (F.pmod(three, F.lit(100)) >= rate), "plain")
        .when(F.pmod(four, F.lit(100)) < suffix_first, "spm").otherwise("psm")
    )
    rest = F.length(whole) - second
    prefix, middle = F.substring(whole, 1, first), F.substring(whole, first + 1, second - first)
    suffix = F.substring(whole, second + 1, rest)
    mark = F.lit
    output = (
        F.when(F.col("form") == "psm", F.concat(mark(PREFIX), prefix, mark(SUFFIX), suffix, mark(MIDDLE), middle))
        .when(F.col("form") == "spm", F.concat(mark(SUFFIX), suffix, mark(PREFIX), prefix, mark(MIDDLE), middle))
        .otherwise(whole)
    )
    changed = F.col("form") != "plain"
    return known.withColumn("form", form).select(
        "doc_id", F.col("found.n").alias("n"), "form", output.alias("output"),
        F.when(changed, F.col("found.first")).alias("prefix_chars"),
        F.when(changed, F.col("found.second") - F.col("found.first")).alias("middle_chars"),
    )


def restored(output: Column, form: Column) -> Column:
    """The text that an output of this form was made of.

    No part holds a mark, and no mark's end begins another, so splitting at the marks gives the parts back.
    """
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (
        F.when(form == "psm", F.concat(part[1], part[3], part[2]))
        .when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output)
    )
