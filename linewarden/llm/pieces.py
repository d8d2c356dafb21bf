"""SentencePiece BPE encoding and decoding by suffix-array matching.

Pieces never hold a space mark after another character, so a text is encoded word by word, a word being a run of
space marks and what follows it. The distinct new words of a batch are concatenated and their suffixes sorted by the
longest piece's length. A binary search finds each piece's range of suffixes: its occurrences, which are the edges of
a lattice. Sorted by position they are relaxed from left to right: of the edges that end at a position, exactly one
continues the encoding of its start so that BPE, run on the last two pieces alone, leaves both as they are. A
sequence whose neighbours all pass that test is the BPE encoding of the whole, so the ids equal those of the
merge procedure.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linewarden.llm.common import STEP_CHARS, slices, steps

MARK = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Stands between words in an index; no character.
GAP = 0x110000
#: Distinct words whose ids a worker keeps.
KEPT_WORDS = 200_000
#: Slots of the table of answers about pairs of pieces, a power of two.
SLOTS = 1 << 21
#: Words that are gathered before they are indexed, and characters of one index.
NEW_WORDS, INDEXED = 60_000, 450_000
SPACED = re.compile(" +[^ ]*")


@dataclass(frozen=True)
class Vocabulary:
    """Pieces that merges can make, their scores and ids, the ids of the 256 bytes, and what each id stands for."""

    ids: dict[str, int]
    scores: dict[str, float]
    bytes_at: tuple[int, ...]
    spelled: tuple[bytes, ...]

    @property
    def size(self) -> int:
        return len(self.spelled)


def load(path: str = MODEL) -> Vocabulary:
    """Reads a byte-fallback BPE model whose normalizer leaves texts as they are but for a leading space mark."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    every = range(model.vocab_size())
    names = [model.id_to_piece(i) for i in every]
    plain = [i for i in every if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    spelled = [b"" for _ in every]
    for i in plain:
        spelled[i] = names[i].replace(MARK, " ").encode()
    for i in every:
        if model.is_byte(i):
            spelled[i] = bytes([int(names[i][3:-1], 16)])
    single = {names[i] for i in plain if len(names[i]) == 1}
    if any(not single.issuperset(names[i]) or re.search(f"[^{MARK}]{MARK}", names[i]) for i in plain):
        raise ValueError("pieces must consist of characters that are pieces, with space marks in front only")
    return Vocabulary(
        {names[i]: i for i in plain}, {names[i]: model.get_score(i) for i in plain},
        tuple(model.piece_to_id(f"<0x{b:02X}>") for b in range(256)), tuple(spelled),
    )


def merged(text: str, scores: dict[str, float]) -> list[str]:
    """BPE of a short text: the best-scored neighbours join, the leftmost of equals first."""
    never = float("-inf")
    symbols = list(text)
    gains = [scores.get(a + b, never) for a, b in zip(symbols, symbols[1:], strict=False)]
    while gains and (best := max(gains)) > never:
        at = gains.index(best)
        symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        del gains[at]
        if at > 0:
            gains[at - 1] = scores.get(symbols[at - 1] + symbols[at], never)
        if at < len(gains):
            gains[at] = scores.get(symbols[at] + symbols[at + 1], never)
    return symbols


@dataclass
class Encoder:
    """Encodes batches in one task; keeps the ids of words it has met, up to a bound."""

    vocabulary: Vocabulary
    numbers: dict[str, int] = field(default_factory=dict)
    firsts: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    flat: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))

    def __post_init__(self) -> None:
        self.answers = np.full(SLOTS, -2, np.int64)
        known = sorted(self.vocabulary.ids)
        self.names = {i: piece for piece, i in self.vocabulary.ids.items()}
        self.piece_ids = np.array([self.vocabulary.ids[p] for p in known], np.int64)
        self.lengths = np.array([len(p) for p in known], np.int64)
        self.longest = int(self.lengths.max())
        self.spellings = np.full((len(known), self.longest), -1, np.int32)
        for row, piece in enumerate(known):
            self.spellings[row, : len(piece)] = [ord(c) for c in piece]

    def suffixes(self, text: np.ndarray) -> np.ndarray:
        """Start positions in the order of their suffixes, compared by as many characters as the longest piece has."""
        ranks = np.searchsorted(np.unique(text), text).astype(np.int64) + 1
        reach, most = 1, int(ranks.max(initial=0)) + 1
        while True:
            ahead = 4 if most**4 < 2**62 else 2
            key = np.zeros_like(ranks)
            for k in range(ahead):
                key *= most
                key[: len(key) - k * reach] += ranks[k * reach :]
            reach *= ahead
            if reach >= self.longest:
                return np.argsort(key, kind="stable")
            ranks = np.unique(key, return_inverse=True)[1].astype(np.int64) + 1
            most = int(ranks.max()) + 1

    def ranges(self, text: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pieces whose characters all occur, for each the first suffix that starts with it, and their end.

        Suffixes and pieces are compared some characters at a time, as numbers: the group of suffixes that a piece has
        reached and its next characters. Each binary search leaves a piece with its range or with its next group.
        """
        occurs = np.zeros(GAP + 2, bool)
        occurs[text] = occurs[-1] = True
        kept = np.flatnonzero(occurs[self.spellings].all(axis=1))
        spellings, lengths = self.spellings[kept], self.lengths[kept]
        alphabet = np.unique(text)
        codes = np.zeros(len(text) + self.longest, np.int64)
        codes[: len(text)] = np.searchsorted(alphabet, text) + 1
        digits = np.searchsorted(alphabet, spellings) + 1
        base, used = len(alphabet) + 2, 0
        low, high = np.zeros(len(kept), np.int64), np.zeros(len(kept), np.int64)
        group, open_, reached = np.zeros(len(order), np.int64), np.arange(len(kept)), np.zeros(len(kept), np.int64)
        while len(open_):
            width, most = 1, (int(group[-1]) + 1) * base
            while used + width < self.longest and most * base < 2**62:
                width, most = width + 1, most * base
            keys, least, last = group, reached, reached
            for k in range(used, used + width):
                keys = keys * base + codes[order + k]
                inside = lengths[open_] > k
                least = least * base + np.where(inside, digits[open_, k], 0)
                last = last * base + np.where(inside, digits[open_, k], base - 1)
            used += width
            starts, ends = np.searchsorted(keys, least), np.searchsorted(keys, last, "right")
            done = lengths[open_] <= used
            low[open_[done]], high[open_[done]] = starts[done], ends[done]
            on = ~done & (starts < ends)
            group = np.cumsum(np.diff(keys, prepend=keys[:1]) != 0)
            open_, reached = open_[on], group[starts[on]]
        return kept, low, high

    def edges(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, piece) of every occurrence; a character that is no piece stands for itself."""
        order = self.suffixes(text)
        kept, low, high = self.ranges(text, order)
        counts = high - low
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        starts = order[np.repeat(low, counts) + within]
        pieces, lengths = np.repeat(self.piece_ids[kept], counts), np.repeat(self.lengths[kept], counts)
        alone = text != GAP
        alone[starts[lengths == 1]] = False
        odd = np.flatnonzero(alone)
        return (
            np.concatenate([starts, odd]), np.concatenate([lengths, np.ones(len(odd), np.int64)]),
            np.concatenate([pieces, self.vocabulary.size + text[odd].astype(np.int64)]),
        )

    def stays(self, left: int, right: int) -> bool:
        """Whether BPE leaves these neighbours as they are; left is -1 at the start of a word."""
        size = self.vocabulary.size
        if right >= size:
            return True
        own = [self.names[right]]
        if 0 <= left < size:
            own.insert(0, self.names[left])
        return merged("".join(own), self.vocabulary.scores) == own

    def stay(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """stays() of many pairs: from a table of answers by hash, else worked out and put there."""
        keys = ((left + 1) * (self.vocabulary.size + GAP) + right) * 2
        slots = (keys * 0x9E3779B97F4A7C1 >> 17) & (len(self.answers) - 1)
        held = self.answers[slots]
        missing = np.flatnonzero(held >> 1 != keys >> 1)
        asked, first, which = np.unique(keys[missing], return_index=True, return_inverse=True)
        told = asked.copy()
        for i, at in enumerate(missing[first].tolist()):
            told[i] |= self.stays(int(left[at]), int(right[at]))
        held[missing] = self.answers[slots[missing]] = told[which]
        return (held & 1).astype(bool)

    def relax(self, text: np.ndarray, begins: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each position the piece that ends there in its word's encoding, and where that piece starts.

        All words advance together, one character at a time; the longest piece is tried first.
        """
        starts, lengths, pieces = self.edges(text)
        ends = starts + lengths
        reached = ends - np.repeat(begins, spans)[starts]
        step = reached * self.longest + (self.longest - lengths)
        step = step.astype(np.uint16) if step.max(initial=0) < 1 << 16 else step
        order = np.argsort(step, kind="stable")
        starts, ends, pieces, step = starts[order], ends[order], pieces[order], step[order]
        last, back = np.full(len(text) + 1, -2, np.int64), np.zeros(len(text) + 1, np.int64)
        last[begins] = -1
        cuts = np.flatnonzero(np.diff(step.astype(np.int64), prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(step)], strict=True):
            open_ = np.flatnonzero(last[ends[a:b]] == -2) + a
            good = open_[self.stay(last[starts[open_]], pieces[open_])]
            last[ends[good]], back[ends[good]] = pieces[good], starts[good]
        return last, back

    def learn(self, words: list[str]) -> None:
        """Encodes new words through one index over all of them."""
        joined = "".join(MARK + w.replace(" ", MARK) + "\0" for w in words)
        text = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.int32).copy()
        spans = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
        closes = np.cumsum(spans) - 1
        text[closes] = GAP
        begins = closes + 1 - spans
        last, back = self.relax(text, begins, spans)
        word, at = np.arange(len(words)), closes
        taken: list[tuple[np.ndarray, np.ndarray]] = []
        while len(word):
            taken.append((word, last[at]))
            at = back[at]
            going = at > begins[word]
            word, at = word[going], at[going]
        owner = np.concatenate([w for w, _ in reversed(taken)])
        order = np.argsort(owner, kind="stable")
        owner, ids = owner[order], np.concatenate([i for _, i in reversed(taken)])[order]
        odd = np.flatnonzero(ids >= self.vocabulary.size)
        if len(odd):
            raw = {i: chr(i - self.vocabulary.size).encode("utf-8", "surrogatepass") for i in set(ids[odd].tolist())}
            times = np.ones(len(ids), np.int64)
            times[odd] = [len(raw[i]) for i in ids[odd].tolist()]
            places = np.repeat(np.cumsum(times) - times, times)[np.repeat(ids, times) >= self.vocabulary.size]
            owner, ids = np.repeat(owner, times), np.repeat(ids, times)
            spots = np.flatnonzero(ids >= self.vocabulary.size)
            values = [raw[i][k] for i, k in zip(ids[spots].tolist(), (spots - places).tolist(), strict=True)]
            ids[spots] = np.array(self.vocabulary.bytes_at)[values]
        first = len(self.numbers)
        self.numbers.update(zip(words, range(first, first + len(words)), strict=True))
        counts = np.bincount(owner, minlength=len(words))
        self.firsts = np.concatenate([self.firsts, self.firsts[-1] + np.cumsum(counts)])
        self.flat = np.concatenate([self.flat, ids.astype(np.int32)])

    def forget(self) -> None:
        """Lets go of the words; what was found out about pairs stays, in a table of fixed size."""
        self.numbers, self.firsts, self.flat = {}, np.zeros(1, np.int64), np.zeros(0, np.int32)

    def learn_new(self, words: set[str]) -> None:
        """Encodes those of the words that are not known yet, so many characters at a time."""
        part, held = [], 0
        for word in words - self.numbers.keys():
            part.append(word)
            held += len(word) + 2
            if held > INDEXED:
                self.learn(part)
                part, held = [], 0
        if part:
            self.learn(part)

    def words(self, text: str) -> list[str]:
        """The words of a text, each without the first of its space marks."""
        if not text:
            return []
        marked = " " + text.replace(MARK, " ")
        if "  " in marked or marked[-1] == " ":
            return [w[1:] for w in SPACED.findall(marked)]
        return marked[1:].split(" ")

    def encode(self, texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Steps over the texts: which texts, the number of ids of each, and all their ids in order."""
        if len(self.numbers) > KEPT_WORDS:
            self.forget()
        spans = list(steps(texts, STEP_CHARS))
        new: set[str] = set()
        for a, b in spans:
            new.update(chain.from_iterable(map(self.words, texts[a:b])))
            if len(new) > NEW_WORDS:
                self.learn_new(new)
                new = set()
        self.learn_new(new)
        for a, b in spans:
            split = [self.words(t) for t in texts[a:b]]
            numbers = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(split)), np.int64)
            counts = self.firsts[numbers + 1] - self.firsts[numbers]
            ends = np.cumsum(counts)
            total = int(ends[-1]) if len(ends) else 0
            ids = self.flat[np.arange(total) + np.repeat(self.firsts[numbers] - (ends - counts), counts)]
            bounds = np.zeros(len(split) + 1, np.int64)
            np.cumsum([len(ws) for ws in split], out=bounds[1:])
            yield a, b, np.diff(np.concatenate([[0], ends])[bounds]), ids


def spell(ids: list[int], spelled: tuple[bytes, ...]) -> str:
    """The text of a sequence of ids, without the leading space mark; broken bytes become U+FFFD."""
    return b"".join(map(spelled.__getitem__, ids)).decode("utf-8", "replace")[1:]


def spells(texts: list[str], ids: np.ndarray, offsets: np.ndarray, spelled: tuple[bytes, ...]) -> list[bool]:
    """Whether the ids of each text, `offsets` apart, spell it again; space marks count as spaces."""
    pieces = list(map(spelled.__getitem__, ids.tolist()))
    ends = np.zeros(len(ids) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)), out=ends[1:])
    raw, places = b"".join(pieces), ends[offsets].tolist()
    return [
        raw[begin + 1 : end] == text.replace(MARK, " ").encode() for text, begin, end in zip(texts, places[:-1], places[1:], strict=True)
    ]


STRUCT = pa.struct([("ids", pa.list_(pa.int32())), ("restored", pa.bool_())])
ENCODED = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("restored", T.BooleanType())])


@lru_cache(maxsize=1)
def _encoder(vocabulary: Broadcast) -> Encoder:
    """The encoder of a worker process: its next tasks know the pairs, and up to KEPT_WORDS words, of the ones before."""
    return Encoder(vocabulary.value)


def encoded(spark: SparkSession, text: Column, path: str = MODEL) -> Column:
    """struct(ids, restored) of a column of texts: piece ids of the whole text, and whether they spell it again.

    A null or empty text has no ids and is restored. The model writes a space and U+2581 alike, so both come back as
    a space. Only the vocabulary, of fixed size, is broadcast.
    """
    shared = spark.sparkContext.broadcast(load(path))

    @F.arrow_udf(ENCODED)
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(shared)
        spelled = shared.value.spelled
        for batch in slices(batches):
            if not len(batch):
                yield pa.array([], STRUCT)
            texts = [t or "" for t in batch.to_pylist()]
            for a, b, sizes, ids in encoder.encode(texts):
                offsets = np.zeros(b - a + 1, np.int32)
                offsets[1:] = np.cumsum(sizes)
                restored = spells(texts[a:b], ids, offsets, spelled)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))
                yield pa.StructArray.from_arrays([lists, pa.array(restored, pa.bool_())], ["ids", "restored"])

    return encode(text.cast("string"))


def decoded(spark: SparkSession, ids: Column, path: str = MODEL) -> Column:
    """The text of a column of id arrays; null and empty arrays give an empty text, unknown ids are an error."""
    shared = spark.sparkContext.broadcast(load(path))

    @F.arrow_udf(T.StringType())
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([spell(i or [], shared.value.spelled) for i in batch.to_pylist()], pa.string())

    return decode(ids)
