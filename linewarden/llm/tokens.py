"""Hashes of all words of a batch of texts, without a Python object per word."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

#: The bytes that separate words: [\x20\x09-\x0D].
SPACES = bytes([32, 9, 10, 11, 12, 13])
#: Odd base of the polynomial that identifies a word, and its inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: A longer text is hashed in parts of about so many bytes, cut between words.
PART = 250_000


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits; one to one."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(32))


def combined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of an ordered pair of hashes."""
    return mixed(left * np.uint64(BASE) + (right ^ (right >> np.uint64(32))) + np.uint64(0x2545F4914F6CDD1D))


@dataclass
class Spans:
    """Words of some texts: `raw[starts[i] : ends[i]]` with its hash; a text's words and bytes by `bounds`, `firsts`."""

    raw: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray
    firsts: np.ndarray

    def in_words(self, wanted: np.ndarray) -> np.ndarray:
        """For each word how many of its bytes a table of 256 flags marks."""
        total = np.zeros(len(self.raw) + 1, np.int32)
        np.cumsum(wanted[self.raw], out=total[1:])
        return total[self.ends] - total[self.starts]

    def owners(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sum over the words of each text."""
        total = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
        np.cumsum(values, out=total[1:])
        return total[self.bounds[1:]] - total[self.bounds[:-1]]


def marks(characters: bytes) -> np.ndarray:
    """A table of 256 flags for these bytes."""
    table = np.zeros(256, bool)
    table[np.frombuffer(characters, np.uint8)] = True
    return table


class WordHasher:
    """64-bit hashes of words, which are runs of bytes other than separators, with A-Z (and À-Þ) lower-cased.

    Words of equal bytes have equal hashes. Of n distinct words about n^2 / 2^65 pairs collide.
    """

    def __init__(self, separators: bytes = SPACES, lower: bool = True, latin: bool = False):
        self.separates = np.zeros(256, bool)
        self.separates[np.frombuffer(separators, np.uint8)] = True
        self.codes = np.arange(256, dtype=np.uint8)
        if lower:
            self.codes[ord("A") : ord("Z") + 1] += 32
        self.latin = latin
        self.cut = re.compile(b"[" + re.escape(separators) + b"]")
        self.powers = np.ones(1, np.uint64)
        self.inverses = np.ones(1, np.uint64)

    def _reach(self, n: int) -> None:
        if n > len(self.powers):
            for name, base in (("powers", BASE), ("inverses", INVERSE)):
                table = np.full(n, base, np.uint64)
                table[0] = 1
                setattr(self, name, np.cumprod(table))

    def _parts(self, text: bytes) -> list[bytes]:
        parts, at = [], 0
        while len(text) - at > PART and (found := self.cut.search(text, at + PART)):
            parts.append(text[at : found.start()])
            at = found.start()
        return [*parts, text[at:]]

    def __call__(self, texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The hash of every word in order, and the positions at which each text starts and the last ends."""
        if sum(map(len, texts)) <= 2 * PART:
            return self._hashed(texts)
        found, counts = [np.zeros(0, np.uint64)], [0]
        for text in texts:
            parts = [self._hashed([part])[0] for part in self._parts(text)]
            found.extend(parts)
            counts.append(sum(map(len, parts)))
        return np.concatenate(found), np.cumsum(counts)

    def _hashed(self, texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = self.spans(texts)
        return found.hashes, found.bounds

    def spans(self, texts: Sequence[bytes]) -> Spans:
        """Hash and place of every word; the texts are held as one run of bytes with a separator around each."""
        gap = bytes([int(np.flatnonzero(self.separates)[0])])
        raw = np.frombuffer(gap + gap.join(texts) + gap, np.uint8)
        self._reach(len(raw))
        apart = self.separates[raw]
        edge = np.flatnonzero(apart[1:] != apart[:-1]) + 1
        starts, ends = edge[::2], edge[1::2]
        codes = self.codes[raw]
        if self.latin:
            after = np.flatnonzero(raw[:-1] == 0xC3) + 1
            codes[after[(raw[after] >= 0x80) & (raw[after] <= 0x9E)]] += 32
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * self.powers[: len(raw)], out=total[1:])
        hashes = mixed((total[ends] - total[starts]) * self.inverses[starts])
        firsts = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=firsts[1:])
        return Spans(raw, starts, ends, hashes, np.searchsorted(starts, firsts + 1), firsts + 1)
