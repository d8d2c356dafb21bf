"""Language-model scoring by a weighted backoff automaton.

Smoothed n-grams are states: from the state of the last word an arc leads on for each word seen after it, and a
failure arc with its own weight leads back to the empty state, which has an arc for every word. One traversal from
left to right carries the state and adds up log-probabilities.

Counts cover all training texts, so the automaton grows with the corpus and is never in one place. Texts are dealt
into blocks. A block sends its distinct n-grams with its own counts to the shards of the hash range; a shard adds
them up and tells each block the totals that differ from what the block knows. The block then builds the part of the
automaton that its texts can reach, which its size bounds, and walks through it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linewarden.llm.common import as_bytes, in_fold, slices, steps
from linewarden.llm.tokens import SPACES, WordHasher, combined

#: Documents of a block, about, and blocks to a shard.
BLOCK_DOCS, SHARD_BLOCKS = 1_500, 2
#: Weight of the words seen after a known word, against that of all words.
MIX = 0.4
#: The token at the end of a text, which no word equals but by chance of 2^-64.
END = np.uint64(0xE0F0E0F0E0F0E0F1)
#: Tokens that one lane of the traversal reads.
LANE = 256


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of each text and its end, and where texts start and the last ends."""
    words = WordHasher(SPACES)
    hashes, bounds, size = [], [np.zeros(1, np.int64)], 0
    for a, b in steps(texts):
        found, own = words(texts[a:b])
        place = np.arange(len(found)) + np.repeat(np.arange(b - a), np.diff(own))
        with_ends = np.full(len(found) + b - a, END, np.uint64)
        with_ends[place] = found
        hashes.append(with_ends)
        bounds.append(size + own[1:] + np.arange(1, b - a + 1))
        size += len(with_ends)
    return np.concatenate([np.zeros(0, np.uint64), *hashes]), np.concatenate(bounds)


@dataclass
class Block:
    """The tokens of some texts and their distinct n-grams, in order of their hashes."""

    bounds: np.ndarray
    keys: np.ndarray
    words: np.ndarray
    pairs: np.ndarray
    own: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes], training: np.ndarray) -> Block:
        """`words` and `pairs` place each token, alone and after the one before, in `keys`; -1 without one before."""
        found, bounds = tokens(texts)
        later = np.ones(len(found), bool)
        later[bounds[:-1]] = False
        at = np.flatnonzero(later)
        keys, which = np.unique(np.concatenate([found, combined(found[at - 1], found[at])]), return_inverse=True)
        pairs = np.full(len(found), -1, np.int64)
        pairs[at] = which[len(found) :]
        learned = np.repeat(training, np.diff(bounds))
        counted = which[np.concatenate([learned, learned[at]])]
        return cls(bounds, keys, which[: len(found)], pairs, np.bincount(counted, minlength=len(keys)))


def shard_starts(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where each shard's equal part of the hash range starts in sorted keys, and the end."""
    edges = np.array([(1 << 64) * s // shards for s in range(1, shards)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def planes(values: np.ndarray) -> bytes:
    """Whole numbers as bytes by significance, so that the zeros of small ones lie together and compress away."""
    width = values.dtype.itemsize
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, width).T).tobytes()


def from_planes(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).ravel()


def packed(keys: np.ndarray) -> bytes:
    """Sorted keys as differences."""
    return planes(np.diff(keys, prepend=np.uint64(0)))


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(from_planes(data, np.uint64), dtype=np.uint64)


def walk(block: Block, counts: np.ndarray, total: int, types: int) -> np.ndarray:
    """log10 probability of every token, by one traversal of the automaton over lanes of text side by side.

    A lane that starts inside a text starts in the state of the word before.
    """
    words, n = block.words, len(block.words)
    every = np.log10((counts + 1.0) / (total + types + 1))
    seen = np.flatnonzero((block.pairs >= 0) & (counts[block.pairs] > 0))
    first = seen[np.unique(block.pairs[seen], return_index=True)[1]]
    source, target = words[first - 1], words[first]
    order = np.lexsort((target, source))
    source, target, arcs = source[order], target[order], block.pairs[first][order]
    size = len(block.keys) + 1
    arc_keys = source * size + target
    arc_weights = np.log10(MIX * counts[arcs] / np.maximum(counts[source], 1) + (1 - MIX) * 10 ** every[target])
    failure = np.where(counts > 0, np.log10(1 - MIX), 0.0)

    lengths = np.diff(block.bounds)
    lanes = -(-lengths // LANE)
    text = np.repeat(np.arange(len(lengths)), lanes)
    within = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    starts = block.bounds[:-1][text] + within * LANE
    left = np.minimum(LANE, block.bounds[1:][text] - starts)
    longest = np.argsort(-left, kind="stable")
    starts, left = starts[longest], left[longest]
    inside = within[longest] > 0
    #: The state is the last word's place in the keys, or -1 for the empty state.
    state = np.where(inside & (counts[words[starts - 1]] > 0), words[starts - 1], -1)
    out = np.zeros(n)
    for step in range(int(left.max(initial=0))):
        active = int(np.searchsorted(-left, -step, "left"))
        at = starts[:active] + step
        word, now = words[at], state[:active]
        wanted = now * size + word
        arc = np.minimum(np.searchsorted(arc_keys, wanted), max(len(arc_keys) - 1, 0))
        goes = (now >= 0) & (arc_keys[arc] == wanted) if len(arc_keys) else np.zeros(active, bool)
        fails = np.where(now >= 0, failure[now], 0.0) + every[word]
        out[at] = np.where(goes, arc_weights[arc] if len(arc_keys) else 0.0, fails)
        state[:active] = np.where(counts[word] > 0, word, -1)
    return out


def corpus_size(rows: DataFrame) -> tuple[int, int]:
    """(N, V): tokens and distinct tokens of all training texts."""

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 5_000):
            texts = as_bytes(batch.column(0))
            for a, b in steps(texts, 16_000_000):
                found, times = np.unique(tokens(texts[a:b])[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(times)], ["token", "times"])

    each = rows.where("training").select("text").mapInArrow(distinct, "token long, times long")
    totals = each.groupBy("token").agg(F.sum("times").alias("times")).agg(
        F.coalesce(F.sum("times"), F.lit(0)).alias("total"), F.count("*").alias("types")
    ).first()
    return totals.total, totals.types


def scored(docs: DataFrame, training: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Learns from the rows where `training` holds. A null or empty text is its end alone. Repeated rows count each
    time. Words are compared by 64-bit hashes. Other columns are not read.
    """
    blocks = max(1, -(-docs.count() // BLOCK_DOCS))
    shards = max(1, blocks // SHARD_BLOCKS)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), F.coalesce(training, F.lit(False)).alias("training")
    )
    total, types = corpus_size(rows)
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))

    def request(table: pa.Table) -> pa.Table:
        block = Block.of(*_read(table))
        starts = shard_starts(block.keys, shards)
        sent = [s for s in range(shards) if starts[s + 1] > starts[s]]
        parts = [slice(starts[s], starts[s + 1]) for s in sent]
        return pa.table({
            "shard": pa.array(sent, pa.int64()),
            "block": pa.array([table.column("block")[0].as_py()] * len(sent), pa.int64()),
            "keys": pa.array([packed(block.keys[p]) for p in parts], pa.binary()),
            "counts": pa.array([planes(block.own[p].astype(np.uint32)) for p in parts], pa.binary()),
        })

    def answer(table: pa.Table) -> pa.Table:
        keys = [unpacked(k) for k in table.column("keys").to_pylist()]
        own = [from_planes(c, np.uint32) for c in table.column("counts").to_pylist()]
        found, which = np.unique(np.concatenate(keys), return_inverse=True)
        sums = np.bincount(which, weights=np.concatenate(own), minlength=len(found)).astype(np.int64)[which]
        told: dict[str, list] = {"block": [], "shard": [], "at": [], "totals": []}
        begin = 0
        for block, mine in zip(table.column("block").to_pylist(), own, strict=True):
            totals = sums[begin : begin + len(mine)]
            begin += len(mine)
            at = np.flatnonzero(totals != mine)
            if len(at):
                told["block"].append(block)
                told["shard"].append(table.column("shard")[0].as_py())
                told["at"].append(planes(np.diff(at, prepend=0).astype(np.uint32)))
                told["totals"].append(planes(totals[at]))
        kinds = {"block": pa.int64(), "shard": pa.int64(), "at": pa.binary(), "totals": pa.binary()}
        return pa.table({k: pa.array(v, kinds[k]) for k, v in told.items()})

    def score(table: pa.Table, answers: pa.Table) -> pa.Table:
        block = Block.of(*_read(table))
        counts, starts = block.own.astype(np.int64), shard_starts(block.keys, shards)
        for shard, at, totals in zip(*(answers.column(c).to_pylist() for c in ("shard", "at", "totals")), strict=True):
            counts[starts[shard] + np.cumsum(from_planes(at, np.uint32), dtype=np.int64)] = from_planes(totals, np.int64)
        mine = counts[block.words]
        base = np.log10((mine + 1.0) / (total + types + 1))
        log = walk(block, counts, total, types)
        per_text = [np.concatenate([[0], np.cumsum(v)]) for v in (mine > 0, base, log)]
        known, base, log = (c[block.bounds[1:]] - c[block.bounds[:-1]] for c in per_text)
        return pa.table({
            "doc_id": table.column("doc_id"), "n_tokens": pa.array(np.diff(block.bounds)), "n_known": pa.array(known),
            "train_tokens": pa.array(np.full(len(known), total)), "base_score": pa.array(base), "score": pa.array(log),
        })

    requests = dealt.groupBy("block").applyInArrow(request, "shard long, block long, keys binary, counts binary")
    answers = requests.groupBy("shard").applyInArrow(answer, "block long, shard long, at binary, totals binary")
    kind = docs.schema[doc_id].dataType.simpleString()
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        score, f"doc_id {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )


def _read(table: pa.Table) -> tuple[list[bytes], np.ndarray]:
    training = table.column("training").to_numpy(zero_copy_only=False).astype(bool)
    return as_bytes(table.column("text").combine_chunks()), training


def trained_on(key: Column, folds: int = 7, held: int = 2) -> Column:
    return ~in_fold(key, folds, held)
