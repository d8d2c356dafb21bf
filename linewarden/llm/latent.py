"""Benchmark decontamination by latent semantic retrieval.

Passages are windows of words, weighted by TF-IDF over all documents and projected on the leading right singular
vectors of the benchmark's passages, found by a randomised SVD. A document window is a candidate if the latent space
explains about as much of it as of a benchmark window and the cosine between the two is high; a longest common
subsequence of words with the item and a look for its answer settle it, so that paraphrases with changed, added or
dropped words count too.

The term table has a fixed number of hashed rows, so what is broadcast is bounded: rows x rank floats, and one block
of benchmark windows at a time. Document frequencies, the SVD and the search cover every document and every item.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linewarden.llm.common import LEAN_STEP, as_bytes, slices, steps
from linewarden.llm.tokens import SPACES, WordHasher

#: Hashed terms, rank of the latent space, and random directions beyond it.
TERMS, RANK, EXTRA = 1 << 16, 64, 8
#: Words of a window and words from one window of a text to the next.
WINDOW, STRIDE = 16, 8
#: Window and stride of the search by an item's length: an item of WINDOW + STRIDE words or more has the first, a
#: shorter one the first that it is long enough for, so that a window of any grid lies within a copy of it.
LENGTHS = ((WINDOW, STRIDE), (8, 4), (4, 2), (2, 1))
#: Benchmark items whose windows one task of the SVD's fit has, about; fewest and most tasks of it. Every item counts.
SAMPLE_ITEMS = 2_000
FIT_TASKS = 6, 64
POWER_ROUNDS = 2
#: Benchmark items that one block of the search holds at most, about.
BLOCK_ITEMS = 5_000
#: Least cosine of a candidate window, and the least explained share of it against that of the item's window.
COSINE, EXPLAINED = 0.7, 0.4
#: Least share of an item's words in the common subsequence: alone, and with the item's answer in the same place.
COMMON, COMMON_WITH_ANSWER = 0.75, 0.55
#: Words at an item's end that stand for its answer, and how many of them must come in order.
ANSWER_WORDS, ANSWER_FOUND = 6, 5
SEED = 5
#: Rows of terms or windows that are worked on at a time.
SLICE = 1024


def hasher() -> WordHasher:
    """Words are runs of letters, digits and other characters than ASCII signs, in lower case."""
    return WordHasher(SPACES + string.punctuation.encode(), latin=True)


def window_blocks(hashes: np.ndarray, bounds: np.ndarray, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the distinct terms of `stride` words, filled up with TERMS, and for each text the row at which it starts."""
    counts = np.diff(bounds)
    blocks = -(-counts // stride)
    first = np.concatenate([[0], np.cumsum(blocks)])
    rows = np.full(first[-1] * stride, TERMS, np.int64)
    places = np.arange(len(hashes)) + np.repeat(first[:-1] * stride - bounds[:-1], counts)
    rows[places] = buckets(hashes)
    rows = np.sort(rows.reshape(-1, stride), axis=1)
    rows[:, 1:][rows[:, 1:] == rows[:, :-1]] = TERMS
    return rows, first


def buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(TERMS - 1)).astype(np.int64)


def windows(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Terms of every window."""
    rows, first = window_blocks(hashes, bounds)
    second = np.concatenate([rows[1:], np.full((1, STRIDE), TERMS)])[: len(rows)]
    second[first[1:][np.diff(first) > 0] - 1] = TERMS
    return np.concatenate([rows, second], axis=1)


def document_frequencies(docs: DataFrame) -> DataFrame:
    """(term, docs): in how many of all documents each hashed term occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, total = hasher(), np.zeros(TERMS, np.int64)
        for batch in slices(batches):
            texts = as_bytes(batch.column(0))
            for a, b in steps(texts, LEAN_STEP):
                hashes, bounds = words(texts[a:b])
                for c in range(0, b - a, TERMS):
                    own = bounds[c : min(c + TERMS, b - a) + 1]
                    owner = np.repeat(np.arange(len(own) - 1, dtype=np.uint32) * TERMS, np.diff(own))
                    pairs = np.sort(owner + buckets(hashes[own[0] : own[-1]]).astype(np.uint32))
                    once = pairs[np.flatnonzero(np.diff(pairs.astype(np.int64), prepend=-1))]
                    total += np.bincount(once & (TERMS - 1), minlength=TERMS)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["term", "docs"])

    return docs.select("text").mapInArrow(count, "term long, docs long").groupBy("term").agg(F.sum("docs").alias("docs"))


def item_windows(texts: DataFrame) -> DataFrame:
    """(terms): the windows of the benchmark's texts."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = hasher()
        for batch in batches:
            found = as_bytes(batch.column(0))
            for a, b in steps(found, LEAN_STEP):
                terms = windows(*words(found[a:b]))
                offsets = np.arange(0, terms.size + 1, WINDOW, dtype=np.int32)
                lists = pa.ListArray.from_arrays(offsets, pa.array(terms.ravel().astype(np.int32)))
                yield pa.RecordBatch.from_arrays([lists], ["terms"])

    return texts.mapInArrow(cut, "terms array<int>")


def _rows(batch: pa.RecordBatch, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    terms = batch.column(0).flatten().to_numpy().astype(np.int64).reshape(-1, WINDOW)
    weight = weights[terms]
    return terms, weight / np.maximum(np.sqrt((weight**2).sum(1, keepdims=True)), 1e-9)


def _back_and_forth(passages: DataFrame, weights: Broadcast, basis: Broadcast) -> np.ndarray:
    """The TF-IDF matrix's transpose times itself times the basis, summed over the passages' partitions."""
    width = basis.value.shape[1]

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((TERMS + 1, width), np.float32)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                terms, weight = _rows(batch.slice(at, SLICE), weights.value)
                seen = (weight[:, :, None] * basis.value[terms]).sum(1)
                flat = terms.ravel()
                order = np.argsort(flat, kind="stable")
                given = (weight[:, :, None] * seen[:, None, :]).reshape(-1, width)[order]
                starts = np.flatnonzero(np.diff(flat[order], prepend=-1))
                if len(starts):
                    total[flat[order][starts]] += np.add.reduceat(given, starts, axis=0)
        blocks = total[:TERMS].reshape(-1, SLICE, width)
        used = np.flatnonzero(blocks.any(axis=(1, 2)))
        values = pa.array([blocks[i].tobytes() for i in used], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(used), values], ["slice", "block"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b, np.float32) for b in table.column("block").to_pylist())
        return pa.table({"slice": table.column("slice")[:1], "block": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros((TERMS + 1, width), np.float32)
    shape = "slice long, block binary"
    for r in passages.mapInArrow(part, shape).groupBy("slice").applyInArrow(add, shape).collect():
        out[r.slice * SLICE : (r.slice + 1) * SLICE] = np.frombuffer(r.block, np.float32).reshape(SLICE, width)
    return out


def orthonormal(columns: np.ndarray) -> None:
    """Makes the columns orthonormal in place, twice by their Gram matrix; directions without weight become zero."""
    for _ in range(2):
        gram = np.zeros((columns.shape[1],) * 2)
        for at in range(0, len(columns), SLICE):
            part = columns[at : at + SLICE].astype(np.float64)
            gram += part.T @ part
        energy, turn = np.linalg.eigh(gram)
        there = energy > max(energy[-1], 1e-30) * 1e-12
        turn = np.where(there, turn / np.sqrt(np.where(there, energy, 1)), 0)
        for at in range(0, len(columns), SLICE):
            columns[at : at + SLICE] = columns[at : at + SLICE] @ turn


@dataclass
class Latent:
    """Rows of terms, the last of them zero: latent vector and squared IDF; singular values."""

    table: np.ndarray
    strengths: np.ndarray

    def explained(self, sums: np.ndarray) -> np.ndarray:
        """Share of a passage's TF-IDF energy that lies in the latent space, from the sum of its terms' rows."""
        return ((sums[:, :RANK] * self.strengths) ** 2).sum(1) / np.maximum(sums[:, RANK], 1e-9)


def latent_terms(docs: DataFrame, items: DataFrame) -> Latent:
    """The latent vector of every hashed term, with a row of zeros behind them.

    It is the term's IDF times its right singular vectors over the singular values, so that no direction, such as a
    language, outweighs the others; one more column holds its squared IDF.
    Subspace iteration over the windows of all items, dealt over tasks that each stream theirs; partial products are
    summed by Spark in slices of terms, one block a task and slice at most; the driver holds two matrices of TERMS x (RANK + EXTRA) at most and factors small ones only.
    """
    context, n = docs.sparkSession.sparkContext, docs.count()
    weights = np.zeros(TERMS + 1, np.float32)
    frequencies = document_frequencies(docs).toArrow()
    weights[:TERMS] = np.log(1 + n)
    weights[frequencies["term"].to_numpy()] = np.log((1 + n) / (1 + frequencies["docs"].to_numpy().astype(np.float64)))
    fewest, most = FIT_TASKS
    tasks = min(most, max(fewest, -(-items.count() // SAMPLE_ITEMS)))
    passages = item_windows(items.select("text").repartition(tasks)).persist()
    shared = context.broadcast(weights)
    basis = np.random.default_rng(SEED).standard_normal((TERMS + 1, RANK + EXTRA), np.float32)
    basis[TERMS] = 0
    try:
        for _ in range(POWER_ROUNDS):
            sent = context.broadcast(basis)
            basis = _back_and_forth(passages, shared, sent)
            sent.destroy()
            orthonormal(basis)
        sent = context.broadcast(basis)
        moved = _back_and_forth(passages, shared, sent)
        sent.destroy()
    finally:
        passages.unpersist()
        shared.destroy()
    within = basis.T @ moved
    del moved
    energy, turn = np.linalg.eigh((within + within.T) / 2)
    strengths = np.sqrt(np.maximum(energy[::-1][:RANK], 1e-9)).astype(np.float32)
    turn = turn[:, ::-1][:, :RANK] / strengths
    table = np.zeros((TERMS + 1, RANK + 1), np.float32)
    for at in range(0, TERMS, SLICE):
        part = slice(at, at + SLICE)
        table[part, :RANK] = weights[part, None] * (basis[part] @ turn)
    table[:TERMS, RANK] = weights[:TERMS] ** 2
    return Latent(table, strengths)


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)


def common_length(places: dict[int, int], n: int, words: list[int]) -> int:
    """Length of the longest common subsequence, by bits; `places` has the positions of each word of the one text."""
    full = (1 << n) - 1
    row = full
    for word in words:
        if mask := places.get(word):
            both = row & mask
            row = ((row + both) | (row - both)) & full
    return n - row.bit_count()


def bit_places(words: list[int]) -> dict[int, int]:
    places: dict[int, int] = {}
    for at, word in enumerate(words):
        places[word] = places.get(word, 0) | 1 << at
    return places


@dataclass
class Queries:
    """Windows of the items of one length class."""

    window: int
    stride: int
    vectors: np.ndarray
    explained: np.ndarray
    owner: np.ndarray


@dataclass
class Items:
    """Benchmark items of one block, ready for the search."""

    ids: list[int]
    words: list[list[int]]
    places: list[dict[int, int]]
    answers: list[dict[int, int]]
    queries: list[Queries]

    def judged(self, item: int, words: list[int]) -> tuple[float, bool]:
        """Share of an item's words in the common subsequence with these words, and whether its answer is there.

        Nothing is worked out where too few of the item's words occur at all.
        """
        own, n = self.words[item], len(self.words[item])
        if sum(map(set(words).__contains__, own)) < COMMON_WITH_ANSWER * n:
            return 0.0, False
        size = min(ANSWER_WORDS, n)
        found = common_length(self.answers[item], size, words) >= min(ANSWER_FOUND, size)
        return common_length(self.places[item], n, words) / n, found


def length_class(n: int) -> tuple[int, int]:
    """Window and stride by which an item of n words is searched."""
    return next((c for c in LENGTHS if n >= sum(c)), LENGTHS[-1])


def query_starts(n: int) -> list[int]:
    """Where an item's windows start: all over it, by half a stride so that one lies near any grid, and at its end."""
    window, stride = length_class(n)
    last = max(0, n - window)
    return sorted({*range(0, last + 1, max(1, stride // 2)), last})


def prepared(rows: list[tuple[int, str]], terms: Latent) -> Items:
    """Windows of items (id, text); an item without words has none and is never found."""
    hashes, bounds = hasher()([text.encode() for _, text in rows])
    words = [hashes[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    queries = []
    for window, stride in LENGTHS:
        mine = [(i, w) for i, w in enumerate(words) if w and length_class(len(w)) == (window, stride)]
        cuts = [(i, np.unique(buckets(np.array(w[s : s + window], np.uint64)))) for i, w in mine for s in query_starts(len(w))]
        if cuts:
            sums = np.array([terms.table[cut].sum(0) for _, cut in cuts], np.float32).reshape(-1, RANK + 1)
            owner = np.array([i for i, _ in cuts], np.int64)
            queries.append(Queries(window, stride, unit(sums[:, :RANK]), terms.explained(sums), owner))
    return Items(
        [item for item, _ in rows], words, [bit_places(w) for w in words],
        [bit_places(w[-ANSWER_WORDS:]) for w in words], queries,
    )


HIT = T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("cosine", T.DoubleType()),
    T.StructField("common", T.DoubleType()), T.StructField("answer", T.BooleanType()),
])


def candidates(
    hashes: np.ndarray, bounds: np.ndarray, terms: Latent, queries: Queries
) -> dict[tuple[int, int], list[tuple[float, int]]]:
    """(cosine, first word of the window) of all windows near one of an item's, by (text, item)."""
    best: dict[tuple[int, int], list[tuple[float, int]]] = {}
    stride = queries.stride
    rows, first = window_blocks(hashes, bounds, stride)
    if not len(rows):
        return best
    block = np.zeros((len(rows) + 1, RANK + 1), np.float32)
    for at in range(0, len(rows), SLICE):
        block[at : at + len(rows[at : at + SLICE])] = terms.table[rows[at : at + SLICE]].sum(1)
    after = block[1:].copy()
    after[first[1:][np.diff(first) > 0] - 1] = 0
    block = block[:-1] + after
    explained = terms.explained(block)
    able = np.flatnonzero(explained >= EXPLAINED * queries.explained.min())
    for at in range(0, len(able), SLICE):
        part = able[at : at + SLICE]
        directions = unit(block[part, :RANK])
        for c in range(0, len(queries.owner), 4096):
            cosines = directions @ queries.vectors[c : c + 4096].T
            near, which = np.nonzero(cosines >= COSINE)
            fits = explained[part[near]] >= EXPLAINED * queries.explained[c + which]
            near, which = near[fits], which[fits]
            places = part[near]
            owner = np.searchsorted(first, places, "right") - 1
            starts = bounds[owner] + (places - first[owner]) * stride
            for doc, item, start, value in zip(
                owner.tolist(), queries.owner[c + which].tolist(), starts.tolist(), cosines[near, which].tolist(), strict=True
            ):
                best.setdefault((doc, item), []).append((value, start))
    return best


def found_in(texts: list[bytes], words: WordHasher, terms: Latent, items: Items) -> list[list[dict]]:
    """For each text the items that it holds."""
    hashes, bounds = words(texts)
    out: list[list[dict]] = [[] for _ in texts]
    for queries in items.queries:
        for (doc, item), places in candidates(hashes, bounds, terms, queries).items():
            reach, common, answer, reached = len(items.words[item]), 0.0, False, -1
            for start in sorted({start for _, start in places}):
                if start < reached:
                    continue
                stop = min(bounds[doc + 1], start + queries.window + reach)
                share, has = items.judged(item, hashes[max(bounds[doc], start - reach) : stop].tolist())
                common, answer, reached = max(common, share), answer or has, start + queries.stride
                if common == 1 and answer:
                    break
            if common >= COMMON or (answer and common >= COMMON_WITH_ANSWER):
                top = min(max(value for value, _ in places), 1.0)
                out[doc].append({"item_id": items.ids[item], "cosine": top, "common": common, "answer": answer})
    return out


def hits(docs: DataFrame, items: DataFrame) -> Column:
    """A column over `docs`: an array of struct(item_id, cosine, common, answer), empty where a text holds no item.

    Null and empty texts hold none. Items without words and null items are never found. A repeated item or document
    gives repeated hits. The benchmark is searched in blocks of about BLOCK_ITEMS items, each sent by itself and made
    ready in the workers. All blocks of a benchmark are searched in one pass over the documents, so a worker holds the
    whole benchmark; every document window of enough explained energy is multiplied with every item window of its
    length class, 64 numbers each.
    """
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    known = items.where("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text")
    context = docs.sparkSession.sparkContext
    n = known.count()
    none = F.array().cast(T.ArrayType(HIT))
    if n == 0:
        return none
    terms = latent_terms(texts, known)
    shared = context.broadcast(terms)
    columns = []
    blocks = -(-n // BLOCK_ITEMS)
    for number in range(blocks):
        mine = known.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == number).orderBy("item_id", "text").collect()
        if mine:
            block = context.broadcast([tuple(r) for r in mine])
            columns.append(_search(shared, block)(F.col("text").cast("string")))
    return F.concat(*columns) if len(columns) > 1 else columns[0]


@lru_cache(maxsize=64)
def _ready(terms: Broadcast, block: Broadcast) -> Items:
    """A block's items, made ready once in a worker process."""
    return prepared(block.value, terms.value)


def _search(terms: Broadcast, block: Broadcast):
    @F.arrow_udf(T.ArrayType(HIT))
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words, items = hasher(), _ready(terms, block)
        kind = pa.list_(pa.struct([
            ("item_id", pa.int64()), ("cosine", pa.float64()), ("common", pa.float64()), ("answer", pa.bool_()),
        ]))
        for batch in slices(batches):
            texts = as_bytes(batch)
            found = [f for a, b in steps(texts, LEAN_STEP) for f in found_in(texts[a:b], words, terms.value, items)]
            yield pa.array(found, kind)

    return search


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, cosine, common, answer) for each benchmark item that a document holds."""
    held = docs.select("doc_id", F.explode(hits(docs, items)).alias("hit"))
    return held.select("doc_id", "hit.item_id", "hit.cosine", "hit.common", "hit.answer")
