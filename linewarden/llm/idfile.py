"""Token-id files: frequency-ranked ids in byte-aligned variable-length coding with separate control bytes.

Ids are replaced by their rank by frequency over the whole corpus, so that the commonest 256 take one byte and the next
65,280 two. A block of a file holds the bytes of its values and, apart from them, control bytes: two bits a value, its
number of bytes less one, four values a control byte, the first value in the lowest bits. A reader looks up the four
lengths of every control byte in a table of 256 rows, sums them to offsets and gathers the values with numpy; no loop
runs over values. Parts of the last control byte beyond the block's values are zero and have no bytes.

A folder of id files holds three Parquet tables, so that any file system of the cluster serves and a lost executor's
task is written again or not at all:

* `ranks` (id, rank): one row an id of the vocabulary;
* `blocks` (part, seq, skip, n, doc_ids, sizes, control, data): about BLOCK_IDS ids each; documents stand in ascending
  order of id over parts and, within a part, over `seq`; `skip` ids of the part come before the block;
* `parts` (part, before): ids of all parts before, one row a file.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linewarden.llm.common import as_bytes, new_folder, removed, slices, steps, words_of, written_to

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
#: Ends every document.
END_ID = 2
#: Ids of a block, about: a document is never split, so a longer one is a block of its own.
BLOCK_IDS = 1 << 18
#: Distinct words whose ids a worker keeps.
KEPT_WORDS = 600_000
#: Words of printable ASCII, and the splitter's parts of them in lower case (fixed values of the vocabulary's file).
PLAIN = re.compile(rb"[!-~]+")
PARTS = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
#: Ids are handed on as unsigned integers of so many bits.
ID_TYPE = np.dtype("<u4")

#: Lengths of the four values of each control byte.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + np.uint8(1)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) of values below 2^32."""
    values = values.astype("<u4")
    code = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    padded = np.zeros(-(-len(code) // 4) * 4, np.uint8)
    padded[: len(code)] = code
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    taken = np.arange(4) <= code[:, None]
    return control.tobytes(), values.view(np.uint8).reshape(-1, 4)[taken].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n values of (control, data)."""
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    starts = np.cumsum(lengths, dtype=np.int64) - lengths
    raw = np.frombuffer(data, np.uint8)
    values = raw[starts].astype(np.uint32)
    for k in range(1, 4):
        longer = np.flatnonzero(lengths > k)
        if not len(longer):
            break
        values[longer] |= raw[starts[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return values


class WordEncoder(dict):
    """Encodes texts word by word, each distinct word once; a worker keeps words up to a bound.

    The vocabulary's splitter drops white space and none of its steps reaches over it, so the ids of a text are those of
    its words one after the other. Words of printable ASCII are cut by the splitter's pattern here, and only distinct
    parts go to the library's model; all other words go through the whole library (both tested against whole texts).
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.parts: dict[bytes, bytes] = {}
        self.fresh: list[bytes] = []
        self.firsts, self.flat, self.uses = np.zeros(1, np.int64), np.zeros(0, ID_TYPE), np.zeros(0, np.int64)

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.fresh.append(word)
        return number

    def part(self, part: bytes) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            ids = self.parts[part] = array("I", [token.id for token in self.model.tokenize(part.decode())]).tobytes()
        return ids

    def learn(self) -> None:
        """Works out the ids of the words met since the last call."""
        found: list[bytes] = []
        others = []
        for at, word in enumerate(self.fresh):
            if PLAIN.fullmatch(word) and b"<|" not in word:
                parts = PARTS.findall(word.lower())
                found.append(self.part(parts[0]) if len(parts) == 1 else b"".join(map(self.part, parts)))
            else:
                others.append(at)
                found.append(b"")
        whole = [self.fresh[at].decode("utf-8", "replace") for at in others]
        for at, told in zip(others, self.tokenizer.encode_batch_fast(whole, add_special_tokens=False), strict=True):
            found[at] = array("I", told.ids).tobytes()
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // ID_TYPE.itemsize
        self.firsts = np.concatenate([self.firsts, self.firsts[-1] + np.cumsum(sizes)])
        self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(found), ID_TYPE)])
        self.uses = np.concatenate([self.uses, np.zeros(len(found), np.int64)])
        self.fresh = []

    def thin(self) -> None:
        """Keeps the words that were met more than once since they came, at most half of the bound."""
        if len(self) <= KEPT_WORDS:
            return
        kept = np.flatnonzero(self.uses > 1)[: KEPT_WORDS // 2]
        words = list(self)
        sizes = np.diff(self.firsts)[kept]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        self.flat = self.flat[np.arange(ends[-1]) + np.repeat(self.firsts[kept] - ends[:-1], sizes)]
        self.firsts, self.uses = ends, np.zeros(len(kept), np.int64)
        self.clear()
        self.update(zip(map(words.__getitem__, kept.tolist()), range(len(kept)), strict=True))
        self.parts = {}

    def __call__(self, texts: list[bytes], end_id: int) -> Iterator[np.ndarray]:
        """The ids of every text, the end id behind them."""
        for a, b in steps(texts):
            words, bounds = words_of(texts[a:b])
            self.thin()
            numbers = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
            self.learn()
            self.uses += np.bincount(numbers, minlength=len(self.uses))
            counts = self.firsts[numbers + 1] - self.firsts[numbers]
            ends = np.zeros(len(words) + 1, np.int64)
            np.cumsum(counts, out=ends[1:])
            ids = self.flat[np.arange(ends[-1]) + np.repeat(self.firsts[numbers] - ends[:-1], counts)]
            places = ends[bounds].tolist()
            for begin, end in zip(places[:-1], places[1:], strict=True):
                yield np.append(ids[begin:end], ID_TYPE.type(end_id))


@lru_cache(maxsize=1)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def stored(size: int) -> np.dtype:
    """The type of ids below `size` in intermediate tables."""
    return np.dtype("<u2" if size <= 1 << 16 else "<u4")


def token_bytes(text: Column, kind: np.dtype, path: str = VOCABULARY, end_id: int = END_ID) -> Column:
    """The ids of a column of texts, closed by the end id, as integers of this type; null is an empty text."""

    @F.arrow_udf("binary")
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in slices(batches):
            yield pa.array([ids.astype(kind).tobytes() for ids in _encoder(path)(as_bytes(batch), end_id)], pa.binary())

    return encoded(text.cast("string"))


def frequencies(tokens: DataFrame, kind: np.dtype) -> DataFrame:
    """(id, n): how often each id occurs in `ids`; every task sends an id at most once."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for ids in slices([batch.column(0)]):
                found = np.bincount(np.frombuffer(b"".join(as_bytes(ids)), kind))
                if len(found) > len(total):
                    found, total = total, found
                total[: len(found)] += found
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["id", "n"])

    return tokens.select("ids").mapInArrow(counted, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def ranked(counts: DataFrame, size: int) -> np.ndarray:
    """The rank of every id below `size`: by frequency, of equals the smaller id first. One row an id is collected."""
    total = np.zeros(size, np.int64)
    for row in counts.collect():
        total[row.id] = row.n
    ranks = np.zeros(size, np.int64)
    ranks[np.lexsort((np.arange(size), -total))] = np.arange(size)
    return ranks


BLOCK = "part long, seq long, skip long, n long, doc_ids array<long>, sizes array<long>, control binary, data binary"


def blocks(tokens: DataFrame, ranks: np.ndarray, kind: np.dtype) -> DataFrame:
    """Blocks of (doc_id, ids, n_tokens, mark, row), dealt over files by ranges of ids and packed in their order."""
    ordered = tokens.repartitionByRange("doc_id", "n_tokens", "mark", "row").sortWithinPartitions(
        "doc_id", "n_tokens", "mark", "row"
    )
    shared = tokens.sparkSession.sparkContext.broadcast(ranks.astype(np.uint32))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, skip = TaskContext.get().partitionId(), 0, 0
        held: list[tuple[int | None, bytes]] = []
        size = 0

        def block() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(i for _, i in held), kind)
            control, data = pack(shared.value[ids])
            row = (part, seq, skip, len(ids), [d for d, _ in held], [len(i) // kind.itemsize for _, i in held], control, data)
            whole, many = pa.int64(), pa.list_(pa.int64())
            kinds = (whole, whole, whole, whole, many, many, pa.binary(), pa.binary())
            names = ("part", "seq", "skip", "n", "doc_ids", "sizes", "control", "data")
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], list(names))

        for batch in batches:
            for rows in slices([batch]):
                for pair in zip(rows.column("doc_id").to_pylist(), rows.column("ids").to_pylist(), strict=True):
                    held.append(pair)
                    size += len(pair[1]) // kind.itemsize
                    if size >= BLOCK_IDS:
                        yield block()
                        seq, skip, held, size = seq + 1, skip + size, [], 0
        if held:
            yield block()

    return ordered.select("doc_id", "ids").mapInArrow(packed, BLOCK)


def write(docs: DataFrame, folder: str, path: str = VOCABULARY, end_id: int = END_ID) -> None:
    """Encodes all texts of (doc_id, text) and writes them as id files into a new folder.

    Documents stand in ascending order of doc_id; rows without an id come first, rows that repeat one by their number
    of ids and a digest of them. A null or empty text is the end id alone. An empty table gives empty tables. Other
    columns are not read. Texts are encoded once into a table in the shared folder, which is read for the
    frequencies, to be dealt and to be packed, and then deleted. What is broadcast is one rank for each id of the vocabulary.
    """
    spark = docs.sparkSession
    size = max(WordEncoder(path).size, end_id + 1)
    kind = stored(size)
    encoded = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), token_bytes(F.col("text"), kind, path, end_id).alias("ids")
    ).select(
        "doc_id", "ids", (F.octet_length("ids") / kind.itemsize).cast("long").alias("n_tokens"),
        F.xxhash64("ids").alias("mark"), F.monotonically_increasing_id().alias("row"),
    )
    held = new_folder(spark, "token-ids")
    tokens = written_to(encoded, held)
    ranks = ranked(frequencies(tokens, kind), size)
    rows = [(i, r) for i, r in enumerate(ranks.tolist())]
    spark.createDataFrame(rows, "id long, rank long").coalesce(1).write.parquet(f"{folder}/ranks")
    blocks(tokens, ranks, kind).write.parquet(f"{folder}/blocks")
    removed(spark, held)
    totals = spark.read.parquet(f"{folder}/blocks").groupBy("part").agg(F.sum("n").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    totals.select("part", before.alias("before")).write.parquet(f"{folder}/parts")


def _read(spark: SparkSession, folder: str, schema: str, rows: Callable) -> DataFrame:
    """Decodes every block in tasks; `rows` turns (doc_ids, starts, sizes, ids) into a record batch."""
    ranks = spark.read.parquet(f"{folder}/ranks")
    by_rank = np.array([r.id for r in ranks.orderBy("rank").collect()], ID_TYPE)
    shared = spark.sparkContext.broadcast(by_rank)
    found = spark.read.parquet(f"{folder}/blocks").join(F.broadcast(spark.read.parquet(f"{folder}/parts")), "part")

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in slices([batch], 1):
                if not len(block):
                    continue
                held = {name: block.column(name)[0].as_py() for name in block.schema.names}
                ids = shared.value[unpack(held["control"], held["data"], held["n"])]
                sizes = np.array(held["sizes"], np.int64)
                starts = held["before"] + np.cumsum(sizes) - sizes
                yield rows(held["doc_ids"], starts, sizes, ids)

    return found.select(
        (F.col("before") + F.col("skip")).alias("before"), "n", "doc_ids", "sizes", "control", "data"
    ).mapInArrow(decoded, schema)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, ids) of every document of a folder of id files; `start` counts the ids of all before it."""

    def rows(doc_ids: list, starts: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        offsets = np.zeros(len(sizes) + 1, np.int32)
        np.cumsum(sizes, out=offsets[1:])
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))
        return pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(starts), lists], ["doc_id", "start", "ids"])

    return _read(spark, folder, "doc_id long, start long, ids array<int>", rows)


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, worked out from the ids that the files give back."""

    def rows(doc_ids: list, starts: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        raw, ends = memoryview(ids.tobytes()), (np.cumsum(sizes) * ID_TYPE.itemsize).tolist()
        sums = [zlib.crc32(raw[a:b]) for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array(doc_ids, pa.int64()), pa.array(starts), pa.array(sizes), pa.array(sums, pa.int64())],
            ["doc_id", "start", "n_tokens", "ids_crc32"],
        )

    return _read(spark, folder, "doc_id long, start long, n_tokens long, ids_crc32 long", rows)
