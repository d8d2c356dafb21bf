"""Helpers shared by the document operators: words, batches of texts, labelled samples, shared folders."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters of text that one step over a batch handles at a time.
STEP_CHARS = 2_000_000
#: The same where a step builds rows of numbers for every word, so that a worker stays small.
LEAN_STEP = 500_000
#: Labelled documents of one task, about, where all are taken.
LABELLED_TASK = 2_000
#: Labels up to which they go to the texts, so that only labelled texts are moved.
SENT_LABELS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_fold(key: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the key as text leaves this remainder; false for a null key."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string")), F.lit(modulus)) == remainder, F.lit(False))


def shared_folder(spark: SparkSession) -> str:
    """The folder that all machines of the cluster see, for checkpoints and intermediate tables.

    It is spark.checkpoint.dir; where that is unset, a folder in the warehouse, which a cluster shares as well.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints")
    return context.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing stands at yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in a new folder of the shared one: its lineage ends there."""
    return written_to(df, new_folder(df.sparkSession, name))


def written_to(df: DataFrame, folder: str) -> DataFrame:
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def removed(spark: SparkSession, *folders: str) -> None:
    """Deletes intermediate tables that nothing reads any more."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for folder in folders:
        path = hadoop.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def slices(batches: Iterator, rows: int = 1_000) -> Iterator:
    """Arrays or record batches in slices of so many rows, so that little of a batch is unpacked at a time."""
    for batch in batches:
        for start in range(0, max(1, len(batch)), rows):
            yield batch.slice(start, rows)


def as_bytes(texts: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every text; a null text is empty."""
    return [t or b"" for t in texts.cast(pa.large_binary()).to_pylist()]


def steps(texts: Sequence[bytes], most: int = STEP_CHARS) -> Iterator[tuple[int, int]]:
    """Slices of a batch that hold at most so many bytes, or one text."""
    return steps_of(list(map(len, texts)), most)


def steps_of(sizes: Sequence[int], most: int = STEP_CHARS) -> Iterator[tuple[int, int]]:
    """Slices of items of these sizes that hold at most so much, or one item."""
    start = held = 0
    for at, size in enumerate(sizes):
        if at > start and held + size > most:
            yield start, at
            start, held = at, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def words_of(texts: Sequence[bytes]) -> tuple[list[bytes], np.ndarray]:
    """All words [^\\x20\\x09-\\x0D]+ in order, and the positions at which each text starts and the last ends."""
    split = [t.split() for t in texts]
    bounds = np.zeros(len(split) + 1, np.int64)
    np.cumsum([len(w) for w in split], out=bounds[1:])
    return list(chain.from_iterable(split)), bounds


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the rows of each text."""
    total = np.zeros((len(values) + 1, *values.shape[1:]))
    np.cumsum(values, axis=0, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


class WordTable(dict):
    """Numbers distinct words and keeps a row of measurements for each, worked out when it is first seen.

    A task's table is emptied once it holds `limit` words, so its memory is bounded.
    """

    def __init__(self, measure: Callable[[bytes], Sequence[float]], limit: int = 150_000):
        super().__init__()
        self.measure, self.limit = measure, limit
        self.fresh: list[Sequence[float]] = []
        self.known: np.ndarray | None = None
        self.size = 0

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.fresh.append(self.measure(word))
        return number

    def numbers(self, words: Sequence[bytes]) -> np.ndarray:
        """The number of every word; rows() of the same step go with them."""
        if len(self) > self.limit:
            self.clear()
            self.size = 0
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def rows(self, dtype: type = np.float64) -> np.ndarray:
        if self.fresh:
            new = np.array(self.fresh, dtype)
            need = self.size + len(new)
            if self.known is None or need > len(self.known):
                grown = np.zeros((2 * need, *new.shape[1:]), dtype)
                if self.known is not None:
                    grown[: self.size] = self.known[: self.size]
                self.known = grown
            self.known[self.size : need] = new
            self.size, self.fresh = need, []
        if self.known is None:
            return np.zeros(0, dtype)
        return self.known[: self.size]


def bounded_share(rows: int, bound: int, key: Column) -> Column:
    """Keeps about `bound` of so many rows, chosen by a hash of the key; all where there are no more."""
    if rows <= bound:
        return F.lit(True)
    return F.pmod(F.xxhash64(key.cast("string"), F.lit("sample")), F.lit(1_000_000)) < int(1_000_000 * bound / rows)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, keep: Callable[[Column], Column], bound: int | None, tasks: int = 6
) -> DataFrame:
    """(doc_id, text, label) of about `bound` labelled documents at most, dealt over a few tasks.

    With no bound it has all of them, over as many tasks more as keep each at about LABELLED_TASK documents. The
    largest label of a repeated id counts. Labels other than 0 and 1 and null ids are left out.
    """
    marked = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.max(label).cast("double").alias("label"))
        .where(keep(F.col("doc_id")))
    )
    rows = marked.count()
    if bound is not None:
        marked, rows = marked.where(bounded_share(rows, bound, F.col("doc_id"))), min(rows, bound)
    else:
        tasks = max(tasks, -(-rows // LABELLED_TASK))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(marked) if rows <= SENT_LABELS else marked, "doc_id").repartition(tasks)
