"""SimHash near-duplicates found by meet-in-the-middle ball hashing.

A fingerprint takes the majority of each bit over the XXH64 hashes of the text's 3-word shingles. Every distinct
fingerprint emits itself and the 64 values one bit away. Two fingerprints at most two bits apart meet in one of
those values, and all that meet in a value lie within two bits of each other, so a value's smallest member links
to every other one and no link between groups is lost. A value has 65 possible members: no group can grow.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linewarden.llm.common import as_bytes, shared_folder, slices

SHINGLE_WORDS = 3
SEED = 42
RADIUS = 2
#: Hashes whose bits are counted at a time.
STEP = 1 << 16


def text_fingerprint(text: bytes) -> int:
    """Signed 64-bit fingerprint of one whole text; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    width = min(SHINGLE_WORDS, len(words))
    digest, n = xxhash.xxh64_intdigest, len(words) - width + 1
    ones = np.zeros(64, np.int64)
    for at in range(0, n, STEP):
        spans = zip(starts[at : min(at + STEP, n)], ends[at + width - 1 :], strict=False)
        hashes = np.fromiter((digest(joined[a : b - 1], SEED) for a, b in spans), np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


@F.arrow_udf(T.LongType())
def fingerprint(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in slices(batches):
        yield pa.array([text_fingerprint(t) for t in as_bytes(texts)], pa.int64())


def ball(value: Column) -> Column:
    """The value and all values one bit away: within half the radius."""
    return F.array(value, *[value.bitwiseXOR(F.lit(1 << k if k < 63 else -(1 << 63))) for k in range(64)])


def links(prints: DataFrame) -> DataFrame:
    """(low, high): links that join all distinct `fingerprint` values at most two bits apart into their groups."""
    variants = prints.select("fingerprint", F.explode(ball(F.col("fingerprint"))).alias("variant"))
    low = F.min("fingerprint").over(Window.partitionBy("variant"))
    met = variants.select(low.alias("low"), F.col("fingerprint").alias("high")).where("low <> high").distinct()
    return met.where(F.bit_count(F.col("low").bitwiseXOR(F.col("high"))) <= RADIUS)


def components(edges: DataFrame) -> DataFrame:
    """(node, root): smallest node reachable over undirected links (low, high), for every linked node.

    Each round takes the smallest root among the neighbours, then the root's root, until nothing changes; chains
    shorten by more than half each round. Rounds are checkpointed in the shared folder.
    """
    shared_folder(edges.sparkSession)
    both = edges.select(F.col("low").alias("node"), F.col("high").alias("other")).unionByName(
        edges.select(F.col("high").alias("node"), F.col("low").alias("other"))
    ).checkpoint()
    roots = both.groupBy("node").agg(F.min(F.least("node", "other")).alias("root")).checkpoint()
    while True:
        seen = roots.select(F.col("node").alias("other"), F.col("root").alias("theirs"))
        nearest = both.join(seen, "other").groupBy("node").agg(F.min("theirs").alias("theirs"))
        lowered = roots.join(nearest, "node").select(
            "node", F.least("root", "theirs").alias("root"), (F.col("theirs") < F.col("root")).alias("moved")
        ).checkpoint()
        if lowered.where("moved").isEmpty():
            return lowered.select("node", "root")
        above = lowered.select(F.col("node").alias("root"), F.col("root").alias("top"))
        roots = lowered.join(above, "root").select("node", F.col("top").alias("root")).checkpoint()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    `component_id` is the smallest id reachable over links of at most two differing bits, itself included. Texts
    that are null or have no word share fingerprint 0, which links like any other. Repeated rows give repeated
    results; a row without an id gets its group's smallest id, or null where the group has none. Other columns of
    `docs` are not read. A hot fingerprint is one row after grouping; joins back to the rows are plain equi-joins
    that Spark can split.
    """
    shared_folder(docs.sparkSession)
    prints = docs.select(
        F.col(doc_id).alias("doc_id"), fingerprint(F.col(text).cast("string")).alias("fingerprint")
    ).checkpoint()
    groups = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("lead")).checkpoint()
    linked = components(links(groups)).withColumnRenamed("node", "fingerprint")
    members = groups.join(linked, "fingerprint", "left").select(
        "fingerprint", "lead", F.coalesce("root", "fingerprint").alias("root")
    ).checkpoint()
    leads = members.groupBy("root").agg(F.min("lead").alias("component_id"))
    named = members.join(leads, "root").select("fingerprint", "component_id")
    return prints.join(named, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def kept_ids(docs: DataFrame) -> DataFrame:
    """(doc_id): the smallest id of each group, distinct; none of rows without an id."""
    return near_duplicates(docs).where("doc_id = component_id").select("doc_id").distinct()
