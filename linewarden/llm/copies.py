"""Edited near copies: documents that share four fifths of their distinct five-word shingles.

MinHash keys in bands propose pairs, the exact Jaccard similarity of the shingles settles them. A pair at the threshold
shares a key in at least one of 24 bands of five rows but in 1 of 14,000 cases.

In a group of up to SMALL members every pair is compared. In a larger one every member is first held against LEADERS
others, chosen by a hash that differs from band to band, so that most of what belongs together is linked by pairs that
grow with the members. What these links leave apart within a group is then compared in full: everything outside the
group's largest part against all its members, a block of shingles by a block of shingles, so no pair is left out that
could link two parts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linewarden.llm import simhash
from linewarden.llm.common import LEAN_STEP, as_bytes, new_folder, removed, slices, steps, steps_of, written_to
from linewarden.llm.simhash import components
from linewarden.llm.tokens import WordHasher, combined, mixed

SHINGLE_WORDS = 5
#: Least Jaccard similarity of near copies, in fifths.
LEAST, OF = 4, 5
BANDS, ROWS = 24, 5
#: Members up to which all pairs of a group are compared, and leaders of a larger one in each band.
SMALL, LEADERS = 12, 4
#: Shingles of one block of members, about: a task holds two blocks.
BLOCK_SHINGLES = 400_000
#: Most bytes of one batch of pairs of texts on its way to Python.
PAIR_BATCH = "16m"
#: Bytes of both texts that one step over a batch of pairs handles at a time, or one pair.
PAIR_STEP = 500_000
SEED = 11
SKETCH = T.StructType([
    T.StructField("size", T.LongType()), T.StructField("print", T.LongType()), T.StructField("keys", T.ArrayType(T.LongType())),
])


def shingles(texts: Sequence[bytes], words: WordHasher) -> list[np.ndarray]:
    """Distinct hashes of each text's shingles; a text with fewer words is one shingle, one without words has none."""
    hashes, bounds = words(texts)
    out = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        width = min(SHINGLE_WORDS, b - a)
        if not width:
            out.append(np.zeros(0, np.uint64))
            continue
        found = mixed(hashes[a : b - width + 1] + np.uint64(width))
        for k in range(1, width):
            found = combined(found, hashes[a + k : b - width + 1 + k])
        out.append(np.unique(found))
    return out


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """A row of BANDS keys for each set, none of them empty."""
    joined = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    factors = np.random.default_rng(SEED).integers(1, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
    keys = np.zeros((len(sets), BANDS), np.uint64)
    for at, factor in enumerate(factors):
        least = np.minimum.reduceat(mixed(joined * factor), starts)
        keys[:, at // ROWS] = combined(keys[:, at // ROWS], least)
    return keys


@F.arrow_udf(SKETCH)
def sketch(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """struct(size, print, keys): number of shingles, a hash of the whole set, MinHash keys (none without words)."""
    words = WordHasher()
    for batch in slices(batches):
        rows, texts = [], as_bytes(batch)
        for a, b in steps(texts, LEAN_STEP):
            sets = shingles(texts[a:b], words)
            full = [s for s in sets if len(s)]
            keys = iter(band_keys(full).view(np.int64).tolist() if full else [])
            for s in sets:
                whole = int(s.sum(dtype=np.uint64).astype(np.int64))
                rows.append({"size": len(s), "print": whole, "keys": next(keys) if len(s) else []})
        yield pa.array(rows, pa.struct([("size", pa.int64()), ("print", pa.int64()), ("keys", pa.list_(pa.int64()))]))


@F.arrow_udf(T.BooleanType())
def alike(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Whether two texts share at least LEAST of OF shingles of either."""
    words = WordHasher()
    for left, right in batches:
        ones, others, out = as_bytes(left), as_bytes(right), []
        for a, b in steps_of([len(x) + len(y) for x, y in zip(ones, others, strict=True)], PAIR_STEP):
            for s, t in zip(shingles(ones[a:b], words), shingles(others[a:b], words), strict=True):
                both = len(np.intersect1d(s, t, assume_unique=True))
                out.append(both > 0 and OF * both >= LEAST * (len(s) + len(t) - both))
        yield pa.array(out, pa.bool_())


def proposed(sketches: DataFrame) -> DataFrame:
    """(low, high): distinct pairs of ids that share a group and whose numbers of shingles let them be alike."""
    bands = sketches.select(F.struct("doc_id", "size").alias("member"), F.posexplode("keys").alias("band", "key"))
    leaders = F.array(*[F.min_by("member", F.xxhash64("member.doc_id", "band", F.lit(k))) for k in range(LEADERS)])
    groups = bands.groupBy("band", "key").agg(F.count("*").alias("n"), leaders.alias("leaders")).where("n > 1")
    met = bands.join(groups, ["band", "key"])
    led = met.where(F.col("n") > SMALL).select("member", F.explode("leaders").alias("other"))
    small = met.where(F.col("n") <= SMALL).groupBy("band", "key").agg(F.collect_list("member").alias("members"))
    each = small.select("members", F.explode("members").alias("member")).select("member", F.explode("members").alias("other"))
    both = led.unionByName(each)
    a, b = F.col("member.size"), F.col("other.size")
    near = OF * F.least(a, b) >= LEAST * F.greatest(a, b)
    ids = [F.col("member.doc_id"), F.col("other.doc_id")]
    return both.where(near & (ids[0] != ids[1])).select(F.least(*ids).alias("low"), F.greatest(*ids).alias("high")).distinct()


@F.arrow_udf(T.BinaryType())
def shingled(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The hashes of a text's distinct shingles, eight bytes each."""
    words = WordHasher()
    for batch in slices(batches):
        texts = as_bytes(batch)
        yield pa.array([s.tobytes() for a, b in steps(texts, LEAN_STEP) for s in shingles(texts[a:b], words)], pa.binary())


def apart(sketches: DataFrame, roots: DataFrame, folder: str) -> DataFrame:
    """(band, key, part, block, doc_id, root, seeks): members of the large groups whose links leave several roots.

    Members that seek are those outside the largest root of their group. Each meets all members: a group's seekers are
    dealt over parts, its members over blocks, and there is a row of every member for each part, and of every seeker
    for each block.
    """
    bands = sketches.select("doc_id", "size", F.posexplode("keys").alias("band", "key"))
    large = bands.groupBy("band", "key").agg(F.count("*").alias("n")).where(F.col("n") > SMALL).drop("n")
    named = roots.select(F.col("node").alias("doc_id"), "root")
    met = bands.join(large, ["band", "key"]).join(named, "doc_id", "left")
    met = written_to(met.withColumn("root", F.coalesce("root", "doc_id")), folder)
    each = met.groupBy("band", "key", "root").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    rank = F.struct("n", "root")
    groups = each.groupBy("band", "key").agg(
        F.count("*").alias("roots"), F.max_by("root", rank).alias("most"),
        F.sum("size").alias("whole"), F.max_by("size", rank).alias("linked"),
    ).where("roots > 1")

    def dealt(size: Column, name: str) -> tuple[Column, Column]:
        number = F.ceil(size / BLOCK_SHINGLES).cast("int")
        return number, F.pmod(F.xxhash64("doc_id", F.lit(name)), number).cast("int")

    blocks, block = dealt(F.col("whole"), "block")
    parts, part = dealt(F.col("whole") - F.col("linked"), "part")
    seeks = F.col("root") != F.col("most")
    every = F.transform(
        F.sequence(F.lit(0), parts - 1),
        lambda p: F.struct(p.alias("part"), block.alias("block"), (seeks & (p == part)).alias("seeks")),
    )
    others = F.filter(F.sequence(F.lit(0), blocks - 1), lambda b: seeks & (b != block))
    more = F.transform(others, lambda b: F.struct(part.alias("part"), b.alias("block"), F.lit(True).alias("seeks")))
    rows = met.join(groups, ["band", "key"]).select("band", "key", "doc_id", "root", F.explode(F.concat(every, more)).alias("at"))
    return rows.select("band", "key", "at.*", "doc_id", "root")


def root_links(table: pa.Table) -> pa.Table:
    """(low, high): links that join the roots of members that are alike, of what seeks and the others in one table."""
    ids = table.column("root").to_pylist()
    names = sorted(set(ids))
    number = {root: i for i, root in enumerate(names)}
    own = np.array([number[i] for i in ids])
    sets = [np.frombuffer(b, np.uint64) for b in table.column("shingles").to_pylist()]
    sizes = np.array([len(s) for s in sets])
    starts = np.cumsum(sizes) - sizes
    kinds, flat = np.unique(np.concatenate(sets), return_inverse=True)
    label, found = own.copy(), []
    for at in np.flatnonzero(table.column("seeks").to_numpy()):
        near = (label != label[at]) & (OF * np.minimum(sizes, sizes[at]) >= LEAST * np.maximum(sizes, sizes[at]))
        if not near.any():
            continue
        has = np.zeros(len(kinds), np.int64)
        has[flat[starts[at] : starts[at] + sizes[at]]] = 1
        both = np.add.reduceat(has[flat], starts)
        hits = np.flatnonzero(near & (OF * both >= LEAST * (sizes + sizes[at] - both)))
        for hit in hits.tolist():
            if label[hit] != label[at]:
                found.append(sorted((ids[at], ids[hit])))
                label[label == label[hit]] = label[at]
    kind = table.schema.field("root").type
    low, high = ([pair[k] for pair in found] for k in (0, 1))
    return pa.table({"low": pa.array(low, kind), "high": pa.array(high, kind)})


def joined_roots(docs: DataFrame, sketches: DataFrame, roots: DataFrame) -> DataFrame:
    """`roots` with those joined that a pair of alike members of one large group links, whoever led the group."""
    spark = docs.sparkSession
    folders = [new_folder(spark, f"copy-{name}") for name in ("members", "apart", "shingles", "joins")]
    rows = written_to(apart(sketches, roots, folders[0]), folders[1])
    texts = docs.join(rows.select("doc_id").distinct(), "doc_id", "left_semi")
    sets = texts.select("doc_id", shingled(F.col("text").cast("string")).alias("shingles")).where("length(shingles) > 0")
    sets = written_to(sets, folders[2])
    kind = sketches.schema["doc_id"].dataType
    shape = T.StructType([T.StructField("low", kind), T.StructField("high", kind)])
    met = rows.join(sets, "doc_id").groupBy("band", "key", "part", "block")
    links = written_to(met.applyInArrow(root_links, shape).distinct(), folders[3])
    if not links.isEmpty():
        above = components(links)
        top = above.select(F.col("node").alias("root"), F.col("root").alias("top"))
        lifted = roots.join(top, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
        roots = lifted.unionByName(above.join(roots, "node", "left_anti")).checkpoint()
    removed(spark, *folders)
    return roots


def near_copies(docs: DataFrame, sketches: DataFrame) -> DataFrame:
    """(node, root): the smallest id that links of alike texts reach, for every document with a link.

    `sketches` has one (doc_id, size, keys) for each set of shingles. Only texts of documents in a pair, or in a large
    group that its leaders don't link, are moved.
    """
    spark = docs.sparkSession
    folders = [new_folder(spark, f"copy-{name}") for name in ("pairs", "texts", "links")]
    pairs = written_to(proposed(sketches), folders[0])
    some = pairs.select(F.explode(F.array("low", "high")).alias("doc_id")).distinct()
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(some, "doc_id", "left_semi")
    texts = written_to(texts, folders[1])
    named = lambda side: texts.select(F.col("doc_id").alias(side), F.col("text").alias(f"{side}_text"))
    held = pairs.join(named("low"), "low").join(named("high"), "high")
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(bound)
    spark.conf.set(bound, PAIR_BATCH)
    try:
        links = written_to(held.where(alike(F.col("low_text"), F.col("high_text"))).select("low", "high"), folders[2])
    finally:
        spark.conf.set(bound, before)
    roots = components(links)
    removed(spark, *folders)
    return joined_roots(docs, sketches, roots)


def kept_ids(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(doc_id): of the known ids the smallest of each group linked by near copies, distinct.

    Texts without words are no copies and stay. Rows that repeat an id go or stay together. Texts may be of any length;
    an empty table gives an empty result.
    """
    spark = docs.sparkSession
    folders = [new_folder(spark, f"copy-{name}") for name in ("sketches", "leads")]
    found = docs.where("doc_id IS NOT NULL").select("doc_id", sketch(F.col("text").cast("string")).alias("found"))
    sketches = written_to(found.select("doc_id", "found.*").join(known, "doc_id", "left_semi"), folders[0])
    full = sketches.where("size > 0").groupBy("size", "print")
    leads = written_to(full.agg(F.min("doc_id").alias("doc_id"), F.first("keys").alias("keys")).drop("print"), folders[1])
    roots = near_copies(docs, leads)
    kept = leads.join(roots, F.col("doc_id") == F.col("node"), "left").where("root IS NULL OR root = doc_id").select("doc_id")
    kept = kept.unionByName(sketches.where("size = 0").select("doc_id")).distinct().checkpoint()
    removed(spark, *folders)
    return kept


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of `docs` with one document left of each group of near-duplicates; columns as they are.

    First of each group of SimHash near-duplicates, then, of what is left, of each group linked by near copies, the
    smallest id. All rows of an id that stays stay. Rows without an id can't be told apart and stay.
    """
    kept = kept_ids(docs, simhash.kept_ids(docs))
    return docs.join(kept, "doc_id", "left_semi").select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))
