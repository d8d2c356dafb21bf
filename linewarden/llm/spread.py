"""Line dedup by distinct-site spread: lines that many sites share are boilerplate.

A HyperLogLog sketch of the sites is kept for each line hash and merged by aggregation. Where the estimate is too
near the threshold to trust, the sites are counted exactly. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linewarden.llm.common import written

#: Distinct sites from which a line is boilerplate.
MIN_SITES = 6
#: 2^this buckets a sketch; the standard error is 1.04 / sqrt(buckets).
SKETCH_BITS = 10
#: Estimates within this share of the threshold are settled by exact counts: over five standard errors.
NEAR = 0.2
#: A document with more than this share of its characters in spread lines is a copy of another document rather
#: than a page with boilerplate around it; it is left whole for near-duplicate removal.
MOST_REMOVED = 0.5
#: For a pipeline: a line of more than LONG_WORDS words is spread from LONG_SITES sites on.
LONG_WORDS, LONG_SITES = 50, 2
#: For a pipeline: only a document with fewer characters than this outside spread lines is left whole.
FEW_CHARS = 20
BLANK = " \t\r\x0b\x0c"


def trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANK))


def line_table(docs: DataFrame, site: str = "source", long_words: int | None = None) -> DataFrame:
    """(doc_id, site, line, chars) of every line that has more than blanks; `line` is a 64-bit hash.

    With `long_words` also `long`: whether the line has more words than that. A null site counts as one site of its own. Rows without an id are left out.
    """
    lines = docs.where(F.col("doc_id").isNotNull()).select(
        "doc_id",
        F.coalesce(F.col(site).cast("string"), F.lit("")).alias("site"),
        F.explode(F.split(F.col("text").cast("string"), "\n")).alias("line"),
    )
    short = lines.select("doc_id", "site", trimmed(F.col("line")).alias("line")).where("line <> ''")
    long = [] if long_words is None else [(F.size(F.split("line", r"[\x20\x09-\x0D]+")) > long_words).alias("long")]
    return short.select("doc_id", "site", F.xxhash64("line").alias("line"), F.length("line").alias("chars"), *long)


def spread_lines(lines: DataFrame, min_sites: int = MIN_SITES, long_sites: int | None = None) -> DataFrame:
    """(line, sites, keeper): lines on at least `min_sites` sites; `keeper` is the smallest document with it.

    With `long_sites` that many are enough for lines marked `long`.
    """
    least = F.lit(min_sites) if long_sites is None else F.when(F.max("long"), long_sites).otherwise(min_sites)
    sketched = lines.groupBy("line").agg(
        F.hll_sketch_agg("site", F.lit(SKETCH_BITS)).alias("sketch"), F.min("doc_id").alias("keeper"), least.alias("least")
    )
    likely = written(
        sketched.select("line", "keeper", "least", F.hll_sketch_estimate("sketch").alias("sites"))
        .where(F.col("sites") >= F.col("least") * (1 - NEAR)),
        "line-sites",
    )
    sure = F.col("sites") > F.col("least") * (1 + NEAR)
    unsure = likely.where(~sure).select("line", "keeper", "least")
    exact = (
        lines.join(unsure.select("line"), "line", "left_semi")
        .groupBy("line", "site").agg(F.lit(1).alias("one"))
        .groupBy("line").agg(F.count("one").alias("sites"))
    )
    settled = unsure.join(exact, "line").where(F.col("sites") >= F.col("least")).select("line", "sites", "keeper")
    return likely.where(sure).select("line", "sites", "keeper").unionByName(settled)


def without_boilerplate(
    docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES, most_removed: float = MOST_REMOVED,
    long_words: int | None = None, long_sites: int = LONG_SITES,
    few_chars: int | None = None,
) -> DataFrame:
    """`docs` with boilerplate lines cut from `text`, and the count in `lines_removed`.

    A line of a document goes if at least `min_sites` distinct sites have it and a smaller id has it too: the
    first document keeps it. Lines are compared without blanks at their ends. A document with more than
    `most_removed` of its characters in such lines is left whole, as are null and empty texts and rows without an
    id. With `long_words`, `long_sites` sites are enough for lines of more words than that. With `few_chars` only
    a document with fewer characters outside such lines is left whole, whatever their share. Rows that repeat an id share one decision over the lines of all of them. A column named `lines_removed`
    is replaced.
    """
    lines = written(line_table(docs, site, long_words), "lines")
    spread = spread_lines(lines, min_sites, None if long_words is None else long_sites)
    hits = lines.join(spread.select("line", "keeper"), "line").where(F.col("doc_id") > F.col("keeper"))
    totals = hits.groupBy("doc_id").agg(
        F.collect_set("line").alias("cut"), F.sum("chars").alias("cut_chars")
    ).select(F.col("doc_id").alias("cut_id"), "cut", "cut_chars")
    whole = lines.groupBy("doc_id").agg(F.sum("chars").alias("all_chars"))
    if few_chars is None:
        enough = F.col("cut_chars") <= most_removed * F.col("all_chars")
    else:
        enough = F.col("all_chars") - F.col("cut_chars") >= few_chars
    decided = totals.join(whole, totals.cut_id == whole.doc_id).where(enough).select("cut_id", "cut")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("own_id"))
    met = rows.join(decided, F.col("own_id") == F.col("cut_id"), "left")
    pieces = F.split(F.col("row.text").cast("string"), "\n")
    left = F.filter(pieces, lambda x: ~F.array_contains(F.col("cut"), F.xxhash64(trimmed(x))))
    cleaned = met.withColumn("left", F.when(F.col("cut").isNotNull(), left))
    text = F.when(F.col("cut").isNotNull(), F.array_join("left", "\n")).otherwise(F.col("row.text").cast("string"))
    removed = F.when(F.col("cut").isNotNull(), F.size(pieces) - F.size("left")).otherwise(0).cast("long")
    columns = [text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns if c != "lines_removed"]
    return cleaned.select(*columns, removed.alias("lines_removed"))
