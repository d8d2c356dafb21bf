"""Corpus pipeline: the stages that turn the table `documents` into token ids.

Every stage takes (spark, docs, sf_dir), works on all documents that its predecessor kept, and returns a frame that
is written as Parquet and read again before the next one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linewarden.llm import copies, latent, pieces, spread, toxicity
from linewarden.llm.common import new_folder, removed, table, written_to

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def free(docs: DataFrame, name: str) -> str:
    """The name, with as many underscores behind it as keep it apart from the columns of `docs`."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learned from all of `labels` outside its held-out fold, scores under 0.5.

    Null and empty texts have the score of an empty text and rows that repeat are scored each; without any labels all
    stay. An empty table gives an empty result, and texts of any length are scored whole.
    """
    model, score = toxicity.fit(docs, table(spark, sf_dir, "labels"), rows=None), free(docs, "toxicity")
    return model.add_score(docs, score).where(F.col(score) < 0.5).select(*docs.columns)


def cut_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that many sites share, or long ones that two share; `n_chars` follows the text."""
    names = {c: free(docs, c) for c in docs.columns if c.lower() == "lines_removed"}
    cleaned = spread.without_boilerplate(
        docs.withColumnsRenamed(names), long_words=spread.LONG_WORDS, few_chars=spread.FEW_CHARS
    )
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        cleaned = cleaned.withColumn("n_chars", F.when(F.col("lines_removed") > 0, size).otherwise(F.col("n_chars")))
    return cleaned.select(*[F.col(names.get(c, c)).alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, its smallest id.

    Groups are those of SimHash fingerprints, and among what they leave those of edited copies, four fifths of whose
    five-word shingles are shared.
    """
    return copies.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of `benchmark`, nor a paraphrase of one.

    Null and empty texts hold none and stay, rows that repeat are judged each, texts are searched whole whatever their
    length, and an empty table or benchmark changes nothing.
    """
    found = latent.hits(docs, table(spark, sf_dir, "benchmark"))
    return docs.where(F.size(found) == 0).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens, restored): the piece ids of every text, and whether they spell it again.

    Null and empty texts have no ids and are restored, rows that repeat are encoded each, texts of any length are
    whole, and an empty table gives an empty result.
    """
    found = docs.select("doc_id", pieces.encoded(spark, F.col("text")).alias("found"))
    return found.select("doc_id", "found.ids", F.size("found.ids").cast("long").alias("n_tokens"), "found.restored")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", cut_boilerplate),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode),
]

#: SQL can express neither the models nor the fingerprints; tests hold the rows against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        folder = new_folder(spark, f"stage-{name}")
        docs = written_to(stage(spark, docs, sf_dir), folder)
        if before:
            removed(spark, before)
        before = folder
    return docs
