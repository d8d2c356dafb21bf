"""Registered queries of the document operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linewarden.llm import (
    automaton, families, ftrl, idfile, latent, ledger, middle, phrases, pieces, pseudonym, simhash, spread, toxicity,
)
from linewarden.llm.common import in_fold, new_folder, table


#: Key of the registered query only; a real corpus takes a secret one.
SAMPLE_KEY = b"registered query"


def op1_pseudonym(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", pseudonym.pseudonymised(F.col("text"), SAMPLE_KEY).alias("found"))
    return found.select("doc_id", "found.text", "found.spans", F.size("found.spans").cast("long").alias("n_replaced"))


def op2_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = ledger.ledger(table(spark, sf_dir, "documents"))
    return entries.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~ledger.passes(ledger.BASE)).alias("base_failed"), ledger.passes(ledger.POLICIES["v3"]).alias("kept"),
        "n_lines", "n_capital_words", "n_letter_words", "failures",
    )


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_latent(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return latent.contaminated(docs, table(spark, sf_dir, "benchmark"))


def op5_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = ftrl.add_score(docs, ftrl.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", in_fold(F.col("doc_id"), 4, 2).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op6_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = automaton.scored(docs, automaton.trained_on(F.col("doc_id")))
    return found.select(
        "doc_id", in_fold(F.col("doc_id"), 7, 2).alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score",
    )


def op7_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = families.add_language(docs.select("doc_id", "text"), families.fit(docs))
    return found.select("doc_id", in_fold(F.col("doc_id"), 4, 2).alias("held_out"), "found.lang_pred", "found.score")


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", pieces.encoded(spark, F.col("text")).alias("found"))
    return found.select("doc_id", "found.ids", F.size("found.ids").cast("long").alias("n_tokens"), "found.restored")


def op9_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = spread.without_boilerplate(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return cleaned.select("doc_id", "text", "lines_removed")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = model.add_score(docs, "score")
    return scored.select(
        "doc_id", in_fold(F.col("doc_id"), 5, 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op11_idfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "id-files")
    idfile.write(table(spark, sf_dir, "documents"), folder)
    return idfile.digests(spark, folder)


def op12_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = middle.rearranged(table(spark, sf_dir, "documents"))
    back = middle.restored(F.col("output"), F.col("form"))
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(back, 256).alias("restored_sha256"),
    )


def op13_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pseudonym": op1_pseudonym,
    "op2_ledger": op2_ledger,
    "op3_simhash": op3_simhash,
    "op4_latent": op4_latent,
    "op5_ftrl": op5_ftrl,
    "op6_automaton": op6_automaton,
    "op7_families": op7_families,
    "op8_pieces": op8_pieces,
    "op9_line_spread": op9_line_spread,
    "op10_toxicity": op10_toxicity,
    "op11_idfile": op11_idfile,
    "op12_boundaries": op12_boundaries,
    "op13_rollup": op13_rollup,
}
