"""Quality rules as a ledger of failure bits.

Every rule is evaluated once. The ledger keeps a document's measurements and one bit for each rule that it fails.
Policies are versions of a bit mask applied to it, and ablations are counts of equal bit patterns: neither reads a
text again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linewarden.llm.common import as_bytes, slices, steps
from linewarden.llm.tokens import SPACES, Spans, WordHasher, combined, marks, mixed

SYMBOLS = b"#*$%&|<>"
CAPITALS, SMALL = bytes(range(65, 91)), bytes(range(97, 123))
LETTERS = CAPITALS + SMALL + bytes(range(0x80, 0x100))
#: Words of a window that counts as repeated.
REPEAT_WORDS = 3

#: Whole numbers measured on a text; a word is a run of bytes other than [\x20\x09-\x0D].
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_capital_words", "n_letter_words",
)

#: Rules by bit, in order: the bit is set where the condition holds.
RULES: dict[str, str] = {
    "short": "n_words < 50",
    "repetitive": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 10 * n_words",
    "capitals": "100 * n_capital_words > 30 * n_words",
    "word_length": "word_chars < 3 * n_words OR word_chars > 10 * n_words",
    "letters": "100 * n_letter_words < 80 * n_words",
    "repeated_lines": "100 * n_dup_lines > 50 * n_lines",
    "rather_repetitive": "100 * n_repeat_words > 40 * n_words",
}
BASE = ("short", "repetitive")
#: Versions of the policy: the rules that a document must pass.
POLICIES: dict[str, tuple[str, ...]] = {"v1": BASE, "v2": (*BASE, "symbols", "capitals"), "v3": tuple(RULES)}


def repeated_words(found: Spans) -> np.ndarray:
    """For each text its words in windows of REPEAT_WORDS words that occur twice or more in it."""
    n, owner = len(found.hashes), found.owners()
    if n < REPEAT_WORDS:
        return np.zeros(len(found.bounds) - 1, np.int64)
    last = n - REPEAT_WORDS + 1
    window = found.hashes[:last]
    for k in range(1, REPEAT_WORDS):
        window = combined(window, found.hashes[k : last + k])
    at = np.flatnonzero(owner[:last] == owner[REPEAT_WORDS - 1 :])
    keys = window[at] ^ mixed(owner[at].astype(np.uint64) + np.uint64(1))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    again = np.zeros(len(at), bool)
    again[order[1:]] |= same
    again[order[:-1]] |= same
    covered = np.zeros(n, bool)
    for k in range(REPEAT_WORDS):
        covered[at[again] + k] = True
    return found.per_text(covered)


def measured(texts: list[bytes], words: WordHasher, lines: WordHasher) -> list[np.ndarray]:
    """MEASURES of each text, in order."""
    found = words.spans(texts)
    every = np.zeros(len(found.raw) + 1, np.int64)
    np.cumsum(marks(SYMBOLS)[found.raw], out=every[1:])
    symbols = every[found.firsts[1:] - 1] - every[found.firsts[:-1]]
    characters = found.in_words(~marks(bytes(range(0x80, 0xC0))))
    capital = (found.in_words(marks(CAPITALS)) > 1) & (found.in_words(marks(SMALL)) == 0)
    row = lines.spans(texts)
    full = row.in_words(~marks(SPACES)) > 0
    owner = row.owners()
    keys = (row.hashes ^ mixed(owner.astype(np.uint64) + np.uint64(1)))[full]
    order = np.argsort(keys, kind="stable")
    again = np.zeros(len(row.hashes), bool)
    again[np.flatnonzero(full)[order[1:][keys[order][1:] == keys[order][:-1]]]] = True
    return [
        np.diff(found.bounds), found.per_text(characters), symbols, row.per_text(again), repeated_words(found),
        row.per_text(full), found.per_text(capital), found.per_text(found.in_words(marks(LETTERS)) > 0),
    ]


@F.arrow_udf(T.StructType([T.StructField(name, T.LongType()) for name in MEASURES]))
def measures(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    words, lines = WordHasher(SPACES, lower=False), WordHasher(b"\n", lower=False)
    for batch in slices(batches):
        texts = as_bytes(batch)
        parts = [measured(texts[a:b], words, lines) for a, b in steps(texts)]
        columns = [np.concatenate([np.zeros(0, np.int64), *(p[i] for p in parts)]) for i in range(len(MEASURES))]
        yield pa.StructArray.from_arrays([pa.array(c.astype(np.int64)) for c in columns], list(MEASURES))


def bit(rule: str) -> int:
    return 1 << list(RULES).index(rule)


def mask(rules: tuple[str, ...]) -> int:
    return sum(bit(r) for r in rules)


def ledger(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, MEASURES, failures) of every row; other columns are not read.

    A null or empty text has no words and fails `short` alone. Repeated rows give repeated entries.
    """
    found = docs.select(F.col(doc_id).alias("doc_id"), measures(F.col(text).cast("string")).alias("found"))
    flat = found.select("doc_id", "found.*")
    failures = F.lit(0).cast("long")
    for name, condition in RULES.items():
        failures = failures.bitwiseOR(F.when(F.expr(condition), F.lit(bit(name))).otherwise(0).cast("long"))
    return flat.withColumn("failures", failures)


def passes(rules: tuple[str, ...], failures: str = "failures") -> Column:
    """Whether a ledger entry fails none of the rules."""
    return F.col(failures).bitwiseAND(F.lit(mask(rules))) == 0


def ablations(entries: DataFrame, policies: dict[str, tuple[str, ...]] = POLICIES) -> DataFrame:
    """(policy, rule, failed, only, kept_without): what each rule does in each policy.

    `failed` documents fail the rule, `only` fail no other rule of the policy, `kept_without` would pass the policy
    without it. Worked out from the counts of equal bit patterns, at most 2^rules rows.
    """
    patterns = entries.groupBy("failures").agg(F.count("*").alias("documents"))
    pairs = [(p, r, mask(rules), bit(r)) for p, rules in policies.items() for r in rules]
    wanted = entries.sparkSession.createDataFrame(pairs, "policy string, rule string, policy_mask long, rule_bit long")
    counted = patterns.crossJoin(F.broadcast(wanted))
    broken = F.col("failures").bitwiseAND(F.col("policy_mask"))
    others = broken.bitwiseAND(F.bitwise_not("rule_bit"))

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("documents")).otherwise(0))

    return counted.groupBy("policy", "rule").agg(
        total(broken.bitwiseAND(F.col("rule_bit")) != 0).alias("failed"),
        total(broken == F.col("rule_bit")).alias("only"),
        total(others == 0).alias("kept_without"),
    )
