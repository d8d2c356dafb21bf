"""Turn configured rules and limits into boolean and text Columns.

Everything is decided while the plan is built: which physical column feeds a rule, the
order of the texts, and which texts repeat. Flags are packed into small integers, and the
joined texts of every flag combination are tabulated beforehand, so a row costs its
comparisons and one array lookup per packed integer. That keeps the generated code short;
spelling every text out as its own branch makes methods too long for the JIT compiler.
"""

from __future__ import annotations

import operator
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linewarden.config.production import COLUMN_ALIASES
from linewarden.functions.text import LIST_SEPARATOR, as_double, normalized_text
from linewarden.sources.rulebook import CauseRule, Limit

# Flags per packed integer, so 64 texts per lookup table.
WORD = 6
# Parts the entries of a lookup table; never part of a result.
CELL = "\u0002"

COMPARE = {
    "<=": operator.le,
    "<": operator.lt,
    ">=": operator.ge,
    ">": operator.gt,
    "==": operator.eq,
    "!=": operator.ne,
}


def physical_columns(df: DataFrame, name: str) -> list[str]:
    """Columns of `df` that can carry the configured column, best first."""
    present = {c.lower(): c for c in df.columns}
    wanted = [name.lower()]
    for aliases in COLUMN_ALIASES.values():
        if name.lower() in aliases:
            wanted.extend(a for a in aliases if a not in wanted)
    return [present[w] for w in wanted if w in present]


def _present(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.col(name).isNotNull() & ~F.isnan(name)
    return F.col(name).isNotNull()


def _first_present(df: DataFrame, names: Sequence[str], convert, kind: str) -> Column:
    """Converted value of the first column that holds one.

    The choice is made on presence, before conversion: an unreadable value in a preferred
    column does not fall through to the next one.
    """
    if not names:
        return F.lit(None).cast(kind)
    if len(names) == 1:
        return convert(names[0])
    chain = F.when(_present(df, names[0]), convert(names[0]))
    for name in names[1:]:
        chain = chain.when(_present(df, name), convert(name))
    return chain


def configured_number(df: DataFrame, name: str) -> Column:
    return _first_present(
        df, physical_columns(df, name), lambda c: as_double(df, c), "double"
    )


def configured_text(df: DataFrame, name: str) -> Column:
    return _first_present(
        df, physical_columns(df, name), lambda c: normalized_text(F.col(c)), "string"
    )


def cause_fires(df: DataFrame, rule: CauseRule) -> Column:
    """Whether a cause rule fires; a missing value never fires."""
    if rule.is_numeric:
        hit = COMPARE[rule.operator](configured_number(df, rule.column), F.lit(rule.value))
    else:
        expected = sorted({v.strip().lower() for v in rule.values} - {""})
        hit = configured_text(df, rule.column).isin(expected)
    return F.coalesce(hit, F.lit(False))


def limit_broken(df: DataFrame, limit: Limit) -> Column:
    """Whether a limit is violated; a missing value violates every limit but `!=`."""
    kept = COMPARE[limit.operator](as_double(df, limit.parameter), F.lit(limit.value))
    return ~F.coalesce(kept, F.lit(limit.operator == "!="))


def count_true(flags: Iterable[Column]) -> Column:
    total = F.lit(0)
    for flag in flags:
        total = total + flag.cast("int")
    return total


def any_true(flags: Sequence[Column]) -> Column:
    result = F.lit(False)
    for flag in flags:
        result = result | flag
    return result


def text_of_true(
    pairs: Sequence[tuple[Column, Column | str | None]], separator: str = LIST_SEPARATOR
) -> Column:
    """Texts of the true flags in the given order, joined; empty if none is true."""
    shown = [
        F.when(flag, text if isinstance(text, Column) else F.lit(text))
        for flag, text in pairs
        if text is not None
    ]
    return F.concat_ws(separator, *shown) if shown else F.lit("")


def pack(flags: Sequence[Column]) -> list[Column]:
    """Flags as integers of `WORD` bits each; null counts as false."""
    words = []
    for start in range(0, len(flags), WORD):
        word = F.lit(0)
        for bit, flag in enumerate(flags[start : start + WORD]):
            word = word + F.when(flag, 1 << bit).otherwise(0)
        words.append(word)
    return words


def packed_count(words: Sequence[Column], chosen: Sequence[bool] | None = None) -> Column:
    """Number of set flags, optionally only of the chosen ones."""
    total = F.lit(0)
    for i, word in enumerate(words):
        if chosen is not None:
            bits = sum(1 << b for b, c in enumerate(chosen[i * WORD : (i + 1) * WORD]) if c)
            word = word.bitwiseAND(bits)
        total = total + F.bit_count(word)
    return total


def _cell(texts: Sequence[str | None], word: int, separator: str, distinct: bool) -> str:
    shown = [text for bit, text in enumerate(texts) if word >> bit & 1 and text]
    return separator.join(dict.fromkeys(shown) if distinct else shown)


def packed_text(
    words: Sequence[Column],
    texts: Sequence[str | None],
    separator: str = LIST_SEPARATOR,
    distinct: bool = True,
) -> Column:
    """Texts of the set flags, in flag order, joined; blank texts never show.

    The table of one word holds the joined text of each of its combinations. With
    `distinct`, a text that also belongs to an earlier word is masked out of the later one
    when it showed there.
    """
    pieces = []
    parts = [texts[start : start + WORD] for start in range(0, len(texts), WORD)]
    for i, (word, part) in enumerate(zip(words, parts)):
        if not any(part):
            continue
        for text in {t for t in part if t} if distinct else ():
            repeats = ~sum(1 << b for b, t in enumerate(part) if t == text)
            for earlier, before in zip(words[:i], parts[:i]):
                bits = sum(1 << b for b, t in enumerate(before) if t == text)
                if bits:
                    shown = earlier.bitwiseAND(bits) != 0
                    word = word.bitwiseAND(F.when(shown, repeats).otherwise(-1))
        joined = [_cell(part, w, separator, distinct) for w in range(1 << len(part))]
        # One literal, taken apart when the plan is optimised.
        lookup = F.split(F.lit(CELL.join(joined)), CELL)
        pieces.append(F.nullif(F.get(lookup, word), F.lit("")))
    return F.concat_ws(separator, *pieces) if pieces else F.lit("")


def list_of_true(pairs: Sequence[tuple[Column, Column]]) -> Column:
    """Array of the values whose flag is true, order kept."""
    return F.array_compact(F.array(*[F.when(flag, value) for flag, value in pairs]))
