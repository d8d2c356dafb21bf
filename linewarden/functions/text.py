"""Text and number columns: missing values, lenient numbers, lists held in strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LIST_SEPARATOR = "; "
SUMMARY_MARKER = "mainly due to "
# Characters that count as blank, as Unicode defines white space, besides the separators 1C to 1F.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def column_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def stripped(text: Column) -> Column:
    """Text without white space of any kind at its ends."""
    return F.btrim(text, F.lit(BLANKS))


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, NaN, or blank text."""
    column, kind = F.col(name), column_type(df, name)
    if isinstance(kind, T.StringType):
        return column.isNull() | (stripped(column) == "")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def parse_number(text: Column) -> Column:
    """Text to double; anything that is no plain number becomes null.

    The cast also takes literals with a type suffix such as `1d` and hexadecimal ones such
    as `0x1p3`; those are not numbers here, while `inf` (which ends the same way) is.
    """
    text = stripped(text)
    value = F.nanvl(text.try_cast("double"), F.lit(None).cast("double"))
    last = F.lower(F.right(text, F.lit(1)))
    suffixed = last.isin("d", "f") & (F.abs(value) != float("inf"))
    hexadecimal = F.contains(F.lower(text), F.lit("x"))
    return F.when(~suffixed & ~hexadecimal, value)


def as_double(df: DataFrame, name: str) -> Column:
    """Any column as double with NaN turned into null."""
    kind = column_type(df, name)
    if isinstance(kind, T.StringType):
        return parse_number(F.col(name))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))
    return F.col(name).cast("double")


def normalized_text(column: Column) -> Column:
    """Trimmed lower-case text; blank becomes null."""
    return F.nullif(F.lower(stripped(column.cast("string"))), F.lit(""))


def split_list(text: Column, pattern: str = ";") -> Column:
    """Entries of a separated list, trimmed, blanks dropped."""
    return F.filter(F.transform(F.split(text, pattern), stripped), lambda item: item != "")


def join_list(items: Column, limit: int | None = None) -> Column:
    return F.array_join(items if limit is None else F.slice(items, 1, limit), LIST_SEPARATOR)


def drivers_in_summary(summary: Column) -> Column:
    """Driver names read back from a summary sentence; the whole text if it names none."""
    text = stripped(summary)
    position = F.instr(F.lower(text), SUMMARY_MARKER)
    named = F.rtrim(
        F.substring(F.lower(text), position + len(SUMMARY_MARKER), F.length(text)), F.lit(".")
    )
    named = F.replace(F.replace(named, F.lit(", and "), F.lit(", ")), F.lit(" and "), F.lit(", "))
    return F.when(position > 0, split_list(named, ",")).otherwise(
        F.filter(F.array(text), lambda item: item != "")
    )


def title_case(text: Column) -> Column:
    return F.initcap(text)


def array_rounded(value: Column, decimals: int) -> Column:
    """Round as array libraries do: scale, round halves to even, unscale. NaN becomes null, infinity stays."""
    scale = float(10**decimals)
    return F.rint(F.nanvl(value.cast("double"), F.lit(None)) * scale) / scale


def number_text(value: Column, decimals: int) -> Column:
    """The stored binary value with exactly `decimals` digits after the point, exact ties to even."""
    return F.call_function("format_number", value, F.lit("0." + "0" * decimals))


def rounded(value: Column, decimals: int) -> Column:
    """Round the stored binary value exactly, ties to even: one in 32 is 0.0312.

    Scaling first would move near-ties such as 0.37875 across. It goes through text, which fits the few rows of a
    summary; `array_rounded` is for columns of a large table. NaN becomes null, infinity stays.
    """
    value = F.nanvl(value.cast("double"), F.lit(None).cast("double"))
    endless = F.abs(value) == float("inf")
    return F.when(endless, value).otherwise(number_text(value, decimals).try_cast("double"))


def percent_value(fraction: Column) -> Column:
    return rounded(fraction * 100, 2)


def fixed_decimals(value: Column, decimals: int) -> Column:
    """Number text with exactly `decimals` digits of the stored binary value, exact ties away from zero.

    A double lies exactly between two such numbers only if it is an odd multiple of 2^-(decimals + 1).
    """
    halves = F.abs(value) * float(2 ** (decimals + 1))
    tie = (halves < float(1 << 53)) & (halves % 2 == 1)
    return F.when(tie, value.cast(f"decimal(38,{decimals})").cast("string")).otherwise(
        number_text(value, decimals)
    )


def percent_text(fraction: Column) -> Column:
    return F.concat(number_text(fraction * 100, 2), F.lit("%"))


def general_number(value: Column) -> Column:
    """Shortest text of up to six significant digits, as C's `%g` prints it.

    Sensor readings nearly always fit in seven characters, and then the plain cast without
    a trailing `.0` is the answer; the slow formatter is only reached by longer ones.
    """
    plain = value.cast("string")
    formatted = F.format_string("%.6g", value)
    for pattern, kept in ((r"(\.\d*?)0+(e|$)", "$1$2"), (r"\.(e|$)", "$1"), ("Infinity", "inf")):
        formatted = F.regexp_replace(formatted, pattern, kept)
    return (
        F.when(value.isNull(), "nan")
        .when(
            (F.length(plain) <= 7) & ~F.contains(plain, F.lit("E")),
            F.regexp_replace(plain, r"\.0$", ""),
        )
        .otherwise(formatted)
    )
