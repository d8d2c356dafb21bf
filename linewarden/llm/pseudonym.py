"""Format-preserving pseudonyms of personal data by a keyed Feistel permutation.

A value that passes its kind's validation is permuted among all values of its format: a card number becomes another
card number with a right check digit, a date another date in the same notation. Equal values get equal pseudonyms in
every document, and whoever holds the key can undo it. What only looks like a value (a 16-digit order number) stays.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from datetime import date
from hashlib import blake2b
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linewarden.llm.common import slices

ROUNDS = 8
FIRST_DAY, LAST_DAY = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()

# Patterns of values, by kind; the first that matches at a place counts.
PATTERNS = {
    "email": r"(?<![\w.+%-])[A-Za-z0-9][\w.+%-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}[A-Z0-9]{11,30}(?!\w)",
    "date": r"(?<![\w./-])(?:\d{4}-\d\d-\d\d|\d{4}/\d\d/\d\d|\d\d\.\d\d\.\d{4}|\d\d/\d\d/\d{4}|\d\d-\d\d-\d{4})(?![\w/-])(?!\.\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": r"(?<!\w)\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})(?:[ .-]?\d{2,4}){1,4}(?!\w)",
    "ip": r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w)(?!\.\d)",
    "card": r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?!\w)(?!-\d)",
    "secret": r"(?<!\w)(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})(?!\w)",
}
VALUE = re.compile("|".join(f"(?P<{kind}>{pattern})" for kind, pattern in PATTERNS.items()), re.ASCII)
ALONE = {kind: re.compile(pattern, re.ASCII) for kind, pattern in PATTERNS.items()}
#: The first word of a value, at least one character.
WORD = re.compile(r"\w+|\W", re.ASCII)
WORD_CHARACTER = re.compile(r"\w", re.ASCII)
#: The longest run of digits that can be a card number, and the least number of them.
RUN, LEAST_DIGITS = re.compile(r"\d(?:[ -]?\d){0,18}", re.ASCII), 13
LIKELY = re.compile("[0-9@]")
#: Alphabets whose characters stand for each other.
ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
HEX = ("0123456789abcdef", "0123456789ABCDEF")


class Permutation:
    """A keyed permutation of the whole numbers below any size, by an alternating Feistel network."""

    def __init__(self, key: bytes, undo: bool = False):
        self.key, self.undo = blake2b(key, digest_size=32).digest(), undo

    def _share(self, kind: str, step: int, half: int, size: int) -> int:
        text = f"{kind}|{step}|{half}".encode()
        return int.from_bytes(blake2b(text, key=self.key, digest_size=48).digest()) % size

    def _once(self, kind: str, value: int, left_size: int, right_size: int) -> int:
        left, right = divmod(value, right_size)
        sign = -1 if self.undo else 1
        for step in reversed(range(ROUNDS)) if self.undo else range(ROUNDS):
            if step % 2:
                right = (right + sign * self._share(kind, step, left, right_size)) % right_size
            else:
                left = (left + sign * self._share(kind, step, right, left_size)) % left_size
        return left * right_size + right

    def __call__(self, kind: str, value: int, size: int) -> int:
        """Where a number below `size` goes; steps that leave the range go on until they are back in it."""
        if size < 2:
            return value
        right = isqrt(size - 1) + 1
        left = -(-size // right)
        kind = f"{kind}|{size}"
        value = self._once(kind, value, left, right)
        while value >= size:
            value = self._once(kind, value, left, right)
        return value

    def characters(self, kind: str, text: str, alphabets: tuple[str, ...] = ALPHABETS) -> str:
        """Permutes all strings of the same shape: characters of an alphabet vary within it, others stay."""
        own = [next((a for a in alphabets if c in a), "") for c in text]
        value = size = 0
        size = 1
        for c, alphabet in zip(text, own, strict=True):
            if alphabet:
                value, size = value * len(alphabet) + alphabet.index(c), size * len(alphabet)
        shape = "".join("x" if not a else str(alphabets.index(a)) for a in own)
        value = self(f"{kind}|{shape}", value, size)
        out = []
        for c, alphabet in zip(reversed(text), reversed(own), strict=True):
            if alphabet:
                value, at = divmod(value, len(alphabet))
                c = alphabet[at]
            out.append(c)
        return "".join(reversed(out))


def refilled(text: str, digits: str) -> str:
    """The text with its digits replaced in order."""
    fresh = iter(digits)
    return re.sub(r"\d", lambda _: next(fresh), text)


def check_digit(digits: str) -> str:
    """The digit that completes a number so that its Luhn sum is a multiple of ten."""
    total = 0
    for place, c in enumerate(reversed(digits)):
        doubled = int(c) * (2 - place % 2)
        total += doubled - 9 * (doubled > 9)
    return str(-total % 10)


def card(text: str, permute: Permutation) -> str | None:
    digits = re.sub(r"\D", "", text)
    if check_digit(digits[:-1]) != digits[-1]:
        return None
    body = permute.characters("card", digits[:-1])
    return refilled(text, body + check_digit(body))


def remainder(country: str, check: str, account: str) -> int:
    return int("".join(str(int(c, 36)) for c in account + country + check)) % 97


def iban(text: str, permute: Permutation) -> str | None:
    country, check, account = text[:2], text[2:4], text[4:]
    if remainder(country, check, account) != 1:
        return None
    account = permute.characters(f"iban|{country}", account)
    return f"{country}{98 - remainder(country, '00', account):02d}{account}"


def day(text: str, permute: Permutation) -> str | None:
    sign = re.search(r"\D", text)[0]
    parts = text.split(sign)
    day_first = sign != "/" or int(parts[0]) > 12
    order = (0, 1, 2) if len(parts[0]) == 4 else (2, 1, 0) if day_first else (2, 0, 1)
    try:
        number = date(*(int(parts[i]) for i in order)).toordinal()
    except ValueError:
        return None
    if not FIRST_DAY <= number <= LAST_DAY:
        return None
    while True:
        number = FIRST_DAY + permute("date", number - FIRST_DAY, LAST_DAY - FIRST_DAY + 1)
        fresh = date.fromordinal(number)
        # a slash date that is told by its day stays so, or the way back would read another one
        if sign != "/" or order != (2, 1, 0) or fresh.day > 12:
            break
    for i, value in zip(order, (f"{fresh.year:04d}", f"{fresh.month:02d}", f"{fresh.day:02d}"), strict=True):
        parts[i] = value
    return sign.join(parts)


def social(text: str, permute: Permutation) -> str | None:
    """An area from 001 to 899 but 666, a group from 01 and a serial number from 0001."""
    area, group, serial = map(int, text.split("-"))
    if area in (0, 666) or area > 899 or group == 0 or serial == 0:
        return None
    place = area - 1 - (area > 666)
    value = permute("ssn", (place * 99 + group - 1) * 9999 + serial - 1, 898 * 99 * 9999)
    rest, serial = divmod(value, 9999)
    place, group = divmod(rest, 99)
    return f"{place + 1 + (place >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"


def phone(text: str, permute: Permutation) -> str | None:
    """The country code, up to the first separator, stays."""
    code = re.match(r"\+\d{1,3}", text)[0]
    if not 8 <= len(re.sub(r"\D", "", text)) <= 15:
        return None
    rest = text[len(code) :]
    digits = re.sub(r"\D", "", rest)
    return code + refilled(rest, permute.characters(f"phone|{code}", digits))


def address(text: str, permute: Permutation) -> str | None:
    """Four numbers up to 255, written without leading zeros."""
    parts = text.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    value = permute("ip", int.from_bytes(bytes(map(int, parts))), 1 << 32)
    return ".".join(map(str, value.to_bytes(4)))


def email(text: str, permute: Permutation) -> str | None:
    """The name varies; the host stays."""
    name, _, host = text.partition("@")
    return f"{permute.characters('email|' + host.lower(), name)}@{host}"


def secret(text: str, permute: Permutation) -> str | None:
    if text.isdigit() or text.isalpha():
        return None
    return permute.characters("secret", text, HEX if text == text.lower() else HEX[::-1])


KINDS: dict[str, Callable[[str, Permutation], str | None]] = {
    "email": email, "iban": iban, "date": day, "ssn": social, "phone": phone, "ip": address, "card": card,
    "secret": secret,
}


def is_card(text: str) -> bool:
    digits = re.sub(r"\D", "", text)
    return check_digit(digits[:-1]) == digits[-1]


def card_at(text: str, start: int, tried: list[tuple[int, int]], permute: Permutation) -> tuple[int, str] | None:
    """(end, pseudonym) of the card number of 13 to 19 digits that starts here, the longest first.

    What fails is added to `tried`. The pseudonym is one with which all that was tried before fails again, so that the
    way back finds the same place.
    """
    run = RUN.match(text, start).group()
    ends = [start + m.end() for m in re.finditer(r"\d+", run)]
    for end in reversed(ends):
        digits = re.sub(r"\D", "", text[start:end])
        if len(digits) < LEAST_DIGITS or WORD_CHARACTER.match(text, end):
            continue
        if is_card(digits):
            fresh = card(text[start:end], permute)
            near = [(a, b) for a, b in tried if b > start]
            while any(is_card(text[a:start] + fresh[max(0, a - start) : b - start] + text[end:b]) for a, b in near):
                fresh = card(fresh, permute)
            return end, fresh
        tried.append((start, end))
    return None


def found_at(text: str, match: re.Match, tried: list[tuple[int, int]], permute: Permutation) -> tuple[str, int, str] | None:
    """(kind, end, pseudonym) of the first kind whose pattern and checks hold at a match's start."""
    for kind, pattern in ALONE.items():
        own = pattern.match(text, match.start())
        if own is None:
            continue
        if kind == "card":
            if inner := card_at(text, own.start(), tried, permute):
                return kind, *inner
        elif (fresh := KINDS[kind](own.group(), permute)) is not None:
            return kind, own.end(), fresh
    return None


def replaced(text: str, permute: Permutation) -> tuple[str, list[dict]]:
    """The text with pseudonyms, and (kind, start, length) of each in the new text.

    Where no kind's checks hold the search goes on behind the first word of what was refused.
    """
    if not LIKELY.search(text):
        return text, []
    parts, spans, at, size, look = [], [], 0, 0, 0
    tried: list[tuple[int, int]] = []
    while match := VALUE.search(text, look):
        start = match.start()
        tried = [t for t in tried if t[1] > start]
        found = found_at(text, match, tried, permute)
        if found is None:
            look = WORD.match(text, start).end()
            continue
        kind, end, fresh = found
        parts += [text[at:start], fresh]
        size += start - at
        spans.append({"kind": kind, "start": size, "length": len(fresh)})
        size += len(fresh)
        at = look = end
        tried = []
    return "".join([*parts, text[at:]]), spans


REPLACED = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    ]))),
])
SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("length", pa.int64())]))


def pseudonymised(text: Column, key: bytes, undo: bool = False) -> Column:
    """struct(text, spans) of a column of texts; with `undo` the pseudonyms of the same key turn back.

    Names of the host in e-mail addresses and country codes stay. A null text stays null, without spans. A value
    that its kind's checks refuse stays as it is. Undoing is exact where no pseudonym touches other digits.
    """

    @F.arrow_udf(REPLACED)
    def change(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        permute = Permutation(key, undo)
        for batch in slices(batches):
            found = [(None, []) if t is None else replaced(t, permute) for t in batch.to_pylist()]
            texts, spans = ([f[i] for f in found] for i in (0, 1))
            yield pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(spans, SPANS)], ["text", "spans"])

    return change(text.cast("string"))
