"""Phrase mining against a plain count of every phrase."""

import re
from collections import Counter
from random import Random

import duckdb
import pytest

from linewarden.llm import phrases
from linewarden.llm.oracle import LLM_ORACLE
from linewarden.llm.queries import LLM_QUERIES

DATA = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, top=phrases.TOP):
    counts, sizes = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            if words:
                sizes[lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + size])] += 1
    out = []
    for lang, found in counts.items():
        often = {p: a for p, a in found.items() if len(p) > 1 and a >= 30}
        kept = []
        for p, a in often.items():
            within = [b for q, b in often.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if any(100 * b >= 80 * a for b in within):
                continue
            cuts = [(2_000_000 * a // (found[p[:k]] + found[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, sizes[lang], -score))
    return sorted(out)


def texts():
    draw = Random(3)
    names = ["new", "york", "city", "the", "a", "x y", "é", "É", "of", "0"]
    rows = []
    for i in range(4_000):
        words = [draw.choice(names) for _ in range(draw.randrange(30))]
        if i % 3 == 0:
            words[2:2] = ["New", "York", "City", "Hall"]
        rows.append(("".join(w + draw.choice([" ", "  ", "\t", " ", ". ", "\n", ", "]) for w in words), draw.choice(["en", "de-long-name-1", "de-long-name-2", None])))
    return rows + [(None, "en"), ("", None), (" \t.,", "fr"), ("one word " * 20_000, "es")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(t, l, 1, "x", "y") for t, l in texts()]
    return spark.createDataFrame(rows, "text string, lang string, a long, w1 string, phrase string").repartition(7).cache()


def mined(docs, **more):
    return sorted(tuple(r) for r in phrases.collocations(docs, **more).collect())


def test_plain_count(docs):
    found = mined(docs)
    assert len(found) > 100 and found == plain(texts())
    assert mined(docs, top=5) == plain(texts(), top=5)


@pytest.mark.parametrize("bits", [3, 12])
def test_crowded_slots_change_nothing(docs, bits):
    """Few slots hold many phrases each: less is padded, the result is the same."""
    assert mined(docs, slot_bits=bits) == plain(texts())


def test_empty_table(docs):
    assert mined(docs.where("false")) == []
    assert mined(docs.where("text IS NULL")) == []


def test_products_beyond_64_bits(spark):
    rows = [("en", 0, "", 9 * 10**18), ("en", 1, "a", 3 * 10**18), ("en", 1, "b", 2 * 10**18 + 7), ("en", 2, "a b", 2 * 10**18)]
    found = phrases.scored(spark.createDataFrame(rows, "lang string, size int, phrase string, a long")).collect()
    assert [(r.l, r.r, r.score) for r in found] == [(3 * 10**18, 2 * 10**18 + 7, 2_000_000 * 2 * 10**18 // (5 * 10**18 + 7))]


def test_query_equals_its_sql(spark):
    database = duckdb.connect()
    database.sql(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    told = database.sql(LLM_ORACLE["op13_rollup"])
    df = LLM_QUERIES["op13_rollup"](spark, DATA)
    assert df.columns == told.columns
    assert sorted(map(tuple, df.collect())) == sorted(told.fetchall())


def test_few_windows_are_spelled_at_a_time(monkeypatch):
    """No batch has more than SPELLED windows, and their rows are the same in any case."""
    texts = [f"alpha beta gamma word{i} . alpha beta".encode() for i in range(300)]
    grams = phrases.Reader()(texts, ["en"] * 300)
    reach, codes = phrases.Filter(16, {}).reach(grams), phrases.WordHasher().codes
    whole = list(phrases.counted(grams, ["en"] * 300, reach, codes))
    monkeypatch.setattr(phrases, "SPELLED", 7)
    few = list(phrases.counted(grams, ["en"] * 300, reach, codes))
    assert len(whole) == 1 and len(few) > 1 and max(map(len, few)) == 7
    assert [row for batch in few for row in batch.to_pylist()] == whole[0].to_pylist()
