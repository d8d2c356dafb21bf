"""Fill-in-middle against a plain version, and the boundary set against sorted lists."""

import hashlib
import re
from random import Random

import duckdb
import numpy as np
import pytest

from linewarden.llm import middle
from linewarden.llm.oracle import LLM_ORACLE
from linewarden.llm.queries import LLM_QUERIES

DATA = "/root/testdata/sf0.001"
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain(doc_id, text, units=UNIT.findall):
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    parts = units(text)
    low, high = sorted(x % (len(parts) + 1) for x in h[:2])
    prefix, mid, suffix = ("".join(p) for p in (parts[:low], parts[low:high], parts[high:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(parts), "plain", text, None, None
    if h[3] % 100 < 80:
        return len(parts), "spm", f"<S>{suffix}<P>{prefix}<M>{mid}", len(prefix), len(mid)
    return len(parts), "psm", f"<P>{prefix}<S>{suffix}<M>{mid}", len(prefix), len(mid)


@pytest.mark.parametrize("density", [0.001, 0.05, 0.3, 0.9, 1.0])
def test_select(density):
    draw = np.random.default_rng(int(1000 * density))
    members = np.flatnonzero(draw.random(300_000) < density)
    members = members[(members < 70_000) | (members > 140_000)]
    held = middle.BoundarySet.of(members)
    assert len(held) == len(members)
    for k in {0, len(members) - 1, *draw.integers(0, len(members), 300).tolist()}:
        assert held.select(k) == members[k] and held.offset(k + 1) == members[k]
    assert held.offset(0) == 0 and len(middle.BoundarySet.of(np.zeros(0, np.int64))) == 0


def test_smallest_container():
    kinds = {
        middle.ArrayContainer: np.arange(0, 8000, 2), middle.BitmapContainer: np.arange(0, 65_536, 2), middle.RunContainer: np.arange(60_000),
    }
    for kind, members in kinds.items():
        assert isinstance(middle.container(members), kind)
    assert isinstance(middle.container(np.arange(4096) * 3), middle.ArrayContainer)
    assert isinstance(middle.container(np.arange(4097) * 3), middle.BitmapContainer)


def odd_texts():
    draw = Random(5)
    some = ["", " ", "a", " a", "a ", "\t\x0b a\r\n", " x y", "🎉 日本 é", "x<P>y", "x <M> y", "a<S>", "<", "<P", "x < P> >", "ab " * 70_000]
    return some + ["".join(draw.choice("ab \n\té🎉<PSM>") for _ in range(draw.randrange(40))) for _ in range(400)]


@pytest.mark.parametrize("units", ["words", "characters"])
def test_odd_texts(spark, units):
    rows = [(i if i != 3 else None, t) for i, t in enumerate(odd_texts())] + [(5_000, None), (7, " a")]
    docs = spark.createDataFrame([(i, t, "f", 1) for i, t in rows], "doc_id long, text string, form string, found int")
    found = middle.rearranged(docs, units=units)
    found = found.withColumn("back", middle.restored(found.output, found.form)).collect()
    split = UNIT.findall if units == "words" else list
    assert sorted(map(str, ((r.doc_id, r.n, r.form, r.output, r.prefix_chars, r.middle_chars) for r in found))) == sorted(
        str((i, *plain(i, t, split))) for i, t in rows
    )
    assert sorted(r.back for r in found) == sorted(t or "" for _, t in rows)
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_query_equals_its_sql(spark):
    database = duckdb.connect()
    database.sql(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    told = database.sql(LLM_ORACLE["op12_boundaries"])
    df = LLM_QUERIES["op12_boundaries"](spark, DATA)
    assert df.columns == told.columns
    assert sorted(map(str, map(tuple, df.collect()))) == sorted(map(str, told.fetchall()))
