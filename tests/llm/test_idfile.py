"""Id files against the tokenizers library and a plain coder."""

import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from linewarden.llm import idfile
from linewarden.llm.common import new_folder
from linewarden.llm.queries import LLM_QUERIES

DATA = "/root/testdata/sf0.001"
ODD = [
    "", " ", "a", "Grüße aus KÖLN, it's I'LL  don't go on", "<|endoftext|>x <|startoftext|> y<|endoftext|>",
    "é ́x ȩ́ 각 ᄀ ᅡ", "日本語🎉 12345 ½²", "tab\there\x0b\x0c\r\nand\x1c\x1d\x85 end",
    "x" * 5_000, "'s 't ' s​﻿", "İstanbul ΣΑΣ ß",
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(idfile.VOCABULARY)
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, idfile.END_ID]


def in_order(texts, library):
    """(doc_id, start, ids) of every text, in ascending order of id."""
    at = 0
    for doc_id, text in sorted(texts.items()):
        ids = library(text)
        yield doc_id, at, ids
        at += len(ids)


@pytest.mark.parametrize("top", [1, 255, 256, 65_535, 65_536, 1 << 24, (1 << 32) - 1])
def test_coder(top):
    draw = np.random.default_rng(top)
    for n in (0, 1, 3, 4, 5, 1_000):
        values = (draw.integers(0, top, n, np.uint64, endpoint=True) >> draw.integers(0, 20, n).astype(np.uint64)).astype(np.uint32)
        control, data = idfile.pack(values)
        sizes = [max(1, -(-int(v).bit_length() // 8)) for v in values]
        plain = b"".join(int(v).to_bytes(s, "little") for v, s in zip(values, sizes))
        assert data == plain and len(control) == -(-n // 4)
        assert [control[i // 4] >> 2 * (i % 4) & 3 for i in range(n)] == [s - 1 for s in sizes]
        assert idfile.unpack(control, data, n).tolist() == values.tolist()


def test_query_equals_the_library(spark, library):
    table = pq.read_table(f"{DATA}/documents.parquet")
    texts = dict(zip(table.column("doc_id").to_pylist(), table.column("text").to_pylist()))
    found = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in LLM_QUERIES["op11_idfile"](spark, DATA).collect()}
    digest = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    assert found == {i: (at, len(ids), digest(ids)) for i, at, ids in in_order(texts, library)}


def test_odd_texts_and_many_small_blocks(spark, library, monkeypatch):
    monkeypatch.setattr(idfile, "BLOCK_IDS", 40)
    texts = {7 * i - 20: t for i, t in enumerate(ODD)} | {1_000: None}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    folder = new_folder(spark, "test-ids")
    idfile.write(docs.withColumn("row", F.lit("x")).withColumn("ids", F.lit(1)), folder)
    found = {r.doc_id: (r.start, r.ids) for r in idfile.read(spark, folder).collect()}
    assert found == {i: (at, ids) for i, at, ids in in_order(texts, library)}


def test_ranks_follow_frequency(spark):
    docs = spark.createDataFrame([(1, "b b b a"), (2, "b a c")], "doc_id long, text string")
    folder = new_folder(spark, "test-ids")
    idfile.write(docs, folder)
    ranks = {r.id: r["rank"] for r in spark.read.parquet(f"{folder}/ranks").collect()}
    ids = [i for r in idfile.read(spark, folder).collect() for i in r.ids]
    counts = {i: ids.count(i) for i in set(ids)}
    assert sorted(counts, key=ranks.get) == sorted(counts, key=lambda i: (-counts[i], i))
    assert sorted(ranks.values()) == list(range(len(ranks)))


def test_repeated_and_missing_ids_follow_each_other(spark):
    docs = spark.createDataFrame([(2, "one two"), (2, "one two"), (None, "three"), (None, None), (1, "")], "doc_id long, text string")
    folder = new_folder(spark, "test-ids")
    idfile.write(docs, folder)
    rows = sorted((r.start, r.n_tokens, r.doc_id) for r in idfile.digests(spark, folder).collect())
    assert [r[2] for r in rows] == [None, None, 1, 2, 2]
    assert [r[0] for r in rows] == np.cumsum([0, *(r[1] for r in rows)]).tolist()[:-1]


def test_words_that_are_kept_and_forgotten(library, monkeypatch):
    monkeypatch.setattr(idfile, "KEPT_WORDS", 6)
    encoder = idfile.WordEncoder(idfile.VOCABULARY)
    for turn in range(30):
        texts = [f"the cat and The dog{turn} o'clock!'s {turn * 7919} it's", ODD[turn % len(ODD)], "the the cat"]
        found = [ids.tolist() for ids in encoder([t.encode() for t in texts], idfile.END_ID)]
        assert found == [library(t) for t in texts]
    assert len(encoder) < 40


def test_parts_of_ascii_words(library):
    draw = np.random.default_rng(1)
    signs = [*map(chr, range(33, 127)), *"''<|sStTmMdD", "'ll", "'RE", "<|endoftext|>"]
    words = ["".join(draw.choice(signs, draw.integers(1, 12))) for _ in range(5_000)]
    encoder = idfile.WordEncoder(idfile.VOCABULARY)
    found = [ids.tolist() for ids in encoder([w.encode() for w in words], idfile.END_ID)]
    assert found == [library(w) for w in words]
