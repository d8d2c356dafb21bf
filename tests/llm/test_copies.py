"""Near copies against brute force over all pairs."""

from itertools import combinations
from random import Random

import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from linewarden.llm import copies


def plain_shingles(text):
    words = (text or "").encode().lower().split()
    width = min(5, len(words))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()


def plain_roots(texts):
    """Smallest id linked over pairs with a Jaccard similarity of at least 0.8."""
    sets, root = {i: plain_shingles(t) for i, t in texts.items()}, {i: i for i in texts}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(sorted(texts), 2):
        both = len(sets[i] & sets[j])
        if both and 5 * both >= 4 * len(sets[i] | sets[j]):
            a, b = sorted((top(i), top(j)))
            root[b] = a
    return {i: top(i) for i in texts}


def test_edited_copies_leave_the_pipeline(spark):
    """The documents that the pipeline ends with hold no pair of near copies."""
    folder = "/root/testdata/sf0.001"
    texts, docs = {}, spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder).checkpoint()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert plain_roots(texts) == {i: i for i in texts}


def test_near_copies_of_a_table(spark):
    table = pq.read_table("/root/testdata/sf0.01/documents.parquet").slice(0, 600)
    texts = dict(zip(table.column("doc_id").to_pylist(), table.column("text").to_pylist(), strict=True))
    docs = spark.createDataFrame([*texts.items(), (None, "x")], "doc_id long, text string")
    words = [i for i in texts if plain_shingles(texts[i])]
    roots = plain_roots({i: texts[i] for i in words})
    left = {r.doc_id for r in copies.kept_ids(docs, docs.select("doc_id")).collect()}
    assert left == set(roots.values()) | (set(texts) - set(words))
    assert len(set(roots.values())) < len(words)


def edited(random, copies_, edits):
    """A hundred unlike texts, edited copies of one text, and copies of copies in a chain."""
    base = [f"w{random.randrange(5000)}" for _ in range(300)]
    texts = {i: " ".join(f"w{random.randrange(5000)}" for _ in range(80)) for i in range(100)}
    for i in range(100, 100 + copies_):
        own = list(base)
        for at in random.sample(range(300), edits):
            own[at] = f"edit{random.randrange(9**9)}"
        texts[i] = " ".join(own)
    chain = [f"c{k}" for k in range(200)]
    for i in range(100 + copies_, 120 + copies_):
        texts[i] = " ".join(chain)
        chain[(i - 100 - copies_) * 10] = f"new{i}"
        chain[(i - 100 - copies_) * 10 + 5] = f"other{i}"
    return texts


def left_of(spark, texts):
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    return {r.doc_id for r in copies.kept_ids(docs, docs.select("doc_id")).collect()}


def test_hot_group_of_near_copies(spark):
    texts = edited(Random(7), 300, 2)
    roots = plain_roots(texts)
    assert left_of(spark, texts) == set(roots.values()) and len(set(roots.values())) == 102


def test_copies_that_lie_near_the_threshold(spark):
    """Four edits a copy: most pairs lie under 0.8, so chains through a few others link them, beyond SMALL members."""
    texts = edited(Random(8), 300, 4)
    roots = plain_roots(texts)
    gone, left = {i for i, r in roots.items() if i != r}, left_of(spark, texts)
    assert set(roots.values()) <= left
    assert len(gone - left) >= 0.9 * len(gone)


@pytest.mark.parametrize("shingles", [copies.BLOCK_SHINGLES, 3_000])
def test_large_groups_are_exact(spark, monkeypatch, shingles):
    """What no leader links is compared in full, also where a group takes many blocks."""
    monkeypatch.setattr(copies, "BLOCK_SHINGLES", shingles)
    texts = edited(Random(8), 300, 4)
    assert left_of(spark, texts) == set(plain_roots(texts).values())


def test_small_groups_are_exact(spark, monkeypatch):
    """Where every group is small, all that brute force links is linked."""
    monkeypatch.setattr(copies, "SMALL", 400)
    texts = edited(Random(9), 120, 4)
    assert left_of(spark, texts) == set(plain_roots(texts).values())


def test_rows_of_one_id_go_or_stay_together(spark):
    """An id that stays keeps all its rows, whatever their texts."""
    some = " ".join(f"w{k}" for k in range(40))
    rows = [(1, some), (1, "quite another text of its own"), (2, some), (3, some + " end"), (None, some), (4, None), (5, "")]
    found = copies.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in found) == sorted((i or 0, t or "") for i, t in rows if i not in (2, 3, 5))
