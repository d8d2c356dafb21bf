"""Long and short benchmark items planted inside longer texts."""

from random import Random

import pyarrow.parquet as pq
import pytest

from linewarden.llm import latent

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def found(spark):
    """All plants by (kind, size), each with whether it is found; searched in one pass."""
    random = Random(13)
    items = [t.split() for t in pq.read_table(f"{DATA}/benchmark.parquet").column("text").to_pylist()]
    around = [t.split() for t in pq.read_table(f"{DATA}/documents.parquet").column("text").to_pylist() if len(t.split()) > 150]
    bench, rows, planted = [], [], {}

    def plant(kind, item, body):
        base = random.choice(around)
        at = random.randrange(len(base))
        planted[len(rows), item] = kind
        rows.append((len(rows), " ".join([*base[:at], *body, *base[at:]])))

    for k in range(40):
        words = [w for t in random.sample(items, 5) for w in t]
        bench.append((k, " ".join(words)))
        cut = len(words) // 10
        plant("middle", k, words[cut : len(words) - cut])
        other = random.choice(around)
        plant("ends", k, [*other[: cut + 2], *words[cut + 2 : len(words) - cut], *other[-cut:]])
    for n in (3, 5, 6, 8, 10, 12, 14, 20):
        for _ in range(25):
            bench.append((len(bench), " ".join(random.choice(items)[:n])))
            plant(f"short {n}", bench[-1][0], bench[-1][1].split())
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    hits = {(r.doc_id, r.item_id) for r in latent.contaminated(docs, spark.createDataFrame(bench, "item_id long, text string")).collect()}
    result = {}
    for pair, kind in planted.items():
        result.setdefault(kind, []).append(pair in hits)
    return result


@pytest.mark.parametrize("kind", ["middle", "ends"])
def test_the_middle_of_a_long_item(found, kind):
    assert all(found[kind])


@pytest.mark.parametrize("size", [3, 5, 6, 8, 10, 12, 14, 20])
def test_short_items_in_long_texts(found, size):
    assert all(found[f"short {size}"])


def test_the_basis_is_fitted_on_every_item(spark, monkeypatch):
    """All windows of all items go into the SVD, however many items there are."""
    monkeypatch.setattr(latent, "SAMPLE_ITEMS", 5)
    items = spark.createDataFrame([(i, " ".join(f"w{i}x{k}" for k in range(20))) for i in range(60)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "some words of a text")], "doc_id long, text string")
    seen, whole = [], latent._back_and_forth

    def counted(passages, *rest):
        seen.append(passages.count())
        return whole(passages, *rest)

    monkeypatch.setattr(latent, "_back_and_forth", counted)
    latent.latent_terms(docs, items)
    assert set(seen) == {60 * 3}
