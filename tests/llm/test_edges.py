"""Nulls, empty and very long texts, repeats, empty tables and clashing column names, for every operator and stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from linewarden.llm import (
    automaton, families, ftrl, idfile, latent, ledger, middle, phrases, pieces, pseudonym, simhash, spread, toxicity,
)
from linewarden.llm.common import in_fold, new_folder

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "score double, fingerprint string, label string, line string, keeper long, found string, block long, row string"
)
LONG = "word " * 60_000 + "x" * 300_000


def rows():
    own = [
        (1, "one two three four five six seven", "en", "a", 33),
        (2, None, "en", "a", None),
        (3, "", None, "b", 0),
        (4, " \t\n \x0b", "de", None, 5),
        (5, LONG, "en", "c", len(LONG)),
        (6, "Über die Straße 日本語 🎉\nzweite Zeile", "de", "d", 30),
        (7, "12345 !!! ###", "en", "e", 13),
        (8, "one two three four five six seven", "en", "b", 33),
        (8, "one two three four five six seven", "en", "b", 33),
        (None, "no id here", "en", "a", 10),
        (None, None, None, None, None),
    ]
    return [(*r, None, None, "x", "y", 1, "z", 0, "w") for r in own]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(rows(), SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    marks = [(1, 1, 0), (6, 0, 1), (7, 0, 1), (8, 1, 0), (8, 0, 0), (None, 1, 1), (5, None, None), (99, 1, 1), (3, 7, -1)]
    return spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def items(spark):
    texts = [(1, "one two three four five six seven"), (2, None), (None, "x"), (3, ""), (4, "!!")]
    return spark.createDataFrame(texts, "item_id long, text string")


def languages(docs):
    return families.add_language(docs, families.fit(docs)).select("doc_id", "found.*")


def id_files(docs):
    folder = new_folder(docs.sparkSession, "test-ids")
    idfile.write(docs, folder)
    return idfile.digests(docs.sparkSession, folder)


PER_ROW = {
    "pseudonym": lambda d, l: d.select("doc_id", pseudonym.pseudonymised(F.col("text"), b"k").alias("r")).select("doc_id", "r.*"),
    "ledger": lambda d, l: ledger.ledger(d),
    "simhash": lambda d, l: simhash.near_duplicates(d),
    "ftrl": lambda d, l: ftrl.add_score(d, ftrl.fit(d, l)),
    "automaton": lambda d, l: automaton.scored(d, automaton.trained_on(F.col("doc_id"))),
    "families": lambda d, l: languages(d),
    "pieces": lambda d, l: d.select("doc_id", pieces.encoded(d.sparkSession, F.col("text")).alias("r")).select("doc_id", "r.*"),
    "spread": lambda d, l: spread.without_boilerplate(d),
    "toxicity": lambda d, l: toxicity.fit(d, l).add_score(d, "toxic_score"),
    "idfile": lambda d, l: id_files(d),
    "middle": lambda d, l: middle.rearranged(d),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_result_for_each_row(odd, labels, name):
    """Every row gets its result: repeated rows each, null ids and null texts too."""
    found = [r.doc_id for r in PER_ROW[name](odd, labels).collect()]
    assert sorted(found, key=str) == sorted((r[0] for r in rows()), key=str)


@pytest.mark.parametrize("name", PER_ROW)
def test_empty_tables(odd, labels, name):
    nothing = odd.where("false")
    assert PER_ROW[name](nothing, labels.where("false")).collect() == []
    if name in ("ftrl", "toxicity"):
        scores = {r["score" if name == "ftrl" else "toxic_score"] for r in PER_ROW[name](odd, labels.where("false")).collect()}
        assert scores == ({0.5} if name == "ftrl" else {0.0})


def test_defined_results(odd, labels):
    marks = {(r.doc_id, r.n_words, r.failures & 1) for r in ledger.ledger(odd).where("doc_id in (2, 3, 4)").collect()}
    assert marks == {(2, 0, 1), (3, 0, 1), (4, 0, 1)}
    near = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(odd).collect() if r.doc_id}
    assert {near[i] for i in (2, 3, 4)} == {("0" * 16, 2)} and near[8] == near[1] and near[1][1] == 1
    told = {r.doc_id: r.lang_pred for r in languages(odd).collect() if r.doc_id}
    assert {told[i] for i in (2, 3, 4, 7)} == {"und"} and told[5] in ("en", "de")
    ids = odd.select("doc_id", pieces.encoded(odd.sparkSession, F.col("text")).alias("r")).select("doc_id", "r.*").collect()
    assert all(r.restored for r in ids) and {len(r.ids) for r in ids if r.doc_id in (2, 3)} == {0}
    model = automaton.scored(odd, automaton.trained_on(F.col("doc_id"))).where("doc_id = 3").first()
    assert model.n_tokens == 1 and model.n_known == 1
    assert [r.found.text for r in odd.where("doc_id = 2").select(pseudonym.pseudonymised(F.col("text"), b"k").alias("found")).collect()] == [None]


def test_decontamination_edges(odd, items):
    found = {(r.doc_id, r.item_id) for r in latent.contaminated(odd, items).collect()}
    assert found == {(1, 1), (8, 1)}
    assert latent.contaminated(odd, items.where("false")).count() == 0
    assert latent.contaminated(odd.where("false"), items).count() == 0
    assert latent.contaminated(odd, items.where("item_id = 4")).count() == 0


def test_policies_and_ablations(odd):
    entries = ledger.ledger(odd)
    told = {(r.policy, r.rule): r for r in ledger.ablations(entries).collect()}
    bits = [r.failures for r in entries.collect()]
    for policy, rules in ledger.POLICIES.items():
        every = ledger.mask(rules)
        for rule in rules:
            own, row = ledger.bit(rule), told[policy, rule]
            assert row.failed == sum(bool(b & own) for b in bits)
            assert row.only == sum(b & every == own for b in bits)
            assert row.kept_without == sum(b & every & ~own == 0 for b in bits)
    assert ledger.ablations(entries.where("false")).count() == 0


@pytest.fixture(scope="module")
def folder(labels, items, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("tables"))
    labels.write.parquet(f"{base}/labels.parquet")
    items.write.parquet(f"{base}/benchmark.parquet")
    return base


@pytest.mark.parametrize("number", range(len(corpus_pipeline.STAGES)))
def test_stage_edges(spark, odd, folder, number):
    name, stage = corpus_pipeline.STAGES[number]
    found = stage(spark, odd, folder)
    kept = [r.doc_id for r in found.collect()]
    if number < len(corpus_pipeline.STAGES) - 1:
        assert found.columns == odd.columns
    expected = {
        "line_dedup": 11, "sentencepiece": 11,
        "near_dedup": {1, 2, 5, 6, 7, None}, "decontamination": {2, 3, 4, 5, 6, 7, None},
    }.get(name)
    if isinstance(expected, int):
        assert len(kept) == expected
    elif expected:
        assert set(kept) == expected
    assert set(kept) <= {1, 2, 3, 4, 5, 6, 7, 8, None}
    assert stage(spark, odd.where("false"), folder).collect() == []


def test_folds(spark):
    import zlib

    ids = spark.range(200).select("id", in_fold(F.col("id"), 4, 2).alias("held")).collect()
    assert all(r.held == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in ids)


@pytest.mark.parametrize("text, letter", [("½ ²", False), ("①②", False), ("Ⅷ", False), ("٣", False), ("_1", False), ("²é", True), ("日", True), ("ª", True)])
def test_letters(spark, text, letter):
    """What Spark chooses to learn from and what gets a language are the same."""
    assert families.has_letter(text.encode()) == letter
    assert spark.createDataFrame([(text,)], "t string").where(F.col("t").rlike(r"\p{L}")).count() == letter


def test_stages_keep_columns_with_their_own_names(spark, odd, folder):
    named = odd.withColumns({c: F.lit("own") for c in ("toxicity", "toxicity_", "lines_removed", "_benchmark_hits")})
    for name, stage in corpus_pipeline.STAGES[:2] + corpus_pipeline.STAGES[3:4]:
        found = stage(spark, named, folder)
        assert found.columns == named.columns, name
        assert {tuple(r) for r in found.select("toxicity", "toxicity_", "lines_removed", "_benchmark_hits").collect()} == {("own",) * 4}
