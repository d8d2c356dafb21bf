"""What the stage line_dedup of the pipeline leaves."""

import corpus_pipeline

LONG = " ".join(f"passage{k}" for k in range(60))


def own(i, size=120):
    return " ".join(f"own{i}x{k}" for k in range(size))


def stage(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return {r.doc_id: r.text for r in corpus_pipeline.cut_boilerplate(spark, docs, "").collect()}


def test_long_lines_of_two_sites(spark):
    rows = [(i, f"{own(i)}\n{LONG}\nshort line", "ab"[i % 2]) for i in range(4)]
    rows += [(10 + i, f"{own(10 + i)}\nwithin one site {LONG}", "a") for i in range(3)]
    found = stage(spark, rows)
    assert found == {i: t if i in (0, 10, 11, 12) else f"{own(i)}\nshort line" for i, t, _ in rows}


def test_boilerplate_of_short_pages(spark):
    """A page that is mostly a license keeps its own line alone; a whole copy is left to near-duplicate removal."""
    license = "\n".join(f"license line {k} {'of many words ' * 3}" for k in range(12))
    rows = [(i, f"{own(i, 5)}\n{license}", f"s{i}") for i in range(8)]
    rows.append((20, license, "s1"))
    found = stage(spark, rows)
    assert found == {i: t if i in (0, 20) else own(i, 5) for i, t, _ in rows}


def test_what_both_stages_leave(spark):
    """After line_dedup and near_dedup only documents that are spread lines and nothing else hold a later spread line."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sites, first = {}, {}
    for r in docs.collect():
        for line in filter(None, (x.strip() for x in (r.text or "").split("\n"))):
            sites.setdefault(line, set()).add(r.source)
            first[line] = min(r.doc_id, first.get(line, r.doc_id))
    spread = {x for x in sites if len(sites[x]) >= (2 if len(x.split()) > 50 else 6)}
    cut = corpus_pipeline.cut_boilerplate(spark, docs, "")
    for r in corpus_pipeline.drop_near_duplicates(spark, cut, "").collect():
        lines = [x.strip() for x in (r.text or "").split("\n")]
        later = [x for x in lines if x in spread and first[x] < r.doc_id]
        rest = sum(len(x) for x in lines) - sum(map(len, later))
        assert not later or rest < 20
