"""What the toxicity model learns from."""

import corpus_pipeline
from linewarden.llm import toxicity


def test_pipeline_learns_from_every_label(spark, tmp_path, monkeypatch):
    """All labelled documents outside the held-out fold, above the bound that the operator has by default."""
    docs = spark.range(20_000).selectExpr(
        "id AS doc_id", "if(id % 10 = 0, concat('you idiot ', id), concat('a calm text ', id)) AS text"
    )
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = docs.selectExpr("doc_id", "cast(doc_id % 10 = 0 AS int) AS toxic")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    learned, own = [], toxicity.labelled_sample

    def seen(*given):
        learned.append(own(*given))
        return learned[0]

    monkeypatch.setattr(toxicity, "labelled_sample", seen)
    left = corpus_pipeline.drop_toxic(spark, spark.read.parquet(str(tmp_path / "documents.parquet")), str(tmp_path))
    wanted = labels.where(~toxicity.in_fold(labels.doc_id, 5, 0)).count()
    assert wanted > toxicity.SAMPLE_ROWS and learned[0].count() == wanted
    assert left.count() == 18_000 and left.where("doc_id % 10 = 0").isEmpty()
