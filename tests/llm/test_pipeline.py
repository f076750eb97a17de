import corpus_pipeline
from docweave.llm.shared import stored
from tests.conftest import SF


def test_stages_in_turn(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF))
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts[0] >= counts[1] >= counts[2] >= counts[3] > 0
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert out.filter("piece = 0").count() == docs.count()
