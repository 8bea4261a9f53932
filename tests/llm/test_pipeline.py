"""The pipeline, stage by stage on small tables."""

import corpus_pipeline
from stationflow.llm import queries

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = {r.doc_id: r.text for r in rows.collect()}
    assert len(corpus_pipeline.STAGES) == 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = spark.createDataFrame(stage(spark, rows, sf_dir).collect(), rows.schema)
        now = {r.doc_id: r.text for r in rows.collect()}
        assert rows.columns == COLUMNS and set(now) <= set(before)
        before = now
    pieces = corpus_pipeline.STAGES[-1][1](spark, rows, sf_dir).toPandas()
    assert set(pieces.doc_id) == set(before)
    whole = corpus_pipeline.run(spark, sf_dir).toPandas()
    assert whole.groupby("doc_id").length.sum().to_dict() == pieces.groupby("doc_id").length.sum().to_dict()


def test_every_operator_is_registered():
    assert {int(name[2:].split("_")[0]) for name in queries.QUERIES} == set(range(1, 14))
