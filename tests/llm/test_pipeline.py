"""The pipeline: every stage on its own input, and on odd rows."""

import corpus_pipeline as pipeline
from cases import documents
from pyspark.sql import functions as F

from ebbflow.llm import decontaminate, secrets
from ebbflow.session import settled
from test_dedup import brute_components, brute_leaks, brute_print
from test_models import brute_spans

SMALL = "/root/testdata/sf0.001"
ORDER = ["language_id", "simhash_near_dedup", "benchmark_decontamination", "secret_scan", "best_fit_packing"]


def test_stages_against_brute_force(spark):
    assert [name for name, _ in pipeline.STAGES] == ORDER and pipeline.ORACLE_SQL is None
    stages = dict(pipeline.STAGES)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    one = settled(stages["language_id"](spark, docs, SMALL))
    assert one.count() == docs.filter(F.col("text").rlike(r"\p{L}")).count() and one.columns == docs.columns
    two = settled(stages["simhash_near_dedup"](spark, one, SMALL))
    texts = {r.doc_id: r.text for r in one.collect()}
    groups = brute_components({k: brute_print(t) for k, t in texts.items()})
    assert sorted(r.doc_id for r in two.collect()) == sorted(set(groups.values()))
    three = settled(stages["benchmark_decontamination"](spark, two, SMALL))
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    left = [(r.doc_id, r.text) for r in two.collect()]
    leaks = {doc for doc, _ in brute_leaks(left, items)}
    assert leaks and {r.doc_id for r in three.collect()} == {k for k, _ in left} - leaks
    four = settled(stages["secret_scan"](spark, three, SMALL))
    masked = {r.doc_id: r for r in four.collect()}
    for r in three.collect():
        spans = brute_spans(r.text)
        assert (masked[r.doc_id].text == r.text) == (not spans)
        assert not brute_spans(masked[r.doc_id].text) and masked[r.doc_id].n_chars == len(masked[r.doc_id].text)
    five = stages["best_fit_packing"](spark, four, SMALL)
    assert five.select("doc_id").distinct().count() == len(masked)
    assert five.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 1024").count() == 0


def test_odd_rows_go_through(spark):
    docs, columns = documents(spark), pipeline.COLUMNS
    for name, stage in pipeline.STAGES:
        docs = settled(stage(spark, docs, SMALL))
        assert name == ORDER[-1] or docs.columns == columns
    assert {r.doc_id for r in docs.collect()} == {1, 6, 7, 9, -3, None}
    nothing = documents(spark).limit(0)
    for _, stage in pipeline.STAGES:
        nothing = settled(stage(spark, nothing, SMALL))
        assert nothing.count() == 0
    assert decontaminate.RADIUS < 64 and secrets.KINDS[-1] == "markov"
