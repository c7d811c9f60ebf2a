import re

import corpus_pipeline as pipeline
from cardloom.llm import oracle, quality, toxicity
from cardloom.llm.queries import held_out
from checks.compare import connect
from pyspark.sql import functions as F

from .test_ngram_join import brute


def test_every_stage_against_a_plain_version(spark, sample):
    docs = spark.read.parquet(f"{sample}/documents.parquet")
    columns = docs.columns
    con = connect(sample)
    seen = {}
    for name, stage in pipeline.STAGES:
        out = pipeline.staged(stage(spark, docs, sample), f"test-{name}")
        rows = {r.doc_id: r for r in docs.collect()}
        kept = {r.doc_id for r in out.collect()}
        seen[name] = (set(rows), kept)
        if name != "packing":
            assert out.columns == columns
            assert all(r == rows[r.doc_id] for r in out.collect())
            assert out.count() == len(kept)
        if name == "quality_rules":
            sql = f"WITH docs AS (SELECT doc_id, text FROM documents), {oracle.quality()}"
            assert kept == {r[0] for r in con.execute(f"{sql} SELECT doc_id FROM judged WHERE kept").fetchall()}
        elif name == "toxicity":
            labels = spark.read.parquet(f"{sample}/labels.parquet").where(~held_out(F.col("doc_id")))
            model = toxicity.train(docs, labels)
            score = docs.select("doc_id", toxicity.score_column(model)(F.col("text")).alias("s"))
            assert kept == {r.doc_id for r in score.collect() if r.s < 0.3}
        elif name == "ngram_join":
            found = brute([(i, r.text) for i, r in rows.items()], 5, 80)
            assert kept == {i for i, _, c in found if i == c}
        elif name == "decontaminate":
            fold = lambda t: " ".join(t.lower().split())
            items = [fold(r.text) for r in spark.read.parquet(f"{sample}/benchmark.parquet").collect()]
            clean = {i for i, r in rows.items() if not any(b in fold(r.text) for b in items)}
            assert kept == clean
        else:
            assert kept == set(rows)
            words = sum(len(re.findall(r"\S+", r.text)) for r in rows.values())
            assert out.agg(F.sum("length")).first()[0] >= words + len(rows)
        docs = out
    assert len(seen["quality_rules"][0]) > len(seen["packing"][1]) > 0
    assert quality.KEEP == 0.5


def test_empty_documents(spark, sample):
    docs = spark.read.parquet(f"{sample}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        docs = pipeline.staged(stage(spark, docs, sample), "test-empty")
    assert docs.collect() == []


def test_odd_documents(spark, sample, odd_documents):
    docs = odd_documents
    for name, stage in pipeline.STAGES:
        docs = pipeline.staged(stage(spark, docs, sample), "test-odd")
        if name != "packing":
            assert docs.columns == odd_documents.columns
