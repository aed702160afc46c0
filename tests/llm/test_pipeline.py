"""The pipeline on the smallest tables, stage by stage."""

import corpus_pipeline
import __spark_entry__
from skyframe.llm import secret_scan, simhash_pigeonring, toxicity_knn
from skyframe.session import table

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = table(spark, SF, "documents")
    columns, before = docs.columns, docs.count()
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, SF).write.parquet(path)
        out = spark.read.parquet(path)
        seen[name] = (docs, out)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns
        docs = out
    first, kept = seen["toxicity"]
    scores = toxicity_knn.score_documents(first, table(spark, SF, "labels"))
    clean = {r["doc_id"] for r in scores.filter("predicted = 0").collect()}
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == clean and before > len(clean)
    first, kept = seen["near_duplicates"]
    groups = {r["component_id"] for r in simhash_pigeonring.near_duplicates(first).collect()}
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == groups
    first, kept = seen["secrets"]
    assert kept.count() == first.count()
    assert secret_scan.report(kept).filter("n_access + n_hex > 0").count() == 0
    first, kept = seen["mixing"]
    taken = {r["doc_id"]: r["count"] for r in kept.groupBy("doc_id").count().collect()}
    assert taken and max(taken.values()) <= 3
    assert seen["tokens"][1].count() == seen["mixing"][1].count()


def test_run_on_empty_table(spark, tmp_path):
    d = str(tmp_path)
    for name in ("documents", "labels"):
        table(spark, SF, name).limit(0).write.parquet(f"{d}/{name}.parquet")
    assert corpus_pipeline.run(spark, d).count() == 0


def test_queries_are_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert any(k.startswith(f"op{n}_") for k in names)
