"""The corpus pipeline: stage by stage on the smallest tables, and on edge cases."""

import re

import corpus_pipeline
from helpers import EDGES, docs, duck, spark_rows, words

from hazardflow.llm import line_dedup, mixing
from hazardflow.llm.queries import QUERIES, SQL
from hazardflow.llm.tables import written

SMALL = "/root/testdata/sf0.001"


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "near_dedup", "decontamination", "mixing"]
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES) == list(range(1, 14))
    assert set(SQL) <= set(QUERIES)


def test_stages(spark):
    before = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, ids = before.columns, {r.doc_id for r in before.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = written(stage(spark, before, SMALL), name)
        now = {r.doc_id: r.text for r in after.collect()}
        assert after.columns == columns and set(now) <= ids and len(now) == after.count()
        if name == "line_dedup":
            cols, rows = duck(line_dedup.SQL, documents=before.select("doc_id", "text"))
            assert {r[cols.index("doc_id")]: r[cols.index("text")] for r in rows} == now
        elif name == "decontamination":
            items = [words(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
            windows = {" ".join(w[i: i + min(10, len(w))]) for w in items if w for i in range(len(w) - min(10, len(w)) + 1)}
            for r in before.collect():
                text = " " + " ".join(words(r.text)) + " "
                assert (r.doc_id in now) == (not any(f" {w} " in text for w in windows))
        else:
            assert len(now) >= 0.8 * len(ids)
        before, ids = after, set(now)
    assert spark_rows(corpus_pipeline.STAGES[-1][1](spark, before, SMALL)) == duck(mixing.SQL, documents=before)


def test_edge_cases_and_empty_documents(spark):
    df = docs(spark, EDGES)
    for table in (df, df.limit(0)):
        now = table
        for name, stage in corpus_pipeline.STAGES[:-1]:
            now = written(stage(spark, now, SMALL), name)
            assert now.columns == df.columns
        assert corpus_pipeline.STAGES[-1][1](spark, now, SMALL).count() >= 0
