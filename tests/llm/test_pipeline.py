import pytest

import __spark_entry__
import corpus_pipeline
from covisit.llm.queries import QUERIES

from .test_decontamination import brute as brute_leaks
from .test_dedup import brute_components, brute_lines, without
from .test_tokens import check_packing
from .tools import SMALL, frame, rows_of


def test_registry():
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert QUERIES.keys() <= __spark_entry__.queries().keys() and "pipeline" in __spark_entry__.queries()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "packing"]


def test_stages_against_brute_force(spark):
    """Every stage on what the one before kept; the last one's rows are those of the registered query."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    rows = []
    for name, stage in corpus_pipeline.STAGES:
        before = rows
        docs = stage(spark, docs, SMALL)
        rows = [r.asDict() for r in docs.collect()]
        if name != "packing":
            assert docs.columns == columns and all(r["n_chars"] == len(r["text"]) for r in rows)
            docs = frame(spark, rows)
            docs = docs.select(*columns)
        if name == "line_dedup":
            removed, _ = brute_lines(before)
            expected = {r["doc_id"]: without(r["text"], removed[r["doc_id"]]) for r in before}
            assert {r["doc_id"]: r["text"] for r in rows} == {k: t for k, t in expected.items() if t.strip() or not removed[k]}
        if name == "ngram_jaccard_join":
            assert {r["doc_id"] for r in rows} == {k for k, (_, c) in brute_components(before).items() if k == c}
        if name == "benchmark_decontamination":
            leaks = {k for k, _ in brute_leaks(before, rows_of("benchmark"))}
            assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in before} - leaks
        if name == "packing":
            check_packing(before, rows)


def test_pipeline_query(spark):
    assert corpus_pipeline.run(spark, SMALL).count() > 0


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_of_an_empty_table(spark, name):
    assert dict(corpus_pipeline.STAGES)[name](spark, frame(spark, []), SMALL).count() == 0
