"""The registered queries against their SQL, and the pipeline's stages."""

import uuid

import corpus_pipeline
import oracle
import plainly
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from laborlens.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, sf, name):
    assert oracle.compare(queries.QUERIES[name](spark, sf), oracle.connect(sf), queries.ORACLES[name]) == []


def test_all_are_registered():
    names = entry.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14)) and "pipeline" in names


def test_native_plans_have_no_python(spark, sf):
    for name in ("op2_line_dedup", "op3_secret_scans"):
        text = queries.QUERIES[name](spark, sf)._jdf.queryExecution().toString()
        assert not any(x in text for x in ("Python", "Pandas", "InArrow"))


def test_pipeline_stage_by_stage(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        stage(spark, docs, sf).write.parquet(path := f"{tmp_path}/{uuid.uuid4().hex}")
        out = spark.read.parquet(path)
        if name == "packing":
            ends = out.filter("start + length = doc_tokens")
            assert {r.doc_id for r in ends.collect()} == set(before)
            break
        assert out.columns == columns
        after = {r.doc_id: r.text for r in out.select("doc_id", "text").collect()}
        assert set(after) <= set(before) and after
        if name == "quality_rules":
            assert not any(plainly.quality(t)["n_words"] < 50 for t in after.values())
            assert all(after[i] == before[i] for i in after)
        elif name == "line_dedup":
            want = plainly.line_dedup(before.items())
            whole = {i for i, (n, gone, _) in want.items() if gone < n}
            assert set(after) == whole and all(plainly.sha(after[i] or "") == want[i][2] for i in after)
        elif name == "near_dedup":
            want = plainly.components(list(before.items()), 5, 80)
            assert set(after) == {i for i, (_, c) in want.items() if c == i}
            assert all(after[i] == before[i] for i in after)
        elif name == "secret_scan":
            for i, text in before.items():
                found = [tuple(map(int, s.split(":")[1:])) for s in plainly.base_secrets(text)]
                assert (after[i] == text) or found or "[live opaque]" in after[i]
                assert not any(text[a:b] in after[i] for a, b in found)
        docs = out
    assert corpus_pipeline.run(spark, sf).agg(F.countDistinct("doc_id")).first()[0] == len(before)
