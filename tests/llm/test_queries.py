"""Registered queries against their SQL; the pipeline stage by stage."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from eventide.llm import queries
from eventide.plans.verify import compare, duck, plan_text
from tests.llm.test_duplicates import brute_leaks, brute_print, brute_repeats, groups

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_oracle(spark, name):
    r = compare(queries.QUERIES[name](spark, SF), duck(SF), queries.ORACLE_SQL[name])
    assert r["cols_match"] and r["rows_match"] and r["values_match"], r


@pytest.mark.parametrize("name", ["op3_url_filters", "op5_license_scans", "op7_benchmark_decontamination", "op8_mixing"])
def test_native_plans_have_no_python_and_no_cross_join(spark, name):
    plan = plan_text(queries.QUERIES[name](spark, SMALL))
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def test_texts_are_not_shuffled_by_scans(spark):
    for name in ("op1_token_counts", "op2_quality_rules", "op4_quality_classifier", "op5_license_scans", "op6_html_extraction"):
        assert "Exchange" not in plan_text(queries.QUERIES[name](spark, SMALL)), name


def test_pipeline_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, kept = docs.columns, None
    for name, stage in corpus_pipeline.STAGES:
        before = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        if name == "simhash_near_dedup":
            rows = sorted(before)
            assert set(after) == {rows[n][0] for n in groups([brute_print(t or "") for _, t in rows], 2)}
        elif name == "suffix_array_dedup":
            told = {i: (n, gone) for i, n, gone, *_ in brute_repeats(before, 100)}
            assert set(after) == {i for i, _ in before}
            assert all(n - gone - 6 * 99 <= len(after[i].encode()) <= n - gone for i, (n, gone) in told.items())
        elif name == "benchmark_decontamination":
            items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
            held = brute_leaks([r for r in before if any(w in r[1] for _, t in items for w in [" ".join(t.split()[:4])])], items)
            assert {i for i, _ in before} - set(after) == {i for i, _ in held}
        elif name == "mixing_to_weights":
            assert set(after) <= {i for i, _ in before} and docs.columns == [*columns, "copy"]
            kept = docs.groupBy("doc_id").agg(F.count("*").alias("n"), F.max("copy").alias("m")).where("n <> m OR n > 3").count()
            continue
        assert docs.columns == columns, name
    assert kept == 0


def test_run_equals_the_stages(spark):
    a, b = (corpus_pipeline.run(spark, SMALL).agg(F.count("*"), F.expr("bit_xor(xxhash64(doc_id, text, copy))")).first() for _ in range(2))
    assert a == b and a[0] > 0
