"""The pipeline keeps what its stages keep, on whole small tables."""

from __future__ import annotations

import corpus_pipeline
from engagelake.llm import decontaminate, near_dedup, quality_rules
from engagelake.llm.queries import table
from engagelake.session import BATCH, BATCH_BYTES, SCAN, SCAN_ROWS


def test_stages_and_result(spark, sf_small):
    docs = table(spark, sf_small, "documents")
    good = {r.doc_id for r in quality_rules.measure(docs).filter("kept").collect()}
    kept = docs.filter(docs.doc_id.isin(list(good)))
    unique = {r.doc_id for r in near_dedup.components(kept).filter("kept").collect()}
    bad = {r.doc_id for r in decontaminate.scan(kept, table(spark, sf_small, "benchmark")).filter("contaminated").collect()}
    out = corpus_pipeline.run(spark, sf_small).collect()
    assert {r.doc_id for r in out} == unique - bad
    assert len(corpus_pipeline.STAGES) == 5
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, kept, sf_small).columns == docs.columns, name


def test_a_stage_called_alone_applies_the_runtime_settings(spark, sf_small):
    docs = table(spark, sf_small, "documents")
    kept = {name: spark.conf.get(name) for name in (BATCH, SCAN)}
    try:
        for name, stage in corpus_pipeline.STAGES:
            for setting in kept:
                spark.conf.unset(setting)
            stage(spark, docs.limit(20), sf_small)
            assert [spark.conf.get(x) for x in (BATCH, SCAN)] == [BATCH_BYTES, SCAN_ROWS], name
    finally:
        for setting, value in kept.items():
            spark.conf.set(setting, value)
