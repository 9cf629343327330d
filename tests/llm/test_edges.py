"""Every operator's query and the pipeline on odd tables: empty ones, null ids and texts, repeated rows, very long texts, clashing columns."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from engagelake.llm.queries import REGISTRY

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, key string, n_words int, spans string, shard string, kept string, "
        "output string, copies int, rows int, block int, a int, term string, pos int, w string")
PER_DOCUMENT = [n for n in REGISTRY if n.split("_")[0] in ("op3", "op4", "op6", "op7", "op8", "op9", "op10", "op11", "op12", "op13")]


def texts():
    rng = random.Random(20)
    words = [f"w{i}" for i in range(500)]
    long = " ".join(rng.choice(words) for _ in range(30_000))
    body = " ".join(rng.choice(words) for _ in range(80))
    return [(None, body), (None, body), (None, None), (1, body), (1, body), (2, ""), (3, " \n\t "), (4, long), (5, "one"), (6, body + " tail"),
            (7, "AKIA" + "Z9" * 9 + " a@b.cc 1.2.3.4"), (7, "AKIA" + "Z9" * 9 + " a@b.cc 1.2.3.4"), (8, "x" * 100_000), (9, "é🙂 " * 500)]


def tables(spark, folder, empty):
    docs = [(i, t, "en", "s", len(t or ""), "k", 1, "s", "x", "y", "o", 1, 2, 3, 4, "t", 5, "w") for i, t in texts()]
    frames = {"documents": (docs, DOCS),
              "benchmark": ([(1, "w1 w2 w3"), (2, None), (None, "one"), (2, "")], "item_id long, text string"),
              "pages": ([(1, "http://a.com/x", "<p>"), (1, "http://a.com/x", "<p>"), (None, None, None), (2, "", ""), (3, "http://b.net/es/" + "q" * 5000, "")],
                        "page_id long, url string, html string"),
              "labels": ([(1, 1, 0)], "doc_id long, quality int, toxic int"),
              "conversations": ([(1, 0, "user", "hi?"), (1, 1, "assistant", "yes"), (1, 1, "assistant", "yes"), (None, None, "user", None),
                                 (None, None, "user", None), (2, 0, "user", "word " * 5000)], "conv_id long, turn int, role string, text string")}
    for name, (rows, schema) in frames.items():
        frame = spark.createDataFrame([] if empty else rows, schema)
        frame.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    return tables(spark, tmp_path_factory.mktemp("odd"), False)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return tables(spark, tmp_path_factory.mktemp("empty"), True)


@pytest.mark.parametrize("name", [*REGISTRY, "pipeline"])
def test_empty_tables_give_no_rows(spark, empty, name):
    run = corpus_pipeline.run if name == "pipeline" else REGISTRY[name]
    assert run(spark, empty).collect() == []


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_each_row_has_its_result(spark, odd, name):
    rows = REGISTRY[name](spark, odd).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in texts())
    if name.split("_")[0] not in ("op3", "op9"):                # these place or link rows; the others judge a text alone
        for i in (1, 7):
            assert len({str(r) for r in rows if r.doc_id == i}) == 1


def test_packing_takes_every_row(spark, odd):
    rows = REGISTRY["op2_best_fit_packing"](spark, odd).collect()
    assert Counter(r.doc_id for r in rows if r.piece == 0) == Counter(i for i, _ in texts())
    for sequence in {r.sequence_id for r in rows}:
        parts = sorted((r.offset, r.length) for r in rows if r.sequence_id == sequence)
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))] and sum(n for _, n in parts) <= 2048


def test_pages_and_conversations_keep_their_rows(spark, odd):
    pages = REGISTRY["op5_url_filters"](spark, odd).collect()
    assert Counter(r.page_id for r in pages) == Counter([1, 1, None, 2, 3])
    turns = REGISTRY["op1_chat_formatting"](spark, odd).collect()
    assert {r.conv_id for r in turns} == {1, 2, None}
    assert sum(len(r.content) for r in turns if r.conv_id == 2) >= 25_000


def test_pipeline_on_odd_rows(spark, odd):
    rows = corpus_pipeline.run(spark, odd).collect()
    good = {i for i, t in texts() if t and len(t.split()) >= 50}
    assert {r.doc_id for r in rows} <= good
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, odd)
        assert out.columns == docs.columns, name
        assert out.filter(F.col("key").isNull()).count() == 0, name
