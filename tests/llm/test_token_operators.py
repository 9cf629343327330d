"""Alignment, fill-in-middle and token counts on odd rows, against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import uuid
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from engagelake.llm import cross_tokens, fill_middle, token_counts
from engagelake.llm.queries import BYTE_VOCABULARY, PIECE_MODEL, tokenizer_path
from engagelake.session import shared_root

DOCS = "doc_id long, text string, form string, key string, n_a int, a int, n_tokens int, output string"
ODD = ["", None, " ", "  ", "\n", "a", "  two  spaces  here ", "line one\nline two\n", "no end\nof line", "\n\n\nx\n", "tab\there\r\nthere",
       "naïve café – 東京 🙂 x", "a b   c", "　wide　", "x\u0085 y", "mark ▁ inside", "<P>already", "pre<M>mid", "a <S> b",
       "<|endoftext|> <s> </s> <unk> <0x41>", "can't we're I'll 'tis", "1234567890 12.5%", "\x1c x\x1f y", "é" * 50, "w" * 3000,
       "🙂🙂 🙂\n🙂", "of\n of\n  of", "\x00 nul"]


def texts_of(seed=1, n=60):
    rng = random.Random(seed)
    vocab = ["the", "of", "naïve", "Über", "word", "東京", "x", "42", "don't", "🙂", "longer-word", "", "\n", "foo.bar", "(a)", "ß"]
    made = [" ".join(rng.choice(vocab) for _ in range(rng.randint(1, 60))) for _ in range(n)]
    made += ["".join(rng.choice("ab é🙂\n\t東 '") for _ in range(rng.randint(0, 40))) for _ in range(n)]
    return ODD + made + made[:10] + [made[0]] * 5


def docs_of(spark, texts):
    rows = [(i, t, "x", "y", 1, 2, 3, "z") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


# ---- alignment ------------------------------------------------------------------------------------------------

def bytes_of_a():
    """Byte-level alphabet as the vocabulary's publishers describe it, inverted."""
    keep = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    table, extra = {chr(b): b for b in keep}, 0
    for b in range(256):
        if b not in keep:
            table[chr(256 + extra)] = b
            extra += 1
    return table


def brute_alignment(texts):
    import sentencepiece
    from tokenizers import Tokenizer
    a_tool = Tokenizer.from_file(tokenizer_path(BYTE_VOCABULARY))
    a_tool.encode_special_tokens = True
    b_tool = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECE_MODEL))
    table, held, docs = bytes_of_a(), defaultdict(int), []
    for text in texts:
        links, groups, a, b = [], [], [], []
        if text:
            whole = (" " + text).encode()
            a = a_tool.encode(" " + text, add_special_tokens=False).ids
            b = b_tool.encode(text)
            raw_a = [bytes(table[c] for c in a_tool.id_to_token(i)) for i in a]
            raw_b = []
            for i in b:
                piece = b_tool.id_to_piece(i)
                coded = re.fullmatch("<0x(..)>", piece)
                raw_b.append(bytes([int(coded[1], 16)]) if coded else piece.replace("▁", " ").encode())
            if b"".join(raw_a) == whole == b"".join(raw_b):
                ends_a, ends_b = np.cumsum([len(r) for r in raw_a]), np.cumsum([len(r) for r in raw_b])
                for i, x in enumerate(a):
                    for j, y in enumerate(b):
                        if max(ends_a[i] - len(raw_a[i]), ends_b[j] - len(raw_b[j])) < min(ends_a[i], ends_b[j]):
                            links.append((x, y))
                before = 0
                for end in sorted(set(ends_a) & set(ends_b)):
                    groups.append(",".join(str(x) for x, e in zip(a, ends_a) if before < e <= end) + "|"
                                  + ",".join(str(y) for y, e in zip(b, ends_b) if before < e <= end))
                    before = end
            else:
                a, b = [], []
        for pair in set(links):
            held[pair] += 1
        docs.append((len(a), len(b), groups, links))
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    return [(n_a, n_b, len(groups), len(links), sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links),
             ";".join(groups)) for n_a, n_b, groups, links in docs]


@pytest.mark.parametrize("held", [cross_tokens.HELD, 40, 0])
def test_alignment_equals_brute_force(spark, held):
    texts = texts_of()
    got = cross_tokens.align_documents(docs_of(spark, texts), tokenizer_path(BYTE_VOCABULARY), tokenizer_path(PIECE_MODEL), held=held)
    rows = {r.doc_id: tuple(r)[1:] for r in got.collect()}
    want = brute_alignment(texts)
    assert rows == dict(enumerate(want))
    assert rows[ODD.index("mark ▁ inside")] == (0, 0, 0, 0, 0, 0, "")


def test_units_change_nothing():
    """Whole texts and remembered units give the same alignment, also after forgetting."""
    paths = tokenizer_path(BYTE_VOCABULARY), tokenizer_path(PIECE_MODEL)
    cut, whole = cross_tokens.Aligner(*paths), cross_tokens.Aligner(*paths)
    assert cut.cuttable
    whole.cuttable = False
    texts = [t or "" for t in texts_of(7, 120)]
    for at in range(0, len(texts), 20):
        for x, y in zip(cut.align(texts[at:at + 20]), whole.align(texts[at:at + 20])):
            assert list(x[0]) == list(y[0]) and x[1] == y[1] and (x[2] == y[2]).all() and (x[3] == y[3]).all()
        cut.held = cross_tokens.REMEMBERED + 1


def test_alignment_null_ids_repeated_rows_and_no_rows(spark):
    paths = tokenizer_path(BYTE_VOCABULARY), tokenizer_path(PIECE_MODEL)
    docs = spark.createDataFrame([(None, "same text"), (None, "same text"), (3, "same text"), (3, None)], "doc_id long, text string")
    rows = cross_tokens.align_documents(docs, *paths, whole_groups=False).collect()
    assert Counter((r.doc_id, r.count_sum > 0) for r in rows) == {(None, True): 2, (3, True): 1, (3, False): 1}
    full = next(r for r in rows if r.count_sum)
    assert full.count_sum == 3 * full.n_links and len(full.groups) == 64
    assert cross_tokens.align_documents(docs.limit(0), *paths).collect() == []


def test_pair_counts_in_small_portions(spark, monkeypatch):
    """Counts passed on in portions add up to those of one."""
    def batch(seed):
        rng = random.Random(seed)
        a = [sorted(rng.sample(range(50), 5)) for _ in range(30)]
        return pa.RecordBatch.from_arrays([pa.array([rng.randint(1, 3) for _ in a]), pa.array(a, pa.list_(pa.int32())),
                                           pa.array([[x % 7 for x in r] for r in a], pa.list_(pa.int32()))], names=["copies", "a", "b"])
    batches = [batch(s) for s in range(6)]

    def total():
        out = Counter()
        for part in cross_tokens._pair_counts(iter(batches)):
            for a, b, n in zip(*(c.to_pylist() for c in part.columns)):
                out[a, b] += n
        return out
    whole = total()
    monkeypatch.setattr(cross_tokens, "PENDING", 10)
    assert total() == whole and sum(whole.values()) > 500


# ---- fill-in-middle -------------------------------------------------------------------------------------------

def brute_fill(doc_id, text, unit="lines", rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if unit == "lines" else list(text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(units)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b, c = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    if h[3] % 100 < spm:
        return n, "spm", len(a), len(b), f"<S>{c}<P>{a}<M>{b}"
    return n, "psm", len(a), len(b), f"<P>{a}<S>{c}<M>{b}"


@pytest.mark.parametrize("unit,rate,spm", [("lines", 100, 50), ("chars", 100, 50), ("lines", 60, 0), ("chars", 30, 100)])
def test_fill_in_middle_equals_brute_force_and_restores(spark, unit, rate, spm):
    texts = texts_of(3)
    made = fill_middle.transform(docs_of(spark, texts), unit=unit, rate=rate, spm_share=spm)
    rows = made.withColumn("back", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    assert {r.doc_id: tuple(r)[1:6] for r in rows} == {i: brute_fill(i, t, unit, rate, spm) for i, t in enumerate(texts)}
    assert all(r.back == (texts[r.doc_id] or "") for r in rows)
    assert unit == "chars" or rate < 100 or {r.form for r in rows} == {"plain", "psm", "spm"}


def test_fill_in_middle_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(fill_middle, "CHUNK", 16)
    docs = spark.createDataFrame([(None, "a\nb\nc"), (None, "a\nb\nc"), (1, None)], "doc_id long, text string")
    rows = fill_middle.transform(docs).collect()
    assert sorted(tuple(r)[1:6] for r in rows if r.doc_id is None) == [brute_fill(None, "a\nb\nc")] * 2
    assert fill_middle.transform(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        fill_middle.transform(docs, unit="words")
    long = spark.createDataFrame([(5, "é line 🙂\n" * 200_000)], "doc_id long, text string")
    assert tuple(fill_middle.transform(long).first())[1:6] == brute_fill(5, "é line 🙂\n" * 200_000)


def test_exception_index_both_ways():
    text = "aé東🙂b\n" * 30 + "plain" * 20 + "ß"
    index = fill_middle.Exceptions(np.frombuffer(text.encode(), np.uint8))
    points = np.arange(len(text) + 1)
    at = np.array([len(text[:k].encode()) for k in points])
    assert (index.to_bytes(points) == at).all() and (index.to_points(at) == points).all()
    assert len(index.first) == sum(ord(c) > 127 for c in text)


# ---- token counts ---------------------------------------------------------------------------------------------

@pytest.mark.parametrize("name", [PIECE_MODEL, "byte_bpe_50k.json", "word_bpe_49k.json"])
def test_token_counts_equal_the_library(spark, name):
    path = tokenizer_path(name)
    if name.endswith(".json"):
        from tokenizers import Tokenizer
        tool = Tokenizer.from_file(path)
        count = lambda t: len(tool.encode(t, add_special_tokens=False).ids)
    else:
        import sentencepiece
        tool = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(tool.encode(t))
    texts = [*texts_of(4), "word " * 5000]
    rows = token_counts.count_tokens(docs_of(spark, texts), cache_of(spark), path, limit=4096).collect()
    want = {i: (len((t or "").encode()), count(t or ""), count(t or "") > 4096) for i, t in enumerate(texts)}
    assert {r.doc_id: tuple(r)[1:] for r in rows} == want
    assert any(r.over_limit for r in rows)


def cache_of(spark):
    return f"{shared_root(spark)}/cache-{uuid.uuid4().hex}"


@pytest.mark.parametrize("few", [token_counts.FEW_MISSING, 0])
def test_only_distinct_misses_are_encoded(spark, few):
    cache, path = cache_of(spark), tokenizer_path(PIECE_MODEL)
    first = docs_of(spark, ["one text", "one text", None, "", "two"])
    assert token_counts.fill(first, cache, path, few=few) == 3
    assert token_counts.fill(first, cache, path, few=few) == 0
    more = docs_of(spark, ["two", "three", "three", "one text"])
    assert token_counts.fill(more, cache, path, few=few) == 1
    version = token_counts.tokenizer_digest(path)
    assert token_counts.stored(spark, cache, version).count() == 4
    assert token_counts.fill(first, cache, tokenizer_path("word_bpe_49k.json"), few=few) == 3      # another version, its own counts
    assert spark.read.schema(token_counts.CACHE).parquet(cache).count() == 7


def test_a_stored_count_is_used_and_double_appends_are_one(spark):
    cache, path = cache_of(spark), tokenizer_path(PIECE_MODEL)
    docs = spark.createDataFrame([(None, "some text"), (None, "some text"), (2, "other")], "doc_id long, text string")
    token_counts.fill(docs, cache, path)
    rows = spark.read.schema(token_counts.CACHE).parquet(cache)
    rows.withColumn("n_tokens", F.lit(99).cast("long")).write.partitionBy("tokenizer").parquet(cache + "-marked")
    got = token_counts.count_tokens(docs, cache + "-marked", path).collect()
    assert [r.n_tokens for r in got] == [99, 99, 99] and sum(r.doc_id is None for r in got) == 2
    rows.write.partitionBy("tokenizer").mode("append").parquet(cache + "-marked")
    token_counts.compact(spark, cache + "-marked", cache + "-small")
    assert spark.read.schema(token_counts.CACHE).parquet(cache + "-small").count() == 2
    assert {r.n_tokens for r in token_counts.count_tokens(docs, cache + "-small", path).collect()} < set(range(10))


def test_token_counts_of_no_rows(spark):
    docs = docs_of(spark, ["x"]).limit(0)
    assert token_counts.count_tokens(docs, cache_of(spark), tokenizer_path(PIECE_MODEL)).collect() == []


def test_a_python_batch_is_bounded_by_bytes(spark):
    """Long rows reach Python in batches of a few MB, unless the session sets its own bound."""
    from engagelake.session import BATCH, configure

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], names=["bytes"])
    rows = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("x"), 10_000).alias("text"))
    kept = spark.conf.get(BATCH)
    try:
        spark.conf.unset(BATCH)
        configure(spark)
        found = [r["bytes"] for r in rows.mapInArrow(sizes, "bytes long").collect()]
        assert sum(found) >= 30_000_000 and max(found) < 6_000_000
        spark.conf.set(BATCH, "8m")
        assert configure(spark).conf.get(BATCH) == "8m"
    finally:
        spark.conf.set(BATCH, kept)


def test_a_scan_of_texts_decodes_few_rows_at_once(spark):
    """Column vectors of long texts stay small, unless the session sets its own number of rows."""
    from engagelake.session import SCAN, configure
    kept = spark.conf.get(SCAN)
    try:
        spark.conf.unset(SCAN)
        assert int(configure(spark).conf.get(SCAN)) <= 512
        spark.conf.set(SCAN, "1024")
        assert configure(spark).conf.get(SCAN) == "1024"
    finally:
        spark.conf.set(SCAN, kept)


def test_packing_of_few_rows_takes_few_tasks(spark):
    """Many shuffle partitions, not coalesced, do not make as many tasks and files of a small result."""
    from engagelake.llm import packing
    from engagelake.llm.common import written
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    kept = [spark.conf.get(n) for n in names]
    cut = spark.createDataFrame([(i, 0, 0, 100 + i % 50, i) for i in range(200)],
                                "doc_id long, piece int, start long, length long, ids_crc32 long")
    try:
        spark.conf.set(names[0], "64")
        spark.conf.set(names[1], "false")
        got = packing.pack(written(cut, "cut"))
        assert got.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
        rows = got.collect()
    finally:
        for n, value in zip(names, kept):
            spark.conf.set(n, value)
    assert sorted(r.doc_id for r in rows) == list(range(200))
    used = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == used.get(r.sequence_id, 0)
        used[r.sequence_id] = r.offset + r.length
    assert max(used.values()) <= packing.CAPACITY and len(used) == -(-sum(r.length for r in rows) // packing.CAPACITY)
