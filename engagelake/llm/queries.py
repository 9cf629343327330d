"""Registered queries of the operators, over the whole generated tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat_format, cross_tokens, decontaminate, fill_middle, license_scan, near_dedup, packing, pii, quality_rules,
               secret_scan, sharding, token_counts, url_filter)
from ..session import new_run_dir

#: Name of the vocabulary file in the folder of public tokenizers.
VOCABULARY = "word_bpe_49k.json"
BYTE_VOCABULARY, PIECE_MODEL = "byte_bpe_50k.json", "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def span_digest(spans, kinds) -> tuple:
    """(base_sha256, spans) columns of an array of spans with kind, start and end, sorted."""
    def joined(array):
        return F.array_join(F.transform(array, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.sha2(joined(base), 256), joined(spans)


#: Speaker markers by which the generated transcripts open turns, in four styles (system, user, assistant).
MARKERS = (("System: ", "User: ", "Assistant: "), ("[system] ", "[human] ", "[ai] "),
           ("**Context:** ", "**Q:** ", "**A:** "), ("- ", "- ", "- "))


def marked_turns(spark, sf_dir):
    """The conversations as transcripts: each turn opened by its conversation's style of marker."""
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(MARKERS)))
    opened = F.lit("")
    for i, marks in enumerate(MARKERS):
        for role, mark in zip(chat_format.ROLES, marks):
            opened = F.when((style == i) & (F.col("role") == role), F.lit(mark)).otherwise(opened)
    return table(spark, sf_dir, "conversations").withColumn("text", F.concat(opened, F.coalesce("text", F.lit(""))))


def op1_chat_formatting(spark, sf_dir):
    turns = marked_turns(spark, sf_dir)
    model = chat_format.fit(turns)
    return chat_format.parse(turns.select("conv_id", F.col("turn").alias("pos"), "text"), model)


def op2_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op3_minhash_near_dedup(spark, sf_dir):
    return near_dedup.components(table(spark, sf_dir, "documents"))


def op4_secret_scans(spark, sf_dir):
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    spans = F.col("spans")
    digest, text = span_digest(spans, secret_scan.BASE)
    return found.select("doc_id", *[F.size(F.filter(spans, _is(k))).cast("long").alias(f"n_{k}") for k in secret_scan.BASE],
                        digest.alias("base_sha256"), text.alias("spans"))


def op5_url_filters(spark, sf_dir):
    return url_filter.classify(table(spark, sf_dir, "pages"))


def op6_license_scans(spark, sf_dir):
    return license_scan.by_document(table(spark, sf_dir, "documents"))


def op7_pii(spark, sf_dir):
    found = pii.scan(table(spark, sf_dir, "documents"))
    spans = F.col("spans")
    digest, text = span_digest(spans, pii.BASE)
    return found.select("doc_id", *[F.size(F.filter(spans, _is(k))).cast("long").alias(f"n_{k}") for k in pii.BASE],
                        digest.alias("base_sha256"), text.alias("spans"))


def _is(kind):
    return lambda s: s["kind"] == kind


def op8_benchmark_decontamination(spark, sf_dir):
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), near=True)
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated", "n_near")


def op9_sharding(spark, sf_dir):
    placed = sharding.assign(table(spark, sf_dir, "documents"), sharding.SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op10_quality_rules(spark, sf_dir):
    return quality_rules.measure(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_cross_tokenizer_alignment(spark, sf_dir):
    found = cross_tokens.align_documents(table(spark, sf_dir, "documents"), tokenizer_path(BYTE_VOCABULARY),
                                         tokenizer_path(PIECE_MODEL), whole_groups=False)
    return found.withColumnRenamed("groups", "groups_sha256")


def op12_fill_in_middle(spark, sf_dir):
    made = fill_middle.transform(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op13_token_counts(spark, sf_dir):
    """From an empty cache, so that every run does the whole work; a lasting one is a folder that stays."""
    cache = f"{new_run_dir(spark, 'token-cache')}/counts"
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), cache, tokenizer_path(PIECE_MODEL))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_chat_formatting, op2_best_fit_packing, op3_minhash_near_dedup, op4_secret_scans, op5_url_filters,
    op6_license_scans, op7_pii, op8_benchmark_decontamination, op9_sharding, op10_quality_rules, op11_cross_tokenizer_alignment,
    op12_fill_in_middle, op13_token_counts)}


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _oracle_near_dedup() -> str:
    return rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+') w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i+4], ' ') g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id x, b.doc_id y, count(*) shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * shared >= 75 * (a.n + b.n - shared)),
r AS (SELECT doc_id, doc_id AS reach FROM documents UNION SELECT r.doc_id, l.y FROM r JOIN l ON r.reach = l.x),
c AS (SELECT doc_id, min(reach) component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)"""


def _oracle_decontamination() -> str:
    words = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    width, share = decontaminate.WIDTH, decontaminate.SHARE_OF
    return rf"""
WITH d AS (SELECT doc_id, {words} w FROM documents),
i AS (SELECT item_id, {words} w FROM benchmark),
p AS (SELECT DISTINCT item_id, w[k:k+{width - 1}] g
      FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {width - 1}, 1) + 1)) k FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(g) n FROM p),
o AS (SELECT doc_id, k, n, w[k:k+n-1] g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) k FROM d, sizes)),
m AS (SELECT o.doc_id, o.k, o.n, p.item_id FROM o JOIN p ON o.g = p.g),
h AS (SELECT doc_id, count(DISTINCT place) n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) place FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, list(DISTINCT item_id::VARCHAR ORDER BY item_id::VARCHAR) ids FROM m GROUP BY doc_id),
k AS (SELECT doc_id, term, o FROM (SELECT doc_id, unnest(w) term, unnest(range(1, len(w) + 1)) o FROM d)),
f AS (SELECT term, count(*) df FROM k GROUP BY term),
y AS (SELECT DISTINCT g FROM p),
z AS (SELECT g, unnest(g) term, unnest(range(1, len(g) + 1)) o FROM y),
r AS (SELECT z.g, z.term, row_number() OVER (PARTITION BY z.g ORDER BY df NULLS FIRST, encode(z.term), z.o) rn, df FROM z LEFT JOIN f USING (term)),
q AS (SELECT g, max(term) FILTER (rn = 1) one, max(term) FILTER (rn = 2) two FROM r GROUP BY g HAVING count(df) = count(*)),
x AS (SELECT doc_id, count(DISTINCT g) n_near FROM (SELECT a.doc_id, q.g FROM q JOIN k a ON a.term = q.one
      JOIN k b ON b.term = q.two AND a.doc_id = b.doc_id AND b.o <> a.o AND abs(b.o - a.o) < {width}) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT n_words, coalesce(n_hit, 0)::BIGINT n_hit, coalesce(len(ids), 0)::BIGINT n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) items_sha256,
       coalesce(n_hit, 0) > 0 AND {share} * coalesce(n_hit, 0) >= len(w) AS contaminated,
       coalesce(n_near, 0)::BIGINT n_near
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id) LEFT JOIN x USING (doc_id)"""


def _oracle_quality() -> str:
    stop = ", ".join("'" + w + "'" for w in quality_rules.STOP_FORMS)
    fails = " OR ".join(f"{r.metric} {op} {bound}" for r in quality_rules.RULES
                        for op, bound in (("<", r.low), (">", r.high)) if bound is not None)
    return rf"""
WITH w AS (SELECT doc_id, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) l FROM documents),
g AS (SELECT doc_id, k, w[k:k+2] g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) k FROM w WHERE len(w) > 2)),
f AS (SELECT doc_id, k FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) c FROM g) WHERE c > 1),
r AS (SELECT doc_id, count(DISTINCT place) n FROM (SELECT doc_id, unnest([k, k + 1, k + 2]) place FROM f) GROUP BY doc_id),
c AS (SELECT w.doc_id, len(w)::BIGINT n_words, len(array_to_string(w, ''))::BIGINT word_chars,
      len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT n_symbols, (len(l) - len(list_distinct(l)))::BIGINT n_dup_lines,
      coalesce(r.n, 0)::BIGINT n_repeat_words, len(l) n_lines, len(regexp_extract_all(t, '\p{{Lu}}{{2,}}')) n_capitals,
      len(regexp_extract_all(t, '!{{2,}}')) n_marks, len(list_filter(w, lambda x: x IN ({stop}))) n_stop,
      len(list_filter(l, lambda x: ends_with(x, '...') OR ends_with(x, '…'))) n_ellipsis
      FROM w LEFT JOIN r USING (doc_id)),
m AS (SELECT *, coalesce(word_chars / nullif(n_words, 0), 0) mean_word_length, coalesce(n_symbols / nullif(n_words, 0), 0) symbol_ratio,
      coalesce(n_capitals / nullif(n_words, 0), 0) capital_ratio, coalesce(n_marks / nullif(n_words, 0), 0) exclamation_ratio,
      coalesce(n_stop / nullif(n_words, 0), 0) stop_ratio, coalesce(n_dup_lines / nullif(n_lines, 0), 0) dup_line_ratio,
      coalesce(n_repeat_words / nullif(n_words, 0), 0) repeat_ratio, coalesce(n_ellipsis / nullif(n_lines, 0), 0) ellipsis_line_ratio,
      n_words < {quality_rules.BASE_MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.BASE_MAX_REPEAT_PERCENT} * n_words base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT ({fails}) AS kept FROM m"""


def _oracle_fill_middle() -> str:
    p, s, m = fill_middle.MARKERS
    dice = ", ".join(f"('0x' || substr(d, {8 * k + 1}, 8))::UBIGINT::BIGINT h{k + 1}" for k in range(4))
    return rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') t, sha256('{fill_middle.SEED}:' || coalesce(doc_id::VARCHAR, '')) d FROM documents),
l AS (SELECT doc_id, t, regexp_extract_all(t, '[^
]*
|[^
]+') l, {dice} FROM t),
c AS (SELECT *, len(l)::BIGINT n, least(h1 % (len(l) + 1), h2 % (len(l) + 1)) lo, greatest(h1 % (len(l) + 1), h2 % (len(l) + 1)) hi,
      CASE WHEN t = '' OR contains(t, '{p}') OR contains(t, '{s}') OR contains(t, '{m}') OR h3 % 100 >= {fill_middle.RATE}
      THEN 'plain' WHEN h4 % 100 < {fill_middle.SPM_SHARE} THEN 'spm' ELSE 'psm' END form FROM l),
x AS (SELECT *, array_to_string(l[1:lo], '') a, array_to_string(l[lo + 1:hi], '') b, array_to_string(l[hi + 1:], '') e FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(a) END::BIGINT prefix_chars,
       CASE WHEN form <> 'plain' THEN length(b) END::BIGINT middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{p}' || a || '{s}' || e || '{m}' || b
              ELSE '{s}' || e || '{p}' || a || '{m}' || b END) output_sha256, sha256(t) restored_sha256 FROM x"""


ORACLES: dict[str, str] = {"op12_fill_in_middle": _oracle_fill_middle(),
                           "op3_minhash_near_dedup": _oracle_near_dedup(),
                           "op8_benchmark_decontamination": _oracle_decontamination(),
                           "op10_quality_rules": _oracle_quality()}
