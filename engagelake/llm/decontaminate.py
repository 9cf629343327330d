"""Benchmark decontamination over a distributed positional inverted index.

Phrases are the ``width`` consecutive words of the test items (a shorter item
is one phrase).  Term frequencies are counted over the whole training corpus;
each phrase is probed by its two rarest terms.  The index stores the postings
``(term, document, position)`` of the probing terms with the words around each
posting.  A phrase's rarest list, shifted by the term's offset, proposes start
positions; the shifted list of its second term is intersected with them, and
the surviving starts are compared word by word: exact phrase matches.
Proximity matches are the places where a phrase's two rarest terms stand less than
``width`` words apart, in any order (:func:`near_matches`; :func:`scan` counts, per
document, the phrases that have one).  They do not decide contamination.

A document word inside any occurrence is hit; a document is contaminated when
``n_hit > 0`` and ``SHARE_OF * n_hit >= n_words``.

Built-in expressions only.  Probing terms and phrases are broadcast only when
their measured bytes are under ``BROADCAST_BYTES``; beyond it the same joins
shuffle.  Frequent words propose nothing unless a phrase has no other word.

Defined results for odd input: null, empty or wordless texts have no words, no
hits and are clean; a null id is an id of its own; repeated rows each give a
row, with equal results for equal (id, text); empty tables give no rows or no
hits; items with null or wordless text have no phrase; extra columns of either
table are ignored by :func:`scan` and kept by :func:`drop_contaminated`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import let, written

WIDTH = 13
SHARE_OF = 20
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A test-set table of more measured bytes than this is not broadcast.
BROADCAST_BYTES = 32 * 1024 * 1024


def item_words(text: Column) -> Column:
    """Lower-cased (A-Z only) runs of digits, letters a-z and characters beyond ASCII."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), SEPARATORS)
    return F.array_remove(parts, "")


def _fits(df: DataFrame, size: Column) -> bool:
    return (df.agg(F.sum(size)).first()[0] or 0) <= BROADCAST_BYTES


def _measured_broadcast(df: DataFrame, size: Column) -> DataFrame:
    """Hint for broadcast if the summed ``size`` of the (written) rows is under the cap."""
    return F.broadcast(df) if _fits(df, size) else df


def phrases(items: DataFrame, id_col: str = "item_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """Distinct phrases: ``phrase_id``, ``phrase`` (words), ``length``, ``item_ids`` (as strings)."""
    words = items.select(F.col(id_col).cast("string").alias("item_id"), item_words(F.col(text_col)).alias("w"))
    cut = words.filter(F.size("w") > 0).select("item_id", F.explode(let(F.col("w"), lambda w: F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(w) - width + 1, F.lit(1))),
        lambda i: F.slice(w, i, width)))).alias("phrase"))
    return (cut.groupBy("phrase").agg(F.collect_set("item_id").alias("item_ids"))
            .select(F.sha1(F.array_join("phrase", " ")).alias("phrase_id"), "phrase",
                    F.size("phrase").alias("length"), "item_ids"))


def term_frequency(docs: DataFrame, terms: DataFrame, text_col: str = "text") -> DataFrame:
    """Occurrences in all ``docs`` of each of the ``terms`` (column ``term``); absent terms have no row."""
    # the outer form: the inner one has the optimizer tokenise twice, to test for emptiness first
    tokens = docs.select(F.explode_outer(item_words(F.col(text_col))).alias("term"))
    if _fits(terms, F.octet_length("term") + 16):
        tokens = tokens.join(F.broadcast(terms), "term", "left_semi")
        return tokens.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    # too many terms to broadcast: counted in the tasks before anything is shuffled, so no frequent word piles up
    return tokens.groupBy("term").agg(F.count(F.lit(1)).alias("df")).join(terms.hint("merge"), "term", "left_semi")


def probes(table: DataFrame, frequency: DataFrame) -> DataFrame:
    """The two rarest terms of each phrase of which every term occurs in the corpus."""
    places = (table.select("phrase_id", F.posexplode("phrase").alias("at", "term"))
              .join(frequency, "term", "left"))
    order = W.partitionBy("phrase_id").orderBy(F.col("df").asc_nulls_first(), "term", "at")
    return (places.withColumn("r", F.row_number().over(order)).filter("r <= 2").groupBy("phrase_id")
            .agg(F.min(F.when(F.col("r") == 1, F.struct("term", "at"))).alias("first"),
                 F.min(F.when(F.col("r") == 2, F.struct("term", "at"))).alias("second"),
                 F.count("df").alias("known"), F.count(F.lit(1)).alias("probed"))
            .filter("known = probed").drop("known", "probed"))


def index(docs: DataFrame, terms: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          width: int = WIDTH) -> DataFrame:
    """Postings of ``terms`` in ``docs`` plus one row per document.

    Columns: ``doc_id``, ``text_key`` (hash of the text), ``n_words``, ``pos``
    (-1 in the document's own row), ``term``, ``context``: the ``width - 1``
    words on each side of the posting, whose first one stands at ``left``.
    """
    marked = terms.select("term").unionByName(docs.sparkSession.range(1).select(F.lit("").alias("term")))
    bounded = _measured_broadcast(marked, F.octet_length("term") + 16)
    tokens = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_key"),
                         F.concat(F.array(F.lit("")), item_words(F.col(text_col))).alias("w"))
    posted = tokens.select("doc_id", "text_key", "w", F.posexplode_outer("w").alias("at", "term"))
    left = F.greatest(F.col("at") - (width - 1), F.lit(1))
    return (posted.join(bounded, "term")
            .select("doc_id", "text_key", (F.size("w") - 1).cast("long").alias("n_words"),
                    (F.col("at") - 1).alias("pos"), "term",
                    F.when(F.col("at") > 0, F.slice("w", left + 1, F.col("at") - left + width)).alias("context"),
                    (left - 1).alias("left")))


def exact_matches(postings: DataFrame, table: DataFrame, probed: DataFrame) -> DataFrame:
    """``doc_id``, ``text_key``, ``start``, ``length``, ``item_ids`` of every phrase occurrence."""
    entry = probed.join(table, "phrase_id")
    entry = written(entry, "phrases")
    size = F.octet_length(F.array_join("phrase", " ")) + F.octet_length(F.array_join("item_ids", " ")) + 64
    first = _measured_broadcast(entry.select("phrase_id", F.col("first.term").alias("term"), F.col("first.at").alias("at"),
                                             "second", "phrase", "length", "item_ids"), size)
    start = F.col("pos") - F.col("at")
    proposed = (postings.filter("pos >= 0").join(first, "term")
                .withColumn("start", start).withColumn("skip", F.col("start") - F.col("left"))
                .filter((F.col("start") >= 0) & (F.col("skip") >= 0)
                        & (F.col("start") + F.col("length") <= F.col("n_words"))))
    # the second list, shifted to the phrase's start: its posting must stand at start + offset
    both = proposed.filter(F.col("second").isNull()
                           | (F.get("context", F.col("skip") + F.col("second.at")) == F.col("second.term")))
    return (both.filter(F.slice("context", F.greatest(F.col("skip") + 1, F.lit(1)), F.col("length")) == F.col("phrase"))
            .select("doc_id", "text_key", "start", "length", "item_ids"))


def near_matches(postings: DataFrame, probed: DataFrame, within: int = WIDTH - 1) -> DataFrame:
    """Proximity matches: documents in which the two rarest terms of a phrase stand at most ``within``
    words apart: ``doc_id``, ``phrase_id``, ``pos``, ``distance`` (signed).  ``within`` is below the index's width."""
    pairs = probed.filter(F.col("second").isNotNull()).select(
        "phrase_id", F.col("first.term").alias("term"), F.col("second.term").alias("other"))
    near = postings.filter("pos >= 0").join(pairs, "term")
    here = F.col("pos") - F.col("left")
    return (near.select("doc_id", "phrase_id", "pos", "other", F.posexplode("context").alias("c", "word"),
                        here.alias("here"))
            .filter((F.col("word") == F.col("other")) & (F.abs(F.col("c") - F.col("here")) <= within))
            .filter(F.col("c") != F.col("here"))
            .select("doc_id", "phrase_id", "pos", (F.col("c") - F.col("here")).alias("distance")))


def near_phrases(postings: DataFrame, probed: DataFrame) -> DataFrame:
    """``doc_id``, ``text_key``, ``n_near``: phrases with a proximity match, per document.

    A posting's context is the ``width - 1`` words on each side, so the other term is looked for there."""
    pairs = probed.filter(F.col("second").isNotNull()).select(
        "phrase_id", F.col("first.term").alias("term"), F.col("second.term").alias("other"))
    pairs = _measured_broadcast(pairs, F.octet_length("term") + F.octet_length("other") + 64)
    others = F.size(F.filter("context", lambda w: w == F.col("other")))
    return (postings.filter("pos >= 0").join(pairs, "term").filter(others > (F.col("other") == F.col("term")).cast("int"))
            .select("doc_id", "text_key", "phrase_id").distinct()
            .groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("n_near")))


def scan(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_id_col: str = "item_id", item_text_col: str = "text", width: int = WIDTH,
         share_of: int = SHARE_OF, near: bool = False) -> DataFrame:
    """One row per document row: ``doc_id``, ``text_key``, ``n_words``, ``n_hit``, ``item_ids`` (sorted
    strings), ``spans`` (merged [start, end) word ranges), ``contaminated``, and with ``near`` also ``n_near``
    (phrases that match by proximity)."""
    table = written(phrases(items, item_id_col, item_text_col, width), "items")
    terms = written(table.select(F.explode("phrase").alias("term")).distinct(), "terms")
    frequency = written(term_frequency(docs, terms, text_col), "frequency")
    probed = written(probes(table, frequency), "probes")
    probing = written(probed.select(F.explode(F.array("first.term", "second.term")).alias("term"))
                      .filter("term is not null").distinct(), "probing")
    postings = written(index(docs, probing, id_col, text_col, width), "postings")

    per_doc = (exact_matches(postings, table, probed).groupBy("doc_id", "text_key")
               .agg(F.array_sort(F.collect_set(F.struct("start", "length"))).alias("at"),
                    F.collect_set("item_ids").alias("item_ids")))
    merged = F.aggregate("at", F.array().cast("array<struct<start:int,end:int>>"), _merge)
    found = per_doc.select(F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key"), merged.alias("spans"),
                           F.array_sort(F.array_distinct(F.flatten("item_ids"))).alias("item_ids"))
    own = postings.filter("pos = -1").select("doc_id", "text_key", "n_words")
    joined = own.join(found, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_key") == F.col("hit_key")), "left")
    hit = F.aggregate(F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")), F.lit(0).cast("long"),
                      lambda acc, s: acc + (s["end"] - s["start"]))
    own_columns = ["doc_id", "text_key", "n_words", "n_hit",
                   F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"), "spans",
                   ((F.col("n_hit") > 0) & (F.col("n_hit") * share_of >= F.col("n_words"))).alias("contaminated")]
    joined = joined.withColumn("n_hit", hit)
    if near:
        close = near_phrases(postings, probed).withColumnsRenamed({"doc_id": "near_id", "text_key": "near_key"})
        joined = joined.join(close, F.col("doc_id").eqNullSafe(F.col("near_id")) & (F.col("text_key") == F.col("near_key")), "left")
        own_columns.append(F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"))
    return joined.select(*own_columns)


def _merge(done: Column, span: Column) -> Column:
    """Add a (start, length) span to merged ranges, in order of start."""
    end = span["start"] + span["length"]
    last = F.element_at(done, -1)
    joins = (F.size(done) > 0) & (F.get(done, F.size(done) - 1)["end"] >= span["start"])
    grown = F.concat(F.slice(done, 1, F.size(done) - 1),
                     F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], end).alias("end"))))
    fresh = F.concat(done, F.array(F.struct(span["start"].alias("start"), end.alias("end"))))
    return F.when(joins, grown).otherwise(fresh)


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns unchanged."""
    bad = (scan(docs, items, id_col, text_col, **options).filter("contaminated")
           .select(F.col("doc_id").alias("bad_id"), F.col("text_key").alias("bad_key")).distinct())
    return docs.join(bad, docs[id_col].eqNullSafe(F.col("bad_id")) & (F.xxhash64(docs[text_col]) == F.col("bad_key")),
                     "left_anti")
