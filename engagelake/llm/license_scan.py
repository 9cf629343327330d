"""Licence scans: sparse n-gram logistic regression over paragraphs, calibrated unknown class, template comparison.

Scored are passages of at most ``PASSAGE`` words: the lines of a text (long ones in
overlapping windows) and, for statements wrapped over lines, windows over the words
of each block of lines between blank ones.  Features are the word uni- and bigrams that
occur in the licence templates (a bounded vocabulary).  A multinomial logistic
regression (Spark ML) is fitted on labelled paragraphs: the templates with words
left out, as their families, and corpus paragraphs without template agreement as
``none``.  Confidence is calibrated by a temperature chosen on held-out labelled
paragraphs; a paragraph under ``LEAST_CONFIDENCE`` is ``unknown``.  A predicted
family is confirmed when the passage has at least ``AGREEMENT`` of a template's
words within a stretch of one and a half times the template's length.

Only passages that agree with a template to ``AGREEMENT`` or have ``EVIDENCE`` different
telling words are scored; all others cannot be confirmed.  To agree, a paragraph must have
one of the ``needed`` words of a template, which is looked for first.  Built-in expressions
and Spark ML only.

Defined results for odd input: null and empty texts have no licence; repeated rows are
scanned alike, each with the result of one; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, written

NONE_SAMPLE = 2_000
LEAST_CONFIDENCE = 0.5
AGREEMENT = 0.6
EVIDENCE = 2
#: Words of a passage and of the step to the next; the longest template has fewer words than a step.
PASSAGE, STEP = 48, 24
NONE = "none"

# Statements by which texts name their licence, per family.
TEMPLATES = {
    "mit": ("Released under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    "apache": ("Licensed under the Apache License, Version 2.0.",
               "you may not use this file except in compliance with the License"),
    "gpl": ("This work is licensed under the GNU General Public License, version 3.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License"),
    "cc": ("Licensed under CC BY-NC 4.0.",
           "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "bsd": ("Redistribution and use in source and binary forms, with or without modification, are permitted",),
    "proprietary": ("All rights reserved.", "Copyright. All rights reserved."),
}
FAMILIES = tuple(TEMPLATES)
_COMMON = frozenset("a and any by can except file for free in is it may not of or the this to under use with without you "
                    "all person source 0 2 3 4 work".split())
SPLIT = "[^a-z0-9]+"


def words(text: Column) -> Column:
    """Lower-case words of a text."""
    return F.filter(F.split(F.lower(text), SPLIT), lambda w: w != "")


def terms(text: Column) -> Column:
    """Lower-case words and word pairs of a paragraph."""
    return let(words(text), with_pairs)


def with_pairs(w: Column) -> Column:
    return F.concat(w, F.when(F.size(w) > 1, F.transform(
        F.sequence(F.lit(0), F.size(w) - 2), lambda i: F.concat_ws(" ", F.get(w, i), F.get(w, i + 1))))
        .otherwise(F.array().cast("array<string>")))


def _template_words() -> list[tuple[str, int, list[str]]]:
    """(family, words in a row, different words) of each template."""
    import re
    found = [(family, [w for w in re.split(SPLIT, t.lower()) if w]) for family, ts in TEMPLATES.items() for t in ts]
    return [(family, len(ws), sorted(set(ws))) for family, ws in found]


def vocabulary() -> list[str]:
    """All words and word pairs of the templates."""
    import re
    out = set()
    for ts in TEMPLATES.values():
        for t in ts:
            w = [x for x in re.split(SPLIT, t.lower()) if x]
            out |= {*w, *(f"{a} {b}" for a, b in zip(w, w[1:]))}
    return sorted(out)


def telling_words() -> list[str]:
    """Vocabulary words that name licences rather than join sentences."""
    return [w for w in vocabulary() if " " not in w and w not in _COMMON]


def needed_words() -> list[str]:
    """Per template, so many of its longest words that no paragraph without any of them reaches ``AGREEMENT``."""
    out = set()
    for _, _, ws in _template_words():
        missing = next(k for k in range(1, len(ws) + 1) if (len(ws) - k) / len(ws) < AGREEMENT)
        out |= set(sorted(ws, key=lambda w: (w in _COMMON, -len(w), w))[:missing])
    return sorted(out | set(telling_words()))


def agreement(words: Column) -> Column:
    """The best-agreeing template: struct (share of its words found close together, family)."""
    placed = F.transform(words, lambda w, i: F.struct(i.alias("at"), w.alias("w")))

    def share(length: int, ws: list[str]) -> Column:
        reach = length + max(2, length // 2)

        def most(hits):
            near = lambda h: F.filter(hits, lambda x: (x["at"] >= h["at"]) & (x["at"] < h["at"] + reach))
            return F.array_max(F.transform(hits, lambda h: F.size(F.array_distinct(F.transform(near(h), lambda x: x["w"])))))
        # words found anywhere bound those found close together: only enough of them are worth a closer look
        anywhere = F.size(F.array_intersect(words, F.array(*map(F.lit, ws))))
        close = F.coalesce(let(F.filter(placed, lambda p: p["w"].isin(*ws)), most), F.lit(0))
        return F.when(anywhere / F.lit(len(ws)) >= AGREEMENT, close).otherwise(anywhere) / F.lit(len(ws))
    return F.array_max(F.array(*[F.struct(share(n, ws).alias("share"), F.lit(family).alias("family"))
                                 for family, n, ws in _template_words()]))


def paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Passages that agree with a template or have ``EVIDENCE`` different telling words: ``doc_id``, ``text_key``, ``wrapped`` (over
    lines, not a line), ``line`` (number of the line or block), ``words``, ``paragraph`` (the words in a row), ``terms``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    needed = F.array(*map(F.lit, needed_words()))
    hint = "(?i)(?<![a-z0-9])(?:" + "|".join(needed_words()) + ")(?![a-z0-9])"
    hinted = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).filter(F.col("text").rlike(hint))
    key = F.xxhash64("text").alias("text_key")
    lines = hinted.select("doc_id", key, F.lit(False).alias("wrapped"), F.posexplode(F.split("text", "\n", -1)).alias("line", "part"))
    blocks = hinted.select("doc_id", key, F.lit(True).alias("wrapped"),
                           F.posexplode(F.split("text", "\n[ \t\r]*\n", -1)).alias("line", "part")).filter(F.col("part").contains("\n"))
    windows = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil((F.size("w") - PASSAGE) / STEP), F.lit(0)).cast("int")),
                          lambda k: F.slice(F.col("w"), k * STEP + 1, PASSAGE))
    found = (lines.unionByName(blocks).filter(F.col("part").rlike(hint)).withColumn("w", words(F.col("part")))
             .select("doc_id", "text_key", "wrapped", "line", F.explode(windows).alias("words"))
             .filter(F.arrays_overlap("words", needed))
             .withColumns({"paragraph": F.array_join("words", " "), "terms": with_pairs(F.col("words"))}))
    evidence = F.size(F.array_intersect("words", F.array(*map(F.lit, telling_words())))) >= EVIDENCE
    return found.filter(evidence | (agreement(F.col("words"))["share"] >= AGREEMENT))


def _labelled(spark, candidates: DataFrame) -> DataFrame:
    """Training paragraphs: every template with each word left out once, and corpus paragraphs that agree with none."""
    import re
    rows = []
    for family, ts in TEMPLATES.items():
        for t in ts:
            w = [x for x in re.split(SPLIT, t.lower()) if x]
            rows += [(family, " ".join(w))] + [(family, " ".join(w[:i] + w[i + 1:])) for i in range(len(w))]
    labelled = spark.createDataFrame(rows, "family string, paragraph string").withColumn("terms", terms(F.col("paragraph")))
    other = (candidates.filter(agreement(F.col("words"))["share"] < AGREEMENT)
             .select("paragraph").distinct().withColumn("terms", terms(F.col("paragraph")))
             .orderBy(F.xxhash64("paragraph"), "paragraph").limit(NONE_SAMPLE).withColumn("family", F.lit(NONE)))
    blank = [(NONE, w) for w in vocabulary()]
    alone = spark.createDataFrame(blank, "family string, paragraph string").withColumn("terms", terms(F.col("paragraph")))
    return labelled.unionByName(other.select("family", "paragraph", "terms")).unionByName(alone)


def _temperature(scored: DataFrame) -> float:
    """The temperature with the smallest held-out log loss."""
    losses = []
    grid = (0.5, 0.75, 1.0, 1.5, 2.0, 3.0)
    for t in grid:
        total = F.aggregate(F.transform("raw", _scaled(t)), F.lit(0.0), lambda a, x: a + x)
        own = _scaled(t)(F.get("raw", F.col("label").cast("int")))
        losses.append(F.avg(-F.log(own / total)).alias(f"t{len(losses)}"))
    row = scored.agg(*losses).first()
    return min(zip(row, grid), key=lambda x: (x[0] is None, x[0]))[1]


def _scaled(t):
    return lambda x: F.exp(x / F.lit(t))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per found passage: ``doc_id``, ``text_key``, ``wrapped``, ``line``, ``paragraph``, ``family`` (or ``unknown``),
    ``confidence``, ``agreement``, ``confirmed``."""
    spark = docs.sparkSession
    candidates = written(paragraphs(docs, id_col, text_col), "paragraphs")
    names = [NONE, *FAMILIES]
    index = F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(n), F.lit(float(i)))])
    vectorizer = CountVectorizerModel.from_vocabulary(vocabulary(), inputCol="terms", outputCol="features")
    vectorizer.setBinary(True)
    labelled = vectorizer.transform(_labelled(spark, candidates).withColumn("label", index[F.col("family")]))
    labelled = written(labelled.withColumn("held", F.pmod(F.xxhash64("paragraph"), F.lit(5)) == 0).coalesce(1), "labelled")
    model = LogisticRegression(family="multinomial", regParam=0.002, elasticNetParam=0.5, maxIter=60).fit(
        labelled.filter("not held"))
    held = model.transform(labelled.filter("held")).select("label", vector_to_array("rawPrediction").alias("raw"))
    t = _temperature(held)
    raw = vector_to_array("rawPrediction")
    scored = model.transform(vectorizer.transform(candidates)).withColumn("e", F.transform(raw, _scaled(t)))
    total = F.aggregate("e", F.lit(0.0), lambda a, x: a + x)
    best = F.array_max("e")
    family = F.get(F.array(*map(F.lit, names)), F.array_position("e", best).cast("int") - 1)
    scored = scored.withColumns({"confidence": best / total, "likely": family, "match": agreement(F.col("words"))})
    confirmed = (F.col("likely") == F.col("match.family")) & (F.col("match.share") >= AGREEMENT)
    return (scored.filter(F.col("likely") != NONE)
            .select("doc_id", "text_key", "wrapped", "line", "paragraph",
                    F.when(F.col("confidence") >= LEAST_CONFIDENCE, F.col("likely")).otherwise("unknown").alias("family"),
                    "confidence", F.col("match.share").alias("agreement"), confirmed.alias("confirmed")))


def by_document(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: ``doc_id``, ``families`` (confirmed, sorted), ``n_paragraphs`` (lines that speak of a licence),
    ``n_unknown`` (those without a confirmed passage)."""
    sure = F.col("confirmed") & (F.col("family") != "unknown")
    by_line = scan(docs, id_col, text_col).groupBy("doc_id", "text_key", "wrapped", "line").agg(
        F.collect_set(F.when(sure, F.col("family"))).alias("sure"), F.bool_or("confirmed").alias("confirmed"))
    found = (by_line.groupBy("doc_id", "text_key")
             .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("sure")))).alias("families"),
                  F.count_if(~F.col("wrapped")).alias("n_paragraphs"),
                  F.count_if(~F.col("wrapped") & ~F.col("confirmed")).alias("n_unknown"))
             .withColumnsRenamed({"doc_id": "found_id", "text_key": "found_key"}))
    own = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key"))
    joined = own.join(found, F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("text_key") == F.col("found_key")), "left")
    return joined.select("doc_id", F.coalesce("families", F.array().cast("array<string>")).alias("families"),
                         F.coalesce("n_paragraphs", F.lit(0).cast("long")).alias("n_paragraphs"),
                         F.coalesce("n_unknown", F.lit(0).cast("long")).alias("n_unknown"))
