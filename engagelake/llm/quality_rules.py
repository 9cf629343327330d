"""Quality rules: a threshold table compiled into one projection of built-in expressions.

A rule bounds one document metric (``low <= metric <= high``); a document is
kept when no rule fails.  All metrics and rules of a document are computed in
a single projection: no shuffle, no user function, whole texts.

Defined results for odd input: a null, empty or blank text has zero words and
fails; repeated rows are judged alike, one result per row; an empty table gives
an empty result; extra columns of the input are ignored by :func:`measure`
and passed through unchanged by :func:`keep_good`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, let, temp_name, words_of

# Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in a is that it for was on be as with by this are at an from or not have "
    "de la que el en y los del se las un por con no una su para es "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine "
    "le les et des du une est dans qui par pour au sur pas plus"
).split()

#: As words begin a sentence or not; other capitals are not counted.
STOP_FORMS = tuple(STOP_WORDS) + tuple(w.capitalize() for w in STOP_WORDS)

#: Positions of a window share a BIGINT with the window's hash; longer documents take a wider key.
POSITION_BITS = 21


@dataclass(frozen=True)
class Rule:
    """``metric`` must lie in [low, high]; None leaves a side open."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None


#: Hard floor of the registered query, kept apart because its two bounds are exact integer comparisons.
BASE_MIN_WORDS = 50
BASE_MAX_REPEAT_PERCENT = 50

RULES = (
    Rule("word_count", "n_words", 50, None),
    Rule("mean_word_length", "mean_word_length", 2.0, 14.0),
    Rule("symbols", "symbol_ratio", None, 0.10),
    Rule("capitals", "capital_ratio", None, 0.30),
    Rule("exclamations", "exclamation_ratio", None, 0.10),
    Rule("stop_words", "stop_ratio", 0.02, None),
    Rule("repeated_lines", "dup_line_ratio", None, 0.50),
    Rule("repeated_words", "repeat_ratio", None, 0.50),
    Rule("ellipsis_lines", "ellipsis_line_ratio", None, 0.30),
)


def _covered(words: Column) -> Column:
    """Number of words that lie in a three-word window found twice or more."""
    mask = (1 << POSITION_BITS) - 1
    n = F.size(words)

    def windows(key):
        return F.transform(F.sequence(F.lit(0), n - 3), key)

    def window_hash(i):
        return F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))

    def same(p, q):                # hashes agree; the words decide
        return ((F.get(words, p) == F.get(words, q)) & (F.get(words, p + 1) == F.get(words, q + 1))
                & (F.get(words, p + 2) == F.get(words, q + 2)))

    def packed_pairs(s):           # neighbours with equal upper bits
        return F.zip_with(s, F.slice(s, 2, F.size(s)), lambda a, b: F.when(
            F.shiftright(a, POSITION_BITS) == F.shiftright(b, POSITION_BITS),
            F.array(a.bitwiseAND(F.lit(mask)).cast("int"), b.bitwiseAND(F.lit(mask)).cast("int"))))

    def wide_pairs(s):
        return F.zip_with(s, F.slice(s, 2, F.size(s)),
                          lambda a, b: F.when(a["h"] == b["h"], F.array(a["p"], b["p"])))

    packed = let(F.sort_array(windows(lambda i: window_hash(i).bitwiseAND(F.lit(~mask)).bitwiseOR(i.cast("long")))),
                 packed_pairs)
    wide = let(F.sort_array(windows(lambda i: F.struct(window_hash(i).alias("h"), i.alias("p")))), wide_pairs)
    pairs = F.filter(F.when(n <= mask, packed).otherwise(wide),
                     lambda p: p.isNotNull() & same(F.get(p, F.lit(0)), F.get(p, F.lit(1))))
    starts = F.sort_array(F.array_distinct(F.flatten(pairs)))
    covered = let(starts, lambda d: F.aggregate(
        F.zip_with(d, F.slice(d, 2, F.size(d) + 1), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3)))),
        F.lit(0).cast("long"), lambda acc, x: acc + x))
    return F.when(n >= 4, covered).otherwise(F.lit(0).cast("long"))


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def metrics(text: Column) -> Column:
    """Struct of the counts and ratios that rules may name."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.btrim(x, F.lit(WHITE)) != "")

    def of_words(w):
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _covered(w).alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: x.isin(*STOP_FORMS))).cast("long").alias("n_stop"))

    def of_lines(x):
        return F.struct(
            F.size(x).cast("long").alias("n_lines"),
            _count(t, "[#*$%&|<>]").alias("n_symbols"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            F.size(F.filter(x, lambda y: y.endswith("...") | y.endswith("…"))).cast("long").alias("n_ellipsis"))

    def ratio(part, whole):
        return F.coalesce(part / F.nullif(whole, F.lit(0).cast("long")), F.lit(0.0))

    def all_of(w, x):
        return F.struct(
            w["n_words"].alias("n_words"), w["word_chars"].alias("word_chars"),
            x["n_symbols"].alias("n_symbols"), x["n_dup_lines"].alias("n_dup_lines"),
            w["n_repeat_words"].alias("n_repeat_words"),
            ratio(w["word_chars"], w["n_words"]).alias("mean_word_length"),
            ratio(x["n_symbols"], w["n_words"]).alias("symbol_ratio"),
            ratio(_count(t, "\\p{Lu}{2,}"), w["n_words"]).alias("capital_ratio"),
            ratio(_count(t, "!{2,}"), w["n_words"]).alias("exclamation_ratio"),
            ratio(w["n_stop"], w["n_words"]).alias("stop_ratio"),
            ratio(x["n_dup_lines"], x["n_lines"]).alias("dup_line_ratio"),
            ratio(w["n_repeat_words"], w["n_words"]).alias("repeat_ratio"),
            ratio(x["n_ellipsis"], x["n_lines"]).alias("ellipsis_line_ratio"))

    return let(let(words_of(text), of_words), lambda w: let(let(lines, of_lines), lambda x: all_of(w, x)))


def failed_rules(measured: Column, rules=RULES) -> Column:
    """Names of the rules that a struct of metrics breaks, in table order."""
    tests = []
    for rule in rules:
        bad = F.lit(False)
        if rule.low is not None:
            bad = bad | (measured[rule.metric] < F.lit(rule.low))
        if rule.high is not None:
            bad = bad | (measured[rule.metric] > F.lit(rule.high))
        tests.append(F.when(bad, F.lit(rule.name)))
    return F.array_compact(F.array(*tests))


def verdict(text: Column, rules=RULES) -> Column:
    """Struct: the metrics, ``failed`` (rule names), ``base_failed`` and ``kept``."""
    def judge(m):
        base = ((m["n_words"] < BASE_MIN_WORDS)
                | (m["n_repeat_words"] * 100 > m["n_words"] * BASE_MAX_REPEAT_PERCENT))
        return let(failed_rules(m, rules), lambda f: F.struct(
            m.alias("metrics"), f.alias("failed"), base.alias("base_failed"),
            (~base & (F.size(f) == 0)).alias("kept")))
    return let(metrics(text), judge)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """One row per document: id, every metric, ``failed``, ``base_failed``, ``kept``."""
    return (docs.select(F.col(id_col).alias("doc_id"), verdict(F.col(text_col), rules).alias("v"))
            .select("doc_id", "v.metrics.*", "v.failed", "v.base_failed", "v.kept"))


def keep_good(docs: DataFrame, text_col: str = "text", rules=RULES) -> DataFrame:
    """The rows of ``docs`` that pass every rule, all columns unchanged."""
    flag = temp_name(docs, "kept")
    return docs.withColumn(flag, verdict(F.col(text_col), rules)["kept"]).filter(F.col(flag)).drop(flag)
