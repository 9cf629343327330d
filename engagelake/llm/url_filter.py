"""URL filters: prefix rules first, gradient-boosted trees on lexical features for the rest.

A rule names a host and a path: it fits the host and its subdomains when the URL's
path begins with the rule's; the longest fitting rule decides.  URLs without a rule
are judged by boosted trees (Spark ML) over lexical features: lengths, depth, digit
ratio, entropy, parameter counts, host hyphens and the block rate of the host's
suffixes among labelled URLs.

Labels for the fit are weak: a rule's verdict, else block for a host with a
``SEED_BLOCK`` word, else allow.  The trees are fitted on at most ``SAMPLE`` URLs of
each class, the smallest hashes; suffix rates are counted over all URLs.  Built-in expressions and Spark ML only, no user functions.

Defined results for odd input: a null URL or one without ``://`` has empty host
and path and no rule, and is judged as such; repeated rows are judged alike;
without labelled URLs of both classes the verdict is ``allow``; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, written

SAMPLE = 4_000
TREES = 12
DEPTH = 4


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)
# Words of host names that label a URL as unwanted.
SEED_BLOCK = ("casino", "pills", "bets", "adult", "spam", "ads-track")
FEATURES = ("url_length", "host_length", "host_labels", "host_hyphens", "path_length", "depth", "digit_ratio", "entropy",
            "parameters", "suffix_rate", "second_rate")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), "^(?s:.*?)://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule as a struct (rule, verdict); null without one."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(out)
    return out


def _entropy(text: Column) -> Column:
    """Bits per character, over the distinct characters."""
    n = F.greatest(F.length(text), F.lit(1)).cast("double")

    def term(c):
        p = (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / n
        return F.when(p > 0, -p * F.log2(p)).otherwise(0.0)
    chars = F.array_distinct(F.split(text, ""))
    return F.aggregate(F.transform(chars, term), F.lit(0.0), lambda a, x: a + x)


def lexical(pages: DataFrame, id_col: str, url_col: str) -> DataFrame:
    """``page_id``, ``url``, ``host``, ``path``, suffixes and lexical features."""
    url = F.coalesce(F.col("url"), F.lit(""))
    rest = F.regexp_replace(url, "^(?s:.*?)://[^/?#]*", "")
    base = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).withColumns(
        {"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    labels = F.split("host", "\\.")
    return base.withColumns({
        "suffix": F.element_at(labels, -1),
        "second": F.substring_index("host", ".", -2),
        "url_length": F.length(url).cast("double"),
        "host_length": F.length("host").cast("double"),
        "host_labels": F.size(labels).cast("double"),
        "host_hyphens": F.regexp_count("host", F.lit("-")).cast("double"),
        "path_length": F.length("path").cast("double"),
        "depth": F.regexp_count("path", F.lit("/")).cast("double"),
        "digit_ratio": F.regexp_count(url, F.lit("[0-9]")) / F.greatest(F.length(url), F.lit(1)),
        "entropy": let(rest, _entropy),
        "parameters": F.regexp_count(url, F.lit("[?&][^=&#]*=")).cast("double")})


def suffix_rates(labelled: DataFrame, column: str) -> DataFrame:
    """Smoothed share of blocked URLs by a suffix column, over all labelled URLs."""
    return (labelled.groupBy(column).agg(((F.sum("label") + 1.0) / (F.count(F.lit(1)) + 2.0)).alias(f"{column}_rate")))


def classify(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, sample: int = SAMPLE) -> DataFrame:
    """Per row: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``block_probability`` (null under a rule)."""
    known = lexical(pages, id_col, url_col).withColumn("found", matching_rule(F.col("host"), F.col("path"), rules))
    known = written(known.select("*", "found.rule", F.col("found.verdict").alias("ruled")).drop("found"), "urls")
    seeded = F.col("host").rlike("(^|[.-])(" + "|".join(SEED_BLOCK) + ")")
    labelled = known.withColumn("label", F.when(F.col("ruled") == "allow", 0.0).when(F.col("ruled") == "block", 1.0)
                                .when(seeded, 1.0).otherwise(0.0))
    first, second = suffix_rates(labelled, "suffix"), suffix_rates(labelled, "second")

    def featured(df):
        return (df.join(first, "suffix", "left").join(second, "second", "left")
                .fillna(0.5, ["suffix_rate", "second_rate"]))
    chosen = None
    for label in (0.0, 1.0):
        part = labelled.filter(F.col("label") == label).orderBy(F.xxhash64("url"), "url").limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)
    train = written(featured(chosen).select(*FEATURES, "label").coalesce(1), "train")
    classes = [r[0] for r in train.select("label").distinct().collect()]
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    scored = featured(known)
    if len(classes) < 2:
        scored = scored.withColumn("p", F.lit(0.0))
    else:
        model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=7, maxMemoryInMB=64).fit(assembler.transform(train))
        scored = (model.transform(assembler.transform(scored))
                  .withColumn("p", vector_to_array("probability")[1]))
    own = F.when(F.col("p") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select("page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"),
                         F.when(F.col("rule").isNull(), F.col("p")).alias("block_probability"))
