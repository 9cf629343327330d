"""Schema-free JSON operators over a JSON text column, as Spark jobs.

Documents are parsed to VARIANT and walked with a recursive CTE
(``LATERAL variant_explode`` per level): every node of every document is
visited, whatever the depth, distributed over the documents' partitions.
The recursion guards of the session are lifted for the walk: they exist to
stop runaway recursion, while a walk over finite documents always ends.

* ``harvest``: string values stored under given member names, at any depth
  (a match is still descended into), as a distinct set; needs no walk.
* ``extract_records``: the record list of a response -- the value itself if
  it is a list, else the first of the container members holding a list.
* ``shape``: per path and JSON type, node counts and array lengths; members
  with a sensitive name are reported as redacted and not descended into.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engagelake.constants import RECORD_CONTAINER_KEYS
from engagelake.operators.privacy import SENSITIVE_PATTERN

_UNLIMITED = {"spark.sql.cteRecursionRowLimit": "-1", "spark.sql.cteRecursionLevelLimit": "-1"}


def _lift_recursion_guards(spark) -> None:
    for k, v in _UNLIMITED.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


def _view(df: DataFrame) -> str:
    name = f"_json_docs_{uuid.uuid4().hex[:10]}"
    df.createOrReplaceTempView(name)
    return name


def walk(docs: DataFrame, id_cols: Sequence[str], json_col: str, descend_sensitive: bool = True,
         keep: str | None = None, with_path: bool = True) -> DataFrame:
    """All nodes ``(ids..., path, key, node, depth)``; ``key`` is the member
    name (null for array elements and the root).  ``keep`` (SQL over ``e.key``
    and ``e.value``) restricts the scalar nodes carried to the next level;
    objects and arrays are always kept, as they are walked further.
    ``with_path=False`` skips building the path text of every node."""
    spark = docs.sparkSession
    _lift_recursion_guards(spark)
    src = _view(docs.select(*id_cols, F.col(json_col).alias("_json")))
    ids = ", ".join(f"`{c}`" for c in id_cols)
    wids = ", ".join(f"w.`{c}`" for c in id_cols)
    conds = []
    if not descend_sensitive:
        conds.append(f"(w.key IS NULL OR NOT (lower(w.key) RLIKE '{SENSITIVE_PATTERN}'))")
    if keep:
        conds.append("(schema_of_variant(e.value) LIKE 'OBJECT%' OR schema_of_variant(e.value) LIKE 'ARRAY%' "
                     f"OR ({keep}))")
    stop = ("WHERE " + " AND ".join(conds)) if conds else ""
    path_expr = ("CASE WHEN e.key IS NULL THEN w.path || '[]' ELSE w.path || '.' || e.key END" if with_path
                 else "CAST(NULL AS STRING)")
    return spark.sql(f"""
        WITH RECURSIVE nodes({ids}, path, key, node, depth) AS (
          SELECT {ids}, {"'$'" if with_path else "CAST(NULL AS STRING)"}, CAST(NULL AS STRING),
                 try_parse_json(_json), 0 FROM {src}
          UNION ALL
          SELECT {wids},
                 {path_expr},
                 e.key, e.value, w.depth + 1
          FROM nodes w, LATERAL variant_explode(w.node) e
          {stop}
        )
        SELECT * FROM nodes WHERE node IS NOT NULL""")


def json_type(node) -> F.Column:
    """JSON type name of a VARIANT node."""
    t = F.schema_of_variant(node)
    return (F.when(t.startswith("OBJECT"), "object").when(t.startswith("ARRAY"), "array")
             .when(t == "STRING", "string").when(t == "BOOLEAN", "bool").when(t == "VOID", "null")
             .when(t.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), "int").otherwise("float"))


def harvest(docs: DataFrame, id_cols: Sequence[str], json_col: str, names: Sequence[str],
            value_name: str = "value") -> DataFrame:
    """Distinct string values held under any of ``names``, at any depth.

    One pass, whatever the depth: a parsed document written out again is compact, and there a member name follows
    ``{`` or ``,`` and stands between bare quotes, which inside a string are escaped; so the pattern matches
    members and nothing else.  Of members that a document repeats the last one counts.  Documents without one of
    the names spelled out, or an escape that may hide it, are skipped unparsed -- an exact filter."""
    text = F.col(json_col)
    may_hold = text.contains("\\")
    for n in names:
        may_hold = may_hold | text.contains(n)
    listed = "|".join(re.escape(json.dumps(n, ensure_ascii=False)[1:-1]) for n in names)
    member = F.lit(r'[{,]"(?:' + listed + r')":"((?:[^"\\]|\\.)*+)"')
    compact = F.try_parse_json(text).cast("string")
    return (docs.filter(may_hold).select(F.explode(F.regexp_extract_all(compact, member, F.lit(1))).alias("_raw")).distinct()
            .select(F.variant_get(F.parse_json(F.concat(F.lit('"'), "_raw", F.lit('"'))), "$", "string").alias(value_name))
            .distinct())


def extract_records(docs: DataFrame, json_col: str) -> DataFrame:
    """Adds ``records`` (array<variant>): list payload as is, else the first
    container member that holds a list, else empty."""
    v = F.try_parse_json(F.col(json_col))
    candidates = [F.try_variant_get(v, "$", "array<variant>")]
    candidates += [F.try_variant_get(v, f"$.{k}", "array<variant>") for k in RECORD_CONTAINER_KEYS]
    return docs.withColumn("records", F.coalesce(*candidates, F.array().cast("array<variant>")))


#: Structures that ``schema_of_variant`` writes without quoted names and arrays, so that they tell a document's every node.
_PLAIN_FORM = r"^[A-Za-z0-9_:,<>() ]*$"
_SAMPLES = (("[A-Z]+\\([0-9, ]+\\)", "DOUBLE"), (r"(\w+): ", r'"$1":'), (r"(^|:)OBJECT<", "$1{"), (">", "}"),
            (r"(^|:)STRING\b", r'$1""'), (r"(^|:)(?:BIGINT|INT|SMALLINT|TINYINT)\b", "$1-1"), (r"(^|:)BOOLEAN\b", "$1true"),
            (r"(^|:)VOID\b", "$1null"), (r"(^|:)(?:DOUBLE|FLOAT)\b", "$1-0.5"))


def _samples(docs: DataFrame, json_col: str) -> DataFrame:
    """``(json, times)``: documents that stand for all of ``docs`` in a count of nodes by path and type.

    Documents without arrays count by their structure, combined map-side, and a document is written for each
    structure; those with arrays, or with names that need quotes, stand for themselves."""
    form = F.schema_of_variant(F.try_parse_json(json_col))
    plain = F.col("_form").rlike(_PLAIN_FORM) & ~F.col("_form").contains("ARRAY<")
    told = docs.select(json_col, form.alias("_form")).filter(F.col("_form").isNotNull()).select(
        plain.alias("_plain"), F.when(plain, F.col("_form")).otherwise(F.col(json_col)).alias(json_col))
    counted = told.groupBy("_plain", json_col).agg(F.count(F.lit(1)).alias("times"))
    sample = F.col(json_col)
    for pattern, text in _SAMPLES:
        sample = F.regexp_replace(sample, pattern, text)
    return counted.select(F.when(F.col("_plain"), sample).otherwise(F.col(json_col)).alias(json_col), "times")


def shape(docs: DataFrame, json_col: str) -> DataFrame:
    """Per ``(path, json_type, redacted)``: node count and array length range."""
    nodes = walk(_samples(docs, json_col), ["times"], json_col, descend_sensitive=False)
    redacted = F.col("key").isNotNull() & F.lower("key").rlike(SENSITIVE_PATTERN)
    typed = nodes.select("path", json_type(F.col("node")).alias("json_type"), redacted.alias("redacted"), "times",
                         F.when(F.schema_of_variant("node").startswith("ARRAY"),
                                F.array_size(F.try_variant_get("node", "$", "array<variant>"))).alias("_len"))
    return typed.groupBy("path", "json_type", "redacted").agg(
        F.sum("times").alias("n_nodes"), F.min("_len").alias("min_length"), F.max("_len").alias("max_length"))


def merged_schema(docs: DataFrame, json_col: str) -> DataFrame:
    """One row: the schema that fits every document (``schema_of_variant_agg``;
    partial schemas merge map-side, so it is one pass over any volume)."""
    return docs.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(json_col))).alias("merged_schema"))
