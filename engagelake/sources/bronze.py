"""Bronze layer: response envelopes, landing and the record-by-record scan.

Landing writes **JSON Lines** (one envelope per line, splittable) under
``<root>/<dataset>/ingest_date=<d>/run_id=<run>/``.  The folders only route;
the envelope body keeps ``media_id`` and ``channel`` itself, so a recursive
read (which ignores folder names) loses nothing.  There is deliberately no
per-media folder level: with many media it would multiply small files
without helping any reader.

Reading takes both layouts, one envelope a line and one (pretty-printed)
document a file, without being told which: a file of up to ``WHOLE_FILE_BYTES``
is one row of text, cut into lines unless it is one document; larger files are
read by lines, in splits, and compressed ones (as ``land`` writes them) by lines.  Every record of a payload is decoded on its own
against its declared schema.  What does not fit -- a line that is not JSON, a
payload of another kind, one record of a page -- becomes a reject with file,
position, reason and raw text, and costs nothing but itself.

Envelopes are built by Spark from record frames: records are numbered within
their routing key (``operators.aggregate.numbered``, so a hot one is spread
over many tasks) and cut into pages by their number.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql import types as T

from engagelake.constants import DEFAULT_PAGE_SIZE, FILE_PART_UNSAFE, SOURCE_NAME
from engagelake.functions.scalar import iso_date, sanitize_file_part
from engagelake.operators.aggregate import numbered
from engagelake.schemas import CORRUPT, ENVELOPE_FIELDS, PAYLOADS, envelope, struct
from engagelake.sources.files import path_exists

ROUTING = ["ingest_date", "run_id"]

#: Files up to this size are read whole, so that one may be a single document; larger ones hold one envelope a line.
WHOLE_FILE_BYTES = 32 << 20
#: Landed files are compressed, so not split; they hold so many envelopes at most (some 45 kB each as text) and are read by lines.
LINES_PER_FILE = 4000
LINES_PER_FILE_OF_ONE_RUN = 500       # where a single run is read back, its files are all the tasks there are
LANDED = "*.{json,json.gz}"
BLANK = " \t\r\n"
NOT_JSON = "not JSON"
NOT_AN_ENVELOPE = "not an envelope"
NOT_A_LIST = "payload is not a list"
NOT_AN_OBJECT = "not an object"
OTHER_STRUCTURE = "a field has another structure than declared"
RUN_ID_TEXT = '"pipeline_run_id"\\s*:\\s*"([^"]*)"'
REJECT = T.ArrayType(struct(("position", T.IntegerType()), ("reason", T.StringType()), ("raw", T.StringType())))


class BronzeError(RuntimeError):
    pass


def new_run_id(now: dt.datetime | None = None) -> str:
    """Run id ``yyyyMMddTHHmmssZ-<8 hex>`` (UTC), one per run."""
    now = (now or dt.datetime.now(dt.timezone.utc)).astimezone(dt.timezone.utc)
    return f"{now:%Y%m%dT%H%M%SZ}-{uuid.uuid4().hex[:8]}"


def record_file_part(key: Column) -> Column:
    """File-name part for a record key: ``/`` first becomes ``_``, then runs of
    unsafe characters become one ``_``."""
    return sanitize_file_part(F.regexp_replace(key, "/", "_"))


def run_stamp(ts: Column) -> Column:
    """ISO-8601 text with explicit UTC offset, as landed in ``ingested_at``."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def page_records(records: DataFrame, group_cols: Sequence[str], order_col: str,
                 per_page: int = DEFAULT_PAGE_SIZE) -> DataFrame:
    """Adds ``page`` (from 1, without gaps within the group): ``per_page``
    records a page, the last one fewer.  Pages depend on the records alone, not
    on partitions, and no task holds a whole group."""
    return (numbered(records, group_cols, order_col, "_number")
            .withColumn("page", F.floor((F.col("_number") - 1) / F.lit(per_page)).cast("long") + 1).drop("_number"))


def envelopes(records: DataFrame, *, dataset: str, endpoint: str, run_id: Column, ingested_at: Column,
              media_id: Column | None, channel: Column | None, record_cols: Sequence[str],
              request_params: Column | None = None, array_payload: bool = True,
              group_cols: Sequence[str] = ()) -> DataFrame:
    """One envelope per group: ``payload`` = list of the group's records
    (``array_payload``) or the single record struct."""
    rec = F.struct(*[F.col(c) for c in record_cols])
    keyed = records.select(
        *group_cols,
        run_id.alias("pipeline_run_id"), ingested_at.alias("ingested_at"),
        (media_id if media_id is not None else F.lit(None).cast("string")).alias("media_id"),
        (channel if channel is not None else F.lit(None).cast("string")).alias("channel"),
        (request_params if request_params is not None
         else F.create_map().cast("map<string,string>")).alias("request_params"),
        rec.alias("_rec"))
    keys = ["pipeline_run_id", "ingested_at", "media_id", "channel", *group_cols]
    if array_payload:
        grouped = keyed.groupBy(*keys).agg(F.first("request_params").alias("request_params"),
                                           F.collect_list("_rec").alias("payload"))
    else:
        grouped = keyed.withColumnRenamed("_rec", "payload")
    return grouped.select(
        "pipeline_run_id", "ingested_at", F.lit(SOURCE_NAME).alias("source"), F.lit(dataset).alias("dataset"),
        "media_id", "channel", F.lit(endpoint).alias("endpoint"), "request_params", "payload")


def land(env: DataFrame, root: str, dataset: str, finish: Callable[[DataFrame], DataFrame] | None = None,
         lines_per_file: int = LINES_PER_FILE) -> str:
    """Append envelopes as JSON Lines below ``root/dataset`` (routing folders).

    ``finish`` completes the payload after the rows were dealt to the files, so that what it
    derives from a row itself is not shuffled."""
    out = f"{root.rstrip('/')}/{dataset}"
    routed = env.select(
        "*",
        iso_date("ingested_at").cast("string").alias("ingest_date"),
        sanitize_file_part("pipeline_run_id").alias("run_id"))
    dealt = routed.hint("rebalance", *ROUTING)
    ((finish(dealt) if finish else dealt)
           .write.mode("append").option("maxRecordsPerFile", lines_per_file).partitionBy(*ROUTING)
           .json(out, compression="gzip"))
    return out


def run_folder(root: str, dataset: str, ingest_date: str, run_id: str) -> str:
    """Landing folder of one run of one dataset (the routing of ``land``)."""
    return f"{root.rstrip('/')}/{dataset}/ingest_date={ingest_date}/run_id={file_part(run_id)}"


def file_part(name: str) -> str:
    return re.sub(FILE_PART_UNSAFE, "_", name)


def _text(spark: SparkSession, path: str, pattern: str, whole: bool) -> DataFrame:
    return (spark.read.text(path, wholetext=whole, recursiveFileLookup=True, pathGlobFilter=pattern)
            .select(F.col("value").alias("raw"), F.col("_metadata.file_path").alias("source_file"),
                    F.col("_metadata.file_size").alias("_size"), F.col("_metadata.file_name").alias("_name")))


def is_small(whole_file_bytes: int = WHOLE_FILE_BYTES) -> Column:
    """Whether a file (``_size``, ``_name``) is read whole; of a compressed one the text may be of any size."""
    return (F.col("_size") <= whole_file_bytes) & ~F.col("_name").endswith(".gz")


def _as_json(text: Column, schema: T.StructType) -> Column:
    """``text`` by ``schema``; what does not fit leaves its raw text in the corrupt column."""
    return F.from_json(text, T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]),
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def _starts(text: Column, mark: str) -> Column:
    return F.coalesce(F.ltrim(text).startswith(mark), F.lit(False))


ENVELOPE_TEXT = struct(*[(name, T.StringType()) for name, _ in ENVELOPE_FIELDS], ("payload", T.StringType()))


def _parses(text: Column) -> Column:
    return _starts(text, "{") & _as_json(text, ENVELOPE_TEXT)[CORRUPT].isNull()


def documents_of(files: DataFrame) -> DataFrame:
    """Whole files (``raw``) -> one row per document: the lines, or the file where it is a single document.

    The first line decides if it is an envelope by itself; else the file, if it
    parses; a file where neither does is cut into lines if any looks like an
    envelope, and stays whole otherwise (one reject instead of one a line)."""
    text = F.btrim("raw", F.lit(BLANK))
    first = F.substring_index(F.col("_text"), "\n", 1)
    by_line = (F.when(_parses(first), True).when(_parses(F.col("_text")), False)
               .otherwise(F.col("_text").rlike(r"(?m)^\s*\{.+\}\s*$")))
    return (files.withColumn("_text", text).filter(F.col("_text") != "")
            .withColumn("raw", F.explode(F.when(by_line, F.split("_text", "\n")).otherwise(F.array("_text"))))
            .drop("_text"))


def decode(documents: DataFrame, dataset: str) -> DataFrame:
    """One envelope document a row (``raw``) -> envelope columns, ``payload`` with its sound records, ``rejects``.

    A document that is no envelope keeps the run id that could be read, a null payload and one reject without
    position; a record that does not fit its schema is a reject at its position in the payload."""
    schema = PAYLOADS[dataset]
    listed = isinstance(schema, T.ArrayType)
    record = schema.elementType if listed else schema
    entire = T.StructType([T.StructField(CORRUPT, T.StringType()), *envelope(dataset).fields])
    read = documents.filter(F.btrim("raw", F.lit(BLANK)) != "").withColumn("_w", F.from_json(
        F.col("raw"), entire, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
    w = F.col("_w")
    # an envelope that fits as a whole needs no look at its parts
    fits = (_starts(F.col("raw"), "{") & w[CORRUPT].isNull() & w["payload"].isNotNull()
            & (~F.exists(w["payload"], lambda r: r.isNull()) if listed else F.lit(True)))
    opened = (read.withColumn("_fits", F.coalesce(fits, F.lit(False)))
              .withColumn("_e", F.when(~F.col("_fits"), _as_json(F.col("raw"), ENVELOPE_TEXT))))
    e, payload = F.col("_e"), F.col("_e.payload")
    fault = (F.when(~_starts(F.col("raw"), "{") | e[CORRUPT].isNotNull(), F.lit(NOT_JSON))
             .when(e["pipeline_run_id"].isNull() & e["ingested_at"].isNull() & payload.isNull(), F.lit(NOT_AN_ENVELOPE)))
    if listed:
        fault = F.coalesce(fault, F.when(payload.isNotNull() & ~_starts(payload, "["), F.lit(NOT_A_LIST)))
        texts = F.from_json(payload, T.ArrayType(T.StringType()))
    else:
        texts = F.array(payload)
    faulted = opened.withColumn("_fault", F.when(~F.col("_fits"), fault))
    records = F.when(~F.col("_fits") & F.col("_fault").isNull() & payload.isNotNull(), F.transform(texts, lambda text, at: F.struct(
        at.alias("position"), text.alias("raw"), _as_json(text, record).alias("record"))))
    written_id = F.nullif(F.regexp_extract("raw", RUN_ID_TEXT, 1), F.lit(""))      # of a document that broke off
    parsed = faulted.withColumn("_records", records)

    def reason(r):
        return (F.when(~_starts(r["raw"], "{"), F.lit(NOT_AN_OBJECT))
                .when(r["record"][CORRUPT].isNotNull(), F.lit(OTHER_STRUCTURE)))
    sound = F.transform(F.filter("_records", lambda r: reason(r).isNull()),
                        lambda r: F.struct(*[r["record"][f.name].alias(f.name) for f in record.fields]))
    bad = F.transform(F.filter("_records", lambda r: reason(r).isNotNull()),
                      lambda r: F.struct(r["position"].alias("position"), reason(r).alias("reason"), r["raw"].alias("raw")))
    faults = F.array(F.struct(F.lit(None).cast("int").alias("position"), F.col("_fault").alias("reason"), F.col("raw")))
    def either(whole, part):
        return F.when(F.col("_fits"), whole).otherwise(part)
    fields = [either(w[name], F.from_json(e[name], kind) if isinstance(kind, T.MapType) else e[name]).alias(name)
              for name, kind in ENVELOPE_FIELDS[1:]]
    run_id = F.when(F.col("_fits"), w["pipeline_run_id"]).when(F.col("_fault").isNull(), e["pipeline_run_id"]).otherwise(F.coalesce(e["pipeline_run_id"], written_id))
    return parsed.select(run_id.alias("pipeline_run_id"), *fields, either(w["payload"], sound if listed else F.get(sound, F.lit(0))).alias("payload"),
                         F.when(F.col("_fault").isNotNull(), faults).otherwise(F.coalesce(bad, F.array().cast(REJECT)))
                         .cast(REJECT).alias("rejects"),
                         F.col("_fault").isNull().alias("is_envelope"), "source_file")


def decoded(spark: SparkSession, root: str, dataset: str, path: str | None = None, pattern: str = LANDED,
            whole_file_bytes: int = WHOLE_FILE_BYTES) -> DataFrame:
    """Scan of one bronze dataset, decoded (see :func:`decode`); a missing folder gives no rows.

    ``path`` narrows the scan to one run's folder (``run_folder``).  The file
    size is a metadata filter, so each file is read by one of the two scans."""
    path = path or f"{root.rstrip('/')}/{dataset}"
    if not path_exists(spark, path):
        empty = T.StructType([T.StructField("raw", T.StringType()), T.StructField("source_file", T.StringType())])
        return decode(spark.createDataFrame([], empty), dataset)
    small = documents_of(_text(spark, path, pattern, True).filter(is_small(whole_file_bytes)))
    large = _text(spark, path, pattern, False).filter(~is_small(whole_file_bytes))
    return decode(small.unionByName(large).drop("_size", "_name"), dataset)


def envelopes_of(frame: DataFrame, dataset: str) -> DataFrame:
    """The envelopes of a decoded frame, with the columns the silver transforms read."""
    return frame.filter("is_envelope").select(*envelope(dataset).fieldNames(), "source_file")


def rejects_of(frame: DataFrame, dataset: str) -> DataFrame:
    """The rejects of a decoded frame: ``dataset``, ``source_file``, ``pipeline_run_id``, ``position``, ``reason``, ``raw``."""
    return (frame.select("pipeline_run_id", "source_file", F.explode("rejects").alias("r"))
            .select(F.lit(dataset).alias("dataset"), "source_file", "pipeline_run_id", "r.position", "r.reason", "r.raw"))


def barren_files(frame: DataFrame) -> DataFrame:
    """Files with text of which not a single envelope could be read."""
    return frame.groupBy("source_file").agg(F.bool_or("is_envelope").alias("_any")).filter(~F.col("_any")).select("source_file")


def read(spark: SparkSession, root: str, dataset: str, path: str | None = None, pattern: str = LANDED) -> DataFrame:
    """The envelopes of one bronze dataset, in either layout, each with its sound records and ``source_file``."""
    return envelopes_of(decoded(spark, root, dataset, path, pattern), dataset)


def quarantine(spark: SparkSession, root: str, dataset: str, path: str | None = None, pattern: str = LANDED) -> DataFrame:
    """The rejects of one bronze dataset (see :func:`rejects_of`)."""
    return rejects_of(decoded(spark, root, dataset, path, pattern), dataset)
