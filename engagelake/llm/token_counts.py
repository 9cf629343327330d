"""Token counts through a cache keyed by content and tokenizer digests.

A text's key is the SHA-256 of its normalised content (a null text is the empty
one; nothing else is normalised, since anything else may change the count) under
the digest of the tokenizer's version: its file's bytes, the library's name and
version, and the settings.  A run

1. reads ids, keys and byte lengths of all documents,
2. looks the distinct keys up among the counts stored for this tokenizer,
3. encodes one text for each distinct key that is missing, and
4. appends those counts to the cache, from which every document takes its own.

Copies are collapsed inside the tasks before any text is shuffled, so a text that
a third of the documents share is encoded once and travels once a task; the last
join moves keys and ids alone, and its hot keys are split by adaptive skew
handling.  Texts of known keys are not shuffled when the missing keys are few
(counted, at most ``FEW_MISSING``).  An append is committed as a whole; one
repeated after a failure, or made by two runs at once, only stores equal rows
twice, which reading makes one.  ``compact`` rewrites a grown cache.

Defined results for odd input: null and empty texts have 0 bytes and 0 tokens;
null ids and repeated rows keep a result each; an empty table gives no rows and
leaves the cache as it was; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import path_exists
from .common import ship_package, text_buffers, written

#: Documents of more tokens are over the limit.
LIMIT = 4096
#: Missing keys that are broadcast at most (32 bytes each); beyond it the join shuffles.
FEW_MISSING = 100_000
#: Bytes of texts handed to the tokenizer at once (or one longer text).
CHUNK = 4 << 20
CACHE = "tokenizer string, key binary, n_tokens long"


def tokenizer_digest(path: str) -> str:
    """Digest of what decides a count: the file's bytes, the library and its version, the settings."""
    if path.endswith(".json"):
        import tokenizers as library
    else:
        import sentencepiece as library
    whole = hashlib.sha256(f"{library.__name__} {library.__version__} no special tokens added\n".encode())
    with open(path, "rb") as file:
        for block in iter(lambda: file.read(1 << 20), b""):
            whole.update(block)
    return whole.hexdigest()


_COUNTERS: dict = {}


def counter(path: str):
    """A function from texts to their numbers of tokens, kept by the worker."""
    if path not in _COUNTERS:
        if path.endswith(".json"):
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer
            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            _COUNTERS[path] = lambda texts: [len(e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        else:
            from sentencepiece import SentencePieceProcessor
            model = SentencePieceProcessor(model_file=path)
            _COUNTERS[path] = lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
    return _COUNTERS[path]


def _count_with(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in batches:
            _, offsets = text_buffers(batch.column(1))
            found, low = [], 0
            while low < batch.num_rows:
                high = low + 1
                while high < batch.num_rows and offsets[high + 1] - offsets[low] <= CHUNK:
                    high += 1
                found += count(batch.column(1).slice(low, high - low).to_pylist())
                low = high
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], names=["key", "n_tokens"])
    return run


def stored(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """``key`` and ``n_tokens`` of one tokenizer version, each key once; no rows where there is no cache yet."""
    if not path_exists(spark, cache):
        return spark.createDataFrame([], "key binary, n_tokens long")
    rows = spark.read.schema(CACHE).parquet(cache).filter(F.col("tokenizer") == version)
    return rows.groupBy("key").agg(F.min("n_tokens").alias("n_tokens"))


def _content(text) -> tuple:
    """(key, normalised content) of a text column."""
    text = F.coalesce(text, F.lit(""))
    return F.unhex(F.sha2(text, 256)), text


def fill(docs: DataFrame, cache: str, tokenizer_path: str, text_col: str = "text", few: int = FEW_MISSING,
         keys: DataFrame | None = None) -> int:
    """Encode each distinct text whose count is not stored and append the counts; returns how many.

    ``keys`` are the distinct keys of ``docs`` where these are at hand."""
    spark = docs.sparkSession
    version = tokenizer_digest(tokenizer_path)
    key, content = _content(F.col(text_col))
    rows = docs.select(key.alias("key"), content.alias("text"))
    keys = rows.select("key").distinct() if keys is None else keys
    missing = written(keys.join(stored(spark, cache, version).select("key"), "key", "left_anti"),
                      "missing")
    count = missing.count()
    if not count:
        return 0
    ship_package(spark)
    if count <= few:
        rows = rows.join(F.broadcast(missing), "key", "left_semi")
    texts = rows.groupBy("key").agg(F.first("text").alias("text"))
    if count > few:
        texts = texts.join(missing.hint("merge"), "key", "left_semi")
    (texts.mapInArrow(_count_with(tokenizer_path), "key binary, n_tokens long")
     .select(F.lit(version).alias("tokenizer"), "key", "n_tokens")
     .write.mode("append").partitionBy("tokenizer").parquet(cache))
    return count


def count_tokens(docs: DataFrame, cache: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every document, by way of the cache folder ``cache``."""
    spark = docs.sparkSession
    key, content = _content(F.col(text_col))
    rows = written(docs.select(F.col(id_col).alias("doc_id"), F.octet_length(content).cast("long").alias("n_bytes"),
                               key.alias("key")), "keys")
    distinct = written(rows.select("key").distinct(), "distinct")
    fill(docs, cache, tokenizer_path, text_col, keys=distinct)
    found = written(distinct.join(stored(spark, cache, tokenizer_digest(tokenizer_path)), "key"), "found")
    return (rows.join(found.hint("merge"), "key")                  # two written tables: a hot key's rows can be split
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))


def compact(spark: SparkSession, cache: str, target: str, keys_per_file: int = 4_000_000) -> None:
    """Write the cache anew to ``target``: each key once a tokenizer, in files of about ``keys_per_file`` keys."""
    rows = spark.read.schema(CACHE).parquet(cache).groupBy("tokenizer", "key").agg(F.min("n_tokens").alias("n_tokens"))
    (rows.write.option("maxRecordsPerFile", keys_per_file).partitionBy("tokenizer").parquet(target))
