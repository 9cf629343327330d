"""Contiguous shards of near equal bytes: the minimax partition of ordered atomic groups.

Rows with equal text form a group that is never split; groups are ordered by a
hash of their text.  The smallest shard capacity is found by binary search
with a greedy check (fill each shard up to the capacity, cut, go on).  The
order is cut within that capacity, near equal shares of what is left, so that the
last shard is not the only short one.

The running sizes of all groups are a distributed table; the driver only holds
a summary of it: at most ``CELLS`` cells of the size axis with the smallest and
largest running size in each.  On a summary the greedy check gives a lower and
an upper bound of the capacity; the cells in which cuts may fall are then cut
finer, until both bounds meet.  The number of passes grows with the logarithm
of the number of groups.

Ranks within a group are made with salts, so that a group of a third of all
rows is spread over tasks.  Balance is bounded by atomicity: a shard holds at
least the largest group.

Defined results for odd input: a null text is a text of its own (0 bytes, size
``OVERHEAD``); null ids and repeated rows are rows of their own; with fewer
groups than shards the last shards stay empty; an empty table gives no rows;
extra columns are ignored by :func:`assign`.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import salt_count, written

OVERHEAD = 8
SHARDS = 24
CELLS = 1 << 15
#: Hash prefixes that order the groups are at most this many.
BUCKETS = 1 << 12


def running_sizes(groups: DataFrame, rows: int) -> DataFrame:
    """Add ``bytes_before`` and ``rows_before``: totals of the groups ordered earlier.

    ``groups`` has ``text_key`` (uniform hash), ``bytes`` and ``rows``.  Totals per hash prefix
    (at most BUCKETS rows) give each prefix its base; within a prefix a window goes on.
    """
    buckets = min(BUCKETS, max(1, rows // 200))
    bucketed = groups.withColumn("bucket", F.pmod(F.xxhash64("text_key"), F.lit(buckets)))
    totals = bucketed.groupBy("bucket").agg(F.sum("bytes").alias("b"), F.sum("rows").alias("r"))
    earlier = W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    base = totals.select("bucket", F.coalesce(F.sum("b").over(earlier), F.lit(0)).alias("base_bytes"),
                         F.coalesce(F.sum("r").over(earlier), F.lit(0)).alias("base_rows"))
    inside = W.partitionBy("bucket").orderBy("text_key").rowsBetween(W.unboundedPreceding, -1)
    return (bucketed.withColumn("b", F.coalesce(F.sum("bytes").over(inside), F.lit(0)))
            .withColumn("r", F.coalesce(F.sum("rows").over(inside), F.lit(0)))
            .join(F.broadcast(base), "bucket")                    # at most BUCKETS rows
            .select("text_key", "bytes", "rows", (F.col("base_bytes") + F.col("b")).alias("bytes_before"),
                    (F.col("base_rows") + F.col("r")).alias("rows_before")))


class _Summary:
    """Ends of groups on the size axis, known per cell by their smallest and largest value."""

    def __init__(self, cells: list[tuple[int, int]]):
        self.low = [c[0] for c in cells]
        self.high = [c[1] for c in cells]

    def cut(self, limit: int, generous: bool) -> int:
        """The last end up to ``limit``: never too small when generous, never too large otherwise."""
        i = bisect_right(self.low, limit) - 1
        if i < 0:
            return 0
        if self.high[i] <= limit:
            return self.high[i]
        return limit if generous else self.low[i]

    def feasible(self, capacity: int, shards: int, total: int, generous: bool) -> bool:
        at = 0
        for _ in range(shards):
            nxt = self.cut(at + capacity, generous)
            if nxt >= total:
                return True
            if nxt <= at:
                return False
            at = nxt
        return False

    def least(self, low: int, high: int, shards: int, total: int, generous: bool) -> int:
        while low < high:
            middle = (low + high) // 2
            if self.feasible(middle, shards, total, generous):
                high = middle
            else:
                low = middle + 1
        return low

    def even_cuts(self, capacity: int, shards: int, total: int) -> list[int]:
        """Known ends near equal shares of what is left, no shard above ``capacity``."""
        ends = sorted({*self.low, *self.high})
        out, at = [], 0
        for left in range(shards, 0, -1):
            target = at - (at - total) // left
            i = bisect_right(ends, target)
            near = [e for e in ends[max(i - 1, 0):i + 1] if at < e <= at + capacity]
            cut = min(near, key=lambda e: abs(e - target)) if near else at
            if left > 1 and not self._rest_fits(cut, capacity, left - 1, total):
                cut = min(self.cut(at + capacity, False), total)
            out.append(cut if left > 1 else total)
            at = out[-1]
        return out

    def _rest_fits(self, at: int, capacity: int, shards: int, total: int) -> bool:
        for _ in range(shards):
            if at >= total:
                return True
            at = self.cut(at + capacity, False)
        return at >= total

    def cuts(self, capacity: int, shards: int, total: int, generous: bool) -> list[int]:
        out, at = [], 0
        for _ in range(shards):
            at = min(self.cut(at + capacity, generous), total)
            out.append(at)
        return out


def minimax_cuts(groups: DataFrame, shards: int, cells: int = CELLS) -> tuple[int, list[int]]:
    """(capacity, ends of the shards) of the best contiguous partition of ``running_sizes`` rows."""
    cells = max(cells, 4 * shards * shards)                 # open spans cover fewer cells than this: each pass narrows them
    ends = groups.select((F.col("bytes_before") + F.col("bytes")).alias("end"))
    first = groups.agg(F.max(F.col("bytes_before") + F.col("bytes")), F.max("bytes")).first()
    if first[0] is None:
        return 0, [0] * shards
    total, largest = int(first[0]), int(first[1])
    low, high = max(-(-total // shards), largest), total
    spans = [(0, total)]                                    # parts of the axis (start, end] to be cut finer
    known: dict[int, tuple[int, int]] = {}
    while True:
        width = max(1, -(-sum(b - a for a, b in spans) // cells))
        inside, label = F.lit(False), F.lit(None).cast("long")
        for a, b in spans:                                  # at most two per shard
            here = (F.col("end") > a) & (F.col("end") <= b)
            inside = inside | here
            label = F.when(here, F.lit(a) + F.floor((F.col("end") - a - 1) / width) * width).otherwise(label)
        found = (ends.filter(inside).groupBy(label.alias("cell"))
                 .agg(F.min("end").alias("low"), F.max("end").alias("high")).collect())     # at most 2 * cells rows
        known = {k: v for k, v in known.items() if not any(a < v[1] and v[0] <= b for a, b in spans)}
        known.update({int(r["low"]): (int(r["low"]), int(r["high"])) for r in found})
        summary = _Summary(sorted(known.values()))
        low = summary.least(low, high, shards, total, generous=True)
        high = summary.least(low, high, shards, total, generous=False)
        spans = _open_spans(summary, low, high, shards, total)
        if low == high and not spans:
            return low, summary.even_cuts(low, shards, total)


def _open_spans(summary: _Summary, low: int, high: int, shards: int, total: int) -> list[tuple[int, int]]:
    """Cells not yet resolved in which some cut of a capacity in [low, high] may fall, joined to spans."""
    small = summary.cuts(low, shards, total, generous=False)
    large = summary.cuts(high, shards, total, generous=True)
    starts_small, starts_large = [0, *small[:-1]], [0, *large[:-1]]
    spans: list[tuple[int, int]] = []
    for a, b in zip(starts_small, starts_large):
        reach_low, reach_high = a + low, b + high
        i = max(bisect_right(summary.low, reach_low) - 1, 0)
        while i < len(summary.low) and summary.low[i] <= reach_high:
            if summary.high[i] > summary.low[i] and summary.high[i] > reach_low:
                spans.append((summary.low[i] - 1, summary.high[i]))
            i += 1
    joined: list[tuple[int, int]] = []
    for a, b in sorted(set(spans)):
        if joined and a <= joined[-1][1] + 1:
            joined[-1] = (joined[-1][0], max(b, joined[-1][1]))
        else:
            joined.append((a, b))
    return joined


def assign(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
           overhead: int = OVERHEAD) -> DataFrame:
    """Per row: ``doc_id``, ``size``, ``text_crc32``, ``shard``, ``slot`` (gapless in the shard)."""
    text = F.col(text_col)
    rows = written(docs.select(
        F.col(id_col).alias("doc_id"),
        F.when(text.isNotNull(), F.sha1(text)).otherwise(F.lit("")).alias("text_key"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + overhead).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32")), "rows")
    count = rows.count()
    salts = salt_count(count)
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
    parts = written(salted.groupBy("text_key", "salt").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes")),
                    "parts")
    groups = parts.groupBy("text_key").agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"))
    placed = written(running_sizes(groups, count), "groups")
    _, ends = minimax_cuts(placed, shards)
    shard = F.lit(0)
    for end in ends[:-1]:
        shard = shard + F.when(F.col("bytes_before") >= end, 1).otherwise(0)
    sharded = placed.withColumn("shard", shard)
    first_row = sharded.groupBy("shard").agg(F.min("rows_before").alias("shard_start"))
    earlier = W.partitionBy("text_key").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)
    bases = (parts.withColumn("part_start", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
             .select("text_key", "salt", "part_start")
             .join(sharded.join(F.broadcast(first_row), "shard")          # one row per shard
                   .select("text_key", "shard", (F.col("rows_before") - F.col("shard_start")).alias("group_start")), "text_key"))
    inside = W.partitionBy("text_key", "salt").orderBy("doc_id")
    return (salted.withColumn("r", F.row_number().over(inside) - 1)
            .join(bases, ["text_key", "salt"])
            .select("doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"),
                    (F.col("group_start") + F.col("part_start") + F.col("r")).cast("long").alias("slot")))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write ``doc_id``, text and slot partitioned by shard; every row of ``docs``, null ids and repeated rows, too."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    texts = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).dropDuplicates()
             .withColumns({"crc": F.crc32(text), "bytes": F.length(text).cast("long") + 8}))
    texts = texts.dropDuplicates(["id", "crc", "bytes"])           # null and empty are one text here
    placed = assign(docs, shards, id_col, text_col)
    same = (placed.doc_id.eqNullSafe(texts.id) & (placed.text_crc32 == texts.crc) & (placed["size"] == texts.bytes))
    (placed.join(texts, same, "left").drop("id", "crc", "bytes").hint("rebalance", "shard")
     .write.partitionBy("shard").parquet(path))
