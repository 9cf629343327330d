"""Best-fit packing of token sequences by exact complements.

Documents are tokenised, closed with a separator id, and cut only when longer
than a sequence.  Packing depends on lengths alone, so the plan is made on the
histogram of piece lengths (at most ``capacity`` numbers, whatever the data
size): for each length, longest first, an index of available lengths and of
their pair sums finds one, two or three lengths that fill the gap
exactly; as many sequences as the availability counts allow take that
pattern at once.  What has no exact complement is placed best-fit, together with a
few short pieces held back for it.

The pattern list is turned into intervals of ranks per length; a piece looks up
its sequence and offset by its rank within its length.  Ranks are made with
salts, so a length that a third of the pieces share is spread over tasks.

Defined results for odd input: null and empty texts are one separator; repeated
rows are packed as rows of their own; null ids are kept; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import salt_count, ship_package, text_buffers, written
from .word_ids import encoder

CAPACITY = 2048
SEPARATOR_ID = 0
#: Shares of all tokens whose shortest pieces may be held back from exact fills, for the residual; tried in this order.
RESERVES = (1 / 32, 1 / 64, 1 / 16, 1 / 128, 1 / 256, 1 / 512, 1 / 8, 0.0)


def _pieces_with(tokenizer_path: str, capacity: int, separator: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = encoder(tokenizer_path)
        names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

        def rows(source, which, piece, start, length, crc, ids):
            arrays = [source.take(pa.array(which, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                      pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            return pa.RecordBatch.from_arrays(arrays + [pa.array(ids, pa.list_(pa.int32()))] * with_ids, names=names)

        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                part = batch.slice(low, 1000)
                which, piece, start, length, crc, ids = [], [], [], [], [], []
                for i, found in enumerate(codes.encode_texts(*text_buffers(part.column(1)))):
                    tokens = np.append(found, np.uint32(separator)).astype("<u4")
                    for k, at in enumerate(range(0, len(tokens), capacity)):
                        cut = tokens[at:at + capacity]
                        which.append(i)
                        piece.append(k)
                        start.append(at)
                        length.append(len(cut))
                        crc.append(zlib.crc32(cut.tobytes()))
                        if with_ids:
                            ids.append(cut.astype(np.int32))
                yield rows(part.column(0), which, piece, start, length, crc, ids)
    return run


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = CAPACITY, separator: int = SEPARATOR_ID, with_ids: bool = False) -> DataFrame:
    """Per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` (and ``ids`` on request)."""
    ship_package(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(_pieces_with(tokenizer_path, capacity, separator, with_ids),
                             f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
                             + ", ids array<int>" * with_ids)


def plan_patterns(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence's pieces, how many sequences) for a histogram of lengths up to ``capacity``.

    Exact fills would use up the short pieces that the residual needs, so some are held back for it: as many of the
    shortest as make up a share of all tokens, the first share of ``RESERVES`` that gives the fewest sequences."""
    least = -(-sum(length * n for length, n in counts.items()) // capacity)
    best: list[tuple[tuple[int, ...], int]] = []
    for share in RESERVES:
        plan = _plan(counts, capacity, share)
        if not best or _sequences(plan) < _sequences(best):
            best = plan
        if _sequences(best) == least:
            break
    return best


def _sequences(plan: list[tuple[tuple[int, ...], int]]) -> int:
    return sum(n for _, n in plan)


def _plan(counts: dict[int, int], capacity: int, share: float) -> list[tuple[tuple[int, ...], int]]:
    """Exact fills of all but the held-back pieces, then best-fit of what is left with them."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] += n
    held = np.zeros(capacity + 1, np.int64)
    room = int(share * int((left * np.arange(capacity + 1)).sum()))
    for length in np.flatnonzero(left):
        held[length] = min(left[length], room // length)
        room -= int(held[length] * length)
        if held[length] < left[length]:
            break
    left -= held
    out: list[tuple[tuple[int, ...], int]] = []

    def take(lengths: tuple[int, ...]) -> bool:
        need = {x: lengths.count(x) for x in lengths}
        times = min(int(left[x]) // k for x, k in need.items())
        if times:
            for x, k in need.items():
                left[x] -= k * times
            out.append((lengths, times))
        return times > 0

    def pair(total: int, used: tuple[int, ...]) -> tuple[int, int] | None:
        """The two available lengths of that sum whose larger one is largest, besides those in use."""
        if total < 2:
            return None
        free = left[:total].copy()
        for x in used:
            if x < total:
                free[x] -= 1
        larger = np.arange(total - 1, (total - 1) // 2, -1)
        smaller = total - larger
        ok = (free[larger] > 0) & (free[smaller] > 0) & ((larger != smaller) | (free[larger] > 1))
        hit = int(ok.argmax())
        return (int(larger[hit]), int(smaller[hit])) if ok[hit] else None

    take((capacity,))
    for length in range(capacity - 1, 0, -1):
        while left[length]:
            gap = capacity - length
            if take((length, gap)):
                continue
            two = pair(gap, (length,))
            if two and take((length, *two)):
                continue
            three = None
            for a in np.flatnonzero(left[:gap])[::-1]:
                a = int(a)
                if left[a] <= (a == length):
                    continue
                two = pair(gap - a, (length, a))
                if two:
                    three = (length, a, *two)
                    break
            if not three or not take(three):
                break
    left += held
    return out + _best_fit({int(x): int(left[x]) for x in np.flatnonzero(left)}, capacity)


def _best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over counted lengths; equal bins are handled together."""
    gaps: list[int] = []                                   # sorted gaps that have bins
    bins: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def put(gap, lengths, n):
        if gap not in bins:
            bins[gap] = []
            insort(gaps, gap)
        bins[gap].append((lengths, n))

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                each = capacity // length
                if n >= each:
                    put(capacity - each * length, (length,) * each, n // each)
                    n %= each
                else:
                    put(capacity - n * length, (length,) * n, 1)
                    n = 0
                continue
            gap = gaps[at]
            lengths, m = bins[gap].pop()
            used = min(n, m)
            if m > used:
                bins[gap].append((lengths, m - used))
            if not bins[gap]:
                del bins[gap]
                gaps.pop(at)
            put(gap - length, (*lengths, length), used)
            n -= used
    return [(lengths, n) for group in bins.values() for lengths, n in group]


def place_table(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length: interval starts (ranks), first sequence id of the interval, offset in the sequence."""
    rows: dict[int, list[tuple[int, int, int]]] = {}
    cursor: dict[int, int] = {}
    base = 0
    for lengths, times in patterns:
        offset = 0
        for x in lengths:
            at = cursor.get(x, 0)
            rows.setdefault(x, []).append((at, base, offset))
            cursor[x] = at + times
            offset += x
        base += times
    return {x: tuple(np.array(c, np.int64) for c in zip(*r)) for x, r in rows.items()}


def ranked(df: DataFrame, key: str, order: list[str], rank: str, salts: int) -> DataFrame:
    """Add ``rank``: gapless numbers from 0 within ``key``, without any task holding a whole key."""
    salt = F.pmod(F.xxhash64(*order), F.lit(salts))
    salted = df.withColumn("__salt", salt)
    sizes = salted.groupBy(key, "__salt").agg(F.count(F.lit(1)).alias("__n"))
    before = W.partitionBy(key).orderBy("__salt").rowsBetween(W.unboundedPreceding, -1)
    base = sizes.select(key, "__salt", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    inside = W.partitionBy(key, "__salt").orderBy(*order)
    return (salted.withColumn("__r", F.row_number().over(inside)).join(base, [key, "__salt"])
            .withColumn(rank, F.col("__base") + F.col("__r") - 1).drop("__salt", "__r", "__base"))


def _place_with(table: dict[int, tuple[np.ndarray, ...]]):
    def run(batches):
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            cuts = np.flatnonzero(np.diff(length[order])) + 1
            for rows in np.split(order, cuts) if len(order) else []:
                low, base, at = table[int(length[rows[0]])]
                i = np.searchsorted(low, rank[rows], side="right") - 1
                sequence[rows], offset[rows] = base[i] + rank[rows] - low[i], at[i]
            keep = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in keep),
                                              pa.array(sequence), pa.array(offset)],
                                             names=[*keep, "sequence_id", "offset"])
    return run


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows that have ``doc_id``, ``piece`` and ``length``.

    ``cut`` must give the same rows each time it is read (a written table).
    """
    spark = cut.sparkSession
    counts = {int(r[0]): int(r[1]) for r in cut.groupBy("length").count().collect()}      # at most ``capacity`` rows
    table = place_table(plan_patterns(counts, capacity))
    order = [c for c in ("doc_id", "piece", "ids_crc32") if c in cut.columns]
    rows = sum(counts.values())
    numbered = ranked(cut, "length", order, "rank", salt_count(rows, least=16))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema.fields)
    ship_package(spark)
    # no more tasks, and files that they write, than the rows need
    return (numbered.select(*cut.columns, "rank").coalesce(salt_count(rows, least=spark.sparkContext.defaultParallelism))
            .mapInArrow(_place_with(table), f"{fields}, sequence_id long, offset long"))


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, separator: int = SEPARATOR_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece with its place; see :func:`pieces` for the columns."""
    return pack(written(pieces(docs, tokenizer_path, id_col, text_col, capacity, separator, with_ids), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The token ids of each sequence (``packed`` made with ids): ``sequence_id``, ``ids``, ``doc_ids``."""
    parts: Column = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id")))
    return (packed.groupBy("sequence_id").agg(parts.alias("p"))
            .select("sequence_id", F.flatten(F.col("p.ids")).alias("ids"), F.col("p.doc_id").alias("doc_ids")))
