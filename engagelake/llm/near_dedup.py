"""Near-duplicate documents: HyperMinHash sketches, banding, corrected estimates, exact verification.

1. Each document's distinct five-word shingles are hashed and sketched into
   compressed registers (leading zeros and mantissa bits); documents with
   equal sets are collapsed to the smallest id first, so groups of exact copies
   cost one row afterwards.
2. Bands of registers propose candidates.  A bucket does not emit its pairs:
   each member meets the bucket's hub (the member that shares most buckets),
   which gives one row per membership.
3. A pair whose collision-corrected Jaccard estimate lies ``SLACK`` standard
   errors below the threshold is dropped; the rest is verified on full sets.
4. Connected components over the verified links (alternating large-star and
   small-star contraction).
5. Members that still lie in different components of one hub's group are
   compared in blocks of ``BLOCK`` documents (size classes apart are skipped,
   block pairs inside the hub's component too); only verified links leave a
   task.  With these links the components are final.

No pair is dropped by a cap: what two documents need to be linked is one equal
band out of forty, which pairs at the threshold miss with probability 2.5e-7.
Memory per task is a batch of texts or two blocks of sets.  Intermediate
tables are written below the shared folder.

Defined results for odd input: null, empty or wordless texts have an empty set
and stay alone; a null id stays alone, with a null component, and is kept;
repeated rows each give a row with equal results (rows of one id count as one
document, and :func:`keep_one` returns such a row once); an empty table gives no
rows; extra columns are ignored by :func:`components` and kept by :func:`keep_one`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shingles as sh
from .common import ship_package, temp_name, text_buffers, written

THRESHOLD_PERCENT = 75
SLACK = 5.0
BLOCK = 256
#: A list of ids of more measured bytes than this is not broadcast.
BROADCAST_BYTES = 32 * 1024 * 1024
SKETCH = "doc_id {id}, n_shingles long, set_key binary, small binary, large binary"


def _batches(batches: Iterator[pa.RecordBatch], most_bytes: int = 1 << 25) -> Iterator[pa.RecordBatch]:
    """Cut record batches to about ``most_bytes`` each."""
    for batch in batches:
        step = max(1, int(batch.num_rows * most_bytes // max(batch.nbytes, 1)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib
    for batch in _batches(batches):
        sizes, keys, sets = [], [], []
        small, large = [], []
        for i, s in enumerate(sh.shingle_sets(*text_buffers(batch.column(1)))):
            sizes.append(len(s))
            keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
            if 0 < len(s) <= sh.SMALL:
                small.append((i, s))
            if len(s) >= sh.LARGE:
                large.append((i, s))
        out = []
        for chosen, f in ((small, sh.small_sketches), (large, sh.large_sketches)):
            rows = [None] * batch.num_rows
            for at in range(0, len(chosen), 512):
                part = chosen[at:at + 512]
                for (i, _), registers in zip(part, f([s for _, s in part])):
                    rows[i] = registers.tobytes()
            out.append(pa.array(rows, pa.binary()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), *out],
            names=["doc_id", "n_shingles", "set_key", "small", "large"])


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles``, ``set_key`` (digest of the set, null if empty), registers."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(_sketch, SKETCH.format(id=kind))


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _batches(batches, 1 << 21):
        for column, scheme in ((1, 0), (2, 1)):
            rows = batch.filter(batch.column(column).is_valid())
            if rows.num_rows:
                registers = np.frombuffer(b"".join(rows.column(column).to_pylist()), np.uint16)
                keys = sh.band_keys(registers.reshape(rows.num_rows, sh.REGISTERS), scheme)
                which = np.repeat(np.arange(rows.num_rows), keys.shape[1])
                yield pa.RecordBatch.from_arrays([rows.column(0).take(pa.array(which)), pa.array(keys.ravel())],
                                                 names=["doc_id", "band"])


def band_rows(sketched: DataFrame) -> DataFrame:
    """``doc_id``, ``band``: one row per band key."""
    kind = sketched.schema["doc_id"].dataType.simpleString()
    return sketched.select("doc_id", "small", "large").mapInArrow(_bands, f"doc_id {kind}, band long")


def hub_pairs(bands: DataFrame) -> DataFrame:
    """Distinct (``hub``, ``member``) pairs: in each bucket every member meets the hub."""
    size = bands.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # few rows for the tasks that find them: brought together, else each task writes a file of its own
    shared = written(bands.join(size, "band").hint("rebalance"), "shared")
    weight = shared.groupBy("doc_id").agg(F.sum(F.log2("n")).alias("weight"))
    weighed = shared.join(weight, "doc_id")
    hubs = weighed.groupBy("band").agg(F.max_by("doc_id", F.struct("weight", "doc_id")).alias("hub"))
    return (shared.join(hubs, "band").filter(F.col("hub") != F.col("doc_id"))
            .select("hub", F.col("doc_id").alias("member")).distinct())


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _batches(batches):
        found = list(sh.shingle_sets(*text_buffers(batch.column(1))))
        small = [sh.small_sketches([s])[0].tobytes() if 0 < len(s) <= sh.SMALL else None for s in found]
        large = [sh.large_sketches([s])[0].tobytes() if len(s) >= sh.LARGE else None for s in found]
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.binary()) for x in (small, large)),
                                          pa.array([s.tobytes() for s in found], pa.binary())],
                                         names=["doc_id", "small", "large", "shingles"])


def _registers(values: list, rows: list[int]) -> np.ndarray:
    return np.frombuffer(b"".join(values[i] for i in rows), np.uint16).reshape(len(rows), sh.REGISTERS)


def _likely(x: list[dict], y: list[dict], percent: int) -> np.ndarray:
    """Which pairs (x[i], y[i]) are not far below the threshold by their estimates and sizes."""
    n, m = (np.array([len(v["shingles"]) // 8 for v in side], np.int64) for side in (x, y))
    ok = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
    out = np.zeros(len(x), bool)
    for column, large in (("small", False), ("large", True)):
        rows = [i for i in np.flatnonzero(ok) if x[i][column] is not None and y[i][column] is not None
                and (not large or x[i]["small"] is None or y[i]["small"] is None)]
        if rows:
            guess, used = sh.estimate(_registers([v[column] for v in x], rows), _registers([v[column] for v in y], rows),
                                      n[rows], m[rows], large)
            t = percent / 100
            out[rows] = guess >= t - SLACK * np.sqrt(t * (1 - t) / used)
    return out


def _linked(a: bytes, b: bytes, percent: int) -> bool:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if len(x) > len(y):
        x, y = y, x
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    both = int((y[at] == x).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def _verify_with(percent: int):
    def verify(batches):
        for batch in _batches(batches, 1 << 24):
            x, y = batch.column("x").to_pylist(), batch.column("y").to_pylist()
            likely = _likely(x, y, percent)
            keep = [i for i in np.flatnonzero(likely) if _linked(x[i]["shingles"], y[i]["shingles"], percent)]
            yield batch.select(["hub", "member"]).take(pa.array(keep, pa.int64()))
    return verify


def verified(pairs: DataFrame, sets: DataFrame, percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """The (``hub``, ``member``) pairs whose full sets reach the similarity."""
    kind = sets.schema["doc_id"].dataType.simpleString()
    of = F.struct("shingles", "small", "large")
    return (pairs.join(sets.select(F.col("doc_id").alias("member"), of.alias("y")), "member")
            .join(sets.select(F.col("doc_id").alias("hub"), of.alias("x")), "hub")
            .select("hub", "member", "x", "y")
            .mapInArrow(_verify_with(percent), f"hub {kind}, member {kind}"))


def _starred(edges: DataFrame) -> bool:
    """Whether every ``u`` has one ``v`` and no ``v`` is a ``u``: the edges are the components then."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("child"), F.lit(0).alias("root")),
                                          F.struct(F.col("v").alias("node"), F.lit(0).alias("child"), F.lit(1).alias("root")))).alias("e"))
    odd = ends.groupBy("e.node").agg(F.sum("e.child").alias("n"), F.max("e.root").alias("root")).filter("n > 1 or n = 1 and root = 1")
    return odd.agg(F.count(F.lit(1))).first()[0] == 0


def connected(links: DataFrame, left: str, right: str) -> DataFrame:
    """``node``, ``component`` (its smallest node) for every node that has a link.

    ``links`` is read several times: a written table.
    """
    edges = links.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).filter("u > v")
    while not _starred(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("low"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        joined = large.join(large.groupBy("u").agg(F.min("v").alias("low")), "u")
        own = F.struct("u", F.col("low").alias("v"))
        small = F.array(own, F.when(F.col("v") > F.col("low"), F.struct(F.col("v").alias("u"), F.col("low").alias("v"))).otherwise(own))
        edges = written(joined.select(F.explode(small).alias("e")).select("e.u", "e.v").distinct(), "edges")
    # grouped by node, so that joins by it need no further shuffle
    named = F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("component")),
                    F.struct(F.col("v").alias("node"), F.col("v").alias("component")))
    return edges.select(F.explode(named).alias("e")).groupBy("e.node").agg(F.min("e.component").alias("component"))


def _compare_blocks_with(percent: int):
    def compare(batches):
        for batch in batches:
            for row in batch.to_pylist():
                x, y = row["x"], row["y"]
                same = row["i"] == row["j"]
                for i, one in enumerate(x):
                    rest = [o for o in (x[i + 1:] if same else y) if o["component"] != one["component"]]
                    if rest:
                        likely = _likely([one] * len(rest), rest, percent)
                        found = [rest[k]["doc_id"] for k in np.flatnonzero(likely)
                                 if _linked(one["shingles"], rest[k]["shingles"], percent)]
                        if found:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([one["doc_id"]] * len(found)), pa.array(found)], names=["hub", "member"])
    return compare


def cross_links(pairs: DataFrame, sets: DataFrame, labels: DataFrame, percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """Verified links between members of one hub's group that lie in different components so far."""
    kind = sets.schema["doc_id"].dataType.simpleString()
    central = labels.select(F.col("node").alias("hub"), F.col("component").alias("central"))
    labelled = (pairs.withColumnRenamed("member", "doc_id").join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left")
                .join(central, "hub", "left").select("hub", "doc_id", F.coalesce("component", "doc_id").alias("component"),
                                                     F.coalesce("central", "hub").alias("central")))
    # A group of which every other member is linked to the hub, or with one member left, needs nothing more.
    groups = (labelled.groupBy("hub").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("component") != F.col("central")).alias("left"),
                                          F.min("central").alias("central")).filter("left > 0 and n > 1"))
    members = (labelled.drop("central").join(groups.select("hub", "central"), "hub")
               .select("hub", "doc_id", "component", (F.col("component") == F.col("central")).alias("own"))
               .unionByName(groups.select("hub", F.col("hub").alias("doc_id"), F.col("central").alias("component"),
                                          F.lit(True).alias("own"))))
    weight = F.octet_length("shingles") / F.lit(8)
    members = members.join(sets, "doc_id").withColumn(
        "size_class", F.floor(F.log(F.greatest(weight, F.lit(1.0))) / F.log(F.lit(100.0 / percent)) + 1e-9).cast("int"))
    members = written(members, "members")
    classes = (members.groupBy("hub", "own", "size_class")
               .agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum(weight) / 400_000)).alias("blocks")))
    cut = members.join(classes, ["hub", "own", "size_class"]).withColumn(
        "salt", F.pmod(F.xxhash64("doc_id"), F.col("blocks")))
    key = F.struct("own", "size_class", "salt")
    blocks = written(cut.groupBy("hub", key.alias("b")).agg(F.collect_list(
        F.struct("doc_id", "component", "shingles", "small", "large")).alias("docs")), "blocks")
    names = blocks.select("hub", "b")
    first, second = names.withColumnRenamed("b", "i"), names.withColumnRenamed("b", "j")
    todo = (first.join(second, "hub").filter(F.col("i") <= F.col("j"))
            .filter(~(F.col("i.own") & F.col("j.own")))
            .filter(F.abs(F.col("i.size_class") - F.col("j.size_class")) <= 1))
    side = blocks.select("hub", F.col("b").alias("i"), F.col("docs").alias("x"))
    other = blocks.select("hub", F.col("b").alias("j"), F.col("docs").alias("y"))
    return (todo.join(side, ["hub", "i"]).join(other, ["hub", "j"]).select("i", "j", "x", "y")
            .mapInArrow(_compare_blocks_with(percent), f"hub {kind}, member {kind}"))


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id``, ``kept`` (the component's smallest id)."""
    ship_package(docs.sparkSession)
    all_rows = written(sketches(docs, id_col, text_col), "sketches")
    # equal sets have equal sketches: any of them stands for all
    reps = written(all_rows.filter("set_key is not null and doc_id is not null").groupBy("set_key")
                   .agg(F.min("doc_id").alias("doc_id"), *[F.first(c).alias(c) for c in ("small", "large")]), "representatives")
    groups = reps.select("set_key", F.col("doc_id").alias("first_id"))
    pairs = written(hub_pairs(band_rows(reps)), "pairs")

    wanted = written(pairs.select(F.col("hub").alias("doc_id")).unionByName(pairs.select(F.col("member").alias("doc_id")))
                     .distinct(), "wanted")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # a list of ids of measured size spares the shuffle of all texts
    size = wanted.agg(F.sum(F.octet_length(F.col("doc_id").cast("string")) + 16)).first()[0] or 0
    chosen = texts.join(F.broadcast(wanted) if size <= BROADCAST_BYTES else wanted, "doc_id", "left_semi")
    kind = docs.schema[id_col].dataType.simpleString()
    sets = written(chosen.mapInArrow(_sets, f"doc_id {kind}, small binary, large binary, shingles binary")
                   .dropDuplicates(["doc_id"]), "sets")

    links = written(verified(pairs, sets, percent).hint("rebalance"), "links")
    labels = written(connected(links, "hub", "member"), "labels")
    more = written(cross_links(pairs, sets, labels, percent), "more")
    if more.take(1):
        found = labels.select(F.col("node").alias("hub"), F.col("component").alias("member"))
        labels = connected(found.unionByName(more), "hub", "member")

    owner = groups.join(labels, groups.first_id == labels.node, "left").select(
        "set_key", F.coalesce("component", "first_id").alias("component_id"))
    return (all_rows.select("doc_id", "n_shingles", "set_key").join(owner, "set_key", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """One document of each component (the one with the smallest id), all columns unchanged."""
    flag = temp_name(docs, "id")
    gone = (components(docs, id_col, text_col, percent).filter("not kept")
            .select(F.col("doc_id").alias(flag)).distinct())
    left = docs.join(gone, docs[id_col] == gone[flag], "left_anti")
    named = left.filter(F.col(id_col).isNotNull()).dropDuplicates([id_col])
    return named.unionByName(left.filter(F.col(id_col).isNull()))
