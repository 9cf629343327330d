"""Chat formatting: a hidden Markov model recovers turns and roles of transcripts, then renders them.

Input rows are parts of transcripts (``conv_id``, ``pos``, ``text`` of one or more
lines).  Each line is observed by its speaker marker, length, closing mark and
first character.  Hidden states are (role, begins a turn / goes on); emission and
transition tables are smoothed counts over whole turns of a bounded sample of
labelled transcripts, tallied in the tasks.  Viterbi decoding is exact and runs in
blocks of at most ``ROWS_PER_BLOCK`` rows: a block is
summed up in one max-plus matrix, the matrices are chained (in tiers of
``FAN``) to give each block its first and last state, and each block is then
decoded on its own.  So a transcript of any length is spread over tasks and no
task holds a whole one.  Turns are rendered canonically, with the marks of the
template escaped where they occur in a turn's own text (:func:`escaped`).

Blocks are ranges of ``pos`` as long as these hold few rows.  Where many rows share
a ``pos`` (or have none), the rows of a range are numbered, equal ones counted
once, and cut by their numbers.

Defined results for odd input: a null text is an empty line; a null ``conv_id`` is a
conversation of its own, a null ``pos`` sorts first; ties of ``pos`` are ordered by the
hash of their text; repeated rows are repeated lines; an empty table gives no rows; extra columns are
ignored; lines before the first marker belong to the turn that the model begins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import ship_package, written

ROLES = ("system", "user", "assistant")
STATES = 2 * len(ROLES)                       # 2 * role: begins a turn; 2 * role + 1: goes on
ROWS_PER_BLOCK = 64
FAN = 512
SAMPLE_ROWS = 4_000

# Words that name a speaker before a colon or in brackets.
SPEAKERS = {
    "system": ("system", "sys", "context"),
    "user": ("user", "human", "q", "question", "customer", "client", "you"),
    "assistant": ("assistant", "ai", "bot", "a", "answer", "agent", "support", "model"),
}
_NAMED = {w: i for i, r in enumerate(ROLES) for w in SPEAKERS[r]}
_MARKER = re.compile(r"\s*(?:#{1,4}\s*|\*{1,2}|\[|<)?([A-Za-z]{1,12})(?:\*{1,2})?\s*(?:[:\]>]|：)(?:\*{1,2})?\s*")
_DASH = re.compile(r"\s*[-–—]\s+")
TEMPLATE = "<|im_start|>{role}\n{text}<|im_end|>\n"
SIZES = (5, 4, 2, 2)                          # values of the four observations


def marker(line: str) -> tuple[int, int]:
    """(0-2 role named, 3 bare dash, 4 none; end of the marker)."""
    m = _MARKER.match(line)
    if m and m.group(1).lower() in _NAMED:
        return _NAMED[m.group(1).lower()], m.end()
    m = _DASH.match(line)
    return (3, m.end()) if m else (4, 0)


def observe(line: str) -> tuple[int, int, int, int]:
    kind, end = marker(line)
    n = len(line) - end
    return kind, (n > 60) + (n > 200) + (n > 600), int(line.rstrip().endswith("?")), int(line[end:end + 1].islower())


@dataclass
class Model:
    first: np.ndarray                          # log probabilities of the first line's state
    step: np.ndarray                           # [from, to]
    emit: list[np.ndarray]                     # per observation: [state, value]

    def emission(self, line: str) -> np.ndarray:
        return sum(e[:, v] for e, v in zip(self.emit, observe(line)))


def tally(text: str | None) -> tuple[int, list[int]]:
    """(lines, how often each observation's values occur in the first line and then in the others) of a turn."""
    counts = np.zeros((2, sum(SIZES)), np.int64)
    lines = (text or "").split("\n")
    for k, line in enumerate(lines):
        at = 0
        for size, value in zip(SIZES, observe(line)):
            counts[min(k, 1), at + value] += 1
            at += size
    return len(lines), counts.ravel().tolist()


def train(turns: list[tuple[object, int, str, str]], smooth: float = 0.5) -> Model:
    """Tables from labelled turns (conversation, number, role, text with markers), in order."""
    return train_tallied([(conv, role, *tally(text)) for conv, _, role, text in turns], smooth)


def train_tallied(turns: list[tuple[object, str, int, list[int]]], smooth: float = 0.5) -> Model:
    """Tables from labelled turns (conversation, role, lines, tallies), in order."""
    first = np.full(STATES, 1e-9)
    first[0::2] = smooth
    step = np.full((STATES, STATES), 1e-12)
    for r in range(len(ROLES)):                # a turn goes on in its role; any role may begin one
        step[2 * r, 2 * r + 1] = step[2 * r + 1, 2 * r + 1] = smooth
        step[2 * r, 0::2] = step[2 * r + 1, 0::2] = smooth
    emit = [np.full((STATES, n), smooth) for n in SIZES]
    before = (None, 0)
    for conv, role, lines, counts in turns:
        if role not in ROLES:
            continue
        begin = 2 * ROLES.index(role)
        if before[0] != conv:
            first[begin] += 1
        else:
            step[before[1], begin] += 1
        step[begin, begin + 1] += lines > 1
        step[begin + 1, begin + 1] += max(lines - 2, 0)
        parts = np.split(np.array(counts).reshape(2, -1), np.cumsum(SIZES)[:-1], axis=1)
        for e, part in zip(emit, parts):
            e[begin:begin + 2] += part
        before = (conv, begin + (lines > 1))
    return Model(np.log(first / first.sum()), np.log(step / step.sum(axis=1, keepdims=True)),
                 [np.log(e / e.sum(axis=1, keepdims=True)) for e in emit])


def block_matrix(model: Model, lines: list[str]) -> np.ndarray:
    """Best log weight from the state before the block to its last state."""
    out = None
    for line in lines:
        one = model.step + model.emission(line)[None, :]
        out = one if out is None else (out[:, :, None] + one[None, :, :]).max(axis=1)
    return out


def decode(model: Model, lines: list[str], before: int, last: int) -> list[int]:
    """States of a block's lines given the state before it (-1: the transcript begins) and its last state."""
    back, score = [], None
    for k, line in enumerate(lines):
        e = model.emission(line)
        if k == 0:
            score = (model.first if before < 0 else model.step[before]) + e
        else:
            paths = score[:, None] + model.step
            back.append(paths.argmax(axis=0))
            score = paths.max(axis=0) + e
    out = [last]
    for pointers in reversed(back):
        out.append(int(pointers[out[-1]]))
    return out[::-1]


def chain(first: np.ndarray, matrices: list[np.ndarray], last: int | None) -> list[tuple[int, int]]:
    """(state before, last state) of consecutive blocks; ``first`` scores the states before them."""
    scores = [first]
    for m in matrices:
        scores.append((scores[-1][:, None] + m).max(axis=0))
    at, out = int(scores[-1].argmax()) if last is None else last, []
    for v, m in zip(scores[-2::-1], reversed(matrices)):
        before = int((v + m[:, at]).argmax())
        out.append((before, at))
        at = before
    return out[::-1]


def _lines(rows: list[dict]) -> list[str]:
    return [line for r in rows for line in (r["text"] or "").split("\n")]


def _matrices_with(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for block, rows in zip(batch.column(1).to_pylist(), batch.column(2)):
                lines = _lines(rows.as_py())
                m = block_matrix(model, lines)
                if block == 0:                 # state before the first block does not matter: every row is the beginning
                    start = model.first + model.emission(lines[0])
                    rest = block_matrix(model, lines[1:])
                    m = np.tile(start if rest is None else (start[:, None] + rest).max(axis=0), (STATES, 1))
                out.append(m.ravel())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.float64()))],
                                             names=["conv_id", "block", "matrix"])
    return run


def _product(batches):
    for batch in batches:
        out = []
        for rows in batch.column(2):
            total = None
            for r in rows.as_py():
                m = np.array(r["matrix"]).reshape(STATES, STATES)
                total = m if total is None else (total[:, :, None] + m[None, :, :]).max(axis=1)
            out.append(total.ravel())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.float64()))],
                                         names=["conv_id", "block", "matrix"])


def _chained(batches):
    for batch in batches:
        conv, block, before, last = [], [], [], []
        for i in range(batch.num_rows):
            row = {n: batch.column(k)[i].as_py() for k, n in enumerate(batch.schema.names)}
            ms = [np.array(r["matrix"]).reshape(STATES, STATES) for r in row["blocks"]]
            first = np.zeros(STATES)
            if row["before"] is not None:
                first = np.full(STATES, -np.inf)
                first[row["before"]] = 0.0
            for r, (a, b) in zip(row["blocks"], chain(first, ms, row["last"])):
                conv.append(i)
                block.append(r["block"])
                before.append(a)
                last.append(b)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(conv, pa.int64())), pa.array(block, pa.int64()),
                                          pa.array(before, pa.int32()), pa.array(last, pa.int32())],
                                         names=["conv_id", "block", "before", "last"])


def _block_states(matrices: DataFrame, kind: str) -> DataFrame:
    """``conv_id``, ``block``, ``before``, ``last``: states around each block, tier by tier."""
    tier = (matrices.withColumn("up", F.floor(F.col("block") / FAN)).groupBy("conv_id", "up")
            .agg(F.array_sort(F.collect_list(F.struct("block", "matrix"))).alias("blocks")))
    schema = f"conv_id {kind}, block long, before int, last int"
    if (matrices.agg(F.max("block")).first()[0] or 0) < FAN:
        whole = tier.select("conv_id", F.lit(None).cast("int").alias("before"), F.lit(None).cast("int").alias("last"), "blocks")
        return whole.mapInArrow(_chained, schema)
    upper = written(tier.select("conv_id", "up", "blocks").mapInArrow(
        _product, f"conv_id {kind}, block long, matrix array<double>"), "tier")
    around = _block_states(upper, kind).withColumnsRenamed({"block": "up", "conv_id": "c"})
    joined = tier.join(around, tier.conv_id.eqNullSafe(around.c) & (tier.up == around.up))
    return joined.select("conv_id", "before", "last", "blocks").mapInArrow(_chained, schema)


def _segments_with(model: Model):
    def run(batches):
        names = ["conv_id", "block", "part", "begins", "role", "text"]
        for batch in batches:
            where, block, part, begins, role, text = [], [], [], [], [], []
            for i in range(batch.num_rows):
                number, before, last = (batch.column(k)[i].as_py() for k in (1, 2, 3))
                lines = _lines(batch.column(4)[i].as_py())
                states = decode(model, lines, -1 if number == 0 else before, last)
                at, n = 0, 0
                while at < len(lines):
                    end = at + 1
                    while end < len(lines) and states[end] % 2:
                        end += 1
                    first = lines[at][marker(lines[at])[1]:] if states[at] % 2 == 0 else lines[at]
                    where.append(i)
                    block.append(number)
                    part.append(n)
                    begins.append(states[at] % 2 == 0)
                    role.append(ROLES[states[at] // 2])
                    text.append("\n".join([first, *lines[at + 1:end]]))
                    at, n = end, n + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(where, pa.int64())), pa.array(block, pa.int64()), pa.array(part, pa.int32()),
                 pa.array(begins, pa.bool_()), pa.array(role, pa.string()), pa.array(text, pa.string())], names=names)
    return run


#: Bits of the text's hash by which the rows of one ``pos`` are dealt while they are numbered.
DEAL_BITS = 10


def blocked(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``block`` (gapless from 0), ``rows`` (at most ROWS_PER_BLOCK of pos, text; in order)."""
    size = ROWS_PER_BLOCK
    ranged = rows.select("conv_id", "pos", F.coalesce("text", F.lit("")).alias("text"), F.floor(F.col("pos") / size).alias("range"))
    sizes = ranged.groupBy("conv_id", "range").agg(F.count(F.lit(1)).alias("n"))
    earlier = W.partitionBy("conv_id").orderBy(F.col("range").asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1)
    base = written(sizes.select(F.col("conv_id").alias("c"), F.col("range").alias("r"), "n", F.coalesce(
        F.sum(F.ceil(F.col("n") / size)).over(earlier), F.lit(0)).cast("long").alias("base")), "ranges")

    def in_range(table):
        return ranged.join(table, ranged.conv_id.eqNullSafe(table.c) & ranged.range.eqNullSafe(table.r)).drop("c", "r")

    def in_order(*extra):
        return F.transform(F.array_sort(F.collect_list(F.struct(F.col("pos").isNotNull().alias("known"), "pos", F.xxhash64("text").alias("h"),
                                                                "text", *extra))), lambda p: F.struct(p["pos"].alias("pos"), p["text"].alias("text"),
                                                                                                      *[p[c].alias(c) for c in extra]))
    few = (in_range(base.filter(F.col("n") <= size)).groupBy("conv_id", "range", "base").agg(in_order().alias("rows"))
           .select("conv_id", F.col("base").alias("block"), "rows"))
    if base.filter(F.col("n") > size).isEmpty():
        return few
    # ranges of many rows: equal rows once, with their number; numbered by pos and hash, dealt by both
    keys = ["conv_id", "range", "pos", "deal"]
    dealt = F.shiftrightunsigned(F.xxhash64("text"), 64 - DEAL_BITS).cast("int")
    equal = written(in_range(base.filter(F.col("n") > size)).groupBy("conv_id", "range", "base", "pos", "text")
                    .agg(F.count(F.lit(1)).alias("times")).withColumn("deal", dealt), "equal")
    ahead = W.partitionBy("conv_id", "range").orderBy(F.col("pos").asc_nulls_first(), "deal").rowsBetween(W.unboundedPreceding, -1)
    offsets = (equal.groupBy(*keys).agg(F.sum("times").alias("n"))
               .select(*[F.col(k).alias(f"o_{k}") for k in keys], F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("offset")))
    inside = W.partitionBy(*keys).orderBy(F.xxhash64("text"), "text").rowsBetween(W.unboundedPreceding, -1)
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"o_{k}")) for k in keys])
    start, times = F.col("start"), F.col("times")
    placed = (equal.withColumn("within", F.coalesce(F.sum("times").over(inside), F.lit(0))).join(offsets, same)
              .withColumn("start", F.col("offset") + F.col("within"))
              .withColumn("cut", F.explode(F.sequence(F.floor(start / size), F.floor((start + times - 1) / size))))
              .withColumn("times", F.least(start + times, (F.col("cut") + 1) * size) - F.greatest(start, F.col("cut") * size)))
    many = (placed.groupBy("conv_id", "range", "base", "cut").agg(in_order("times").alias("rows"))
            .select("conv_id", (F.col("base") + F.col("cut")).cast("long").alias("block"),
                    F.flatten(F.transform("rows", lambda p: F.array_repeat(F.struct(p["pos"].alias("pos"), p["text"].alias("text")),
                                                                           p["times"].cast("int")))).alias("rows")))
    return few.unionByName(many)


def escaped(content: Column) -> Column:
    """Text in which no mark of the template occurs: each ``<|`` gets a backslash inside, one more if it has some."""
    return F.regexp_replace(content, r"<(\\*)\|", r"<\\$1|")


def unescaped(content: Column) -> Column:
    return F.regexp_replace(content, r"<\\(\\*)\|", "<$1|")


def read_back(rendered: Column) -> Column:
    """(role, content) of a rendered turn; of several, one after another, an array of them."""
    turns = F.regexp_extract_all(rendered, F.lit(r"(?s)<\|im_start\|>(.*?)<\|im_end\|>"), F.lit(1))
    return F.transform(turns, lambda t: F.struct(F.substring_index(t, "\n", 1).alias("role"), unescaped(
        F.substring(t, F.locate("\n", t) + 1, F.length(t))).alias("content")))


def parse(transcripts: DataFrame, model: Model, conv_col: str = "conv_id", pos_col: str = "pos",
          text_col: str = "text") -> DataFrame:
    """One row per recovered turn: ``conv_id``, ``turn`` (from 0), ``role``, ``content``, ``rendered``."""
    ship_package(transcripts.sparkSession)
    rows = transcripts.select(F.col(conv_col).alias("conv_id"), F.col(pos_col).alias("pos"), F.col(text_col).alias("text"))
    kind = rows.schema["conv_id"].dataType.simpleString()
    blocks = written(blocked(rows), "blocks")
    matrices = written(blocks.select("conv_id", "block", "rows").mapInArrow(
        _matrices_with(model), f"conv_id {kind}, block long, matrix array<double>"), "matrices")
    around = _block_states(matrices, kind).withColumnsRenamed({"conv_id": "c", "block": "b"})
    framed = (blocks.join(around, blocks.conv_id.eqNullSafe(around.c) & (blocks.block == around.b))
              .select("conv_id", "block", "before", "last", "rows"))
    segments = written(framed.mapInArrow(_segments_with(model), f"conv_id {kind}, block long, part int, begins boolean, "
                                         "role string, text string"), "segments")
    # Turn numbers: begins counted per block, then summed over the earlier blocks.
    counts = segments.groupBy("conv_id", "block").agg(F.count_if("begins").alias("n"))
    earlier = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    base = counts.select(F.col("conv_id").alias("c"), F.col("block").alias("b"),
                         F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = W.partitionBy("conv_id", "block").orderBy("part").rowsBetween(W.unboundedPreceding, 0)
    numbered = (segments.withColumn("k", F.count_if("begins").over(inside))
                .join(base, segments.conv_id.eqNullSafe(F.col("c")) & (segments.block == F.col("b")))
                .withColumn("turn", F.col("base") + F.col("k") - 1))
    parts = F.array_sort(F.collect_list(F.struct("block", "part", "text")))
    turns = numbered.groupBy("conv_id", "turn").agg(F.min_by("role", F.struct("block", "part")).alias("role"),
                                                    F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("content"))
    before, after = TEMPLATE.split("{role}")[0], TEMPLATE.split("{text}")[1]
    rendered = F.concat(F.lit(before), "role", F.lit("\n"), escaped(F.col("content")), F.lit(after))
    return turns.select("conv_id", "turn", "role", "content", rendered.alias("rendered"))


def _tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lines, counts = zip(*map(tally, batch.column(3).to_pylist())) if batch.num_rows else ((), ())
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(lines, pa.int64()), pa.array(counts, pa.list_(pa.int64()))],
                                         names=["conv_id", "turn", "role", "lines", "counts"])


def fit(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
        text_col: str = "text", sample: int = SAMPLE_ROWS) -> Model:
    """Train on at most ``sample`` labelled turns, whole ones: those of the conversations with the smallest hashes."""
    ship_package(turns.sparkSession)
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"),
                        F.col(text_col).alias("text")).orderBy(F.xxhash64(conv_col), conv_col, turn_col).limit(sample)
    kinds = [rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn", "role")]
    tallies = rows.mapInArrow(_tallied, "conv_id {}, turn {}, role {}, lines long, counts array<long>".format(*kinds))
    found = tallies.orderBy(F.xxhash64("conv_id"), "conv_id", "turn").collect()
    return train_tallied([(r["conv_id"], r["role"], r["lines"], r["counts"]) for r in found])
