"""Secret scans: base patterns, and probabilistic automata inferred from labelled credentials.

Labelled credentials (values with a kind) are generalised to symbols (the
first characters literally, then character classes).  Per kind, a probabilistic
automaton grows round by round: all values are traced through it in the tasks
as far as it goes, which counts the next ``AHEAD`` symbols at its states and behind
its open steps; an open step leads to the first state whose frequencies agree
by Hoeffding's bound (states are merged), or else to a new one.  Candidates are the runs
of the labelled values' characters (a class that occurs counts whole) that are as
long as short labelled values are, cut at the base spans.  Every candidate of
every text is scored: the log likelihood ratio per
character of the best automaton against a class model of ordinary tokens
(numbers, of digits alone, have uniform digits for a model and are left out of
the other).  Candidates that
reach the cut of their kind become spans of the kind ``format``; in those that do not, and in
those longer than labelled values are, every window of a labelled value's
length is scored, and of overlapping windows that reach the cut the best are
the spans, so what stands before or behind a credential does not hide it.
The cut of a kind is the ``HELD_SHARE`` quantile of its labelled credentials,
each scored by an automaton fitted without it; unlabelled credentials among the
ordinary tokens do not raise it, and tokens that reach a cut are left out of the
final model of ordinary tokens.

Everything is fitted on all that occurs in the texts, whatever the input's size:
the automata on all distinct values, the cuts on the scores of all of them, the
class model on all distinct ordinary tokens.  The driver gets counts by state and
symbols, by length and by class, and a cut's scores narrowed to a few.  The scan
covers whole texts of all rows.  Values
are fitted and tokens scored at their whole length, ``LONG`` characters at a time.

Defined results for odd input: null and empty texts have no spans; repeated rows
are scanned alike; without labelled credentials only base spans are reported;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_package, written

LITERAL = 4
#: States are compared by what may follow in so many symbols.
AHEAD = 2
ALPHA = 0.05
#: A format span must reach this many bits per character, and the score that all but this share of held-out credentials reach.
LEAST_BITS = 0.6
HELD_SHARE = 0.05
#: Longer values go through the automata in consecutive pieces; no window is longer.
LONG = 512
#: Quantiles of the labelled lengths that are the lengths of windows; candidates have the first one at least, and LEAST.
LENGTHS = (0.05, 0.5, 0.95)
LEAST = 6
#: Ordinary tokens have so many characters at least, or those of a short labelled value.
ORDINARY = 16
#: Log2 of an unseen step: as much as one count in a thousand.
UNSEEN = math.log2(1e-3 / 64)

# The base patterns (ASCII, keyword letters in either case).
PATTERNS = {
    "assign": r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}
BASE = tuple(PATTERNS)
_ASSIGN = re.compile(PATTERNS["assign"], re.A | re.I)
_ACCESS = re.compile(PATTERNS["access"] .replace("+", "{16,}"))
_HEX = re.compile("[0-9a-f]{24,}")
_CLASSES = {c: k for k, cs in {"0": "0123456789", "a": "abcdef", "z": "ghijklmnopqrstuvwxyz", "A": "ABCDEF",
                               "Z": "GHIJKLMNOPQRSTUVWXYZ"}.items() for c in cs}
_CLASS_SIZE = Counter(_CLASSES.values())
_CLASS_BITS = {k: math.log2(n) for k, n in _CLASS_SIZE.items()}


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the base kinds."""
    found = [(m.start(), "assign", m.end()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    found += [(m.start(), "access", m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), "hex", m.end()) for m in _HEX.finditer(text)]
    return found


def symbols(value: str) -> list[str]:
    return [c if i < LITERAL else _CLASSES.get(c, c) for i, c in enumerate(value)]


def pieces(value: str) -> list[str]:
    """Consecutive pieces of at most ``LONG`` characters that make up the value."""
    return [value[i:i + LONG] for i in range(0, len(value), LONG)]


def lengths_of(lengths: Counter) -> list[int]:
    """Lengths of windows: quantiles of the values' lengths, which are given with their counts."""
    rows, out = sorted(lengths.items()), set()
    for q in LENGTHS if rows else ():
        rank = int(q * (lengths.total() - 1))
        for length, n in rows:
            rank -= n
            if rank < 0:
                out.add(min(max(LEAST, length), LONG))
                break
    return sorted(out)


def candidate_pattern(chars: set[str], least: int) -> str | None:
    """Regular expression of the runs of ``least`` and more characters that may hold a credential of these characters."""
    if not chars:
        return None
    ranges = [r for r, low, high in (("0-9", "0", "9"), ("A-Z", "A", "Z"), ("a-z", "a", "z")) if any(low <= c <= high for c in chars)]
    marks = "".join("\\" + c for c in sorted(chars) if not (c.isascii() and c.isalnum()))
    return f"[{''.join(ranges)}{marks}]{{{least},}}"


#: What stands behind the last symbol of a value.
END = "\0"
#: A machine's key: kind, and the half of the values that is held out (-1: none).
Key = tuple[str, int]


class Automaton:
    """A probabilistic automaton: per state, how often strings end there and take each symbol."""

    def __init__(self, alpha: float = ALPHA):
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        self.next: list[dict[str, int]] = [{}]
        self.read = [0]                                        # symbols read to get to a state, LITERAL at most
        self.count: list[Counter] = [Counter()]
        self.end = [0]
        self.logs: list[dict[str, float]] = [{}]

    def tally(self, value: str, found: Counter, key: Key = ("", -1)):
        """Count what follows at the states that a value passes, up to and behind its first open step."""
        for piece in pieces(value):
            at, symbol, s = 0, "", symbols(piece) + [END]
            for i in range(len(s)):
                found[key, at, symbol, ""] += 1
                for k in range(1, min(AHEAD, len(s) - i) + 1):
                    found[key, at, symbol, "".join(s[i:i + k])] += 1
                if symbol or s[i] == END:
                    break
                if s[i] in self.next[at]:
                    at = self.next[at][s[i]]
                else:
                    symbol = s[i]

    def _agree(self, a: Counter, b: Counter) -> bool:
        n, m = a[""], b[""]
        if not n or not m:
            return True
        bound = self.bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))
        return bound >= 1 or all(abs(a[x] / n - b[x] / m) <= bound for x in {*a, *b})

    def grow(self, seen: dict[tuple[int, str], Counter]) -> bool:
        """Settle the open steps (state, symbol) by what follows; without any, take over the counts and be done."""
        known = [seen.get((q, ""), Counter()) for q in range(len(self.next))]
        steps = sorted((x for x in seen if x[1]), key=lambda x: (-seen[x][""], x))
        for p, c in steps:
            read = min(self.read[p] + 1, LITERAL)              # literal symbols and classes do not mix
            q = next((q for q, r in enumerate(self.read) if r == read and self._agree(known[q], seen[p, c])), len(self.next))
            if q == len(self.next):
                self.next.append({})
                self.read.append(read)
                known.append(Counter())
            self.next[p][c] = q
            known[q].update(seen[p, c])
        if not steps:
            self.count = [Counter({x: n for x, n in k.items() if len(x) == 1 and x != END}) for k in known]
            self.end = [k[END] for k in known]
            self.logs = [{c: math.log2(n / k[""]) for c, n in counts.items()} for k, counts in zip(known, self.count)]
        return bool(steps)

    def log_likelihood(self, value: str) -> float:
        """Log2 probability of the characters; an unseen step costs ``UNSEEN``."""
        out = 0.0
        for piece in pieces(value):
            at = 0
            for i, s in enumerate(symbols(piece)):
                seen = self.logs[at].get(s)
                if seen is None:
                    out += UNSEEN
                    continue
                out += seen - (_CLASS_BITS.get(s, 0.0) if i >= LITERAL else 0.0)
                at = self.next[at][s]
        return out


def tallied(rows: Iterable[tuple[str, int, str]], machines: dict[Key, Automaton], found: Counter):
    """Count (kind, half, value) in the machines of all values of the kind, and of those without the other half."""
    for kind, half, value in rows:
        for key in ((kind, -1), (kind, 1 - half)):
            if key in machines:
                machines[key].tally(value, found, key)


def learn(keys: Iterable[Key], count: Callable[[dict[Key, Automaton]], Counter]) -> dict[Key, Automaton]:
    """Grow machines on what ``count`` finds; a round settles one more symbol of every value at least."""
    done = {key: Automaton() for key in keys}
    growing = dict(done)
    while growing:
        seen: dict[Key, dict] = defaultdict(lambda: defaultdict(Counter))
        for (key, at, symbol, path), n in count(growing).items():
            seen[key][at, symbol][path] = n
        growing = {key: machine for key, machine in growing.items() if machine.grow(seen[key])}
    return done


def _automaton(values: list[str]) -> Automaton:
    """An automaton of values at hand."""
    return learn([("", -1)], Values([("", 0, v) for v in values], []).count)["", -1]


class Values:
    """Labelled values (kind, half, value) and ordinary tokens at hand."""

    def __init__(self, rows: list[tuple[str, int, str]], ordinary: list[str]):
        self.rows, self.ordinary = rows, ordinary

    def keys(self) -> list[Key]:
        return sorted({key for kind, half, _ in self.rows for key in ((kind, -1), (kind, 1 - half))})

    def lengths(self) -> Counter:
        return Counter(min(len(v), LONG) for _, _, v in self.rows)

    def chars(self) -> set[str]:
        return {c for _, _, v in self.rows for c in v}

    def count(self, machines: dict[Key, Automaton]) -> Counter:
        found = Counter()
        tallied(self.rows, machines, found)
        return found

    def classes(self, model: Model | None) -> Counter:
        found = Counter()
        ordinary_classes(self.ordinary, model, found)
        return found

    def cuts(self, model: Model) -> dict[str, float]:
        found = defaultdict(list)
        for kind, score in held_out(self.rows, model):
            found[kind].append(score)
        return {kind: sorted(scores)[int(HELD_SHARE * len(scores))] for kind, scores in found.items()}


#: A token's classes count as ONE together, in whole numbers, so that the order of sums does not matter.
ONE = 16 << 40


def ordinary_classes(tokens: Iterable[str], model: Model | None, found: Counter):
    """Add the tokens' classes, each token counting alike; numbers and what reaches a cut of the model are left out."""
    for v in tokens:
        if not v.isdecimal() and not base_spans(v) and not (model and model.credible(v)[1]):
            for s, n in Counter(_CLASSES.get(c, c) for c in v).items():
                found[s] += n * ONE // len(v)


def held_out(rows: Iterable[tuple[str, int, str]], model: Model) -> Iterator[tuple[str, float]]:
    """(kind, score) of values, each by the automaton of the other half."""
    for kind, half, v in rows:
        if (kind, half) in model.machines:
            yield kind, (model.machines[kind, half].log_likelihood(v) - model._plain(v)) / len(v)


class Model:
    """Automata and cuts per kind, and the class model of ordinary tokens."""

    def __init__(self, credentials: dict[str, list[str]] | None = None, ordinary: list[str] = (), source: Values | None = None):
        source = source or Values([(k, i % 2, v) for k, values in (credentials or {}).items() for i, v in enumerate(values)], ordinary)
        self.machines = learn(source.keys(), source.count)
        self.automata = {kind: machine for (kind, half), machine in self.machines.items() if half < 0}
        self.windows, chars = lengths_of(source.lengths()), source.chars()
        self.marks = sorted(chars - set(_CLASSES))
        pattern = candidate_pattern(chars, self.windows[0]) if chars else None
        self.candidate = re.compile(pattern) if pattern else None
        for model in (None, self):                             # again without the tokens that reach a cut
            self._calibrate(source, model)
        self.machines = {}

    def _calibrate(self, source: Values, model: Model | None):
        """Set the class model (each token counts alike, whatever its length) and the cuts."""
        tally = Counter([*_CLASS_SIZE, *"+/_=-", *self.marks])
        for s, n in source.classes(model).items():
            tally[s] += n / (ONE // 16)
        total = sum(n for _, n in sorted(tally.items()))
        self.ordinary = {s: math.log2(n / total) - _CLASS_BITS.get(s, 0.0) for s, n in tally.items()}
        held = source.cuts(self) if self.automata else {}
        self.cuts = {kind: max(LEAST_BITS, held.get(kind, LEAST_BITS)) for kind in self.automata}

    def _plain(self, value: str) -> float:
        """Log2 probability as an ordinary token."""
        plain = sum(self.ordinary.get(_CLASSES.get(c, c), -20.0) for c in value)
        return max(plain, -math.log2(10) * len(value)) if value.isdecimal() else plain

    def score(self, value: str) -> tuple[str | None, float]:
        """The best kind and its log likelihood ratio per character in bits."""
        if not self.automata:
            return None, -math.inf
        bits, best = max(((a.log_likelihood(value), k) for k, a in self.automata.items()), key=lambda x: x[0])
        return best, (bits - self._plain(value)) / len(value)

    def credible(self, value: str) -> tuple[float, bool]:
        """The score in bits, and whether it reaches the cut of its kind."""
        kind, bits = self.score(value)
        return bits, kind is not None and bits >= self.cuts[kind]


    def credible_parts(self, token: str) -> list[tuple[int, int, float]]:
        """(start, end, bits) of the parts of a candidate that reach a cut: the whole, or windows of labelled lengths."""
        def bits_of(parts):
            return sum(bits * (end - start) for start, end, bits in parts)
        bits, credible = self.credible(token)
        whole = [(0, len(token), bits)] if credible else []
        if whole and len(token) <= self.windows[-1]:
            return whole
        found = [(bits * w, w, at) for w in self.windows if w < len(token) for at in range(len(token) - w + 1)
                 for bits, credible in [self.credible(token[at:at + w])] if credible]
        taken, starts, ends = [], [], []
        for total, w, at in sorted(found, key=lambda f: (-f[0], f[2])):
            k = bisect_left(ends, at + 1)                      # the first part that ends behind this one's start
            if k == len(starts) or starts[k] >= at + w:
                starts.insert(k, at)
                ends.insert(k, at + w)
                taken.append((at, at + w, total / w))
        if whole and bits_of(whole) >= bits_of(taken):
            return whole                                       # long as a whole, not a short one in something else
        return sorted(taken) or whole


def _tally_with(machines: dict[Key, Automaton]):
    def rows(found):
        keys = list(found)
        kind, held, at, symbol, path = zip(*[(*k, *rest) for k, *rest in keys]) if keys else ((),) * 5
        return pa.RecordBatch.from_arrays(
            [pa.array(kind, pa.string()), pa.array(held, pa.int32()), pa.array(at, pa.int32()), pa.array(symbol, pa.string()),
             pa.array(path, pa.string()), pa.array(list(found.values()), pa.int64())], names=["kind", "held", "at", "symbol", "path", "n"])

    def run(batches):
        found = Counter()
        for batch in batches:
            tallied(zip(*(c.to_pylist() for c in batch.columns)), machines, found)
            if len(found) > 200_000:
                yield rows(found)
                found = Counter()
        yield rows(found)
    return run


def _classes_with(model: Model | None):
    def run(batches):
        found = Counter()
        for batch in batches:
            ordinary_classes(batch.column(0).to_pylist(), model, found)
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array([str(n) for n in found.values()], pa.string())],
                                         names=["symbol", "n"])
    return run


def _held_with(model: Model):
    def run(batches):
        for batch in batches:
            found = list(held_out(zip(*(c.to_pylist() for c in batch.columns)), model))
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())],
                                             names=["kind", "score"])
    return run


#: Scores that the driver takes to pick one of them by its rank; more are narrowed first.
PICKED, BINS = 1000, 256


def by_rank(frame: DataFrame, column: str, rank: int) -> float:
    """The value of that rank (from 0): the rows are narrowed to the bin that holds it until few or equal ones are left."""
    c = F.col(column)
    while True:
        low, high, n = frame.agg(F.min(c), F.max(c), F.count(c)).first()
        width = (high - low) / BINS
        if n <= PICKED or not width:
            break
        place = F.least(F.floor((c - F.lit(low)) / F.lit(width)), F.lit(BINS - 1))
        for b, n in sorted(frame.groupBy(place.alias("b")).count().collect()):
            if rank < n:
                frame = frame.filter(place == b)
                break
            rank -= n
    return sorted(r[0] for r in frame.select(c).collect())[rank] if n <= PICKED else low


class SpreadValues(Values):
    """Labelled values and ordinary tokens in tables: ``kind``, ``half``, ``v``; ``v``."""

    def __init__(self, values: DataFrame, tokens: DataFrame):
        self.values, self.tokens = values, tokens

    def keys(self) -> list[Key]:
        found = self.values.select("kind", "half").distinct().collect()
        return sorted({key for r in found for key in ((r["kind"], -1), (r["kind"], 1 - r["half"]))})

    def lengths(self) -> Counter:
        return Counter(dict(self.values.groupBy(F.least(F.length("v"), F.lit(LONG))).count().collect()))

    def chars(self) -> set[str]:
        return {r[0] for r in self.values.select(F.explode(F.split("v", ""))).distinct().collect()} - {""}

    def count(self, machines: dict[Key, Automaton]) -> Counter:
        found = (self.values.mapInArrow(_tally_with(machines), "kind string, held int, at int, symbol string, path string, n long")
                 .groupBy("kind", "held", "at", "symbol", "path").agg(F.sum("n").alias("n")))
        return Counter({((r[0], r[1]), r[2], r[3], r[4]): r[5] for r in found.collect()})

    def classes(self, model: Model | None) -> Counter:
        found = self.tokens.mapInArrow(_classes_with(model), "symbol string, n string")
        return Counter({s: int(n) for s, n in found.groupBy("symbol").agg(F.sum(F.col("n").cast("decimal(38,0)"))).collect()})

    def cuts(self, model: Model) -> dict[str, float]:
        scores = written(self.values.mapInArrow(_held_with(model), "kind string, score double"), "scores")
        return {kind: by_rank(scores.filter(F.col("kind") == kind), "score", int(HELD_SHARE * n))
                for kind, n in scores.groupBy("kind").count().collect()}


def fit(docs: DataFrame, text_col: str = "text", sample: int | None = None) -> Model:
    """Fit on all values that base patterns label and all ordinary tokens of ``docs``.

    A ``sample`` asks for so many of each kind, those with the smallest hashes; the registered query asks for none."""
    ship_package(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    assign = "(?i)" + PATTERNS["assign"]
    patterns = {"assign": (assign, 2), "access": ("AKIA[A-Z0-9]{16,}", 0), "hex": ("[0-9a-f]{24,}", 0)}

    def matches(kind, pattern, group):
        return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)),
                           lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("v")))

    def some(frame):
        return frame if sample is None else frame.orderBy(F.xxhash64("v"), "v").limit(sample)
    found = (docs.select(F.explode(F.concat(*[matches(kind, *p) for kind, p in patterns.items()])).alias("x"))
             .select("x.kind", "x.v").filter((F.col("kind") != "assign") | (F.length("v") >= 6)).distinct())
    half = F.pmod(F.xxhash64("v", F.lit(1)), F.lit(2)).cast("int")
    found = written(found.select("kind", half.alias("half"), "v"), "values")
    labels = found if sample is None else reduce(DataFrame.unionByName, [some(found.filter(F.col("kind") == k)) for k in patterns])
    source = SpreadValues(labels, labels.select("v"))
    chars = source.chars()
    if not chars:
        return Model()
    pattern = candidate_pattern(chars, min(ORDINARY, lengths_of(source.lengths())[0]))      # words, too, where labels are long
    tokens = docs.select(F.explode(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias("v")).distinct()
    source.tokens = written(some(tokens.join(found.select("v"), "v", "left_anti")
                                 .filter(~F.col("v").rlike(f"{patterns['access'][0]}|{patterns['hex'][0]}"))), "tokens")
    return Model(source=source)


def _outside(start: int, end: int, taken: list[tuple[int, int]], first: int) -> Iterator[tuple[int, int]]:
    """The parts of ``start:end`` that no interval of ``taken`` (sorted; those before ``first`` lie before) meets."""
    for k in range(first, len(taken)):
        a, b = taken[k]
        if a >= end:
            break
        if a > start:
            yield start, a
        start = max(start, b)
    if start < end:
        yield start, end


def scan_text(text: str, model: Model) -> list[tuple[int, str, int, float]]:
    """All spans of a text: (start, kind, end, bits), by start and then kind; base spans carry their score, too."""
    base = base_spans(text)
    out = [(s, k, e, model.score(text[s:e])[1]) for s, k, e in base]
    taken = sorted((a, b) for a, _, b in base)
    first = 0
    for m in model.candidate.finditer(text) if model.candidate else ():
        s, e = m.span()
        while first < len(taken) and taken[first][1] <= s:
            first += 1
        for at, end in _outside(s, e, taken, first):
            if end - at >= model.windows[0]:
                out += [(at + a, "format", at + b, bits) for a, b, bits in model.credible_parts(text[at:end])]
    order = {k: i for i, k in enumerate((*BASE, "format"))}
    return sorted(out, key=lambda x: (x[0], order[x[1]]))


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32()), ("score", pa.float64())]))


def _scan_with(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                spans = [[{"start": s, "kind": k, "end": e, "score": b} for s, k, e, b in scan_text(t.as_py() or "", model)]
                         for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(spans, _SPANS)], names=["doc_id", "spans"])
    return run


def scan(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id`` and ``spans`` (start, kind, end, score)."""
    ship_package(docs.sparkSession)
    model = model or fit(docs, text_col)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(_scan_with(model), f"doc_id {kind}, spans array<struct<start:int,kind:string,end:int,score:double>>")
