"""Cross-tokenizer alignment of a byte-level BPE (A) and a sentence-piece model (B).

Documents are first made distinct by their full text (copies collapse inside the
tasks, then texts are shuffled by themselves), so each distinct text is tokenised
and aligned once, whatever its number of copies.  Both token sequences spell the
same bytes, a space and the text; byte offsets where tokens of A and B both end cut
them into groups, and each stretch between two ends of any kind is one link, the
overlap of one A token with one B token.

How many documents hold an id pair linked is counted per task (each text weighs as
many documents as it has copies) and then by Spark.  The measures of a text look its
distinct pairs up in these counts: the pairs most documents hold are broadcast (at
most ``HELD`` rows, chosen by count), any others are joined by shuffle, where each
is rare.  Measures return to the documents by the digest of the text.

``Aligner`` cuts texts before a space that follows a character which is surely not
white: neither model joins anything across such a place (checked on loading;
otherwise texts are taken whole).  A unit's tokens, groups and links are remembered
up to a bound of bytes.

Defined results for odd input: null and empty texts, and texts whose joined token
bytes of A or B are not the space and the text, have no tokens: zeros and an empty
``groups_sha256``; null ids and repeated rows keep a result each and count as
documents; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_package, written

#: Pairs whose counts are broadcast at most (about 50 bytes each); beyond it the rarer ones join by shuffle.
HELD = 500_000
#: Bytes of remembered units in a worker; beyond it those met once are forgotten.
REMEMBERED = 128 << 20
#: Pairs that a task holds before it passes their counts on.
PENDING = 2_000_000
#: A cut: before a space, after a character that no Unicode version calls white.
_CUT = re.compile(r"(?<=[!-~\w])(?= )")
_SPACE = "▁"
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")
MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def _byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the rest from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Aligner:
    """Tokens of both models and their alignment, by remembered units."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True                # their strings are ordinary text
        self.a.no_truncation()
        self.a.no_padding()
        self.b = SentencePieceProcessor(model_file=path_b)
        alphabet = _byte_alphabet()
        vocabulary = self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = []
        for piece in pieces:
            coded = _BYTE.fullmatch(piece)
            self.bytes_b.append(bytes([int(coded[1], 16)]) if coded else piece.replace(_SPACE, " ").encode())
        self.space_b = [self.b.piece_to_id(_SPACE)]
        self.ids = max(len(self.bytes_a), len(self.bytes_b))
        self.words = [f"{i}{mark}" for mark in ",|;" for i in range(self.ids)]
        split = json.loads(self.a.to_str()).get("pre_tokenizer") or {}
        self.cuttable = (split.get("type") == "ByteLevel" and split.get("use_regex", True)
                         and not any(_SPACE in piece.lstrip(_SPACE) for piece in pieces)
                         and pieces[self.space_b[0]] == _SPACE)
        self.forget()

    def forget(self):
        self.number: dict[str, int] = {}
        self.groups: list[str] = []
        self.good = np.empty(0, bool)
        self.sizes = np.empty((0, 4), np.int64)            # tokens of A, of B, groups, links
        self.links = np.empty(0, np.int64)                 # packed pairs of linked ids, unit after unit
        self.used = np.empty(0, np.int64)                  # how often a unit was met
        self.held = 0

    def _links_of(self, at: np.ndarray) -> np.ndarray:
        """The links of the units numbered ``at``, one after another."""
        count = self.sizes[at, 3]
        done = np.cumsum(count)
        return self.links[np.repeat(self.first_link[at] - (done - count), count) + np.arange(done[-1])]

    def shrink(self):
        """Forget the units met only once since the last time; all of them if that is not enough."""
        keep = np.flatnonzero(self.used > 1)
        if not len(keep) or len(keep) > len(self.used) // 2:
            self.forget()
            return
        units, share = list(self.number), len(keep) / len(self.used)
        self.links = self._links_of(keep)
        self.number = {units[i]: k for k, i in enumerate(keep.tolist())}
        self.groups = [self.groups[i] for i in keep.tolist()]
        self.good, self.sizes, self.used = self.good[keep], self.sizes[keep], np.zeros(len(keep), np.int64)
        self.held = int(self.held * share)

    def _spelled(self, units: list[bytes], ids: list[list[int]], table: list[bytes], ok: np.ndarray):
        """(token ids in one array, their byte lengths, tokens of each unit); ``ok`` loses units that the tokens do not spell."""
        flat = list(chain.from_iterable(ids))
        spelled, count = [table[i] for i in flat], np.fromiter(map(len, ids), np.int64, len(ids))
        lengths = np.fromiter(map(len, spelled), np.int64, len(flat))
        ends = np.concatenate(([0], np.cumsum(lengths)))[np.cumsum(count)]
        whole = b"".join(spelled)
        if whole != b"".join(units) or not np.array_equal(ends, np.cumsum([len(u) for u in units])):
            starts = [0, *ends[:-1].tolist()]
            ok &= np.array([whole[i:j] == unit for unit, i, j in zip(units, starts, ends.tolist())], bool)
        return np.array(flat, np.int64), lengths, count

    def _tokens_of_a(self, units: list[str], raw: list[bytes], ok: np.ndarray):
        """As :meth:`_spelled`, for A: it takes many units as one text, since no token spans a cut."""
        if self.cuttable:
            joined = ["".join(units[i:i + 64]) for i in range(0, len(units), 64)]
            flat = list(chain.from_iterable([e.ids for e in self.a.encode_batch_fast(joined, add_special_tokens=False)]))
            spelled = [self.bytes_a[i] for i in flat]
            lengths = np.fromiter(map(len, spelled), np.int64, len(flat))
            ends, unit_ends = np.cumsum(lengths), np.cumsum([len(u) for u in raw])
            until = np.searchsorted(ends, unit_ends)
            if b"".join(spelled) == b"".join(raw) and np.array_equal(ends[until], unit_ends):
                return np.array(flat, np.int64), lengths, np.diff(until + 1, prepend=0)
        return self._spelled(raw, [e.ids for e in self.a.encode_batch_fast(units, add_special_tokens=False)], self.bytes_a, ok)

    def _learn(self, units: list[str]):
        """Tokens, groups and links of new units, all at once over the units' bytes laid end to end."""
        raw = [u.encode() for u in units]
        pieces = self.b.encode([u[1:] for u in units], num_threads=1)          # the model adds a space in front
        ok = np.ones(len(units), bool)
        a, size_a, n_a = self._tokens_of_a(units, raw, ok)
        b, size_b, n_b = self._spelled(raw, [self.space_b if u == " " else p for u, p in zip(units, pieces)], self.bytes_b, ok)
        used_a, used_b = np.repeat(ok, n_a), np.repeat(ok, n_b)
        a, b, n_a, n_b = a[used_a], b[used_b], n_a * ok, n_b * ok
        end_a, end_b = np.cumsum(size_a[used_a]), np.cumsum(size_b[used_b])
        unit_end = np.cumsum(np.array([len(u) for u in raw]) * ok)
        ends, common = np.union1d(end_a, end_b), np.intersect1d(end_a, end_b, assume_unique=True)
        links = a[np.searchsorted(end_a, ends)] << 32 | b[np.searchsorted(end_b, ends)]
        per_unit = [np.diff(np.searchsorted(e, unit_end, side="right"), prepend=0) for e in (common, ends)]

        # the tokens in the order of groups, A before B, each as text with the mark that follows it
        place = np.concatenate((np.searchsorted(common, end_a) * 2, np.searchsorted(common, end_b) * 2 + 1))
        order = np.argsort(place, kind="stable")
        ranked = np.append(place[order], -1)
        mark = np.where(ranked[1:] == ranked[:-1], 0, np.where(ranked[:-1] % 2 == 0, 1, 2))
        words = [self.words[i] for i in (np.concatenate((a, b))[order] + mark * self.ids).tolist()]
        text = "".join(words)
        until = np.concatenate(([0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))))[np.cumsum(n_a + n_b)].tolist()
        starts = [0, *until[:-1]]

        first = len(self.number)
        self.number.update(zip(units, range(first, first + len(units))))
        self.groups += [text[i:j - 1] for i, j in zip(starts, until)]
        self.good = np.concatenate((self.good, ok))
        self.sizes = np.concatenate((self.sizes, np.stack((n_a, n_b, *per_unit), 1)))
        self.links = np.concatenate((self.links, links))
        self.used = np.concatenate((self.used, np.zeros(len(units), np.int64)))
        self.held += 250 * len(units) + sum(map(len, raw)) + len(text) + links.nbytes

    def units(self, text: str) -> list[str]:
        return _CUT.split(" " + text) if self.cuttable else [" " + text]

    def align(self, texts: list[str]) -> Iterator[tuple]:
        """Per text: sizes, groups, distinct packed pairs and how often each is linked."""
        if self.held > REMEMBERED:
            self.shrink()
        cut = [self.units(t) if t else [] for t in texts]
        met = [list(map(self.number.get, units)) for units in cut]
        open_texts = [k for k, at in enumerate(met) if None in at]
        fresh = list({u: None for k in open_texts for u, i in zip(cut[k], met[k]) if i is None})
        for at in range(0, len(fresh), 16384):
            self._learn(fresh[at:at + 16384])
        for k in open_texts:
            met[k] = [self.number[u] if i is None else i for u, i in zip(cut[k], met[k])]
        self.first_link = np.cumsum(self.sizes[:, 3]) - self.sizes[:, 3]
        self.used += np.bincount(np.fromiter(chain.from_iterable(met), np.int64), minlength=len(self.used))
        for numbers in met:
            at = np.array(numbers, np.int64)
            if not len(at) or not self.good[at].all():
                yield [0, 0, 0, 0], "", np.empty(0, np.int64), np.empty(0, np.int64)
                continue
            pairs, times = np.unique(self._links_of(at), return_counts=True)
            yield self.sizes[at].sum(0).tolist(), ";".join([self.groups[i] for i in numbers]), pairs, times


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """The worker's aligner; it outlives tasks, as workers do."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(arrays) if arrays else [], pa.int32()))


def _align_with(path_a: str, path_b: str, whole_groups: bool, chunk: int = 2 << 20):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(path_a, path_b)
        for batch in batches:
            texts, low = batch.column(0).to_pylist(), 0
            while low < len(texts):
                high, size = low + 1, len(texts[low])
                while high < len(texts) and size + len(texts[high]) <= chunk:
                    size += len(texts[high])
                    high += 1
                sizes, groups, pairs, times = zip(*tool.align(texts[low:high]))
                said = list(groups) if whole_groups else [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).slice(low, high - low) for k in (1, 2)]
                    + [pa.array([s[k] for s in sizes], pa.int64()) for k in range(4)]
                    + [pa.array(said), _lists([p >> 32 for p in pairs]), _lists([p & 0xFFFFFFFF for p in pairs]), _lists(times)],
                    names=["key", "copies", "n_a", "n_b", "n_groups", "n_links", "groups", "a", "b", "times"])
                low = high
    return run


def alignments(docs: DataFrame, path_a: str, path_b: str, text_col: str = "text", whole_groups: bool = True) -> DataFrame:
    """One row per distinct non-empty text: ``key`` (its SHA-256), ``copies``, sizes, ``groups`` as ``a1,a2|b1;a3|b2,b3``
    (or their SHA-256), and the distinct linked pairs ``a``, ``b`` with how many ``times`` each is linked."""
    ship_package(docs.sparkSession)
    text = F.col(text_col)
    distinct = docs.filter(F.octet_length(text) > 0).groupBy(text.alias("text")).agg(F.count(F.lit(1)).alias("copies"))
    return distinct.select("text", F.unhex(F.sha2("text", 256)).alias("key"), "copies").mapInArrow(
        _align_with(path_a, path_b, whole_groups),
        "key binary, copies long, n_a long, n_b long, n_groups long, n_links long, groups string, "
        "a array<int>, b array<int>, times array<int>")


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents by linked pair, summed within the task as far as PENDING pairs allow."""
    keys, counts, pending = [], [], 0

    def summed():
        pair, at = np.unique(np.concatenate(keys), return_inverse=True)
        return pair, np.bincount(at, np.concatenate(counts), len(pair)).astype(np.int64)

    def out(pair, count):
        return pa.RecordBatch.from_arrays([pa.array((pair >> 32).astype(np.int32)), pa.array((pair & 0xFFFFFFFF).astype(np.int32)),
                                           pa.array(count)], names=["a", "b", "docs"])
    for batch in batches:
        copies = batch.column(0).to_numpy()
        a, b = batch.column(1), batch.column(2)
        sizes = np.diff(a.offsets.to_numpy())
        keys.append(a.flatten().to_numpy().astype(np.int64) << 32 | b.flatten().to_numpy())
        counts.append(np.repeat(copies, sizes))
        pending += len(keys[-1])
        if pending > PENDING:
            pair, count = summed()
            keys, counts, pending = [pair], [count], len(pair)
            if pending > PENDING // 2:
                yield out(pair, count)
                keys, counts, pending = [], [], 0
    if keys:
        yield out(*summed())


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``a``, ``b``, ``docs`` (how many documents hold the pair linked) and ``best`` (none of ``a`` is held by more)."""
    counts = (aligned.select("copies", "a", "b").mapInArrow(_pair_counts, "a int, b int, docs long")
              .groupBy("a", "b").agg(F.sum("docs").alias("docs")))
    counts = written(counts, "pairs")
    top = counts.groupBy("a").agg(F.max("docs").alias("most"))                 # a row per id of A's vocabulary at most
    return counts.join(F.broadcast(top), "a").select("a", "b", "docs", (F.col("docs") == F.col("most")).alias("best"))


def _most_held(counts: DataFrame, held: int) -> int | None:
    """Least count such that at most ``held`` pairs reach it; None if all pairs are that few."""
    if counts.count() <= held:
        return None
    by_bits = counts.groupBy(F.floor(F.log2("docs")).alias("bits")).count().collect()       # at most 63 rows, bits 0 to 62
    total, least = 0, 62
    for bits, n in sorted(((int(r[0]), int(r[1])) for r in by_bits), reverse=True):
        if total + n > held:
            break
        total, least = total + n, bits
    return 1 << least


def measures(aligned: DataFrame, counts: DataFrame, held: int = HELD) -> DataFrame:
    """Per distinct text: ``key``, ``n_best`` (links whose pair is its A id's best) and ``count_sum`` (over links)."""
    links = aligned.select("key", F.explode(F.arrays_zip("a", "b", "times")).alias("l")).select("key", "l.a", "l.b", "l.times")

    def summed(found):
        return found.groupBy("key").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).cast("long").alias("n_best"),
                                        F.sum(F.col("times") * F.col("docs")).alias("count_sum"))
    least = _most_held(counts, held)
    if least is None:
        return summed(links.join(F.broadcast(counts), ["a", "b"]))
    common, rare = counts.filter(F.col("docs") >= least), counts.filter(F.col("docs") < least)
    parts = (summed(links.join(F.broadcast(common), ["a", "b"]))
             .unionByName(summed(links.join(F.broadcast(common.select("a", "b")), ["a", "b"], "left_anti")
                                 .join(rare.hint("merge"), ["a", "b"]))))
    return parts.groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align_documents(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
                    whole_groups: bool = True, held: int = HELD) -> DataFrame:
    """Per document: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups``."""
    aligned = written(alignments(docs, path_a, path_b, text_col, whole_groups), "aligned")
    found = measures(aligned, written(pair_counts(aligned), "counts"), held)
    per_text = written(aligned.select("key", *MEASURES[:4], "groups").join(found, "key", "left"), "measures")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(F.col(text_col), 256)).alias("key"))
    return (rows.join(per_text.hint("merge"), "key", "left")
            .select("doc_id", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in MEASURES],
                    F.coalesce("groups", F.lit("")).alias("groups")))
