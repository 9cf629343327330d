"""Fill-in-middle transformation over a sparse index of the multibyte characters.

A text is cut into units (lines, or code points), two cuts chosen by a hash of the
document's id part it into prefix, middle and suffix, and the parts are written in
one of two orders between markers: ``psm`` (prefix, suffix, middle) or ``spm``
(suffix, prefix, middle).  ``restore`` gives the text back.

Texts stay UTF-8 bytes.  Of each batch only the exceptions are recorded: where a
character of several bytes begins and how many bytes it has beyond one.  A binary
search among these turns byte cuts into code points and back; between exceptions
positions differ by a constant, so ASCII texts need no index at all.

Rows are independent: one pass, no shuffle; memory is that of ``CHUNK`` bytes of
texts or of one longer text.

Defined results for odd input: a null or empty text has no units and form
``plain``; a text that holds a marker is left ``plain``; a null id is hashed as an
empty string; repeated rows give repeated results; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship_package, text_buffers

#: Markers before the prefix, the suffix and the middle.
MARKERS = ("<P>", "<S>", "<M>")
SEED = "7"
#: Texts transformed, and transformed texts written suffix first (per cent).
RATE, SPM_SHARE = 100, 50
UNITS = ("lines", "chars")
CHUNK = 8 << 20


class Exceptions:
    """Multibyte characters of some UTF-8 bytes: first bytes, code points before each, excess bytes so far."""

    def __init__(self, data: np.ndarray):
        self.first = np.flatnonzero(data >= 0xC0)
        lead = data[self.first]
        self.excess = np.zeros(len(lead) + 1, np.int64)
        np.cumsum(1 + (lead >= 0xE0) + (lead >= 0xF0), out=self.excess[1:])
        self.point = self.first - self.excess[:-1]

    def to_points(self, at: np.ndarray) -> np.ndarray:
        """Code points before the byte positions ``at`` (none of them inside a character)."""
        return at - self.excess[np.searchsorted(self.first, at)] if len(self.first) else at

    def to_bytes(self, point: np.ndarray) -> np.ndarray:
        """Byte positions of the code points numbered ``point``."""
        return point + self.excess[np.searchsorted(self.point, point)] if len(self.first) else point


def _cuts(data: np.ndarray, offsets: np.ndarray, index: Exceptions, unit: str, one: np.ndarray, two: np.ndarray):
    """(units of each text, byte position of its first cut, of its second cut)."""
    start, end = offsets[:-1], offsets[1:]
    if unit == "chars":
        base = index.to_points(start)
        n = index.to_points(end) - base
        low, high = np.minimum(one % (n + 1), two % (n + 1)), np.maximum(one % (n + 1), two % (n + 1))
        return n, index.to_bytes(base + low), index.to_bytes(base + high)
    newline = np.flatnonzero(data == 10)
    before, until = np.searchsorted(newline, start), np.searchsorted(newline, end)
    open_end = end > start
    open_end[open_end] = data[end[open_end] - 1] != 10
    n = until - before + open_end
    line_end = np.append(newline + 1, 0)

    def after(units):
        inside = line_end[np.minimum(before + np.maximum(units, 1) - 1, len(newline))]
        return np.where(units == 0, start, np.where(units == n, end, inside))
    low, high = np.minimum(one % (n + 1), two % (n + 1)), np.maximum(one % (n + 1), two % (n + 1))
    return n, after(low), after(high)


def _chunks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of about CHUNK bytes, or of one longer text."""
    i, count = 0, len(offsets) - 1
    while i < count:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK, side="right")) - 1)
        yield i, j
        i = j


def _transform_with(unit: str, rate: int, spm_share: int, markers: tuple[str, str, str]):
    marks = [m.encode() for m in markers]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            dice = [batch.column(k).to_numpy() for k in range(2, 6)]
            for i, j in _chunks(offsets):
                yield rows(batch.slice(i, j - i), data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i],
                           [d[i:j] for d in dice])

    def rows(part, data, offsets, dice):
        index = Exceptions(data)
        n, low, high = _cuts(data, offsets, index, unit, dice[0], dice[1])
        raw = data.tobytes()
        held = [m for m in marks if m in raw]
        form, out, size = [], [], np.zeros(part.num_rows + 1, np.int64)
        for k, (s, a, b, e) in enumerate(zip(offsets[:-1].tolist(), low.tolist(), high.tolist(), offsets[1:].tolist())):
            if s == e or dice[2][k] % 100 >= rate or any(raw.find(m, s, e) >= 0 for m in held):
                form.append("plain")
                out.append(raw[s:e])
            elif dice[3][k] % 100 < spm_share:
                form.append("spm")
                out.append(b"".join((marks[1], raw[b:e], marks[0], raw[s:a], marks[2], raw[a:b])))
            else:
                form.append("psm")
                out.append(b"".join((marks[0], raw[s:a], marks[1], raw[b:e], marks[2], raw[a:b])))
            size[k + 1] = len(out[-1])
        plain = np.array([f == "plain" for f in form], bool)
        cut = index.to_points(low)
        output = pa.Array.from_buffers(pa.large_string(), len(out),
                                       [None, pa.py_buffer(np.cumsum(size).tobytes()), pa.py_buffer(b"".join(out))])
        return pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()),
             pa.array(cut - index.to_points(offsets[:-1]), pa.int64(), mask=plain),
             pa.array(index.to_points(high) - cut, pa.int64(), mask=plain), output.cast(pa.string())],
            names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])
    return run


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "lines", seed: str = SEED,
              rate: int = RATE, spm_share: int = SPM_SHARE, markers: tuple[str, str, str] = MARKERS) -> DataFrame:
    """``doc_id``, units ``n``, ``form`` (plain, psm, spm), ``prefix_chars``, ``middle_chars`` and the ``output`` text."""
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}: {unit!r}")
    ship_package(docs.sparkSession)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), digest.alias("digest"))
    dice = [F.conv(F.substring("digest", 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.select("doc_id", "text", *dice).mapInArrow(
        _transform_with(unit, rate, spm_share, tuple(markers)),
        f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text that ``output`` was made from: markers stand in no part, so splitting at them is exact."""
    quoted = "|".join("\\Q" + m + "\\E" for m in markers)
    parts = F.split(output, quoted, -1)
    return (F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
            .when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output))
