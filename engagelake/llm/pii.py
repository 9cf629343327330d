"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Per kind a regular expression proposes leftmost non-overlapping matches; a
validator confirms each (octet range, Luhn, mod-97, digit count); a score
starts from the kind's prior and moves with words in the ``CONTEXT`` characters
before and after (other matches in them included).  Kinds marked ``base`` are reported whenever the validator
holds; the others only from ``THRESHOLD`` upwards.

Offsets are code points.  The text is cut at the matches (``split`` and
``regexp_extract_all`` with one pattern), and running lengths give the
offsets, in blocks so that a text with very many matches stays linear.
Redaction replaces the reported spans, once, so it hides what the scan reports
and nothing else.
Patterns use possessive quantifiers and begin at the start of a run, so that
no text makes them backtrack quadratically.  Built-in expressions only, one
projection, no shuffle.

Defined results for odd input: null and empty texts have no spans; repeated rows
are scanned alike; an empty table gives no rows; extra columns are ignored by
:func:`scan` and kept by :func:`redact`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

CONTEXT = 40
THRESHOLD = 0.7
BLOCK = 512
#: Spans masked in one stretch of a text.
MASKS = 128
SPAN = "array<struct<start:int,rank:int,kind:string,end:int,score:double,text:string>>"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    base: bool
    prior: float
    #: Words that raise the score when near; lower case, alternatives of a regular expression.
    near: str
    #: Cheap necessary condition on a whole text.
    needs: str


# The patterns of the kinds.  (?:\G|(?<!...)) starts a match at a run's start or at the last match's end.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         True, 0.9, "mail|contact|write", "@"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)", True, 0.7, "ip|address|host|server", "."),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", True, 0.5, "card|visa|credit|pay", ""),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", True, 0.8, "phone|tel|call|mobile|fax", "+"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
         False, 0.5, "iban|bank|account|konto", ""),
    Kind("national_phone", r"(?<![0-9+().-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
         False, 0.4, "phone|tel|call|mobile|fax", ""),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", False, 0.4, "ssn|social security", "-"),
)
BASE = tuple(k.name for k in KINDS if k.base)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _chars(text: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1))), lambda i: F.substring(text, i, F.lit(1)))


def luhn(digits: Column) -> Column:
    """The Luhn checksum over a string of digits."""
    n = F.length(digits)

    def weigh(d, i):
        doubled = d.cast("int") * F.when((n - i) % 2 == 0, 2).otherwise(1)
        return F.when(doubled > 9, doubled - 9).otherwise(doubled)
    return F.aggregate(F.transform(_chars(digits), weigh), F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(code: Column) -> Column:
    """The mod-97 checksum of an IBAN without blanks."""
    moved = F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, F.lit(1), F.lit(4)))

    def step(acc, c):
        value = F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
        return F.when(value < 10, acc * 10 + value).otherwise(acc * 100 + value) % 97
    return F.aggregate(_chars(moved), F.lit(0), step) == 1


def confirmed(kind: Kind, match: Column) -> Column:
    """Does the validator of ``kind`` hold for a matched text?"""
    if kind.name == "ip":
        def small(part):
            bare = F.ltrim(part, F.lit("0"))
            return (F.length(bare) < 3) | ((F.length(bare) == 3) & (bare <= "255"))
        return F.forall(F.split(match, "\\."), small)
    if kind.name == "card":
        return let(_digits(match), lambda d: F.when(F.length(d).between(12, 19), luhn(d)).otherwise(False))
    if kind.name == "phone":
        return F.length(_digits(match)).between(9, 15)
    if kind.name == "iban":
        return let(F.replace(match, F.lit(" "), F.lit("")),
                   lambda c: F.when(F.length(c).between(15, 34), mod97(c)).otherwise(False))
    return F.lit(True)


def _joined(one: Column, other: Column) -> Column:
    return F.array_join(F.zip_with(one, other, lambda x, y: F.concat(x, y)), "")


def _near(gaps: Column, matches: Column, i: Column) -> Column:
    """The CONTEXT characters before and after match ``i``, lower case, whatever other matches stand in them."""
    reach = CONTEXT // 2 + 1                                  # a match has two characters or more
    gap, after = F.get(gaps, i), F.get(gaps, i + 1)
    low = F.greatest(i - reach, F.lit(0))
    before = F.when(F.length(gap) >= CONTEXT, gap).otherwise(
        F.concat(_joined(F.slice(gaps, low + 1, i - low), F.slice(matches, low + 1, i - low)), gap))
    behind = F.when(F.length(after) >= CONTEXT, after).otherwise(
        F.concat(after, _joined(F.slice(matches, i + 2, reach), F.slice(F.concat(gaps, F.array(F.lit(""))), i + 3, reach))))
    return F.lower(F.concat(F.right(before, F.lit(CONTEXT)), F.lit(" "), F.left(behind, F.lit(CONTEXT))))


def _pieces(kind: Kind, text: Column) -> Column:
    """Per match: ``gap`` (text since the last match), ``match``, ``ok``, ``near`` (the context, where it is ok)."""
    gaps, matches = F.split(text, kind.pattern, -1), F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    return let(gaps, lambda g: let(matches, lambda m: F.transform(
        F.zip_with(F.slice(g, 1, F.size(m)), m, lambda a, x: F.struct(a.alias("gap"), x.alias("match"),
                                                                      confirmed(kind, x).alias("ok"))),
        lambda p, i: F.struct(p["gap"].alias("gap"), p["match"].alias("match"), p["ok"].alias("ok"),
                              F.when(p["ok"], _near(g, m, i)).alias("near")))))


def _score(kind: Kind, piece: Column) -> Column:
    near = piece["near"]
    checked = 0.1 if kind.name in ("card", "iban") else 0.0
    return F.least(F.lit(1.0), F.lit(kind.prior + checked)
                   + F.when(near.rlike(f"(?<![a-z])(?:{kind.near})"), 0.3).otherwise(0.0)
                   - F.when(near.rlike("(?<![a-z])(?:example|sample|dummy|version)(?![a-z.])"), 0.2).otherwise(0.0))


def _placed(rank: int, kind: Kind, pieces: Column) -> Column:
    """Spans of the confirmed pieces, by running lengths in blocks."""
    def width(p):
        return F.length(p["gap"]) + F.length(p["match"])

    def block_spans(block, base):
        def add(acc, p):
            start = acc["at"] + F.length(p["gap"])
            end = start + F.length(p["match"])
            span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), F.lit(kind.name).alias("kind"),
                            end.alias("end"), _score(kind, p).alias("score"), p["match"].alias("text"))
            return F.struct(end.alias("at"), F.when(p["ok"], F.concat(acc["spans"], F.array(span)))
                            .otherwise(acc["spans"]).alias("spans"))
        return F.aggregate(block, F.struct(base.alias("at"), F.array().cast(SPAN).alias("spans")), add,
                           lambda acc: acc["spans"])

    def of_blocks(blocks):
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda a, p: a + width(p)))
        starts = F.aggregate(totals, F.array(F.lit(0)), lambda a, t: F.concat(a, F.array(F.element_at(a, -1) + t)))
        return F.flatten(F.zip_with(blocks, F.slice(starts, 1, F.size(blocks)), block_spans))

    blocks = let(pieces, lambda ps: F.transform(
        F.sequence(F.lit(0), F.floor((F.size(ps) - 1) / BLOCK).cast("int")),
        lambda b: F.slice(ps, b * BLOCK + 1, BLOCK)))
    return let(blocks, of_blocks)


def _present(kind: Kind, text: Column) -> Column:
    needed = F.contains(text, F.lit(kind.needs)) if kind.needs else F.lit(True)
    return needed & text.rlike(kind.pattern)


def spans(text: Column, kinds=KINDS, threshold: float = THRESHOLD) -> Column:
    """All reported spans of a text, sorted by start and then kind."""
    t = F.coalesce(text, F.lit(""))
    found = []
    for rank, kind in enumerate(kinds):
        placed = F.when(_present(kind, t), _placed(rank, kind, _pieces(kind, t))).otherwise(F.array().cast(SPAN))
        if not kind.base:
            placed = F.filter(placed, lambda s: s["score"] >= threshold)
        found.append(placed)
    return F.array_sort(F.concat(*found))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", kinds=KINDS) -> DataFrame:
    """One row per document: ``doc_id`` and ``spans`` (start, rank, kind, end, score, text)."""
    return docs.select(F.col(id_col).alias("doc_id"), spans(F.col(text_col), kinds).alias("spans"))


REGION = "array<struct<start:int,kind:string,end:int>>"


def _regions(found: Column) -> Column:
    """Sorted spans with overlapping ones joined, under the kind of the first."""
    def add(acc, s):
        last = F.element_at(acc, -1)
        joined = F.struct(last["start"].alias("start"), last["kind"].alias("kind"), F.greatest(last["end"], s["end"]).alias("end"))
        own = F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
        meets = (F.size(acc) > 0) & (s["start"] < F.try_element_at(acc, F.lit(-1))["end"])
        return F.when(meets, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(joined))).otherwise(F.concat(acc, F.array(own)))
    return F.aggregate(found, F.array().cast(REGION), add)


def _masked(text: Column, regions: Column) -> Column:
    """The text with the regions replaced; cut into stretches of few regions first, so that long texts stay linear."""
    def stretch(b):
        here = F.slice(regions, b * MASKS + 1, MASKS)
        begin = F.when(b == 0, 0).otherwise(F.try_element_at(regions, b * MASKS)["end"])
        end = F.when((b + 1) * MASKS >= F.size(regions), F.length(text)).otherwise(F.element_at(here, -1)["end"])

        def shown(part):
            def one(r, i):
                since = F.when(i == 0, begin).otherwise(F.try_element_at(here, F.greatest(i, F.lit(1)))["end"])
                return F.concat(F.substring(part, since - begin + 1, r["start"] - since), F.lit("["), F.upper(r["kind"]), F.lit("]"))
            tail = F.substring(part, F.element_at(here, -1)["end"] - begin + 1, F.length(part))
            return F.concat(F.array_join(F.transform(here, one), ""), tail)
        return let(F.substring(text, begin + 1, end - begin), shown)
    blocks = F.sequence(F.lit(0), F.floor((F.size(regions) - 1) / MASKS).cast("int"))
    return F.array_join(F.transform(blocks, stretch), "")


def redacted(text: Column, kinds=KINDS, threshold: float = THRESHOLD) -> Column:
    """The text with every reported span replaced by its kind in brackets (overlapping spans by the first one's); null stays null."""
    return F.when(text.isNull(), text).otherwise(
        let(text, lambda t: let(_regions(spans(t, kinds, threshold)), lambda r: F.when(F.size(r) == 0, t).otherwise(_masked(t, r)))))


def redact(docs: DataFrame, text_col: str = "text", kinds=KINDS) -> DataFrame:
    """``docs`` with personal data masked in ``text_col``; all rows and columns kept."""
    return docs.withColumn(text_col, redacted(F.col(text_col), kinds))
