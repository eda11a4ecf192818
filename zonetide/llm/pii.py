"""Personal data in texts: proposed by pattern, confirmed by checksum, scored by context.

For every kind of personal data a regular expression proposes spans, leftmost first and not
overlapping.  A validator confirms or drops each: the Luhn sum of card numbers, the mod-97
remainder of IBANs, the parts of addresses, the number of digits, the characters next to
the span.  A confirmed span starts with its kind's score, and words near it, in the text up
to its neighbours of the kind, raise or lower it: a bare number is somebody's phone where
"call" stands next to it, and four numbers are a version where "version" does.
Spans of the four base kinds stay whatever their score; the others need ``LEAST``.

Positions come without a search for each hit: the pieces between hits and the hits
themselves have lengths, and their running sums are the ends.  The sums are taken in blocks, so
that a text with n hits costs n steps and not n squared.  The patterns are written so that
no text takes more than linear time: repetitions that nothing can follow don't give back,
and a run of characters is entered at its start only.

Only DataFrame functions run, on each row by itself: no shuffle, no Python.

Defined results: a null text is empty and has no spans; rows that repeat an id are
judged each by itself; texts of any length are read whole; a column of ``docs`` named
``pii`` is replaced by the result, all others are carried along; positions count code
points, ends are exclusive.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Length of the blocks of running sums, characters of context, the score that is needed.
BLOCK, BEFORE, AFTER, LEAST = 256, 40, 20, 0.5


def digits_of(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Every second digit from the right counts twice, less 9 if over 9; the sum ends in 0."""
    start = F.struct(F.lit(0).alias("sum"), F.lit(False).alias("twice"))

    def add(s: Column, c: Column) -> Column:
        d = c.cast("int")
        worth = F.when(s.twice, 2 * d - F.when(d > 4, 9).otherwise(0)).otherwise(d)
        return F.struct((s["sum"] + worth).alias("sum"), (~s.twice).alias("twice"))

    return F.aggregate(F.split(F.reverse(digits), ""), start, add, lambda s: s["sum"] % 10 == 0)


def mod97(code: Column) -> Column:
    """ISO 7064: the first four characters moved to the end, letters as 10 to 35, leave 1."""
    moved = F.concat(F.substring(code, 5, 34), F.substring(code, 1, 4))
    value = lambda c: F.ascii(c) - F.when(c < "A", 48).otherwise(55)
    step = lambda s, c: (s * F.when(c < "A", 10).otherwise(100) + value(c)) % 97
    return F.aggregate(F.split(moved, ""), F.lit(0), step, lambda s: s == 1)


def _card(hit: Column, before: Column, after: Column) -> Column:
    digits = digits_of(hit)
    return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)


def _iban(hit: Column, before: Column, after: Column) -> Column:
    code = F.replace(hit, F.lit(" "), F.lit(""))
    whole = ~F.concat(F.right(before, F.lit(1)), F.lit(" "), F.left(after, F.lit(1))).rlike("[A-Za-z0-9]")
    return F.when(whole & F.length(code).between(15, 34), mod97(code)).otherwise(False)


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    #: A text without this string, or without a match of this pattern, has no span of the kind.
    holds: str
    hint: str
    valid: Callable[[Column, Column, Column], Column]
    score: float
    base: bool = False
    #: Words near a span and what they add to its score.
    words: str = ""
    bonus: float = 0.0
    #: Whether every span has a digit.
    digits: bool = True


#: ``\G`` is where the hit before ended: runs are entered there or at their first character.
LOCAL, LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
EMAIL = rf"(?:\G|(?<!{LOCAL})){LOCAL}++@{LABEL}++(?:\.{LABEL}++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
#: Chains of fewer than 13 digits are never cards, so none of them needs to be a hit.
CARD = r"[0-9](?:[\x20-]?[0-9]){12,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+"
OCTETS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.|$)){4}"

KINDS = (
    Kind("email", EMAIL, "@", "", lambda h, b, a: F.lit(True), 0.9, True, digits=False),
    Kind("ip", IP, ".", r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", lambda h, b, a: h.rlike(OCTETS), 0.6, True, r"(?i)version|release|chapter|section", -0.3),
    Kind("card", CARD, "", CARD, _card, 0.8, True, r"(?i)card|visa|master|credit|debit|expir", 0.2),
    Kind("phone", PHONE, "+", r"\+[0-9]", lambda h, b, a: F.length(digits_of(h)).between(9, 15), 0.7, True, r"(?i)call|phone|tel|mobil|fax|whatsapp", 0.2),
    Kind("iban", r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}", "", r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]", _iban, 0.9, False, r"(?i)iban|account|bank|konto", 0.1),
    Kind(
        "ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "-", r"[0-9]-[0-9]{2}-[0-9]",
        lambda h, b, a: ~h.rlike("^(?:000|666|9)|-00-|-0000$") & ~F.right(b, F.lit(1)).rlike("[0-9A-Za-z-]") & ~F.left(a, F.lit(1)).rlike("[0-9A-Za-z-]"),
        0.4, False, r"(?i)ssn|social.?security|tax.?id", 0.4,
    ),
    Kind(
        "tel", r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}", "", r"[\x20.-][0-9]{3}[\x20.-][0-9]{4}",
        lambda h, b, a: ~F.right(b, F.lit(6)).rlike(r"[0-9.(-]$|\+[0-9]{1,3}\x20?$") & ~F.left(a, F.lit(2)).rlike("^(?:[0-9]|[.-][0-9])"),
        0.4, False, r"(?i)call|phone|tel|mobil|fax|whatsapp", 0.3,
    ),
    Kind(
        "secret", TOKEN, "", TOKEN,
        lambda h, b, a: h.rlike("[0-9]") & h.rlike("[A-Za-z]"),
        0.2, False, r"(?i)token|secret|passw|api.?key|bearer|credential", 0.5,
    ),
)
BASE = tuple(k for k in KINDS if k.base)


def running_sums(values: Column) -> Column:
    """Sums of an array's first 1, 2, ... longs."""
    last = lambda a: F.element_at(a, -1)
    zero = F.array(F.lit(0).cast("long"))
    blocks = F.sequence(F.lit(0), F.floor(F.greatest(F.size(values) - 1, F.lit(0)) / BLOCK).cast("int"))
    blocks = F.transform(blocks, lambda b: F.slice(values, b * BLOCK + 1, BLOCK))

    def one_more(out: Column, block: Column) -> Column:
        sums = F.aggregate(block, F.array(last(last(out))), lambda a, v: F.concat(a, F.array(last(a) + v)))
        return F.concat(out, F.array(F.slice(sums, 2, BLOCK)))

    return F.aggregate(blocks, F.array(zero), one_more, lambda out: F.flatten(F.slice(out, 2, F.size(out))))


def _confirms(kind: Kind) -> Callable[[Column], Column]:
    return lambda s: s.hit.isNotNull() & kind.valid(s.hit, s.gap, s.after)


def _scores(kind: Kind) -> Callable[[Column], Column]:
    def scored(s: Column) -> Column:
        score = F.lit(kind.score)
        if kind.words:
            near = F.concat(F.right(s.gap, F.lit(BEFORE)), F.lit(" "), F.left(s.after, F.lit(AFTER)))
            score = score + F.when(near.rlike(kind.words), kind.bonus).otherwise(0.0)
        return F.struct(
            F.lit(kind.name).alias("kind"),
            (s.end - F.length(s.hit)).cast("long").alias("start"),
            s.end.alias("end"),
            F.round(score, 3).alias("score"),
        )

    return scored


def find_pii(docs: DataFrame, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``docs`` with ``pii``: an array of (kind, start, end, score) by kind, then start."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.coalesce(F.col("text"), F.lit("")).alias("t"))
    text, own = F.col("t"), {}
    # each stage names what the next one uses twice or more, so that it is computed once
    rows = rows.withColumn("digit", text.rlike("[0-9]"))
    for k in kinds:
        some = (F.col("digit") if k.digits else F.lit(True)) & text.contains(k.holds) & text.rlike(k.hint)
        own[f"{k.name}_gaps"] = F.when(some, F.split(text, k.pattern, -1)).otherwise(F.array(text))
        own[f"{k.name}_hits"] = F.when(some, F.regexp_extract_all(text, F.lit(k.pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumns(own)
    lengths = {
        f"{k.name}_lengths": F.zip_with(
            f"{k.name}_gaps", f"{k.name}_hits", lambda g, h: (F.length(g) + F.coalesce(F.length(h), F.lit(0))).cast("long")
        )
        for k in kinds
    }
    rows = rows.withColumns(lengths)
    spans = []
    for k in kinds:
        gaps, hits = F.col(f"{k.name}_gaps"), F.col(f"{k.name}_hits")
        parts = F.arrays_zip(
            hits.alias("hit"), gaps.alias("gap"),
            F.slice(gaps, 2, F.size(hits)).alias("after"), running_sums(F.col(f"{k.name}_lengths")).alias("end"),
        )
        sound = F.filter(parts, _confirms(k))
        scored = F.transform(sound, _scores(k))
        scored = scored if k.base else F.filter(scored, lambda s: s.score >= LEAST)
        spans.append(F.when(F.size(hits) > 0, scored).otherwise(F.array().cast("array<struct<kind:string,start:bigint,end:bigint,score:double>>")))
    kept = [F.col("row").getField(c).alias(c) for c in docs.columns if c != "pii"]
    return rows.select(*kept, F.concat(*spans).alias("pii"))


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def mask(docs: DataFrame, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets, null texts left.

    Overlapping spans become one, named after the one that starts first.  Unlike finding,
    this reads the text from its start for every span.
    """
    found = find_pii(docs.withColumn("_own", F.struct(*(F.col(f"`{c}`") for c in docs.columns))), kinds)
    spans = F.array_sort(F.transform("pii", lambda s: F.struct(s.start.alias("start"), s.end.alias("end"), s.kind.alias("kind"))))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(s: Column, span: Column) -> Column:
        gap = F.substring(F.col("text"), s["at"].cast("int") + 1, (span.start - s["at"]).cast("int"))
        more = F.when(span.start >= s["at"], F.concat(s.out, F.array(F.concat(gap, F.lit("["), span.kind, F.lit("]"))))).otherwise(s.out)
        return F.struct(F.greatest(s["at"], span.end).alias("at"), more.alias("out"))

    tail = lambda s: F.concat(F.array_join(s.out, ""), F.substring(F.col("text"), s["at"].cast("int") + 1, 2**31 - 1))
    masked = F.when(F.size("pii") > 0, F.aggregate(spans, start, step, tail)).otherwise(F.col("text"))
    return found.select(*(masked.alias(c) if c == "text" else F.col("_own").getField(c).alias(c) for c in docs.columns))


def op13_pii(spark: SparkSession, folder: str) -> DataFrame:
    """``n_…`` count the spans of the base kinds, which ``base_sha256`` digests."""
    docs = find_pii(common.table(spark, folder, "documents").select("doc_id", "text"))
    base = F.filter("pii", lambda s: s.kind.isin(*(k.name for k in BASE)))
    docs = docs.select("doc_id", "pii", base.alias("base"))
    kinds = F.transform("base", lambda s: s.kind)
    counts = [F.size(F.filter(kinds, F.lit(k.name).__eq__)).cast("long").alias(f"n_{k.name}") for k in BASE]
    return docs.select("doc_id", *counts, F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("pii")).alias("spans"))
