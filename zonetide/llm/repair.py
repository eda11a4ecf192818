"""Conversation structure repair: weighted interval parsing over spans of turns.

A conversation should read ``(s?(ua)+)?`` by role initials: perhaps a system turn, then
pairs of user and assistant.  Every turn is kept (K, free), given another role (R), or
deleted (D), which blank and duplicate turns must be; turns without text are inserted (I);
a truncated turn that stays costs extra.  The cheapest repair is wanted, and of equally cheap ones
the one whose letters, in order, sort first.

The repair grammar in Chomsky normal form has a nonterminal for each pair of states of the
wanted pattern: ``X[p,q]`` derives the turns of a span, with edits, such that their repaired
roles lead from p to q.

    X[p,q] -> X[p,m] X[m,q]                    a span is two shorter ones
    X[p,q] -> turn                             by K, R or D, at the cost of the edit
    X[p,q] -> I X[m,q] | X[p,m] I              insertion closure, on either side

A span's cell holds the least (cost, audit) of every nonterminal.  Cells are combined
bottom-up by span length.  Because the nonterminals are all pairs of states, every way to cut a
span in two gives the same cell; one cut, of even halves, is enough.  Equally cheap audits
of one span are never prefixes of each other (more letters over the same turns are
insertions, which cost), so the least of two joined spans is the join of their least.

A cell depends on the kinds of its turns only, so the cells of short spans are remembered.

On Spark: turns shrink to narrow rows (key, role initial, fault), copies to counts.  The order
of all turns comes from a range partitioning by conversation and turn, which cuts a long
conversation into as many tasks as its size asks for, and from counts carried over the
partitions.  A conversation is then parsed in spans of ``SPAN`` turns by different tasks,
the spans' cells again in spans of ``SPAN`` cells, until one is left.  Texts move once, to where
the audit is applied; a digest of a whole conversation needs it as a stream in one task,
which holds one turn at a time.

Defined results: turns in order, null first, equal turns by role and digest of the text;
nulls in role and text are one space; a null id is a conversation; rows that repeat are
duplicates of the first; an initial other than s, u and a fits nowhere, so such a turn is
given a role or deleted; a conversation without turns has cost 0 and an empty audit; an
empty table has no conversation; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: States of the pattern: nothing yet, a system turn, an open user turn, whole pairs.
EMPTY, SYSTEM, OPEN, PAIRS = STATES = range(4)
NEXT = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): OPEN, (SYSTEM, "u"): OPEN, (PAIRS, "u"): OPEN, (OPEN, "a"): PAIRS}
LEGAL = ("su", "ua", "au")
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
SPAN = 256
#: Spans up to this length are remembered, up to this number.
REMEMBERED, MOST = 6, 100_000

#: Kinds of turns: the initial (x: no role that fits), in capitals if truncated; "-" if a
#: turn must go.
GONE = "-"

Cell = dict[tuple[int, int], tuple[int, str]]


def _better(cell: Cell, at: tuple[int, int], cost: int, audit: str) -> None:
    if at not in cell or (cost, audit) < cell[at]:
        cell[at] = (cost, audit)


def combined(left: Cell, right: Cell) -> Cell:
    """X[p,q] -> X[p,m] X[m,q], by least cost, then audit."""
    out: Cell = {}
    for (p, m), (cost, audit) in left.items():
        for q in STATES:
            if (m, q) in right:
                more = right[m, q]
                _better(out, (p, q), cost + more[0], audit + more[1])
    return out


def _insertions() -> Cell:
    """Insertions alone: none, one, or two in a row; a third returns to a state."""
    one: Cell = {(p, q): (INSERT, "I") for (p, initial), q in NEXT.items() if initial in "ua"}
    out: Cell = {(p, p): (0, "") for p in STATES} | one
    for at, found in combined(one, one).items():
        _better(out, at, *found)
    return out


INSERTIONS = _insertions()


class Parser:
    """Cells of spans of turn kinds."""

    def __init__(self) -> None:
        self.known: dict[str, Cell] = {}

    @staticmethod
    def turn(kind: str) -> Cell:
        """One turn with the insertion closure on either side."""
        out: Cell = {(p, p): (DELETE, "D") for p in STATES}
        if kind != GONE:
            extra = TRUNCATED if kind.isupper() else 0
            for (p, initial), q in NEXT.items():
                if initial == kind.lower():
                    _better(out, (p, q), extra, "K")
                if initial in "ua":
                    _better(out, (p, q), REROLE + extra, "R")
        return combined(combined(INSERTIONS, out), INSERTIONS)

    def cell(self, kinds: str) -> Cell:
        """The cell of a span: cells of single turns, combined bottom-up."""
        if not kinds:
            return INSERTIONS
        if len(kinds) <= REMEMBERED and kinds in self.known:
            return self.known[kinds]
        half = len(kinds) // 2
        found = self.turn(kinds) if len(kinds) == 1 else combined(self.cell(kinds[:half]), self.cell(kinds[half:]))
        if len(kinds) <= REMEMBERED:
            if len(self.known) >= MOST:
                self.known.clear()
            self.known[kinds] = found
        return found


def joined(cells: list[Cell]) -> Cell:
    """Neighbouring cells combined bottom-up by span length."""
    while len(cells) > 1:
        pairs = [combined(a, b) for a, b in zip(cells[::2], cells[1::2], strict=False)]
        cells = pairs + cells[len(pairs) * 2 :]
    return cells[0]


def best(cell: Cell) -> tuple[int, str]:
    """The cheapest repair to a whole conversation."""
    return min(cell[EMPTY, q] for q in (EMPTY, PAIRS) if (EMPTY, q) in cell)


# --- turns and their faults --------------------------------------------------------------


def spaced(column: Column) -> Column:
    return F.coalesce(column, F.lit(" "))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, n) after deterministic damage; n counts the copies."""
    key = F.concat(spaced(F.col("conv_id").cast("string")), F.lit(":"), spaced(F.col("turn").cast("string")))
    fault = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    text = spaced(F.col("text"))
    return rows.where(fault != 0).select(
        "conv_id",
        "turn",
        F.when(fault == 4, F.lit("user")).otherwise(spaced(F.col("role"))).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(fault == 3, 2).otherwise(1).cast("long").alias("n"),
    )


def faults(rows: DataFrame) -> DataFrame:
    """One narrow row per different turn: conv_id, turn, role, digest, n, kind, and how many
    of the copies have which fault."""
    shown = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*+\z", 1)
    narrow = rows.select(
        "conv_id", "turn", "role", F.md5("text").alias("digest"), "n",
        (shown == "").alias("blank"), (~shown.isin("", ".", "!", "?")).alias("cut"),
    )
    turns = narrow.groupBy("conv_id", "turn", "role", "digest").agg(F.sum("n").alias("n"), F.first("blank").alias("blank"), F.first("cut").alias("cut"))
    # the first turn that says it, a turn without number coming before all others
    number = F.struct(F.col("turn").isNotNull().alias("numbered"), "turn")
    first = turns.groupBy("conv_id", "role", "digest").agg(F.min(number).alias("first"))
    both = turns.alias("t").join(first.alias("f"), F.expr("t.conv_id <=> f.conv_id and t.role = f.role and t.digest = f.digest"))
    blank, cut = F.col("t.blank"), F.col("t.cut")
    again = ~F.struct(F.col("t.turn").isNotNull().alias("numbered"), F.col("t.turn").alias("turn")).eqNullSafe(F.col("f.first"))
    initial = F.when(F.left("t.role", F.lit(1)).isin("s", "u", "a"), F.left("t.role", F.lit(1))).otherwise("x")
    kind = F.when(blank | again, GONE).when(cut, F.upper(initial)).otherwise(initial)
    repeats = F.when(blank, 0).when(again, F.col("t.n")).otherwise(F.col("t.n") - 1)
    return both.select(
        "t.conv_id", "t.turn", "t.role", "t.digest", "t.n", kind.alias("kind"), initial.alias("initial"),
        F.when(blank, F.col("t.n")).otherwise(0).alias("blank"), repeats.cast("long").alias("duplicate"),
        F.when(~blank & ~again & cut, 1).otherwise(0).cast("long").alias("truncated"),
    )


def numbered(turns: DataFrame) -> DataFrame:
    """``turns`` (written) with ``at``, their number inside their conversation from 0."""
    order = (F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("digest"))
    ordered = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = common.stored(ordered.withColumn("place", F.monotonically_increasing_id()), "turns")
    # one row per range partition, whose counts are carried on
    part = F.shiftright("place", 33)
    sizes = ordered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    ahead = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("part", ahead.alias("ahead"))
    rows = ordered.withColumn("part", part).join(sizes, "part")
    rows = rows.withColumn("seq", F.col("ahead") + F.col("place") - F.shiftleft("part", 33)).drop("part", "ahead", "place")
    starts = rows.groupBy("conv_id").agg(F.min("seq").alias("start"))
    both = rows.alias("r").join(starts.alias("s"), F.expr("r.conv_id <=> s.conv_id"))
    return both.select("r.*", (F.col("r.seq") - F.col("s.start")).alias("at"))


# --- cells on Spark ------------------------------------------------------------------------

CELLS = "conv long, none boolean, at long, first string, last string, illegal long, costs array<long>, audits array<string>"
PAIRS_OF_STATES = [(p, q) for p in STATES for q in STATES]


def _row(key: tuple, first: str, last: str, illegal: int, cell: Cell) -> tuple:
    costs = [cell[at][0] if at in cell else None for at in PAIRS_OF_STATES]
    return (key[0], key[1], key[2], first, last, illegal, costs, [cell[at][1] if at in cell else None for at in PAIRS_OF_STATES])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()))
    names = ("conv", "none", "at", "first", "last", "illegal", "costs", "audits")
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=list(names))


def _flushed(rows: Iterator[tuple], size: int = 512) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held)
            held = []
    if held:
        yield _batch(held)


def _illegal(initials: str) -> int:
    return sum(initials[i : i + 2] not in LEGAL for i in range(len(initials) - 1))


def parse_turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One cell per span of turns: (conv, none, span), sorted by the turns' place."""
    parser = Parser()

    def rows() -> Iterator[tuple]:
        for key, span in common.runs(batches, ("conv", "none", "span")):
            cells, illegal, initials = [], 0, ""
            kinds, first, last = "", None, ""
            for kind, initial, n in zip(span["kind"].to_pylist(), span["initial"].to_pylist(), span["n"].to_pylist(), strict=True):
                illegal += n - 1  # copies stand together; no role may follow itself
                kinds += kind
                if n > 1:
                    cells += [parser.cell(kinds), {(p, p): (DELETE * (n - 1), "D" * (n - 1)) for p in STATES}]
                    kinds = ""
                initials += initial
                first, last = first or initial, initial
            cells.append(parser.cell(kinds))
            yield _row(key, first, last, illegal + _illegal(initials), joined(cells))

    yield from _flushed(rows())


def parse_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One cell per span of cells."""

    def rows() -> Iterator[tuple]:
        for key, span in common.runs(batches, ("conv", "none", "span")):
            cells, illegal = [], sum(span["illegal"].to_pylist())
            for costs, audits in zip(span["costs"].to_pylist(), span["audits"].to_pylist(), strict=True):
                cells.append({at: (c, a) for at, c, a in zip(PAIRS_OF_STATES, costs, audits, strict=True) if c is not None})
            edges = list(zip(span["first"].to_pylist(), span["last"].to_pylist(), strict=True))
            illegal += sum(a[1] + b[0] not in LEGAL for a, b in zip(edges, edges[1:], strict=False))
            yield _row(key, edges[0][0], edges[-1][1], illegal, joined(cells))

    yield from _flushed(rows(), 16)


def _spans(rows: DataFrame, work, *columns: str) -> DataFrame:
    sent = rows.select("conv", "none", F.expr(f"at div {SPAN}").alias("span"), "at", *columns)
    sent = sent.repartition("conv", "none", "span").sortWithinPartitions("conv", "none", "span", "at")
    return common.map_batches(sent, work, CELLS)


def _open(column: str) -> tuple[Column, Column]:
    """A nullable id as two columns without null."""
    return F.coalesce(column, F.lit(0)).cast("long").alias("conv"), F.col(column).isNull().alias("none")


def parsed(turns: DataFrame) -> DataFrame:
    """(conv, none, cost, audit, illegal) of every conversation with turns."""
    rows = numbered(turns).select(*_open("conv_id"), "at", "kind", "initial", "n")
    cells = common.stored(_spans(rows, parse_turns, "kind", "initial", "n"), "cells")
    while cells.agg(F.max("at")).first()[0]:
        cells = common.stored(_spans(cells, parse_cells, "first", "last", "illegal", "costs", "audits"), "cells")
    whole = [PAIRS_OF_STATES.index((EMPTY, q)) for q in (EMPTY, PAIRS)]
    options = [F.struct(F.get("costs", F.lit(i)).alias("cost"), F.get("audits", F.lit(i)).alias("audit")) for i in whole]
    least = F.array_min(F.filter(F.array(*options), lambda o: o.cost.isNotNull()))
    return cells.select("conv", "none", least["cost"].alias("cost"), least["audit"].alias("audit"), "illegal")


# --- the repaired conversations --------------------------------------------------------------

TURNS = "conv long, none boolean, at long, role string, text string"
DIGESTS = "conv long, none boolean, repaired_sha256 string"


def replayed(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(key, role, text) of repaired turns, from (key, audit, role, text, n) in order; a
    conversation's first row brings the audit and no turn."""
    for key, group in groupby(rows, key=lambda r: r[0]):
        audit = next(group)[1]
        at, out = 0, 0

        def inserts() -> Iterator[tuple]:
            nonlocal at, out
            while audit[at : at + 1] == "I":
                yield key, ("user", "assistant")[out % 2], ""
                at, out = at + 1, out + 1

        for _, _, role, text, n in group:
            for _ in range(n):
                yield from inserts()
                letter, at = audit[at], at + 1
                if letter == "K":
                    yield key, role, text
                    out += role[:1] != "s"
                elif letter == "R":
                    yield key, ("user", "assistant")[out % 2], text
                    out += 1
        yield from inserts()


def _turn_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        c = [batch.column(x).to_pylist() for x in ("conv", "none", "audit", "role", "text", "n")]
        yield from (((conv, none), *rest) for conv, none, *rest in zip(*c, strict=True))


def repaired_turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, last, at = [], None, 0

    def batch() -> pa.RecordBatch:
        conv, none, place, role, text = zip(*held, strict=True)
        return pa.record_batch(
            [pa.array(conv, pa.int64()), pa.array(none, pa.bool_()), pa.array(place, pa.int64()), pa.array(role), pa.array(text)],
            names=["conv", "none", "at", "role", "text"],
        )

    for key, role, text in replayed(_turn_rows(batches)):
        at, last = (at + 1 if key == last else 0), key
        held.append((*key, at, role, text))
        if len(held) >= 2000:
            yield batch()
            held.clear()
    if held:
        yield batch()


def repaired_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of role:text, newline-joined, one turn in memory at a time."""
    done: list[tuple] = []

    def batch() -> pa.RecordBatch:
        conv, none, digest = zip(*done, strict=True)
        return pa.record_batch([pa.array(conv, pa.int64()), pa.array(none, pa.bool_()), pa.array(digest)], names=["conv", "none", "repaired_sha256"])

    for key, turns in groupby(replayed(_turn_rows(batches)), key=lambda r: r[0]):
        digest = hashlib.sha256()
        for i, (_, role, text) in enumerate(turns):
            digest.update(common.utf8(("\n" if i else "") + f"{role}:{text}"))
        done.append((*key, digest.hexdigest()))
        if len(done) >= 2000:
            yield batch()
            done.clear()
    if done:
        yield batch()


def apply_audits(rows: DataFrame, audits: DataFrame, work=repaired_turns, schema: str = TURNS) -> DataFrame:
    """The audits applied to the rows (conv_id, turn, role, text, n): repaired turns, or
    what ``work`` makes of them.  The only step that moves texts."""
    nothing = F.lit(None).cast("string")
    turns = rows.select(
        *_open("conv_id"), F.lit(1).alias("later"), "turn", "role", F.md5("text").alias("digest"), "text", nothing.alias("audit"), "n"
    )
    heads = audits.select(
        "conv", "none", F.lit(0).alias("later"), F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), nothing.alias("role"),
        nothing.alias("digest"), nothing.alias("text"), "audit", F.lit(0).cast("long").alias("n"),
    )
    order = ("conv", "none", "later", F.asc_nulls_first("turn"), "role", "digest")
    both = turns.unionByName(heads).repartition("conv", "none").sortWithinPartitions(*order)
    return common.map_batches(both, work, schema)


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (conv_id, turn, role, text, n) as parses (conv, none, cost, audit, illegal) and
    repaired turns (conv, none, at, role, text)."""
    found = common.stored(parsed(common.stored(faults(rows), "faults")), "audits")
    return found, apply_audits(rows, found)


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    given = common.table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    rows = damaged(given)
    turns = common.stored(faults(rows), "faults")
    found = common.stored(parsed(turns), "audits")
    digests = apply_audits(rows, found, repaired_digests, DIGESTS)
    counted = turns.groupBy(*_open("conv_id")).agg(*(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")))
    # different turns first, so that no conversation's turn numbers are held as a set
    numbers = turns.where("turn is not null").select(*_open("conv_id"), "turn").distinct()
    gaps = numbers.groupBy("conv", "none").agg((F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).cast("long").alias("gaps"))
    out = given.select(*_open("conv_id")).distinct()
    for part in (counted, gaps, found, digests):
        out = out.join(part, ["conv", "none"], "left")
    none = F.lit(0).cast("long")
    return out.select(
        F.when(~F.col("none"), F.col("conv")).alias("conv_id"),
        *(F.coalesce(c, none).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
