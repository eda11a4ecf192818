"""Conversation repair against a search over all edits and against splits of any kind."""

import hashlib
import heapq
import random
import re

import pytest
from pyspark.sql import functions as F

from zonetide.llm import repair

PATTERN = re.compile("(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string"


def searched(kinds):
    """Least (cost, audit) by shortest paths over (turns done, roles so far)."""
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, roles = heapq.heappop(heap)
        state = roles if roles in ("", "s") else ("ua"[len(roles.lstrip("s")) % 2 == 0])
        if i == len(kinds) and PATTERN.fullmatch(roles):
            return cost, audit
        if (i, state) in seen:
            continue
        seen.add((i, state))
        steps = [(3, "I", i, roles + r) for r in "ua"]
        if i < len(kinds):
            k = kinds[i]
            steps.append((4, "D", i + 1, roles))
            if k != "-":
                extra = 3 if k.isupper() else 0
                steps.append((extra, "K", i + 1, roles + k.lower()))
                steps += [(3 + extra, "R", i + 1, roles + r) for r in "ua"]
        for more, letter, j, after in steps:
            if re.fullmatch("s?(ua)*u?", after):
                heapq.heappush(heap, (cost + more, audit + letter, j, after))


def kinds_of(draw, n):
    return "".join(draw.choices("suaxSUAX-", (2, 6, 6, 1, 1, 3, 3, 1, 3), k=n))


def test_parser_equals_search():
    draw, parser = random.Random(1), repair.Parser()
    for n in range(12):
        for _ in range(40):
            kinds = kinds_of(draw, n)
            assert repair.best(parser.cell(kinds)) == searched(kinds), kinds


def test_every_cut_of_a_span_gives_the_same_cell():
    draw, parser = random.Random(2), repair.Parser()
    for _ in range(60):
        kinds = kinds_of(draw, 9)
        whole = parser.cell(kinds)
        assert all(repair.combined(parser.cell(kinds[:i]), parser.cell(kinds[i:])) == whole for i in range(1, 9))


def by_hand(rows):
    """Parse and repaired text of rows (turn, role, text) in order."""
    kinds, seen = "", set()
    for _, role, text in rows:
        shown = re.sub("[\x20\x09-\x0d]", "", text)
        initial = role[:1] if role[:1] in tuple("sua") else "x"
        kinds += "-" if not shown or (role, text) in seen else initial if shown[-1] in ".!?" else initial.upper()
        seen.add((role, text))
    cost, audit = searched(kinds)
    told, left, out = [], list(rows), 0
    for letter in audit:
        _, role, text = left.pop(0) if letter != "I" else (0, "", "")
        if letter == "D":
            continue
        told.append((role if letter == "K" else ("user", "assistant")[out % 2], text))
        out += not (letter == "K" and role.startswith("s"))
    return cost, audit, told


@pytest.mark.parametrize("span", [2, 3, 256])
def test_repair_in_spans_of_any_length(spark, monkeypatch, span):
    monkeypatch.setattr(repair, "SPAN", span)
    draw = random.Random(3)
    said = ["Yes.", "No!", "", " \n", "and then", "What?", "ok ", "été ", "x.\n"]
    convs = {
        c: [(t, draw.choice(["user", "assistant", "system", "tool", "", "s"]), draw.choice(said) + ("" if draw.random() < 0.4 else f"{t}.")) for t in range(n)]
        for c, n in enumerate([1, 2, 3, 5, 8, 40, 90])
    }
    convs[None] = [(None, "user", "hm")] * 4 + [(3, "user", "hm"), (4, "assistant", "well.")]
    rows = [(c, t, role, text, 1) for c, turns in convs.items() for t, role, text in turns]
    draw.shuffle(rows)
    found, turns = repair.repair(spark.createDataFrame(rows, SCHEMA + ", n long").repartition(3))
    found = {None if r["none"] else r["conv"]: r for r in found.collect()}
    told = {}
    for r in sorted(turns.collect(), key=lambda r: r["at"]):
        told.setdefault(None if r["none"] else r["conv"], []).append((r["role"], r["text"]))
    for c, turns in convs.items():
        cost, audit, text = by_hand(turns)
        assert (found[c]["cost"], found[c]["audit"]) == (cost, audit)
        assert told.get(c, []) == text
        initials = [role[:1] or "x" for _, role, _ in turns]
        assert found[c]["illegal"] == sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def test_query_on_odd_rows(spark, tmp_path):
    rows = [(1, t, "user" if t % 2 else "assistant", f"say {t}.") for t in range(9)] * 2
    rows += [(None, None, None, None), (2, None, "user", None), (2, 5, None, "x"), (2, 9, "system", "Be kind.")]
    rows = [(*r, "clash", "clash") for r in rows]
    spark.createDataFrame(rows, SCHEMA + ", kind string, n string").write.parquet(str(tmp_path / "conversations.parquet"))
    out = {r["conv_id"]: r for r in repair.op11_conversation_repair(spark, str(tmp_path)).collect()}
    assert set(out) == {1, 2, None}
    assert out[1]["duplicate"] >= 8
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "none" / "conversations.parquet"))
    assert repair.op11_conversation_repair(spark, str(tmp_path / "none")).count() == 0


def test_conversation_that_is_dropped_whole(spark, tmp_path):
    ids = spark.range(400).selectExpr("id AS conv_id", "0L AS turn", "'user' AS role", "'Hi.' AS text")
    ids = ids.where("crc32(cast(concat(conv_id, ':', turn) AS binary)) % 20 = 0")
    ids.write.parquet(str(tmp_path / "conversations.parquet"))
    rows = repair.op11_conversation_repair(spark, str(tmp_path)).drop("conv_id").distinct().collect()
    assert [tuple(r) for r in rows] == [(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_damage_is_as_stated(spark):
    df = spark.createDataFrame([(None, None, None, None), (1, 2, "assistant", "a.b!c?")] , SCHEMA)
    keys = df.select(F.crc32(F.concat(repair.spaced(F.col("conv_id").cast("string")), F.lit(":"), repair.spaced(F.col("turn").cast("string"))).cast("binary")).alias("c"))
    import zlib

    assert [r["c"] for r in keys.collect()] == [zlib.crc32(b" : "), zlib.crc32(b"1:2")]
