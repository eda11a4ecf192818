"""The operators against brute force, on rows made for the purpose and on the test tables."""

import math
import random
import textwrap
import zlib
from collections import Counter

import compare
import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL
from pyspark.sql import Observation
from pyspark.sql import functions as F

from zonetide.llm import (
    chat,
    common,
    decontaminate,
    labelled,
    licenses,
    lm,
    mixing,
    neardup,
    quality,
    topk,
    toxicity,
    urls,
)
from zonetide.llm.queries import ORACLES, QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id string, kept int, label string"
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(60_000))
ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
EXAMPLES = [
    (1, "The quick brown fox jumps over the lazy dog and runs away home", "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog and runs away home", "en", "a"),
    (3, "the quick BROWN fox jumps over the lazy dog and runs away home", "en", None),
    (4, None, None, None),
    (5, "", "en", "b"),
    (6, " \n\t ", "en", "b"),
    (7, LONG, "en", "b"),
    (8, LONG + " end", None, "b"),
    (9, f"Before it. {ITEM.upper()}! After it.", "en", "c"),
    (10, "one two", "en", "c"),
    (10, "one two", "en", "c"),
    (None, "one two", "en", "c"),
    (None, "nothing like the others here", "en", "c"),
    (12, "Ünïcode ÄÖÜ straße … 漢字 \U0001f600 text", "de", ""),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, lang, s, len(t or ""), "x", 7, "y") for i, t, lang, s in EXAMPLES]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (2, 1, 1), (5, 0, 0), (7, 0, 1), (None, 1, 1), (8, None, None), (3, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def con():
    return compare.connect(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert compare.check(spark, con, name, SMALL) == []


def test_every_operator_is_registered():
    assert sorted({int(n.split("_")[0][2:]) for n in QUERIES}) == list(range(1, 14))


# --- mixing ---------------------------------------------------------------------------


def test_water_filling_clamps_and_reshares(spark):
    rows = [("a", 100, 3), ("b", 1000, 1), ("c", 50, 2), ("d", 0, 5)]
    sources = spark.createDataFrame(rows, "source string, size long, weight int")
    got = {r["source"]: r["target"] for r in mixing.water_fill(sources, 600.0, 2.0).collect()}
    # a and c stop at twice their size, b gets the rest
    assert got == {"a": 200.0, "b": 300.0, "c": 100.0, "d": 0.0}


def test_mix_takes_near_targets(spark, docs):
    sized, plan = mixing.mixed(docs)
    rows = mixing.take(sized, plan).collect()
    assert len(rows) == len(EXAMPLES)
    taken, target, largest = Counter(), {}, Counter()
    for r in rows:
        assert 0 <= r["copies"] <= 2
        taken[r["source"]] += r["size"] * r["copies"]
        target[r["source"]] = r["target"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for source, wanted in target.items():
        assert abs(taken[source] - wanted) <= max(largest[source] / 2, 1)


WORDS = "one two three four five six seven eight nine ten"


SHARED = {
    "one id": lambda i: (5, WORDS),
    "null id": lambda i: (None, WORDS),
    "null id, own texts": lambda i: (None, f"{i} {WORDS[4:]}"),
    "a third shares an id": lambda i: (i if i % 3 else 0, WORDS),
}


@pytest.mark.parametrize("kind", SHARED)
def test_mix_reaches_targets_where_ids_are_shared(spark, monkeypatch, kind):
    monkeypatch.setattr(mixing, "MANY", 4)
    rows = [(*SHARED[kind](i), None, "s", i) for i in range(40)]
    shared = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").repartition(5)
    sized, plan = mixing.mixed(shared)
    assert sum(r["size"] * r["copies"] for r in mixing.take(sized, plan).collect()) == 600
    if kind == "one id":
        monkeypatch.setattr(mixing, "SHARE", 0.3)
        out = mixing.repeat_documents(shared).collect()
        assert len(out) == 12
        assert max(Counter(r["n_chars"] for r in out).values()) == 1


def test_repeated_documents_keep_columns(docs, none):
    out = mixing.repeat_documents(docs)
    assert out.columns == [*docs.columns, "repetition"]
    sized, plan = mixing.mixed(docs)
    assert out.count() == mixing.take(sized, plan).agg(F.sum("copies")).first()[0]
    assert mixing.repeat_documents(none).count() == 0


# --- licenses -------------------------------------------------------------------------


def test_license_notices_word_for_word(spark):
    notices = [(i, f"Some prose.\nMore of it.\n{t}\nAnd more.") for i, t in enumerate(licenses.TEMPLATES.values())]
    near = "This work is licensed under the GNU General Public License, version 2."
    rows = [*notices, (100, near), (101, None), (102, ""), (103, "License to sing. Copyright nothing."), (104, "İ all RIGHTS reserved.")]
    found = licenses.find_licenses(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r["doc_id"]: [f["license"] for f in r["findings"]] for r in found.collect()}
    for i, name in enumerate(licenses.TEMPLATES):
        assert name in got[i], name
    assert [got[i] for i in (100, 101, 102, 103)] == [[], [], [], []]
    assert got[104] == ["all-rights-reserved"]


def test_license_text_with_small_differences():
    text = licenses.TEMPLATES["MIT-text"].replace("free of charge", "free of any charge").replace(" and ", " & ", 1)
    n, found = licenses.scan("Title\n" + text.replace(", ", ",\n"))
    assert n and [f["license"] for f in found] == ["MIT-text"]
    assert 0 < found[0]["differences"] <= 4


PROSE = "a plain sentence about rivers, tea and the long way home by night; "


def test_license_notices_inside_long_lines():
    assert all(licenses.trigger_words([m.group().lower() for m in licenses.WORD.finditer(t)]) for t in licenses.TEMPLATES.values())
    for size in (1200, 2200, 30_000):
        around = PROSE * (size // len(PROSE) // 2)
        for name, text in licenses.TEMPLATES.items():
            found = licenses.scan(around + text + " " + around)[1]
            assert [f["license"] for f in found] == [name], (size, name)
            start = len(around)
            assert (found[0]["start"], found[0]["end"]) == (start, start + len(text.rstrip("."))), name
    several = " ".join(f"{PROSE} {t} {PROSE}" for t in licenses.TEMPLATES.values())
    assert [f["license"] for f in licenses.scan(several)[1]] == list(licenses.TEMPLATES)
    twice = f"{licenses.TEMPLATES['BSD-text']} " * 2
    assert [(f["license"], f["differences"]) for f in licenses.scan(twice)[1]] == [("BSD-text", 0)] * 2


@pytest.mark.parametrize("width", [1, 12, 30, 70])
def test_license_notices_wrapped_over_lines(width):
    long_line = PROSE * 40
    for name, text in licenses.TEMPLATES.items():
        wrapped = textwrap.fill(text, width, break_on_hyphens=False, break_long_words=False)
        for white in ("\n", "\r\n", " \n\t  "):
            found = licenses.scan(f"{long_line}\n{wrapped.replace(chr(10), white)}\n{long_line}")[1]
            assert [f["license"] for f in found] == [name], (name, white)


def test_license_floor_loses_no_notice(spark, monkeypatch):
    """What compression ranks above the floor against confirming every template everywhere."""
    draw = random.Random(7)
    texts = [r["text"] for r in common.table(spark, SMALL, "documents").collect()]
    for template in licenses.templates():
        for white in (" ", "\n", " \r\n\t"):
            for n in {0, template.allowed // 2, template.allowed}:
                words = list(template.words)
                for place in draw.sample(range(len(words)), n):
                    words[place] = f"{draw.choice(PROSE.split())}{draw.randrange(99)}"
                around = PROSE * draw.choice([0, 1, 40])
                texts.append(f"{around} all rights {white.join(words)} copyright {around}" * draw.choice([1, 2]))
    ranked = [licenses.scan(t) for t in texts]
    monkeypatch.setattr(licenses, "FLOOR", float("-inf"))
    assert ranked == [licenses.scan(t) for t in texts]
    assert sum(len(found) for _, found in ranked) > 80


def test_license_ranks_the_right_template_first():
    for template in licenses.templates():
        words = [*PROSE.lower().replace(";", "").replace(",", "").split(), *template.words, *PROSE.split()[:5]]
        first = [licenses.ranked(words, at)[0] for at in licenses.trigger_words(words)]
        assert any(t is template or len(t.words) > len(template.words) for _, t, _, _ in first)
        assert all(licenses.share_saved(template, " ".join(template.words)) == 1.0 for _ in range(2))


def test_license_equals_substring_search(spark):
    table = common.table(spark, SMALL, "documents")
    got = {r["doc_id"]: r["licenses"] for r in QUERIES["op2_license_scan"](spark, SMALL).collect()}
    for r in table.collect():
        held = sorted(k for k, t in licenses.TEMPLATES.items() if t.lower() in (r["text"] or "").lower())
        assert got[r["doc_id"]] == ",".join(held)


# --- decontamination ------------------------------------------------------------------


def brute_hits(text, items, window=10):
    words = decontaminate.words_of(text)
    hit, found = set(), set()
    for item_id, item in items:
        own = decontaminate.words_of(item)
        m = min(len(own), window)
        wanted = {tuple(own[i : i + m]) for i in range(len(own) - m + 1)} if m else set()
        for i in range(len(words) - m + 1):
            if tuple(words[i : i + m]) in wanted:
                hit.update(range(i, i + m))
                found.add(item_id)
    return len(words), len(hit), sorted(found - {None})


ITEMS = [(1, ITEM), (2, ITEM + " mu nu"), (2, ITEM + " mu nu"), (3, "one two"), (4, None), (5, ""), (None, "漢字"), (6, "a a a a a a a a a a a a")]


@pytest.mark.parametrize("block_bytes", [10**6, 60])
def test_decontamination_equals_brute_force(spark, docs, none, monkeypatch, block_bytes):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    more = spark.createDataFrame([(50, " ".join(["a"] * 40)), (51, "a " * 11 + "b " + "a " * 9)], "doc_id long, text string")
    every = docs.select("doc_id", "text").unionByName(more)
    rows = decontaminate.find_matches(every, items).collect()
    want = [(r["doc_id"], *brute_hits(r["text"], ITEMS)) for r in every.collect()]
    got = [(r["doc_id"], r["found"]["n_words"], r["found"]["n_hit"], r["found"]["item_ids"]) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    left = decontaminate.remove_contaminated(docs, items)
    assert left.columns == docs.columns
    clean = Counter(i for i, _, n, _ in ((r["doc_id"], *brute_hits(r["text"], ITEMS)) for r in docs.collect()) if not n)
    assert Counter(r["doc_id"] for r in left.collect()) == clean
    assert decontaminate.find_matches(none, items).count() == 0
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.remove_contaminated(docs, empty).count() == len(EXAMPLES)


def test_longest_matches_have_locations(spark):
    items = spark.createDataFrame([(7, "zero " + ITEM + " mu")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "other words " + ITEM + " mu nu")], "doc_id long, text string")
    (row,) = decontaminate.find_matches(docs, items).collect()
    (match,) = row["found"]["matches"]
    assert match.asDict() == {"item_id": 7, "item_start": 1, "doc_start": 2, "length": 12}


def brute_matches(text, items, window=10):
    """Every verbatim stretch that can't be extended, of a window at least or a whole shorter item."""
    words, found = decontaminate.words_of(text), []
    for item_id, item in items:
        own = decontaminate.words_of(item)
        for i in range(len(words)):
            for j in range(len(own)):
                if i and j and words[i - 1] == own[j - 1]:
                    continue
                n = 0
                while i + n < len(words) and j + n < len(own) and words[i + n] == own[j + n]:
                    n += 1
                if n >= min(window, len(own)):
                    found.append((item_id, j, i, n))
    return sorted(found, key=repr)


@pytest.mark.parametrize(("block_bytes", "pairs"), [(10**6, 1 << 18), (10**6, 3), (150, 1 << 18)])
def test_longest_matches_of_items_that_share_a_passage(spark, monkeypatch, block_bytes, pairs):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(decontaminate, "PAIRS", pairs)
    p, x, y = (" ".join(f"{c}{i}" for i in range(1, n)) for c, n in (("p", 13), ("x", 21), ("y", 21)))
    items = [(1, f"{p} {x}"), (2, f"{p} {y}"), (3, f"{p} {x}"), (4, f"{y} {p} z {p} {y}"), (5, "p3 p4"), (6, "a " * 13)]
    texts = [f"{p} {y}", f"q {p} {x} q {p}", f"{x} {y}", "a " * 15, f"{y} {p} z"]
    table = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in decontaminate.find_matches(docs, table).collect():
        got = sorted(((m["item_id"], m["item_start"], m["doc_start"], m["length"]) for m in r["found"]["matches"]), key=repr)
        assert got == brute_matches(texts[r["doc_id"]], items)
    assert (2, 0, 0, 32) in brute_matches(texts[0], items)


# --- chat -----------------------------------------------------------------------------


def test_chat_flattens_parts(spark):
    parts = [
        {"type": "text", "text": "look <s>[TEXT] at"},
        {"type": "image", "ref": "a.png", "width": 28, "height": 14},
        {"type": "audio", "ref": "b.wav", "seconds": 2.0},
        {"type": "document", "ref": "c.pdf", "pages": 3},
        {"type": None, "text": None},
    ]
    fields = ("type", "text", "ref", "width", "height", "seconds", "pages")
    content = [tuple(p.get(f) for f in fields) for p in parts]
    rows = [(1, 0, "user", content), (1, 1, "assistant", [("text", "ok\\", None, None, None, None, None)]), (2, None, None, None)]
    messages = spark.createDataFrame(rows, f"conv_id long, turn long, role string, content array<{chat.PART}>")
    got = {r["conv_id"]: r for r in chat.format_chats(messages).collect()}
    body = "look \\1s>\\2TEXT] at<image><audio><document>"
    assert got[1]["formatted"] == f"<s>user[TEXT]{body}</s><s>assistant[TEXT]ok\\0</s>"
    assert [(a["type"], a["ref"], a["tokens"]) for a in got[1]["attachments"]] == [("image", "a.png", 2), ("audio", "b.wav", 50), ("document", "c.pdf", 768)]
    assert got[1]["extra_tokens"] == 2 + 50 + 768 - 3
    (span,) = got[1]["loss_spans"]
    assert got[1]["formatted"][span["start"] : span["end"]] == "ok\\0"
    assert got[2]["formatted"] == "<s>[TEXT]</s>"


ODD = ["", "</s>", "<s>[TEXT]</s>", "\\0\\1\\2", "\\", "[/INST] [INST]", "\\\\<[", "plain\ntext", "\\2[\\0<"]


def test_chat_round_trip(spark):
    rows = [(i, t, r, x) for i in range(3) for t, (r, x) in enumerate(zip(ODD, reversed(ODD), strict=True))]
    rows += [(None, 0, None, None), (9, None, "user", LONG), (9, None, "user", LONG)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    messages = table.withColumn("content", chat.text_part(F.col("text")))
    out = chat.format_chats(messages).select("conv_id", chat.read_turns(F.col("formatted")).alias("turns")).collect()
    got = {r["conv_id"]: [(t["role"], t["text"]) for t in r["turns"]] for r in out}
    assert got[1] == list(zip(ODD, reversed(ODD), strict=True))
    assert got[None] == [("", "")] and got[9] == [("user", LONG), ("user", LONG)]
    assert chat.format_chats(messages.where("false")).count() == 0


# --- near-duplicates ------------------------------------------------------------------


def brute_components(rows, width, percent):
    """Smallest reachable id by texts, rows without id linked to equal sets only."""
    sets = {}
    for i, text in rows:
        words = common.spaced_words(text)
        n = min(width, len(words))
        sets[i] = {tuple(words[j : j + n]) for j in range(len(words) - n + 1)} if n else set()
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                lo, hi = sorted((root(a), root(b)))
                parent[hi] = lo
    return {i: (len(sets[i]), root(i)) for i in sets}


def copies(seed=3):
    """Groups of near copies around the threshold, with chains and shared passages."""
    random = np.random.default_rng(seed)
    word = lambda: f"w{random.integers(100000)}"
    passage = [word() for _ in range(60)]
    rows = []
    for group in range(40):
        base = [word() for _ in range(int(random.integers(20, 150)))]
        if group % 3 == 0:
            base += passage
        for _ in range(int(random.integers(1, 12))):
            text = list(base)
            for _ in range(int(random.integers(0, max(2, len(base) // 25)))):
                text[int(random.integers(len(text)))] = word()
            rows.append(text)
    order = random.permutation(len(rows))
    return [(int(i), " ".join(rows[j])) for i, j in enumerate(order)]


def test_near_duplicates_equal_brute_force(spark):
    rows = copies()
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80).collect()
    want = brute_components(rows, 5, 80)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert len({c for _, c in want.values()}) < len(rows)


def test_links_between_is_exact():
    random = np.random.default_rng(0)
    sets = [np.unique(random.integers(0, 40, 30).astype(np.uint64)) for _ in range(20)]
    got = neardup.links_between(sets, sets, 80)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            both = len(np.intersect1d(a, b))
            assert got[i, j] == (100 * both >= 80 * (len(a) + len(b) - both))


def test_estimate_follows_similarity():
    random = np.random.default_rng(1)
    base = random.integers(0, 2**63, 400).astype(np.uint64)
    for similar in (0.2, 0.5, 0.8, 1.0):
        shared = int(400 * 2 * similar / (1 + similar))
        other = np.concatenate([base[:shared], random.integers(0, 2**63, 400 - shared).astype(np.uint64)])
        signatures = np.stack([neardup.signature_of(neardup.minima(s)) for s in (base, other)]).view(np.uint64)
        assert abs(neardup.estimates(signatures)[0, 1] - similar) < 0.15


def test_near_duplicates_of_odd_rows(docs, none):
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(docs).collect()), key=repr)
    assert (1, 9, 1, True) in got and (2, 9, 1, False) in got and (3, 9, 1, False) in got
    assert [r for r in got if r[0] in (4, 5, 6)] == [(i, 0, i, True) for i in (4, 5, 6)]
    assert [r[2:] for r in got if r[0] in (7, 8)] == [(7, True), (7, False)]
    assert got.count((10, 1, 10, True)) == 2
    assert (None, 1, 10, False) in got and (None, 1, None, True) in got
    kept = neardup.keep_first(docs)
    assert kept.columns == docs.columns
    assert neardup.near_duplicates(none).count() == 0 and neardup.keep_first(none).count() == 0


def test_keep_first_leaves_one_row_of_each_group(spark):
    a, b, c, d, e = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcde")
    rows = [(1, a), (1, a), (2, a + " more"), (None, a), (None, b), (None, b), (3, c), (None, c), (4, c)]
    rows += [(5, d), (5, d), (5, e), (6, ""), (None, ""), (None, None), (7, "x y")]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, `n r` int").repartition(3)
    kept = neardup.keep_first(docs)
    assert kept.columns == docs.columns
    want = [(1, a), (None, b), (3, c), (5, d), (5, e), (6, ""), (None, ""), (None, None), (7, "x y")]
    got = [tuple(r) for r in kept.collect()]
    assert Counter(r[:2] for r in got) == Counter(want)
    assert all(rows[n] == (i, t) for i, t, n in got)


# --- language model -------------------------------------------------------------------


def test_lm_base_equals_brute_force_and_model_is_better(spark):
    rows = {r["doc_id"]: r for r in lm.op6_lm_score(spark, SMALL).collect()}
    texts = {r["doc_id"]: common.spaced_words(r["text"]) for r in common.table(spark, SMALL, "documents").collect()}
    counts = Counter()
    for i, words in texts.items():
        if zlib.crc32(str(i).encode()) % 5 != 1:
            counts.update(words)
            counts[None] += 1
    total, distinct = sum(counts.values()), len(counts)
    gain = 0.0
    for i, words in texts.items():
        tokens = [*words, None]
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in tokens)
        r = rows[i]
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert (r["n_tokens"], r["n_known"]) == (len(tokens), sum(counts[w] > 0 for w in tokens))
        assert (r["train_tokens"], r["held_out"]) == (total, zlib.crc32(str(i).encode()) % 5 == 1)
        gain += (r["score"] - r["base_score"]) if r["held_out"] else 0
    assert len(rows) == len(texts) and gain > 0


def toy_classes(n=900):
    counts = np.sort(np.random.default_rng(2).zipf(1.4, n).clip(1, 5000))[::-1].astype(float)
    words = [b"", *(f"w{i}".encode() for i in range(1, n))]
    return lm.Classes({lm.word_hash(w): i for i, w in enumerate(words)}, counts, int(counts.sum()) + 70, n + 40)


def test_lm_is_a_distribution():
    classes = toy_classes()
    network = lm.Network(classes)
    h = np.random.default_rng(0).normal(0, 1, (1, lm.HIDDEN)).astype(np.float32)
    ids = np.arange(len(classes.counts) + 1)
    log_p, _ = network.output(np.repeat(h, len(ids), axis=0), ids)
    # the last id stands for the whole rare class, the unknown word among it
    assert (10 ** (log_p / np.log(10) + classes.within)).sum() == pytest.approx(1, abs=1e-4)


def test_lm_splits_texts_into_the_same_words(monkeypatch):
    texts = [None, "", " \t", "A b\x0b C\x1fD e\u3000É x", " x ", "x\x00y  z\x85q", *["w " * 5] * 3, "LONG " * 50]
    for size in (8, 30, 1 << 20):
        monkeypatch.setattr(lm, "SPLIT_BYTES", size)
        for column in (pa.array(texts), pa.array(["cut off", *texts])[1:], pa.array([], pa.string())):
            got = []
            for split in lm.split_texts(column):
                assert split.rows.start == len(got) == split.rows.stop - len(split.starts) + 1
                got += [split.hashes[split.codes[i:j]].tolist() for i, j in zip(split.starts, split.starts[1:], strict=False)]
            words = [[*common.spaced_words(t), lm.END] for t in column.to_pylist()]
            assert got == [[lm.word_hash(w) for w in ws] for ws in words]


def test_lm_softmax_is_the_same_with_and_without_bounds():
    random = np.random.default_rng(7)
    x, bias, chosen = random.normal(0, 2, (50, 9)), random.normal(0, 5, 9), random.integers(0, 9, 50)
    want = x + bias
    want = want[np.arange(50), chosen] - np.log(np.exp(want).sum(axis=1))
    for reach in (np.abs(x).max(axis=0), np.full(9, 500.0)):
        terms = x.copy()
        log_p, sums = lm._softmax(terms, chosen, bias, reach)
        assert np.allclose(log_p, want)
        assert np.allclose((terms / sums[:, None]).sum(axis=1), 1)


def test_lm_gradients_and_carried_state():
    classes = toy_classes(40)
    network = lm.Network(classes)
    network.w = {k: v.astype(np.float64) for k, v in network.w.items()}
    random = np.random.default_rng(4)
    runs = random.integers(0, 41, (5, 7))
    runs[1, 4:] = -1
    grads, _, _ = network.gradients(runs, np.zeros((5, lm.HIDDEN)))
    n = (runs[:, 1:] >= 0).sum()

    def loss():
        return network.gradients(runs, np.zeros((5, lm.HIDDEN)))[2] / n

    for name in ("input", "state", "out", "word"):
        w = network.w[name].reshape(-1)
        for at in random.choice(np.flatnonzero(grads[name].reshape(-1)), 4):
            keep = w[at]
            w[at] = keep + 1e-5
            up = loss()
            w[at] = keep - 1e-5
            down = loss()
            w[at] = keep
            assert (up - down) / 2e-5 == pytest.approx(grads[name].reshape(-1)[at], rel=2e-2, abs=2e-5)


def test_lm_scores_whole_texts_alike_in_any_company():
    classes = toy_classes()
    network = lm.Network(classes)
    random = np.random.default_rng(6)
    texts = [random.integers(0, 900, n) for n in (1, 30, 200, 24, 49)]
    together = network.score(texts)
    for i, text in enumerate(texts):
        assert network.score([text])[0] == pytest.approx(together[i], rel=1e-5)


def test_lm_learns_from_every_word_with_the_state_carried_on(monkeypatch):
    class Shared:
        def __init__(self, value):
            self.value = value

    classes = toy_classes()
    network = lm.Network(classes)
    monkeypatch.setattr(lm, "STRETCH", 10 * lm.WINDOW)
    own = [i for i in range(1, 40) if not lm.held_out(i)]
    long = own[0]
    texts = {i: [f"w{1 + (i * j) % 950}" for j in range(n)] for i, n in zip(own, (20_000, 1, 0, 240, 239, 100), strict=False)}
    batch = pa.record_batch([pa.array(list(texts)), pa.array([" ".join(t) for t in texts.values()])], names=["doc_id", "text"])
    (rows,) = lm._stretches(Shared(classes), Shared(lm._packed(network.w)))([batch])
    found = lm._read_stretches([rows])
    assert max(len(ids) for ids, _ in found) == lm.STRETCH + 1
    ids_of = lm.Ids(classes)
    want = Counter(w for t in texts.values() for w in ids_of.of([x.encode() for x in t]).tolist())
    assert Counter(w for ids, _ in found for w in ids[1:].tolist()) == want

    ends = {}  # the state of the long text before each of its stretches
    whole = np.concatenate([[ids_of[lm.END]], ids_of.of([x.encode() for x in texts[long]])])
    h = np.zeros((1, lm.HIDDEN), np.float32)
    for at in range(len(whole) - 1):
        if at % lm.STRETCH == 0:
            ends[at] = h[0]
        h, _ = network.step(classes.inputs(whole[at : at + 1]), h)
    assert np.allclose(network.states(whole), list(ends.values()), atol=1e-6)

    seen, before = Counter(), []
    monkeypatch.setattr(lm, "BATCH", 3)
    inner = lm.Network.gradients

    def watched(self, runs, h):
        seen.update(runs[:, 1:][runs[:, 1:] >= 0].tolist())
        out = inner(self, runs, h)
        before.append((len(h), np.abs(h).sum(axis=1), out[1]))
        return out

    monkeypatch.setattr(lm.Network, "gradients", watched)
    network.train(found, 1, 1e-3, 1)
    assert seen == want
    assert all(n <= 3 for n, _, _ in before) and sum((a == 0).sum() for _, a, _ in before) == len(texts)


def test_lm_of_odd_rows(spark, docs, none):
    rows = lm.score(docs).collect()
    assert len(rows) == len(EXAMPLES)
    assert all(r["held_out"] for r in rows if r["doc_id"] is None)
    assert [r["n_tokens"] for r in rows if r["doc_id"] in (4, 5, 6)] == [1, 1, 1]
    assert all(math.isfinite(r["score"]) for r in rows)
    assert lm.score(none).count() == 0
    alone = lm.score(docs.where("doc_id is null")).collect()
    assert [(r["n_known"], r["train_tokens"]) for r in alone] == [(0, 0)] * 2
    assert all(r["base_score"] == pytest.approx(0) == r["score"] for r in alone)


# --- urls -----------------------------------------------------------------------------

URLS = [
    ("http://a.net/x?y#z", "a.net", "/x", "net/", "block"),
    ("HTTP://WWW.Example.NET/en/1", "www.example.net", "/en/1", "example.net/en/", "allow"),
    ("https://example.net/en", "example.net", "/en", "net/", "block"),
    ("x://sub.example.com/de/", "sub.example.com", "/de/", "example.com/de/", "block"),
    ("x://notexample.com/de/", "notexample.com", "/de/", None, None),
    ("x://some.org/fr/a://b", "some.org", "/fr/a://b", "org/fr/", "allow"),
    ("x://a.net", "a.net", "", None, None),
    ("x://a.net?/en/", "a.net", "", None, None),
    ("no scheme", "", "", None, None),
    ("", "", "", None, None),
    (None, "", "", None, None),
    ("line\nbreak://h\nost.net/p\nath#f", "h\nost.net", "/p\nath", "net/", "block"),
]


def test_url_rules(spark):
    rows = [(i, u, "own host", "x") for i, (u, *_) in enumerate(URLS)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    out = {r["page_id"]: r for r in urls.judge_urls(pages).collect()}
    assert out[0]["host"] == "own host"
    for i, (_, host, path, rule, verdict) in enumerate(URLS):
        judged = out[i]["judged"]
        assert (judged["host"], judged["path"], judged["rule"]) == (host, path, rule)
        assert judged["verdict"] == verdict if verdict else judged["verdict"] in ("allow", "block")
    assert urls.judge_urls(pages.where("false")).count() == 0


def test_url_labels_are_different_urls_of_both_verdicts(spark):
    named = [(f"x://sub.example.com/de/{i}",) for i in range(60)] + [(f"x://some.org/fr/{i}",) for i in range(60)]
    first = urls.rule_labels(spark.createDataFrame(named, "url string"), max_rows=120).orderBy(F.xxhash64("url")).first()["url"]
    rows = spark.createDataFrame(named + [(first,)] * 500, "url string")
    got = urls.rule_labels(rows, max_rows=40).collect()
    assert len({r["url"] for r in got}) == 40
    assert Counter(r["verdict"] for r in got) == {"allow": 20, "block": 20}


def test_urls_are_judged_after_anything_else_in_the_session(spark):
    """An observed table leaves an object in the session that cannot be sent to executors."""
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    common.components(spark.createDataFrame([(1, 2), (2, 3)], "a long, b long")).collect()
    assert QUERIES["op7_url_filter"](spark, SMALL).count() == spark.read.parquet(f"{SMALL}/pages.parquet").count()


def test_url_model_learns(spark):
    good, bad = "http://news{}.site/story/{}", "http://casino{}.site/win-cash/{}"
    row = lambda u, v: (u, v)
    small = [row(good.format(i, i), "allow") for i in range(40)] + [row(bad.format(i, i), "block") for i in range(40)]
    table = spark.createDataFrame(small, "url string, verdict string")
    fresh = [(good.format(i, i * 7), "allow") for i in range(100, 130)] + [(bad.format(i, i * 7), "block") for i in range(100, 130)]
    out = urls.judge_urls(spark.createDataFrame(fresh, "url string, want string"), table).collect()
    assert sum(r["judged"]["verdict"] == r["want"] for r in out) >= 57
    one = urls.judge_urls(spark.createDataFrame([(LONG,)], "url string"), table.where("verdict = 'block'")).first()
    assert one["judged"]["verdict"] == "block"


# --- classifiers ----------------------------------------------------------------------


def test_held_out_accuracy(spark):
    docs, labels = (common.table(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    out = labelled.remainder(F.col("doc_id")) == 0
    quality_rows = quality.op9_quality(spark, "/root/testdata/sf0.01").join(labels, "doc_id").where("held_out").collect()
    assert len(quality_rows) > 50
    assert np.mean([r["predicted"] == r["quality"] for r in quality_rows]) > 0.95
    toxic = toxicity.score(docs, toxicity.train(docs, labels)).join(labels, "doc_id").where(out).collect()
    assert np.mean([r["rejected"] == (r["toxic"] == 1) for r in toxic]) > 0.9
    assert all(r["severity"] >= r["p_toxic"] for r in toxic)


def test_thresholds_rise_and_weights_are_shared():
    random = np.random.default_rng(8)
    strength = random.integers(0, 4, 300)
    rows = [{0: 1.0 * k, 1 + int(random.integers(20)): 1.0} for k in strength]
    weights, thresholds = toxicity.fit_grades(rows, strength, 21)
    assert (np.diff(thresholds) >= 0).all() and weights[0] > 0.5
    assert np.abs(weights[1:]).max() < weights[0] / 2
    expected = toxicity.Model({}, weights, thresholds).probabilities([{0: 0}, {0: 3}, {0: 20}]).sum(axis=1)
    assert (np.diff(expected) > 0).all()


@pytest.mark.parametrize("module", [toxicity, quality])
def test_classifiers_on_odd_rows(spark, docs, none, labels, module):
    model = module.train(docs, labels)
    assert module.score(docs, model).count() == len(EXAMPLES)
    assert module.score(none, model).count() == 0
    keep = toxicity.keep_clean if module is toxicity else quality.keep_good
    for known in (labels, labels.where("false"), labels.where("quality = 1 and toxic = 0")):
        left = keep(docs, known)
        assert left.columns == docs.columns
        assert left.count() == len(EXAMPLES) if known is not labels else left.count() <= len(EXAMPLES)
    assert keep(none, labels).count() == 0


# --- search ---------------------------------------------------------------------------


def brute_topk(vectors, queries, k):
    out = []
    for q in queries:
        scored = sorted((-int(np.dot(vectors[q], v)), i) for i, v in vectors.items() if i != q)
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return out


@pytest.mark.parametrize("scale", [20, 2**28])
def test_topk_equals_brute_force_with_ties(spark, monkeypatch, scale):
    monkeypatch.setattr(topk, "SHARD_ROWS", 40)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 7)
    monkeypatch.setattr(topk, "LEAF_ROWS", 5)
    random = np.random.default_rng(9)
    centres = random.integers(-scale, scale, (6, 8))
    vectors = {i: centres[i % 6] + random.integers(-1, 2, 8) for i in range(300)}
    vectors |= {i: np.zeros(8, int) for i in range(300, 340)}  # many equal rows
    rows = [(i, [int(x) for x in v]) for i, v in vectors.items()]
    out = topk.top_k(spark.createDataFrame(rows, "vec_id long, v array<long>"), F.col("vec_id") % 10 == 0, 7)
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in out.collect())
    assert got == brute_topk(vectors, range(0, 340, 10), 7)


def test_topk_of_odd_rows(spark):
    rows = [(0, [1.0, 0.5]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [2.0, 0.0]), (5, [2.0, 0.0]), (6, []), (7, [1.0]), (None, [1.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").select("vec_id", topk.whole_vector(F.col("embedding")).alias("v"))
    got = topk.top_k(table, F.col("vec_id") % 5 == 0, 20).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == [
        (0, 1, 5, 64 * 128), (0, 2, 7, 64 * 64), (0, 3, 6, 0), (5, 1, 0, 64 * 128), (5, 2, 7, 128 * 64), (5, 3, 6, 0)
    ]
    assert topk.top_k(table.where("false"), F.lit(True)).count() == 0
    assert topk.top_k(table, F.lit(False)).count() == 0
