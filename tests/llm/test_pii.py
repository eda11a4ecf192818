"""Personal data against plain regular expressions and against made-up rows."""

import random
import re

from pyspark.sql import functions as F

from zonetide.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    twice = [2 * int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[::-2])) + sum(t // 10 + t % 10 for t in twice)) % 10 == 0


def sound(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(p) <= 255 for p in hit.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return [
        f"{kind}:{m.start()}:{m.end()}"
        for kind, pattern in BASE.items()
        for m in re.finditer(pattern, text or "")
        if sound(kind, m.group())
    ]


def found(spark, texts, kinds=pii.KINDS):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rows = pii.find_pii(docs, kinds).select("doc_id", pii.written(F.col("pii")).alias("s")).collect()
    return [r["s"].split(",") if r["s"] else [] for r in sorted(rows)]


ODD = [
    None,
    "",
    "   ",
    "a@b.c@d.e a@b.c_d@e.f a@b. @b.c x@y..z 1.2.3.4.5.6.7.8 999.1.1.1.5.5 001.002.003.0004",
    "1.2.3.4 1.2.3.256 4111 1111-1111 1111 4111111111111112 41111 11111 11111 1",
    "+1 (017) 555-7713 +49 30 1234 +12345678 +123456789 +1234567890123456 +1 ( ) +1--2 + 1 +1  2",
    "4111111111111111" * 3 + " 378282246310005 30569309025904",
    "ünï 漢字 😀 me.you@mail7.example.com 😀 +1 (017) 555-7713 é 10.0.0.1",
    "12 34 56 78 90 12 3 4-5-6--7 8  9",
]


def test_base_spans_equal_plain_patterns(spark):
    assert found(spark, ODD, pii.BASE) == [brute(t) for t in ODD]


def test_random_texts_equal_plain_patterns(spark):
    draw = random.Random(5)
    texts = ["".join(draw.choices("a.@-+ ()01249é😀", k=draw.randrange(60))) for _ in range(3000)]
    assert found(spark, texts, pii.BASE) == [brute(t) for t in texts]


def test_very_long_texts_take_linear_time(spark):
    shapes = ["a", "a.", "1", "1.", "1 ", "(555) 123-4567 ", "@a.b", "me@b.c 10.0.0.1 "]
    texts = [s * (60_000 // len(s)) for s in shapes] + ["+1" + " " * 60_000]
    got = [[s for s in spans if s.split(":")[0] in BASE] for spans in found(spark, texts)]
    # plain patterns take long on the first four
    plain = [[], [], [], [f"ip:{i}:{i + 7}" for i in range(0, 60_000, 8)], *map(brute, texts[4:])]
    assert got == plain


def test_checksums_and_context_decide_the_added_kinds(spark):
    texts = [
        "pay to GB82 WEST 1234 5698 7654 32 now",
        "pay to GB82 WEST 1234 5698 7654 33 now",
        "account DE89370400440532013000.",
        "xGB82WEST12345698765432",
        "SSN 123-45-6789",
        "part 123-45-6789",
        "SSN 666-45-6789",
        "call (555) 123-4567 today",
        "call +1 (555) 123-4567 today",
        "sum (555) 123-4567 today",
        'token = "04dbebab91ab85687d33eeaaf9ac699e1188"',
        'commit = "04dbebab91ab85687d33eeaaf9ac699e1188"',
    ]
    kinds = [[s.split(":")[0] for s in spans] for spans in found(spark, texts)]
    assert kinds == [["iban"], [], ["iban"], [], ["ssn"], [], [], ["tel"], ["phone"], [], ["secret"], []]


def test_context_moves_the_score_of_base_kinds_but_keeps_them(spark):
    docs = spark.createDataFrame([(1, "version 1.2.3.4"), (2, "host 1.2.3.4")], "doc_id long, text string")
    rows = sorted(pii.find_pii(docs).collect())
    assert [(r["pii"][0]["kind"], r["pii"][0]["score"]) for r in rows] == [("ip", 0.3), ("ip", 0.6)]


def test_columns_repeats_and_empty_tables(spark):
    schema = "doc_id long, text string, pii int, t string, digit int, row string, email_hits int"
    rows = [(1, "a@b.c", 5, "t", 1, "r", 2)] * 2 + [(None, None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, schema)
    out = pii.find_pii(docs)
    assert sorted(out.columns) == sorted(docs.columns)
    assert sorted((r["doc_id"] or 0, len(r["pii"]), r["row"]) for r in out.collect() if r["row"]) == [(1, 1, "r")] * 2
    assert pii.find_pii(spark.createDataFrame([], schema)).count() == 0
    masked = pii.mask(docs).collect()
    assert pii.mask(docs).columns == docs.columns
    assert sorted(str(r["text"]) for r in masked) == ["None", "[email]", "[email]"]
    assert [r["pii"] for r in masked if r["row"]] == [5, 5]


def test_mask_replaces_every_span(spark):
    docs = spark.createDataFrame([(1, "write me@b.c, 10.0.0.1 or +1 (017) 555-7713."), (2, "nothing")], "doc_id long, text string")
    assert [r["text"] for r in sorted(pii.mask(docs).collect())] == ["write [email], [ip] or [phone].", "nothing"]
