"""License scans by conditional compression.

A text is read as its words, so line breaks and runs of white space don't matter.  Around
every ``TRIGGERS`` place candidate blocks are cut, sized to each template: for a short one
the words that would be the notice if the trigger were one of its own, for a long one as many words to both
sides as the template and its differences take.  Every block is compressed on its own and
with its template as zstandard raw dictionary; what that takes off, as a share of what the
template saves on itself, ranks the templates of a place.  All that reach ``FLOOR`` are
confirmed by their wording, the best first: a short notice must agree word for word; for a long one the words of
template and block are aligned, and words left out, changed or put in between are counted,
up to ``TOLERANCE`` of its words.  The floor lies between what blocks without a notice save
by chance and what the most different notices still save, so it loses none: tests
compare with confirming every template everywhere.  Findings inside the span of a longer one are dropped.

A notice is found by a trigger in it or near it; every template holds one.  ``n_blocks``
counts the candidate blocks, one for each trigger.

Documents stay in their tasks: one pass, one row per document, no shuffle.

Defined results: null and empty texts have no candidates; a notice that repeats is found
each time; repeated rows give equal rows; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher
from functools import cache, lru_cache
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

# Public license notices, by SPDX identifier where there is one.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "all-rights-reserved": "All rights reserved.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"
    ),
    "BSD-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met"
    ),
    "Apache-2.0-text": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at"
    ),
    "GPL-3.0-text": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
TRIGGERS = ("licens", "licenc", "copyright", "rights reserved", "permission", "redistribut", "public domain")
#: Licenses that don't allow free commercial use without further terms.
RESTRICTED = ("CC-BY-NC-4.0", "all-rights-reserved", "GPL-3.0", "GPL-3.0-text")
SHORT_WORDS, TOLERANCE = 20, 0.1
#: Share of its own saving that a template must reach on a block to be confirmed.
FLOOR = 0.3
LEVEL = 3

WORD = re.compile(r"[^\W_]+")
TRIGGER = re.compile("|".join(TRIGGERS))
#: Without one of these no text has a trigger, however its words are set apart.
FIRST_WORDS = tuple(t.split()[0] for t in TRIGGERS)
FINDING = "struct<license:string,start:int,end:int,saved:double,differences:int>"


@dataclass(frozen=True)
class Template:
    name: str
    words: tuple[str, ...]
    short: bool
    #: Places of triggers among the words, words that may differ.
    places: tuple[int, ...]
    allowed: int
    compressor: zstandard.ZstdCompressor
    #: Bytes that the template takes off itself.
    itself: int

    def blocks(self, at: int, n_words: int) -> list[tuple[int, int]]:
        """Where the candidate blocks of a trigger begin and end."""
        if not self.short:
            reach = len(self.words) + self.allowed
            return [(max(at - reach, 0), min(at + reach, n_words))]
        firsts = (at - place for place in self.places)
        return [(first, first + len(self.words)) for first in firsts if 0 <= first <= n_words - len(self.words)]


@cache
def plain() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL)


@cache
def templates() -> tuple[Template, ...]:
    out = []
    for name, text in TEMPLATES.items():
        words = tuple(m.group().lower() for m in WORD.finditer(text))
        data = common.utf8(" ".join(words))
        raw = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        own, short = zstandard.ZstdCompressor(level=LEVEL, dict_data=raw), len(words) <= SHORT_WORDS
        itself = max(len(plain().compress(data)) - len(own.compress(data)), 1)
        out.append(Template(name, words, short, tuple(trigger_words(words)), 0 if short else int(len(words) * TOLERANCE), own, itself))
    return tuple(out)


@lru_cache(maxsize=20_000)
def share_saved(template: Template, block: str) -> float:
    """Bytes that the template takes off a block, as a share of what it saves on itself."""
    data = common.utf8(block)
    return (len(plain().compress(data)) - len(template.compressor.compress(data))) / template.itself


def trigger_words(words) -> list[int]:
    """The places of words at which a trigger begins."""
    starts = list(accumulate((len(w) + 1 for w in words), initial=0))
    return sorted({bisect_right(starts, m.start()) - 1 for m in TRIGGER.finditer(" ".join(words))})


def ranked(words: list[str], at: int) -> list[tuple[float, Template, int, int]]:
    """(share saved, template, begin, end) of a trigger's blocks that may be a notice, best
    first."""
    blocks = ((t, *block) for t in templates() for block in t.blocks(at, len(words)))
    scored = [(share_saved(t, " ".join(words[i:j])), t, i, j) for t, i, j in blocks]
    return sorted((c for c in scored if c[0] >= FLOOR), key=lambda c: (-c[0], c[1].name, c[2]))


def confirmed(template: Template, words: list[str], begin: int, end: int) -> Iterator[tuple[int, int, int]]:
    """(differences, first word, word after the last) of the notices in a block."""
    if template.short:
        if tuple(words[begin:end]) == template.words:
            yield 0, begin, end
    else:
        for first, last, differ in aligned(template.words, words, template.allowed, begin, end):
            yield differ, first, last


def aligned(wanted: tuple, words: list, allowed: int, low: int, high: int) -> Iterator[tuple[int, int, int]]:
    """(first word, word after the last, differences) of a long wording in words[low:high]."""
    if high - low < len(wanted) - allowed:
        return
    same = [m for m in SequenceMatcher(None, wanted, words[low:high], False).get_matching_blocks() if m.size]
    best = None
    for i, first in enumerate(same):
        # stray words before or after the notice can match too: any row of blocks may be it
        agree = 0
        for last in same[i:]:
            agree += last.size
            inside = last.b + last.size - first.b
            option = max(len(wanted), inside) - agree, -agree, inside, first.b
            best = min(best or option, option)
    if best and best[0] <= allowed:
        start, end = low + best[3], low + best[3] + best[2]
        yield start, end, best[0]
        yield from aligned(wanted, words, allowed, low, start)
        yield from aligned(wanted, words, allowed, end, high)


def scan(text: str | None) -> tuple[int, list[dict]]:
    """Number of candidate blocks, and the confirmed findings in order."""
    text = text or ""
    low = text.lower()
    if not any(w in low for w in FIRST_WORDS):
        return 0, []
    spans = [(m.start(), m.end()) for m in WORD.finditer(text)]
    words = [text[a:b].lower() for a, b in spans]
    triggers = trigger_words(words)
    found: dict[Template, set] = {}
    for at in triggers:
        for _, template, begin, end in ranked(words, at):
            found.setdefault(template, set()).update(confirmed(template, words, begin, end))
    single = []
    for template, places in found.items():
        # blocks overlap: of readings of the same words the one with the fewest differences
        own: list[tuple] = []
        for differ, first, last in sorted(places, key=lambda x: (x[0], x[1] - x[2], x[1])):
            if all(last <= f or first >= e for _, f, e in own):
                own.append((differ, first, last))
        for differ, first, last in own:
            saved = share_saved(template, " ".join(words[first:last]))
            single.append((spans[first][0], spans[last - 1][1], template.name, differ, saved))
    kept: list[dict] = []
    for a, b, name, differ, saved in sorted(single, key=lambda x: (x[0] - x[1], x)):
        if not any(k["start"] <= a and b <= k["end"] for k in kept):
            kept.append({"license": name, "start": a, "end": b, "saved": saved, "differences": differ})
    return len(triggers), sorted(kept, key=lambda k: (k["start"], k["license"]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(
        pa.struct([("license", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("saved", pa.float64()), ("differences", pa.int32())])
    )
    for batch in batches:
        results = [scan(t.as_py()) for t in batch.column("text")]
        arrays = [batch.column("doc_id"), pa.array([n for n, _ in results], pa.int32()), pa.array([f for _, f in results], kind)]
        yield pa.record_batch(arrays, names=["doc_id", "n_blocks", "findings"])


def find_licenses(docs: DataFrame) -> DataFrame:
    """(doc_id, n_blocks, findings) of every document; offsets are in characters."""
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, n_blocks int, findings array<{FINDING}>"
    return common.map_batches(docs.select("doc_id", "text"), _scan, schema)


def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = find_licenses(common.table(spark, folder, "documents"))
    names = F.array_sort(F.array_distinct(F.transform("findings", lambda f: f.license)))
    restricted = F.arrays_overlap(names, F.array(*(F.lit(n) for n in RESTRICTED)))
    return found.select(
        "doc_id",
        "n_blocks",
        F.size("findings").alias("n_findings"),
        F.array_join(names, ",").alias("licenses"),
        restricted.alias("restricted"),
        F.round(F.array_max(F.transform("findings", lambda f: f.saved)), 3).alias("saved"),
    )
