"""License scans: ordered signature rules behind a keyword filter, overlaps resolved by priority."""

from __future__ import annotations

import re
from bisect import bisect_right
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealtide.llm.tables import prepare_python


@dataclass(frozen=True)
class Rule:
    """``pattern`` matches whole words of a text in lower case, words joined by one space.

    It is only tried in texts that hold ``keyword``. Of two detections of which one contains the
    other, the one with the higher priority stays.
    """

    name: str
    label: str
    keyword: str
    pattern: str
    priority: int
    confidence: float


# Phrases and labels of the base rules. All their places are reported.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Identifier, a literal part of the name, and the name as a pattern.
NAMES = (
    ("0bsd", "zero clause", r"(?:bsd )?zero clause(?: bsd)?"),
    ("afl-3.0", "academic free", r"academic free(?: license)?(?: v?(?:ersion )?3(?: 0)?)?"),
    ("agpl-3.0", "affero", r"(?:gnu )?affero(?: general public)?(?: license)?(?: v?(?:ersion )?3(?: 0)?)?"),
    ("apache-1.1", "apache", r"apache(?: software)?(?: license)? v?(?:ersion )?1 1"),
    ("apache-2.0", "apache", r"apache(?: software)?(?: license)?(?: v?(?:ersion )?2(?: 0)?)?"),
    ("artistic-2.0", "artistic", r"artistic(?: license)?(?: v?(?:ersion )?2(?: 0)?)?"),
    ("bsd-2-clause", "bsd", r"(?:bsd 2 clause|(?:2 clause|two clause|simplified|freebsd) bsd)"),
    ("bsd-3-clause", "bsd", r"(?:bsd 3 clause|(?:3 clause|three clause|new|modified|revised) bsd)"),
    ("bsd-4-clause", "bsd", r"(?:bsd 4 clause|(?:4 clause|four clause|original) bsd)"),
    ("bsl-1.0", "boost", r"boost(?: software)?(?: license)?(?: v?(?:ersion )?1(?: 0)?)?"),
    ("cc-by-4.0", "cc by", r"cc by(?: v?(?:ersion )?[1-4](?: \d)?)?"),
    ("cc-by-nc-4.0", "cc by nc", r"cc by nc(?: v?(?:ersion )?[1-4](?: \d)?)?"),
    ("cc-by-nc-nd-4.0", "cc by nc nd", r"cc by nc nd(?: v?(?:ersion )?[1-4](?: \d)?)?"),
    ("cc-by-nc-sa-4.0", "cc by nc sa", r"cc by nc sa(?: v?(?:ersion )?[1-4](?: \d)?)?"),
    ("cc-by-nd-4.0", "cc by nd", r"cc by nd(?: v?(?:ersion )?[1-4](?: \d)?)?"),
    ("cc-by-sa-4.0", "cc by sa", r"cc by sa(?: v?(?:ersion )?[1-4](?: \d)?)?"),
    ("cc-by", "creative commons", r"creative commons attribution(?: \d \d)?(?: international| unported)?"),
    ("cc-by-nc", "creative commons", r"creative commons attribution non ?commercial(?: \d \d)?"),
    ("cc-by-sa", "creative commons", r"creative commons attribution share ?alike(?: \d \d)?"),
    ("cc0-1.0", "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("cddl-1.0", "common development", r"common development and distribution(?: license)?(?: 1 [01])?"),
    ("cpl-1.0", "common public", r"common public(?: license)?(?: v?(?:ersion )?1 0)?"),
    ("ecl-2.0", "educational community", r"educational community(?: license)?(?: v?(?:ersion )?2 0)?"),
    ("epl-1.0", "eclipse", r"eclipse public(?: license)? v?(?:ersion )?1(?: 0)?"),
    ("epl-2.0", "eclipse", r"eclipse public(?: license)?(?: v?(?:ersion )?2(?: 0)?)?"),
    ("eupl-1.2", "european union", r"european union public(?: licence| license)?(?: v?(?:ersion )?1 [12])?"),
    ("gfdl-1.3", "free documentation", r"(?:gnu )?free documentation(?: license)?(?: v?(?:ersion )?1 [123])?"),
    ("gpl-1.0", "general public", r"(?:gnu )?general public(?: license)? v?(?:ersion )?1(?: 0)?"),
    ("gpl-2.0", "general public", r"(?:gnu )?general public(?: license)? v?(?:ersion )?2(?: 0)?"),
    ("gpl-3.0", "general public", r"(?:gnu )?general public(?: license)? v?(?:ersion )?3(?: 0)?"),
    ("gpl", "general public", r"(?:gnu )?general public(?: license)?"),
    ("gpl", "gpl", r"(?:gnu )?gpl(?: ?v?[123])?(?: 0)?(?: or later| only)?"),
    ("isc", "isc", r"isc"),
    ("lgpl-2.1", "lesser general", r"(?:gnu )?lesser general public(?: license)? v?(?:ersion )?2 1"),
    ("lgpl-3.0", "lesser general", r"(?:gnu )?lesser general public(?: license)? v?(?:ersion )?3(?: 0)?"),
    ("lgpl", "lesser general", r"(?:gnu )?lesser general public(?: license)?"),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl(?: ?v?[23])?(?: [01])?"),
    ("lppl-1.3c", "latex project", r"latex project public(?: license)?(?: 1 3c?)?"),
    ("mit", "mit", r"(?:mit|expat)"),
    ("mit-0", "mit no attribution", r"mit no attribution"),
    ("mpl-1.1", "mozilla", r"mozilla public(?: license)? v?(?:ersion )?1 1"),
    ("mpl-2.0", "mozilla", r"mozilla public(?: license)?(?: v?(?:ersion )?2(?: 0)?)?"),
    ("ms-pl", "microsoft public", r"microsoft public"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)?"),
    ("odbl-1.0", "open database", r"open database"),
    ("ofl-1.1", "open font", r"(?:sil )?open font(?: license)?(?: v?(?:ersion )?1 1)?"),
    ("osl-3.0", "open software", r"open software(?: license)?(?: v?(?:ersion )?3 0)?"),
    ("postgresql", "postgresql", r"postgresql"),
    ("psf-2.0", "python software", r"python software foundation"),
    ("unlicense", "unlicense", r"unlicense"),
    ("wtfpl", "do what the", r"do what the \w+ you want to public"),
    ("zlib", "zlib", r"zlib(?: libpng)?"),
)

# Ways to say that something is under a license; {} stands for its name. Name,
# keyword, pattern, priority, confidence.
WAYS = (
    ("identifier", "license identifier", r"(?:spdx )?license identifier {}(?: license| licence)?", 90, 0.99),
    ("grant", "licensed under", r"(?:is |are )?(?:dual )?licensed under (?:the )?(?:terms of (?:the )?)?(?:an? )?{}(?: licen[cs]e)?", 80, 0.95),
    ("release", " under ", r"(?:released|distributed|published|available|provided|offered|shared|covered) under (?:the )?(?:terms of (?:the )?)?(?:an? )?{}(?: licen[cs]e)?", 80, 0.95),
    ("notice", "licen", r"under (?:the )?(?:terms of (?:the )?)?{} licen[cs]e", 70, 0.9),
    ("terms", "licen", r"under (?:the )?(?:terms of (?:the )?)?{}", 72, 0.9),
    ("mention", "licen", r"(?:the )?{} licen[cs]e", 50, 0.6),
    ("label", "license", r"license {}", 40, 0.5),
)

# Sentences of license texts and notices. Label, pattern, priority, confidence; the
# keyword is the pattern's start up to its first operator.
SENTENCES = (
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy", 100, 0.99),
    ("mit", r"the above copyright notice and this permission notice shall be included in all copies", 95, 0.95),
    ("isc", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee", 100, 0.98),
    ("bsd", r"redistribution and use in source and binary forms with or without modification are permitted", 100, 0.97),
    ("bsd-3-clause", r"neither the name of (?:\w+ ){1,12}nor the names of its contributors", 96, 0.95),
    ("bsd-4-clause", r"all advertising materials mentioning features or use of this software", 96, 0.95),
    ("apache-2.0", r"unless required by applicable law or agreed to in writing(?: software)?", 90, 0.9),
    ("apache-2.0", r"you may not use this file except in compliance with the license", 95, 0.95),
    ("gpl", r"this program is free software you can redistribute it and or modify it", 95, 0.95),
    ("gpl", r"everyone is permitted to copy and distribute verbatim copies of this license document", 95, 0.95),
    ("gpl", r"either version [123](?: of the license)? or at your option any later version", 92, 0.9),
    ("lgpl", r"this library is free software you can redistribute it and or modify it", 95, 0.95),
    ("mpl-2.0", r"this source code form is subject to the terms of the mozilla public license", 100, 0.99),
    ("epl-2.0", r"this program and the accompanying materials are made available under the terms of the eclipse", 100, 0.99),
    ("unlicense", r"this is free and unencumbered software released into the public domain", 100, 0.99),
    ("unlicense", r"anyone is free to copy modify publish use compile sell or distribute this software", 100, 0.97),
    ("zlib", r"altered source versions must be plainly marked as such", 95, 0.95),
    ("bsl-1.0", r"permission is hereby granted free of charge to any person or organization obtaining a copy", 100, 0.99),
    ("cc0-1.0", r"to the extent possible under law (?:\w+ ){1,12}waived all copyright", 95, 0.95),
    ("public-domain", r"(?:dedicated to|released into|placed in) the public domain", 85, 0.9),
    ("public-domain", r"public domain", 30, 0.4),
    ("creative-commons", r"licensed under a creative commons", 75, 0.9),
    ("no-warranty", r"without warranty of any kind(?: express or implied)?", 60, 0.5),
    ("no-warranty", r"without warranties or conditions of any kind", 60, 0.5),
    ("no-warranty", r"without even the implied warranty of merchantability", 60, 0.5),
    ("reserved", r"all rights reserved", 60, 0.8),
    ("reserved", r"some rights reserved", 60, 0.6),
    ("reserved", r"no part of this (?:publication|book|work|document) may be reproduced", 85, 0.95),
    ("reserved", r"reproduction (?:\w+ ){0,6}without (?:\w+ ){0,3}permission", 70, 0.8),
    ("proprietary", r"proprietary and confidential", 80, 0.9),
    ("proprietary", r"unauthorized copying of this file", 85, 0.95),
    ("copyright", r"copyright (?:c )?(?:19|20)\d\d", 40, 0.5),
    ("copyright", r"copyright by", 35, 0.4),
)


def _keyword(pattern: str) -> str:
    return re.split(r"[^a-z ]", pattern)[0] or re.search(r"\) ([a-z ]+)", pattern)[1]


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """All rules: sentences, and each name said in each way. In the order of their priority."""
    made = [
        Rule(f"sentence-{n}", label, _keyword(pattern), pattern, priority, confidence)
        for n, (label, pattern, priority, confidence) in enumerate(SENTENCES)
    ]
    for n, (label, part, name) in enumerate(NAMES):
        for way, keyword, pattern, priority, confidence in WAYS:
            if way == "terms" and "license" not in name:
                continue  # without the word in its name, it may be no license at all
            # The longer the name, the more it says: "cc by nc" is not "cc by".
            made.append(Rule(
                f"{way}-{n}-{label}", label, part if len(part) > 3 else keyword, pattern.format(f"(?:{name})"),
                priority, confidence,
            ))
    made += [Rule(f"bare-{n}-{label}", label, part, name, 20, 0.4)
             for n, (label, part, name) in enumerate(NAMES) if " " in part]
    return tuple(sorted(made, key=lambda r: (-r.priority, r.name)))


@lru_cache(maxsize=1)
def _compiled():
    found = ahocorasick.Automaton()
    by_keyword: dict[str, list[int]] = {}
    patterns = []
    for n, rule in enumerate(rules()):
        by_keyword.setdefault(rule.keyword, []).append(n)
        patterns.append(re.compile(b"(?<![^ ])(?:" + rule.pattern.encode() + b")(?![^ ])"))
    for keyword, numbers in by_keyword.items():
        found.add_word(keyword, tuple(numbers))
    found.make_automaton()
    base = [(re.compile(b"(?<![^ ])" + phrase.encode() + b"(?![^ ])"), phrase.encode(), label) for phrase, label in BASE]
    return found, patterns, base


# A-Z to lower case; every ASCII character that is no letter or digit to a space.
_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def suppress(detections: list[tuple[int, int, int]]) -> list[int]:
    """Indices of the (start, end, priority) that no other contains with a higher priority, or
    with the same one and a longer or earlier interval. What is suppressed suppresses nothing.

    Kept intervals of one priority contain none of each other, so in the order of their starts their ends
    rise as well: of each priority only the last one that starts no later can contain a detection.
    """
    levels: list[tuple[list[int], list[int]]] = []  # starts and ends of each level, both rising
    kept: list[int] = []
    by_priority: dict[int, list[int]] = {}
    for i, (_, _, priority) in enumerate(detections):
        by_priority.setdefault(priority, []).append(i)
    for priority in sorted(by_priority, reverse=True):
        # Within a priority a sweep by start, the longer first: what ends no later than an earlier one lies in it.
        furthest, added = -1, []
        for i in sorted(by_priority[priority], key=lambda i: (detections[i][0], -detections[i][1], i)):
            start, end, _ = detections[i]
            if end <= furthest or any(_contains(level, start, end) for level in levels):
                continue
            furthest = end
            added.append(i)
        if added:
            levels.append(([detections[i][0] for i in added], [detections[i][1] for i in added]))
            kept += added
    return sorted(kept, key=lambda i: (detections[i][0], detections[i][1]))


def _contains(level: tuple[list[int], list[int]], start: int, end: int) -> bool:
    starts, ends = level
    at = bisect_right(starts, start) - 1
    return at >= 0 and end <= ends[at]


def scan_text(text: bytes) -> dict:
    """What one text says about licenses; places are counted in words, from 0."""
    words = text.translate(_WORDS).split()
    line = b" ".join(words)
    automaton, patterns, base_rules = _compiled()

    blanks = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)

    def place(at: int) -> int:
        return int(np.searchsorted(blanks, at))

    base = [
        {"label": label, "start": place(m.start()), "end": place(m.end()) + 1}
        for pattern, phrase, label in base_rules if phrase in line for m in pattern.finditer(line)
    ]
    tried = sorted({n for _, numbers in automaton.iter(line.decode("latin-1")) for n in numbers})
    hits = [(m.start(), m.end(), n) for n in tried for m in patterns[n].finditer(line) if m.end() > m.start()]
    all_rules = rules()
    kept = suppress([(a, b, all_rules[n].priority) for a, b, n in hits])
    found = [
        {"rule": all_rules[n].name, "label": all_rules[n].label, "start": place(a), "end": place(b) + 1,
         "confidence": all_rules[n].confidence}
        for a, b, n in (hits[i] for i in kept)
    ]
    doubt = 1.0
    for confidence in {(f["rule"], f["confidence"]) for f in found}:
        doubt *= 1.0 - confidence[1]
    return {"n_words": len(words), "base": base, "found": found, "score": round(1.0 - doubt, 6)}


_BASE = "array<struct<label:string,start:bigint,end:bigint>>"
_FOUND = "array<struct<rule:string,label:string,start:bigint,end:bigint,confidence:double>>"
_ARROW = pa.struct([
    ("n_words", pa.int64()),
    ("base", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))),
    ("found", pa.list_(pa.struct([
        ("rule", pa.string()), ("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
        ("confidence", pa.float64()),
    ]))),
    ("score", pa.float64()),
])


def scan(df: DataFrame, text: str = "text", name: str = "licenses") -> DataFrame:
    """All rows and columns, and the struct ``name``: n_words, base, found and score.

    ``base``: every place of a base phrase. ``found``: the detections of all rules that remain after
    suppression. ``score``: how sure it is that the text speaks of a license, from the confidences
    of the different rules. Whole texts are scanned. A NULL text is an empty one: no words, nothing
    found, score 0. A column of the name is replaced; an empty table gives an empty table.
    """
    prepare_python(df.sparkSession)

    @F.arrow_udf(f"n_words bigint, base {_BASE}, found {_FOUND}, score double")
    def scanned(texts: pa.Array) -> pa.Array:
        return pa.array([scan_text(t.as_py() or b"") for t in texts], _ARROW)

    given = F.encode(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), "UTF-8")
    rest = [F.col(f"`{c}`") for c in df.columns if c.lower() != name.lower()]
    return df.select(*rest, scanned(given).alias(name))
