"""License detection by ordered signature rules.

Text is reduced to lower-case words. An automaton over the rules' keywords runs first: only rules whose keyword stands in
the text run their regex. Matches of all rules are ordered by priority (exact tags, then texts, notices, names), then by
length and place; a match that lies inside the interval of one kept before it is suppressed, so that "gnu lesser general
public license" isn't also reported as the general one, and a name inside a notice isn't reported twice.

The rules are written by hand: signatures of license texts and notices below, and for each name in NAMES the forms in
which licenses are referred to.

Defined results: a null or empty text has no words, no labels and score 0; long texts are scanned whole; repeated rows
each return a row; an empty table returns no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: The phrases that always count, whatever stands around them.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

TAG, TEXT, NOTICE, NAME = 4, 3, 2, 1
CONFIDENCE = {TAG: 1.0, TEXT: 0.95, NOTICE: 0.9, NAME: 0.6}


class Rule(NamedTuple):
    label: str
    priority: int
    keyword: str
    pattern: re.Pattern
    licen: bool = False  # whether no match is without "licen"


#: label: names as regexes over lower-case words; the first word of each is its keyword unless "keyword @ regex" is given.
NAMES = {
    "mit": ["mit"],
    "mit-0": ["mit 0", "mit no attribution"],
    "apache-1": ["apache(?: software)?(?: license)?(?: version)? 1(?: [01])?"],
    "apache-2": ["apache(?: software)?(?: license)?(?: version)? 2(?: 0)?", "asl 2(?: 0)?"],
    "bsd-1-clause": ["bsd 1 clause"],
    "bsd-2-clause": ["bsd 2 clause", "bsd @ simplified bsd", "bsd @ freebsd"],
    "bsd-3-clause": ["bsd 3 clause", "bsd @ new bsd", "bsd @ modified bsd", "bsd @ revised bsd"],
    "bsd-4-clause": ["bsd 4 clause", "bsd @ original bsd", "bsd @ old bsd"],
    "bsd-0-clause": ["0bsd", "bsd zero clause"],
    "isc": ["isc"],
    "zlib": ["zlib(?: libpng)?"],
    "libpng": ["libpng"],
    "bsl-1": ["boost(?: software)?(?: license)?(?: version)? 1(?: 0)?", "bsl 1 0"],
    "unlicense": ["unlicense"],
    "wtfpl": ["wtfpl", "do what the fuck you want to(?: public license)?"],
    "gpl-1": ["gpl(?: licen[cs]e)?(?: version)?(?: v)? ?1(?: 0)?", "gnu (?:general public license|gpl)(?: version)?(?: v)? ?1(?: 0)?"],
    "gpl-2": ["gpl(?: licen[cs]e)?(?: version)?(?: v)? ?2(?: 0)?", "gplv2", "gnu (?:general public license|gpl)(?: version)?(?: v)? ?2(?: 0)?"],
    "gpl-3": ["gpl(?: licen[cs]e)?(?: version)?(?: v)? ?3(?: 0)?", "gplv3", "gnu (?:general public license|gpl)(?: version)?(?: v)? ?3(?: 0)?"],
    "gpl": ["gnu general public", "gpl"],
    "lgpl-2": ["lgpl(?: licen[cs]e)?(?: version)?(?: v)? ?2(?: 0)?", "gnu library general public license(?: version)?(?: v)? ?2(?: 0)?"],
    "lgpl-2.1": ["lgpl(?: licen[cs]e)?(?: version)?(?: v)? ?2 1", "lgplv2 1", "gnu lesser general public license(?: version)?(?: v)? ?2 1"],
    "lgpl-3": ["lgpl(?: licen[cs]e)?(?: version)?(?: v)? ?3(?: 0)?", "lgplv3", "gnu lesser general public license(?: version)?(?: v)? ?3(?: 0)?"],
    "lgpl": ["gnu lesser general public", "gnu library general public", "lgpl"],
    "agpl-3": ["agpl(?: licen[cs]e)?(?: version)?(?: v)? ?3(?: 0)?", "agplv3", "gnu affero general public license(?: version)?(?: v)? ?3(?: 0)?"],
    "agpl": ["gnu affero general public", "affero general public", "agpl"],
    "gfdl": ["gnu free documentation", "gfdl"],
    "mpl-1.1": ["mpl(?: version)? 1 1", "mozilla public license(?: version)? 1 1"],
    "mpl-2": ["mpl(?: version)? 2(?: 0)?", "mozilla public license(?: version)? 2(?: 0)?"],
    "mpl": ["mozilla public"],
    "epl-1": ["epl 1 0", "eclipse public license(?: version)?(?: v)? ?1(?: 0)?"],
    "epl-2": ["epl 2 0", "eclipse public license(?: version)?(?: v)? ?2(?: 0)?"],
    "epl": ["eclipse public"],
    "edl-1": ["eclipse distribution license(?: version)?(?: v)? ?1(?: 0)?"],
    "cddl-1": ["cddl(?: version)? 1 0", "common development and distribution license(?: version)? 1(?: 0)?"],
    "cddl-1.1": ["cddl(?: version)? 1 1"],
    "cpl-1": ["cpl 1 0", "common public license(?: version)? 1(?: 0)?"],
    "ipl-1": ["ibm public license(?: version)? 1(?: 0)?"],
    "eupl-1.1": ["eupl(?: v)? ?1 1"],
    "eupl-1.2": ["eupl(?: v)? ?1 2", "european union public licen[cs]e(?: v)? ?1 2"],
    "eupl": ["european union public"],
    "osl-3": ["osl 3 0", "open software license(?: version)? 3(?: 0)?"],
    "afl-3": ["afl 3 0", "academic free license(?: version)? 3(?: 0)?"],
    "artistic-1": ["artistic(?: license)? 1(?: 0)?"],
    "artistic-2": ["artistic(?: license)?(?: version)? 2(?: 0)?"],
    "psf-2": ["psf(?: license)?(?: version)? 2", "python software foundation"],
    "php-3": ["php license(?: version)? 3(?: 0)?"],
    "ruby": ["ruby license"],
    "openssl": ["openssl"],
    "ms-pl": ["ms pl", "microsoft public"],
    "ms-rl": ["ms rl", "microsoft reciprocal"],
    "ncsa": ["ncsa", "university of illinois ncsa open source"],
    "postgresql": ["postgresql license"],
    "upl-1": ["upl 1 0", "universal permissive license(?: version)?(?: v)? ?1(?: 0)?"],
    "vim": ["vim license"],
    "w3c": ["w3c software(?: notice and)? license"],
    "x11": ["x11 license"],
    "curl": ["curl license"],
    "sleepycat": ["sleepycat"],
    "ofl-1.1": ["ofl 1 1", "sil open font license(?: version)? 1 1"],
    "ofl": ["sil open font", "open font license"],
    "cc0": ["cc0(?: 1 0)?", "creative commons zero(?: v)? ?(?:1 0)?"],
    "cc-by": ["cc by(?: [1-4] 0)?", "creative commons attribution(?: [1-4] 0)?"],
    "cc-by-sa": ["cc by sa(?: [1-4] 0)?", "creative commons attribution share ?alike(?: [1-4] 0)?"],
    "cc-by-nd": ["cc by nd(?: [1-4] 0)?", "creative commons attribution no ?deriv(?:ative|ativeworks|s|atives)?(?: [1-4] 0)?"],
    "cc-by-nc": ["cc by nc(?: [1-4] 0)?", "creative commons attribution non ?commercial(?: [1-4] 0)?"],
    "cc-by-nc-sa": ["cc by nc sa(?: [1-4] 0)?", "creative commons attribution non ?commercial share ?alike(?: [1-4] 0)?"],
    "cc-by-nc-nd": ["cc by nc nd(?: [1-4] 0)?", "creative commons attribution non ?commercial no ?deriv(?:s|atives|ativeworks)?(?: [1-4] 0)?"],
    "odbl": ["odbl(?: 1 0)?", "open database license"],
    "odc-by": ["odc by(?: 1 0)?", "open data commons attribution"],
    "pddl": ["pddl(?: 1 0)?", "public domain dedication and license"],
    "busl-1.1": ["busl 1 1", "business source license(?: 1 1)?"],
    "sspl-1": ["sspl(?: v)? ?1", "server side public license"],
    "elastic-2": ["elastic license(?: 2 0)?"],
    "blueoak-1": ["blue oak model license(?: 1 0 0)?", "blueoak 1 0 0"],
    "mulan-psl-2": ["mulan psl(?: v)? ?2", "mulan permissive software license"],
    "llama": ["llama(?: [234])? community"],
    "openrail": ["openrail(?: m)?", "responsible ai license"],
}

#: The only form of a name in which the word license may be missing.
BY_VERB = "(?:released|distributed|available|published|provided|covered|shared|dual licensed) under (?:the )?(?:terms of )?(?:the )?{0}(?: licen[cs]e)?"

#: The forms in which a name stands, {0} being the name. A bare name needs "license" or "licence" next to it.
FORMS = [
    (TAG, "spdx license identifier {0}(?: only| or later)?"),
    (TAG, "license {0}(?: only| or later)?(?= (?:author|version|url|homepage|classifier))"),
    (NOTICE, "(?:re)?licen[cs]ed under (?:the )?(?:terms of )?(?:the )?{0}(?: licen[cs]e)?"),
    (NOTICE, BY_VERB),
    (NOTICE, "(?:subject to|governed by|under the terms of|according to|in accordance with|see) the {0} licen[cs]e"),
    (NOTICE, "under (?:the |an |a )?{0} licen[cs]e"),
    (NAME, "(?:the )?{0} licen[cs]e(?: version)?(?: [0-9](?: [0-9])?)?"),
    (NAME, "licen[cs]es? {0}"),
]

#: label, keyword, regex: sentences of the texts themselves, and addresses.
SIGNATURES = [
    ("mit", "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("mit", "the above copyright notice and this permission notice", "the above copyright notice and this permission notice(?: including the next paragraph)? shall be included in all copies or substantial portions of the software"),
    ("mit", "opensource org", "opensource org licenses mit"),
    ("isc", "permission to use copy modify", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice"),
    ("bsd-0-clause", "permission to use copy modify", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted(?! provided)"),
    ("apache-2", "apache org licenses", "(?:www )?apache org licenses license 2 0"),
    ("apache-2", "you may not use this file except", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache-2", "terms and conditions for use reproduction", "terms and conditions for use reproduction and distribution 1 definitions"),
    ("bsd-3-clause", "neither the name", "neither the name of .{1,80}? nor the names of its contributors may be used to endorse or promote products"),
    ("bsd-2-clause", "redistribution and use in source", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-4-clause", "all advertising materials", "all advertising materials mentioning features or use of this software must display"),
    ("gpl-2", "under the terms of the gnu", "under the terms of the gnu general public license as published by the free software foundation (?:either )?version 2"),
    ("gpl-3", "under the terms of the gnu", "under the terms of the gnu general public license as published by the free software foundation (?:either )?version 3"),
    ("lgpl-2.1", "under the terms of the gnu", "under the terms of the gnu lesser general public license as published by the free software foundation (?:either )?version 2 1"),
    ("lgpl-3", "under the terms of the gnu", "under the terms of the gnu lesser general public license as published by the free software foundation (?:either )?version 3"),
    ("agpl-3", "under the terms of the gnu", "under the terms of the gnu affero general public license as published by the free software foundation (?:either )?version 3"),
    ("gpl", "www gnu org licenses", "www gnu org licenses gpl"),
    ("lgpl", "www gnu org licenses", "www gnu org licenses lgpl"),
    ("agpl", "www gnu org licenses", "www gnu org licenses agpl"),
    ("gfdl", "www gnu org licenses", "www gnu org licenses fdl"),
    ("mpl-2", "this source code form is subject", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-2", "mozilla org mpl", "mozilla org mpl 2 0"),
    ("mpl-1.1", "mozilla org mpl", "mozilla org mpl(?: mpl 1 1)"),
    ("epl-2", "www eclipse org legal", "www eclipse org legal epl(?: v)? ?2"),
    ("epl-1", "www eclipse org legal", "www eclipse org legal epl v10"),
    ("zlib", "this software is provided as is without", "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("bsl-1", "permission is hereby granted", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("bsl-1", "boost org license", "boost org license 1 0"),
    ("unlicense", "this is free and unencumbered", "this is free and unencumbered software released into the public domain"),
    ("wtfpl", "you just do what the fuck", "you just do what the fuck you want to"),
    ("public-domain", "public domain", "(?:released|placed|dedicated|given|put) (?:in|into|to) the public domain"),
    ("public-domain", "public domain", "this work is (?:hereby )?(?:in the )?public domain"),
    ("cc0", "creativecommons org", "creativecommons org publicdomain zero 1 0"),
    ("cc-by", "creativecommons org", "creativecommons org licenses by [1-4]"),
    ("cc-by-sa", "creativecommons org", "creativecommons org licenses by sa"),
    ("cc-by-nd", "creativecommons org", "creativecommons org licenses by nd"),
    ("cc-by-nc", "creativecommons org", "creativecommons org licenses by nc [1-4]"),
    ("cc-by-nc-sa", "creativecommons org", "creativecommons org licenses by nc sa"),
    ("cc-by-nc-nd", "creativecommons org", "creativecommons org licenses by nc nd"),
    ("ofl-1.1", "scripts sil org ofl", "scripts sil org ofl"),
    ("proprietary", "all rights reserved", "(?:copyright|c|©) (?:[0-9]{4} )*.{0,80}?all rights reserved"),
    ("proprietary", "proprietary", "proprietary and confidential"),
    ("proprietary", "without the prior written", "without the prior written (?:permission|consent) of"),
    ("commercial", "commercial license", "(?:under|requires|need|buy|purchase) a commercial license"),
]


@cache
def rules() -> tuple[Rule, ...]:
    """All rules, the base phrases first."""
    word = lambda pattern: re.compile(rf"(?<= )(?:{pattern})(?= )")
    found = [Rule(label, TAG, f" {phrase} ", word(phrase)) for phrase, label in BASE.items()]
    found += [Rule(label, TEXT, f" {keyword}", word(pattern)) for label, keyword, pattern in SIGNATURES]
    for label, names in NAMES.items():
        for name in names:
            keyword, _, pattern = name.rpartition(" @ ")
            keyword = keyword or re.match(r"[a-z0-9]+(?: [a-z0-9]+)*", name.replace("(?:", "|").split("|")[0].split("[")[0].strip())[0]
            for priority, form in FORMS:
                found.append(Rule(label, priority, f" {keyword}", word(form.format(f"(?:{pattern})")), form != BY_VERB))
    return tuple(found)


@cache
def _automaton() -> ahocorasick.Automaton:
    at: dict[str, list[int]] = {}
    for i, r in enumerate(rules()):
        at.setdefault(r.keyword, []).append(i)
    a = ahocorasick.Automaton()
    for k, numbers in at.items():
        a.add_word(k, tuple(numbers))
    a.make_automaton()
    return a


_FOLD = bytes(32 if b < 0x30 or 0x3A <= b < 0x41 or 0x5B <= b < 0x61 or 0x7B <= b < 0x80 else b + 32 if 0x41 <= b < 0x5B else b for b in range(256))


def detect(words: str) -> list[tuple[int, int, Rule]]:
    """Kept matches as (first character, end, rule) of a text of words with a space on either side of each."""
    found = []
    seen: set[int] = set()
    for _, numbers in _automaton().iter(words):
        seen.update(numbers)
    licen = "licen" in words
    for i in sorted(seen):
        r = rules()[i]
        if r.licen and not licen:
            continue
        found += [(m.start(), m.end(), r) for m in r.pattern.finditer(words)]
    found.sort(key=lambda x: (-x[2].priority, x[0] - x[1], x[0], x[2].label))
    kept: list[tuple[int, int, Rule]] = []
    # intervals of equal priority order by length, so one inside another always comes later. One lies inside a kept one if the
    # furthest end of those kept that begin no later reaches its own: a tree of prefix maxima over the beginnings
    rank = {x: k for k, x in enumerate(sorted({x for x, _, _ in found}), 1)}
    furthest = [0] * (len(rank) + 1)
    for a, b, r in found:
        k = at = rank[a]
        end = 0
        while k:
            end = max(end, furthest[k])
            k &= k - 1
        if end < b:
            kept.append((a, b, r))
            while at < len(furthest):
                furthest[at] = max(furthest[at], b)
                at += at & -at
    return kept


def places(words: str, phrase: str) -> list[int]:
    """First characters of every place of a phrase, overlapping ones too."""
    out, at = [], words.find(f" {phrase} ")
    while at >= 0:
        out.append(at)
        at = words.find(f" {phrase} ", at + 1)
    return out


def scan(text: bytes | None) -> tuple[int, int, int | None, int | None, str, str, float]:
    """n_words, n_base, first_word, last_word, base_labels, labels, score of a text in UTF-8."""
    split = (text or b"").translate(_FOLD).split()
    words = (b" " + b" ".join(split) + b" ").decode("latin-1")  # a byte is a character: only ASCII is looked for
    at = {p: places(words, p) for p in BASE}
    starts = sorted(x for v in at.values() for x in v)
    base = {BASE[p] for p, v in at.items() if v}
    kept = detect(words)
    labels = base | {r.label for _, _, r in kept}
    score = max([CONFIDENCE[TAG] if base else 0.0, *(CONFIDENCE[r.priority] for _, _, r in kept)])
    word = lambda c: words.count(" ", 0, c + 1) - 1
    ends = (word(starts[0]), word(starts[-1])) if starts else (None, None)
    return (len(split), len(starts), *ends, ",".join(sorted(base)), ",".join(sorted(labels)), score)


RESULT = "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double"


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and the RESULT columns for each row."""
    names = ["id", *(x.split()[0] for x in RESULT.split(", "))]
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = list(zip(*(scan(t.as_py()) for t in b.column(1)), strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(rows, kinds, strict=True))], names)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(run, f"id {kind}, {RESULT}")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
