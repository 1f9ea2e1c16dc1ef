import re

from tamarack.llm import licenses

from .conftest import SF

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    starts, labels = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)))


def test_query_equals_brute_force(spark, documents):
    got = {r["doc_id"]: r for r in licenses.op7_license_scan(spark, SF).collect()}
    for d, t in zip(documents.doc_id, documents.text):
        r = got[d]
        assert tuple(r)[1:6] == plain(t)
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    assert len(got) == len(documents) and any(r["n_base"] for r in got.values())


def labels(text):
    return licenses.scan(text.encode())[5]


def test_rules():
    assert len(licenses.rules()) > 300
    assert labels("Licensed under the GNU Lesser General Public License, version 2.1") == "lgpl-2.1"
    assert labels("SPDX-License-Identifier: BSD-3-Clause") == "bsd-3-clause"
    assert labels("released under the GPL license version 2") == "gpl-2"
    assert labels("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction") == "mit"
    assert labels("see https://www.apache.org/licenses/LICENSE-2.0 for it") == "apache-2"
    assert labels("CC BY-NC-SA 4.0 license") == "cc-by-nc,cc-by-nc-sa"  # the base phrase stays
    assert labels("komm mit mir, die Lizenz ist gut; mit license-free") == "mit"
    assert labels("nothing to see here") == ""
    assert licenses.scan(b"cc by nc cc by nc cc by nc")[:4] == (9, 3, 0, 6)


def test_prefilter_loses_no_rule():
    assert labels("This program is distributed under the GPL v2") == "gpl-2"
    assert labels("released under MPL 2.0") == "mpl-2"
    assert labels("available under CC BY-SA 4.0") == "cc-by-sa"
    name = {r.label: re.sub(r"\(\?:[^()]*\)\??| \?|\[.*", "", licenses.NAMES[r.label][0].rpartition(" @ ")[2]) for r in licenses.rules() if r.label in licenses.NAMES}
    texts = [f" it is {verb} under the {n} and more " for n in name.values() for verb in ("released", "shared", "licensed")]
    for words in [*texts, " nothing ", " put into the public domain "]:
        every = [(m.start(), m.end(), r) for r in licenses.rules() for m in r.pattern.finditer(words)]
        kept = licenses.detect(words)
        assert all(any(a <= x and y <= b for a, b, _ in kept) for x, y, _ in every), words
        assert set(kept) <= set(every)


def test_inner_matches_are_suppressed():
    kept = licenses.detect(" licensed under the mozilla public license version 2 0 ")
    assert [r.label for _, _, r in kept] == ["mpl-2"]


def test_edge_cases(edge, none):
    rows = {r["id"]: r for r in licenses.scan_licenses(edge).collect()}
    assert tuple(rows[2])[1:] == (0, 0, None, None, "", "", 0.0) and rows[7]["n_words"] == 60_000
    assert licenses.scan_licenses(edge).count() == edge.count() and not licenses.scan_licenses(none).count()


def test_suppression_equals_all_against_all_and_stays_fast():
    import random
    import time

    rng = random.Random(6)
    parts = ["licensed under the mit license", "mit license", "the gnu general public license version 3", "apache license version 2 0", "bsd 3 clause license", "some words", "under the terms of the gnu lesser general public license as published by the free software foundation version 3", "cc by nc sa 4 0"]
    for _ in range(30):
        words = f" {' '.join(rng.choices(parts, k=rng.randrange(1, 40)))} "
        every = [(m.start(), m.end(), r) for r in licenses.rules() if not r.licen or "licen" in words for m in r.pattern.finditer(words)]
        kept = []
        for a, b, r in sorted(every, key=lambda x: (-x[2].priority, x[0] - x[1], x[0], x[2].label)):
            if not any(x <= a and b <= y for x, y, _ in kept):
                kept.append((a, b, r))
        assert [(a, b, r.label) for a, b, r in licenses.detect(words)] == [(a, b, r.label) for a, b, r in kept]
    began = time.time()
    licenses.scan(b"Licensed under the MIT license. Some words here. " * 20_000)
    assert time.time() - began < 10  # in proportion: all against all takes minutes
