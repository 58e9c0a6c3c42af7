import random
import re

import pytest

from eventlake.llm import licenses
from eventlake.llm.licenses import BASE, SCORES, Rule, all_rules

SCHEMA = "doc_id long, text string, norm int, label string"


def norm(text):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
    return w, " " + " ".join(w) + " " if w else " "


def brute(text, rules):
    w, n = norm(text)
    places, labels = [], set()
    for phrase, label in BASE:
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    found = [(m.start(), m.end(), r.priority, r.label) for r in rules for m in re.finditer(r.pattern, n)]
    inside = lambda a, b: b[0] <= a[0] and a[1] <= b[1]
    found = [d for d in found if not any(inside(e, d) and e[2] > d[2] for e in found)]
    keep = set()
    for d in found:
        rank = lambda e: (-e[2], e[3])
        if not any(inside(d, e) and e[2] >= d[2] and (e[:2] != d[:2] or rank(e) < rank(d)) for e in found):
            keep.add(d)
    score = max([SCORES[d[2]] for d in keep] + [0.6 if labels else 0.0])
    return len(w), len(places), min(places, default=None), max(places, default=None), sorted(labels), sorted(labels | {d[3] for d in keep}), score


def scanned(spark, rows, **options):
    got = licenses.scan(spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA), **options).collect()
    assert all(r.rest.norm == 1 and r.rest.label == "x" for r in got)
    return {r.id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) for r in got}


def test_rules_are_many_and_each_passes_its_own_gates():
    rules = all_rules()
    assert len(rules) > 200
    for r in rules:
        assert re.search(r.pattern, r.example), r
        assert any(k in r.example for k in r.keywords), r


def test_equals_definition(spark):
    rng = random.Random(1)
    rules = all_rules()
    filler = ["the", "Über", "a1", "license", "CC", "by", "cc-by", "reserved", "all rights", "version 2.0", "MIT", "©", "İ", "under the"]
    rows = []
    for i in range(120):
        t = []
        for _ in range(rng.randrange(25)):
            t.append(rng.choice(rules).example.strip().title() if rng.random() < 0.2 else rng.choice(filler))
        rows.append((i, rng.choice([" ", ", ", "\n"]).join(t)))
    got = scanned(spark, rows)
    for i, t in rows:
        assert got[i] == brute(t, rules), t


@pytest.mark.parametrize(
    "text, labels",
    [
        ("Licensed under the Apache License, Version 2.0.", ["apache-2.0"]),
        ("This work is licensed under the GNU General Public License, version 3.", ["gpl", "gpl-3.0"]),
        ("Released under the MIT License.", ["mit"]),
        ("Licensed under CC BY-NC 4.0.", ["cc-by", "cc-by-nc-4.0"]),
        ("SPDX-License-Identifier: LGPL-2.1-or-later", ["lgpl-2.1"]),
        ("Nothing to see here, a driving license.", []),
    ],
)
def test_common_notices(spark, text, labels):
    assert scanned(spark, [(1, text)])[1][5] == labels


def test_priority_and_containment(spark):
    rules = [Rule("wide", 1, (" a",), " (?:a b c d)(?= )", ""), Rule("inner", 2, (" b",), " (?:b c)(?= )", ""), Rule("part", 2, (" c",), " (?:c)(?= )", ""), Rule("twin", 2, (" b",), " (?:b c)(?= )", "")]
    got = scanned(spark, [(1, "License a b c d"), (2, "license a b x"), (3, "license c"), (4, "license a b c d a b c")], rules=rules)
    assert [got[i][5] for i in (1, 2, 3, 4)] == [["inner"], [], ["part"], ["inner"]]


def test_edge_rows(spark):
    rules = all_rules()
    rows = [(1, None), (2, ""), (3, "?!"), (4, "cc by"), (5, "CC BY cc by, cc-by"), (6, "word " * 100_000 + "all rights reserved"), (None, "mit license"), (7, "l" * 200_000), (8, "x\x00license")]
    got = scanned(spark, rows)
    for d, t in rows:
        assert got[d] == brute(t, rules)
    assert scanned(spark, []) == {}


def test_many_hits_in_one_text(spark):
    # beyond the block in which hits are added up, and beyond a block of blocks
    n = licenses.BLOCK**2 + 70
    text = "mit license, " * n + "cc by 4.0 " + "x all rights reserved " * n
    got = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert len(got.detections) == 2 * n + 1 and got.labels == ["cc-by", "cc-by-4.0", "mit", "reserved"]
    flat = " " + " ".join(re.findall("[a-z0-9]+", text)) + " "
    assert all(flat[d.start : d.end].strip() in ("mit license", "cc by 4 0", "all rights reserved") for d in got.detections)
    assert got.n_base == n + 1 and got.first_word == 2 * n


def test_only_ascii_capitals_are_lowered(spark):
    kelvin = "\u212aIT MIT LICENSE"
    assert scanned(spark, [(1, kelvin)])[1] == brute(kelvin, all_rules())
    one = Rule("k", 2, (" k ",), " k(?= )", " k ")
    assert scanned(spark, [(1, "\u212a"), (2, "K")], rules=[one])[1][5] == []


def test_bodies_are_known_without_a_name(spark):
    header = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
    with the License. Unless required by applicable law or agreed to in writing, software distributed under the License is
    distributed on an "AS IS" BASIS."""
    clauses = """1. Redistributions of source code must retain the above copyright notice. 3. Neither the name of the University
    nor the names of its contributors may be used to endorse or promote products derived from this software."""
    linking = "As a special exception, the copyright holders of this library give you permission to link it."
    got = scanned(spark, [(1, header), (2, clauses), (3, linking)])
    assert [got[i][5] for i in (1, 2, 3)] == [["apache-2.0"], ["bsd", "bsd-3-clause"], ["linking-exception"]]
