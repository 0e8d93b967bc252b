"""The license scan against ungated rules, quadratic suppression and plain word lists."""

import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from salescope.llm import license_scan
from salescope.llm.license_rules import RULES, WEIGHTS, parse_rules
from salescope.llm.queries import op12_license_scan

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute_places(words):
    return sorted((k, label) for phrase, label in license_scan.PHRASES.items() for k in range(len(words))
                  if words[k:k + len(phrase.split())] == phrase.split())


def brute_suppressed(found):
    def goes(a, b):  # a lies within b, which outranks it
        inside = b[0] <= a[0] and a[1] <= b[1]
        same = a[:2] == b[:2]
        return inside and (b[2] > a[2] or b[2] == a[2] and (not same or b[3] < a[3]))
    return sorted(a for a in found if not any(goes(a, b) for b in found))


def brute_detections(words, rules=RULES):
    line = " ".join(words).encode()
    found = []
    for k, rule in enumerate(rules):
        for m in rule.pattern.finditer(line):
            first = line.count(b" ", 0, m.start())
            found.append((first, first + m.group().count(b" ") + 1, rule.priority, k))
    return brute_suppressed(found)


def brute_row(text):
    words = brute_words(text)
    places = brute_places(words)
    found = brute_detections(words)
    best = {}
    for _, _, p, k in found:
        best[RULES[k].label] = max(best.get(RULES[k].label, 0), p)
    rest = 1.0
    for label in sorted(best):
        rest *= 1 - WEIGHTS[best[label]]
    base = {label for _, label in places}
    return (len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None,
            ",".join(sorted(base)), ",".join(sorted(base | set(best))), pytest.approx(1 - rest, abs=1e-12))


TEXTS = [
    None, "", "123 !!", "no words of interest here",
    "Licensed under the Apache License, Version 2.0 (the \"License\"); see all rights reserved.",
    "GNU General Public License, version 3, or (at your option) any later version. GENERAL-PUBLIC-LICENSE general public license",
    "CC BY cc-by_cc.by ccby cc byé ccc by cc by",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files, to deal without restriction to sublicense",
    "SPDX-License-Identifier: GPL-2.0-or-later\nCopyright (c) 2020 Some One. All rights reserved.",
    "Creative Commons Attribution-ShareAlike 4.0 International license; all rights reserved all rights reserved",
    "İstanbul ÀLL rights reserved general\x00public\x7flicense   gplv3+",
    "word " * 300_000 + "all rights reserved " * 20_000 + "mit license",
    "x" * 3_000_000 + " the MIT License",
]


def test_query_against_brute_force(spark, tmp_path):
    rows = [(k % 9, t, "x", 1.5, "y", [1]) for k, t in enumerate(TEXTS)] + [(4, TEXTS[4], "x", 1.5, "y", [1])]
    spark.createDataFrame(rows, "doc_id long, text string, labels string, score double, n_words string, places array<int>"
                          ).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    out = op12_license_scan(spark, str(tmp_path)).collect()
    short = [t for t in TEXTS if len(t or "") < 10_000] + [TEXTS[4]]
    got = [tuple(r)[1:] for r in out]
    for text in short:
        assert brute_row(text) in got
    long = next(r for r in out if r.n_words == 300_000 + 60_000 + 2)
    assert (long.n_base, long.first_word, long.last_word) == (20_000, 300_000, 300_000 + 3 * 19_999)
    assert long.labels == "all-rights-reserved,mit,reserved"
    assert len(out) == len(rows) and any(r.n_words == 4 and r.labels == "mit" for r in out)


def test_query_on_the_table(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    out = op12_license_scan(spark, sf).collect()
    assert {r.doc_id: tuple(r)[1:] for r in out} == {i: brute_row(t) for i, t in texts.items()}


def test_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert license_scan.scan(none).count() == 0


def test_there_are_hundreds_of_rules():
    assert len(RULES) >= 200 and all(r.keywords for r in RULES)


@pytest.mark.parametrize("part", range(10))
@settings(max_examples=150, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.data())
def test_every_match_holds_its_keywords(part, data):
    rule = data.draw(st.sampled_from(RULES[part::10]))
    inner = rule.pattern.pattern.removeprefix(b"(?<![^ ])").removesuffix(b"(?![^ ])")
    text = data.draw(st.from_regex(re.compile(inner), fullmatch=True))
    words = b" ".join(text.translate(license_scan._WORD).split())
    assert all(rule.keywords <= set(m.group().split()) for m in rule.pattern.finditer(words))


def test_suppression_against_all_pairs():
    r = random.Random(5)
    for _ in range(400):
        found = []
        for k in range(r.randrange(14)):
            start = r.randrange(12)
            found.append((start, start + r.randint(1, 8), r.randrange(len(WEIGHTS)), k))
        assert sorted(license_scan.suppressed(found)) == brute_suppressed(found)


def test_gate_and_pieces_change_nothing(monkeypatch):
    r = random.Random(7)
    vocabulary = ["gpl", "3", "0", "or", "later", "mit", "license", "cc", "by", "nc", "sa", "4", "apache", "version", "2", "the",
                  "gnu", "lesser", "general", "public", "all", "rights", "reserved", "zlib", "domain", "in", "É", "x"]
    for size in (1, 7, 1 << 20):
        monkeypatch.setattr(license_scan, "PIECE", size)
        scanner = license_scan.Scanner(RULES, license_scan.PHRASES)
        for _ in range(60):
            text = r.choice([" ", "-", ", "]).join(r.choices(vocabulary, k=r.randrange(60)))
            words = brute_words(text)
            n, places, found = scanner.scan(text)
            assert (n, sorted((k, label) for label, k in places), sorted(found)) == \
                (len(words), brute_places(words), brute_detections(words))


def test_own_rules_and_phrases(spark):
    rules = parse_rules("low | 1 | acme | acme ~l\nhigh | 3 | acme plus | (?:the )?acme ~l plus")
    docs = spark.createDataFrame([("a", "The ACME licence plus, acme license; see foo bar")], "k string, body string")
    row = license_scan.scan(docs, "k", "body", rules, {"foo bar": "f"}).first()
    assert [(d.label, d.start, d.end) for d in row.detections] == [("high", 0, 4), ("low", 4, 6)]
    assert [(p.label, p.start) for p in row.places] == [("f", 7)] and 0.9 < row.score < 1
