"""License scans against a plain scan of every rule."""

import re
import time
import warnings

import pytest
from hypothesis import HealthCheck, find, settings
from hypothesis import strategies as st

from wakeline.llm import licenses
from wakeline.llm.license_rules import Rule, read_rules, spaced

RULES = read_rules()
SCHEMA = "doc_id long, text string, words string, id string, hits int, list int, label string"
EXTRA = ("w", "i", 1, 2, "l")


def plain_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", low) if w]


def brute(text, rules=RULES):
    words = plain_words(text)
    line = spaced(" ".join(words)) if words else ""
    base = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(words))
            if words[i: i + len(phrase.split())] == phrase.split()]
    hits = []
    for r in rules:
        for m in re.finditer(r.pattern, line):
            at = line[: m.start()].count(" ") // 2
            hits.append((at, at + m.group().count(" ") // 2, r.level, r.rank, r.label))

    def within(d, e):
        wide, narrow = e[1] - e[0], d[1] - d[0]
        return e[0] <= d[0] and d[1] <= e[1] and (e[2] < d[2] or (e[2] == d[2] and (wide > narrow or (wide == narrow and e[3] < d[3]))))

    kept = sorted((d for d in hits if not any(within(d, e) for e in hits)), key=lambda d: (d[0], -d[1], d[2], d[3]))
    best = {}
    for d in kept:
        best[d[4]] = min(best.get(d[4], 9), d[2])
    return (
        len(words), len(base), min((b[0] for b in base), default=None), max((b[0] for b in base), default=None),
        ",".join(sorted({b[1] for b in base})), ",".join(sorted({b[1] for b in base} | {d[4] for d in kept})),
        1 - 2.0 ** -min(50, sum(licenses.POINTS[v] for v in best.values())), ",".join(f"{d[4]}:{d[0]}:{d[1]}" for d in kept))


def run(spark, texts, rules=None):
    table = spark.createDataFrame([(i, t, *EXTRA) for i, t in enumerate(texts)], SCHEMA)
    return [tuple(r)[1:] for r in licenses.report(table, rules=rules).orderBy("doc_id").collect()]


def samples():
    """For each rule its shortest text and one found at random."""

    out = []
    for r in RULES:
        whole = re.compile(r.pattern)
        strategy = st.from_regex(re.compile(r.pattern.replace("[^ ]", "[a-z]"), re.ASCII), fullmatch=True)
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            text = find(strategy, lambda t: bool(whole.fullmatch(t)), settings=settings(
                max_examples=5, database=None, derandomize=True, suppress_health_check=list(HealthCheck)))
        out.append((r, text))
    return out


def test_rules_match_their_own_samples_and_hold_a_keyword():
    assert len(RULES) > 200 and len({r.label for r in RULES}) > 80
    for r, text in samples():
        assert any(k in text for k in r.keywords), (r, text)


def test_every_rule_as_in_a_plain_scan(spark):
    texts = [f"Before it, {t.strip().replace('  ', '-').upper()}; after it." for _, t in samples()]
    texts += ["".join(texts[i: i + 7]) for i in range(0, 70, 7)]
    assert run(spark, texts) == [brute(t) for t in texts]


def test_odd_texts(spark):
    texts = [
        None, "", " \n.,;", "cc", "CC-BY", "cc by cc by", "mit license mit license", "The MIT\n\tLicense!", "ApacheK License", "İ mit license",
        "apache-license", "xapache license", "apache licenses", "GNU  General...Public/License", "cc é by", "CC BY-NC 4.0, CC BY", "\x00mit\x7flicense\x00",
        "Licensed under the Apache License, Version 2.0 (the \"License\")", "gnu lesser general public license version 2.1 or later",
        "permission is hereby granted", "mit license" + "\U0001f600", "\U0001f600 mit license", "apache license", "apache license",
    ]
    assert run(spark, texts) == [brute(t) for t in texts]


def test_suppression(spark):
    texts = [
        "SPDX-License-Identifier: MIT license", "Licensed under the MIT license", "mit license under gpl 3 0 or later and gplv3",
        "licensed under cc by nc 4 0 license", "this work is under the terms of the GNU General Public License, version 2, or gpl",
    ]
    got = run(spark, texts)
    assert got == [brute(t) for t in texts]
    assert "mit:0:4" in got[0][-1] and got[3][5] == "cc-by,cc-by-nc-4.0"


def test_nested_rules(spark):
    rules = [Rule(0, 2, "a", (" x ",), " x  y "), Rule(1, 2, "b", (" x ",), " x  y  z "), Rule(2, 1, "c", (" y ",), " y "),
             Rule(3, 2, "d", (" x ",), " x  y  z "), Rule(4, 3, "e", (" z ",), " z  x ")]
    texts = ["x y z", "x y z x y z", "y x y", "z x", "x y z x " * 90]
    assert run(spark, texts, rules) == [brute(t, rules) for t in texts]


def test_empty_table_and_very_long_text(spark):
    assert run(spark, []) == []
    text = "Licensed under CC BY 4.0, or (at your option) the MIT License; " * 12_000
    began = time.time()
    got = run(spark, [text])[0]
    assert got[:4] == (len(plain_words(text)), 24_000, 2, len(plain_words(text)) - 2)
    assert got[4] == "cc-by,mit" and got[5] == "cc-by,cc-by-4.0,mit"
    assert time.time() - began < 120


@pytest.mark.parametrize("level", sorted(licenses.POINTS))
def test_every_level_has_rules(level):
    assert any(r.level == level for r in RULES)
