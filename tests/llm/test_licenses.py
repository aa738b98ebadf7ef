from __future__ import annotations

import re

import pytest

from rideflow.llm import licenses

PHRASES = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}
A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(A_Z))


def brute_base(text):
    words = words_of(text)
    places = sorted((i, label) for i in range(len(words)) for p, label in PHRASES.items() if tuple(words[i : i + len(p)]) == p)
    return (len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(sorted({x for _, x in places})))


def brute_labels(text):
    """Every rule over plain words; a detection goes if one of better or equal priority and rank holds it."""
    words = words_of(text)
    line, at = "", {}
    for i, w in enumerate(words):
        at[len(line)] = i
        line += f"{w} "
    hits = []
    for order, rule in enumerate(licenses.RULES):
        for m in re.finditer(rf"(?:^|(?<= ))(?:{rule.pattern})(?= )", line):
            hits.append((at[m.start()], rule.priority, -(at[m.start()] + m[0].count(" ")), order, rule.label))
    hits.sort()
    kept = []
    for k, (s, p, e, *_, label) in enumerate(hits):
        if not any(s2 <= s and -e2 >= -e and p2 <= p for s2, p2, e2, *_ in hits[:k]):
            kept.append(label)
    return set(kept), len(kept)


TEXTS = [
    None, "", "   ", "no words on terms", "Released under the MIT License.", "MIT license mit LICENSE", "mit_license mit-license MIT  License",
    "Licensed under the Apache License, Version 2.0.", "This work is licensed under the GNU General Public License, version 3.",
    "SPDX-License-Identifier: GPL-3.0-or-later\nThe General Public License", "general public  license, apache license; mit license",
    "GNU Lesser General Public License v2.1", "mIt lİcense mit license", "KİT ſ license MIT LICENSE é", "licensemit license",
    "Permission is hereby granted, free of charge, to any person obtaining a copy", "Copyright (c) 2020 Some Body. All rights reserved.",
    "Creative Commons Attribution-ShareAlike 4.0 International License", "bsd 3 clause license and the mozilla public license 2.0",
    "public license general public license", "apache license version 2.0 " * 400,
]


@pytest.fixture(scope="module")
def scanned(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    return {r.doc_id: r for r in licenses.license_report(df).collect()}


@pytest.mark.parametrize("i", range(len(TEXTS)))
def test_base_places(scanned, i):
    r = scanned[i]
    assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_base(TEXTS[i])
    assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


@pytest.mark.parametrize("i", [i for i, t in enumerate(TEXTS) if len(t or "") < 1000])
def test_rules_and_suppression(scanned, i):
    labels, kept = brute_labels(TEXTS[i])
    base = set(filter(None, brute_base(TEXTS[i])[-1].split(",")))
    assert scanned[i].labels == ",".join(sorted(labels | base)) and scanned[i].n_signatures == kept


def test_there_are_hundreds_of_rules_in_priority_order():
    assert len(licenses.RULES) > 300
    assert all(0 <= r.priority < len(licenses.CONFIDENCE) for r in licenses.RULES)


def example(pattern):
    """A text that the pattern matches: first alternatives, options left out."""
    while re.search(r"\(", pattern):
        pattern = re.sub(r"\(([^()]*)\)(\?|\{[^}]*\})?", lambda m: "" if m[2] == "?" else m[1].partition("|")[0], pattern)
    return re.sub(r"\[0-9\]\+|\[0-9\]\{4\}", "2020", pattern.partition("|")[0]).replace("[^ ]+", "x")


def test_each_rule_is_found_through_its_prefilter(spark):
    texts = [(i, example(r.pattern)) for i, r in enumerate(licenses.RULES)]
    got = licenses.license_scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert [texts[r.doc_id] for r in got if r.n_signatures == 0] == []


def test_clashing_columns_and_no_rows(spark):
    df = spark.createDataFrame([(1, "mit license", "x", 2)], "doc_id long, text string, labels string, Score int")
    row = licenses.license_scan(df).first()
    assert (row["labels"], row["labels_"], row["Score"], row["score_"]) == ("x", "mit", 2, 0.75)
    assert licenses.license_report(df.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = licenses.license_report(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
