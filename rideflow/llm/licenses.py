"""License scan: ordered signature rules behind a keyword prefilter, one row at a time in the JVM.

A text that holds any prefilter word becomes a line of numbered words (`` mit#4 license#5``), so a
match of a rule carries the numbers of its first and last word. Rules whose keyword is absent are
not tried. Overlaps are resolved in one sweep over the detections in start order: a detection that
lies within one of a better or equal priority seen before is suppressed.
"""

from __future__ import annotations

import json
import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rideflow.llm.common import fresh, whole_text

# Fixed values of the contract: word characters, base phrases and their labels.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

_BASE_KEYWORD = "license"

#: Priorities: an identifier, a name with its version, a name, a clause of a license text, a hint.
IDENTIFIER, VERSIONED, NAMED, CLAUSE, HINT = range(5)
CONFIDENCE = (1.0, 0.9, 0.75, 0.6, 0.3)


class Rule(NamedTuple):
    """A pattern of words parted by single spaces; `( x)?` and `( x| y)` are allowed."""

    label: str
    priority: int
    keyword: str
    pattern: str


# label: keyword, words of the name, words of the identifier, versions ("" is without one).
_FAMILIES = {
    "mit": ("mit", "mit", "mit", [""]),
    "mit-0": ("mit", "mit no attribution", "mit 0", [""]),
    "apache": ("apache", "apache( software)?", "apache", ["1 0", "1 1", "2 0", "2", ""]),
    "gpl": ("general", "(gnu )?general public", "gpl", ["1 0", "2 0", "3 0", "1", "2", "3", ""]),
    "lgpl": ("lesser", "(gnu )?lesser general public", "lgpl", ["2 0", "2 1", "3 0", "3", ""]),
    "library-gpl": ("library", "(gnu )?library general public", "lgpl", ["2 0", "2", ""]),
    "agpl": ("affero", "(gnu )?affero general public", "agpl", ["1 0", "3 0", "3", ""]),
    "gfdl": ("documentation", "(gnu )?free documentation", "gfdl", ["1 1", "1 2", "1 3", ""]),
    "mpl": ("mozilla", "mozilla public", "mpl", ["1 0", "1 1", "2 0", ""]),
    "epl": ("eclipse", "eclipse public", "epl", ["1 0", "2 0", ""]),
    "edl": ("eclipse", "eclipse distribution", "edl", ["1 0", ""]),
    "cddl": ("development", "common development and distribution", "cddl", ["1 0", "1 1", ""]),
    "cpl": ("common", "common public", "cpl", ["1 0", ""]),
    "ipl": ("ibm", "ibm public", "ipl", ["1 0", ""]),
    "eupl": ("european", "european union public", "eupl", ["1 0", "1 1", "1 2", ""]),
    "cecill": ("cecill", "cecill( free software)?", "cecill", ["1 0", "2 0", "2 1", ""]),
    "bsl": ("boost", "boost software", "bsl", ["1 0", ""]),
    "busl": ("business", "business source", "busl", ["1 1", ""]),
    "sspl": ("server", "server side public", "sspl", ["1 0", "1", ""]),
    "elastic": ("elastic", "elastic", "elastic", ["2 0", ""]),
    "bsd-2-clause": ("bsd", "(bsd 2 clause|2 clause bsd|simplified bsd)", "bsd 2 clause", [""]),
    "bsd-3-clause": ("bsd", "(bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)", "bsd 3 clause", [""]),
    "bsd-4-clause": ("bsd", "(bsd 4 clause|4 clause bsd|original bsd)", "bsd 4 clause", [""]),
    "0bsd": ("bsd", "(zero clause bsd|bsd zero clause)", "0bsd", [""]),
    "bsd": ("bsd", "bsd( style)?", "bsd", [""]),
    "isc": ("isc", "isc", "isc", [""]),
    "zlib": ("zlib", "zlib( libpng)?", "zlib", [""]),
    "libpng": ("libpng", "libpng", "libpng", ["2 0", ""]),
    "unlicense": ("unlicense", "the unlicense", "unlicense", [""]),
    "wtfpl": ("want", "do what the fuck you want to public", "wtfpl", ["2", ""]),
    "artistic": ("artistic", "artistic", "artistic", ["1 0", "2 0", ""]),
    "python": ("python", "python( software foundation)?", "psf", ["2 0", "2", ""]),
    "php": ("php", "php", "php", ["3 0", "3 01", ""]),
    "ruby": ("ruby", "ruby", "ruby", [""]),
    "perl": ("perl", "perl( 5)?", "artistic 1 0 perl", [""]),
    "postgresql": ("postgresql", "postgresql", "postgresql", [""]),
    "openssl": ("openssl", "openssl", "openssl", [""]),
    "curl": ("curl", "curl", "curl", [""]),
    "vim": ("vim", "vim", "vim", [""]),
    "ncsa": ("ncsa", "(university of illinois )?ncsa( open source)?", "ncsa", [""]),
    "x11": ("x11", "x11", "x11", [""]),
    "w3c": ("w3c", "w3c( software)?( notice and)?", "w3c", [""]),
    "ofl": ("font", "(sil )?open font", "ofl", ["1 0", "1 1", ""]),
    "osl": ("open", "open software", "osl", ["1 0", "2 0", "2 1", "3 0", ""]),
    "afl": ("academic", "academic free", "afl", ["1 1", "2 0", "2 1", "3 0", ""]),
    "ecl": ("educational", "educational community", "ecl", ["1 0", "2 0", ""]),
    "ms-pl": ("microsoft", "microsoft public", "ms pl", [""]),
    "ms-rl": ("microsoft", "microsoft reciprocal", "ms rl", [""]),
    "upl": ("universal", "universal permissive", "upl", ["1 0", ""]),
    "mulan": ("mulan", "mulan( permissive software| psl)?", "mulanpsl", ["1 0", "2 0", ""]),
    "odbl": ("database", "open( data commons open)? database", "odbl", ["1 0", ""]),
    "odc-by": ("attribution", "open data commons attribution", "odc by", ["1 0", ""]),
    "cc-by": ("creative", "creative commons attribution", "cc by", ["1 0", "2 0", "2 5", "3 0", "4 0", ""]),
    "cc-by-sa": ("creative", "creative commons attribution (sharealike|share alike)", "cc by sa", ["2 0", "2 5", "3 0", "4 0", ""]),
    "cc-by-nd": ("creative", "creative commons attribution (noderivatives|noderivs|no derivatives|no derivs)", "cc by nd", ["3 0", "4 0", ""]),
    "cc-by-nc": ("creative", "creative commons attribution (noncommercial|non commercial)", "cc by nc", ["2 0", "3 0", "4 0", ""]),
    "cc0": ("creative", "creative commons zero", "cc0", ["1 0", ""]),
    "openrail": ("responsible", "(open|creativeml open) responsible ai", "openrail", [""]),
    "llama": ("llama", "llama [0-9]+( [0-9]+)? community", "llama", [""]),
}

_CLAUSES = (
    ("mit", "granted", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "merge", "to use copy modify merge publish distribute sublicense and or sell copies"),
    ("mit", "substantial", "included in all copies or substantial portions of the software"),
    ("isc", "hereby", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "redistributions", "redistributions of source code must retain the above copyright notice"),
    ("bsd", "redistributions", "redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", "endorse", "may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", "advertising", "all advertising materials mentioning features or use of this software"),
    ("apache", "except", "you may not use this file except in compliance with the license"),
    ("apache", "basis", "distributed on an as is basis without warranties or conditions of any kind"),
    ("apache", "perpetual", "a perpetual worldwide non exclusive no charge royalty free irrevocable"),
    ("gpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("agpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("gpl", "merchantability", "without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("gpl", "option", "either version [0-9]+( [0-9]+)? of the license or at your option any later version"),
    ("mpl", "obtain", "if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl", "subject", "this source code form is subject to the terms of the mozilla public license"),
    ("epl", "accompanying", "this program and the accompanying materials are made available under the terms of the eclipse"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("public-domain", "domain", "released (in|into|to) the public domain"),
    ("public-domain", "domain", "(is|are|placed) in the public domain"),
    ("public-domain", "dedicated", "dedicated to the public domain"),
    ("zlib", "misrepresented", "the origin of this software must not be misrepresented"),
    ("boost", "machine", "solely in the form of machine executable object code generated by a source language processor"),
    ("wtfpl", "want", "you just do what the fuck you want to"),
    ("beerware", "stuff", "if we meet some day and you think this stuff is worth it you can buy me a beer"),
    ("artistic", "perl", "under the same terms as perl itself"),
    ("artistic", "artistic", "under the same terms as the artistic license"),
    ("ofl", "reserved", "with reserved font name"),
    ("proprietary", "confidential", "proprietary and confidential"),
    ("proprietary", "prohibited", "unauthorized copying of this file via any medium is strictly prohibited"),
    ("proprietary", "reserved", "copyright( c)? [0-9]{4}( [0-9]{4})?( [^ ]+){1,6} all rights reserved"),
    ("copyleft", "copyleft", "copyleft"),
    ("copyleft", "wrongs", "all wrongs reserved"),
)

_HINTS = (
    ("unknown", "license", "see (the )?license( file)?( for details)?"),
    ("unknown", "license", "license agreement|end user license( agreement)?"),
    ("unknown", "licensed", "(is|are) licensed under"),
    ("unknown", "licence", "under (the|this) licence"),
    ("unknown", "rights", "all rights reserved"),
)


def _license_rules() -> list[Rule]:
    rules = []
    for label, (keyword, name, identifier, versions) in _FAMILIES.items():
        for version in versions:
            full = f"{label}-{version.replace(' ', '.')}" if version else label
            dashed, first = f"{identifier} {version}".strip(), identifier.split()[0]
            tail = "( only| or later| plus)?" if version else ""
            rules.append(Rule(full, IDENTIFIER, first, f"spdx license identifier {dashed}{tail}"))
            rules.append(Rule(full, IDENTIFIER, first, f"(license|licence) (type |id )?{dashed}{tail}") if version else
                         Rule(full, VERSIONED, first, f"licensed under (the )?{dashed}"))
            if version:
                rules.append(Rule(full, VERSIONED, keyword, f"{name} (license|licence) (version |v )?(v{version}|{version})"))
                rules.append(Rule(full, VERSIONED, keyword, f"{name} (version |v )?(v{version}|{version})( international| generic| unported)? (license|licence)"))
            else:
                rules.append(Rule(full, NAMED, keyword, f"(the )?{name} (license|licence)"))
                rules.append(Rule(full, VERSIONED, keyword, f"under (the )?(terms of the )?{name} (license|licence)"))
    rules += [Rule(label, CLAUSE, keyword, pattern) for label, keyword, pattern in _CLAUSES]
    rules += [Rule(label, HINT, keyword, pattern) for label, keyword, pattern in _HINTS]
    return rules


RULES = _license_rules()
#: A text without any of these parts of words holds no match of any rule.
PREFILTER = ("licens", "licenc", "domain", "granted", "merge", "substantial", "redistribut", "endorse", "advertising", "warrant",
             "royalty", "obtain", "eclipse", "mozilla", "misrepresented", "executable", "fuck", "stuff", "perl", "reserved",
             "confidential", "prohibited", "copyleft")


def lower_words(text: Column) -> Column:
    """The words, lower-cased from A to Z."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    plain = F.trim(F.regexp_replace(lower, NOT_WORD, " "))
    return F.filter(F.split(plain, " "), lambda w: w != "")


def numbered_words(words: Column) -> Column:
    """`` first#0 second#1 ...``."""
    return F.concat(F.lit(" "), F.array_join(F.transform(words, lambda w, i: F.concat(w, F.lit("#"), i.cast("string"))), " "))


def numbered(pattern: str) -> str:
    """The pattern over numbered words: every word is followed by its number."""
    out, word = [], ""
    for piece in re.findall(r"\[[^\]]*\](?:\+|\{\d+\})?|\{[\d,]+\}|[a-z0-9]+|.", pattern):
        is_word = re.match(r"\[|[a-z0-9]", piece) is not None
        if is_word:
            word += piece
            continue
        out.append(word + "#[0-9]+" if word else "")
        word = ""
        out.append(piece)
    out.append(word + "#[0-9]+" if word else "")
    return " (?:" + "".join(out).replace("(", "(?:") + ")"


def _number(match: Column, last: bool) -> Column:
    parts = F.split(match, "#")
    return F.element_at(parts, -1).cast("int") if last else F.regexp_extract(match, "#([0-9]+)", 1).cast("int")


def _base_places(line: Column) -> Column:
    choices = "|".join(f"{p.rpartition(' ')[0].replace(' ', '#[0-9]+ ')}#[0-9]+" for p in BASE)
    return F.regexp_extract_all(line, F.lit(f" (?:{choices}) license#[0-9]+"), F.lit(0))


_RULE_TABLE = "array<struct<priority: int, order: int, label: string, keyword: string, pattern: string>>"


def _detections(line: Column, present: Column, rules: list[Rule]) -> Column:
    """All matches of the rules whose keyword is present, sorted for the sweep."""
    listed = [
        {"priority": r.priority, "order": i, "label": r.label, "keyword": r.keyword, "pattern": numbered(r.pattern)}
        for i, r in enumerate(rules)
    ]
    table = F.from_json(F.lit(json.dumps(listed)), _RULE_TABLE)  # one constant instead of thousands
    tried = F.filter(table, lambda r: F.array_contains(present, r["keyword"]))
    found = F.flatten(F.transform(tried, lambda r: F.transform(
        F.regexp_extract_all(line, r["pattern"], F.lit(0)),
        lambda m: F.struct(
            _number(m, False).alias("start"), r["priority"].alias("priority"), (-_number(m, True)).alias("minus_end"),
            r["order"].alias("order"), r["label"].alias("label"),
        ),
    )))
    return F.array_sort(found)


def _swept(found: Column) -> Column:
    """``labels`` (distinct) and best ``priority`` of what no better or equal detection contains.

    ``reach`` holds, by priority, the furthest end of the detections that start no later.
    """
    levels = len(CONFIDENCE)
    start = F.struct(
        F.array(*[F.lit(-1)] * levels).alias("reach"),
        F.array().cast("array<string>").alias("labels"),
        F.lit(levels).alias("best"),
        F.lit(0).cast("long").alias("kept"),
    )

    def step(state: Column, hit: Column) -> Column:
        end = -hit["minus_end"]
        inside = F.exists(F.slice(state["reach"], F.lit(1), hit["priority"] + 1), lambda x: x >= end)
        reach = F.transform(state["reach"], lambda x, i: F.when(i == hit["priority"], F.greatest(x, end)).otherwise(x))
        return F.struct(
            reach.alias("reach"),
            F.when(inside | F.array_contains(state["labels"], hit["label"]), state["labels"])
            .otherwise(F.concat(state["labels"], F.array(hit["label"]))).alias("labels"),
            F.when(inside, state["best"]).otherwise(F.least(state["best"], hit["priority"])).alias("best"),
            F.when(inside, state["kept"]).otherwise(state["kept"] + 1).alias("kept"),
        )

    return F.aggregate(found, start, step)


def license_scan(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """The documents with ``n_words, n_base, first_word, last_word, base_labels, labels, n_signatures, score``.

    Null and empty texts have no word and no label, and score 0. Rows are judged one by one, so
    repeated rows get equal results. A name that ``docs`` has already gets a longer one.
    """
    rules = RULES if rules is None else rules
    low, words, present, line, base, swept = (fresh(docs, n) for n in ("_low", "_words", "_present", "_line", "_base", "_swept"))
    keywords = F.split(F.lit(" ".join(sorted({_BASE_KEYWORD, *(r.keyword for r in rules)}))), " ")
    names = {n: fresh(docs, n) for n in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "n_signatures", "score")}
    text, plausible = whole_text(), F.lit(False)
    for part in PREFILTER:
        plausible = plausible | F.contains(F.col(low), F.lit(part))
    rows = docs.withColumns({low: F.lower(text), names["n_words"]: F.regexp_count(text, F.lit(WORD)).cast("long")})
    rows = rows.withColumn(words, F.when(plausible, lower_words(text))).drop(low)
    rows = rows.withColumn(present, F.array_intersect(words, keywords))
    there = F.size(present) > 0
    rows = rows.withColumn(line, F.when(there, numbered_words(F.col(words)))).drop(words)
    rows = rows.withColumns({
        base: F.when(there, _base_places(F.col(line))),
        swept: F.when(there, _swept(_detections(F.col(line), F.col(present), rules))),
    })
    places, result = F.col(base), F.col(swept)
    some = F.coalesce(F.size(places), F.lit(0)) > 0
    own = [F.when(F.contains(F.array_join(places, ""), F.lit(f" {phrase.split()[-2]}#")), F.lit(label)) for phrase, label in BASE.items()]
    base_labels = F.when(some, F.array_compact(F.array(*own))).otherwise(F.array().cast("array<string>"))
    confidence = F.element_at(F.array(*map(F.lit, CONFIDENCE), F.lit(0.0)), result["best"] + 1)
    return rows.withColumns({
        names["n_base"]: F.when(some, F.size(places)).otherwise(0).cast("long"),
        names["first_word"]: F.when(some, _number(F.element_at(places, 1), False)).cast("long"),
        names["last_word"]: F.when(some, _number(F.element_at(places, -1), False)).cast("long"),
        names["base_labels"]: F.array_join(F.array_sort(F.array_distinct(base_labels)), ","),
        names["labels"]: F.array_join(
            F.array_sort(F.array_union(base_labels, F.coalesce(result["labels"], F.array().cast("array<string>")))), ","
        ),
        names["n_signatures"]: F.coalesce(result["kept"], F.lit(0)).cast("long"),
        names["score"]: F.greatest(F.coalesce(confidence, F.lit(0.0)), F.when(some, F.lit(CONFIDENCE[NAMED])).otherwise(0.0)),
    }).drop(present, line, base, swept)


def license_report(docs: DataFrame) -> DataFrame:
    """One row per document: words, base places, labels and score."""
    return license_scan(docs.select("doc_id", "text")).drop("text")
