"""Secret scan: base patterns and an assignment-aware lexer over whole texts.

The lexer (``assignments``) reads source and configuration syntax into pairs of a name and literals and
carries constants from name to name; each literal is scored here by the name it ends up under.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import cache
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rideflow.llm.assignments import bindings, reaching, resolved
from rideflow.llm.common import fresh, small_batches, whole_text

# Fixed values of the contract: base patterns, least lengths and the order of kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "named")

#: A literal under a name is a secret from this product of name and literal score.
NAMED_FROM = 0.45
MARK = "[REDACTED]"

_NAME_WEIGHTS = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "pass": 0.7, "secret": 0.9, "token": 0.85, "apikey": 0.95,
    "credential": 0.8, "credentials": 0.8, "bearer": 0.8, "auth": 0.6, "jwt": 0.8, "pin": 0.5, "salt": 0.5, "signature": 0.5,
}
_KEY_BEFORE = {"api", "private", "access", "secret", "encryption", "signing", "master", "account", "service", "client", "auth", "ssh", "aws"}
_HARMLESS_NAMES = {"public", "example", "sample", "placeholder", "length", "len", "count", "file", "path", "type", "url", "uri", "endpoint",
                   "field", "label", "prompt", "hint", "policy", "expiry", "expires", "ttl", "regex", "pattern", "format", "header"}
_HARMLESS_VALUES = re.compile(r"(?i)^(?:x+|\*+|\.+|changeme|password|secret|token|example.*|your[-_ ].*|<.*>|\$\{.*|\{\{.*|\{[A-Za-z0-9_.()]*\}|none|null|true|false|todo|test|dummy|\[?redacted\]?)$")
# A member of another name, such as ``user.password``.
_PATH = re.compile(r"[A-Za-z_]+(?:\.[A-Za-z_]+)+")
# Part of every name that has a weight.
_HINT = re.compile(r"(?i)pass|pwd|secret|token|key|cred|bearer|auth|jwt|pin|salt|signature")
_NAME_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")

class Span(NamedTuple):
    """``start`` and ``end`` of the finding, ``value_start`` and ``value_end`` of the secret in it."""

    kind: str
    start: int
    end: int
    value_start: int
    value_end: int
    score: float


def name_score(name: str) -> float:
    """How sensitive a name is, 0 to 1, by its parts (``dbPassword``, ``API_KEY``)."""
    parts = [p.lower() for p in _NAME_PARTS.findall(name)]
    if _HARMLESS_NAMES & set(parts):
        return 0.0
    best = max((_NAME_WEIGHTS.get(p, 0.0) for p in parts), default=0.0)
    keys = any(b in ("key", "keys") and a in _KEY_BEFORE for a, b in zip(parts, parts[1:]))
    return max(best, 0.95 if keys else 0.0)


def literal_score(value: str, quoted: bool) -> float:
    """How much a literal looks like a secret, 0 to 1, by its information in bits."""
    if len(value) < 6 or _HARMLESS_VALUES.match(value) or not quoted and _PATH.fullmatch(value):
        return 0.0
    kinds = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    if not quoted and kinds < 2 or " " in value and kinds < 3:
        return 0.0
    n = len(value)
    bits = -sum(c * math.log2(c / n) for c in Counter(value).values())
    return min(1.0, bits / 32)


def base_spans(text: str) -> list[Span]:
    """The base findings: leftmost, non-overlapping by kind; those that are too short go."""
    out = []
    low = text.lower()
    if any(w in low for w in ("passw", "secret", "token", "api")):
        out += [Span("assign", *m.span(), *m.span(2), 1.0) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [Span("access", *m.span(), *m.span(), 1.0) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    out += [Span("hex", *m.span(), *m.span(), 1.0) for m in HEX.finditer(text) if m.end() - m.start() >= LEAST["hex"]]
    return out


def named_spans(text: str) -> list[Span]:
    """Literals that a sensitive name gets, directly or through other names; each span once."""
    if not _HINT.search(text):
        return []
    scored = cache(name_score)
    found = bindings(text, scored)
    if not any(scored(b.name) for b in found):
        return []
    rows = resolved(text, found)
    scores = {i: scored(r.name) * literal_score(r.value, r.quoted) for i, r in enumerate(rows) if scored(r.name)}
    hits = reaching(rows, {i: score for i, score in scores.items() if score >= NAMED_FROM})
    return [Span("named", *span, *span, score) for span, score in hits.items()]


def secret_spans(text: str) -> list[Span]:
    """All findings by start, then kind. A named literal inside a base finding is not repeated."""
    base = sorted(base_spans(text), key=lambda s: (s.start, BASE_KINDS.index(s.kind)))
    named = sorted(named_spans(text), key=lambda s: s.start)
    reach, i, more = -1, 0, []
    for s in named:
        while i < len(base) and base[i].start <= s.start:
            reach, i = max(reach, base[i].end), i + 1
        if s.end > reach:
            more.append(s)
    return sorted(base + more, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def redact(text: str) -> str:
    """The text with every secret's value replaced by a mark."""
    out, at = [], 0
    for start, end in sorted((s.value_start, s.value_end) for s in secret_spans(text)):
        if start >= at:
            out += [text[at:start], MARK]
        at = max(at, end)
    return "".join([*out, text[at:]])


_SPANS = T.ArrayType(
    T.StructType()
    .add("kind", T.StringType())
    .add("start", T.LongType()).add("end", T.LongType())
    .add("value_start", T.LongType()).add("value_end", T.LongType())
    .add("score", T.DoubleType())
)


@F.pandas_udf(_SPANS)
def _spans_of(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: [s._asdict() for s in secret_spans(t)])


@F.pandas_udf(T.StringType())
def _redacted(texts: pd.Series) -> pd.Series:
    return texts.map(redact)


def secret_scan(docs: DataFrame) -> DataFrame:
    """The rows with ``secrets``: every finding by start and kind, offsets in code points.

    Null and empty texts have none. Rows are judged one by one, so repeated rows get equal results.
    A column ``secrets`` of the input stays; the new one then gets a longer name.
    """
    small_batches(docs.sparkSession)
    return docs.withColumn(fresh(docs, "secrets"), _spans_of(whole_text()))


def without_secrets(docs: DataFrame) -> DataFrame:
    """The same rows and columns with the secrets in ``text`` masked and ``n_chars`` following it.

    A null text stays null. ``n_chars`` changes only where the text does.
    """
    small_batches(docs.sparkSession)
    clean = fresh(docs, "_clean")
    rows = docs.withColumn(clean, F.when(F.col("text").isNotNull(), _redacted(whole_text())))
    if "n_chars" in docs.columns:
        changed = ~F.col(clean).eqNullSafe(F.col("text"))
        rows = rows.withColumn("n_chars", F.when(changed, F.length(clean)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return rows.withColumn("text", F.col(clean)).drop(clean)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_report(docs: DataFrame) -> DataFrame:
    """One row per document: base findings by kind, their digest, and all spans."""
    rows = secret_scan(docs.select("doc_id", "text"))
    spans = F.col("secrets")
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE_KINDS))
    counts = [_count(spans, kind).alias(f"n_{kind}") for kind in BASE_KINDS]
    return rows.select(
        "doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(spans).alias("spans")
    )


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
