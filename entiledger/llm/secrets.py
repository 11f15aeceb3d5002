"""Secret scans: fixed formats, and sliding-window entropy over candidate strings.

A candidate is a run of letters, digits and the marks of base 64. A window slides over
it; the counts of its characters change by one in and one out, and so does its entropy.
A run of windows whose entropy reaches the bound of its character class is reported as
one span, unless the allow-list knows it, less what a fixed format covers of it.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The formats, in listed order, and the length that each match needs of
#: its last group (or of itself). Letters of `assign` are of either case in ASCII only.
#: The runs of the other two hold no shorter match of theirs, so their lengths are part
#: of the pattern.
BASE = {
    "assign": (
        r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
        r"((?-i:[A-Za-z0-9+/_.=-])+)",
        re.ASCII | re.IGNORECASE,
        6,
    ),
    "access": (r"AKIA[A-Z0-9]{16,}", re.ASCII, 20),
    "hex": (r"[0-9a-f]{24,}", re.ASCII, 24),
}
KINDS = [*BASE, "entropy"]

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: Least length of what a fixed format leaves of a span: shorter rests are mostly names.
REST = 10
#: Bits per character that a window needs, by the class of the whole candidate: the
#: digits are of hex (either case), of letters and digits, or of base 64 with marks.
CLASSES = (
    ("hex", re.compile(r"[0-9a-f]+|[0-9A-F]+"), 3.0),
    ("alnum", re.compile(r"[A-Za-z0-9]+"), 3.6),
    ("base64", re.compile(r"[A-Za-z0-9+/_=-]+"), 3.6),
)
#: Example words, judged by what stands between / and = in a candidate.
EXAMPLE = r"(?i:.*(example|sample|dummy|placeholder|changeme|xxxx).*)"
TOKEN = r"[^/=]+"
#: Candidates that are never secrets: without digits or without letters, identifiers in
#: the common form of 8-4-4-4-12 hex digits, words joined by marks, paths, and examples.
ALLOWED = (
    r"[^0-9]*",
    r"[^A-Za-z]*",
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
    r"([A-Za-z]+|[0-9]+)([/_=+-]+([A-Za-z]+|[0-9]+))*[/_=+-]*",
    EXAMPLE,
)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed formats, leftmost and non-overlapping by kind."""
    out = []
    for kind, (pattern, flags, least) in BASE.items():
        for match in re.finditer(pattern, text, flags):
            if len(match[match.re.groups]) >= least:
                out.append((*match.span(), kind))
    return out


def hot_windows(run: str, bound: float, window: int = WINDOW) -> Iterator[tuple[int, int]]:
    """(start, end) of the merged windows of a run whose entropy is at least the bound.

    The entropy of a window is log2(w) - sum(n * log2(n)) / w over its character counts,
    and the sum is kept up by two terms for each character that the window moves.
    """
    if len(run) < window:
        return
    term = [0.0] + [n * math.log2(n) for n in range(1, window + 1)]
    count: dict[str, int] = {}
    total, full, start, end = 0.0, math.log2(window), -1, -1
    for i, c in enumerate(run):
        if i >= window:
            gone = run[i - window]
            n = count[gone]
            count[gone] = n - 1
            total += term[n - 1] - term[n]
        n = count.get(c, 0)
        count[c] = n + 1
        total += term[n + 1] - term[n]
        if i >= window - 1 and full - total / window >= bound - 1e-9:
            if start >= 0 and i - window + 1 > end:
                yield start, end
                start = -1
            if start < 0:
                start = i - window + 1
            end = i + 1
    if start >= 0:
        yield start, end


def _stretches(run: str, example: re.Pattern) -> Iterator[tuple[int, int]]:
    """(start, end) of what lies between the tokens of a run that are examples."""
    if not example.fullmatch(run):
        yield 0, len(run)
        return
    start = end = -1
    for token in re.finditer(TOKEN, run):
        if example.fullmatch(token[0]):
            if start >= 0:
                yield start, end
            start = -1
            continue
        if start < 0:
            start = token.start()
        end = token.end()
    if start >= 0:
        yield start, end


@lru_cache
def _known(allowed: tuple[str, ...]) -> re.Pattern:
    """Pattern of the candidates that are never secrets, but for the example words."""
    return re.compile("|".join(f"(?:{p})" for p in allowed if p != EXAMPLE) or r"(?!)")


def entropy_spans(text: str, allowed: tuple[str, ...] = ALLOWED) -> list:
    """(start, end, "entropy") of windows of high entropy outside the allow-list."""
    known = _known(allowed)
    example = re.compile(EXAMPLE if EXAMPLE in allowed else r"(?!)")
    out = []
    for match in re.finditer(CANDIDATE, text):
        if known.fullmatch(match[0]):
            continue
        for first, last in _stretches(match[0], example):
            run = match[0][first:last]
            if len(run) < WINDOW or known.fullmatch(run):
                continue
            bound = next(b for _, p, b in CLASSES if p.fullmatch(run))
            for start, end in hot_windows(run, bound):
                at = match.start() + first
                out.append((at + start, at + end, "entropy"))
    return out


def _rests(start: int, end: int, starts: list, ends: list) -> Iterator[tuple[int, int]]:
    """(start, end) of what merged spans, given by their sorted ends, leave of a span."""
    i = bisect_right(ends, start)
    while i < len(ends) and starts[i] < end:
        if start < starts[i]:
            yield start, starts[i]
        start = ends[i]
        i += 1
    if start < end:
        yield start, end


def spans(text: str | None, allowed: tuple[str, ...] = ALLOWED) -> list:
    """All (start, end, kind) of a text by start, then kind as listed.

    Spans of a fixed format are all there. One of high entropy is cut by those that it
    overlaps: what lies outside them is a span if it has ten characters or more and the
    allow-list does not know it. Places are code points, the end exclusive.
    """
    if not text:
        return []
    found = base_spans(text)
    starts, ends = [], []
    for a, b, _ in sorted(found):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    for a, b, kind in entropy_spans(text, allowed):
        for c, d in _rests(a, b, starts, ends):
            rest = d - c < b - a
            if not rest or d - c >= REST and not _known(allowed).fullmatch(text, c, d):
                found.append((c, d, kind))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def scan(
    docs: DataFrame,
    allowed: tuple[str, ...] = ALLOWED,
    text: str = "text",
    into: str = "secrets",
) -> DataFrame:
    """docs with the spans of a text column, array<struct<kind, start, end>>.

    Every whole text is scanned by itself, without a shuffle; a null or empty text has no
    spans, and equal texts have equal ones. A column called `into` is replaced.
    """

    @F.pandas_udf("array<struct<kind:string,start:int,end:int>>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(
            [
                [{"kind": k, "start": a, "end": b} for a, b, k in spans(t, allowed)]
                for t in texts
            ],
            dtype=object,
        )

    return docs.withColumn(into, of(F.col(text)))
