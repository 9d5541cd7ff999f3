"""Secret scan: fixed patterns, and windows of high entropy inside candidate strings.

A candidate is a long run of the characters of one class.  A window of fixed
width slides over it; the counts of its characters, and with them the Shannon
entropy, change by one character in and one out.  Windows at or above the
threshold of the class grow together into spans, unless the allow-list names
them.  The work is local to a row: no shuffle, memory in proportion to a text.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The base patterns by kind, the group whose length counts, and the least length.
BASE = (
    ("assign", r"(?ai:(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?)([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)
KINDS = [kind for kind, *_ in BASE]


@dataclass(frozen=True)
class CharacterClass:
    """Runs of ``characters`` of at least ``window``; ``bits`` is the least entropy of a window."""

    kind: str
    characters: str
    window: int
    bits: float


CLASSES = (CharacterClass("entropy_hex", "0-9A-Fa-f", 24, 3.2), CharacterClass("entropy_base64", "A-Za-z0-9+/_-", 20, 3.9))

#: A candidate that one of these matches from end to end is ordinary text, not a secret.
ALLOWED = (
    r"[A-Za-z]?[a-z]+",  # one long word
    r"[A-Z]+|[0-9]+",  # shouted words and plain numbers
    r"(?:[A-Za-z]?[a-z]+|[A-Z]+|[0-9]{1,4})(?:[-_/](?:[A-Za-z]?[a-z]+|[A-Z]+|[0-9]{1,4}))+",  # slugs, paths, names
)
#: Words of samples; they allow what is within the width of a window of them, not the rest of a candidate.
SAMPLES = (
    r"(?i:example|placeholder|your[-_]?(?:key|token|secret)|changeme)",  # samples in manuals
    r"(?i:abcdefghij|0123456789|qwertyuiop)",  # alphabets and keyboard rows
)

SCHEMA = "array<struct<kind:string,start:int,stop:int,value:string>>"
ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("value", pa.string())]))


def hot_spans(run: str, window: int, bits: float) -> Iterator[tuple[int, int]]:
    """Spans of ``run`` whose windows reach ``bits`` of entropy per character."""
    # The entropy is log2(window) - sum(c * log2(c)) / window.  Scaled to whole numbers, the sum cannot drift.
    scale = 1 << 40
    weight = [0] + [round(c * math.log2(c) * scale) for c in range(1, window + 1)]
    most = math.floor((math.log2(window) - bits) * window * scale)
    counts: dict[str, int] = {}
    total, start, stop = 0, -1, -1
    for i, c in enumerate(run):
        n = counts.get(c, 0)
        counts[c] = n + 1
        if i >= window:
            old = run[i - window]
            # The one that leaves goes first, so no count passes the width of the window.
            counts[c] = n
            m = counts[old]
            counts[old] = m - 1
            total += weight[m - 1] - weight[m]
            n = counts[c]
            counts[c] = n + 1
        total += weight[n + 1] - weight[n]
        if i >= window - 1 and total <= most:
            first = i - window + 1
            if first > stop:
                if start >= 0:
                    yield start, stop
                start = first
            stop = i + 1
    if start >= 0:
        yield start, stop


class Scanner:
    """Finds the spans of one text, sorted by start and kind."""

    def __init__(self, classes: tuple[CharacterClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED,
                 samples: tuple[str, ...] = SAMPLES):
        self.base = [(kind, re.compile(p), group, least) for kind, p, group, least in BASE]
        # A run below the least length fails anyway, so the expression may leave it out.
        self.base[2] = ("hex", re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}"), 0, 24)
        self.classes = [(c, re.compile(f"[{c.characters}]{{{c.window},}}")) for c in classes]
        self.allowed = re.compile("|".join(f"(?:{p})" for p in allowed)) if allowed else None
        self.samples = re.compile("|".join(f"(?:{p})" for p in samples)) if samples else None
        self.order = {k: i for i, k in enumerate([*KINDS, *[c.kind for c in classes]])}

    def spans(self, run: str, c: CharacterClass) -> Iterator[tuple[int, int]]:
        """Hot spans of a candidate, without what is near a sample word."""
        hot = list(hot_spans(run, c.window, c.bits))
        near = [(m.start() - c.window, m.end() + c.window) for m in self.samples.finditer(run)] if hot and self.samples else []
        for a, b in hot:
            at = a
            for start, stop in [*near, (b, b)]:
                if at < min(start, b):
                    # The text between is looked at anew; windows that reach into the left out part do not count.
                    yield from ((at + x, at + y) for x, y in hot_spans(run[at:min(start, b)], c.window, c.bits))
                at = max(at, stop)

    def __call__(self, text: str) -> list[tuple[str, int, int]]:
        found = [(kind, m.start(), m.end()) for kind, pattern, group, least in self.base
                 for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
        for c, runs in self.classes:
            for m in runs.finditer(text):
                if self.allowed is None or not self.allowed.fullmatch(m.group()):
                    found += [(c.kind, m.start() + a, m.start() + b) for a, b in self.spans(m.group(), c)]
        return sorted(found, key=lambda x: (x[1], self.order[x[0]]))


def scan_secrets(df: DataFrame, text: str = "text", into: str = "secrets",
                 classes: tuple[CharacterClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED,
                 samples: tuple[str, ...] = SAMPLES) -> DataFrame:
    """Adds an array of ``kind, start, stop, value`` (code points, stop excluded), sorted by start and kind.

    Base kinds are always reported; the allow-list suppresses entropy spans
    only.  A null or empty text gives an empty array; repeated rows get the
    same array each; an empty table stays empty; other columns pass through,
    one that is named ``into`` is replaced.
    """
    scanner: list[Scanner] = []

    @F.arrow_udf(SCHEMA)
    def find(texts: pa.Array) -> pa.Array:
        if not scanner:
            scanner.append(Scanner(classes, allowed, samples))
        rows = []
        for t in texts:
            t = t.as_py() or ""
            rows.append([{"kind": k, "start": a, "stop": b, "value": t[a:b]} for k, a, b in scanner[0](t)])
        return pa.array(rows, ARROW)

    return df.withColumn(into, find(F.col(f"`{text}`").cast("string")))
