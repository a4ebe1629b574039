"""Secrets in texts: fixed patterns, and runs of high entropy that no pattern names.

The second kind slides a window over every candidate string, once for each character class; the
entropy of the window follows from counts that change by one character in and one out. Windows
above the threshold of their class are joined to spans, unless the candidate is on the allow list.

Defined cases: an absent or empty text has no spans; repeated rows are returned as often as they
occur; no rows give no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import log2

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds in the order in which equal starts are listed.
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = re.compile(
    r"((?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # whole runs, for a longer run has no earlier start
MIN_ASSIGNED, MIN_ACCESS = 6, 20

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
WINDOW = 20
#: Class, its characters, and the bits a character that a window must reach (a window of 20
#: different characters has 4.32).
CLASSES = (
    ("hex", re.compile(r"[0-9A-Fa-f]{20,}"), 3.3),
    ("alphanumeric", re.compile(r"[A-Za-z0-9]{20,}"), 3.8),
    ("base64", re.compile(r"[A-Za-z0-9+/_=-]{20,}"), 3.9),
)
#: Candidates that are known not to be secret. Patterns have one way to match a text, as candidates
#: may be of any length.
ALLOWED = (
    re.compile(r"[a-z]+|[A-Z]+|[A-Z]?[a-z]+([-_/=+][A-Z]?[a-z]+)*"),  # words, also joined
    re.compile(r"[0-9+/_=-]+"),  # numbers, rulers, phone numbers
    re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"),  # identifiers
    re.compile(r"(.{1,4})\1{4,}.{0,4}"),  # one short piece again and again
)
#: Paths, when each of their pieces is a name: words (also run together), then a number.
PATH = re.compile(r"[\w=-]*(?:/[\w=-]*){2,}", re.A)
NAME = re.compile(r"(?:[A-Za-z]|(?:[A-Z]*+[a-z]{2,}+)*+(?:[A-Z]{2,}+)?+)\d{0,8}")
#: Text in front of a checksum, and of a part of an address.
CHECKSUM = re.compile(r"(?:sha(?:1|256|384|512)|md5)[-:=]\Z", re.A)
ADDRESS = re.compile(r"(?:https?|ftp)://(\S*)\Z", re.A)
LOGIN = re.compile(r"[^\s/?#@]*@")
HOOK = re.compile(r"hook", re.I)


def window_spans(run: str, bits: float, width: int = WINDOW) -> list[tuple[int, int]]:
    """Joined windows of `run` whose entropy reaches `bits`.

    The entropy is log2(width) - sum(c log2 c) / width; only the terms of the two characters
    that change are touched at each step.
    """
    if len(run) < width:
        return []
    term = [0.0, *(c * log2(c) for c in range(1, width + 1))]
    counts: dict[str, int] = {}
    for ch in run[:width]:
        counts[ch] = counts.get(ch, 0) + 1
    total = sum(term[c] for c in counts.values())
    most = (log2(width) - bits) * width
    spans: list[tuple[int, int]] = []
    for start in range(len(run) - width + 1):
        if start:
            out, new = run[start - 1], run[start + width - 1]
            total -= term[counts[out]] - term[counts[out] - 1]
            counts[out] -= 1
            held = counts.get(new, 0)
            total += term[held + 1] - term[held]
            counts[new] = held + 1
        if total <= most + 1e-9:
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], start + width)
            else:
                spans.append((start, start + width))
    return spans


def is_path(whole: str) -> bool:
    return bool(PATH.fullmatch(whole)) and all(NAME.fullmatch(x) for x in re.split(r"[/_=-]", whole))


def in_address(text: str, start: int, end: int) -> bool:
    """Whether the candidate is the host or page of an address: not its login, its query, a web hook,
    or a path with several pieces that are no names."""
    before = ADDRESS.search(text, max(0, start - 200), start)
    if not before:
        return False
    inside = before.group(1)
    if re.search(r"[?#]", inside) or ("/" not in inside and LOGIN.match(text, end)):
        return False
    path = inside + text[start:end]
    odd = sum(not all(NAME.fullmatch(x) for x in re.split(r"[._=-]", piece)) for piece in path.split("/")[1:])
    return odd < 2 and not HOOK.search(path)


def entropy_spans(text: str) -> list[tuple[int, int]]:
    found: list[tuple[int, int]] = []
    for candidate in CANDIDATE.finditer(text):
        whole, at = candidate.group(), candidate.start()
        mixed = sum((any(map(str.islower, whole)), any(map(str.isupper, whole)), any(map(str.isdigit, whole))))
        if mixed < 2 or is_path(whole) or any(a.fullmatch(whole) for a in ALLOWED):
            continue
        if CHECKSUM.search(text, max(0, at - 200), at) or in_address(text, at, candidate.end()):
            continue
        here = {
            (at + run.start() + a, at + run.start() + b)
            for _, characters, bits in CLASSES
            for run in characters.finditer(whole)
            if any(map(str.isdigit, run.group()))
            for a, b in window_spans(run.group(), bits)
        }
        for a, b in sorted(here):  # spans of the classes overlap; one span covers what touches
            if found and a <= found[-1][1]:
                found[-1] = (found[-1][0], max(b, found[-1][1]))
            else:
                found.append((a, b))
    return found


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Matches of the fixed patterns by start, then kind; a failing match still uses up its text."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= MIN_ASSIGNED]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return [(KINDS[kind], start, end) for start, kind, end in sorted(found)]


def all_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, base and entropy spans). What a base span covers is cut off the entropy spans."""
    base = base_spans(text)
    extra = []
    for start, end in entropy_spans(text):
        for s, e in sorted((s, e) for _, s, e in base if start < e and s < end):
            if start < s:
                extra.append(("entropy", start, s))
            start = max(start, e)
        if start < end:
            extra.append(("entropy", start, end))
    return base, sorted(base + extra, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        base, spans = [], []
        for text in batch.column("text").to_pylist():
            b, s = all_spans(text or "")
            base.append([dict(zip(("kind", "start", "end"), x)) for x in b])
            spans.append([dict(zip(("kind", "start", "end"), x)) for x in s])
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(base, kind), pa.array(spans, kind)], names=["id", "base", "spans"]
        )


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, base, spans): spans of every whole text in code points, end exclusive. No shuffle."""
    named = docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"))
    span = "array<struct<kind: string, start: long, end: long>>"
    kind = dict(named.dtypes)["id"]
    return named.mapInArrow(scan_batches, f"id {kind}, base {span}, spans {span}")


def count_kind(column: str, kind: str) -> Column:
    return F.size(F.filter(column, lambda s: s["kind"] == kind)).cast("long")


def joined(column: str) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
