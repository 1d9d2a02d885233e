"""Secret scan over a trigram inverted index.

Each rule's regex is turned into a Boolean trigram query: literal runs that every
match must hold (alternatives and optional characters are written out) give
trigrams joined by AND, alternatives are joined by OR. ``[0-9a-f]+`` and the like
hold no mandatory trigram; such rules scan fully.

The index is segmented: every piece of an Arrow batch (1 MB of texts, one text at least) is one segment with its
own postings (trigram -> rows of the segment, over case-folded bytes), limited
to the trigrams that the rules' queries name. A rule's query intersects and
unites postings; only the rows that remain are verified with the regex. Segments
need no shuffle, hold a bounded number of rows, and are rebuilt alone if
their executor is lost; a hot source or a group of copies is just more segments.

Defined results: a null text counts as empty and has no spans; offsets are code
points, end exclusive; spans are ordered by start, then kind as listed, then end;
repeated rows are scanned row by row; an empty table gives an empty table;
clashing extra columns are harmless (only the id and the text are read).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rtdw.llm.common import pieces

TRIGRAM = 3
MOST_STRINGS = 64
BLOCK = 1 << 20         # bytes of a segment that are looked up at a time


@dataclass(frozen=True)
class Rule:
    kind: str
    regex: str
    ignore_case: bool = False
    group: int = 0        # the group whose length counts
    at_least: int = 0     # shortest length of that group
    span: int = 0         # the group that is the span
    base: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.regex, re.ASCII | (re.IGNORECASE if self.ignore_case else 0))


# The three base kinds first, then well-known credential formats.
RULES = (
    Rule("assign", r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
         ignore_case=True, group=2, at_least=6, base=True),
    Rule("access", r"AKIA[A-Z0-9]+", at_least=20, base=True),
    Rule("hex", r"[0-9a-f]+", at_least=24, base=True),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]+"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("bearer", r"authorization:\x20*bearer\x20+[A-Za-z0-9._~+/=-]{16,}", ignore_case=True),
    # tried once per run of scheme characters; the scheme begins at its first letter
    Rule("url_login", r"(?<![a-z0-9+.-])[0-9+.-]*+([a-z][a-z0-9+.-]*+://[^\x20\x09-\x0D/:@]+:[^\x20\x09-\x0D/:@]+@)",
         span=1),
)


# ---------------------------------------------------------------- trigram queries
# A query is True (no condition), a trigram (bytes), ("and", ...) or ("or", ...).

def _all(parts: list) -> object:
    parts = [p for p in dict.fromkeys(parts) if p is not True]
    return True if not parts else parts[0] if len(parts) == 1 else ("and", *parts)


def _any(parts: list) -> object:
    parts = list(dict.fromkeys(parts))
    return True if True in parts or not parts else parts[0] if len(parts) == 1 else ("or", *parts)


def _of_string(s: str) -> object:
    b = s.lower().encode()
    return _all([b[i:i + TRIGRAM] for i in range(len(b) - TRIGRAM + 1)])


def _of_strings(strings: set[str]) -> object:
    return _any([_of_string(s) for s in sorted(strings)])


def _strings(op: str, arg) -> set[str] | None:
    """The strings a node can match when they are few, else None."""
    if op == "LITERAL":
        return {chr(arg)} if arg < 128 else None
    if op == "IN":
        chars = {chr(v) for o, v in arg if str(o) == "LITERAL" and v < 128}
        return chars if len(chars) == len(arg) <= 8 else None
    if op == "SUBPATTERN":
        return _sequence_strings(arg[3])
    if op == "BRANCH":
        each = [_sequence_strings(x) for x in arg[1]]
        return None if any(x is None for x in each) else set().union(*each)
    if op in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
        low, high, item = arg
        inner = _sequence_strings(item)
        if inner is None or int(high) > 1:
            return None
        return inner | {""} if low == 0 else inner
    return None


def _sequence_strings(items) -> set[str] | None:
    out = {""}
    for op, arg in items:
        s = _strings(str(op), arg)
        if s is None or len(out) * len(s) > MOST_STRINGS:
            return None
        out = {a + b for a in out for b in s}
    return out


def _sequence_query(items) -> object:
    run, parts = {""}, []
    for op, arg in items:
        op = str(op)
        s = _strings(op, arg)
        if s is not None and len(run) * len(s) <= MOST_STRINGS:
            run = {a + b for a in run for b in s}
            continue
        parts.append(_of_strings(run))
        run = {""}
        if s is not None:
            run = s
        elif op == "SUBPATTERN":
            parts.append(_sequence_query(arg[3]))
        elif op == "BRANCH":
            parts.append(_any([_sequence_query(x) for x in arg[1]]))
        elif op in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT") and arg[0] >= 1:
            parts.append(_sequence_query(arg[2]))
    return _all([*parts, _of_strings(run)])


def trigram_query(regex: str) -> object:
    """The Boolean trigram query of a regex (True: nothing is mandatory)."""
    return _sequence_query(re._parser.parse(regex, re.ASCII))


def trigrams_of(query: object) -> set[bytes]:
    if query is True:
        return set()
    if isinstance(query, bytes):
        return {query}
    return set().union(*(trigrams_of(q) for q in query[1:]))


# ---------------------------------------------------------------- one segment

_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32


def postings(texts: list[bytes], wanted: list[bytes]) -> dict[bytes, np.ndarray]:
    """Rows of the segment that hold each wanted trigram (sorted, distinct)."""
    none = np.empty(0, np.int64)
    if not texts or not wanted:
        return {t: none for t in wanted}
    # one text after another, parted by a byte that no trigram holds
    raw = np.frombuffer(b"\xff".join(texts), np.uint8)
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    ends = np.cumsum(lengths)
    known = np.zeros(1 << 24, np.uint8)
    for i, t in enumerate(wanted):
        known[(t[0] << 16) | (t[1] << 8) | t[2]] = i + 1
    found: list[list[np.ndarray]] = [[none] for _ in wanted]
    for start in range(0, len(raw) - TRIGRAM + 1, BLOCK):
        data = _FOLD[raw[start:start + BLOCK + TRIGRAM - 1]]
        which = known[(data[:-2] << 16) | (data[1:-1] << 8) | data[2:]]
        at = np.flatnonzero(which)
        which, rows = which[at], np.searchsorted(ends, at + start, side="right")
        for i in np.unique(which):
            found[i - 1].append(np.unique(rows[which == i]))
    return {t: np.unique(np.concatenate(f)) for t, f in zip(wanted, found)}


def matching(query: object, index: dict[bytes, np.ndarray], n: int) -> np.ndarray:
    """Rows of a segment of ``n`` that satisfy a query."""
    if query is True:
        return np.arange(n)
    if isinstance(query, bytes):
        return index[query]
    parts = [matching(q, index, n) for q in query[1:]]
    out = parts[0]
    for p in parts[1:]:
        out = np.intersect1d(out, p, assume_unique=True) if query[0] == "and" else np.union1d(out, p)
    return out


def spans_of(texts: list[str], rules=RULES) -> list[list[tuple[int, int, int]]]:
    """Spans (start, rule number, end) of every text of one segment."""
    queries = [trigram_query(r.regex) for r in rules]
    wanted = sorted(set().union(*(trigrams_of(q) for q in queries)))
    index = postings([t.encode("utf-8", "replace") for t in texts], wanted)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for k, (rule, query) in enumerate(zip(rules, queries)):
        pattern = rule.compiled()
        for row in matching(query, index, len(texts)):
            found[row].extend((m.start(rule.span), k, m.end(rule.span)) for m in pattern.finditer(texts[row])
                              if len(m[rule.group]) >= rule.at_least)
    for f in found:
        f.sort()
    return found


def scanner(rules=RULES) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, 1):
            texts = [t or "" for t in b.column(1).to_pylist()]
            found = spans_of(texts, rules)
            yield pa.RecordBatch.from_arrays([
                b.column(0),
                pa.array([[s for s, _, _ in f] for f in found], pa.list_(pa.int64())),
                pa.array([[e for _, _, e in f] for f in found], pa.list_(pa.int64())),
                pa.array([[rules[k].kind for _, k, _ in f] for f in found], pa.list_(pa.string())),
                pa.array([[t[s:e] for s, _, e in f] for t, f in zip(texts, found)], pa.list_(pa.string())),
            ], ["doc_id", "starts", "ends", "kinds", "secrets"])
    return scan_batches


def scan(docs: DataFrame, rules=RULES) -> DataFrame:
    """(doc_id, starts, ends, kinds, secrets), parallel arrays, for every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", docs["text"].cast("string").alias("text")).mapInArrow(
        scanner(rules),
        f"doc_id {kind}, starts array<long>, ends array<long>, kinds array<string>, secrets array<string>")
