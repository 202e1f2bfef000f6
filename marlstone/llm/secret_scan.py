"""Secret scans: fixed patterns, and sliding-window Shannon entropy per character class.

For each class (hexadecimal, alphanumeric, base64-like) the maximal runs of its characters are
candidates. A window slides over a candidate; the counts of its characters, and with them the
entropy, are updated by the one character that leaves and the one that enters. Windows at or
above the threshold of the class merge into spans of kind ``entropy``. Allow-listed candidates
(plain words and identifiers, UUIDs, dates and numbers, repeats) are left alone. Letters of one
case count as a word up to 30 letters; no shape tells a random key of such letters from a word.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "entropy")
#: A word: letters of one case, with a capital or not, or such words joined by capitals.
WORD = r"(?:[A-Z]?[a-z]{1,30}|[A-Z]{1,30}|[A-Z]?[a-z]{1,20}(?:[A-Z][a-z]{2,20}){1,8})"
#: A part of a path, name or date: a word, digits, a numbered word, a version, a time of day.
NAME = rf"(?:{WORD}|[0-9]{{1,12}}|[A-Za-z][a-z]{{2,30}}[0-9]{{1,4}}|v[0-9]{{1,2}}|[0-9]{{2}}T[0-9]{{2,6}}Z?)"


@dataclass(frozen=True)
class EntropyRules:
    window: int = 20
    #: name, characters of the class, least entropy in bits of a window
    classes: tuple = (("hex", "0-9a-fA-F", 3.0), ("alnum", "A-Za-z0-9", 3.6), ("base64", "A-Za-z0-9+/_=-", 3.8))
    allow: tuple = (
        r"[0-9]+",
        rf"[/_=+-]*{NAME}(?:[/_=+-]+{NAME})*[/_=+-]*",  # words, paths, names, dates
        r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",  # UUIDs
        r"(.{1,4})\1{4,}.{0,3}",  # repeats
    )
    #: Report only windows with both a digit and a letter; leaves out every key of letters alone.
    digit_and_letter: bool = False
    runs: tuple = field(init=False, default=())
    allowed: re.Pattern = field(init=False, default=None)

    def __post_init__(self):
        object.__setattr__(self, "runs", tuple((re.compile(f"(?<![{c}])[{c}]{{{self.window},}}"), least) for _, c, least in self.classes))
        object.__setattr__(self, "allowed", re.compile("|".join(f"(?:{p})" for p in self._numbered())))

    def _numbered(self):
        """The allow-list with each pattern's own group number in its back references."""
        seen, out = 0, []
        for p in self.allow:
            out.append(re.sub(r"\\(\d)", lambda m, n=seen: rf"\{int(m[1]) + n}", p))
            seen += re.compile(p).groups
        return out


def entropy_windows(s: str, window: int, least: float) -> list[tuple[int, int]]:
    """Merged [start, end) of the windows of ``s`` whose entropy is at least ``least`` bits."""
    if len(s) < window:
        return []
    term = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    counts: dict[str, int] = {}
    total = 0.0  # sum of c * log2(c)
    for ch in s[:window]:
        c = counts.get(ch, 0)
        total += term[c + 1] - term[c]
        counts[ch] = c + 1
    top, spans = math.log2(window), []
    for i in range(len(s) - window + 1):
        if i:
            c = counts[s[i - 1]]
            total += term[c - 1] - term[c]
            counts[s[i - 1]] = c - 1
            c = counts.get(s[i + window - 1], 0)
            total += term[c + 1] - term[c]
            counts[s[i + window - 1]] = c + 1
        if top - total / window >= least - 1e-9:
            if spans and i <= spans[-1][1]:
                spans[-1] = (spans[-1][0], i + window)
            else:
                spans.append((i, i + window))
    return spans


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns in a whole text."""
    out = []
    if ":" in text or "=" in text:
        low = text.lower()
        if any(k in low for k in ASSIGN_WORDS):
            out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    return out + [(m.start(), 2, m.end()) for m in HEX.finditer(text)]


def scan_text(text: str | None, rules: EntropyRules) -> tuple[list, list]:
    """(base spans, all spans) of one text, each sorted by start, then kind."""
    text = text or ""
    longest = max(map(len, text.split()), default=0)  # no candidate holds white space
    base = sorted(base_spans(text)) if longest >= 20 or ":" in text or "=" in text else []
    found = set()
    if longest >= rules.window:
        for pattern, least in rules.runs:
            for m in pattern.finditer(text):
                if not rules.allowed.fullmatch(m[0]):
                    for a, b in entropy_windows(m[0], rules.window, least):
                        s = m[0][a:b]
                        if not rules.digit_and_letter or (any(c.isdigit() for c in s) and any(c.isalpha() for c in s)):
                            found.add((m.start() + a, m.start() + b))
    merged: list[list[int]] = []
    for a, b in sorted(found):  # the classes overlap
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    return base, sorted(base + [(a, 3, b) for a, b in merged])


def _said(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def secret_scan(docs: DataFrame, rules: EntropyRules | None = None) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Spans are [start, end) in code points of the whole text. Null, empty and clean texts give
    zeros and an empty ``spans``. Repeated rows are each scanned, null ids are passed through,
    extra columns are ignored.
    """
    rules = rules or EntropyRules()

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for t in b.column(1):
                base, spans = scan_text(t.as_py(), rules)
                kinds = [k for _, k, _ in base]
                rows.append((kinds.count(0), kinds.count(1), kinds.count(2), hashlib.sha256(_said(base).encode()).hexdigest(), _said(spans)))
            counts = [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)]
            said = [pa.array([r[i] for r in rows], pa.string()) for i in (3, 4)]
            yield pa.RecordBatch.from_arrays([b.column(0), *counts, *said], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scanned, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
