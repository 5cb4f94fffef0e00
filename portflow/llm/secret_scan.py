"""Secrets in texts: named assignments and known key forms, and strings whose characters look random.

Candidates are strings of one character class, as long as the window or longer. A window slides over each; one character enters
and one leaves per step, so its Shannon entropy follows from two changed counts. Windows at or above the class's entropy that
hold a letter and a digit are joined to spans. Spans inside a text that the allow-list matches are suppressed, and so are those
inside a span that a fixed pattern has found already; what the fixed patterns find always stays.

Entropies are compared as integers: a window of n characters has the entropy log2(n) - sum(c * log2(c)) / n over its character counts
c, so it is high enough if the sum of the costs c * log2(c), in units of 2**-20, is low enough.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portflow.llm.common import slices

# The patterns whose findings always stay.
ASSIGNMENT = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_VALUE = 6
MIN_ACCESS = 20
# A text in lower case without any of these has no assignment.
NAMES = ("passw", "secret", "token", "apikey", "api_key")

BASE_KINDS = ("assign", "access", "hex")

WINDOW = 24
UNIT = 1 << 20
# Class -> its characters, and the entropy in bits a window needs. All characters belong to the last class, too.
CLASSES = {
    "entropy_hex": ("0-9A-Fa-f", 3.0),
    "entropy_upper": ("0-9A-Z", 3.5),
    "entropy_base64": ("0-9A-Za-z+/_-", 4.0),
}
KINDS = (*BASE_KINDS, *CLASSES)

# What looks random but is no secret: ids, addresses up to their query, named digests, inline images, placeholders.
ALLOWED = (
    r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}",
    r"https?://[0-9A-Za-z.:/_~%+@-]+",
    r"(sha1|sha256|sha384|sha512|md5)[:-][0-9A-Za-z+/=]+",
    r"data:image/[a-z.+-]+;base64,[0-9A-Za-z+/=]+",
    r"[0-9A-Za-z+/_-]*(EXAMPLE|example|PLACEHOLDER|placeholder)[0-9A-Za-z+/_-]*",
)

BATCH_BYTES = 4 << 20
SPAN_TYPE = "array<struct<kind: string, start: bigint, end: bigint>>"
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

Span = tuple[str, int, int]


def costs(window: int = WINDOW) -> list[int]:
    """c * log2(c) for c = 0 ... window, in units."""
    return [0] + [round(c * math.log2(c) * UNIT) for c in range(1, window + 1)]


def cost_limit(bits: float, window: int = WINDOW) -> int:
    """The largest cost of a window that has an entropy of ``bits``."""
    return math.floor(window * (math.log2(window) - bits) * UNIT)


def base_spans(text: str) -> list[Span]:
    found = []
    lower = text.lower()
    if any(name in lower for name in NAMES):
        found += [("assign", m.start(), m.end()) for m in ASSIGNMENT.finditer(text) if len(m[2]) >= MIN_VALUE]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    return found + [("hex", m.start(), m.end()) for m in HEX.finditer(text)]


def high_entropy(text: str, bits: float, window: int = WINDOW) -> list[tuple[int, int]]:
    """The joined windows of a candidate that reach ``bits`` and hold an ASCII letter and a digit."""
    cost, limit = costs(window), cost_limit(bits, window)
    counts: dict[str, int] = {}
    total = digits = letters = 0
    spans: list[tuple[int, int]] = []
    for i, char in enumerate(text):
        n = counts.get(char, 0)
        counts[char] = n + 1
        total += cost[n + 1] - cost[n]
        digits += char.isdigit()
        letters += char.isalpha()
        if i >= window - 1:
            start = i - window + 1
            if total <= limit and digits and letters:
                if spans and spans[-1][1] >= start:
                    spans[-1] = (spans[-1][0], i + 1)
                else:
                    spans.append((start, i + 1))
            old = text[start]
            n = counts[old]
            counts[old] = n - 1
            total -= cost[n] - cost[n - 1]
            digits -= old.isdigit()
            letters -= old.isalpha()
    return spans


class Scanner:
    """All spans of a text, by start, then kind."""

    def __init__(self, window: int = WINDOW, allowed: Sequence[str] = ALLOWED) -> None:
        self.window = window
        widest = list(CLASSES.values())[-1][0]
        self.candidates = re.compile(f"[{widest}]{{{window},}}")
        self.classes = [(kind, re.compile(f"[{chars}]{{{window},}}"), bits) for kind, (chars, bits) in CLASSES.items()]
        self.allowed = [re.compile(pattern) for pattern in allowed]

    def random_spans(self, text: str) -> list[Span]:
        """Spans of high entropy, before any is suppressed."""
        found = []
        for candidate in self.candidates.finditer(text):
            for kind, pattern, bits in self.classes:
                for run in pattern.finditer(candidate[0]):
                    offset = candidate.start() + run.start()
                    found += [(kind, offset + a, offset + b) for a, b in high_entropy(run[0], bits, self.window)]
        return found

    def spans(self, text: str) -> list[Span]:
        base = base_spans(text)
        added = self.random_spans(text)
        if added:
            quiet = [(m.start(), m.end()) for pattern in self.allowed for m in pattern.finditer(text)]
            added = outside(added, quiet + [(start, end) for _, start, end in base])
        return sorted(base + added, key=lambda span: (span[1], KINDS.index(span[0])))


def outside(spans: list[Span], covers: list[tuple[int, int]]) -> list[Span]:
    """The spans that lie within none of ``covers``."""
    covers = sorted(covers)
    starts = np.array([start for start, _ in covers], np.int64)
    reach = np.maximum.accumulate(np.array([end for _, end in covers], np.int64)) if covers else starts
    kept = []
    for span in spans:
        before = int(np.searchsorted(starts, span[1], side="right"))
        if not before or reach[before - 1] < span[2]:
            kept.append(span)
    return kept


def secret_spans(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, allowed: Sequence[str] = ALLOWED
) -> DataFrame:
    """(doc_id, spans) for every row of ``docs``; a span has a kind, a start and an exclusive end in code points.

    Spans are ordered by start, then kind: ``assign``, ``access``, ``hex``, then one kind per class of random strings. Nothing is
    shuffled and no text is cut. Null counts as the empty text, which has no spans. Repeated ids and rows give a row
    each; a null id stays null; an empty table gives no rows. Other columns, whatever their names, have no influence.
    """
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    schema = f"doc_id {chosen.schema['doc_id'].dataType.simpleString()}, spans {SPAN_TYPE}"
    allowed = tuple(allowed)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(window, allowed)
        for batch in batches:
            sizes = np.array([len(value) for value in (x.as_buffer() for x in batch["text"])], np.int64)
            for start, stop in slices(sizes, BATCH_BYTES):
                part = batch.slice(start, stop - start)
                rows = [
                    [dict(zip(("kind", "start", "end"), span)) for span in scanner.spans(data.decode("utf-8", "replace"))]
                    for data in part["text"].to_pylist()
                ]
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(rows, pa.list_(_SPAN))], ["doc_id", "spans"])

    return chosen.mapInArrow(scan, schema)


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(parts, ",")
