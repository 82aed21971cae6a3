"""Secrets in texts, with multipart credentials linked.

Base spans are matches of three patterns, leftmost and not overlapping per
kind. Then weak parts, too common to report alone, are joined with their
complements: a bare 40-character key counts only near an access identifier, a
short secret or a login only near an endpoint or an identifier. Parts meet by
an interval join: each part's interval is widened to its scope (a paragraph),
or by ``reach`` code points inside it, and joined with the intervals it overlaps
by binary search over the sorted starts, so a text with many parts costs
n log n, not all pairs. Parts that overlap a base span are complements too, but
not reported again.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.text import by_bytes

#: Kinds in the order that breaks ties of their starts; the first three are the base.
KINDS = ("assign", "access", "hex", "key", "login", "short", "endpoint")
REACH = 200

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
# A run that is long enough is the same match with a least count: matches take whole runs.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
# A sentence may end after a key, and an assignment's '=' stand before it; '=' after it is padding.
_KEY = re.compile(r"(?<![A-Za-z0-9+/_.-])[A-Za-z0-9+/]{40}(?!\.*[A-Za-z0-9+/=_-])")
_LOGIN = re.compile(r"""(?:user(?:name)?|login|account)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,})""", re.I | re.A)
_ENDPOINT = re.compile(r"(?:https?|jdbc:[a-z]+|postgres(?:ql)?|mysql|redis|mongodb|amqp|ftp|ssh|s3)://[^\s\"'<>]{4,}", re.A)
_SCOPE = re.compile(r"\n[\x20\t]*\n")
#: Weak kinds and the kinds of which one must be near.
COMPLEMENTS = {"key": ("access",), "login": ("assign", "short"), "short": ("endpoint", "login", "access"), "endpoint": ("assign", "short", "key")}


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the three patterns."""
    out = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        out += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text)]
    out += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def _weak(text: str, base: list[tuple[int, int, str]]) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """All weak parts, and those that do not overlap a base span."""
    out = []
    low = text.lower()
    if any(k == "access" for _, _, k in base):
        out += [(m.start(), m.end(), "key") for m in _KEY.finditer(text)]
    if any(w in low for w in _WORDS):
        out += [(m.start(), m.end(), "short") for m in _ASSIGN.finditer(text) if 4 <= m.end(2) - m.start(2) < 12]
    if "user" in low or "login" in low or "account" in low:
        out += [(m.start(), m.end(), "login") for m in _LOGIN.finditer(text)]
    if "://" in text:
        out += [(m.start(), m.end(), "endpoint") for m in _ENDPOINT.finditer(text)]
    ends, most = [], 0
    for _, e, _ in base:
        most = max(most, e)
        ends.append(most)
    starts = [s for s, _, _ in base]

    def free(s: int, e: int) -> bool:
        i = bisect_left(starts, e) - 1
        return i < 0 or ends[i] <= s

    return out, [x for x in out if free(x[0], x[1])]


def linked_spans(text: str, reach: int | None = REACH) -> list[tuple[int, int, str]]:
    """All spans: the base ones, and weak parts with a complement in reach and scope
    (anywhere in the scope if reach is None).

    Weak parts count as complements only when they may be one; a weak pair
    (login and short secret, say) reports both.
    """
    base = base_spans(text)
    every, weak = _weak(text, base)
    if not weak:
        return base
    borders = [m.start() for m in _SCOPE.finditer(text)]
    by: dict[str, list[tuple[int, int]]] = {}
    for s, e, k in sorted(base + every):
        by.setdefault(k, []).append((s, e))
    # Spans of a kind do not overlap, so both their starts and their ends ascend.
    starts = {k: [s for s, _ in v] for k, v in by.items()}
    ends = {k: [e for _, e in v] for k, v in by.items()}

    def near(s: int, e: int, kind: str) -> bool:
        if kind not in by:
            return False
        i = bisect_right(borders, s)
        lo = borders[i - 1] if i else 0
        j = bisect_left(borders, e)
        hi = borders[j] if j < len(borders) else len(text)
        if reach is not None:
            lo, hi = max(s - reach, lo), min(e + reach, hi)
        a = bisect_right(ends[kind], lo)
        return a < len(ends[kind]) and starts[kind][a] < hi

    found = [x for x in weak if any(near(x[0], x[1], k) for k in COMPLEMENTS[x[2]])]
    return sorted(base + found, key=lambda s: (s[0], KINDS.index(s[2])))


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with every span, overlapping ones as one, replaced by [SECRET]."""
    out, at = [], 0
    merged: list[list[int]] = []
    for s, e, _ in spans:
        if merged and s < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    for s, e in merged:
        out += [text[at:s], "[SECRET]"]
        at = e
    return "".join([*out, text[at:]])


def _scan(reach: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", 1 << 21):
            rows = []
            for x in batch.column("text"):
                spans = linked_spans(x.as_py() or "", reach)
                base = [s for s in spans if s[2] in KINDS[:3]]
                n = [sum(s[2] == k for s in base) for k in KINDS[:3]]
                rows.append((*n, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans)))
            a, b, c, sha, every = zip(*rows, strict=True) if rows else ((),) * 5
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.int64()), pa.array(sha, pa.string()), pa.array(every, pa.string())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    return run


def scan(docs: DataFrame, reach: int | None = None) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) per row of docs.

    Null text counts as empty: no spans, the hash of the empty string. Repeated
    rows are scanned each; other columns are ignored. Parts are linked within their
    whole scope unless ``reach`` is given. One pass, no shuffle.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _scan(reach), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )


def _redacted(reach: int | None):
    def run(texts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(texts, "text", 1 << 21):
            new = [None if (t := x.as_py()) is None else redact(t, linked_spans(t, reach)) for x in batch.column("text")]
            i = batch.schema.get_field_index("text")
            yield batch.set_column(i, batch.schema.field(i), pa.array(new, batch.schema.field(i).type))

    return run


def redact_secrets(docs: DataFrame, reach: int | None = None) -> DataFrame:
    """docs with all spans in text replaced; n_chars, if there, follows. Texts without secrets, and nulls, stay as they are."""
    out = docs.mapInArrow(_redacted(reach), docs.schema)
    return out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.char_length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
