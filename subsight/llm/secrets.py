"""Secret scan: credential patterns plus windows of high character entropy.

A candidate string is a maximal run of characters of one class.  A window of
fixed length slides over it; the counts of its characters, and with them the
Shannon entropy, are updated for the one character that enters and the one
that leaves.  Windows at or above the class's limit are merged into spans.  An
allow-list takes out what is random by design but no secret.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subsight.llm.text import pieces

SPAN_TYPE = "array<struct<kind:string,start:bigint,end:bigint>>"

_ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# runs are maximal either way, so the lower bound drops the same matches
_HEX = re.compile(r"[0-9a-f]{24,}")
# one of these is in every assignment; they are much faster to look for
_ASSIGN_PARTS = ("passw", "secret", "token", "key")


@dataclass(frozen=True)
class EntropyClass:
    """Candidates of one alphabet; ``limit`` is in bits per character."""

    kind: str
    alphabet: str
    window: int
    limit: float
    # a run without these is a word or a number, not a key
    needs: tuple[str, ...] = ()


ENTROPY_CLASSES = (
    EntropyClass("entropy_hex", "0-9A-Fa-f", 20, 3.0, (r"[0-9]", r"[A-Fa-f]")),
    EntropyClass("entropy_base64", "A-Za-z0-9+/_=-", 20, 3.7, (r"[0-9]", r"[A-Za-z]")),
)

#: Full matches of the run around a span: UUIDs, dates with times, and
#: placeholders.
ALLOWED = (
    r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}",
    r"[0-9]{4}-[0-9]{2}-[0-9]{2}[T_-][0-9-]+Z?",
    r"(?i).*(example|placeholder|changeme|xxxxxx|redacted).*",
    r"(?i)[0a]?123456789(abcdef.*|0.*)?",
)
#: What may stand right before a span that is a checksum; any blanks count as one space.
ALLOWED_BEFORE = (r"(?i)(sha-?(1|256|384|512)|md5|integrity|etag)[\"']?[:=-] ?[\"']?$",)
#: A span that begins inside the group of one of these is part of an address.
ALLOWED_INSIDE = (r"https?://(\S*)",)
#: Characters before a span that ``ALLOWED_BEFORE`` is matched on; its names are shorter.
_LOOK_BACK = 40


@dataclass(frozen=True)
class Scanner:
    """Compiled rules; ``spans`` works on one text."""

    classes: Sequence[EntropyClass] = ENTROPY_CLASSES
    allowed: Sequence[str] = ALLOWED
    allowed_before: Sequence[str] = ALLOWED_BEFORE
    allowed_inside: Sequence[str] = ALLOWED_INSIDE
    _runs: list = field(default_factory=list)

    def __post_init__(self):
        for c in self.classes:
            run = re.compile(f"[{c.alphabet}]{{{c.window},}}")
            self._runs.append((c, run, [re.compile(n) for n in c.needs]))
        object.__setattr__(self, "_allowed", [re.compile(a) for a in self.allowed])
        object.__setattr__(self, "_before", [re.compile(a) for a in self.allowed_before])
        object.__setattr__(self, "_inside", [re.compile(a) for a in self.allowed_inside])

    def patterns(self, text: str) -> list[tuple[int, int, int]]:
        """(start, order of the kind, end) of the credential patterns."""
        found = []
        low = text.lower()
        if any(p in low for p in _ASSIGN_PARTS):
            found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
        if "AKIA" in text:
            found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
        found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
        return found

    def entropy(self, text: str) -> list[tuple[int, int, int]]:
        found = []
        inside = sorted(m.span(1) for p in self._inside for m in p.finditer(text))
        for order, (kind, run, needs) in enumerate(self._runs, 3):
            for m in run.finditer(text):
                candidate = m.group()
                if not all(n.search(candidate) for n in needs):
                    continue
                if any(a.fullmatch(candidate) for a in self._allowed):
                    continue
                at = bisect_right(inside, (m.start(), len(text))) - 1
                if at >= 0 and m.start() <= inside[at][1]:
                    continue
                before = _before(text, m.start())
                if any(b.search(before) for b in self._before):
                    continue
                for start, end in dense_windows(candidate, kind.window, kind.limit):
                    if all(n.search(candidate, start, end) for n in needs):
                        found.append((m.start() + start, order, m.start() + end))
        return found

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """Sorted spans; entropy adds only what no other span already covers."""
        found = self.patterns(text)
        for start, order, end in self.entropy(text):
            if not any(s <= start and end <= e for s, _, e in found):
                found.append((start, order, end))
        return sorted(found)

    @property
    def kinds(self) -> list[str]:
        return ["assign", "access", "hex", *[c.kind for c in self.classes]]


def _before(text: str, start: int) -> str:
    """What stands before a span, blanks next to it or to its quote taken as one space."""
    quote = text[start - 1] if start and text[start - 1] in "\"'" else ""
    upto = end = start - len(quote)
    while upto and text[upto - 1].isspace():
        upto -= 1
    return text[max(0, upto - _LOOK_BACK) : upto] + (" " if upto < end else "") + quote


def dense_windows(candidate: str, window: int, limit: float) -> Iterator[tuple[int, int]]:
    """Merged windows whose entropy is ``limit`` or more.

    With counts n_c in a window of W characters the entropy is
    log2 W - (sum of n_c log2 n_c) / W; only that sum is kept, and one step
    changes two of its terms.
    """
    weight = [0.0] + [n * log2(n) for n in range(1, window + 1)]
    counts: dict[str, int] = {}
    total, most, opened, upto = 0.0, (log2(window) - limit) * window + 1e-9, -1, -1
    for i, entering in enumerate(candidate):
        n = counts.get(entering, 0)
        counts[entering] = n + 1
        total += weight[n + 1] - weight[n] if n < window else 0.0
        if i >= window:
            leaving = candidate[i - window]
            n = counts[leaving]
            counts[leaving] = n - 1
            total -= weight[n] - weight[n - 1] if n <= window else 0.0
        if i >= window - 1 and total <= most:
            first = i - window + 1
            if opened >= 0 and first > upto:
                yield opened, upto
                opened = -1
            if opened < 0:
                opened = first
            upto = i + 1
    if opened >= 0:
        yield opened, upto


def find_secrets(df: DataFrame, text: str = "text", out: str = "secrets", **rules) -> DataFrame:
    """Add an array of spans (kind, start, end in code points, end exclusive).

    One pass over each text, no shuffle.  NULL and empty texts have an empty
    array; rows, their order of columns and repeated rows stay as they are.  A
    column named like ``out`` is replaced.
    """
    columns = [c for c in df.columns if c != out]
    kept = df.select(*[f"`{c}`" for c in columns])
    spans_type = T.StructType().add(out, T.DataType.fromDDL(SPAN_TYPE)).fields
    schema = T.StructType([*kept.schema.fields, *spans_type])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(**rules)
        names = scanner.kinds
        kind_of = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            for piece in pieces(batch, text):
                spans = [
                    [{"kind": names[k], "start": s, "end": e} for s, k, e in scanner.spans(t)] if t else []
                    for t in piece.column(text).to_pylist()
                ]
                yield pa.RecordBatch.from_arrays(
                    [*piece.columns, pa.array(spans, pa.list_(kind_of))], names=[*columns, out]
                )

    return kept.mapInArrow(scan, schema)


def redact(df: DataFrame, text: str = "text", mask: str = "[secret]", **rules) -> DataFrame:
    """Replace every secret span of ``text`` by ``mask``; other texts stay.

    Overlapping spans are replaced once.  NULL stays NULL.
    """
    columns = df.columns
    at = columns.index(text)

    def clean(scanner: Scanner, value: str | None) -> str | None:
        if not value:
            return value
        parts, upto = [], 0
        for start, _, end in scanner.spans(value):
            if start >= upto:
                parts += [value[upto:start], mask]
            upto = max(upto, end)
        return "".join(parts) + value[upto:] if parts else value

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(**rules)
        for batch in batches:
            for piece in pieces(batch, text):
                values = [clean(scanner, t) for t in piece.column(text).to_pylist()]
                arrays = list(piece.columns)
                arrays[at] = pa.array(values, arrays[at].type)
                yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return df.mapInArrow(scan, df.schema)


def secret_digest(docs: DataFrame) -> DataFrame:
    """Counts and joined spans of each document, derived from :func:`find_secrets`."""
    base = F.array(F.lit("assign"), F.lit("access"), F.lit("hex"))
    rank = {k: i for i, k in enumerate(Scanner().kinds)}
    order = F.create_map(*[x for k, i in rank.items() for x in (F.lit(k), F.lit(i))])
    found = find_secrets(docs.select("doc_id", "text")).select("doc_id", "secrets")
    keyed = F.array_sort(
        F.transform(
            "secrets",
            lambda s: F.struct(s["start"].alias("s"), order[s["kind"]].alias("o"), s["kind"].alias("k"), s["end"].alias("e")),
        )
    )
    found = found.select("doc_id", keyed.alias("spans"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["k"], s["s"], s["e"])), ",")

    def of(kind):
        return F.size(F.filter("spans", lambda s: s["k"] == kind)).cast("bigint")

    patterns = F.filter("spans", lambda s: F.array_contains(base, s["k"]))
    return found.select(
        "doc_id",
        of("assign").alias("n_assign"),
        of("access").alias("n_access"),
        of("hex").alias("n_hex"),
        F.sha2(joined(patterns), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
