"""Secret scans: base patterns, and password guess-cost dynamic programming.

Three patterns find the base spans. The method then looks at values in a credential context
(a credential word and an assignment, a bearer header, the password of a URL) and estimates
how many guesses an attacker needs: the cheapest segmentation of the value into dictionary
words, dates, repeats, keyboard walks and brute-force spans. Values that cost at least
``MIN_BITS`` are secrets; cheap ones (placeholders, plain words) are not.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from math import lgamma, log, log2

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from revlens.llm.common import map_arrow, rows_of, table

# The base patterns.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "guess")

# Credential contexts: what comes before a value, and the value.
CONTEXTS = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|api[_\x20-]?key|access[_\x20-]?key"""
    r"""|private[_\x20-]?key|auth(?:orization)?|client[_\x20-]?secret)["']?\x20*(?::=|=>|[:=])\x20*"""
    r"""(?:bearer\x20+|basic\x20+)?(?:"([^"\n]{6,})"|'([^'\n]{6,})'|([^\s"',;<>]{6,}))"""
    r"""|\b(?:bearer|basic)\x20+([A-Za-z0-9+/_.=~-]{16,})"""
    r"""|[a-z][a-z0-9+.-]{1,20}://[^\s/:@]{1,128}:([^\s/@]{6,})@""",
    re.ASCII | re.IGNORECASE,
)
_HINTS = ("pass", "pwd", "secret", "token", "cred", "key", "auth", "bearer", "basic", "://")

# Guesses in bits from which a value counts as a secret.
MIN_BITS = 36.0

# Common words of passwords and placeholders, most common first.
WORDS = (
    "password pass admin welcome login user test secret token key master letmein qwerty hello love "
    "monkey dragon football baseball sunshine princess shadow superman michael summer winter spring "
    "autumn hunter access server root default change changeme example sample demo temp guest public "
    "private service account database client api auth value string none null true false your here "
    "insert enter replace placeholder redacted hidden required optional config setting environment "
    "variable the and for with this that from have not you are was but all can had her one our out"
).split()
RANKS = {word: rank for rank, word in enumerate(WORDS, 1)}
LONGEST = max(map(len, WORDS))
LEET = str.maketrans("@4831!|05$7+2", "aabeiiiosstt" + "z")
# Rows of a keyboard, unshifted and shifted.
ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
SHIFTED = ("~!@#$%^&*()_+", "QWERTYUIOP{}|", 'ASDFGHJKL:"', "ZXCVBNM<>?")
KEYS = {
    key: (row, column + row * 0.5)
    for rows in (ROWS, SHIFTED)
    for row, keys in enumerate(rows)
    for column, key in enumerate(keys)
}
DATE = re.compile(r"(\d{1,4})([-/._]?)(\d{1,2})\2(\d{1,4})", re.ASCII)
YEARS = range(1900, 2051)


def _alphabet(value: str) -> int:
    """Size of the alphabet that brute force has to try for a value."""
    size = 26 * any("a" <= c <= "z" for c in value) + 26 * any("A" <= c <= "Z" for c in value)
    size += 10 * any("0" <= c <= "9" for c in value) + 33 * any(c.isascii() and not c.isalnum() for c in value)
    return max(size + 100 * (not value.isascii()), 2)


def _word_bits(value: str) -> dict[tuple[int, int], float]:
    """Dictionary words, also reversed, with leet characters or capitals, by place."""
    found = {}
    lower = value.lower()
    plain = lower.translate(LEET)
    for start in range(len(value)):
        for end in range(start + 3, min(len(value), start + LONGEST) + 1):
            for text, extra in (
                (lower[start:end], 0.0),
                (plain[start:end], 1.0),
                (lower[start:end][::-1], 1.0),
            ):
                rank = RANKS.get(text)
                if rank:
                    part = value[start:end]
                    capitals = sum(c.isupper() for c in part)
                    shape = 0.0 if not capitals else 1.0 if part[0].isupper() and capitals in (1, len(part)) else float(capitals + 1)
                    bits = log2(rank + 1) + extra + shape
                    found[start, end] = min(bits, found.get((start, end), bits))
    return found


def _date_bits(value: str) -> dict[tuple[int, int], float]:
    """Dates in any order of day, month and year, with or without separators."""
    found = {}
    for start in range(len(value)):
        if not value[start].isdigit():
            continue
        for end in range(start + 4, min(len(value), start + 10) + 1):
            part = value[start:end]
            match = DATE.fullmatch(part)
            if part.isdecimal() and len(part) == 4 and part.isascii() and int(part) in YEARS:
                found[start, end] = log2(len(YEARS))
            elif match and _is_date(match[1], match[3], match[4]):
                found[start, end] = log2(len(YEARS) * 366) + (2.0 if match[2] else 0.0)
    return found


def _is_date(a: str, b: str, c: str) -> bool:
    orders = ((a, b, c), (c, b, a), (c, a, b))
    return any(
        len(y) in (2, 4) and (len(y) == 2 or int(y) in YEARS) and 1 <= int(m) <= 12 and 1 <= int(d) <= 31
        for y, m, d in orders
    )


def _walk_ends(value: str) -> list[int]:
    """For each place, where a walk over neighbouring keys from it ends."""
    ends = list(range(1, len(value) + 1))
    for i in range(len(value) - 2, -1, -1):
        here, there = KEYS.get(value[i]), KEYS.get(value[i + 1])
        if here and there and abs(here[0] - there[0]) <= 1 and abs(here[1] - there[1]) <= 1:
            ends[i] = ends[i + 1]
    return ends


def _run_ends(value: str) -> list[int]:
    """For each place, where a run with a constant step (0, 1 or -1) from it ends."""
    ends, steps = list(range(1, len(value) + 1)), [None] * len(value)
    for i in range(len(value) - 2, -1, -1):
        step = ord(value[i + 1]) - ord(value[i])
        if step in (0, 1, -1):
            ends[i], steps[i] = ends[i + 1] if steps[i + 1] in (None, step) else i + 2, step
    return ends


def _period(value: str) -> int | None:
    """The least period that fits at least twice, by the borders of all prefixes."""
    border = [0] * len(value)
    for i in range(1, len(value)):
        k = border[i - 1]
        while k and value[i] != value[k]:
            k = border[k - 1]
        border[i] = k + (value[i] == value[k])
    period = len(value) - border[-1]
    return period if 2 * period <= len(value) else None


def _orders(segments: int) -> float:
    """log2 of the number of orders of segments."""
    return lgamma(segments + 1) / log(2)


def guess_bits(value: str) -> float:
    """log2 of the guesses for ``value``: the cheapest segmentation, counted once per order.

    Dynamic programming over the end of the prefix and the number of segments; the cost is
    the product of the segments' guesses times the factorial of their number. A period that
    repeats costs its unit once and a count. Time is linear in the length: walks and runs are
    taken whole, and eight numbers of segments are kept per prefix.
    """
    if not value:
        return 0.0
    unit = _period(value)
    if unit:
        return guess_bits(value[:unit]) + log2(len(value) / unit + 1)
    per_character = log2(_alphabet(value))
    ending: dict[int, list[tuple[int, float]]] = {}
    for spans in (_word_bits(value), _date_bits(value)):
        for (start, end), bits in spans.items():
            ending.setdefault(end, []).append((start, bits))
    for ends, least, cost in ((_walk_ends(value), 4, 8.0), (_run_ends(value), 3, 6.0)):
        for start, end in enumerate(ends):
            if end - start >= least and (not start or ends[start - 1] != end):
                ending.setdefault(end, []).append((start, cost + log2(end - start)))
    # best[end]: segments to cheapest bits; brute-force spans extend one another for free.
    best: list[dict[tuple[int, bool], float]] = [{(0, False): 0.0}]
    for end in range(1, len(value) + 1):
        row: dict[tuple[int, bool], float] = {}
        for (count, brute), bits in best[end - 1].items():
            key = (count + (not brute), True)
            row[key] = min(row.get(key, 1e9), bits + per_character)
        for start, cost in ending.get(end, ()):
            for (count, _), bits in best[start].items():
                key = (count + 1, False)
                row[key] = min(row.get(key, 1e9), bits + cost)
        # Few segments suffice; with more, the factorial outweighs any gain.
        best.append(dict(sorted(row.items(), key=lambda x: x[1] + _orders(x[0][0]))[:8]))
    return min(bits + _orders(count) for (count, _), bits in best[-1].items())


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns, in order."""
    found = []
    lower = text.lower() if text.isascii() else text
    if not text.isascii() or "pass" in lower or "secret" in lower or "token" in lower or "api" in lower:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def added_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of costly values in credential contexts, but for those that lie in a base span.

    Each value is judged whole, blanks of quoted ones included, also where a base span ends
    within it; such spans overlap.
    """
    lower = text.lower()
    if not any(hint in lower for hint in _HINTS):
        return []
    found = []
    for match in CONTEXTS.finditer(text):
        start, end = next(match.span(g) for g in range(1, 6) if match[g] is not None)
        covered = any(s <= start and end <= e for s, _, e in base)
        if not covered and guess_bits(text[start:end]) >= MIN_BITS:
            found.append((start, 3, end))
    return found


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n_assign, n_access, n_hex, base_sha256, spans), one per row of ``docs``.

    Spans are kind:start:end in code points, end exclusive, by start and then kind (assign,
    access, hex, guess), joined by commas; a guess span may overlap base ones. A null text counts as empty. Rows are scanned each
    on their own, whole; other columns are ignored; an empty table gives no rows.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            counts, digests, spans = ([], [], []), [], []
            for text in batch.column(1).to_pylist():
                base = base_spans(text or "")
                for kind, of_kind in enumerate(counts):
                    of_kind.append(sum(k == kind for _, k, _ in base))
                digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                spans.append(_joined(base + added_spans(text or "", base)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *[pa.array(c, pa.int64()) for c in counts],
                    pa.array(digests, pa.string()),
                    pa.array(spans, pa.string()),
                ],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return map_arrow(docs.select("doc_id", "text"), scan, schema)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``scan_secrets`` over all documents."""
    return scan_secrets(table(spark, sf_dir, "documents"))


def mask_secrets(docs: DataFrame, mask: str = "[secret]") -> DataFrame:
    """``docs`` with every found span replaced by ``mask``; n_chars, if there, is counted anew.

    Overlapping spans are masked as one. Null texts stay null.
    """
    names, fields = docs.columns, docs.schema.fields

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index("text")
        for batch in rows_of(batches):
            texts = [None if t is None else mask_text(t, mask) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            if "n_chars" in names:
                n = names.index("n_chars")
                new = [len(t) if t is not None else old for t, old in zip(texts, columns[n].to_pylist(), strict=True)]
                columns[n] = pa.array(new, batch.schema.field(n).type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return map_arrow(docs, rewrite, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields))


def mask_text(text: str, mask: str) -> str:
    """A text with its secret spans masked."""
    base = base_spans(text)
    out, at = [], 0
    for start, _, end in sorted(base + added_spans(text, base)):
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])
