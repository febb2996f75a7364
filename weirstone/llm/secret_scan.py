"""Secrets in texts: fixed patterns, and sliding-window entropy over candidate strings.

``scan(df)`` adds ``secrets``, an array of (kind, start, end) in code points,
end exclusive, by start and then kind in the order of KINDS. Three kinds are
patterns; the last two come from the entropy of windows:

* candidates are maximal runs of the characters keys are written with;
* each window of ``window`` characters is judged by its Shannon entropy, in its
  own class: hexadecimal inside a run of hexadecimal digits of one case, a letter
  among them, wherever in the candidate the run stands; else base 64, which needs
  an upper-case letter, a lower-case letter and a digit in the window, so that
  words and paths of words are none. Moving a window by one changes two counts,
  so the sum of c log c is updated, not recomputed;
* overlapping windows of a class above its threshold join into one span;
* the allow-list takes back the windows that overlap what looks random and is not
  secret: placeholders, alphabets and other runs of consecutive characters, UUIDs,
  and strings the caller names. The other windows of the candidate are judged.

Defined results: null and empty texts hold no secrets. Extra columns stay; a
column named ``secrets`` is replaced. Each row is judged alone, so repeated
rows repeat their result. Texts are scanned whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")
SECRETS = ArrayType(
    StructType(
        [StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType())]
    )
)

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
# With the least length inside the pattern: runs are maximal, so the same matches are left.
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
HEX_RUNS = (re.compile(r"[0-9a-f]+"), re.compile(r"[0-9A-F]+"))

ALLOW = tuple(
    re.compile(p)
    for p in (
        r"(?i)example|sample|placeholder|changeme|dummy|your[-_]?(?:key|token|secret)",
        r"(?<![0-9A-Za-z])[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?![0-9A-Za-z])",
        r"(?i)0123456789|abcdefghij|qwertyuiop",
    )
)

_CLOGC = [0.0] + [c * math.log2(c) for c in range(1, 4096)]


def _entropies(text: str, window: int) -> Iterator[float]:
    """Entropy in bits per character of each window, from counts that move with it."""
    counts: dict[str, int] = {}
    total = 0.0
    whole = math.log2(window)
    for i, new in enumerate(text):
        c = counts.get(new, 0)
        counts[new] = c + 1
        total += _CLOGC[c + 1] - _CLOGC[c]
        if i >= window:
            old = text[i - window]
            c = counts[old]
            counts[old] = c - 1
            total += _CLOGC[c - 1] - _CLOGC[c]
        if i >= window - 1:
            yield whole - total / window


def _mixed(text: str) -> bool:
    return any(c.isupper() for c in text) and any(c.islower() for c in text) and any(c.isdigit() for c in text)


def _mark(windows: bytearray, start: int, end: int) -> None:
    start, end = max(start, 0), min(end, len(windows))
    if start < end:
        windows[start:end] = b"\1" * (end - start)


def entropy_spans(
    text: str, window: int = 20, hex_bits: float = 3.0, base64_bits: float = 3.8, allow: Iterable[re.Pattern] = ALLOW
) -> Iterator[tuple[str, int, int]]:
    for found in CANDIDATE.finditer(text):
        candidate = found[0]
        windows = max(len(candidate) - window + 1, 0)
        hexadecimal = bytearray(windows)
        for runs in HEX_RUNS:
            for run in runs.finditer(candidate):
                if len(run[0]) >= window and not run[0].isdigit():
                    _mark(hexadecimal, run.start(), run.end() - window + 1)
        if not (any(hexadecimal) or _mixed(candidate)):
            continue
        allowed = bytearray(windows)
        for pattern in allow:
            for match in pattern.finditer(candidate):
                _mark(allowed, match.start() - window + 1, match.end())
        open_spans: dict[str, tuple[int, int]] = {}
        for at, entropy in enumerate(_entropies(candidate, window)):
            kind, bits = ("entropy_hex", hex_bits) if hexadecimal[at] else ("entropy_base64", base64_bits)
            if entropy < bits or allowed[at] or not (hexadecimal[at] or _mixed(candidate[at : at + window])):
                continue
            start, end = open_spans.get(kind, (at, at))
            if at > end:
                yield kind, found.start() + start, found.start() + end
                start = at
            open_spans[kind] = start, at + window
        for kind, (start, end) in open_spans.items():
            yield kind, found.start() + start, found.start() + end


def spans(text: str, **entropy) -> list[tuple[str, int, int]]:
    """All spans of one text, by start and then kind."""
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [("access", *m.span()) for m in ACCESS.finditer(text)]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    out += entropy_spans(text, **entropy)
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def scan(df: DataFrame, text: str = "text", window: int = 20, hex_bits: float = 3.0, base64_bits: float = 3.8,
         allow: tuple[str, ...] = ()) -> DataFrame:
    """The rows with ``secrets``. ``allow`` adds patterns to the allow-list of the entropy kinds."""
    if not 2 <= window < len(_CLOGC):
        raise ValueError(f"a window of 2 to {len(_CLOGC) - 1} characters is asked for, not {window}")

    @F.udf(SECRETS, useArrow=True)
    def found(value: str | None) -> list[tuple[str, int, int]]:
        patterns = (*ALLOW, *map(re.compile, allow))
        return spans(value or "", window=window, hex_bits=hex_bits, base64_bits=base64_bits, allow=patterns)

    return df.withColumn("secrets", found(F.col(f"`{text}`")))


def redacted(value: str, found: list[tuple[str, int, int]], mark: str = "<SECRET>") -> str:
    """The text with each run of overlapping spans replaced by one mark."""
    out, at = [], 0
    for _, start, end in found:
        if start >= at:
            out += [value[at:start], mark]
        at = max(at, end)
    return "".join(out) + value[at:]


def redact(df: DataFrame, text: str = "text", mark: str = "<SECRET>") -> DataFrame:
    """The rows with their secrets replaced by ``mark``; a text without secrets, null too, stays as it is."""
    names, schema = df.columns, df.schema

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(names.index(text))
            texts = column.to_pylist()
            done = [t if not t or not (s := spans(t)) else redacted(t, s, mark) for t in texts]
            columns = list(batch.columns)
            columns[names.index(text)] = pa.array(done, column.type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return df.mapInArrow(replace, schema)
