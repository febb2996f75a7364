"""Periodic runs of words in documents, and the documents with their repetitions collapsed.

A run is a stretch of consecutive words with smallest period q and a length of
at least max(12, 2q) that no neighbouring word extends keeping period q. Seen
from the period, it is a stretch of positions i with word i = word i + q: an
equality interval. These intervals are found tile by tile:

* Periods below 64: the words are cut into tiles of 65,536 positions, and each
  period is compared position by position. An interval that touches a tile's
  edge is kept however short.
* Periods G to 2G, G = 64, 128, ...: an interval that makes a run is at least G
  long, so it holds a whole block of m = G / 2 words that begins at a multiple
  of m. Each such boundary c has a tile of words from c - m to c + 3G. Periods
  q at which the block comes again at c + q are looked up among hashes of all
  m-grams (equal blocks have equal hashes, so none is missed); for those the
  tile's boundary Z-functions say how many words match onward from (c, c + q),
  up to G, and backward, up to m. The words themselves are compared.

The fragments are shuffled by document and period and stitched where they
touch. A block of smallest period p <= m / 2 comes again at every p-th word of
its own run; those shifts are multiples of p, hence no smallest periods, and
are dropped, and elsewhere in the tile the ends of the p-runs give the match
lengths. So a tile costs time in proportion to its words even if a document is
one word repeated. A multiple of a smallest period p > m / 2 gives the same
interval as p; the least period of an interval stays.

Words are runs of anything but space, tab, line feed, vertical tab, form feed
and carriage return. Defined results: null and empty texts have no words and
no runs; rows with the same id or text are judged each; a null id stays null;
an empty table gives an empty table; extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from weirstone.llm.runtime import stored
from weirstone.llm.textbytes import mix

LEAST = 12
OCTAVE = 64
TILE = 1 << 16
BATCH_WORDS = 1 << 15
COMPARED = 1 << 22

Rewrite = Callable[[object, list[bytes]], list[bytes]]
Fragment = tuple[np.ndarray, np.ndarray, np.ndarray]  # positions from, to (exclusive), period


def _numbers(words: list[bytes]) -> np.ndarray:
    table = {word: i for i, word in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(table.__getitem__, words), np.int32, len(words))


def _short_periods(a: np.ndarray) -> Iterator[Fragment]:
    """Equality intervals of periods below OCTAVE that are long enough or touch a tile's edge."""
    for low in range(0, len(a), TILE):
        size = min(TILE, len(a) - low)
        inner = low + size < len(a)
        for q in range(1, OCTAVE):
            n = min(size, len(a) - low - q)
            if n <= 0:
                break
            need = max(LEAST - q, q)
            equal = a[low : low + n] == a[low + q : low + q + n]
            at = np.flatnonzero(equal)
            long = len(at) >= need and bool((at[need - 1 :] - at[: len(at) - need + 1] == need - 1).any())
            if not (long or len(at) and (low and equal[0] or inner and equal[-1])):
                continue
            cut = np.flatnonzero(np.diff(at) != 1)
            first = at[np.concatenate(([0], cut + 1))]
            last = at[np.concatenate((cut, [len(at) - 1]))] + 1
            kept = last - first >= need
            if low:
                kept |= first == 0
            if inner:
                kept |= last == n
            yield first[kept] + low, last[kept] + low, np.full(int(kept.sum()), q)


def _matching(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading elements of two equally long arrays agree."""
    differs = a != b
    first = int(differs.argmax()) if len(differs) else 0
    return first if len(differs) and differs[first] else len(differs)


def _onward(a: np.ndarray, c: int, q: int, done: int, most: int) -> int:
    return done + _matching(a[c + done : c + most], a[c + q + done : c + q + most])


def _backward(a: np.ndarray, c: int, q: int, done: int, most: int) -> int:
    return done + _matching(a[c - most : c - done][::-1], a[c + q - most : c + q - done][::-1])


def _smallest_period(block: list[int]) -> int:
    border = [0] * len(block)
    k = 0
    for i in range(1, len(block)):
        while k and block[i] != block[k]:
            k = border[k - 1]
        if block[i] == block[k]:
            k += 1
        border[i] = k
    return len(block) - k


def _tile(a: np.ndarray, start: int, end: int, c: int, periods: np.ndarray, octave: int) -> list[tuple[int, int, int]]:
    """Fragments at the boundary ``c`` of a document of the words ``start`` to ``end``, for periods at which its block comes again."""
    m = octave // 2
    p = _smallest_period(a[c : c + m].tolist())
    most_back = min(m, c - start)
    out = []
    if 2 * p > m:  # occurrences lie more than m / 2 apart, so there are few
        for q in periods.tolist():
            most = min(octave, end - c - q)
            on, back = _onward(a, c, q, 0, most), _backward(a, c, q, 0, most_back)
            if on == octave or back == m or on + back >= q:
                out.append((c - back, c + on, q))
        return out
    low, high = max(start, c - m), min(end, c + 3 * octave)
    breaks = np.flatnonzero(a[low : high - p] != a[low + p : high]) + low

    def run_of(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First word and end of the p-periodic stretch around words x, as far as the tile shows."""
        k = np.searchsorted(breaks, x)
        ends = np.append(breaks + p, high)[k]
        starts = np.concatenate(([low], breaks + 1))[k]
        return starts, ends

    here, there = run_of(np.array([c])), run_of(c + periods)
    outside = here[1][0] < c + periods + m  # within its own run the shift is a multiple of p
    most = np.minimum(octave, end - c - periods)
    on_here, on_there = here[1][0] - c, there[1] - (c + periods)
    back_here, back_there = c - here[0][0], (c + periods) - there[0]
    on, back = np.minimum(np.minimum(on_here, on_there), most), np.minimum(np.minimum(back_here, back_there), most_back)
    further = np.flatnonzero(outside & ((on_here == on_there) & (on < most) | (back_here == back_there) & (back < most_back)))
    for i in further.tolist():
        q = int(periods[i])
        if on_here == on_there[i]:
            on[i] = _onward(a, c, q, int(on[i]), int(most[i]))
        if back_here == back_there[i]:
            back[i] = _backward(a, c, q, int(back[i]), most_back)
    for i in np.flatnonzero(outside & ((on == octave) | (back == m) | (on + back >= periods))).tolist():
        q, x, y = int(periods[i]), c - int(back[i]), c + int(on[i])
        if np.array_equal(a[x:y], a[x + q : y + q]):  # else two hashes met
            out.append((x, y, q))
    return out


def _long_periods(a: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[Fragment]:
    """Fragments of periods from OCTAVE on. Documents come longest first, each followed by a separator."""
    hashes, length = mix(a.astype(np.uint64) + np.uint64(1)), 1
    octave = OCTAVE
    while len(starts) and (n := int(np.searchsorted(-(ends - starts), -2 * octave, "right"))):
        hashes = hashes[: int(ends[n - 1])]
        m = octave // 2
        while length < m:
            pair = hashes[: len(hashes) - length] * np.uint64(0x9E3779B97F4A7C15)
            pair ^= hashes[length:] + np.uint64(0x632BE59BD9B4E019)
            hashes, length = mix(pair), 2 * length
        grid = np.arange(0, len(hashes), m)
        ahead = np.lib.stride_tricks.sliding_window_view(np.concatenate((hashes, np.zeros(2 * octave, np.uint64))), octave)
        ahead = ahead[octave::m][: len(grid)]
        found = []
        step = max(1, COMPARED // octave)
        for i in range(0, len(grid), step):
            rows, columns = np.nonzero(ahead[i : i + step] == hashes[grid[i : i + step], None])
            if len(rows):
                part = grid[rows + i]
                doc = np.searchsorted(starts[:n], part, "right") - 1
                within = part + columns + octave + m <= ends[doc]
                part, columns, doc = part[within], columns[within], doc[within]
                edges = np.flatnonzero(np.diff(part, prepend=-1, append=-1))  # none if all that matched was another document's
                for first, last in zip(edges, edges[1:], strict=False):
                    d = int(doc[first])
                    found += _tile(a, int(starts[d]), int(ends[d]), int(part[first]), columns[first:last] + octave, octave)
        if found:
            low, high, q = np.array(found, np.int64).T
            yield low, high, q
        octave *= 2


def _fragments(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """For each document its fragments (from, to, period) of equality intervals."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    lengths = np.array([len(texts[i]) for i in order])
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    words = _numbers([word for i in order for word in texts[i]])
    a = np.empty(len(words) + len(order), np.int32)
    separator = np.zeros(len(a), bool)
    separator[ends] = True
    a[~separator] = words
    a[separator] = len(words) + np.arange(len(order), dtype=np.int32)
    for low, high, q in (*_short_periods(a), *_long_periods(a, starts, ends)):
        doc = np.searchsorted(starts, low, "right") - 1
        high = np.minimum(high, ends[doc] - q)  # what reaches into the next document is no match
        for d, x, y, k in zip(doc.tolist(), low.tolist(), high.tolist(), q.tolist(), strict=True):
            if x < y:
                s = int(starts[d])
                out[order[d]].append((x - s, y - s, k))
    return out


_FOUND = "row bigint, doc_id bigint, n_words bigint, words binary, fragments array<struct<low:bigint,high:bigint,period:bigint>>"


def _solve(rewrite: Rewrite | None):
    kind = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64()), ("period", pa.int64())]))

    def solved(rows: list[tuple[int, int | None, list[bytes]]]) -> pa.RecordBatch:
        fragments = _fragments([words for _, _, words in rows])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([row for row, _, _ in rows], pa.int64()),
                pa.array([doc_id for _, doc_id, _ in rows], pa.int64()),
                pa.array([len(words) for _, _, words in rows], pa.int64()),
                pa.array([b" ".join(words) for _, _, words in rows], pa.binary()),
                pa.array([[dict(zip(("low", "high", "period"), f, strict=True)) for f in some] for some in fragments], kind),
            ],
            ["row", "doc_id", "n_words", "words", "fragments"],
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row, doc_id, text in zip(*(batch.column(i) for i in range(3)), strict=True):
                words = (text.as_py() or b"").split()
                if rewrite:
                    words = rewrite(doc_id.as_py(), words)
                held.append((row.as_py(), doc_id.as_py(), words))
                size += len(words) + 1
                if size >= BATCH_WORDS:
                    yield solved(held)
                    held, size = [], 0
        if held:
            yield solved(held)

    return run


def stitch(fragments: DataFrame) -> DataFrame:
    """(row, start, length, period): the runs that fragments (row, low, high, period) of equality intervals make up."""
    ordered = Window.partitionBy("row", "period").orderBy("low", "high")
    before = F.max("high").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    opens = (before.isNull() | (F.col("low") > before)).cast("int")
    numbered = fragments.withColumn("opens", opens).withColumn("part", F.sum("opens").over(ordered))
    whole = numbered.groupBy("row", "period", "part").agg(F.min("low").alias("start"), F.max("high").alias("stop"))
    length = F.col("stop") - F.col("start") + F.col("period")
    runs = whole.select("row", "start", length.alias("length"), "period")
    runs = runs.where((F.col("length") >= LEAST) & (F.col("length") >= 2 * F.col("period")))
    return runs.groupBy("row", "start", "length").agg(F.min("period").alias("period"))


def _collapse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for words, runs in zip(batch.column("words"), batch.column("runs"), strict=True):
            words, runs = words.as_py(), runs.as_py()
            if runs:
                words = words.split()
                gone = np.zeros(len(words) + 1, np.int64)
                for run in runs:
                    gone[run["start"] + run["period"]] += 1
                    gone[run["start"] + run["length"]] -= 1
                kept = np.flatnonzero(np.cumsum(gone)[:-1] == 0)
                words = b" ".join([words[i] for i in kept.tolist()])
            texts.append(words)
        columns = [batch.column(name) for name in ("doc_id", "n_words", "runs")] + [pa.array(texts, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])


def collapse(docs: DataFrame, rewrite: Rewrite | None = None) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of each row of ``docs`` (doc_id, text).

    ``runs`` is sorted by start, then period. ``collapsed`` holds, in UTF-8, the
    words no run contains after its first q words, joined by one space.
    ``rewrite`` may change the words of a document before they are judged.
    Texts go to a table once, and only those with fragments meet their runs.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint"), F.encode("text", "UTF-8").alias("text")
    )
    found = stored(rows.mapInArrow(_solve(rewrite), _FOUND), "periodic")
    some = F.size("fragments") > 0
    pieces = found.where(some).select("row", F.explode("fragments").alias("f")).select("row", "f.*")
    runs = stitch(pieces).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    runs = runs.withColumn("runs", F.transform("runs", lambda r: F.struct(r["start"], r["length"], r["period"])))
    kind = "array<struct<start:bigint,length:bigint,period:bigint>>"
    none = F.array().cast(kind)
    met = found.where(some).join(runs, "row", "left").select(
        "doc_id", "n_words", "words", F.coalesce(F.col("runs").cast(kind), none).alias("runs")
    )
    schema = f"doc_id bigint, n_words bigint, runs {kind}, collapsed binary"
    plain = found.where(~some).select("doc_id", "n_words", none.alias("runs"), F.col("words").alias("collapsed"))
    return met.mapInArrow(_collapse, schema).unionByName(plain)
