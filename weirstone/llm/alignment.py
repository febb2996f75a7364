"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Items are taken in blocks of bounded size (``block_bytes`` of text), each block
against all documents in one pass.

1. Every word n-gram of an item is a seed, however rare. An edit takes up to n of
   them from a copy, and beside an exact copy those are the rarest ones the corpus
   holds: seeds chosen by rarity would be those that an edited copy has lost.
2. Hits of one item on nearby diagonals make a passage, as far around them as an
   alignment at the threshold can drift by its gaps.
3. A passage whose words leave too low a score whatever their order is passed over,
   which is most that share a common n-gram. The others are aligned with the item word by word:
   match 2, mismatch -1, gap -1, local. The score is the alignment's share of a full match.

So a copy that reaches the threshold is found if n words of it in a row are those of the
item; a passage that only shares a phrase scores low. Words are runs of letters and digits, A-Z as a-z.

Defined results: null and empty texts, and items of fewer than ``n`` words,
match nothing. Repeated items are reported each; repeated documents, too. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from weirstone.llm.textbytes import chunks, ngrams, words

GAPS = np.ones(256, bool)
for _from, _to in ((48, 58), (65, 91), (97, 123), (128, 256)):
    GAPS[_from:_to] = False
_FILTER_BITS = 22
THRESHOLD = 0.5


@dataclass(frozen=True)
class Items:
    """A block of items: their words, and where each distinct n-gram occurs in them."""

    ids: list[int]
    words: list[np.ndarray]
    n: int
    grams: np.ndarray
    first: np.ndarray
    item: np.ndarray
    at: np.ndarray

    @staticmethod
    def of(ids: list[int], texts: list[str | None], n: int) -> Items:
        found = []
        for chunk in chunks(pa.array(texts, pa.large_string())):
            hashes, _, _, first = words(chunk, gaps=GAPS)
            found += [hashes[first[i] : first[i + 1]] for i in range(len(chunk))]
        grams = [ngrams(w, n) for w in found]
        sizes = [len(g) for g in grams]
        every = np.concatenate([np.empty(0, np.uint64), *grams])
        item = np.repeat(np.arange(len(found)), sizes)
        at = np.concatenate([np.empty(0, np.int64), *[np.arange(s) for s in sizes]])
        order = np.argsort(every, kind="stable")
        distinct, first = np.unique(every[order], return_index=True)
        return Items(ids, found, n, distinct, np.append(first, len(every)), item[order], at[order])


def _finder(grams: np.ndarray) -> Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Positions in an array that hold one of the sorted ``grams``, and which: most are turned away by one table look-up."""
    shift = np.uint64(64 - _FILTER_BITS)
    table = np.zeros(1 << _FILTER_BITS, bool)
    table[grams >> shift] = True

    def find(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(table[hashes >> shift])
        which = np.searchsorted(grams, hashes[at])
        which[which == len(grams)] = 0
        same = grams[which] == hashes[at] if len(grams) else np.zeros(len(at), bool)
        return at[same], which[same]

    return find


def _hits(texts: pa.Array, items: Items) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, words of the row, word positions of its hits, their n-grams) for rows with a hit."""
    find = _finder(items.grams)
    for chunk in chunks(texts):
        hashes, _, _, first = words(chunk, gaps=GAPS)
        at, which = find(ngrams(hashes, items.n))
        row = np.searchsorted(first, at, "right") - 1
        inside = at + items.n <= first[row + 1]
        at, which, row = at[inside], which[inside], row[inside]
        cuts = np.flatnonzero(np.diff(row)) + 1
        for a, w, r in zip(np.split(at, cuts), np.split(which, cuts), row[np.append(0, cuts)] if len(row) else ()):
            yield chunk.first + int(r), hashes[first[r] : first[r + 1]], a - first[r], w


def smith_waterman(item: np.ndarray, passage: np.ndarray, match: int = 2, mismatch: int = -1, gap: int = -1) -> tuple[int, int]:
    """The best local score, and the passage position behind the alignment that has it first."""
    place = np.arange(len(passage) + 1) * -gap
    above = np.zeros(len(passage) + 1, np.int64)
    best, end = 0, 0
    for word in item:
        row = np.zeros(len(passage) + 1, np.int64)
        row[1:] = np.maximum(above[:-1] + np.where(passage == word, match, mismatch), above[1:] + gap)
        np.maximum(row, 0, out=row)
        row = np.maximum.accumulate(row + place) - place  # gaps in the item, all lengths at once
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
        above = row
    return best, end


def _ceiling(words: np.ndarray, others: np.ndarray) -> int:
    """What no local alignment of the two can exceed: a word that others lack costs 1 wherever it stands inside."""
    worth = np.append(0, np.cumsum(np.where(np.isin(words, others), 2, -1)))
    return int((worth - np.minimum.accumulate(worth)).max())


def _aligned(text: np.ndarray, at: np.ndarray, which: np.ndarray, items: Items, threshold: float) -> Iterator[tuple[int, float, int, int]]:
    """(item, score, first word, last word + 1): the best passage of a text for each item that reaches the threshold."""
    sizes = items.first[which + 1] - items.first[which]
    place = np.repeat(items.first[which] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    item, diagonal = items.item[place], np.repeat(at, sizes) - items.at[place]
    order = np.lexsort((diagonal, item))
    item, diagonal = item[order], diagonal[order]
    new = np.flatnonzero(np.diff(item)) + 1
    for start, end in zip((0, *new), (*new, len(item))):
        number = int(item[start])
        sought = items.words[number]
        enough = threshold * 2 * len(sought)
        slack = int(2 * len(sought) - enough) + 2
        found = np.unique(diagonal[start:end])
        best = (0, 0, 0)
        for group in np.split(found, np.flatnonzero(np.diff(found) > slack) + 1):
            low = max(0, int(group[0]) - slack)
            passage = text[low : int(group[-1]) + len(sought) + slack]
            if _ceiling(passage, sought) < enough or _ceiling(sought, passage) < enough:
                continue
            score, stop = smith_waterman(sought, passage)
            if score > best[0]:
                best = (score, low, stop)
        score, low, stop = best
        if score and score >= enough:
            _, back = smith_waterman(sought[::-1], text[low : low + stop][::-1])
            yield number, score / (2 * len(sought)), low + stop - back, low + stop


def _blocks(items: DataFrame, n: int, block_bytes: int) -> Iterator[Items]:
    ids, texts, size = [], [], 0
    for row in items.select("item_id", "text").orderBy("item_id", "text").toLocalIterator():
        if size and size + len(row["text"] or "") > block_bytes:
            yield Items.of(ids, texts, n)
            ids, texts, size = [], [], 0
        ids.append(row["item_id"])
        texts.append(row["text"])
        size += len(row["text"] or "")
    if ids:
        yield Items.of(ids, texts, n)


def matches(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, n: int = 3, block_bytes: int = 4 << 20) -> DataFrame:
    """(doc_id, item_id, score, first_word, last_word) of documents (doc_id, text) that hold a copy of an item (item_id, text)."""
    schema = "doc_id long, item_id long, score double, first_word long, last_word long"
    docs = docs.select("doc_id", "text")
    out = docs.sparkSession.createDataFrame([], schema)
    for block in _blocks(items, n, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def find(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = shared.value
            for batch in batches:
                rows = [
                    (batch.column(0)[row].as_py(), items.ids[number], score, first, last)
                    for row, text, at, which in _hits(batch.column(1), items)
                    for number, score, first, last in _aligned(text, at, which, items, threshold)
                ]
                columns = list(zip(*rows)) or [()] * 5
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    ["doc_id", "item_id", "score", "first_word", "last_word"],
                )

        out = out.union(docs.mapInArrow(find, schema))
    return out


def clean(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, n: int = 3, block_bytes: int = 4 << 20) -> DataFrame:
    """The documents, all columns, that hold no copy of any item."""
    names = docs.columns
    out = docs
    for block in _blocks(items, n, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                good = np.ones(len(batch), bool)
                for row, text, at, which in _hits(batch.column(names.index("text")), shared.value):
                    good[row] = next(_aligned(text, at, which, shared.value, threshold), None) is None
                yield batch.filter(pa.array(good))

        out = out.mapInArrow(keep, docs.schema)
    return out
