"""Token ids of whole texts, with every distinct word encoded once."""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa

from weirstone.llm.textbytes import LOWER, WHITE, Chunk, chunks, range_hash


# Classes of bytes; what is in none of them is left to the tokenizer's own splitting.
_LETTER, _DIGIT, _MARK, _LEAD, _OTHER = range(5)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[33:127] = _MARK
_CLASS[48:58] = _DIGIT
_CLASS[65:91] = _CLASS[97:123] = _LETTER
_CLASS[39] = _OTHER  # an apostrophe may begin a contraction
_CLASS[0xC3] = _LEAD
_SECOND = np.zeros(256, bool)  # after 0xC3: the Latin-1 letters, which are all but the signs for times and divided by
_SECOND[0x80:0xC0] = True
_SECOND[[0x97, 0xB7]] = False


def pieces(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes in lower case, starts, ends, whether the piece is plain, first piece of each row).

    Plain pieces are runs of letters, single digits and runs of marks in words
    of ASCII and Latin-1 letters: the tokenizer splits there as well. Other words stay whole.
    """
    data = LOWER[chunk.data]
    n = len(data)
    kind = _CLASS[data]
    lead = np.flatnonzero(kind[:-1] == _LEAD) if n else np.empty(0, np.int64)
    lead = lead[_SECOND[data[lead + 1]]]
    capital = lead[(data[lead + 1] < 0x9F)] + 1
    data[capital] += 0x20
    kind[lead] = kind[lead + 1] = _LETTER
    kind[kind == _LEAD] = _OTHER
    ink = ~WHITE[data]
    edge = np.zeros(n + 1, bool)
    edge[chunk.offsets] = True
    start = ink.copy()
    start[1:] &= ~ink[:-1] | edge[1:n]
    word = np.cumsum(start) - 1
    odd = np.zeros(int(word[-1]) + 1 if n and word[-1] >= 0 else 0, bool)
    odd[word[ink & (kind == _OTHER)]] = True
    split = np.zeros(n, bool)
    split[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    inked = np.flatnonzero(ink & (start | split))
    inked = inked[start[inked] | ~odd[word[inked]]]
    last = np.zeros(n, bool)
    last[:-1] = ~ink[1:] | edge[1:n]
    if n:
        last[-1] = True
    stops = np.flatnonzero(ink & last) + 1  # of words
    following = np.append(inked[1:], n)
    ends = np.minimum(following, stops[word[inked]])
    return data, inked, ends, ~odd[word[inked]], np.searchsorted(inked, chunk.offsets)


class WordTokenizer:
    """Ids by a tokenizer file that lower-cases, splits texts as ``pieces`` does, and marks ends of pieces with </w>.

    Such a tokenizer gives a text the ids of its pieces, one after the other. A
    chunk's pieces are looked up in the ids of pieces seen before (at most
    ``keep`` and those of a chunk are held), and only new ones are encoded.
    Strings of special tokens in a text count as ordinary text.
    """

    def __init__(self, path: str, keep: int = 500_000):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab()
        self.closing = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closing[[i for name, i in vocabulary.items() if name.endswith("</w>")]] = True
        self.keep = keep
        self._forget()

    def _forget(self) -> None:
        self.names = np.empty(0, np.uint64)
        self.starts = np.empty(0, np.int64)
        self.sizes = np.empty(0, np.int64)
        self.ids = np.empty(0, np.uint32)

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids end to end, and those of each text."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes

    def _learn(self, names: np.ndarray, texts: list[bytes], plain: np.ndarray) -> None:
        whole = [t.decode() for t, p in zip(texts, plain) if not p]
        some = [t for t, p in zip(texts, plain) if p]
        lines = [b" ".join(some[i : i + 256]).decode() for i in range(0, len(some), 256)]
        ids, _ = self._encode(lines)
        ends = np.flatnonzero(self.closing[ids]) + 1
        more, sizes = self._encode(whole)
        names = np.concatenate((names[plain], names[~plain]))
        sizes = np.concatenate((np.diff(ends, prepend=0), sizes))
        starts = len(self.ids) + np.cumsum(sizes) - sizes
        order = np.argsort(np.concatenate((self.names, names)), kind="stable")
        self.names = np.concatenate((self.names, names))[order]
        self.starts = np.concatenate((self.starts, starts))[order]
        self.sizes = np.concatenate((self.sizes, sizes))[order]
        self.ids = np.concatenate((self.ids, ids, more))

    def encode(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the chunk's rows end to end, and where each row's begin (one longer than the rows)."""
        data, starts, ends, plain, first = pieces(chunk)
        if not len(starts):
            return np.empty(0, np.uint32), np.zeros(len(chunk) + 1, np.int64)
        hashes = range_hash(data, starts, ends)
        names, sample, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.names) > self.keep:
            self._forget()
        at = np.searchsorted(self.names, names)
        at[at == len(self.names)] = 0
        new = np.flatnonzero(self.names[at] != names) if len(self.names) else np.arange(len(names))
        if len(new):
            raw = data.tobytes()
            texts = [raw[a:b] for a, b in zip(starts[sample[new]].tolist(), ends[sample[new]].tolist())]
            self._learn(names[new], texts, plain[sample[new]])
            at = np.searchsorted(self.names, names)
        place = at[inverse]
        sizes = self.sizes[place]
        stops = np.cumsum(sizes)
        source = np.repeat(self.starts[place] - stops + sizes, sizes) + np.arange(int(stops[-1]))
        return self.ids[source], np.append(0, stops)[first]


_tokenizers: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """One per worker process and file, so that its words are known to later tasks."""
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def encoded(texts: pa.Array, path: str) -> Iterator[tuple[int, np.ndarray]]:
    """(row, ids) of a string column; a null text has no ids."""
    known = tokenizer(path)
    for chunk in chunks(texts, 2 << 20):
        ids, first = known.encode(chunk)
        for row in range(len(chunk)):
            yield chunk.first + row, ids[first[row] : first[row + 1]]
