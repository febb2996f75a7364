"""How far the sources of each language differ in their words: count-level bitmaps.

The terms kept for a language are numbered and cut into chunks of a few hundred
terms of similar frequency. For each chunk and each group, a source of
the language, ``levels`` stores one bitset of term numbers per occurring count: bit i of the
bitset of count c is set if the group has term i exactly c times. The language
as a whole is one more such group. Two groups that meet in a chunk are compared
by AND and popcount: the cells (c, d) say how many terms one has c times and
the other d times, and each is multiplied by f(c, d). The bitset of count zero
is the complement of the others.

With count c a group's p is 1 + floor(10^9 (c + 5) / (N + 5 V)), computed in
38-digit decimals; f is the absolute difference of two p. So all sums are exact integers.

Terms are runs of ASCII letters, A-Z taken as a-z, and characters beyond
ASCII. Defined results: null text, lang and source are ''. A group without
terms has zero counts everywhere. A language without kept terms gives pairs of value 0 and no
terms. Repeated rows count each; an empty table gives none; extra columns are not looked at.

A chunk's groups are packed by 16 (``BLOCK``) and blocks of the chunk meet in
pairs, so a task holds two blocks at most, however many sources a language has.
Per language the result has a row for each ordered pair of sources: that is the report.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from weirstone.llm.runtime import stored

TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
MIN_DOCS = 30
TOP = 50
CHUNK = 256
BLOCK = 16
HELD = 500_000
CELLS = 1 << 19
PIECE = 1 << 20
ONE = 1_000_000_000
SMOOTH = 5


def _terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order; long texts come piece by piece, cut between terms."""
    at = 0
    while at < len(text):
        end = min(len(text), at + PIECE)
        while end < len(text) and (text[end] > 0x7F or chr(text[end]).isalpha()):
            end += 1
        yield TERM.findall(text, at, end)
        at = end


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))

    def given() -> Iterator[pa.RecordBatch]:
        for (lang, source), (total, docs) in groups.items():
            # a null term says that the group occurs, even if it has no terms
            terms = pa.array([*total, None], pa.binary()).cast(pa.string())
            n = np.fromiter(total.values(), np.int64, len(total))
            d = np.fromiter(map(docs.__getitem__, total), np.int64, len(total))
            same = [pa.repeat(pa.scalar(x, pa.string()), len(terms)) for x in (lang, source)]
            yield pa.RecordBatch.from_arrays([*same, terms, *(pa.array(np.append(x, 0)) for x in (n, d))], ["lang", "source", "term", "n", "docs"])

    for batch in batches:
        lang, source, text = (batch.column(i).to_pylist() for i in range(3))
        for g, one in zip(zip(lang, source, strict=True), text, strict=True):
            total, docs = groups[g]
            once: set[bytes] = set()
            for some in _terms(one.lower()):
                total.update(some)
                once.update(some)
            docs.update(once)
        if sum(len(total) for total, _ in groups.values()) >= HELD:
            yield from given()
            groups.clear()
    yield from given()


def counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term in each group; a null term marks a group."""
    blank = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)
    rows = docs.select(blank("lang"), blank("source"), F.encode(blank("text"), "UTF-8").alias("text"))
    pieces = rows.mapInArrow(_count, "lang string, source string, term string, n bigint, docs bigint")
    return pieces.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(counted: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, total, band, chunk, place): terms in at least ``min_docs`` documents of the language, numbered within chunks.

    A band holds the terms of a power of two of occurrences; its chunks are dealt by hash.
    """
    terms = counted.where(F.col("term").isNotNull()).groupBy("lang", "term")
    terms = terms.agg(F.sum("n").alias("total"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
    terms = stored(terms.select("lang", "term", "total", F.floor(F.log2("total")).cast("int").alias("band")), "terms")
    bands = terms.groupBy("lang", "band").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
    dealt = terms.join(bands, ["lang", "band"]).withColumn("chunk", F.pmod(F.xxhash64("term"), "chunks"))
    # dealt by chunk: Spark would let a window stay as the join by band has dealt it
    dealt = dealt.repartition("lang", "band", "chunk")
    order = Window.partitionBy("lang", "band", "chunk").orderBy("term")
    return dealt.withColumn("place", F.row_number().over(order) - 1).drop("chunks")


def _p(count: str | Column, n: str, v: str) -> Column:
    top = F.lit(ONE).cast("decimal(38,0)") * (F.col(count) if isinstance(count, str) else count) + F.lit(ONE * SMOOTH)
    frame = {"top": top.cast("decimal(38,0)"), "below": (F.col(n) + SMOOTH * F.col(v)).cast("decimal(38,0)")}
    # both are positive, so taking off the remainder first makes the division exact
    return (F.lit(1) + ((frame["top"] - frame["top"] % frame["below"]) / frame["below"])).cast("bigint")


_PACK = (
    "lang string, band int, chunk bigint, block bigint, terms bigint, sources array<string>, zero array<bigint>, "
    "levels array<int>, p array<bigint>, bits binary"
)


def _packed(key: tuple, table: pa.Table) -> pa.Table:
    """Bitsets per (source, count) of one block of groups in one chunk."""
    lang, band, chunk, block = (k.as_py() for k in key)
    terms = table.column("terms")[0].as_py()
    words = -(-terms // 64)
    names, sources = np.unique(np.array([s or "" for s in table.column("source").to_pylist()], object), return_inverse=True)
    place, n, p = (table.column(name).to_numpy() for name in ("place", "n", "p"))
    zero = np.zeros(len(names), np.int64)
    marks = n == 0
    zero[sources[marks]] = p[marks]
    sources, place, n, p = sources[~marks], place[~marks], n[~marks], p[~marks]
    order = np.lexsort((n, sources))
    sources, place, n, p = sources[order], place[order].astype(np.int64), n[order], p[order]
    new = np.ones(len(n), bool)
    new[1:] = (n[1:] != n[:-1]) | (sources[1:] != sources[:-1])
    level = np.cumsum(new) - 1
    bits = np.zeros((int(new.sum()), words), np.uint64)
    np.bitwise_or.at(bits, (level, place >> 6), np.uint64(1) << (place & 63).astype(np.uint64))
    per_source = np.bincount(sources[new], minlength=len(names)).astype(np.int32)
    row = [[lang], [band], [chunk], [block], [terms], [names.tolist()], [zero], [per_source], [p[new]], [bits.tobytes()]]
    kinds = [pa.string(), pa.int32(), *[pa.int64()] * 3, pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.binary()]
    names_ = ["lang", "band", "chunk", "block", "terms", "sources", "zero", "levels", "p", "bits"]
    return pa.Table.from_arrays([pa.array(x, k) for x, k in zip(row, kinds, strict=True)], names_)


class _Block:
    """The groups of one block in one chunk: all their bitsets, that of count zero being the complement, and whose each is."""

    def __init__(self, row: dict, side: str):
        terms, words = row["terms"], -(-row["terms"] // 64)
        self.sources = row[f"{side}_sources"]
        bits = np.frombuffer(row[f"{side}_bits"], np.uint64).reshape(-1, words)
        p, zero = np.array(row[f"{side}_p"], np.int64), np.array(row[f"{side}_zero"], np.int64)
        ends = np.cumsum(row[f"{side}_levels"])
        everything = np.packbits(np.arange(words * 64) < terms, bitorder="little").view(np.uint64)
        parts, shares = [], []
        for k, (start, end) in enumerate(zip(ends - row[f"{side}_levels"], ends, strict=True)):
            seen = np.bitwise_or.reduce(bits[start:end], axis=0) if end > start else np.zeros(words, np.uint64)
            parts += [bits[start:end], (everything & ~seen)[None, :]]
            shares += [p[start:end], zero[k : k + 1]]
        self.bits, self.p = np.concatenate(parts), np.concatenate(shares)
        self.starts = ends - row[f"{side}_levels"] + np.arange(len(ends))  # with one more bitset for each group before
        self.last = np.append(self.starts[1:], len(self.p)) - 1  # the bitset of count zero


def _joint(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Terms in each cell of two counts: AND and popcount."""
    out = np.empty((len(a), len(b)), np.int64)
    step = max(1, CELLS // max(1, b.size))
    for i in range(0, len(a), step):
        out[i : i + step] = np.bitwise_count(a[i : i + step, None, :] & b[None, :, :]).sum(axis=2, dtype=np.int64)
    return out


def _distances(a: _Block, b: _Block) -> np.ndarray:
    """The sum of f over a chunk's terms, for each group of ``a`` with each of ``b``."""
    weighed = _joint(a.bits, b.bits) * np.abs(a.p[:, None] - b.p[None, :])
    return np.add.reduceat(np.add.reduceat(weighed, a.starts, axis=0), b.starts, axis=1)


def _leading(whole: _Block, block: _Block, top: int) -> Iterator[tuple[str, int, int]]:
    """(source, place, value) of terms a group has more often than the language: those of its ``top`` greatest values and all ties."""
    over = block.p[None, :] - whole.p[:, None]
    cells = np.where(over > 0, _joint(whole.bits, block.bits), 0)
    cells[:, block.last] = 0  # the term must occur in the group
    for source, start, last in zip(block.sources, block.starts, block.last, strict=True):
        i, j = np.nonzero(cells[:, start:last])
        j += start
        order = np.argsort(-over[i, j], kind="stable")
        i, j = i[order], j[order]
        values, before = over[i, j], np.cumsum(cells[i, j]) - cells[i, j]
        needed = before < top
        if needed.any():
            needed |= values >= values[needed][-1]
        for x, y, value in zip(i[needed].tolist(), j[needed].tolist(), values[needed].tolist(), strict=True):
            both = whole.bits[x] & block.bits[y]
            for place in np.flatnonzero(np.unpackbits(both.view(np.uint8), bitorder="little")).tolist():
                yield source, place, value


_MET = "lang string, source string, item string, band int, chunk bigint, place int, value bigint"


def _meet(top: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.int64()]
        names = ["lang", "source", "item", "band", "chunk", "place", "value"]
        for batch in batches:
            sums: Counter = Counter()
            rows = []
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                left, right = _Block(row, "a"), _Block(row, "b")
                lang, at = row["lang"], (row["band"], row["chunk"])
                if row["a_block"] < 0:  # the language itself
                    if row["b_block"] >= 0:
                        rows += [(lang, source, None, *at, place, value) for source, place, value in _leading(left, right, top)]
                    continue
                same = row["a_block"] == row["b_block"]
                values = _distances(left, right).tolist()
                for i, g in enumerate(left.sources):
                    for j, h in enumerate(right.sources):
                        if not same or i < j:
                            sums[lang, g, h] += values[i][j]
                            sums[lang, h, g] += values[i][j]
            rows += [(*key, None, None, None, value) for key, value in sums.items()]
            columns = list(zip(*rows, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)

    return run


def levels(counted: DataFrame, terms: DataFrame, groups: DataFrame) -> DataFrame:
    """Packed bitsets (one row per language, chunk and block of 16 sources; block -1 is the language itself).

    ``groups`` (lang, source, block, kept, v): N of each group and V of its language.
    """
    known = counted.join(terms.select("lang", "term", "band", "chunk", "place"), ["lang", "term"])
    mine = known.join(groups, ["lang", "source"]).select("lang", "band", "chunk", "block", "source", "place", "n", _p("n", "kept", "v").alias("p"))
    whole = groups.groupBy("lang").agg(F.sum("kept").alias("kept"), F.max("v").alias("v"))
    all_of = terms.join(whole, "lang").select(
        "lang", "band", "chunk", F.lit(-1).cast("bigint").alias("block"), F.lit("").alias("source"), "place",
        F.col("total").alias("n"), _p("total", "kept", "v").alias("p"),
    )
    chunks = terms.groupBy("lang", "band", "chunk").agg(F.count("*").alias("terms"))
    marks = chunks.join(groups, "lang").select(
        "lang", "band", "chunk", "block", "source", F.lit(0).alias("place"), F.lit(0).cast("bigint").alias("n"),
        _p(F.lit(0).cast("decimal(19,0)"), "kept", "v").alias("p"),
    )
    rows = mine.unionByName(all_of).unionByName(marks).join(chunks, ["lang", "band", "chunk"])
    return rows.groupBy("lang", "band", "chunk", "block").applyInArrow(_packed, _PACK)


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): the other sources of the language by distance, and the ``top`` terms of the source."""
    counted = stored(counts(docs), "counts")
    terms = stored(kept_terms(counted, min_docs), "terms")
    sizes = terms.groupBy("lang").agg(F.count("*").alias("v"))
    met = counted.join(terms.select("lang", "term"), ["lang", "term"]).groupBy("lang", "source").agg(F.sum("n").alias("kept"))
    groups = counted.groupBy("lang", "source").agg(F.lit(0).alias("x")).drop("x")
    of_lang = groups.groupBy("lang").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    groups = groups.join(met, ["lang", "source"], "left").join(sizes, "lang", "left").join(of_lang, "lang").select(
        "lang", "source", F.pmod(F.xxhash64("source"), "blocks").alias("block"),
        F.coalesce("kept", F.lit(0)).cast("bigint").alias("kept"), F.coalesce("v", F.lit(0)).cast("bigint").alias("v"),
    )
    groups = stored(groups, "groups")
    packed = stored(levels(counted, terms, groups), "levels")
    chunk = ["lang", "band", "chunk"]

    def side(name: str) -> DataFrame:
        own = [F.col(c).alias(f"{name}_{c}") for c in ("block", "sources", "zero", "levels", "p", "bits")]
        return packed.select(*chunk, *(["terms"] if name == "a" else []), *own)

    pairs = side("a").join(side("b"), chunk).where("a_block <= b_block")
    found = stored(pairs.mapInArrow(_meet(top), _MET), "met")
    sums = found.where("item is not null").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    others = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang")
    others = others.where("source <> item").join(sums, ["lang", "source", "item"], "left")
    by_pair = others.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("bigint").alias("value"))
    named = found.where("item is null").drop("item").join(terms.select(*chunk, "place", F.col("term").alias("item")), [*chunk, "place"])
    by_term = named.select("lang", "source", F.lit("term").alias("part"), "item", "value")

    def ranked(rows: DataFrame) -> DataFrame:
        order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
        return rows.withColumn("rank", F.row_number().over(order))

    return ranked(by_pair).unionByName(ranked(by_term).where(F.col("rank") <= top))
