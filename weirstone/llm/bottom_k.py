"""Near duplicates by bottom-k sketches of word shingles, confirmed by exact Jaccard similarity.

1. Texts with the same shingle set form a class (128 bits of a cryptographic
   hash of the set name it); the rest works on one row per class.
2. A class keeps the ``k`` least hashes of its set, all under one hash function.
   Two sets of similarity 0.75 or more share at least ``least_shared(k)`` of
   the kept values, but for a chance of about 1e-9; sets not longer than k are
   kept whole, and for them the bound is exact.
3. Inverted lists: values that stand in one sketch only cannot pair anything.
   For each class the values are ordered from rare to frequent, and only the
   first of them, so many that a pair beyond the bound must share one, are
   indexed. What a third of all texts hold thus comes last and makes no lists
   unless a text holds little else. Counting is done per range of values over
   summed blocks, so a frequent value costs one row per block.
4. Each list first offers links between its members and one pivot, a number of
   pairs in proportion to the list. Pairs are estimated on the union of the two
   sketches and then confirmed on the full sets of the whole texts. When all members
   of a list have come together, nothing is left to find in it; the others get
   new pivots for ``rounds`` rounds, and what is still apart then is compared across the
   components, list by list in blocks of bounded size.
5. Components are found by star contraction over the confirmed links.

Defined results: a null or empty text, or one without words, has the empty set
and is linked with nothing. Fewer than five words are one shingle. Repeated
rows and rows that share an id each get a row; a component is named by its
least id that is not null, and a row is kept if its id is that one. A
row without id belongs to its component, too, and is kept only if no row of it has an id.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weirstone.llm.components import members, star_forest
from weirstone.llm.runtime import if_small, stored, width
from weirstone.llm.textbytes import chunks, mix, shingle_sets

K = 96
UNIT = 1000
BLOCK = 256
SHORT = 64
MARKS = 1 << 23
PIECE_BITS = 1 << 15  # of Spark's bitmaps


def least_shared(k: int, percent: int = 75, miss: float = 1e-9) -> int:
    """The most m for which a sample of k from a union holds m common members, but for a chance below ``miss``."""
    p, total, m = percent / 100, 0.0, 0
    while m < k:
        total += math.comb(k, m) * p**m * (1 - p) ** (k - m)
        if total > miss:
            break
        m += 1
    return m


def required(size: int, k: int, percent: int = 75) -> int:
    """Kept values that a sketch of this size shares with any similar one."""
    exact = -(-percent * size // 100)
    return exact if size * 100 <= k * percent else min(exact, least_shared(k, percent))


def signatures(docs: DataFrame, k: int = K, shingle: int = 5) -> DataFrame:
    """(doc_id, node, check, n_shingles, sketch) for each row; node is null for an empty set."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                names, sizes, kept = [], [], []
                for found in shingle_sets(chunk, shingle):
                    digest = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
                    names.append(np.frombuffer(digest, np.int64) if len(found) else (None, None))
                    sizes.append(len(found))
                    kept.append(found[:k].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(chunk.first, len(chunk)),
                        pa.array([a for a, _ in names], pa.int64()),
                        pa.array([b for _, b in names], pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(kept, pa.binary()),
                    ],
                    ["doc_id", "node", "check", "n_shingles", "sketch"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        sign, "doc_id long, node long, check long, n_shingles long, sketch binary"
    )


def classes(signed: DataFrame) -> DataFrame:
    """One row per shingle set; the rows of a set meet only after a task has joined its own."""
    return signed.where("node is not null").groupBy("node", "check").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")
    )


def _units(reps: DataFrame) -> DataFrame:
    """Classes packed many to a row: (unit, nodes, sizes of sketches, values)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), UNIT):
                part = batch.slice(at, UNIT)
                nodes = part.column("node").to_numpy()
                kept = part.column("sketch").to_pylist()
                sizes = np.array([len(s) // 8 for s in kept], np.int32)
                row = [[int(nodes[0])], [nodes.tobytes()], [sizes.tobytes()], [b"".join(kept)]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in row], ["unit", "nodes", "sizes", "vals"]
                )

    return reps.select("node", "sketch").mapInArrow(pack, "unit long, nodes binary, sizes binary, vals binary")


def _part(values: np.ndarray, parts: int) -> np.ndarray:
    return (mix(values ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(parts)).astype(np.int64)


def _frequencies(units: DataFrame, parts: int) -> DataFrame:
    """(unit, part, counts): for a unit's distinct values in this part, in order, the classes that hold them."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for unit, vals in zip(batch.column("unit").to_pylist(), batch.column("vals").to_pylist()):
                values, counts = np.unique(np.frombuffer(vals, np.uint64), return_counts=True)
                where = _part(values, parts)
                order = np.argsort(where, kind="stable")
                cuts = np.searchsorted(where[order], np.arange(parts + 1))
                values, counts = values[order], counts[order].astype(np.uint32)
                held = [p for p in range(parts) if cuts[p] < cuts[p + 1]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([unit] * len(held), pa.int64()),
                        pa.array(held, pa.int32()),
                        pa.array([values[cuts[p] : cuts[p + 1]].tobytes() for p in held], pa.binary()),
                        pa.array([counts[cuts[p] : cuts[p + 1]].tobytes() for p in held], pa.binary()),
                    ],
                    ["unit", "part", "vals", "counts"],
                )

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        values = np.concatenate([np.frombuffer(v, np.uint64) for v in rows.vals])
        counts = np.concatenate([np.frombuffer(c, np.uint32) for c in rows.counts])
        _, inverse = np.unique(values, return_inverse=True)
        total = np.minimum(np.bincount(inverse, counts), 65535).astype(np.uint16)[inverse]
        ends = np.cumsum([len(v) // 8 for v in rows.vals])
        replies = [part.tobytes() for part in np.split(total, ends[:-1])]
        return pd.DataFrame({"unit": rows.unit, "part": rows.part, "counts": replies})

    asked = units.select("unit", "vals").mapInArrow(ask, "unit long, part int, vals binary, counts binary")
    return asked.groupBy("part").applyInPandas(answer, "unit long, part int, counts binary")


def inverted_lists(units: DataFrame, parts: int, k: int = K, percent: int = 75) -> DataFrame:
    """(value, node) of the values by which a class must be found, where another class holds them, too."""
    need = np.array([required(s, k, percent) for s in range(k + 1)])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                nodes, sizes = np.frombuffer(row["nodes"], np.int64), np.frombuffer(row["sizes"], np.int32)
                raw = np.frombuffer(row["vals"], np.uint64)
                values, inverse = np.unique(raw, return_inverse=True)
                where = _part(values, parts)
                counts = np.empty(len(values), np.uint16)
                replies = sorted((r["part"], r["counts"]) for r in row["replies"])
                counts[np.argsort(where, kind="stable")] = np.frombuffer(b"".join(c for _, c in replies), np.uint16)
                counts = counts[inverse]
                owner = np.repeat(np.arange(len(nodes)), sizes)
                order = np.lexsort((raw, counts, owner))
                rank = np.arange(len(raw)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                take = order[(rank < np.repeat(sizes - need[sizes] + 1, sizes)) & (counts[order] > 1)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(raw[take].view(np.int64)), pa.array(nodes[owner[take]])], ["value", "node"]
                )

    replies = _frequencies(units, parts).groupBy("unit").agg(F.collect_list(F.struct("part", "counts")).alias("replies"))
    return units.join(replies, "unit").mapInArrow(choose, "value long, node long")


class Marks:
    """A bitmap of ``MARKS`` bits that holds all the given ids, and by chance some others, sent to the tasks that look ids up.

    Spark builds it: every task ors its ids into pieces of 4 KB, tasks' pieces are ored, and the
    driver gets the 256 pieces. ``close`` takes it back from driver and executors when what was read with it is stored.
    """

    def __init__(self, ids: DataFrame):
        place = F.pmod(F.col(ids.columns[0]), F.lit(MARKS)) + 1
        pieces = ids.where(F.col(ids.columns[0]).isNotNull()).groupBy(F.bitmap_bucket_number(place).alias("piece"))
        packed = np.zeros((MARKS // PIECE_BITS, PIECE_BITS // 8), np.uint8)
        for row in pieces.agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect():
            packed[row["piece"] - 1] = np.frombuffer(row["bits"], np.uint8)
        self.sent = ids.sparkSession.sparkContext.broadcast(packed.tobytes())

    def close(self) -> None:
        self.sent.destroy()


def _bits(sent) -> np.ndarray:
    return np.unpackbits(np.frombuffer(sent.value, np.uint8), bitorder="little").astype(bool)


def _held(batch: pa.RecordBatch, bits: np.ndarray, by: str) -> pa.RecordBatch:
    return batch.filter(pa.array(bits[batch.column(by).fill_null(0).to_numpy() % MARKS]))


def _only(df: DataFrame, marks: Marks, columns: list[str], by: str, marked: bool = True) -> DataFrame:
    """The rows whose column ``by`` is marked, or the others."""
    schema, sent = df.select(columns).schema, marks.sent

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = _bits(sent) == marked
        for batch in batches:
            yield _held(batch, bits, by)

    return df.select(columns).mapInArrow(keep, schema)


def _pair_with(pairs: DataFrame, of: DataFrame, columns: list[str]) -> DataFrame:
    """Pairs (a, b) with the named columns of both; a node that is in very many pairs splits as any skewed join key."""
    left = of.select(F.col("node").alias("a"), *[F.col(c).alias(f"{c}_a") for c in columns])
    right = of.select(F.col("node").alias("b"), *[F.col(c).alias(f"{c}_b") for c in columns])
    return pairs.join(left, "a").join(right, "b")


def _likely(pairs: DataFrame, reps: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs whose similarity, estimated on the union of their sketches, is not too low."""
    bound = least_shared(k, percent)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            rows = zip(*(batch.column(c).to_pylist() for c in ("sketch_a", "sketch_b", "n_a", "n_b")))
            for x, y, n, m in rows:
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if 100 * min(n, m) < percent * max(n, m):
                    keep.append(False)
                    continue
                union, counts = np.unique(np.concatenate((x, y)), return_counts=True)
                if n <= k and m <= k:
                    keep.append(100 * int((counts == 2).sum()) >= percent * len(union))
                else:
                    keep.append(int((counts[:k] == 2).sum()) >= bound)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return _pair_with(pairs, reps, ["sketch", "n"]).mapInArrow(judge, "a long, b long")


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int, shingle: int) -> DataFrame:
    """Pairs whose full shingle sets are similar."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, last, known = [], None, None
            first = (s for c in chunks(batch.column("text_a")) for s in shingle_sets(c, shingle))
            for x, b, text in zip(first, batch.column("b").to_pylist(), batch.column("text_b")):
                if b != last:
                    known = next(s for c in chunks(pa.array([text.as_py()])) for s in shingle_sets(c, shingle))
                    last = b
                common = len(np.intersect1d(x, known, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(known) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return _pair_with(pairs, texts, ["text"]).mapInArrow(judge, "a long, b long")


def _texts(docs: DataFrame, reps: DataFrame, nodes: DataFrame, shingle: int) -> tuple[DataFrame, Marks]:
    """(node, text) of the wanted classes, one whole text of each, and the marks to close when they have been read."""
    wanted = stored(reps.join(nodes, "node", "left_semi").select("node", "doc_id"), "wanted")
    marks = Marks(wanted.select(F.coalesce("doc_id", F.lit(0)).alias("doc_id")))
    sent = marks.sent

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = _bits(sent)
        for batch in batches:
            batch = _held(batch, bits, "doc_id")
            for chunk in chunks(batch.column("text")):
                nodes = [
                    np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64)[0] if len(s) else None
                    for s in shingle_sets(chunk, shingle)
                ]
                part = batch.slice(chunk.first, len(chunk))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes, pa.int64()), part.column("doc_id"), part.column("text")], ["node", "id", "text"]
                )

    named = docs.select("doc_id", "text").mapInArrow(name, "node long, id long, text string")
    found = named.join(wanted, "node").where("id <=> doc_id")
    return found.groupBy("node").agg(F.first("text").alias("text")), marks


def _cross(apart: DataFrame) -> DataFrame:
    """Pairs of different components in short lists (value, node, component)."""

    def pair(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("value")
        value, node, component = (rows[c].to_numpy() for c in ("value", "node", "component"))
        cuts = np.flatnonzero(np.diff(value)) + 1
        out = []
        for start, end in zip((0, *cuts), (*cuts, len(value))):
            n, c = node[start:end], component[start:end]
            x, y = np.nonzero((c[:, None] != c) & (n[:, None] > n))
            out.append(np.stack((n[x], n[y])))
        pairs = np.unique(np.concatenate(out, axis=1), axis=1)
        return pd.DataFrame({"a": pairs[0], "b": pairs[1]})

    parts = 4 * width(apart.sparkSession)
    dealt = apart.select("value", "node", "component", F.pmod(F.xxhash64("value"), F.lit(parts)).alias("part"))
    return dealt.groupBy("part").applyInPandas(pair, "a long, b long").distinct()


def _overlaps(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Common members of each set of x with each of y, as products of slices of the two incidence matrices."""
    values, column, counts = np.unique(np.concatenate(x + y), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(x) + len(y)), [len(s) for s in x + y])
    shared = counts[column] > 1
    owner, column = owner[shared], column[shared]
    names = np.cumsum(counts > 1) - 1
    column = names[column]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(x), len(y)), np.float32)
    step = 4096
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        a, b = np.searchsorted(column, (low, low + step))
        held = np.zeros((len(x) + len(y), step), np.float32)
        held[owner[a:b], column[a:b] - low] = 1
        out += held[: len(x)] @ held[len(x) :].T
    return out.astype(np.int64)


def _across_blocks(apart: DataFrame, texts: DataFrame, percent: int, shingle: int) -> DataFrame:
    """Confirmed links between components in long lists (value, node, component, members).

    Members are dealt into blocks of about BLOCK texts that stand in the same
    list, and every two blocks that any list spans meet once, however many
    lists they share. Two blocks are compared on their full sets by a matrix
    product; of the links found, those that join further components are given out.
    """
    top = apart.groupBy("node").agg(
        F.max(F.struct("members", "value")).alias("top"), F.first("component").alias("component")
    )
    top = top.select("node", "component", F.col("top.value").alias("family"))
    sizes = top.groupBy("family").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    block = F.xxhash64("family", F.pmod(F.xxhash64("node"), F.col("blocks")))
    dealt = stored(top.join(sizes, "family").select("node", "component", block.alias("block")), "blocks")
    spans = apart.join(dealt.select("node", "block"), "node").select("value", "block").distinct()
    other = spans.select("value", F.col("block").alias("other"))
    met = spans.join(other, "value").where("block <= other").select("block", "other").distinct()
    rows = dealt.join(texts, "node")
    left = met.join(rows, "block").select("block", "other", F.lit(0).alias("side"), "node", "component", "text")
    right = met.where("block <> other").join(rows.withColumnRenamed("block", "other"), "other")
    both = left.union(right.select("block", "other", F.lit(1), "node", "component", "text"))

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        sets = [s for c in chunks(pa.array(rows.text, pa.large_string())) for s in shingle_sets(c, shingle)]
        node, component, side = rows.node.to_numpy(), rows.component.to_numpy(), rows.side.to_numpy()
        x = np.flatnonzero(side == 0)
        y = np.flatnonzero(side == 1) if side.any() else x
        common = _overlaps([sets[i] for i in x], [sets[i] for i in y])
        size = np.array([len(s) for s in sets])
        union = size[x][:, None] + size[y][None, :] - common
        at = np.nonzero((100 * common >= percent * union) & (component[x][:, None] != component[y][None, :]))
        root: dict[int, int] = {}

        def find(c: int) -> int:
            while root.get(c, c) != c:
                c = root[c]
            return c

        out = []
        for i, j in zip(x[at[0]], y[at[1]]):
            p, q = find(component[i]), find(component[j])
            if p != q:
                root[max(p, q)] = min(p, q)
                out.append((max(node[i], node[j]), min(node[i], node[j])))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return both.groupBy("block", "other").applyInPandas(compare, "a long, b long")


def _spread(lists: DataFrame, forest: DataFrame | None, turn: int) -> DataFrame:
    """The members of lists that stand in several components, with their component and a pivot of the list."""
    if forest is None:
        state = lists.withColumn("component", F.col("node"))
    else:
        state = lists.join(members(forest), "node", "left")
        state = state.select("value", "node", F.coalesce("component", "node").alias("component"))
    spread = state.groupBy("value").agg(
        F.min("component").alias("low"),
        F.max("component").alias("high"),
        F.count("*").alias("members"),
        F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), "node", "component")).alias("pivot"),
    )
    return stored(state.join(spread.where("low <> high"), "value").drop("low", "high"), "apart")


def link(docs: DataFrame, k: int = K, percent: int = 75, shingle: int = 5, rounds: int = 2) -> tuple[DataFrame, DataFrame]:
    """Per row its signature, and (node, component) of the classes that are linked to another."""
    spark = docs.sparkSession
    signed = stored(signatures(docs, k, shingle), "signatures")
    reps = stored(classes(signed), "classes")
    units = stored(_units(reps), "units")
    lists = stored(inverted_lists(units, 2 * width(spark), k, percent), "lists")
    marks = Marks(lists.select("node"))
    some = stored(_only(reps, marks, ["node", "doc_id", "n", "sketch"], "node"), "candidates")
    marks.close()
    forest = tested = None
    for turn in range(rounds):
        apart = _spread(lists, forest, turn)
        other = F.col("pivot.node")
        found = apart.where(F.col("pivot.component") != F.col("component"))
        found = found.select(F.greatest("node", other).alias("a"), F.least("node", other).alias("b")).distinct()
        found = stored(found if tested is None else found.join(tested, ["a", "b"], "left_anti"), "pairs")
        new = _proved(docs, some, found, k, percent, shingle)
        tested = found if tested is None else tested.union(found)
        forest = star_forest(new if forest is None else forest.union(new))
    apart = _spread(lists, forest, rounds)
    short = _cross(apart.where(F.col("members") <= SHORT)).join(tested, ["a", "b"], "left_anti")
    new = _proved(docs, some, stored(short, "pairs"), k, percent, shingle)
    long = apart.where(F.col("members") > SHORT)
    if not long.isEmpty():
        texts, marks = _texts(docs, some, long.select("node").distinct(), shingle)
        new = new.union(stored(_across_blocks(long, texts, percent, shingle), "links"))
        marks.close()
    return signed, members(star_forest(forest.union(new)))


def _proved(docs: DataFrame, some: DataFrame, pairs: DataFrame, k: int, percent: int, shingle: int) -> DataFrame:
    """Of the pairs (a, b), those that the sketches leave possible and the full sets confirm."""
    likely = stored(_likely(pairs, some, k, percent), "likely")
    nodes = likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct()
    texts, marks = _texts(docs, some, nodes, shingle)
    proved = stored(_confirmed(likely, texts, percent, shingle), "links")
    marks.close()
    return proved


def near_duplicates(docs: DataFrame, k: int = K, percent: int = 75, shingle: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs`` (doc_id, text)."""
    signed, grouped = link(docs, k, percent, shingle)
    named = signed.select("doc_id", "node", "n_shingles").join(grouped, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    least = named.where("node is not null").groupBy("component").agg(F.min("doc_id").alias("least"))
    out = named.join(least, "component", "left")
    alone = F.col("node").isNull()
    return out.select(
        "doc_id",
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("least")).alias("component_id"),
        F.when(alone, F.lit(True)).otherwise(F.col("doc_id").eqNullSafe(F.col("least"))).alias("kept"),
    )


def _with_names(docs: DataFrame, shingle: int) -> DataFrame:
    """The rows with the name of their shingle set, (__node, __check): null for an empty set."""
    schema = docs.withColumn("__node", F.lit(None).cast("long")).withColumn("__check", F.lit(None).cast("long")).schema
    names = docs.columns

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(names.index("text"))):
                found = [
                    np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64) if len(s) else (None, None)
                    for s in shingle_sets(chunk, shingle)
                ]
                more = [pa.array([f[i] for f in found], pa.int64()) for i in range(2)]
                part = batch.slice(chunk.first, len(chunk))
                yield pa.RecordBatch.from_arrays([*part.columns, *more], [*names, "__node", "__check"])

    return docs.mapInArrow(name, schema)


def one_of_each(docs: DataFrame, k: int = K, percent: int = 75, shingle: int = 5) -> DataFrame:
    """The rows of ``docs``, all columns, without the near duplicates of rows that stay.

    Of each component one row stays: that of the least id, before those without id, and
    of several texts or rows under that id the one of the least set name and row hash.
    Each text under a repeated id is judged for itself; rows with the empty set all stay.
    """
    signed, grouped = link(docs, k, percent, shingle)
    named = signed.select("doc_id", "node", "check").join(grouped, "node", "left")
    found = stored(named.withColumn("component", F.coalesce("component", "node")), "near-duplicates")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "node", "check")).alias("stay")
    stay = stored(found.where("node is not null").groupBy("component").agg(least), "kept")
    same = F.struct("doc_id", "node", "check").eqNullSafe(F.struct("stay.doc_id", "stay.node", "stay.check"))
    gone = found.where("doc_id is not null").join(stay, "component").where(~same).select("doc_id")
    twice = found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1")
    twice = stored(twice.select("doc_id"), "repeated")
    left = stored(gone.union(twice).distinct(), "left-out")
    once = docs.join(if_small(left), "doc_id", "left_anti").select(docs.columns)
    if twice.isEmpty() and found.where("doc_id is null").isEmpty():
        return once
    again = docs.join(if_small(twice), "doc_id", "left_semi").select(docs.columns)
    again = _with_names(again.union(docs.where("doc_id is null")), shingle)
    row = F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("__row")
    key = [F.col("doc_id").alias("__id"), "__node", "__check"]
    rows = again.where("__node is not null").groupBy(*key).agg(row)  # a task sends one row of a key, however many it has
    names = stay.select("stay.*").toDF("without", "id", "node", "check")
    chosen = rows.join(names, F.expr("__id <=> id and __node = node and __check = check"), "left_semi")
    empty = again.where("__node is null").select(docs.columns)
    return once.where("doc_id is not null").union(empty).union(chosen.select("__row.*"))
