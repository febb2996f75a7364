"""Exact top-k search by inner product over a pivot-distance index.

``build`` scales each vector's components to integers floor(scale * x) and adds
one coordinate, sqrt(M^2 - |x|^2) with M the largest norm, so that a larger inner product
with a query is a smaller distance to it. A vector's key is its nearest pivot and its distance
to it: the annulus, one of ``rings`` per pivot, and the distance within. Pivots and ring borders are fitted on a
bounded sample, the ``sample`` vectors whose id and components hash lowest; every vector is
indexed. The vectors of an annulus are sorted by distance and stored in blocks of up to 512;
the directory, ``pivots * rings`` rows at most, has each annulus's count and least and greatest distance.

``search`` takes queries in blocks of 128 neighbours. By the triangle
inequality a vector at distance r from pivot p is at least |d(q, p) - r| from
query q, which bounds its score from above. Each query goes through its annuli from
the best bound down, 8, then 64, then 512 ... of them, and leaves out those whose
bound is under its k-th best score so far; so it stops when no bound reaches it. A visit is a join of query
blocks and row blocks on (annulus, part), both shuffled; parts of an annulus are 64 blocks, so a
hot one is spread over tasks. The result is exact: bounds have slack
for rounding, and scores are exact integers (float64 products while they stay below 2^53,
Python integers beyond; a score outside 64 bits is returned as the nearest 64-bit value).

Defined results: vectors that are null, hold null or non-finite components, or
whose scaled components are not finite, take no part; neither do rows without id. Shorter vectors
count as filled up with zeros. Rows with the same id are rows of their own: each is a query if its
id is one, and a candidate for all but itself. Ties go to the smaller id. An empty table gives none;
extra columns are not looked at. With vectors spread evenly in many dimensions distances to pivots
say little, and a query then visits most annuli: exactness has that price.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from weirstone.llm.runtime import stored

PIVOTS = 32
RINGS = 16
SAMPLE = 4096
BLOCK = 512
QUERY_BLOCK = 128
PART_BLOCKS = 64
REACH = 8
EXACT = float(1 << 53)
_KINDS = (np.int16, np.int32, np.float64)


@dataclass(frozen=True)
class Index:
    """Pivots with their extra coordinate, ring borders, the directory of annuli, and the stored vectors and blocks."""

    pivots: np.ndarray
    borders: np.ndarray
    reach: float  # M squared
    size: int  # components of the longest vector
    directory: list[tuple[int, int, float, float]]  # annulus, parts, least and greatest distance
    vectors: DataFrame
    blocks: DataFrame


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """Lists of numbers as rows, filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    out = np.zeros((len(column), size))
    if len(values):
        out[np.arange(size)[None, :] < lengths[:, None]] = values
    return out


def _extended(x: np.ndarray, reach: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(reach - (x * x).sum(axis=1), 0.0))
    return np.concatenate((x, rest[:, None]), axis=1)


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)[None, :] - 2 * (x @ pivots.T)
    return np.sqrt(np.maximum(squares, 0.0))


def _fitted(sample: np.ndarray, pivots: int, rings: int) -> tuple[np.ndarray, np.ndarray]:
    """Pivots by farthest-first seeds and a few rounds of means, and ring borders by quantiles of distance."""
    centres = [sample[0]]
    nearest = ((sample - centres[0]) ** 2).sum(axis=1)
    while len(centres) < min(pivots, len(sample)) and nearest.max() > 0:
        centres.append(sample[int(nearest.argmax())])
        nearest = np.minimum(nearest, ((sample - centres[-1]) ** 2).sum(axis=1))
    pivot = np.array(centres)
    for _ in range(5):
        own = _distances(sample, pivot).argmin(axis=1)
        for k in range(len(pivot)):
            if (own == k).any():
                pivot[k] = sample[own == k].mean(axis=0)
    return pivot, np.quantile(_distances(sample, pivot).min(axis=1), np.arange(1, rings) / rings)


def _bytes(x: np.ndarray) -> tuple[int, bytes]:
    most = float(np.abs(x).max()) if x.size else 0.0
    kind = 0 if most < 1 << 15 else 1 if most < 1 << 31 else 2
    return kind, np.ascontiguousarray(x, _KINDS[kind]).tobytes()


def _rows(kind: int, data: bytes, count: int) -> np.ndarray:
    return np.frombuffer(data, _KINDS[kind]).reshape(count, -1).astype(np.float64)


def _keyed(pivots: np.ndarray, borders: np.ndarray, reach: float, size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("vector"), size)
            d = np.nan_to_num(_distances(_extended(x, reach), pivots), nan=np.inf, posinf=np.inf)
            nearest = d.argmin(axis=1)
            distance = d[np.arange(len(x)), nearest] if len(x) else np.empty(0)
            annulus = nearest * (len(borders) + 1) + np.searchsorted(borders, distance, "right")
            kinds = [_bytes(one) for one in x]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"), batch.column("vec_id"), pa.array(annulus, pa.int32()), pa.array(distance, pa.float64()),
                    pa.array([k for k, _ in kinds], pa.int32()), pa.array([b for _, b in kinds], pa.binary()),
                ],
                ["row", "vec_id", "annulus", "distance", "kind", "vector"],
            )

    return run


_KEYED = "row bigint, vec_id bigint, annulus int, distance double, kind int, vector binary"
_BLOCKS = "annulus int, part bigint, least double, most double, rows array<bigint>, ids array<bigint>, kind int, vectors binary"


def _blocked(size: int, most: int):
    """Consecutive rows of an annulus and part as blocks, of fewer rows if vectors are long."""
    most = max(1, min(most, (1 << 21) // max(size, 1)))

    def block(key: tuple, held: list[tuple]) -> tuple:
        kind = max(k for _, _, _, k, _ in held)
        x = np.concatenate([np.frombuffer(b, _KINDS[k]).astype(_KINDS[kind]) for _, _, _, k, b in held])
        distances = [d for _, _, d, _, _ in held]
        return (*key, min(distances), max(distances), [r for r, *_ in held], [i for _, i, *_ in held], kind, x.tobytes())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int32(), pa.binary()]
        names = ["annulus", "part", "least", "most", "rows", "ids", "kind", "vectors"]

        def given(blocks: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*blocks, strict=True), kinds, strict=True)], names)

        key, held = None, []
        for batch in batches:
            done = []
            for *new, row, vec_id, distance, kind, vector in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (tuple(new) != key or len(held) == most):
                    done.append(block(key, held))
                    held = []
                key = tuple(new)
                held.append((row, vec_id, distance, kind, vector))
            if done:
                yield given(done)
        if held:
            yield given([block(key, held)])

    return run


def _in_blocks(keyed: DataFrame, parts: Column, size: int, most: int) -> DataFrame:
    dealt = keyed.withColumn("part", F.pmod(F.xxhash64("row"), parts))
    sorted_rows = dealt.repartition("annulus", "part").sortWithinPartitions("annulus", "part", "distance", "row")
    return sorted_rows.select("annulus", "part", "row", "vec_id", "distance", "kind", "vector").mapInArrow(_blocked(size, most), _BLOCKS)


def build(table: DataFrame, scale: int = 256, pivots: int = PIVOTS, rings: int = RINGS, sample: int = SAMPLE) -> Index | None:
    """The index over ``table`` (vec_id, embedding), or None without any usable vector."""
    scaled = F.transform("embedding", lambda x: F.lit(float(scale)) * x.cast("double"))
    usable = F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    raw = table.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("bigint").alias("vec_id"), scaled.alias("v"))
    # SQL's floor is a bigint; doubles from 2^52 on are whole already
    whole = F.transform("v", lambda x: F.when(F.abs(x) < float(1 << 52), F.floor(x).cast("double")).otherwise(x))
    vectors = raw.where(F.coalesce(usable, F.lit(False))).select("row", "vec_id", whole.alias("vector"))
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    known = vectors.agg(F.max(square).alias("reach"), F.max(F.size("vector")).alias("size")).first()
    if known["reach"] is None:
        return None
    reach, size = known["reach"] * (1 + 1e-12), max(known["size"], 1)
    picked = vectors.orderBy(F.xxhash64("vec_id", "vector"), "vec_id", "vector").limit(sample).select("vector").toArrow()
    pivot, borders = _fitted(_extended(_matrix(picked.column("vector"), size), reach), pivots, rings)
    keyed = stored(vectors.mapInArrow(_keyed(pivot, borders, reach, size), _KEYED), "keyed")
    part_rows = PART_BLOCKS * BLOCK
    found = keyed.groupBy("annulus").agg(F.count("*").alias("n"), F.min("distance").alias("least"), F.max("distance").alias("most")).collect()
    directory = [(r["annulus"], -(-r["n"] // part_rows), r["least"], r["most"]) for r in found]
    parts = F.create_map(*[F.lit(x) for annulus, n, *_ in directory for x in (annulus, n)])
    blocks = stored(_in_blocks(keyed, parts[F.col("annulus")], size, BLOCK), "blocks")
    return Index(pivot, borders, reach, size, directory, keyed, blocks)


_QUERIES = "number bigint, rows array<bigint>, ids array<bigint>, floors array<double>, kind int, vectors binary"
_VISITS = "annulus int, part bigint, number bigint, places array<int>, q_rows array<bigint>, q_ids array<bigint>, floors array<double>, q_kind int, q_vectors binary"


def _visits(index: Index, begin: int, end: int):
    """For each query block the annuli, from place ``begin`` to ``end`` in each query's order, that a query still needs."""
    directory = index.directory
    pivots, reach, size = index.pivots, index.reach, index.size
    per = len(index.borders) + 1
    nearest = np.array([a // per for a, *_ in directory])
    least, most = (np.array([row[i] for row in directory]) for i in (2, 3))
    names = ["annulus", "part", "number", "places", "q_rows", "q_ids", "floors", "q_kind", "q_vectors"]
    kinds = [
        pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.float64()),
        pa.int32(), pa.binary(),
    ]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                x = _rows(row["kind"], row["vectors"], len(row["rows"]))
                own = (x * x).sum(axis=1)
                d = _distances(np.concatenate((x, np.zeros((len(x), 1))), axis=1), pivots)[:, nearest]
                gap = np.maximum(np.maximum(d - most, least - d), 0.0)
                total = (own + reach)[:, None]
                bound = (total - gap * gap) / 2
                order = np.argsort(-bound, axis=1, kind="stable")
                place = np.empty_like(order)
                np.put_along_axis(place, order, np.arange(order.shape[1])[None, :], axis=1)
                floors = np.array(row["floors"], np.float64)
                needed = (place >= begin) & (place < end) & ~(bound + 1e-9 * total + 1 < floors[:, None])
                out = []
                for a in np.flatnonzero(needed.any(axis=0)).tolist():
                    some = np.flatnonzero(needed[:, a])
                    kind, data = _bytes(x[some])
                    shared = (
                        row["number"], some.tolist(), [row["rows"][i] for i in some], [row["ids"][i] for i in some], floors[some].tolist(),
                        kind, data,
                    )
                    out += [(directory[a][0], part, *shared) for part in range(directory[a][1])]
                for i in range(0, len(out), 64):
                    columns = zip(*out[i : i + 64], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)

    return run


_SCORED = "number bigint, place int, q_id bigint, row bigint, vec_id bigint, value decimal(38,0), score bigint"


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    size = max(q.shape[1], 1)
    if float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * size < EXACT:
        return q @ x.T
    whole = [[[int(v) for v in row] for row in side.tolist()] for side in (q, x)]
    return np.array([[sum(a * b for a, b in zip(one, other, strict=True)) for other in whole[1]] for one in whole[0]], object)


_LEAST, _MOST = -(1 << 63), (1 << 63) - 1
_WIDEST = 10**38 - 1


def _scored(k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from decimal import Decimal

        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.decimal128(38, 0), pa.int64()]
        names = ["number", "place", "q_id", "row", "vec_id", "value", "score"]
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                q, x = _rows(r["q_kind"], r["q_vectors"], len(r["places"])), _rows(r["kind"], r["vectors"], len(r["rows"]))
                scores = _scores(q, x)
                rows, ids = np.array(r["rows"]), np.array(r["ids"])
                own = np.array(r["q_rows"])[:, None] == rows[None, :]
                valid = scores.astype(np.float64)
                valid[own] = -np.inf
                floor = np.array(r["floors"], np.float64)
                if valid.shape[1] > k:
                    floor = np.maximum(floor, np.partition(valid, -k, axis=1)[:, -k])
                # floors are rounded to doubles, so what is just under may come along; the ranking below is exact
                a, b = np.nonzero((valid >= (floor - 1e-9 * np.abs(floor))[:, None]) & ~own)
                if not len(a):
                    continue
                value = scores[a, b]
                order = np.lexsort((rows[b], ids[b], -value, a))
                a, b, value = a[order], b[order], value[order]
                first = np.searchsorted(a, a)
                kept = np.arange(len(a)) - first < k
                a, b, value = a[kept], b[kept], value[kept]
                places, q_ids = np.array(r["places"]), np.array(r["q_ids"])
                for column, values in zip(out, ([r["number"]] * len(a), places[a].tolist(), q_ids[a].tolist(), rows[b].tolist(), ids[b].tolist(), [int(v) for v in value]), strict=True):
                    column += values
            exact = [Decimal(max(-_WIDEST, min(_WIDEST, v))) for v in out[5]]
            score = [max(_LEAST, min(_MOST, v)) for v in out[5]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip([*out[:5], exact, score], kinds, strict=True)], names)

    return run


def search(index: Index | None, queries: Column, k: int, spark) -> DataFrame:
    """(query_id, rank, vec_id, score): for each indexed row that ``queries`` chooses, its ``k`` best others."""
    if index is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    chosen = index.vectors.where(queries)
    blocks = _in_blocks(chosen, F.lit(1), index.size, QUERY_BLOCK)
    floors = F.transform("rows", lambda r: F.lit(float("-inf")))
    waiting = stored(
        blocks.select(F.monotonically_increasing_id().alias("number"), "rows", "ids", floors.alias("floors"), "kind", "vectors"), "queries"
    )
    best: DataFrame | None = None
    begin, end = 0, REACH
    order = Window.partitionBy("number", "place").orderBy(F.desc("value"), "vec_id", "row")
    while True:
        asked = waiting if best is None else _raised(waiting, best, k)
        # the planner takes visits to be as small as the queries, though there are up to one per query and annulus: never broadcast
        visits = asked.mapInArrow(_visits(index, begin, end), _VISITS).hint("shuffle_merge")
        met = visits.join(index.blocks, ["annulus", "part"])
        met = met.select("number", "places", "q_rows", "q_ids", "floors", "q_kind", "q_vectors", "rows", "ids", "kind", "vectors")
        found = met.mapInArrow(_scored(k), _SCORED)
        found = found if best is None else found.unionByName(best.drop("rank"))
        best = stored(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "best")
        if end >= len(index.directory):
            return best.select(F.col("q_id").alias("query_id"), "rank", "vec_id", "score")
        begin, end = end, end * 8


def _raised(waiting: DataFrame, best: DataFrame, k: int) -> DataFrame:
    """The query blocks with each query's k-th best score, if it has one."""
    kth = best.where(F.col("rank") == k).groupBy("number").agg(F.map_from_entries(F.collect_list(F.struct("place", F.col("value").cast("double")))).alias("kth"))
    floors = F.transform("rows", lambda r, i: F.coalesce(F.try_element_at("kth", i), F.lit(float("-inf"))))
    return waiting.join(kth, "number", "left").select("number", "rows", "ids", floors.alias("floors"), "kind", "vectors")
