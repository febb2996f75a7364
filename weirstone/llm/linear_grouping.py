"""Best-fit packing of token sequences by linear grouping.

The planner sees lengths and how often each occurs, at most ``capacity`` rows
whatever the input, and works on runs of equal sequences:

1. large lengths are sorted and cut into groups of equal cardinality; every
   length of a group is rounded up to the group's largest. What counts as
   large, over a half to an eighth of the capacity, is tried out: the plan of fewest sequences is taken;
2. with these few sizes, configurations are optimised: the largest size left
   is taken and its sequence filled as far as any choice of sizes left can
   fill it (a knapsack over the capacity), as often as the supply allows;
3. each slot of a configuration takes actual documents of its group, whose
   lengths are at most the rounded size, so runs split into a few runs;
4. small documents, longest first, go where they leave least room.

The plan is a set of runs: documents of a length, by rank, go to consecutive sequences
at one offset. Documents get their rank in their length by counting in
buckets, so no length is gathered in one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from weirstone.llm.runtime import stored, width
from weirstone.llm.tokens import encoded

CAPACITY = 4096
GROUPS = 512
SHARES = (2, 3, 4, 8)
END = 1


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of whole texts as ids and ``end``, cut only where longer than the capacity."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, number, start, length, crc = [], [], [], [], []
            for row, ids in encoded(batch.column("text"), path):
                ids = np.append(ids, end).astype("<u4")
                for k, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at : at + capacity]
                    rows.append(row)
                    number.append(k)
                    start.append(at)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(number, pa.int32())]
                + [pa.array(x, pa.int64()) for x in (start, length, crc)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


@dataclass
class Run:
    """``count`` sequences alike: the room left, and (length, first rank) of what they hold."""

    count: int
    room: int
    held: list[tuple[int, int]] = field(default_factory=list)


def _groups(lengths: np.ndarray, counts: np.ndarray, groups: int) -> list[list[list[int]]]:
    """Large lengths, longest first, in groups of equal cardinality: lists of [length, number left]."""
    total = int(counts.sum())
    size = max(1, -(-total // groups))
    out, room = [], 0
    for length, count in zip(lengths[::-1].tolist(), counts[::-1].tolist()):
        while count:
            if not room:
                out.append([])
                room = size
            take = min(room, count)
            out[-1].append([length, take])
            room -= take
            count -= take
    return out


def _fill(room: int, sizes: np.ndarray, supply: np.ndarray) -> list[int]:
    """Groups whose sizes fill the room as far as possible, none beyond its supply."""
    usable = [g for g in np.flatnonzero(supply) if sizes[g] <= room]
    # reach[r]: the group last used to fill exactly r, -2 for the empty choice, -1 for none
    reach = np.full(room + 1, -1, np.int32)
    reach[0] = -2
    for g in usable:
        s = int(sizes[g])
        for _ in range(min(int(supply[g]), room // s)):
            new = np.flatnonzero((reach[:-s] != -1) & (reach[s:] == -1) & (reach[:-s] != g)) + s if _ == 0 else (
                np.flatnonzero((reach[:-s] == g) & (reach[s:] == -1)) + s
            )
            if not len(new):
                break
            reach[new] = g
        if reach[room] != -1:
            break
    at = int(np.flatnonzero(reach != -1)[-1])
    chosen: list[int] = []
    while at:
        g = int(reach[at])
        chosen.append(g)
        at -= int(sizes[g])
    return chosen


def _take(queue: list[list[int]], n: int, ranks: dict[int, int]) -> list[tuple[int, int, int]]:
    """The next n documents of a group as (length, first rank, number)."""
    out = []
    while n:
        length, left = queue[0]
        k = min(n, left)
        out.append((length, ranks.get(length, 0), k))
        ranks[length] = ranks.get(length, 0) + k
        n -= k
        queue[0][1] -= k
        if not queue[0][1]:
            queue.pop(0)
    return out


def _substitute(slots: list[list[tuple[int, int, int]]], capacity: int) -> Iterator[Run]:
    """Runs of sequences that hold, for each slot, the same length."""
    at = [0] * len(slots)
    used = [0] * len(slots)
    while at[0] < len(slots[0]):
        n = min(slot[i][2] - u for slot, i, u in zip(slots, at, used))
        held = [(slot[i][0], slot[i][1] + u) for slot, i, u in zip(slots, at, used)]
        yield Run(n, capacity - sum(length for length, _ in held), held)
        for s, slot in enumerate(slots):
            used[s] += n
            if used[s] == slot[at[s]][2]:
                at[s], used[s] = at[s] + 1, 0


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, shares=SHARES) -> list[Run]:
    """Runs that hold every document of the histogram (length: number), with the bound of large lengths that does best."""
    plans = (_plan(histogram, capacity, groups, capacity // share) for share in shares)
    return min(plans, key=lambda runs: sum(run.count for run in runs))


def _plan(histogram: dict[int, int], capacity: int, groups: int, bound: int) -> list[Run]:
    lengths = np.array(sorted(histogram), np.int64)
    counts = np.array([histogram[x] for x in lengths.tolist()], np.int64)
    large = lengths > bound
    queues = _groups(lengths[large], counts[large], groups)
    sizes = np.array([queue[0][0] for queue in queues], np.int64)
    supply = np.array([sum(n for _, n in queue) for queue in queues], np.int64)
    ranks: dict[int, int] = {}
    runs: list[Run] = []
    while supply.any():
        first = int(np.flatnonzero(supply)[0])
        rest = supply.copy()
        rest[first] -= 1
        chosen = [first, *_fill(capacity - int(sizes[first]), sizes, rest)]
        need = np.bincount(chosen, minlength=len(sizes))
        times = int((supply[need > 0] // need[need > 0]).min())
        supply -= need * times
        runs += _substitute([_take(queues[g], times, ranks) for g in chosen], capacity)
    _best_fit(runs, {int(x): int(n) for x, n in zip(lengths[~large], counts[~large])}, ranks, capacity)
    return runs


def _best_fit(runs: list[Run], small: dict[int, int], ranks: dict[int, int], capacity: int) -> None:
    by_room: list[list[Run]] = [[] for _ in range(capacity + 1)]
    filled = np.zeros(capacity + 1, bool)
    for run in runs:
        by_room[run.room].append(run)
        filled[run.room] = True

    def put(run: Run, length: int, n: int) -> None:
        """n of the run's sequences, which is in no list, take a document of the length."""
        if n < run.count:
            rest = Run(run.count - n, run.room, [(x, r + n) for x, r in run.held])
            runs.append(rest)
            by_room[rest.room].append(rest)
            filled[rest.room] = True
            run.count = n
        run.held.append((length, ranks.get(length, 0)))
        ranks[length] = ranks.get(length, 0) + n
        run.room -= length
        by_room[run.room].append(run)
        filled[run.room] = True

    for length in sorted(small, reverse=True):
        left = small[length]
        while left:
            fits = filled[length:]
            room = length + int(fits.argmax())
            if fits.any():
                run = by_room[room].pop()
                filled[room] = bool(by_room[room])
                n = min(left, run.count)
            else:  # new sequences, only as many as documents of this length fill
                n = max(1, left // (capacity // length))
                run = Run(n, capacity)
                runs.append(run)
            put(run, length, n)
            left -= n


def _places(runs: list[Run]) -> dict[int, np.ndarray]:
    """For each length: (first rank, first sequence, offset), by first rank."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    first = 0
    for run in runs:
        offset = 0
        for length, rank in run.held:
            out.setdefault(length, []).append((rank, first, offset))
            offset += length
        first += run.count
    return {length: np.array(sorted(rows), np.int64) for length, rows in out.items()}


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """The pieces of ``docs`` (doc_id, text) with sequence_id and offset.

    Null and empty texts are one piece, the end id alone. Repeated rows are
    packed each; equal rows may change places. Extra columns are not looked at.
    """
    spark = docs.sparkSession
    cut = stored(pieces(docs, path, capacity), "pieces")
    buckets = 4 * width(spark)
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets))
    cut = cut.withColumn("bucket", bucket)
    counted = stored(cut.groupBy("length", "bucket").agg(F.count("*").alias("n")), "counts")
    before = F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    counted_before = counted.select("length", "bucket", F.coalesce(before, F.lit(0)).alias("before"))
    histogram = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    shared = spark.sparkContext.broadcast(_places(plan(histogram, capacity, groups)))
    inside = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32"))
    ranked = cut.withColumn("inside", inside).join(counted_before, ["length", "bucket"])
    ranked = ranked.select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("inside") - 1).alias("rank")
    )

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sequence = np.empty(len(batch), np.int64)
            offset = np.empty(len(batch), np.int64)
            for length, at in batch.groupby("length").indices.items():
                rank, first, where = shared.value[length].T
                ranks = batch["rank"].to_numpy()[at]
                k = np.searchsorted(rank, ranks, "right") - 1
                sequence[at] = first[k] + ranks - rank[k]
                offset[at] = where[k]
            yield batch.drop(columns="rank").assign(sequence_id=sequence, offset=offset)

    return ranked.mapInPandas(
        place,
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )
