"""Repeated passages of at least ``length`` bytes, found by a logarithmic family of sparse suffix arrays.

Every window of ``length`` bytes has an anchor: the start, inside the window,
of its ``gram`` bytes with the least hash, the first of equals. Equal windows have their anchor
at the same place, so only suffixes that start at an anchor are indexed, about one
in ``(length - gram) / 2`` bytes, and none of the matches asked for is lost. Consecutive
windows with one anchor are a run. An entry of the index is (gram, context,
number): hashes of the suffix's first bytes and of all bytes that the run's
windows cover, and how often they occur.

* A new batch of documents gets its own array, ordered by gram.
* It is merge-scanned against each existing level: grams in both, or twice in
  the batch, are hits.
* Levels of equal size class merge, and the result again, so that there are
  logarithmically many and an entry is rewritten as often.

Then hits are made exact. A context that occurs twice repeats all windows of
its run. Where one gram has several contexts, the bytes of one run of each
context meet at the gram; their windows are hashed in the task, and those found
under two contexts repeat as well. Runs of a gram with more than ``GROUP``
contexts do not meet: their windows are counted by hash over all tasks, in two
looks. A passage in very many documents is a count, never a list: contexts are
aggregated before they are shuffled.

Defined results: null and empty texts have no bytes; texts shorter than
``length`` keep all. Repeated rows repeat each other. Matches never cross rows. Hashes are of
64 bits. Extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weirstone.llm.bottom_k import Marks, _bits, _only
from weirstone.llm.runtime import remove, scratch, stored
from weirstone.llm.textbytes import Chunk, chunks, mix, range_hash, window_hash

LENGTH = 200
GRAM = 32
SEGMENT = 8 << 20
GROUP = 2048
_U = np.uint64


def _runs(chunk: Chunk, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, first window, last window, gram hash, context hash) of each run; places are bytes of the row.

    A text beyond SEGMENT bytes is worked off in overlapping segments; a run cut there counts as two.
    """
    whole = [(r, int(a), int(b)) for r, (a, b) in enumerate(zip(chunk.offsets, chunk.offsets[1:]))]
    if len(chunk.data) <= SEGMENT:
        parts = [(0, len(chunk.data), whole)]
    else:
        parts = [
            (at, min(b, at + SEGMENT + length - 1), [(r, at, min(b, at + SEGMENT + length - 1))])
            for r, a, b in whole
            for at in range(a, max(a + 1, b - length + 1), SEGMENT)
        ]
    window = length - gram + 1
    for low, high, rows in parts:
        data = chunk.data[low:high]
        if len(data) < length:
            continue
        place = np.arange(len(data) - gram + 1)
        grams = window_hash(data, gram)
        least = (grams >> _U(24) << _U(24)) | place.astype(_U)
        reach = 1
        while 2 * reach <= window:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < window:
            least = np.minimum(least[: len(data) - length + 1], least[window - reach :][: len(data) - length + 1])
        row = np.full(len(least), -1, np.int64)
        for r, a, b in rows:
            row[a - low : max(a - low, b - low - length + 1)] = r
        anchor = (least & _U(0xFFFFFF)).astype(np.int64)
        new = np.append(True, (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1]))
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(least)) - 1
        keep = row[first] >= 0
        first, last = first[keep], last[keep]
        at, owner = anchor[first], row[first]
        context = mix(range_hash(data, first, last + length) + (at - first).astype(_U))
        base = chunk.offsets[owner] - low
        yield owner, first - base, last - base, grams[at], context


def runs(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(uid, low, high, gram, context) of the rows (uid, text)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uid = batch.column("uid").to_numpy()
            for chunk in chunks(batch.column("text")):
                for owner, low, high, name, context in _runs(chunk, length, gram):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(uid[chunk.first + owner])]
                        + [pa.array(x.astype(np.int32)) for x in (low, high)]
                        + [pa.array(x.view(np.int64)) for x in (name, context)],
                        ["uid", "low", "high", "gram", "context"],
                    )

    return docs.select("uid", "text").mapInArrow(find, "uid long, low int, high int, gram long, context long")


class Family:
    """The levels: tables of (gram, context, n), each of a size class, and the grams hit so far."""

    def __init__(self) -> None:
        self.levels: dict[int, tuple[DataFrame, str]] = {}
        self.hits: DataFrame | None = None

    def add(self, batch: DataFrame) -> None:
        """Take in the runs of a new batch."""
        array, folder = self._array(batch.groupBy("gram", "context").agg(F.count("*").alias("n")))
        found = array.groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1").select("gram")
        for level, _ in self.levels.values():
            found = found.union(array.join(level.select("gram"), "gram", "left_semi").select("gram"))
        hits = stored(found.distinct(), "hits")
        self.hits = hits if self.hits is None else self.hits.union(hits)
        size = 0
        while size in self.levels:
            level, old = self.levels.pop(size)
            both, merged = self._array(level.union(array).groupBy("gram", "context").agg(F.sum("n").alias("n")))
            for done in (old, folder):
                remove(both.sparkSession, done)
            array, folder = both, merged
            size += 1
        self.levels[size] = array, folder

    def _array(self, counted: DataFrame) -> tuple[DataFrame, str]:
        folder = scratch(counted.sparkSession, "suffix-array")
        return stored(counted.sortWithinPartitions("gram", "context"), "suffix-array", folder), folder

    def matched(self) -> DataFrame:
        """(gram, context, n, contexts) of the entries whose gram occurs more than once."""
        marks = Marks(self.hits)
        entries = None
        for level, _ in self.levels.values():
            some = _only(level, marks, ["gram", "context", "n"], "gram")
            entries = some if entries is None else entries.union(some)
        entries = stored(entries.groupBy("gram", "context").agg(F.sum("n").alias("n")), "entries")
        per_gram = entries.groupBy("gram").agg(F.count("*").alias("contexts"), F.sum("n").alias("total"))
        return stored(entries.join(per_gram.where("total > 1").drop("total"), "gram"), "matched")


def _pieces(rows: DataFrame, length: int) -> DataFrame:
    """(gram, context, contexts, n, uid, low, piece): the bytes that each run of rows (uid, text, runs) covers."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("runs")
            begin = lists.offsets.to_numpy()
            uids = batch.column("uid").to_numpy()
            for chunk in chunks(batch.column("text")):
                own = slice(begin[chunk.first], begin[chunk.first + len(chunk)])
                fields = {c: lists.values.field(c)[own] for c in ("gram", "context", "contexts", "n", "low", "high")}
                row = np.repeat(np.arange(len(chunk)), np.diff(begin[chunk.first : chunk.first + len(chunk) + 1]))
                data = chunk.data.tobytes()
                low = (chunk.offsets[row] + fields["low"].to_numpy()).tolist()
                high = (chunk.offsets[row] + fields["high"].to_numpy() + length).tolist()
                piece = pa.array([data[a:b] for a, b in zip(low, high)], pa.binary())
                columns = [*(fields[c] for c in ("gram", "context", "contexts", "n")), pa.array(uids[chunk.first + row])]
                yield pa.RecordBatch.from_arrays([*columns, fields["low"], piece], names)

    names = ["gram", "context", "contexts", "n", "uid", "low", "piece"]
    schema = "gram long, context long, contexts long, n long, uid long, low int, piece binary"
    return rows.select("uid", "text", "runs").mapInArrow(cut, schema)


def _hashed(pieces: pa.Array | pa.ChunkedArray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the windows of all pieces in order: piece, offset in it, hash."""
    raw = pieces.to_pylist()
    sizes = np.array([len(p) for p in raw], np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    number = sizes - length + 1
    owner = np.repeat(np.arange(len(raw)), number)
    offset = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
    start = (np.cumsum(sizes) - sizes)[owner] + offset
    return owner, offset, window_hash(data, length)[start]


def _met(pieces: DataFrame, length: int) -> DataFrame:
    """(uid, low, high): windows that pieces of one gram share, as ranges; for pieces that occur once.

    A gram's pieces, at most ``GROUP``, lie side by side; each is of another context.
    """

    def shared(table: pa.Table) -> pa.RecordBatch:
        owner, offset, win = _hashed(table.column("piece"), length)
        order = np.argsort(win, kind="stable")
        equal = win[order[1:]] == win[order[:-1]]
        hit = np.zeros(len(win), bool)
        hit[order[1:][equal]] = True
        hit[order[:-1][equal]] = True
        hit &= (table.column("n").to_numpy() == 1)[owner]
        places = np.flatnonzero(hit)
        new = np.ones(len(places), bool)
        new[1:] = (np.diff(places) > 1) | (np.diff(owner[places]) > 0)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(places))[: len(first)] - 1
        piece = owner[places[first]]
        low = table.column("low").to_numpy()[piece]
        columns = [
            pa.array(table.column("uid").to_numpy()[piece], pa.int64()),
            pa.array((low + offset[places[first]]).astype(np.int32)),
            pa.array((low + offset[places[last]]).astype(np.int32)),
        ]
        return pa.RecordBatch.from_arrays(columns, ["uid", "low", "high"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            table = pa.Table.from_batches([*waiting, batch])
            grams = table.column("gram").to_numpy()
            cut = int(np.searchsorted(grams, grams[-1], "left"))
            if cut:
                yield shared(table.slice(0, cut))
            waiting = table.slice(cut).to_batches()
        if waiting:
            yield shared(pa.Table.from_batches(waiting))

    together = pieces.select("gram", "n", "uid", "low", "piece").repartition("gram").sortWithinPartitions("gram")
    return together.mapInArrow(meet, "uid long, low int, high int")


def _counted(pieces: DataFrame, length: int) -> DataFrame:
    """The same as ``_met`` for grams of any number of contexts, one window at a time."""

    def windows(rows: DataFrame, marks: Marks | None) -> DataFrame:
        sent = None if marks is None else marks.sent

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bits = None if sent is None else _bits(sent)
            for batch in batches:
                owner, offset, win = _hashed(batch.column("piece"), length)
                win = win.view(np.int64)
                keep = np.ones(len(win), bool) if bits is None else bits[win % len(bits)]
                owner, offset, win = owner[keep], offset[keep], win[keep]
                columns = [win] + [batch.column(c).to_numpy()[owner] for c in ("context", "uid", "low")]
                columns[3] = (columns[3] + offset).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["win", "context", "uid", "low"])

        return rows.select("context", "uid", "low", "piece").mapInArrow(find, "win long, context long, uid long, low int")

    per_window = windows(pieces, None).groupBy("win").agg(F.min("context").alias("a"), F.max("context").alias("b"))
    twice = stored(per_window.where("a <> b").select("win"), "windows")
    again = windows(pieces.where("n = 1"), Marks(twice)).join(twice, "win")
    return again.select("uid", "low", F.col("low").alias("high"))


def _uid_texts(docs: DataFrame, uids: DataFrame) -> DataFrame:
    """One row (uid, text) of each wanted text; others fall to a bitmap before the shuffle."""
    return _only(docs, Marks(uids), ["uid", "text"], "uid")


def repeated_windows(docs: DataFrame, length: int, gram: int, batches: int) -> DataFrame:
    """(uid, spans): for texts that hold a repeated window, (first window, last window) of the repeats."""
    batch = F.pmod(F.xxhash64("uid"), F.lit(batches))
    spark, folder = docs.sparkSession, scratch(docs.sparkSession, "runs")
    found = stored(runs(docs, length, gram), "runs", folder)
    family = Family()
    for number in range(batches):
        family.add(found.where(batch == number))
    matched = family.matched()
    marks = Marks(matched.select("gram").distinct())
    some = stored(
        _only(found, marks, ["uid", "low", "high", "gram", "context"], "gram").join(matched, ["gram", "context"]), "some"
    )
    for done in (folder, *(level for _, level in family.levels.values())):
        remove(spark, done)
    whole = some.where("n > 1").select("uid", "low", "high")
    first = some.where("contexts > 1").groupBy("gram", "context", "contexts", "n").agg(F.min(F.struct("uid", "low", "high")).alias("r"))
    listed = stored(
        first.select("r.uid", F.struct("r.low", "r.high", "gram", "context", "contexts", "n").alias("run"))
        .groupBy("uid")
        .agg(F.collect_set("run").alias("runs")),
        "representatives",
    )
    texts = _uid_texts(docs, listed.select("uid")).dropDuplicates(["uid"]).join(listed, "uid")
    pieces = stored(_pieces(texts, length), "pieces")
    few, many = pieces.where(F.col("contexts") <= GROUP), pieces.where(F.col("contexts") > GROUP)
    spans = whole.union(_met(few, length)).union(_counted(many, length))
    return spans.groupBy("uid").agg(F.collect_set(F.struct("low", "high")).alias("spans"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, batches: int = 2) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_text) of ``docs`` (doc_id, text).

    Every byte in a window that starts anywhere else, too, goes. ``kept_text`` is
    the rest as text; a character cut in two is replaced there.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("uid", F.xxhash64("doc_id", "text"))
    spans = stored(repeated_windows(docs, length, gram, batches), "spans")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, spans in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "spans"))):
                raw = text.encode()
                step = np.zeros(len(raw) + 1, np.int32)
                for s in spans or ():
                    step[s["low"]] += 1
                    step[s["high"] + length] -= 1
                gone = np.cumsum(step[:-1]) > 0
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes() if spans else raw
                number = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
                out.append(
                    (doc_id, len(raw), int(gone.sum()), number, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace"))
                )
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * 6, kinds)],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"],
            )

    marks = Marks(spans.select("uid"))
    held = _only(docs, marks, ["doc_id", "text", "uid"], "uid").join(spans, "uid", "left")
    none = F.lit(None).cast(spans.schema["spans"].dataType).alias("spans")
    free = _only(docs, marks, ["doc_id", "text", "uid"], "uid", marked=False)
    rows = held.select("doc_id", "text", "spans").union(free.select("doc_id", "text", none))
    return rows.mapInArrow(cut, schema)
