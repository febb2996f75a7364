"""Documents of flat, unindexed token files, found by their end-of-document ids.

A token file is ids end to end, little-endian, nothing else. ``scan`` cuts
files into blocks, whatever documents lie where. Each block is read once, as a
range, and searched with one vector comparison for the separator; what is left
of it is where its separators stand. A prefix scan over the blocks of a file
(within stretches of ``STRETCH`` blocks, over stretches, and both together, so
that no task holds a row per block of a large file) tells each block how many
documents ended before it and where the one that reaches into it began. So
documents longer than a block, and separators at its edges, are stitched.

``write`` makes such files from texts, to try the scan on. Files have fresh names, and only those of
tasks that ended well are listed.

Defined results: a null or empty text is a document of no tokens; so is what two
neighbouring separators enclose. Repeated rows are documents each, extra columns are not looked at. An id that does
not fit the width, or is the separator itself, stops ``write``. Tokens after a file's last separator are one
document that is not ended. An empty file holds nothing. A file whose size is
no multiple of the width raises an error.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from weirstone.llm.runtime import scratch, stored, tasks_for
from weirstone.llm.tokens import encoded
from weirstone.llm.zip_warc import _place

SEPARATOR = 49407
WIDTH = 2
BLOCK_BYTES = 4 << 20
STRETCH = 1024


def write(docs: DataFrame, path: str, folder: str, separator: int = SEPARATOR, width: int = WIDTH) -> DataFrame:
    """(path, ordinal, doc_id) of the documents written to token files; a separator follows each."""
    kind = f"<u{width}"

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = f"{folder}/{uuid.uuid4().hex}.tokens"
        system, local = _place(file)
        system.create_dir(local.rpartition("/")[0], recursive=True)
        number = 0
        with system.open_output_stream(local) as out:
            for batch in batches:
                for _, ids in encoded(batch.column("text"), path):
                    if len(ids) and (int(ids.max()) >> 8 * width or bool((ids == separator).any())):
                        raise ValueError(f"ids must fit {width} bytes and differ from the separator {separator}")
                    out.write(np.append(ids, separator).astype(kind).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([file] * len(batch), pa.string()),
                        pa.array(np.arange(number, number + len(batch))),
                        batch.column("doc_id"),
                    ],
                    ["path", "ordinal", "doc_id"],
                )
                number += len(batch)

    return stored(docs.select("doc_id", "text").mapInArrow(put, "path string, ordinal long, doc_id long"), "written")


def _found(files: DataFrame, separator: int, width: int, block_bytes: int) -> DataFrame:
    """Each block's separators: their number, the last and all of their places in the file."""

    def size(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column(0).to_pylist()
            sizes = [system.get_file_info(local).size for system, local in map(_place, paths)]
            if bad := [p for p, s in zip(paths, sizes) if s % width]:
                raise ValueError(f"{bad[0]} does not hold whole ids of {width} bytes")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], ["path", "size"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, block, size in zip(*(c.to_pylist() for c in batch.columns)):
                system, local = _place(path)
                with system.open_input_file(local) as file:
                    raw = file.read_at(min(block_bytes, size - block * block_bytes), block * block_bytes)
                ends = np.flatnonzero(np.frombuffer(raw, f"<u{width}") == separator) + block * block_bytes // width
                row = ([path], [block], [len(raw) // width], [len(ends)], [int(ends[-1]) if len(ends) else -1], [ends.tobytes()])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in row], ["path", "block", "tokens", "number", "last", "ends"]
                )

    schema = "path string, block long, tokens long, number long, last long, ends binary"
    sized = files.select("path").mapInArrow(size, "path string, size long").where("size > 0")
    last = F.floor((F.col("size") - 1) / block_bytes).cast("long")
    blocks = sized.select("path", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"), "size")
    total = sized.agg(F.sum("size")).first()[0] or 0
    return blocks.repartition(tasks_for(total, files.sparkSession), "path", "block").mapInArrow(search, schema)


def scan(files: DataFrame, separator: int = SEPARATOR, width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(path, ordinal, start, n_tokens, ended) of the documents in token files (path); start counts ids from 0."""
    if block_bytes % width:
        raise ValueError("blocks hold whole ids")
    blocks = stored(_found(files, separator, width, block_bytes), "blocks")
    sums = blocks.withColumn("stretch", F.floor(F.col("block") / STRETCH)).drop("ends")

    def before(columns: list[str], order: str) -> tuple[F.Column, F.Column]:
        """Separators, and the place of the last one, in the rows before."""
        rows = Window.partitionBy(*columns).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("number").over(rows), F.lit(0)), F.coalesce(F.max("last").over(rows), F.lit(-1))

    totals = sums.groupBy("path", "stretch").agg(F.sum("number").alias("number"), F.max("last").alias("last"))
    number, last = before(["path"], "stretch")
    totals = totals.select("path", "stretch", number.alias("n0"), last.alias("p0"))
    number, last = before(["path", "stretch"], "block")
    ends_file = sums.groupBy("path").agg(F.max("block").alias("final"))
    own = sums.select("path", "block", "stretch", number.alias("n1"), last.alias("p1"))
    carried = own.join(totals, ["path", "stretch"]).join(ends_file, "path").select(
        "path", "block", (F.col("n0") + F.col("n1")).alias("number_before"), F.greatest("p0", "p1").alias("last_before"),
        (F.col("block") == F.col("final")).alias("final"),
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ends = np.frombuffer(row["ends"], np.int64)
                starts = np.append(row["last_before"], ends) + 1
                stop = row["block"] * (block_bytes // width) + row["tokens"]
                if row["final"] and starts[-1] < stop:
                    ends = np.append(ends, stop)
                n = len(ends)
                ended = np.ones(n, bool)
                ended[len(row["ends"]) // 8 :] = False
                columns = [
                    pa.array([row["path"]] * n, pa.string()),
                    pa.array(row["number_before"] + np.arange(n)),
                    pa.array(starts[:n]),
                    pa.array(ends - starts[:n]),
                    pa.array(ended),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["path", "ordinal", "start", "n_tokens", "ended"])

    joined = blocks.select("path", "block", "tokens", "ends").join(carried, ["path", "block"])
    return joined.mapInArrow(cut, "path string, ordinal long, start long, n_tokens long, ended boolean")


def count(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens) of ``docs`` (doc_id, text), by way of token files in the shared folder."""
    written = write(docs, path, scratch(docs.sparkSession, "tokens"))
    return scan(written.select("path").distinct()).join(written, ["path", "ordinal"]).select("doc_id", "n_tokens")
