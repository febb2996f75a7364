"""WARC records in ZIP packages: written once, found by the packages' directories, read by ranges.

``write`` puts one WARC record per page into packages with the stored members
``archive/data.warc.gz`` (one gzip member per record), ``indexes/index.cdx``
(offset and length of each record) and ``datapackage.json``. Of pages with
equal payloads one is a response and the others revisit it.

``members`` reads the end of a package and its central directory, ZIP64
included, and finds where a stored member's bytes lie; ``records`` reads the indexes, and then
ranges of neighbouring records, each range a task's work of bounded size. No
package is read whole or unpacked.

Packages are written under fresh names; only those of tasks that ended well
are in the returned table, so a repeated task does no harm. A package is closed when it holds ``package_bytes``, and
the task goes on with the next; that every row became a record is checked. Ranges are dealt to a number of tasks that
follows from the bytes to be read.

Defined results: a null or empty html is an empty payload, which is compared like any other
if ``least_bytes`` allows. Rows that repeat the largest page_id of a payload
are responses each; a page without id never has precedence over one with an id. An empty table gives an
empty one. A very long html is a record of its own, larger than ``range_bytes`` as it may be. Extra columns are not looked at.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import itertools
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Observation, functions as F

from weirstone.llm.runtime import scratch, stored, tasks_for

PACKAGE_BYTES = 256 << 20
RANGE_BYTES = 1 << 20
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAME = "urn:weirstone:page:"


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def record(page_id: int | None, url: str | None, payload: bytes, sha1: bytes, refers_to: int | None) -> bytes:
    """A WARC record; a revisit if it refers to another page."""
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<{NAME}{'' if page_id is None else page_id}>",
        "WARC-Target-URI": "".join((url or "").split()),
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Payload-Digest": f"sha1:{base64.b32encode(sha1).decode()}",
        "X-Payload-Length": str(len(payload)),
        "Content-Type": "application/http; msgtype=response",
    }
    if refers_to is not None:
        head |= {"WARC-Refers-To": f"<{NAME}{refers_to}>", "WARC-Profile": PROFILE}
    block = HTTP + (payload if refers_to is None else b"")
    head["Content-Length"] = str(len(block))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def parsed(raw: bytes) -> tuple[int | None, int, str, str, int | None]:
    """(page_id, payload bytes, base-32 SHA-1, record type, page referred to) of a record, its digest proved if the payload is there."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    number = lambda key: int(x) if (x := fields.get(key, "<>")[1:-1].removeprefix(NAME)) else None
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(fields["X-Payload-Length"])
    if fields["WARC-Type"] == "response":
        payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")[2]
        size, found = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if found != digest:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} does not have the digest {digest}")
    return number("WARC-Record-ID"), size, digest, fields["WARC-Type"], number("WARC-Refers-To")


def decided(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, url, html, sha1, refers_to): refers_to is null for responses. Only ids and digests are grouped."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha1(html.cast("binary")).alias("sha1"))
    first = rows.where(F.octet_length("html") >= least_bytes).groupBy("sha1").agg(F.max("page_id").alias("first"))
    other = ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(first, "sha1", "left").select(
        "page_id", "url", "html", "sha1", F.when(other, F.col("first")).alias("refers_to")
    )


def write(pages: DataFrame, folder: str, least_bytes: int = 0, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """The packages (path, records, bytes) that hold a record for each row of ``pages`` (page_id, url, html)."""

    def package(head: dict, rows: Iterator[dict]) -> tuple[str, int, int]:
        path = f"{folder}/{uuid.uuid4().hex}.wacz"
        system, local = _place(path)
        system.create_dir(local.rpartition("/")[0], recursive=True)
        index, at = [], 0
        with system.open_output_stream(local) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as archive:
            with archive.open(zipfile.ZipInfo("archive/data.warc.gz"), "w", force_zip64=True) as member:
                # a chain, not a generator: ending the loop early leaves ``rows`` open for the next package
                for r in itertools.chain([head], rows):
                    raw = record(r["page_id"], r["url"], r["html"].encode(), bytes.fromhex(r["sha1"]), r["refers_to"])
                    packed = gzip.compress(raw, 3, mtime=0)
                    member.write(packed)
                    index.append(f"{at} {len(packed)}\n")
                    at += len(packed)
                    if at >= package_bytes:
                        break
            archive.writestr(zipfile.ZipInfo("indexes/index.cdx"), "".join(index))
            archive.writestr(zipfile.ZipInfo("datapackage.json"), json.dumps({"profile": "data-package", "wacz_version": "1.1.1"}))
        return path, len(index), at

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for at in range(0, len(batch), 500) for row in batch.slice(at, 500).to_pylist())
        for head in rows:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in package(head, rows)], ["path", "records", "bytes"])

    seen = Observation()
    given = decided(pages, least_bytes).observe(seen, F.count(F.lit(1)).alias("rows"))
    packages = stored(given.mapInArrow(put, "path string, records long, bytes long"), "packages")
    written = packages.agg(F.coalesce(F.sum("records"), F.lit(0)).alias("records")).first()["records"]
    if written != seen.get["rows"]:
        raise RuntimeError(f"{written} records written for {seen.get['rows']} pages")
    return packages


def directory(read: Callable[[int, int], bytes], size: int) -> Iterator[tuple[str, int, int, int]]:
    """(name, method, first byte, bytes) of each member, from the end of a package; ``read`` takes offset and length."""
    tail_at = max(0, size - 65557)
    tail = read(tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end of central directory")
    entries, length, at = struct.unpack_from("<H2I", tail, end + 10)
    where = tail_at + end - 20
    if where >= 0 and (locator := read(where, 20))[:4] == b"PK\x06\x07":
        (wide_at,) = struct.unpack_from("<Q", locator, 8)
        wide = read(wide_at, 56)
        if wide[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory")
        entries, length, at = struct.unpack_from("<3Q", wide, 32)
    held, stop = b"", at + length
    for _ in range(entries):
        while len(held) < 46 or len(held) < 46 + sum(struct.unpack_from("<3H", held, 28)):
            if at >= stop:
                raise ValueError("the central directory ends early")
            more = read(at, min(1 << 20, stop - at))
            at += len(more)
            held += more
        if held[:4] != b"PK\x01\x02":
            raise ValueError("no entry of the central directory")
        (method,) = struct.unpack_from("<H", held, 10)
        packed, whole = struct.unpack_from("<2I", held, 20)
        n, m, k = struct.unpack_from("<3H", held, 28)
        (header,) = struct.unpack_from("<I", held, 42)
        name, extra = held[46 : 46 + n].decode(), held[46 + n : 46 + n + m]
        held = held[46 + n + m + k :]
        while len(extra) >= 4:
            kind, width = struct.unpack_from("<2H", extra)
            if kind == 1:  # the fields that are all ones, in this order
                wide = iter(struct.unpack_from(f"<{width // 8}Q", extra, 4))
                whole = next(wide) if whole == 0xFFFFFFFF else whole
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                header = next(wide) if header == 0xFFFFFFFF else header
            extra = extra[4 + width :]
        own = read(header, 30)
        if own[:4] != b"PK\x03\x04":
            raise ValueError(f"no local header of {name}")
        yield name, method, header + 30 + sum(struct.unpack_from("<2H", own, 26)), packed


def members(packages: DataFrame) -> DataFrame:
    """(path, name, start, length) of the members of the packages (path), all of which must be stored."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for path in batch.column(0).to_pylist():
                system, local = _place(path)
                with system.open_input_file(local) as file:
                    for name, method, start, length in directory(lambda at, n: file.read_at(n, at), file.size()):
                        if method:
                            raise ValueError(f"{name} in {path} is compressed, not stored")
                        out.append((path, name, start, length))
            kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
            columns = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["path", "name", "start", "length"]
            )

    return packages.select("path").mapInArrow(find, "path string, name string, start long, length long")


def records(packages: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record in the packages."""
    found = members(packages)
    data = found.where("name like 'archive/%'").select("path", F.col("start").alias("base"))
    index = found.where("name like 'indexes/%'").join(data, "path")

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, local = _place(row["path"])
                out: list[list[int]] = []
                with system.open_input_file(local) as file:
                    at, left, held = row["start"], row["length"], b""
                    while left:
                        more = file.read_at(min(left, 1 << 20), at)
                        at, left = at + len(more), left - len(more)
                        *lines, held = (held + more).split(b"\n")
                        for line in lines:
                            first, size = map(int, line.split())
                            if out and out[-1][0] + out[-1][1] == first and out[-1][1] + size <= range_bytes:
                                out[-1][1] += size
                            else:
                                out.append([first, size])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["path"]] * len(out), pa.string()),
                        pa.array([row["base"] + a for a, _ in out], pa.int64()),
                        pa.array([n for _, n in out], pa.int64()),
                    ],
                    ["path", "start", "length"],
                )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, local = _place(row["path"])
                with system.open_input_file(local) as file:
                    raw = file.read_at(row["length"], row["start"])
                out = []
                while raw:
                    one = zlib.decompressobj(31)
                    out.append(parsed(one.decompress(raw)))
                    raw = one.unused_data
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                    ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
                )

    ranged = index.mapInArrow(ranges, "path string, start long, length long")
    spread = ranged.repartition(tasks_for(packages.agg(F.sum("bytes")).first()[0] or 0, packages.sparkSession), "path", "start")
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return spread.mapInArrow(read, schema)


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages written to packages in the shared folder, and what their records say."""
    return records(write(pages, scratch(pages.sparkSession, "wacz"), least_bytes))
