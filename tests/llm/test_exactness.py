"""Texts made to collide under weak hashes, packages and blocks that roll over, and the queries over whole tables."""

import base64
import hashlib
import uuid
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from weirstone.llm import bottom_k, linear_grouping, pitman_yor, queries, separator_scan, suffix_levels, textbytes, tokens, zip_warc
from weirstone.llm.runtime import scratch, ship

PATH = public_tokenizers.path("word_bpe_49k.json")
THUE = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
MORSE = THUE.translate(str.maketrans("ab", "ba"))


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def test_complementary_texts_have_their_own_hashes():
    """These pairs have the same value under any polynomial modulo 2^64."""
    for n in (1, 7, 8, 9, 64, 1024, 2048):
        data = np.frombuffer((THUE[:n] + MORSE[:n]).encode(), np.uint8)
        one, other = textbytes.range_hash(data, np.array([0, n]), np.array([n, 2 * n]))
        assert one != other
    longer = np.frombuffer((THUE * 5 + MORSE * 5).encode(), np.uint8)
    assert len(set(textbytes.range_hash(longer, np.array([0, 10240]), np.array([10240, 20480])).tolist())) == 2


def test_range_and_window_hashes_depend_on_the_bytes_alone():
    chance = np.random.default_rng(1)
    data = chance.integers(97, 100, 20_000, dtype=np.uint8)
    start = chance.integers(0, 14_000, 3000)
    end = start + chance.integers(0, 30, 3000)
    start[:4], end[:4] = (0, 5, 0, 100), (5000, 5005, 4097, 4196)
    by_bytes = defaultdict(set)
    for a, b, h in zip(start.tolist(), end.tolist(), textbytes.range_hash(data, start, end).tolist(), strict=True):
        by_bytes[data[a:b].tobytes()].add(h)
    assert all(len(h) == 1 for h in by_bytes.values())
    assert len(set.union(*by_bytes.values())) == len(by_bytes)
    for size in (1, 3, 8, 31):
        windows = textbytes.window_hash(data, size)
        assert len(windows) == len(data) - size + 1
        assert len(set(windows.tolist())) == len({data[i : i + size].tobytes() for i in range(len(windows))})
    assert len(textbytes.window_hash(data[:3], 4)) == 0


def test_tokens_of_complementary_texts(spark):
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    texts = [THUE, MORSE, f"{MORSE} {THUE}"]
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids.tolist() for _, ids in tokens.encoded(pa.array(texts), PATH)] == want
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    packed = {(r.doc_id, r.piece): r.ids_crc32 for r in linear_grouping.pack(docs, PATH).collect()}
    import zlib

    for i, ids in enumerate(want):
        assert packed[i, 0] == zlib.crc32(np.array([*ids, 1], "<u4").tobytes())
    counted = {r.doc_id: r.n_tokens for r in separator_scan.count(docs, PATH).collect()}
    assert counted == {i: len(ids) for i, ids in enumerate(want)}


def test_complementary_texts_are_no_near_duplicates(spark):
    docs = spark.createDataFrame([(1, THUE), (2, MORSE), (3, THUE)], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in bottom_k.near_duplicates(docs).collect()} == {1: 1, 2: 2, 3: 1}
    known = pitman_yor.score(docs.select("doc_id", "text", (F.col("doc_id") == 2).alias("held_out"))).collect()
    assert {r.doc_id: r.n_known for r in known} == {1: 2, 2: 1, 3: 2}


def test_complementary_windows_are_not_repeats(spark):
    docs = spark.createDataFrame([(1, THUE[:256]), (2, MORSE[:256])], "doc_id long, text string")
    texts = [THUE[:256].encode(), MORSE[:256].encode()]
    seen = Counter(t[i : i + 200] for t in texts for i in range(57))
    want = []
    for t in texts:
        gone = {j for i in range(57) if seen[t[i : i + 200]] > 1 for j in range(i, i + 200)}
        want.append(len(gone))
    assert [r.n_removed for r in suffix_levels.remove_repeats(docs).orderBy("doc_id").collect()] == want


# op5: packages that fill up


def expected_records(pages):
    by_payload = defaultdict(list)
    for page_id, html in pages:
        by_payload[html or ""].append(page_id)
    out = []
    for page_id, html in pages:
        raw = (html or "").encode()
        first = max((i for i in by_payload[html or ""] if i is not None), default=None)
        kind = ("response", None) if page_id == first else ("revisit", first)
        out.append((page_id, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), *kind))
    return sorted(out, key=str)


@pytest.mark.parametrize("package_bytes", [1, 20_000, 50_000, 1 << 28])
def test_no_page_is_lost_when_packages_roll_over(spark, sample, package_bytes):
    pages = spark.read.parquet(f"{sample}/pages.parquet")
    packages = zip_warc.write(pages, scratch(spark, "wacz"), package_bytes=package_bytes)
    want = expected_records([(r.page_id, r.html) for r in pages.select("page_id", "html").collect()])
    assert packages.agg(F.sum("records")).first()[0] == len(want)
    if package_bytes == 1:
        assert packages.count() == len(want)
    found = zip_warc.records(packages, range_bytes=3000)
    got = found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=str) == want


def test_whole_query_of_pages(spark, sample):
    rows = spark.read.parquet(f"{sample}/pages.parquet").select("page_id", "html").collect()
    got = queries.op5_zip_warc(spark, sample).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(tuple, got.collect()), key=str) == expected_records([(r.page_id, r.html) for r in rows])


# op1: many blocks and stretches


def test_documents_across_blocks_and_stretches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(separator_scan, "STRETCH", 3)
    chance = np.random.default_rng(2)
    want, paths = [], []
    for n in range(3):
        lengths = chance.choice([0, 1, 5, 900, 255, 256, 257], 40)
        parts = [np.append(chance.integers(0, 40_000, k), 49407) for k in lengths]
        if n == 1:
            parts.append(chance.integers(0, 40_000, 700))  # not ended
        path = f"{tmp_path}/{uuid.uuid4().hex}"
        np.concatenate(parts).astype("<u2").tofile(path)
        paths.append((path,))
        at = 0
        for i, part in enumerate(parts):
            ended = part[-1] == 49407
            want.append((path, i, at, len(part) - ended, bool(ended)))
            at += len(part)
    empty = f"{tmp_path}/empty"
    open(empty, "wb").close()
    files = spark.createDataFrame([*paths, (empty,)], "path string")
    got = separator_scan.scan(files, block_bytes=512).select("path", "ordinal", "start", "n_tokens", "ended").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_ids_that_do_not_fit_stop_the_write(spark):
    docs = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    with pytest.raises(Exception, match="must fit"):
        separator_scan.write(docs, PATH, scratch(spark, "tokens"), width=1, separator=255).count()
    one = Tokenizer.from_file(PATH).encode("some", add_special_tokens=False).ids[0]
    with pytest.raises(Exception, match="must fit"):
        separator_scan.write(docs, PATH, scratch(spark, "tokens"), separator=one).count()
