"""The registered queries on the smallest sample, against plain Python that takes the slow way."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from weirstone.llm import nbsvm, queries, secret_scan, suffix_levels
from weirstone.llm.linear_grouping import plan
from weirstone.llm.zip_warc import directory

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(spark, sample):
    rows = spark.read.parquet(f"{sample}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text or "" for r in rows}


@pytest.fixture(scope="module")
def ids(texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    return {d: tokenizer.encode(t, add_special_tokens=False).ids for d, t in texts.items()}


def run(spark, sample, name):
    return queries.QUERIES[name](spark, sample).toPandas()


def sets(texts):
    out = {}
    for d, t in texts.items():
        w = WORD.findall(t.translate(LOW))
        out[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    return out


def classes(shingles):
    root = {d: d for d in shingles}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, x in shingles.items():
        for b, y in shingles.items():
            if b < a and x and 100 * len(x & y) >= 75 * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {d: find(d) for d in shingles}


def test_token_counts(spark, sample, ids):
    got = run(spark, sample, "op1_separator_scan")
    assert dict(zip(got.doc_id, got.n_tokens)) == {d: len(i) for d, i in ids.items()}


def test_secrets(spark, sample, texts):
    assign = re.compile(
        r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|"""
        r"""[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    )
    for r in run(spark, sample, "op2_secret_scan").itertuples():
        t = texts[r.doc_id]
        base = [("assign", *m.span()) for m in assign.finditer(t) if len(m[2]) >= 12]
        base += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        base += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
        base.sort(key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))
        text = ",".join(":".join(map(str, s)) for s in base)
        kinds = Counter(k for k, _, _ in base)
        want = (kinds["assign"], kinds["access"], kinds["hex"], hashlib.sha256(text.encode()).hexdigest())
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256) == want
        assert not Counter(text.split(",") if text else []) - Counter(r.spans.split(","))


def test_entropy_windows():
    text = "key 9f8E7d6C5b4A3z2Y1x0WvUtS and 0123456789abcdef01234567 and onreableonreableonreableon"
    got = list(secret_scan.entropy_spans(text))
    assert [text[a:b] for _, a, b in got] == ["9f8E7d6C5b4A3z2Y1x0WvUtS"]
    slow = [
        -sum(n / 20 * math.log2(n / 20) for n in Counter(text[i : i + 20]).values()) for i in range(len(text) - 19)
    ]
    assert np.allclose(list(secret_scan._entropies(text, 20)), slow)


def test_pitman_yor(spark, sample, texts):
    got = run(spark, sample, "op3_pitman_yor")
    tokens = {d: WORD.findall(t.translate(LOW)) + [0] for d, t in texts.items()}
    out = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in texts}
    counts = Counter(w for d, ws in tokens.items() if not out[d] for w in ws)
    n, v = sum(counts.values()), len(counts)
    for r in got.itertuples():
        ws = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (out[r.doc_id], len(ws), n)
        assert r.n_known == sum(counts[w] > 0 for w in ws)
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-6)
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum()


def test_classifier(spark, sample):
    small, labels = run(spark, sample, "op4_nb_svm"), spark.read.parquet(f"{sample}/labels.parquet").toPandas()
    both = small.merge(labels, on="doc_id")
    held = both[both.held_out]
    assert (both.held_out == [zlib.crc32(str(d).encode()) % 4 == 2 for d in both.doc_id]).all()
    assert (held.predicted == held.quality).mean() >= 0.9  # few rows here: 99.8 % on larger samples


def test_dual_coordinate_descent_separates():
    rows = [np.array(r, np.int32) for r in ([1, 2], [1, 3], [4, 2], [4, 3])]
    weights, bias = nbsvm.dual_coordinate_descent(rows, [np.ones(2)] * 4, np.array([1.0, 1, -1, -1]), np.ones(4) * 10)
    assert [float(weights[r].sum()) + bias > 0 for r in rows] == [True, True, False, False]


def test_rules(spark, sample, texts):
    for r in run(spark, sample, "op6_log_ratio_rules").itertuples():
        t = texts[r.doc_id]
        w = WORD.findall(t)
        windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        often = Counter(windows)
        repeat = len({j for i, x in enumerate(windows) if often[x] > 1 for j in range(i, i + 5)})
        lines = [line for line in t.split("\n") if WORD.search(line)]
        failed = len(w) < 10 or 100 * repeat > 20 * len(w)
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)))
        assert (r.n_dup_lines, r.n_repeat_words, r.base_failed) == (len(lines) - len(set(lines)), repeat, failed)
        assert r.kept == (not failed and r.llr >= -0.1)


def test_repeats(spark, sample, texts):
    raw = {d: t.encode() for d, t in texts.items()}
    often = Counter(b[i : i + 200] for b in raw.values() for i in range(len(b) - 199))
    for r in run(spark, sample, "op7_suffix_levels").itertuples():
        b = raw[r.doc_id]
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 199):
            if often[b[i : i + 200]] > 1:
                gone[i : i + 200] = True
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(b), int(gone.sum()), spans)
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_packing(spark, sample, ids):
    got = run(spark, sample, "op8_linear_grouping")
    room = defaultdict(list)
    for r in got.itertuples():
        whole = np.array([*ids[r.doc_id], 1], "<u4")
        part = whole[r.start : r.start + r.length]
        assert r.start == 4096 * r.piece and len(part) == r.length == min(4096, len(whole) - r.start)
        assert zlib.crc32(part.tobytes()) == r.ids_crc32
        room[r.sequence_id].append((r.offset, r.length))
    assert got.length.sum() == sum(len(i) + 1 for i in ids.values())
    for held in room.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(room) <= 1.1 * -(-got.length.sum() // 4096)


def test_plan_is_close_to_the_bound():
    lengths = np.clip(np.random.default_rng(1).exponential(1288, 50_000).astype(int) + 1, 1, 4096)
    runs = plan(dict(Counter(lengths.tolist())))
    assert sum(r.count for r in runs) <= 1.001 * -(-lengths.sum() // 4096)
    held = Counter()
    for r in runs:
        assert r.room == 4096 - sum(n for n, _ in r.held) >= 0
        held.update({n: r.count * k for n, k in Counter(n for n, _ in r.held).items()})
    assert held == Counter(lengths.tolist())


def test_decontamination(spark, sample, texts):
    items = spark.read.parquet(f"{sample}/benchmark.parquet").collect()
    got = run(spark, sample, "op9_rare_seed_alignment")
    verbatim = {(d, i.item_id) for d, t in texts.items() for i in items if i.text in t}
    assert verbatim and verbatim <= set(zip(got.doc_id, got.item_id))
    assert got.score.between(0.5, 1).all()


def test_near_duplicates(spark, sample, texts):
    got = run(spark, sample, "op10_bottom_k")
    shingles = sets(texts)
    assert dict(zip(got.doc_id, got.component_id)) == classes(shingles)
    assert dict(zip(got.doc_id, got.n_shingles)) == {d: len(s) for d, s in shingles.items()}
    assert (got.kept == (got.doc_id == got.component_id)).all()


def test_zip64_directory():
    """A package whose sizes and places stand in ZIP64 fields only."""
    import struct

    data, ones = b"stored bytes", 0xFFFFFFFF
    local = b"PK\x03\x04" + struct.pack("<5H3I2H", 45, 0, 0, 0, 0, 0, ones, ones, 1, 20)
    local += b"m" + struct.pack("<2H2Q", 1, 16, len(data), len(data))
    extra = struct.pack("<2H3Q", 1, 24, len(data), len(data), 0)
    entry = b"PK\x01\x02" + struct.pack("<6H3I5H2I", 45, 45, 0, 0, 0, 0, 0, ones, ones, 1, len(extra), 0, 0, 0, 0, ones)
    entry += b"m" + extra
    at = len(local) + len(data)
    wide = b"PK\x06\x06" + struct.pack("<Q2H2I4Q", 44, 45, 45, 0, 0, 1, 1, len(entry), at)
    tail = b"PK\x06\x07" + struct.pack("<IQI", 0, at + len(entry), 1)
    tail += b"PK\x05\x06" + struct.pack("<4H2IH", 0, 0, 0xFFFF, 0xFFFF, ones, ones, 0)
    whole = local + data + entry + wide + tail
    ((name, method, start, size),) = directory(lambda a, n: whole[a : a + n], len(whole))
    assert (name, method, whole[start : start + size]) == ("m", 0, data)


def test_pipeline(spark, sample, texts):
    docs = spark.read.parquet(f"{sample}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, sample)
        assert kept.columns == docs.columns, name
    left = {r.doc_id: r.text for r in kept.collect()}
    got = corpus_pipeline.run(spark, sample).toPandas()
    assert set(got.doc_id) == set(left) <= set(texts)
    shingles = sets({d: texts[d] for d in left})
    assert len(set(classes(shingles).values())) == len(left)
    assert not any(secret_scan.spans(t) for t in left.values())
    items = spark.read.parquet(f"{sample}/benchmark.parquet").collect()
    assert not any(i.text in t for t in left.values() for i in items)


@pytest.mark.parametrize("group", [0, 2])
def test_repeats_of_grams_with_many_contexts(spark, monkeypatch, group):
    """Windows counted one by one give what windows that meet at their gram give, and what brute force gives."""
    draw = np.random.default_rng(3)
    shared = bytes(draw.integers(97, 123, 700, np.uint8)).decode()
    rows = []
    for i in range(12):
        a, b = sorted(draw.integers(0, 700, 2))
        rows.append((i, bytes(draw.integers(97, 123, 150, np.uint8)).decode() + shared[a:b] + "é" * (i % 3)))
    often = Counter(t.encode()[i : i + 200] for _, t in rows for i in range(len(t.encode()) - 199))
    monkeypatch.setattr(suffix_levels, "GROUP", group)
    got = {r.doc_id: r for r in suffix_levels.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for doc_id, text in rows:
        b = text.encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 199):
            if often[b[i : i + 200]] > 1:
                gone[i : i + 200] = True
        assert got[doc_id].n_removed == gone.sum()
        assert got[doc_id].kept_sha256 == hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()
    assert sum(r.n_removed for r in got.values()) > 0
