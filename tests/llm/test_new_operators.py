"""Pivot-distance search, periodic runs and source divergence: brute force, hard cases and edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weirstone.llm import periodic_runs, pivot_distance, queries, source_divergence
from weirstone.llm.runtime import ship

LETTERS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


# Periodic runs


def runs_of(words):
    """All runs, period by period over the whole text."""
    n = len(words)
    table = {w: i for i, w in enumerate(dict.fromkeys(words))}
    a = np.array([table[w] for w in words], int)
    found = {}
    for q in range(1, n // 2 + 1):
        edges = np.diff(np.concatenate(([0], (a[: n - q] == a[q:]).astype(int), [0])))
        for x, y in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist(), strict=True):
            if y - x + q >= max(12, 2 * q):
                found.setdefault((x, y - x + q), q)
    return sorted((start, length, q) for (start, length), q in found.items())


def collapsed(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def check_texts(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = periodic_runs.collapse(docs).collect()
    assert len(rows) == len(texts)
    for row in rows:
        words = (texts[row.doc_id] or "").encode().split()
        want = runs_of(words)
        assert [tuple(r) for r in row.runs] == want, row.doc_id
        assert bytes(row.collapsed) == collapsed(words, want)
        assert row.n_words == len(words)


def test_blocks_that_come_again_in_the_next_document_only():
    first = [b"a%d" % i for i in range(160)]
    second = [b"b%d" % i for i in range(150)]
    second[31:63] = first[128:160]  # 64 words after the last block of the first document, the only match there is
    assert periodic_runs._fragments([first, second]) == [[], []]


def test_runs_of_random_repetitions(spark):
    chance = random.Random(5)
    texts = []
    for _ in range(60):
        n = chance.choice([5, 13, 200, 700, 2500])
        words = [str(chance.randrange(chance.choice([1, 2, 3, 50]))) for _ in range(n)]
        for _ in range(3):
            at, p = chance.randrange(n), chance.choice([1, 2, 3, 7, 33, 63, 64, 65, 100, 128, 200, 400, 700])
            base = words[at : at + p]
            if len(base) > 4 and chance.random() < 0.4:  # a repetition of repetitions
                r = chance.randrange(1, len(base) // 2 + 1)
                base = [base[i % r] for i in range(len(base) - chance.randrange(2))]
            length = min(chance.randrange(p, 4 * p + 50), n - at)
            words[at : at + length] = [base[i % len(base)] for i in range(length)]
        texts.append(" ".join(words))
    check_texts(spark, texts)


def test_runs_across_tiles():
    chance = random.Random(6)
    for tile in (64, 100, 1000):
        periodic_runs.TILE, kept = tile, periodic_runs.TILE
        try:
            words = [b"%d" % chance.randrange(9) for _ in range(900)]
            words[100:500] = words[100:107] * 57 + [b"x"]
            words[600:800] = words[600:650] * 4
            pieces = defaultdict(list)
            for low, high, q in periodic_runs._fragments([words])[0]:
                pieces[q].append((low, high))
            found = {}
            for q, some in sorted(pieces.items()):
                start, stop = None, None
                for low, high in [*sorted(some), (10**9, 0)]:
                    if start is not None and low <= stop:
                        stop = max(stop, high)
                        continue
                    if start is not None and stop - start + q >= max(12, 2 * q):
                        found.setdefault((start, stop - start + q), q)
                    start, stop = low, high
            assert sorted((s, n, q) for (s, n), q in found.items()) == runs_of(words)
        finally:
            periodic_runs.TILE = kept


def test_runs_of_hard_texts(spark):
    fibonacci = ["a", "b"]
    while len(fibonacci) < 20:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    thue = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
    texts = [
        " ".join(fibonacci[14]), " ".join(thue), "a " * 5000, ("a " * 50 + "b ") * 60, "a b " * 6, "a b " * 5 + "a", "a " * 12, "a " * 11,
        None, "", " \t\n", "é ü " * 20, " x " * 14,
    ]
    check_texts(spark, texts)


def test_runs_of_the_sample(spark, sample):
    found = {r.doc_id: r for r in queries.op12_periodic_runs(spark, sample).collect()}
    rows = spark.read.parquet(f"{sample}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(rows)
    planted = 0
    for doc in rows:
        words = (doc.text or "").encode().split()
        h = zlib.crc32(str(doc.doc_id).encode())
        if h % 10 == 0 and words:
            planted += 1
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = runs_of(words)
        row = found[doc.doc_id]
        assert row.n_runs == len(runs)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        assert (row.start, row.length, row.period) == best
        assert row.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert row.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(collapsed(words, runs)).hexdigest()
    assert planted


def test_runs_edges(spark):
    rows = [(1, "a " * 20), (1, "a " * 20), (None, "a " * 20), (None, None)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, row int, words string")
    got = sorted((str(r.doc_id), len(r.runs), bytes(r.collapsed)) for r in periodic_runs.collapse(docs).collect())
    assert got == [("1", 1, b"a"), ("1", 1, b"a"), ("None", 0, b""), ("None", 1, b"a")]
    assert periodic_runs.collapse(docs.where("false")).count() == 0
    assert queries.planted(None, [b"a"] * 3) == [b"a"] * 3


# Pivot-distance search


def nearest(rows, k, scale=256):
    """Plain integers, all against all."""
    usable = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    whole = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in usable]
    out = []
    for n, (i, v) in enumerate(whole):
        if i % 50 == 0:
            scores = [(-sum(a * b for a, b in zip(v, w)), j, m) for m, (j, w) in enumerate(whole) if m != n]  # noqa: B905
            out += [(i, r + 1, j, -s) for r, (s, j, _) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def found(spark, rows, k=5, schema="vec_id long, embedding array<double>", **how):
    table = spark.createDataFrame(rows, schema)
    got = pivot_distance.search(pivot_distance.build(table, **how), F.col("vec_id") % 50 == 0, k, spark)
    return sorted(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect())


def test_search_of_random_vectors(spark):
    chance = np.random.default_rng(3)
    centres = chance.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] * (1 + i % 3) + chance.normal(scale=0.05, size=8)).tolist()) for i in range(1500)]
    rows += [(i, rows[i][1]) for i in range(0, 200, 25)]  # rows of the same id
    rows += [(5000 + i, rows[0][1]) for i in range(30)]  # ties
    want = nearest(rows, 5)
    assert found(spark, rows) == want
    assert found(spark, rows, pivots=3, rings=2, sample=50) == want


def test_bounds_leave_out_annuli(spark):
    chance = np.random.default_rng(4)
    rows = [(i, (np.eye(8)[i % 8] * 5 + chance.normal(scale=0.01, size=8)).tolist()) for i in range(2000)]
    index = pivot_distance.build(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    block = [{"number": 0, "rows": [0], "ids": [0], "floors": [6000.0**2 / 25], "kind": 2, "vectors": (np.array(rows[0][1]) * 256).tobytes()}]
    visits = sum(b.num_rows for b in pivot_distance._visits(index, 0, 10**6)([pa.RecordBatch.from_pylist(block)]))
    assert 0 < visits < len(index.directory) / 4


def test_visits_do_not_pass_through_the_driver(spark, monkeypatch):
    chance = np.random.default_rng(5)
    rows = [(i, chance.normal(size=16).tolist()) for i in range(3000)]
    plans, stored = [], pivot_distance.stored

    def noted(df, name, *more):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return stored(df, name, *more)

    monkeypatch.setattr(pivot_distance, "stored", noted)
    assert len(found(spark, rows)) == 60 * 5
    meetings = [plan for name, plan in plans if name == "best"]
    assert len(meetings) > 1
    # a broadcast goes through the driver; visits are as many as queries times annuli
    for plan in meetings:
        assert "SortMergeJoin [annulus" in plan
        assert "BroadcastHashJoin [annulus" not in plan


def test_search_edges(spark):
    rows = [
        (0, [1.0, 2.0]), (50, None), (100, [None, 1.0]), (150, [float("nan"), 1.0]), (200, [float("inf"), 1.0]), (250, []), (None, [1.0]),
        (300, [-1e-20, -0.1]), (7, [3.0]), (8, [1e30, -1e30]), (350, [1e30, 1e30]), (9, [1e18, 1.0]),
    ]
    got = found(spark, rows)
    clear = [r for r in got if r[0] in (0, 300) and abs(r[3]) < 1 << 62]
    want = [r for r in nearest(rows, 5) if r[0] in (0, 300) and abs(r[3]) < 1 << 62]
    assert clear == want
    assert {r[0] for r in got} == {0, 250, 300, 350}
    assert [r[2] for r in got if r[0] == 350] == [r[2] for r in nearest(rows, 5) if r[0] == 350]
    assert found(spark, [(50, [1.0])]) == []
    assert found(spark, [(50, None)]) == [] and found(spark, []) == []
    extra = [(0, [1.0], 1, 2, "k"), (1, [2.0], 1, 2, "k")]
    assert found(spark, extra, schema="vec_id long, embedding array<double>, row int, annulus int, vector string") == [(0, 1, 1, 131072)]


# Source divergence


def divergence(rows, least, top):
    counts, in_docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        g = (lang or "", source or "")
        groups.add(g)
        words = LETTERS.findall((text or "").translate(LOW))
        counts[g].update(words)
        in_docs[g[0]].update(set(words))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in in_docs[lang].items() if n >= least]
        mine = [g for g in groups if g[0] == lang]

        def share(count, kept=kept):
            total = sum(count[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (count[t] + 5) // total for t in kept}

        p = {g: share(counts[g]) for g in mine}
        q = share(sum((counts[g] for g in mine), Counter()))
        for g in mine:
            others = [(-sum(abs(p[g][t] - p[h][t]) for t in kept), h[1].encode()) for h in mine if h != g]
            terms = [(q[t] - p[g][t], t.encode()) for t in kept if counts[g][t] and p[g][t] > q[t]]
            for part, some in (("pair", sorted(others)), ("term", sorted(terms)[:top])):
                out += [(*g, part, item.decode(), -value, rank + 1) for rank, (value, item) in enumerate(some)]
    return sorted(out)


def test_divergence_of_made_up_sources(spark, monkeypatch):
    chance = random.Random(8)
    names = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)] + ["é", "Ünder", "ABC", "日本"]
    rows = []
    for i in range(400):
        source = f"s{chance.randrange(40)}" if i % 3 else "hot"
        pool = names[: chance.choice([5, 50, 304])]
        rows.append((chance.choice(["a", "b"]), source, " ".join(chance.choice(pool) for _ in range(chance.randrange(60)))))
    rows += [("a", "empty", None), ("a", None, ""), (None, None, "x y"), (None, "only", "12 34"), ("c", "x", "alone"), ("a", "S0", "ABC abc-abc")]
    docs = spark.createDataFrame([(*r, 1, "k") for r in rows], "lang string, source string, text string, n int, term string")
    monkeypatch.setattr(source_divergence, "CHUNK", 40)
    monkeypatch.setattr(source_divergence, "HELD", 100)
    got = source_divergence.audit(docs, min_docs=3, top=7)
    order = ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in got.select(order).collect()) == divergence(rows, 3, 7)
    assert source_divergence.audit(docs.where("false")).count() == 0


def test_terms_of_long_texts_are_cut_between_terms(monkeypatch):
    monkeypatch.setattr(source_divergence, "PIECE", 7)
    text = "abc defgh é日本x 12 abc q".encode() * 3
    assert sum(source_divergence._terms(text), []) == source_divergence.TERM.findall(text)
