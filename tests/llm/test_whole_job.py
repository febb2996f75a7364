"""Cases in which an operator once did less than its whole job, against brute force."""

import math
import re
import string
from collections import Counter

import numpy as np

from weirstone.llm import alignment, bottom_k, secret_scan
from weirstone.llm.runtime import ship


def local_score(x, y):
    """Smith-Waterman, cell by cell: match 2, mismatch -1, gap -1."""
    best, above = 0, [0] * (len(y) + 1)
    for a in x:
        row = [0]
        for j, b in enumerate(y):
            row.append(max(0, above[j] + (2 if a == b else -1), above[j + 1] - 1, row[j] - 1))
        best, above = max(best, *row), row
    return best


def test_edited_copies_beside_an_exact_one(spark):
    """One copy of each item, its words replaced, left out and put in at 10 to 30 %: every pair at the threshold that shares three words in a row."""
    ship(spark)
    draw = np.random.default_rng(5)
    common = [f"w{i}" for i in range(300)]
    items = [list(draw.choice(common, draw.integers(20, 50))) for _ in range(75)]
    rows = []
    for i, item in enumerate(items):
        kinds = ("r", "rdi", "i")[i % 3]
        copy = []
        for word in item:
            kind = draw.choice(list(kinds)) if draw.random() < 0.1 + 0.05 * (i % 5) else ""
            copy += {"": [word], "r": [f"new{draw.integers(10**6)}"], "d": [], "i": [word, f"new{draw.integers(10**6)}"]}[kind]
        rows.append(" ".join([*draw.choice(common, 15), *copy, *draw.choice(common, 15)]))
        if i % 2:
            rows.append(" ".join(item))
    want = {}
    for d, text in enumerate(rows):
        words = text.split()
        held = {tuple(words[i : i + 3]) for i in range(len(words) - 2)}
        for i, item in enumerate(items):
            if held & {tuple(item[k : k + 3]) for k in range(len(item) - 2)}:
                score = local_score(item, words) / (2 * len(item))
                if score >= 0.5:
                    want[d, i] = score
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    assert len(want) > 100
    assert {(r.doc_id, r.item_id): r.score for r in alignment.matches(docs, bench).collect()} == want
    assert {r.doc_id for r in alignment.clean(docs, bench).collect()} == set(range(len(rows))) - {d for d, _ in want}


def test_entropy_of_every_window():
    """Random keys, alone or joined to names, placeholders and UUIDs: what is found is what windows judged one by one give."""
    draw = np.random.default_rng(7)
    base64 = string.ascii_letters + string.digits + "+/"
    uuid = "550e8400-E29b-41d4-A716-446655440000"
    words = ("sample", "dummy", "QwertyUiop", "0123456789", uuid)

    def key(letters, size):
        return "".join(draw.choice(list(letters), size))

    texts = [key(base64, draw.integers(32, 89)) for _ in range(300)]
    texts += [key(base64, 40) + tail for tail in ("/abc", "/a/b", "a/") for _ in range(20)]
    texts += [f"{key(base64, 30)}-{word}-{key(base64, 30)}" for word in words for _ in range(10)]
    texts += [f"{key(base64, 30)}_{uuid}" for _ in range(10)]
    texts += [f"KEY{mark}{key(digits, 64)}" for mark in "=-_" for digits in ("0123456789ABCDEF", "0123456789abcdef")]
    bare = 0
    for text in texts:
        want = {}
        for run in re.finditer("[A-Za-z0-9+/_=-]{20,}", text):
            for at in range(run.start(), run.end() - 19):
                part = text[at : at + 20]
                if any(at < m.end() and m.start() < at + 20 for w in words for m in re.finditer(re.escape(w), text, re.I)):
                    continue
                bits = -sum(n / 20 * math.log2(n / 20) for n in Counter(part).values())
                hexadecimal = re.fullmatch("[0-9a-f]+|[0-9A-F]+", part) and not part.isdigit()
                mixed = all(re.search(c, part) for c in ("[A-Z]", "[a-z]", "[0-9]"))
                if hexadecimal and bits >= 3 or not hexadecimal and mixed and bits >= 3.8:
                    want.setdefault("entropy_hex" if hexadecimal else "entropy_base64", set()).update(range(at, at + 20))
        got = {}
        for kind, start, end in secret_scan.entropy_spans(text):
            got.setdefault(kind, set()).update(range(start, end))
        assert got == want, text
        bare += not want
    assert bare < len(texts) / 50  # keys without a digit, say
    assert not list(secret_scan.entropy_spans(f"Id={uuid} and some/long/Path/of/Words/only/Letters"))


def test_one_row_of_each_component_stays(spark):
    """Ids repeated with other texts, and rows without id: each text is judged for itself, against brute force."""
    ship(spark)
    draw = np.random.default_rng(11)
    texts = []
    for _ in range(12):
        words = [f"v{i}" for i in draw.integers(0, 10**6, 60)]
        texts += [" ".join(words), " ".join([*words, "more"]), " ".join(words).upper()]
    rows = [(int(draw.integers(1, 15)) if draw.random() < 0.7 else None, t, i % 3) for i, t in enumerate(texts * 2)]
    a = "a " + texts[0].replace("v", "p")
    rows += [(103, a + " end", 0), (105, a, 0), (105, "z " + texts[0].replace("v", "q"), 0)]
    rows += [(None, "copy without an id at all", i) for i in range(3)] + [(105, None, 0), (105, "", 0), (None, None, 0)]
    rows += [(107, "the very same row twice", 1)] * 2

    def shingles(text):
        w = (text or "").lower().split()
        return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])

    sets = [shingles(t) for _, t, _ in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 4 * len(sets[i] & sets[j]) >= 3 * len(sets[i] | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    docs = spark.createDataFrame(rows, "doc_id long, text string, more long")
    got = list(map(tuple, bottom_k.one_of_each(docs).collect()))
    assert not Counter(got) - Counter(rows)
    assert sorted(str(r) for r in got if not shingles(r[1])) == sorted(str(r) for r, s in zip(rows, sets) if not s)
    of = {s: g for s, g in zip(sets, group) if s}
    least = {}
    for (doc_id, _, _), s in zip(rows, sets):
        if s:
            least[of[s]] = min(least.get(of[s], math.inf), math.inf if doc_id is None else doc_id)
    left = [(of[shingles(t)], math.inf if d is None else d) for d, t, _ in got if shingles(t)]
    assert sorted(left) == sorted(least.items())
