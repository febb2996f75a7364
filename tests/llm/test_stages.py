"""Every pipeline stage on nulls, empty texts, repeated rows, an empty table and columns of clashing names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, node string, sketch int, component string, "
    "vector string, low int, id string, spans string, secrets int, words int, `a.b` int"
)
EXTRA = (0.5, "n", 1, "c", "v", 2, "i", "s", 3, 4, 5)
PROSE = "The committee published its yearly report on the state of the harbour and the roads that lead to it. " * 4
ROWS = [
    (1, PROSE, "en", "s", len(PROSE)), (1, PROSE, "en", "s", len(PROSE)), (2, PROSE + "Again.", "en", "s", 7), (3, None, None, None, None),
    (4, "", "en", "s", 0), (5, " \t\n", "en", "s", 3), (None, "one two", None, None, 7), (None, None, None, None, None),
    (6, "password = abcdefghijkl0123 and more", "en", "s", 36),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*row, *EXTRA) for row in ROWS], SCHEMA)


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stage(spark, sample, docs, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, docs, sample)
    rows = out.collect()
    assert stage(spark, docs.where("false"), sample).count() == 0
    if name == "packing":
        assert sum(1 for r in rows if r.piece == 0) == len(ROWS)
        assert {r.length for r in rows if r.doc_id in (3, 4, 5)} == {1}
        return
    assert out.columns == docs.columns
    assert out.schema.simpleString() == docs.schema.simpleString()
    ids = [r.doc_id for r in rows]
    if name == "near_duplicates":
        assert sorted(map(str, ids)) == sorted(["1", "3", "4", "5", "6", "None", "None"])
    elif name == "secrets":
        assert len(rows) == len(ROWS)
        kept = {r.doc_id: (r.text, r.n_chars) for r in rows}
        assert kept[3] == (None, None) and kept[4] == ("", 0) and kept[2][1] == 7
        assert "abcdefghijkl0123" not in kept[6][0] and kept[6][1] == len(kept[6][0])
    elif name == "decontamination":
        assert len(rows) == len(ROWS)


def test_decontamination_takes_out_edited_copies(spark, sample):
    item = spark.read.parquet(f"{sample}/benchmark.parquet").orderBy(F.length("text").desc()).first().text
    words = item.split()
    edited = " ".join("changed" if i % 12 == 5 else w for i, w in enumerate(words))
    made = [(1, f"{PROSE} {item} {PROSE}"), (2, f"{PROSE} {edited} {PROSE}"), (3, PROSE)]
    docs = spark.createDataFrame([(*row, "en", "s", len(row[1])) for row in made], "doc_id long, text string, lang string, source string, n_chars long")
    assert [r.doc_id for r in corpus_pipeline.decontamination(spark, docs, sample).collect()] == [3]
