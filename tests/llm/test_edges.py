"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns: every operator has an answer."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from weirstone.llm import (
    alignment,
    bottom_k,
    linear_grouping,
    nbsvm,
    ngram_rules,
    pitman_yor,
    secret_scan,
    separator_scan,
    suffix_levels,
    zip_warc,
)
from weirstone.llm.runtime import ship

PATH = public_tokenizers.path("word_bpe_49k.json")
LONG = " ".join(f"word{i} other{i % 7}" for i in range(30_000))
SCHEMA = "doc_id long, text string, node string, uid string, words int, score string, secrets int, part int"
ROWS = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "one two three four five six seven"),
    (5, "one two three four five six seven"), (None, "one two three four five six seven"), (None, None),
    (6, LONG), (7, LONG), (8, "password = abcdefghijkl0123"),
]


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    return spark.createDataFrame([(*r, "x", "y", 1, "z", 2, 3) for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def test_separator_scan(docs, none):
    found = separator_scan.count(docs, PATH)
    assert found.count() == len(ROWS)
    assert {r.n_tokens for r in found.where("doc_id in (1, 2, 3)").collect()} == {0}
    assert separator_scan.count(none, PATH).count() == 0


def test_secret_scan(docs, none):
    found = {r.doc_id: [s.kind for s in r.secrets] for r in secret_scan.scan(docs).collect()}
    assert found[8] == ["assign"] and found[1] == found[2] == []
    assert secret_scan.redact(docs).where("doc_id = 8").first().text == "<SECRET>"
    assert secret_scan.redact(docs).columns == docs.columns
    assert secret_scan.scan(none).count() == secret_scan.redact(none).count() == 0


def test_pitman_yor(docs, none):
    marked = docs.select("*", F.lit(False).alias("held_out"))
    rows = pitman_yor.score(marked).collect()
    assert len(rows) == len(ROWS)
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert pitman_yor.score(none.select("*", F.lit(False).alias("held_out"))).count() == 0
    unknown = pitman_yor.score(marked.withColumn("held_out", F.lit(True))).collect()
    assert {r.n_known for r in unknown} == {0} and {r.train_tokens for r in unknown} == {0}


def test_nb_svm(docs, none):
    one = docs.select(F.col("doc_id").alias("id"), "text", F.lit(1).alias("label"))
    assert {r.score > 0.5 for r in nbsvm.score(docs, nbsvm.fit(one)).collect()} == {True}
    blank = nbsvm.fit(one.where("false"))
    assert {r.score for r in nbsvm.score(docs, blank).collect()} == {0.5}
    assert nbsvm.score(none, blank).count() == 0


def test_zip_warc(spark):
    pages = spark.createDataFrame(
        [(1, "u", None), (2, None, ""), (3, "u", "<p>é"), (4, "u", "<p>é"), (4, "u", "<p>é"), (None, "u", "<p>é"), (None, "u", "q")],
        "page_id long, url string, html string",
    )
    rows = sorted(map(tuple, zip_warc.round_trip(pages).select("page_id", "payload_bytes", "record_type", "refers_to").collect()), key=str)
    assert rows == sorted(
        [(1, 0, "revisit", 2), (2, 0, "response", None), (3, 5, "revisit", 4), (4, 5, "response", None), (4, 5, "response", None),
         (None, 5, "revisit", 4), (None, 1, "response", None)], key=str,
    )
    assert zip_warc.round_trip(pages.where("false")).count() == 0


def test_ngram_rules(docs, none):
    table = ngram_rules.ratios(docs, docs.where("doc_id = 6"))
    rows = {r.doc_id: r for r in ngram_rules.rules(docs, table).where("doc_id is not null").collect()}
    assert rows[1].n_words == rows[2].n_words == rows[3].n_words == 0 and not rows[1].kept
    assert rows[6].n_words == 60_000 and rows[6].kept
    assert ngram_rules.rules(none, ngram_rules.ratios(none, none)).count() == 0


def test_suffix_levels(docs, none):
    rows = {r.doc_id: r for r in suffix_levels.remove_repeats(docs).where("doc_id is not null").collect()}
    assert rows[6].n_removed == rows[6].n_bytes and rows[6].n_spans == 1 and rows[6].kept_text == ""
    assert rows[5].n_removed == 0 and rows[1].n_bytes == 0
    assert suffix_levels.remove_repeats(none).count() == 0


def test_linear_grouping(docs, none):
    rows = linear_grouping.pack(docs, PATH).collect()
    assert sum(r.piece == 0 for r in rows) == len(ROWS)
    assert [r.length for r in rows if r.doc_id == 1] == [1]
    assert linear_grouping.pack(none, PATH).count() == 0


def test_alignment(spark, docs, none):
    items = spark.createDataFrame([(1, "three FOUR, five six"), (2, None), (3, "a b"), (1, "three FOUR, five six")], "item_id long, text string")
    found = alignment.matches(docs, items).collect()
    assert sorted((r.doc_id or 0, r.item_id, r.score) for r in found) == [(0, 1, 1.0)] * 2 + [(5, 1, 1.0)] * 4
    assert alignment.clean(docs, items).count() == len(ROWS) - 3
    assert alignment.clean(docs, items).columns == docs.columns
    assert alignment.matches(none, items).count() == alignment.matches(docs, items.where("false")).count() == 0


def test_bottom_k(docs, none):
    rows = sorted(map(tuple, bottom_k.near_duplicates(docs).collect()), key=str)
    assert [r for r in rows if r[0] == 5] == [(5, 3, 5, True)] * 2
    assert (None, 3, 5, False) in rows and (7, 59_996, 6, False) in [(a, 59_996, c, d) for a, _, c, d in rows]
    assert (1, 0, 1, True) in rows and (4, 1, 4, True) in rows
    assert bottom_k.near_duplicates(none).count() == 0
    kept = bottom_k.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [1, 2, 3, 4, 5, 6, 8]
