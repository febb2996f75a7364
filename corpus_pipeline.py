"""A training corpus from documents, in five stages that each write what the next one reads.

``run(spark, sf_dir)`` applies STAGES to ``documents``. A stage takes (spark,
docs, sf_dir), works on all rows its predecessor kept, and returns the columns of documents;
the last returns the packed pieces.

Defined results, for every stage: an empty table gives an empty table; a null text counts as an empty one and stays
null; rows that repeat are rows of their own, except that near_duplicates keeps one of each group; a null
doc_id stays null; columns beyond those of documents are carried along, whatever their names. For near_duplicates
they must be of kinds that Spark can hash, which maps are not.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from weirstone.llm import alignment, bottom_k, linear_grouping, nbsvm, secret_scan
from weirstone.llm.queries import GOOD, vocabulary
from weirstone.llm.runtime import scratch, ship
from weirstone.session import configure


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _carrying(stage: Stage) -> Stage:
    """The stage, with columns beyond those of documents under names that meet no other while it works."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = docs.columns
        inside = [name if name in DOCUMENT else f"__extra{i}" for i, name in enumerate(names)]
        if inside == names:
            return stage(spark, docs, sf_dir)
        out = stage(spark, docs.toDF(*inside), sf_dir)
        return out.toDF(*names) if out.columns == inside else out

    return run_stage


@_carrying
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, scores as good; the others go.

    A text without features has the score of the bias alone. Without labels every score is 0.5, under the bound.
    """
    labels = _table(spark, sf_dir, "labels")
    names = docs.columns
    model = nbsvm.learn(docs, labels)
    return nbsvm.score(docs, model, name="__score").where(F.col("__score") >= GOOD).select(names)


@_carrying
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the least id. Documents without words all stay.

    Texts that share an id are judged each; a row without id stays only if none of its group has one.
    """
    configure(spark)
    ship(spark)
    return bottom_k.one_of_each(docs)


@_carrying
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy of a benchmark item, edited or not; the others go.

    A document without text, or too short to hold an item's n-gram, stays; an item without text matches nothing.
    """
    return alignment.clean(docs, _table(spark, sf_dir, "benchmark"))


@_carrying
def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in the text and n_chars counted anew where it changed.

    A text without secrets, an empty and a null one stay as they are, their n_chars too.
    """
    configure(spark)
    ship(spark)
    before = docs.withColumn("__before", F.length("text"))
    done = secret_scan.redact(before)
    changed = F.length("text") != F.col("__before")
    return done.withColumn(
        "n_chars", F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    ).select(docs.columns)


@_carrying
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of at most 4096; a document without tokens is its end token alone."""
    configure(spark)
    ship(spark)
    return linear_grouping.pack(docs, vocabulary())


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]
#: SQL has neither the fitted classifier nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = scratch(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
