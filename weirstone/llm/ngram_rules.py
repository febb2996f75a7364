"""Quality rules in DataFrame functions alone: counts over a text, and a hashed n-gram log-likelihood ratio.

``ratios`` counts hashed word uni- and bigrams of all documents in ``buckets``
buckets, once for the trusted target and once for the raw corpus, and gives
log p_target - log p_raw of each bucket, both with additive smoothing. A
document's score is the sum over its n-grams divided by their number; it is
kept if the score is at least ``threshold`` and the rules do not fail it. The
table of ratios has ``buckets`` numbers whatever the input, and reaches the
scoring pass as one constant array.

Words are runs of anything but space, tab, line feed, vertical tab, form feed
and carriage return. Defined results: null and empty texts have no words,
score 0 and fail the rules. Repeated rows are judged each. With no trusted
document, the ratios are those of smoothing alone and near 0. Extra columns
are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from weirstone.llm.runtime import if_small

WHITE = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
BUCKETS = 1 << 15
THRESHOLD = -0.1


def split_words(docs: DataFrame) -> DataFrame:
    """(doc_id, text, words, hashes): words and their 64-bit hashes, in order."""
    text = F.coalesce(F.col("text"), F.lit(""))
    out = docs.select("doc_id", text.alias("text"))
    out = out.withColumn("words", F.array_remove(F.split("text", WHITE), ""))
    return out.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))


def _buckets(buckets: int) -> Column:
    """Bucket numbers of a text's unigrams and bigrams, from 0."""
    pairs = F.transform(
        F.col("hashes"),
        lambda h, i: F.pmod(F.xxhash64(h, F.get(F.col("hashes"), i - 1)), F.lit(buckets)).cast("int"),
    )
    single = F.transform("hashes", lambda h: F.pmod(h, F.lit(buckets)).cast("int"))
    return F.concat(single, pairs)  # the first word's pair is that with nothing before it


def ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, smoothing: float = 1.0) -> DataFrame:
    """One row with ``ratios``, an array of the log ratio of each bucket. ``trusted`` names target documents (doc_id)."""
    marked = trusted.select("doc_id").where("doc_id is not null").distinct().withColumn("target", F.lit(1))
    rows = docs.select("doc_id", "text").join(if_small(marked), "doc_id", "left")
    text = F.coalesce(F.col("text"), F.lit(""))
    hashed = rows.select(
        F.coalesce("target", F.lit(0)).alias("target"),
        F.transform(F.array_remove(F.split(text, WHITE), ""), lambda w: F.xxhash64(w)).alias("hashes"),
    )
    counted = (
        hashed.select("target", F.explode(_buckets(buckets)).alias("bucket"))
        .groupBy("bucket")
        .agg(F.sum("target").alias("good"), F.count("*").alias("raw"))
    )
    spark = docs.sparkSession
    every = spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    filled = every.join(counted, "bucket", "left").select(
        "bucket", (F.coalesce("good", F.lit(0)) + smoothing).alias("good"), (F.coalesce("raw", F.lit(0)) + smoothing).alias("raw")
    )
    listed = filled.agg(
        F.sum("good").alias("goods"), F.sum("raw").alias("raws"), F.collect_list(F.struct("bucket", "good", "raw")).alias("rows")
    )
    shift = F.log("goods") - F.log("raws")
    return listed.select(
        F.transform(F.sort_array("rows"), lambda r: F.log(r["good"]) - F.log(r["raw"]) - shift).alias("ratios")
    )


def _covered(words: int = 5) -> Column:
    """Words inside windows that occur again, from the sorted start positions of those windows."""
    at = F.col("at")
    steps = F.aggregate(
        F.sequence(F.lit(1), F.size(at) - 1), F.lit(0), lambda a, j: a + F.least(F.lit(words), F.get(at, j) - F.get(at, j - 1))
    )
    return F.when(F.size(at) < 1, 0).when(F.size(at) == 1, words).otherwise(steps + words)


def rules(docs: DataFrame, table: DataFrame | None = None, buckets: int = BUCKETS, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, llr, kept)."""
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    window = F.transform(
        F.slice("hashes", 1, F.greatest(F.size("hashes") - 4, F.lit(0))),
        lambda h, i: F.xxhash64(h, *[F.get(F.col("hashes"), i + k) for k in range(1, 5)]),
    )
    found = split_words(docs).select(
        "doc_id",
        "hashes",
        F.size("words").cast("long").alias("n_words"),
        (F.length("text") - F.regexp_count("text", F.lit(r"[\x20\x09-\x0D]"))).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        window.alias("windows"),
    )
    if table is None:
        score = F.lit(0.0)
    else:
        listed = table.select(F.concat_ws(",", F.transform("ratios", lambda r: r.cast("string"))).alias("r")).first()["r"]
        weights = F.split(F.lit(listed), ",").cast("array<double>")  # folded to one constant array
        total = F.aggregate(_buckets(buckets), F.lit(0.0), lambda a, b: a + F.coalesce(F.get(weights, b), F.lit(0.0)))
        score = F.when(F.col("n_words") == 0, 0.0).otherwise(total / (2 * F.col("n_words")))
    # Only a text with some window twice is sorted.
    ordered = F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    found = found.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        score.alias("llr"),
        ordered.alias("ordered"),
    )
    same = lambda x, j: F.get(F.col("ordered"), j)["h"].eqNullSafe(x["h"])
    again = F.filter("ordered", lambda x, j: same(x, j + 1) | same(x, j - 1))
    found = found.withColumn("at", F.sort_array(F.transform(again, lambda x: x["i"]))).drop("ordered")
    found = found.withColumn("n_repeat_words", F.when(F.col("at").isNull(), 0).otherwise(_covered()).cast("long"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return found.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        "llr",
        (~failed & (F.col("llr") >= threshold)).alias("kept"),
    )
