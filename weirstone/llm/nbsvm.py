"""Naive Bayes support vectors: a linear quality classifier over n-gram indicators.

A text becomes the set of its hashed n-grams: four-byte strings of the text,
and bigrams and trigrams of word shapes (letter case, digits, symbols, closing
mark, and whether the word repeats the one before). ``fit``

1. counts, over *all* labelled rows, in how many texts of each class a feature
   occurs; a task sends its sums per feature, so the shuffle holds at most
   ``2**BITS`` rows per task;
2. scales each feature's indicator by its class log-count ratio
   log((p + a) / |p|) - log((q + a) / |q|), and texts to unit length;
3. fits a linear hinge-loss model by dual coordinate descent on about
   ``sample`` labelled rows, those whose id and text hash lowest (the documented
   bound on what reaches the driver: never more than twice ``sample`` sets of at
   most 2**BITS features), and maps margins to 0..1 by a logistic curve fitted
   on a fifth of the sample held back.

``score`` is then one product per text.

Defined results: null and empty texts have no features and get the score of
the bias alone. Rows without label, and labels of rows without text, teach
nothing. Several rows or labels of one id each count. With one class or none
to learn from, every score is the rate of the good class (0.5 when nothing is known). Extra
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from weirstone.llm.runtime import if_small
from weirstone.llm.textbytes import Chunk, chunks, mix, ngrams, words

BITS = 18
SIZE = 1 << BITS
_U = np.uint64
_UPPER, _LOWER, _DIGIT, _MARK, _OTHER = range(5)
_KIND = np.full(256, _MARK, np.int64)
_KIND[65:91] = _UPPER
_KIND[97:123] = _LOWER
_KIND[48:58] = _DIGIT
_KIND[128:] = _OTHER


def _shapes(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """A small number per word for how it is written, and the first word of each row."""
    hashes, starts, ends, first = words(chunk)
    if not len(starts):
        return np.empty(0, _U), first
    kinds = _KIND[chunk.data]
    seen = np.zeros(len(starts), np.int64)
    for k in range(5):
        inside = np.concatenate(([0], np.cumsum(kinds == k)))
        seen |= ((inside[ends] - inside[starts]) > 0).astype(np.int64) << k
    begins, last = kinds[starts], chunk.data[ends - 1].astype(np.int64)
    last = np.where(kinds[ends - 1] == _MARK, last, 0)
    again = np.zeros(len(starts), np.int64)
    again[1:] = hashes[1:] == hashes[:-1]
    return mix((seen | begins << 5 | last << 8 | again << 16).astype(_U)), first


def features(chunk: Chunk) -> Iterator[np.ndarray]:
    """The distinct feature numbers of each row."""
    data = chunk.data.astype(np.uint32)
    four = data[:-3] | data[1:-2] << 8 | data[2:-1] << 16 | data[3:] << 24 if len(data) > 3 else data[:0]
    four = ((four.astype(_U) * _U(0x9E3779B97F4A7C15)) >> _U(64 - BITS)).astype(np.int32)
    shapes, first = _shapes(chunk)
    two, three = ((ngrams(shapes, n) >> _U(64 - BITS)).astype(np.int32) for n in (2, 3))
    for row in range(len(chunk)):
        a, b = int(chunk.offsets[row]), int(chunk.offsets[row + 1])
        c, d = int(first[row]), int(first[row + 1])
        yield np.unique(np.concatenate((four[a : max(a, b - 3)], two[c : max(c, d - 1)], three[c : max(c, d - 2)])))


@dataclass(frozen=True)
class Model:
    """Weights with the log-count ratios multiplied in; ``ratios`` scale lengths."""

    ratios: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, found: np.ndarray) -> float:
        if not len(found):
            return self.bias
        size = float(np.sqrt(np.square(self.ratios[found]).sum()))
        return float((self.ratios[found] * self.weights[found]).sum()) / (size or 1.0) + self.bias

    def score(self, found: np.ndarray) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.slope * self.margin(found) + self.shift, -30, 30))))


def _class_counts(rows: DataFrame) -> np.ndarray:
    """Texts of each class that hold a feature, and in the last column the texts: (2, SIZE + 1)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((2, SIZE + 1), np.int64)
        for batch in batches:
            labels = batch.column("label").to_numpy(zero_copy_only=False)
            for chunk in chunks(batch.column("text")):
                for row, found in enumerate(features(chunk)):
                    counts = held[int(labels[chunk.first + row])]
                    counts[found] += 1
                    counts[SIZE] += 1
        used = np.flatnonzero(held.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(held[0, used]), pa.array(held[1, used])], ["feature", "bad", "good"]
        )

    partial = rows.mapInArrow(count, "feature long, bad long, good long")
    total = partial.groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).toArrow().to_pandas()
    out = np.zeros((2, SIZE + 1), np.int64)
    out[:, total.feature.to_numpy(np.int64)] = total[["bad", "good"]].to_numpy(np.int64).T
    return out


def dual_coordinate_descent(
    rows: list[np.ndarray], values: list[np.ndarray], signs: np.ndarray, c: np.ndarray, epochs: int = 15
) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge-loss model; the bias is the weight of a feature that is always one."""
    weights, bias = np.zeros(SIZE), 0.0
    alpha = np.zeros(len(rows))
    curvature = np.array([float(v @ v) + 1.0 for v in values])
    draw = np.random.default_rng(7)
    for _ in range(epochs):
        largest = 0.0
        for i in draw.permutation(len(rows)):
            gradient = signs[i] * (float(weights[rows[i]] @ values[i]) + bias) - 1.0
            new = min(max(alpha[i] - gradient / curvature[i], 0.0), c[i])
            step = (new - alpha[i]) * signs[i]
            if step:
                alpha[i] = new
                weights[rows[i]] += step * values[i]
                bias += step
                largest = max(largest, abs(step))
        if largest < 1e-3:
            break
    return weights, bias


def _logistic(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the curve from margin to probability, by Newton's method on smoothed targets."""
    n1, n0 = good.sum(), (1 - good).sum()
    target = np.where(good == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        w = p * (1 - p) + 1e-9
        g = np.array([((p - target) * margins).sum() + 1e-3 * (a - 1), (p - target).sum()])
        h = np.array([[(w * margins**2).sum() + 1e-3, (w * margins).sum()], [(w * margins).sum(), w.sum()]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return max(a, 1e-3), b


def fit(labelled: DataFrame, sample: int = 4000, smoothing: float = 1.0, cost: float = 1.0) -> Model:
    """A model from rows (id, text, label 0/1), of which all are counted and ``sample`` fitted."""
    rows = labelled.select("id", "text", F.col("label").cast("int").alias("label")).where(
        "text is not null and label in (0, 1)"
    )
    counts = _class_counts(rows)
    n0, n1 = counts[:, SIZE]
    zero = np.zeros(SIZE)
    if not n0 or not n1:
        return Model(zero, zero, 0.0, 1.0, float(np.log((n1 + 1) / (n0 + 1))))
    bad, good = counts[:, :SIZE] + smoothing
    ratios = np.log(good / good.sum()) - np.log(bad / bad.sum())
    ratios[counts[:, :SIZE].sum(axis=0) == 0] = 0.0

    share = min(1.0, sample / (n0 + n1))
    chosen = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                found = [f.tobytes() for f in features(chunk)]
                part = batch.column("label").slice(chunk.first, len(chunk))
                yield pa.RecordBatch.from_arrays([part, pa.array(found, pa.binary())], ["label", "features"])

    local = chosen.mapInArrow(featurise, "label int, features binary").limit(2 * sample).toArrow().to_pandas()
    local = local.sort_values(["features", "label"], ignore_index=True)  # the order of arrival is not the fit's business
    local = local.iloc[np.random.default_rng(11).permutation(len(local))]
    found = [np.frombuffer(x, np.int32) for x in local.features]
    labels = local.label.to_numpy(np.int64)
    values = [ratios[f] / (np.sqrt(np.square(ratios[f]).sum()) or 1.0) for f in found]
    signs = np.where(labels == 1, 1.0, -1.0)
    held = np.arange(len(labels)) % 5 == 4
    weigh = np.where(labels == 1, len(labels) / (2 * max(1, (labels == 1).sum())), len(labels) / (2 * max(1, (labels == 0).sum())))
    train = np.flatnonzero(~held)
    weights, bias = dual_coordinate_descent(
        [found[i] for i in train], [values[i] for i in train], signs[train], cost * weigh[train]
    )
    margins = np.array([float(weights[f] @ v) + bias for f, v in zip(found, values)])
    use = held if len(np.unique(labels[held])) == 2 else np.ones(len(labels), bool)
    slope, shift = _logistic(margins[use], labels[use])
    return Model(ratios, weights, bias, slope, shift)


def score(df: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """The rows with the model's score, 0 to 1, higher for better; a column of that name is replaced."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # three arrays of 2**BITS numbers, whatever the input

    @F.pandas_udf("double")
    def judged(texts):
        import pandas as pd

        out = [shared.value.score(f) for chunk in chunks(pa.Array.from_pandas(texts, type=pa.large_string())) for f in features(chunk)]
        return pd.Series(out, dtype="float64")

    return df.withColumn(name, judged(F.col(f"`{text}`")))


def held_out(id_column: Column, parts: int = 4, part: int = 2) -> Column:
    """Whether a row is set aside for the test."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % parts == part, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, sample: int = 4000) -> Model:
    """Fit on the labelled documents that are not held out."""
    known = labels.select("doc_id", F.col("quality").alias("label")).where("quality is not null")
    rows = docs.select("doc_id", "text").where(~held_out(F.col("doc_id"))).join(if_small(known), "doc_id")
    return fit(rows.select(F.col("doc_id").alias("id"), "text", "label"), sample)
