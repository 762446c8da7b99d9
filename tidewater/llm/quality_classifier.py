"""A quality classifier: naive Bayes support vectors on byte n-grams."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import only

#: Features: pairs of bytes together with the text's level of repetition, and three bytes, each by a
#: hash of 2^16 values.
HALF = 1 << 16
FEATURES = 2 * HALF
#: The classifier is fitted on at most so many labelled texts of each class, those whose ids have
#: the smallest hashes. A text's features are at most 16 KB, so this bounds what the driver gets.
SAMPLE = 2000
#: One text in so many of the sample is kept out of the fit and gives the scale of the score.
SCALING = 5
PENALTY, EPOCHS, SMOOTHING = 1.0, 30, 1.0
CUT = 0.3
#: Levels of repetition: shares of the three-word windows that are equal to an earlier one.
LEVELS = (0.05, 0.2, 0.5)
BLOCK = 1 << 20


class Model(NamedTuple):
    weights: np.ndarray  # log-count ratio times support vector weight, by feature
    bias: float
    slope: float
    shift: float


def repetition(text: bytes) -> int:
    words = text.split()
    windows = max(1, len(words) - 2)
    repeated = 1 - len(set(zip(words, words[1:], words[2:]))) / windows if len(words) > 2 else 0.0  # noqa: B905
    return sum(repeated >= level for level in LEVELS)


def features(text: bytes | None) -> np.ndarray:
    """The sorted numbers of the n-grams that occur in the whole text."""
    there = np.zeros(FEATURES, bool)
    data = np.frombuffer(text or b"", np.uint8)
    level = np.uint32(repetition(text or b"") * 0x5BD1E995 & 0xFFFFFFFF)
    for at in range(0, len(data), BLOCK):
        block = data[at : at + BLOCK + 2].astype(np.uint32)
        two = block[:-1] << np.uint32(8) | block[1:]
        three = (two[:-1] << np.uint32(8) | block[2:]) * np.uint32(2654435761) >> np.uint32(16)
        there[(two ^ level) * np.uint32(2246822519) >> np.uint32(16)] = True
        there[three + np.uint32(HALF)] = True
    return np.flatnonzero(there)


def log_count_ratios(rows: list[np.ndarray], good: np.ndarray) -> np.ndarray:
    counts = np.full((2, FEATURES), SMOOTHING)
    for row, label in zip(rows, good, strict=True):
        counts[int(label), row] += 1
    shares = counts / counts.sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0])


def margins(rows: list[np.ndarray], weights: np.ndarray, bias: float) -> np.ndarray:
    """Texts of any length count alike: the sum is divided by the root of the number of n-grams."""
    return np.array([weights[r].sum() / max(1.0, len(r)) ** 0.5 + bias for r in rows])


def dual_coordinate_descent(rows: list[np.ndarray], good: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights of the hinge-loss model on indicators scaled by the ratios; both classes weigh the same."""
    sign = np.where(good, 1.0, -1.0)
    share = np.array([np.mean(~good), np.mean(good)])
    most = PENALTY / (2 * np.maximum(share, 1e-9))[good.astype(int)]
    values = [ratios[r] / max(1.0, len(r)) ** 0.5 for r in rows]
    squares = np.array([v @ v + 1 for v in values])
    dual, weights, bias = np.zeros(len(rows)), np.zeros(FEATURES), 0.0
    random = np.random.Generator(np.random.PCG64(11))
    for _ in range(EPOCHS):
        moved = 0.0
        for i in random.permutation(len(rows)):
            gradient = sign[i] * (weights[rows[i]] @ values[i] + bias) - 1
            new = min(max(dual[i] - gradient / squares[i], 0.0), most[i])
            if new != dual[i]:
                step = (new - dual[i]) * sign[i]
                weights[rows[i]] += step * values[i]
                bias += step
                moved = max(moved, abs(new - dual[i]))
                dual[i] = new
        if moved < 1e-3:
            break
    return weights, bias


def scale(margin: np.ndarray, good: np.ndarray, share: float) -> tuple[float, float]:
    """Slope and shift of the logistic curve that turns margins into scores, by Newton's method.

    ``share`` is that of good texts among all labelled ones. Targets are smoothed, so the curve is
    finite where margins separate the classes.
    """
    n = np.array([max(1, int(np.sum(~good))), max(1, int(np.sum(good)))])
    target = np.where(good, (n[1] + 1) / (n[1] + 2), 1 / (n[0] + 2))
    weight = np.where(good, share / n[1], (1 - share) / n[0]) * len(margin)
    at = np.array([1.0, 0.0])
    x = np.stack([margin, np.ones_like(margin)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        gradient = x.T @ (weight * (p - target)) + 1e-3 * at
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        at = at - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(max(at[0], 1e-3)), float(at[1])


def fit(rows: list[np.ndarray], good: np.ndarray, share: float) -> Model:
    """Without texts of both classes all scores are the share of good ones."""
    if not good.any() or good.all():
        share = float(np.clip(share, 1e-6, 1 - 1e-6))
        return Model(np.zeros(FEATURES), 0.0, 1.0, float(np.log(share / (1 - share))))
    aside = np.arange(len(rows)) % SCALING == 0
    if len({*good[aside]}) < 2 or len({*good[~aside]}) < 2:
        aside = np.zeros(len(rows), bool)
    used = [r for r, out in zip(rows, aside, strict=True) if not out]
    ratios = log_count_ratios(used, good[~aside])
    weights, bias = dual_coordinate_descent(used, good[~aside], ratios)
    scaled = weights * ratios
    held = aside if aside.any() else ~aside
    margin = margins([r for r, out in zip(rows, held, strict=True) if out], scaled, bias)
    return Model(scaled, bias, *scale(margin, good[held], share))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bits = []
        for text in batch.column(2).cast(pa.binary()):
            there = np.zeros(FEATURES, bool)
            there[features(text.as_py())] = True
            bits.append(zlib.compress(np.packbits(there).tobytes(), 1))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bits, pa.binary())], ["good", "place", "bits"])


def held_out(id_col: Column) -> Column:
    """Rows that nothing is learnt from; a row without an id is none of them."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Model:
    """Fits the classifier on labelled documents that are not held out.

    A document labelled twice is good only if all labels say so; null labels and ids don't count.
    """
    known = only(labels, ["doc_id", "quality"]).where("doc_id is not null and quality is not null")
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").cast("boolean").alias("good"))
    known = known.withColumn("place", F.xxhash64(F.lit(5), "doc_id"))
    share = known.agg(F.avg(F.col("good").cast("double"))).first()[0]
    chosen = [known.where(F.col("good") == good).orderBy("place", "doc_id").limit(sample) for good in (True, False)]
    # at most two times `sample` rows of three numbers
    few = F.broadcast(chosen[0].union(chosen[1]).withColumnRenamed("doc_id", "of"))
    read = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    rows = read.join(few, F.col("id") == F.col("of")).select("good", "place", "text").mapInArrow(_packed, "good boolean, place long, bits binary")
    # rows that repeat an id would pass the bound; of those the text whose n-grams are least stays
    table = rows.groupBy("place").agg(F.min("good").alias("good"), F.min("bits").alias("bits")).toArrow().sort_by("place").to_pydict()
    unpacked = [np.flatnonzero(np.unpackbits(np.frombuffer(zlib.decompress(b), np.uint8))) for b in table["bits"]]
    return fit(unpacked, np.array(table["good"], bool), 0.5 if share is None else share)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", cut: float = CUT) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs``.

    Scores come from the whole text alone; a null text counts as empty and gets the score of a text
    without n-grams. Ids may be null or repeat. Other columns are not read. An empty table gives an
    empty one.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model._replace(weights=model.weights.astype(np.float32)))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias, slope, shift = sent.value
        for batch in batches:
            rows = [features(t.as_py()) for t in batch.column(1).cast(pa.binary())]
            values = 1 / (1 + np.exp(-np.clip(slope * margins(rows, weights, bias) + shift, -30, 30))) if rows else np.empty(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.float64())], ["doc_id", "score"])

    read = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    found = read.mapInArrow(scored, "doc_id long, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learns from the labelled rows that are not held out and scores all rows."""
    return score(docs, learn(docs, labels, id_col, text_col), id_col, text_col)
