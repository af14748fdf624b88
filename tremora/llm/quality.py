"""Quality: a compression classifier.

Two zstandard dictionaries are built, from good and from bad labelled texts. A text is compressed
with each, block by block so that long texts meet the dictionaries all along. The difference of the
two sizes over their sum is turned into a probability by a logistic fit on labelled rows that
are in neither dictionary; its weight depends on the logarithm of the bytes, as differences of
short texts say less. Nothing else goes into the score.

At most ``SAMPLE_ROWS`` labelled rows are read for the fit (the first by a hash of the id). The
dictionaries are trained on at most ``DICTIONARY_BLOCKS`` blocks a class, taken by a hash from all
blocks of these rows' whole texts. Scoring compresses all blocks of all texts.

Defined cases: null and empty texts have the difference 0; null labels and labels without document
are left out, of repeated labels of an id the largest counts; without rows of both classes every
score is the smoothed share of good ones; further columns are not read; an empty table gives
an empty one.
"""

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremora.llm.common import fold_of, small_batches, texts
from tremora.llm.toxicity import SAMPLE_ROWS, labelled_texts, sampled_labels

DICTIONARY_BLOCKS = 6000
DICTIONARY_BYTES = 400_000
#: Characters of a block.
BLOCK = 2048
LEVEL = 3


@dataclass
class Compressors:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]  # of ``inputs``, then the shift


def dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary; from too few samples to train on, their plain content."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


class Sizes:
    """Compressed sizes with both dictionaries."""

    def __init__(self, model: Compressors) -> None:
        self.tools = []
        for raw in (model.good, model.bad):
            words = zstandard.ZstdCompressionDict(raw) if raw else None
            if words:
                words.precompute_compress(level=LEVEL)
            self.tools.append(zstandard.ZstdCompressor(
                level=LEVEL, dict_data=words, write_checksum=False, write_content_size=False,
                write_dict_id=False))

    def measure(self, text: str) -> tuple[float, float, float]:
        """The difference (above 0 where the good dictionary fits better), the larger size by
        byte, and the logarithm of the bytes."""
        good = bad = raw = 0
        for at in range(0, len(text), BLOCK):
            block = text[at:at + BLOCK].encode()
            raw += len(block)
            good += len(self.tools[0].compress(block))
            bad += len(self.tools[1].compress(block))
        if not raw:
            return 0.0, 1.0, 0.0
        return (bad - good) / (bad + good), min(1.0, max(good, bad) / raw), math.log1p(raw)


_TOOLS: list = []


def _sizes(model: Compressors) -> Sizes:
    if not _TOOLS or _TOOLS[0] is not model:
        _TOOLS[:] = [model, Sizes(model)]
    return _TOOLS[1]


def measures(text: Column, model: Compressors, spark) -> Column:
    """A struct ``difference, density, size`` for a text column."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("difference double, density double, size double")
    def run(texts: pd.Series) -> pd.DataFrame:
        tool = _sizes(shared.value)
        return pd.DataFrame([tool.measure(t) for t in texts],
                            columns=["difference", "density", "size"], dtype=float)

    return run(text)


def inputs(m) -> list:
    """What the logistic fit sees, of numbers, arrays or columns alike: the difference, and how much
    it says at this length."""
    d, _, n = m
    return [d, d * n]


def calibrate(x: np.ndarray, y: np.ndarray, steps: int = 60) -> list[float]:
    """Weights of a logistic regression and its shift, by Newton's method, slightly smoothed."""
    mean, scale = x.mean(0), np.where(x.std(0) > 0, x.std(0), 1.0)
    a = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    ridge = np.diag([1e-2] * x.shape[1] + [1e-6])
    w = np.zeros(a.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p) + 1e-9)[:, None]) + ridge,
                               a.T @ (p - y) + ridge @ w)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    plain = w[:-1] / scale
    return [*plain.tolist(), float(w[-1] - plain @ mean)]


def fit(docs: DataFrame, labels: DataFrame, column: str = "quality", folds: int = 4,
        held_out: int = 2, sample_rows: int = SAMPLE_ROWS) -> Compressors:
    spark = docs.sparkSession
    sample = sampled_labels(labels, column, folds, held_out, sample_rows)
    rows = labelled_texts(docs, sample).where("text <> ''")
    # every other row by another hash: some for the dictionaries, the others to calibrate
    for_words = F.pmod(F.xxhash64(F.lit("words"), "doc_id"), F.lit(2)) == 0
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.length("text") - 1) / BLOCK).cast("int")),
                         lambda k: F.substring("text", k * BLOCK + 1, F.lit(BLOCK)))
    chosen: dict[int, list[bytes]] = {}
    for label in (0, 1):
        picked = (rows.where(for_words & (F.col("label") == label))
                  .select("doc_id", F.posexplode(blocks).alias("at", "text"))
                  .select(F.xxhash64("doc_id", "at").alias("mark"), "text")
                  .orderBy("mark", "text").limit(DICTIONARY_BLOCKS).collect())
        chosen[label] = [r.text.encode() for r in picked]
    prior = sample.groupBy("label").count().collect()
    good = sum(r["count"] for r in prior if r.label == 1)
    share = (good + 1) / (sum(r["count"] for r in prior) + 2)
    model = Compressors(dictionary(chosen[1]) if chosen[1] else b"",
                        dictionary(chosen[0]) if chosen[0] else b"",
                        (0.0,) * len(inputs((0, 0, 0))) + (float(np.log(share / (1 - share))),))
    if not (chosen[0] and chosen[1]):
        return model
    pairs = rows.where(~for_words).select(
        measures(F.col("text"), model, spark).alias("m"), "label", "doc_id").collect()
    pairs.sort(key=lambda r: r.doc_id)  # the fit must not hang on the order of arrival
    y = np.array([r.label for r in pairs], float)
    if len(y) and y.min() < y.max():
        x = np.stack(inputs(np.array([tuple(r.m) for r in pairs]).T), 1)
        model.weights = tuple(calibrate(x, y))
    return model


def report(docs: DataFrame, model: Compressors, folds: int = 4, held_out: int = 2,
           limit: float = 0.7) -> DataFrame:
    """``doc_id, held_out, score, difference, density, predicted`` for every row; the density (the
    larger size by byte) is for the reader, no part of the score."""
    *weights, shift = model.weights
    parts = inputs([F.col(f"m.{c}") for c in ("difference", "density", "size")])
    margin = sum((w * part for w, part in zip(weights, parts)), F.lit(shift))
    return (texts(docs).select(
        "doc_id", (fold_of(F.col("doc_id"), folds) == held_out).alias("held_out"),
        measures(F.col("text"), model, docs.sparkSession).alias("m"))
        .select("doc_id", "held_out", (1 / (1 + F.exp(-margin))).alias("score"), "m.difference",
                "m.density")
        .withColumn("predicted", (F.col("score") >= limit).cast("int")))
