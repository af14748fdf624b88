"""Toxicity: a factorization machine over hashed terms.

A text's features are its hashed words and their hashed beginnings of 3 to 8 letters, which stand
for words never seen that are built from a known one; each with whether one, two, or three and
more different words of the text share it. The machine adds to the linear weights an inner
product of factors for each pair of features, so an insult together with a group counts for more
than the two apart. It is fitted on at most ``sample_rows`` labelled rows (the first by a hash of
the id), over the ``max_terms`` hashed terms that split their classes best; scoring reads all words
of all texts.

Defined cases: null and empty texts have no features and get the score of the bias; labels that are
null, or whose document is missing, are left out, and of repeated labels of an id the largest
counts; without any labelled rows, or with one class only, every score is the smoothed share of
the positive class; further columns stay as they are or are not read; an empty table gives an empty
one.
"""

import re
import zlib
from collections import Counter
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremora.llm.common import Memo, fold_of, small_batches, texts

#: Most labelled rows that a fit reads.
SAMPLE_ROWS = 20_000
#: Most hashed terms with weights.
MAX_TERMS = 4096
HASH_BITS = 20
PREFIXES = range(3, 9)
LEVELS = 3
WORD = re.compile(r"\w+")


def sampled_labels(labels: DataFrame, column: str, folds: int, held_out: int,
                   sample_rows: int) -> DataFrame:
    """``doc_id, label`` of at most ``sample_rows`` rows outside the held-out fold."""
    return (labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull()
                         & (fold_of(F.col("doc_id"), folds) != held_out))
            .groupBy("doc_id").agg(F.max(column).cast("int").alias("label"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))


def labelled_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """``doc_id, text, label``; the sample's size is bounded, so it is broadcast."""
    return texts(docs).join(F.broadcast(sample), "doc_id")


def buckets(word: str) -> list[int]:
    """Of the word, and of its beginnings (marked by a tilde)."""
    terms = [word] + [word[:k] + "~" for k in PREFIXES if k <= len(word)]
    return [zlib.crc32(t.encode()) & ((1 << HASH_BITS) - 1) for t in terms]


def levels(counts: Counter) -> list[int]:
    """Terms of buckets with their numbers of words: the bucket, and above its bits the number."""
    return [b + (k << HASH_BITS) for b, n in counts.items() for k in range(min(n, LEVELS))]


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def hashed_terms(text: pd.Series) -> pd.Series:
    return pd.Series([levels(Counter(b for w in set(WORD.findall(t.lower())) for b in buckets(w)))
                      for t in text], dtype=object)


def select_terms(terms: DataFrame, max_terms: int = MAX_TERMS, least: int = 4,
                 least_chi: float = 25.0) -> list[int]:
    """The buckets whose share of documents differs most between the classes, by chi-square; what
    lies below ``least_chi`` would only let the fit learn its rows by heart.

    The counts have at most LEVELS * 2**HASH_BITS rows.
    """
    n, pos = terms.agg(F.count(F.lit(1)), F.sum("label")).first()
    counts = (terms.select("label", F.explode("terms").alias("term")).groupBy("term")
              .agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("pos")).where(f"n >= {least}"))
    if not n or not 0 < pos < n:
        return []
    gap = F.col("pos") * float(n) - F.col("n") * float(pos)
    chi = gap * gap * (n / (float(pos) * (n - pos))) / (
        F.col("n") * F.greatest(float(n) - F.col("n"), F.lit(1.0)))
    best = counts.withColumn("chi", chi).where(F.col("chi") >= least_chi)
    return sorted(r.term for r in best.orderBy(F.desc("chi"), "term").limit(max_terms).collect())


@dataclass
class Machine:
    """Bias, linear weights and factors, by position in ``terms``."""

    bias: float
    terms: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    factors: np.ndarray = field(default_factory=lambda: np.zeros((0, 1), np.float32))

    def margins(self, index: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
        """For ``n`` texts with features ``index``, feature k belonging to text ``rows[k]``."""
        out = np.full(n, self.bias) + np.bincount(rows, self.weights[index], n)
        for f in range(self.factors.shape[1]):
            v = self.factors[index, f].astype(float)
            total = np.bincount(rows, v, n)
            out += 0.5 * (total * total - np.bincount(rows, v * v, n))
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_machine(features: list[np.ndarray], labels: np.ndarray, terms: np.ndarray,
                factors: int = 8, epochs: int = 30, batch: int = 256, rate: float = 0.2,
                decay: float = 5e-5, seed: int = 7) -> Machine:
    """Logistic loss, AdaGrad steps on batches; ``features`` are positions in ``terms``."""
    rng, n, m = np.random.default_rng(seed), len(labels), len(terms)
    share = (labels.sum() + 1) / (n + 2)
    start = float(np.log(share / (1 - share)))
    model = Machine(start, terms, np.zeros(m), rng.normal(0, 0.02, (m, factors)))
    if n == 0 or m == 0 or labels.min() == labels.max():
        return Machine(start)
    sizes = np.array([len(f) for f in features])
    sums = [np.full_like(model.weights, 1e-2), np.full_like(model.factors, 1e-2), 1e-2]
    for epoch in range(epochs):
        order = rng.permutation(n)
        for at in range(0, n, batch):
            pick = order[at:at + batch]
            index = np.concatenate([features[i] for i in pick])
            rows = np.repeat(np.arange(len(pick)), sizes[pick])
            error = (_sigmoid(model.margins(index, rows, len(pick))) - labels[pick]) / len(pick)
            used, place = np.unique(index, return_inverse=True)
            v = model.factors[index]
            total = np.stack([np.bincount(rows, v[:, f], len(pick)) for f in range(factors)], 1)
            grad_v = error[rows][:, None] * (total[rows] - v)
            g_w = np.bincount(place, error[rows], len(used)) + decay * model.weights[used]
            g_v = np.stack([np.bincount(place, grad_v[:, f], len(used)) for f in range(factors)],
                           1) + decay * model.factors[used]
            sums[0][used] += g_w * g_w
            sums[1][used] += g_v * g_v
            model.weights[used] -= rate * g_w / np.sqrt(sums[0][used])
            model.factors[used] -= rate * 0.3 * g_v / np.sqrt(sums[1][used])
            g_b = error.sum()
            sums[2] += g_b * g_b
            model.bias -= rate * g_b / np.sqrt(sums[2])
    return model


def fit(docs: DataFrame, labels: DataFrame, column: str = "toxic", folds: int = 3,
        held_out: int = 1, sample_rows: int = SAMPLE_ROWS, max_terms: int = MAX_TERMS) -> Machine:
    """Fit on labelled rows outside the held-out fold. What reaches the driver is bounded by
    ``sample_rows`` times ``max_terms``."""
    small_batches(docs.sparkSession)
    sample = sampled_labels(labels, column, folds, held_out, sample_rows)
    terms = labelled_texts(docs, sample).select("doc_id", "label", hashed_terms("text").alias(
        "terms")).persist()  # bounded; lost blocks are computed again
    try:
        chosen = select_terms(terms, max_terms)
        few = F.array(*[F.lit(t) for t in chosen]) if chosen else F.array().cast("array<int>")
        rows = terms.orderBy("doc_id").select("label", F.array_sort(
            F.array_intersect("terms", few)).alias("terms")).collect()
    finally:
        terms.unpersist()
    known = np.array(chosen, np.int64)
    features = [np.searchsorted(known, np.array(r.terms, np.int64)) for r in rows]
    return fit_machine(features, np.array([r.label for r in rows], float), known)


def score(text: Column, model: Machine, spark) -> Column:
    """Probability of the positive class for a text column, over its every word."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        machine = shared.value
        places, words = _places(machine)
        index, counts = [], []
        for t in texts:
            held = Counter(chain.from_iterable(map(words.__getitem__,
                                                   set(WORD.findall(t.lower())))))
            found = [places[term] for term in levels(held) if term in places]
            index.extend(found)
            counts.append(len(found))
        n = len(counts)
        return pd.Series(_sigmoid(machine.margins(np.array(index, np.int64),
                                                  np.repeat(np.arange(n), counts), n)))

    return run(text)


_PLACES: list = []


def _places(machine: Machine) -> tuple[dict[int, int], Memo]:
    """Positions of terms, and a word's buckets that matter; kept for the model at hand."""
    if not _PLACES or _PLACES[0] is not machine:
        known = {int(t) & ((1 << HASH_BITS) - 1) for t in machine.terms}
        _PLACES[:] = [machine, {int(t): k for k, t in enumerate(machine.terms)},
                      Memo(lambda word: tuple(b for b in buckets(word) if b in known), 100_000)]
    return _PLACES[1], _PLACES[2]


def report(docs: DataFrame, model: Machine, folds: int = 3, held_out: int = 1,
           limit: float = 0.7) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row."""
    rows = texts(docs)
    return rows.select("doc_id", (fold_of(F.col("doc_id"), folds) == held_out).alias("held_out"),
                       score(F.col("text"), model, docs.sparkSession).alias("score")).withColumn(
        "predicted", (F.col("score") >= limit).cast("int"))


def without_toxic(docs: DataFrame, model: Machine, limit: float = 0.7,
                  text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below ``limit``, with all their columns."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (docs.select(F.struct("*").alias("__row"),
                        score(text, model, docs.sparkSession).alias("__score"))
            .where(F.col("__score") < limit).select("__row.*"))
