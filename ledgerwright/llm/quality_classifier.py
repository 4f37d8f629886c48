"""Quality classifier: logistic regression on hashed word n-grams, trained by FTRL-proximal.

Words (letters and digits, or runs of other signs) and pairs of neighbouring words are
hashed into ``2**BITS`` features, weighted by 1 + log of their count and scaled to unit
length. Training rows are a bounded sample of the labelled ones: the ``SAMPLE`` rows
of smallest hashed id, learned one after another with follow-the-regularised-leader
updates in one task. The model has at most ``2**BITS`` weights, which bounds what is
broadcast. A score is the
sparse dot product with the text's features, through the logistic function.

Defined cases: a null or empty text scores by the intercept alone; null labels are not
learned from; without labelled rows every score is 0.5; rows that repeat are scored
each; an empty table gives an empty result; other columns are never inputs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops
from .common import crc32_mod

BITS = 18
SAMPLE = 12_000      # labelled rows that are learned from, at most
EPOCHS = 6
ALPHA, BETA, L1, L2 = 30.0, 1.0, 0.01, 0.0001
THRESHOLD = 0.3


def features(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted feature numbers and weights of one text; feature 0 is the intercept."""
    pairs = textops.shingles(hashes, 2)
    at = (np.concatenate([hashes, pairs]) >> np.uint64(64 - BITS)).astype(np.int64)
    at, count = np.unique(at, return_counts=True)
    at, count = at[at > 0], count[at > 0]
    value = 1.0 + np.log(count)
    length = np.sqrt((value * value).sum())
    return np.concatenate([[0], at]), np.concatenate([[1.0], value / length if length else value])


def _rows(texts: pa.Array):
    buf, offs = textops.text_buffer(texts)
    for i, j in textops.blocks(offs):
        base = offs[i]
        hashes, _, first = textops.words(buf[base:offs[j]], offs[i:j + 1] - base, by_kind=True)
        for k in range(j - i):
            yield features(hashes[first[k]:first[k + 1]])


def _learn(sample: pd.DataFrame) -> pd.DataFrame:
    """FTRL-proximal over the sampled rows, in the order of their hashed ids."""
    sample = sample.sort_values(["place", "text"])
    rows = list(_rows(pa.array(sample["text"], pa.string())))
    labels = sample["label"].to_numpy()
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)

    def weights(at):
        return np.where(np.abs(z[at]) <= L1, 0.0,
                        -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))
    for _ in range(EPOCHS):
        for (at, value), label in zip(rows, labels):
            w = weights(at)
            p = 1.0 / (1.0 + np.exp(-np.clip(value @ w, -35, 35)))
            g = (p - label) * value
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    w = weights(np.arange(1 << BITS))
    at = np.flatnonzero(w)
    return pd.DataFrame({"feature": at, "weight": w[at]})


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> np.ndarray:
    """Weights learned from a sample of at most ``sample`` labelled documents."""
    chosen = (labels.select(F.col("doc_id"), F.col(label).cast("double").alias("label"))
              .where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
              .withColumn("place", F.xxhash64("doc_id")).orderBy("place", "doc_id").limit(sample))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    model = (rows.select("place", "label", "text").groupBy(F.lit(0).alias("all"))
             .applyInPandas(_learn, "feature long, weight double")).toPandas()
    weights = np.zeros(1 << BITS)
    weights[model["feature"]] = model["weight"]
    return weights


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """Rows (doc_id, score), one per row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    def run(batches):
        for batch in batches:
            w = sent.value
            dots = np.array([value @ w[at] for at, value in _rows(batch.column("text"))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(1.0 / (1.0 + np.exp(-np.clip(dots, -35, 35))), pa.float64())],
                ["doc_id", "score"])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted); rows held out (id hash modulo 5 is 0) are never learned."""
    held_out = crc32_mod(F.col("doc_id"), 5) == 0
    weights = train(docs.where(~held_out), labels.where(~held_out))
    return score(docs, weights).select("doc_id", held_out.alias("held_out"), "score",
                                       (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
