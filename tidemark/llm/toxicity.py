"""Toxicity by non-negative positive-unlabelled learning.

A logistic model over the distinct words of a text is fitted to the class-prior-corrected risk
``prior * R_P(+) + max(0, R_U(-) - prior * R_P(-))``: confirmed toxic texts stand for the positive class,
texts of unknown label for the mixture of both. Where the estimated negative risk falls below zero, the
step goes up that part's gradient instead, so that the model cannot fit it away.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import held_out, pieces, ship_code
from tidemark.llm.hashing import NOT_LETTER, U64, words

WORD_BITS = 22
SAMPLE_BYTES = 1 << 27  # of hashed words that reach the driver, for each of the two sets, beyond a first text


def distinct_words(column: pa.Array) -> Iterator[np.ndarray]:
    """Per whole text its distinct hashed words: runs of letters, A-Z lowered; none for a null."""
    for _, texts in pieces(column, 1 << 20):
        hashed, begin = words(texts, NOT_LETTER)
        hashed = (hashed >> U64(64 - WORD_BITS)).astype(np.int32)
        for low, high in zip(begin[:-1], begin[1:]):
            yield np.unique(hashed[low:high])


@dataclass
class Model:
    words: np.ndarray  # ascending
    weights: np.ndarray
    bias: float

    def score(self, found: np.ndarray) -> float:
        at = np.searchsorted(self.words, found)
        at = np.minimum(at, max(len(self.words) - 1, 0))
        f = self.bias
        if len(self.words):
            f += float(self.weights[at[self.words[at] == found]].sum())
        return float(1 / (1 + np.exp(-np.clip(f, -40, 40))))


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, steps: int = 400,
          rate: float = 0.05, l1: float = 2e-4, least: int = 3) -> Model:
    """Full-batch Adam on the corrected risk, with a proximal L1 step; words seen in fewer than
    ``least`` of the texts are left out."""
    if not positive or not unlabelled:
        return Model(np.zeros(0, np.int32), np.zeros(0), -40.0 if not positive else 0.0)
    rows = [*positive, *unlabelled]
    flat = np.concatenate(rows)
    names, at, seen = np.unique(flat, return_inverse=True, return_counts=True)
    keep = seen >= least
    place = np.cumsum(keep) - 1
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])[keep[at]]
    at, names = place[at[keep[at]]], names[keep]
    p, u = len(positive), len(unlabelled)
    w, b = np.zeros(len(names)), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    for step in range(1, steps + 1):
        f = np.bincount(owner, w[at], len(rows)) + b
        s = 1 / (1 + np.exp(-np.clip(f, -40, 40)))
        loss_minus = np.logaddexp(0, f)  # of calling a row negative
        negative = loss_minus[p:].mean() - prior * loss_minus[:p].mean()
        pull = np.zeros(len(rows))
        if negative >= 0:
            pull[:p] = prior * (s[:p] - 1) / p - prior * s[:p] / p
            pull[p:] = s[p:] / u
        else:
            pull[:p] = prior * s[:p] / p
            pull[p:] = -s[p:] / u
        g = np.append(np.bincount(at, pull[owner], len(names)), pull.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
        scale = rate / (np.sqrt(v[:-1] / (1 - 0.999 ** step)) + 1e-8)
        w = np.sign(w) * np.maximum(np.abs(w) - scale * l1, 0)
    used = w != 0
    return Model(names[used].astype(np.int32), w[used], float(b))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [w.tobytes() for w in distinct_words(batch.column(0))]
        yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(found, pa.binary())],
                                         names=["toxic", "rank", "words"])


def fit(docs: DataFrame, labels: DataFrame, positives: int = 3000, unlabelled: int = 6000, prior: float | None = None) -> Model:
    """Learn from ``docs (doc_id, text)`` and ``labels (doc_id, toxic)``.

    ``prior`` is the share of toxic texts among those of unknown label; where it is not given, the share of
    ``toxic = 1`` among the labelled rows stands for it. At most ``positives`` confirmed and
    ``unlabelled`` other whole texts, by the hash of the id, are fitted; an id with several labels is
    toxic if one says so, and of several texts of an id the one with the least digest is taken; within ``SAMPLE_BYTES`` later ones go
    first. Rows with a null id, text or label teach nothing, rows that repeat teach once; without a confirmed
    text all scores are near 0.
    """
    ship_code(docs.sparkSession)
    texts = docs.where("doc_id is not null and text is not null").select("doc_id", "text")
    known = (labels.where("doc_id is not null and toxic is not null")
             .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    if prior is None:
        prior = known.agg(F.avg("toxic")).first()[0] or 0.0
    prior = min(max(prior, 1e-3), 1 - 1e-3)
    rank = F.xxhash64("doc_id")
    sure = (texts.select("doc_id").join(known.where("toxic = 1").select("doc_id"), "doc_id").distinct()
            .withColumn("rank", rank).orderBy("rank", "doc_id").limit(positives).withColumn("toxic", F.lit(1)))
    any_label = (texts.select("doc_id").distinct().withColumn("rank", rank)
                 .orderBy("rank", "doc_id").limit(unlabelled).withColumn("toxic", F.lit(0)))
    # Bounded by the two parameters, so it may be broadcast.
    before = Window.partitionBy("toxic").orderBy("rank", "words").rowsBetween(Window.unboundedPreceding, -1)
    sample = (texts.join(F.broadcast(sure.unionByName(any_label)), "doc_id")
              .groupBy("doc_id", "toxic", "rank").agg(F.min_by("text", F.sha2("text", 256)).alias("text")).select("text", "toxic", "rank")
              .mapInArrow(_features, "toxic int, rank long, words binary")
              .withColumn("before", F.coalesce(F.sum(F.octet_length("words")).over(before), F.lit(0)))
              .where(F.col("before") < SAMPLE_BYTES).drop("before").collect())
    sample.sort(key=lambda r: (r["rank"], bytes(r["words"])))
    rows = {k: [np.frombuffer(r["words"], np.int32) for r in sample if r["toxic"] == k] for k in (0, 1)}
    return train(rows[1], rows[0], prior)


def predict(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """``(doc_id, score, predicted)`` per row, rows that repeat each by itself; the score reads the whole text
    alone, of any length, a null one as empty. An empty table gives no rows; other columns are ignored."""
    ship_code(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = [model.score(w) for w in distinct_words(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score, pa.float64()), pa.array([int(s >= threshold) for s in score], pa.int32())],
                names=["doc_id", "score", "predicted"])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from the rows that are not held out, and score all of ``docs``."""
    model = fit(docs.where(~held_out()), labels.where(~held_out()))
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")
