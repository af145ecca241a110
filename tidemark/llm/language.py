"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Learned with follow-the-regularised-leader (per-coordinate steps, L1 and L2 penalties), then calibrated
with one temperature on rows kept aside. Document frequencies count every learning row; every language is
learned, from at most ``rows_per_language`` whole texts, taken by the hash of the id, and from fewer where
there are so many languages that all together would pass ``rows_in_all``. State and weights are sparse: there
is a weight for each feature and language that met in a learning row, and for no other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tidemark.llm.common import free_name, held_out, ship_code
from tidemark.llm.hashing import U64, mix

FEATURE_BITS = 14
FEATURES = 1 << FEATURE_BITS
ORDERS = (1, 2, 3)
LETTER = regex.compile(r"\p{L}")
UNKNOWN = "und"
MOST_LANGUAGES = 32_000  # an error beyond: a name each reaches the driver
SAMPLE_BYTES = 1 << 28  # of features that reach the driver, beyond a first row of each language
MOST_WEIGHTS = 1 << 24  # an error beyond; 6 bytes each go to every task
_FACTORS = mix(np.arange(7, 7 + max(ORDERS), dtype=U64)) | U64(1)


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character n-grams of a whole text, and how often each occurs."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(U64)
    rolled, out = np.zeros(len(points), dtype=U64), np.zeros(FEATURES, dtype=np.int64)
    for n in ORDERS:
        if len(points) < n:
            break
        rolled = rolled[:len(points) - n + 1] + points[n - 1:] * _FACTORS[n - 1]
        mixed = (rolled + U64(n)) * U64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> U64(29)
        out += np.bincount((mixed * U64(0xBF58476D1CE4E5B9) >> U64(64 - FEATURE_BITS)).astype(np.int64), minlength=FEATURES)
    at = np.flatnonzero(out)
    return at, out[at]


def weigh(at: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    value = (1 + np.log(count)) * idf[at]
    return value / max(float(np.sqrt((value * value).sum())), 1e-12)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of the task hold a feature; feature -1 counts the texts."""
    held, n = np.zeros(FEATURES, dtype=np.int64), 0
    for batch in batches:
        for text in batch.column(0).to_pylist():
            held[gram_counts(text)[0]] += 1
            n += 1
    at = np.flatnonzero(held)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(held[at], n), pa.int64())],
                                     names=["feature", "n"])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [gram_counts(t) for t in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([a.astype(np.int32).tobytes() for a, _ in rows], pa.binary()),
             pa.array([c.astype(np.int32).tobytes() for _, c in rows], pa.binary()), batch.column(1), batch.column(2),
             batch.column(3).cast(pa.string())],
            names=["at", "n", "lang", "rank", "doc_id"])


@dataclass
class Model:
    """``classes`` and ``weights`` of feature f lie at ``begin[f]`` to ``begin[f + 1]``."""

    languages: list[str]
    idf: np.ndarray
    begin: np.ndarray
    classes: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def logits(self, at: np.ndarray, value: np.ndarray) -> np.ndarray:
        cells, x = spread(self.begin, at, value)
        return np.bincount(self.classes[cells], x * self.weights[cells], minlength=len(self.bias)) + self.bias


def spread(begin: np.ndarray, at: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of all weights of the features ``at``, and each one's feature value."""
    counts = begin[at + 1] - begin[at]
    total = np.cumsum(counts)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(begin[at] - total + counts, counts), np.repeat(value, counts)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int = 4, alpha: float = 0.5,
          beta: float = 1.0, l1: float = 0.02, l2: float = 0.1) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """FTRL-proximal over sparse rows ``(features, values, class)``: ``(begin, classes, weights, bias)`` of the
    weights that are not 0."""
    met = [np.unique(np.concatenate([at.astype(np.int64) * classes + label for at, _, label in rows[i:i + 256]])) for i in range(0, len(rows), 256)]
    cells = np.unique(np.concatenate(met)) if met else np.zeros(0, dtype=np.int64)
    if len(cells) > MOST_WEIGHTS:
        raise ValueError(f"{len(cells)} weights for {classes} languages; at most {MOST_WEIGHTS} are learned")
    begin, owner = np.searchsorted(cells, np.arange(FEATURES + 1) * classes), (cells % classes).astype(np.int32)
    z, n = np.zeros(len(cells) + classes), np.zeros(len(cells) + classes)  # the bias at the end

    def weights(zs: np.ndarray, ns: np.ndarray) -> np.ndarray:
        return np.where(np.abs(zs) <= l1, 0.0, -(zs - np.sign(zs) * l1) / ((beta + np.sqrt(ns)) / alpha + l2))

    order = np.random.default_rng(0)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, value, label = rows[i]
            place, x = spread(begin, at, value.astype(np.float64))
            kind = np.concatenate([owner[place], np.arange(classes)])
            place, x = np.concatenate([place, len(cells) + np.arange(classes)]), np.concatenate([x, np.ones(classes)])
            w = weights(z[place], n[place])
            error = softmax(np.bincount(kind, x * w, minlength=classes))
            error[label] -= 1
            g = x * error[kind]
            z[place] += g - (np.sqrt(n[place] + g * g) - np.sqrt(n[place])) / alpha * w
            n[place] += g * g
    w = weights(z, n)
    own = np.flatnonzero(w[:len(cells)])
    return np.searchsorted(cells[own], np.arange(FEATURES + 1) * classes), owner[own], w[own].astype(np.float32), w[len(cells):]


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least negative log likelihood."""
    def loss(t: float) -> float:
        return float(-np.log(np.maximum(softmax(logits / t)[np.arange(len(labels)), labels], 1e-12)).mean())
    return float(min(np.geomspace(0.05, 5, 80), key=loss)) if len(labels) else 1.0


def fit(docs: DataFrame, rows_per_language: int = 500, rows_in_all: int = 32_000) -> Model:
    """Learn from ``(text, lang, doc_id)`` rows; rows without text, letter, language or id teach nothing. An
    empty table gives a model without languages; rows that repeat teach once.

    At most ``rows_in_all`` rows reach the driver, as features of whole texts of any length, or one of each
    language if there are more languages than that; none is left out. Within ``SAMPLE_BYTES``, shared evenly
    by the languages, later rows of a language go first. Of the texts that share id and language, the one with
    the least digest is taken. Rows are chosen by the hash of their id: those below a bound that lets about
    twice as many ids of a language pass as it needs, so that no task sees more of a language, whatever its size.
    """
    ship_code(docs.sparkSession)
    usable = docs.where(F.col("text").rlike(r"\p{L}") & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    counted = dict(usable.select("text").mapInArrow(_frequencies, "feature int, n long")
                   .groupBy("feature").agg(F.sum("n").alias("n")).collect())
    df = np.zeros(FEATURES)
    for feature, n in counted.items():
        if feature >= 0:
            df[feature] = n
    idf = np.log((1 + counted.get(-1, 0)) / (1 + df)) + 1
    ids = usable.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("ids")).limit(MOST_LANGUAGES + 1).collect()
    if len(ids) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    names = sorted(r["lang"] for r in ids)
    each = min(rows_per_language, max(1, rows_in_all // max(len(names), 1)))
    passing = [(r["lang"], (1 << 63) - 1 if r["ids"] <= 2 * each + 50 else int((2 * each + 50) / r["ids"] * (1 << 64)) - (1 << 63)) for r in ids]
    bounds = docs.sparkSession.createDataFrame(passing, "lang string, highest long")  # MOST_LANGUAGES rows at most
    rank = F.xxhash64("doc_id")
    chosen = (usable.select("doc_id", "lang").withColumn("rank", rank).join(F.broadcast(bounds), "lang").where("rank <= highest")
              .select("doc_id", "lang", "rank").distinct()
              .withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("rank", "doc_id")))
              .where(F.col("n") <= each).select("doc_id", "lang", "rank"))
    # Bounded by the two parameters or the number of languages, so it may be broadcast.
    upto = Window.partitionBy("lang").orderBy("rank", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    sample = (usable.select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"])
              .groupBy("doc_id", "lang", "rank").agg(F.min_by("text", F.sha2("text", 256)).alias("text")).select("text", "lang", "rank", "doc_id")
              .mapInArrow(_features, "at binary, n binary, lang string, rank long, doc_id string")
              .withColumn("before", F.coalesce(F.sum(F.octet_length("at") + F.octet_length("n")).over(upto), F.lit(0)))
              .where(F.col("before") < SAMPLE_BYTES // max(len(names), 1)).drop("before", "doc_id").collect())
    rows, kept, place, learned = [], [], {name: k for k, name in enumerate(names)}, set()
    for r in sorted(sample, key=lambda r: (r["rank"], r["lang"])):
        at = np.frombuffer(r["at"], np.int32)
        row = (at, weigh(at, np.frombuffer(r["n"], np.int32), idf).astype(np.float32), place[r["lang"]])
        # The first row of a language always teaches it.
        (kept if row[2] in learned and r["rank"] % 5 == 0 else rows).append(row)
        learned.add(row[2])
    if not names:
        return Model([], idf.astype(np.float32), np.zeros(FEATURES + 1, dtype=np.int64), np.zeros(0, np.int32), np.zeros(0, np.float32), np.zeros(0), 1.0)
    model = Model(names, idf.astype(np.float32), *train(rows, len(names)), 1.0)
    if kept:
        model.temperature = temperature(np.array([model.logits(a, v) for a, v, _ in kept]), np.array([y for *_, y in kept]))
    return model


def predict(docs: DataFrame, model: Model, lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the calibrated probability of that language.

    A null text, one without a letter, or a model without languages gives ``und`` and 0. All columns of
    ``docs`` stay; columns that had one of the two names are replaced. Only the text is read.
    """
    ship_code(docs.sparkSession)

    def one(text: str | None) -> tuple[str, float]:
        if not model.languages or text is None or not LETTER.search(text):
            return UNKNOWN, 0.0
        at, count = gram_counts(text)
        p = softmax(model.logits(at, weigh(at, count, model.idf)) / model.temperature)
        k = int(p.argmax())
        return model.languages[k], float(p[k])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [one(t) for t in batch.column("text").to_pylist()]
            new = {lang: pa.array([x[0] for x in found], pa.string()), score: pa.array([x[1] for x in found], pa.float64())}
            names = [n for n in batch.schema.names if n not in new]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], *new.values()], names=[*names, *new])

    kept = docs.drop(lang, score)
    schema = StructType([*kept.schema.fields, StructField(lang, StringType()), StructField(score, DoubleType())])
    return kept.mapInArrow(run, schema)


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the rows of ``docs`` that are not held out, and predict all of them, rows that repeat each by
    itself. Null texts, and texts without a letter, are ``und``; texts of any length are read whole; an empty
    table gives no rows; other columns are ignored, whatever they are called."""
    model = fit(docs.where(~held_out()).select("doc_id", "text", "lang"))
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def identified(docs: DataFrame, least: float = 0.4) -> DataFrame:
    """The rows of ``docs`` whose language is known with a score of ``least``, with all their columns.

    Rows without text or letter go, and those of which no language has a clear part. Where no row
    teaches a language, all are kept: there is nothing to tell them by.
    """
    model = fit(docs.where(~held_out()).select("doc_id", "text", "lang"))
    if not model.languages:
        return docs
    lang, score = free_name(docs, "lang_pred"), free_name(docs, "score")
    found = predict(docs, model, lang, score)
    return found.where((F.col(lang) != UNKNOWN) & (F.col(score) >= least)).select(*docs.columns)
