"""Language identification by sparse multinomial logistic regression.

Texts become TF-IDF weights of hashed character n-grams. Document frequencies
come from all documents that may be learned from; the regression is trained on
a bounded sample of them with follow-the-regularised-leader (FTRL-proximal) and
elastic-net penalties, in rounds: tasks train on their parts of the sample and
their states are averaged. A temperature fitted on the rest of the sample makes
the probabilities honest.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import bounded, id_remainder, short_batches
from trolley.sources.storage import settled

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
CHUNK = 1 << 20
# Bound of the labelled sample that is fitted on; one in five of it calibrates.
SAMPLE = 6000
PARTS = 4
ROUNDS = 3
ALPHA, BETA, LAMBDA1, LAMBDA2 = 0.5, 1.0, 0.05, 0.1
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray  # by bucket
    weights: np.ndarray  # bucket x language; mostly zeros
    bias: np.ndarray
    temperature: float


def gram_counts(text: str) -> np.ndarray:
    """How often each bucket of character n-grams occurs; case is ignored and what is not a letter is a blank."""
    counts = np.zeros(BUCKETS)
    plain = " " + re.sub(r"[\W\d_]+", " ", text.lower()) + " "
    codes = np.frombuffer(plain.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    for start in range(0, len(codes), CHUNK):
        # Chunks overlap by what an n-gram needs of the next.
        part = codes[start : start + CHUNK + max(ORDERS) - 1]
        for order in ORDERS:
            size = min(len(part), CHUNK + order - 1) - order + 1
            if size <= 0:
                continue
            mixed = np.full(size, order, dtype=np.uint32)
            for k in range(order):
                mixed = (mixed ^ part[k : k + size]) * np.uint32(0x9E3779B1)
                mixed ^= mixed >> np.uint32(15)
            counts += np.bincount(mixed & np.uint32(BUCKETS - 1), minlength=BUCKETS)
    return counts


def tf_idf(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and their weights, of length one together."""
    counts = gram_counts(text)
    buckets = np.flatnonzero(counts)
    values = np.log1p(counts[buckets]) * idf[buckets]
    return buckets, values / max(float(np.sqrt(values @ values)), 1e-12)


def _document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each bucket occurs, and the number of texts."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, n = np.zeros(BUCKETS, dtype=np.int64), 0
        for frame in frames:
            for text in frame["text"]:
                seen += gram_counts(text) > 0
                n += 1
        found = np.flatnonzero(seen)
        yield pd.DataFrame({"bucket": np.append(found, -1), "n": np.append(seen[found], n)})

    # One row per bucket at most comes to the driver.
    rows = texts.mapInPandas(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    frequencies = np.zeros(BUCKETS)
    inside = rows["bucket"] >= 0
    frequencies[rows["bucket"][inside]] = rows["n"][inside]
    return frequencies, int(rows["n"][~inside].sum())


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Weights that the FTRL state stands for; small sums are exactly zero."""
    kept = np.sign(z) * np.maximum(np.abs(z) - LAMBDA1, 0)
    return -kept / ((BETA + np.sqrt(n)) / ALPHA + LAMBDA2)


def ftrl_epoch(state: tuple[np.ndarray, np.ndarray], examples: list[tuple[np.ndarray, np.ndarray, int]]) -> None:
    """One pass over (buckets, values, class), changing the state; its last row is the bias."""
    z, n = state
    bias = len(z) - 1
    for buckets, values, label in examples:
        at, x = np.append(buckets, bias), np.append(values, 1.0)
        w = _weights(z[at], n[at])
        error = _softmax(x @ w)
        error[label] -= 1
        gradient = x[:, None] * error[None, :]
        grown = n[at] + gradient**2
        z[at] += gradient - (np.sqrt(grown) - np.sqrt(n[at])) / ALPHA * w
        n[at] = grown


def _examples(frame: pd.DataFrame) -> list[tuple[np.ndarray, np.ndarray, int]]:
    frame = frame.sort_values("place")
    return [(np.asarray(b), np.asarray(v), int(c)) for b, v, c in zip(frame["buckets"], frame["tf_idf"], frame["label"])]


def _epoch_from(shared):
    """A function that trains from a broadcast state on one part of the sample."""

    def epoch(frame: pd.DataFrame) -> pd.DataFrame:
        z, n = (s.copy() for s in shared.value)
        ftrl_epoch((z, n), _examples(frame))
        return pd.DataFrame({"z": [z.astype(np.float32).tobytes()], "n": [n.astype(np.float32).tobytes()]})

    return epoch


def _train(sample: DataFrame, classes: int) -> tuple[np.ndarray, np.ndarray]:
    state = (np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes)))
    spark = sample.sparkSession
    for _ in range(ROUNDS):
        shared = spark.sparkContext.broadcast(state)

        found = sample.filter("part >= 0").groupBy("part").applyInPandas(_epoch_from(shared), "z binary, n binary").collect()
        shared.destroy()
        state = tuple(
            np.mean([np.frombuffer(row[i], dtype=np.float32).reshape(BUCKETS + 1, classes) for row in found], axis=0, dtype=float)
            for i in (0, 1)
        )
    weights = _weights(*state)
    return weights[:-1], weights[-1]


def best_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature that makes the labels likeliest, by golden-section search over its logarithm."""
    if len(labels) == 0:
        return 1.0

    def loss(log_t: float) -> float:
        p = _softmax(logits / np.exp(log_t))[np.arange(len(labels)), labels]
        return -float(np.log(np.maximum(p, 1e-12)).mean())

    low, high, part = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    while high - low > 1e-4:
        a, b = high - part * (high - low), low + part * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def learnable(doc_id: Column) -> Column:
    """True for documents that may be learned from."""
    return id_remainder(doc_id, 5) != 0


def fit(docs: DataFrame) -> Model:
    """A model from the learnable documents with a language and a text."""
    short_batches(docs.sparkSession)
    known = docs.select(F.col("doc_id").alias("doc_id"), F.col("lang").alias("lang"), F.col("text").alias("text"))
    known = known.filter(learnable(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    languages = sorted(row[0] for row in known.select("lang").distinct().collect())
    frequencies, n_docs = _document_frequencies(known.select("text"))
    idf = np.log((1 + n_docs) / (1 + frequencies)) + 1
    classes = max(len(languages), 1)

    # The sampled ids are at most SAMPLE, so they can be broadcast. Where documents
    # repeat an id, the bound holds for the documents.
    chosen = (
        known.select(F.col("doc_id").alias("_id")).distinct().withColumn("place", F.md5(F.col("_id").cast("string")))
        .orderBy("place")
        .limit(SAMPLE)
    )
    number = {language: i for i, language in enumerate(languages)}

    def vectors(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [tf_idf(text, idf) for text in frame["text"]]
            yield pd.DataFrame(
                {
                    "place": frame["place"],
                    "part": [-1 if int(p[:8], 16) % 5 == 0 else int(p[8:16], 16) % PARTS for p in frame["place"]],
                    "label": [number[lang] for lang in frame["lang"]],
                    "buckets": [b.astype(np.int32) for b, _ in found],
                    "tf_idf": [v for _, v in found],
                }
            )

    sample = settled(
        bounded(known.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")), SAMPLE, "_id")
        .select(F.md5(F.concat("place", F.md5(F.col("text").cast("binary")))).alias("place"), "lang", "text")
        .mapInPandas(vectors, "place string, part int, label int, buckets array<int>, tf_idf array<double>"),
        "language-sample",
    )
    if n_docs == 0:
        return Model([], idf, np.zeros((BUCKETS, 1)), np.zeros(1), 1.0)
    weights, bias = _train(sample, classes)

    def logits_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            z = [v @ weights[b] + bias for b, v in zip(frame["buckets"], frame["tf_idf"], strict=True)]
            yield pd.DataFrame({"label": frame["label"], "z": z})

    held = sample.filter("part < 0").mapInPandas(logits_of, "label int, z array<double>").toPandas()
    logits = np.stack(held["z"].to_numpy()) if len(held) else np.zeros((0, classes))
    return Model(languages, idf, weights, bias, best_temperature(logits, held["label"].to_numpy(dtype=int)))


def prediction_of(model: Model, spark):
    """The column function from a text to its language and the probability of it."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for texts in batches:
            found = []
            for text in texts:
                if not m.languages or text is None or not LETTER.search(text):
                    found.append((UNKNOWN, 0.0))
                    continue
                buckets, values = tf_idf(text, m.idf)
                p = _softmax((values @ m.weights[buckets] + m.bias) / m.temperature)
                found.append((m.languages[int(p.argmax())], float(p.max())))
            yield pd.DataFrame(found, columns=["lang", "score"])

    return predict


def languages(docs: DataFrame) -> DataFrame:
    """The language of every document, learned from those that have one.

    Returns one row per row of ``docs``: doc_id, held_out (it was not learned
    from), lang_pred (one of the learned languages) and score (its probability).
    The whole text counts. A text that is null or has no letter is ``und`` with
    score 0, and so is every text if there is nothing to learn from; equal texts
    get equal results; an empty table gives no rows. Other columns are ignored.
    """
    predict = prediction_of(fit(docs), docs.sparkSession)
    return docs.select(
        F.col("doc_id").alias("doc_id"), (~learnable(F.col("doc_id"))).alias("held_out"), predict(F.col("text")).alias("p")
    ).select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))
