"""Toxicity by compression distance.

Two zstandard dictionaries are made from labelled text. Both begin with the same
content, learned by zstandard's own trainer from ordinary text; after it, nearest
to the window and so cheapest to refer to, one holds passages typical of toxic
text and the other as many bytes typical of ordinary text. A window that compresses
shorter with the toxic dictionary uses toxic wording; all else in the two results
is equal, so the difference is not blurred by chance. What a document saves is
turned into a probability by a logistic fit on labelled documents that the
dictionaries have not seen, and the same documents give the score from which on
a given share of ordinary ones is rejected.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import bounded, id_remainder, release_memory, short_batches
from trolley.sources.storage import settled

WINDOW = 256
OVERLAP = 16
PIECE = 2048
# Bounds of the labelled sample that is fitted on: documents and pieces of their
# text for the dictionaries (per class), documents for the calibration.
FIT_DOCUMENTS = 2000
FIT_PIECES = 4000
CALIBRATION_DOCUMENTS = 20_000
GRAM = 6
BASE_BYTES = 8192
SIDE_BYTES = 6144
LEVEL = 9
REJECT_AT = 0.7
# Passages in a smaller part of the toxic pieces cost more than they tell: every
# byte of the dictionary moves the others away.
LEAST_SHARE = 0.02
# Of the ordinary documents of the calibration, so many are rejected by ``without_toxic``.
FALSE_ALARMS = 0.005
CLEAR_SAVING = 4


@dataclass
class Dictionaries:
    """Contents of the two dictionaries, equally long."""

    toxic: bytes
    ordinary: bytes


@dataclass
class Model:
    dictionaries: Dictionaries | None
    weights: list[float]  # of the features; the constant comes last
    cutoff: float = REJECT_AT  # the score that ``FALSE_ALARMS`` of ordinary documents reach


def windows_of(data: bytes, size: int, overlap: int = 0) -> list[bytes]:
    """The whole of ``data`` in windows; neighbours share ``overlap`` bytes."""
    return [data[i : i + size] for i in range(0, max(len(data) - overlap, 1), size - overlap)]


def _gram_counts(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Byte n-grams of the pieces as numbers, and in how many pieces each occurs."""
    seen = []
    for piece in pieces:
        if len(piece) < GRAM:
            continue
        codes = np.zeros(len(piece) - GRAM + 1, dtype=np.uint64)
        data = np.frombuffer(piece, dtype=np.uint8)
        for k in range(GRAM):
            codes = (codes << np.uint64(8)) | data[k : k + len(codes)]
        seen.append(np.unique(codes))
    if not seen:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    return np.unique(np.concatenate(seen), return_counts=True)


def typical_passages(own: list[bytes], other: list[bytes], size: int, ratio: float = 20.0) -> bytes:
    """Up to ``size`` bytes of passages that are far more frequent in ``own`` than in ``other``.

    N-grams that occur ``ratio`` times as often are joined to passages where they
    overlap. The most frequent come last, where zstandard refers to them most cheaply.
    """
    grams, counts = _gram_counts(own)
    other_grams, other_counts = _gram_counts(other)
    enough = counts >= max(3, LEAST_SHARE * len(own))
    grams, counts = grams[enough], counts[enough]
    at = np.searchsorted(other_grams, grams)
    there = np.zeros(len(grams))
    if len(other_grams):
        at = np.minimum(at, len(other_grams) - 1)
        there = np.where(other_grams[at] == grams, other_counts[at], 0)
    odds = (counts / max(len(own), 1)) / ((there + 0.5) / max(len(other), 1))
    chosen = {
        int(g).to_bytes(GRAM, "big"): int(c) for g, c, o in zip(grams, counts, odds, strict=True) if o >= ratio
    }
    used: set[bytes] = set()
    passages, length = [], 0
    for gram, count in sorted(chosen.items(), key=lambda x: (-x[1], x[0])):
        if gram in used:
            continue
        passage = gram
        used.add(gram)
        for before in (False, True):
            while True:
                ends = [
                    bytes([b]) + passage[: GRAM - 1] if before else passage[1 - GRAM :] + bytes([b]) for b in range(256)
                ]
                ends = [g for g in ends if chosen.get(g, 0) >= 0.3 * count and g not in used]
                if not ends:
                    break
                best = max(ends, key=lambda g: (chosen[g], g))
                used.add(best)
                passage = best[:1] + passage if before else passage + best[-1:]
        if length + len(passage) > size:
            continue  # a shorter one may fit
        passages.append(passage)
        length += len(passage)
    return b"".join(reversed(passages))


def train_dictionaries(toxic: list[bytes], ordinary: list[bytes]) -> Dictionaries | None:
    """Dictionaries from pieces of toxic and of ordinary text; None if they cannot be told apart."""
    special = typical_passages(toxic, ordinary, SIDE_BYTES)
    if not special:
        return None
    usual = typical_passages(ordinary, toxic, len(special))
    # What is missing is filled with bytes that no text holds, so that all offsets agree.
    usual = bytes(random.Random(0).choices(range(0xF8, 0x100), k=len(special) - len(usual))) + usual
    samples = [w for piece in ordinary for w in windows_of(piece, WINDOW)]
    try:
        base = zstandard.train_dictionary(BASE_BYTES, samples, level=3).as_bytes()
    except zstandard.ZstdError:  # too few samples for the trainer
        base = b"".join(samples)[-BASE_BYTES:]
    return Dictionaries(base + special, base + usual)


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    """Compress windows with ``content`` as raw dictionary, without headers; matches have 6 bytes at least."""
    options = zstandard.ZstdCompressionParameters.from_level(
        LEVEL,
        min_match=GRAM,
        format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        write_content_size=False,
        write_dict_id=False,
        write_checksum=False,
    )
    raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    raw.precompute_compress(compression_params=options)
    return zstandard.ZstdCompressor(dict_data=raw, compression_params=options)


MEASURES = ("saved", "most", "some", "clear", "length")


def savings(dictionaries: Dictionaries | None):
    """A function of texts: the measures of each.

    They are the bytes saved in all windows, the most in one, the windows that save
    some and much, and the length.
    """
    if dictionaries is not None:
        toxic, ordinary = compressor(dictionaries.toxic).compress, compressor(dictionaries.ordinary).compress

    def measure(texts) -> list[tuple[int, int, int, int, int]]:
        rows = []
        for text in texts:
            data = (text or "").encode("utf-8", "surrogatepass")
            gains = [0]
            if dictionaries is not None and data:
                gains = [len(ordinary(w)) - len(toxic(w)) for w in windows_of(data, WINDOW, OVERLAP)]
            some, clear = sum(g >= CLEAR_SAVING // 2 for g in gains), sum(g >= CLEAR_SAVING for g in gains)
            rows.append((sum(g for g in gains if g > 0), max(gains), some, clear, len(data)))
        return rows

    return measure


def _features(rows) -> np.ndarray:
    saved, most, some, clear, length = np.asarray(rows, dtype=float).reshape(-1, len(MEASURES)).T
    rate = 1000.0 * saved / (length + WINDOW)
    return np.stack(
        [np.log1p(saved), np.minimum(rate, 40.0), np.clip(most, 0, 12), np.log1p(some), np.log1p(clear), np.log1p(length)],
        axis=1,
    )


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 50) -> list[float]:
    """Weights and constant of a ridge-penalised logistic regression, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-3
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hessian, x.T @ (p - y) + ridge * w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return [float(v) for v in w]


def _pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        cut = [windows_of((t or "").encode("utf-8", "surrogatepass"), PIECE) for t in frame["text"]]
        yield pd.DataFrame(
            {
                "toxic": np.repeat(frame["toxic"].to_numpy(), [len(c) for c in cut]),
                "piece": [p for c in cut for p in c],
            }
        )


def learnable(doc_id: Column) -> Column:
    """True for documents whose labels may be learned from."""
    return id_remainder(doc_id, 3) != 1


def _for_dictionaries(doc_id: Column) -> Column:
    """Two thirds of the documents fit the dictionaries, the others the calibration."""
    return id_remainder(F.concat(F.lit("fit-"), doc_id.cast("string")), 3) != 0


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the learnable labels.

    Of labels that repeat a document, the highest counts; null labels and labels
    without a document are passed over. Documents are sampled by a digest of
    their id, so the sampled ids, at most ``2 * FIT_DOCUMENTS +
    CALIBRATION_DOCUMENTS`` of them, can be broadcast. Where documents repeat an
    id, the bound holds for the documents.
    """
    short_batches(docs.sparkSession)
    known = labels.select(F.col("doc_id").alias("_label_id"), F.col("toxic").cast("int").alias("toxic"))
    known = settled(
        known.filter("toxic IN (0, 1) AND _label_id IS NOT NULL")
        .filter(learnable(F.col("_label_id")))
        .groupBy("_label_id")
        .agg(F.max("toxic").alias("toxic"))
        .withColumn("_order", F.md5(F.col("_label_id").cast("string"))),
        "toxic-labels",
    )
    texts = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))

    def sampled(part: DataFrame, bound: int) -> DataFrame:
        chosen = part.orderBy("_order", "_label_id").limit(bound).select("_label_id", "toxic")
        found = texts.join(F.broadcast(chosen), F.col("_label_id") == F.col("doc_id"))
        return bounded(found, bound, "_label_id").select("toxic", "text")

    in_fit = _for_dictionaries(F.col("_label_id"))
    sample = {}
    for kind in (0, 1):
        pieces = sampled(known.filter(in_fit & (F.col("toxic") == kind)), FIT_DOCUMENTS).mapInPandas(
            _pieces, "toxic int, piece binary"
        )
        # Copies say nothing more.
        chosen = pieces.select("piece").distinct().orderBy(F.sha2("piece", 256)).limit(FIT_PIECES)
        sample[kind] = [bytes(row[0]) for row in chosen.collect()]
    dictionaries = train_dictionaries(sample[1], sample[0])

    def measured(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        measure = savings(dictionaries)
        for frame in frames:
            yield pd.DataFrame(measure(frame["text"]), columns=list(MEASURES)).assign(toxic=frame["toxic"].to_numpy())

    kinds = ", ".join(f"{name} long" for name in MEASURES)
    seen = (
        sampled(known.filter(~in_fit), CALIBRATION_DOCUMENTS)
        .mapInPandas(measured, f"{kinds}, toxic int")
        .toPandas()
        .sort_values(["toxic", *MEASURES])
    )
    y = seen["toxic"].to_numpy(dtype=float)
    if len(y) == 0 or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 10.0)
        return Model(dictionaries, [0.0] * 6 + [float(np.log(share / (1 - share)))])
    features = _features(seen[list(MEASURES)].to_numpy())
    weights = fit_logistic(features, y)
    ordinary = np.sort(_scores(features, weights)[y == 0])
    # The least score that no more than the given share of ordinary documents reach.
    reached = ordinary[-int(FALSE_ALARMS * len(ordinary)) - 1]
    return Model(dictionaries, weights, float(np.nextafter(reached, 1)))


def _scores(features: np.ndarray, weights: list[float]) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(features @ np.array(weights[:-1]) + weights[-1], -30, 30)))


def score_of(model: Model):
    """The column function that gives texts their scores."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        measure = savings(model.dictionaries)
        for texts in batches:
            yield pd.Series(_scores(_features(measure(texts)), model.weights))
        release_memory()

    return score


def toxicity(docs: DataFrame, labels: DataFrame, reject_at: float = REJECT_AT) -> DataFrame:
    """The toxicity of every document, learned from the labels of some.

    Returns one row per row of ``docs``: doc_id, held_out (its label was not
    learned from), score (0 to 1) and predicted (1 from ``reject_at`` on). Every
    window of the whole text counts. A null text counts as empty and an empty
    one gets a score like any other; equal texts get equal scores; without
    labels of both kinds every score is one small constant; an empty table gives
    no rows. Other columns are ignored.
    """
    score = score_of(fit(docs, labels))
    return docs.select(
        F.col("doc_id").alias("doc_id"),
        (~learnable(F.col("doc_id"))).alias("held_out"),
        score(F.col("text")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= reject_at).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows whose score reaches the model's calibrated cutoff, all columns unchanged."""
    model = fit(docs, labels)
    return docs.filter(score_of(model)(F.col("text")) < model.cutoff)
