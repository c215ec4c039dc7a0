"""Quality rules whose cutoffs carry a guarantee: few good documents of any stratum are rejected.

Rules measure a text (symbols, repeats, repeated lines, capitals, exclamations, long
words). A policy is one cutoff per rule; ``CUTOFFS`` lists policies from lenient to
strict, fixed before any label is seen. Every document has a level, the first policy
that rejects it. Labelled holdouts then choose a policy for each stratum:

* of the n good documents of a stratum, policy j falsely rejects k(j) of those whose
  level is at most j;
* the hypothesis "policy j rejects more than ``risk`` of the good documents" is
  tested exactly: its p-value is P(Binomial(n, risk) <= k(j)), which is the same
  as comparing the exact (Clopper-Pearson) upper bound with ``risk``;
* policies are tested from lenient to strict and testing stops at the first that
  is not proven, which needs no correction inside a stratum; across strata the
  error ``DELTA`` is divided by their number (Bonferroni).

With probability 1 - ``DELTA``, no stratum loses more than ``RISK`` of its good
documents. A stratum with too few labels to prove anything is not filtered beyond
the base rules. Only counts per stratum and level are gathered, so a stratum may
hold any part of the corpus; cutoffs are joined to the documents by stratum.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley.functions.hashing import digest_number, seeded_digest
from trolley.functions.skew import small_side
from trolley.llm.common import short_batches
from trolley.sources.storage import settled

LEAST_WORDS = 20
MOST_REPEATED = 30  # of 100 words
REPEAT_WINDOW = 8

RISK = 0.02
DELTA = 0.05
# One document in so many is kept out of calibration, to judge the result by.
AUDIT_SHARE = 5
AUDIT_SEED = 12

# Each rule as (part, whole); the policies' cutoffs are parts of 100 of the whole,
# from lenient to strict.
RULES = {
    "symbols": ("n_symbols", "n_words"),
    "repeats": ("n_repeat_words", "n_words"),
    "lines": ("n_dup_lines", "n_lines"),
    "capitals": ("n_capitals", "n_letters"),
    "marks": ("n_marks", "n_words"),
    "length": ("word_chars", "n_words"),
}
CUTOFFS = {
    "symbols": (200, 150, 100, 80, 60, 50, 40, 30, 20, 15, 10, 5),
    "repeats": (29, 28, 27, 26, 25, 24, 22, 20, 18, 16, 14, 12),
    "lines": (95, 90, 85, 80, 75, 70, 65, 60, 55, 50, 45, 40),
    "capitals": (95, 90, 85, 80, 75, 70, 65, 60, 50, 40, 30, 25),
    "marks": (200, 150, 100, 80, 60, 50, 45, 40, 35, 30, 25, 20),
    "length": (4000, 3000, 2500, 2000, 1800, 1600, 1500, 1400, 1300, 1200, 1100, 1000),
}
POLICIES = len(CUTOFFS["symbols"])

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_lines", "n_capitals", "n_letters", "n_marks")

# What a byte counts for: later bytes of a code point, white space, symbols,
# capitals, small letters, exclamation and question marks, all else.
_LATER, _WHITE, _SYMBOL, _CAPITAL, _SMALL, _MARK, _OTHER = range(7)
_kind = np.full(256, _OTHER, dtype=np.uint8)
_kind[0x80:0xC0] = _LATER
_kind[[0x20, *range(0x09, 0x0E)]] = _WHITE
_kind[list(b"#*$%&|<>")] = _SYMBOL
_kind[0x41:0x5B] = _CAPITAL
_kind[0x61:0x7B] = _SMALL
_kind[list(b"!?")] = _MARK


def repeated_words(words: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """Words inside windows of ``window`` words that the text holds twice or more, the first included.

    Windows are numbered by doubling: equal numbers of two halves make equal wholes,
    so nothing rests on a hash.
    """
    places = len(words) - window + 1
    if places < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    if len(numbers) == len(words):
        return 0
    span = 1
    while span < window:
        pairs = ids[:-span] * (ids.max() + 1) + ids[span:]
        _, ids = np.unique(pairs, return_inverse=True)
        span *= 2
    again = np.bincount(ids)[ids] > 1
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edges, np.flatnonzero(again), 1)
    np.add.at(edges, np.flatnonzero(again) + window, -1)
    return int((np.cumsum(edges) > 0).sum())


def measures(data: bytes) -> tuple[int, ...]:
    """The numbers ``BASE`` and ``MORE`` of one text. ASCII white space is all that ``bytes.split`` splits at."""
    words = data.split()
    kinds = np.bincount(_kind[np.frombuffer(data, dtype=np.uint8)], minlength=7).tolist()
    points = len(words) and sum(kinds) - kinds[_LATER] - kinds[_WHITE]
    lines = [line for line in data.split(b"\n") if line and not line.isspace()]
    return (
        len(words),
        points,
        kinds[_SYMBOL],
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        kinds[_CAPITAL],
        kinds[_CAPITAL] + kinds[_SMALL],
        kinds[_MARK],
    )


def _measured(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        yield pd.DataFrame([measures(data) for data in texts], columns=[*BASE, *MORE], dtype="int64")


def level() -> Column:
    """The first policy (from 1) that rejects a measured text; ``POLICIES`` + 1 if none does."""
    first = F.lit(POLICIES + 1)
    for rule in reversed(range(POLICIES)):
        rejects = F.lit(False)
        for name, (part, whole) in RULES.items():
            rejects = rejects | (100 * F.col(part) > CUTOFFS[name][rule] * F.col(whole))
        first = F.when(rejects, F.lit(rule + 1)).otherwise(first)
    return first


def base_failed() -> Column:
    """Whether a measured text fails the two fixed rules."""
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def measured(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """doc_id, stratum, the measures, base_failed, level and the digest of the text; one row per document."""
    short_batches(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    udf = F.pandas_udf(_measured, ", ".join(f"{c} long" for c in (*BASE, *MORE)))
    return (
        docs.select(
            F.col("doc_id").alias("doc_id"),
            F.coalesce(F.col(stratum).cast("string"), F.lit("und")).alias("stratum"),
            F.md5(text).alias("digest"),
            udf(text).alias("m"),
        )
        .select("doc_id", "stratum", "digest", "m.*")
        .select("*", base_failed().alias("base_failed"), level().alias("level"))
    )


def chance_of_at_most(k: int, n: int, p: float) -> float:
    """P(Binomial(n, p) <= k), from the logarithms of its terms."""
    if k >= n:
        return 1.0
    i = np.arange(1, k + 1, dtype=np.float64)
    terms = np.concatenate([[0.0], np.cumsum(np.log((n - i + 1) / i) + math.log(p / (1 - p)))]) + n * math.log1p(-p)
    top = terms.max()
    return float(min(1.0, math.exp(top) * np.exp(terms - top).sum()))


def audited(doc_id: Column, audit: int = AUDIT_SHARE) -> Column:
    """Whether a label is kept out of calibration: one in ``audit``, by a digest of the id."""
    return digest_number(seeded_digest(AUDIT_SEED, doc_id)) % audit == 0


def policies(
    rows: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA, audit: int = AUDIT_SHARE
) -> DataFrame:
    """(stratum, policy, n_good, n_rejected): the strictest proven policy of every stratum, 0 if there is none.

    ``rows`` are measured documents. Labels count where quality is 1 and the id is not
    ``audited``. Texts that are equal count once, as a test of chances
    needs separate cases; so do ids that are labelled twice, if all their labels
    are 1. The strata are those of all measured documents.
    """
    good = (
        labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("least"), F.max("quality").alias("most"))
        .filter("least = 1 AND most = 1")
        .filter(~audited(F.col("doc_id"), audit))
        .select("doc_id")
    )
    counted = (
        rows.filter(~F.col("base_failed"))
        .select("doc_id", "stratum", "digest", "level")
        .join(good, "doc_id")
        .select("stratum", "digest", "level")
        .distinct()
        .groupBy("stratum")
        # One number per policy and stratum, whatever the number of labels.
        .agg(
            F.count(F.lit(1)).alias("n_good"),
            F.array(*[F.count_if(F.col("level") <= j) for j in range(1, POLICIES + 1)]).alias("rejected"),
        )
    )
    strata = settled(rows.select("stratum").distinct(), "quality-strata")
    share = delta / max(1, strata.count())

    @F.pandas_udf("int")
    def strictest(n_good: pd.Series, rejected: pd.Series) -> pd.Series:
        chosen = []
        for n, counts in zip(n_good, rejected):
            policy = 0
            for k in counts:
                # A count at or above its expectation proves nothing.
                if k >= risk * n or chance_of_at_most(int(k), int(n), risk) > share:
                    break
                policy += 1
            chosen.append(policy)
        return pd.Series(chosen, dtype="int32")

    proven = counted.withColumn("policy", strictest("n_good", "rejected")).withColumn(
        "n_rejected", F.when(F.col("policy") > 0, F.try_element_at("rejected", F.col("policy"))).otherwise(F.lit(0))
    )
    return strata.join(proven, "stratum", "left").select(
        "stratum",
        F.coalesce("policy", F.lit(0)).alias("policy"),
        F.coalesce("n_good", F.lit(0)).cast("long").alias("n_good"),
        F.coalesce("n_rejected", F.lit(0)).cast("long").alias("n_rejected"),
    )


def quality(docs: DataFrame, labels: DataFrame, stratum: str = "lang", **options) -> DataFrame:
    """The measures of every document and whether it stays.

    Returns one row per row of ``docs``: doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, kept, stratum, level (the first policy
    that rejects the text) and policy (the one its stratum uses). A document stays
    unless it fails the base rules or its level is within its stratum's policy. A
    null text counts as empty and fails; a null stratum is ``und``; equal rows fare
    alike; texts of any length are read whole; without labels only the base rules
    reject; an empty table gives no rows. Other columns are ignored.
    """
    rows = settled(measured(docs, stratum), "quality-measures")
    chosen = small_side(policies(rows, labels, **options).select("stratum", "policy"), "quality-policies")
    return rows.join(chosen, "stratum", "left").select(
        "doc_id",
        *BASE,
        "base_failed",
        (~F.col("base_failed") & (F.col("level") > F.coalesce("policy", F.lit(0)))).alias("kept"),
        "stratum",
        "level",
        "policy",
    )
