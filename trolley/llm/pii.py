"""Personal data: fixed patterns as seeds, and bootstrapped contextual extraction.

Four kinds of identifiers are found by their form. They, and long hexadecimal words
as secrets have, are the seeds of a graph between lexical patterns (the one or two
words before an identifier) and instances (words with a digit or an @). Patterns that
were seen before several different seeds, and that rarely stand before anything else,
are scored by the scores of their instances, instances by those of their patterns, in
a few rounds. Instances that the surviving patterns point to are further identifiers;
a hexadecimal word by itself is none.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import WordCodes, key_filter, mixed, passing, short_batches
from trolley.sources.storage import settled

KINDS = ("email", "ip", "card", "phone")
LEARNED = "context"
MIN_SEEDS = 5
MIN_INDICATION = 0.5
ACCEPT = 0.6
ROUNDS = 3

LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Possessive forms of the four-part and digit patterns: no text makes them go back and forth.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
MARK = re.compile(r"[0-9@]")
SECRET = re.compile(r"[0-9A-Fa-f]{32,64}")
EDGES = "\"'<>()[]{},;:!?*#$%&.|=`"
TO_ZERO = str.maketrans("123456789", "000000000")


def emails(text: str) -> Iterator[tuple[int, int]]:
    at, done = text.find("@"), 0
    while at >= 0:
        domain = DOMAIN.match(text, at + 1)
        start = at
        if domain:
            while start > done and text[start - 1] in LOCAL_PART:
                start -= 1
        if domain and start < at:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of all identifiers of fixed form, in this order."""
    spans = [(start, 0, end) for start, end in emails(text)]
    for match in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in match[0].split(".")):
            spans.append((match.start(), 1, match.end()))
    for match in CARD.finditer(text):
        digits = match[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            spans.append((match.start(), 2, match.end()))
    for match in PHONE.finditer(text):
        if 10 <= sum("0" <= c <= "9" for c in match[0]) <= 15:
            spans.append((match.start(), 3, match.end()))
    return sorted(spans)


def _plain(word: str) -> str:
    """Case and digits do not count in a pattern."""
    return word.lower().translate(TO_ZERO)


def patterns_of(words: list[str], codes: WordCodes) -> tuple[np.ndarray, np.ndarray]:
    """The patterns that stand before the word after each of ``words``: one of this word, one of it and the last."""
    own = np.fromiter(map(codes.__getitem__, words), dtype=np.uint64, count=len(words))
    before = np.append(np.uint64(codes[""]), own[:-1])
    return mixed(own).view(np.int64), mixed(mixed(before) + own).view(np.int64)


def occurrences(
    text: str, spans: list[tuple[int, int, int]], codes: WordCodes
) -> list[tuple[int, int, int, int, int, bool, bool]]:
    """(start, end, pattern of one word, pattern of two, instance, is a seed, is of fixed form) of words with a digit or @.

    The word itself goes without the marks around it. A seed counts where it starts.
    """
    if not MARK.search(text):
        return []
    found, words, at, next_span = [], text.split(), 0, 0
    ones, twos = patterns_of(words, codes)
    for i, word in enumerate(words):
        at = text.index(word, at)
        if MARK.search(word):
            inner = word.strip(EDGES)
            start = at + word.index(inner) if inner else at
            end = start + len(inner)
            while next_span < len(spans) and spans[next_span][2] <= start:
                next_span += 1
            span = spans[next_span] if next_span < len(spans) and spans[next_span][0] < at + len(word) else None
            inside = span is not None and span[0] < at
            if inner and i > 0 and not inside:
                identifier = inner if span is None else text[span[0] : span[2]]
                instance = xxhash.xxh64_intdigest(identifier.encode("utf-8", "surrogatepass")) - (1 << 63)
                fixed = span is not None
                seed = fixed or SECRET.fullmatch(inner) is not None
                found.append((start, end, int(ones[i - 1]), int(twos[i - 1]), instance, seed, fixed))
        at += len(word)
    return found


SCAN = (
    "counts array<long>, base string, starts array<int>, ends array<int>, ones array<long>, twos array<long>, "
    "instances array<long>, seeds array<boolean>, fixed array<boolean>, text_key string"
)


def _scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    codes = WordCodes(_plain)
    for texts in batches:
        rows = []
        for text in texts:
            text = text or ""
            spans = base_spans(text)
            kinds = Counter(kind for _, kind, _ in spans)
            found = occurrences(text, spans, codes)
            rows.append(
                (
                    [kinds[k] for k in range(len(KINDS))],
                    ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans),
                    *([f[k] for f in found] for k in range(7)),
                    hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest() if found else "",
                )
            )
        names = ["counts", "base", "starts", "ends", "ones", "twos", "instances", "seeds", "fixed", "text_key"]
        yield pd.DataFrame(rows, columns=names)


def _context_counts(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """How often each of ``patterns`` stands before any word of the corpus.

    A filter of fixed size picks the contexts to count; those it lets through
    by chance fall away in the join that follows.
    """
    shared = key_filter(patterns, "pattern")

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes = WordCodes(_plain)
        for frame in frames:
            counts: Counter[int] = Counter()
            for text in frame["text"]:
                words = (text or "").split()
                if len(words) > 1:
                    found = np.concatenate(patterns_of(words[:-1], codes))
                    counts.update(found[passing(shared.value, found)].tolist())
            yield pd.DataFrame({"pattern": list(counts.keys()), "n": list(counts.values())}, dtype="int64")

    counted = docs.select(F.col("text").alias("text")).mapInPandas(count, "pattern long, n long")
    return counted.groupBy(F.col("pattern").alias("context")).agg(F.sum("n").alias("total"))


def learned_instances(
    docs: DataFrame, found: DataFrame, min_seeds: int = MIN_SEEDS, rounds: int = ROUNDS
) -> DataFrame | None:
    """Occurrences that trusted patterns point to; None if no pattern can be trusted.

    ``found`` has one row per occurrence: one, two, instance, seed, fixed (whether it is
    known by its form, and so nothing to learn) and whatever identifies it.
    """
    edges = settled(
        found.select(F.explode(F.array("one", "two")).alias("pattern"), "instance", "seed")
        .groupBy("pattern", "instance")
        .agg(F.max("seed").alias("seed"), F.count(F.lit(1)).alias("n")),
        "pattern-edges",
    )
    supported = settled(
        edges.groupBy("pattern").agg(F.count_if("seed").alias("seeds"), F.sum("n").alias("hits")).filter(F.col("seeds") >= min_seeds),
        "supported-patterns",
    )
    if supported.isEmpty():
        return None
    totals = _context_counts(docs, supported)
    telling = settled(
        supported.join(totals, supported["pattern"] == totals["context"])
        .select(F.col("pattern").alias("telling"), (F.col("hits") / F.greatest("hits", "total")).alias("indication"))
        .filter(F.col("indication") >= MIN_INDICATION),
        "telling-patterns",
    )
    if telling.isEmpty():
        return None
    graph = settled(
        edges.join(telling, edges["pattern"] == telling["telling"]).select("pattern", "indication", "instance", "seed"), "pattern-graph"
    )
    scores = graph.groupBy(F.col("instance").alias("of")).agg(F.max(F.col("seed").cast("double")).alias("score"))
    for _ in range(rounds):
        scores = settled(scores, "instance-scores")
        trusted = settled(
            graph.join(scores, graph["instance"] == scores["of"])
            .groupBy(F.col("pattern").alias("trusted"))
            .agg((F.max("indication") * F.sum("score") / (F.count(F.lit(1)) + 1)).alias("trust"))
            .filter(F.col("trust") >= ACCEPT),
            "trusted-patterns",
        )
        doubt = F.sum(F.log1p(-F.least("trust", F.lit(0.999999))))
        scores = (
            graph.join(trusted, graph["pattern"] == trusted["trusted"], "left")
            .groupBy(F.col("instance").alias("of"))
            .agg(
                F.when(F.max("seed"), F.lit(1.0)).otherwise(1.0 - F.exp(F.coalesce(doubt, F.lit(0.0)))).alias("score")
            )
        )
    good = settled(scores.filter(F.col("score") >= ACCEPT).select("of"), "trusted-instances")
    pointed = found.filter("NOT fixed").withColumn("pattern", F.explode(F.array("one", "two")))
    return (
        pointed.join(trusted.select("trusted"), F.col("pattern") == F.col("trusted"), "left_semi")
        .join(good, F.col("instance") == F.col("of"), "left_semi")
        .drop("pattern")
        .distinct()
    )


def personal_data(docs: DataFrame, min_seeds: int = MIN_SEEDS, rounds: int = ROUNDS) -> DataFrame:
    """Identifiers in every document.

    Returns one row per row of ``docs``: doc_id, counts (of the kinds of fixed
    form, in the order of ``KINDS``), base and spans. These list ``kind:start:end``
    by start, then kind, joined by commas, in code points with the end excluded:
    ``base`` those of fixed form, ``spans`` also the learned ones, of kind
    ``context``. A null text counts as empty and has none; equal texts have equal
    spans; an empty table gives no rows. Other columns are ignored. The whole
    text and all documents count.
    """
    short_batches(docs.sparkSession)
    scan = F.pandas_udf(_scan, SCAN)
    scanned = settled(
        docs.select(F.col("doc_id").alias("doc_id"), scan(F.col("text")).alias("s")).select("doc_id", "s.*"), "pii-scan"
    )
    found = (
        scanned.filter("text_key <> ''")
        .select("text_key", F.explode(F.arrays_zip("starts", "ends", "ones", "twos", "instances", "seeds", "fixed")).alias("o"))
        .select(
            "text_key",
            F.col("o.starts").alias("start"),
            F.col("o.ends").alias("end"),
            F.col("o.ones").alias("one"),
            F.col("o.twos").alias("two"),
            F.col("o.instances").alias("instance"),
            F.col("o.seeds").alias("seed"),
            F.col("o.fixed").alias("fixed"),
        )
    )
    learned = learned_instances(docs, found, min_seeds, rounds)
    if learned is None:
        return scanned.select("doc_id", "counts", "base", F.col("base").alias("spans"))
    added = settled(
        learned.groupBy(F.col("text_key").alias("key"))
        .agg(F.collect_set(F.struct("start", F.lit(len(KINDS)).alias("kind"), "end")).alias("added")),
        "pii-learned",
    )
    kind_names = F.array(*[F.lit(k) for k in (*KINDS, LEARNED)])
    parts = F.transform(F.filter(F.split("base", ","), lambda s: s != ""), lambda s: F.split(s, ":"))
    base = F.transform(
        parts,
        lambda p: F.struct(
            p[1].cast("int").alias("start"),
            (F.array_position(kind_names, p[0]) - 1).cast("int").alias("kind"),
            p[2].cast("int").alias("end"),
        ),
    )
    every = F.array_sort(F.concat(base, F.coalesce("added", F.array().cast("array<struct<start:int,kind:int,end:int>>"))))
    listed = F.concat_ws(",", F.transform(every, lambda s: F.concat_ws(":", F.element_at(kind_names, s["kind"] + 1), s["start"], s["end"])))
    return scanned.join(added, scanned["text_key"] == added["key"], "left").select(
        "doc_id", "counts", "base", F.when(F.col("added").isNull(), F.col("base")).otherwise(listed).alias("spans")
    )
