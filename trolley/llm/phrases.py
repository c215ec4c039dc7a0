"""Collocations by partitioned mining (SON): local mining, union, exact global counts.

A phrase of 2 or 3 words that occurs ``SUPPORT`` times in a language occurs
``ceil(SUPPORT / SHARDS)`` times in one of ``SHARDS`` shards at least, however the
corpus is dealt out to them:

1. words are counted per language; only words that reach the support can be part
   of a phrase that does;
2. every shard is mined completely at the lowered local support. A shard is a fixed
   share of the input partitions. Tasks send hashes of the phrases they met, sorted and
   packed by range, and one task mines one range of a shard, so no task holds a shard;
3. the locally frequent phrases of all shards are united, and all of them counted
   exactly over the whole corpus.

The two sets are passed to the tasks as filters of fixed size (``key_filter``). A
filter lets through all that it should and some more, which the exact counts settle.
Tasks number the words they meet and count phrases as numbers, a bounded window of
tokens at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trolley.llm.common import key_filter, mixed, passing, release_memory, short_batches
from trolley.sources.storage import parts_for, settled

SUPPORT = 10
SHARDS = 5
MOST_WORDS = 3
SCALE = 1_000_000
INSIDE = 50  # of 100: a phrase this often inside one longer phrase is dropped
REPORTED = 2000
SALTS = 64

WINDOW_TOKENS = 1_200_000
MOST_NUMBERS = 1 << 21  # the numbers of three words fit in 63 bits
PART_BYTES = 1 << 19
# Bytes of input behind one range of all shards; the phrases of a range take some twice that.
RANGE_BYTES = 8 << 20
_BITS = np.int64(21)

_breaks = b".,;:!?\n\x0b\x0c\r"
_word_end = re.compile(rb"[ \t.,;:!?\n\x0b\x0c\r]")
_plain = bytes(0x2E if i in _breaks else i + 32 if 0x41 <= i <= 0x5A else i for i in range(256))


def words_and_breaks(text: bytes) -> list[bytes]:
    """Lower-case words in order, with ``b"."`` between the pieces of the text."""
    return text.translate(_plain).replace(b".", b" . ").split()


class _Window:
    """A stretch of the corpus: words by number, and the tokens of each language; 0 is a break."""

    def __init__(self):
        self.numbers: dict[bytes, int] = {b".": 0}
        self.tokens: dict[str, list[int]] = {}
        self.carried: dict[str, int] = {}
        self.size = 0

    def add(self, lang: str, words: list[bytes]) -> None:
        numbers = self.numbers
        tokens = self.tokens.setdefault(lang, [])
        tokens += [numbers.setdefault(w, len(numbers)) for w in words]
        self.size += len(words)

    def carry(self, lang: str, words: list[bytes]) -> None:
        """Begin with the last words of the window before, which it has counted."""
        self.add(lang, words)
        self.carried[lang] = len(words)

    def full(self, coming: int) -> bool:
        return self.size >= WINDOW_TOKENS or self.size and len(self.numbers) + coming > MOST_NUMBERS

    def codes(self) -> np.ndarray:
        """A 64-bit hash of every word, by number."""
        return np.array([xxhash.xxh64_intdigest(w) for w in self.numbers], dtype=np.uint64)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[_Window]:
    """The texts of a task in windows. A text that does not fit goes on in the next window."""
    window = _Window()
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            last: list[bytes] = []
            for part in _parts(text):
                words = words_and_breaks(part)
                if window.full(len(words)):
                    yield window
                    window = _Window()
                    window.carry(lang, last)
                window.add(lang, words)
                last = (last + words[1 - MOST_WORDS :])[1 - MOST_WORDS :]
            window.add(lang, [b"."])
    yield window
    release_memory()


def _parts(text: bytes) -> Iterator[bytes]:
    """``text`` in parts of about ``PART_BYTES`` that end where a word does."""
    start = 0
    while len(text) - start > PART_BYTES:
        end = _word_end.search(text, start + PART_BYTES)
        if end is None:
            break
        yield text[start : end.start()]
        start = end.start()
    yield text[start:]


def _lang_code(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass")) | 1)


def _phrase_codes(word_codes: list[np.ndarray], lang: np.uint64) -> np.ndarray:
    """One 64-bit code per phrase from the codes of its words and language."""
    code = np.full(len(word_codes[0]), lang, dtype=np.uint64)
    for words in word_codes:
        code = mixed(code * np.uint64(0x9E3779B97F4A7C15) + words)
    return code


def _counted(tokens: np.ndarray, allowed: np.ndarray, n: int, carried: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct phrases of ``n`` allowed words inside pieces, as word numbers, and their counts.

    Phrases that end among the first ``carried`` tokens were counted in the window before.
    """
    if len(tokens) < n:
        return [np.empty(0, dtype=np.int64)] * n, np.empty(0, dtype=np.int64)
    ok = allowed[tokens]
    whole, key = ok[: len(tokens) - n + 1].copy(), tokens[: len(tokens) - n + 1].copy()
    for i in range(1, n):
        whole &= ok[i : len(tokens) - n + 1 + i]
        key = (key << _BITS) | tokens[i : len(tokens) - n + 1 + i]
    whole[: max(0, carried - n + 1)] = False
    keys, counts = np.unique(key[whole], return_counts=True)
    last = (np.int64(1) << _BITS) - 1
    return [(keys >> (_BITS * np.int64(n - 1 - i))) & last for i in range(n)], counts


def _allowed(lang: str, frequent: Broadcast, codes: np.ndarray) -> np.ndarray:
    """Which word numbers may be part of a phrase; breaks never."""
    allowed = passing(frequent.value, _phrase_codes([codes], _lang_code(lang)).view(np.int64))
    allowed[0] = False
    return allowed


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for window in _windows(batches):
        words, codes = list(window.numbers), window.codes()
        for lang, tokens in window.tokens.items():
            fresh = np.array(tokens[window.carried.get(lang, 0) :], dtype=np.int64)
            counts = np.bincount(fresh, minlength=len(words))
            counts[0] = 0
            here = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(here), pa.string()),
                    pa.array([words[i] for i in here], pa.binary()),
                    pa.array(_phrase_codes([codes[here]], _lang_code(lang)).view(np.int64)),
                    pa.array(counts[here], pa.int64()),
                ],
                ["lang", "phrase", "code", "f"],
            )


def _local_codes(frequent: Broadcast, shards: int, ranges: int, least: int):
    """The phrases of each window as sorted codes, cut into ``ranges`` ranges, each code as often as it counts, up to ``least``."""
    edges = np.array([(i << 64) // ranges for i in range(1, ranges)], dtype=np.uint64)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() % shards
        for window in _windows(batches):
            codes, found = window.codes(), [np.zeros(0, dtype=np.uint64)]
            for lang, tokens in window.tokens.items():
                allowed, tokens = _allowed(lang, frequent, codes), np.array(tokens, dtype=np.int64)
                for n in range(2, MOST_WORDS + 1):
                    words, counts = _counted(tokens, allowed, n, window.carried.get(lang, 0))
                    found.append(np.repeat(_phrase_codes([codes[w] for w in words], _lang_code(lang)), np.minimum(counts, least)))
            every = np.sort(np.concatenate(found))
            cuts = [0, *np.searchsorted(every, edges).tolist(), len(every)]
            some = [i for i in range(ranges) if cuts[i] < cuts[i + 1]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(some), shard, dtype=np.int32)),
                    pa.array(np.array(some, dtype=np.int32)),
                    pa.array([every[cuts[i] : cuts[i + 1]].tobytes() for i in some], pa.binary()),
                ],
                ["shard", "range", "codes"],
            )

    return send


def _locally_frequent(least: int):
    def mine(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(c, dtype=np.uint64) for c in table["codes"].to_pylist()]
        codes, counts = np.unique(np.concatenate(parts), return_counts=True)
        return pa.table({"code": codes[counts >= least].view(np.int64)})

    return mine


def _global_counts(frequent: Broadcast, candidates: Broadcast):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for window in _windows(batches):
            codes, names = window.codes(), list(window.numbers)
            for lang, tokens in window.tokens.items():
                allowed, tokens = _allowed(lang, frequent, codes), np.array(tokens, dtype=np.int64)
                for n in range(2, MOST_WORDS + 1):
                    words, counts = _counted(tokens, allowed, n, window.carried.get(lang, 0))
                    code = _phrase_codes([codes[w] for w in words], _lang_code(lang)).view(np.int64)
                    kept = passing(candidates.value, code)
                    numbers = np.stack([w[kept] for w in words], axis=1).tolist()
                    phrases = [b" ".join([names[i] for i in phrase]) for phrase in numbers]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * len(phrases), pa.string()),
                            pa.array(phrases, pa.binary()),
                            pa.array(counts[kept], pa.int64()),
                        ],
                        ["lang", "phrase", "f"],
                    )

    return count


def frequent_phrases(docs: DataFrame, support: int = SUPPORT, shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f) of all words, and of all phrases of 2 to 3 words with f >= ``support``, counted exactly."""
    spark = docs.sparkSession
    short_batches(spark)
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
    )
    words = settled(
        texts.mapInArrow(_word_counts, "lang string, phrase binary, code long, f long")
        .groupBy("lang", F.col("phrase").cast("string").alias("phrase"))
        .agg(F.first("code").alias("code"), F.sum("f").alias("f")),
        "phrase-words",
    )
    frequent = key_filter(words.filter(F.col("f") >= support), "code")
    least = -(-support // shards)
    # A task that mines holds one range of one shard.
    ranges = max(2, parts_for(docs, RANGE_BYTES) // shards)
    local = (
        texts.mapInArrow(_local_codes(frequent, shards, ranges, least), "shard int, range int, codes binary")
        .groupBy("shard", "range")
        .applyInArrow(_locally_frequent(least), "code long")
    )
    candidates = key_filter(local, "code")
    counted = settled(
        texts.mapInArrow(_global_counts(frequent, candidates), "lang string, phrase binary, f long")
        .groupBy("lang", F.col("phrase").cast("string").alias("phrase"))
        .agg(F.sum("f").alias("f"))
        .filter(F.col("f") >= support),
        "phrase-counts",
    )
    return words.select("lang", "phrase", "f"), counted


def _wide(column: str) -> Column:
    return F.col(column).cast("decimal(18,0)")


def collocations(docs: DataFrame, support: int = SUPPORT, reported: int = REPORTED, shards: int = SHARDS) -> DataFrame:
    """The best collocations of every language.

    Returns lang, rank (from 1), phrase, a, l, r, n, score: of every language the
    first ``reported`` phrases by score, then a, descending, then phrase in byte order. A
    null text counts as empty, a null language is ``und``, repeated rows count each,
    texts of any length are read whole, and an empty table, or one where no phrase
    reaches the support, gives no rows. Other columns are ignored. Counts may have 16
    digits; products of them are decimals.
    """
    words, counted = frequent_phrases(docs, support, shards)
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))
    parts = F.split("phrase", " ")
    split = counted.select("lang", "phrase", F.col("f").alias("a"), parts.alias("parts"))

    # Phrases that mostly stand inside one longer phrase.
    longest = (
        split.filter(F.size("parts") == MOST_WORDS)
        .select("lang", F.col("a").alias("longer"), F.explode(F.array(_joined(0, 2), _joined(1, 2))).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("longer").alias("longer"))
    )
    left = split.join(longest, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < INSIDE * F.col("a"))
    )

    # Every cut of every phrase, with the counts of both its parts.
    cuts = left.select(
        "lang", "phrase", "a", "parts", F.explode(F.sequence(F.lit(1), F.size("parts") - 1)).alias("k")
    ).select(
        "lang",
        "phrase",
        "a",
        "k",
        F.array_join(F.slice("parts", F.lit(1), F.col("k")), " ").alias("head"),
        F.array_join(F.slice("parts", F.col("k") + 1, F.size("parts") - F.col("k")), " ").alias("tail"),
    )
    facts = settled(words.filter(F.col("f") >= support).unionByName(counted), "phrase-facts")
    heads = facts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = facts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    scored = (
        cuts.join(heads, ["lang", "head"])
        .join(tails, ["lang", "tail"])
        .withColumn("score", F.call_function("div", F.lit(SCALE) * _wide("a") * _wide("a"), _wide("l") * _wide("r")))
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # A language is first ranked in slices, so that no task gets more than SALTS * reported rows.
    sliced = scored.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    best = (
        sliced.withColumn("rank", F.row_number().over(W.partitionBy("lang", "slice").orderBy(*order)))
        .filter(F.col("rank") <= reported)
        .withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long"))
        .filter(F.col("rank") <= reported)
    )
    return best.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _joined(start: int, length: int) -> Column:
    return F.array_join(F.slice("parts", start + 1, length), " ")
