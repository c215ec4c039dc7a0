"""Fill-in-middle examples: two cuts per document, found from memorised chunk counts.

A document of n tokens (runs of ASCII letters, and every other code point on its
own) is cut after two numbers of tokens that a digest of its id decides. Nothing
is tokenised twice that was seen before:

* a rolling hash over the last ``WINDOW`` bytes cuts a text into chunks where the
  hash ends in zeros, so equal passages give equal chunks wherever they lie;
* a cache per task maps the bytes of a chunk to a boundary summary: its tokens, its
  code points, and whether it begins and ends inside a run of letters. The bytes
  themselves are the key, so a chunk is only taken for one that is the same;
* summaries combine: two chunks share a token where a run of letters goes on from
  one into the next. Running sums of the summaries give n and the chunk in which
  a cut lies, and only that chunk is read token by token.

The cache holds a fixed number of bytes and decides nothing but the time taken.
Tasks send back three numbers per document; the examples are put together, and
taken apart again, by column functions.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import mixed, short_batches

TOKEN = r"[A-Za-z]+|[^A-Za-z]"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = "1"
PLAIN_FROM = 90  # of 100: documents left as they are
SPM_BELOW = 20  # of 100: documents with the suffix first

WINDOW = 32
MEAN_CHUNK = 512
LEAST_CHUNK, MOST_CHUNK = 64, 4096
CACHE_BYTES = 32 << 20

_tokens = re.compile(TOKEN)
_letters = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
# One pseudo-random number per byte value.
_gear = (mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)


def chunk_ends(data: bytes) -> list[int]:
    """Ends of the content-defined chunks, never inside a code point.

    A cut depends on the ``WINDOW`` bytes before it, and on the chunk before only
    through the least and the greatest length.
    """
    size = len(data)
    if size <= LEAST_CHUNK:
        return [size] if size else []
    raw = np.frombuffer(data, dtype=np.uint8)
    hashed = _gear[raw]
    span = 1
    while span < WINDOW:  # the sum over 2 * span bytes from two sums over span bytes
        longer = hashed.copy()
        longer[span:] += hashed[:-span] << np.uint32(span)
        hashed, span = longer, 2 * span
    starts_point = np.append((raw[1:] & 0xC0) != 0x80, True)
    wanted = (np.flatnonzero((hashed >> np.uint32(32 - MEAN_CHUNK.bit_length() + 1) == 0) & starts_point) + 1).tolist()
    ends, last = [], 0
    for end in [*wanted, size]:
        while end - last > MOST_CHUNK:
            forced = last + MOST_CHUNK
            while forced > last + 1 and data[forced] & 0xC0 == 0x80:
                forced -= 1
            ends.append(forced)
            last = forced
        if end - last >= LEAST_CHUNK or end == size and end > last:
            ends.append(end)
            last = end
    return ends


class ChunkCounts(dict):
    """Boundary summaries by the bytes of a chunk: (tokens, code points, letter first, letter last)."""

    def __init__(self, bound: int = CACHE_BYTES):
        super().__init__()
        self.bound, self.held, self.counted = bound, 0, 0

    def __missing__(self, chunk: bytes) -> tuple[int, int, bool, bool]:
        text = chunk.decode("utf-8", "replace")
        found = (len(_tokens.findall(text)), len(text), chunk[0] in _letters, chunk[-1] in _letters)
        self.counted += 1
        self.held += len(chunk) + 200
        if self.held > self.bound:
            self.clear()
            self.held = len(chunk) + 200
        self[chunk] = found
        return found


class Cutter:
    """Places in one text, from the summaries of its chunks."""

    def __init__(self, data: bytes, counts: ChunkCounts):
        self.chunks, self.tokens, self.points, self.goes_on = [], [], [], []
        n = points = start = 0
        inside = False  # whether the text so far ends in a run of letters
        for end in chunk_ends(data):
            chunk = data[start:end]
            some, length, first, last = counts[chunk]
            self.goes_on.append(inside and first)
            n += some - (inside and first)
            points += length
            self.chunks.append(chunk)
            self.tokens.append(n)  # tokens begun by the end of the chunk
            self.points.append(points)
            inside, start = last, end
        self.n = n

    def points_before(self, tokens: int) -> int:
        """Code points of the first ``tokens`` tokens."""
        if tokens <= 0:
            return 0
        if tokens >= self.n:
            return self.points[-1] if self.points else 0
        # The token after the cut begins in this chunk, so the cut lies before it.
        k = bisect_left(self.tokens, tokens + 1)
        before = self.tokens[k - 1] if k else 0
        skipped = tokens - before + self.goes_on[k]
        at = 0
        for i, token in enumerate(_tokens.finditer(self.chunks[k].decode("utf-8", "replace"))):
            if i == skipped:
                at = token.start()
                break
        return (self.points[k - 1] if k else 0) + at


def _places(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    counts = ChunkCounts()
    for texts, firsts, seconds in batches:
        rows = []
        for data, first, second in zip(texts, firsts, seconds):
            cut = Cutter(data, counts)
            low, high = sorted((first % (cut.n + 1), second % (cut.n + 1)))
            start, end = cut.points_before(low), cut.points_before(high)
            rows.append((cut.n, start, end - start))
        yield pd.DataFrame(rows, columns=["n", "prefix_chars", "middle_chars"], dtype="int64")


def draws(doc_id: Column, seed: str = SEED) -> list[Column]:
    """Four numbers below 2^32 that the seed and the id decide; a null id counts as empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """One training example per document.

    Returns one row per row of ``docs``: doc_id, n (tokens), form (plain, psm or
    spm), prefix_chars and middle_chars (code points; null if plain) and output,
    the example. A null text counts as empty; an empty text, and one that holds one
    of the markers, stays plain. Texts of any length are cut whole. Rows that repeat
    get the same example, a null id draws as empty text, and an empty table gives no
    rows. Other columns are ignored.
    """
    short_batches(docs.sparkSession)
    places = F.pandas_udf(_places, "n long, prefix_chars long, middle_chars long")
    first, second, third, fourth = draws(F.col("doc_id"), seed)
    text = F.coalesce(F.col("text"), F.lit(""))
    cut = docs.select(
        F.col("doc_id").alias("doc_id"),
        text.alias("text"),
        third.alias("third"),
        fourth.alias("fourth"),
        places(text.cast("binary"), first, second).alias("at"),
    )
    marked = F.lit(False)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains("text", F.lit(marker))
    form = (
        F.when((F.col("text") == "") | marked | (F.col("third") % 100 >= PLAIN_FROM), "plain")
        .when(F.col("fourth") % 100 < SPM_BELOW, "spm")
        .otherwise("psm")
    )
    shaped = cut.select(
        "doc_id", "text", form.alias("form"), F.col("at.n").alias("n"), "at.prefix_chars", "at.middle_chars"
    )
    start, end = F.col("prefix_chars").cast("int"), (F.col("prefix_chars") + F.col("middle_chars")).cast("int")
    prefix = F.substring("text", F.lit(1), start)
    middle = F.substring("text", start + 1, F.col("middle_chars").cast("int"))
    suffix = F.substring("text", end + 1, F.lit(2**31 - 1))
    whole = F.col("form") == "plain"
    output = (
        F.when(whole, F.col("text"))
        .when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
    )
    return shaped.select(
        "doc_id",
        "n",
        "form",
        *[F.when(~whole, F.col(c)).alias(c) for c in ("prefix_chars", "middle_chars")],
        output.alias("output"),
    )


def restored(output: Column, form: Column) -> Column:
    """The text of an example, from nothing but the example and its form.

    The parts hold no marker, and no marker can arise where two parts meet one, so
    cutting at the markers gives the parts back.
    """
    parts = F.split(output, "<[PSM]>", -1)
    return (
        F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .when(form == "spm", F.concat(parts[2], parts[3], parts[1]))
        .otherwise(output)
    )


def digests() -> list[Column]:
    """Digests of the examples and of the texts rebuilt from them."""
    return [
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    ]
