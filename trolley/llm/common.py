"""Small helpers that several operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def new_names(df: DataFrame, *wanted: str) -> list[str]:
    """``wanted`` as names that no column of ``df`` has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    names = []
    for name in wanted:
        name = f"_{name}"
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        names.append(name)
    return names


class WordCodes(dict):
    """64-bit hashes of words, remembered up to a bound. ``plain`` maps a word to the form that counts."""

    def __init__(self, plain=None, bound: int = 50_000):
        super().__init__()
        self.plain, self.bound = plain, bound

    def __missing__(self, word: str) -> int:
        if len(self) >= self.bound:
            self.clear()
        form = word if self.plain is None else self.plain(word)
        code = self[word] = xxhash.xxh64_intdigest(form.encode("utf-8", "surrogatepass"))
        return code


def short_batches(spark, rows: int = 500) -> None:
    """Send tasks' Python workers at most so many rows at a time: texts are long.

    A setting of the session that only changes how much a worker holds at once.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > rows:
        spark.conf.set(name, str(rows))


def release_memory() -> None:
    """Give what a finished task no longer uses back to the system.

    Python workers live on for the tasks that follow and would otherwise keep it.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim is not None:
        trim(0)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def id_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(divisor)).cast("int")


def bounded(sample: DataFrame, rows: int, id_column: str) -> DataFrame:
    """``sample`` with at most so many rows, the first by digests of id and ``text``.

    A sample of ids is larger than their number only if documents repeat an id. Only
    then are texts put in order.
    """
    if sample.select(id_column).count() <= rows:
        return sample
    order = [F.md5(F.col(id_column).cast("string")), F.md5(F.coalesce("text", F.lit("")).cast("binary"))]
    return sample.orderBy(*order).limit(rows).repartition(sample.sparkSession.sparkContext.defaultParallelism)


# Bits of a broadcast filter: 8 MB, whatever the number of keys.
FILTER_BITS = 1 << 26


def key_filter(keys: DataFrame, column: str) -> Broadcast:
    """A Bloom filter of the long ``column``, of fixed size, for all tasks.

    It lets through every key and, by chance, some others, so it only spares rows
    a shuffle: a join must follow.
    """
    bits = keys.select(
        F.explode(
            F.array(
                F.expr(f"cast(pmod(`{column}`, {FILTER_BITS}) as int)"),
                F.expr(f"cast(pmod(shiftrightunsigned(`{column}`, 32), {FILTER_BITS}) as int)"),
            )
        ).alias("bit")
    )
    # At most FILTER_BITS / 64 words come to the driver.
    words = (
        bits.groupBy(F.expr("bit div 64").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias("bits"))
        .toArrow()
    )
    table = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    table[words["word"].to_numpy()] = words["bits"].to_numpy()
    return keys.sparkSession.sparkContext.broadcast(table.view(np.uint64))


def passing(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the keys the filter lets through."""
    passed = np.ones(len(keys), dtype=bool)
    for code in (keys.view(np.uint64), keys.view(np.uint64) >> np.uint64(32)):
        bit = code % np.uint64(FILTER_BITS)
        passed &= (table[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
    return passed


def passes(shared: Broadcast):
    """The column function that tells whether the filter lets a long through."""

    @F.pandas_udf("boolean")
    def passed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for keys in batches:
            yield pd.Series(passing(shared.value, keys.to_numpy(dtype=np.int64)))

    return passed


def passing_items(shared: Broadcast):
    """The column function that keeps the items of an array of longs that the filter lets through."""

    @F.pandas_udf("array<long>")
    def passed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for lists in batches:
            lengths = np.array([len(items) for items in lists], dtype=np.int64)
            if not lengths.sum():
                yield pd.Series([[]] * len(lists))
                continue
            items = np.concatenate(lists.to_list())
            kept = passing(shared.value, items)
            ends = np.cumsum([0, *np.add.reduceat(np.append(kept, False), np.cumsum([0, *lengths[:-1]])) * (lengths > 0)])
            items = items[kept]
            yield pd.Series([items[a:b] for a, b in zip(ends[:-1], ends[1:])])

    return passed


# Rows of a mask: 4 MB of slots and bits, whatever the number of keys.
MASK_SLOTS = 1 << 18


def _place(key: Column) -> tuple[Column, Column]:
    """The slot of a key and its bit there."""
    hashed = F.xxhash64(key)
    bit = F.pmod(F.shiftrightunsigned(hashed, 32), F.lit(64)).cast("int")
    return F.pmod(hashed, F.lit(MASK_SLOTS)), F.call_function("shiftleft", F.lit(1).cast("long"), bit)


def key_mask(keys: DataFrame, column: str) -> DataFrame:
    """(slot, mask): a filter as a table of at most ``MASK_SLOTS`` rows, for ``maybe_among``."""
    slot, bit = _place(F.col(column))
    return keys.select(slot.alias("slot"), bit.alias("bit")).groupBy("slot").agg(F.bit_or("bit").alias("mask"))


def maybe_among(df: DataFrame, key: Column, mask: DataFrame, name: str) -> DataFrame:
    """``df`` with the boolean ``name``: true for every row whose key is in the mask, and by chance for others.

    Only column functions, and no row is moved: the mask is broadcast, which its
    number of rows allows.
    """
    slot, bits = new_names(df, "slot", "mask")
    at, bit = _place(key)
    held = F.broadcast(mask.select(F.col("slot").alias(slot), F.col("mask").alias(bits)))
    joined = df.join(held, at == F.col(slot), "left")
    return joined.withColumn(name, F.coalesce(F.col(bits).bitwiseAND(bit), F.lit(0)) != 0).drop(slot, bits)
