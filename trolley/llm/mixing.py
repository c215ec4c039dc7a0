"""Mixing sources to target weights by a low-discrepancy schedule.

The mix is a sequence of slots of equal token counts. Golden-ratio points, sent
through the cumulative targets, decide the source of every slot, so any stretch
of the sequence holds each source in proportion. The slots of a source are
ranked; rank r takes the r-th block of the source's shuffled documents, read
again from the start once all are used. The points leave no gap of two slots, but
a source of few slots may get half or twice of them by chance. Such a source has
its words counted out instead: its slots lie evenly in the sequence, and the last
of them is cut.

Documents and slots are placed by running sums inside small blocks and across
them, so a source may hold any part of the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trolley.functions.skew import small_side
from trolley.llm.common import WORD, new_names
from trolley.sources.storage import discard, settled

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SLOTS = 1 << 17
MAX_BLOCK = 2048
SLOT_CHUNK = 4096
# A source with less than this part of the slots asked for, or less than two, is counted out.
FEW_SLOTS = 64
ROWS_PER_BUCKET = 1000
# 2**64 divided by the golden ratio; multiples of it modulo 2**64 are the points.
GOLDEN = 0x9E3779B97F4A7C15


def source_targets(sizes: dict[str | None, int], weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> dict:
    """Tokens wanted of each source. Weights repeat over the sources by code point, null last.

    All sizes together are shared by weight. A target stops at ``max_repeats``
    times its source's size; what is over is shared again among the others.
    """
    ordered = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(ordered)}
    targets: dict = {}
    free, left = list(ordered), sum(sizes.values())
    while free:
        total = sum(weight[s] for s in free)
        full = [s for s in free if left * weight[s] > max_repeats * sizes[s] * total]
        if not full:
            targets |= {s: left * weight[s] / total for s in free}
            break
        targets |= {s: float(max_repeats * sizes[s]) for s in full}
        left -= sum(max_repeats * sizes[s] for s in full)
        free = [s for s in free if s not in targets]
    return targets


def counted_out(targets: dict, block: int, slots: int = SLOTS) -> dict:
    """Words of the sources with too few slots for the points: their targets, in whole words.

    With blocks of one word the points are right to a few words, so that only
    targets below two words are counted out.
    """
    least = max(2, slots // FEW_SLOTS) if block > 1 else 2
    return {s: math.ceil(t - 1e-6) for s, t in targets.items() if t < least * block}


def slot_sources(n_slots: int, block: int, targets: list[float]):
    """A function that gives every slot of a chunk its source and its rank among the chunk's slots of that source."""
    edges = np.cumsum(targets) / max(sum(targets), 1e-300)
    golden, chunk = GOLDEN, SLOT_CHUNK

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for c in frame["chunk"]:
                slots = np.arange(c * chunk, min((c + 1) * chunk, n_slots), dtype=np.uint64)
                points = ((slots + np.uint64(1)) * np.uint64(golden)) / 2.0**64
                source = np.minimum(np.searchsorted(edges, points, side="right"), len(edges) - 1)
                order = np.argsort(source, kind="stable")
                starts = np.searchsorted(source[order], np.arange(len(edges)))
                rank = np.empty(len(slots), dtype=np.int64)
                rank[order] = np.arange(len(slots)) - starts[source[order]]
                yield pd.DataFrame(
                    {"chunk": np.int64(c), "slot": slots.astype(np.int64), "src": source.astype(np.int32), "_rank": rank}
                )

    return place


def ranked_slots(spark, n_slots: int, block: int, targets: list[float]) -> DataFrame:
    """(slot, src, rank): every slot, its source and its place among the slots of that source."""
    chunks = spark.range(-(-n_slots // SLOT_CHUNK)).withColumnRenamed("id", "chunk")
    slots = settled(
        chunks.mapInPandas(
            slot_sources(n_slots, block, targets), "chunk long, slot long, src int, _rank long"
        ),
        "mix-slots",
    )
    earlier = W.partitionBy("src").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        slots.groupBy("src", "chunk")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("src", "chunk", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    )
    return slots.join(starts, ["src", "chunk"]).select("slot", "src", (F.col("_start") + F.col("_rank")).alias("rank"))


def mix_sources(
    docs: DataFrame,
    weights=WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    slots: int = SLOTS,
    max_block: int = MAX_BLOCK,
    seed: str = "mix",
) -> DataFrame:
    """How many tokens of every document the mix takes.

    Returns one row per row of ``docs``: doc_id, size, source_size, target,
    taken. A size is the number of words (``WORD``); a null text has none. A
    source gives its target in whole words if that is less than 1/64 of
    ``slots`` (or two) blocks, and comes within a few blocks of it otherwise, or
    within a few words if a block is one word. No document gives
    more than ``max_repeats`` times its size. A null source is a source of its
    own, empty texts take no part (taken 0), documents with equal ids are mixed
    as separate documents, and an empty table gives no rows. Other columns are
    ignored. The result depends on the ids and sizes only.

    The mix has at least ``slots`` slots, and blocks of ``max_block`` tokens at
    most. The table of sources, one row each, is read by the driver.
    """
    mixed, _ = _mixed(docs, weights, max_repeats, slots, max_block, seed)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def _mixed(
    docs: DataFrame,
    weights=WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    slots: int = SLOTS,
    max_block: int = MAX_BLOCK,
    seed: str = "mix",
) -> tuple[DataFrame, list[DataFrame]]:
    """The rows of ``mix_sources`` with their source and shuffle key, and the stored tables they are read from."""
    spark = docs.sparkSession
    sized = settled(
        docs.select(
            F.col("doc_id").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        ),
        "mix-sizes",
    )
    counted = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")).collect()
    sizes = {r["source"]: r["size"] for r in counted}
    wanted = source_targets(sizes, weights, max_repeats)
    ordered = sorted(sizes, key=lambda s: (s is None, s or ""))
    total, n_rows = sum(sizes.values()), sum(r["rows"] for r in counted)
    block = min(max(total // slots, 1), max_block)
    n_slots = -(-total // block) if total else 0
    quotas = counted_out(wanted, block, slots)
    sources = spark.createDataFrame(
        [(s, i, sizes[s], float(wanted[s]), quotas.get(s)) for i, s in enumerate(ordered)],
        "name string, src int, source_size long, target double, _quota long",
    )
    few = sources.filter("_quota IS NOT NULL").select("src", "_quota", F.expr(f"(_quota + {block - 1}) div {block}").alias("_n"))
    evenly = few.filter("_n > 0").select("src", "_n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)).alias("rank"))
    taken_slots = settled(
        ranked_slots(spark, n_slots, block, [wanted[s] for s in ordered] or [1.0])
        .join(few, "src", "left_anti")
        .unionByName(evenly.select(F.expr(f"(2 * rank + 1) * {n_slots} div (2 * _n)").alias("slot"), "src", "rank"))
        .select(F.col("src").alias("_src"), F.col("rank").alias("_block"), "slot"),
        "mix-ranks",
    )
    n_taken = taken_slots.groupBy("_src").agg((F.count(F.lit(1)) * block).alias("_tokens"))

    # Shuffle the documents of a source and place them in a row: first the buckets of
    # the shuffle key, then the documents in each.
    bits = max(1, (n_rows // ROWS_PER_BUCKET).bit_length())
    shuffled = (
        sized.join(sources, sized["source"].eqNullSafe(sources["name"]))
        .drop("name")
        .withColumn("_key", _shuffle_key(seed))
        .withColumn("_bucket", F.shiftright(F.conv(F.substring("_key", 1, 10), 16, 10).cast("long"), max(0, 40 - bits)))
    )
    earlier_buckets = W.partitionBy("src").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        shuffled.groupBy("src", "_bucket")
        .agg(F.sum("size").alias("_size"))
        .select("src", "_bucket", F.coalesce(F.sum("_size").over(earlier_buckets), F.lit(0)).alias("_start"))
    )
    earlier_docs = W.partitionBy("src", "_bucket").orderBy("_key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    placed = settled(
        shuffled.withColumn("_before", F.coalesce(F.sum("size").over(earlier_docs), F.lit(0)))
        .join(starts, ["src", "_bucket"])
        .join(n_taken, F.col("src") == F.col("_src"), "left")
        .select(
            "doc_id",
            "size",
            "source_size",
            "target",
            "src",
            "source",
            "_key",
            (F.col("_start") + F.col("_before")).alias("_at"),
            F.coalesce("_quota", "_tokens", F.lit(0)).cast("long").alias("_tokens"),
        ),
        "mix-placed",
    )

    # A document lies in one block or more of each reading of its source; only the
    # blocks that the mix reaches are looked up.
    pieces = (
        placed.withColumn("_reading", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))))
        .withColumn("_from", F.col("_at") + F.col("_reading") * F.col("source_size"))
        .withColumn("_to", F.least(F.col("_from") + F.col("size"), F.col("_tokens")))
        .filter(F.col("_from") < F.col("_to"))
        .withColumn("_block", F.explode(F.sequence(F.expr(f"_from div {block}"), F.expr(f"(_to - 1) div {block}"))))
        .withColumn(
            "_piece",
            F.least("_to", (F.col("_block") + 1) * block) - F.greatest("_from", F.col("_block") * block),
        )
    )
    taken = (
        pieces.join(taken_slots.withColumnRenamed("_src", "src"), ["src", "_block"])
        .groupBy("src", "_at", "size")
        .agg(F.sum("_piece").alias("_taken"))
        .select(F.col("src").alias("_s"), F.col("_at").alias("_a"), F.col("size").alias("_n"), "_taken")
    )
    same = (F.col("src") == F.col("_s")) & (F.col("_at") == F.col("_a")) & (F.col("size") == F.col("_n"))
    mixed = placed.join(taken, same, "left").withColumn("taken", F.coalesce("_taken", F.lit(0)).cast("long"))
    return mixed, [sized, taken_slots, placed]


def _shuffle_key(seed: str) -> Column:
    """Documents are shuffled by sorting on this."""
    return F.md5(F.concat_ws("|", F.lit(seed), F.col("doc_id").cast("string")))


def mixed_documents(docs: DataFrame, seed: str = "mix", **options) -> DataFrame:
    """``docs`` as often as the mix takes them: the rows of a document repeat, all columns unchanged.

    A document of which the mix takes some tokens but not half of them is there
    once; empty documents, and those that the mix does not reach, are not. Rows of
    a source with one id all repeat as the one of them that the mix takes most often.

    The mix reads the shuffled documents of a source in order, so the last document
    that it takes so many times tells how often it takes each: texts stay where
    they are, and only a few such ends per source are sent to them.
    """
    name, ends, times, n = new_names(docs, "mix_source", "ends", "times", "n")
    mixed, tables = _mixed(docs, seed=seed, **options)
    repeats = F.greatest(F.round(F.col("taken") / F.col("size")).cast("int"), F.lit(1))
    lasts = (
        mixed.filter("taken > 0")
        .groupBy("source", repeats.alias("times"))
        .agg(F.max(F.struct("_key", "doc_id")).alias("last"))
        # At most as many as a document may repeat.
        .groupBy(F.col("source").alias(name))
        .agg(F.collect_list(F.struct("times", "last")).alias(ends))
    )
    held = small_side(lasts, "mix-ends")
    discard(*tables)
    here = F.struct(_shuffle_key(seed), F.col("doc_id"))
    reached = F.transform(F.filter(ends, lambda e: here <= e["last"]), lambda e: e["times"])
    return (
        docs.join(held, F.col("source").cast("string").eqNullSafe(F.col(name)))
        .withColumn(times, F.coalesce(F.array_max(reached), F.lit(0)))
        .filter((F.col(times) > 0) & F.col("text").rlike(WORD))
        .withColumn(n, F.explode(F.sequence(F.lit(1), F.col(times))))
        .select(*docs.columns)
    )
