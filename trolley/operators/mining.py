"""Market baskets: frequent itemsets and association rules."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.functions.hashing import below_fraction, seeded_digest
from trolley.functions.skew import dense_index
from trolley.functions.stats import ratio
from trolley.sources.storage import discard, settled

# Baskets per bitmap.
CHUNK_BITS = 16
CHUNK = 1 << CHUNK_BITS
# Candidates that tasks get at a time.
MOST_CANDIDATES = 1_000_000


def row_sample(df: DataFrame, fraction: float = 0.05, seed: int = 42, keys: list[str] | None = None) -> DataFrame:
    """About ``fraction`` of the rows, chosen by the values in ``keys``.

    With the default keys single lines are drawn, so baskets are cut.
    """
    keys = keys or ["order_id", "add_to_cart_order", "product_id"]
    return df.filter(below_fraction(seeded_digest(seed, *keys), fraction))


def order_sample(df: DataFrame, fraction: float = 0.05, seed: int = 42) -> DataFrame:
    """All lines of about ``fraction`` of the orders, so baskets stay whole."""
    return row_sample(df, fraction, seed, ["order_id"])


def basket_items(df: DataFrame) -> DataFrame:
    """Distinct (order, product name) pairs; lines without a name are left out."""
    return df.filter(F.col("product_name").isNotNull()).select("order_id", "product_name").distinct()


def baskets(df: DataFrame, min_items: int = 2) -> DataFrame:
    """The distinct product names of each order, sorted, for orders with enough of them."""
    return (
        basket_items(df)
        .groupBy("order_id")
        .agg(F.sort_array(F.collect_list("product_name")).alias("items"))
        .filter(F.size("items") >= min_items)
    )


def frequent_names(pairs: DataFrame, min_support: float) -> DataFrame:
    """Names in at least ``min_support`` of all baskets of two or more names.

    Baskets of one name do not count, so what they add is taken off again.
    There are at most (mean basket size / min_support) such names.
    """
    sizes = pairs.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("_size"), F.min("product_name").alias("product_name")
    )
    total = sizes.agg(F.count(F.when(F.col("_size") >= 2, 1))).scalar()
    alone = sizes.filter(F.col("_size") == 1).select("product_name", F.lit(-1).alias("_n"))
    return (
        pairs.select("product_name", F.lit(1).alias("_n"))
        .unionByName(alone)
        .groupBy("product_name")
        .agg(F.sum("_n").alias("_support"))
        .filter(F.col("_support") >= F.ceil(F.lit(min_support) * total))
        .select("product_name")
    )


def trimmed_baskets(df: DataFrame, min_support: float) -> DataFrame:
    """Baskets of two or more names, holding only the frequent ones.

    No frequent itemset holds an infrequent name, so the itemsets and their
    counts stay the same, while no basket is longer than the list of frequent
    names. A basket left empty stays, since supports are shares of all baskets.
    """
    pairs = basket_items(df)
    frequent = frequent_names(pairs, min_support).withColumn("_frequent", F.lit(True))
    return (
        pairs.join(frequent, "product_name", "left")
        .groupBy("order_id")
        .agg(
            F.count(F.lit(1)).alias("_size"),
            F.sort_array(F.collect_list(F.when(F.col("_frequent"), F.col("product_name")))).alias("items"),
        )
        .filter(F.col("_size") >= 2)
        .select("order_id", "items")
    )


def frequent_itemsets(
    stored_baskets: DataFrame, min_support: float = 0.005, num_partitions: int | None = None
) -> DataFrame:
    """(items, freq) of all itemsets in at least ``min_support`` of the baskets.

    Baskets are numbered, and every ``CHUNK`` of them gives each frequent name a bitmap
    of the baskets that hold it. Level by level, candidates (sets whose parts are all
    frequent) are sent to the chunks, which intersect the bitmaps and count; only
    counts are shuffled. A task holds the bitmaps of one chunk: 8 KB per frequent
    name, of which there are at most (mean basket size / min_support).
    ``num_partitions`` is the number of parts the chunks are counted in.
    """
    spark = stored_baskets.sparkSession
    pairs = stored_baskets.select("order_id", F.explode(F.array_distinct("items")).alias("product_name"))
    least = max(1, math.ceil(min_support * stored_baskets.count()))
    counted = pairs.groupBy("product_name").agg(F.count(F.lit(1)).alias("freq")).filter(F.col("freq") >= least)
    names = settled(
        dense_index(settled(counted, "frequent-names"), "product_name")
        .withColumnRenamed("id", "product_name")
        .join(counted, "product_name")
        .select("product_name", F.col("idx").cast("int").alias("item"), "freq"),
        "item-numbers",
    )
    chunks = settled(_bitmaps(pairs, names, num_partitions), "bitmaps")
    level = settled(names.select(F.array("item").alias("set"), "freq"), "itemsets-1")
    levels = [level]
    while True:
        candidates = settled(_candidates(level, len(levels)), "candidates")
        if candidates.isEmpty():
            break
        level = settled(_counted(chunks, candidates).filter(F.col("freq") >= least), f"itemsets-{len(levels) + 1}")
        discard(candidates)
        levels.append(level)
    discard(chunks)
    whole = reduce(DataFrame.unionByName, levels).withColumn("_set", F.monotonically_increasing_id())
    whole = settled(whole, "itemsets-by-number")
    named = (
        whole.select("_set", "freq", F.explode("set").alias("item"))
        .join(names.select("item", "product_name"), "item")
        .groupBy("_set", "freq")
        .agg(F.sort_array(F.collect_list("product_name")).alias("items"))
    )
    found = settled(named.select("items", "freq"), "itemsets")
    discard(whole, names, *levels)
    return found


def _bitmaps(pairs: DataFrame, names: DataFrame, parts: int | None) -> DataFrame:
    """(chunk, items, bits): of each chunk of baskets the names it holds and the bitmap of each."""
    known = pairs.join(F.broadcast(names.select("product_name", "item")), "product_name").select("order_id", "item")
    numbers = dense_index(known, "order_id").select(F.col("id").alias("order_id"), "idx")
    placed = known.join(numbers, "order_id").select(
        F.shiftright("idx", CHUNK_BITS).alias("chunk"), (F.col("idx") % CHUNK).cast("int").alias("at"), "item"
    )
    # At most CHUNK places per chunk and name.
    lists = placed.groupBy("chunk", "item").agg(F.collect_list("at").alias("places"))

    @F.pandas_udf("binary")
    def bitmap(places: pd.Series) -> pd.Series:
        rows = []
        for at in places:
            held = np.zeros(CHUNK, dtype=bool)
            held[at] = True
            rows.append(np.packbits(held).tobytes())
        return pd.Series(rows)

    bits = lists.select("chunk", "item", bitmap("places").alias("bits"))
    whole = bits.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("item", "bits"))).alias("_all"))
    whole = whole.select("chunk", F.col("_all.item").alias("items"), F.col("_all.bits").alias("bits"))
    return whole if parts is None else whole.repartition(parts, "chunk")


def _candidates(level: DataFrame, size: int) -> DataFrame:
    """(set): sorted sets of ``size`` + 1 numbers of which all parts of ``size`` are in ``level``."""
    prefix = F.slice("set", 1, size - 1)
    first = level.select(prefix.alias("prefix"), F.element_at("set", -1).alias("a"))
    second = level.select(prefix.alias("prefix"), F.element_at("set", -1).alias("b"))
    grown = first.join(second, "prefix").filter("a < b").select(F.concat("prefix", F.array("a", "b")).alias("set"))
    if size == 1:
        return grown
    # The two sets it was grown from are frequent; so must be the others.
    parts = F.transform(F.sequence(F.lit(0), F.lit(size - 2)), lambda i: F.filter("set", lambda x, j: j != i))
    known = level.select(F.col("set").alias("part"))
    return (
        grown.select("set", F.explode(parts).alias("part"))
        .join(known, "part", "left_semi")
        .groupBy("set")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") == size - 1)
        .select("set")
    )


def _counted(chunks: DataFrame, candidates: DataFrame) -> DataFrame:
    """(set, freq) of the candidates, which are sent to the chunks ``MOST_CANDIDATES`` at a time."""
    slices = max(1, -(-candidates.count() // MOST_CANDIDATES))
    counts = []
    for i in range(slices):
        part = candidates.filter(F.pmod(F.xxhash64("set"), F.lit(slices)) == i) if slices > 1 else candidates
        sent = part.toArrow()["set"].combine_chunks()
        table = sent.flatten().to_numpy().reshape(len(sent), -1) if len(sent) else np.zeros((0, 1), dtype=np.int32)
        counts.append(_counted_slice(chunks, np.sort(table, axis=1)))
    return reduce(DataFrame.unionByName, counts)


def _counted_slice(chunks: DataFrame, table: np.ndarray) -> DataFrame:
    shared = chunks.sparkSession.sparkContext.broadcast(table)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sets = shared.value
        totals = np.zeros(len(sets), dtype=np.int64)
        for frame in frames:
            for items, bits in zip(frame["items"], frame["bits"]):
                held = np.zeros((max(int(sets.max(initial=0)), int(items.max())) + 1, CHUNK // 64), dtype=np.uint64)
                held[items] = np.frombuffer(b"".join(bits), dtype=np.uint64).reshape(len(items), -1)
                for start in range(0, len(sets), 512):
                    part = sets[start : start + 512]
                    both = held[part[:, 0]]
                    for column in part.T[1:]:
                        both &= held[column]
                    totals[start : start + 512] += np.bitwise_count(both).sum(axis=1, dtype=np.int64)
        some = np.flatnonzero(totals)
        if len(some):
            yield pd.DataFrame({"set": pd.Series(list(sets[some]), dtype=object), "freq": totals[some]})

    return (
        chunks.select("items", "bits")
        .mapInPandas(count, "set array<int>, freq long")
        .groupBy("set")
        .agg(F.sum("freq").alias("freq"))
    )


def association_rules(itemsets: DataFrame, stored_baskets: DataFrame, min_confidence: float = 0.1) -> DataFrame:
    """Rules with one consequent: antecedent, consequent, confidence, lift, support.

    Each itemset gives one candidate per item, whose confidence is the count of
    the set over the count of the rest.
    """
    total = stored_baskets.agg(F.count(F.lit(1))).scalar()
    candidates = (
        itemsets.filter(F.size("items") >= 2)
        .select("items", F.col("freq").alias("_both"), F.explode("items").alias("_item"))
        .select(
            F.array_remove("items", F.col("_item")).alias("antecedent"),
            F.array("_item").alias("consequent"),
            "_both",
        )
    )
    before = itemsets.select(F.col("items").alias("antecedent"), F.col("freq").alias("_before"))
    after = itemsets.filter(F.size("items") == 1).select(
        F.col("items").alias("consequent"), F.col("freq").alias("_after")
    )
    confidence = ratio(F.col("_both"), F.col("_before"))
    return (
        candidates.join(before, "antecedent")
        .withColumn("confidence", confidence)
        .filter(F.col("confidence") >= min_confidence)
        .join(after, "consequent")
        .withColumn("_total", total)
        .select(
            "antecedent",
            "consequent",
            "confidence",
            (F.col("confidence") / ratio(F.col("_after"), F.col("_total"))).alias("lift"),
            ratio(F.col("_both"), F.col("_total")).alias("support"),
        )
    )


def top_rules_by_lift(rules: DataFrame, k: int = 20) -> DataFrame:
    return rules.orderBy(F.desc("lift"), "antecedent", "consequent").limit(k)


def run_fpgrowth(
    df: DataFrame,
    min_support: float = 0.005,
    min_confidence: float = 0.1,
    sample_frac: float = 1.0,
    seed: int = 42,
    whole_orders: bool = True,
    num_partitions: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Frequent itemsets and rules of all orders, or of a sample of orders (or of lines)."""
    draw = order_sample if whole_orders else row_sample
    stored = settled(trimmed_baskets(draw(df, sample_frac, seed), min_support), "baskets")
    itemsets = frequent_itemsets(stored, min_support, num_partitions)
    return itemsets, association_rules(itemsets, stored, min_confidence)
