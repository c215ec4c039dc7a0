"""Exact duplicates by an extendible-hash index on shared files.

Two texts are equal when they are identical once white space is deleted. The
index maps a hash of the normalised text to the distinct texts that have it:

* a directory of hash prefixes is doubled wherever a bucket holds more keys than
  its capacity, so buckets stay even and keep their sizes as the corpus grows;
* entries are dealt out to owner tasks by ranges of keys. The owner of a range
  chains the different texts of one key and stores its buckets in key order as a
  file in the shared folder;
* every row then looks its entry up by key and finds its place in the chain.

Bytes are compared where a key occurs more than once; such rows are told from the
others by a filter of fixed size, so all other texts stay where they are.
Equal texts are counted before they are sent to the owner, and rows look entries up
in a join that adaptive execution can split, so a group may hold any part of the
corpus. Only DataFrame functions are used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trolley.llm.common import key_mask, maybe_among, new_names
from trolley.sources.storage import discard, new_shared_folder, settled

HASH_BITS = 64
BUCKET_KEYS = 100_000


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def text_key(norm: Column, hash_bits: int = HASH_BITS) -> Column:
    """The leading ``hash_bits`` bits of a 64-bit hash, left-aligned in a long."""
    key = F.xxhash64(norm)
    return key if hash_bits == 64 else F.shiftleft(F.shiftright(key, 64 - hash_bits), 64 - hash_bits)


def _prefix(depth: int) -> Column:
    """The first ``depth`` bits of the key as a number; the keys of one prefix are a range."""
    if depth == 0:
        return F.lit(0).cast("long")
    # The sign bit is flipped so that prefixes sort as the signed keys do.
    return F.shiftright(F.col("_key"), 64 - depth) + F.lit(1 << (depth - 1)).cast("long")


def build_directory(keys: DataFrame, capacity: int = BUCKET_KEYS, hash_bits: int = HASH_BITS) -> DataFrame:
    """Buckets of an extendible-hash index over distinct ``_key`` values.

    Returns (depth, prefix, n_keys): a bucket holds the keys that begin with
    the ``depth`` bits of ``prefix``. A bucket above ``capacity`` is split by
    one more bit until it fits or no bit is left. An empty table has no bucket.
    """
    # Hashes are even, so the first doublings are known from the number of keys.
    depth = min(max(0, (keys.count() // capacity).bit_length()), hash_bits, 40)
    buckets, rest = [], keys.select("_key")
    while True:
        counted = settled(
            rest.groupBy(_prefix(depth).alias("prefix"))
            .agg(F.count(F.lit(1)).alias("n_keys"))
            .select(F.lit(depth).alias("depth"), "prefix", "n_keys"),
            "bucket-counts",
        )
        overfull = counted.filter(F.col("n_keys") > capacity)
        if depth == min(hash_bits, 62) or overfull.isEmpty():
            buckets.append(counted)
            return reduce(DataFrame.unionByName, buckets)
        buckets.append(counted.filter(F.col("n_keys") <= capacity))
        rest = rest.withColumn("_prefix", _prefix(depth)).join(
            overfull.select(F.col("prefix").alias("_prefix")), "_prefix", "left_semi"
        )
        depth += 1


def with_bucket(entries: DataFrame, directory: DataFrame) -> DataFrame:
    """Add ``bucket``, the first directory slot of the bucket of each ``_key``.

    The directory has one slot per prefix of the deepest bucket; several slots
    point to a shallower bucket.
    """
    deepest = directory.agg(F.max("depth")).first()[0] or 0
    slots = directory.select(
        F.expr(f"shiftleft(prefix, {deepest} - depth)").alias("bucket"),
        F.explode(
            F.expr(
                f"sequence(shiftleft(prefix, {deepest} - depth), "
                f"shiftleft(prefix, {deepest} - depth) + shiftleft(1L, {deepest} - depth) - 1)"
            )
        ).alias("_slot"),
    )
    return entries.withColumn("_slot", _prefix(deepest)).join(slots, "_slot").drop("_slot")


def build_index(
    entries: DataFrame, keys: DataFrame, capacity: int = BUCKET_KEYS, hash_bits: int = HASH_BITS
) -> DataFrame:
    """Store ``entries`` (one row per distinct text) by bucket and read them from there.

    Owner tasks get ranges of buckets and keys and number the chain of texts of each
    key (``_link``) in the order of ``_norm``; the texts themselves are not stored.
    """
    spark = entries.sparkSession
    path = new_shared_folder(spark, "dedup-index")
    chain = W.partitionBy("bucket", "_key").orderBy("_norm")
    (
        with_bucket(entries, build_directory(keys, capacity, hash_bits))
        .repartitionByRange("bucket", "_key")
        .withColumn("_link", F.row_number().over(chain))
        .drop("_norm")
        .sortWithinPartitions("bucket", "_key", "_link")
        .write.parquet(path)
    )
    return spark.read.parquet(path)


def _looked_up(docs: DataFrame, capacity: int, hash_bits: int) -> tuple[DataFrame, DataFrame]:
    """(rows, mask): every row with its key, digest and entry; the filter of keys that occur more than once."""
    norm = normalised(F.col("text"))
    row_facts = [
        F.col("doc_id").alias("doc_id"),
        F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("_points"),
        text_key(norm, hash_bits).alias("_key"),
    ]
    sha = F.sha2(norm.cast("binary"), 256)
    best = F.min(F.struct(-F.col("_points"), F.col("doc_id").isNull(), F.col("doc_id"))).alias("_best")
    rows = settled(docs.select(*row_facts, sha.alias("text_sha256")), "dedup-rows")
    keys = settled(
        rows.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"), best, F.min("text_sha256").alias("_sha")), "dedup-keys"
    )
    repeated = keys.filter("_n > 1").select("_key")
    mask = settled(key_mask(repeated, "_key"), "dedup-mask")

    # A key of one row is an entry as it is. The texts of the others are compared.
    single = keys.filter("_n = 1").select("_key", F.lit(None).cast("string").alias("_norm"), "_sha", "_best", "_n")
    compared = (
        maybe_among(docs.select(*row_facts, norm.alias("_norm")), F.col("_key"), mask, "_maybe")
        .filter("_maybe")
        .join(repeated, "_key", "left_semi")
        .groupBy("_key", "_norm")
        .agg(best, F.count(F.lit(1)).alias("_n"))
        .select("_key", "_norm", F.sha2(F.col("_norm").cast("binary"), 256).alias("_sha"), "_best", "_n")
    )
    index = build_index(single.unionByName(compared), keys, capacity, hash_bits)
    discard(keys)
    entries = index.select(
        F.col("_key").alias("_index_key"),
        F.col("_sha").alias("_index_sha"),
        F.col("_best.doc_id").alias("keep_id"),
        F.col("_n").alias("group_size"),
    )
    same = (F.col("_key") == F.col("_index_key")) & (F.col("text_sha256") == F.col("_index_sha"))
    return rows.join(entries, same, "left"), mask


def exact_duplicates(docs: DataFrame, capacity: int = BUCKET_KEYS, hash_bits: int = HASH_BITS) -> DataFrame:
    """The group of equal texts of every document.

    Returns one row per row of ``docs``: doc_id, keep_id, group_size, kept,
    text_sha256. Of equal texts, the row with the most code points in the
    original text stays, then that with the smallest doc_id; a null doc_id comes
    last. A null text counts as empty, and all empty texts are one group. Rows
    that repeat both doc_id and text are in one group and all marked as kept
    (``drop_exact_duplicates`` leaves one). An empty table gives no rows. Other
    columns are ignored.
    """
    rows, _ = _looked_up(docs, capacity, hash_bits)
    return rows.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def drop_exact_duplicates(docs: DataFrame, capacity: int = BUCKET_KEYS, hash_bits: int = HASH_BITS) -> DataFrame:
    """``docs`` with one row left of each group of equal texts, all columns unchanged.

    Rows whose key occurs once are passed on where they lie; only the others are joined.
    """
    key, maybe, kept_id, kept_sha, copies = new_names(docs, "key", "maybe", "kept_id", "kept_sha", "copies")
    rows, mask = _looked_up(docs, capacity, hash_bits)
    norm = normalised(F.col("text"))
    marked = maybe_among(docs.withColumn(key, text_key(norm, hash_bits)), F.col(key), mask, maybe)
    kept = settled(
        maybe_among(rows.filter(F.col("doc_id").eqNullSafe(F.col("keep_id"))), F.col("_key"), mask, "_maybe")
        .filter("_maybe")
        .groupBy(F.col("doc_id").alias(kept_id), F.col("text_sha256").alias(kept_sha))
        .agg(F.count(F.lit(1)).alias(copies)),
        "dedup-kept",
    )
    sha = F.sha2(norm.cast("binary"), 256)
    alone = marked.filter(~F.col(maybe)).select(*docs.columns)
    left = marked.filter(maybe).join(kept, F.col("doc_id").eqNullSafe(F.col(kept_id)) & (sha == F.col(kept_sha)))
    once = left.filter(F.col(copies) == 1).select(*docs.columns)
    if kept.filter(F.col(copies) > 1).isEmpty():
        return alone.unionByName(once)
    again = left.filter(F.col(copies) > 1).dropDuplicates([kept_id, kept_sha]).select(*docs.columns)
    return alone.unionByName(once).unionByName(again)
