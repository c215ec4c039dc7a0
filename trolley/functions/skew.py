"""Joins and row numbers for keys of any weight.

A single order, user, product or group of equal rows may hold a large part of
the table. The helpers here never put such a group into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trolley.functions.hashing import row_text
from trolley.sources.storage import settled

# A key with more rows than this is handled apart from the others. A table of
# n rows has fewer than n / HEAVY_ROWS such keys.
HEAVY_ROWS = 1_000_000
# Lists up to this length are broadcast; longer ones are joined like any table.
BROADCAST_ROWS = 1_000_000
# Rows are numbered in 16 to this power buckets.
BUCKET_DIGITS = 4


def small_side(df: DataFrame, label: str) -> DataFrame:
    """``df`` stored, and marked for broadcast if it has no more than ``BROADCAST_ROWS`` rows."""
    stored = settled(df, label)
    return F.broadcast(stored) if stored.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else stored


def spread_lookup(
    rows: DataFrame,
    facts: DataFrame,
    keys: list[str],
    values: list[str],
    size_col: str,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Left join of ``rows`` with one row of ``facts`` per key.

    ``size_col`` of ``facts`` tells how many rows carry the key. Keys above
    ``heavy_rows`` are looked up in a list of their own, which is broadcast if it
    is short, so their rows are not shuffled; the other keys use an ordinary join.
    The facts are stored first, as both ways read them.
    """
    facts = settled(facts, "facts")
    heavy = small_side(facts.filter(F.col(size_col) > heavy_rows).select(*keys, *values), "heavy-facts")
    light = facts.filter(F.col(size_col) <= heavy_rows).select(*keys, *values)
    columns = [*rows.columns, *values]
    some_heavy = not heavy.isEmpty()

    # Rows with a null key match nothing; a slice number keeps them from
    # meeting in one partition.
    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(key).isNotNull()
    slice_of = F.when(complete, F.lit(0)).otherwise(F.pmod(F.xxhash64(*rows.columns), F.lit(4096)).cast("int"))
    ordinary = rows.join(heavy.select(*keys), keys, "left_anti") if some_heavy else rows
    shuffled = (
        ordinary.withColumn("_slice", slice_of)
        .join(light.withColumn("_slice", F.lit(0)), [*keys, "_slice"], "left")
        .select(*columns)
    )
    return shuffled.unionByName(rows.join(heavy, keys, "inner").select(*columns)) if some_heavy else shuffled


def number_rows(
    rows: DataFrame,
    id_col: str = "_row_id",
    bucket_digits: int = BUCKET_DIGITS,
    copies_per_task: int = HEAVY_ROWS,
) -> DataFrame:
    """Add a dense long id (0, 1, 2, ...) that depends only on the row values.

    Rows are numbered in the order of the MD5 of all their columns, inside
    ``16 ** bucket_digits`` even buckets that are counted first; one shuffle brings
    the rows of a bucket together. A bucket of more than ``copies_per_task`` rows may
    hold that many equal ones: its rows are counted, placed by running sums and
    written out again, so neither a heavy key nor a heavy group of equal rows ends
    up in one task. ``rows`` is read twice: store it first if it is costly. Store the
    result if several queries use it.
    """
    columns = rows.columns
    quoted = [f"`{c}`" for c in columns]
    digest = F.md5(row_text(columns))
    marked = rows.withColumn("_bucket", F.substring(digest, 1, bucket_digits))
    sizes = settled(marked.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size")), "bucket-sizes")
    # One row per bucket.
    earlier_buckets = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = small_side(
        sizes.withColumn("_bucket_start", F.coalesce(F.sum("_size").over(earlier_buckets), F.lit(0))), "bucket-starts"
    )
    is_large = F.col("_size") > copies_per_task
    some_large = not sizes.filter(is_large).isEmpty()

    even = marked.join(starts.filter(~is_large).select("_bucket"), "_bucket", "left_semi") if some_large else marked
    # The digest is worked out again behind the shuffle, which would hardly compress it.
    in_bucket = W.partitionBy("_bucket").orderBy("_digest", *quoted)
    numbered = (
        even.repartition("_bucket")
        .withColumn("_digest", digest)
        .withColumn("_at", F.row_number().over(in_bucket) - 1)
        .join(starts, "_bucket")
        .select((F.col("_bucket_start") + F.col("_at")).alias(id_col), *quoted)
    )
    if not some_large:
        return numbered
    large = marked.join(starts.filter(is_large).select("_bucket"), "_bucket", "left_semi").select(*quoted)
    return numbered.unionByName(_numbered_copies(large, starts, digest, id_col, bucket_digits, copies_per_task))


def _numbered_copies(
    rows: DataFrame, starts: DataFrame, digest: Column, id_col: str, bucket_digits: int, copies_per_task: int
) -> DataFrame:
    """The rows of some buckets with their ids; equal rows are counted and written out again."""
    quoted = [f"`{c}`" for c in rows.columns]
    counted = settled(
        rows.groupBy(*quoted).agg(F.count(F.lit(1)).alias("_copies")).withColumn("_digest", digest), "counted-rows"
    )
    counted = counted.withColumn("_bucket", F.substring("_digest", 1, bucket_digits))
    earlier_rows = W.partitionBy("_bucket").orderBy("_digest", *quoted).rowsBetween(W.unboundedPreceding, -1)
    placed = (
        counted.withColumn("_inside", F.coalesce(F.sum("_copies").over(earlier_rows), F.lit(0)))
        .join(starts, "_bucket")
        .withColumn("_first", F.col("_bucket_start") + F.col("_inside"))
    )

    def finished(part: DataFrame, first: Column, last: Column) -> DataFrame:
        numbered = part.withColumn("_offset", F.explode(F.sequence(first, last)))
        return numbered.select((F.col("_first") + F.col("_offset")).alias(id_col), *quoted)

    zero = F.lit(0).cast("long")
    is_large = F.col("_copies") > copies_per_task
    if counted.filter(is_large).isEmpty():
        return finished(placed, zero, F.col("_copies") - 1)

    # Groups of very many copies are cut into pieces that are spread before they
    # are written out.
    placed = settled(placed, "placed-rows")
    size = F.lit(copies_per_task).cast("long")
    many = (
        placed.filter(is_large)
        .withColumn("_piece", F.explode(F.sequence(zero, F.floor((F.col("_copies") - 1) / size).cast("long"))))
        .repartition("_digest", "_piece")
    )
    piece_start = F.col("_piece") * size
    return finished(placed.filter(~is_large), zero, F.col("_copies") - 1).unionByName(
        finished(many, piece_start, F.least(piece_start + size, F.col("_copies")) - 1)
    )


def dense_index(df: DataFrame, column: str) -> DataFrame:
    """(id, idx): the distinct values of a column and their places 0, 1, 2, ... in order; nulls have none.

    The values are dealt out by ranges and sorted once, and stored with their part
    and their place in it. A part's values then count on from where the parts
    before it end, which one row per part tells.
    """
    values = df.select(F.col(column).alias("id")).filter("id IS NOT NULL").distinct()
    # The number of a row in its part, below the number of the part.
    stored = settled(
        values.repartitionByRange("id").sortWithinPartitions("id").withColumn("_at", F.monotonically_increasing_id()),
        "dense-index",
    )
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    # As many rows as there were tasks.
    starts = (
        stored.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    )
    numbered = stored.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return numbered.select("id", (F.col("_start") + place).alias("idx"))


def visits_in_order(
    visits: DataFrame,
    group: str,
    day: str,
    visit_id: str,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Number the visits of each group by (day, id) and give days since the one before.

    Adds ``visit_number`` (1, 2, ...) and ``days_since_previous`` (null for the
    first). Groups above ``heavy_rows`` visits are numbered by running sums over
    days and over blocks of ids, so no task sees more than 2 ** 20 of their
    visits. ``visit_id`` must be a unique whole number.
    """
    columns = [*visits.columns, "visit_number", "days_since_previous"]
    known = visits.filter(F.col(group).isNotNull())
    unknown = (
        visits.filter(F.col(group).isNull())
        .withColumn("visit_number", F.lit(None).cast("long"))
        .withColumn("days_since_previous", F.lit(None).cast("double"))
        .select(*columns)
    )
    heavy = small_side(
        known.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > heavy_rows).select(group),
        "heavy-groups",
    )

    in_group = W.partitionBy(group).orderBy(day, visit_id)
    ordinary = (
        known.join(heavy, group, "left_anti")
        .withColumn("visit_number", F.row_number().over(in_group).cast("long"))
        .withColumn("days_since_previous", F.datediff(F.col(day), F.lag(day).over(in_group)).cast("double"))
        .select(*columns)
    )

    if heavy.isEmpty():
        return ordinary.unionByName(unknown)
    cut = (
        known.join(heavy, group, "left_semi")
        .withColumn("_day", F.coalesce(F.col(day), F.lit("0001-01-01").cast("date")))
        .withColumn("_block", F.shiftright(F.col(visit_id), 20))
    )
    blocks = cut.groupBy(group, "_day", "_block").agg(F.count(F.lit(1)).alias("_n"))
    # One row per group and calendar day.
    day_order = W.partitionBy(group).orderBy("_day")
    days = (
        blocks.groupBy(group, "_day")
        .agg(F.sum("_n").alias("_n"))
        .withColumn("_day_start", F.coalesce(F.sum("_n").over(day_order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("_previous_day", F.lag("_day").over(day_order))
        .drop("_n")
    )
    block_order = W.partitionBy(group, "_day").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        blocks.withColumn("_block_start", F.coalesce(F.sum("_n").over(block_order), F.lit(0)))
        .drop("_n")
        .join(days, [group, "_day"])
    )
    in_block = W.partitionBy(group, "_day", "_block").orderBy(visit_id)
    in_day = F.col("_block_start") + F.row_number().over(in_block)
    no_day = F.lit("0001-01-01").cast("date")
    gap = F.when(
        F.col("_in_day") == 1,
        F.when(F.col("_previous_day") != no_day, F.datediff(F.col(day), F.col("_previous_day"))),
    ).otherwise(F.when(F.col(day).isNotNull(), F.lit(0)))
    numbered = (
        cut.join(starts, [group, "_day", "_block"])
        .withColumn("_in_day", in_day)
        .withColumn("visit_number", (F.col("_day_start") + F.col("_in_day")).cast("long"))
        .withColumn("days_since_previous", gap.cast("double"))
        .select(*columns)
    )
    return ordinary.unionByName(numbered).unionByName(unknown)


def running_totals(
    rows: DataFrame,
    group: list[str],
    order: str,
    block: str,
    amounts: dict[str, str],
) -> DataFrame:
    """Running sums per group in descending ``order``, including the current row.

    ``block`` must fall or rise together with ``order`` (equal blocks hold
    neighbouring values). Sums are first carried across the blocks of a group
    and then inside each block, so a group is split over as many tasks as it
    has blocks. ``amounts`` maps input columns to output names.
    """
    totals = rows.groupBy(*group, block).agg(*[F.sum(a).alias(f"_{a}") for a in amounts])
    across = W.partitionBy(*group).orderBy(F.desc(block)).rowsBetween(W.unboundedPreceding, -1)
    starts = totals.select(
        *group, block, *[F.coalesce(F.sum(f"_{a}").over(across), F.lit(0)).alias(f"_start_{a}") for a in amounts]
    )
    inside = W.partitionBy(*group, block).orderBy(F.desc(order)).rowsBetween(W.unboundedPreceding, 0)
    summed = rows.join(starts, [*group, block])
    for amount, name in amounts.items():
        summed = summed.withColumn(name, F.col(f"_start_{amount}") + F.sum(amount).over(inside))
    return summed.drop(*[f"_start_{a}" for a in amounts])
