"""The catalogue of queries over the relation and its fragments.

Each function takes fragments as DataFrames. A site's own numbers and the
merged numbers of several sites use the same building blocks. Every top-k
breaks ties by the smaller name or id, so results repeat.
"""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trolley.functions.stats import ratio, rounded_ratio
from trolley.operators.fragments import (
    ROW_ID,
    Fragments,
    distributed_query_horizontal,
    reconstruct_horizontal,
)

# --- views and free SQL ---------------------------------------------------


def register_views(relation: DataFrame, horizontal: Fragments, vertical: Fragments) -> list[str]:
    """Register temp views: ``global_relation``, ``h_<site>`` and ``v_<site>``.

    A vertical site named ``site_1_order_info`` is also reachable as
    ``v_site_1``; two sites that claim one name are an error.
    """
    views = {"global_relation": relation}
    views.update({f"h_{site}": fragment for site, fragment in horizontal.items()})
    for site, fragment in vertical.items():
        for name in dict.fromkeys((f"v_{site}", "v_" + "_".join(site.split("_")[:2]))):
            if name in views:
                raise ValueError(f"two sites would be called {name}")
            views[name] = fragment
    for name, frame in views.items():
        frame.createOrReplaceTempView(name)
    return list(views)


def run_sql(spark: SparkSession, text: str, max_rows: int | None = None) -> DataFrame:
    """Run one SQL text; all rows unless the caller wants fewer."""
    result = spark.sql(text)
    return result if max_rows is None else result.limit(max_rows)


def run_sql_or_error(spark: SparkSession, text: str, max_rows: int | None = None) -> tuple[DataFrame | None, str | None]:
    """The result of one SQL text, or else what is wrong with the text, as for a query page."""
    try:
        return run_sql(spark, text, max_rows), None
    except PySparkException as error:
        return None, str(error)


# --- building blocks ------------------------------------------------------


def product_counts(fragment: DataFrame) -> DataFrame:
    return fragment.groupBy("product_name").agg(F.count(F.lit(1)).alias("purchase_count"))


def department_sums(fragment: DataFrame) -> DataFrame:
    return fragment.groupBy("department").agg(
        F.sum("reordered").alias("reorders"), F.count("reordered").alias("known"), F.count(F.lit(1)).alias("total")
    )


def top(counts: DataFrame, by: str, k: int, *ties: str) -> DataFrame:
    return counts.orderBy(F.desc(by), *ties).limit(k)


# --- horizontal: one site and merged --------------------------------------


def top_site_products(fragment: DataFrame, k: int = 5) -> DataFrame:
    return top(product_counts(fragment), "purchase_count", k, "product_name")


def top_site_products_named(fragment: DataFrame, site: str, k: int = 5) -> DataFrame:
    return top_site_products(fragment, k).select(F.lit(site).alias("site"), "product_name", "purchase_count")


def top_products_merged(fragments: Fragments, k: int = 5) -> DataFrame:
    """Exact top products: full counts per site, then their sums."""

    def total(merged: DataFrame) -> DataFrame:
        sums = merged.groupBy("product_name").agg(F.sum("purchase_count").alias("total_purchases"))
        return top(sums, "total_purchases", k, "product_name")

    return distributed_query_horizontal(fragments, product_counts, total)[0]


def reorder_rate_merged(fragments: Fragments) -> DataFrame:
    def total(merged: DataFrame) -> DataFrame:
        rate = ratio(F.sum("reorders"), F.sum("known")).alias("avg_reorder_rate")
        return merged.groupBy("department").agg(rate).orderBy(F.desc("avg_reorder_rate"), "department")

    return distributed_query_horizontal(fragments, department_sums, total)[0]


def reconstructed_rows(fragments: Fragments) -> DataFrame:
    return reconstruct_horizontal(fragments).agg(F.count(F.lit(1)).alias("total_rows"))


def top_departments_centralized(relation: DataFrame, k: int = 5) -> DataFrame:
    sums = department_sums(relation).select(
        "department", F.col("total").alias("cnt"), ratio(F.col("reorders"), F.col("known")).alias("avg_reorder")
    )
    return top(sums, "cnt", k, "department")


def top_departments_distributed(fragments: Fragments, k: int = 5) -> DataFrame:
    def total(merged: DataFrame) -> DataFrame:
        sums = merged.groupBy("department").agg(
            F.sum("total").alias("cnt"), ratio(F.sum("reorders"), F.sum("known")).alias("avg_reorder")
        )
        return top(sums, "cnt", k, "department")

    return distributed_query_horizontal(fragments, department_sums, total)[0]


def fragment_row_counts(relation: DataFrame, fragments: Fragments) -> DataFrame:
    """Rows of each horizontal fragment and of the whole relation."""
    parts = {f"h_{site}": fragment for site, fragment in fragments.items()} | {"global_relation": relation}
    result = None
    for name, frame in parts.items():
        counted = frame.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("fragment"), "row_count")
        result = counted if result is None else result.unionByName(counted)
    return result


def department_stats(fragment: DataFrame) -> DataFrame:
    return (
        department_sums(fragment)
        .select(
            "department",
            F.col("total").alias("total_orders"),
            rounded_ratio(F.col("reorders"), F.col("known"), 4).alias("reorder_rate"),
            F.col("reorders").alias("total_reorders"),
        )
        .orderBy(F.desc("total_orders"), "department")
    )


def hourly_orders(fragment: DataFrame) -> DataFrame:
    return (
        fragment.groupBy(F.col("order_hour_of_day").alias("hour"))
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            rounded_ratio(F.sum("reordered"), F.count("reordered"), 3).alias("reorder_rate"),
        )
        .orderBy("hour")
    )


def weekday_orders(fragment: DataFrame) -> DataFrame:
    return (
        fragment.groupBy(F.col("order_dow").alias("day_of_week"))
        .agg(F.count(F.lit(1)).alias("orders"), F.countDistinct("user_id").alias("unique_users"))
        .orderBy("day_of_week")
    )


def most_reordered_products(fragment: DataFrame, more_than: int = 50, k: int = 10) -> DataFrame:
    counts = (
        fragment.groupBy("product_name")
        .agg(F.sum("reordered").alias("reorder_count"), F.count(F.lit(1)).alias("total"))
        .filter(F.col("total") > more_than)
        .withColumn("reorder_pct", rounded_ratio(F.col("reorder_count"), F.col("total"), 1, scale=100))
    )
    return top(counts, "reorder_pct", k, "product_name")


def cart_positions(fragment: DataFrame, k: int = 15) -> DataFrame:
    return (
        fragment.filter(F.col("add_to_cart_order").isNotNull())
        .groupBy(F.col("add_to_cart_order").alias("cart_position"))
        .agg(
            F.count(F.lit(1)).alias("frequency"),
            rounded_ratio(F.sum("reordered"), F.count("reordered"), 3).alias("reorder_rate"),
        )
        .orderBy("cart_position")
        .limit(k)
    )


def department_reorder_percent(fragment: DataFrame) -> DataFrame:
    return (
        department_sums(fragment)
        .select(
            "department",
            "total",
            "reorders",
            rounded_ratio(F.col("reorders"), F.col("total"), 2, scale=100).alias("reorder_pct"),
        )
        .orderBy(F.desc("reorder_pct"), "department")
    )


def product_variety(fragment: DataFrame) -> DataFrame:
    return (
        fragment.groupBy("department")
        .agg(F.countDistinct("product_name").alias("unique_products"), F.count(F.lit(1)).alias("total_orders"))
        .withColumn("orders_per_product", rounded_ratio(F.col("total_orders"), F.col("unique_products"), 1))
        .orderBy(F.desc("unique_products"), "department")
    )


# --- vertical: one site and joined ----------------------------------------


def first_rows(fragment: DataFrame, k: int = 10) -> DataFrame:
    return fragment.orderBy(ROW_ID).limit(k)


# Keys that are sent to both fragments as a list; above it they are joined in full.
MOST_KEYS = 4096


def joined_sample(left: DataFrame, right: DataFrame, columns: list[str], k: int) -> DataFrame:
    """The first ``k`` joined rows by row key.

    The smallest keys are taken from the left fragment's key column alone, and only
    their rows are read from both. If keys are missing on the right, more are
    taken, up to ``MOST_KEYS``.
    """
    held_left = [c for c in columns if c in left.columns]
    rest = [c for c in columns if c not in held_left]

    def matched(few_left: DataFrame, few_right: DataFrame) -> DataFrame:
        held = few_left.select(ROW_ID, *[c for c in held_left if c in few_left.columns])
        return held.join(few_right.select(ROW_ID, *[c for c in rest if c in few_right.columns]), ROW_ID).orderBy(ROW_ID).limit(k)

    wanted = 2 * k
    while wanted <= MOST_KEYS:
        rows = left.select(ROW_ID).filter(F.col(ROW_ID).isNotNull()).orderBy(ROW_ID).limit(wanted).collect()
        among = F.col(ROW_ID).isin(sorted({row[ROW_ID] for row in rows})) if rows else F.lit(False)
        few_left, few_right = left.filter(among), right.filter(among)
        if len(rows) < wanted or matched(few_left.select(ROW_ID), few_right.select(ROW_ID)).count() >= k:
            return matched(few_left, few_right).select(*columns)
        wanted *= 8
    return matched(left, right).select(*columns)


def morning_purchases(order_info: DataFrame, product_info: DataFrame, before_hour: int = 10) -> DataFrame:
    early = order_info.filter(F.col("order_hour_of_day") < before_hour).select(ROW_ID)
    return (
        early.join(product_info.select(ROW_ID, "department"), ROW_ID)
        .groupBy("department")
        .agg(F.count(F.lit(1)).alias("morning_purchases"))
        .orderBy(F.desc("morning_purchases"), "department")
    )


def department_rates(fragment: DataFrame) -> DataFrame:
    return (
        department_sums(fragment)
        .select(
            "department",
            ratio(F.col("reorders"), F.col("known")).alias("reorder_rate"),
            F.col("total").alias("total_items"),
        )
        .orderBy(F.desc("reorder_rate"), "department")
    )


def reconstructed_keys(order_info: DataFrame, product_info: DataFrame) -> DataFrame:
    joined = order_info.select(ROW_ID).join(product_info.select(ROW_ID), ROW_ID)
    return joined.agg(F.count(F.lit(1)).alias("total_rows"), F.countDistinct(ROW_ID).alias("unique_keys"))


def most_active_users(fragment: DataFrame, k: int = 10) -> DataFrame:
    counts = (
        fragment.filter(F.col("days_since_prior_order").isNotNull())
        .groupBy("user_id")
        .agg(
            F.countDistinct("order_id").alias("order_count"),
            rounded_ratio(F.sum(F.col("days_since_prior_order").cast("decimal(28,6)")), F.count(F.lit(1)), 1).alias("avg_days_between_orders"),
        )
    )
    return top(counts, "order_count", k, "user_id")


def order_pattern(fragment: DataFrame, k: int = 15) -> DataFrame:
    counts = fragment.groupBy(F.col("order_dow").alias("day"), F.col("order_hour_of_day").alias("hour")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    return top(counts, "orders", k, "day", "hour")


def product_rank_in_department(fragment: DataFrame, more_than: int = 30, k: int = 20) -> DataFrame:
    """Rank of products by reorders within their department; the first ``k`` rows.

    Only the first ``k`` products of a department can be among the first ``k``
    rows, and the rank of each depends only on products before it. So each task
    keeps ``k`` products per department before any are brought together.
    """
    counts = (
        fragment.groupBy("product_name", "department")
        .agg(F.count(F.lit(1)).alias("total_purchases"), F.sum("reordered").alias("reorders"))
        .filter(F.col("total_purchases") > more_than)
        .withColumn("reorder_pct", rounded_ratio(F.col("reorders"), F.col("total_purchases"), 1, scale=100))
    )
    in_department = W.partitionBy("department")
    first = counts.withColumn(
        "_place", F.row_number().over(in_department.orderBy(F.desc("reorders"), "product_name"))
    ).filter(F.col("_place") <= k)
    return (
        first.withColumn("dept_rank", F.rank().over(in_department.orderBy(F.desc("reorders"))))
        .drop("_place")
        .orderBy("department", "dept_rank", "product_name")
        .limit(k)
    )


def top_department_rates(fragment: DataFrame, k: int = 10) -> DataFrame:
    rates = department_sums(fragment).select(
        "department", rounded_ratio(F.col("reorders"), F.col("known"), 4).alias("reorder_rate"), "total"
    )
    return top(rates, "reorder_rate", k, "department")


def morning_rates(
    order_info: DataFrame, product_info: DataFrame, from_hour: int = 6, to_hour: int = 10, k: int = 10
) -> DataFrame:
    early = order_info.filter(F.col("order_hour_of_day").between(from_hour, to_hour)).select(ROW_ID)
    counts = (
        early.join(product_info.select(ROW_ID, "department", "reordered"), ROW_ID)
        .groupBy("department")
        .agg(
            F.count(F.lit(1)).alias("morning_purchases"),
            rounded_ratio(F.sum("reordered"), F.count("reordered"), 3).alias("reorder_rate"),
        )
    )
    return top(counts, "morning_purchases", k, "department")
