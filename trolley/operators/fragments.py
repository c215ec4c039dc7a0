"""Horizontal and vertical fragments: cut, check, query and rebuild a table."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import combinations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley.functions.skew import number_rows
from trolley.functions.stats import ratio

ROW_ID = "_row_id"

# Which departments and which columns belong to which site.
HORIZONTAL_PREDICATES = {
    "site_1": ["produce", "dairy eggs", "snacks", "beverages", "frozen", "pantry"],
    "site_2": [
        "bakery",
        "canned goods",
        "deli",
        "dry goods pasta",
        "meat seafood",
        "breakfast",
        "household",
        "personal care",
        "babies",
        "international",
        "pets",
        "alcohol",
        "missing",
        "other",
        "bulk",
        "unknown",
    ],
}
VERTICAL_SCHEMA = {
    "site_1_order_info": [
        ROW_ID,
        "order_id",
        "user_id",
        "product_id",
        "order_number",
        "order_dow",
        "order_hour_of_day",
        "days_since_prior_order",
    ],
    "site_2_product_info": [
        ROW_ID,
        "order_id",
        "user_id",
        "product_id",
        "add_to_cart_order",
        "reordered",
        "department_id",
        "department",
        "product_name",
    ],
}

Fragments = dict[str, DataFrame]
# Up to so many fragments, all sets of them are compared to find the smallest that serves.
MOST_COMPARED = 10


# --- horizontal -----------------------------------------------------------


def horizontal_fragment(
    df: DataFrame,
    predicates: dict[str, list[str]] | None = None,
    column: str = "department",
) -> Fragments:
    """One fragment per site: the rows whose department is in the site's list."""
    sites = HORIZONTAL_PREDICATES if predicates is None else predicates
    return {site: df.filter(F.col(column).isin(values)) for site, values in sites.items()}


def horizontal_complement(df: DataFrame, values: list[str], column: str = "department") -> Fragments:
    """Two sites: the listed departments and all others. Null departments are in neither."""
    listed = F.col(column).isin(values)
    return {"site_1": df.filter(listed), "site_2": df.filter(~listed)}


def fragment_shares(df: DataFrame, fragments: Fragments) -> DataFrame:
    """Rows of each fragment and their percentage of the original."""
    total = df.agg(F.count(F.lit(1))).scalar()
    sizes = _labelled(fragments).groupBy("site").agg(F.count(F.lit(1)).alias("row_count"))
    return sizes.withColumn("_total", total).select(
        "site", "row_count", ratio(F.col("row_count") * 100, F.col("_total")).alias("percentage")
    )


def check_completeness(df: DataFrame, fragments: Fragments) -> DataFrame:
    """Do the fragments together hold as many rows as the original?"""
    whole = df.select(F.lit(1).alias("_whole"))
    pieces = [fragment.select(F.lit(0).alias("_whole")) for fragment in fragments.values()]
    return (
        reduce(DataFrame.unionAll, pieces, whole)
        .agg(
            F.count(F.when(F.col("_whole") == 1, 1)).alias("original_rows"),
            F.count(F.when(F.col("_whole") == 0, 1)).alias("fragment_rows"),
        )
        .withColumn("unassigned_rows", F.col("original_rows") - F.col("fragment_rows"))
        .withColumn("status", _verdict(F.col("unassigned_rows") == 0))
    )


def check_disjointness(fragments: Fragments) -> DataFrame:
    """Is there a row value that occurs in more than one fragment?

    Rows are compared by value, nulls being equal. All pairs of fragments are
    checked in one aggregation: a value is shared if its first and last site
    differ.
    """
    columns = [f"`{c}`" for c in next(iter(fragments.values())).columns]
    # Sites are numbered here: text would rule out hash aggregation.
    numbered = [fragment.withColumn("_site", F.lit(n)) for n, fragment in enumerate(fragments.values())]
    return (
        reduce(DataFrame.unionByName, numbered)
        .groupBy(*columns)
        .agg(F.min("_site").alias("_first_site"), F.max("_site").alias("_last_site"))
        .agg(F.count(F.when(F.col("_first_site") != F.col("_last_site"), 1)).alias("shared_values"))
        .withColumn("status", _verdict(F.col("shared_values") == 0))
    )


def reconstruct_horizontal(fragments: Fragments) -> DataFrame:
    return reduce(DataFrame.unionByName, fragments.values())


def distributed_query_horizontal(
    fragments: Fragments,
    query_func: Callable[[DataFrame], DataFrame],
    combine: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, Fragments]:
    """Run a query on each fragment and put the results together.

    Returns the united result, after ``combine`` if given, and the result per
    site. Nothing runs until the result is used, and then as one job.
    """
    per_site = {site: query_func(fragment) for site, fragment in fragments.items()}
    merged = reduce(DataFrame.unionByName, per_site.values())
    return (merged if combine is None else combine(merged)), per_site


def topk_local_merge(fragments: Fragments, k: int = 5) -> DataFrame:
    """Top products from the top ``k`` of each site.

    A product just below the cut in one site is missed there, so this can
    differ from the top ``k`` of the whole table.
    """

    def local(fragment: DataFrame) -> DataFrame:
        counts = fragment.groupBy("product_name").agg(F.count(F.lit(1)).alias("purchase_count"))
        return counts.orderBy(F.desc("purchase_count"), "product_name").limit(k)

    def total(merged: DataFrame) -> DataFrame:
        sums = merged.groupBy("product_name").agg(F.sum("purchase_count").alias("total_purchases"))
        return sums.orderBy(F.desc("total_purchases"), "product_name").limit(k)

    return distributed_query_horizontal(fragments, local, total)[0]


def avg_weighted_merge(fragments: Fragments) -> DataFrame:
    """Reorder rate per department from sums and counts of non-null values per site."""

    def local(fragment: DataFrame) -> DataFrame:
        return fragment.groupBy("department").agg(
            F.sum("reordered").alias("_sum"), F.count("reordered").alias("_n")
        )

    def total(merged: DataFrame) -> DataFrame:
        return (
            merged.groupBy("department")
            .agg(ratio(F.sum("_sum"), F.sum("_n")).alias("avg_reorder_rate"))
            .orderBy(F.desc("avg_reorder_rate"), "department")
        )

    return distributed_query_horizontal(fragments, local, total)[0]


# --- vertical -------------------------------------------------------------


def add_row_id(df: DataFrame) -> DataFrame:
    """Give each row a key that is the same whenever and wherever it is computed.

    Fragments are computed apart from each other, so a key that depends on row
    order or partitioning could pair wrong rows when they are joined.
    """
    return number_rows(df, ROW_ID)


def vertical_fragment(df: DataFrame, schema: dict[str, list[str]] | None = None) -> Fragments:
    """One fragment per site with the listed columns that exist. Adds the row key if absent."""
    sites = VERTICAL_SCHEMA if schema is None else schema
    keyed = df if ROW_ID in df.columns else add_row_id(df)
    return {site: keyed.select(*[c for c in columns if c in keyed.columns]) for site, columns in sites.items()}


def check_column_coverage(df: DataFrame, fragments: Fragments) -> DataFrame:
    """Is every column of the original in some fragment? Rows are counted along the way."""
    held = {c for fragment in fragments.values() for c in fragment.columns}
    missing = [c for c in df.columns if c not in held]
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count",
        F.lit(len(df.columns)).alias("original_columns"),
        F.lit(len(missing)).alias("missing_columns"),
        F.lit(",".join(missing)).alias("missing"),
        F.lit(_word(not missing)).alias("status"),
    )


def check_lossless_key(fragments: Fragments) -> DataFrame:
    """Per site: is the row key there, and is it unique?

    Dense keys need no distinct count, but the check must not assume them, so
    repeated keys are found by counting.
    """
    checks = []
    for site, fragment in fragments.items():
        present = ROW_ID in fragment.columns
        keys = fragment.select(F.col(ROW_ID) if present else F.lit(None).cast("long").alias(ROW_ID))
        # One row per site, so that buckets by the key serve until then.
        checks.append(
            keys.groupBy(ROW_ID)
            .agg(F.count(F.lit(1)).alias("_n"))
            .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"), F.count(ROW_ID).alias("distinct_keys"))
            .select(F.lit(site).alias("site"), F.lit(present).alias("has_key"), "row_count", "distinct_keys")
        )
    unique = F.col("has_key") & (F.col("row_count") == F.col("distinct_keys"))
    return reduce(DataFrame.unionByName, checks).withColumn("status", _verdict(unique))


def reconstruct_vertical(fragments: Fragments, columns: list[str] | None = None) -> DataFrame:
    """Join all fragments on the row key; shared columns are taken once, the key is dropped."""
    joined = _join_on_key(list(fragments.values()), None)
    return joined.select(*(columns or [c for c in joined.columns if c != ROW_ID]))


def distributed_query_vertical(
    fragments: Fragments,
    query_cols: list[str],
    filter_expr: Column | str | None = None,
    filter_cols: list[str] | None = None,
) -> DataFrame:
    """Select columns, and filter, across fragments.

    The smallest set of fragments that holds all columns is joined; one
    fragment alone needs no join. The filter may use columns that are not
    selected; they are found from the expression unless ``filter_cols`` names
    them.
    """
    condition = F.expr(filter_expr) if isinstance(filter_expr, str) else filter_expr
    used = filter_cols or ([] if condition is None else _columns_of(condition, fragments))
    needed = list(dict.fromkeys([*query_cols, *used]))
    chosen = _smallest_cover(fragments, needed)
    result = chosen[0] if len(chosen) == 1 else _join_on_key(chosen, needed)
    if condition is not None:
        result = result.filter(condition)
    return result.select(*query_cols)


def _join_on_key(parts: list[DataFrame], needed: list[str] | None) -> DataFrame:
    joined = None
    for part in parts:
        held = [] if joined is None else joined.columns
        extra = [c for c in part.columns if c != ROW_ID and c not in held and (needed is None or c in needed)]
        part = part.select(ROW_ID, *extra)
        joined = part if joined is None else joined.join(part, ROW_ID)
    return joined


def _smallest_cover(fragments: Fragments, needed: list[str]) -> list[DataFrame]:
    held = {c for fragment in fragments.values() for c in fragment.columns}
    unknown = [c for c in needed if c not in held]
    if unknown:
        raise ValueError(f"in no fragment: {unknown}")
    if len(fragments) <= MOST_COMPARED:
        for size in range(1, len(fragments) + 1):
            for sites in combinations(fragments.values(), size):
                if set(needed) <= {c for fragment in sites for c in fragment.columns}:
                    return list(sites)
    # Too many sets to try: take the fragment that adds most, again and again.
    chosen, left = [], set(needed)
    while left:
        best = max(fragments.values(), key=lambda fragment: len(left & set(fragment.columns)))
        chosen.append(best)
        left -= set(best.columns)
    return chosen or [next(iter(fragments.values()))]


def _columns_of(condition: Column, fragments: Fragments) -> list[str]:
    """The columns a condition needs: those without which it cannot be resolved."""
    fields = {f.name: f for fragment in fragments.values() for f in fragment.schema.fields}
    session = next(iter(fragments.values())).sparkSession

    def blank(without: str | None = None) -> DataFrame:
        return session.createDataFrame([], T.StructType([f for n, f in fields.items() if n != without]))

    def resolves(without: str) -> bool:
        try:
            blank(without).filter(condition).schema
        except AnalysisException:
            return False
        return True

    blank().filter(condition).schema  # a column of no fragment fails here
    return [name for name in fields if not resolves(name)]


def _labelled(fragments: Fragments) -> DataFrame:
    return reduce(
        DataFrame.unionByName, [fragment.withColumn("site", F.lit(site)) for site, fragment in fragments.items()]
    )


def _word(passed: bool) -> str:
    return "PASS" if passed else "FAIL"


def _verdict(passed: Column) -> Column:
    return F.when(passed, F.lit("PASS")).otherwise(F.lit("FAIL"))
