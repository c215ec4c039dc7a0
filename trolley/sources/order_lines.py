"""The order-line relation: one row per product in an order.

It is built from the tables ``lineitem``, ``orders`` and ``part``. Every line
is kept; a line whose order or part is missing has nulls in those columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trolley.functions.skew import HEAVY_ROWS, small_side, spread_lookup, visits_in_order
from trolley.sources.storage import settled

COLUMNS = [
    "order_id",
    "user_id",
    "order_number",
    "order_dow",
    "order_hour_of_day",
    "days_since_prior_order",
    "product_id",
    "add_to_cart_order",
    "reordered",
    "department_id",
    "department",
    "product_name",
]
# Not part of the relation itself; used for weekly series.
EXTRA_COLUMNS = ["order_date"]

_FROM_PART = {"department", "product_name"}
_FROM_ORDER = {"user_id", "order_number", "days_since_prior_order", "order_date"}
_FROM_HISTORY = {"order_number", "days_since_prior_order"}
# Worked out from another column of the line once it lies where it is wanted, so that no shuffle carries them.
_DERIVED = {
    # The order dates carry no time of day; an hour is made from the key.
    "order_hour_of_day": ("order_id", "CAST(pmod(order_id, 24) AS int)"),
    # Sunday is 0.
    "order_dow": ("order_date", "CAST(dayofweek(order_date) - 1 AS int)"),
    "department_id": ("department", "try_cast(substring_index(department, '#', -1) AS int)"),
}


def load_order_lines(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """The relation from the Parquet tables in ``folder``."""
    tables = [spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet") for name in ("lineitem", "orders", "part")]
    return order_lines(*tables, columns=list(columns) or None)


def order_lines(
    lineitem: DataFrame,
    orders: DataFrame,
    part: DataFrame,
    columns: list[str] | None = None,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Build the given columns of the relation (default: all twelve).

    The other tables are joined one row per key from the left, so leaving out a
    join whose columns are not asked for changes no row. With ``reordered``,
    the joined lines are stored on the way.
    """
    wanted = columns or COLUMNS
    unknown = set(wanted) - set(COLUMNS) - set(EXTRA_COLUMNS)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    needed = {_DERIVED[c][0] if c in _DERIVED else c for c in wanted}
    if "reordered" in needed:
        needed |= {"user_id", "order_number", "product_name"}

    lines = lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_linenumber").cast("int").alias("add_to_cart_order"),
    )
    if needed & _FROM_ORDER:
        facts = _order_facts(orders, needed, heavy_rows)
        lines = lines.join(facts, "order_id", "left")
    if needed & _FROM_PART:
        lines = lines.join(_part_facts(part), "product_id", "left")
    if "reordered" in needed:
        lines = _with_reordered(lines, needed, heavy_rows)
    return lines.select(*[F.expr(_DERIVED[c][1]).alias(c) if c in _DERIVED else c for c in wanted])


def _order_facts(orders: DataFrame, needed: set[str], heavy_rows: int) -> DataFrame:
    facts = orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
    )
    if needed & _FROM_HISTORY:
        facts = visits_in_order(facts, "user_id", "order_date", "order_id", heavy_rows)
        facts = facts.withColumns(
            {
                "order_number": F.col("visit_number").cast("int"),
                "days_since_prior_order": F.col("days_since_previous"),
            }
        ).drop("visit_number", "days_since_previous")
    return facts


def _part_facts(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("department"),
    )


def _with_reordered(lines: DataFrame, needed: set[str], heavy_rows: int) -> DataFrame:
    """1 if the user bought a product of the same name in an earlier order.

    The lines of a user and name meet in one shuffle. Only a user with more than
    ``heavy_rows`` lines can have more with one name, so the lines of such users look up
    their first purchases instead.
    """
    keys = ["user_id", "product_name"]
    # Used for the users' sizes and for the first purchases: join the tables once.
    carried = [c for c in lines.columns if c in needed or c in ("order_id", "product_id", "add_to_cart_order")]
    lines = settled(lines.select(*carried), "joined-lines")
    complete = F.col("user_id").isNotNull() & F.col("product_name").isNotNull()
    known = lines.filter(complete)
    busy = small_side(
        known.groupBy("user_id").agg(F.count(F.lit(1)).alias("_lines")).filter(F.col("_lines") > heavy_rows).select("user_id"),
        "busy-users",
    )
    some_busy = not busy.isEmpty()
    ordinary = known.join(busy, "user_id", "left_anti") if some_busy else known
    first = F.min("order_number").over(W.partitionBy(*keys))
    found = ordinary.withColumn("_first_order", first).unionByName(
        lines.filter(~complete).withColumn("_first_order", F.lit(None).cast("int"))
    )
    if some_busy:
        theirs = known.join(busy, "user_id", "left_semi")
        firsts = theirs.groupBy(*keys).agg(
            F.min("order_number").alias("_first_order"),
            F.count(F.lit(1)).alias("_lines"),
        )
        found = found.unionByName(spread_lookup(theirs, firsts, keys, ["_first_order"], "_lines", heavy_rows))
    again = F.coalesce(F.col("order_number") > F.col("_first_order"), F.lit(False))
    return found.withColumn("reordered", again.cast("int"))
