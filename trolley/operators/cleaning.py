"""Profiling and cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.functions.hashing import row_text
from trolley.functions.stats import approx_quantiles, exact_quantiles

KEY_COLUMNS = ["order_id", "user_id", "product_id"]
# Keys are 64-bit: narrower ids would turn into nulls on a large table.
ID_TYPES = {"order_id": "bigint", "user_id": "bigint", "product_id": "bigint", "department_id": "int"}


def null_profile(df: DataFrame) -> DataFrame:
    """(column_name, nulls) for the columns that hold nulls, in one scan."""
    counts = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in df.columns])
    return counts.select(F.inline(pairs)).filter(F.col("nulls") > 0)


def null_cause_orders(df: DataFrame) -> DataFrame:
    """The order numbers at which the days since the prior order are missing."""
    return df.filter(F.col("days_since_prior_order").isNull()).select("order_number").distinct()


def impute_median(df: DataFrame, column: str = "days_since_prior_order", exact: bool = True) -> DataFrame:
    """Fill nulls with the median; a column without values stays null."""
    quantiles = exact_quantiles if exact else approx_quantiles
    median = F.lit(quantiles(df, column, {"median": 0.5}).first()["median"]).cast(dict(df.dtypes)[column])
    return df.withColumn(column, F.coalesce(F.col(column), median))


def impute_sentinel(df: DataFrame, column: str = "days_since_prior_order", value: float = -1.0) -> DataFrame:
    return df.fillna({column: value})


def impute_unknown(df: DataFrame, columns: tuple[str, ...] = ("department", "product_name")) -> DataFrame:
    return df.fillna({c: "unknown" for c in columns if c in df.columns})


def drop_null_keys(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    return df.dropna(subset=keys or [c for c in KEY_COLUMNS if c in df.columns])


def cast_ids(df: DataFrame, types: dict[str, str] | None = None) -> DataFrame:
    """Cast the id columns that are present; text that is no number becomes null."""
    present = {c: t for c, t in (types or ID_TYPES).items() if c in df.columns}
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in present.items()})


def clean_data(df: DataFrame, exact_median: bool = True) -> DataFrame:
    """Fill missing days and names, drop rows without keys, cast the ids."""
    if "days_since_prior_order" in df.columns:
        df = impute_median(df, exact=exact_median)
    return cast_ids(drop_null_keys(impute_unknown(df)))


def cleaning_report(df: DataFrame) -> DataFrame:
    """Rows before and after cleaning, in one scan of the keys."""
    keys = [F.col(c).isNotNull() for c in KEY_COLUMNS if c in df.columns]
    kept = F.lit(True)
    for key in keys:
        kept = kept & key
    return df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count(F.when(kept, 1)).alias("rows_after"),
    ).withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


def quartiles(df: DataFrame, column: str, exact: bool = True) -> DataFrame:
    quantiles = exact_quantiles if exact else approx_quantiles
    return quantiles(df, column, {"q1": 0.25, "q3": 0.75})


def iqr_outlier_report(df: DataFrame, column: str = "add_to_cart_order", exact: bool = True) -> DataFrame:
    """Quartiles, the upper fence Q3 + 1.5 IQR, and how many values lie above it.

    The outliers themselves stay in the data.
    """
    found = quartiles(df, column, exact).first()
    q1, q3 = (F.lit(found[q]).cast("double") for q in ("q1", "q3"))
    value = F.col(column).cast("double")
    fence = q3 + F.lit(1.5) * (q3 - q1)
    return df.agg(
        F.max(value).alias("max_value"),
        F.count(F.when(value > fence, 1)).alias("outliers"),
    ).select(q1.alias("q1"), q3.alias("q3"), (q3 - q1).alias("iqr"), fence.alias("threshold"), "max_value", "outliers")


def relation_sample(df: DataFrame, rows: int = 10) -> DataFrame:
    """A few rows to look at: those with the smallest digests of all their values."""
    columns = [f"`{c}`" for c in df.columns]
    return df.orderBy(F.md5(row_text(df.columns)), *columns).limit(rows)


def relation_profile(df: DataFrame) -> DataFrame:
    """Row and column counts."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn("column_count", F.lit(len(df.columns)))
