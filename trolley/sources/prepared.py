"""The order-line relation, built once and stored for the queries that follow.

Building the relation takes joins and windows over whole tables. Queries that
all start from it read a stored copy instead, of which Spark then scans only
the columns they use. Copies lie in the shared folder, so they outlive lost
executors. A copy serves one Spark session and is built again if the tables
change.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.operators.fragments import ROW_ID, add_row_id
from trolley.sources.order_lines import COLUMNS, EXTRA_COLUMNS, load_order_lines
from trolley.sources.storage import (
    drop_bucketed,
    files_of,
    load_parquet,
    new_shared_folder,
    save_bucketed,
    save_horizontal,
    settled,
    wide_shuffles,
)

TABLES = ("lineitem", "orders", "part")

_stored: dict[tuple, tuple[tuple, DataFrame]] = {}
# With the session, so that its id cannot be given to another one.
_fitted: dict[tuple, tuple[tuple, Any, SparkSession]] = {}


def stored_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The relation with the order date."""

    def store() -> DataFrame:
        with wide_shuffles(*[load_parquet(spark, f"{folder.rstrip('/')}/{table}.parquet") for table in TABLES]):
            return settled(load_order_lines(spark, folder, *COLUMNS, *EXTRA_COLUMNS), "lines")

    return stored_once(spark, folder, "lines", store)


def stored_keyed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The relation with its row key, from which vertical fragments are cut.

    The table is bucketed by the key, so joining fragments on it moves no rows.
    """

    def store() -> DataFrame:
        lines = stored_lines(spark, folder).select(*COLUMNS)
        with wide_shuffles(lines):
            return save_bucketed(add_row_id(lines), new_shared_folder(spark, "keyed-lines"), ROW_ID)

    return stored_once(spark, folder, "keyed-lines", store)


def stored_sites(spark: SparkSession, folder: str, sites: dict[str, list[str]]) -> dict[str, DataFrame]:
    """The relation's horizontal fragments, stored in one table partitioned by site."""

    def store() -> DataFrame:
        path = new_shared_folder(spark, "sites")
        save_horizontal(stored_lines(spark, folder).select(*COLUMNS), sites, path)
        return spark.read.parquet(f"{path}/fragments_horizontal")

    whole = stored_once(spark, folder, f"sites {sorted(sites.items())}", store)
    return {site: whole.filter(F.col("site") == site).drop("site") for site in sites}


def stored_once(spark: SparkSession, folder: str, kind: str, store: Callable[[], DataFrame]) -> DataFrame:
    """The table that ``store`` stores and returns, kept for this session until a file of the tables changes."""
    # The stored DataFrame keeps its session, so the id cannot be given to another one.
    key = (spark.sparkContext.applicationId, id(spark), kind, folder)
    state = _state(spark, folder)
    if key not in _stored or _stored[key][0] != state:
        if key in _stored:
            _drop(spark, _stored.pop(key)[1])
        _stored[key] = (state, store())
    return _stored[key][1]


def fitted_once(spark: SparkSession, folder: str, kind: str, fit: Callable[[], Any]) -> Any:
    """What ``fit`` returns, a model for example, kept as ``stored_once`` keeps tables."""
    key = (spark.sparkContext.applicationId, id(spark), kind, folder)
    state = _state(spark, folder)
    if key not in _fitted or _fitted[key][0] != state:
        _fitted[key] = (state, fit(), spark)
    return _fitted[key][1]


def _state(spark: SparkSession, folder: str) -> tuple:
    return tuple(file for table in TABLES for file in files_of(spark, f"{folder.rstrip('/')}/{table}.parquet"))


def forget(spark: SparkSession) -> None:
    """Drop all stored copies of this session."""
    for key in [k for k in _stored if k[:2] == (spark.sparkContext.applicationId, id(spark))]:
        _drop(spark, _stored.pop(key)[1])
    for key in [k for k in _fitted if k[:2] == (spark.sparkContext.applicationId, id(spark))]:
        del _fitted[key]


def _drop(spark: SparkSession, table: DataFrame) -> None:
    for file in {name.rsplit("/", 1)[0].split("/fragments_horizontal")[0] for name in table.inputFiles()}:
        drop_bucketed(spark, file)
