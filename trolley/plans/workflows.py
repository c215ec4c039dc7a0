"""Whole analyses from order lines to results, composed of the operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from trolley.operators import (
    cleaning,
    clustering,
    eda,
    features,
    forecast,
    fragments,
    mining,
    neighbours,
    neural,
    recommend,
)
from trolley.plans import catalog
from trolley.sources import storage


@dataclass
class FragmentStore:
    """The relation and its fragments, as stored."""

    relation: DataFrame
    horizontal: dict[str, DataFrame]
    vertical: dict[str, DataFrame]


def bootstrap_fragments(
    spark: SparkSession,
    output_dir: str,
    lines: DataFrame | None = None,
    predicates: dict[str, list[str]] | None = None,
    schema: dict[str, list[str]] | None = None,
) -> FragmentStore:
    """Load stored fragments; where they are missing, clean ``lines``, cut and store them.

    The row key is stored with the cleaned table, so all vertical fragments
    are cut from the same keys. Views are registered for all tables.
    """
    predicates = predicates or fragments.HORIZONTAL_PREDICATES
    schema = schema or fragments.VERTICAL_SCHEMA
    cleaned_path = f"{output_dir.rstrip('/')}/cleaned_data.parquet"
    complete = (
        storage.is_complete(spark, cleaned_path)
        and storage.stored_sites(spark, output_dir, "horizontal") >= set(predicates)
        and storage.stored_sites(spark, output_dir, "vertical") >= set(schema)
    )
    if not complete:
        if lines is None:
            raise ValueError(f"no fragments in {output_dir} and no lines to cut them from")
        storage.save_parquet(fragments.add_row_id(cleaning.clean_data(lines)), cleaned_path)
        keyed = storage.load_parquet(spark, cleaned_path)
        whole = keyed.drop(fragments.ROW_ID)
        storage.save_horizontal(whole, predicates, output_dir)
        storage.save_fragments(fragments.vertical_fragment(keyed, schema), output_dir, "vertical")
    horizontal = storage.load_fragments(spark, output_dir, "horizontal", list(predicates))
    vertical = storage.load_fragments(spark, output_dir, "vertical", list(schema))
    relation = storage.load_parquet(spark, cleaned_path).drop(fragments.ROW_ID)
    catalog.register_views(relation, horizontal, vertical)
    return FragmentStore(relation, horizontal, vertical)


def eda_workflow(lines: DataFrame, output_dir: str, sample_frac: float = 1.0) -> dict[str, DataFrame]:
    """Clean, build features, explore, mine; store the cleaned data and the feature tables."""
    spark = lines.sparkSession
    root = output_dir.rstrip("/")
    storage.save_parquet(cleaning.clean_data(lines), f"{root}/cleaned_data.parquet")
    cleaned = storage.load_parquet(spark, f"{root}/cleaned_data.parquet")
    tables = {
        "user_features": features.build_user_features(cleaned),
        "order_features": features.build_order_features(cleaned),
    }
    for name, table in tables.items():
        storage.save_parquet(table, f"{root}/{name}.parquet")
        tables[name] = storage.load_parquet(spark, f"{root}/{name}.parquet")
    itemsets, rules = mining.run_fpgrowth(cleaned, sample_frac=sample_frac)
    return {"cleaned_data": cleaned, **tables, **eda.run_eda(cleaned), "itemsets": itemsets, "rules": rules}


def training_workflow(
    cleaned: DataFrame, weekly: DataFrame, users: int | None = None, products: int = 200
) -> dict[str, DataFrame | float]:
    """Segments, recommenders and forecasts with their quality.

    ``weekly`` is the result of :func:`trolley.operators.forecast.weekly_sales`.
    """
    scaled = clustering.scaled_features(storage.settled(features.build_rfm(cleaned), "rfm"))
    best, clustered = clustering.kmeans_best(scaled)
    forecasts = forecast.arima_forecast(forecast.time_split(weekly))
    items = neighbours.catalogue(cleaned, products)
    # Both recommenders over the catalogue start from these.
    bought = items, storage.settled(neighbours.bought_items(cleaned, items), "bought-items", "user_id")
    return {
        "clusters": clustered,
        "cluster_summary": clustering.cluster_summary(clustered),
        "davies_bouldin": clustering.davies_bouldin(clustered),
        "silhouette": best.silhouette,
        "als_rmse": recommend.run_als(cleaned, users, None)[1],
        "knn": neighbours.run_knn_recommender(cleaned, users, products, bought),
        "ncf": neural.run_ncf(cleaned, users, products, bought=bought),
        "forecasts": forecasts,
        "forecast_rmse": forecast.forecast_rmse(forecasts),
    }


def fragmentation_workflow(
    cleaned: DataFrame,
    output_dir: str,
    predicates: dict[str, list[str]] | None = None,
    schema: dict[str, list[str]] | None = None,
) -> dict[str, DataFrame]:
    """Cut, check, query and rebuild the relation both ways; store the fragments."""
    spark = cleaned.sparkSession
    sites = predicates or fragments.HORIZONTAL_PREDICATES
    keyed = storage.settled(fragments.add_row_id(cleaned), "keyed-lines")
    vertical = fragments.vertical_fragment(keyed, schema)
    storage.save_horizontal(cleaned, sites, output_dir)
    storage.save_fragments(vertical, output_dir, "vertical")
    horizontal = storage.load_fragments(spark, output_dir, "horizontal", list(sites))
    vertical = storage.load_fragments(spark, output_dir, "vertical", list(vertical))
    return {
        "shares": fragments.fragment_shares(cleaned, horizontal),
        "completeness": fragments.check_completeness(cleaned, horizontal),
        "disjointness": fragments.check_disjointness(horizontal),
        "top_products": fragments.topk_local_merge(horizontal),
        "reorder_rate": fragments.avg_weighted_merge(horizontal),
        "rebuilt_from_rows": fragments.reconstruct_horizontal(horizontal),
        "column_coverage": fragments.check_column_coverage(cleaned, vertical),
        "lossless_key": fragments.check_lossless_key(vertical),
        "order_day_and_product": fragments.distributed_query_vertical(
            vertical, ["order_id", "order_dow", "product_name"]
        ),
        "morning": catalog.morning_purchases(*vertical.values()),
        "rate_by_department": catalog.department_rates(vertical["site_2_product_info"]),
        "rebuilt_from_columns": fragments.reconstruct_vertical(vertical, cleaned.columns),
    }


def sql_workflow(store: FragmentStore) -> dict[str, DataFrame]:
    """The demo queries over stored fragments."""
    horizontal, (order_info, product_info) = store.horizontal, store.vertical.values()
    return {
        "q1_site_1": catalog.top_site_products_named(horizontal["site_1"], "site_1"),
        "q1_site_2": catalog.top_site_products_named(horizontal["site_2"], "site_2"),
        "q1_merged": catalog.top_products_merged(horizontal),
        "q2": catalog.reorder_rate_merged(horizontal),
        "q3": catalog.reconstructed_rows(horizontal),
        "q4": catalog.joined_sample(order_info, product_info, ["order_id", "order_dow", "product_name"], 10),
        "q5": catalog.morning_purchases(order_info, product_info),
        "q6": catalog.department_rates(product_info),
        "q7": catalog.reconstructed_keys(order_info, product_info),
        "q8_centralized": catalog.top_departments_centralized(store.relation),
        "q8_distributed": catalog.top_departments_distributed(horizontal),
    }
