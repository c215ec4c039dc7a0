"""Named queries. Each takes (spark, folder) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.functions import stats as quantiles
from trolley.operators import (
    cleaning,
    clustering,
    eda,
    features,
    forecast,
    fragments,
    metrics,
    mining,
    neighbours,
    neural,
    recommend,
)
from trolley.plans import catalog, workflows
from trolley.sources import storage
from trolley.sources.order_lines import COLUMNS, load_order_lines
from trolley.sources.prepared import fitted_once, stored_keyed_lines, stored_lines, stored_once, stored_sites
from trolley.sources.storage import settled, wide_shuffles

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The test tables have 25 brands as departments: site 1 holds the first eight.
SITES = {
    "site_1": [f"Brand#{n}" for n in range(1, 9)],
    "site_2": [f"Brand#{n}" for n in range(9, 26)],
}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def relation(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return stored_lines(spark, folder).select(*(columns or COLUMNS))


def horizontal(spark: SparkSession, folder: str, *columns: str) -> dict[str, DataFrame]:
    """The sites' partitions of the stored relation."""
    wanted = [c for c in COLUMNS if c in columns or c == "department"] if columns else COLUMNS
    return {site: part.select(*wanted) for site, part in stored_sites(spark, folder, SITES).items()}


def vertical(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return fragments.vertical_fragment(stored_keyed_lines(spark, folder))


def order_info(spark: SparkSession, folder: str) -> DataFrame:
    return vertical(spark, folder)["site_1_order_info"]


def product_info(spark: SparkSession, folder: str) -> DataFrame:
    return vertical(spark, folder)["site_2_product_info"]


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Doubles whose last bits depend on the order of summation, made comparable."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    return sql_q2_reorder_merged(spark, folder)


# --- sources, sinks, views ------------------------------------------------


@query
def scan_csv_inferred(spark, folder):
    path = storage.new_shared_folder(spark, "lines-csv")
    storage.save_csv(relation(spark, folder), path)
    return storage.load_csv(spark, path)


@query
def scan_csv_typed(spark, folder):
    path = storage.new_shared_folder(spark, "lines-csv")
    storage.save_csv(relation(spark, folder), path)
    return storage.load_csv(spark, path, storage.ORDER_LINE_SCHEMA)


@query
def scan_parquet(spark, folder):
    lines = storage.load_parquet(spark, f"{folder}/lineitem.parquet")
    return lines.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


@query
def sink_parquet(spark, folder):
    """The relation built from its tables and written."""
    path = storage.new_shared_folder(spark, "lines-parquet")
    storage.save_parquet(load_order_lines(spark, folder), path)
    return storage.load_parquet(spark, path)


@query
def save_fragments(spark, folder):
    """Stored horizontal fragments, rows per site."""
    path = storage.new_shared_folder(spark, "fragments")
    storage.save_horizontal(relation(spark, folder), SITES, path)
    stored = storage.load_fragments(spark, path, "horizontal")
    whole = fragments.reconstruct_horizontal(stored)
    return fragments.fragment_shares(whole, stored)


@query
def load_fragments(spark, folder):
    """Vertical fragments stored, read back by site name, and joined."""
    path = storage.new_shared_folder(spark, "fragments")
    storage.save_fragments(vertical(spark, folder), path, "vertical")
    stored = storage.load_fragments(spark, path, "vertical", list(fragments.VERTICAL_SCHEMA))
    return fragments.reconstruct_vertical(stored, COLUMNS)


@query
def register_views(spark, folder):
    """Rows of the relation, read through its views under both spellings."""
    lines = relation(spark, folder)
    catalog.register_views(lines, fragments.horizontal_fragment(lines, SITES), vertical(spark, folder))
    return spark.sql(
        """
        SELECT 'global_relation' AS view_name, COUNT(*) AS row_count FROM global_relation
        UNION ALL SELECT 'h_site_1', COUNT(*) FROM h_site_1
        UNION ALL SELECT 'h_site_2', COUNT(*) FROM h_site_2
        UNION ALL SELECT 'v_site_1', COUNT(*) FROM v_site_1
        UNION ALL SELECT 'v_site_2_product_info', COUNT(*) FROM v_site_2_product_info
        """
    )


@query
def bootstrap_fragments(spark, folder):
    """Cleaned, cut and stored; then loaded again, rows per stored table."""
    path = storage.new_shared_folder(spark, "bootstrap")
    workflows.bootstrap_fragments(spark, path, relation(spark, folder), SITES)
    store = workflows.bootstrap_fragments(spark, path, predicates=SITES)
    tables = {"relation": store.relation, **store.horizontal, **store.vertical}
    counts = [
        table.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


@query
def run_sql(spark, folder):
    relation(spark, folder).createOrReplaceTempView("global_relation")
    return catalog.run_sql(
        spark,
        """
        SELECT department, order_dow, COUNT(*) AS line_count, SUM(reordered) AS reorders
        FROM global_relation GROUP BY department, order_dow ORDER BY department, order_dow
        """,
    )


@query
def repartition(spark, folder):
    lines = storage.repartitioned(relation(spark, folder, "order_id", "department"), 8)
    return lines.groupBy("department").agg(F.count(F.lit(1)).alias("line_count"))


# --- profiling and cleaning -----------------------------------------------


@query
def null_profile(spark, folder):
    return cleaning.null_profile(relation(spark, folder))


@query
def null_cause_orders(spark, folder):
    return cleaning.null_cause_orders(relation(spark, folder, "order_number", "days_since_prior_order"))


@query
def impute_median(spark, folder):
    return cleaning.impute_median(
        relation(spark, folder, "order_id", "product_id", "add_to_cart_order", "days_since_prior_order")
    )


@query
def impute_sentinel(spark, folder):
    return cleaning.impute_sentinel(
        relation(spark, folder, "order_id", "product_id", "add_to_cart_order", "days_since_prior_order")
    )


@query
def impute_unknown(spark, folder):
    """Departments and names with a blank tried out: every third brand is taken for missing."""
    lines = relation(spark, folder, "order_id", "department_id", "department", "product_name")
    missing = F.col("department_id") % 3 == 0
    lines = lines.withColumn("department", F.when(~missing, F.col("department")))
    filled = cleaning.impute_unknown(lines)
    return filled.groupBy("department").agg(F.count("product_name").alias("line_count"))


@query
def drop_null_keys(spark, folder):
    """Lines of first orders lose their user here, and are then dropped."""
    lines = relation(spark, folder, "order_id", "user_id", "order_number", "product_id")
    lines = lines.withColumn("user_id", F.when(F.col("order_number") > 1, F.col("user_id")))
    return cleaning.drop_null_keys(lines)


@query
def cast_ids(spark, folder):
    """Ids as text, those of department 1 spoilt; spoilt text becomes null."""
    lines = relation(spark, folder, "order_id", "product_id", "department_id")
    spoilt = F.when(F.col("department_id") == 1, F.lit("x")).otherwise(F.lit(""))
    return cleaning.cast_ids(lines.select(*[F.concat(F.col(c).cast("string"), spoilt).alias(c) for c in lines.columns]))


@query
def clean_data(spark, folder):
    return cleaning.clean_data(relation(spark, folder))


@query
def cleaning_report(spark, folder):
    return cleaning.cleaning_report(relation(spark, folder, "order_id", "user_id", "product_id"))


@query
def approx_quantiles(spark, folder):
    return cleaning.quartiles(relation(spark, folder, "add_to_cart_order"), "add_to_cart_order")


@query
def iqr_outlier_report(spark, folder):
    return cleaning.iqr_outlier_report(relation(spark, folder, "add_to_cart_order"))


@query
def relation_profile(spark, folder):
    return cleaning.relation_profile(relation(spark, folder))


@query
def relation_sample(spark, folder):
    return cleaning.relation_sample(relation(spark, folder))


@query
def approx_quantile_ranks(spark, folder):
    """Whether each quantile of the sketch lies within its rank error, which is 0.01."""
    lines = relation(spark, folder, "add_to_cart_order")
    shares = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    found = quantiles.approx_quantiles(lines, "add_to_cart_order", shares).first()
    value = F.col("add_to_cart_order")
    counts = lines.agg(
        F.count(value).alias("n"),
        *[F.count(F.when(value < found[name], 1)).alias(f"below_{name}") for name in shares],
        *[F.count(F.when(value <= found[name], 1)).alias(f"upto_{name}") for name in shares],
    )
    checks = [
        F.struct(
            F.lit(name).alias("name"),
            (
                (F.col(f"below_{name}") <= (share + 0.01) * F.col("n")) & (F.col(f"upto_{name}") >= (share - 0.01) * F.col("n"))
            ).alias("within_error"),
        )
        for name, share in shares.items()
    ]
    return counts.select(F.inline(F.array(*checks)))


# --- feature tables -------------------------------------------------------


@query
def user_features(spark, folder):
    lines = relation(
        spark, folder, "order_id", "user_id", "product_id", "days_since_prior_order", "reordered", "department"
    )
    return features.build_user_features(cleaning.clean_data(lines))


@query
def user_features_nb(spark, folder):
    lines = relation(
        spark, folder, "user_id", "order_number", "product_id", "days_since_prior_order", "reordered"
    )
    return features.build_user_features_nb(cleaning.impute_sentinel(lines))


@query
def order_features(spark, folder):
    lines = relation(
        spark, folder, "order_id", "user_id", "order_dow", "order_hour_of_day", "product_id", "reordered", "department"
    )
    return features.build_order_features(lines)


@query
def order_features_nb(spark, folder):
    return features.build_order_features_nb(relation(spark, folder, "order_id", "user_id", "product_id"))


def rfm_lines(spark, folder):
    lines = relation(spark, folder, "user_id", "order_number", "days_since_prior_order", "product_id")
    return cleaning.impute_median(lines)


@query
def rfm(spark, folder):
    return features.rfm(rfm_lines(spark, folder))


@query
def rfm_nb(spark, folder):
    lines = relation(spark, folder, "user_id", "order_number", "days_since_prior_order", "product_id")
    return features.rfm(cleaning.impute_sentinel(lines))


SCORES = ["frequency_zscore", "recency_zscore", "monetary_zscore"]


@query
def rfm_zscores(spark, folder):
    return rounded(features.rfm_zscores(features.rfm(rfm_lines(spark, folder))), 6, *SCORES)


@query
def rfm_trimmed(spark, folder):
    return rounded(features.build_rfm(rfm_lines(spark, folder)), 6, *SCORES)


@query
def rfm_trim_report(spark, folder):
    return features.rfm_trim_report(features.rfm_zscores(features.rfm(rfm_lines(spark, folder))))


def rfm_nb_scores(spark, folder):
    return features.rfm_zscores(settled(rfm_nb(spark, folder), "rfm-nb"))


@query
def rfm_zscores_nb(spark, folder):
    return rounded(rfm_nb_scores(spark, folder), 6, *SCORES)


@query
def rfm_trimmed_nb(spark, folder):
    return rounded(features.rfm_trimmed(rfm_nb_scores(spark, folder)), 6, *SCORES)


# --- exploration ----------------------------------------------------------


@query
def top_departments(spark, folder):
    return eda.top_departments(relation(spark, folder, "department", "product_id"))


@query
def top_departments_nb(spark, folder):
    return eda.top_departments_nb(relation(spark, folder, "department"))


@query
def top_products(spark, folder):
    return eda.top_products(relation(spark, folder, "product_name"))


@query
def top_products_nb(spark, folder):
    return eda.top_products(relation(spark, folder, "product_name"), 10)


@query
def orders_by_dow(spark, folder):
    return eda.orders_by_dow(relation(spark, folder, "order_id", "order_dow"))


@query
def orders_by_dow_share(spark, folder):
    return eda.orders_by_dow_share(relation(spark, folder, "order_id", "order_dow"))


@query
def orders_by_hour(spark, folder):
    return eda.orders_by_hour(relation(spark, folder, "order_id", "order_hour_of_day"))


@query
def reorder_rate_by_department(spark, folder):
    return eda.reorder_rate_by_department(relation(spark, folder, "department", "reordered", "product_id"))


# --- horizontal fragments -------------------------------------------------


@query
def horizontal_fragment(spark, folder):
    pieces = horizontal(spark, folder)
    return fragments.reconstruct_horizontal({s: p.withColumn("site", F.lit(s)) for s, p in pieces.items()})


@query
def horizontal_complement(spark, folder):
    lines = relation(spark, folder, "order_id", "product_id", "department")
    pieces = fragments.horizontal_complement(lines, SITES["site_1"])
    return fragments.reconstruct_horizontal({s: p.withColumn("site", F.lit(s)) for s, p in pieces.items()})


@query
def fragment_shares(spark, folder):
    lines = relation(spark, folder, "department")
    return fragments.fragment_shares(lines, fragments.horizontal_fragment(lines, SITES))


@query
def check_completeness(spark, folder):
    lines = relation(spark, folder, "department")
    return fragments.check_completeness(lines, fragments.horizontal_fragment(lines, SITES))


@query
def check_disjointness(spark, folder):
    return fragments.check_disjointness(horizontal(spark, folder))


@query
def reconstruct_horizontal(spark, folder):
    return fragments.reconstruct_horizontal(horizontal(spark, folder))


@query
def distributed_query_horizontal(spark, folder):
    def local(fragment):
        return fragment.groupBy("order_dow").agg(
            F.count(F.lit(1)).alias("line_count"), F.sum("add_to_cart_order").alias("position_sum")
        )

    return fragments.distributed_query_horizontal(
        horizontal(spark, folder, "order_dow", "add_to_cart_order"), local
    )[0]


@query
def topk_local_merge(spark, folder):
    return fragments.topk_local_merge(horizontal(spark, folder, "product_name"))


@query
def avg_weighted_merge(spark, folder):
    return fragments.avg_weighted_merge(horizontal(spark, folder, "reordered"))


# --- vertical fragments ---------------------------------------------------


@query
def add_row_id(spark, folder):
    return fragments.add_row_id(relation(spark, folder))


@query
def vertical_fragment(spark, folder):
    pieces = vertical(spark, folder)
    first, second = pieces["site_1_order_info"], pieces["site_2_product_info"]
    return first.join(second.drop("order_id", "user_id", "product_id"), fragments.ROW_ID)


@query
def check_column_coverage(spark, folder):
    return fragments.check_column_coverage(relation(spark, folder), vertical(spark, folder))


@query
def check_lossless_key(spark, folder):
    return fragments.check_lossless_key(vertical(spark, folder))


@query
def reconstruct_vertical(spark, folder):
    return fragments.reconstruct_vertical(vertical(spark, folder), COLUMNS)


@query
def distributed_query_vertical(spark, folder):
    """A filter on a column that is not selected and lies in the other fragment."""
    return fragments.distributed_query_vertical(
        vertical(spark, folder), ["product_name", "reordered"], F.col("order_dow").isin(0, 6)
    )


@query
def vquery_cross_join(spark, folder):
    return fragments.distributed_query_vertical(
        vertical(spark, folder), ["order_id", "order_dow", "product_name"]
    )


@query
def vquery_morning(spark, folder):
    early = fragments.distributed_query_vertical(
        vertical(spark, folder),
        ["order_hour_of_day", "product_name", "department"],
        F.col("order_hour_of_day") < 10,
    )
    return early.groupBy("department").agg(F.count(F.lit(1)).alias("morning_purchases"))


@query
def vquery_single_site(spark, folder):
    one = fragments.distributed_query_vertical(vertical(spark, folder), ["department", "reordered"])
    return one.groupBy("department").agg(F.mean("reordered").alias("reorder_rate"))


# --- catalogue: distributed demo ------------------------------------------


@query
def sql_q1_site1(spark, folder):
    return catalog.top_site_products_named(horizontal(spark, folder, "product_name")["site_1"], "site_1")


@query
def sql_q1_site2(spark, folder):
    return catalog.top_site_products_named(horizontal(spark, folder, "product_name")["site_2"], "site_2")


@query
def sql_q1_merged(spark, folder):
    return catalog.top_products_merged(horizontal(spark, folder, "product_name"))


@query
def sql_q2_reorder_merged(spark, folder):
    return catalog.reorder_rate_merged(horizontal(spark, folder, "reordered"))


@query
def sql_q3_reconstruct_h(spark, folder):
    return catalog.reconstructed_rows(horizontal(spark, folder))


@query
def sql_q4_vjoin(spark, folder):
    pieces = vertical(spark, folder)
    return catalog.joined_sample(*pieces.values(), ["order_id", "order_dow", "product_name"], 10)


@query
def sql_q5_morning(spark, folder):
    return catalog.morning_purchases(*vertical(spark, folder).values())


@query
def sql_q6_site2_only(spark, folder):
    return catalog.department_rates(product_info(spark, folder))


@query
def sql_q7_reconstruct_v(spark, folder):
    return catalog.reconstructed_keys(*vertical(spark, folder).values())


@query
def sql_q8_centralized(spark, folder):
    return catalog.top_departments_centralized(relation(spark, folder, "department", "reordered"))


@query
def sql_q8_distributed(spark, folder):
    return catalog.top_departments_distributed(horizontal(spark, folder, "reordered"))


@query
def sql_shell_top5(spark, folder):
    return catalog.top_site_products(horizontal(spark, folder, "product_name")["site_1"]).withColumnRenamed(
        "purchase_count", "cnt"
    )


@query
def sql_shell_vjoin(spark, folder):
    return catalog.joined_sample(*vertical(spark, folder).values(), ["order_dow", "product_name"], 5)


# --- catalogue: presets ---------------------------------------------------


@query
def w1_h_top5(spark, folder):
    return catalog.top_site_products(horizontal(spark, folder, "product_name")["site_1"])


@query
def w1_h_dept_stats(spark, folder):
    return catalog.department_stats(horizontal(spark, folder, "reordered")["site_1"])


@query
def w1_h_hourly(spark, folder):
    return catalog.hourly_orders(horizontal(spark, folder, "order_hour_of_day", "reordered")["site_1"])


@query
def w1_h_dow(spark, folder):
    return catalog.weekday_orders(horizontal(spark, folder, "order_dow", "user_id")["site_1"])


@query
def w1_h_reorder_top(spark, folder):
    return catalog.most_reordered_products(horizontal(spark, folder, "product_name", "reordered")["site_1"])


@query
def w1_v_schema(spark, folder):
    return catalog.first_rows(order_info(spark, folder))


@query
def w1_v_active_users(spark, folder):
    return catalog.most_active_users(
        order_info(spark, folder)
    )


@query
def w1_v_order_pattern(spark, folder):
    return catalog.order_pattern(order_info(spark, folder))


@query
def w1_cross_union(spark, folder):
    lines = relation(spark, folder, "department")
    return catalog.fragment_row_counts(lines, fragments.horizontal_fragment(lines, SITES))


@query
def w2_h_top5(spark, folder):
    return catalog.top_site_products(horizontal(spark, folder, "product_name")["site_2"])


@query
def w2_h_dept_stats(spark, folder):
    return catalog.department_stats(horizontal(spark, folder, "reordered")["site_2"])


@query
def w2_h_top_add_cart(spark, folder):
    return catalog.cart_positions(horizontal(spark, folder, "add_to_cart_order", "reordered")["site_2"])


@query
def w2_h_reorder_dept(spark, folder):
    return catalog.department_reorder_percent(horizontal(spark, folder, "reordered")["site_2"])


@query
def w2_h_product_variety(spark, folder):
    return catalog.product_variety(horizontal(spark, folder, "product_name")["site_2"])


@query
def w2_v_schema(spark, folder):
    return catalog.first_rows(product_info(spark, folder))


@query
def w2_v_product_rank(spark, folder):
    return catalog.product_rank_in_department(
        product_info(spark, folder)
    )


@query
def w2_v_dept_local(spark, folder):
    return catalog.top_department_rates(product_info(spark, folder))


@query
def w2_cross_join(spark, folder):
    return catalog.morning_rates(*vertical(spark, folder).values())


# --- baskets --------------------------------------------------------------


@query
def row_sample(spark, folder):
    return mining.row_sample(relation(spark, folder, "order_id", "product_id", "add_to_cart_order", "product_name"))


@query
def order_sample(spark, folder):
    return mining.order_sample(relation(spark, folder, "order_id", "product_id", "add_to_cart_order", "product_name"))


@query
def baskets(spark, folder):
    found = mining.baskets(relation(spark, folder, "order_id", "product_name"))
    return found.select("order_id", F.concat_ws(",", "items").alias("items"))


def mined(spark, folder):
    """Itemsets and the baskets they are of, mined once for the queries on them."""

    def store():
        return settled(mining.trimmed_baskets(relation(spark, folder, "order_id", "product_name"), 0.005), "baskets")

    stored = stored_once(spark, folder, "baskets", store)
    return stored_once(spark, folder, "itemsets", lambda: mining.frequent_itemsets(stored, 0.005)), stored


def rules_as_text(rules):
    return rounded(rules, 9, "confidence", "lift", "support").withColumns(
        {side: F.concat_ws(",", side) for side in ("antecedent", "consequent")}
    )


@query
def frequent_itemsets(spark, folder):
    return mined(spark, folder)[0].select(F.concat_ws(",", "items").alias("items"), "freq")


@query
def association_rules(spark, folder):
    return rules_as_text(mining.association_rules(*mined(spark, folder)))


@query
def top_rules_by_lift(spark, folder):
    rules = mining.association_rules(*mined(spark, folder), min_confidence=0.05)
    return rules_as_text(mining.top_rules_by_lift(rules))


# --- segments -------------------------------------------------------------


def cluster_fits(spark, folder):
    """The fits for all k, made once for the queries on them."""
    return fitted_once(spark, folder, "kmeans", lambda: clustering.kmeans_fits(scaled_rfm(spark, folder)))


def best_clusters(spark, folder):
    """The assignment with the best silhouette."""

    def store():
        best = clustering.best_fit(cluster_fits(spark, folder))
        return settled(best.assign(scaled_rfm(spark, folder)), "clusters")

    return stored_once(spark, folder, "clusters", store)


def scaled_rfm(spark, folder):
    def store():
        return settled(features.build_rfm(rfm_lines(spark, folder)), "rfm")

    return clustering.scaled_features(stored_once(spark, folder, "rfm", store))


@query
def scaled_features(spark, folder):
    values = F.col("_values")
    return (
        scaled_rfm(spark, folder)
        .withColumn("_values", vector_to_array("features"))
        .select("user_id", *[F.round(values[i], 6).alias(c) for i, c in enumerate(features.RFM_COLUMNS)])
    )


@query
def kmeans_sweep(spark, folder):
    return clustering.sweep_table(scaled_rfm(spark, folder), cluster_fits(spark, folder))


@query
def kmeans_best(spark, folder):
    return best_clusters(spark, folder).select("user_id", *features.RFM_COLUMNS, "cluster")


@query
def davies_bouldin(spark, folder):
    return clustering.davies_bouldin(best_clusters(spark, folder))


@query
def cluster_summary(spark, folder):
    return clustering.cluster_summary(best_clusters(spark, folder))


def ruled_clusters(spark, folder):
    """Users parted by their number of orders."""
    scores = settled(features.rfm(rfm_lines(spark, folder)), "rfm")
    rule = F.when(F.col("frequency") >= 12, 2).when(F.col("frequency") >= 8, 1).otherwise(0)
    assembled = VectorAssembler(inputCols=features.RFM_COLUMNS, outputCol="features").transform(scores)
    return assembled.withColumn("cluster", rule)


@query
def davies_bouldin_by_rule(spark, folder):
    return rounded(clustering.davies_bouldin(ruled_clusters(spark, folder)), 6, "davies_bouldin")


@query
def cluster_summary_by_rule(spark, folder):
    found = clustering.cluster_summary(ruled_clusters(spark, folder))
    return rounded(found, 9, "avg_frequency", "avg_recency", "avg_monetary")


# --- ALS ------------------------------------------------------------------


def bought(spark, folder):
    return relation(spark, folder, "user_id", "product_id")


@query
def top_users_products(spark, folder):
    return recommend.top_users_products(bought(spark, folder))


@query
def ratings(spark, folder):
    """Of the 2000 most active users and the 200 most bought products."""
    return recommend.ratings(bought(spark, folder), 2000, 200).withColumn("rating", F.col("rating").cast("int"))


@query
def train_test_split(spark, folder):
    train, test = recommend.train_test_split(recommend.ratings(bought(spark, folder), None, None))
    parts = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return parts.withColumn("rating", F.col("rating").cast("int"))


def als_parts(spark, folder):
    """All users and all products."""

    def store():
        lines = bought(spark, folder)
        with wide_shuffles(lines):
            return settled(recommend.ratings(lines), "ratings")

    return recommend.train_test_split(stored_once(spark, folder, "ratings", store))


def als_model(spark, folder):
    """One fit for all queries on it."""
    return fitted_once(spark, folder, "als", lambda: recommend.als_fit(als_parts(spark, folder)[0]))


def als_lists(spark, folder):
    def store():
        lists = recommend.als_top(als_model(spark, folder), 10)
        with wide_shuffles(lists):
            return settled(lists, "als-lists")

    return stored_once(spark, folder, "als-lists", store)


@query
def als_fit(spark, folder):
    """Size of the factors per side."""
    model = als_model(spark, folder)
    sides = [("user", model.model.userFactors), ("product", model.model.itemFactors)]
    counted = [
        side.agg(F.count(F.lit(1)).alias("ids"), F.max(F.size("features")).alias("rank")).select(
            F.lit(name).alias("side"), "ids", "rank"
        )
        for name, side in sides
    ]
    return counted[0].unionByName(counted[1])


@query
def als_rmse(spark, folder):
    model, test = als_model(spark, folder), als_parts(spark, folder)[1]
    with wide_shuffles(test):
        return settled(recommend.rating_rmse(model.predict(test)), "als-rmse")


@query
def als_rank_metrics(spark, folder):
    """Precision, recall, NDCG and MAP at 10 of the ALS lists and of the list of the most bought products."""
    train, test = als_parts(spark, folder)
    held = settled(test.select("user_id", "product_id"), "held-out")
    lists = {"als": als_lists(spark, folder), "popularity": recommend.popular_top(train, test, 10)}
    measured = [metrics.rank_metrics(table, held, 10).withColumn("model", F.lit(name)) for name, table in lists.items()]
    with wide_shuffles(held, lists["als"]):
        return settled(rounded(reduce(DataFrame.unionByName, measured), 9, *RANK_METRICS), "rank-metrics")


RANK_METRICS = ["precision", "recall", "ndcg", "map"]


@query
def popularity_rank_metrics(spark, folder):
    """The same of the list of the most bought products alone."""
    train, test = als_parts(spark, folder)
    held = settled(test.select("user_id", "product_id"), "held-out")
    return rounded(metrics.rank_metrics(recommend.popular_top(train, test, 10), held, 10), 9, *RANK_METRICS)


@query
def rating_rmse_of_mean(spark, folder):
    """The error of predicting the mean of the training ratings."""
    train, test = als_parts(spark, folder)
    mean = train.agg(F.mean("rating")).first()[0]
    return rounded(recommend.rating_rmse(test.withColumn("prediction", F.lit(mean))), 9, "rmse")


@query
def als_top5(spark, folder):
    return als_lists(spark, folder).filter("place <= 5")


# --- item neighbours ------------------------------------------------------


def named(spark, folder):
    return relation(spark, folder, "user_id", "product_name")


# Names in the catalogue of the recommenders.
CATALOGUE = 200


def knn_catalogue(spark, folder):
    return stored_once(spark, folder, "catalogue", lambda: neighbours.catalogue(named(spark, folder), CATALOGUE))


def knn_users(spark, folder):
    """The catalogue and all users with at least five of its items."""
    items = knn_catalogue(spark, folder)

    def store():
        return settled(neighbours.user_items(named(spark, folder), items), "user-items", "user_id")

    return items, stored_once(spark, folder, "knn-users", store)


def knn_folds(spark, folder):
    items, held = knn_users(spark, folder)

    def store():
        return settled(neighbours.holdout_folds(held), "folds", "user_id")

    return items, stored_once(spark, folder, "knn-folds", store)


def knn_counted(spark, folder):
    """Outcomes of the cross-validation, counted once for the queries on them."""

    def count():
        items, folded = knn_folds(spark, folder)
        return settled(neighbours.knn_cv_counts(folded, items.count()), "knn-counts")

    return stored_once(spark, folder, "knn-counts", count)


@query
def knn_interactions(spark, folder):
    items, held = knn_users(spark, folder)
    return neighbours.interactions(held, items)


@query
def item_cosine(spark, folder):
    items, held = knn_users(spark, folder)
    return rounded(neighbours.item_cosine(held, items), 9, "similarity")


@query
def knn_scores(spark, folder):
    items, held = knn_users(spark, folder)
    return neighbours.user_scores(held, items)


@query
def knn_top10(spark, folder):
    """The ten best unbought items of every user."""
    items, held = knn_users(spark, folder)
    return neighbours.top_items(held, items, top_n=10)


@query
def knn_holdout_folds(spark, folder):
    items, folded = knn_folds(spark, folder)
    marked = folded.select("user_id", "fold", "hidden", F.explode("items").alias("item"))
    return marked.join(F.broadcast(items), "item").select(
        "user_id", "fold", "product_name", F.array_contains("hidden", F.col("item")).cast("int").alias("hidden")
    )


METRICS = ["precision", "recall", "f1", "accuracy", "auc"]


@query
def knn_cv_metrics(spark, folder):
    return rounded(neighbours.knn_cv_metrics(knn_counted(spark, folder)), 9, *METRICS)


@query
def knn_summary(spark, folder):
    return rounded(neighbours.knn_summary(neighbours.knn_cv_metrics(knn_counted(spark, folder))), 9, *METRICS)


@query
def roc_curve(spark, folder):
    return metrics.roc_curve(knn_counted(spark, folder), ["fold"])


@query
def roc_auc(spark, folder):
    return rounded(metrics.roc_auc(knn_counted(spark, folder), ["fold"]), 9, "auc")


@query
def knn_k_sweep(spark, folder):
    items, folded = knn_folds(spark, folder)
    return neighbours.knn_k_sweep(folded, items.count())


# --- neural recommender ---------------------------------------------------


def ncf_users(spark, folder):
    """The catalogue and all users with at least three of its items."""
    items = knn_catalogue(spark, folder)

    def store():
        return settled(neighbours.user_items(named(spark, folder), items, min_items=3), "ncf-users", "user_id")

    return items, stored_once(spark, folder, "ncf-users", store)


def ncf_split(spark, folder):
    def store():
        items, held = ncf_users(spark, folder)
        return neural.stratified_parts(neural.labelled_pairs(neural.with_user_index(held), items.count()))

    return neural.split_of(stored_once(spark, folder, "ncf-parts", store))


def ncf_scored(spark, folder):
    def store():
        n_items = knn_catalogue(spark, folder).count()
        return settled(neural.neural_cf(*ncf_split(spark, folder), n_items), "scores")

    return stored_once(spark, folder, "ncf-scores", store)


@query
def ncf_interactions(spark, folder):
    items, held = ncf_users(spark, folder)
    return neighbours.interactions(held, items)


@query
def index_encode(spark, folder):
    """Index of each user and each catalogue item."""
    items, held = ncf_users(spark, folder)
    users = neural.index_users(held).select(
        F.lit("user").alias("kind"), F.col("user_id").cast("string").alias("value"), F.col("user_idx").alias("idx")
    )
    products = items.select(
        F.lit("product").alias("kind"), F.col("product_name").alias("value"), F.col("item").cast("long").alias("idx")
    )
    return users.unionByName(products)


@query
def negative_samples(spark, folder):
    items, held = ncf_users(spark, folder)
    return neural.negative_samples(held, items.count())


@query
def stratified_split(spark, folder):
    items, held = ncf_users(spark, folder)
    return neural.stratified_parts(neural.labelled_pairs(held, items.count()))


@query
def neural_cf(spark, folder):
    return ncf_scored(spark, folder)


@query
def neural_cf_metrics(spark, folder):
    """The model beside ALS alone and beside each user's share of purchases."""
    train, test = ncf_split(spark, folder)
    scores = {
        "neural": ncf_scored(spark, folder),
        "als": settled(neural.factor_scores(train, test), "scores"),
        "share": settled(neural.baseline_scores(train, test), "scores"),
    }
    return neural.compared(scores)


@query
def binary_metrics(spark, folder):
    """Metrics of the neighbour scores, an item counting as predicted from a score of 8."""
    measured = metrics.binary_metrics(knn_counted(spark, folder), threshold=8.0)
    return rounded(measured, 9, "precision", "recall", "f1", "auc")


# --- weekly sales ---------------------------------------------------------


def weeks(spark, folder):
    return forecast.weekly_sales(
        stored_lines(spark, folder).select("order_date", "department", "product_id")
    )


def forecasts(spark, folder):
    return stored_once(
        spark,
        folder,
        "forecasts",
        lambda: settled(forecast.arima_forecast(forecast.time_split(weeks(spark, folder))), "forecasts"),
    )


@query
def sales_by_dow(spark, folder):
    return forecast.sales_by_dow(relation(spark, folder, "order_dow", "order_id", "product_id"))


@query
def weekly_sales(spark, folder):
    return weeks(spark, folder)


@query
def time_split(spark, folder):
    return forecast.time_split(weeks(spark, folder))


@query
def arima_forecast(spark, folder):
    return forecasts(spark, folder)


@query
def forecast_rmse(spark, folder):
    return forecast.forecast_rmse(forecasts(spark, folder))


@query
def forecast_rmse_last_value(spark, folder):
    """What the forecasts are to be held against."""
    errors = forecast.forecast_rmse(forecast.last_value_forecast(forecast.time_split(weeks(spark, folder))))
    return rounded(errors, 9, "rmse")


# --- whole workflows: rows of each of their tables ---------------------------


def table_rows(tables):
    """(name, row_count) of every table among the results of a workflow."""
    counts = [
        table.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("name"), "row_count")
        for name, table in tables.items()
        if isinstance(table, DataFrame)
    ]
    return reduce(DataFrame.unionByName, counts)


@query
def eda_workflow(spark, folder):
    return table_rows(workflows.eda_workflow(relation(spark, folder), storage.new_shared_folder(spark, "eda")))


@query
def training_workflow(spark, folder):
    cleaned = settled(cleaning.clean_data(relation(spark, folder)), "cleaned")
    return table_rows(workflows.training_workflow(cleaned, weeks(spark, folder), products=CATALOGUE))


@query
def fragmentation_workflow(spark, folder):
    cleaned = settled(cleaning.clean_data(relation(spark, folder)), "cleaned")
    path = storage.new_shared_folder(spark, "fragmentation")
    return table_rows(workflows.fragmentation_workflow(cleaned, path, SITES))


@query
def sql_workflow(spark, folder):
    path = storage.new_shared_folder(spark, "sql-workflow")
    store = workflows.bootstrap_fragments(spark, path, relation(spark, folder), SITES)
    return table_rows(workflows.sql_workflow(store))
