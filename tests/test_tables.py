"""Cleaning, features and exploration on odd input."""

import math

from frames import LINE_TYPES, bag, line, lines
from pyspark.sql import functions as F

from trolley.functions.stats import rounded_ratio
from trolley.operators import cleaning, eda, features
from trolley.plans import workflows
from trolley.registry.queries import relation
from trolley.sources.prepared import stored_lines

FOLDER = "/root/testdata/sf0.001"


def test_cleaning(spark):
    df = lines(
        spark,
        [
            line(order=None, days=1.0),
            line(user=None),
            line(product=None),
            line(days=4.0, dep=None),
            line(days=9.0, name=None),
            line(order=2),
        ],
    )
    clean = cleaning.clean_data(df)
    # The median is taken before rows are dropped, over the values 1, 4 and 9.
    assert bag(clean, "order_id", "days_since_prior_order", "department", "product_name") == {
        (1, 4.0, "unknown", "n1"): 1,
        (1, 9.0, "d1", "unknown"): 1,
        (2, 4.0, "d1", "n1"): 1,
    }
    assert cleaning.cleaning_report(df).collect()[0] == (6, 3, 3)
    assert cleaning.clean_data(df, exact_median=False).count() == 3


def test_no_known_days_give_no_median(spark):
    for rows in ([], [line(), line(order=2)]):
        df = cleaning.impute_median(spark.createDataFrame(rows, LINE_TYPES))
        assert df.filter("days_since_prior_order IS NOT NULL").count() == 0


def test_text_that_is_no_number_becomes_null(spark):
    df = spark.createDataFrame([("7", "x"), ("y", "8")], "order_id string, product_id string")
    assert bag(cleaning.cast_ids(df)) == {(7, None): 1, (None, 8): 1}


def test_null_profile_lists_only_columns_with_nulls(spark):
    df = lines(spark, [line(days=1.0), line(name=None)])
    assert bag(cleaning.null_profile(df)) == {("days_since_prior_order", 1): 1, ("product_name", 1): 1}


def test_outliers_are_counted_and_kept(spark):
    df = lines(spark, [line(cart=c) for c in (1, 2, 3, 4, 100)])
    report = cleaning.iqr_outlier_report(df).collect()[0]
    assert tuple(report) == (2.0, 4.0, 2.0, 7.0, 100.0, 1)


def test_equal_scores_have_no_zscore_and_are_trimmed(spark):
    df = lines(spark, [line(user=u, days=float(u), product=p) for u in (1, 2, 3) for p in (1, 2)])
    scored = features.rfm_zscores(features.rfm(df))
    assert {r["frequency_zscore"] for r in scored.collect()} == {None}
    assert features.rfm_trimmed(scored).count() == 0
    recency = sorted(r["recency_zscore"] for r in scored.collect())
    assert all(math.isclose(a, b) for a, b in zip(recency, [-1.0, 0.0, 1.0]))


def test_first_orders_do_not_count_as_gaps(spark):
    df = lines(spark, [line(days=-1.0), line(number=2, days=5.0), line(user=2, days=-1.0)])
    assert bag(features.rfm(df)) == {(1, 2, 5.0, 2): 1, (2, 1, 0.0, 1): 1}
    assert bag(features.build_user_features_nb(df), "user_id", "avg_days_between_orders") == {(1, 5.0): 1, (2, None): 1}


def test_ties_go_to_the_smaller_name(spark):
    df = lines(spark, [line(name=n) for n in "cab"])
    assert [r["product_name"] for r in eda.top_products(df, 2).collect()] == ["a", "b"]


def test_weekday_names_differ_in_their_start(spark):
    df = lines(spark, [line(dow=0), line(order=2, dow=6)])
    assert [r["day"] for r in eda.orders_by_dow(df).collect()] == ["Sun", "Sat"]
    assert [r["day_name"] for r in eda.orders_by_dow_share(df).collect()] == ["Monday", "Sunday"]


def test_rounding_is_half_up(spark):
    df = spark.createDataFrame([(1005, 1000), (1, 8), (2, 3), (0, 5), (5, 0)], "a long, b long")
    found = [r[0] for r in df.select(rounded_ratio(F.col("a"), F.col("b"), 2)).collect()]
    assert found == [1.01, 0.13, 0.67, 0.0, None]


def test_eda_workflow(spark, tmp_path):
    found = workflows.eda_workflow(relation(spark, FOLDER), str(tmp_path), sample_frac=0.5)
    assert found["user_features"].count() == found["cleaned_data"].select("user_id").distinct().count()
    assert found["rules"].filter("confidence < 0.1").count() == 0


def test_a_new_file_in_a_partition_is_noticed(spark, tmp_path):
    tables = {t: spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("lineitem", "orders", "part")}
    for name, table in tables.items():
        table.withColumn("piece", F.lit(1)).write.partitionBy("piece").parquet(str(tmp_path / f"{name}.parquet"))
    rows = stored_lines(spark, str(tmp_path)).count()
    tables["lineitem"].write.mode("append").parquet(str(tmp_path / "lineitem.parquet/piece=1"))
    assert stored_lines(spark, str(tmp_path)).count() == 2 * rows
