"""The skew helpers give what plain windows and joins give, at any threshold and partitioning."""

import pytest
from frames import bag
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trolley.functions.hashing import row_text
from trolley.functions.skew import dense_index, number_rows, running_totals, spread_lookup, visits_in_order
from trolley.functions.stats import exact_quantiles
from trolley.sources.storage import SHUFFLED_BYTES, parts_for, wide_shuffles
from trolley.sources.order_lines import order_lines

FOLDER = "/root/testdata/sf0.001"


def skewed_visits(spark):
    """Visitor 1 holds a third of all visits, many of them on one day; some visitors and days are unknown."""
    rows = spark.range(3000)
    return rows.select(
        (F.col("id") * 700_001 % 9_000_017).alias("visit"),
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 40).alias("who"),
        F.when(F.col("id") % 71 == 0, None)
        .when(F.col("id") % 6 == 0, F.lit("2024-02-01").cast("date"))
        .otherwise(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 97).cast("int")))
        .alias("day"),
    )


@pytest.mark.parametrize("heavy", [0, 70, 10**6])
def test_visits_in_order(spark, heavy):
    visits = skewed_visits(spark)
    ordered = W.partitionBy("who").orderBy("day", "visit")
    known = F.col("who").isNotNull()
    expected = visits.withColumn(
        "visit_number", F.when(known, F.row_number().over(ordered)).cast("long")
    ).withColumn(
        "days_since_previous", F.when(known, F.datediff("day", F.lag("day").over(ordered))).cast("double")
    )
    found = visits_in_order(visits, "who", "day", "visit", heavy_rows=heavy)
    assert bag(found) == bag(expected)


@pytest.mark.parametrize("heavy", [0, 100, 10**6])
def test_spread_lookup(spark, heavy):
    visits = skewed_visits(spark)
    facts = visits.groupBy("who").agg(F.count(F.lit(1)).alias("n"), F.min("visit").alias("first"))
    expected = visits.join(facts.select("who", "first"), "who", "left").select("visit", "who", "day", "first")
    assert bag(spread_lookup(visits, facts, ["who"], ["first"], "n", heavy)) == bag(expected)


@pytest.mark.parametrize("heavy", [0, 3, 10**6])
def test_relation_does_not_depend_on_the_heavy_limit(spark, heavy):
    tables = [spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("lineitem", "orders", "part")]
    assert bag(order_lines(*tables, heavy_rows=heavy)) == bag(order_lines(*tables))


def test_lines_without_order_or_part_are_kept(spark):
    lineitem, orders, part = [spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("lineitem", "orders", "part")]
    found = order_lines(lineitem, orders.filter("o_orderkey % 5 > 0"), part.filter("p_partkey % 7 > 0"))
    assert found.count() == lineitem.count()
    assert found.filter("order_id % 5 = 0 AND user_id IS NOT NULL").count() == 0
    assert found.filter("product_id % 7 = 0 AND product_name IS NOT NULL").count() == 0
    assert found.filter("user_id IS NULL AND reordered <> 0").count() == 0


ROWS = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.sampled_from(["a", "b", "-", "1:a", ""]))),
    max_size=30,
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS, partitions=st.sampled_from([1, 4, 13]), limit=st.sampled_from([1, 3, 10**6]))
def test_row_numbers_are_dense_and_repeat(spark, rows, partitions, limit):
    df = spark.createDataFrame(rows, "x int, y string")
    found = number_rows(df.repartition(partitions), "id", bucket_digits=2, copies_per_task=limit)
    assert sorted(r["id"] for r in found.collect()) == list(range(len(rows)))
    assert bag(found, "x", "y") == bag(df)
    assert bag(found) == bag(number_rows(df.coalesce(1), "id"))


def test_many_copies_are_numbered(spark):
    df = spark.range(5000).select((F.col("id") % 3 * F.col("id") % 2).alias("x"))
    found = number_rows(df, "id", copies_per_task=100)
    assert found.agg(F.min("id"), F.max("id"), F.countDistinct("id")).collect()[0] == (0, 4999, 5000)
    spans = found.groupBy("x").agg((F.max("id") - F.min("id") + 1).alias("span"), F.count("*").alias("n"))
    assert spans.filter("span <> n").count() == 0


def test_running_totals(spark):
    rows = spark.range(500).select(
        (F.col("id") % 3).alias("g"), (F.col("id") * 37 % 101 / 7).alias("score"), (F.col("id") % 5).alias("n")
    )
    steps = rows.groupBy("g", "score").agg(F.sum("n").alias("n"))
    down = W.partitionBy("g").orderBy(F.desc("score")).rowsBetween(W.unboundedPreceding, 0)
    found = running_totals(steps.withColumn("b", F.floor("score")), ["g"], "score", "b", {"n": "total"})
    assert bag(found, "g", "score", "total") == bag(steps.withColumn("total", F.sum("n").over(down)), "g", "score", "total")


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.none(), st.integers(-40, 40)), max_size=25))
def test_exact_quantiles(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    found = exact_quantiles(df, "v", {"low": 0.25, "mid": 0.5, "top": 1.0}).collect()[0]
    known = sorted(v for v in values if v is not None)
    for name, share in (("low", 0.25), ("mid", 0.5), ("top", 1.0)):
        place = max(1, -int(-share * len(known) // 1)) if known else 0
        assert found[name] == (known[place - 1] if known else None)


def test_heavy_order_is_split_by_adaptive_execution(spark):
    """An order with a third of all lines: the join with its order is cut into several tasks."""
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in keys}
    lineitem, orders, part = [spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("lineitem", "orders", "part")]
    lineitem = lineitem.repartition(8).withColumn(
        "l_orderkey", F.when(F.col("l_linenumber") < 4, F.lit(7).cast("long")).otherwise(F.col("l_orderkey"))
    )
    try:
        for key, value in keys.items():
            spark.conf.set(key, value)
        found = order_lines(lineitem, orders, part, ["order_id", "user_id", "order_dow", "product_id", "product_name"])
        found.collect()
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_quantiles_of_wide_and_close_values(spark):
    values = [float(v) for v in (1e300, -1e300, 0.1, 0.1 + 1e-17, 5e-324, 3.0, 3.0000000000000004)] + [2.0**53, 2.0**53 + 2]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double")
    found = exact_quantiles(df, "v", {str(i): (i + 1) / len(values) for i in range(len(values))}).collect()[0]
    assert list(found) == sorted(values)
    ids = [2**62 + i for i in range(300)]
    df = spark.createDataFrame([(v,) for v in ids], "v long")
    assert exact_quantiles(df, "v", {"mid": 0.5}).collect()[0]["mid"] == ids[149]


def test_dense_index(spark):
    df = spark.createDataFrame([(v,) for v in (30_000_000_000, 7, None, 7, -2)], "v long")
    assert sorted(map(tuple, dense_index(df.repartition(5), "v").collect())) == [(-2, 0), (7, 1), (30_000_000_000, 2)]


def test_part_counts_follow_the_size(spark, tmp_path):
    spark.range(100_000).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    few, many = parts_for(table, 1 << 20), parts_for(table, 1 << 10)
    assert many > 100 * few >= 100
    assert parts_for(table.crossJoin(spark.createDataFrame([(1,)], "a int")), 1 << 20) == few


def test_rows_are_shuffled_once_to_be_numbered(spark):
    """Ids follow the digests; the rows are neither counted nor stored on the way where no bucket is large."""
    df = spark.range(700).select((F.col("id") % 300).alias("x"), F.when(F.col("id") % 7 > 0, "a").alias("y"))
    found = number_rows(df, "id")
    assert "_copies" not in found._jdf.queryExecution().optimizedPlan().toString()
    digest = F.md5(row_text(["x", "y"]))
    plain = df.select((F.row_number().over(W.orderBy(digest, "x", "y")) - 1).cast("long").alias("id"), "x", "y")
    assert bag(found) == bag(plain)
    assert bag(number_rows(df, "id", bucket_digits=1, copies_per_task=40)) == bag(plain)


def test_first_purchases_need_no_join(spark):
    """The lines of a user and name meet in one shuffle, and carry no column that others give."""
    tables = [spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("lineitem", "orders", "part")]
    found = order_lines(*tables)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" in plan
    assert found.filter("order_hour_of_day <> order_id % 24 OR department <> concat('Brand#', department_id)").count() == 0


def test_shuffles_are_as_wide_as_the_inputs(spark, tmp_path):
    spark.range(20_000_000).write.parquet(str(tmp_path / "t"))
    key, table = "spark.sql.shuffle.partitions", spark.read.parquet(str(tmp_path / "t"))
    before, parts = spark.conf.get(key), parts_for(table, SHUFFLED_BYTES)
    with wide_shuffles(table, table, table):
        assert int(spark.conf.get(key)) == max(int(before), 3 * parts)
    assert spark.conf.get(key) == before
