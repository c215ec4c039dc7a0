"""Itemsets, segments, joined samples and running totals against plain Python, DuckDB and Spark's own measures."""

import itertools
import math
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from trolley.operators import clustering, forecast, metrics, mining
from trolley.operators.fragments import ROW_ID
from trolley.plans import catalog
from trolley.sources.storage import settled


@pytest.mark.parametrize("bits", [16, 7])
def test_itemsets_of_all_sizes(spark, monkeypatch, bits):
    monkeypatch.setattr(mining, "CHUNK_BITS", bits)
    monkeypatch.setattr(mining, "CHUNK", 1 << bits)
    monkeypatch.setattr(mining, "MOST_CANDIDATES", 10)
    rng = random.Random(bits)
    baskets = []
    for order in range(400):
        items = {f"n{rng.randrange(14)}" for _ in range(rng.randrange(7))}
        if rng.random() < 0.4:
            items |= {"n1", "n2", "n3", "n4"} - ({"n4"} if rng.random() < 0.3 else set())
        baskets.append((10**12 + 7 * order, sorted(items)))
    stored = settled(spark.createDataFrame(baskets, "order_id long, items array<string>").repartition(5), "baskets")
    least = math.ceil(0.05 * len(baskets))
    expected = {}
    for size in range(1, 8):
        counts = Counter(c for _, items in baskets for c in itertools.combinations(items, size))
        expected |= {items: n for items, n in counts.items() if n >= least}
    found = {tuple(r["items"]): r["freq"] for r in mining.frequent_itemsets(stored, 0.05).collect()}
    assert found == expected
    assert max(map(len, found)) >= 4
    # The same from SQL, for sets of three.
    connection = duckdb.connect()
    pairs = stored.select("order_id", F.explode("items").alias("item")).toPandas()
    connection.register("pairs", pairs)
    triples = connection.sql(
        "SELECT a.item, b.item, c.item, count(*) FROM pairs a JOIN pairs b ON a.order_id = b.order_id AND a.item < b.item "
        f"JOIN pairs c ON a.order_id = c.order_id AND b.item < c.item GROUP BY ALL HAVING count(*) >= {least}"
    ).fetchall()
    assert {t[:3]: t[3] for t in triples} == {k: v for k, v in found.items() if len(k) == 3}


def test_itemsets_of_few_or_no_baskets(spark):
    schema = "order_id long, items array<string>"
    assert mining.frequent_itemsets(spark.createDataFrame([], schema), 0.1).count() == 0
    one = spark.createDataFrame([(1, ["b", "a"])], schema)
    found = {tuple(r["items"]): r["freq"] for r in mining.frequent_itemsets(one, 0.1, num_partitions=3).collect()}
    assert found == {("a",): 1, ("b",): 1, ("a", "b"): 1}


def points(spark, n=600, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 6, (4, 3))
    rows = [(i, (centres[i % 4] + rng.normal(0, 1, 3)).tolist()) for i in range(n)]
    return spark.createDataFrame(rows, "user_id long, v array<double>").select("user_id", array_to_vector("v").alias("features"))


def test_all_fits_are_the_same_on_any_partitioning(spark):
    first = clustering.kmeans_fits(points(spark).repartition(2), range(2, 6))
    second = clustering.kmeans_fits(points(spark).repartition(11, "user_id"), range(2, 6))
    for a, b in zip(first, second):
        assert np.array_equal(a.centres, b.centres) and (a.k, a.silhouette, a.wssse) == (b.k, b.silhouette, b.wssse)
    assert [f.k for f in first] == [2, 3, 4, 5]
    assert clustering.best_fit(first).k == 4


def test_costs_and_silhouettes_against_sql_and_spark(spark):
    scaled = settled(points(spark, seed=3), "points")
    evaluator = ClusteringEvaluator(predictionCol="cluster", featuresCol="features")
    connection = duckdb.connect()
    for fit in clustering.kmeans_fits(scaled, range(2, 6)):
        assigned = fit.assign(scaled)
        assert fit.silhouette == pytest.approx(evaluator.evaluate(assigned), abs=1e-6)
        table = assigned.toPandas()
        table[["x", "y", "z"]] = np.stack([v.toArray() for v in table.pop("features")])
        connection.register("stored", table)
        cost = connection.sql(
            "SELECT sum((x - cx) ** 2 + (y - cy) ** 2 + (z - cz) ** 2) FROM stored JOIN "
            "(SELECT cluster, avg(x) AS cx, avg(y) AS cy, avg(z) AS cz FROM stored GROUP BY cluster) USING (cluster)"
        ).fetchall()[0][0]
        assert fit.wssse == pytest.approx(cost, rel=1e-3)
        # Every point is with its nearest centre.
        xyz = table[["x", "y", "z"]].to_numpy()
        nearest = ((xyz[:, None] - fit.centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        assert (nearest == table["cluster"].to_numpy()).all()


def test_fits_of_few_points(spark):
    rows = spark.createDataFrame([(i, [float(i % 2), 1.0]) for i in range(10)], "user_id long, v array<double>")
    few = rows.select("user_id", array_to_vector("v").alias("features"))
    fits = clustering.kmeans_fits(few, range(2, 4))
    assert [len(f.centres) for f in fits] == [2, 2] and all(f.wssse == pytest.approx(0, abs=1e-6) for f in fits)
    assert clustering.kmeans_fits(few.limit(0)) == []


@pytest.mark.parametrize("missing", [0.0, 0.9, 0.999, 1.0])
def test_first_joined_rows_when_keys_are_missing(spark, missing):
    rng = random.Random(3)
    left = spark.createDataFrame([(i, f"l{i}") for i in range(12_000)], f"{ROW_ID} long, a string")
    kept = [(i, f"r{i}") for i in range(12_000) if rng.random() >= missing]
    right = spark.createDataFrame(kept, f"{ROW_ID} long, b string")
    found = [tuple(r) for r in catalog.joined_sample(left, right, ["a", "b"], 5).collect()]
    assert found == [(f"l{i}", b) for i, b in sorted(kept)[:5]]


def test_first_joined_rows_read_few_of_both(spark):
    left = spark.range(100_000).select(F.col("id").alias(ROW_ID), F.lit("x").alias("a"))
    right = spark.range(100_000).select(F.col("id").alias(ROW_ID), F.lit("y").alias("b"))
    plan = catalog.joined_sample(left, right, ["a", "b"], 5)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Filter") >= 2 and "IN (" in plan or "INSET" in plan


def test_running_totals_of_crowded_scores(spark):
    """All scores inside one part of 1/4096, and infinite ones."""
    rng = random.Random(2)
    rows = [(0.5 + rng.random() * 1e-5, rng.randrange(2)) for _ in range(5000)] + [(math.inf, 1), (-math.inf, 0), (None, 1)]
    scored = spark.createDataFrame(rows, "score double, label int").withColumn("g", F.lit(1))
    steps = metrics.score_steps(scored, ["g"]).collect()
    known = [r for r in rows if r[0] is not None]
    assert len(steps) == len({r[0] for r in known})
    for r in random.Random(1).sample(steps, 50):
        assert r["tp"] == sum(y for s, y in known if s >= r["score"])
        assert r["fp"] == sum(1 - y for s, y in known if s >= r["score"])


def test_many_series_are_fitted_together():
    rng = np.random.default_rng(1)
    series = [np.cumsum(rng.normal(0, 3, rng.integers(22, 60))) for _ in range(40)] + [np.full(30, 5.0)]
    steps = [int(n) for n in rng.integers(1, 9, len(series))]
    together = forecast.arima_paths(series, steps)
    for known, n, path in zip(series, steps, together):
        assert len(path) == n
        assert path == pytest.approx(forecast.arima_path(known, n), abs=1e-9)


def test_ten_thousand_series_in_a_minute(spark):
    import time

    rows = spark.range(10_000).select(
        F.concat(F.lit("s"), "id").alias("series"), F.explode(F.sequence(F.lit(0), F.lit(51))).alias("i")
    )
    weekly = rows.select(
        "series",
        F.expr("date_add(DATE'2024-01-07', 7 * i)").alias("week"),
        (F.lit(50) + F.pmod(F.xxhash64("series", "i"), F.lit(40))).alias("y"),
    )
    start = time.time()
    found = forecast.arima_forecast(forecast.time_split(weekly))
    assert found.filter("forecast IS NOT NULL AND model = 'arima'").count() == 10_000 * 11
    assert time.time() - start < 120  # 60 on an idle machine


def test_nearest_centres_are_the_first_of_equally_near_ones(spark):
    points = spark.createDataFrame([(i, x, 0) for i, x in enumerate((0, 10**9, 2 * 10**9, 9 * 10**9))], "i int, x long, y long")
    centres = np.array([[0.0, 0.0], [2.0, 0.0], [9.0, 0.0], [2.0, 0.0]])
    found = points.withColumn("_n", clustering._nearest_of(["x", "y"], centres)).orderBy("i").select("_n.c", "_n.d").collect()
    assert [tuple(r) for r in found] == [(0, 0.0), (0, 1.0), (1, 0.0), (2, 0.0)]


def test_sums_of_whole_numbers_are_exact():
    assert clustering._exact(np.array([2**62, 2**62, 1])) == 2**63 + 1
    assert clustering._sum_of(np.array([0.5, -0.5, 1.5, 0.49999999999999994, 2.4])) == 4
    assert clustering._exact(np.array([], dtype=np.int64)) == 0
