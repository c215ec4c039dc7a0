"""The ALS of the recommenders against that of pyspark.ml, and what its half steps and the search for its lists store."""

import random

import numpy as np
import pytest
from pyspark.ml.recommendation import ALS

from trolley.operators import als_training, factor_search
from trolley.sources.storage import settled


def rated(spark, n_users, n_products, seed=3):
    """Every number occurs; pairs may repeat, one product is in a fifth of the rows, ratings may be negative."""
    rng = random.Random(seed)
    rows = [(u, rng.randrange(n_products), float(rng.randrange(1, 6))) for u in range(n_users)]
    rows += [(rng.randrange(n_users), p, float(rng.randrange(1, 6))) for p in range(n_products)]
    rows += [(rng.randrange(n_users), rng.choice([0, rng.randrange(n_products)]), float(rng.randrange(-1, 4))) for _ in range(600)]
    return settled(spark.createDataFrame(rows, "_user int, _product int, rating float"), "rated")


def vectors(df):
    return {r["id"]: np.array(r["features"]) for r in df.collect()}


@pytest.mark.parametrize("block_rows, iterations", [(7, 3), (1 << 17, 2), (30, 0)])
def test_factors_are_those_of_spark(spark, block_rows, iterations):
    rows = rated(spark, 100, 45)
    found = als_training.fit(rows, 100, 45, 5, iterations, 0.1, 42, block_rows=block_rows)
    names = {"userCol": "_user", "itemCol": "_product", "ratingCol": "rating", "coldStartStrategy": "drop"}
    slow = ALS(rank=5, maxIter=iterations, regParam=0.1, seed=42, implicitPrefs=True, **names).fit(rows)
    for ours, theirs in ((found.userFactors, slow.userFactors), (found.itemFactors, slow.itemFactors)):
        ours, theirs = vectors(ours), vectors(theirs)
        assert ours.keys() == theirs.keys()
        assert max(np.abs(ours[i] - theirs[i]).max() for i in ours) < 1e-5
    pairs = rows.select("_user", "_product").distinct()
    score = {(r["_user"], r["_product"]): r["prediction"] for r in found.transform(pairs).collect()}
    assert score == pytest.approx({(r["_user"], r["_product"]): r["prediction"] for r in slow.transform(pairs).collect()}, abs=1e-5)


def test_half_steps_store_each_vector_once_and_are_deleted(spark, monkeypatch):
    stored, sizes = [], []

    def counted(df, label):
        table = settled(df, label)
        if label == "als-factors":
            stored.append(table)
            sizes.append(table.selectExpr("sum(length(factors))").first()[0])
        return table

    monkeypatch.setattr(als_training, "settled", counted)
    als_training.fit(rated(spark, 60, 20), 60, 20, 4, 3, 0.1, 42, block_rows=6)
    assert sorted(set(sizes)) == [20 * 4 * 4, 60 * 4 * 4] and len(sizes) == 2 + 2 * 3
    for table in stored:
        file = spark._jvm.org.apache.hadoop.fs.Path(table.inputFiles()[0])
        assert not file.getFileSystem(spark._jsc.hadoopConfiguration()).exists(file)


def test_ratings_must_be_numbers(spark):
    rows = spark.createDataFrame([(0, 0, 1.0), (0, 1, float("nan"))], "_user int, _product int, rating float")
    with pytest.raises(Exception, match="not a number"):
        als_training.fit(rows, 1, 2, 2, 1, 0.1, 42)


def test_a_met_cell_stores_the_users_places_only(spark, monkeypatch):
    stored = {}

    def kept(df, label):
        stored[label] = table = settled(df, label)
        if label == "sent-users":
            met = table.selectExpr("sum(length(users)) / 4 AS met", "sum(length(limits)) / 4 AS limits").first()
            stored["sizes"] = met["met"], met["limits"], sum(c != "limits" and kind == "binary" for c, kind in table.dtypes)
        return table

    monkeypatch.setattr(factor_search, "settled", kept)
    rng = np.random.default_rng(1)

    def factors(n):
        rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(0, 1, (n, 3)))]
        return spark.createDataFrame(rows, "id int, features array<float>")

    best = factor_search.best_items(factors(90), factors(400), 3, 4, 16)
    assert best.count() == 90 * 4
    met, limits, columns = stored["sizes"]
    # Vectors and limits are not written again for every cell that a user meets.
    assert limits == 90 and columns == 1 and met >= 90
