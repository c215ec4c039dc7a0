"""Mining, neighbours, metrics, segments, the neural recommender and forecasts against plain Python."""

import collections
import datetime
import math
from itertools import combinations

import numpy as np
import pytest
from frames import bag, line, lines
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from trolley.operators import clustering, features, forecast, metrics, mining, neighbours, neural, recommend
from trolley.registry.queries import relation
from trolley.sources.order_lines import order_lines
from trolley.sources.storage import settled

FOLDER = "/root/testdata/sf0.001"


def shop(spark):
    """Twelve users with baskets of different sizes; one has everything, one has a single item."""
    rows = []
    for user in range(1, 13):
        names = [n for i, n in enumerate("abcdefgh") if (user * (i + 3)) % 5 < 3 or user == 1]
        names = names[:1] if user == 2 else names
        rows += [line(order=100 + user, user=user, name=n, product=ord(n), cart=i) for i, n in enumerate(names)]
    return lines(spark, rows)


def bought_by(df):
    held = {}
    for user, name in df.select("user_id", "product_name").collect():
        held.setdefault(user, set()).add(name)
    return held


def test_itemsets_and_rules(spark):
    df = shop(spark)
    carts = [c for c in bought_by(df).values() if len(c) >= 2]
    need = math.ceil(0.4 * len(carts))
    counts = {
        items: n
        for size in range(1, 9)
        for items in combinations("abcdefgh", size)
        if (n := sum(set(items) <= c for c in carts)) >= need
    }
    assert max(map(len, counts)) >= 3
    stored = settled(mining.trimmed_baskets(df, 0.4), "baskets")
    found = mining.frequent_itemsets(stored, 0.4)
    assert {tuple(r["items"]): r["freq"] for r in found.collect()} == counts
    rules = {(tuple(r[0]), tuple(r[1])): r[2:] for r in mining.association_rules(found, stored, 0.5).collect()}
    for items, both in counts.items():
        for item in items if len(items) > 1 else ():
            rest = tuple(i for i in items if i != item)
            confidence = both / counts[rest]
            rule = rules.pop((rest, (item,)), None)
            assert (rule is not None) == (confidence >= 0.5)
            if rule:
                lift = confidence / (counts[(item,)] / len(carts))
                assert rule == pytest.approx((confidence, lift, both / len(carts)))
    assert rules == {}


def test_a_sample_of_orders_keeps_them_whole(spark):
    df = relation(spark, FOLDER)
    drawn = mining.order_sample(df, 0.3)
    assert bag(drawn) == bag(df.join(drawn.select("order_id").distinct(), "order_id", "left_semi").select(*df.columns))
    assert bag(mining.row_sample(df.repartition(13))) == bag(mining.row_sample(df.coalesce(1)))
    assert mining.order_sample(df, 1.0).count() == df.count()


def plain_scores(held, catalogue, k):
    """Scores of open items from the similarities of all users."""
    matrix = np.array([[name in items for name in catalogue] for items in held.values()], dtype=float)
    together = matrix.T @ matrix
    norm = np.sqrt(np.diag(together))
    similar = together / np.outer(np.where(norm == 0, 1, norm), np.where(norm == 0, 1, norm))
    np.fill_diagonal(similar, 0)
    scores = {}
    for user, items in held.items():
        own = [catalogue.index(n) for n in items]
        for place, name in enumerate(catalogue):
            if name not in items:
                scores[user, name] = sum(sorted(similar[place, own], reverse=True)[:k])
    return scores


@pytest.mark.parametrize("k", [2, 30])
def test_neighbour_scores(spark, k):
    df = shop(spark)
    items = neighbours.catalogue(df, 6)
    names = sorted(r["product_name"] for r in items.collect())
    held = {u: n & set(names) for u, n in bought_by(df).items()}
    held = {u: n for u, n in held.items() if len(n) >= 2}
    users = neighbours.user_items(df, items, min_items=2)
    found = {(r[0], r[1]): r[2] for r in neighbours.user_scores(users, items, k).collect()}
    expected = plain_scores(held, names, k)
    assert found.keys() == expected.keys()
    assert all(math.isclose(found[key], expected[key], abs_tol=1e-8) for key in found)
    assert not any(user == 1 for user, _ in found)  # has everything


def test_fold_similarity_leaves_out_what_is_hidden(spark):
    df = shop(spark)
    items = neighbours.catalogue(df)
    folded = neighbours.holdout_folds(neighbours.user_items(df, items, min_items=1))
    n = items.count()
    rows = folded.collect()
    assert all(len(r["hidden"]) == (max(1, len(r["items"]) // 5) if len(r["items"]) > 1 else 0) for r in rows)
    assert all(sorted(r["visible"] + r["hidden"]) == r["items"] for r in rows)
    found = {(r[0], r[1], r[2]): r[3] for r in neighbours.fold_similarity(folded, n).collect()}
    expected = {}
    for fold in range(1, 6):
        matrix = np.zeros((len(rows), n))
        for i, r in enumerate(rows):
            matrix[i, r["visible"] if r["fold"] == fold else r["items"]] = 1
        together = matrix.T @ matrix
        for a, b in combinations(range(n), 2):
            if together[a, b]:
                expected[fold, a, b] = together[a, b] / math.sqrt(together[a, a] * together[b, b])
    assert found == pytest.approx(expected)


def test_drawing_users_does_not_depend_on_partitions(spark):
    df = relation(spark, FOLDER)
    items = neighbours.catalogue(df)
    draws = [
        bag(neighbours.user_items(df.repartition(p), items, users=20), "user_id", F.concat_ws(",", "items"))
        for p in (1, 4, 13)
    ]
    assert draws[0] == draws[1] == draws[2] and sum(draws[0].values()) == 20


def test_auc_is_the_share_of_pairs_in_order(spark):
    rows = [(g, (i * 7 % 11) / 4, int(i * i % 3 == g)) for g in (0, 1) for i in range(30)]
    df = spark.createDataFrame(rows, "g int, score double, label int")
    found = {r["g"]: r["auc"] for r in metrics.roc_auc(df, ["g"]).collect()}
    for g in (0, 1):
        ups = [s for h, s, y in rows if h == g and y]
        downs = [s for h, s, y in rows if h == g and not y]
        wins = sum((u > d) + 0.5 * (u == d) for u in ups for d in downs)
        assert found[g] == pytest.approx(wins / len(ups) / len(downs))
    curve = metrics.roc_curve(df, ["g"]).filter("g = 0").orderBy(F.desc("score")).collect()
    assert (curve[-1]["fpr"], curve[-1]["tpr"]) == (1.0, 1.0)


def test_one_class_has_no_auc(spark):
    df = spark.createDataFrame([(0.2, 0), (0.9, 0)], "score double, label int")
    assert metrics.roc_auc(df.withColumn("g", F.lit(1)), ["g"]).collect()[0]["auc"] is None
    assert tuple(metrics.binary_metrics(df).collect()[0]) == (0.0, 0.0, 0.0, 0.0)


def test_davies_bouldin(spark):
    points = [(0, 0.0, 0.0), (0, 0.0, 2.0), (1, 5.0, 5.0), (1, 6.0, 5.0), (2, -4.0, 1.0), (2, -4.0, 4.0), (2, -5.0, 1.0)]
    df = spark.createDataFrame([(c, Vectors.dense(x, y)) for c, x, y in points], ["cluster", "features"])
    groups = {c: np.array([p[1:] for p in points if p[0] == c]) for c in range(3)}
    centre = {c: g.mean(axis=0) for c, g in groups.items()}
    spread = {c: np.linalg.norm(g - centre[c], axis=1).mean() for c, g in groups.items()}
    worst = [
        max((spread[a] + spread[b]) / np.linalg.norm(centre[a] - centre[b]) for b in range(3) if b != a) for a in range(3)
    ]
    found = clustering.davies_bouldin(df).collect()[0]
    assert found["clusters"] == 3 and found["davies_bouldin"] == pytest.approx(np.mean(worst))


def test_kmeans_finds_separate_groups(spark):
    rows = [(i, float(i % 3 * 50 + i % 5), float(i % 3 * 20), i % 3 * 7 + i % 2) for i in range(90)]
    df = spark.createDataFrame(rows, "user_id long, frequency double, recency double, monetary int")
    scaled = clustering.scaled_features(df)
    best, clustered = clustering.kmeans_best(scaled, range(2, 5))
    assert best.k == 3 and 0.8 < best.silhouette <= 1
    assert {r["count"] for r in clustering.cluster_summary(clustered).collect()} == {30}


def test_als_gives_each_user_different_products(spark):
    rated = recommend.ratings(relation(spark, FOLDER), None, 50)
    train, test = recommend.train_test_split(rated)
    assert bag(train.unionAll(test)) == bag(rated)
    assert bag(recommend.train_test_split(rated.repartition(13))[0]) == bag(train)
    best = recommend.als_top(recommend.als_fit(train, iterations=3), 5)
    per_user = best.groupBy("user_id").agg(F.count("*").alias("n"), F.countDistinct("product_id").alias("d"))
    assert per_user.filter("n <> 5 OR d <> 5").count() == 0


def test_negatives_were_not_bought(spark):
    df = shop(spark)
    items = neighbours.catalogue(df)
    held = neighbours.user_items(df, items, min_items=1)
    drawn = bag(neural.negative_samples(held, items.count()))
    assert drawn == bag(neural.negative_samples(held.repartition(13), items.count()))
    assert set(drawn.values()) == {1}
    bought = {r["user_id"]: set(r["items"]) for r in held.collect()}
    for user, own in bought.items():
        others = {i for u, i in drawn if u == user}
        assert not others & own and len(others) == min(4 * len(own), items.count() - len(own))


def test_split_keeps_the_share_of_each_label(spark):
    df = spark.range(1000).select(
        F.col("id").alias("user_id"), F.lit(1).alias("item"), (F.col("id") % 10 == 0).cast("int").alias("label")
    )
    train, test = neural.stratified_split(df.repartition(5))
    assert bag(train.groupBy("label").count()) == {(0, 720): 1, (1, 80): 1}
    assert bag(train.unionAll(test)) == bag(df)


def test_neural_recommender_learns_two_tastes(spark):
    rows = [(u, [i for i in range(20) if i % 2 == u % 2 and (u * 7 + i) % 10 > 1]) for u in range(120)]
    held = spark.createDataFrame(rows, "user_id long, items array<int>")
    pairs = settled(neural.labelled_pairs(held, 20, per_positive=1), "pairs")
    train, test = neural.stratified_split(pairs)
    scored = neural.neural_cf(train, test, 20, rank=4)
    assert metrics.binary_metrics(scored).collect()[0]["auc"] > 0.85


def test_forecast_follows_an_autoregressive_series():
    noise = np.random.default_rng(1).normal(size=400)
    change = np.zeros(400)
    for t in range(2, 400):
        change[t] = 0.7 * change[t - 1] - 0.2 * change[t - 2] + noise[t] + 0.3 * noise[t - 1]
    series = 1000 + np.cumsum(change)
    ours, mean = [], []
    for cut in range(200, 390, 10):
        ours.append(forecast.arima_path(series[:cut], 3) - series[cut : cut + 3])
        mean.append(series[:cut].mean() - series[cut : cut + 3])
    last = [series[c - 1] - series[c : c + 3] for c in range(200, 390, 10)]
    assert np.square(ours).mean() < np.square(last).mean() < np.square(mean).mean()


def test_short_series_carry_the_last_value_and_gaps_are_zero(spark):
    days = [("2024-01-01", 3), ("2024-01-07", 1), ("2024-01-22", 5)]
    rows = [(d, "x", 1) for d, n in days for _ in range(n)]
    df = spark.createDataFrame(rows, "order_date string, department string, product_id long")
    weekly = forecast.weekly_sales(df.withColumn("order_date", F.col("order_date").cast("date")))
    found = [(str(r["week"]), r["y"]) for r in weekly.filter("series = 'all'").orderBy("week").collect()]
    assert found == [("2024-01-07", 4), ("2024-01-14", 0), ("2024-01-21", 0), ("2024-01-28", 5)]
    ahead = forecast.arima_forecast(forecast.time_split(weekly, 0.5)).filter("series = 'x'").collect()
    assert [r["forecast"] for r in ahead] == [0.0, 0.0]
    rmse = forecast.forecast_rmse(spark.createDataFrame([("s", 3, 0.0), ("s", 4, 0.0)], "series string, y long, forecast double"))
    assert rmse.collect()[0]["rmse"] == pytest.approx(math.sqrt(12.5))


@pytest.mark.parametrize("scale", ["0.001", "0.01", "0.1"])
def test_forecasts_stay_in_range_over_the_whole_horizon(spark, scale):
    folder = f"/root/testdata/sf{scale}"
    tables = [spark.read.parquet(f"{folder}/{t}.parquet") for t in ("lineitem", "orders", "part")]
    lines = order_lines(*tables, columns=["order_date", "department", "product_id"])
    split = forecast.time_split(settled(forecast.weekly_sales(lines), "weekly"))
    found = settled(forecast.arima_forecast(split), "forecasts")
    ranges = {r["series"]: r["high"] for r in split.filter("part = 'train'").groupBy("series").agg(F.max("y").alias("high")).collect()}
    for row in found.collect():
        assert -ranges[row["series"]] - 1 <= row["forecast"] <= 2 * ranges[row["series"]] + 1
        assert row["model"] == "arima"

    def pooled(table):
        return table.agg(F.sqrt(F.mean(F.pow(F.col("y") - F.col("forecast"), F.lit(2))))).first()[0]

    assert pooled(found) <= pooled(forecast.last_value_forecast(split))
    rmse = {r["series"]: r["rmse"] for r in forecast.forecast_rmse(found).collect()}
    errors = collections.defaultdict(list)
    for row in found.collect():
        errors[row["series"]].append((row["y"] - row["forecast"]) ** 2)
    for series, squares in errors.items():
        assert rmse[series] == pytest.approx((sum(squares) / len(squares)) ** 0.5)


def test_short_series_say_so(spark):
    rows = [("s", datetime.date(2024, 1, 7) + datetime.timedelta(weeks=i), i, "train" if i < 8 else "test") for i in range(10)]
    found = forecast.arima_forecast(spark.createDataFrame(rows, "series string, week date, y long, part string")).collect()
    assert [(r["forecast"], r["model"]) for r in found] == [(7.0, "last_value")] * 2


def test_partial_autocorrelations_give_stationary_models():
    rng = np.random.default_rng(1)
    for _ in range(200):
        ar = forecast.coefficients(rng.uniform(-0.97, 0.97, (1, 3)))[0]
        assert np.abs(np.roots(np.append(1.0, -ar))).max() < 1


def test_ids_beyond_32_bits_are_rated_and_recommended(spark):
    rows = [(3_000_000_000 + u, 5_000_000_000 + p) for u in range(12) for p in range(8) if (u + p) % 3]
    rated = settled(recommend.ratings(spark.createDataFrame(rows, "user_id long, product_id long")), "rated")
    fitted = recommend.als_fit(rated)
    best = recommend.als_top(fitted, 2).collect()
    assert {r["user_id"] for r in best} == {u for u, _ in rows} and {r["product_id"] for r in best} <= {p for _, p in rows}
    assert recommend.als_rmse(fitted, rated) >= 0


def test_lines_without_a_user_are_nobodys(spark):
    lines = spark.createDataFrame(
        [(None, 1, 2.0, 5), (0, 1, 2.0, 5)], "user_id long, order_number int, days_since_prior_order double, product_id long"
    )
    assert [r["user_id"] for r in features.rfm(lines).collect()] == [0]
