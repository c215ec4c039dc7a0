"""Recommenders, quantiles and indexes against plain Python."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from frames import bag
from pyspark.sql import functions as F

from trolley.functions.skew import dense_index
from trolley.functions.stats import exact_quantiles, exact_quantiles_of
from trolley.operators import factor_search, metrics, ncf_training, neighbours, neural, recommend


# --- quantiles and numbering -------------------------------------------------


def wanted(values, share):
    known = sorted(v for v in values if v is not None and not (isinstance(v, float) and math.isnan(v)))
    return known[max(1, math.ceil(share * len(known))) - 1] if known else None


INF, HUGE = float("inf"), 1.7e308
SHARES = {"zero": 0.0, "low": 0.25, "mid": 0.5, "high": 0.9, "all": 1.0}


@pytest.mark.parametrize(
    "values",
    [
        [1.0, 2.0, 3.0, INF],
        [-INF, INF],
        [-INF, -INF, 1.0, INF, INF, INF],
        [-HUGE, 0.0, HUGE],
        [HUGE, -HUGE, 1e-320, 5e-324, float("nan"), None],
        [0.0, -0.0, 1.0],
        [None],
    ],
)
def test_quantiles_of_infinite_and_very_wide_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = exact_quantiles(df, "v", SHARES).first()
    assert row.asDict() == {name: wanted(values, share) for name, share in SHARES.items()}


@pytest.mark.parametrize("limit", [1_000_000, 50])
def test_quantiles_of_many_values(spark, monkeypatch, limit):
    monkeypatch.setattr("trolley.functions.stats.SETTLED_VALUES", limit)
    monkeypatch.setattr("trolley.functions.stats.ACCURACY", 100)
    rng = random.Random(limit)
    values = [rng.randrange(2**60) for _ in range(20_000)] + [7] * 3000 + [None] * 10
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(7)
    assert exact_quantiles(df, "v", SHARES).first().asDict() == {n: wanted(values, s) for n, s in SHARES.items()}


def test_quantiles_of_several_columns_at_once(spark):
    df = spark.range(1000).selectExpr("id AS a", "IF(id % 10 = 0, id * 2, NULL) AS b", "CAST(NULL AS bigint) AS c")
    assert exact_quantiles_of(df, {"a": ("a", 0.5), "b": ("b", 0.3), "c": ("c", 0.5)}) == {"a": 499, "b": 580, "c": None}


def test_dense_index_needs_no_python(spark):
    rng = random.Random(2)
    ids = [rng.randrange(-(2**62), 2**62) for _ in range(5000)]
    df = spark.createDataFrame([(i,) for i in ids * 2] + [(None,)], "v long").repartition(9)
    found = dense_index(df, "v")
    assert "Python" not in found._jdf.queryExecution().toString()
    assert sorted(map(tuple, found.collect())) == [(v, i) for i, v in enumerate(sorted(set(ids)))]
    names = spark.createDataFrame([("b",), ("é",), ("a",)], "v string")
    assert sorted(map(tuple, dense_index(names, "v").collect())) == [("a", 0), ("b", 1), ("é", 2)]
    assert dense_index(df.limit(0), "v").count() == 0


# --- ranked lists ----------------------------------------------------------------


def test_rank_metrics_against_plain_counts(spark):
    rng = random.Random(4)
    k, lists, held = 5, [], []
    for user in range(60):
        items = rng.sample(range(30), 8)
        if user % 7:
            lists += [(user, place, item) for place, item in enumerate(items, 1)]
        held += [(user, item) for item in rng.sample(range(30), rng.randrange(0, 12))]
    lists += [(999, 1, 3)]  # nothing held out
    of = defaultdict(list)
    for user, place, item in lists:
        of[user].append((place, item))
    totals = Counter()
    users = {u for u, _ in held}
    for user in users:
        mine = {i for u, i in held if u == user}
        hits = [p for p, i in sorted(of[user]) if p <= k and i in mine]
        most = min(k, len(mine))
        totals["precision"] += len(hits) / k
        totals["recall"] += len(hits) / len(mine)
        totals["ndcg"] += sum(1 / math.log2(p + 1) for p in hits) / sum(1 / math.log2(i + 1) for i in range(1, most + 1))
        totals["map"] += sum((n + 1) / p for n, p in enumerate(hits)) / most
    row = metrics.rank_metrics(
        spark.createDataFrame(lists, "user_id long, place int, product_id long"),
        spark.createDataFrame(held, "user_id long, product_id long"),
        k,
    ).first()
    assert row["users"] == len(users)
    for name, total in totals.items():
        assert row[name] == pytest.approx(total / len(users))


def test_popular_list_is_the_same_for_all(spark):
    train = spark.createDataFrame([(u, p) for u in range(9) for p in range(u % 4 + 1)], "user_id long, product_id long")
    found = recommend.popular_top(train, train, 2)
    assert bag(found, "place", "product_id") == Counter({(1, 0): 9, (2, 1): 9})
    assert bag(found.filter("user_id = 8"), "place", "product_id", "score") == Counter({(1, 0, 9.0): 1, (2, 1, 6.0): 1})
    assert recommend.popular_top(train.limit(0), train, 2).count() == 0


# --- best products without scoring all pairs ---------------------------------------


@pytest.mark.parametrize("cell_items", [512, 16, 3])
def test_best_products_are_those_of_all_pairs(spark, monkeypatch, cell_items):
    monkeypatch.setattr("trolley.operators.factor_search.PORTION_USERS", 64)
    rng = random.Random(5)
    rows = list({(rng.randrange(150), int(rng.paretovariate(0.6)) % 200): float(rng.randrange(1, 5)) for _ in range(3000)}.items())
    rated = spark.createDataFrame([(u, p, r) for (u, p), r in rows], "user_id long, product_id long, rating float")
    model = recommend.als_fit(rated, iterations=3).model
    best = factor_search.best_items(model.userFactors, model.itemFactors, model.rank, 7, cell_items)
    slow = model.recommendForAllUsers(7).select("_user", F.posexplode("recommendations").alias("place", "r"))
    # Single precision: the last digits depend on the order of summation.
    score = {(r["user"], r["place"]): r["score"] for r in best.collect()}
    assert score == pytest.approx({(r["_user"], r["place"] + 1): r["r"]["rating"] for r in slow.collect()}, abs=1e-5)
    item = {(r["user"], r["place"]): r["item"] for r in best.collect()}
    same = sum(item[r["_user"], r["place"] + 1] == r["r"]["_product"] for r in slow.collect())
    assert same >= 0.99 * len(item)
    few = factor_search.best_items(model.userFactors, model.itemFactors.filter("id < 4"), model.rank, 7, cell_items)
    assert few.count() == 4 * model.userFactors.count()
    assert few.select("user", "item").distinct().count() == few.count()


def test_equal_scores_go_to_the_smaller_item(spark):
    kinds = "id int, features array<float>"
    users = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0])], kinds)
    items = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(30, 0, -1)], kinds)
    best = factor_search.best_items(users, items, 2, 3, 4)
    assert bag(best.filter("user = 1").select("place", "item", "score")) == Counter({(1, 1, 1.0): 1, (2, 2, 1.0): 1, (3, 3, 1.0): 1})
    assert bag(best.filter("user = 2").select("place", "item")) == Counter({(1, 1): 1, (2, 2): 1, (3, 3): 1})


def test_most_pairs_of_users_and_products_are_not_scored(spark, monkeypatch):
    rng = np.random.default_rng(3)
    tastes = rng.normal(0, 1, (12, 6))
    kinds, n_users, n_items = "id int, features array<float>", 400, 6000

    def factors(n):
        own = tastes[rng.integers(0, 12, n)] * rng.uniform(0.5, 1.5, (n, 1)) + rng.normal(0, 0.05, (n, 6))
        return spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(own)], kinds)

    scored, stored = [], factor_search.settled

    def settled(df, label):
        table = stored(df, label)
        if label == "sent-users":
            scored.append(table.agg(F.sum(F.length("users") / 4)).first()[0] * 64)
        return table

    monkeypatch.setattr("trolley.operators.factor_search.settled", settled)
    best = factor_search.best_items(factors(n_users), factors(n_items), 6, 10, 64)
    assert best.count() == 10 * n_users
    assert scored[0] < 0.15 * n_users * n_items
    assert "recommendForAllUsers" not in recommend.als_top.__code__.co_names


# --- neighbours without a limit of names -------------------------------------------


def slow_scores(held, k):
    """{user: {item: score}} of all items of any user."""
    holders = defaultdict(set)
    for user, items in held.items():
        for item in items:
            holders[item].add(user)
    similar = {}
    for a in holders:
        for b in holders:
            both = len(holders[a] & holders[b])
            if a != b and both:
                similar[a, b] = both / math.sqrt(len(holders[a]) * len(holders[b]))
    return {
        user: {
            item: round(sum(sorted((similar.get((item, h), 0.0) for h in own), reverse=True)[:k]), 9)
            for item in holders
            if item not in own
        }
        for user, own in held.items()
    }


@pytest.mark.parametrize("block", [512, 7, 3])
def test_neighbours_in_blocks(spark, block):
    rng = random.Random(block)
    held = {u: sorted(rng.sample(range(20), rng.randrange(5, 12))) for u in range(40)}
    n_items = 20
    whole = spark.createDataFrame([(0, u, items) for u, items in held.items()], "fold int, user_id long, items array<int>")
    counts = neighbours.co_counts(whole, "fold", n_items, block)
    together = Counter((a, b) for items in held.values() for a in items for b in items if a <= b)
    assert {(r["a"], r["b"]): r["together"] for r in counts.collect()} == together
    scored = neighbours.knn_scores(whole, neighbours.cosine(counts, "fold"), n_items, (3, 30), block)
    for k in (3, 30):
        found = defaultdict(dict)
        for r in scored.filter(F.col("k") == k).collect():
            found[r["user_id"]][r["item"]] = r["score"]
        slow = slow_scores(held, k)
        for user in held:
            assert found[user] == pytest.approx({i: slow[user].get(i, 0.0) for i in range(n_items) if i not in held[user]}, abs=2e-9)
    users = whole.drop("fold")
    items = spark.createDataFrame([(f"n{i}", i) for i in range(n_items)], "product_name string, item int")
    best = neighbours.top_items(users, items, 30, 4, block)
    slow = slow_scores(held, 30)
    expected = Counter()
    for user in held:
        ranked = sorted(((-round(s, 7), i) for i, s in slow[user].items() if s > 0))[:4]
        expected.update((user, place, f"n{i}") for place, (_, i) in enumerate(ranked, 1))
    assert sum((bag(best, "user_id", "place", "product_name") & expected).values()) >= 0.95 * sum(expected.values())
    folded = neighbours.holdout_folds(users)
    one = neighbours.knn_cv_counts(folded, n_items, (3, 30), block=512)
    assert bag(neighbours.knn_cv_counts(folded, n_items, (3, 30), block=block)) == bag(one)


def test_a_catalogue_of_more_than_5000_names(spark):
    rng = random.Random(6)
    lines = []
    for user in range(400):
        group = user % 20
        lines += [(user, f"name {group * 300 + rng.randrange(300):05d}") for _ in range(25)]
    lines += [(1000 + i // 6, f"name {i:05d}") for i in range(6000)]
    df = spark.createDataFrame(lines, "user_id long, product_name string")
    items = neighbours.catalogue(df, 6000)
    n_items = items.count()
    assert n_items == 6000
    held = neighbours.user_items(df, items, min_items=5)
    best = neighbours.top_items(held, items, 30, 5)
    assert "collect" not in neighbours.top_items.__code__.co_names
    number = {r["product_name"]: r["item"] for r in items.collect()}
    own = {r["user_id"]: set(r["items"]) for r in held.collect()}
    rows = best.collect()
    assert {r["user_id"] for r in rows} == set(own)
    assert all(number[r["product_name"]] not in own[r["user_id"]] for r in rows)
    # What users of a group are offered is what their group buys.
    grouped = [r for r in rows if r["user_id"] < 1000]
    assert sum(number[r["product_name"]] // 300 == r["user_id"] % 20 for r in grouped) > 0.95 * len(grouped)


# --- the neural model ------------------------------------------------------------


def planted(spark, users=1500, n_items=60, groups=6):
    """Users of a group buy the group's items, whatever their number."""
    rng = random.Random(1)
    rows = []
    for user in range(users):
        group = rng.randrange(groups)
        liked = [i for i in range(n_items) if i % groups == group]
        bought = set(rng.sample(liked, rng.randrange(4, 9))) | {rng.randrange(n_items)}
        rows.append((10**12 + user, sorted(bought)))
    return spark.createDataFrame(rows, "user_id long, items array<int>")


def test_training_finds_planted_tastes(spark):
    held = neural.with_user_index(planted(spark))
    pairs = neural.labelled_pairs(held, 60).persist()
    train, test = neural.stratified_split(pairs)
    scores = {
        "neural": neural.neural_cf(train, test, 60),
        "als": neural.factor_scores(train, test),
        "share": neural.baseline_scores(train, test),
    }
    auc = {r["model"]: r["auc"] for r in neural.compared(scores).collect()}
    assert auc["neural"] > 0.86, auc
    # The tastes are of low rank, so factors alone come as near to the best possible (0.89).
    assert auc["neural"] > auc["als"] - 0.02 and auc["neural"] > auc["share"] + 0.2, auc
    pairs.unpersist()


def test_training_is_the_same_on_any_partitioning(spark):
    held = planted(spark, users=200)
    pairs = neural.labelled_pairs(held, 60)
    first = ncf_training.train(pairs, 60, rank=4, rounds=2)
    second = ncf_training.train(pairs.repartition(13), 60, rank=4, rounds=2)
    assert np.array_equal(first.shared, second.shared)
    unknown = spark.createDataFrame([(5, 3, 0), (10**12, 1000, 0)], "user_id long, item int, label int")
    assert all(0 < r["score"] < 1 for r in first.score(unknown).collect())


def test_gradients_follow_the_loss():
    shape = ncf_training.Shape(5, 3, (4, 2))
    rng = np.random.default_rng(0)
    shared = shape.start(1).astype(np.float64) + rng.normal(0, 0.3, shape.n_layers + 30)
    user, item = rng.normal(0, 1, (6, 6)), rng.normal(0, 1, (6, 6))
    label = np.array([1, 0, 1, 1, 0, 0.0])

    def loss(shared, user, item):
        p = ncf_training.forward(shape, shape.parts(shared), user, item)[0]
        return -np.mean(label * np.log(p) + (1 - label) * np.log(1 - p))

    score, kept = ncf_training.forward(shape, shape.parts(shared), user, item)
    *layers, by_user, by_item = ncf_training.gradients(shape, shape.parts(shared), user, item, score, label, kept)
    flat = np.concatenate([g.ravel() for g in layers])
    eps = 1e-6
    for i in range(shape.n_layers):
        up, down = shared.copy(), shared.copy()
        up[i] += eps
        down[i] -= eps
        assert flat[i] == pytest.approx((loss(up, user, item) - loss(down, user, item)) / (2 * eps), abs=1e-5)
    for which, gradient in ((0, by_user), (1, by_item)):
        for i, j in ((0, 0), (3, 2), (5, 4), (2, 5)):
            moved = [[user.copy(), item.copy()] for _ in range(2)]
            moved[0][which][i, j] += eps
            moved[1][which][i, j] -= eps
            assert gradient[i, j] == pytest.approx((loss(shared, *moved[0]) - loss(shared, *moved[1])) / (2 * eps), abs=1e-5)


def test_a_step_adds_the_rows_of_a_number_one_by_one():
    rng = np.random.default_rng(3)
    for numbers, kind in ((5, np.uint16), (400, np.int64), (1, np.uint16)):
        at, values = rng.integers(0, numbers, 300).astype(kind), rng.normal(size=(300, 6)).astype(np.float32)
        rows, place = np.unique(at, return_inverse=True)
        summed = np.zeros((len(rows), 6), dtype=np.float32)
        np.add.at(summed, place, values)
        found = ncf_training.row_sums(at, values)
        assert np.array_equal(found[0], rows) and np.array_equal(found[1], summed)


def test_tasks_hold_few_blocks_and_rounds_do_not_sort_pairs(spark, monkeypatch):
    buckets, rounds = [], []
    monkeypatch.setattr(ncf_training, "BLOCK_USERS", 2)

    def saved(df, path, column, n=None, save=ncf_training.save_bucketed):
        table = save(df, path, column, n)
        buckets.append(len({f.rsplit("_", 1)[-1] for f in table.inputFiles()}))
        return table

    def stored(df, label, keep=ncf_training.settled):
        rounds.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df, label)

    monkeypatch.setattr(ncf_training, "save_bucketed", saved)
    monkeypatch.setattr(ncf_training, "settled", stored)
    ncf_training.train(neural.labelled_pairs(planted(spark, users=200), 60), 60, rank=4, rounds=2)
    # About 100 blocks; by cores alone there were 8 buckets.
    assert buckets[0] > 16
    assert len(rounds) == 3 and "ShuffledHashJoin" in rounds[1] and not any("SortMergeJoin" in plan for plan in rounds)


def test_parts_of_a_split_are_read_from_stored_digests(spark):
    pairs = neural.labelled_pairs(planted(spark, users=50), 60)
    for part in neural.stratified_split(pairs):
        plan = part._jdf.queryExecution().optimizedPlan().toString()
        assert "md5" not in plan
        assert part.columns == ["user_id", "item", "label"]


def test_recommenders_share_what_users_bought(spark, monkeypatch):
    held = planted(spark, users=120).select("user_id", F.explode("items").alias("item"))
    df = held.select("user_id", F.format_string("name %02d", "item").alias("product_name"))
    items = neighbours.catalogue(df, 60)
    bought = items, neighbours.bought_items(df, items).persist()
    for users in (None, 70):
        apart = neighbours.run_knn_recommender(df, users, 60).collect(), neural.run_ncf(df, users, 60).collect()
        with monkeypatch.context() as patched:
            # Nothing is left to look up in the lines.
            patched.setattr(neighbours, "bought_items", None)
            shared = (
                neighbours.run_knn_recommender(df, users, 60, bought).collect(),
                neural.run_ncf(df, users, 60, bought=bought).collect(),
            )
        for one, other in zip(apart, shared):
            assert one[0].asDict() == pytest.approx(other[0].asDict())
    bought[1].unpersist()
