"""Every named query runs, and agrees with its SQL where there is one."""

import pytest
from comparing import connect, difference

import __spark_entry__ as entry_points
from trolley.operators import neural
from trolley.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_query_agrees_with_sql(spark, connection, name):
    assert difference(QUERIES[name](spark, FOLDER), connection, ORACLES[name]) is None


def rows(spark, name):
    return QUERIES[name](spark, FOLDER).collect()


def test_segments(spark):
    sweep = sorted(rows(spark, "kmeans_sweep"))
    assert [r["k"] for r in sweep] == list(range(2, 8))
    assert all(-1 <= r["silhouette"] <= 1 and r["wssse"] > 0 for r in sweep)
    best = max(sweep, key=lambda r: (r["silhouette"], -r["k"]))["k"]
    assigned = rows(spark, "kmeans_best")
    assert {r["cluster"] for r in assigned} == set(range(best))
    users = {r["user_id"]: r for r in rows(spark, "rfm_trimmed")}
    assert {r["user_id"] for r in assigned} == set(users)
    summary = {r["cluster"]: r for r in rows(spark, "cluster_summary")}
    for cluster, row in summary.items():
        inside = [r["monetary"] for r in assigned if r["cluster"] == cluster]
        assert row["count"] == len(inside) and row["avg_monetary"] == pytest.approx(sum(inside) / len(inside))
    (index,) = rows(spark, "davies_bouldin")
    assert index["clusters"] == best and index["davies_bouldin"] > 0


def test_als(spark):
    train = [r for r in rows(spark, "train_test_split") if r["part"] == "train"]
    sizes = {r["side"]: (r["ids"], r["rank"]) for r in rows(spark, "als_fit")}
    products = {r["product_id"] for r in train}
    assert sizes == {"user": (len({r["user_id"] for r in train}), 10), "product": (len(products), 10)}
    best = rows(spark, "als_top5")
    assert len(best) == 5 * sizes["user"][0] and {r["product_id"] for r in best} <= products
    by_user = {}
    for r in sorted(best, key=lambda r: (r["user_id"], r["place"])):
        by_user.setdefault(r["user_id"], []).append(r["score"])
    assert all(scores == sorted(scores, reverse=True) for scores in by_user.values())
    ranked = {r["model"]: r for r in rows(spark, "als_rank_metrics")}
    (popular,) = rows(spark, "popularity_rank_metrics")
    assert all(ranked["popularity"][c] == popular[c] for c in ("users", "precision", "recall", "ndcg", "map"))
    assert all(0 <= ranked["als"][c] <= 1 for c in ("precision", "recall", "ndcg", "map"))
    (error,) = rows(spark, "als_rmse")
    assert error["pairs"] > 0 and 0 < error["rmse"] < 3


def test_neural_scores(spark):
    scored = rows(spark, "neural_cf")
    assert len(scored) == sum(r["part"] == "test" for r in rows(spark, "stratified_split"))
    assert all(0 <= r["score"] <= 1 for r in scored)
    compared = {r["model"]: r for r in rows(spark, "neural_cf_metrics")}
    assert set(compared) == {"neural", "als", "share"}
    found = compared["neural"]
    hits = sum(r["label"] and r["score"] >= 0.5 for r in scored)
    said, true = sum(r["score"] >= 0.5 for r in scored), sum(r["label"] for r in scored)
    assert found["precision"] == pytest.approx(hits / said if said else 0.0)
    assert found["recall"] == pytest.approx(hits / true)
    ups, downs = ([r["score"] for r in scored if r["label"] == kind] for kind in (1, 0))
    wins = sum((u > d) + 0.5 * (u == d) for u in ups for d in downs)
    assert found["auc"] == pytest.approx(wins / len(ups) / len(downs))


def test_compared_scores_are_stored_before_they_are_read_twice(spark, monkeypatch):
    seen, compared = {}, neural.compared
    monkeypatch.setattr(neural, "compared", lambda scores: seen.update(scores) or compared(scores))
    rows(spark, "neural_cf_metrics")
    assert set(seen) == {"neural", "als", "share"}
    assert not any("Join" in table._jdf.queryExecution().optimizedPlan().toString() for table in seen.values())


def test_forecasts(spark):
    found = rows(spark, "arima_forecast")
    assert {(r["series"], r["week"], r["y"]) for r in found} == {
        (r["series"], r["week"], r["y"]) for r in rows(spark, "time_split") if r["part"] == "test"
    }
    errors = {}
    for r in found:
        errors.setdefault(r["series"], []).append((r["y"] - r["forecast"]) ** 2)
    for r in rows(spark, "forecast_rmse"):
        assert r["rmse"] == pytest.approx((sum(errors[r["series"]]) / len(errors[r["series"]])) ** 0.5)


def test_training_workflow_has_all_tables(spark):
    found = {r["name"]: r["row_count"] for r in rows(spark, "training_workflow")}
    assert set(found) == {"clusters", "cluster_summary", "davies_bouldin", "knn", "ncf", "forecasts", "forecast_rmse"}
    assert all(found.values())


def test_entry(spark):
    assert entry_points.entry(spark).count() == 25
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
