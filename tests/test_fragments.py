"""Cutting, checking, querying and rebuilding, with the odd cases."""

import pytest
from frames import bag, line, lines
from pyspark.sql import functions as F

from trolley.operators import fragments
from trolley.plans import catalog, workflows
from trolley.registry.queries import SITES, relation, vertical
from trolley.sources import storage
from trolley.sources.order_lines import COLUMNS

FOLDER = "/root/testdata/sf0.001"
TWO = {"site_1": ["a", "b"], "site_2": ["c"]}


@pytest.fixture
def odd(spark):
    """Equal rows, a null department, and one of no site."""
    return lines(
        spark,
        [line(dep="a"), line(dep="a"), line(order=2, dep="b"), line(order=3, dep="c"), line(dep=None), line(dep="z")],
    )


def test_rows_of_no_site_fail_completeness(odd):
    found = fragments.check_completeness(odd, fragments.horizontal_fragment(odd, TWO)).collect()[0]
    assert tuple(found) == (6, 4, 2, "FAIL")


def test_complement_takes_other_departments_but_no_nulls(odd):
    pieces = fragments.horizontal_complement(odd, ["a", "b"])
    assert {s: p.count() for s, p in pieces.items()} == {"site_1": 3, "site_2": 2}


def test_shares_are_of_the_whole(odd):
    shares = fragments.fragment_shares(odd, fragments.horizontal_fragment(odd, TWO))
    assert bag(shares) == {("site_1", 3, 50.0): 1, ("site_2", 1, 100 / 6): 1}


def test_disjointness_is_by_value(odd):
    assert fragments.check_disjointness(fragments.horizontal_fragment(odd, TWO)).collect()[0] == (0, "PASS")
    both = {"x": odd.filter("department IS NULL"), "y": odd}
    assert fragments.check_disjointness(both).collect()[0] == (1, "FAIL")
    repeated = {"x": odd.filter("department = 'a'"), "y": odd.filter("department = 'c'")}
    assert fragments.check_disjointness(repeated).collect()[0] == (0, "PASS")


def test_default_sites_use_the_grocery_departments(spark):
    df = lines(spark, [line(dep="produce"), line(dep="unknown"), line(dep="Brand#1")])
    assert {s: p.count() for s, p in fragments.horizontal_fragment(df).items()} == {"site_1": 1, "site_2": 1}


def test_both_rebuilds_give_the_relation(spark, tmp_path):
    whole = relation(spark, FOLDER)
    rows = fragments.reconstruct_horizontal(fragments.horizontal_fragment(whole, SITES))
    assert bag(rows) == bag(whole)
    # The two fragments are numbered apart from each other, on different partitionings.
    left = fragments.vertical_fragment(whole.repartition(13))["site_1_order_info"]
    right = fragments.vertical_fragment(whole.coalesce(1))["site_2_product_info"]
    rebuilt = fragments.reconstruct_vertical({"x": left, "y": right}, COLUMNS)
    assert bag(rebuilt) == bag(whole)
    pieces = {"x": left, "y": right}
    storage.save_fragments(pieces, str(tmp_path), "vertical")
    loaded = storage.load_fragments(spark, str(tmp_path), "vertical")
    assert list(loaded) == ["x", "y"]
    assert bag(loaded["y"]) == bag(right)
    assert storage.load_fragments(spark, str(tmp_path), "horizontal") == {}


def test_equal_rows_survive_the_vertical_rebuild(odd):
    pieces = fragments.vertical_fragment(odd)
    assert bag(fragments.reconstruct_vertical(pieces, odd.columns)) == bag(odd)
    assert {r["status"] for r in fragments.check_lossless_key(pieces).collect()} == {"PASS"}


def test_missing_key_and_missing_column_are_reported(odd):
    pieces = fragments.vertical_fragment(odd, {"x": ["order_id", "department"], "y": ["_row_id", "product_name"]})
    status = {r["site"]: r["status"] for r in fragments.check_lossless_key(pieces).collect()}
    assert status == {"x": "FAIL", "y": "PASS"}
    coverage = fragments.check_column_coverage(odd, pieces).collect()[0]
    assert coverage["missing_columns"] == 9 and coverage["status"] == "FAIL"


def test_repeated_key_is_reported(odd):
    pieces = {"x": odd.withColumn("_row_id", F.lit(1).cast("long"))}
    assert fragments.check_lossless_key(pieces).collect()[0]["status"] == "FAIL"


def test_vertical_query_joins_only_what_it_needs(odd):
    pieces = fragments.vertical_fragment(storage.settled(fragments.add_row_id(odd), "keyed"))

    def joins(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("Join")

    one = fragments.distributed_query_vertical(pieces, ["order_id", "department"], F.col("reordered") == 0)
    two = fragments.distributed_query_vertical(pieces, ["department"], "order_dow < 3")
    assert (joins(one), joins(two)) == (0, 1)
    assert one.columns == ["order_id", "department"]
    assert bag(two) == bag(odd.filter("order_dow < 3"), "department")
    with pytest.raises(ValueError, match="in no fragment"):
        fragments.distributed_query_vertical(pieces, ["nothing"])


def test_local_top_k_can_miss_what_the_merged_counts_find(spark):
    rows = []
    for site, names in (("a", "xxxxyyyz"), ("c", "wwwwyyyv")):
        rows += [line(dep=site, name=n, cart=i) for i, n in enumerate(names)]
    pieces = fragments.horizontal_fragment(lines(spark, rows), TWO)
    assert catalog.top_products_merged(pieces, 1).collect()[0] == ("y", 6)
    assert fragments.topk_local_merge(pieces, 1).collect()[0]["product_name"] == "w"


def test_mean_over_sites_leaves_out_nulls(spark):
    df = lines(spark, [line(dep="a", reordered=1), line(dep="a", reordered=None), line(dep="c", reordered=0)])
    found = bag(fragments.avg_weighted_merge(fragments.horizontal_fragment(df, TWO)))
    assert found == {("a", 1.0): 1, ("c", 0.0): 1}


def test_rank_keeps_ties(spark):
    rows = [line(dep="a", name=n, cart=i, reordered=1) for n in "pqr" for i in range(2)]
    rows += [line(dep="a", name="s", cart=i, reordered=int(i == 0)) for i in range(2)]
    found = catalog.product_rank_in_department(lines(spark, rows), more_than=1, k=4)
    assert [(r["product_name"], r["dept_rank"]) for r in found.collect()] == [("p", 1), ("q", 1), ("r", 1), ("s", 4)]


def test_workflows_over_stored_fragments(spark, tmp_path):
    whole = relation(spark, FOLDER)
    with pytest.raises(ValueError, match="no fragments"):
        workflows.bootstrap_fragments(spark, str(tmp_path / "none"), predicates=SITES)
    store = workflows.bootstrap_fragments(spark, str(tmp_path / "store"), whole, SITES)
    results = workflows.sql_workflow(store)
    assert bag(results["q8_centralized"]) == bag(results["q8_distributed"])
    assert spark.sql("SELECT COUNT(*) FROM v_site_1 JOIN v_site_2 USING (_row_id)").collect()[0][0] == whole.count()
    # No rows are cut off unless the caller asks for it.
    assert catalog.run_sql(spark, "SELECT * FROM global_relation").count() == whole.count() > 200
    assert catalog.run_sql(spark, "SELECT * FROM global_relation", 200).count() == 200
    parts = workflows.fragmentation_workflow(store.relation, str(tmp_path / "work"), SITES)
    for check in ("completeness", "disjointness", "column_coverage", "lossless_key"):
        assert {r["status"] for r in parts[check].collect()} == {"PASS"}
    assert bag(parts["rebuilt_from_columns"]) == bag(store.relation)


def test_joining_stored_vertical_fragments_moves_no_rows(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        pieces = vertical(spark, FOLDER)
        joined = fragments.distributed_query_vertical(pieces, ["order_dow", "product_name"], "order_hour_of_day < 10")
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert bag(joined) == bag(relation(spark, FOLDER).filter("order_hour_of_day < 10"), "order_dow", "product_name")


def test_missing_and_unfinished_sites_are_errors(spark, tmp_path):
    whole = relation(spark, FOLDER)
    storage.save_horizontal(whole, SITES, str(tmp_path))
    assert set(storage.load_fragments(spark, str(tmp_path))) == set(SITES)
    with pytest.raises(ValueError, match="site_9"):
        storage.load_fragments(spark, str(tmp_path), site_names=["site_1", "site_9"])
    # What a broken-off write leaves behind: data, and no list of sites.
    storage.delete(spark, f"{tmp_path}/fragments_horizontal_sites")
    assert storage.load_fragments(spark, str(tmp_path)) == {}
    with pytest.raises(ValueError, match="site_1"):
        storage.load_fragments(spark, str(tmp_path), site_names=["site_1"])
    (tmp_path / "fragments_vertical_sites").mkdir()
    with pytest.raises(ValueError, match="no fragments"):
        workflows.bootstrap_fragments(spark, str(tmp_path), predicates=SITES)


def test_a_site_is_read_alone(spark, tmp_path):
    storage.save_horizontal(relation(spark, FOLDER), SITES, str(tmp_path))
    part = storage.load_fragments(spark, str(tmp_path))["site_1"]
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(site" in plan
    assert bag(part) == bag(relation(spark, FOLDER).filter(F.col("department").isin(SITES["site_1"])))


def test_two_sites_cannot_share_a_view(spark):
    frame = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError, match="v_site_1"):
        catalog.register_views(frame, {}, {"site_1_a": frame, "site_1_b": frame})


def test_sql_errors_are_told(spark):
    result, error = catalog.run_sql_or_error(spark, "SELEC 1")
    assert result is None and "SYNTAX" in error.upper()
    result, error = catalog.run_sql_or_error(spark, "SELECT 1 AS one")
    assert error is None and result.collect()[0]["one"] == 1


def test_fractions_of_days_count(spark):
    lines = spark.createDataFrame([(1, 1, 0.9), (1, 2, 0.9)], "user_id long, order_id long, days_since_prior_order double")
    assert catalog.most_active_users(lines).collect()[0]["avg_days_between_orders"] == 0.9
