"""Sketches, profiles of many tables, uniqueness rules in one exchange, keys under a collation, numbers that do not fit."""

import pytest
from pyspark.sql import functions as F

from tierloom.functions.collation import SOURCE
from tierloom.operators import quality, sketches
from tierloom.operators.dedup import first_per_key, latest_per_key
from tierloom.operators.references import exclude_orphans, flag_missing_ref, resolve
from tierloom.plans import cleanse
from tierloom.plans.refresh import cleanse_all, read_cleansed
from tierloom.sources.landing import LANDING_SCHEMAS
from tierloom.sources.versions import publish
from workload.operators import sketches_of_extracts

VALUES = [("a", 1, None), ("", 1, "x"), (" ", 2, "x"), (None, 3, "y"), ("a", None, "y"), ("b", 1, "y")]


@pytest.fixture
def values(spark):
    return spark.createDataFrame(VALUES, "t string, n int, u string")


def by_column(df):
    return {r.column_name: r.asDict() for r in df.collect()}


def test_sketches_of_few_values_are_exact(values):
    found = by_column(sketches.sketched_profile(sketches.column_sketches(values, values.columns)))
    assert [(found[c]["row_count"], found[c]["null_count"], found[c]["blank_count"], found[c]["distinct_estimate"]) for c in "tnu"] == [
        (6, 1, 2, 4), (6, 1, 0, 3), (6, 1, 0, 2),
    ]
    assert {x.item: x["count"] for x in found["t"]["frequent"]} == {"a": 2, "": 1, " ": 1, "b": 1}
    assert found["u"]["frequent"][0].item == "y" and found["u"]["frequent"][0]["count"] == 3


def test_sketches_of_nothing(values):
    found = by_column(sketches.sketched_profile(sketches.column_sketches(values.limit(0), ["t"])))
    assert (found["t"]["row_count"], found["t"]["distinct_estimate"], found["t"]["frequent"]) == (0, 0, [])


def test_estimates_keep_their_error_and_merge(spark):
    df = spark.range(200_000).select(F.concat(F.lit("k"), F.col("id") % 60_000).alias("k"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("h"))
    whole = by_column(sketches.sketched_profile(sketches.column_sketches(df, ["k", "h"])))
    parts = [sketches.column_sketches(df.where(F.xxhash64("k", "h") % 5 == i), ["k", "h"]) for i in range(-4, 5)]
    merged = by_column(sketches.sketched_profile(sketches.merged_sketches(parts)))
    for found in (whole, merged):
        assert abs(found["k"]["distinct_estimate"] / 60_000 - 1) < 4 * sketches.relative_error()
        assert found["h"]["row_count"] == 200_000 and found["h"]["frequent"][0].item == "hot"


def test_sketches_shuffle_one_row_for_each_task(spark, plan_of):
    plan = plan_of(sketches.column_sketches(spark.range(10).selectExpr("id", "cast(id as string) as t"), ["id", "t"]))
    assert plan.count("Exchange") == 1 and "SinglePartition" in plan and "partial_hll_sketch_agg" in plan


def test_adaptive_profile_counts_small_columns(spark):
    df = spark.range(5000).select(F.col("id").alias("many"), (F.col("id") % 7).alias("few"), (F.col("id") % 900).alias("asked"))
    found = by_column(sketches.adaptive_profile(df, df.columns, small=100, exact=["asked"]))
    assert {c: r["is_exact"] for c, r in found.items()} == {"many": False, "few": True, "asked": True}
    assert (found["few"]["distinct_count"], found["asked"]["distinct_count"], found["asked"]["repeated_count"]) == (7, 900, 4100)
    assert abs(found["many"]["distinct_count"] - 5000) < 5000 * 4 * sketches.relative_error()
    assert sketches.adaptive_profile(df, ["many"], small=1).count() == 1


def test_profiles_of_several_tables(spark, values, plan_of):
    other = values.select("n").limit(0)
    profiles = quality.column_profiles({"a": values, "b": other, "c": values.select(F.col("u").alias("n"))})
    assert plan_of(profiles).split("Initial Plan")[-1].count("Exchange hashpartitioning") == 2
    found = {(r.table_name, r.column_name): tuple(r)[2:] for r in profiles.collect()}
    assert found == {("a", "t"): (6, 1, 2, 4, 1), ("a", "n"): (6, 1, 0, 3, 2), ("a", "u"): (6, 1, 0, 2, 3), ("c", "n"): (6, 1, 0, 2, 3)}


def test_uniqueness_rules_share_an_exchange(spark, plan_of):
    a = spark.createDataFrame([(1, "x", 0.0), (1, "x", -0.0), (2, None, 1.0), (2, None, 1.0), (3, "1:x", 2.0)], "id int, t string, d double")
    b = spark.createDataFrame([("k" * 100,), ("k" * 100,), ("k" * 99,), (None,), (None,), ("",)], "t string")
    rules = [quality.unique("a", "id"), quality.unique("a", "id", "t"), quality.unique("a", "d"), quality.unique("b", "t"), quality.unique("c", "t")]
    report = quality.run_suite({"a": a, "b": b, "c": b.limit(0)}, rules)
    assert {r.check_name: r.issue_count for r in report.collect()} == {
        "a - duplicate id": 2, "a - duplicate (id, t)": 2, "a - duplicate d": 2, "b - duplicate t": 2, "c - duplicate t": 0,
    }
    only_a = plan_of(quality.run_suite({"a": a}, rules[:3]))
    assert only_a.count("Scan ExistingRDD") == 1 and only_a.count("hashpartitioning") == 1


def test_parts_of_a_key_are_kept_apart(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), ("1:a", None), (None, "1:a"), ("a-", ""), ("a", "-")], "x string, y string")
    report = quality.run_suite({"t": df}, [quality.unique("t", "x", "y")])
    assert report.first().issue_count == 0


def test_keys_under_a_collation(spark):
    df = spark.createDataFrame([("Ab ", 1), ("aB", 2), ("c", 3), (None, 4), ("AB", 2)], "k string, n int")
    latest = latest_per_key(df, ["k"], "n", collation=SOURCE)
    assert sorted((tuple(r) for r in latest.collect()), key=str) == sorted([("AB", 2), ("c", 3), (None, 4)], key=str)
    assert dict(latest.dtypes)["k"] == "string" and latest_per_key(df, ["k"], "n").count() == 5
    assert first_per_key(df, ["k"], ["n"], collation=SOURCE).count() == 3
    known = spark.createDataFrame([("aB",), ("AB  ",), (None,), ("z",)], "name string")
    assert exclude_orphans(df, "k", known, "name", SOURCE).count() == 3 and exclude_orphans(df, "k", known, "name").count() == 1
    flagged = flag_missing_ref(df, "k", known, "name", "missing", SOURCE)
    assert sorted((r.n, r.missing) for r in flagged.collect()) == [(1, 0), (2, 0), (2, 0), (3, 1), (4, 1)]
    assert resolve(df, "k", known, "name", SOURCE).count() == 3 * 2 + 2
    for folded, issues in ((True, 1), (False, 0)):
        report = quality.run_suite({"t": df}, [quality.unique("t", "k", folded=folded)])
        assert report.first().issue_count == issues


def test_collated_joins_shuffle_by_key(spark, plan_of):
    a, b = (spark.createDataFrame([("x",)], f"{n} string") for n in "ab")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = plan_of(resolve(a, "a", b, "b", SOURCE))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "NestedLoop" not in plan


BIG, HUGE = "3000000000", "99999999999999999999"


def landed_rows(spark, table, lines):
    return spark.createDataFrame(lines, LANDING_SCHEMAS[table])


def test_stock_and_quantities_beyond_32_bits(spark):
    products = spark.createDataFrame([(1,)], "prd_id long")
    stock = landed_rows(spark, "erp_inv_q4v1", [("I1", "1", "w", BIG, BIG, "2024-01-01"), ("I2", "1", "w", HUGE, "x", "2024-01-01"), ("I3", "1", "w", "", "5", None)])
    found = {r.inv_id: r for r in cleanse.clean_inventory(stock, products, misfits=True).collect()}
    assert found["I1"].inv_stock_on_hand == found["I1"].inv_reorder_level == int(BIG) and found["I1"]["_misfit"] is None
    assert found["I2"]["_misfit"] == f"inv_stock_on_hand: {HUGE}" and found["I3"]["_misfit"] is None
    vendors = spark.createDataFrame([("V",)], "vnd_id string")
    orders = landed_rows(spark, "erp_po_ord44", [("P1", "V", "1", BIG, "2", None), ("P2", "V", "1", "1e30", "2", None)])
    bought = {r.po_number: r for r in cleanse.clean_purchase_orders(orders, vendors, misfits=True).collect()}
    assert (bought["P1"].po_quantity_ordered, bought["P1"].total_cost) == (int(BIG), 2.0 * int(BIG))
    assert bought["P2"]["_misfit"] == "po_quantity_ordered: 1e30"
    assert "_misfit" not in cleanse.clean_purchase_orders(orders, vendors).columns


def test_a_number_that_does_not_fit_is_an_outcome_of_the_load(spark, tmp_path):
    landed, cleansed = str(tmp_path / "landed"), str(tmp_path / "cleansed")
    for table, schema in LANDING_SCHEMAS.items():
        lines = {"erp_po_ord44": [("P1", None, "1", "7", "2", None), ("P2", None, "1", HUGE, "2", None)]}.get(table, [])
        publish(spark.createDataFrame(lines, schema), f"{landed}/{table}")
    with pytest.raises(Exception, match=f"po_quantity_ordered: {HUGE}"):
        cleanse_all(spark, landed, cleansed, "2024-06-30")
    cleanse_all(spark, landed, cleansed, "2024-06-30", hold_back=True)
    kept = read_cleansed(spark, cleansed, "erp_po_ord44")
    assert [r.po_number for r in kept.collect()] == ["P1"] and "_misfit" not in kept.columns
    assert [(r.po_number, r["_misfit"]) for r in read_cleansed(spark, cleansed, "erp_po_ord44", held_back=True).collect()] == [("P2", f"po_quantity_ordered: {HUGE}")]


def test_sketched_extracts_are_derived_once(spark, plan_of, tmp_path):
    days = "TIMESTAMP_NTZ'2024-01-05'"
    spark.range(6).selectExpr("id AS o_orderkey", "id AS o_custkey", f"{days} AS o_orderdate", "'1-URGENT' AS o_orderpriority", "1D AS o_totalprice").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(24).selectExpr(
        "id div 5 AS l_orderkey", "id AS l_partkey", "id AS l_suppkey", "cast(id AS int) AS l_linenumber", "2D AS l_quantity", "9D AS l_extendedprice", f"{days} AS l_shipdate"
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(0).selectExpr("id AS event_id", f"{days} AS ts", "id AS user_id").write.parquet(f"{tmp_path}/events.parquet")
    result = sketches_of_extracts(spark, str(tmp_path))
    assert str(tmp_path) not in plan_of(result)  # sketches and exact counts read what was stored, not the tables and their join
    found = {(r.extract, r.column_name): r for r in result.collect()}
    assert found["crm_sales_details", "sls_ord_num"].row_count == 24 and found["crm_sales_details", "sls_ord_num"].most == 5
    assert found["crm_cust_info", "cst_id"].null_count == 1 and all(r.estimate_is_near for r in found.values() if r.row_count)
    assert not any(extract == "crm_supp_tkts" and r.row_count for (extract, _), r in found.items())
