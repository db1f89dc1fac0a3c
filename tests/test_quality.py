"""Quality rules: one-pass suites against plain counting, reports against hand counts."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tierloom.operators import quality
from tierloom.plans import checks


def issues(df):
    return {r.check_name: r.issue_count for r in df.collect()}


@pytest.fixture
def lines(spark):
    return spark.createDataFrame(
        [
            (1, "A", 5, 10.0, 2, "V1"), (1, "B", -1, 4.0, 4, "V9"), (2, None, 0, 3.0, 3, None),
            (3, " ", None, 1.0, 2, "V1"), (3, "C", 7, 2.005, 2, "V2"),
        ],
        "id int, code string, n int, total double, part int, vendor string",
    )


@pytest.fixture
def vendors(spark):
    return spark.createDataFrame([("V1",), ("V2",), (None,)], "v string")


def test_rules(lines, vendors):
    rules = [
        quality.not_null("lines", "code"),
        quality.not_blank("lines", "code", "blank code"),
        quality.unique("lines", "id"),
        quality.unique("lines", "id", "part"),
        quality.in_set("lines", "code", ["A", "B"]),
        quality.bound("lines", "n", "<=", 0, "n not positive"),
        quality.consistent("lines", "total", "part", "total differs"),
        quality.consistent("lines", "total", "part", "total differs much", 0.01),
        quality.references("lines", "vendor", "vendors", "v"),
        quality.ReferenceRule("lines", "known vendor", "vendor", "vendors", "v", exists=True),
    ]
    assert issues(quality.run_suite({"lines": lines, "vendors": vendors}, rules, "layer.")) == {
        "layer.lines - NULL code": 1,
        "layer.lines - blank code": 2,
        "layer.lines - duplicate id": 2,
        "layer.lines - duplicate (id, part)": 1,
        "layer.lines - invalid code": 2,
        "layer.lines - n not positive": 2,
        "layer.lines - total differs": 3,
        "layer.lines - total differs much": 2,
        "layer.lines - unresolved vendor": 1,
        "layer.lines - known vendor": 3,
    }


def test_empty_tables_have_no_issues(lines, vendors):
    rules = [
        quality.not_null("lines", "code"), quality.unique("lines", "id"),
        quality.references("lines", "vendor", "vendors", "v"),
    ]
    empty = {"lines": lines.limit(0), "vendors": vendors}
    assert set(issues(quality.run_suite(empty, rules)).values()) == {0}


def test_row_rules_of_a_table_share_one_pass(spark, plan_of, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select("id", F.col("id").alias("n"), F.lit("x").alias("unused")).write.parquet(path)
    rules = [quality.not_null("t", "id"), quality.bound("t", "n", "<", 3, "low"), quality.in_set("t", "n", [1])]
    suite = quality.run_suite({"t": spark.read.parquet(path)}, rules)
    plan = plan_of(suite)
    assert plan.count("FileScan") == 1 and "unused" not in plan
    assert issues(suite) == {"t - NULL id": 0, "t - low": 3, "t - invalid n": 9}


def test_number_of_checks():
    cleansed, star = checks.cleansed_rules("2024-06-30"), checks.star_rules("2024-06-30")
    assert (len(cleansed), len(star)) == (71, 53)
    for rules in (cleansed, star):
        names = [(r.table, r.name) for r in rules]
        assert len(set(names)) == len(names)
    kinds = [type(r).__name__ for r in cleansed]
    assert (kinds.count("UniqueRule"), kinds.count("ReferenceRule")) == (12, 1)
    assert [type(r).__name__ for r in star].count("UniqueRule") == 7


def test_match_rates(spark):
    fact = spark.createDataFrame([(1, None), (2, 1), (None, None)], "product_key int, customer_key int")
    rates = checks.sales_match_rates(fact)
    assert rates.first().asDict() == {
        "total_sales": 3, "matched_products": 2, "matched_customers": 1,
        "product_match_pct": Decimal("66.7"), "customer_match_pct": Decimal("33.3"),
    }
    assert dict(rates.dtypes)["product_match_pct"] == "decimal(5,1)"
    empty = checks.sales_match_rates(fact.limit(0)).first()
    assert (empty.total_sales, empty.product_match_pct) == (0, None)


def test_match_rate_reports_of_the_other_facts(spark):
    po = spark.createDataFrame(
        [("V", 1, 0), (None, 1, 1)], "vendor_id string, product_id int, flag_missing_vendor int"
    )
    assert checks.purchase_order_match_rates(po).first().asDict() == {
        "total_pos": 2, "matched_vendors": 1, "matched_products": 2, "flagged_missing_vendor": 1,
        "vendor_match_pct": Decimal("50.0"), "product_match_pct": Decimal("100.0"),
    }
    assert checks.inventory_match_rates(po).first().asDict() == {
        "total_inv_snapshots": 2, "matched_products": 2, "product_match_pct": Decimal("100.0"),
        "unmatched_products": 0,
    }


def test_profile(lines):
    profile = {r.column_name: tuple(r)[1:] for r in quality.column_profile(lines, ["code", "id"]).collect()}
    assert profile == {"code": (5, 1, 1, 4, 0), "id": (5, 0, 0, 3, 2)}


def test_values(lines):
    counted = {(r.column_name, r.value): r.row_count for r in quality.column_values(lines, ["part", "vendor"]).collect()}
    assert counted == {
        ("part", "2"): 3, ("part", "4"): 1, ("part", "3"): 1,
        ("vendor", "V1"): 2, ("vendor", "V9"): 1, ("vendor", "V2"): 1, ("vendor", None): 1,
    }
