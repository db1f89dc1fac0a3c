"""The quality suites of the cleansed tables and of the star schema, written down as rules."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierloom.functions import fixed_values as fixed
from tierloom.operators.quality import (
    ReferenceRule,
    RowRule,
    Rule,
    bound,
    consistent,
    in_set,
    match_rates,
    not_before,
    not_blank,
    not_future,
    not_null,
    run_suite,
    unique,
)

# Prefixes of the layers in names of checks and tables.
CLEANSED_PREFIX = "silver."
STAR_PREFIX = "gold."
# Fixed value: what two computations of a cost may differ by.
COST_TOLERANCE = 0.01

_STOCK_FLAG = "CASE WHEN {stock} < {level} THEN 1 ELSE 0 END"


def _day(as_of) -> str:
    """The day of the rules; today is the session's, as it is for the cleansing."""
    return str(as_of) if as_of is not None else "current_date()"


def _nulls(table: str, *columns: str) -> list[RowRule]:
    return [not_null(table, column) for column in columns]


def cleansed_rules(as_of=None) -> list[Rule]:
    """The 71 rules of the cleansed tables. All are 0 on clean data but the duplicate order numbers:
    an order has as many rows as it has lines."""
    today = _day(as_of)
    labels = {
        ("crm_cust_info", "cst_marital_status"): [*fixed.MARITAL_STATUS, fixed.NOT_AVAILABLE],
        ("crm_prd_info", "prd_line"): [*fixed.PRODUCT_LINE, fixed.NOT_AVAILABLE],
        ("crm_camp_info", "cmp_channel"): [*fixed.CAMPAIGN_CHANNEL, fixed.OTHER],
        ("crm_supp_tkts", "tkt_status"): [*fixed.TICKET_STATUS, fixed.UNKNOWN],
        ("crm_supp_tkts", "tkt_issue_cat"): [*fixed.ISSUE_CATEGORY, fixed.UNKNOWN],
        ("erp_cust_az12", "gen"): [*fixed.ERP_GENDER, fixed.NOT_AVAILABLE],
    }
    return [
        # missing values
        *_nulls("crm_cust_info", "cst_id", "cst_key", "cst_firstname", "cst_lastname"),
        *_nulls("crm_prd_info", "prd_id", "prd_key", "prd_nm", "cat_id"),
        *_nulls("crm_sales_details", "sls_ord_num", "sls_prd_key", "sls_cst_id"),
        *_nulls("crm_camp_info", "cmp_id", "cmp_name"),
        *_nulls("crm_supp_tkts", "tkt_id"),
        *_nulls("erp_cust_az12", "cid"),
        *_nulls("erp_loc_a101", "cid", "cntry"),
        *_nulls("erp_px_cat_g1v2", "id", "cat"),
        *_nulls("erp_hr_hx19", "emp_id", "emp_full_name", "emp_role"),
        *_nulls("erp_vnd_z90", "vnd_id", "vnd_name"),
        *_nulls("erp_inv_q4v1", "inv_id", "inv_prd_id"),
        *_nulls("erp_po_ord44", "po_number"),
        # repeated keys
        unique("crm_cust_info", "cst_id"),
        unique("crm_prd_info", "prd_key", "prd_start_dt"),
        unique("crm_sales_details", "sls_ord_num"),
        unique("crm_camp_info", "cmp_id"),
        unique("crm_supp_tkts", "tkt_id"),
        unique("erp_cust_az12", "cid"),
        unique("erp_loc_a101", "cid"),
        unique("erp_px_cat_g1v2", "id"),
        unique("erp_hr_hx19", "emp_id"),
        unique("erp_vnd_z90", "vnd_id"),
        unique("erp_inv_q4v1", "inv_id"),
        unique("erp_po_ord44", "po_number"),
        # values outside their vocabulary
        *(in_set(table, column, values) for (table, column), values in labels.items()),
        in_set(
            "crm_cust_info", "cst_gndr", [*fixed.CRM_GENDER, fixed.NOT_AVAILABLE],
            "invalid cst_gnder",
        ),
        not_blank("erp_hr_hx19", "emp_branch_id", "NULL or empty emp_branch_id"),
        not_blank("erp_vnd_z90", "vnd_name", "NULL vnd_name (should be Unknown Vendor)"),
        bound("erp_inv_q4v1", "inv_stock_on_hand", "<", 0, "negative inv_stock_on_hand"),
        consistent(
            "erp_inv_q4v1",
            "below_reorder",
            _STOCK_FLAG.format(stock="inv_stock_on_hand", level="inv_reorder_level"),
            "below_reorder flag mismatch",
        ),
        ReferenceRule(
            "erp_po_ord44", "flag_missing_vendor set but vendor exists",
            "po_vnd_id", "erp_vnd_z90", "vnd_id", exists=True, only_if="flag_missing_vendor = 1",
        ),
        RowRule(
            "erp_po_ord44", "flag_missing_vendor=0 but vendor is NULL",
            "po_vnd_id IS NULL AND flag_missing_vendor = 0",
        ),
        # dates out of order
        not_before("crm_sales_details", "sls_ship_dt", "sls_order_dt", "ship_dt before order_dt"),
        not_before("crm_sales_details", "sls_due_dt", "sls_order_dt", "due_dt before order_dt"),
        not_before("crm_prd_info", "prd_end_dt", "prd_start_dt", "prd_end_dt before prd_start_dt"),
        not_before(
            "crm_camp_info", "cmp_end_date", "cmp_start_date",
            "end_date < start_date (flag_invalid_date_range=0)", "flag_invalid_date_range = 0",
        ),
        RowRule(
            "crm_camp_info", "flagged as invalid but dates are valid",
            "flag_invalid_date_range = 1 AND cmp_end_date >= cmp_start_date",
        ),
        not_before(
            "crm_supp_tkts", "tkt_resolution_date", "tkt_open_date",
            "resolution_date before open_date",
        ),
        not_future("erp_cust_az12", "bdate", today, "future bdate"),
        not_future("erp_hr_hx19", "emp_hire_date", today, "future emp_hire_date"),
        not_future("erp_po_ord44", "po_order_date", today, "future po_order_date"),
        not_future("erp_inv_q4v1", "inv_snap_date", today, "future inv_snap_date"),
        # business rules
        *(
            bound("crm_sales_details", column, "<=", 0, f"zero or negative {column}")
            for column in ("sls_sales", "sls_quantity", "sls_price")
        ),
        bound("crm_prd_info", "prd_cost", "<", 0, "negative prd_cost"),
        bound("crm_camp_info", "cmp_budget", "<", 0, "negative cmp_budget"),
        bound(
            "erp_inv_q4v1", "inv_reorder_level", "<=", 0, "zero or negative inv_reorder_level"
        ),
        bound(
            "erp_po_ord44", "po_quantity_ordered", "<=", 0, "zero or negative po_quantity_ordered"
        ),
        consistent(
            "erp_po_ord44", "total_cost", "(po_quantity_ordered * po_unit_cost)",
            "total_cost mismatch vs qty * unit_cost", COST_TOLERANCE,
        ),
        consistent(
            "erp_hr_hx19", "emp_full_name",
            "coalesce(emp_first_name, '') || ' ' || coalesce(emp_last_name, '')",
            "emp_full_name mismatch (first + last)",
        ),
    ]


def star_rules(as_of=None) -> list[Rule]:
    """The 53 rules of the star schema. Unresolved products of tickets are expected, as tickets need
    not cite a product."""
    today = _day(as_of)
    return [
        # missing values
        *_nulls("dim_customers", "customer_id", "customer_number", "first_name", "last_name"),
        *_nulls("dim_products", "product_id", "product_number", "product_name", "category"),
        *_nulls("dim_employees", "employee_id", "employee_full_name", "job_title"),
        *_nulls("dim_vendors", "vendor_id", "vendor_name", "vendor_region"),
        *_nulls("dim_campaigns", "campaign_id", "campaign_name", "channel"),
        # joins that found nothing
        not_null("fact_sales", "product_key", "NULL product_key (unresolved product join)"),
        not_null("fact_sales", "customer_key", "NULL customer_key (unresolved customer join)"),
        not_null("fact_support_tickets", "id", "NULL id (ticket has no identifier)"),
        not_null(
            "fact_support_tickets", "product_key", "NULL product_key (unresolved product join)"
        ),
        not_null("fact_inventory", "product_id", "NULL product_id (unresolved product join)"),
        not_null("fact_purchase_orders", "product_id", "NULL product_id (unresolved product join)"),
        # repeated keys
        unique("dim_customers", "customer_id"),
        unique("dim_customers", "customer_key"),
        unique("dim_products", "product_id"),
        unique("dim_products", "product_key"),
        unique("dim_employees", "employee_id"),
        unique("dim_vendors", "vendor_id"),
        unique("dim_campaigns", "campaign_id"),
        # dates out of order
        not_before("fact_sales", "shipping_date", "order_date", "shipping_date before order_date"),
        not_before("fact_sales", "due_date", "order_date", "due_date before order_date"),
        not_before(
            "fact_support_tickets", "resolution_date", "open_date",
            "resolution_date before open_date",
        ),
        not_future("fact_purchase_orders", "order_date", today, "order_date in the future"),
        not_before(
            "dim_campaigns", "end_date", "start_date",
            "end_date before start_date (not flagged)", "flag_invalid_date_range = 0",
        ),
        not_future("dim_employees", "hire_date", today, "future hire_date"),
        RowRule(
            "dim_campaigns", "negative campaign_duration_days (not flagged)",
            "campaign_duration_days < 0 AND flag_invalid_date_range = 0",
        ),
        bound("dim_employees", "years_of_service", "<", 0, "negative years_of_service"),
        # business rules
        *(
            bound("fact_sales", column, "<=", 0, f"zero or negative {column}")
            for column in ("sales_amount", "quantity", "price")
        ),
        bound("fact_inventory", "stock_on_hand", "<", 0, "negative stock_on_hand"),
        bound("fact_inventory", "reorder_level", "<=", 0, "negative reorder_level"),
        consistent(
            "fact_inventory", "below_reorder",
            _STOCK_FLAG.format(stock="stock_on_hand", level="reorder_level"),
            "below_reorder flag mismatch",
        ),
        consistent(
            "fact_inventory", "stock_vs_reorder", "(stock_on_hand - reorder_level)",
            "stock_vs_reorder calculation mismatch",
        ),
        bound(
            "fact_purchase_orders", "quantity_ordered", "<=", 0, "zero or negative quantity_ordered"
        ),
        bound("fact_purchase_orders", "unit_cost", "<", 0, "negative unit_cost"),
        consistent(
            "fact_purchase_orders", "total_cost", "(quantity_ordered * unit_cost)",
            "total_cost calculation mismatch", COST_TOLERANCE,
        ),
        bound("fact_support_tickets", "days_to_resolve", "<", 0, "negative days_to_resolve"),
        bound("dim_campaigns", "budget", "<", 0, "negative budget"),
        bound("dim_products", "cost", "<", 0, "negative cost"),
        in_set("dim_employees", "seniority_band", fixed.SENIORITY_LABELS),
        in_set("dim_vendors", "vendor_region", [*fixed.VENDOR_REGION, fixed.OTHER]),
    ]


def check_cleansed(tables: Mapping[str, DataFrame], as_of=None) -> DataFrame:
    """Issue count of every rule of the cleansed tables."""
    return run_suite(tables, cleansed_rules(as_of), CLEANSED_PREFIX)


def check_star(tables: Mapping[str, DataFrame], as_of=None) -> DataFrame:
    """Issue count of every rule of the star schema."""
    return run_suite(tables, star_rules(as_of))


def sales_match_rates(fact: DataFrame) -> DataFrame:
    return match_rates(
        fact, "total_sales", {"products": "product_key", "customers": "customer_key"}
    )


def ticket_match_rates(fact: DataFrame) -> DataFrame:
    return match_rates(
        fact,
        "total_tickets",
        {"customers": "customer_id", "employees": "employee_id", "products": "product_key"},
    )


def purchase_order_match_rates(fact: DataFrame) -> DataFrame:
    """As the others, with the number of orders flagged for a missing vendor beside them."""
    flagged = F.when(F.col("flag_missing_vendor") == 1, F.lit(1))
    return match_rates(
        fact.withColumn("_flagged", flagged),
        "total_pos",
        {"vendors": "vendor_id", "products": "product_id", "flagged": "_flagged"},
    ).withColumnRenamed("matched_flagged", "flagged_missing_vendor").drop("flagged_match_pct")


def inventory_match_rates(fact: DataFrame) -> DataFrame:
    """As the others, with the number of unmatched products beside them."""
    rates = match_rates(fact, "total_inv_snapshots", {"products": "product_id"})
    return rates.withColumn(
        "unmatched_products", F.col("total_inv_snapshots") - F.col("matched_products")
    )
