"""Every quality rule on rows that break it: the counts are written down here, not taken from the rules."""

from datetime import date

import pytest

from tierloom.plans import checks

AS_OF = "2024-06-30"
D, LATER, EARLIER, FUTURE = date(2024, 1, 10), date(2024, 1, 20), date(2024, 1, 1), date(2024, 7, 1)

# table: schema, key that tells its rows apart, a clean row, and the changes of one broken row each
CLEANSED = {
    "crm_cust_info": (
        "cst_id long, cst_key string, cst_firstname string, cst_lastname string, cst_marital_status string, cst_gndr string",
        "cst_id", (0, "k", "f", "l", "Single", "n/a"),
        [{"cst_id": None}, {"cst_key": None}, {"cst_firstname": None}, {"cst_lastname": None}, {"cst_id": 1000}, {"cst_id": 1000}, {"cst_marital_status": "S"}, {"cst_gndr": "female"}],
    ),
    "crm_prd_info": (
        "prd_id long, cat_id string, prd_key string, prd_nm string, prd_cost int, prd_line string, prd_start_dt date, prd_end_dt date",
        "prd_key", (1, "c", "0", "n", 1, "Road", D, LATER),
        [{"prd_id": None}, {"prd_key": None}, {"prd_nm": None}, {"cat_id": None}, {"prd_key": "same"}, {"prd_key": "same"}, {"prd_line": "R"}, {"prd_end_dt": EARLIER}, {"prd_cost": -1}],
    ),
    "crm_sales_details": (
        "sls_ord_num string, sls_prd_key string, sls_cst_id long, sls_order_dt date, sls_ship_dt date, sls_due_dt date, sls_sales long, sls_quantity int, sls_price long",
        "sls_ord_num", ("0", "p", 1, D, LATER, LATER, 4, 2, 2),
        [{"sls_ord_num": None}, {"sls_prd_key": None}, {"sls_cst_id": None}, {"sls_ord_num": "same"}, {"sls_ord_num": "same"}, {"sls_ship_dt": EARLIER}, {"sls_due_dt": EARLIER},
         {"sls_sales": 0}, {"sls_quantity": -2}, {"sls_price": 0}],
    ),
    "crm_camp_info": (
        "cmp_id string, cmp_name string, cmp_channel string, cmp_budget double, cmp_start_date date, cmp_end_date date, flag_invalid_date_range int",
        "cmp_id", ("0", "n", "TV", 1.0, D, LATER, 0),
        [{"cmp_id": None}, {"cmp_name": None}, {"cmp_id": "same"}, {"cmp_id": "same"}, {"cmp_channel": "tv"}, {"cmp_end_date": EARLIER}, {"flag_invalid_date_range": 1}, {"cmp_budget": -0.5},
         {"cmp_end_date": EARLIER, "flag_invalid_date_range": 1}],  # the last one is right
    ),
    "crm_supp_tkts": (
        "tkt_id string, tkt_issue_cat string, tkt_status string, tkt_open_date date, tkt_resolution_date date",
        "tkt_id", ("0", "Billing", "Open", D, LATER),
        [{"tkt_id": None}, {"tkt_id": "same"}, {"tkt_id": "same"}, {"tkt_status": "open"}, {"tkt_issue_cat": "misc"}, {"tkt_resolution_date": EARLIER}],
    ),
    "erp_cust_az12": (
        "cid string, bdate date, gen string", "cid", ("0", D, "Male"),
        [{"cid": None}, {"cid": "same"}, {"cid": "same"}, {"gen": "M"}, {"bdate": FUTURE}],
    ),
    "erp_loc_a101": ("cid string, cntry string", "cid", ("0", "Peru"), [{"cid": None}, {"cntry": None}, {"cid": "same"}, {"cid": "same"}]),
    "erp_px_cat_g1v2": ("id string, cat string", "id", ("0", "c"), [{"id": None}, {"cat": None}, {"id": "same"}, {"id": "same"}]),
    "erp_hr_hx19": (
        "emp_id string, emp_first_name string, emp_last_name string, emp_full_name string, emp_role string, emp_branch_id string, emp_hire_date date",
        "emp_id", ("0", "A", "B", "A B", "Pilot", "BR1", D),
        [{"emp_id": None}, {"emp_full_name": None}, {"emp_role": None}, {"emp_id": "same"}, {"emp_id": "same"}, {"emp_branch_id": " "}, {"emp_branch_id": None}, {"emp_hire_date": FUTURE}, {"emp_full_name": "A C"}],
    ),
    "erp_vnd_z90": ("vnd_id string, vnd_name string", "vnd_id", ("0", "n"), [{"vnd_id": None}, {"vnd_name": None}, {"vnd_id": "same"}, {"vnd_id": "same"}, {"vnd_name": "  "}]),
    "erp_inv_q4v1": (
        "inv_id string, inv_prd_id long, inv_stock_on_hand int, inv_reorder_level int, below_reorder int, inv_snap_date date",
        "inv_id", ("0", 1, 9, 5, 0, D),
        [{"inv_id": None}, {"inv_prd_id": None}, {"inv_id": "same"}, {"inv_id": "same"}, {"inv_stock_on_hand": -1, "below_reorder": 1}, {"below_reorder": 1}, {"inv_snap_date": FUTURE}, {"inv_reorder_level": 0}],
    ),
    "erp_po_ord44": (
        "po_number string, po_vnd_id string, po_quantity_ordered int, po_unit_cost double, total_cost double, po_order_date date, flag_missing_vendor int",
        "po_number", ("0", "0", 2, 1.5, 3.0, D, 0),
        [{"po_number": None}, {"po_number": "same"}, {"po_number": "same"}, {"flag_missing_vendor": 1}, {"po_vnd_id": None}, {"po_vnd_id": None, "flag_missing_vendor": 1}, {"po_order_date": FUTURE},
         {"po_quantity_ordered": 0, "total_cost": 0.0}, {"total_cost": 3.02}, {"total_cost": 3.005}],
    ),
}
STAR = {
    "dim_customers": (
        "customer_key long, customer_id long, customer_number string, first_name string, last_name string", "customer_key", (0, 1, "n", "f", "l"),
        [{"customer_id": None}, {"customer_id": 51, "customer_number": None}, {"customer_id": 52, "first_name": None}, {"customer_id": 53, "last_name": None}, {"customer_id": 54, "customer_key": 1000},
         {"customer_id": 55, "customer_key": 1000}, {"customer_id": 56}, {"customer_id": 56}],
    ),
    "dim_products": (
        "product_key long, product_id long, product_number string, product_name string, category string, cost int", "product_key", (0, 1, "n", "p", "c", 1),
        [{"product_id": None}, {"product_id": 51, "product_number": None}, {"product_id": 52, "product_name": None}, {"product_id": 53, "category": None}, {"product_id": 54, "product_key": 1000},
         {"product_id": 55, "product_key": 1000}, {"product_id": 56}, {"product_id": 56}, {"product_id": 57, "cost": -1}],
    ),
    "dim_employees": (
        "employee_id string, employee_full_name string, job_title string, hire_date date, years_of_service int, seniority_band string", "employee_id", ("0", "n", "j", D, 1, "Junior"),
        [{"employee_id": None}, {"employee_full_name": None}, {"job_title": None}, {"employee_id": "same"}, {"employee_id": "same"}, {"hire_date": FUTURE}, {"years_of_service": -1}, {"seniority_band": "junior"}],
    ),
    "dim_vendors": (
        "vendor_id string, vendor_name string, vendor_region string", "vendor_id", ("0", "n", "Other"),
        [{"vendor_id": None}, {"vendor_name": None}, {"vendor_region": None}, {"vendor_id": "same"}, {"vendor_id": "same"}, {"vendor_region": "Asia"}],
    ),
    "dim_campaigns": (
        "campaign_id string, campaign_name string, channel string, budget double, start_date date, end_date date, campaign_duration_days int, flag_invalid_date_range int",
        "campaign_id", ("0", "n", "TV", 1.0, D, LATER, 10, 0),
        [{"campaign_id": None}, {"campaign_name": None}, {"channel": None}, {"campaign_id": "same"}, {"campaign_id": "same"}, {"end_date": EARLIER}, {"campaign_duration_days": -9}, {"budget": -1.0},
         {"end_date": EARLIER, "campaign_duration_days": -9, "flag_invalid_date_range": 1}],
    ),
    "fact_sales": (
        "order_number string, product_key long, customer_key long, order_date date, shipping_date date, due_date date, sales_amount long, quantity int, price long",
        "order_number", ("0", 1, 1, D, LATER, LATER, 4, 2, 2),
        [{"product_key": None}, {"customer_key": None}, {"shipping_date": EARLIER}, {"due_date": EARLIER}, {"sales_amount": 0}, {"quantity": 0}, {"price": -1}],
    ),
    "fact_support_tickets": (
        "id string, product_key string, open_date date, resolution_date date, days_to_resolve int", "id", ("0", "p", D, LATER, 10),
        [{"id": None}, {"product_key": None}, {"resolution_date": EARLIER}, {"days_to_resolve": -1}],
    ),
    "fact_inventory": (
        "inventory_id string, product_id long, stock_on_hand int, reorder_level int, below_reorder int, stock_vs_reorder int", "inventory_id", ("0", 1, 9, 5, 0, 4),
        [{"product_id": None}, {"stock_on_hand": -1, "below_reorder": 1, "stock_vs_reorder": -6}, {"reorder_level": 0, "stock_vs_reorder": 9}, {"below_reorder": 1}, {"stock_vs_reorder": 5}],
    ),
    "fact_purchase_orders": (
        "po_number string, product_id long, order_date date, quantity_ordered int, unit_cost double, total_cost double", "po_number", ("0", 1, D, 2, 1.5, 3.0),
        [{"product_id": None}, {"order_date": FUTURE}, {"quantity_ordered": 0, "total_cost": 0.0}, {"unit_cost": -1.0, "total_cost": -2.0}, {"total_cost": 3.02}],
    ),
}
# Rules that not just one row breaks.
MORE = {
    "silver.erp_hr_hx19 - NULL or empty emp_branch_id": 2,
    "silver.erp_vnd_z90 - NULL vnd_name (should be Unknown Vendor)": 2,
}


def frames(spark, tables):
    out = {}
    for name, (schema, key, clean, changes) in tables.items():
        columns = [c.split()[0] for c in schema.split(", ")]
        kind = type(clean[columns.index(key)])
        rows = [clean]
        for i, change in enumerate(changes, start=1):
            row = dict(zip(columns, clean)) | {key: kind(i)} | change
            rows.append(tuple(row[c] for c in columns))
        out[name] = spark.createDataFrame(rows, schema)
    return out


@pytest.mark.parametrize(
    ("tables", "check", "number"), [(CLEANSED, checks.check_cleansed, 71), (STAR, checks.check_star, 53)], ids=["cleansed", "star"]
)
def test_every_rule_counts_the_rows_that_break_it(spark, tables, check, number):
    found = {r.check_name: r.issue_count for r in check(frames(spark, tables), AS_OF).collect()}
    assert len(found) == number
    assert {name: n for name, n in found.items() if n != MORE.get(name, 1)} == {}


@pytest.mark.parametrize(("tables", "check"), [(CLEANSED, checks.check_cleansed), (STAR, checks.check_star)], ids=["cleansed", "star"])
def test_clean_rows_break_no_rule(spark, tables, check):
    clean = {name: (schema, key, row, []) for name, (schema, key, row, _) in tables.items()}
    assert not [r for r in check(frames(spark, clean)).collect() if r.issue_count]
