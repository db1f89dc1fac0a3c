"""SQL that computes the cleansed tables and the star schema from the same extracts.

Written for DuckDB and on its own terms (pattern matches, ``try_strptime``, ``QUALIFY``, global
windows), so that it checks the Spark side rather than repeats it. Each table is a common table
expression; :func:`with_tables` puts those a statement needs in front of it.
"""

from __future__ import annotations

import re

from tierloom.functions import fixed_values as fixed
from tierloom.operators.quality import ReferenceRule, RowRule, Rule
from workload.extracts import EXTRACTS
from workload.registry import AS_OF


def sql_date(x: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({x}, '\\d\\d/\\d\\d/\\d{{4}}') "
        f"THEN CAST(try_strptime({x}, '%m/%d/%Y') AS DATE) "
        f"WHEN regexp_full_match(trim({x}), '\\d{{4}}-\\d\\d-\\d\\d') "
        f"THEN CAST(try_strptime(trim({x}), '%Y-%m-%d') AS DATE) END"
    )


def sql_date_number(x: str) -> str:
    return (
        f"CASE WHEN {x} BETWEEN 10000000 AND 99999999 "
        f"THEN CAST(try_strptime(CAST({x} AS VARCHAR), '%Y%m%d') AS DATE) END"
    )


def sql_int(x: str) -> str:
    return (
        f"CASE WHEN regexp_full_match(trim({x}), '[+-]?\\d+') THEN TRY_CAST(trim({x}) AS INTEGER) END"
    )


def sql_long(x: str) -> str:
    return f"CASE WHEN regexp_full_match(trim({x}), '[+-]?\\d+') THEN TRY_CAST(trim({x}) AS BIGINT) END"


def sql_whole(x: str) -> str:
    """A whole number of any length, as the nearest double."""
    return f"CASE WHEN regexp_full_match(trim({x}), '[+-]?\\d+') THEN TRY_CAST(trim({x}) AS DOUBLE) END"


def sql_double(x: str) -> str:
    number = "[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?"
    return f"CASE WHEN regexp_full_match(trim({x}), '{number}') THEN TRY_CAST(trim({x}) AS DOUBLE) END"


def sql_money(x: str) -> str:
    return f"CASE WHEN {x}[1] = '$' THEN {sql_double(f'({x})[2:]')} ELSE {sql_double(x)} END"


def sql_label(x: str, labels: dict, otherwise: str, exact: bool = False) -> str:
    value = x if exact else f"upper(trim({x}))"
    cases = " ".join(
        f"WHEN {value} IN ({', '.join(repr(s) for s in spellings)}) THEN '{label}'"
        for label, spellings in labels.items()
    )
    return f"CASE {cases} ELSE {otherwise} END"


def sql_text_or(x: str, default: str) -> str:
    return f"CASE WHEN trim({x}) <> '' THEN trim({x}) ELSE '{default}' END"


def sql_one_per(keys: str, order: str) -> str:
    return f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1"


def _asc(*columns: str) -> str:
    return ", ".join(f"{c} ASC NULLS FIRST" for c in columns)


TODAY = f"DATE '{AS_OF}'"

_TABLES: dict[str, str] = {
    f"landed_{name}": extract.sql() for name, extract in EXTRACTS.items()
}

_TABLES["crm_cust_info"] = f"""
SELECT cst_id, cst_key, trim(cst_firstname) AS cst_firstname, trim(cst_lastname) AS cst_lastname,
       {sql_label('cst_marital_status', fixed.MARITAL_STATUS, "'n/a'")} AS cst_marital_status,
       {sql_label('cst_gnder', fixed.CRM_GENDER, "'n/a'")} AS cst_gndr, cst_create_date
FROM (SELECT * FROM landed_crm_cust_info WHERE cst_id IS NOT NULL
      {sql_one_per('cst_id', 'cst_create_date DESC NULLS LAST, ' + _asc(
          'cst_key', 'cst_firstname', 'cst_lastname', 'cst_marital_status', 'cst_gnder'))})"""

_TABLES["crm_prd_info"] = f"""
SELECT prd_id, replace(prd_key[1:5], '-', '_') AS cat_id, prd_key[7:] AS prd_key, prd_nm,
       coalesce(prd_cost, 0) AS prd_cost,
       {sql_label('prd_line', fixed.PRODUCT_LINE, "'n/a'")} AS prd_line,
       prd_start_dt,
       CAST(lead(prd_start_dt) OVER (PARTITION BY prd_key ORDER BY prd_start_dt, prd_id)
            - INTERVAL 1 DAY AS DATE) AS prd_end_dt
FROM landed_crm_prd_info"""

_TABLES["crm_sales_details"] = f"""
SELECT sls_ord_num, sls_prd_key, sls_cst_id,
       {sql_date_number('sls_order_dt')} AS sls_order_dt,
       {sql_date_number('sls_ship_dt')} AS sls_ship_dt,
       {sql_date_number('sls_due_dt')} AS sls_due_dt,
       CASE WHEN sls_sales > 0 AND (sls_sales = implied) IS DISTINCT FROM FALSE
            THEN CAST(sls_sales AS BIGINT)
            ELSE sls_quantity::BIGINT * coalesce(abs(sls_price), 1) END AS sls_sales,
       sls_quantity,
       CASE WHEN sls_price > 0 THEN sls_price::BIGINT
            WHEN sls_quantity <> 0 THEN sls_sales::BIGINT // sls_quantity END AS sls_price
FROM (SELECT *, sls_quantity::BIGINT * abs(sls_price) AS implied FROM landed_crm_sales_details)"""

_TABLES["crm_camp_info"] = f"""
SELECT *, CAST(coalesce(cmp_end_date < cmp_start_date, FALSE) AS INTEGER) AS flag_invalid_date_range
FROM (SELECT cmp_id, trim(cmp_name) AS cmp_name,
             {sql_label('cmp_channel', fixed.CAMPAIGN_CHANNEL, "'Other'")} AS cmp_channel,
             coalesce(abs({sql_double('cmp_budget')}), 0) AS cmp_budget,
             {sql_date('cmp_start_date')} AS cmp_start_date,
             {sql_date('cmp_end_date')} AS cmp_end_date
      FROM landed_crm_camp_info)"""

_TABLES["crm_supp_tkts"] = f"""
SELECT tkt_id, nullif({sql_long('tkt_cst_id')}, 999999) AS tkt_cst_id,
       nullif(trim(regexp_replace(CASE WHEN starts_with(tkt_prd_key, 'PRD-') THEN tkt_prd_key
                                       ELSE translate(tkt_prd_key, '_', '-') END, '^PRD-', '')), '') AS tkt_prd_key,
       CASE WHEN coalesce({sql_whole('(trim(tkt_emp_id))[4:]')} <= {fixed.LAST_EMPLOYEE_NUMBER}, TRUE)
            THEN nullif(trim(tkt_emp_id), '') END AS tkt_emp_id,
       {sql_label('tkt_issue_cat', fixed.ISSUE_CATEGORY, "'Unknown'")} AS tkt_issue_cat,
       {sql_label('tkt_status', fixed.TICKET_STATUS, "'Unknown'")} AS tkt_status,
       {sql_date('tkt_open_date')} AS tkt_open_date,
       {sql_date('tkt_resolution_date')} AS tkt_resolution_date
FROM landed_crm_supp_tkts"""

_TABLES["erp_cust_az12"] = f"""
SELECT regexp_replace(cid, '^NAS', '') AS cid, CASE WHEN bdate <= {TODAY} THEN bdate END AS bdate,
       {sql_label('gen', fixed.ERP_GENDER, "'n/a'")} AS gen
FROM landed_erp_cust_az12"""

_TABLES["erp_loc_a101"] = f"""
SELECT replace(cid, '-', '') AS cid,
       CASE WHEN coalesce(trim(cntry), '') = '' THEN 'n/a'
            ELSE {sql_label('cntry', fixed.CUSTOMER_COUNTRY, 'trim(cntry)')} END AS cntry
FROM landed_erp_loc_a101"""

_TABLES["erp_px_cat_g1v2"] = "SELECT * FROM landed_erp_px_cat_g1v2"

_TABLES["erp_hr_hx19"] = f"""
SELECT emp_id, emp_first_name, emp_last_name, emp_first_name || ' ' || emp_last_name AS emp_full_name,
       emp_role, emp_branch_id, emp_hire_date
FROM (SELECT emp_id, {sql_text_or('emp_first_name', 'N/A')} AS emp_first_name,
             {sql_text_or('emp_last_name', 'N/A')} AS emp_last_name,
             {sql_label('emp_role', fixed.JOB_ROLE, 'trim(emp_role)')} AS emp_role,
             {sql_text_or('emp_branch_id', 'Unknown')} AS emp_branch_id,
             {sql_date('emp_hire_date')} AS emp_hire_date
      FROM landed_erp_hr_hx19)
{sql_one_per('emp_id', 'emp_hire_date DESC NULLS LAST, ' + _asc(
    'emp_first_name', 'emp_last_name', 'emp_role', 'emp_branch_id'))}"""

_TABLES["erp_vnd_z90"] = f"""
SELECT vnd_id, {sql_text_or('vnd_name', 'Unknown Vendor')} AS vnd_name,
       {sql_label('vnd_country', fixed.VENDOR_COUNTRY, 'trim(vnd_country)')} AS vnd_country
FROM (SELECT * FROM landed_erp_vnd_z90
      {sql_one_per('vnd_id', _asc('vnd_name', 'vnd_country'))})"""

_TABLES["erp_inv_q4v1"] = f"""
SELECT inv_id, inv_prd_id, inv_wh_loc, inv_stock_on_hand, inv_reorder_level,
       CAST(coalesce(inv_stock_on_hand < inv_reorder_level, FALSE) AS INTEGER) AS below_reorder,
       inv_snap_date
FROM (SELECT inv_id, {sql_long('inv_prd_id')} AS inv_prd_id, upper(trim(inv_wh_loc)) AS inv_wh_loc,
             CASE WHEN left(trim(inv_stock_on_hand), 1) = '-' THEN 0
                  ELSE {sql_long('inv_stock_on_hand')} END AS inv_stock_on_hand,
             {sql_long('inv_reorder_level')} AS inv_reorder_level,
             {sql_date('inv_snap_date')} AS inv_snap_date
      FROM landed_erp_inv_q4v1)
WHERE inv_prd_id IN (SELECT prd_id FROM crm_prd_info)
{sql_one_per('inv_id', 'inv_snap_date DESC NULLS LAST, ' + _asc(
    'inv_prd_id', 'inv_wh_loc', 'inv_stock_on_hand', 'inv_reorder_level'))}"""

_TABLES["erp_po_ord44"] = f"""
SELECT po_number, po_vnd_id, po_prd_id, po_quantity_ordered, po_unit_cost,
       po_quantity_ordered * po_unit_cost AS total_cost, po_order_date,
       CAST(po_vnd_id IS NULL OR NOT EXISTS (
           SELECT 1 FROM erp_vnd_z90 AS v WHERE v.vnd_id = p.po_vnd_id) AS INTEGER)
           AS flag_missing_vendor
FROM (SELECT po_number, nullif(trim(po_vnd_id), '') AS po_vnd_id, {sql_long('po_prd_id')} AS po_prd_id,
             CAST(round({sql_double('po_quantity_ordered')}) AS BIGINT) AS po_quantity_ordered,
             {sql_money('po_unit_cost')} AS po_unit_cost,
             {sql_date('po_order_date')} AS po_order_date
      FROM landed_erp_po_ord44) AS p
{sql_one_per('po_number', 'po_order_date DESC NULLS LAST, ' + _asc(
    'po_vnd_id', 'po_prd_id', 'po_quantity_ordered', 'po_unit_cost'))}"""

_TABLES["conformed_customers"] = """
SELECT cst_id AS customer_id, cst_key AS customer_number, cst_firstname AS first_name,
       cst_lastname AS last_name, cntry AS country, cst_marital_status AS marital_status,
       CASE WHEN cst_gndr IN ('Male', 'Female') THEN cst_gndr ELSE coalesce(gen, 'n/a') END AS gender,
       cst_create_date AS create_date, bdate AS birth_date
FROM crm_cust_info LEFT JOIN erp_cust_az12 AS d ON cst_key = d.cid
LEFT JOIN erp_loc_a101 AS l ON cst_key = l.cid"""

_TABLES["dim_customers"] = """
SELECT row_number() OVER (ORDER BY customer_id) AS customer_key, * FROM conformed_customers"""

_TABLES["dim_products"] = """
SELECT row_number() OVER (ORDER BY prd_start_dt, prd_id) AS product_key, prd_id AS product_id,
       p.prd_key AS product_number, prd_nm AS product_name, cat_id AS category_id, cat AS category,
       subcat AS subcategory, maintenance, prd_cost AS cost, prd_line AS product_line,
       prd_start_dt AS start_date
FROM crm_prd_info AS p LEFT JOIN erp_px_cat_g1v2 AS c ON cat_id = c.id
WHERE prd_end_dt IS NULL"""

_TABLES["dim_employees"] = f"""
SELECT *, {list(fixed.SENIORITY_LABELS)}[1 + len(list_filter({list(fixed.SENIORITY_CUTS)},
               lambda c: coalesce(years_of_service, 999) >= c))] AS seniority_band
FROM (SELECT emp_id AS employee_id, emp_first_name AS employee_first_name,
             emp_last_name AS employee_last_name, emp_full_name AS employee_full_name,
             emp_role AS job_title, emp_branch_id AS branch_id, emp_hire_date AS hire_date,
             CAST(date_diff('year', emp_hire_date, {TODAY}) AS INTEGER) AS years_of_service
      FROM erp_hr_hx19)"""

_TABLES["dim_vendors"] = f"""
SELECT vnd_id AS vendor_id, vnd_name AS vendor_name, vnd_country AS vendor_country,
       {sql_label('vnd_country', fixed.VENDOR_REGION, "'Other'", exact=True)} AS vendor_region
FROM erp_vnd_z90"""

_TABLES["dim_campaigns"] = """
SELECT cmp_id AS campaign_id, cmp_name AS campaign_name, cmp_channel AS channel,
       cmp_budget AS budget, cmp_start_date AS start_date, cmp_end_date AS end_date,
       CAST(cmp_end_date - cmp_start_date AS INTEGER) AS campaign_duration_days,
       CAST(year(cmp_start_date) AS INTEGER) AS campaign_year, flag_invalid_date_range
FROM crm_camp_info"""

_TABLES["fact_sales"] = """
SELECT sls_ord_num AS order_number, product_key, customer_key, sls_order_dt AS order_date,
       sls_ship_dt AS shipping_date, sls_due_dt AS due_date, sls_sales AS sales_amount,
       sls_quantity AS quantity, sls_price AS price
FROM crm_sales_details LEFT JOIN dim_products ON sls_prd_key = product_number
LEFT JOIN dim_customers ON sls_cst_id = customer_id"""

_TABLES["fact_support_tickets"] = f"""
SELECT tkt_id AS id, tkt_open_date AS open_date, tkt_resolution_date AS resolution_date,
       CAST(coalesce(tkt_resolution_date, {TODAY}) - tkt_open_date AS INTEGER) AS days_to_resolve,
       CAST(coalesce(tkt_status <> 'Closed' AND {TODAY} - tkt_open_date > {fixed.OVERDUE_AFTER_DAYS}, FALSE) AS INTEGER)
           AS is_overdue,
       tkt_issue_cat AS issue_category, tkt_status AS status, customer_id, customer_number,
       concat(first_name, ' ', last_name) AS customer_full_name, country AS customer_country,
       employee_id, employee_full_name AS assigned_agent, job_title AS agent_role,
       branch_id AS agent_branch, product_number AS product_key, product_name,
       category AS product_category, subcategory AS product_subcategory
FROM crm_supp_tkts LEFT JOIN dim_customers ON tkt_cst_id = customer_id
LEFT JOIN dim_employees ON tkt_emp_id = employee_id
LEFT JOIN dim_products ON tkt_prd_key = product_number"""

_TABLES["fact_inventory"] = """
SELECT inv_id AS inventory_id, inv_snap_date AS snapshot_date, inv_wh_loc AS warehouse_location,
       product_id, product_number AS product_key, product_name, category AS product_category,
       subcategory AS product_subcategory, inv_stock_on_hand AS stock_on_hand,
       inv_reorder_level AS reorder_level, below_reorder,
       inv_stock_on_hand - inv_reorder_level AS stock_vs_reorder,
       inv_stock_on_hand::BIGINT * coalesce(cost, 0) AS estimated_stock_value
FROM erp_inv_q4v1 LEFT JOIN dim_products ON inv_prd_id = product_id"""

_TABLES["fact_purchase_orders"] = """
SELECT po_number, po_order_date AS order_date, CAST(year(po_order_date) AS INTEGER) AS order_year,
       CAST(month(po_order_date) AS INTEGER) AS order_month, vendor_id, vendor_name, vendor_country,
       vendor_region, product_id, product_name, category AS product_category,
       po_quantity_ordered AS quantity_ordered, po_unit_cost AS unit_cost, total_cost,
       flag_missing_vendor
FROM erp_po_ord44 LEFT JOIN dim_vendors ON po_vnd_id = vendor_id
LEFT JOIN dim_products ON po_prd_id = product_id"""


def with_tables(body: str) -> str:
    """``body`` with the tables it names, and those they name, in front."""
    needed: dict[str, None] = {}

    def visit(sql: str) -> None:
        for name in dict.fromkeys(re.findall(r"\w+", sql)):
            if name in _TABLES and name not in needed:
                visit(_TABLES[name])
                needed[name] = None

    visit(body)
    if not needed:
        return body
    expressions = ",\n".join(f"{name} AS ({_TABLES[name]})" for name in needed)
    return f"WITH {expressions}\n{body}"


def suite_sql(rules: list[Rule], prefix: str = "") -> str:
    """One counting statement per rule, all of them in a row."""

    def count(rule: Rule) -> str:
        if isinstance(rule, RowRule):
            return f"SELECT count(*) FROM {rule.table} WHERE {rule.broken_if}"
        if isinstance(rule, ReferenceRule):
            test = "EXISTS" if rule.exists else "NOT EXISTS"
            return (
                f"SELECT count(*) FROM {rule.table} AS t WHERE {rule.only_if} AND {test} "
                f"(SELECT 1 FROM {rule.reference} AS r WHERE r.{rule.key} = t.{rule.foreign_key})"
            )
        keys = ", ".join(rule.keys)
        return (
            f"SELECT count(*) FROM (SELECT 1 FROM {rule.table} GROUP BY {keys} HAVING count(*) > 1)"
        )

    def line(rule: Rule) -> str:
        name = f"{prefix}{rule.table} - {rule.name}".replace("'", "''")
        return f"SELECT '{name}' AS check_name, ({count(rule)}) AS issue_count"

    return with_tables("\nUNION ALL ".join(line(rule) for rule in rules))
