"""One query per operator, over the test tables as they are or with dirt put in by expression."""

from __future__ import annotations

import datetime
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierloom.functions import collation, dates, flags, labels, numbers, text
from tierloom.functions import fixed_values as fixed
from tierloom.operators import quality, sketches
from tierloom.operators.dedup import first_per_key, latest_per_key
from tierloom.operators.history import active_version, validity_intervals, validity_intervals_by_range
from tierloom.operators.keys import surrogate_key
from tierloom.operators.references import exclude_orphans, flag_missing_ref, resolve
from tierloom.session import new_table_path
from tierloom.sources.landing import LANDING_SCHEMAS, REJECTED, read_landing, split_rejected
from tierloom.sources.tables import (
    AUDIT_COLUMN, BATCH, load_all, read_loads, record_loads, run_report, side_by_side, with_audit, write_gated, write_refresh,
)
from tierloom.sources.versions import HELD_BACK, OUTCOME, current, publish, read_version
from workload.extracts import digits, landed, mixed_date, money, product_number, spelled
from workload.extracts import text as as_text
from workload.oracle import (
    sql_date,
    sql_date_number,
    sql_double,
    sql_int,
    sql_label,
    sql_long,
    sql_money,
    sql_one_per,
    sql_text_or,
    suite_sql,
    with_tables,
)
from workload.registry import query, table

col = F.col
TODAY = "2000-01-01"


def dirty(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    return table(spark, folder, name).selectExpr(*columns)


# --- text --------------------------------------------------------------------------------------

PADDED_NAME = "CASE WHEN p_partkey % 3 = 0 THEN '  ' || p_name || ' ' ELSE p_name END AS raw"
GAPPED_NAME = (
    "CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN '   ' "
    "ELSE ' ' || c_name END AS raw"
)


@query(
    "trim_text",
    f"SELECT p_partkey, trim(raw) AS cleaned, upper(trim(raw)) AS code "
    f"FROM (SELECT p_partkey, {PADDED_NAME} FROM part)",
)
def trim_text(spark, folder):
    return dirty(spark, folder, "part", "p_partkey", PADDED_NAME).select(
        "p_partkey",
        text.clean_text(col("raw")).alias("cleaned"),
        text.upper_code(col("raw")).alias("code"),
    )


@query(
    "default_text",
    f"SELECT c_custkey, {sql_text_or('raw', 'N/A')} AS named "
    f"FROM (SELECT c_custkey, {GAPPED_NAME} FROM customer)",
)
def default_text(spark, folder):
    return dirty(spark, folder, "customer", "c_custkey", GAPPED_NAME).select(
        "c_custkey", text.default_text(col("raw"), fixed.MISSING_NAME).alias("named")
    )


@query(
    "blank_to_null",
    f"SELECT c_custkey, nullif(trim(raw), '') AS named "
    f"FROM (SELECT c_custkey, {GAPPED_NAME} FROM customer)",
)
def blank_to_null(spark, folder):
    return dirty(spark, folder, "customer", "c_custkey", GAPPED_NAME).select(
        "c_custkey", text.blank_to_null(col("raw")).alias("named")
    )


@query(
    "full_name",
    "SELECT c_custkey, concat(first, ' ', last) AS full_name FROM (SELECT c_custkey, "
    "CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_name END AS first, "
    "CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_mktsegment END AS last FROM customer)",
)
def full_name(spark, folder):
    return dirty(
        spark, folder, "customer", "c_custkey",
        "CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_name END AS first",
        "CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_mktsegment END AS last",
    ).select("c_custkey", text.full_name(col("first"), col("last")).alias("full_name"))


PREFIXED_ID = f"CASE WHEN c_custkey % 3 = 0 THEN 'NAS' ELSE '' END || 'AW' || ({digits('c_custkey', 8)})"


@query(
    "strip_prefix",
    f"SELECT c_custkey, regexp_replace({PREFIXED_ID}, '^NAS', '') AS cid, "
    f"regexp_extract(c_name, '^Customer#(.*)$', 1) AS number FROM customer",
)
def strip_prefix(spark, folder):
    return dirty(spark, folder, "customer", "*", f"{PREFIXED_ID} AS raw").select(
        "c_custkey",
        text.strip_prefix(col("raw"), fixed.CUSTOMER_ID_PREFIX).alias("cid"),
        text.strip_prefix(col("c_name"), "Customer#").alias("number"),
    )


COMPOSITE_KEY = (
    spelled("p_partkey % 3", "AC", "BI", "CO") + " || '-' || " + spelled("p_size % 3", "HE", "RF", "PE")
    + " || '-' || " + product_number("p_partkey")
)


@query(
    "split_composite_key",
    f"SELECT p_partkey, replace(left(k, 5), '-', '_') AS cat_id, regexp_replace(k, '^.{{6}}', '') "
    f"AS prd_key, replace(k, '-', '') AS joined FROM (SELECT p_partkey, {COMPOSITE_KEY} AS k FROM part)",
)
def split_composite_key(spark, folder):
    return dirty(spark, folder, "part", "p_partkey", f"{COMPOSITE_KEY} AS k").select(
        "p_partkey",
        text.category_part(col("k")).alias("cat_id"),
        text.product_part(col("k")).alias("prd_key"),
        text.swap_delimiter(col("k"), "-", "").alias("joined"),
    )


CITED_KEY = (
    "CASE l_linenumber WHEN 1 THEN '' WHEN 2 THEN NULL WHEN 3 THEN 'PRD-HL_U' || ("
    + digits("l_partkey", 6)
    + ") WHEN 4 THEN ' HL_U' || ("
    + digits("l_partkey", 6)
    + ") || ' ' WHEN 5 THEN ' PRD-' || "
    + product_number("l_partkey")
    + " WHEN 6 THEN 'PRD-' || "
    + product_number("l_partkey")
    + " || ' ' ELSE "
    + product_number("l_partkey")
    + " END AS raw"
)


@query(
    "repair_key",
    "SELECT l_orderkey, l_linenumber, nullif(coalesce(regexp_extract(raw, '^PRD-(.*?) *$', ['rest']).rest, '') "
    "|| CASE WHEN starts_with(raw, 'PRD-') THEN '' ELSE translate(trim(raw), '_', '-') END, '') AS prd_key "
    f"FROM (SELECT *, {CITED_KEY} FROM lineitem)",
)
def repair_key(spark, folder):
    return dirty(spark, folder, "lineitem", "l_orderkey", "l_linenumber", CITED_KEY).select(
        "l_orderkey",
        "l_linenumber",
        text.repair_key(col("raw"), fixed.TICKET_PRODUCT_PREFIX).alias("prd_key"),
    )


EMPLOYEE_ID = (
    "CASE WHEN event_id % 19 = 0 THEN '' WHEN event_id % 23 = 0 THEN 'EMPX' "
    f"ELSE ' EMP' || ({digits('event_id % 400', 3)}) END AS raw"
)


@query(
    "bounded_suffix_id",
    "SELECT event_id, CASE WHEN coalesce(TRY_CAST(regexp_extract(raw, '(\\d+)$', 1) AS INTEGER), 0) "
    f"<= {fixed.LAST_EMPLOYEE_NUMBER} THEN nullif(trim(raw), '') END AS emp_id FROM (SELECT event_id, {EMPLOYEE_ID} FROM events)",
)
def bounded_suffix_id(spark, folder):
    return dirty(spark, folder, "events", "event_id", EMPLOYEE_ID).select(
        "event_id",
        text.null_if_suffix_above(
            col("raw"), fixed.EMPLOYEE_NUMBER_START, fixed.LAST_EMPLOYEE_NUMBER
        ).alias("emp_id"),
    )


# --- labels ------------------------------------------------------------------------------------

ORDER_STATUS = {"Finished": ("F",), "Open": ("O",)}
RAW_STATUS = (
    "CASE WHEN o_orderkey % 4 = 0 THEN ' ' || lower(o_orderstatus) WHEN o_orderkey % 9 = 0 THEN NULL "
    "ELSE o_orderstatus END AS raw"
)


@query(
    "map_codes",
    "SELECT o_orderkey, CASE upper(trim(raw)) WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' "
    f"ELSE 'n/a' END AS status FROM (SELECT o_orderkey, {RAW_STATUS} FROM orders)",
)
def map_codes(spark, folder):
    return dirty(spark, folder, "orders", "o_orderkey", RAW_STATUS).select(
        "o_orderkey", labels.map_codes(col("raw"), ORDER_STATUS, fixed.NOT_AVAILABLE).alias("status")
    )


RAW_CHANNEL = (
    "CASE WHEN o_orderkey % 59 = 0 THEN NULL ELSE "
    + spelled(
        "o_orderkey % 11",
        *("E-mail", "e_mail", "SocialMedia", " sms ", "DM", "web", "TV Ad", "radio ad", "in person"),
        *("fax", "events"),
    )
    + " END AS channel"
)
RAW_GENDER = spelled("o_orderkey % 5", "F", "female", "MALE", " m", "") + " AS gen"


@query(
    "canonicalize_default",
    f"SELECT o_orderkey, {sql_label('channel', fixed.CAMPAIGN_CHANNEL, repr('Other'))} AS channel, "
    f"{sql_label('gen', fixed.ERP_GENDER, repr('n/a'))} AS gen "
    f"FROM (SELECT o_orderkey, {RAW_CHANNEL}, {RAW_GENDER} FROM orders)",
)
def canonicalize_default(spark, folder):
    return dirty(spark, folder, "orders", "o_orderkey", RAW_CHANNEL, RAW_GENDER).select(
        "o_orderkey",
        labels.canonicalize(col("channel"), fixed.CAMPAIGN_CHANNEL, fixed.OTHER).alias("channel"),
        labels.canonicalize(col("gen"), fixed.ERP_GENDER, fixed.NOT_AVAILABLE).alias("gen"),
    )


RAW_ROLE = (
    spelled("c_custkey % 8", "Analst", "T.Lead", "Dir.", "mgr", "Sup Agent", "Pilot ", "Co-Ord", "")
    + " AS role"
)
RAW_COUNTRY = (
    "CASE c_custkey % 9 WHEN 0 THEN 'england' WHEN 1 THEN 'FRA' WHEN 2 THEN ' us' WHEN 3 THEN NULL "
    "ELSE ' Country ' || " + as_text("c_nationkey") + " || ' ' END AS country"
)


@query(
    "canonicalize_passthrough",
    f"SELECT c_custkey, {sql_label('role', fixed.JOB_ROLE, 'trim(role)')} AS role, "
    f"{sql_label('country', fixed.VENDOR_COUNTRY, 'trim(country)')} AS country "
    f"FROM (SELECT c_custkey, {RAW_ROLE}, {RAW_COUNTRY} FROM customer)",
)
def canonicalize_passthrough(spark, folder):
    return dirty(spark, folder, "customer", "c_custkey", RAW_ROLE, RAW_COUNTRY).select(
        "c_custkey",
        labels.canonicalize(col("role"), fixed.JOB_ROLE, default=None).alias("role"),
        labels.canonicalize(col("country"), fixed.VENDOR_COUNTRY, default=None).alias("country"),
    )


NATION_GROUPS = {"North": ("NATION_0", "NATION_3", "NATION_8"), "South": ("NATION_5", "NATION_13")}


@query(
    "region_group",
    "SELECT s_suppkey, CASE WHEN n_nationkey IN (0, 3, 8) THEN 'North' "
    "WHEN n_nationkey IN (5, 13) THEN 'South' ELSE 'Other' END AS area "
    "FROM supplier JOIN nation ON s_nationkey = n_nationkey",
)
def region_group(spark, folder):
    nation = table(spark, folder, "nation")
    return (
        table(spark, folder, "supplier")
        .join(nation, col("s_nationkey") == col("n_nationkey"))
        .select("s_suppkey", labels.group_label(col("n_name"), NATION_GROUPS, fixed.OTHER).alias("area"))
    )


@query(
    "prefer_master",
    "SELECT c_custkey, coalesce(nullif(crm, 'n/a'), erp, 'n/a') AS gender FROM (SELECT c_custkey, "
    + spelled("c_custkey % 3", "Male", "n/a", "Female")
    + " AS crm, CASE WHEN c_nationkey < 9 THEN NULL ELSE 'Female' END AS erp FROM customer)",
)
def prefer_master(spark, folder):
    return dirty(
        spark, folder, "customer", "c_custkey",
        spelled("c_custkey % 3", "Male", "n/a", "Female") + " AS crm",
        "CASE WHEN c_nationkey < 9 THEN NULL ELSE 'Female' END AS erp",
    ).select(
        "c_custkey", labels.prefer(col("crm"), col("erp"), fixed.NOT_AVAILABLE).alias("gender")
    )


# --- dates -------------------------------------------------------------------------------------

ORDER_DAY = "CAST(CAST(o_orderdate AS DATE) AS STRING) AS day"
ORDER_DATE_TEXT = mixed_date("day", "o_orderkey") + " AS raw"


@query(
    "parse_date_multi",
    f"SELECT o_orderkey, {sql_date('raw')} AS order_date "
    f"FROM (SELECT o_orderkey, {ORDER_DATE_TEXT} FROM (SELECT *, {ORDER_DAY} FROM orders))",
)
def parse_date_multi(spark, folder):
    orders = dirty(spark, folder, "orders", "o_orderkey", ORDER_DAY)
    return orders.selectExpr("o_orderkey", ORDER_DATE_TEXT).select(
        "o_orderkey", dates.parse_date_multi(col("raw")).alias("order_date")
    )


ORDER_DATE_NUMBER = (
    "CAST(CASE WHEN o_orderkey % 17 = 0 THEN 0 WHEN o_orderkey % 19 = 0 THEN 201213 "
    "WHEN o_orderkey % 23 = 0 THEN 20130231 WHEN o_orderkey % 29 = 0 THEN NULL "
    "WHEN o_orderkey % 31 = 0 THEN -2012122 "
    "ELSE year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) END AS INT) AS raw"
)


@query(
    "parse_yyyymmdd",
    f"SELECT o_orderkey, {sql_date_number('raw')} AS order_date "
    f"FROM (SELECT o_orderkey, {ORDER_DATE_NUMBER} FROM orders)",
)
def parse_yyyymmdd(spark, folder):
    return dirty(spark, folder, "orders", "o_orderkey", ORDER_DATE_NUMBER).select(
        "o_orderkey", dates.parse_yyyymmdd(col("raw")).alias("order_date")
    )


@query(
    "null_future_date",
    f"SELECT o_orderkey, CASE WHEN o_orderdate <= DATE '{TODAY}' THEN CAST(o_orderdate AS DATE) END "
    "AS order_date FROM orders",
)
def null_future_date(spark, folder):
    return dirty(spark, folder, "orders", "o_orderkey", "CAST(o_orderdate AS DATE) AS day").select(
        "o_orderkey", dates.null_if_after(col("day"), TODAY).alias("order_date")
    )


OPENED = "CAST(o_orderdate AS DATE) AS opened"
CLOSED = "CASE WHEN o_orderstatus = 'F' THEN CAST(l_shipdate AS DATE) END AS closed"
LINES_WITH_ORDERS = "lineitem JOIN orders ON l_orderkey = o_orderkey"


def lines_with_orders(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return (
        table(spark, folder, "lineitem")
        .join(orders, col("l_orderkey") == col("o_orderkey"))
        .selectExpr(*columns)
    )


@query(
    "elapsed_days",
    "SELECT l_orderkey, l_linenumber, l_partkey, CAST(date_diff('day', opened, shipped) AS INTEGER) "
    f"AS to_ship, CAST(date_diff('day', opened, coalesce(closed, DATE '{TODAY}')) AS INTEGER) AS age "
    "FROM (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) AS shipped, "
    f"{OPENED}, {CLOSED} FROM {LINES_WITH_ORDERS})",
)
def elapsed_days(spark, folder):
    return lines_with_orders(
        spark, folder, "l_orderkey", "l_linenumber", "l_partkey",
        "CAST(l_shipdate AS DATE) AS shipped", OPENED, CLOSED,
    ).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        dates.days_between(col("opened"), col("shipped")).alias("to_ship"),
        dates.days_open(col("opened"), col("closed"), TODAY).alias("age"),
    )


@query(
    "date_parts",
    "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS order_year, "
    "CAST(month(o_orderdate) AS INTEGER) AS order_month FROM orders",
)
def date_parts(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.year("o_orderdate").alias("order_year"),
        F.month("o_orderdate").alias("order_month"),
    )


@query(
    "seniority_band",
    "SELECT o_orderkey, years, "
    f"{list(fixed.SENIORITY_LABELS)}[1 + len(list_filter({list(fixed.SENIORITY_CUTS)}, lambda c: coalesce(years, 999) >= c))] AS band FROM (SELECT o_orderkey, CAST("
    f"date_diff('year', CASE WHEN o_orderkey % 13 > 0 THEN o_orderdate END, DATE '{TODAY}') AS INTEGER) "
    "AS years FROM orders)",
)
def seniority_band(spark, folder):
    years = dates.years_crossed(col("since"), dates.as_of_date(TODAY))
    return dirty(
        spark, folder, "orders", "o_orderkey",
        "CASE WHEN o_orderkey % 13 > 0 THEN o_orderdate END AS since",
    ).select(
        "o_orderkey",
        years.alias("years"),
        labels.band(years, fixed.SENIORITY_CUTS, fixed.SENIORITY_LABELS).alias("band"),
    )


# --- flags -------------------------------------------------------------------------------------


@query(
    "overdue_flag",
    "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' AND "
    f"date_diff('day', o_orderdate, DATE '{TODAY}') > {fixed.OVERDUE_AFTER_DAYS} THEN 1 ELSE 0 END AS is_overdue FROM orders",
)
def overdue_flag(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey",
        flags.flag_overdue(
            col("o_orderstatus"), col("o_orderdate"), TODAY, fixed.OVERDUE_AFTER_DAYS, done="F"
        ).alias("is_overdue"),
    )


@query(
    "flag_invalid_range",
    "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN closed < opened THEN 1 ELSE 0 END AS flag "
    f"FROM (SELECT l_orderkey, l_linenumber, l_partkey, {OPENED}, {CLOSED} FROM {LINES_WITH_ORDERS})",
)
def flag_invalid_range(spark, folder):
    return lines_with_orders(
        spark, folder, "l_orderkey", "l_linenumber", "l_partkey", OPENED, CLOSED
    ).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        flags.flag_range(col("opened"), col("closed")).alias("flag"),
    )


@query(
    "flag_below_threshold",
    "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_quantity < p_size THEN 1 ELSE 0 END AS flag "
    "FROM lineitem JOIN part ON l_partkey = p_partkey",
)
def flag_below_threshold(spark, folder):
    part = table(spark, folder, "part")
    return (
        table(spark, folder, "lineitem")
        .join(part, col("l_partkey") == col("p_partkey"))
        .select(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            flags.flag_below(col("l_quantity"), col("p_size")).alias("flag"),
        )
    )


# --- numbers -----------------------------------------------------------------------------------

BALANCE_TEXT = (
    "CASE c_custkey % 9 WHEN 0 THEN '12d' WHEN 1 THEN '' WHEN 2 THEN 'NaN' WHEN 3 THEN NULL "
    f"WHEN 4 THEN ' 1e3 ' WHEN 5 THEN {as_text('c_custkey')} ELSE {money('c_acctbal')} END AS raw"
)


@query(
    "safe_numeric",
    f"SELECT c_custkey, {sql_int('raw')} AS whole, {sql_double('raw')} AS number, "
    f"coalesce(abs({sql_double('raw')}), 0.0::DOUBLE) AS amount "
    f"FROM (SELECT c_custkey, {BALANCE_TEXT} FROM customer)",
)
def safe_numeric(spark, folder):
    return dirty(spark, folder, "customer", "c_custkey", BALANCE_TEXT).select(
        "c_custkey",
        numbers.safe_int(col("raw")).alias("whole"),
        numbers.safe_double(col("raw")).alias("number"),
        numbers.absolute_amount(col("raw")).alias("amount"),
    )


PRICE_TEXT = (
    "CASE p_partkey % 10 WHEN 0 THEN '$' || " + money("p_retailprice")
    + " WHEN 1 THEN 'N/A' WHEN 2 THEN ' na' WHEN 3 THEN 'N.A.' WHEN 4 THEN '  ' WHEN 5 THEN NULL "
    "WHEN 6 THEN ' $7' WHEN 7 THEN 'abc' ELSE ' ' || " + money("p_retailprice") + " END AS raw"
)


@query(
    "parse_money",
    f"SELECT p_partkey, {sql_money('raw')} AS price FROM (SELECT p_partkey, {PRICE_TEXT} FROM part)",
)
def parse_money(spark, folder):
    return dirty(spark, folder, "part", "p_partkey", PRICE_TEXT).select(
        "p_partkey", numbers.parse_money(col("raw")).alias("price")
    )


QUANTITY_TEXT = (
    "CASE WHEN l_linenumber = 1 THEN " + as_text("CAST(floor(l_quantity) AS INT)") + " || '.5' "
    "WHEN l_linenumber = 2 THEN '-' || " + as_text("CAST(floor(l_quantity) AS INT)") + " || '.5' "
    "WHEN l_linenumber = 3 THEN 'x' ELSE " + money("l_quantity") + " END AS raw"
)


@query(
    "round_quantity",
    f"SELECT l_orderkey, l_linenumber, CAST(round({sql_double('raw')}) AS BIGINT) AS quantity "
    f"FROM (SELECT *, {QUANTITY_TEXT} FROM lineitem)",
)
def round_quantity(spark, folder):
    return dirty(spark, folder, "lineitem", "l_orderkey", "l_linenumber", QUANTITY_TEXT).select(
        "l_orderkey", "l_linenumber", numbers.round_long(col("raw")).alias("quantity")
    )


@query(
    "floor_at_zero",
    "SELECT c_custkey, CASE WHEN balance >= 0 THEN balance WHEN balance < 0 THEN 0 END AS balance FROM ("
    "SELECT c_custkey, CAST(CASE WHEN c_custkey % 8 > 0 THEN floor(c_acctbal) END AS INTEGER) AS balance "
    "FROM customer)",
)
def floor_at_zero(spark, folder):
    return dirty(
        spark, folder, "customer", "c_custkey",
        "CAST(CASE WHEN c_custkey % 8 > 0 THEN floor(c_acctbal) END AS INT) AS balance",
    ).select("c_custkey", numbers.floor_at(col("balance"), 0).alias("balance"))


USER_TEXT = (
    "CASE event_id % 7 WHEN 0 THEN '999999' WHEN 1 THEN '' WHEN 2 THEN 'abc' WHEN 3 THEN NULL "
    f"ELSE {as_text('user_id')} END AS raw"
)


@query(
    "null_sentinel",
    f"SELECT event_id, nullif({sql_long('raw')}, 999999) AS user_id "
    f"FROM (SELECT event_id, {USER_TEXT} FROM events)",
)
def null_sentinel(spark, folder):
    return dirty(spark, folder, "events", "event_id", USER_TEXT).select(
        "event_id", numbers.null_if_sentinel(col("raw"), fixed.UNKNOWN_CUSTOMER_ID).alias("user_id")
    )


@query(
    "repair_amounts",
    with_tables(
        "SELECT sls_ord_num, sls_prd_key, sls_quantity, sls_sales, sls_price FROM crm_sales_details"
    ),
)
def repair_amounts(spark, folder):
    rows = landed(spark, folder, "crm_sales_details")
    amount, quantity, price = col("sls_sales"), col("sls_quantity"), col("sls_price")
    return rows.select(
        "sls_ord_num",
        "sls_prd_key",
        "sls_quantity",
        numbers.repair_amount(amount, quantity, price).alias("sls_sales"),
        numbers.repair_price(amount, quantity, price).alias("sls_price"),
    )


UNITS = "CAST(CASE WHEN l_linenumber > 1 THEN floor(l_quantity) END AS INT) AS units"


@query(
    "derived_total",
    "SELECT l_orderkey, l_linenumber, units * l_extendedprice AS total_cost "
    f"FROM (SELECT *, {UNITS} FROM lineitem)",
)
def derived_total(spark, folder):
    return dirty(
        spark, folder, "lineitem", "l_orderkey", "l_linenumber", "l_extendedprice", UNITS
    ).select(
        "l_orderkey",
        "l_linenumber",
        numbers.derived_total(col("units"), col("l_extendedprice")).alias("total_cost"),
    )


STOCK = "CAST(floor(l_quantity) AS INT) AS stock"
COST = "CASE WHEN p_partkey % 6 > 0 THEN CAST(floor(p_retailprice) AS INT) END AS cost"


@query(
    "stock_measures",
    "SELECT l_orderkey, l_linenumber, l_partkey, stock - p_size AS stock_gap, "
    "stock::BIGINT * coalesce(cost, 0) AS stock_value "
    f"FROM (SELECT *, {STOCK}, {COST} FROM lineitem JOIN part ON l_partkey = p_partkey)",
)
def stock_measures(spark, folder):
    part = dirty(spark, folder, "part", "p_partkey", "p_size", COST)
    lines = dirty(spark, folder, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", STOCK)
    return lines.join(part, col("l_partkey") == col("p_partkey")).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        numbers.stock_gap(col("stock"), col("p_size")).alias("stock_gap"),
        numbers.stock_value(col("stock"), col("cost")).alias("stock_value"),
    )


# --- one row per key, versions -----------------------------------------------------------------

ORDERS_FOR_DEDUP = "o_custkey, CAST(o_orderdate AS DATE) AS order_date, o_orderkey"


@query(
    "dedup_latest",
    f"SELECT {ORDERS_FOR_DEDUP} FROM orders WHERE o_custkey IS NOT NULL "
    + sql_one_per("o_custkey", "order_date DESC NULLS LAST, o_orderkey"),
)
def dedup_latest(spark, folder):
    orders = dirty(spark, folder, "orders", *ORDERS_FOR_DEDUP.split(", "))
    with_key = orders.filter(col("o_custkey").isNotNull())
    return latest_per_key(with_key, ["o_custkey"], "order_date", ["o_orderkey"])


@query(
    "dedup_latest_parsed",
    "SELECT * FROM (SELECT o_custkey, o_orderkey, "
    f"{sql_date('raw')} AS order_date "
    f"FROM (SELECT *, {ORDER_DATE_TEXT} FROM (SELECT *, {ORDER_DAY} FROM orders))) "
    + sql_one_per("o_custkey", "order_date DESC NULLS LAST, o_orderkey"),
)
def dedup_latest_parsed(spark, folder):
    orders = dirty(spark, folder, "orders", "o_custkey", "o_orderkey", ORDER_DAY)
    parsed = orders.selectExpr("o_custkey", "o_orderkey", ORDER_DATE_TEXT).select(
        "o_custkey", "o_orderkey", dates.parse_date_multi(col("raw")).alias("order_date")
    )
    return latest_per_key(parsed, ["o_custkey"], "order_date")


LINE_COLUMNS = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_returnflag",
]


@query(
    "dedup_first",
    f"SELECT {', '.join(LINE_COLUMNS)} FROM lineitem "
    + sql_one_per("l_orderkey, l_linenumber", ", ".join(LINE_COLUMNS[2:])),
)
def dedup_first(spark, folder):
    lines = table(spark, folder, "lineitem").select(*LINE_COLUMNS)
    return first_per_key(lines, ["l_orderkey", "l_linenumber"])


VERSIONS_SQL = (
    "SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS valid_from, "
    "CAST(lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) "
    "- INTERVAL 1 DAY AS DATE) AS valid_to FROM orders"
)


@query("validity_intervals", VERSIONS_SQL)
def versions_of_orders(spark, folder):
    orders = dirty(spark, folder, "orders", "o_custkey", "o_orderkey", "o_orderdate")
    return validity_intervals(orders, ["o_custkey"], "o_orderdate", ["o_orderkey"]).select(
        "o_custkey",
        "o_orderkey",
        col("o_orderdate").cast("date").alias("valid_from"),
        "valid_to",
    )


@query("validity_intervals_by_range", VERSIONS_SQL)
def versions_of_orders_by_range(spark, folder):
    orders = dirty(spark, folder, "orders", "o_custkey", "o_orderkey", "o_orderdate")
    return validity_intervals_by_range(orders, ["o_custkey"], "o_orderdate", ["o_orderkey"]).select(
        "o_custkey",
        "o_orderkey",
        col("o_orderdate").cast("date").alias("valid_from"),
        "valid_to",
    )


@query("active_version", f"SELECT * FROM ({VERSIONS_SQL}) WHERE valid_to IS NULL")
def active_orders(spark, folder):
    return active_version(versions_of_orders(spark, folder))


# --- keys under the collation of the source dialect --------------------------------------------

SPELLED_TYPE = "CASE p_partkey % 3 WHEN 0 THEN lower(p_type) || '  ' WHEN 1 THEN upper(p_type) ELSE p_type END AS kind"


@query(
    "collated_dedup",
    f"SELECT * FROM (SELECT p_partkey, p_retailprice, {SPELLED_TYPE} FROM part) "
    "QUALIFY row_number() OVER (PARTITION BY lower(rtrim(kind)) ORDER BY p_retailprice DESC, p_partkey) = 1",
)
def dearest_of_each_type(spark, folder):
    """One part for each type, however it is spelled."""
    parts = dirty(spark, folder, "part", "p_partkey", "p_retailprice", SPELLED_TYPE)
    return latest_per_key(parts, ["kind"], "p_retailprice", ["p_partkey"], collation=collation.SOURCE)


SPELLED_NATION = "CASE c_custkey % 3 WHEN 0 THEN lower(n_name) || ' ' WHEN 1 THEN n_name ELSE lower(n_name) END AS country"
CUSTOMERS_WITH_NATIONS = "customer JOIN nation ON c_nationkey = n_nationkey"


@query(
    "collated_references",
    f"SELECT c.*, n.n_regionkey, CASE WHEN k.n_name IS NULL THEN 1 ELSE 0 END AS missing FROM (SELECT c_custkey, {SPELLED_NATION} FROM {CUSTOMERS_WITH_NATIONS}) AS c "
    "LEFT JOIN nation AS n ON lower(rtrim(c.country)) = lower(rtrim(n.n_name)) "
    "LEFT JOIN (SELECT n_name FROM nation WHERE n_regionkey > 1) AS k ON lower(rtrim(c.country)) = lower(rtrim(k.n_name)) "
    "WHERE lower(rtrim(c.country)) IN (SELECT lower(rtrim(n_name)) FROM nation WHERE n_regionkey > 0)",
)
def customers_by_spelled_nation(spark, folder):
    """Customers whose country is spelled in several ways, resolved, flagged and filtered by the countries' names."""
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name", "n_regionkey")
    keyed = dirty(spark, folder, "customer", "c_custkey", "c_nationkey").join(nations, col("c_nationkey") == col("n_nationkey"))
    customers = keyed.selectExpr("c_custkey", SPELLED_NATION)
    known = exclude_orphans(customers, "country", nations.where("n_regionkey > 0"), "n_name", collation.SOURCE)
    flagged = flag_missing_ref(known, "country", nations.where("n_regionkey > 1"), "n_name", "missing", collation.SOURCE)
    names = nations.select("n_name", "n_regionkey")
    return resolve(flagged, "country", names, "n_name", collation.SOURCE).select("c_custkey", "country", "n_regionkey", "missing")


@query(
    "collated_unique",
    f"SELECT 'parts - duplicate kind' AS check_name, count(*) AS issue_count FROM (SELECT lower(rtrim(kind)) FROM (SELECT {SPELLED_TYPE} FROM part) GROUP BY 1 HAVING count(*) > 1) "
    f"UNION ALL SELECT 'parts - duplicate (kind, p_size)', count(*) FROM (SELECT kind, p_size FROM (SELECT p_size, {SPELLED_TYPE} FROM part) GROUP BY ALL HAVING count(*) > 1)",
)
def repeated_types(spark, folder):
    """A key that is unique only if spelling counts, and one compared as it is, from one reading of the table."""
    parts = dirty(spark, folder, "part", "p_size", SPELLED_TYPE)
    return quality.run_suite({"parts": parts}, [quality.unique("parts", "kind", folded=True), quality.unique("parts", "kind", "p_size")])


# --- references and keys -----------------------------------------------------------------------


@query(
    "exclude_orphans",
    "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem "
    "WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 10)",
)
def lines_of_large_parts(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    large = table(spark, folder, "part").filter(col("p_size") > 10)
    return exclude_orphans(lines, "l_partkey", large, "p_partkey")


MAYBE_SUPPLIER = "CASE WHEN l_linenumber = 5 THEN NULL ELSE l_suppkey END AS l_suppkey"


@query(
    "flag_missing_ref",
    "SELECT l_orderkey, l_linenumber, l_suppkey, CASE WHEN l_suppkey IN "
    "(SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) THEN 0 ELSE 1 END AS missing "
    f"FROM (SELECT l_orderkey, l_linenumber, {MAYBE_SUPPLIER} FROM lineitem)",
)
def lines_without_supplier(spark, folder):
    lines = dirty(spark, folder, "lineitem", "l_orderkey", "l_linenumber", MAYBE_SUPPLIER)
    solvent = table(spark, folder, "supplier").filter(col("s_acctbal") > 0)
    return flag_missing_ref(lines, "l_suppkey", solvent, "s_suppkey", "missing")


@query(
    "surrogate_key",
    "SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS order_number, o_orderkey, "
    "CAST(o_orderdate AS DATE) AS order_date FROM orders",
)
def numbered_orders(spark, folder):
    orders = dirty(spark, folder, "orders", "o_orderkey", "CAST(o_orderdate AS DATE) AS order_date")
    return surrogate_key(orders, ["order_date", "o_orderkey"], "order_number")


# --- quality rules -----------------------------------------------------------------------------

LINES = (
    "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_returnflag, "
    "l_extendedprice * (1 - l_discount) AS net, CAST(l_shipdate AS DATE) AS ship_date, "
    "CAST(o_orderdate AS DATE) AS order_date, "
    "CASE WHEN l_linenumber = 3 THEN NULL ELSE l_suppkey END AS l_suppkey "
    f"FROM {LINES_WITH_ORDERS}"
)
RULES: dict[str, list[quality.Rule]] = {
    "dq_nulls": [
        quality.not_null("lines", c) for c in ("l_orderkey", "l_suppkey", "ship_date", "order_date")
    ],
    "dq_duplicates": [
        quality.unique("lines", "l_orderkey"),
        quality.unique("lines", "l_orderkey", "l_linenumber"),
        quality.unique("lines", "l_suppkey"),
    ],
    "dq_domain": [
        quality.in_set("lines", "l_returnflag", ["A", "R"]),
        quality.in_set("lines", "l_linenumber", [1, 2, 3, 4, 5]),
        quality.in_set("lines", "l_suppkey", [1, 2, 3]),
        quality.not_blank("lines", "l_returnflag", "NULL or empty l_returnflag"),
    ],
    "dq_date_order": [
        quality.not_before("lines", "ship_date", "order_date", "shipped before ordered"),
        quality.not_before(
            "lines", "ship_date", "order_date", "returned before ordered", "l_returnflag = 'R'"
        ),
        quality.not_future("lines", "ship_date", TODAY, "future ship_date"),
    ],
    "dq_bounds": [
        quality.bound("lines", "l_quantity", "<=", 1, "quantity of 1 or less"),
        quality.bound("lines", "l_extendedprice", ">", 50000, "price above 50000"),
        quality.bound("lines", "l_suppkey", "<", 10, "low supplier key"),
    ],
    "dq_consistency": [
        quality.consistent("lines", "net", "l_extendedprice", "net differs from price"),
        quality.consistent("lines", "net", "l_extendedprice", "net differs by more than 100", 100),
    ],
    "dq_referential": [
        quality.references("lines", "l_suppkey", "solvent_suppliers", "s_suppkey"),
        quality.ReferenceRule(
            "lines", "returned to a solvent supplier", "l_suppkey", "solvent_suppliers", "s_suppkey",
            exists=True, only_if="l_returnflag = 'R'",
        ),
    ],
}
SOLVENT = "SELECT s_suppkey FROM supplier WHERE s_acctbal > 0"


def rule_sql(name: str) -> str:
    return f"WITH lines AS ({LINES}), solvent_suppliers AS ({SOLVENT})\n{suite_sql(RULES[name])}"


def checked_lines(name: str, spark: SparkSession, folder: str) -> DataFrame:
    columns = LINES.removeprefix("SELECT ").split(" FROM ")[0].split(", ")
    tables = {
        "lines": lines_with_orders(spark, folder, *columns),
        "solvent_suppliers": table(spark, folder, "supplier").filter(col("s_acctbal") > 0),
    }
    return quality.run_suite(tables, RULES[name])


for _name in RULES:
    query(_name, rule_sql(_name))(partial(checked_lines, _name))


_PROFILE_SQL = " UNION ALL ".join(
    f"SELECT '{extract}' AS extract, '{c}' AS column_name, count(*) AS row_count, count(*) - count(v) AS null_count, "
    "count(*) FILTER (WHERE trim(v) = '') AS blank_count, count(DISTINCT v) AS distinct_count, "
    f"count(v) - count(DISTINCT v) AS repeated_count FROM (SELECT CAST({c} AS VARCHAR) AS v FROM landed_{extract})"
    for extract, schema in LANDING_SCHEMAS.items() for c in schema.names
)


@query("column_profile", with_tables(_PROFILE_SQL))
def profile_of_extracts(spark, folder):
    """Every column of every extract."""
    extracts = {extract: landed(spark, folder, extract).select(*schema.names) for extract, schema in LANDING_SCHEMAS.items()}
    return quality.column_profiles(extracts).withColumnRenamed("table_name", "extract")


_SKETCHED = ("crm_cust_info", "crm_sales_details", "crm_supp_tkts")
_SKETCH_SQL = " UNION ALL ".join(
    f"SELECT '{extract}' AS extract, '{c}' AS column_name, count(*) AS row_count, count(*) - count(v) AS null_count, "
    "count(*) FILTER (WHERE trim(v) = '') AS blank_count, TRUE AS estimate_is_near, "
    f"CASE WHEN count(DISTINCT v) BETWEEN 1 AND 100 THEN (SELECT max(n) FROM (SELECT count({c}) AS n FROM landed_{extract} GROUP BY {c})) END AS most "
    f"FROM (SELECT CAST({c} AS VARCHAR) AS v FROM landed_{extract})"
    for extract in _SKETCHED for c in LANDING_SCHEMAS[extract].names
)


_HALF = "_half"


def _stored_in_halves(spark, folder, extract):
    """The extract in two halves, a partition folder each: derived once, for all that read it."""
    names, path = LANDING_SCHEMAS[extract].names, new_table_path(spark, extract)
    rows = landed(spark, folder, extract).select(*names).withColumn(_HALF, F.pmod(F.xxhash64(*names), F.lit(2)))
    rows.write.partitionBy(_HALF).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


@query("column_sketches", with_tables(_SKETCH_SQL))
def sketches_of_extracts(spark, folder):
    """Sketches of the two halves of three extracts, merged: whether each estimate is within four standard errors of the
    exact number, and how often the most frequent value is there, for columns of few values."""
    read = dict(zip(_SKETCHED, side_by_side([partial(_stored_in_halves, spark, folder, extract) for extract in _SKETCHED])))
    parts = []
    for extract in _SKETCHED:
        names = LANDING_SCHEMAS[extract].names
        rows = read[extract].select(*names)
        halves = [read[extract].where(col(_HALF) == k).select(*names) for k in (0, 1)]
        sketched = sketches.sketched_profile(sketches.merged_sketches([sketches.column_sketches(h, names) for h in halves]), 1)
        exact = quality.column_profile(rows, names).select("column_name", "distinct_count")
        error = F.abs(col("distinct_estimate") - col("distinct_count")) / F.greatest(col("distinct_count"), F.lit(1))
        parts.append(
            sketched.join(exact, "column_name").select(
                F.lit(extract).alias("extract"), "column_name", "row_count", "null_count", "blank_count",
                (error <= 4 * sketches.relative_error()).alias("estimate_is_near"),
                F.when(col("distinct_count").between(1, 100), F.get("frequent", F.lit(0))["count"]).alias("most"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


@query(
    "adaptive_profile",
    with_tables(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count(v) AS null_count, "
            "count(*) FILTER (WHERE trim(v) = '') AS blank_count, count(DISTINCT v) AS distinct_count, "
            f"count(v) - count(DISTINCT v) AS repeated_count, TRUE AS is_exact FROM (SELECT CAST({c} AS VARCHAR) AS v FROM landed_crm_supp_tkts)"
            for c in ("tkt_issue_cat", "tkt_status", "tkt_id", "tkt_emp_id")
        )
    ),
)
def profile_of_tickets(spark, folder):
    """Tickets by sketch first: few-valued columns and the one asked for are exact."""
    tickets = landed(spark, folder, "crm_supp_tkts").select("tkt_issue_cat", "tkt_status", "tkt_id", "tkt_emp_id")
    return sketches.adaptive_profile(tickets, tickets.columns, small=2000, exact=["tkt_id"])


@query(
    "column_values",
    with_tables(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS row_count "
            f"FROM landed_crm_supp_tkts GROUP BY {c}"
            for c in LANDING_SCHEMAS["crm_supp_tkts"].names
        )
    ),
)
def values_of_tickets(spark, folder):
    tickets = landed(spark, folder, "crm_supp_tkts")
    return quality.column_values(tickets, tickets.columns)


# --- landing and storing -----------------------------------------------------------------------


@query(
    "landing_typed",
    with_tables(
        "SELECT prd_id, prd_key, nullif(prd_nm, '') AS prd_nm, prd_cost, nullif(prd_line, '') AS prd_line, "
        "CAST(prd_start_dt AS TIMESTAMP) AS prd_start_dt, CAST(prd_end_dt AS TIMESTAMP) AS prd_end_dt FROM landed_crm_prd_info"
    ),
)
def landing_typed(spark, folder):
    """The products as a delimited file with other column names and CR LF, read by position: whole numbers, text,
    timestamps and empty fields."""
    products = landed(spark, folder, "crm_prd_info")
    fields = [F.coalesce(col(c).cast("string"), F.lit("")) for c in products.columns]
    path = new_table_path(spark, "extract")
    lines = products.select(F.concat_ws(",", *fields).alias("line"))
    _with_header(lines, len(fields)).write.option("lineSep", "\r\n").text(path)
    return split_rejected(read_landing(spark, path, LANDING_SCHEMAS["crm_prd_info"]))[0]


def _with_header(lines: DataFrame, width: int) -> DataFrame:
    """Each partition becomes a file, and each file begins with a header."""
    header = ",".join(f"column {i}" for i in range(width))
    marked = lines.select(F.monotonically_increasing_id().alias("place"), "line")
    first = F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) == 0
    return marked.select(
        F.explode(F.when(first, F.array(F.lit(header), F.col("line"))).otherwise(F.array("line"))).alias("line")
    )


_ORDER_LINE = (
    f"o_orderstatus || ',' || {as_text('o_custkey')} || ',' || "
    f"CASE o_orderkey % 5 WHEN 0 THEN 'x' WHEN 1 THEN '' ELSE {as_text('o_orderkey')} END "
    f"|| CASE WHEN o_orderkey % 7 = 0 THEN ',more' ELSE '' END"
)
_ORDER_BROKEN = "o_orderkey % 5 = 0 OR o_orderkey % 7 = 0"


@query(
    "landing_rejected",
    f"SELECT CASE WHEN {_ORDER_BROKEN} THEN {_ORDER_LINE} END AS rejected, "
    f"CASE WHEN NOT ({_ORDER_BROKEN}) THEN o_orderstatus END AS sls_ord_num, "
    f"CASE WHEN NOT ({_ORDER_BROKEN}) THEN CAST(o_custkey AS BIGINT) END AS sls_cst_id, "
    f"CASE WHEN NOT ({_ORDER_BROKEN}) AND o_orderkey % 5 > 1 THEN CAST(o_orderkey AS INTEGER) END AS sls_order_dt FROM orders",
)
def landing_rejected(spark, folder):
    """Lines that do not fit are put aside as they are; the others are typed."""
    schema = LANDING_SCHEMAS["crm_sales_details"]
    chosen = type(schema)([schema["sls_ord_num"], schema["sls_cst_id"], schema["sls_order_dt"]])
    path = new_table_path(spark, "extract")
    _with_header(dirty(spark, folder, "orders", f"{_ORDER_LINE} AS line"), 3).write.text(path)
    landed_path = new_table_path(spark, "landed")
    write_refresh(read_landing(spark, path, chosen), landed_path)
    good, bad = split_rejected(spark.read.parquet(landed_path))
    return good.select(F.lit(None).cast("string").alias("rejected"), "*").unionByName(
        bad.select(col(REJECTED).alias("rejected"), *(F.lit(None).cast(f.dataType).alias(f.name) for f in chosen))
    )


@query(
    "refresh_idempotent",
    "SELECT o_orderkey, o_orderpriority, TIMESTAMP '2024-06-30 00:00:00' AS dwh_create_date FROM orders",
)
def refresh_idempotent(spark, folder):
    """A table that is loaded twice and holds everything once, with its load time."""
    path = new_table_path(spark, "refresh")
    orders = table(spark, folder, "orders")
    for _ in range(2):
        publish(
            with_audit(orders, datetime.datetime(2024, 6, 30)), path,
            ["o_orderkey", "o_orderpriority", AUDIT_COLUMN],
        )
    return read_version(spark, path).withColumn(AUDIT_COLUMN, col(AUDIT_COLUMN).cast("timestamp_ntz"))


@query(
    "load_report",
    "SELECT 'orders' AS table_name, count(*) AS row_count, TRUE AS timed, TRUE AS within_batch FROM orders "
    "UNION ALL SELECT 'lineitem', count(*), TRUE, TRUE FROM lineitem UNION ALL "
    "SELECT '(batch)', (SELECT count(*) FROM orders) + (SELECT count(*) FROM lineitem), TRUE, TRUE",
)
def load_report(spark, folder):
    """Rows of two loads; seconds differ from run to run, so what is said of them is that they were taken, and that no
    load took longer than the batch."""
    jobs = {
        name: partial(write_refresh, table(spark, folder, name), new_table_path(spark, name))
        for name in ("orders", "lineitem")
    }
    loads = load_all(jobs)
    return run_report(spark, loads).select(
        col("table").alias("table_name"), col("rows").alias("row_count"), (col("seconds") > 0).alias("timed"),
        (col("seconds") <= loads.seconds).alias("within_batch"),
    )


@query(
    "not_null_gate",
    with_tables(
        "SELECT CASE WHEN cst_id IS NULL THEN 'held back' ELSE 'passed' END AS outcome, * FROM landed_crm_cust_info"
    ),
)
def gated_customers(spark, folder):
    """Both outcomes as one write stores them."""
    path = new_table_path(spark, "gated")
    write_gated(landed(spark, folder, "crm_cust_info"), ["cst_id"], path)
    outcome = F.when(col(OUTCOME) == HELD_BACK, F.lit("held back")).otherwise(col(OUTCOME))
    return read_version(spark, path).select(outcome.alias("outcome"), *LANDING_SCHEMAS["crm_cust_info"].names)


@query(
    "refresh_versions",
    "SELECT 1 AS version, 'pinned' AS reader, o_orderkey FROM orders WHERE o_orderkey % 2 = 0 "
    "UNION ALL SELECT 2, 'newest', o_orderkey FROM orders UNION ALL SELECT 2, 'after a failed load', o_orderkey FROM orders",
)
def refresh_versions(spark, folder):
    """What readers see of a table that is loaded twice whole, and once more by a load that ends half way."""
    path, orders = new_table_path(spark, "versions"), table(spark, folder, "orders").select("o_orderkey")
    publish(orders.where("o_orderkey % 2 = 0"), path)
    pinned = read_version(spark, path)
    publish(orders, path)
    newest = read_version(spark, path)
    broken = orders.withColumn("o_orderkey", F.when(col("o_orderkey") % 1000 == 7, F.raise_error(F.lit("lost"))).otherwise(col("o_orderkey")))
    try:
        publish(broken, path)
    except Exception as error:
        if "lost" not in str(error):
            raise
    readers = [(1, "pinned", pinned), (2, "newest", newest), (current(spark, path).number, "after a failed load", read_version(spark, path))]
    return reduce(DataFrame.unionByName, (rows.select(F.lit(n).alias("version"), F.lit(name).alias("reader"), "*") for n, name, rows in readers))


@query(
    "load_history",
    "SELECT name AS table_name, count(*) AS loads, CAST(sum(n) AS BIGINT) AS row_count FROM ("
    "SELECT 'orders' AS name, count(*) AS n FROM orders UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL "
    "SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'lineitem', count(*) FROM lineitem) GROUP BY name",
)
def load_history(spark, folder):
    """Two batches as the table of loads has them, each counted while it was written."""
    path = new_table_path(spark, "history")
    for _ in range(2):
        jobs = {n: lambda n=n: publish(table(spark, folder, n), f"{path}/{n}").rows for n in ("orders", "lineitem")}
        record_loads(spark, load_all(jobs), f"{path}/loads")
    loads = read_loads(spark, f"{path}/loads").where(col("table") != BATCH)
    return loads.groupBy(col("table").alias("table_name")).agg(F.count("*").alias("loads"), F.sum("rows").alias("row_count"))
