"""The twelve extracts, derived from the test tables.

The test tables are clean, so the dirt that the cleansing functions handle is put in here: spellings,
mixed dates, placeholders, duplicates and dangling references, chosen by the rows' own keys. The
expressions mean the same in Spark and in the SQL the results are checked against, and both read the
whole tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tierloom.session import new_table_path
from tierloom.sources.landing import LANDING_SCHEMAS
from workload.registry import table


def text(x: str) -> str:
    return f"CAST({x} AS STRING)"


def digits(x: str, n: int) -> str:
    """A number with zeros in front up to ``n`` digits; longer numbers stay whole."""
    return f"CASE WHEN length({text(x)}) < {n} THEN lpad({text(x)}, {n}, '0') ELSE {text(x)} END"


def choice(selector: str, *options: str) -> str:
    """The option at the selector's value; the last one for all higher values."""
    cases = " ".join(f"WHEN {i} THEN {o}" for i, o in enumerate(options[:-1]))
    return f"CASE {selector} {cases} ELSE {options[-1]} END"


def spelled(selector: str, *spellings: str) -> str:
    """The spelling at the selector's value, looked up in one string to keep the expression short."""
    return f"split_part('{'|'.join(spellings)}', '|', CAST({selector} + 1 AS INT))"


def day_text(day: str, days: str = "") -> str:
    """A date or timestamp as ``YYYY-MM-DD`` text, so many days later."""
    later = f" + CAST({days} AS INT)" if days else ""
    return text(f"CAST({day} AS DATE){later}")


def mixed_date(day: str, key: str) -> str:
    """``YYYY-MM-DD`` text in either format, sometimes missing or impossible."""
    return (
        f"CASE WHEN ({key}) % 31 = 0 THEN NULL WHEN ({key}) % 37 = 0 THEN '02/30/2024' "
        f"WHEN ({key}) % 41 = 0 THEN 'soon' WHEN ({key}) % 43 = 0 THEN '2/3/2024' "
        f"WHEN ({key}) % 3 = 0 "
        f"THEN substr({day}, 6, 2) || '/' || substr({day}, 9, 2) || '/' || substr({day}, 1, 4) "
        f"ELSE {day} END"
    )


def date_number(column: str, years: int = 0) -> str:
    return f"((year({column}) + {years}) * 10000 + month({column}) * 100 + day({column}))"


def group_of(part: str) -> str:
    return f"CAST(floor({part} / 3) AS BIGINT)"


def product_number(group: str) -> str:
    return f"'HL-U' || ({digits(group, 6)})"


def money(x: str) -> str:
    return text(f"CAST({x} AS DECIMAL(18,2))")


_GROUP = group_of("p_partkey")
_MAIN_CATEGORY = spelled(f"{_GROUP} % 4", "AC", "BI", "CL", "CO")
_SUB_CATEGORY = spelled(f"{_GROUP} % 5", "HE", "RF", "TB", "BR", "PE")
_LINE = "(l_orderkey + l_partkey + l_linenumber)"
_PRICE = "CAST(floor(l_extendedprice / l_quantity) AS INT)"
_UNITS = "CAST(floor(l_quantity) AS INT)"


@dataclass(frozen=True)
class Extract:
    """Columns over one test table, joined to another one on a key if ``join`` says so. ``prepared``
    columns are added to the source first, for others to use."""

    source: str
    columns: dict[str, str]
    join: tuple[str, str] | None = None
    prepared: dict[str, str] = field(default_factory=dict)
    distinct: bool = False

    def sql(self) -> str:
        columns = ", ".join(f"{e} AS {name}" for name, e in self.columns.items())
        prepared = "".join(f", {e} AS {name}" for name, e in self.prepared.items())
        join = f" JOIN {self.join[0]} ON {self.join[1]}" if self.join else ""
        return (
            f"SELECT {'DISTINCT ' if self.distinct else ''}{columns} "
            f"FROM (SELECT *{prepared} FROM {self.source}{join})"
        )


EXTRACTS: dict[str, Extract] = {
    # an order hands in the customer's record of that day: many records per customer
    "crm_cust_info": Extract(
        "orders",
        {
            "cst_id": "CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(o_custkey AS BIGINT) END",
            "cst_key": f"'AW' || ({digits('o_custkey', 8)})",
            "cst_firstname": "CASE WHEN o_orderkey % 3 = 0 THEN '  First' || "
            + text("o_custkey % 50")
            + " || ' ' WHEN o_orderkey % 41 = 0 THEN NULL ELSE 'First' || "
            + text("o_custkey % 50")
            + " END",
            "cst_lastname": f"' Last' || {text('o_custkey % 31')}",
            "cst_marital_status": choice(
                "o_orderkey % 5", "'S'", "'m '", "' M'", "NULL", "'X'"
            ),
            "cst_gnder": choice("o_orderkey % 6", "'F'", "'f '", "'M'", "NULL", "''", "' m'"),
            "cst_create_date": "CASE WHEN o_orderkey % 53 = 0 THEN NULL "
            "ELSE CAST(o_orderdate AS DATE) END",
        },
    ),
    # three consecutive parts are versions of one product
    "crm_prd_info": Extract(
        "part",
        {
            "prd_id": "CAST(p_partkey AS BIGINT)",
            "prd_key": f"{_MAIN_CATEGORY} || '-' || {_SUB_CATEGORY} || '-' || "
            + product_number(_GROUP),
            "prd_nm": "p_name",
            "prd_cost": "CASE WHEN p_partkey % 50 = 0 THEN NULL "
            "ELSE CAST(floor(p_retailprice) AS INT) END",
            "prd_line": choice("p_partkey % 7", "'M'", "'R '", "'s'", "'T'", "NULL", "''", "' r'"),
            "prd_start_dt": "DATE '2001-07-01' + CAST(p_partkey * 7 % 5 * 365 + p_size % 3 AS INT)",
            "prd_end_dt": "CAST(NULL AS DATE)",
        },
    ),
    "crm_sales_details": Extract(
        "lineitem",
        {
            "sls_ord_num": f"'SO' || {text('l_orderkey')}",
            "sls_prd_key": product_number(group_of("l_partkey")),
            "sls_cst_id": "CAST(o_custkey AS BIGINT)",
            "sls_order_dt": f"CAST(CASE WHEN {_LINE} % 40 = 0 THEN 0 WHEN {_LINE} % 41 = 0 "
            f"THEN 201302 WHEN {_LINE} % 43 = 0 THEN 20130231 "
            f"ELSE {date_number('o_orderdate')} END AS INT)",
            "sls_ship_dt": f"CAST({date_number('l_shipdate')} AS INT)",
            "sls_due_dt": f"CAST({date_number('l_shipdate', 1)} AS INT)",
            "sls_sales": choice(
                f"{_LINE} % 13",
                "NULL",
                "0",
                "-5",
                f"{_UNITS} * {_PRICE} + 7",
                f"{_UNITS} * {_PRICE}",
            ),
            "sls_quantity": choice(f"{_LINE} % 101", "0", "NULL", _UNITS),
            "sls_price": choice(f"{_LINE} % 17", "NULL", f"-{_PRICE}", "0", _PRICE),
        },
        join=("orders", "l_orderkey = o_orderkey"),
    ),
    "crm_camp_info": Extract(
        "orders",
        {
            "cmp_id": f"'CMP-' || {text('o_orderkey')}",
            "cmp_name": "CASE WHEN o_orderkey % 4 = 0 THEN '  Sale ' ELSE 'Sale ' END || "
            "o_orderpriority || ' '",
            "cmp_channel": "CASE WHEN o_orderkey % 59 = 0 THEN NULL ELSE "
            + spelled(
                "o_orderkey % 17",
                *("E-mail", "e_mail", "EMAIL", "SocialMedia", "social media", " sms", "Text"),
                *("DM", "Direct_Mail", "web", "TV Ad", "television", "radio", "in person"),
                *("In-Person", "fax", "Event "),
            )
            + " END",
            "cmp_budget": choice(
                "o_orderkey % 16",
                *("''", "NULL", "'abc'", f"'-' || {money('o_totalprice')}", "'12d'", "' 1e3 '"),
                money("o_totalprice"),
            ),
            "cmp_start_date": mixed_date("first_day", "o_orderkey"),
            "cmp_end_date": mixed_date("last_day", "o_orderkey + 1"),
        },
        prepared={
            "first_day": day_text("o_orderdate"),
            "last_day": day_text("o_orderdate", "o_orderkey * 7 % 100 - 10"),
        },
    ),
    "crm_supp_tkts": Extract(
        "events",
        {
            "tkt_id": f"'TKT-' || {text('event_id')}",
            "tkt_cst_id": choice(
                "event_id % 20", "''", "'999999'", "'abc'", "NULL", "'  '", text("user_id")
            ),
            "tkt_prd_key": choice(
                "event_id % 8",
                *("''", "'PRD-' || product", "replace(product, '-', '_')"),
                *("'PRD-' || replace(product, '-', '_')", "' ' || product || ' '", "NULL", "product"),
            ),
            "tkt_emp_id": choice(
                "event_id % 25",
                *("''", "'EMPX'", "' EMP007 '", "NULL"),
                f"'EMP' || ({digits('event_id % 310', 3)})",
            ),
            "tkt_issue_cat": spelled(
                "event_id % 9",
                *("BILLING", "technical", " Shipping", "Returns ", "product", "ACCOUNT"),
                *("general", "misc", ""),
            ),
            "tkt_status": spelled(
                "event_id % 13",
                *("open", "OPENED", "o", "Closed", "close", "Clsd", "Resolved", "Rsolvd"),
                *("pend", "In Progress", "in_progress", "lost", " Closed "),
            ),
            "tkt_open_date": mixed_date("opened", "event_id"),
            "tkt_resolution_date": "CASE WHEN event_id % 4 = 0 THEN '' ELSE "
            + mixed_date("resolved", "event_id + 1")
            + " END",
        },
        prepared={
            "product": product_number("event_id % 800"),
            "opened": day_text("ts"),
            "resolved": day_text("ts", "event_id * 7 % 90 - 5"),
        },
    ),
    "erp_cust_az12": Extract(
        "customer",
        {
            "cid": "CASE WHEN c_custkey % 3 = 0 THEN 'NAS' ELSE '' END || 'AW' || ("
            + digits("c_custkey", 8)
            + ")",
            "bdate": "CASE WHEN c_custkey % 71 = 0 THEN NULL "
            "ELSE DATE '1930-05-17' + CAST(c_custkey * 401 % 36500 AS INT) END",
            "gen": choice(
                "c_custkey % 7", "'F'", "'female'", "'MALE'", "'m '", "''", "NULL", "'Female'"
            ),
        },
    ),
    "erp_loc_a101": Extract(
        "customer",
        {
            "cid": f"'AW-' || ({digits('c_custkey', 8)})",
            "cntry": choice(
                "c_custkey % 9",
                *("'DE'", "'US'", "'usa'", "' United States '", "''", "NULL", "'  '", "'de '"),
                f"' Country ' || {text('c_nationkey')}",
            ),
        },
    ),
    # one subcategory has no entry under its own id, so its products stay without a category
    "erp_px_cat_g1v2": Extract(
        "part",
        {
            "id": f"{_MAIN_CATEGORY} || '_' || CASE WHEN {_GROUP} % 4 = 3 AND {_GROUP} % 5 = 4 "
            f"THEN 'PD' ELSE {_SUB_CATEGORY} END",
            "cat": spelled(f"{_GROUP} % 4", "Accessories", "Bikes", "Clothing", "Components"),
            "subcat": spelled(
                f"{_GROUP} % 5", "Helmets", "Frames", "Tubes", "Bottom Brackets", "Pedals"
            ),
            "maintenance": f"CASE WHEN {_GROUP} % 2 = 0 THEN 'Yes' ELSE 'No' END",
        },
        distinct=True,
    ),
    "erp_inv_q4v1": Extract(
        "lineitem",
        {
            "inv_id": f"'INV-' || {text('l_partkey')} || '-' || {text('l_suppkey % 4')}",
            "inv_prd_id": choice(
                f"{_LINE} % 37", "'x'", "NULL", text("-l_partkey"), text("l_partkey")
            ),
            "inv_wh_loc": spelled(
                f"{_LINE} % 5", "warehouse a", "Warehouse A ", "WAREHOUSE B", " warehouse b", "WH-C"
            ),
            "inv_stock_on_hand": choice(
                f"{_LINE} % 19", "'-' || " + text(_UNITS), "'12.5'", "NULL", text(_UNITS)
            ),
            "inv_reorder_level": choice(
                f"{_LINE} % 23", "'many'", "'0'", text(f"{_LINE} % 40")
            ),
            "inv_snap_date": mixed_date("shipped", _LINE),
        },
        prepared={"shipped": day_text("l_shipdate")},
    ),
    # the last three of ten suppliers hand in a record of one vendor
    "erp_vnd_z90": Extract(
        "supplier",
        {
            "vnd_id": "'VND-' || ("
            + digits(
                "CASE WHEN s_suppkey % 10 > 7 THEN s_suppkey - s_suppkey % 10 + 7 "
                "ELSE s_suppkey END",
                6,
            )
            + ")",
            "vnd_name": choice("s_suppkey % 16", "NULL", "'  '", "' ' || s_name || ' '"),
            "vnd_country": "CASE WHEN s_suppkey % 61 = 0 THEN NULL ELSE "
            + spelled(
                "s_suppkey % 13",
                *("england", "FRA", "us", "Peru ", "U.S.A", "Deutschland", "jp", "CAN"),
                *("au", "india", "ESP", "italy", "uk"),
            )
            + " END",
        },
    ),
    "erp_po_ord44": Extract(
        "lineitem",
        {
            "po_number": f"'PO-' || {text('l_orderkey')} || '-' || {text('l_linenumber')}",
            "po_vnd_id": choice(
                f"{_LINE} % 21",
                *("''", "NULL", "'VND-NONE'", f"' VND-' || ({digits('l_suppkey', 6)})"),
                f"'VND-' || ({digits('l_suppkey', 6)})",
            ),
            "po_prd_id": text("l_partkey"),
            "po_quantity_ordered": choice(
                f"{_LINE} % 14", text(_UNITS) + " || '.5'", text(_UNITS) + " || '.0'", "'x'", text(_UNITS)
            ),
            "po_unit_cost": choice(
                f"{_LINE} % 12",
                *("'$' || " + money("l_extendedprice"), "'N/A'", "'na'", "' '", "NULL", "'N.A.'"),
                *("' $5'", text(_PRICE)),
            ),
            "po_order_date": mixed_date("shipped", _LINE),
        },
        prepared={"shipped": day_text("l_shipdate")},
    ),
    "erp_hr_hx19": Extract(
        "customer",
        {
            "emp_id": f"'EMP' || ({digits('c_custkey % 297', 3)})",
            "emp_first_name": choice(
                "c_custkey % 23", "NULL", "'  '", "' Name' || " + text("c_custkey % 40")
            ),
            "emp_last_name": "CASE WHEN c_custkey % 29 = 0 THEN '' ELSE c_mktsegment END",
            "emp_role": "CASE WHEN c_custkey % 67 = 0 THEN NULL ELSE "
            + spelled(
                "c_custkey % 15",
                *("Analst", "T.Lead", "Dir.", "team lead", "Pilot ", "mgr", "SLS_REP", "Engr"),
                *("Sup Agent", "COORD", "spcl", "Consult", "Sales Rep", "ANLST", "Driver"),
            )
            + " END",
            "emp_branch_id": choice(
                "c_custkey % 17", "''", "NULL", f"' BR' || ({digits('c_nationkey', 3)})"
            ),
            "emp_hire_date": mixed_date("hired", "c_custkey"),
        },
        prepared={"hired": day_text("DATE '2008-01-15'", "c_custkey * 37 % 7300")},
    ),
}


_stored: dict[tuple[str, str], str] = {}


def store_extracts(spark: SparkSession, folder: str, files: int) -> None:
    """Store the extracts of ``folder``, each as so many files, for :func:`landed` to read from now on.

    For timings: what is measured then is the work on the extracts, not how they are derived from the test tables.
    """
    for name in EXTRACTS:
        path = new_table_path(spark, name)
        landed(spark, folder, name).repartition(files).write.parquet(path)
        _stored[folder, name] = path


def landed(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Extract ``name`` with the types of its landing schema."""
    if (folder, name) in _stored:
        return spark.read.parquet(_stored[folder, name])
    extract = EXTRACTS[name]
    rows = table(spark, folder, extract.source)
    if extract.join:
        other, condition = extract.join
        left, right = condition.split(" = ")
        other_rows = table(spark, folder, other)
        rows = rows.join(other_rows, rows[left] == other_rows[right])
    rows = rows.selectExpr("*", *(f"{e} AS {alias}" for alias, e in extract.prepared.items()))
    rows = rows.selectExpr(*(f"{e} AS {alias}" for alias, e in extract.columns.items()))
    if extract.distinct:
        rows = rows.distinct()
    return rows.to(LANDING_SCHEMAS[name])
