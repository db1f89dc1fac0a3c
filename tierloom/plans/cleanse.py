"""Cleansing: one function per extract, landing rows in, clean rows out.

All of it is projections over built-in expressions, plus one shuffle where a table is deduplicated,
versioned or checked against another table. Repairs read the landed columns only: each function
computes its columns in a single ``select``, so no repair sees another's result by accident.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierloom.functions import dates, flags, labels, numbers, text
from tierloom.functions import fixed_values as fixed
from tierloom.operators.dedup import first_per_key, latest_per_key
from tierloom.operators.history import validity_intervals
from tierloom.operators.references import exclude_orphans, flag_missing_ref
from tierloom.sources.landing import FILE_ORDER

col = F.col
#: Column of numbers that could not be held.
MISFIT = "_misfit"


def clean_customers(landed: DataFrame) -> DataFrame:
    """Latest record per customer; rows without a customer id are dropped."""
    latest = latest_per_key(
        landed.filter(col("cst_id").isNotNull()), ["cst_id"], "cst_create_date"
    )
    return latest.select(
        "cst_id",
        "cst_key",
        text.clean_text(col("cst_firstname")).alias("cst_firstname"),
        text.clean_text(col("cst_lastname")).alias("cst_lastname"),
        labels.map_codes(
            col("cst_marital_status"), fixed.MARITAL_STATUS, fixed.NOT_AVAILABLE
        ).alias("cst_marital_status"),
        labels.map_codes(col("cst_gnder"), fixed.CRM_GENDER, fixed.NOT_AVAILABLE).alias("cst_gndr"),
        "cst_create_date",
    )


def clean_products(landed: DataFrame) -> DataFrame:
    """Product versions with their validity. Versions belong together by the whole composite key,
    before it is split; the end dates that were landed are ignored."""
    versions = validity_intervals(
        landed.drop("prd_end_dt"), ["prd_key"], "prd_start_dt", ["prd_id"], "prd_end_dt"
    )
    return versions.select(
        "prd_id",
        text.category_part(col("prd_key")).alias("cat_id"),
        text.product_part(col("prd_key")).alias("prd_key"),
        "prd_nm",
        F.coalesce(col("prd_cost"), F.lit(0)).alias("prd_cost"),
        labels.map_codes(col("prd_line"), fixed.PRODUCT_LINE, fixed.NOT_AVAILABLE).alias(
            "prd_line"
        ),
        col("prd_start_dt").cast("date").alias("prd_start_dt"),
        "prd_end_dt",
    )


def clean_sales(landed: DataFrame, strict_dates: bool = False) -> DataFrame:
    """Order lines with real dates and consistent amounts; lines are not deduplicated. With
    ``strict_dates`` an eight-digit number that is no date fails the load instead of giving NULL."""
    amount, quantity, price = col("sls_sales"), col("sls_quantity"), col("sls_price")
    return landed.select(
        "sls_ord_num",
        "sls_prd_key",
        "sls_cst_id",
        *(
            dates.parse_yyyymmdd(col(c), strict_dates).alias(c)
            for c in ("sls_order_dt", "sls_ship_dt", "sls_due_dt")
        ),
        numbers.repair_amount(amount, quantity, price).alias("sls_sales"),
        "sls_quantity",
        numbers.repair_price(amount, quantity, price).alias("sls_price"),
    )


def clean_campaigns(landed: DataFrame) -> DataFrame:
    """Campaigns with one spelling per channel, readable budgets and dates; inverted date ranges are
    flagged and kept."""
    parsed = landed.select(
        "cmp_id",
        text.clean_text(col("cmp_name")).alias("cmp_name"),
        labels.canonicalize(col("cmp_channel"), fixed.CAMPAIGN_CHANNEL, fixed.OTHER).alias(
            "cmp_channel"
        ),
        numbers.absolute_amount(col("cmp_budget")).alias("cmp_budget"),
        dates.parse_date_multi(col("cmp_start_date")).alias("cmp_start_date"),
        dates.parse_date_multi(col("cmp_end_date")).alias("cmp_end_date"),
    )
    return parsed.withColumn(
        "flag_invalid_date_range", flags.flag_range(col("cmp_start_date"), col("cmp_end_date"))
    )


def clean_tickets(landed: DataFrame) -> DataFrame:
    """Support tickets with repaired references; a reference that cannot be meant becomes NULL."""
    return landed.select(
        "tkt_id",
        numbers.null_if_sentinel(col("tkt_cst_id"), fixed.UNKNOWN_CUSTOMER_ID).alias("tkt_cst_id"),
        text.repair_key(col("tkt_prd_key"), fixed.TICKET_PRODUCT_PREFIX).alias("tkt_prd_key"),
        text.null_if_suffix_above(
            col("tkt_emp_id"), fixed.EMPLOYEE_NUMBER_START, fixed.LAST_EMPLOYEE_NUMBER
        ).alias("tkt_emp_id"),
        labels.canonicalize(col("tkt_issue_cat"), fixed.ISSUE_CATEGORY, fixed.UNKNOWN).alias(
            "tkt_issue_cat"
        ),
        labels.canonicalize(col("tkt_status"), fixed.TICKET_STATUS, fixed.UNKNOWN).alias(
            "tkt_status"
        ),
        dates.parse_date_multi(col("tkt_open_date")).alias("tkt_open_date"),
        dates.parse_date_multi(col("tkt_resolution_date")).alias("tkt_resolution_date"),
    )


def clean_demographics(landed: DataFrame, as_of=None) -> DataFrame:
    """Customer demographics under the customer's own key; birth dates after ``as_of`` are NULL."""
    return landed.select(
        text.strip_prefix(col("cid"), fixed.CUSTOMER_ID_PREFIX).alias("cid"),
        dates.null_if_after(col("bdate"), as_of).alias("bdate"),
        labels.canonicalize(col("gen"), fixed.ERP_GENDER, fixed.NOT_AVAILABLE).alias("gen"),
    )


def clean_locations(landed: DataFrame) -> DataFrame:
    """Customer countries under the customer's own key."""
    country = labels.canonicalize(
        text.blank_to_null(col("cntry")), fixed.CUSTOMER_COUNTRY, default=None
    )
    return landed.select(
        text.swap_delimiter(col("cid"), "-", "").alias("cid"),
        F.coalesce(country, F.lit(fixed.NOT_AVAILABLE)).alias("cntry"),
    )


def clean_categories(landed: DataFrame) -> DataFrame:
    """Product categories, which need no cleansing."""
    return landed.select("id", "cat", "subcat", "maintenance")


def clean_employees(landed: DataFrame) -> DataFrame:
    """Record with the latest readable hire date per employee."""
    parsed = landed.select(
        "emp_id",
        text.default_text(col("emp_first_name"), fixed.MISSING_NAME).alias("emp_first_name"),
        text.default_text(col("emp_last_name"), fixed.MISSING_NAME).alias("emp_last_name"),
        labels.canonicalize(col("emp_role"), fixed.JOB_ROLE, default=None).alias("emp_role"),
        text.default_text(col("emp_branch_id"), fixed.UNKNOWN).alias("emp_branch_id"),
        dates.parse_date_multi(col("emp_hire_date")).alias("emp_hire_date"),
    )
    return latest_per_key(parsed, ["emp_id"], "emp_hire_date").select(
        "emp_id",
        "emp_first_name",
        "emp_last_name",
        text.full_name(col("emp_first_name"), col("emp_last_name")).alias("emp_full_name"),
        "emp_role",
        "emp_branch_id",
        "emp_hire_date",
    )


def clean_vendors(landed: DataFrame) -> DataFrame:
    """First record per vendor: first in the file if the landing kept the file order, otherwise the
    one with the smallest name and country."""
    order = [FILE_ORDER] if FILE_ORDER in landed.columns else None
    return first_per_key(landed, ["vnd_id"], order).select(
        "vnd_id",
        text.default_text(col("vnd_name"), fixed.UNKNOWN_VENDOR).alias("vnd_name"),
        labels.canonicalize(col("vnd_country"), fixed.VENDOR_COUNTRY, default=None).alias(
            "vnd_country"
        ),
    )


def _first_misfit(values: dict[str, Column], pattern: str = numbers.INTEGER_PATTERN) -> Column:
    """``column: text`` of the first column whose number could not be held, of those that ``values`` were made of."""
    found = (numbers.misfit(col(c), value, pattern) for c, value in values.items())
    return F.coalesce(*(F.concat(F.lit(f"{c}: "), text) for c, text in zip(values, found)))


def clean_inventory(landed: DataFrame, products: DataFrame, misfits: bool = False) -> DataFrame:
    """Latest snapshot per inventory id, among those of known products only: a snapshot of an unknown
    product is gone before the latest one is picked. ``products`` hold the known ids as ``prd_id``: cleansed
    product versions or, as cleansing neither adds nor drops any, landed ones. Stock and level have 64 bits; ``misfits`` adds
    ``_misfit``, the first number of the row that has more."""
    numbers_of = {c: numbers.safe_long(col(c)) for c in ("inv_stock_on_hand", "inv_reorder_level")}
    parsed = landed.select(
        "inv_id",
        numbers.safe_long(col("inv_prd_id")).alias("inv_prd_id"),
        text.upper_code(col("inv_wh_loc")).alias("inv_wh_loc"),
        *(value.alias(c) for c, value in numbers_of.items()),
        dates.parse_date_multi(col("inv_snap_date")).alias("inv_snap_date"),
        *([_first_misfit(numbers_of).alias(MISFIT)] if misfits else []),
    )
    floored = parsed.withColumn("inv_stock_on_hand", numbers.floor_at(col("inv_stock_on_hand"), 0))
    known = exclude_orphans(floored, "inv_prd_id", products, "prd_id")
    return latest_per_key(known, ["inv_id"], "inv_snap_date").select(
        "inv_id",
        "inv_prd_id",
        "inv_wh_loc",
        "inv_stock_on_hand",
        "inv_reorder_level",
        flags.flag_below(col("inv_stock_on_hand"), col("inv_reorder_level")).alias("below_reorder"),
        "inv_snap_date",
        *([MISFIT] if misfits else []),
    )


def clean_purchase_orders(landed: DataFrame, vendors: DataFrame, misfits: bool = False) -> DataFrame:
    """Latest record per purchase order, flagged where no vendor is known for it. ``vendors`` are
    cleansed vendors. Quantities have 64 bits; ``misfits`` adds ``_misfit``, a quantity that has more."""
    quantity = numbers.round_long(col("po_quantity_ordered"))
    parsed = landed.select(
        "po_number",
        text.blank_to_null(col("po_vnd_id")).alias("po_vnd_id"),
        numbers.safe_long(col("po_prd_id")).alias("po_prd_id"),
        quantity.alias("po_quantity_ordered"),
        numbers.parse_money(col("po_unit_cost")).alias("po_unit_cost"),
        dates.parse_date_multi(col("po_order_date")).alias("po_order_date"),
        *([_first_misfit({"po_quantity_ordered": quantity}, numbers.NUMBER_PATTERN).alias(MISFIT)] if misfits else []),
    )
    latest = latest_per_key(parsed, ["po_number"], "po_order_date")
    flagged = flag_missing_ref(latest, "po_vnd_id", vendors, "vnd_id", "flag_missing_vendor")
    return flagged.select(
        "po_number",
        "po_vnd_id",
        "po_prd_id",
        "po_quantity_ordered",
        "po_unit_cost",
        numbers.derived_total(col("po_quantity_ordered"), col("po_unit_cost")).alias("total_cost"),
        "po_order_date",
        "flag_missing_vendor",
        *([MISFIT] if misfits else []),
    )
