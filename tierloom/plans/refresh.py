"""Full refresh: extracts -> landed tables -> cleansed tables -> star schema.

Every load publishes a new version of its table as a whole (:mod:`tierloom.sources.versions`), so a load that fails
leaves the old table readable, and a rerun starts over cleanly. Tables that do not depend on each other are loaded side by side.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierloom.plans import cleanse, star
from tierloom.plans.cleanse import MISFIT
from tierloom.sources.landing import (
    LANDING_FILES,
    LANDING_SCHEMAS,
    REJECTED,
    read_landing,
)
from tierloom.sources.tables import (
    REQUIRED_COLUMNS,
    Batch,
    assert_absent,
    assert_required,
    complete,
    load_all,
    record_loads,
    side_by_side,
    with_audit,
)
from tierloom.sources.versions import HELD_BACK, PASSED, current, publish, read_version

# What must be cleansed first, because another table is checked against it.
_CHECKED_AGAINST = {"erp_inv_q4v1": "crm_prd_info", "erp_po_ord44": "erp_vnd_z90"}


def land(
    spark: SparkSession, extracts: str, landed: str, tables: Mapping[str, str] | None = None, log: str | None = None
) -> Batch:
    """Store the extracts under ``extracts`` as typed tables under ``landed``. ``tables`` maps table names to files, by
    default all twelve. Lines that do not fit are held back in the same write; see :func:`read_landed`. ``log`` is the table
    the loads are recorded in."""

    def load(table: str, file: str) -> int:
        rows = read_landing(
            spark, f"{extracts}/{file}", LANDING_SCHEMAS[table], file_order=table == "erp_vnd_z90"
        )
        fits = F.col(REJECTED).isNull()
        return publish(rows, f"{landed}/{table}", outcomes={PASSED: fits, HELD_BACK: ~fits}).outcomes[PASSED]

    files = LANDING_FILES if tables is None else tables
    batch = load_all({table: partial(load, table, file) for table, file in files.items()})
    return batch if log is None else record_loads(spark, batch, log)


def read_landed(spark: SparkSession, landed: str, table: str, rejected: bool = False) -> DataFrame:
    """The rows of a landed table, or with ``rejected`` the lines that did not fit, as ``_rejected_line``. A table that was
    published without outcomes holds nothing back."""
    return _outcome(spark, f"{landed}/{table}", rejected) if rejected else _outcome(spark, f"{landed}/{table}", False).drop(REJECTED)


def _outcome(spark: SparkSession, path: str, held_back: bool) -> DataFrame:
    if current(spark, path).outcomes:
        return read_version(spark, path, outcome=HELD_BACK if held_back else PASSED)
    return read_version(spark, path).limit(0) if held_back else read_version(spark, path)


def _cleansers(read: Callable[[str], DataFrame], clean: Callable[[str], DataFrame], as_of):
    return {
        "crm_cust_info": lambda: cleanse.clean_customers(read("crm_cust_info")),
        "crm_prd_info": lambda: cleanse.clean_products(read("crm_prd_info")),
        "crm_sales_details": lambda: cleanse.clean_sales(read("crm_sales_details")),
        "crm_camp_info": lambda: cleanse.clean_campaigns(read("crm_camp_info")),
        "crm_supp_tkts": lambda: cleanse.clean_tickets(read("crm_supp_tkts")),
        "erp_cust_az12": lambda: cleanse.clean_demographics(read("erp_cust_az12"), as_of),
        "erp_loc_a101": lambda: cleanse.clean_locations(read("erp_loc_a101")),
        "erp_px_cat_g1v2": lambda: cleanse.clean_categories(read("erp_px_cat_g1v2")),
        "erp_hr_hx19": lambda: cleanse.clean_employees(read("erp_hr_hx19")),
        "erp_vnd_z90": lambda: cleanse.clean_vendors(read("erp_vnd_z90")),
        "erp_inv_q4v1": lambda: cleanse.clean_inventory(
            read("erp_inv_q4v1"), clean("crm_prd_info"), misfits=True
        ),
        "erp_po_ord44": lambda: cleanse.clean_purchase_orders(
            read("erp_po_ord44"), clean("erp_vnd_z90"), misfits=True
        ),
    }


def cleanse_all(
    spark: SparkSession, landed: str, cleansed: str, as_of=None, audit_time=None, hold_back: bool = False, log: str | None = None
) -> Batch:
    """Cleanse the tables landed under ``landed`` into ``cleansed``, each with its load time. A NULL in a required column,
    and a number that 64 bits cannot hold, fail the load or, with ``hold_back``, keep that row out of the table, in the same write;
    see :func:`read_cleansed`. A table that is checked against another one waits for that one only. ``log`` is the table the
    loads are recorded in."""
    plans = _cleansers(
        lambda table: read_landed(spark, landed, table), lambda table: read_cleansed(spark, cleansed, table), as_of
    )

    def load(table: str) -> int:
        required, path, rows = REQUIRED_COLUMNS.get(table, ()), f"{cleansed}/{table}", plans[table]()
        checked = MISFIT in rows.columns
        if hold_back:
            whole = complete(required) & F.col(MISFIT).isNull() if checked else complete(required)
            return publish(with_audit(rows, audit_time), path, outcomes={PASSED: whole, HELD_BACK: ~whole}).outcomes[PASSED]
        if checked:
            rows = assert_absent(rows, MISFIT)
        return publish(with_audit(assert_required(rows, required), audit_time), path).rows

    batch = load_all({t: partial(load, t) for t in plans}, after=_CHECKED_AGAINST)
    return batch if log is None else record_loads(spark, batch, log)


def read_cleansed(spark: SparkSession, cleansed: str, table: str, held_back: bool = False) -> DataFrame:
    """The newest version of a cleansed table, or the rows that its gate held back."""
    rows = _outcome(spark, f"{cleansed}/{table}", held_back)
    return rows if held_back else rows.drop(MISFIT)


def store_star(star: Mapping[str, DataFrame], path: str, log: str | None = None) -> Batch:
    """Publish the tables of the star under ``path``."""
    batch = load_all({name: lambda n=name: publish(star[n], f"{path}/{n}").rows for name in star})
    return batch if log is None else record_loads(next(iter(star.values())).sparkSession, batch, log)


def build_star(cleansed: Mapping[str, DataFrame], as_of=None) -> dict[str, DataFrame]:
    """The nine tables of the star schema over the cleansed tables. Dimensions with surrogate keys are
    stored in the shared folder by this call; the rest is lazy."""
    customers, products = side_by_side(
        [
            lambda: star.dim_customers(
                cleansed["crm_cust_info"], cleansed["erp_cust_az12"], cleansed["erp_loc_a101"]
            ),
            lambda: star.dim_products(cleansed["crm_prd_info"], cleansed["erp_px_cat_g1v2"]),
        ]
    )
    employees = star.dim_employees(cleansed["erp_hr_hx19"], as_of)
    vendors = star.dim_vendors(cleansed["erp_vnd_z90"])
    return {
        "dim_customers": customers,
        "dim_products": products,
        "dim_employees": employees,
        "dim_vendors": vendors,
        "dim_campaigns": star.dim_campaigns(cleansed["crm_camp_info"]),
        "fact_sales": star.fact_sales(cleansed["crm_sales_details"], products, customers),
        "fact_support_tickets": star.fact_support_tickets(
            cleansed["crm_supp_tkts"], customers, employees, products, as_of
        ),
        "fact_inventory": star.fact_inventory(cleansed["erp_inv_q4v1"], products),
        "fact_purchase_orders": star.fact_purchase_orders(
            cleansed["erp_po_ord44"], vendors, products
        ),
    }


def register_views(tables: Mapping[str, DataFrame], prefix: str = "") -> None:
    """Make the tables available to ``spark.sql`` as temporary views."""
    for name, df in tables.items():
        df.createOrReplaceTempView(prefix + name)
