"""Queries over the layers: cleansing of every extract, dimensions, facts, quality suites, reports."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierloom.plans import checks, cleanse, reports, star
from tierloom.plans.refresh import build_star, cleanse_all, read_cleansed, store_star
from tierloom.session import new_table_path
from tierloom.sources.tables import BATCH, load_all, read_loads, side_by_side, write_refresh
from tierloom.sources.versions import publish
from workload.extracts import landed
from workload.oracle import suite_sql, with_tables
from workload.registry import AS_OF, query


AUDIT_TIME = datetime.datetime(2024, 6, 30)


class Layers:
    """The layers over one folder of test tables.

    Tables are built when first asked for and each only once, so that a dimension is numbered once
    however many facts of a query use it.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder
        self._built: dict[str, DataFrame] = {}

    def landed(self, name: str) -> DataFrame:
        return landed(self._spark, self._folder, name)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = _BUILDERS[name](self)
        return self._built[name]

    def replace(self, tables: dict[str, DataFrame]) -> None:
        """Use these tables from now on, such as stored ones for those they were computed from."""
        self._built.update(tables)

    def shared(self, name: str) -> Layers:
        """The same layers with a table stored that is used more than once."""
        path = new_table_path(self._spark, name)
        write_refresh(self[name], path)
        self.replace({name: self._spark.read.parquet(path)})
        return self

    def numbered(self) -> Layers:
        """The same layers with both numbered dimensions built, side by side."""
        side_by_side([partial(self.__getitem__, n) for n in ("dim_customers", "dim_products")])
        return self


def refreshed(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The cleansed tables as the refresh stores them, with its gates and load time, from landed tables."""
    layers, path = Layers(spark, folder), new_table_path(spark, "layers")

    land_tables(layers, f"{path}/landed")
    cleanse_all(spark, f"{path}/landed", f"{path}/cleansed", AS_OF, AUDIT_TIME)
    return {name: read_cleansed(spark, f"{path}/cleansed", name) for name in CLEANSED}


def land_tables(layers: Layers, path: str) -> None:
    """The landed tables, published; no line misfits here, so that nothing is split off."""
    load_all({name: partial(lambda n: publish(layers.landed(n), f"{path}/{n}").rows, name) for name in CLEANSED})


_BUILDERS: dict[str, Callable[[Layers], DataFrame]] = {
    "crm_cust_info": lambda t: cleanse.clean_customers(t.landed("crm_cust_info")),
    "crm_prd_info": lambda t: cleanse.clean_products(t.landed("crm_prd_info")),
    "crm_sales_details": lambda t: cleanse.clean_sales(t.landed("crm_sales_details")),
    "crm_camp_info": lambda t: cleanse.clean_campaigns(t.landed("crm_camp_info")),
    "crm_supp_tkts": lambda t: cleanse.clean_tickets(t.landed("crm_supp_tkts")),
    "erp_cust_az12": lambda t: cleanse.clean_demographics(t.landed("erp_cust_az12"), AS_OF),
    "erp_loc_a101": lambda t: cleanse.clean_locations(t.landed("erp_loc_a101")),
    "erp_px_cat_g1v2": lambda t: cleanse.clean_categories(t.landed("erp_px_cat_g1v2")),
    "erp_hr_hx19": lambda t: cleanse.clean_employees(t.landed("erp_hr_hx19")),
    "erp_vnd_z90": lambda t: cleanse.clean_vendors(t.landed("erp_vnd_z90")),
    "erp_inv_q4v1": lambda t: cleanse.clean_inventory(
        t.landed("erp_inv_q4v1"), t.landed("crm_prd_info")
    ),
    "erp_po_ord44": lambda t: cleanse.clean_purchase_orders(
        t.landed("erp_po_ord44"), t["erp_vnd_z90"]
    ),
    "conformed_customers": lambda t: star.conform_customers(
        t["crm_cust_info"], t["erp_cust_az12"], t["erp_loc_a101"]
    ),
    # products as facts see them that carry no surrogate key
    "categorized_products": lambda t: star.categorize_products(
        t["crm_prd_info"], t["erp_px_cat_g1v2"]
    ),
    "dim_customers": lambda t: star.dim_customers(
        t["crm_cust_info"], t["erp_cust_az12"], t["erp_loc_a101"]
    ),
    "dim_products": lambda t: star.dim_products(t["crm_prd_info"], t["erp_px_cat_g1v2"]),
    "dim_employees": lambda t: star.dim_employees(t["erp_hr_hx19"], AS_OF),
    "dim_vendors": lambda t: star.dim_vendors(t["erp_vnd_z90"]),
    "dim_campaigns": lambda t: star.dim_campaigns(t["crm_camp_info"]),
    "fact_sales": lambda t: star.fact_sales(
        t["crm_sales_details"], t["dim_products"], t["dim_customers"]
    ),
    "fact_support_tickets": lambda t: star.fact_support_tickets(
        t["crm_supp_tkts"], t["conformed_customers"], t["dim_employees"], t["categorized_products"], AS_OF
    ),
    "fact_inventory": lambda t: star.fact_inventory(t["erp_inv_q4v1"], t["categorized_products"]),
    "fact_purchase_orders": lambda t: star.fact_purchase_orders(
        t["erp_po_ord44"], t["dim_vendors"], t["categorized_products"]
    ),
}

CLEANSED = list(_BUILDERS)[:12]
STAR = [name for name in _BUILDERS if name.startswith(("dim_", "fact_"))]

_TABLE_QUERIES = {
    "clean_customers": "crm_cust_info",
    "clean_products": "crm_prd_info",
    "clean_sales": "crm_sales_details",
    "clean_campaigns": "crm_camp_info",
    "clean_tickets": "crm_supp_tkts",
    "clean_demographics": "erp_cust_az12",
    "clean_locations": "erp_loc_a101",
    "clean_categories": "erp_px_cat_g1v2",
    "clean_employees": "erp_hr_hx19",
    "clean_vendors": "erp_vnd_z90",
    "clean_inventory": "erp_inv_q4v1",
    "clean_purchase_orders": "erp_po_ord44",
    "conform_customer": "conformed_customers",
    "dim_customers": "dim_customers",
    "dim_product": "dim_products",
    "dim_employees": "dim_employees",
    "dim_vendors": "dim_vendors",
    "dim_campaigns": "dim_campaigns",
    "fact_sales": "fact_sales",
    "fact_tickets": "fact_support_tickets",
    "fact_inventory": "fact_inventory",
    "fact_purchase": "fact_purchase_orders",
}


def _whole_table(name: str):
    if name == "fact_purchase_orders":
        return lambda spark, folder: Layers(spark, folder).shared("erp_vnd_z90")[name]
    if name == "fact_sales":
        return lambda spark, folder: Layers(spark, folder).numbered()[name]
    return lambda spark, folder: Layers(spark, folder)[name]


for _query, _table in _TABLE_QUERIES.items():
    query(_query, with_tables(f"SELECT * FROM {_table}"))(_whole_table(_table))


@query("dq_suite", suite_sql(checks.cleansed_rules(AS_OF), checks.CLEANSED_PREFIX))
def dq_suite(spark, folder):
    return checks.check_cleansed(refreshed(spark, folder), AS_OF)


@query("dq_suite_star", suite_sql(checks.star_rules(AS_OF)))
def dq_suite_star(spark, folder):
    return checks.check_star(build_star(refreshed(spark, folder), AS_OF), AS_OF)


@query(
    "row_counts",
    with_tables(
        "\nUNION ALL ".join(
            f"SELECT '{prefix}{name}' AS table_name, count(*) AS row_count FROM {name}"
            for prefix, names in ((checks.CLEANSED_PREFIX, CLEANSED), (checks.STAR_PREFIX, STAR))
            for name in names
        )
    ),
)
def all_row_counts(spark, folder):
    """Rows as they were counted by the loads of both layers; the result reads the table of loads alone."""
    path = new_table_path(spark, "layers")
    land_tables(Layers(spark, folder), f"{path}/landed")
    cleanse_all(spark, f"{path}/landed", f"{path}/cleansed", AS_OF, AUDIT_TIME, log=f"{path}/loads/cleansed")
    star_tables = build_star({name: read_cleansed(spark, f"{path}/cleansed", name) for name in CLEANSED}, AS_OF)
    store_star(star_tables, f"{path}/star", log=f"{path}/loads/star")
    counts = [
        read_loads(spark, f"{path}/loads/{layer}").where(F.col("table") != BATCH).select(F.concat(F.lit(prefix), "table").alias("table_name"), F.col("rows").alias("row_count"))
        for layer, prefix in (("cleansed", checks.CLEANSED_PREFIX), ("star", checks.STAR_PREFIX))
    ]
    return counts[0].unionByName(counts[1])


def _rate(column: str) -> str:
    return f"CAST(100.0 * count({column}) / nullif(count(*), 0) AS DECIMAL(5,1))"


@query(
    "join_match_rates",
    with_tables(f"""
SELECT 'sales products' AS reference, count(*) AS total, count(product_key) AS matched,
       {_rate('product_key')}::DOUBLE AS match_pct, CAST(NULL AS BIGINT) AS beside FROM fact_sales
UNION ALL SELECT 'sales customers', count(*), count(customer_key), {_rate('customer_key')}, NULL
FROM fact_sales
UNION ALL SELECT 'ticket customers', count(*), count(customer_id), {_rate('customer_id')}, NULL
FROM fact_support_tickets
UNION ALL SELECT 'ticket employees', count(*), count(employee_id), {_rate('employee_id')}, NULL
FROM fact_support_tickets
UNION ALL SELECT 'ticket products', count(*), count(product_key), {_rate('product_key')}, NULL
FROM fact_support_tickets
UNION ALL SELECT 'purchase order vendors', count(*), count(vendor_id), {_rate('vendor_id')},
       count(*) FILTER (WHERE flag_missing_vendor = 1) FROM fact_purchase_orders
UNION ALL SELECT 'purchase order products', count(*), count(product_id), {_rate('product_id')}, NULL
FROM fact_purchase_orders
UNION ALL SELECT 'inventory products', count(*), count(product_id), {_rate('product_id')},
       count(*) FILTER (WHERE product_id IS NULL) FROM fact_inventory"""),
)
def all_match_rates(spark, folder):
    """The rate reports of the four facts, one line per reference. ``beside`` is what two of them report besides: orders
    flagged for a missing vendor, and snapshots without a product."""
    layers = build_star(refreshed(spark, folder), AS_OF)
    lines = {
        "sales": (
            checks.sales_match_rates(layers["fact_sales"]), "total_sales",
            ["product", "customer"],
        ),
        "ticket": (
            checks.ticket_match_rates(layers["fact_support_tickets"]), "total_tickets",
            ["customer", "employee", "product"],
        ),
        "purchase order": (
            checks.purchase_order_match_rates(layers["fact_purchase_orders"]), "total_pos",
            ["vendor", "product"],
        ),
        "inventory": (
            checks.inventory_match_rates(layers["fact_inventory"]), "total_inv_snapshots",
            ["product"],
        ),
    }
    beside = {
        ("purchase order", "vendor"): "flagged_missing_vendor", ("inventory", "product"): "unmatched_products"
    }
    reports_as_lines = [
        rates.select(
            F.inline(
                F.array(
                    *(
                        F.struct(
                            F.lit(f"{fact} {noun}s").alias("reference"),
                            F.col(total).alias("total"),
                            F.col(f"matched_{noun}s").alias("matched"),
                            F.col(f"{noun}_match_pct").cast("double").alias("match_pct"),
                            F.col(beside[fact, noun]).alias("beside")
                            if (fact, noun) in beside
                            else F.lit(None).cast("bigint").alias("beside"),
                        )
                        for noun in nouns
                    )
                )
            )
        )
        for fact, (rates, total, nouns) in lines.items()
    ]
    result = reports_as_lines[0]
    for more in reports_as_lines[1:]:
        result = result.unionByName(more)
    return result


@query(
    "bi_top_customers",
    with_tables("""
SELECT customer_id, first_name || ' ' || last_name AS customer_name,
       CAST(sum(sales_amount) AS BIGINT) AS total_sales
FROM fact_sales JOIN dim_customers USING (customer_key)
GROUP BY ALL ORDER BY total_sales DESC NULLS LAST, customer_id LIMIT 10"""),
)
def bi_top_customers(spark, folder):
    layers = Layers(spark, folder).numbered()
    return reports.top_customers(layers["fact_sales"], layers["dim_customers"])


@query(
    "bi_agent_performance",
    with_tables("""
SELECT employee_full_name, job_title, count(*) AS total_tickets,
       round(avg(days_to_resolve), 6) AS avg_days_to_resolve,
       CAST(sum(days_to_resolve) // count(days_to_resolve) AS BIGINT) AS avg_whole_days_to_resolve,
       CAST(sum(is_overdue) AS BIGINT) AS overdue_count
FROM fact_support_tickets JOIN dim_employees USING (employee_id)
GROUP BY employee_full_name, job_title
ORDER BY avg_days_to_resolve NULLS FIRST, employee_full_name, job_title"""),
)
def bi_agent_performance(spark, folder):
    layers = Layers(spark, folder)
    result = reports.agent_performance(layers["fact_support_tickets"], layers["dim_employees"])
    return result.withColumn("avg_days_to_resolve", F.round("avg_days_to_resolve", 6))


@query(
    "bi_inventory_alerts",
    with_tables("""
SELECT warehouse_location, product_name, product_category, stock_on_hand, reorder_level,
       stock_vs_reorder
FROM fact_inventory WHERE below_reorder = 1 ORDER BY stock_vs_reorder, inventory_id"""),
)
def bi_inventory_alerts(spark, folder):
    return reports.inventory_alerts(Layers(spark, folder)["fact_inventory"])


@query(
    "bi_vendor_spend",
    with_tables("""
SELECT v.vendor_name, v.vendor_country, v.vendor_region, count(*) AS total_orders,
       round(sum(total_cost), 2) AS total_spend, round(avg(unit_cost), 2) AS avg_unit_cost
FROM fact_purchase_orders AS p JOIN dim_vendors AS v ON p.vendor_id = v.vendor_id
GROUP BY ALL ORDER BY total_spend DESC NULLS LAST, v.vendor_name, v.vendor_country, v.vendor_region"""),
)
def bi_vendor_spend(spark, folder):
    layers = Layers(spark, folder).shared("erp_vnd_z90")
    result = reports.vendor_spend(layers["fact_purchase_orders"], layers["dim_vendors"])
    return result.withColumns(
        {c: F.round(c, 2) for c in ("total_spend", "avg_unit_cost")}
    )


@query(
    "bi_channel_budget",
    with_tables("""
SELECT channel, count(*) AS num_campaigns, round(sum(budget), 2) AS total_budget,
       round(avg(campaign_duration_days), 6) AS avg_duration_days,
       CAST(sum(campaign_duration_days) // count(campaign_duration_days) AS BIGINT)
           AS avg_whole_duration_days
FROM dim_campaigns WHERE flag_invalid_date_range = 0
GROUP BY channel ORDER BY total_budget DESC NULLS LAST, channel"""),
)
def bi_channel_budget(spark, folder):
    result = reports.channel_budget(Layers(spark, folder)["dim_campaigns"])
    return result.withColumns(
        {
            "total_budget": F.round("total_budget", 2),
            "avg_duration_days": F.round("avg_duration_days", 6),
        }
    )


@query(
    "bi_order_rollup",
    with_tables("""
SELECT order_number, count(*) AS order_lines, CAST(sum(quantity) AS BIGINT) AS total_quantity,
       CAST(sum(sales_amount) AS BIGINT) AS total_amount, min(order_date) AS order_date,
       max(shipping_date) AS last_shipping_date
FROM fact_sales GROUP BY order_number"""),
)
def bi_order_rollup(spark, folder):
    return reports.order_rollup(Layers(spark, folder).numbered()["fact_sales"])
