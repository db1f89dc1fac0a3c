"""Star schema: five dimensions and four facts over the cleansed tables.

Everything but the surrogate keys is lazy. Build a dimension once and pass it to every fact that needs
it; the two with surrogate keys are stored tables after that, so facts read only the columns they use.
Time-dependent columns are measured at ``as_of`` (default: today).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierloom.functions import dates, flags, labels, numbers, text
from tierloom.functions import fixed_values as fixed
from tierloom.operators.history import active_version
from tierloom.operators.keys import surrogate_key
from tierloom.operators.references import resolve

col = F.col


def conform_customers(
    customers: DataFrame, demographics: DataFrame, locations: DataFrame
) -> DataFrame:
    """Customers of both source systems in one row each, without a surrogate key. The gender of the
    customer master wins unless it is not available there."""
    person = demographics.select(col("cid").alias("_person_id"), "bdate", "gen")
    place = locations.select(col("cid").alias("_place_id"), "cntry")
    joined = resolve(resolve(customers, "cst_key", person, "_person_id"), "cst_key", place, "_place_id")
    return joined.select(
        col("cst_id").alias("customer_id"),
        col("cst_key").alias("customer_number"),
        col("cst_firstname").alias("first_name"),
        col("cst_lastname").alias("last_name"),
        col("cntry").alias("country"),
        col("cst_marital_status").alias("marital_status"),
        labels.prefer(col("cst_gndr"), col("gen"), fixed.NOT_AVAILABLE).alias("gender"),
        col("cst_create_date").alias("create_date"),
        col("bdate").alias("birth_date"),
    )


def dim_customers(
    customers: DataFrame, demographics: DataFrame, locations: DataFrame, path: str | None = None
) -> DataFrame:
    """One row per customer, numbered by customer id."""
    conformed = conform_customers(customers, demographics, locations)
    return surrogate_key(conformed, ["customer_id"], "customer_key", path)


def categorize_products(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Active product versions with their category, without a surrogate key."""
    active = active_version(products, "prd_end_dt")
    return resolve(active, "cat_id", categories, "id").select(
        col("prd_id").alias("product_id"),
        col("prd_key").alias("product_number"),
        col("prd_nm").alias("product_name"),
        col("cat_id").alias("category_id"),
        col("cat").alias("category"),
        col("subcat").alias("subcategory"),
        "maintenance",
        col("prd_cost").alias("cost"),
        col("prd_line").alias("product_line"),
        col("prd_start_dt").alias("start_date"),
    )


def dim_products(products: DataFrame, categories: DataFrame, path: str | None = None) -> DataFrame:
    """One row per active product, numbered by start date and product id."""
    categorized = categorize_products(products, categories)
    return surrogate_key(categorized, ["start_date", "product_id"], "product_key", path)


def dim_employees(employees: DataFrame, as_of=None) -> DataFrame:
    """One row per employee, under the employee's own id."""
    years = dates.years_crossed(col("emp_hire_date"), dates.as_of_date(as_of))
    return employees.select(
        col("emp_id").alias("employee_id"),
        col("emp_first_name").alias("employee_first_name"),
        col("emp_last_name").alias("employee_last_name"),
        col("emp_full_name").alias("employee_full_name"),
        col("emp_role").alias("job_title"),
        col("emp_branch_id").alias("branch_id"),
        col("emp_hire_date").alias("hire_date"),
        years.alias("years_of_service"),
        labels.band(years, fixed.SENIORITY_CUTS, fixed.SENIORITY_LABELS).alias("seniority_band"),
    )


def dim_vendors(vendors: DataFrame) -> DataFrame:
    """One row per vendor, under the vendor's own id."""
    return vendors.select(
        col("vnd_id").alias("vendor_id"),
        col("vnd_name").alias("vendor_name"),
        col("vnd_country").alias("vendor_country"),
        labels.group_label(col("vnd_country"), fixed.VENDOR_REGION, fixed.OTHER).alias(
            "vendor_region"
        ),
    )


def dim_campaigns(campaigns: DataFrame) -> DataFrame:
    """One row per campaign, those with an inverted date range included."""
    return campaigns.select(
        col("cmp_id").alias("campaign_id"),
        col("cmp_name").alias("campaign_name"),
        col("cmp_channel").alias("channel"),
        col("cmp_budget").alias("budget"),
        col("cmp_start_date").alias("start_date"),
        col("cmp_end_date").alias("end_date"),
        dates.days_between(col("cmp_start_date"), col("cmp_end_date")).alias(
            "campaign_duration_days"
        ),
        F.year("cmp_start_date").alias("campaign_year"),
        "flag_invalid_date_range",
    )


def fact_sales(sales: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per order line, with the surrogate keys of product and customer (dimensions)."""
    product = products.select("product_key", "product_number")
    customer = customers.select("customer_key", "customer_id")
    joined = resolve(
        resolve(sales, "sls_prd_key", product, "product_number"),
        "sls_cst_id",
        customer,
        "customer_id",
    )
    return joined.select(
        col("sls_ord_num").alias("order_number"),
        "product_key",
        "customer_key",
        col("sls_order_dt").alias("order_date"),
        col("sls_ship_dt").alias("shipping_date"),
        col("sls_due_dt").alias("due_date"),
        col("sls_sales").alias("sales_amount"),
        col("sls_quantity").alias("quantity"),
        col("sls_price").alias("price"),
    )


def fact_support_tickets(
    tickets: DataFrame, customers: DataFrame, employees: DataFrame, products: DataFrame, as_of=None
) -> DataFrame:
    """One row per ticket with customer, agent and product (dimensions). Open tickets age to
    ``as_of``. A ticket without a customer has the name ``' '``; ``product_key`` is the natural key."""
    customer = customers.select(
        "customer_id", "customer_number", "first_name", "last_name", "country"
    )
    agent = employees.select("employee_id", "employee_full_name", "job_title", "branch_id")
    product = products.select("product_number", "product_name", "category", "subcategory")
    joined = resolve(tickets, "tkt_cst_id", customer, "customer_id")
    joined = resolve(joined, "tkt_emp_id", agent, "employee_id")
    joined = resolve(joined, "tkt_prd_key", product, "product_number")
    opened = col("tkt_open_date")
    return joined.select(
        col("tkt_id").alias("id"),
        opened.alias("open_date"),
        col("tkt_resolution_date").alias("resolution_date"),
        dates.days_open(opened, col("tkt_resolution_date"), as_of).alias("days_to_resolve"),
        flags.flag_overdue(col("tkt_status"), opened, as_of, fixed.OVERDUE_AFTER_DAYS).alias(
            "is_overdue"
        ),
        col("tkt_issue_cat").alias("issue_category"),
        col("tkt_status").alias("status"),
        "customer_id",
        "customer_number",
        text.full_name(col("first_name"), col("last_name")).alias("customer_full_name"),
        col("country").alias("customer_country"),
        "employee_id",
        col("employee_full_name").alias("assigned_agent"),
        col("job_title").alias("agent_role"),
        col("branch_id").alias("agent_branch"),
        col("product_number").alias("product_key"),
        "product_name",
        col("category").alias("product_category"),
        col("subcategory").alias("product_subcategory"),
    )


def fact_inventory(inventory: DataFrame, products: DataFrame) -> DataFrame:
    """One row per inventory snapshot with its product (dimension) and what the stock is worth."""
    product = products.select(
        "product_id", "product_number", "product_name", "category", "subcategory", "cost"
    )
    stock = col("inv_stock_on_hand")
    return resolve(inventory, "inv_prd_id", product, "product_id").select(
        col("inv_id").alias("inventory_id"),
        col("inv_snap_date").alias("snapshot_date"),
        col("inv_wh_loc").alias("warehouse_location"),
        "product_id",
        col("product_number").alias("product_key"),
        "product_name",
        col("category").alias("product_category"),
        col("subcategory").alias("product_subcategory"),
        stock.alias("stock_on_hand"),
        col("inv_reorder_level").alias("reorder_level"),
        "below_reorder",
        numbers.stock_gap(stock, col("inv_reorder_level")).alias("stock_vs_reorder"),
        numbers.stock_value(stock, col("cost")).alias("estimated_stock_value"),
    )


def fact_purchase_orders(orders: DataFrame, vendors: DataFrame, products: DataFrame) -> DataFrame:
    """One row per purchase order with its vendor and product (dimensions)."""
    product = products.select("product_id", "product_name", "category")
    joined = resolve(
        resolve(orders, "po_vnd_id", vendors, "vendor_id"), "po_prd_id", product, "product_id"
    )
    return joined.select(
        "po_number",
        col("po_order_date").alias("order_date"),
        F.year("po_order_date").alias("order_year"),
        F.month("po_order_date").alias("order_month"),
        "vendor_id",
        "vendor_name",
        "vendor_country",
        "vendor_region",
        "product_id",
        "product_name",
        col("category").alias("product_category"),
        col("po_quantity_ordered").alias("quantity_ordered"),
        col("po_unit_cost").alias("unit_cost"),
        "total_cost",
        "flag_missing_vendor",
    )
