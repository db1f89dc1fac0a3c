"""Business reports over the star schema.

Facts are aggregated by the dimension's key before they meet the dimension, so the join handles one
row per key and a hot key is combined inside each task. Every ordering ends in columns that tell rows
apart, which makes the output stable and keeps a common value from filling one sort range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierloom.functions.numbers import whole_quotient

col = F.col


def top_customers(sales: DataFrame, customers: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` customers with the greatest sales; ties by customer key, which follows customer id.

    ``sales`` must carry keys of this very dimension. The winners are found on keys alone, so what meets
    the dimension is ``n`` rows. A customer with a missing name part has no name.
    """
    winners = (
        sales.filter(col("customer_key").isNotNull())
        .groupBy("customer_key")
        .agg(F.sum("sales_amount").alias("total_sales"))
        .orderBy(col("total_sales").desc_nulls_last(), "customer_key")
        .limit(n)
    )
    names = customers.select("customer_key", "customer_id", "first_name", "last_name")
    return (
        names.join(winners, "customer_key")
        .select(
            "customer_id",
            F.concat("first_name", F.lit(" "), "last_name").alias("customer_name"),
            "total_sales",
        )
        .orderBy(col("total_sales").desc_nulls_last(), "customer_id")
        .limit(n)
    )


def agent_performance(tickets: DataFrame, employees: DataFrame) -> DataFrame:
    """Tickets, days to resolve and overdue tickets per agent name and title; tickets without a known
    agent are left out. The average is given exactly and, as whole-number averages of the source
    dialect are, cut to whole days."""
    by_agent = tickets.groupBy("employee_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("days_to_resolve").alias("measured"),
        F.sum("days_to_resolve").alias("days"),
        F.sum("is_overdue").alias("overdue"),
    )
    agents = employees.select("employee_id", "employee_full_name", "job_title")
    totals = (
        by_agent.join(agents, "employee_id")
        .groupBy("employee_full_name", "job_title")
        .agg(
            F.sum("n").alias("total_tickets"),
            F.sum("days").alias("days"),
            F.sum("measured").alias("measured"),
            F.sum("overdue").alias("overdue_count"),
        )
    )
    return totals.select(
        "employee_full_name",
        "job_title",
        "total_tickets",
        F.try_divide(col("days"), col("measured")).alias("avg_days_to_resolve"),
        whole_quotient(col("days"), col("measured")).alias("avg_whole_days_to_resolve"),
        "overdue_count",
    ).orderBy("avg_days_to_resolve", "employee_full_name", "job_title")


def inventory_alerts(inventory: DataFrame) -> DataFrame:
    """Stock below its reorder level, the greatest gap first."""
    columns = [
        "warehouse_location",
        "product_name",
        "product_category",
        "stock_on_hand",
        "reorder_level",
        "stock_vs_reorder",
    ]
    below = inventory.filter(col("below_reorder") == 1)
    ordered = below.orderBy("stock_vs_reorder", "inventory_id")
    return ordered.select(*columns)


def vendor_spend(orders: DataFrame, vendors: DataFrame) -> DataFrame:
    """Orders, spend and average unit cost per vendor name, country and region; orders without a known
    vendor are left out."""
    by_vendor = orders.groupBy("vendor_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("total_cost").alias("spend"),
        F.sum("unit_cost").alias("cost_sum"),
        F.count("unit_cost").alias("costed"),
    )
    names = ["vendor_name", "vendor_country", "vendor_region"]
    totals = (
        by_vendor.join(vendors.select("vendor_id", *names), "vendor_id")
        .groupBy(*names)
        .agg(
            F.sum("n").alias("total_orders"),
            F.sum("spend").alias("total_spend"),
            F.try_divide(F.sum("cost_sum"), F.sum("costed")).alias("avg_unit_cost"),
        )
    )
    return totals.orderBy(col("total_spend").desc_nulls_last(), *names)


def channel_budget(campaigns: DataFrame) -> DataFrame:
    """Campaigns, budget and average duration per channel, inverted date ranges left out."""
    days = col("campaign_duration_days")
    return (
        campaigns.filter(col("flag_invalid_date_range") == 0)
        .groupBy("channel")
        .agg(
            F.count(F.lit(1)).alias("num_campaigns"),
            F.sum("budget").alias("total_budget"),
            F.avg(days).alias("avg_duration_days"),
            whole_quotient(F.sum(days), F.count(days)).alias("avg_whole_duration_days"),
        )
        .orderBy(col("total_budget").desc_nulls_last(), "channel")
    )


def order_rollup(sales: DataFrame) -> DataFrame:
    """One row per order: its lines, quantity, amount and dates."""
    return sales.groupBy("order_number").agg(
        F.count(F.lit(1)).alias("order_lines"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("sales_amount").alias("total_amount"),
        F.min("order_date").alias("order_date"),
        F.max("shipping_date").alias("last_shipping_date"),
    )
