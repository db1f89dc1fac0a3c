"""Typed landing of delimited extracts.

Files have a header whose names do not matter: columns are taken by position into a fixed schema in
which everything may be NULL. Nothing is inferred, so no pass over the data is spent on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REJECTED = "_rejected_line"
FILE_ORDER = "_file_order"


_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _schema(columns: str) -> T.StructType:
    """``name type`` pairs as a schema; built by hand, as the DDL parser needs a running session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Columns of the twelve extracts, in file order.
LANDING_SCHEMAS: dict[str, T.StructType] = {
    "crm_cust_info": _schema(
        "cst_id bigint, cst_key string, cst_firstname string, cst_lastname string, "
        "cst_marital_status string, cst_gnder string, cst_create_date date"
    ),
    "crm_prd_info": _schema(
        "prd_id bigint, prd_key string, prd_nm string, prd_cost int, prd_line string, "
        "prd_start_dt timestamp_ntz, prd_end_dt timestamp_ntz"
    ),
    "crm_sales_details": _schema(
        "sls_ord_num string, sls_prd_key string, sls_cst_id bigint, sls_order_dt int, "
        "sls_ship_dt int, sls_due_dt int, sls_sales int, sls_quantity int, sls_price int"
    ),
    "crm_camp_info": _schema(
        "cmp_id string, cmp_name string, cmp_channel string, cmp_budget string, "
        "cmp_start_date string, cmp_end_date string"
    ),
    "crm_supp_tkts": _schema(
        "tkt_id string, tkt_cst_id string, tkt_prd_key string, tkt_emp_id string, "
        "tkt_issue_cat string, tkt_status string, tkt_open_date string, tkt_resolution_date string"
    ),
    "erp_loc_a101": _schema("cid string, cntry string"),
    "erp_cust_az12": _schema("cid string, bdate date, gen string"),
    "erp_px_cat_g1v2": _schema("id string, cat string, subcat string, maintenance string"),
    "erp_inv_q4v1": _schema(
        "inv_id string, inv_prd_id string, inv_wh_loc string, inv_stock_on_hand string, "
        "inv_reorder_level string, inv_snap_date string"
    ),
    "erp_vnd_z90": _schema("vnd_id string, vnd_name string, vnd_country string"),
    "erp_po_ord44": _schema(
        "po_number string, po_vnd_id string, po_prd_id string, po_quantity_ordered string, "
        "po_unit_cost string, po_order_date string"
    ),
    "erp_hr_hx19": _schema(
        "emp_id string, emp_first_name string, emp_last_name string, emp_role string, "
        "emp_branch_id string, emp_hire_date string"
    ),
}

# Where each extract lies under the folder of extracts.
LANDING_FILES: dict[str, str] = {
    "crm_cust_info": "source_crm/cust_info.csv",
    "crm_prd_info": "source_crm/prd_info.csv",
    "crm_sales_details": "source_crm/sales_details.csv",
    "crm_camp_info": "source_crm/camp_info.csv",
    "crm_supp_tkts": "source_crm/supp_tkts.csv",
    "erp_cust_az12": "source_erp/CUST_AZ12.csv",
    "erp_loc_a101": "source_erp/LOC_A101.csv",
    "erp_px_cat_g1v2": "source_erp/PX_CAT_G1V2.csv",
    "erp_hr_hx19": "source_erp/HR_HX19.csv",
    "erp_vnd_z90": "source_erp/VND_Z90.csv",
    "erp_inv_q4v1": "source_erp/INV_Q4V1.csv",
    "erp_po_ord44": "source_erp/PO_ORD44.csv",
}


def read_landing(
    spark: SparkSession, path: str, schema: T.StructType, file_order: bool = False
) -> DataFrame:
    """Rows of a comma-separated UTF-8 extract: header skipped, no quoting, empty fields NULL.

    Lines with values that do not fit the schema keep the rest of their fields and carry their text
    in ``_rejected_line``, which is NULL for good lines; see :func:`split_rejected`. Line ends may be
    any of LF, CR LF and CR. ``file_order`` adds a position that sorts as the lines do in the files.
    """
    rows = (
        spark.read.schema(T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType())]))
        .option("header", True)
        .option("enforceSchema", True)
        .option("encoding", "UTF-8")
        .option("quote", "")
        .option("columnNameOfCorruptRecord", REJECTED)
        # with pruning, what counts as a misfit would depend on the columns a query selects
        .option("columnPruning", False)
        .csv(path)
    )
    if file_order:
        rows = rows.withColumn(
            FILE_ORDER,
            F.struct(
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("line"),
            ),
        )
    return rows


def split_rejected(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows that fit the schema, without the marker column, and those that do not, with it.

    Store either before asking for less than its rows: Spark refuses to run a query on the files
    themselves that needs no column but the marker, such as a bare count.
    """
    fits = F.col(REJECTED).isNull()
    return rows.filter(fits).drop(REJECTED), rows.filter(~fits)
