"""Storing tables, and what is recorded about it."""

from __future__ import annotations

import datetime
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import partial, reduce
from multiprocessing.pool import ThreadPool
from threading import Event

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from tierloom.sources.versions import HELD_BACK, PASSED, Version, publish

AUDIT_COLUMN = "dwh_create_date"
#: The line of a batch in reports of its loads, and the columns of the table of loads.
BATCH = "(batch)"
LOADS = "batch string, table string, rows bigint, seconds double, ended timestamp"

# Columns a cleansed table must not have NULLs in.
REQUIRED_COLUMNS: dict[str, tuple[str, ...]] = {
    "crm_cust_info": ("cst_id",),
    "crm_prd_info": ("prd_id",),
    "crm_sales_details": ("sls_ord_num",),
    "crm_camp_info": ("cmp_id",),
    "crm_supp_tkts": ("tkt_id",),
    "erp_loc_a101": ("cid",),
    "erp_cust_az12": ("cid",),
    "erp_inv_q4v1": ("inv_id", "inv_prd_id"),
    "erp_vnd_z90": ("vnd_id",),
    "erp_po_ord44": ("po_number",),
    "erp_hr_hx19": ("emp_id",),
}


@dataclass(frozen=True)
class Load:
    """What one table load did."""

    table: str
    rows: int
    seconds: float


class Batch(list[Load]):
    """Loads that ran together, and the seconds from the first one's start to the last one's end."""

    def __init__(self, loads: Sequence[Load], seconds: float):
        super().__init__(loads)
        self.seconds = seconds


def with_audit(df: DataFrame, as_of: datetime.datetime | None = None) -> DataFrame:
    """Add the load time; ``as_of`` fixes it, otherwise it is the time of the query."""
    stamp = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return df.withColumn(AUDIT_COLUMN, stamp)


def complete(required: Sequence[str]) -> Column:
    """Whether a row has all required columns."""
    return reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in required), F.lit(True))


def not_null_gate(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with all required columns, and the rows held back because one of them is NULL. Storing both reads ``df`` twice;
    :func:`write_gated` stores them in one pass."""
    return df.filter(complete(required)), df.filter(~complete(required))


def write_gated(df: DataFrame, required: Sequence[str], path: str, columns: Sequence[str] | None = None) -> Version:
    """Publish ``df`` in one pass with the rows that lack a required column held back, beside those that passed.

    ``read_version(spark, path, outcome=PASSED)`` is the table; its rows and those held back are in ``outcomes``."""
    whole = complete(required)
    return publish(df, path, columns, outcomes={PASSED: whole, HELD_BACK: ~whole})


def assert_required(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """The same rows, failing the job at the first NULL in a required column (the strict gate)."""
    checked = df
    for name in required:
        message = F.lit(f"NULL in required column {name}")
        present = F.when(F.col(name).isNull(), F.raise_error(message)).otherwise(F.col(name))
        checked = checked.withColumn(name, present.cast(df.schema[name].dataType))
    return checked


def assert_absent(df: DataFrame, name: str) -> DataFrame:
    """The same rows without the column ``name``, failing the job at the first value in it."""
    first = df.columns[0]
    message = F.concat(F.lit(f"value in {name}: "), F.col(name))
    guarded = F.when(F.col(name).isNotNull(), F.raise_error(message)).otherwise(F.col(first)).cast(df.schema[first].dataType)
    return df.withColumn(first, guarded).drop(name)


def _write_counted(
    df: DataFrame, columns: Sequence[str] | None, write: Callable[[DataFrameWriter], None]
) -> int:
    """Replace a table by ``df``. Rows are counted while they are written, at no extra pass."""
    rows = Observation()
    chosen = df.select(*columns) if columns else df
    write(chosen.observe(rows, F.count(F.lit(1)).alias("rows")).write.mode("overwrite"))
    return rows.get["rows"]


def write_refresh(
    df: DataFrame, path: str, columns: Sequence[str] | None = None, partition_by: Sequence[str] = ()
) -> int:
    """Replace the files at ``path`` by ``df`` and return the number of rows.

    Running it again gives the same files. ``columns`` fixes which columns are stored and in which order. The old files go
    before the new ones are whole: for a table that others read, use :func:`tierloom.sources.versions.publish`.
    """
    return _write_counted(df, columns, lambda w: w.partitionBy(*partition_by).parquet(path))


def write_table(
    df: DataFrame, name: str, columns: Sequence[str] | None = None, path: str | None = None
) -> int:
    """Replace the catalog table ``name`` by ``df`` and return its number of rows. ``path`` makes it an
    external table there."""

    def write(writer: DataFrameWriter) -> None:
        located = writer.option("path", path) if path else writer
        located.format("parquet").saveAsTable(name)

    return _write_counted(df, columns, write)


def side_by_side(jobs: Sequence[Callable], parallel: int = 8) -> list:
    """Results of independent jobs run from driver threads; the first failure is raised.

    Spark shares the executors between them, so that small jobs do not wait for the stragglers of big
    ones.
    """
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPool(max(1, min(parallel, len(jobs)))) as pool:
        return pool.map(inherit(lambda job: job()), jobs, chunksize=1)


def load_all(
    jobs: Mapping[str, Callable[[], int]], parallel: int = 8, after: Mapping[str, str] | None = None
) -> Batch:
    """Run loads side by side, each of which stores one table and returns its row count.

    ``after`` names, for a load, the one whose table it needs; it starts as soon as that one is done, and
    fails with it.
    """
    after = after or {}
    # those that are waited for come first, so that no thread waits for a load that has none
    order = sorted(jobs, key=lambda table: table in after)
    done = {table: Event() for table in jobs}
    failed: set[str] = set()

    def timed(table: str) -> Load:
        try:
            if table in after:
                done[after[table]].wait()
                if after[table] in failed:
                    raise RuntimeError(f"{table} needs {after[table]}, which failed")
            began = time.perf_counter()
            rows = jobs[table]()
            return Load(table, rows, time.perf_counter() - began)
        except BaseException:
            failed.add(table)
            raise
        finally:
            done[table].set()

    began = time.perf_counter()
    loads = side_by_side([partial(timed, table) for table in order], parallel)
    return Batch(loads, time.perf_counter() - began)


def run_report(spark: SparkSession, loads: Batch) -> DataFrame:
    """Table, rows and seconds of each load; under ``(batch)`` all rows, and how long the whole took. Loads run
    side by side, so the batch takes less than its loads together."""
    lines = [(load.table, load.rows, load.seconds) for load in loads]
    lines.append((BATCH, sum(x.rows for x in loads), loads.seconds))
    return spark.createDataFrame(lines, "table string, rows bigint, seconds double")


def record_loads(spark: SparkSession, loads: Batch, path: str) -> Batch:
    """Append the loads of a batch to the table of loads at ``path``: ``batch, table, rows, seconds, ended``; see :func:`read_loads`."""
    batch, ended = uuid.uuid4().hex, datetime.datetime.now(datetime.UTC)
    lines = [(batch, load.table, load.rows, load.seconds, ended) for load in loads]
    lines.append((batch, BATCH, sum(x.rows for x in loads), loads.seconds, ended))
    spark.createDataFrame(lines, LOADS).coalesce(1).write.mode("append").parquet(path)
    return loads


def read_loads(spark: SparkSession, path: str) -> DataFrame:
    """Every load ever recorded at ``path``; a line named ``(batch)`` for each batch as a whole."""
    return spark.read.schema(LOADS).parquet(path)


def row_counts(tables: Mapping[str, DataFrame], prefix: str = "") -> DataFrame:
    """Rows per table, by table name; ``prefix`` names the layer."""
    counts = (
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(prefix + name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    )
    return reduce(DataFrame.unionByName, counts).orderBy("table_name")
