"""Extracts as files: reading, typing, storing."""

import os
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tierloom.session import CHECKPOINT_SETTING, drop_stored, new_table_path, shared_folder
from tierloom.sources.landing import (
    FILE_ORDER,
    LANDING_FILES,
    LANDING_SCHEMAS,
    REJECTED,
    read_landing,
    split_rejected,
)
from tierloom.sources.tables import (
    AUDIT_COLUMN,
    REQUIRED_COLUMNS,
    assert_required,
    load_all,
    not_null_gate,
    row_counts,
    run_report,
    with_audit,
    write_refresh,
    write_table,
)


def write(path, lines, end="\r\n", last=""):
    path.write_bytes((end.join(lines) + last).encode("utf-8"))
    return str(path)


def test_every_extract_has_a_schema_and_a_file():
    assert len(LANDING_SCHEMAS) == 12 and set(LANDING_SCHEMAS) == set(LANDING_FILES)
    assert all(f.nullable for schema in LANDING_SCHEMAS.values() for f in schema)
    for name, required in REQUIRED_COLUMNS.items():
        assert set(required) <= set(LANDING_SCHEMAS[name].names)


@pytest.mark.parametrize("end", ["\r\n", "\n", "\r"])
def test_typed_rows_by_position(spark, tmp_path, end):
    path = write(
        tmp_path / "p.csv",
        ["ID,KEY,NAME,COST,LINE,FROM,TO", "1,AC-HE-X,Helm é,,R ,2003-07-01,", '2,BI-X,"quoted",7,,2011-07-01,2007-12-28'],
        end,
    )
    rows, rejected = split_rejected(read_landing(spark, path, LANDING_SCHEMAS["crm_prd_info"]))
    assert rejected.collect() == []
    assert [tuple(r) for r in rows.orderBy("prd_id").collect()] == [
        (1, "AC-HE-X", "Helm é", None, "R ", datetime(2003, 7, 1), None),
        (2, "BI-X", '"quoted"', 7, None, datetime(2011, 7, 1), datetime(2007, 12, 28)),
    ]
    assert rows.schema == LANDING_SCHEMAS["crm_prd_info"]


def test_lines_that_do_not_fit_are_put_aside(spark, tmp_path):
    path = write(tmp_path / "v.csv", ["id,name,country", "V1,Acme,India", "V2,Too,Many,Fields", "V3,Short"])
    rows = read_landing(spark, path, LANDING_SCHEMAS["erp_vnd_z90"])
    fitting, rejected = split_rejected(rows)
    assert [r.vnd_id for r in fitting.collect()] == ["V1"]
    assert sorted(r[REJECTED] for r in rejected.select("vnd_id", REJECTED).collect()) == [
        "V2,Too,Many,Fields", "V3,Short",
    ]


def test_file_order(spark, tmp_path):
    path = write(tmp_path / "v.csv", ["id,name,country", *(f"V{9 - i},n,c" for i in range(9))])
    rows = read_landing(spark, path, LANDING_SCHEMAS["erp_vnd_z90"], file_order=True)
    stored = new_table_path(spark, "order")
    rows.write.parquet(stored)
    ordered = spark.read.parquet(stored).repartition(3).orderBy(FILE_ORDER)
    assert [r.vnd_id for r in ordered.collect()] == [f"V{9 - i}" for i in range(9)]


def test_refresh_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(7).select("id", F.lit("x").alias("extra"))
    assert write_refresh(df, path, ["id"]) == 7
    assert write_refresh(df.filter("id < 3"), path, ["id"]) == 3
    assert spark.read.parquet(path).columns == ["id"] and spark.read.parquet(path).count() == 3


def test_refresh_by_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    write_refresh(spark.range(6).select("id", (F.col("id") % 2).alias("p")), path, partition_by=["p"])
    assert sorted(x.name for x in (tmp_path / "t").glob("p=*")) == ["p=0", "p=1"]


def test_catalog_table_is_replaced(spark, tmp_path):
    for n in (5, 3):
        write_table(spark.range(n), "plain", path=str(tmp_path / "plain"))
    assert spark.table("plain").count() == 3
    spark.sql("DROP TABLE plain")


def test_audit_time(spark):
    stamped = with_audit(spark.range(1), datetime(2024, 1, 2, 3))
    assert stamped.first()[AUDIT_COLUMN] == datetime(2024, 1, 2, 3)
    assert dict(with_audit(spark.range(1)).dtypes)[AUDIT_COLUMN] == "timestamp"


def test_required_columns(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "id int, name string")
    passed, held = not_null_gate(df, ["id", "name"])
    assert [r.id for r in passed.collect()] == [1] and held.count() == 2
    assert assert_required(df.filter("id = 1"), ["id", "name"]).count() == 1
    with pytest.raises(Exception, match="NULL in required column id"):
        assert_required(df, ["id"]).collect()


def test_load_report(spark, tmp_path):
    loads = load_all(
        {name: lambda n=name: write_refresh(spark.range(len(n)), str(tmp_path / n)) for name in ("ab", "abc")}
    )
    report = {r.table: r for r in run_report(spark, loads).collect()}
    assert (report["ab"].rows, report["abc"].rows, report["(batch)"].rows) == (2, 3, 5)
    assert all(r.seconds > 0 for r in report.values())


def test_a_batch_takes_as_long_as_its_longest_load(spark):
    def nap():
        time.sleep(0.5)
        return 1

    loads = load_all({name: nap for name in "abcd"})
    assert 0.5 <= loads.seconds < 1.2 and sum(x.seconds for x in loads) >= 2


def test_a_load_starts_when_the_one_it_needs_is_done(spark):
    done = []

    def load(name, seconds=0.0):
        time.sleep(seconds)
        done.append(name)
        return 1

    jobs = {"needs slow": lambda: load("needs slow"), "slow": lambda: load("slow", 0.3), "needs quick": lambda: load("needs quick"), "quick": lambda: load("quick")}
    load_all(jobs, after={"needs slow": "slow", "needs quick": "quick"})
    assert done == ["quick", "needs quick", "slow", "needs slow"]
    jobs["quick"] = lambda: 1 / 0
    with pytest.raises(ZeroDivisionError):
        load_all({k: jobs[k] for k in ("quick", "needs quick")}, after={"needs quick": "quick"})


def test_stored_tables_can_be_dropped(spark):
    path = new_table_path(spark, "gone")
    spark.range(3).write.parquet(path)
    assert os.path.isdir(path)
    assert drop_stored(spark) >= 1 and drop_stored(spark) == 0
    assert not os.path.exists(path)


def test_failed_load_is_raised(spark):
    def fail():
        raise ValueError("no such extract")

    with pytest.raises(ValueError, match="no such extract"):
        load_all({"a": fail})


def test_row_counts(spark):
    counted = row_counts({"b": spark.range(2), "a": spark.range(0)})
    assert [tuple(r) for r in counted.collect()] == [("a", 0), ("b", 2)]
    assert row_counts({"a": spark.range(1)}, "gold.").first().table_name == "gold.a"


def test_shared_folder_is_the_one_the_session_names(spark):
    class Named:
        class conf:
            @staticmethod
            def get(key, default=None):
                return {CHECKPOINT_SETTING: "hdfs://x/y/", "spark.master": "yarn"}.get(key, default)

    class Unnamed:
        class conf:
            @staticmethod
            def get(key, default=None):
                return {"spark.master": "yarn"}.get(key, default)

    assert shared_folder(Named) == "hdfs://x/y"
    with pytest.raises(RuntimeError):
        shared_folder(Unnamed)
    assert new_table_path(spark, "t") != new_table_path(spark, "t")
