"""Versioned tables: what readers see of loads that succeed, fail, collide and expire."""

import glob

import pytest
from pyspark.sql import functions as F

from tierloom.plans.refresh import cleanse_all, land, read_cleansed, read_landed
from tierloom.sources.landing import LANDING_FILES
from tierloom.sources.tables import BATCH, load_all, read_loads, record_loads, write_gated
from tierloom.sources.versions import (
    HELD_BACK, OUTCOME, PASSED, PublishConflict, current, expire, publish, read_version, recorded_counts, versions,
)


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def failing(spark, n):
    return spark.range(n).withColumn("id", F.when(F.col("id") == n - 1, F.raise_error(F.lit("lost half way"))).otherwise(F.col("id")))


def test_a_load_that_ends_half_way_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(spark.range(4), path)
    with pytest.raises(Exception, match="lost half way"):
        publish(failing(spark, 1000), path)
    assert len(glob.glob(path + "/data/*")) == 2  # what the failed load wrote is there, and nobody sees it
    assert ids(read_version(spark, path)) == [0, 1, 2, 3] and current(spark, path).number == 1
    assert publish(spark.range(2), path).number == 2
    assert ids(read_version(spark, path)) == [0, 1]


def test_readers_stay_with_their_version(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(spark.range(3), path)
    pinned = read_version(spark, path)
    publish(spark.range(5), path, ["id"])
    assert ids(pinned) == [0, 1, 2] and ids(read_version(spark, path)) == [0, 1, 2, 3, 4]
    assert ids(read_version(spark, path, 1)) == [0, 1, 2]
    with pytest.raises(FileNotFoundError):
        read_version(spark, path, 7)
    with pytest.raises(FileNotFoundError):
        read_version(spark, str(tmp_path / "none"))


def test_a_manifest_that_is_not_whole_is_passed_over(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(spark.range(3), path)
    (tmp_path / "t" / "_manifests" / f"{2:020d}.json").write_text('{"number": 2, "fol')
    assert ids(read_version(spark, path)) == [0, 1, 2]
    assert publish(spark.range(1), path).number == 3 and ids(read_version(spark, path)) == [0]


def test_one_of_two_colliding_loads_publishes(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(spark.range(1), path)

    def publishing(batches):
        """While this load runs, another one publishes."""
        with open(f"{path}/_manifests/{1:020d}.json") as file:
            first = file.read()
        with open(f"{path}/_manifests/{2:020d}.json", "w") as file:
            file.write(first.replace('"number": 1', '"number": 2').replace('"rows": 1', '"rows": 9'))
        yield from batches

    late = spark.range(3).mapInArrow(publishing, "id long")
    with pytest.raises(PublishConflict):
        publish(late, path)
    assert current(spark, path).number == 2 and current(spark, path).rows == 9


def test_old_versions_expire(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(1, 5):
        publish(spark.range(n), path)
    with pytest.raises(Exception, match="lost"):
        publish(failing(spark, 50), path)
    assert expire(spark, path, keep=2) == [1, 2]
    assert [v.rows for v in versions(spark, path)] == [3, 4] and len(glob.glob(path + "/data/*")) == 3  # a load may be writing the third
    assert expire(spark, path, keep=1, grace=-1) == [3]
    assert len(glob.glob(path + "/data/*")) == 1 and ids(read_version(spark, path)) == [0, 1, 2, 3]
    with pytest.raises(ValueError):
        expire(spark, path, keep=0)


def test_partitions_and_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(spark.range(6).select((F.col("id") % 2).alias("p"), "id", F.lit("x").alias("more")), path, ["p", "id"], ["p"])
    rows = read_version(spark, path)
    assert rows.columns == ["id", "p"] and rows.where("p = 1").count() == 3
    assert len(glob.glob(path + "/data/*/p=1")) == 1


def test_a_gate_with_two_outcomes_reads_its_input_once(spark, tmp_path):
    path, calls = str(tmp_path / "t"), spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            calls.add(batch.num_rows)
            yield batch

    rows = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "id long, name string").mapInArrow(seen, "id long, name string")
    version = write_gated(rows, ["id"], path)
    assert calls.value == 3 and version.rows == 3 and version.outcomes == {PASSED: 2, HELD_BACK: 1}
    assert ids(read_version(spark, path, outcome=PASSED)) == [1, 3]
    assert [tuple(r) for r in read_version(spark, path, outcome=HELD_BACK).collect()] == [(None, "b")]
    assert read_version(spark, path).columns == ["id", "name", OUTCOME]
    empty = write_gated(rows.limit(0), ["id"], path)
    assert empty.outcomes == {PASSED: 0, HELD_BACK: 0} and read_version(spark, path, outcome=PASSED).count() == 0


def test_rows_without_an_outcome_fail_the_load(spark, tmp_path):
    with pytest.raises(Exception, match="no outcome"):
        publish(spark.range(3), str(tmp_path / "t"), outcomes={"low": F.col("id") < 2})


def test_counts_come_from_manifests(spark, tmp_path, plan_of):
    paths = {n: str(tmp_path / n) for n in ("a", "b")}
    publish(spark.range(5), paths["a"])
    publish(spark.range(0), paths["b"])
    publish(spark.range(7), paths["b"])
    counts = recorded_counts(spark, paths, "gold.")
    assert sorted(tuple(r) for r in counts.collect()) == [("gold.a", 5, 1), ("gold.b", 7, 2)]
    assert "parquet" not in plan_of(counts).lower()


def test_loads_are_recorded(spark, tmp_path):
    log = str(tmp_path / "loads")
    for n in (3, 4):
        record_loads(spark, load_all({"t": lambda n=n: publish(spark.range(n), str(tmp_path / "t")).rows}), log)
    loads = read_loads(spark, log)
    assert sorted((r.table, r.rows) for r in loads.collect()) == [(BATCH, 3), (BATCH, 4), ("t", 3), ("t", 4)]
    assert loads.select("batch").distinct().count() == 2 and loads.where("ended IS NULL OR seconds < 0").isEmpty()


def test_refresh_holds_back_lines_and_rows(spark, tmp_path):
    vendors = tmp_path / "extracts" / LANDING_FILES["erp_vnd_z90"]
    vendors.parent.mkdir(parents=True)
    vendors.write_text("id,name,country\nV1,Acme,India\n,Nameless,India\nV2,Too,Many,Fields\n")
    landed, cleansed = str(tmp_path / "landed"), str(tmp_path / "cleansed")
    loads = land(spark, str(tmp_path / "extracts"), landed, {"erp_vnd_z90": LANDING_FILES["erp_vnd_z90"]}, log=str(tmp_path / "loads"))
    assert [(x.table, x.rows) for x in loads] == [("erp_vnd_z90", 2)] and read_loads(spark, str(tmp_path / "loads")).count() == 2
    assert [r["_rejected_line"] for r in read_landed(spark, landed, "erp_vnd_z90", rejected=True).collect()] == ["V2,Too,Many,Fields"]
    for name, file in LANDING_FILES.items():
        if name != "erp_vnd_z90":
            path = tmp_path / "extracts" / file
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_text("header\n")
    land(spark, str(tmp_path / "extracts"), landed)
    with pytest.raises(Exception, match="NULL in required column vnd_id"):
        cleanse_all(spark, landed, cleansed, "2024-06-30")
    cleanse_all(spark, landed, cleansed, "2024-06-30", hold_back=True)
    assert [r.vnd_id for r in read_cleansed(spark, cleansed, "erp_vnd_z90").collect()] == ["V1"]
    assert [r.vnd_name for r in read_cleansed(spark, cleansed, "erp_vnd_z90", held_back=True).collect()] == ["Nameless"]
