"""Deduplication, versions, references and keys: results, invariants, and what the plans look like."""

import random
from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierloom.operators.dedup import first_per_key, latest_per_key
from tierloom.operators.history import _ended_in_ranges, active_version, validity_intervals, validity_intervals_by_range
from tierloom.operators.keys import surrogate_key
from tierloom.operators.references import exclude_orphans, flag_missing_ref, resolve

DAY = timedelta(days=1)
RELAXED = settings(
    max_examples=12, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# --- one row per key


def test_latest_row_wins_and_null_loses(spark):
    df = spark.createDataFrame(
        [
            (1, date(2018, 7, 11), "old"), (1, date(2024, 4, 4), "new"), (1, None, "undated"),
            (2, None, "only"), (None, date(2020, 1, 1), "no key"),
            (3, date(2020, 1, 1), "b"), (3, date(2020, 1, 1), "a"),
        ],
        "id int, day date, name string",
    )
    assert rows(latest_per_key(df, ["id"], "day")) == sorted(
        [
            (1, date(2024, 4, 4), "new"), (2, None, "only"), (None, date(2020, 1, 1), "no key"),
            (3, date(2020, 1, 1), "a"),
        ],
        key=repr,
    )


def test_first_row_does_not_depend_on_partitioning(spark):
    df = spark.createDataFrame(
        [("V1", "Zeta", "India"), ("V1", "Acme", "Japan"), ("V2", "Solo", None)],
        "id string, name string, country string",
    )
    expected = [("V1", "Acme", "Japan"), ("V2", "Solo", None)]
    for parts in (1, 2, 3):
        assert rows(first_per_key(df.repartition(parts), ["id"])) == expected
    assert rows(first_per_key(df, ["id"], ["country"]))[0] == ("V1", "Zeta", "India")


@RELAXED
@given(
    st.lists(
        st.tuples(st.integers(0, 4), st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 99)),
        min_size=1, max_size=40,
    )
)
def test_latest_against_brute_force(spark, values):
    df = spark.createDataFrame(values, "k int, v int, t int")
    best = {}
    for k, v, t in values:
        order = (v is None, -(v or 0), t)
        if k not in best or order < best[k][0]:
            best[k] = (order, (k, v, t))
    once = latest_per_key(df, ["k"], "v")
    assert rows(once) == sorted((row for _, row in best.values()), key=repr)
    assert rows(latest_per_key(once, ["k"], "v")) == rows(once)


def test_hot_key_is_cut_down_before_the_shuffle(spark, plan_of):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = plan_of(latest_per_key(df, ["k"], "id"))
    before_exchange = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in before_exchange and "Partial" in before_exchange


# --- versions


def expected_intervals(values):
    """Ends by looking at each key's rows in order."""
    ends = {}
    for key in {k for k, _, _ in values}:
        versions = sorted((s, t) for k, s, t in values if k == key)
        for (start, tie), following in zip(versions, [*versions[1:], None]):
            ends[(key, start, tie)] = following and following[0].date() - DAY
    return ends


def check_intervals(spark, values):
    df = spark.createDataFrame(values, "k string, s timestamp_ntz, t int")
    got = {(r.k, r.s, r.t): r.valid_to for r in validity_intervals(df, ["k"], "s", ["t"]).collect()}
    assert got == expected_intervals(values)


def test_versions_follow_each_other(spark):
    starts = [datetime(2011, 7, 1), datetime(2012, 7, 1), datetime(2013, 7, 1)]
    df = spark.createDataFrame([("A", s, i) for i, s in enumerate(starts)], "k string, s timestamp_ntz, t int")
    ended = validity_intervals(df, ["k"], "s", ["t"])
    assert [r.valid_to for r in ended.orderBy("s").collect()] == [
        date(2012, 6, 30), date(2013, 6, 30), None,
    ]
    assert [r.t for r in active_version(ended).collect()] == [2]


@RELAXED
@given(
    st.lists(
        st.tuples(
            st.sampled_from("AB"),
            st.builds(lambda day, hour: datetime(2020, 1, day, hour), st.integers(1, 6), st.integers(0, 2)),
            st.integers(0, 30),
        ),
        min_size=1, max_size=30, unique=True,
    )
)
def test_intervals_against_brute_force(spark, values):
    check_intervals(spark, values)


def test_intervals_of_a_hot_key_by_shuffled_join(spark, no_broadcast, plan_of):
    numbers = random.Random(7)
    values = [
        ("hot" if i % 3 else f"k{i % 50}", datetime(2020, 1, 1) + timedelta(hours=numbers.randrange(9000)), i)
        for i in range(3000)
    ]
    check_intervals(spark, values)
    df = spark.createDataFrame(values, "k string, s timestamp_ntz, t int")
    plan = plan_of(validity_intervals(df, ["k"], "s", ["t"]))
    window = plan[plan.index("Window [lead") :]
    # what reaches the window is one row per key and day, reduced before any shuffle
    assert window.count("Aggregate(key=[k") + window.count("Aggregate(keys=[k") == 2
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.fixture
def many_ranges(spark):
    """Ranges as many as set, however small, and batches of a few rows."""
    settings_ = {
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "13",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "7",
    }
    before = {name: spark.conf.get(name) for name in settings_}
    for name, value in settings_.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_intervals_by_range_against_brute_force(spark, many_ranges, plan_of):
    numbers = random.Random(11)
    values = [
        ("hot" if i % 3 else f"k{i % 50}", datetime(2020, 1, 1) + timedelta(hours=numbers.randrange(9000)), i)
        for i in range(1500)
    ]
    df = spark.createDataFrame(values, "k string, s timestamp_ntz, t int")
    got = {(r.k, r.s, r.t): r.valid_to for r in validity_intervals_by_range(df, ["k"], "s", ["t"]).collect()}
    assert got == expected_intervals(values)

    ranges = _ended_in_ranges(df, ["k"], "s", ["t"], "valid_to")
    plan = plan_of(ranges)
    assert plan.count("Exchange") == plan.count("rangepartitioning") == 1 and plan.count("Scan") == 1
    assert ranges.filter("k = 'hot'").select("_vi_range").distinct().count() >= 8


@RELAXED
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["A", "B", None]),
            st.sampled_from([1, None]),
            st.one_of(st.none(), st.builds(lambda day, hour: datetime(2020, 1, day, hour), st.integers(1, 6), st.integers(0, 2))),
            st.integers(0, 30),
        ),
        max_size=30, unique=True,
    )
)
def test_intervals_by_range_are_those_of_the_join(spark, many_ranges, values):
    df = spark.createDataFrame(values, "`k.1` string, j int, s timestamp_ntz, t int")
    plain = df.toDF("k", "j", "s", "t")
    assert rows(validity_intervals_by_range(df, ["k.1", "j"], "s", ["t"])) == rows(validity_intervals(plain, ["k", "j"], "s", ["t"]))


def test_intervals_by_range_refuse_what_they_cannot_hold(spark):
    df = spark.createDataFrame([(1.5, date(2020, 1, 1), 1)], "k double, s date, t int")
    with pytest.raises(TypeError):
        validity_intervals_by_range(df, ["k"], "s", ["t"])
    with pytest.raises(ValueError):
        validity_intervals_by_range(df, ["t"], "s", ["t"], end="k")


def test_every_key_has_one_open_version_and_no_overlap(spark):
    df = spark.range(2000).select(
        (F.col("id") % 40).alias("k"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 37).cast("int")).alias("s"),
        F.col("id").alias("t"),
    )
    ended = validity_intervals(df, ["k"], "s", ["t"]).cache()
    assert ended.count() == 2000
    assert active_version(ended).groupBy("k").count().filter("count <> 1").count() == 0
    overlaps = ended.alias("a").join(ended.alias("b"), "k").filter(
        "b.s > a.s and b.s <= a.valid_to"
    )
    assert overlaps.count() == 0


# --- references


@pytest.fixture
def orders(spark):
    return spark.createDataFrame([(1, "V1"), (2, None), (3, "V9"), (4, "V1")], "id int, vendor string")


@pytest.fixture
def vendors(spark):
    return spark.createDataFrame([("V1",), ("V2",), (None,), ("V1",)], "v string")


def test_orphans_leave(orders, vendors):
    assert rows(exclude_orphans(orders, "vendor", vendors, "v")) == [(1, "V1"), (4, "V1")]


def test_missing_references_are_flagged_and_rows_kept(orders, vendors):
    flagged = flag_missing_ref(orders, "vendor", vendors, "v", "missing")
    assert rows(flagged) == [(1, "V1", 0), (2, None, 1), (3, "V9", 1), (4, "V1", 0)]


def test_missing_references_are_not_found_by_comparing_all_pairs(orders, vendors, no_broadcast, plan_of):
    plan = plan_of(flag_missing_ref(orders, "vendor", vendors, "v", "missing"))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_fact_keeps_its_rows(spark, orders):
    vendor = spark.createDataFrame([("V1", "Acme")], "vendor_id string, name string")
    resolved = resolve(orders, "vendor", vendor, "vendor_id").select("id", "name")
    assert rows(resolved) == [(1, "Acme"), (2, None), (3, None), (4, "Acme")]


def test_hot_foreign_key_is_split(spark, no_broadcast):
    """A third of the rows on one key and a third on NULL: both partitions are read by several tasks."""
    settings_ = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    for key, value in settings_.items():
        spark.conf.set(key, value)
    try:
        fact = spark.range(0, 60000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.lit(7))
            .when(F.col("id") % 3 == 1, F.col("id") % 1000)
            .alias("fk"),
            F.concat(F.lit("row "), F.col("id").cast("string")).alias("name"),
        )
        dimension = spark.range(1000).select(F.col("id").alias("key"), F.lit("x").alias("label"))
        joined = resolve(fact, "fk", dimension, "key")
        collected = joined.groupBy().agg(F.count("*").alias("n"), F.count("label").alias("m"))
        assert collected.first() == (60000, 40000)
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings_:
            spark.conf.unset(key)


# --- surrogate keys


def test_keys_equal_a_global_row_number(spark, plan_of):
    numbers = random.Random(3)
    # a third of the rows share one leading value
    values = [
        (None if i % 11 == 0 else date(2020, 1, 1) + DAY * (0 if i % 3 == 0 else numbers.randrange(90)), i)
        for i in range(5000)
    ]
    numbers.shuffle(values)
    df = spark.createDataFrame(values, "day date, id int").repartition(5)
    keyed = surrogate_key(df, ["day", "id"], "key")
    ordered = sorted(values, key=lambda r: (r[0] is not None, r[0] or date.min, r[1]))
    expected = [(i, *row) for i, row in enumerate(ordered, start=1)]
    assert [tuple(r) for r in keyed.orderBy("key").collect()] == expected
    assert dict(keyed.dtypes)["key"] == "bigint"
    plan = plan_of(keyed)
    # the offsets, a row for each partition, are summed up and joined; the rows stay where they are
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert all("day" not in line for line in plan.splitlines() if "Exchange" in line or "Window" in line)
    # asked again, and for one column only, every row still has the same key
    assert keyed.select("id", "key").orderBy("key").first()["id"] == expected[0][2]


def test_keys_of_nothing(spark):
    df = spark.createDataFrame([], "id int, name string")
    keyed = surrogate_key(df, ["id"], "key")
    assert keyed.columns == ["key", "id", "name"] and keyed.count() == 0


def test_keys_can_be_stored_where_wanted(spark, tmp_path):
    target = str(tmp_path / "dim")
    keyed = surrogate_key(spark.range(10), ["id"], "key", target)
    assert keyed.count() == 10 and list((tmp_path / "dim").glob("*.parquet"))
