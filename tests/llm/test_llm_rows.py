"""Archives, sharding and mixing by their contracts."""

import base64
import hashlib
import io
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tierloom.llm import mixing, sharding, warc
from tierloom.session import new_table_path


def base32(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def page_rows():
    rng = random.Random(2)
    texts = ["".join(rng.choices("ab<é>", k=rng.choice([0, 5, 300, 5000]))) for _ in range(60)]
    rows = [(i, f"http://x/{i}", t) for i, t in enumerate(texts)]
    rows += [(100 + i, None, "copy") for i in range(30)] + [(200, "u", None), (201, "line\r\nend", ""), (202, "g", "\x1f\x8b\x08WARC/1.1"), (203, "l", "x" * 300_000)]
    return rows


@pytest.mark.parametrize("split", [warc.SPLIT, 700])
def test_archives_and_back(spark, monkeypatch, split):
    monkeypatch.setattr(warc, "SPLIT", split)
    monkeypatch.setattr(warc, "ARCHIVE", 4000)
    rows = page_rows()
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4).selectExpr("*", "1 AS sha1", "2 AS payload")
    got = {r.page_id: r for r in warc.archived(df).collect()}
    assert len(got) == len(rows)
    least = {}
    for id_, _, html in rows:
        least[html or ""] = min(id_, least.get(html or "", id_))
    for id_, url, html in rows:
        data, r = (html or "").encode(), got[id_]
        first = least[html or ""]
        assert (r.payload_bytes, r.payload_digest) == (len(data), base32(data))
        assert (r.record_type, r.refers_to) == (("response", None) if id_ == first else ("revisit", first))
        assert r.payload == (data if id_ == first else None)
        assert r.url == (None if url is None else url.replace("\r\n", " "))


def test_archives_of_short_payloads_null_ids_and_none(spark):
    schema = "page_id long, url string, html string"
    rows = [(1, "a", "long enough"), (2, "a", "long enough"), (3, "a", "s"), (4, "a", "s"), (None, "a", "long enough"), (None, "a", "other"), (1, "a", "long enough")]
    folder = new_table_path(spark, "warc")
    warc.write_archives(spark.createDataFrame(rows, schema), folder, least_bytes=3).collect()
    got = Counter((r.page_id, r.record_type, r.refers_to) for r in warc.read_archives(spark, "file://" + folder).collect())
    assert got == Counter([(1, "response", None), (1, "response", None), (2, "revisit", 1), (None, "revisit", 1), (3, "response", None), (4, "response", None), (None, "response", None)])
    assert warc.archived(spark.createDataFrame([], schema)).collect() == []


def test_ranges_own_the_records_that_begin_in_them():
    members = [warc.record(i, None, bytes(random.Random(i).randbytes(i * 50)), None, False) for i in range(30)]
    data = b"".join(members)
    starts = np.cumsum([0, *map(len, members)])
    for width in (1, 97, 1000, len(data)):
        found = []
        for begin in range(0, len(data), width):
            source = pa.PythonFile(io.BytesIO(data), mode="r")
            found += [(begin, warc.parsed(m)[0]) for m in warc.records_in(source, begin, min(begin + width, len(data)), len(data))]
        assert [i for _, i in found] == list(range(30))
        assert all(begin <= starts[i] < begin + width for begin, i in found)


def test_a_cut_archive_and_a_wrong_digest_are_errors():
    member = warc.record(1, "u", b"payload" * 100, None, False)
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.records_in(pa.PythonFile(io.BytesIO(member[:-20]), mode="r"), 0, len(member) - 20, len(member) - 20))
    text = zlib.decompress(member, 31).replace(b"payload", b"pAyload", 1)
    with pytest.raises(ValueError, match="differ"):
        warc.parsed(text)


def shard_rows(n=500):
    rng = random.Random(3)
    return [(i if i % 9 else None, rng.choice(["", None, "t", "word " * rng.randrange(300)]), i) for i in range(n)]


@pytest.mark.parametrize("shards", [1, 7, 8])
def test_shards_are_even_gapless_and_whole(spark, shards):
    df = spark.createDataFrame(shard_rows(), "doc_id long, text string, shard int").selectExpr("*", "'x' AS slot", "1 AS bucket", "2 AS `a.b`").repartition(5)
    got = sharding.sharded(df, shards, bucket_bytes=3000).collect()
    assert Counter(r["row"]["shard"] for r in got) == Counter(range(500))
    counts = Counter(r["shard"] for r in got)
    assert set(counts) == set(range(shards)) and max(counts.values()) - min(counts.values()) <= 1
    for s in range(shards):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(counts[s]))
    assert got[0]["row"].asDict().keys() == {"doc_id", "text", "shard", "slot", "bucket", "a.b"}
    again = sharding.sharded(df, shards, bucket_bytes=3000).collect()
    where = lambda rows: {r["row"]["shard"]: (r["shard"], r["slot"]) for r in rows}
    assert where(got) == where(again)


def test_shards_are_shuffled(spark):
    df = spark.range(2000).selectExpr("id AS doc_id", "'t' AS text")
    order = [r["row"]["doc_id"] for r in sorted(sharding.sharded(df, 4, bucket_bytes=8000).collect(), key=lambda r: (r["shard"], r["slot"]))]
    assert abs(np.corrcoef(order, range(2000))[0, 1]) < 0.1
    near = sum(abs(a - b) == 1 for a, b in zip(order, order[1:]))
    assert near < 20


def test_no_rows_to_shard_repeated_rows_and_native_plan(spark, plan_of):
    schema = "doc_id long, text string"
    assert sharding.sharded(spark.createDataFrame([], schema), 8).collect() == []
    got = sharding.sharded(spark.createDataFrame([(1, "same")] * 30, schema), 8).collect()
    assert max(Counter(r["shard"] for r in got).values()) == 4


def test_rows_that_repeat_id_and_text_are_dealt_over_all_shards(spark):
    rows = [(None, None, i) for i in range(500)] + [(7, "same", 0)] * 500 + [(i, "t", i) for i in range(1000, 3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n long").repartition(5)
    got = sharding.sharded(df, 8, bucket_bytes=8000).collect()
    assert Counter(tuple(r["row"]) for r in got) == Counter(rows)
    for id_ in (None, 7):
        counts = Counter(r["shard"] for r in got if r["row"]["doc_id"] == id_)
        assert all(30 < counts[s] < 100 for s in range(8))  # 62.5 each
    where = lambda found: Counter((r["shard"], r["slot"], *r["row"]) for r in found)
    assert where(got) == where(sharding.sharded(df, 8, bucket_bytes=8000).collect())


def test_all_columns_count_for_the_size_of_a_row(spark):
    df = spark.createDataFrame([(1, None, "x" * 500, ["y" * 300])], "doc_id long, text string, html string, parts array<string>")
    assert 864 <= df.select(sharding.row_bytes(df)).first()[0] < 920


def by_hand(sizes, weights, share=Fraction(3, 2), most=2):
    """Targets by dealing out in exact numbers."""
    out, left, open_ = {}, share * sum(sizes), [i for i, s in enumerate(sizes) if s]
    while open_:
        parts = {i: left * weights[i] / sum(weights[k] for k in open_) for i in open_}
        over = [i for i in open_ if parts[i] > most * sizes[i]]
        if not over:
            out.update(parts)
            break
        for i in over:
            out[i] = Fraction(most * sizes[i])
            left -= out[i]
        open_ = [i for i in open_ if i not in over]
    return [float(out.get(i, 0)) for i in range(len(sizes))]


def test_targets():
    for sizes in ([5, 10, 100], [1000, 1, 1, 0], [7], [], [0, 0], [10] * 9):
        weights = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
        assert mixing.targets(sizes, weights) == pytest.approx(by_hand(sizes, weights))
        assert sum(mixing.targets(sizes, weights)) == pytest.approx(1.5 * sum(sizes))


def test_the_splitting_tree_is_exact():
    units = np.array([1000, 3, 0, 512, 7])
    for shards in (1, 3, 8):
        quotas = mixing.split(units, shards, 1)
        assert quotas.sum(axis=1).tolist() == units.tolist()
        assert np.ptp(quotas.sum(axis=0)) <= shards.bit_length()
    means = np.mean([mixing.split(units, 4, seed)[0] for seed in range(200)], axis=0)
    assert means == pytest.approx([250] * 4, abs=5)


def test_mix_of_sources(spark):
    rng = random.Random(8)
    rows = []
    for i in range(3000):
        source = rng.choice(["b", "b", "b", "b", "a", "c", None, "Z"])
        rows.append((i, " ".join(["w"] * rng.choice([0, 1, 5, 30])) if i % 50 else None, source, i))
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size long").selectExpr("*", "1 AS place", "2 AS of").repartition(4)
    plan = mixing.planned(df).collect()
    assert len(plan) == len(rows)
    size_of = {i: len((t or "").split()) for i, t, _, _ in rows}
    names = ["Z", "a", "b", "c", None]
    sizes = [sum(size_of[i] for i, _, s, _ in rows if s == n) for n in names]
    target = dict(zip(names, by_hand(sizes, [3, 1, 2, 3, 1])))
    taken = Counter()
    for r in plan:
        source = rows[r.doc_id][2]
        assert (r.size, r.source_size) == (size_of[r.doc_id], sizes[names.index(source)])
        assert r.target == pytest.approx(target[source])
        assert r.taken == r.size * r.copies and 0 <= r.copies <= 2 and len(r.shards) == r.copies
        taken[source] += r.taken
    for name in names:
        assert taken[name] == pytest.approx(target[name], abs=31)
    assert sorted(map(str, plan)) == sorted(map(str, mixing.planned(df.repartition(2)).collect()))
    mix = mixing.mixed(df).collect()
    assert Counter(r["row"]["size"] for r in mix) == Counter({r.doc_id: r.copies for r in plan})
    of = {(r.doc_id, k): s for r in plan for k, s in enumerate(r.shards)}
    assert all(of[r["row"]["doc_id"], r["copy"]] == r["shard"] for r in mix)
    assert set(r["shard"] for r in mix) == set(range(8))


def test_mix_of_few_rows_and_none(spark):
    schema = "doc_id long, text string, source string"
    assert mixing.planned(spark.createDataFrame([], schema)).collect() == []
    assert mixing.mixed(spark.createDataFrame([], schema)).collect() == []
    got = mixing.planned(spark.createDataFrame([(1, None, None), (None, "a b", "s"), (2, "a b", "s"), (2, "a b", "s")], schema)).collect()
    assert sorted((r.doc_id or 0, r.size, r.source_size, r.target) for r in got) == [(0, 2, 6, 9.0), (1, 0, 0, 0.0), (2, 2, 6, 9.0), (2, 2, 6, 9.0)]


def test_a_pass_ends_among_repeated_rows(spark):
    rows = [(i, "w " * 5, "s") for i in range(200)] + [(None, "w " * 5, "s")] * 100
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    for share in (1.1, 1.3, 1.5, 1.7, 1.9):
        plan = mixing.planned(df, share=share).collect()
        assert len(plan) == 300
        assert sum(r.taken for r in plan) == pytest.approx(plan[0].target, abs=2.5)
    again = Counter(r.copies for r in plan if r.doc_id is None)
    assert set(again) == {1, 2} and sum(again.values()) == 100
    assert len({s for r in plan if r.doc_id is None for s in r.shards}) == 8
    mix = mixing.mixed(df, share=1.9).collect()
    assert Counter((r["shard"], r["row"]["doc_id"]) for r in mix) == Counter((s, r.doc_id) for r in plan for s in r.shards)


def test_more_copies_than_three(spark):
    rows = [(i, "w " * 5, "ab"[i % 10 == 0]) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mixing.planned(df, most=5.0, share=1.9, weights=(1, 1)).collect()
    assert max(r.copies for r in plan) == 5 and all(len(r.shards) == r.copies for r in plan)
    mix = Counter(r["row"]["doc_id"] for r in mixing.mixed(df, most=5.0, share=1.9, weights=(1, 1)).collect())
    assert mix == Counter({r.doc_id: r.copies for r in plan if r.copies})


def test_gathered_buckets_are_not_shuffled_again(spark, plan_of):
    rows = spark.range(40).select((F.col("id") % 4).cast("int").alias("bucket"), F.col("id").alias("place"), F.struct("id").alias("row"))
    offsets = rows.groupBy("bucket").agg(F.count("*").alias("offset"))
    dealt = rows.repartitionById(4, F.col("bucket")).sortWithinPartitions("bucket", "place")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with offsets whose size is not known when the join is planned
    try:
        placed = sharding._placed(dealt, offsets, 7)
        assert "SortMergeJoin" not in plan_of(placed) and "BroadcastHashJoin" in plan_of(placed)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert sorted((r.offset, r.at) for r in placed.collect()) == [(10, at) for at in range(10) for _ in range(4)]
