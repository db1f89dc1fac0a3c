"""Labels and ids of any type, archives of several attempts, records of other writers, buckets and maps."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from tierloom.llm import embedding_dedup, sharding, warc


def test_labels_are_compared_as_they_are(spark):
    rows = [(1, [1.0, 0.0], 1.2), (2, [1.0, 0.0], 1.7), (3, [2.0, 0.0], 1.2), (4, [1.0, 0.0], None)]
    found = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.similar_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label double")).collect()}
    assert found == {1: (1, 1), 2: (0, 2), 3: (1, 1), 4: (0, 4)}
    texts = [(f"id {i}", v, {1.2: "blue", 1.7: "blue "}.get(label)) for i, v, label in rows]
    found = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.similar_vectors(spark.createDataFrame(texts, "vec_id string, embedding array<double>, label string")).collect()}
    assert found == {"id 1": (1, "id 1"), "id 2": (0, "id 2"), "id 3": (1, "id 1"), "id 4": (0, "id 4")}


def test_files_of_a_lost_attempt_are_not_read(spark, tmp_path):
    folder = "file://" + str(tmp_path / "warc")
    pages = spark.createDataFrame([(i, f"u{i}", f"page {i % 3}") for i in range(30)], "page_id long, url string, html string")
    written = warc.write_archives(pages, folder).collect()
    assert sum(r.records for r in written) == 30
    first = next(tmp_path.glob("warc/*.warc.gz"))
    part, attempt, number = first.name.removesuffix(".warc.gz").removeprefix("part-").split("-")
    (tmp_path / "warc" / f"part-{part}-{int(attempt) + 99}-{number}.warc.gz").write_bytes(first.read_bytes())  # a second attempt's
    files = spark.createDataFrame(written)
    assert warc.read_archives(spark, folder, files).count() == 30 < warc.read_archives(spark, folder).count()
    assert sorted(r.page_id for r in warc.archived(pages, str(tmp_path / "again")).collect()) == list(range(30))


def member(kind, block, **fields):
    head = "".join(f"{k.replace('_', '-')}: {v}\r\n" for k, v in {"warc_type": kind, "Content_Length": len(block), **fields}.items())
    return gzip.compress(b"WARC/1.0\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n")


def test_records_of_other_writers(spark, tmp_path):
    response = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n<p>hi</p>"
    members = [
        member("warcinfo", b"software: x\r\n"), member("request", b"GET / HTTP/1.1\r\n\r\n", WARC_Target_URI="http://a"),
        member("response", response, warc_target_uri="http://a"), member("response", response, WARC_PAYLOAD_DIGEST="sha1:" + warc.digest(b"<p>hi</p>")),
        member("revisit", b"HTTP/1.1 200 OK\r\n\r\n"), member("metadata", b""), member("response", response, WARC_Payload_Digest="md5:00"),
    ]
    (tmp_path / "other.warc.gz").write_bytes(b"".join(members))
    rows = warc.read_archives(spark, "file://" + str(tmp_path)).collect()
    assert sorted(r.record_type for r in rows) == ["metadata", "request", "response", "response", "response", "revisit", "warcinfo"]
    assert {bytes(r.payload) for r in rows if r.record_type == "response"} == {b"<p>hi</p>"}
    assert {r.payload_digest for r in rows if r.record_type == "response"} == {warc.digest(b"<p>hi</p>")}
    assert [bytes(r.payload) for r in rows if r.record_type == "warcinfo"] == [b"software: x\r\n"]
    assert [r.url for r in rows if r.record_type == "request"] == ["http://a"] and all(r.page_id is None for r in rows)
    with pytest.raises(ValueError, match="differ"):
        warc.parsed(gzip.decompress(member("response", response, WARC_Payload_Digest="sha1:" + "A" * 32)))


def test_a_task_has_one_bucket(spark, plan_of, monkeypatch):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 20).alias("text"))
    seen = []
    plain = type(docs).repartitionById
    monkeypatch.setattr(type(docs), "repartitionById", lambda self, n, c: seen.append((n, plain(self, n, c))) or seen[-1][1])
    assert sharding.sharded(docs, 4, bucket_bytes=8000).count() == 3000
    n, dealt = seen[0]
    held = dealt.select("bucket", F.spark_partition_id().alias("task")).distinct().groupBy("task").agg(F.count("*").alias("buckets"))
    assert n > 50 and held.count() == n and held.where("buckets > 1").isEmpty()


def test_rows_with_maps_are_sharded(spark):
    docs = spark.range(200).select(
        (F.col("id") % 50).alias("doc_id"), F.lit("t").alias("text"), F.create_map(F.lit("k"), F.col("id")).alias("m"), F.array(F.create_map(F.lit(1), F.lit("v"))).alias("a"),
    )
    for bucket_bytes in (1 << 20, 500):
        rows = sharding.sharded(docs, 3, bucket_bytes=bucket_bytes).select("shard", "slot", F.col("row.m")["k"].alias("k")).collect()
        assert sorted(r.k for r in rows) == list(range(200))
        assert sorted(r.slot for r in rows if r.shard == 0) == list(range(67))


def test_no_temporary_archives_remain(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", None)], "page_id long, url string, html string")
    assert warc.archived(pages, str(tmp_path / "w")).count() == 1
    assert all(name.endswith((".warc.gz", ".crc")) for name in os.listdir(tmp_path / "w"))
