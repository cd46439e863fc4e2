import base64
import hashlib

import pytest
from oracle import both

from tessera.llm import warc_store as w

ROWS = [(1, "http://a", "same ü"), (2, "http://b", "same ü"), (3, None, None), (None, "http://n", "same ü"), (4, "x\r\ny", ""), (5, "http://c", "own\r\n\r\nlines"), (5, "http://c", "own\r\n\r\nlines"), (6, "http://d", "z" * 200_000)]


def test_query_against_sql(spark):
    got, want = both(spark, w.op10_warc_archive, w.ORACLE_SQL["op10_warc_archive"])
    assert got == want and got


def test_round_trip(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    w.write_archive(df, f"file://{tmp_path}/a")
    back = w.reconstruct(spark, f"file://{tmp_path}/a").collect()
    assert sorted(((r.page_id or 0, bytes(r.payload).decode()) for r in back)) == sorted((p or 0, h or "") for p, _, h in ROWS)
    kinds = {(r.page_id, r.record_type, r.refers_to) for r in back}
    assert kinds == {(1, "revisit", 2), (2, "response", None), (None, "revisit", 2), (3, "revisit", 4), (4, "response", None), (5, "response", None), (6, "response", None)}
    for r in back:
        assert r.sha1 == base64.b32encode(hashlib.sha1(bytes(r.payload)).digest()).decode() and r.payload_bytes == len(r.payload)
    assert spark.read.parquet(f"file://{tmp_path}/a/payloads").count() == 4
    w.write_warc(spark, f"file://{tmp_path}/a", f"file://{tmp_path}/files")
    files = w.read_warc(spark, f"file://{tmp_path}/files").collect()
    assert sorted(r.header for r in files) == sorted(r.header for r in back)
    assert {bytes(r.payload).decode() for r in files} == {h or "" for _, _, h in ROWS}


def test_small_payloads_are_all_responses_and_empty_table(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    w.write_archive(df, f"file://{tmp_path}/b", min_bytes=8)
    kinds = {(r.page_id, r.record_type) for r in w.read_records(spark, f"file://{tmp_path}/b").collect()}
    assert {(1, "response"), (2, "response"), (3, "response"), (4, "response")} <= kinds
    w.write_archive(df.limit(0), f"file://{tmp_path}/c")
    assert w.read_records(spark, f"file://{tmp_path}/c").count() == 0


def test_a_changed_payload_is_noticed(spark, tmp_path):
    w.write_archive(spark.createDataFrame(ROWS, "page_id long, url string, html string"), f"file://{tmp_path}/d")
    bad = spark.read.parquet(f"file://{tmp_path}/d/payloads").selectExpr("digest", "cast('other' as binary) payload")
    bad.write.parquet(f"file://{tmp_path}/e/payloads")
    with pytest.raises(Exception, match="differs"):
        w.verified_payloads(spark, f"file://{tmp_path}/e").collect()
