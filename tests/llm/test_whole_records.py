from tessera.llm import toxicity
from tessera.llm import warc_store as w
from tessera.llm.rows import labelled_sample


def test_op10_rebuilds_every_record(spark, monkeypatch):
    whole, seen = w.reconstruct, []
    monkeypatch.setattr(w, "reconstruct", lambda *a: seen.append(a) or whole(*a))
    got = w.op10_warc_archive(spark, "/root/testdata/sf0.001")
    assert len(seen) == 1 and got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    n = {r.page_id: len((r.html or "").encode()) for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    assert {r.page_id: r.payload_bytes for r in got.collect()} == n


def test_toxicity_fits_on_all_of_3500_labelled_documents(spark):
    labels = spark.range(3500).selectExpr("id doc_id", "0 toxic")
    sample = labelled_sample(labels, "toxic", "doc_id", toxicity.PER_CLASS)
    assert sample.count() == 3500 and {r.weight for r in sample.select("weight").distinct().collect()} == {1.0}
