"""Sentences of the caller's own."""

from tessera.llm.licenses import license_scan


def test_own_sentences_need_no_known_word(spark):
    df = spark.createDataFrame([(1, "Hello.\nTake this\nas you like. Bye."), (2, "other"), (3, None), (4, "")], "doc_id long, text string")
    got = {r.doc_id: r.licenses for r in license_scan(df, sentences={"take": "take this as you like"}, rules=[("Own", ["take"])]).collect()}
    assert got == {1: "Own", 2: "", 3: "", 4: ""}
