from pathlib import Path

from tessera.llm import warc_store as w


def test_no_scratch_of_the_writing_is_left_when_reading_begins(spark, tmp_path, monkeypatch):
    made, whole = [], w.materialise
    monkeypatch.setattr(w, "materialise", lambda df, name: made.append(whole(df, name)) or made[-1])
    freed = []
    monkeypatch.setattr(w, "release", lambda s: freed.append([f for t in made for f in t.inputFiles() if Path(f.removeprefix("file://").removeprefix("file:")).exists()]))
    w.write_archive(spark.range(50).selectExpr("id page_id", "'u' url", "concat('p', id div 2) html"), f"file://{tmp_path}/a")
    assert made and freed == [[]]
    assert w.reconstruct(spark, f"file://{tmp_path}/a").count() == 50
