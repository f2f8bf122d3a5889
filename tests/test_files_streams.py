import json

from conftest import rows
from pyspark.sql import functions as F

from pagegrain.sources import files
from pagegrain.streaming import events


def test_files(spark, tmp_path):
    for i in (1, 2, 10):
        (d := tmp_path / "ocr" / "doc").mkdir(parents=True, exist_ok=True)
        (d / f"page_{i}.json").write_text(json.dumps({"pdf_page_num": i, "OCR_text_clusters": [{"text": "x", "cluster_number": 0}]}))
    assert [r.page_number for r in files.page_folder(spark, str(tmp_path / "ocr")).collect()] == [1, 2, 10]
    t = tmp_path / "texts"
    t.mkdir()
    (t / "a.txt").write_text("one\ntwo"), (t / "b.MD").write_text("# h"), (t / "c.csv").write_text("x")
    assert rows(files.whole_texts(spark, str(t)).select("document_id", "source_format")) == [("a", "text"), ("b", "markdown"), ("c", "text")]
    found = files.discover(spark, str(t), [".TXT", ".md"])
    assert [r.name for r in found.collect()] == ["a.txt", "b.MD"]
    f = files.filter_files(files.discover(spark, str(t)), pattern=r"\.(txt|MD)$", most=1)
    assert rows(files.reject_reasons(f)) == [("over the maximum", 1), ("pattern", 1)]
    assert rows(files.folders_by_count(files.discover(spark, str(tmp_path)), 2, 4).select("n_files")) == [(3,), (3,)]
    paths = spark.createDataFrame([("r/a/x/1",), ("r/b/y/2",), ("s/1",), ("s/b/2",)], "path string")
    assert rows(files.uniform_folders(paths, 2)) == [("r",)]
    files.append_json(spark.range(2), str(tmp_path / "log"))
    files.append_json(spark.range(1), str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).count() == 3


EV = [(1, "2024-02-01T00:10:00+00:00", "r1", "llm_end", 5), (2, "2024-02-01T00:20:00+00:00", "r1", "llm_end", 7), (3, "2024-02-01T01:20:00+00:00", "r2", "llm_error", None)]


def stream(spark, tmp_path):
    d = spark.createDataFrame(EV, "id long, ts_iso string, run_id string, event_name string, token_count int")
    for c, k in (("document_id", "string"), ("parent_run_id", "string"), ("model_name", "string"), ("filename", "string"), ("line_number", "int"), ("cost_usd", "double"), ("n_try", "double"), ("metadata_json", "string")):
        d = d.withColumn(c, F.lit(None).cast(k))
    d.write.mode("append").parquet(str(tmp_path / "in"))
    return events.event_stream(spark, str(tmp_path / "in"))


def test_streams(spark, tmp_path):
    s = stream(spark, tmp_path)
    assert rows(events.drain(events.usage_counts(s), "uc", str(tmp_path / "c1"))) == [("llm_end", 2, 12), ("llm_error", 1, None)]
    w = events.drain(events.windowed_usage(s), "wu", str(tmp_path / "c2"))
    assert rows(w.select("event_name", "n_events")) == [("llm_end", 2), ("llm_error", 1)]
    q = events.append_sink(s.select("id"), str(tmp_path / "out"), str(tmp_path / "c3"))
    q.processAllAvailable(), q.stop()
    stream(spark, tmp_path)  # three more rows: the checkpoint goes on behind the first three
    q = events.append_sink(s.select("id"), str(tmp_path / "out"), str(tmp_path / "c3"))
    q.processAllAvailable(), q.stop()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 6
