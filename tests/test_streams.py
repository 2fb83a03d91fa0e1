import os

import pandas as pd
from pyspark.sql import functions as F

from headerflow.operators import recognise
from headerflow.operators.state import circuit_breaker
from headerflow.sinks import writers
from headerflow.sources import files
from headerflow.streaming.breaker import breaker_stream
from headerflow.streaming.ingest import watch


def fake(files_df):
    """A recogniser that takes each line of a document for a page."""
    lines = files_df.select(F.element_at(F.split("path", "/"), -1).alias("pdf_filename"), F.posexplode(F.split(F.decode("content", "UTF-8"), "\n")).alias("page_idx", "raw_text"))
    return lines.where("page_idx > 0").select(F.lit("job").alias("job_id"), "pdf_filename", "page_idx", F.lit(2.0).alias("scale"), F.lit("m").alias("method"), F.lit(7).alias("psm"), F.lit(1).alias("attempt_no"), "raw_text", F.lit(95.0).alias("confidence"))


def test_watch(spark, tmp_path):
    folder, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    os.makedirs(folder)
    pages = ["B-HK-WFE-S17975643", "B-HK-WFE-S17975643", "B-TW-UEI-S18010794"]
    (tmp_path / "in" / "a.PDF").write_text("%PDF-\n" + "\n".join(pages))
    (tmp_path / "in" / "bad.pdf").write_text("nothing")
    (tmp_path / "in" / "other.txt").write_text("%PDF-")
    watch(spark, folder, out, mark, fake, once=True).awaitTermination()
    got = spark.read.parquet(f"{out}/batch=0").orderBy("start_page").collect()
    assert [(r.pdf_filename, r.start_page, r.end_page, r.header) for r in got] == [("a.PDF", 1, 2, pages[0]), ("a.PDF", 3, 3, pages[2])]
    assert spark.read.parquet(f"{out}-quarantine/batch=0").count() == 1
    # a second run sees new files only
    (tmp_path / "in" / "b.pdf").write_text("%PDF-\n" + pages[0])
    watch(spark, folder, out, mark, fake, once=True).awaitTermination()
    assert spark.read.parquet(f"{out}/batch=1").count() == 1


def test_breaker_stream(spark, tmp_path):
    rows = [(k, i, float(i * 10), i % 3 != 0) for k in (1, 2) for i in range(40)]
    df = spark.createDataFrame(rows, "k long, event_id long, ts double, failed boolean")
    df.repartition(1).sortWithinPartitions("ts").write.parquet(str(tmp_path / "e"))
    q = breaker_stream(spark.readStream.schema(df.schema).parquet(str(tmp_path / "e")), "k").writeStream.format("memory").queryName("said").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(map(tuple, spark.table("said").collect())) == sorted(map(tuple, circuit_breaker(df, "k").collect()))


def test_files(spark, tmp_path):
    (tmp_path / "x.pdf").write_text("%PDF-1")
    (tmp_path / "y.pdf").write_text("junk")
    good, bad = files.ready(files.documents(spark, str(tmp_path)))
    assert (good.count(), bad.count()) == (1, 1)
    (tmp_path / "r.csv").write_text("﻿timestamp,pdf_filename,page_number\n# total,1\n2024-01-01 00:00:00,a.pdf,3\n")
    report = files.report(spark, str(tmp_path / "r.csv"))
    assert [(r.pdf_filename, r.page_number) for r in report.collect()] == [("a.pdf", 3)]


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "deep" / "a.pdf")
    assert writers.write_atomically(path, b"1") == path and open(path, "rb").read() == b"1"
    m = spark.createDataFrame([("a", 0, 1, "x.pdf"), ("a", 2, 2, "y.pdf")], "original string, start_page long, end_page long, file_name string")
    done = writers.write_splits(m, lambda name, a, b: f"{name}{a}{b}".encode(), str(tmp_path / "out")).collect()
    assert sorted(r.bytes for r in done) == [3, 3] and (tmp_path / "out" / "y.pdf").read_text() == "a22"
    records = spark.createDataFrame([(i,) for i in range(8)], "n int").coalesce(1)
    got = writers.post(records, lambda body: False, failures=3).first()
    assert (got.sent, got.failed, got.blocked) == (0, 3, 5)
    text = writers.report_text(records.limit(1), {"total": 1})
    assert text == b"\xef\xbb\xbf# total,1\nn\n0\n"


def test_readers(spark):
    def reader(frames):
        for pdf in frames:
            yield pd.DataFrame({"job_id": "j", "pdf_filename": pdf.path, "page_idx": 0, "width": 10.0, "height": 20.0, "direct_text": "B-HK-WFE-S17975643"})

    f = spark.createDataFrame([("p",)], "path string")
    page = recognise.read_pages(f, reader).withColumn("r", recognise.region(F.col("width"), F.col("height"))).first()
    assert page.pdf_filename == "p" and (round(page.r.x0, 6), round(page.r.y1, 6)) == (1.2, 1.6)
