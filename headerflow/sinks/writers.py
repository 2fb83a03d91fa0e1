"""Sinks: reports, metrics, split files, log records over HTTP."""

import csv
import io
import json
import os
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_report(records: DataFrame, path: str) -> None:
    """Records as CSV, one folder a day (report_day=...)."""
    out = records.withColumn("report_day", F.to_date("timestamp")).withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
    out.write.mode("overwrite").partitionBy("report_day").csv(path, header=True)


def report_text(records: DataFrame, summary: dict, most: int = 1_000_000) -> bytes:
    """One CSV file for people: summary lines after #, then the records, with a byte order mark. For bounded reports only."""
    rows = records.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError("too many records for one file; use write_report")
    out = io.StringIO()
    w = csv.writer(out, lineterminator="\n")
    for k, v in summary.items():
        w.writerow([f"# {k}", v])
    w.writerow(records.columns)
    w.writerows([["" if v is None else v for v in r] for r in rows])
    return b"\xef\xbb\xbf" + out.getvalue().encode()


def write_metrics(jobs: DataFrame, fleet: DataFrame, path: str) -> None:
    """summary/: the fleet; jobs/day=.../: all jobs of a day; both as JSON lines."""
    fleet.write.mode("overwrite").json(f"{path}/summary")
    jobs.withColumn("day", F.date_format(F.timestamp_seconds("ended"), "yyyy-MM-dd")).write.mode("overwrite").partitionBy("day").json(f"{path}/jobs")


def write_atomically(path: str, content: bytes, waits: tuple[float, ...] = (0, 0.2, 0.6)) -> str:
    """Writes beside the target and renames; a target that stays locked gets another name."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with open(part, "wb") as f:
        f.write(content)
    for wait in waits:
        time.sleep(wait)
        try:
            os.replace(part, path)
            return path
        except PermissionError:
            continue
    stem, end = os.path.splitext(path)
    os.replace(part, other := f"{stem}_locked_{uuid.uuid4().hex[:8]}{end}")
    return other


def write_splits(manifest: DataFrame, subset: Callable[[str, int, int], bytes], folder: str) -> DataFrame:
    """manifest: original, start_page, end_page, file_name. subset cuts pages out of a document (a PDF library, say).

    Runs on the executors; folder must be one that all of them share. Returns file_name, path and bytes as written.
    """

    def run(frames):
        for pdf in frames:
            content = [subset(r.original, int(r.start_page), int(r.end_page)) for r in pdf.itertuples()]
            paths = [write_atomically(os.path.join(folder, n), c) for n, c in zip(pdf.file_name, content, strict=True)]
            yield pdf[["file_name"]].assign(path=paths, bytes=[len(c) for c in content])

    return manifest.mapInPandas(run, "file_name string, path string, bytes long")


def payloads(records: DataFrame) -> DataFrame:
    """Each record as a JSON body."""
    return records.select(F.to_json(F.struct(*records.columns)).alias("body"))


def post(records: DataFrame, send: Callable[[bytes], bool], failures: int = 5, seconds: float = 60.0) -> DataFrame:
    """Sends each record by a given transport. A task stops sending after so many failures in a row, until time has passed.

    Returns sent, failed and blocked counts, a row a task; bodies are never kept in memory together.
    """

    def run(frames):
        sent = failed = blocked = streak = 0
        since = 0.0
        for pdf in frames:
            for body in pdf.body:
                if streak >= failures and time.monotonic() - since <= seconds:
                    blocked += 1
                elif send(body.encode()):
                    sent, streak = sent + 1, 0
                else:
                    failed, streak, since = failed + 1, streak + 1, time.monotonic()
        import pandas as pd

        yield pd.DataFrame({"sent": [sent], "failed": [failed], "blocked": [blocked]})

    return payloads(records).mapInPandas(run, "sent long, failed long, blocked long").agg(*(F.sum(c).alias(c) for c in ("sent", "failed", "blocked")))


def payload_of(group: dict) -> str:
    return json.dumps(group, ensure_ascii=False, sort_keys=True)


def split_log(manifest: DataFrame, keys: list[str]) -> DataFrame:
    """One JSON body a document, its split files nested in order."""
    files = F.array_sort(F.collect_list(F.struct("idx", "file_name", "start_page", "end_page", "header")))
    return manifest.groupBy(*keys).agg(F.to_json(F.struct(F.count("*").alias("files"), files.alias("splits"))).alias("body"))
