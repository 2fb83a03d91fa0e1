"""The watched folder as a stream: new documents become headers, groups and records, batch by batch."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import SHIPPED, HeaderConfig
from ..operators.segment import document_groups
from ..operators.vote import method_vote
from ..sources.files import document_stream, ready

KEYS = ["job_id", "pdf_filename"]


def headers_of(candidates: DataFrame, cfg: HeaderConfig = SHIPPED) -> DataFrame:
    """The voted header of each page."""
    return method_vote(candidates.withColumnRenamed("raw_text", "text"), [*KEYS, "page_idx"], cfg)


def process(files: DataFrame, recogniser: Callable[[DataFrame], DataFrame], cfg: HeaderConfig = SHIPPED) -> DataFrame:
    """Groups of pages of the documents in files; recogniser gives candidates of files."""
    return document_groups(headers_of(recogniser(files), cfg), KEYS, cfg)


def watch(spark: SparkSession, folder: str, out: str, checkpoint: str, recogniser: Callable[[DataFrame], DataFrame], cfg: HeaderConfig = SHIPPED, once: bool = False) -> StreamingQuery:
    """Groups of each batch go to out/batch=N, so that a batch that is done again replaces its own output; bad files to out-quarantine."""

    def batch(files: DataFrame, n: int) -> None:
        good, bad = ready(files)
        process(good, recogniser, cfg).write.mode("overwrite").parquet(f"{out}/batch={n}")
        bad.select("path", "length", F.current_timestamp().alias("seen")).write.mode("overwrite").parquet(f"{out}-quarantine/batch={n}")

    writer = document_stream(spark, folder).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="5 seconds")).start()
