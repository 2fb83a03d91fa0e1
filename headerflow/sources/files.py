"""File sources: binary documents, header lines of web pages, report files."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import BINARY_FILES, RECORDS

PDF_GLOB = "*.[pP][dD][fF]"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """All PDF files of a folder, not of its folders."""
    return spark.read.format("binaryFile").option("pathGlobFilter", PDF_GLOB).load(folder)


def document_stream(spark: SparkSession, folder: str, files_a_batch: int = 100) -> DataFrame:
    """New PDF files, and those there already; each once, by the checkpoint. Files must appear complete, by renaming."""
    return spark.readStream.format("binaryFile").schema(BINARY_FILES).option("pathGlobFilter", PDF_GLOB).option("maxFilesPerTrigger", files_a_batch).load(folder)


def ready(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Files that look like complete PDFs, and the others for quarantine."""
    head = F.decode(F.substring("content", 1, 5), "ISO-8859-1")
    ok = (F.col("length") > 0) & (head == "%PDF-")
    ok = F.coalesce(ok, F.lit(False))
    return files.where(ok), files.where(~ok)


def on_day(files: DataFrame, year: int, month: int, day: int) -> DataFrame:
    """Files modified on a date."""
    return files.where(F.to_date("modificationTime") == F.make_date(F.lit(year), F.lit(month), F.lit(day)))


def title(html: Column) -> Column:
    """The title of a web page, as its header text; empty without one."""
    return F.trim(F.regexp_extract(F.coalesce(html, F.lit("")), "(?is)<title[^>]*>(.*?)</title>", 1))


def report(spark: SparkSession, path: str) -> DataFrame:
    """Records of report files (a path or pattern). Lines that begin with # are summaries; a row without a timestamp is no record."""
    return spark.read.schema(RECORDS).csv(path, header=True, comment="#", encoding="UTF-8", timestampFormat="yyyy-MM-dd HH:mm:ss").where("timestamp is not null")
