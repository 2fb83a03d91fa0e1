"""Reports over extraction records."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def summary(records: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Totals by status, success share, means and distinct counts; exact, with zeros for an empty report."""
    some = lambda c: F.when(F.col(c) != "", F.col(c))
    out = records.groupBy(*(keys or [])).agg(
        F.count("*").alias("total_pages"),
        *(F.count_if(F.col("status") == s).alias(f"{s}_count") for s in ("success", "error", "low_confidence")),
        F.bround(F.coalesce(F.avg("confidence_score"), F.lit(0.0)), 1).alias("avg_confidence_score"),
        F.bround(F.coalesce(F.avg("processing_time_ms"), F.lit(0.0)), 2).alias("avg_processing_time_ms"),
        F.count_distinct(some("header_extracted")).alias("unique_headers"),
        F.count_distinct(some("split_group")).alias("unique_split_groups"),
    )
    rate = F.when(F.col("total_pages") == 0, 0.0).otherwise(F.col("success_count") * 100.0 / F.col("total_pages"))
    return out.withColumn("success_rate", F.bround(rate, 1))


def errors(records: DataFrame) -> DataFrame:
    return records.where(F.col("status").isin("error", "low_confidence"))


def job_summary(records: DataFrame, keys: list[str]) -> DataFrame:
    """Mean confidence with the zeros in, and pages with an ambiguous code."""
    return records.groupBy(*keys).agg(F.count("*").alias("pages"), F.avg("confidence_score").alias("avg_confidence"), F.count_if(F.col("quality_flags").contains("code_ambiguity:")).alias("code_ambiguity_pages"))
