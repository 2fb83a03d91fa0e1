"""Job metrics from an event table, and their roll-ups."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column, scale: float = 1.0) -> Column:
    """0 where there is nothing to divide by."""
    return F.when(F.coalesce(whole, F.lit(0)) == 0, 0.0).otherwise(part * scale / whole)


def job_metrics(events: DataFrame, key: str) -> DataFrame:
    """events: key, ts (seconds), kind (attempt, success, page, api, api_failure, error), value, message, event_id.

    Jobs last from their first to their last event. A success is an attempt too, an api_failure a call.
    """
    kind = F.col("kind")
    out = events.groupBy(key).agg(
        F.min("ts").alias("started"), F.max("ts").alias("ended"),
        F.count_if(kind == "page").alias("processed_pages"),
        F.count_if(kind.isin("attempt", "success")).alias("ocr_attempts"),
        F.count_if(kind == "success").alias("ocr_successful"),
        F.coalesce(F.max(F.when(kind == "success", F.col("value"))), F.lit(0.0)).alias("best_score"),
        F.count_if(kind.isin("api", "api_failure")).alias("api_calls"),
        F.count_if(kind == "api").alias("api_success"),
        F.count_if(kind == "error").alias("errors_count"),
    )
    seconds = F.col("ended") - F.col("started")
    return out.withColumns({
        "processing_time_seconds": seconds,
        "avg_time_per_page_seconds": ratio(seconds, F.col("processed_pages")),
        "success_rate": ratio(F.col("ocr_successful"), F.col("ocr_attempts"), 100.0),
        "api_failures": F.col("api_calls") - F.col("api_success"),
        "api_success_rate": ratio(F.col("api_success"), F.col("api_calls"), 100.0),
    })


def first_errors(events: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The first messages of each job, in order; rows are cut before they are gathered."""
    order = Window.partitionBy(key).orderBy("ts", "event_id")
    few = events.where("kind = 'error'").withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= n)
    return few.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", "message"))), lambda x: x["message"]).alias("errors"))


def fleet_summary(jobs: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Sums, ratios of the sums, fastest and slowest job; zeros for no jobs."""
    zero = lambda c: F.coalesce(c, F.lit(0))
    s = {c: zero(F.sum(c)) for c in ("processing_time_seconds", "processed_pages", "ocr_attempts", "ocr_successful", "api_calls", "api_success")}
    return jobs.groupBy(*(keys or [])).agg(
        F.count("*").alias("total_jobs"), s["processed_pages"].alias("total_pages_processed"),
        F.bround(ratio(s["processing_time_seconds"], F.count("*")), 2).alias("avg_processing_time_seconds"),
        F.bround(ratio(s["processing_time_seconds"], s["processed_pages"]), 3).alias("avg_processing_per_page_seconds"),
        F.bround(s["processing_time_seconds"], 2).alias("total_processing_time_seconds"),
        s["ocr_attempts"].alias("total_ocr_attempts"), s["ocr_successful"].alias("total_ocr_successful"),
        F.bround(ratio(s["ocr_successful"], s["ocr_attempts"], 100.0), 2).alias("ocr_success_rate"),
        s["api_calls"].alias("total_api_calls"), s["api_success"].alias("total_api_success"),
        F.bround(ratio(s["api_success"], s["api_calls"], 100.0), 2).alias("api_success_rate"),
        zero(F.min("processing_time_seconds")).alias("fastest_job"), zero(F.max("processing_time_seconds")).alias("slowest_job"),
    )


def daily(jobs: DataFrame) -> DataFrame:
    """The fleet summary of each day on which jobs ended."""
    return fleet_summary(jobs.withColumn("day", F.date_format(F.timestamp_seconds("ended"), "yyyy-MM-dd")), ["day"])


def last_jobs(jobs: DataFrame, key: str, n: int = 100) -> DataFrame:
    """The feature is a limit: the n jobs that ended last."""
    return jobs.orderBy(F.desc("ended"), F.desc(key)).limit(n)
