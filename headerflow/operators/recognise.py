"""Which readings are made and trusted: page choice, budgets, early exit, escalation, fallback to a second engine.

Recognisers and page readers are given by the user: functions from an iterator of pandas frames to one, run by mapInPandas, so
that an engine starts once a task. TableRecogniser stands in for one in tests: its readings come from a table.
"""

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import SHIPPED, HeaderConfig
from ..functions import score as S
from ..functions.text import invalid_characters, normalize
from ..schemas import CANDIDATES, PAGES
from .vote import ensemble


class PageReader(Protocol):
    def __call__(self, files: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows of binary files to rows of pages; a file that cannot be read gives none."""


class Recognizer(Protocol):
    def __call__(self, pages: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows of pages to rows of candidates."""


def read_pages(files: DataFrame, reader: PageReader) -> DataFrame:
    return files.mapInPandas(reader, PAGES)


def recognise(pages: DataFrame, recogniser: Recognizer) -> DataFrame:
    return pages.mapInPandas(recogniser, CANDIDATES)


def table_recogniser(readings: DataFrame, keys: list[str]) -> Callable[[DataFrame], DataFrame]:
    return lambda pages: pages.select(*keys).join(readings, keys)


def select_pages(pages: DataFrame, cfg: HeaderConfig = SHIPPED) -> DataFrame:
    """All pages, or those listed (from 1), as often as they are listed."""
    if not cfg.pages:
        return pages
    listed = F.explode(F.array(*[F.lit(p - 1) for p in cfg.pages]))
    return pages.sparkSession.range(1).select(listed.alias("page_idx")).hint("broadcast").join(pages, "page_idx")


def region(width: Column, height: Column, cfg: HeaderConfig = SHIPPED) -> Column:
    """The header's rectangle on a page."""
    x, y = width * (cfg.left / 100), height * (cfg.top / 100)
    return F.struct(x.alias("x0"), y.alias("y0"), (x + width * (cfg.width / 100)).alias("x1"), (y + height * (cfg.height / 100)).alias("y1"))


def direct_text(text: Column, cfg: HeaderConfig = SHIPPED) -> Column:
    """The text layer's header where it is strict; else null, and the page has to be recognised."""
    norm = normalize(text, cfg)
    return F.when(S.strict(norm, cfg) & (S.score(norm, cfg) > 0), norm)


def within_budget(readings: DataFrame, keys: list[str], cfg: HeaderConfig = SHIPPED) -> DataFrame:
    """The first readings of each key, in order of attempt_no."""
    order = Window.partitionBy(*keys).orderBy("attempt_no")
    return readings.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= cfg.attempts).drop("_n")


def early_exit(readings: DataFrame, keys: list[str], cfg: HeaderConfig = SHIPPED) -> DataFrame:
    """Readings up to the one that confirms an excellent text: strict, well scored, trusted, and seen before."""
    r = S.with_header_fields(readings, "text", cfg)
    great = F.col("strict") & (F.col("score") >= cfg.great_score) & (F.col("confidence") >= cfg.confidence) & (F.col("text") != "")
    order = Window.partitionBy(*keys).orderBy("attempt_no")
    r = r.withColumn("_great", great).withColumn("_nth", F.row_number().over(order))
    seen = F.sum(F.col("_great").cast("int")).over(Window.partitionBy(*keys, "text").orderBy("attempt_no"))
    r = r.withColumn("_hit", F.col("_great") & (seen >= cfg.confirmations) & (F.col("_nth") >= cfg.confirmations))
    hits = F.coalesce(F.sum(F.col("_hit").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return r.withColumn("_hits", hits).where("_hits = 0").select(*keys, "attempt_no", "text", "score", F.col("_hit").alias("exits"))


def escalate(readings: DataFrame, keys: list[str], cfg: HeaderConfig = SHIPPED) -> DataFrame:
    """readings: keys, scale, text. Those made before a scale's result was good enough: strict, well scored, not suspicious."""
    r = S.with_header_fields(readings, "text", cfg)
    stop = F.col("strict") & (F.col("score") >= cfg.good_score) & ~S.suspicious(F.col("norm"), cfg)
    before = F.sum(F.col("_stop").cast("int")).over(Window.partitionBy(*keys).orderBy("scale").rowsBetween(Window.unboundedPreceding, -1))
    return r.withColumn("_stop", stop).withColumn("_n", F.coalesce(before, F.lit(0))).where("_n = 0").select(*keys, "scale", "text", "score", F.col("_stop").alias("stops"))


def fallback_reason(text: Column, confidence: Column, cfg: HeaderConfig = SHIPPED) -> Column:
    """Why a second engine is asked: empty_text, or what fails of pattern, confidence and characters; else passed."""
    bad = F.array_join(invalid_characters(text), "")
    reasons = F.concat_ws(
        ", ", F.when(~text.rlike(cfg.pattern), "regex_failed"),
        F.when(confidence < cfg.confidence, F.concat(F.lit("low_confidence("), F.format_string("%.1f", confidence), F.lit("%)"))),
        F.when(bad != "", F.concat(F.lit("invalid_chars("), bad, F.lit(")"))),
    )
    return F.when(F.coalesce(text, F.lit("")) == "", "empty_text").when(reasons == "", "passed").otherwise(reasons)


def fallback(readings: DataFrame, second: DataFrame, keys: list[str], cfg: HeaderConfig = SHIPPED) -> DataFrame:
    """readings: keys, text, confidence; second: keys, second_text, second_confidence of the other engine.

    Good strict texts and texts without a reason keep what they have.
    """
    norm = normalize(F.col("text"), cfg)
    skip = (S.strict(norm, cfg) & (S.score(norm, cfg) >= cfg.good_score)) | (fallback_reason(F.col("text"), F.col("confidence"), cfg) == "passed")
    both = readings.withColumn("asked", ~F.coalesce(skip, F.lit(False))).join(second, keys, "left")
    voted = ensemble(F.col("text"), F.col("second_text"), F.col("confidence"), F.col("second_confidence"), cfg)
    use = F.col("asked") & (F.coalesce("second_text", F.lit("")) != "")
    return both.withColumn("text", F.when(use, voted).otherwise(F.col("text"))).select(*keys, "text", "asked")


def low_confidence_characters(characters: Column, limit: float = 70.0) -> Column:
    """characters: array of structs with a confidence; those above 0 and below the limit."""
    return F.filter(characters, lambda c: (c["confidence"] > 0) & (c["confidence"] < limit))


def characters_with_confidence(text: Column, confidence: Column) -> Column:
    """One struct a character with the confidence (0 to 1) of its line, as a percentage."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    return F.transform(chars, lambda c, i: F.struct(i.alias("pos"), c.alias("ch"), (confidence * 100).alias("confidence")))
