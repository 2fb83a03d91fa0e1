"""Votes and segmentation of the older extractor."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SHIPPED, HeaderConfig
from ..functions import legacy as L
from ..functions.similarity import edit_similarity
from .segment import _ordered
from .vote import first_by


def page_combine(results: DataFrame, keys: list[str], cfg: HeaderConfig = SHIPPED) -> DataFrame:
    """results: keys, text, score, freq_ratio of each page. The text with the best mixture of scores, shares and pages; ties to the lesser."""
    each = results.groupBy(*keys, "text").agg(F.avg("score").alias("a"), F.max("score").alias("m"), F.avg("freq_ratio").alias("f"), F.count("*").alias("n"))
    noise = F.when((F.length("text") > 2) & F.col("text").rlike(" [\\p{L}\\p{N}]$"), 30).otherwise(0)
    each = each.withColumn("combined", F.round(F.col("a") * 0.4 + F.col("m") * 0.2 + F.col("f") * 30 + F.col("n") - noise, 9))
    best = first_by(each, keys, F.desc("combined"), F.asc("text"))
    return best.select(*keys, L.clean_serial(F.col("text"), cfg).alias("header"), "combined")


def serial_vote(results: DataFrame, keys: list[str], cfg: HeaderConfig = SHIPPED) -> DataFrame:
    """results: keys, text, score. The most frequent serial (ties to the lesser), and its best scored text; without any serial the best of all."""
    r = results.withColumn("serial", L.serial_number(F.col("text"), cfg))
    votes = r.where("serial is not null").groupBy(*keys, "serial").agg(F.count("*").alias("votes"))
    top = first_by(votes, keys, F.desc("votes"), F.asc("serial"))
    both = r.join(top.withColumnRenamed("serial", "_top"), keys, "left").where("_top is null or _top = serial")
    return first_by(both, keys, F.desc("score"), F.asc("text")).select(*keys, "text", "score", F.coalesce("votes", F.lit(0)).alias("votes"))


def vote(results: DataFrame, keys: list[str], cfg: HeaderConfig = SHIPPED) -> DataFrame:
    """results: keys, text. The corrected text with the best score, then most frequent, shortest, least."""
    each = results.where("text != ''").groupBy(*keys, "text").agg(F.count("*").alias("freq"))
    each = each.withColumns({"score": L.score(F.col("text"), cfg), "fixed": L.corrections(F.col("text"))}).where("score >= 0")
    return first_by(each, keys, F.desc("score"), F.desc("freq"), F.length("fixed"), F.asc("fixed")).select(*keys, F.col("fixed").alias("header"), "score", "freq")


def longest_text(results: DataFrame, keys: list[str]) -> DataFrame:
    """The longest text; the least of equals."""
    return first_by(results, keys, F.length("text").desc(), F.asc("text")).select(*keys, "text")


def headers_match(a: Column, b: Column, threshold: float) -> Column:
    """Structs (header, key, serial): equal keys, else equal serials if both have one, else likeness below a threshold of 1."""
    alike = edit_similarity(a["key"], b["key"]) >= threshold if threshold < 1 else F.lit(False)
    return (
        F.when((a["header"] == "") | (b["header"] == ""), a["header"] == b["header"]).when(a["key"] == b["key"], True)
        .when(a["serial"].isNotNull() & b["serial"].isNotNull(), a["serial"] == b["serial"]).otherwise(alike)
    )


def segments(pages: DataFrame, keys: list[str], cfg: HeaderConfig = SHIPPED) -> DataFrame:
    """pages: keys, page_idx, header (empty ones too). Start, end and anchor's quality winner of each group with a header.

    A better header of the group becomes what the next page is held against. Pages are counted by place in the list.
    """
    ready = pages.withColumns({"key": L.header_key(F.col("header")), "serial": L.serial_number(F.col("header"), cfg), "quality": L.quality(F.col("header"), cfg)})
    docs = _ordered(ready, keys, "page_idx", "header", "key", "serial", "quality")
    first = F.get("rows", F.lit(0))
    zero = F.struct(first.alias("anchor"), F.lit(0).alias("n"), F.array().cast("array<struct<segment:int,anchor:string>>").alias("out"))

    def step(acc: Column, row: Column) -> Column:
        stays = headers_match(acc["anchor"], row, cfg.similarity)
        anchor = F.when(stays & (row["quality"] <= acc["anchor"]["quality"]), acc["anchor"]).otherwise(row)
        n = F.when(stays, acc["n"]).otherwise(acc["n"] + 1)
        said = F.struct(n.alias("segment"), anchor["header"].alias("anchor"))
        return F.struct(anchor.alias("anchor"), n.alias("n"), F.concat(acc["out"], F.array(said)).alias("out"))

    folded = docs.withColumn("_out", F.aggregate("rows", zero, step, lambda acc: acc["out"]))
    each = folded.select(*keys, F.posexplode(F.arrays_zip("rows", F.col("_out").alias("o"))).alias("place", "x"))
    each = each.select(*keys, F.col("place"), "x.rows.header", "x.rows.quality", "x.o.segment", "x.o.anchor")
    best = F.max_by("header", F.struct(F.col("quality"), -F.col("place")))
    out = each.groupBy(*keys, "segment").agg(F.min("place").alias("start_page"), F.max("place").alias("end_page"), best.alias("header"), F.max_by("anchor", "place").alias("anchor"))
    return out.where("anchor != ''").drop("anchor")
