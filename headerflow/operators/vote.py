"""Votes between readings of the same thing."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import SHIPPED, HeaderConfig
from ..functions import score as S
from ..functions.similarity import edit_similarity
from ..functions.text import ambiguity, let, normalize


def first_by(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key; Spark keeps one row a key and task before the shuffle."""
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rank = 1").drop("_rank")


def method_vote(readings: DataFrame, keys: list[str], cfg: HeaderConfig = SHIPPED) -> DataFrame:
    """readings: keys, text, confidence. The winner by strictness and weighted score, and its share of the non-empty readings.

    Ties go to the lesser text.
    """
    some = readings.where(F.coalesce("text", F.lit("")) != "")
    each = some.groupBy(*keys, "text").agg(F.count("*").alias("freq"), F.avg("confidence").alias("avg_confidence"))
    each = S.with_header_fields(each, "text", cfg)
    each = each.withColumn("weighted", F.col("score") * 0.7 + F.col("avg_confidence") * 0.3 + F.when(F.col("strict"), 20.0).otherwise(0.0))
    each = each.withColumns({"weighted": F.round("weighted", 9), "avg_confidence": F.round("avg_confidence", 9)})  # sums in another order are equal
    each = each.withColumn("total", F.sum("freq").over(Window.partitionBy(*keys)))
    best = first_by(each, keys, *(F.desc(c) for c in ("strict", "weighted", "score", "freq", "avg_confidence")), F.asc("text"))
    chosen = F.when(F.col("score") > 0, F.col("norm")).otherwise(F.col("text"))
    return best.select(*keys, chosen.alias("header"), "score", "strict", "freq", (F.col("freq") / F.col("total")).alias("freq_ratio"), "weighted")


def best_header(headers: DataFrame, keys: list[str], column: str = "header", cfg: HeaderConfig = SHIPPED) -> DataFrame:
    """The header of each group: most frequent, strict, fittest, best scored, shortest, least."""
    named = S.with_header_fields(headers.select(*keys, column), column, cfg).withColumn("best", F.when(F.col("norm") != "", F.col("norm")).otherwise(F.col(column)))
    each = named.groupBy(*keys, "best").agg(F.count("*").alias("n"), F.max("score").alias("score"), F.max("fitness").alias("fitness"), F.max("strict").alias("strict"))
    return first_by(each, keys, F.desc("n"), F.desc("strict"), F.desc("fitness"), F.desc("score"), F.length("best"), F.asc("best"))


def header_support(candidates: DataFrame, keys: list[str], header: str, text: str) -> DataFrame:
    """How many candidates are the header itself, and how many say anything."""
    said = F.trim(F.coalesce(text, F.lit("")))
    return candidates.groupBy(*keys).agg(F.count_if(said == F.col(header)).alias("support"), F.count_if(F.length(said) > 0).alias("non_empty"))


def resolve_by_support(bases: DataFrame, candidates: DataFrame, keys: list[str], least: int = 1, cfg: HeaderConfig = SHIPPED) -> DataFrame:
    """bases: keys, header. The alternative of an ambiguous header that enough candidates (keys, text) agree with.

    Among equals the first alternative wins.
    """
    info = bases.withColumn("info", ambiguity(normalize(F.col("header"), cfg), cfg))
    options = info.where("info.is_ambiguous").select(*keys, F.posexplode("info.headers").alias("place", "option"))
    norm = normalize(F.col("text"), cfg)
    said = candidates.where(F.coalesce("text", F.lit("")) != "").select(*keys, F.when(norm != "", norm).otherwise(F.col("text")).alias("option"))
    votes = said.groupBy(*keys, "option").agg(F.count("*").alias("votes"))
    backed = options.join(votes, [*keys, "option"], "left").withColumn("votes", F.coalesce("votes", F.lit(0)))
    best = first_by(backed, keys, F.desc("votes"), F.asc("place"))
    out = info.select(*keys, "header", "info.is_ambiguous").join(best.select(*keys, "option", "votes"), keys, "left")
    applied = F.col("is_ambiguous") & (F.coalesce("votes", F.lit(0)) >= max(1, least))
    return out.select(*keys, "header", F.when(applied, F.col("option")).otherwise(F.col("header")).alias("resolved"), applied.alias("applied"), F.coalesce("votes", F.lit(0)).alias("votes"))


def scale_vote(candidates: DataFrame, keys: list[str], likeness=edit_similarity) -> DataFrame:
    """candidates: keys, idx, text, score, strict, freq_ratio, scale, fitness. The winner across scales.

    Each candidate is held against those of its own page, of which there are as many as scales. likeness is a Column function
    of two columns; with a Python one the pairs are materialised before it.
    """
    c = candidates.withColumn("text", F.trim(F.coalesce("text", F.lit(""))))
    other = c.where("text != ''").select(*keys, F.col("text").alias("other"))
    pairs = c.where("text != ''").select(*keys, "idx", "text").join(other, keys)
    sim = pairs.withColumn("sim", likeness(F.col("text"), F.col("other")))
    support = sim.groupBy(*keys, "idx").agg(F.count_if(F.col("text") == F.col("other")).alias("n_exact"), F.count_if(F.col("sim") >= 0.92).alias("n_similar"), F.sum("sim").alias("sim_sum"))
    full = c.join(support, [*keys, "idx"], "left").fillna(0, ["n_exact", "n_similar"]).fillna(0.0, ["sim_sum"])
    full = full.withColumn("sim_sum", F.round("sim_sum", 9))
    order = [F.desc(x) for x in ("strict", "n_exact", "n_similar", "fitness", "score", "freq_ratio", "sim_sum", "scale")]
    return first_by(full, keys, *order, F.length("text"), F.asc("idx"))


def mean_confidence(readings: DataFrame, keys: list[str]) -> DataFrame:
    """Mean of the confidences from 0 up; without any, the mean score / 1.5 within 0 and 100."""
    known = F.avg(F.when(F.col("confidence") >= 0, F.col("confidence")))
    guess = F.least(F.lit(100.0), F.greatest(F.lit(0.0), F.avg("score") / 1.5))
    return readings.groupBy(*keys).agg(F.coalesce(known, guess, F.lit(0.0)).alias("confidence"))


def ensemble(first: Column, second: Column, first_conf: Column, second_conf: Column, cfg: HeaderConfig = SHIPPED) -> Column:
    """Of two engines' texts the one with more score and confidence, normalised; equal texts as they are; ties to the first."""
    weight = lambda norm, conf: S.score(norm, cfg) * 0.6 + conf * 0.4
    both = F.struct(normalize(first, cfg).alias("a"), normalize(second, cfg).alias("b"))
    better = let(both, lambda x: F.when(weight(x["b"], second_conf) > weight(x["a"], first_conf), x["b"]).otherwise(x["a"]))
    return F.when(first == second, first).otherwise(better)
