"""Contiguous pages as documents: segmentation, repair of outliers, joining of neighbours.

Whether a page belongs to a segment depends on that segment's first page, and a repair changes what the next one sees, so both
are folds in page order. A fold runs in the JVM over the pages of one document at a time.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import SHIPPED, HeaderConfig
from ..functions import score as S
from ..functions.similarity import edit_similarity, headers_match, likely_misread
from .vote import best_header


def _ordered(df: DataFrame, keys: list[str], order: str, *fields: str) -> DataFrame:
    """One row a key: its rows as an array of structs in order."""
    return df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(order, *[f for f in fields if f != order]))).alias("rows"))


def assign_segments(pages: DataFrame, keys: list[str], cfg: HeaderConfig = SHIPPED, likeness=edit_similarity) -> DataFrame:
    """pages: keys, page_idx, header. Adds segment (from 0): a page that does not match its segment's first page begins another.

    Pages without a header must have been dropped.
    """
    fields = ["header", "norm", "n_parts", "lead", "serial", "strict"]
    docs = _ordered(S.with_header_fields(pages, "header", cfg), keys, "page_idx", *fields)
    first = F.get("rows", F.lit(0))
    zero = F.struct(first.alias("anchor"), F.lit(0).alias("n"), F.array().cast("array<int>").alias("out"))

    def step(acc: Column, row: Column) -> Column:
        stays = headers_match(row, acc["anchor"], cfg, likeness) | (row["page_idx"] == first["page_idx"])
        n = F.when(stays, acc["n"]).otherwise(acc["n"] + 1)
        return F.struct(F.when(stays, acc["anchor"]).otherwise(row).alias("anchor"), n.alias("n"), F.concat(acc["out"], F.array(n)).alias("out"))

    folded = docs.withColumn("_n", F.aggregate("rows", zero, step, lambda acc: acc["out"]))
    each = folded.select(*keys, F.inline(F.arrays_zip("rows", F.col("_n").alias("segment"))))
    return each.select(*keys, "rows.page_idx", "rows.header", F.col("segment"))


def segments(pages: DataFrame, keys: list[str], cfg: HeaderConfig = SHIPPED, likeness=edit_similarity) -> DataFrame:
    """keys, segment, start_page, end_page, header (the group's best) of each segment."""
    marked = assign_segments(pages.where("header != ''"), keys, cfg, likeness)
    ranges = marked.groupBy(*keys, "segment").agg(F.min("page_idx").alias("start_page"), F.max("page_idx").alias("end_page"))
    best = best_header(marked, [*keys, "segment"], "header", cfg).select(*keys, "segment", F.col("best").alias("header"))
    return ranges.join(best, [*keys, "segment"])


def correct_by_context(groups: DataFrame, keys: list[str], cfg: HeaderConfig = SHIPPED) -> DataFrame:
    """groups: keys, start_page, end_page, header. A single page that looks like a misread neighbour joins it.

    If both neighbours qualify, the one with more score, strictness and pages; the one before on a tie.
    """
    ready = S.with_header_fields(groups, "header", cfg).withColumn("worth", F.col("score") + F.when(F.col("strict"), 20).otherwise(0))
    fields = ["end_page", "header", "norm", "strict", "worth"]
    docs = _ordered(ready, keys, "start_page", *fields)
    none = F.lit(None).cast("int")
    zero = F.struct(F.slice("rows", 1, 0).alias("out"), none.alias("carried"), F.lit(0).alias("i"))
    rank = lambda g: g["worth"] + F.least(F.lit(10), g["end_page"] - g["start_page"] + 1)

    def step(acc: Column, row: Column) -> Column:
        here = row.withField("start_page", F.coalesce(acc["carried"], row["start_page"]))
        single = here["start_page"] == here["end_page"]
        before, after = F.get(acc["out"], F.size(acc["out"]) - 1), F.get("rows", acc["i"] + 1)
        to_before = F.coalesce(single & before.isNotNull() & likely_misread(here, before), F.lit(False))
        to_after = F.coalesce(single & after.isNotNull() & likely_misread(here, after), F.lit(False))
        go_after = to_after & (~to_before | F.coalesce(rank(after) > rank(before), F.lit(False)))
        grown = F.concat(F.slice(acc["out"], F.lit(1), F.greatest(F.size(acc["out"]) - 1, F.lit(0))), F.array(before.withField("end_page", here["end_page"])))
        out = F.when(go_after, acc["out"]).when(to_before, grown).otherwise(F.concat(acc["out"], F.array(here)))
        return F.struct(out.alias("out"), F.when(go_after, here["start_page"]).alias("carried"), (acc["i"] + 1).alias("i"))

    fixed = docs.select(*keys, F.inline(F.aggregate("rows", zero, step, lambda acc: acc["out"])))
    return merge_adjacent(fixed.select(*keys, "start_page", "end_page", "header"), keys)


def merge_adjacent(groups: DataFrame, keys: list[str]) -> DataFrame:
    """Neighbours without a gap and with equal headers become one."""
    order = Window.partitionBy(*keys).orderBy("start_page")
    joined = (F.col("start_page") == F.lag("end_page").over(order) + 1) & (F.col("header") == F.lag("header").over(order))
    marked = groups.withColumn("_new", F.when(F.coalesce(joined, F.lit(False)), 0).otherwise(1)).withColumn("_group", F.sum("_new").over(order))
    out = marked.groupBy(*keys, "_group").agg(F.min("start_page").alias("start_page"), F.max("end_page").alias("end_page"), F.min("header").alias("header"))
    return out.drop("_group")


def large_enough(groups: DataFrame, cfg: HeaderConfig = SHIPPED) -> DataFrame:
    return groups.where(F.col("end_page") - F.col("start_page") + 1 >= cfg.least_pages) if cfg.least_pages > 0 else groups


def document_groups(pages: DataFrame, keys: list[str], cfg: HeaderConfig = SHIPPED, likeness=edit_similarity) -> DataFrame:
    """Segments, repaired, joined and filtered by size."""
    return large_enough(correct_by_context(segments(pages, keys, cfg, likeness), keys, cfg), cfg)


def runs(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Stretches of equal values: keys, run (from 1), value, first, last, n."""
    w = Window.partitionBy(*keys).orderBy(order)
    changed = F.when(F.col(value).eqNullSafe(F.lag(value).over(w)) & F.lag(order).over(w).isNotNull(), 0).otherwise(1)
    marked = df.withColumn("_new", changed).withColumn("run", F.sum("_new").over(w))
    return marked.groupBy(*keys, "run").agg(F.first(value).alias(value), F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n"))
