"""The corpus pipeline: documents through the stages in STAGES, each stage on all that the one before it kept.

Stages but the last return the columns of documents. A text that loses words in the substring stage has its n_chars anew. Rows
are told apart by doc_id and text, so rows without a doc_id, or with one that repeats, are documents of their own; of rows equal in both one
stays.
"""

from pyspark.sql import functions as F

from headerflow.llm import bpe, decontaminate, neardup, quality, substring
from headerflow.llm.common import Scratch, bounded_batches, table

#: No SQL expresses the classifier and the encoder; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def quality_stage(spark, docs, sf_dir):
    """Documents that the nearest labelled ones vote for stay."""
    bounded_batches(spark)
    return quality.accepted(docs, quality.quality_model(spark, docs, sf_dir))


def near_duplicate_stage(spark, docs, sf_dir):
    """The least doc_id of each component of linked documents stays; rows without words all stay."""
    bounded_batches(spark)
    return neardup.keep_first(docs, Scratch(spark, "pipeline"))


def substring_stage(spark, docs, sf_dir):
    """Passages of 35 words or more that stand anywhere else too go, wherever they stand."""
    bounded_batches(spark)
    cut = substring.remove_repeats(docs, Scratch(spark, "pipeline"))
    return cut.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast(docs.schema["n_chars"].dataType))) if "n_chars" in docs.columns else cut


def decontamination_stage(spark, docs, sf_dir):
    """Documents with a passage of the benchmark go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), Scratch(spark, "pipeline"))


def encoding_stage(spark, docs, sf_dir):
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit integers) and decoded text."""
    bounded_batches(spark)
    coded = bpe.encode_documents(docs, bpe.vocabulary())
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("substrings", substring_stage),
    ("decontamination", decontamination_stage),
    ("encoding", encoding_stage),
]


def run(spark, sf_dir):
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark, "stages")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
