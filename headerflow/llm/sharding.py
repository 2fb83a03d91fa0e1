"""Sharding by sampled splitters.

Records are ordered by a composite key (hash of the text, hash of the id). A size-weighted sample of keys gives the
boundaries of many fine ranges; a range that turns out overfull is sampled anew and subdivided. Exact byte counts of the
ranges then place every record at its byte offset in the key order, and equal stretches of offsets are the shards. So shards
differ by about one record at most, whatever the key's distribution: the boundaries inside a hot key fall between its ids.

Law `bytes`. Equal texts stay in one shard unless their group is larger than SPLIT of a shard.
Null text: size 1, crc32 of no bytes (0). Empty table: empty result. Repeated rows: each gets a slot of its own.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, fraction, table

SHARDS = 8
#: Rows that a fine range holds about; least and most ranges; sampled keys a range.
RANGE_ROWS, LEAST, MOST, SAMPLES = 20_000, 64, 65_536, 16
#: A group of equal keys over this share of a shard is divided.
SPLIT = 0.005


def _splitters(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """n-1 boundaries from sorted (key, sub) samples. Only a key that takes several boundaries is cut inside."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.unique(np.minimum(len(keys) - 1, np.arange(1, n) * len(keys) // n))
    k, s = keys["k"][at], keys["s"][at].copy()
    _, inverse, count = np.unique(k, return_inverse=True, return_counts=True)
    s[count[inverse] == 1] = np.iinfo(np.int64).min
    both = np.unique(np.rec.fromarrays([k, s], names="k,s"))
    return both["k"].copy(), both["s"].copy()


def _bins(k: np.ndarray, s: np.ndarray, bk: np.ndarray, bs: np.ndarray) -> np.ndarray:
    """How many boundaries are at or below each (key, sub)."""
    low, high = np.searchsorted(bk, k, "left"), np.searchsorted(bk, k, "right")
    out = low.copy()
    for key in np.unique(k[low < high]):
        rows = k == key
        a, b = np.searchsorted(bk, key, "left"), np.searchsorted(bk, key, "right")
        out[rows] = a + np.searchsorted(bs[a:b], s[rows], "right")
    return out.astype(np.int32)


def _assign(rows: DataFrame, bk: np.ndarray, bs: np.ndarray) -> DataFrame:
    def run(batches):
        for b in batches:
            k, s = (b.column(c).to_numpy(zero_copy_only=False) for c in ("key", "sub"))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(_bins(k, s, bk, bs))], [*b.schema.names, "bin"])

    return rows.mapInArrow(run, rows.schema.simpleString()[7:-1] + ",bin:int")


def _sample(rows: DataFrame, share, most: int) -> np.ndarray:
    """Keys drawn with the given probability a row; most: a bound on what is expected, with room for chance."""
    got = rows.where(fraction("sub", F.lit(17)) < share).select("key", "sub").limit(2 * most + 1000).toPandas()
    return np.sort(np.rec.fromarrays([got["key"].to_numpy(np.int64), got["sub"].to_numpy(np.int64)], names="k,s"))


def shard(rows: DataFrame, scratch: Scratch, shards: int = SHARDS) -> DataFrame:
    """rows: doc_id, size, key, sub, and others. Adds shard and slot (gapless from 0 within a shard)."""
    rows = scratch.keep(rows, "keys")
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    ranges = int(min(MOST, max(LEAST, n // RANGE_ROWS)))
    want = SAMPLES * ranges
    bk, bs = _splitters(_sample(rows, F.col("size") * F.lit(want / max(1, total)), want), ranges)
    for attempt in range(4):
        binned = scratch.keep(_assign(rows, bk, bs), f"bins{attempt}")
        load = binned.groupBy("bin").agg(F.sum("size").alias("b"), F.count("*").alias("n")).toPandas().sort_values("bin")
        over = load[(load.b > 3 * total / ranges) & (load.n > 2)]
        if attempt == 3 or over.empty:
            break
        # the overfull ranges alone are sampled again, more densely
        more = binned.where(F.col("bin").isin([int(x) for x in over.bin]))
        pieces = int(np.ceil(over.b.sum() * ranges / total)) + len(over)
        keys = _sample(more, F.col("size") * F.lit(want * 4.0**attempt / max(1, over.b.sum())), int(want * 4**attempt))
        nk, ns = _splitters(keys, 2 * pieces)
        both = np.unique(np.rec.fromarrays([np.r_[bk, nk], np.r_[bs, ns]], names="k,s"))
        scratch.drop(f"bins{attempt}")
        bk, bs = both["k"].copy(), both["s"].copy()
    base = dict(zip(load.bin.tolist(), (load.b.cumsum() - load.b).tolist(), strict=True))
    spark = binned.sparkSession
    order = ["key", "sub", "doc_id"]
    bases = F.broadcast(spark.createDataFrame([(int(k), int(v)) for k, v in base.items()] or [(0, 0)], "bin int, base long"))
    end = F.sum("size").over(Window.partitionBy("bin").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    group = Window.partitionBy("bin", "key")
    placed = binned.join(bases, "bin").withColumn("_end", F.col("base") + end)
    placed = placed.withColumn("_from", F.min(F.col("_end") - F.col("size")).over(group)).withColumn("_to", F.max("_end").over(group))
    whole = (F.col("_to") - F.col("_from")) <= F.lit(SPLIT * total / shards)
    middle = F.when(whole, (F.col("_from") + F.col("_to")) / 2).otherwise(F.col("_end") - F.col("size") / 2)
    placed = placed.withColumn("shard", F.least(F.lit(shards - 1), F.floor(middle * F.lit(shards / max(1, total)))).cast("int"))
    placed = scratch.keep(placed.drop("_from", "_to", "_end", "base"), "placed")
    counts = placed.groupBy("bin", "shard").count().toPandas().sort_values(["shard", "bin"])
    counts["base"] = counts.groupby("shard")["count"].cumsum() - counts["count"]
    offsets = spark.createDataFrame([tuple(int(x) for x in r) for r in counts[["bin", "shard", "base"]].to_numpy()] or [(0, 0, 0)], "bin int, shard int, base long")
    slot = F.row_number().over(Window.partitionBy("bin", "shard").orderBy(*order))
    return placed.withColumn("_n", slot).join(F.broadcast(offsets), ["bin", "shard"]).withColumn("slot", F.col("base") + F.col("_n") - 1).drop("_n", "base", "bin")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("key"), F.xxhash64(F.coalesce("doc_id", F.lit(-1))).alias("sub"),
    )
    out = shard(rows, Scratch(spark, "op3"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
