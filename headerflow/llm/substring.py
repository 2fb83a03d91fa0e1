"""Substring dedup by prefix-partitioned suffix trees.

The suffixes of a corpus are those of its word sequences; only their first SIZE words (the windows) matter here, so each tree is
cut at that depth. A suffix belongs to the group of the least SEED-word hash among its first SIZE words, which equal suffixes
share; neighbouring suffixes mostly share it too and travel as one run. Groups of one run are dropped before any text is moved.
Runs with the same words become one, with a count, before they meet, so copies weigh nothing. Groups that fit in memory are
gathered, and their tree is built by prefix doubling: the nodes at depth 1, 2, 4 ... 32 and SIZE. A node at depth SIZE that
stands for two places or more is an internal node, hence a repeat, and its leaves are marked. A group with more than HOT
different runs takes a longer prefix, the whole window, as its key; such a group is one leaf class, so a count is enough and no
task holds it.

The words that marked windows cover are removed, all at once: windows are judged on the input.

Null and empty texts and those shorter than SIZE words have no window. Rows that repeat a doc_id and its text are documents of
their own that repeat each other. Other columns pass through untouched.
"""

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import NO_ID, Scratch, Tokens, as_bytes, bounded_batches, mix, table, tidied, windows

SIZE, SEED = 35, 17
#: Different runs from which a group's key is the whole window; words of a tree about.
HOT, WORDS = 4000, 400_000


def runs(words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Seed, first window and number of windows of each run: neighbours whose first least seed stands at the same place.

    words: hashes of a text's words. So equal windows, even those of one periodic text, are never in one run.
    """
    if len(words) < size:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    seed = min(SEED, size)
    g, want, have = windows(words, seed), size - seed + 1, 1
    at = np.arange(len(g))

    def first_least(left, right):
        return np.where(g[right] < g[left], right, left)

    while 2 * have <= want:
        at, have = first_least(at[:-have], at[have:]), 2 * have
    if want > have:
        at = first_least(at[: len(at) - (want - have)], at[want - have :])
    start = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return g[at[start]].view(np.int64), start, np.diff(np.r_[start, len(at)])


def repeats(words: np.ndarray, starts: np.ndarray, size: int, times: np.ndarray | None = None) -> np.ndarray:
    """Which starts lead a window that another start leads too, or that stands several times: leaves of nodes at depth size.

    words: word codes of all runs, end to end. Ranks of depth 2k come from two ranks of depth k.
    """
    rank, depth = np.unique(words, return_inverse=True)[1].astype(np.int64), 1
    while 2 * depth <= size:
        pair = rank[:-depth] * len(rank) + rank[depth:]
        rank, depth = np.unique(pair, return_inverse=True)[1], 2 * depth
    node = rank[starts] * len(words) + rank[starts + size - depth]
    _, leaf = np.unique(node, return_inverse=True)
    return np.bincount(leaf, times)[leaf] > 1


def _keyed(docs: DataFrame) -> DataFrame:
    """__hf_id and __hf_text name a row by its content; null ids share a name of their own."""
    return docs.withColumn("__hf_id", F.coalesce("doc_id", F.lit(NO_ID))).withColumn("__hf_text", F.xxhash64(F.coalesce("text", F.lit(""))))


def _scan(docs: DataFrame, size: int) -> DataFrame:
    """__hf_id, __hf_text, doc_id, n_words, sha256 (of the words joined by a space), runs of every row."""
    kind = pa.list_(pa.struct([("seed", pa.int64()), ("start", pa.int32()), ("n", pa.int32())]))

    @tidied
    def run(batches):
        for b in batches:
            n, sha, found = [], [], []
            for t, words in zip(as_bytes(b.column("text")), Tokens(b.column("text")).rows(), strict=True):
                n.append(len(words))
                sha.append(hashlib.sha256(b" ".join(t.split())).hexdigest())
                found.append(runs(words, size))
            ends = np.cumsum([0, *(len(x[0]) for x in found)])
            flat = [np.concatenate([x[i] for x in found]) if found else np.zeros(0, np.int64) for i in range(3)]
            inner = pa.StructArray.from_arrays([pa.array(flat[0].astype(np.int64)), pa.array(flat[1].astype(np.int32)), pa.array(flat[2].astype(np.int32))], ["seed", "start", "n"])
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), inner).cast(kind)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("__hf_id", "__hf_text", "doc_id")), pa.array(n, pa.int64()), pa.array(sha, pa.string()), lists], ["__hf_id", "__hf_text", "doc_id", "n_words", "sha256", "runs"])

    return _keyed(docs).select("__hf_id", "__hf_text", "doc_id", "text").mapInArrow(run, "__hf_id long, __hf_text long, doc_id long, n_words long, sha256 string, runs array<struct<seed:long,start:int,n:int>>")


def _cold(rows: DataFrame, size: int) -> DataFrame:
    """rows: seed, one, two, times, words. For groups that fit in memory: one, two, marked (spans of windows, from the run's start)."""

    def tree(part: list) -> pa.RecordBatch:
        codes = [r[4] for r in part]
        n = np.array([len(c) for c in codes])
        windows_ = n - size + 1
        first = np.cumsum(n) - n
        owner = np.repeat(np.arange(len(part)), windows_)
        place = np.arange(windows_.sum()) - np.repeat(np.cumsum(windows_) - windows_, windows_)
        times = np.repeat(np.array([r[3] for r in part], np.float64), windows_)
        hit = repeats(np.concatenate(codes), first[owner] + place, size, times)
        return _spans(owner[hit], place[hit], [r[1] for r in part], [r[2] for r in part])

    @tidied
    def run(batches):
        held, words = [], 0
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("seed", "one", "two", "times")), Tokens(b.column("words")).rows(), strict=True):
                if words >= WORDS and row[0] != held[-1][0]:
                    yield tree(held)
                    held, words = [], 0
                held.append(row)
                words += len(row[4])
        if held:
            yield tree(held)

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select("seed", "one", "two", "times", "words").repartition(n, "seed").sortWithinPartitions("seed")
    return dealt.mapInArrow(run, MARKED)


MARKED = "one long, two long, start int, end int"


def _spans(owner: np.ndarray, place: np.ndarray, one: list, two: list) -> pa.RecordBatch:
    """Neighbouring marked windows of a run as one row: first and last + 1."""
    first = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (place[1:] != place[:-1] + 1)]) if len(owner) else np.zeros(0, np.int64)
    last = np.r_[first[1:], len(owner)] - 1 if len(first) else first
    at = owner[first].tolist()
    return pa.RecordBatch.from_arrays([pa.array([one[i] for i in at], pa.int64()), pa.array([two[i] for i in at], pa.int64()), pa.array(place[first].astype(np.int32)), pa.array((place[last] + 1).astype(np.int32))], ["one", "two", "start", "end"])


def _hot(rows: DataFrame, size: int) -> DataFrame:
    """The same for the other groups, by counts of whole windows."""

    @tidied
    def run(batches):
        for b in batches:
            out = [[] for _ in range(6)]
            for one, two, times, h in zip(*(b.column(c).to_pylist() for c in ("one", "two", "times")), Tokens(b.column("words")).rows(), strict=True):
                x, y = windows(h, size).view(np.int64), windows(mix(h), size).view(np.int64)
                for c, v in zip(out, (np.full(len(x), one), np.full(len(x), two), np.full(len(x), times), np.arange(len(x)), x, y), strict=True):
                    c.append(v)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in out], ["one", "two", "times", "start", "x", "y"])

    found = rows.select("one", "two", "times", "words").mapInArrow(run, "one long, two long, times long, start long, x long, y long")
    often = found.groupBy("x", "y").agg(F.sum("times").alias("n")).where("n > 1").select("x", "y")
    hit = found.join(often, ["x", "y"], "left_semi")
    return hit.select("one", "two", F.col("start").cast("int"), (F.col("start") + 1).cast("int").alias("end"))


def spans(docs: DataFrame, scratch: Scratch, size: int = SIZE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The scan of all rows; the texts of rows with a repeated seed; the spans to remove (__hf_id, __hf_text, spans)."""
    scan = scratch.keep(_scan(docs, size), "scan")
    seeds = scan.select("__hf_id", "__hf_text", F.explode("runs").alias("r")).select("__hf_id", "__hf_text", "r.*")
    often = seeds.groupBy("seed").agg(F.count("*").alias("n_runs")).where("n_runs > 1").select("seed")
    chosen = seeds.join(often, "seed").select("__hf_id", "__hf_text", F.struct("seed", "start", "n").alias("r"))
    by_row = chosen.groupBy("__hf_id", "__hf_text").agg(F.collect_set("r").alias("runs"))
    texts = scratch.keep(_keyed(docs).select("__hf_id", "__hf_text", "text").join(by_row.hint("merge"), ["__hf_id", "__hf_text"]), "texts")

    @tidied
    def cut(batches):
        for b in batches:
            runs_ = b.column("runs")
            inner = runs_.flatten()
            n_runs = np.diff(runs_.offsets.to_numpy())
            start, n = (inner.field(f).to_numpy() for f in ("start", "n"))
            words, one, two, at = [], [], [], 0
            for text, k in zip(as_bytes(b.column("text")), n_runs.tolist(), strict=True):
                own = text.split()
                for i, m in zip(start[at : at + k].tolist(), n[at : at + k].tolist(), strict=True):
                    run = b" ".join(own[i : i + m + size - 1])
                    words.append(run)
                    one.append(xxhash.xxh3_64_intdigest(run))
                    two.append(xxhash.xxh3_64_intdigest(run, 7))
                at += k
            ids = [pa.array(np.repeat(b.column(c).to_numpy(zero_copy_only=False), n_runs)) for c in ("__hf_id", "__hf_text")]
            names = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (one, two)]
            yield pa.RecordBatch.from_arrays([*ids, inner.field("seed"), pa.array(start), *names, pa.array(words, pa.binary())], ["__hf_id", "__hf_text", "seed", "start", "one", "two", "words"])

    rows = scratch.keep(texts.mapInArrow(cut, "__hf_id long, __hf_text long, seed long, start int, one long, two long, words binary"), "runs")
    # equal runs once; their words come along once a task
    different = rows.groupBy("seed", "one", "two").agg(F.count("*").alias("times"), F.first("words").alias("words"))
    different = scratch.keep(different, "different")
    size_of = different.groupBy("seed").agg(F.count("*").alias("n"), F.sum("times").alias("all")).where("all > 1")
    # at most one seed in HOT runs is hot, so this side is small beside the other, and is broadcast only if it is small at all
    hot = size_of.where(F.col("n") > HOT).select("seed")
    cold = different.join(hot, "seed", "left_anti")
    marked = _cold(cold, size).union(_hot(different.join(hot, "seed", "left_semi"), size))
    marked = marked.groupBy("one", "two").agg(F.collect_list(F.struct("start", "end")).alias("marks"))
    placed = rows.select("__hf_id", "__hf_text", "one", "two", F.col("start").alias("run")).join(marked, ["one", "two"])
    moved = F.transform("marks", lambda m: F.struct((m["start"] + F.col("run")).alias("start"), (m["end"] + F.col("run") + size - 1).alias("end")))
    out = scratch.keep(placed.select("__hf_id", "__hf_text", moved.alias("s")).groupBy("__hf_id", "__hf_text").agg(F.flatten(F.collect_set("s")).alias("spans")), "spans")
    scratch.drop("runs", "different")
    return scan, texts, out


def strip(text: bytes, found: list) -> tuple[list, int]:
    """The words that no span covers, and the number of the others."""
    words = text.split()
    keep = np.ones(len(words), np.bool_)
    for s in found:
        keep[s["start"] : s["end"]] = False
    return [w for w, k in zip(words, keep.tolist(), strict=True) if k], int(len(words) - keep.sum())


def remove_repeats(docs: DataFrame, scratch: Scratch, size: int = SIZE) -> DataFrame:
    """docs with the repeated words out of text (the rest joined by one space); texts without any stay as they are."""
    names, schema = docs.columns, docs.schema
    _, _, found = spans(docs.select("doc_id", "text"), scratch, size)

    @tidied
    def run(batches):
        for b in batches:
            out = []
            for t, s in zip(b.column("text").to_pylist(), b.column("__hf_spans").to_pylist(), strict=True):
                out.append(b" ".join(strip(t.encode(), s)[0]).decode() if s else t)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if c == "text" else b.column(c) for c in names], names)

    found = found.withColumnRenamed("spans", "__hf_spans")
    joined = _keyed(docs).join(found, ["__hf_id", "__hf_text"], "left").select(*names, "__hf_spans")
    return joined.mapInArrow(run, StructType([StructField("text", StringType()) if f.name == "text" else f for f in schema.fields]))


def op4_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    scan, texts, found = spans(table(spark, sf_dir, "documents").select("doc_id", "text"), Scratch(spark, "op4"))

    @tidied
    def run(batches):
        for b in batches:
            n, sha = [], []
            for t, s in zip(as_bytes(b.column("text")), b.column("spans").to_pylist(), strict=True):
                kept, removed = strip(t, s)
                n.append(removed)
                sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("__hf_id"), b.column("__hf_text"), pa.array(n, pa.int64()), pa.array(sha, pa.string())], ["__hf_id", "__hf_text", "n_removed", "kept_sha256"])

    changed = texts.select("__hf_id", "__hf_text", "text").dropDuplicates(["__hf_id", "__hf_text"]).join(found, ["__hf_id", "__hf_text"]).mapInArrow(run, "__hf_id long, __hf_text long, n_removed long, kept_sha256 string")
    out = scan.select("__hf_id", "__hf_text", "doc_id", "n_words", "sha256").join(changed, ["__hf_id", "__hf_text"], "left")
    return out.select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("kept_sha256", "sha256").alias("kept_sha256"))


ORACLE = r"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, coalesce(list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> ''), []) AS ws FROM documents),
n AS (SELECT r, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35),
k AS (SELECT n.r, n.i, md5(array_to_string(ws[n.i:n.i+34], ' ')) AS h FROM n JOIN w ON w.r = n.r),
d AS (SELECT h FROM k GROUP BY h HAVING count(*) > 1),
s AS (SELECT k.r, list(k.i) AS st FROM k JOIN d ON d.h = k.h GROUP BY k.r),
c AS (SELECT r, list_distinct(flatten(list_transform(st, lambda i: range(i, i + 35)))) AS cov FROM s),
o AS (SELECT w.doc_id, w.ws, coalesce(c.cov, []) AS cov FROM w LEFT JOIN c ON c.r = w.r),
p AS (SELECT doc_id, ws, cov, CASE WHEN len(cov) = 0 THEN ws ELSE list_transform(list_sort(list_filter(range(1, len(ws) + 1), lambda j: NOT list_contains(cov, j))), lambda j: ws[j]) END AS kept FROM o)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(cov) AS BIGINT) AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM p
"""
