"""Quality by nearest-neighbour voting.

A text is a bag of hashed byte 3-grams and of a few terms that say how often its words repeat. A bounded, class-balanced sample
of labelled texts gives inverse document frequencies, a truncated singular value decomposition (latent-semantic axes) and the
labelled vectors, which are broadcast (a few MB, whatever the corpus). Every document's cosine with every labelled vector is
computed in blocks; the labels of the nearest vote, weighted by similarity.

Empty and null texts have terms too (of an empty text) and get a score. No labelled rows: every score is 1. Each row is scored by its
text alone, so repeated rows get equal scores; an empty table gives an empty result; other columns pass through unread. Ties among equal
similarities are of no account: all vectors as near as the K-th vote.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import as_bytes, bounded_batches, crc_mod, fraction, table, tidied

#: Labelled texts of each class that the fit sees at most; latent axes; voters; sharpness of the weights.
FIT, AXES, K, SHARP = 1500, 48, 15, 8
#: Hashed 3-grams, and terms of repetition after them.
GRAMS, TERMS = 4096, 64
BLOCK = 128
ACCEPT = 0.3
#: The column that judge() adds; a reserved name.
SCORE = "__hf_score"


def accepted(docs: DataFrame, model: "Model") -> DataFrame:
    """The rows of docs that are accepted, whole."""
    return judge(docs, model).where(F.col(SCORE) >= ACCEPT).select(*docs.columns)


def bag(text: bytes) -> np.ndarray:
    """Logarithmic counts, each part of length 1."""
    out = np.zeros(GRAMS + TERMS, np.float32)
    b = np.frombuffer(b" " + text + b" ", np.uint8).astype(np.uint32)
    if len(b) > 2:
        code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
        code = (code * np.uint32(2654435761)) >> np.uint32(20)
        n = np.bincount(code, minlength=GRAMS)
        out[:GRAMS] = np.log1p(n)
        out[:GRAMS] /= np.linalg.norm(out[:GRAMS])
    words = text.split()
    n = len(words)
    pairs = set(zip(words, words[1:], strict=False))
    lines = text.split(b"\n")
    points = (
        len(set(words)) / n if n else 0,
        len(pairs) / max(1, n - 1) if n > 1 else 1,
        len(set(lines)) / len(lines),
        min(1.0, n / 50),
        float(((b >= 65) & (b <= 90)).mean()),
        float(((b >= 33) & (b <= 47)).mean()),
        float(((b >= 48) & (b <= 57)).mean()),
        min(1.0, float(np.mean([len(w) for w in words])) / 16) if n else 0,
    )
    for i, p in enumerate(points):  # each point is shared by the two nearest of 8 terms
        at = min(max(p, 0.0), 1.0) * 7
        low = int(at)
        out[GRAMS + 8 * i + low] = 1 - (at - low)
        if low < 7:
            out[GRAMS + 8 * i + low + 1] = at - low
    return out


class Model:
    def __init__(self, texts: list[bytes], labels: list[int]):
        self.labels = np.array(labels, np.float32)
        if not len(labels):
            return
        x = np.stack([bag(t) for t in texts])
        self.weight = np.log((1 + len(x)) / (1 + (x > 0).sum(0))).astype(np.float32) + 0.1
        self.weight[GRAMS:] = 0.5
        x *= self.weight
        # truncated SVD by subspace iteration from a fixed start
        q = np.random.default_rng(11).standard_normal((x.shape[1], AXES + 8)).astype(np.float32)
        for _ in range(6):
            q, _ = np.linalg.qr(x.T @ (x @ q))
        _, _, v = np.linalg.svd(x @ q, full_matrices=False)
        self.axes = np.ascontiguousarray((q @ v.T)[:, :AXES])
        self.vectors = self.latent(x)

    def latent(self, weighted: np.ndarray) -> np.ndarray:
        z = weighted @ self.axes
        return z / np.maximum(1e-9, np.linalg.norm(z, axis=1, keepdims=True))

    def score(self, texts: list[bytes]) -> np.ndarray:
        out = np.ones(len(texts))
        if not len(self.labels):
            return out
        k = min(K, len(self.labels))
        for a in range(0, len(texts), BLOCK):
            x = np.stack([bag(t) for t in texts[a : a + BLOCK]]) * self.weight
            near = self.latent(x) @ self.vectors.T
            last = np.partition(near, len(self.labels) - k, axis=1)[:, -k, None]
            w = np.where(near >= last, np.clip(near, 1e-6, 1) ** SHARP, 0)
            out[a : a + BLOCK] = np.clip((w @ self.labels) / w.sum(1), 0, 1)
        return out


def judge(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of docs and SCORE."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @tidied
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shared.value.score(as_bytes(b.column("text"))))], [*b.schema.names, SCORE])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(SCORE, DoubleType())]))


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Model:
    """Learns from the labelled rows outside the held-out fold."""
    labels = table(spark, sf_dir, "labels").where((crc_mod("doc_id", 5) != 0) & F.col("quality").isNotNull())
    labels = labels.select("doc_id", F.col("quality").cast("int").alias("label"))
    # drawn by a hash of the id, a little more than FIT of each class, and cut to that number once they are here
    n = {r[0]: r[1] for r in labels.groupBy("label").count().collect()}
    limit = F.lit(0.0)
    for c, k in n.items():
        limit = F.when(F.col("label") == c, F.lit(1.3 * FIT / k + 1e-9)).otherwise(limit)
    few = labels.where(fraction("doc_id", F.lit(9)) < limit)
    rows = docs.select("doc_id", "text").join(F.broadcast(few), "doc_id")  # about 2.6 * FIT rows, by the rule above
    drawn = rows.toPandas().sort_values("doc_id", kind="stable")
    drawn = drawn.sample(frac=1, random_state=7).groupby("label").head(FIT) if len(drawn) else drawn
    return Model([(t or "").encode() for t in drawn["text"]], drawn["label"].astype(int).tolist())


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs = table(spark, sf_dir, "documents")
    scored = judge(docs.select("doc_id", "text"), quality_model(spark, docs, sf_dir))
    return scored.select("doc_id", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"), F.col(SCORE).alias("score"), F.when(F.col(SCORE) >= ACCEPT, 1).otherwise(0).alias("predicted"))
