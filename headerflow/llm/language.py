"""Language identification by a string kernel.

A text is the set of its character 1-, 2- and 3-grams (presence, blended spectrum). The kernel of two texts is the number of
shared n-grams over the geometric mean of their set sizes. A bounded sample of labelled texts gives Nystroem landmarks; in the
landmark space one ridge regression a language (one versus rest) is fitted on the sample. Every text is scored by two matrix
products a batch: its n-grams with those of the landmarks, and the kernel rows with the dual weights.

Texts that are null or have no letter: `und`, score 0. Ties go to the first language in order. No labelled rows at all: `und`.
The score is the winning regression's value (targets -1 and 1) brought to 0..1.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, crc_mod, fraction, table

#: Labelled texts a language that the fit sees at most, how many of these are landmarks, and the ridge.
FIT, LANDMARKS, RIDGE = 300, 48, 1e-2
#: Texts of a batch whose kernel rows are computed at once.
BLOCK = 128
#: Codes of a character class; 0 is every non-letter.
BITS = 6
_classes = None


def classes() -> np.ndarray:
    """Class of each code point below 0x10000: letters a-z apart, other letters by their lower case's low bits, the rest 0."""
    global _classes
    if _classes is None:
        _classes = np.array([_class(c) for c in range(0x10000)], np.uint32)
    return _classes


def _class(point: int) -> int:
    """0: no letter; 1-26: a-z; the others by their code point."""
    if not (s := chr(point)).isalpha():
        return 0
    low = s.lower()[0]
    return ord(low) - 96 if "a" <= low <= "z" else 27 + ord(low) % 37


def grams(text: str) -> np.ndarray | None:
    """Codes of all 1-, 2- and 3-grams in order of place (repeats included); None without a letter."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    c = classes()[np.minimum(points, 0xFFFF)]
    high = np.flatnonzero(points > 0xFFFF)  # rare: looked up one by one
    if len(high):
        c[high] = [_class(p) for p in points[high].tolist()]
    if not c.any():
        return None
    # runs of non-letters count as one
    keep = (c > 0) | np.r_[True, c[:-1] > 0]
    c = np.concatenate([np.zeros(1, np.uint32), c[keep], np.zeros(1, np.uint32)])
    two = (c[:-1] << BITS) | c[1:]
    three = (two[:-1] << BITS) | c[2:]
    return np.concatenate([c, two + 64, three + (64 + 4096)])


SPACE = 64 + 4096 + 262144


class Model:
    """Landmark n-grams and dual weights; a few MB, whatever the corpus."""

    def __init__(self, texts: list[str], labels: list[str]):
        rows = [(g, y) for t, y in zip(texts, labels, strict=True) if (g := grams(t)) is not None]
        self.langs = sorted({y for _, y in rows})
        picked, seen = [], dict.fromkeys(self.langs, 0)
        for i, (_, y) in enumerate(rows):
            if seen[y] < LANDMARKS:
                picked.append(i)
                seen[y] += 1
        self.column = np.zeros(SPACE, np.int32)
        if not rows:
            self.landmarks = np.zeros((0, 0), np.float32)
            return
        known = np.unique(np.concatenate([rows[i][0] for i in picked]))
        self.column[known] = np.arange(1, len(known) + 1)
        self.width = len(known) + 1
        self.landmarks = np.zeros((len(picked), self.width), np.float32)
        for j, i in enumerate(picked):
            self.landmarks[j, self.column[rows[i][0]]] = 1
        self.landmarks[:, 0] = 0
        self.landmarks /= np.sqrt(np.maximum(1, self.landmarks.sum(1, keepdims=True)))
        k = np.concatenate([self.kernel([g for g, _ in rows[a : a + BLOCK]]) for a in range(0, len(rows), BLOCK)]).astype(np.float64)
        value, vector = np.linalg.eigh(k[picked])
        good = value > 1e-6 * value.max()
        root = vector[:, good] / np.sqrt(value[good])
        z = np.c_[k @ root, np.ones(len(rows))]
        target = np.array([[1.0 if y == c else -1.0 for c in self.langs] for _, y in rows])
        # each language weighs the same, however many of its texts were drawn
        share = np.array([1 / sum(y == c for _, y in rows) for c in self.langs])
        w = np.array([share[self.langs.index(y)] for _, y in rows])[:, None] * len(rows) / len(self.langs)
        ridge = RIDGE * len(rows) * np.eye(z.shape[1])
        ridge[-1, -1] = 1e-9
        beta = np.linalg.solve(z.T @ (w * z) + ridge, z.T @ (w * target))
        self.dual = (root @ beta[:-1]).astype(np.float32)
        self.shift = beta[-1].astype(np.float32)

    def kernel(self, sets: list[np.ndarray]) -> np.ndarray:
        """Rows: texts; columns: landmarks."""
        here = np.zeros((len(sets), self.width), np.float32)
        flags = np.zeros(SPACE, np.bool_)
        size = np.empty(len(sets), np.float32)
        for i, g in enumerate(sets):
            here[i, self.column[g]] = 1
            flags[g] = True
            size[i] = np.count_nonzero(flags)
            flags[g] = False
        return (here @ self.landmarks.T) / np.sqrt(size)[:, None]

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        langs, scores = ["und"] * len(texts), np.zeros(len(texts))
        if len(self.landmarks):
            sets = [(i, g) for i, t in enumerate(texts) if t and (g := grams(t)) is not None]
            for a in range(0, len(sets), BLOCK):
                part = sets[a : a + BLOCK]
                f = self.kernel([g for _, g in part]) @ self.dual + self.shift
                best = f.argmax(1)
                for (i, _), b, v in zip(part, best, f[np.arange(len(part)), best], strict=True):
                    langs[i], scores[i] = self.langs[b], min(1.0, max(0.0, (float(v) + 1) / 2))
        return langs, scores


def fit(rows: DataFrame, label: str = "lang") -> Model:
    """rows: doc_id, text, label. At most FIT texts of each label are drawn, by a hash of the id."""
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    limit = F.lit(0.0)
    for c, n in counts.items():
        limit = F.when(F.col(label) == c, F.lit(1.5 * FIT / n + 1e-9)).otherwise(limit)
    drawn = rows.where(fraction("doc_id", F.lit(5)) < limit).select("doc_id", "text", label).toPandas().sort_values("doc_id", kind="stable")
    drawn = drawn.sample(frac=1, random_state=7).groupby(label).head(FIT) if len(drawn) else drawn
    return Model(drawn["text"].tolist(), drawn[label].tolist())


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            langs, scores = shared.value.predict(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where((crc_mod("doc_id", 3) != 1) & F.col("lang").isNotNull() & F.col("text").isNotNull()))
    return identify(docs, model).select("doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")
