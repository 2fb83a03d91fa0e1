"""Helpers shared by the corpus operators: scratch tables, word hashing, session settings."""

import ctypes
import functools
import gc
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_U = np.uint64
#: Bytes whose words are hashed at once; words longer than LONG are hashed one by one.
PIECE, LONG = 1 << 20, 1 << 16
#: Bytes of an Arrow batch, about.
BATCH = 4 << 20
#: Stands for a null doc_id.
NO_ID = -(1 << 63)
_own_scratch: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession, rows: int = 500, size: int = BATCH) -> None:
    """Keeps the Arrow batches that reach Python workers small, in rows and in bytes: texts may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir); a folder of our own only where that is unset."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        app = spark.sparkContext.applicationId
        if app not in _own_scratch:
            _own_scratch[app] = tempfile.mkdtemp(prefix="headerflow-")
        root = _own_scratch[app]
    return root.rstrip("/")


class Scratch:
    """Tables written once to the shared folder, which cut the lineage and outlive lost executors."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base = spark, f"{scratch_root(spark)}/headerflow/{name}-{uuid.uuid4().hex[:12]}"

    def keep(self, df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
        path = f"{self.base}/{name}"
        df.write.mode("overwrite").parquet(path, compression=codec)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Deletes tables that no later stage reads."""
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        for name in names:
            path = hadoop.Path(f"{self.base}/{name}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fraction(*cols):
    """A column in [0, 1) that depends on the given columns alone."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 30)) / F.lit(float(1 << 30))


def crc_mod(col, m: int):
    return F.crc32(F.col(col).cast("string").cast("binary")) % m if isinstance(col, str) else F.crc32(col.cast("string").cast("binary")) % m


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of all runs of k words; none if there are fewer."""
    n = len(h) - k + 1
    if n < 1:
        return h[:0]
    out = h[:n].copy()
    for i in range(1, k):
        out *= _U(0x9E3779B97F4A7C15)
        out += h[i : n + i]
    return mix(out)


def as_bytes(column) -> list:
    """An Arrow string column as bytes; null as empty."""
    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


def _powers(p: int) -> np.ndarray:
    out = np.full(PIECE + LONG, p, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
#: Random numbers for each byte; the first with A-Z as a-z.
_OF_BYTE, _OF_BYTE_2 = np.random.default_rng(20240301).integers(1, 2**64, (2, 256), dtype=np.uint64)
_OF_LOWER = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.roll(_OF_BYTE, -32), _OF_BYTE)
_BASE = 0x9E3779B97F4A7C15
_POWER, _INVERSE = _powers(_BASE), _powers(pow(_BASE, -1, 2**64))


def _hash_spans(raw: np.ndarray, start: np.ndarray, end: np.ndarray, of: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of raw, which ascend; of says each byte's number. Those longer than LONG are for the caller."""
    out = np.empty(len(start), np.uint64)
    cuts = np.searchsorted(start, np.arange(0, len(raw) + PIECE, PIECE))
    cuts[-1] = len(start)
    sums = np.zeros(min(PIECE + LONG, len(raw)) + 1, np.uint64)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if a == b:
            continue
        base = int(start[a])
        n = min(int(end[b - 1]) - base, PIECE + LONG)
        s, e = start[a:b] - base, np.minimum(end[a:b] - base, n)
        part = of[raw[base : base + n]]
        part *= _POWER[:n]
        np.cumsum(part, out=sums[1 : n + 1])
        h = sums[e] - sums[s]
        h *= _INVERSE[np.minimum(s, PIECE + LONG - 1)]
        out[a:b] = mix(h + (e - s).astype(np.uint64))
    return out


def value_hashes(column) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each value of an Arrow string column without nulls."""
    column = column.cast(pa.large_binary())
    at = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset) if len(column) else np.zeros(1, np.int64)
    raw = column.buffers()[2]
    raw = np.frombuffer(raw, np.uint8, at[-1] - at[0], at[0]) if raw is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    at = at - at[0]
    out = [_hash_spans(raw, at[:-1], at[1:], of) for of in (_OF_BYTE, _OF_BYTE_2)]
    for i in np.flatnonzero(np.diff(at) > LONG).tolist():
        for h, seed in zip(out, (0, 7), strict=True):
            h[i] = xxhash.xxh3_64_intdigest(raw[at[i] : at[i + 1]].tobytes(), seed)
    return out[0], out[1]


class Coded:
    """A bounded cache from pieces of text, known by a 128-bit hash, to their ids; in arrays, some 40 bytes a piece.

    A piece without ids is one that has none of its own. When the cache is full, the half that was used longest ago goes.
    """

    def __init__(self, kind=np.uint16, most: int = 800_000):
        self.kind, self.most, self.time = kind, most, 0
        self.clear()

    def clear(self) -> None:
        self.one, self.two, self.at = (np.zeros(0, k) for k in (np.uint64, np.uint64, np.int64))
        self.n, self.used, self.ids = np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, self.kind)

    def find(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """The place of each piece, -1 if it is not there. Places hold until the next add()."""
        if not len(self.one):
            return np.full(len(one), -1)
        order = np.argsort(one)  # in this order the search touches neighbouring memory
        at = np.empty(len(one), np.int64)
        at[order] = np.minimum(np.searchsorted(self.one, one[order]), len(self.one) - 1)
        hit = (self.one[at] == one) & (self.two[at] == two)
        self.used[at[hit]] = self.time
        return np.where(hit, at, -1)

    def add(self, one: np.ndarray, two: np.ndarray, ids: list[bytes]) -> None:
        n = np.array([len(x) for x in ids], np.int32) // self.ids.itemsize
        self.add_flat(one, two, np.frombuffer(b"".join(ids), self.kind), n)

    def add_flat(self, one: np.ndarray, two: np.ndarray, ids: np.ndarray, n: np.ndarray) -> None:
        """ids: those of all pieces, end to end; n: the number of each one's."""
        self.time += 1
        if len(self.one) > self.most:
            keep = np.flatnonzero(self.used >= max(np.partition(self.used, len(self.used) // 2)[len(self.used) // 2], 1))
            self.ids = _slices(self.ids, self.at[keep], self.n[keep])
            self.one, self.two, self.n, self.used = (x[keep] for x in (self.one, self.two, self.n, self.used))
            self.at = np.cumsum(self.n, dtype=np.int64) - self.n
        order = np.argsort(one, kind="stable")
        start = len(self.ids) + np.cumsum(n, dtype=np.int64) - n
        self.ids = np.concatenate([self.ids, ids])
        to = np.searchsorted(self.one, one[order])
        now = np.full(len(one), self.time, np.int32)
        self.one, self.two, self.at, self.n, self.used = (np.insert(x, to, y[order]) for x, y in ((self.one, one), (self.two, two), (self.at, start), (self.n, n), (self.used, now)))

    def gather(self, places: np.ndarray) -> np.ndarray:
        """The ids of pieces at these places, end to end."""
        return _slices(self.ids, self.at[places], self.n[places])


def _slices(values: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Slices of values, end to end."""
    ends = np.cumsum(n, dtype=np.int64)
    if not len(n) or not ends[-1]:
        return values[:0].copy()
    kind = np.int32 if max(len(values), ends[-1]) < 1 << 31 else np.int64
    at = np.repeat((start - (ends - n)).astype(kind), n)
    at += np.arange(len(at), dtype=kind)
    return values[at]


class Tokens:
    """The words `[^\\x20\\x09-\\x0D]+` of an Arrow string column, all in one go.

    hashes: 64-bit hash of each word (lower: of the word with A-Z lower-cased); start, end: its place in raw; first: of each row its
    first word, and then the number of words. A word's hash is a polynomial over its bytes' random numbers, taken from sums
    over the whole buffer, so there is no loop over words and no cache.
    """

    def __init__(self, column, lower: bool = False):
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"").cast(pa.large_binary())
        at = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset) if len(column) else np.zeros(1, np.int64)
        raw = column.buffers()[2]
        self.raw = raw = np.frombuffer(raw, np.uint8, at[-1] - at[0], at[0]) if raw is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
        at = at - at[0]
        word = ~_SPACE[raw]
        opens, ends = word.copy(), word.copy()
        opens[1:] &= ~word[:-1]
        ends[:-1] &= ~word[1:]
        low, high = at[:-1][at[:-1] < len(raw)], at[1:][at[1:] > 0] - 1
        opens[low] |= word[low]  # rows lie end to end
        ends[high] |= word[high]
        self.start, self.end = np.flatnonzero(opens), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, at)
        self.lower = lower
        self.hashes = _hash_spans(raw, self.start, self.end, _OF_LOWER if lower else _OF_BYTE)
        for i in np.flatnonzero(self.end - self.start > LONG).tolist():
            self.hashes[i] = xxhash.xxh3_64_intdigest(self.word(i))

    def word(self, i: int) -> bytes:
        out = self.raw[self.start[i] : self.end[i]].tobytes()
        return out.lower() if self.lower else out

    def words(self, which: np.ndarray) -> list[bytes]:
        """The words at the given places."""
        raw = self.raw.tobytes()
        raw = raw.lower() if self.lower else raw
        return [raw[a:b] for a, b in zip(self.start[which].tolist(), self.end[which].tolist(), strict=True)]

    def rows(self):
        """The hashes of each row."""
        at = self.first.tolist()
        for a, b in zip(at[:-1], at[1:], strict=True):
            yield self.hashes[a:b]


def word_hashes(words: list) -> np.ndarray:
    """The same hashes for words given one by one."""
    return Tokens(pa.array([b" ".join(words)], pa.large_binary())).hashes


_libc = None


def tidy() -> None:
    """Gives back what a task's batches took, so that a reused worker holds nothing of the tasks before."""
    global _libc
    gc.collect()
    pa.default_memory_pool().release_unused()
    if _libc is None:
        try:
            _libc = ctypes.CDLL("libc.so.6")
        except OSError:
            _libc = False
    if _libc:
        _libc.malloc_trim(0)


def tidied(run):
    """A function over Arrow batches that tidies up as its task ends."""

    @functools.wraps(run)
    def out(batches):
        try:
            yield from run(batches)
        finally:
            tidy()

    return out
