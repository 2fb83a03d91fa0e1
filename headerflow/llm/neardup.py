"""Near duplicates by b-bit MinHash.

A text's set is that of its 5-word shingles (words split at ASCII white space, A-Z lower-cased), each as a 64-bit hash. The
range of hashes is cut into 1024 bins; the least hash of each bin is a minimum, and an empty bin takes that of another one, in an
order drawn for it once and for all, so that each bin agrees with the probability of the similarity. 48 bands of 5 whole minima
give candidates; the low 4 bits of all minima are packed into a 512-byte signature, whose agreement, corrected for chance
collisions, estimates the similarity by bit counts. Pairs estimated far below the threshold are dropped, the others are confirmed
on their full sets.

In a set of few shingles one that shares its bin with a lesser one is lost to all bins, which moves minima and estimate far. So
texts of up to SMALL shingles carry their set: two of them are compared by it, whatever the estimate. Their bands are of minima
that each hash the whole set anew. Similar sets differ in size by the threshold at most, so a pair with a larger set has FEW
shingles on either side; texts of FEW to SMALL shingles have bands of both kinds.

Texts with equal sets form a class first, a node of the graph of links. Links are sought in steps. First each node is held against
one other only: of the least members of its buckets the one that it shares most buckets with. Then, in the buckets whose members
are not yet in one component, pairs of different components are estimated, block against block, so that no task holds a whole
bucket; members of a bucket's largest component meet only the others. Of the likely pairs that come together each component
first gives its best one; when these are confirmed and joined, all likely pairs that still lead from one component to another
are confirmed. A pair in one component already needs no check, as it can add no connection.

A band misses a pair of similarity 0.75 with (1 - 0.75^5); all 48 do with 2e-6.

Null and empty texts have an empty set: no link, a component of their own. Fewer than 5 words: the whole sequence is the one
shingle. A doc_id names one document: rows that repeat it with different texts are linked by it, and share a component. Rows
without a doc_id are documents that take part in links; their component is the least doc_id in it, null if none has any, and
only then they count as kept. Ties do not matter: the least doc_id decides. An empty table gives an empty result. Columns of
the input other than doc_id and text are unread.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import NO_ID, Scratch, Tokens, bounded_batches, mix, table, tidied, windows

WORDS, HASHES, BITS, BANDS, ROWS = 5, 1024, 4, 48, 5
#: Pairs of a hub that meet its set at once.
HUB = 256
#: Steps in which labels may come to rest; each doubles the reach at least.
STEPS = 200
#: A pair is linked from PART of WHOLE on; an estimate below LEAST is a miss beyond doubt.
PART, WHOLE, LEAST = 75, 100, 0.66
#: Sets up to SMALL are carried; FEW is the least set that is similar to a larger one.
SMALL, FEW = 85, 64
#: Members of a bucket that a task holds at once; rows of meetings and pairs that it looks at in one go.
BLOCK, ROWS_HELD, PAIRS_HELD = 256, 4_000, 4_000
#: For each bin the order in which it looks for another one that is not empty; a row a step.
_LENDERS = np.ascontiguousarray(np.random.default_rng(20240229).permuted(np.tile(np.arange(HASHES, dtype=np.int16), (HASHES, 1)), axis=1).T)
#: Of each small-set minimum the odd number that its hashes are multiplied with; what fills up carried sets.
_KEYS = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)
_PAD = np.uint64(2**64 - 1) - np.arange(SMALL, dtype=np.uint64)


def shingles(words: np.ndarray) -> np.ndarray:
    """Distinct shingles as ascending 64-bit hashes, from the hashes of a text's words."""
    return np.unique(windows(words, min(WORDS, len(words)))) if len(words) else words


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """The minimum of each bin, a row a set; sets ascend and are not empty."""
    flat = np.concatenate(sets)
    at = np.repeat(np.arange(len(sets), dtype=np.int32) * HASHES, [len(s) for s in sets]) + (flat >> np.uint64(64 - 10)).astype(np.int32)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    out, full = np.zeros(len(sets) * HASHES, np.uint64), np.zeros(len(sets) * HASHES, np.bool_)
    out[at[first]], full[at[first]] = flat[first], True
    empty = np.flatnonzero(~full).astype(np.int32)
    bin_, step = empty % HASHES, 0
    while len(empty):
        lender = empty - bin_ + _LENDERS[step][bin_]
        found = full[lender]
        out[empty[found]] = out[lender[found]]
        empty, bin_, step = empty[~found], bin_[~found], step + 1
    return out.reshape(-1, HASHES)


def small_minima(s: np.ndarray) -> np.ndarray:
    """For each key the shingle whose product with it is least; s is a small set of hashes."""
    return s[(s[None, :] * _KEYS[:, None]).argmin(axis=1)]


def bands(m: np.ndarray, first: int = 0) -> np.ndarray:
    """A hash of the minima of each band (last axis), not 0."""
    key = np.arange(first + 1, first + BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for r in range(ROWS):
        key = mix(key + m[..., r : BANDS * ROWS : ROWS])
    return np.maximum(key, np.uint64(1)).view(np.int64)


def sketches(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Bands of each set, those of its minima and then those of a small set (0: it has none of the kind), and packed signatures (0 below FEW)."""
    keys, packed = np.zeros((len(sets), 2 * BANDS), np.int64), np.zeros((len(sets), HASHES // 2), np.uint8)
    many = [i for i, s in enumerate(sets) if len(s) >= FEW]
    small = [i for i, s in enumerate(sets) if 0 < len(s) <= SMALL]
    if many:
        m = minima([sets[i] for i in many])
        keys[many, :BANDS], packed[many] = bands(m), pack(m)
    if small:
        keys[small, BANDS:] = bands(np.stack([small_minima(sets[i]) for i in small]), BANDS)
    return keys, packed


def pack(m: np.ndarray) -> np.ndarray:
    """The low 4 bits of the minima, two a byte."""
    low = (m & np.uint64(15)).astype(np.uint8)
    return low[..., ::2] << 4 | low[..., 1::2]


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity from packed signatures (last axis: 64-bit words): equal 4-bit fields, corrected for chance."""
    x = a ^ b
    x |= x >> np.uint64(1)
    x |= x >> np.uint64(2)
    unequal = np.bitwise_count(x & np.uint64(0x1111111111111111)).sum(-1, dtype=np.int32)
    same = 1 - unequal / HASHES
    return (same - 2.0**-BITS) / (1 - 2.0**-BITS)


def _sets(column) -> np.ndarray:
    """Carried sets, one a row, filled up to SMALL."""
    raw = column.to_pylist()
    n = np.array([len(x) // 8 for x in raw], np.int64)
    out = np.tile(_PAD, (len(raw), 1))
    out[np.arange(SMALL) < n[:, None]] = np.frombuffer(b"".join(raw), np.uint64)
    return out


def alike(n: tuple, signatures: tuple, sets: tuple) -> np.ndarray:
    """For each pair (sizes, signatures and carried sets of either side) whether it may be similar: small sets exactly, others by estimate."""
    return likeness(n, signatures, sets) > 0


def likeness(n: tuple, signatures: tuple, sets: tuple) -> np.ndarray:
    """The similarity or its estimate of pairs that may be similar, 0 of others."""
    low, high = np.minimum(*n), np.maximum(*n)
    ok, out = low * WHOLE >= PART * high, np.zeros(len(low))
    small = high <= SMALL
    large = np.flatnonzero(ok & ~small)
    guess = estimate(signatures[0][large], signatures[1][large])
    out[large] = np.where(guess >= LEAST, guess, 0)
    small = np.flatnonzero(ok & small)
    for i in range(0, len(small), 10_000):
        at = small[i : i + 10_000]
        both = np.sort(np.concatenate([sets[0][at], sets[1][at]], axis=1), axis=1)
        both = (both[:, 1:] == both[:, :-1]).sum(axis=1) - (SMALL - high[at])  # without what fills up both
        union = low[at] + high[at] - both
        out[at] = np.where(WHOLE * both >= PART * union, both / np.maximum(union, 1), 0)
    return out


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, text (its hash), n_shingles, set_a, set_b (a 128-bit name of the set), bands, signature, small (the set if it is small)."""

    @tidied
    def run(batches):
        for b in batches:
            sets = [shingles(words) for words in Tokens(b.column("text"), lower=True).rows()]
            n = np.array([len(s) for s in sets], np.int64)
            one = [int(mix(s).sum(dtype=np.uint64).astype(np.int64)) for s in sets]
            two = [int(np.bitwise_xor.reduce(mix(s + np.uint64(0x5851F42D4C957F2D))).astype(np.int64)) if len(s) else 0 for s in sets]
            keys, packed = sketches(sets)
            none = n == 0
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * 2 * BANDS), pa.array(keys.ravel()), mask=pa.array(none))
            sigs = pa.FixedSizeBinaryArray.from_buffers(pa.binary(HASHES // 2), len(n), [None, pa.py_buffer(packed)]).cast(pa.binary())
            small = [s.tobytes() if len(s) <= SMALL else b"" for s in sets]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("hash"), pa.array(n), pa.array(one, pa.int64()), pa.array(two, pa.int64()), lists, sigs, pa.array(small, pa.binary())], ["doc_id", "text", "n_shingles", "set_a", "set_b", "bands", "signature", "small"])

    named = docs.select("doc_id", "text", _text_hash().alias("hash"))
    return named.mapInArrow(run, "doc_id long, text long, n_shingles long, set_a long, set_b long, bands array<long>, signature binary, small binary")


def _text_hash():
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def _id():
    return F.coalesce(F.col("doc_id"), F.lit(NO_ID))


def _u64(column) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, np.uint64).reshape(-1, HASHES * BITS // 64)


def _met(pairs: DataFrame, payload: DataFrame, fields: list[str], run, schema: str) -> DataFrame:
    """Pairs (a, b) with the payload (node, fields) of both: run gets batches in which a row with b null has that of a, for the rows behind it.

    A hub's payload goes along once for HUB pairs, and these are what a task must hold together.
    """
    spark = pairs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hubs = pairs.groupBy("a").agg(F.ceil(F.count("*") / HUB).cast("int").alias("blocks"))
    each = hubs.select(F.col("a").alias("node"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    left = each.join(payload, "node").select(F.col("node").alias("a"), "block", F.lit(None).cast("long").alias("b"), *fields)
    right = pairs.join(hubs, "a").select("a", F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int").alias("block"), "b")
    right = right.join(payload.withColumnRenamed("node", "b"), "b").select("a", "block", "b", *fields)

    @tidied
    def carried(batches):
        hub = None
        for x in batches:
            if hub is not None:
                x = pa.Table.from_batches([hub, x]).combine_chunks().to_batches()[0]
            if not x.num_rows:
                continue
            is_hub = x.column("b").is_null().to_numpy(zero_copy_only=False)
            of = np.maximum.accumulate(np.where(is_hub, np.arange(x.num_rows), 0))
            at = np.flatnonzero(~is_hub)
            hub = x.slice(int(of[-1]), 1)
            if len(at):
                yield from run(x, of[at], at)

    dealt = left.union(right).repartition(n, "a", "block").sortWithinPartitions("a", "block", F.col("b").asc_nulls_first())
    return dealt.mapInArrow(carried, schema)


def _ends(x: pa.RecordBatch, u: np.ndarray, v: np.ndarray, **more) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"a": x.column("a").take(pa.array(u)), "b": x.column("b").take(pa.array(v)), **more})


def likely(pairs: DataFrame, signatures: DataFrame) -> DataFrame:
    """The pairs (a, b) that may be similar; sure: that are, by their small sets."""

    def run(x, u, v):
        n, sig, sets = x.column("n_shingles").to_numpy(), _u64(x.column("signature")), _sets(x.column("small"))
        ok = alike((n[u], n[v]), (sig[u], sig[v]), (sets[u], sets[v]))
        u, v = u[ok], v[ok]
        yield _ends(x, u, v, sure=pa.array(np.maximum(n[u], n[v]) <= SMALL))

    return _met(pairs, signatures, ["n_shingles", "signature", "small"], run, "a long, b long, sure boolean")


def confirm(pairs: DataFrame, docs: DataFrame, who: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """The links among pairs (a, b, sure): the sure ones and those whose full sets are similar enough. who: node, doc_id, text, set_a, set_b of each node.

    Sets are made anew for the nodes that stand in a pair only. Their texts are found by a shuffled join at every size, as their
    number grows with the corpus.
    """

    @tidied
    def sets(batches):
        for b in batches:
            full = [shingles(w).tobytes() for w in Tokens(b.column("text"), lower=True).rows()]
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(full, pa.binary())], ["node", "set"])

    def run(x, u, v):
        full = [np.frombuffer(s, np.uint64) for s in x.column("set").to_pylist()]
        ok = []
        for i, j in zip(u.tolist(), v.tolist(), strict=True):
            one, two = full[i], full[j]
            both = len(np.intersect1d(one, two, assume_unique=True)) if min(len(one), len(two)) * WHOLE >= PART * max(len(one), len(two)) else 0
            ok.append(WHOLE * both >= PART * (len(one) + len(two) - both) and both > 0)
        yield _ends(x, u[ok], v[ok])

    open_ = pairs.where("not sure").select("a", "b")
    nodes = open_.select(F.col("a").alias("node")).union(open_.select("b")).distinct().join(who, "node").select("node", "__hf_id", "text")
    texts = docs.select(_id().alias("__hf_id"), _text_hash().alias("hash"), F.col("text").alias("full"))
    found = texts.join(nodes.hint("merge").withColumnRenamed("text", "hash"), ["__hf_id", "hash"]).dropDuplicates(["node"])
    found = scratch.keep(found.select("node", F.col("full").alias("text")).mapInArrow(sets, "node long, set binary"), f"{name}-sets")
    links = pairs.where("sure").select("a", "b").union(_met(open_, found, ["set"], run, "a long, b long"))
    links = scratch.keep(links, f"{name}-links")
    scratch.drop(f"{name}-sets")
    return links.select("a", "b")


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """node, component (least node reachable) of all nodes in links (a, b): labels spread, then jump to their label's label."""
    edges = scratch.keep(links.select("a", "b").union(links.select("b", "a")).distinct(), f"{name}-edges")
    labels = scratch.keep(edges.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("component")), f"{name}-0")
    for step in range(1, STEPS + 1):
        near = edges.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        spread = labels.join(near, "node").select("node", F.col("component").alias("was"), F.least("component", "near").alias("now"))
        jump = labels.select(F.col("node").alias("now"), F.col("component").alias("further"))
        after = scratch.keep(spread.join(jump, "now", "left").select("node", "was", F.least("now", F.coalesce("further", "now")).alias("component")), f"{name}-{step}")
        changed = after.where("was != component").limit(1).count()
        scratch.drop(f"{name}-{step - 1}")
        labels = after.select("node", "component")
        if not changed:
            scratch.drop(f"{name}-edges")
            return labels
    raise RuntimeError(f"labels of components still move after {STEPS} steps")


def _crossing(members: DataFrame, best: bool) -> DataFrame:
    """members: key, band, block, other, side, node, component, n_shingles, signature, small, bands. Likely pairs between components in each pair of blocks; sure: similar by their small sets.

    A pair that meets in several bands is told by the first of them. best: of the pairs at hand each component tells its likeliest.

    A block meets itself (other = block) or another one of the same bucket; side says which of the two a row is. Meetings come
    sorted, so a task holds some of them at a time, whatever their number.
    """
    fields = ["key", "block", "other", "side", "node", "component", "band", "n_shingles"]
    earlier = np.arange(2 * BANDS)

    def pairs(cols: dict, sig: np.ndarray, sets: np.ndarray, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        comp, side, ids, band, n = cols["component"], cols["side"], cols["node"], cols["band"], cols["n_shingles"]

        def told(u, v):
            ok = comp[u] != comp[v]
            u, v = u[ok], v[ok]
            like = likeness((n[u], n[v]), (sig[u], sig[v]), (sets[u], sets[v]))
            ok = like > 0
            u, v, like = u[ok], v[ok], like[ok]
            if best:
                return likeliest(u, v, like)
            ok = ~((keys[u] == keys[v]) & (keys[u] != 0) & (earlier < band[u, None])).any(axis=1)
            return u[ok], v[ok], like[ok]

        def likeliest(u, v, like):
            """The likeliest pair of each component."""
            c, at = np.concatenate([comp[u], comp[v]]), np.tile(np.arange(len(u)), 2)
            order = np.lexsort((-like[at], c))
            first = order[np.append(True, c[order][1:] != c[order][:-1])] if len(c) else order
            pick = np.unique(at[first])
            return u[pick], v[pick], like[pick]

        two = ends - starts == 2
        found = [told(starts[two], starts[two] + 1)]  # most meetings are of two rows
        for a, b in zip(starts[~two].tolist(), ends[~two].tolist(), strict=True):
            cut = a + int(np.searchsorted(side[a:b], 1))
            x, y = (np.triu_indices(b - a, 1)) if cut == b else (m.ravel() for m in np.indices((cut - a, b - cut)))
            x, y = a + x, (a if cut == b else cut) + y
            found += [told(x[i : i + PAIRS_HELD], y[i : i + PAIRS_HELD]) for i in range(0, len(x), PAIRS_HELD)]
        u, v, like = (np.concatenate([f[i] for f in found]) for i in range(3))
        if best:
            u, v, _ = likeliest(u, v, like)
        sure = np.maximum(n[u], n[v]) <= SMALL
        u, v = ids[u], ids[v]
        low, high = np.minimum(u, v), np.maximum(u, v)
        return pa.RecordBatch.from_arrays([pa.array(low), pa.array(high), pa.array(sure)], ["a", "b", "sure"])

    @tidied
    def run(batches):
        cols, sig = {f: np.zeros(0, np.int64) for f in fields}, np.zeros((0, HASHES * BITS // 64), np.uint64)
        sets, keys, held, rows = np.zeros((0, SMALL), np.uint64), np.zeros((0, 2 * BANDS), np.int64), [], 0

        def done(last: bool):
            nonlocal cols, sig, sets, keys, held, rows
            cols = {f: np.concatenate([cols[f], *(b.column(f).to_numpy(zero_copy_only=False).astype(np.int64) for b in held)]) for f in fields}
            sig = np.concatenate([sig, *(_u64(b.column("signature")) for b in held)])
            sets = np.concatenate([sets, *(_sets(b.column("small")) for b in held)])
            keys = np.concatenate([keys, *(b.column("bands").flatten().to_numpy(zero_copy_only=False).reshape(-1, 2 * BANDS) for b in held)])
            held, rows, n = [], 0, len(sig)
            new = np.ones(n, np.bool_)
            new[1:] = (cols["key"][1:] != cols["key"][:-1]) | (cols["block"][1:] != cols["block"][:-1]) | (cols["other"][1:] != cols["other"][:-1])
            edges = np.append(np.flatnonzero(new), n)
            if not last:
                edges = edges[:-1]  # the last meeting may go on
            out = pairs(cols, sig, sets, keys, edges[:-1], edges[1:])
            cols, sig, sets, keys = {f: c[edges[-1] :] for f, c in cols.items()}, sig[edges[-1] :], sets[edges[-1] :], keys[edges[-1] :]
            return out

        for b in batches:
            if b.num_rows:
                held.append(b)
                rows += b.num_rows
                if rows >= ROWS_HELD:
                    yield done(False)
        if held or len(sig):
            yield done(True)

    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = members.select(*fields, "signature", "small", "bands").repartition(n, "key", "block", "other").sortWithinPartitions("key", "block", "other", "side")
    return dealt.mapInArrow(run, "a long, b long, sure boolean")


NAME = ["n_shingles", "set_a", "set_b"]


def classes_of(docs: DataFrame, scratch: Scratch, by_id: bool) -> tuple[DataFrame, DataFrame]:
    """Sketches of all rows of docs (doc_id, text); the classes of equal sets that are not empty: NAME, rep (least doc_id), component (a number).

    by_id: rows that share a doc_id are linked.
    """
    sketches = scratch.keep(sketch(docs), "sketches")
    rows = sketches.where("n_shingles > 0")
    # a row of each class stands for it; nodes are numbered as they are written
    chosen = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text")).alias("x")
    who = rows.groupBy(*NAME).agg(chosen).withColumn("node", F.monotonically_increasing_id())
    who = scratch.keep(who.select("node", *NAME, F.col("x.doc_id").alias("rep"), F.coalesce("x.doc_id", F.lit(NO_ID)).alias("__hf_id"), F.col("x.text").alias("text")), "classes")
    first = rows.withColumn("__hf_id", _id()).join(who.select("node", *NAME, "__hf_id", "text"), [*NAME, "__hf_id", "text"]).dropDuplicates(["node"])
    signatures = scratch.keep(first.select("node", "n_shingles", "bands", "signature", "small"), "signatures")
    bands = signatures.select("node", F.posexplode("bands").alias("band", "key")).where("key != 0")
    buckets = bands.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("least")).where("n > 1")
    members = scratch.keep(bands.join(buckets, "key"), "members")

    links = None
    if by_id:
        of_id = rows.where("doc_id is not null").select("doc_id", *NAME).distinct().join(who.select("node", *NAME), NAME).select("doc_id", "node")
        many = of_id.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a != z").select("doc_id", "a")
        links = scratch.keep(of_id.join(many, "doc_id").where("node != a").select("a", F.col("node").alias("b")), "ids")
    # each member beside the least one of its buckets with which it shares most of them
    shared = members.where("node != least").groupBy("node", "least").agg(F.count("*").alias("k"))
    stars = shared.groupBy(F.col("node").alias("b")).agg(F.max(F.struct("k", (-F.col("least")).alias("least"))).alias("x")).select((-F.col("x.least")).alias("a"), "b")
    stars = scratch.keep(likely(stars, signatures), "likely")
    more = confirm(stars, docs, who, scratch, "stars")
    links = more if links is None else links.union(more)
    labels = components(links, scratch, "stars")
    told = stars.select("a", "b")

    for best in (True, False):
        name = "best" if best else "rest"
        placed = scratch.keep(members.join(labels, "node", "left").select("key", "band", "node", F.coalesce("component", "node").alias("component")), f"{name}-placed")
        meets = _meetings(placed).join(signatures, "node")
        # estimates were good enough; of small sets they were exact
        found = scratch.keep(_crossing(meets, best).distinct().join(told, ["a", "b"], "left_anti"), f"{name}-found")
        if not found.limit(1).count():
            scratch.drop(f"{name}-placed")
            break
        more = confirm(found, docs, who, scratch, name)
        if more.limit(1).count():
            links = links.union(more)
            labels = components(links, scratch, name)
        told = told.union(found.select("a", "b"))
        scratch.drop(f"{name}-placed")
    own = F.coalesce("component", "node").alias("component")
    classes = who.join(labels, "node", "left").select(*NAME, "rep", own)
    scratch.drop("signatures", "members", "likely")
    return sketches, classes


def _meetings(placed: DataFrame) -> DataFrame:
    """placed (key, band, node, component) in the buckets of several components: key, band, block, other, side, node, component, a row for each meeting.

    The largest component of a bucket has blocks behind those of the other members, and meets these only. A row goes to its
    block's meeting with each block that it is to meet, and once to that with itself.
    """
    parts = placed.groupBy("key", "component").agg(F.count("*").alias("n"))
    largest = F.max(F.struct("n", "component")).alias("x")
    mixed = parts.groupBy("key").agg(F.sum("n").alias("n"), largest, F.count("*").alias("kinds")).where("kinds > 1")
    blocks = mixed.select("key", F.col("x.component").alias("major"), F.ceil((F.col("n") - F.col("x.n")) / BLOCK).cast("int").alias("few"), F.ceil(F.col("x.n") / BLOCK).cast("int").alias("many"))
    rows = placed.join(blocks, "key").withColumn("is_major", F.col("component") == F.col("major"))
    at = F.xxhash64("node")
    own = F.when(F.col("is_major"), F.col("few") + F.pmod(at, F.col("many"))).otherwise(F.pmod(at, F.col("few"))).cast("int")
    last = F.when(F.col("is_major"), F.col("few") - 1).otherwise(F.col("few") + F.col("many") - 1)
    meets = rows.withColumn("own", own).withColumn("with", F.explode(F.sequence(F.lit(0), last)))
    return meets.select("key", "band", F.least("own", "with").alias("block"), F.greatest("own", "with").alias("other"), F.when(F.col("own") > F.col("with"), 1).otherwise(0).alias("side"), "node", "component")


def near_duplicates(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of docs (doc_id, text)."""
    sketches, classes = classes_of(docs, scratch, by_id=True)
    least = classes.groupBy("component").agg(F.min("rep").alias("component_id"))
    by_set = classes.join(least, "component").select(*NAME, "component_id")
    out = sketches.where("n_shingles > 0").select("doc_id", *NAME).join(by_set, NAME).select("doc_id", "n_shingles", "component_id")
    return out.union(sketches.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def keep_first(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """One row of docs for each component, that of the least doc_id (a row without one only if no other is there), and all rows with an empty set.

    Rows are told apart by doc_id and text: one of those that are equal in both stays. Rows that share a doc_id alone are no group.
    """
    sketches, classes = classes_of(docs, scratch, by_id=False)
    rows = sketches.where("n_shingles > 0").join(classes.select(*NAME, "component"), NAME)
    first = rows.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text")).alias("x"))
    first = first.select(F.coalesce("x.doc_id", F.lit(NO_ID)).alias("__hf_id"), F.col("x.text").alias("__hf_text"))
    marked = docs.withColumn("__hf_id", _id()).withColumn("__hf_text", _text_hash())
    once = marked.join(first, ["__hf_id", "__hf_text"], "left_semi").dropDuplicates(["__hf_id", "__hf_text"]).select(*docs.columns)
    wordless = ~F.coalesce(F.col("text"), F.lit("")).rlike("[^\\x20\\x09-\\x0D]")
    return once.union(docs.where(wordless))


def op2_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    out = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), Scratch(spark, "op2"))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    return out.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


ORACLE = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN ws IS NULL OR len(ws) = 0 THEN []
    WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' '))) END AS sh
  FROM w),
n AS (SELECT doc_id, len(sh) AS n FROM s),
e AS (SELECT doc_id, hash(u) AS h FROM (SELECT doc_id, unnest(sh) AS u FROM s)),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
r(doc_id, node) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.node)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, min(node) AS component_id, n.doc_id = min(node) AS kept
FROM n JOIN r USING (doc_id) GROUP BY n.doc_id, n.n
"""
