"""Language-model scoring by a hierarchical Pitman-Yor model.

Each word stands in the restaurant of the word before it (a text's first one in that of the text's start). These restaurants share
a parent: their tables are customers of the one restaurant of words without context. Its tables are customers of a spelling model:
a word that opens a table is spelled byte by byte, and each byte (as one of A classes) sits in the restaurant of the three classes
before it, whose tables are customers of the restaurant of the two before it, and so on to the uniform distribution. Seating is
sampled by Gibbs: each sweep seats every restaurant anew given its parent's predictive probabilities and its own number of tables.
Predictive probabilities are averaged over the sweeps after BURN.

As in the base, a token has as many outcomes as training has words, and one more: a word that training has not. The model gives
that one the odds of a new table times the share of spellings that are no word of training, so the text's probability is that of
its known words and of its places for unknown ones, whose spelling is not paid for. A context that training has not has no
customers, so its words have their probabilities without context.

The corpus is read twice, to count and to score. Each task turns about CHUNK bytes of text into one row a word partition: the
words, the words before each, and then their training counts or where they stand (document, count). A word partition has all pairs
that end in its words, so the customers of a context lie over all partitions, however frequent it is. After each sweep a partition
tells the owner of each context (by its hash) how many customers and tables it has there, and gets the sums. Neither words, pairs
nor contexts are ever in one place, and a task has one word partition only: its number is the task's. The spelling model has A ** 4 cells (4 MB), whatever the corpus; it is fitted on the driver and
broadcast.

Null text is empty: the end token alone. Rows that repeat a doc_id are scored each. Without training tokens all probability is
the spelling model's untrained one.
"""

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NO_ID, Scratch, Tokens, _slices, as_bytes, bounded_batches, crc_mod, table, tidied

#: The end token's bytes, which no word has; its hash, and that of the context of a text's first word.
END, END_HASH, START_HASH = b"\r", np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93)
#: Classes of bytes (0: a word's border, A-1: all but the most frequent), sweeps, and how many of these are not averaged.
A, SWEEPS, BURN = 32, 4, 2
#: Strength of every restaurant; bytes of text that a task turns into postings at once.
THETA, CHUNK = 1.0, 6_000_000
#: Parts of the documents that are scored one after the other, so that only the postings of one are on disk at once; likewise of the word partitions that are rated.
ROUNDS = 3
#: Codec of the tables between the sweeps.
CODEC = "zstd"

POSTINGS = "p int, batch long, docs binary, train binary, hashes binary, spelling binary, pairs binary, contexts binary, context binary, entries binary, place binary, times binary"
STATE = "p int, hashes binary, spelling binary, entries binary, pairs binary, contexts binary, context binary, counts binary, tokens long, kinds long, ones long, twos long, customers long, ones0 long, twos0 long"
SUMS = "batch long, p int, docs binary, places binary, tokens binary, known binary, base binary, score binary"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: What a partition tells: ASK (to q: contexts, customers, tables), SEAT (customers and tables of words, tables of pairs), CELL (cells, customers, sums).
MESSAGE = "kind int, p int, q int, a binary, b binary, c binary"
ASK, SEAT, CELL = 0, 1, 2


def _batch(rows: list, schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    names, types = zip(*(x.split() for x in schema.split(", ")), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, k in zip(zip(*rows, strict=True), types, strict=True)], list(names))


def _packed(x: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the largest needs."""
    top = int(x.max()) if len(x) else 0
    return x.astype("<u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4" if top < 1 << 32 else "<u8").tobytes()


def _sized(raw: bytes, n: int) -> np.ndarray:
    """n unsigned integers of 1, 2, 4 or 8 bytes each."""
    return np.frombuffer(raw, f"<u{len(raw) // n}") if n else np.zeros(0, np.uint8)


def _i(raw: bytes, kind: str = "<u4") -> np.ndarray:
    return np.frombuffer(raw, kind)


def _planes(x: np.ndarray) -> bytes:
    """Values of 4 bytes, all first bytes before all second ones and so on, which compresses better."""
    return x.view(np.uint8).reshape(-1, 4).T.tobytes()


def _unplaned(raw: bytes, kind: str = "<u4") -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view(kind).ravel()


def _coded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes, ascending, and the place of each one among them: sorts high bits together with places, which is fast."""
    bits = np.uint64(max(1, len(x).bit_length()))
    packed = x >> bits << bits | np.arange(len(x), dtype=np.uint64)
    packed.sort()
    at = (packed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    values, top = x[at], packed >> bits
    new = values[1:] != values[:-1]
    if (new & (top[1:] == top[:-1])).any():  # high bits shared by different hashes
        return np.unique(x, return_inverse=True)
    code = np.empty(len(x), np.int64)
    code[at] = np.append(0, np.cumsum(new))
    return values[np.append(True, new)], code


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place and length of each run of equal values."""
    first = np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else np.zeros(0, np.int64)
    return first, np.diff(np.append(first, len(x)))


def _by(q: np.ndarray):
    """Each value of q and its places."""
    order = np.argsort(q.astype(np.uint16) if len(q) and int(q.max()) < 1 << 16 else q, kind="stable")  # short numbers are sorted by radix
    first, n = _runs(q[order])
    for a, k in zip(first.tolist(), n.tolist(), strict=True):
        yield int(q[order[a]]), order[a : a + k]


def _spread(low: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The places low[i], low[i] + 1, ... (n[i] of them) of each i."""
    return np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


class Places:
    """Where keys lie in an ascending array that has them. guess: about where each one is (from 0 on, below n, ascending with the keys)."""

    def __init__(self, keys: np.ndarray, guess: np.ndarray, n: int):
        many = np.bincount(guess, minlength=n)
        self.keys, self.first = keys, np.cumsum(many) - many

    def find(self, keys: np.ndarray, guess: np.ndarray) -> np.ndarray:
        at = self.first[guess]
        miss = np.flatnonzero(self.keys[at] != keys)
        while len(miss):
            at[miss] += 1
            miss = miss[self.keys[at[miss]] != keys[miss]]
        return at


class Hashes:
    """Where hashes lie among distinct ascending ones that have them: found by their first bits, as hashes lie evenly."""

    def __init__(self, h: np.ndarray):
        bits = max(1, len(h).bit_length())
        self.shift = np.uint64(64 - bits)
        self.places = Places(h, self.guess(h), 1 << bits)

    def guess(self, h: np.ndarray) -> np.ndarray:
        return (h >> self.shift).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        return self.places.find(h, self.guess(h))


class PairPlaces:
    """Where pairs lie among those of a partition (n of each word, by word and context): the contexts of a word lie evenly too."""

    def __init__(self, n: np.ndarray, context: np.ndarray, contexts: int):
        self.n, self.contexts = n.astype(np.int64), contexts
        self.first = np.cumsum(self.n) - self.n
        word = np.repeat(np.arange(len(n)), n)
        self.places = Places(word * contexts + context, self.guess(word, context), len(word))

    def guess(self, word: np.ndarray, context: np.ndarray) -> np.ndarray:
        return self.first[word] + self.n[word] * context // self.contexts

    def find(self, word: np.ndarray, context: np.ndarray) -> np.ndarray:
        return self.places.find(word * self.contexts + context, self.guess(word, context))


def postings(docs: DataFrame, parts: int, places: bool) -> DataFrame:
    """docs: doc_id, text, train (boolean). A row for each chunk and word partition.

    Pairs are sorted by word and context. entries: the pair's training count, or with places its number of documents.
    """

    def rows(seq, ids, train, tokens):
        first = tokens.first - tokens.first[0]
        docs_ = len(first) - 1
        owner = np.repeat(np.arange(docs_, dtype=np.int64), np.diff(first) + 1)
        ends = first[1:] + np.arange(docs_)
        h = np.empty(len(owner), np.uint64)
        word = np.ones(len(owner), np.bool_)
        word[ends] = False
        h[word], h[ends] = tokens.hashes, END_HASH
        unique, code = _coded(np.append(h, START_HASH))
        start, code = code[-1], code[:-1]
        if not places:  # a place of each word, the end's behind the texts; START has none and is no word
            raw = np.append(tokens.raw, np.frombuffer(END + b"\n", np.uint8))
            begin, size = np.full(len(unique), len(raw) - 2), np.full(len(unique), 2)
            begin[code[word]], size[code[word]] = tokens.start, tokens.end - tokens.start + 1
        before = np.append(start, code[:-1])
        before[ends[:-1] + 1] = start
        del h, word
        # each token as (word, context, document or whether it trains) in one number
        last, width = ((docs_ if places else 2) - 1).bit_length(), (len(unique) - 1).bit_length()
        key = (code << width | before) << last | (owner if places else train[owner])
        key.sort()
        first, times = _runs(key)
        entry = key[first]
        del key, code, before, owner
        pair, place = entry >> last, entry & ((1 << last) - 1)
        first, each = _runs(pair)
        if not places:
            each = np.add.reduceat(times * place, first)
        pair = pair[first]
        word, before = pair >> width, pair & ((1 << width) - 1)
        part = (unique >> np.uint64(32)) % np.uint64(parts)
        used = np.bincount(word, minlength=len(unique))
        batch = TaskContext.get().partitionId() << 32 | seq
        ids = ids.astype("<i8").tobytes() if places else b""
        press = zstandard.ZstdCompressor(1).compress
        starts, entries = np.cumsum(used) - used, np.cumsum(each) - each
        out, there, code = [], np.flatnonzero(used), np.empty(len(unique), np.int64)
        for p, mine in _by(part[there].astype(np.int64)):
            mine = there[mine]
            n = used[mine]
            at = _spread(starts[mine], n)
            mine_before = before[at]
            contexts = np.sort(mine_before)
            contexts = contexts[_runs(contexts)[0]]
            code[contexts] = np.arange(len(contexts))
            context = code[mine_before]
            spelling, where, times_ = b"", b"", b""
            if not places:
                spell = _slices(raw, begin[mine], size[mine])
                spell[np.cumsum(size[mine]) - 1] = 10  # what follows a word in its text
                spelling = press(spell[:-1].tobytes().lower())
            else:
                rest = _spread(entries[at], each[at])
                where, times_ = _packed(place[rest]), _packed(times[rest])
            out.append((p, batch, ids, b"", unique[mine].tobytes(), spelling, _packed(n), unique[contexts].tobytes(), _packed(context), _packed(each[at]), where, times_))
        return _batch(out, POSTINGS)

    @tidied
    def run(batches):
        seq, held, size = 0, [], 0

        def cut():
            all_ = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            return rows(seq, all_.column("doc_id").fill_null(NO_ID).to_numpy(), all_.column("train").to_numpy(zero_copy_only=False), Tokens(all_.column("text"), lower=True))

        for b in batches:
            if b.num_rows:
                held.append(b)
                size += b.nbytes
                if size >= CHUNK:
                    yield cut()
                    seq, held, size = seq + 1, [], 0
        if held:
            yield cut()

    return docs.select("doc_id", "text", "train").mapInArrow(run, POSTINGS)


class Words:
    """The words of a partition (hashes ascending, spelling) and its pairs (by word, then context) with training counts.

    Pairs hold the places of their words and contexts among those known.
    """

    def __init__(self):
        self.h, self.contexts, self.spell, self.new, self.held, self.many = np.zeros(0, np.uint64), np.zeros(0, np.uint64), [], [], 0, 0
        self.pairs = tuple(np.zeros(0, np.int64) for _ in range(3))

    def add(self, row: dict) -> None:
        h = _i(row["hashes"], np.uint64)
        n = _sized(row["pairs"], len(h)).astype(np.int64)
        k = int(n.sum())
        spell = zstandard.ZstdDecompressor().decompress(row["spelling"]).split(b"\n")
        self.new.append((h, spell, n, _i(row["contexts"], np.uint64), _sized(row["context"], k), _sized(row["entries"], k)))
        self.held, self.many = self.held + len(h), self.many + k
        if self.held > len(self.h) + 200_000 or self.many > len(self.pairs[0]) + 1_000_000:
            self.merge()

    def merge(self) -> None:
        if self.new:
            (word, context, count), a, b = self.pairs, len(self.h), len(self.contexts)
            spell = self.spell + [w for x in self.new for w in x[1]]
            self.h, word_at = _coded(np.concatenate([self.h, *(x[0] for x in self.new)]))
            self.contexts, context_at = _coded(np.concatenate([self.contexts, *(x[3] for x in self.new)]))
            some = np.empty(len(self.h), np.int64)
            some[word_at] = np.arange(len(word_at))
            self.spell = [spell[i] for i in some.tolist()]
            words, contexts, counts = [word_at[word]], [context_at[context]], [count]
            for h, _, n, c, at, times in self.new:
                words.append(np.repeat(word_at[a : a + len(h)], n))
                contexts.append(context_at[b : b + len(c)][at])
                counts.append(times.astype(np.int64))
                a, b = a + len(h), b + len(c)
            self.new, self.held, self.many = [], 0, 0
            self.pairs = _counted(*(np.concatenate(x) for x in (words, contexts, counts)), len(self.h), len(self.contexts))

    def state(self, p: int) -> tuple:
        self.merge()
        word, context, count = self.pairs
        n = np.bincount(word, minlength=len(self.h))
        first = np.cumsum(n) - n
        c, c0 = np.add.reduceat(count, first), np.add.reduceat((count > 0).astype(np.int64), first)
        sums = [c.sum(), (c > 0).sum(), (count == 1).sum(), (count == 2).sum(), c0.sum(), (c0 == 1).sum(), (c0 == 2).sum()]
        return (p, self.h.tobytes(), b"\n".join(self.spell), c.astype("<i8").tobytes(), n.astype("<u4").tobytes(), self.contexts.tobytes(), _planes(context.astype("<u4")), _packed(count), *map(int, sums))


def _counted(word: np.ndarray, context: np.ndarray, count: np.ndarray, words: int, contexts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs by word and context, with the sums of their counts. A pair and its count are sorted as one number where they fit in it."""
    width, bits = np.uint64(contexts.bit_length()), int(count.max()).bit_length()
    key = word.astype(np.uint64) << width | context.astype(np.uint64)
    if words.bit_length() + contexts.bit_length() + bits <= 64:
        key <<= np.uint64(bits)
        key |= count.astype(np.uint64)
        key.sort()
        count = (key & np.uint64((1 << bits) - 1)).astype(np.int64)
        key >>= np.uint64(bits)
    else:
        order = np.argsort(key)
        key, count = key[order], count[order]
    first = _runs(key)[0]
    key = key[first]
    return (key >> width).astype(np.int64), (key & ((np.uint64(1) << width) - np.uint64(1))).astype(np.int64), np.add.reduceat(count, first)


def gathered(rows: DataFrame, parts: int) -> DataFrame:
    """The words and pairs of each word partition."""

    @tidied
    def run(batches):
        words: dict[int, Words] = {}
        for b in batches:
            for row in b.to_pylist():
                words.setdefault(row["p"], Words()).add(row)
        for p in list(words):
            yield _batch([words.pop(p).state(p)], STATE)

    return rows.repartitionById(parts, "p").mapInArrow(run, STATE)


class Pairs:
    """The pairs of a partition's state: word and context of each, as places among the partition's words and contexts."""

    def __init__(self, row: dict):
        self.c, n = _i(row["entries"], "<i8"), _i(row["pairs"])
        self.word, self.context = np.repeat(np.arange(len(n)), n), _unplaned(row["context"])
        self.contexts, self.count = _i(row["contexts"], np.uint64), _sized(row["counts"], len(self.word)).astype(np.int64)
        self.owned: list | None = None

    def owners(self, parts: int) -> list:
        """Each owner and the places of its contexts."""
        if self.owned is None:
            self.owned = list(_by(((self.contexts >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)))
        return self.owned

    def ask(self, p: int, t: np.ndarray, parts: int) -> list:
        """What each owner must know: this partition's customers and tables (t: of each pair) of its contexts."""
        c, t = (np.bincount(self.context, x, len(self.contexts)).astype(np.int64) for x in (self.count, t))
        return [(ASK, p, k, self.contexts[at].tobytes(), _packed(c[at]), _packed(t[at])) for k, at in self.owners(parts)]

    def sums(self, box: dict, s: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
        """Customers and tables of each context in all partitions, after sweep s."""
        c, t = np.zeros(len(self.contexts)), np.zeros(len(self.contexts))
        for k, at in self.owners(parts):
            c[at], t[at] = (_sized(box[s, k][x], len(at)) for x in ("b", "c"))
        return c, t


def answers(messages: DataFrame, parts: int) -> DataFrame:
    """p, q, b, c: the sums over all partitions of the contexts that p asked q for."""

    def reply(rows):
        h = [_i(r["a"], np.uint64) for r in rows]
        ends = np.cumsum([len(x) for x in h])
        unique, code = _coded(np.concatenate(h))
        c, t = (np.bincount(code, np.concatenate([_sized(r[x], len(y)) for r, y in zip(rows, h, strict=True)]), len(unique)).astype(np.int64) for x in ("b", "c"))
        for r, y, b in zip(rows, h, ends.tolist(), strict=True):
            mine = code[b - len(y) : b]
            yield _batch([(r["p"], r["q"], _packed(c[mine]), _packed(t[mine]))], "p int, q int, b binary, c binary")

    @tidied
    def run(batches):
        rows = []
        for b in batches:
            for r in b.to_pylist():
                if rows and rows[0]["q"] != r["q"]:
                    yield from reply(rows)
                    rows = []
                rows.append(r)
        if rows:
            yield from reply(rows)

    asked = messages.where(F.col("kind") == ASK).drop("kind")
    return asked.repartitionById(parts, "q").sortWithinPartitions("q", "p").mapInArrow(run, "p int, q int, b binary, c binary")


def meeting(state: DataFrame, told: list, parts: int, which: Column | None = None) -> DataFrame:
    """Each partition's state behind what it was told. told: (sweep, messages, their answers) of each sweep that counts; which: the partitions that meet."""
    which = F.lit(True) if which is None else which
    box = None
    for s, messages, said in told:
        seats = messages.where((F.col("kind") == SEAT) & which).select("p", F.lit(-1).alias("q"), "a", "b", "c")
        both = seats.unionByName(said.where(which), allowMissingColumns=True).withColumn("s", F.lit(s))
        box = both if box is None else box.unionByName(both)
    last = state.where(which).drop("tokens", "kinds", "ones", "twos", "customers", "ones0", "twos0").withColumn("s", F.lit(1 << 30))
    return box.unionByName(last, allowMissingColumns=True).repartitionById(parts, "p").sortWithinPartitions("p", "s", "q")


def _met(batches):
    """The state row of each partition and what it was told, by sweep and sender (-1: its own seats)."""
    box = {}
    for b in batches:
        for row in b.to_pylist():
            if row["hashes"] is None:
                box[row["s"], row["q"]] = row
            else:
                yield row, box
                box = {}


def seat(c: np.ndarray, pull: np.ndarray, d: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of each dish with c customers. pull: strength of a new table, (theta + d * tables) * parent's probability.

    Customers come one by one; from the hundredth on a few at once (2 % of those seated), at the odds that the first of them has.
    """
    t = (c > 0).astype(np.int64)
    at = np.flatnonzero(c > 1)
    m, tt, a, top = 1, np.ones(len(at), np.int64), np.maximum(pull[at], 1e-300), c[at]  # m: of each dish that is not done, so one number
    while len(at):
        odds = a / (a + m - d * tt)
        step = max(1, m // 50)
        tt += rng.random(len(at)) < odds if m < 100 else rng.binomial(np.minimum(step, top - m), odds)
        m += step
        done = top <= m
        if done.any():
            t[at[done]] = tt[done]
            left = np.flatnonzero(~done)
            at, tt, a, top = at[left], tt[left], a[left], top[left]
    return t


def _discount(one: int, two: int) -> float:
    """The usual estimate from what was seen once and twice."""
    return min(0.95, max(0.05, one / (one + 2 * two))) if one + two else 0.5


def discount(counts: np.ndarray) -> float:
    return _discount(int((counts == 1).sum()), int((counts == 2).sum()))


def class_of(weights: np.ndarray) -> np.ndarray:
    """Class of each byte: the A-2 most frequent have one of their own, the others share the last."""
    out = np.full(256, A - 1, np.int64)
    order = np.argsort(-weights, kind="stable")[: A - 2]
    out[order] = np.arange(1, len(order) + 1)
    return out


def cells(spell: bytes, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For words joined by line feeds: the cell (context and class) of each byte and border, each word's first one, and bytes of the shared class."""
    raw = np.frombuffer(b"\n\n\n" + spell + b"\n", np.uint8)
    border = raw == 10
    k = classes[raw]
    k[border] = 0
    one, two, three, now = k[2:-1], k[1:-2], k[:-3], k[3:]
    two = np.where(one == 0, 0, two)
    three = np.where(two == 0, 0, three)
    cell = ((three * A + two) * A + one) * A + now
    ends = np.flatnonzero(border[3:])
    return cell, np.r_[0, ends[:-1] + 1], (now == A - 1)


class Spelling:
    """The restaurants of the spelling model, seated anew by each call of sweep()."""

    def __init__(self):
        self.tables: list[np.ndarray | None] = [None] * 4
        self.levels = self.predictive([np.zeros(A**n) for n in (4, 3, 2, 1)], [np.zeros(A**n) for n in (4, 3, 2, 1)], [0.5] * 4)

    @staticmethod
    def predictive(counts: list, tables: list, d: list) -> list[np.ndarray]:
        """Probabilities of classes given 0, 1, 2 and 3 classes before."""
        p, out = np.full(A, 1.0 / A), []
        for n in range(4):
            c, t = (x[3 - n].reshape(-1, A) for x in (counts, tables))
            parent = p if n == 0 else np.broadcast_to(p.reshape(1, -1, A), (A, p.size // A, A)).reshape(-1, A)
            parent = parent.reshape(-1, A) if n else parent[None, :]
            p = (c - d[n] * t + (THETA + d[n] * t.sum(1, keepdims=True)) * parent) / (THETA + c.sum(1, keepdims=True))
            out.append(p)
        return out

    def sweep(self, counts: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        """counts: customers of each cell of the longest context. Log probability of each cell afterwards."""
        all_counts, all_tables, d = [], [], []
        c = counts.astype(np.int64)
        for n in range(3, -1, -1):
            used = np.flatnonzero(c)
            disc = discount(c[used])
            context = used // A
            before = self.tables[n] if self.tables[n] is not None else np.bincount(context, minlength=max(1, len(c) // A))
            parent = self.levels[n - 1].reshape(-1)[used % A**n] if n else np.full(len(used), 1.0 / A)
            t = np.zeros(len(c), np.int64)
            t[used] = seat(c[used], (THETA + disc * before[context]) * parent, disc, rng)
            self.tables[n] = t.reshape(-1, A).sum(1)
            all_counts.append(c.astype(np.float64))
            all_tables.append(t.astype(np.float64))
            d.append(disc)
            c = t.reshape(A, -1).sum(0) if n else c
        self.levels = self.predictive(all_counts, all_tables, d[::-1])
        return np.log(np.maximum(self.levels[3], 1e-300)).astype(np.float32).reshape(-1)


def pieces(spell: bytes, words: int = 20_000):
    """Words joined by line feeds in pieces of so many words, so that what is made of their bytes stays small."""
    ends = np.flatnonzero(np.frombuffer(spell + b"\n", np.uint8) == 10)
    for a in range(0, len(ends), words):
        last = min(a + words, len(ends)) - 1
        yield a, last + 1, spell[ends[a - 1] + 1 if a else 0 : ends[last]]


def _spelled(spell: bytes, classes: np.ndarray, other: float, logp: np.ndarray) -> np.ndarray:
    """Log probability of each word's spelling; other: that of a byte within the shared class."""
    out = []
    for _, _, part in pieces(spell):
        cell, first, shared = cells(part, classes)
        out.append(np.add.reduceat(logp[cell].astype(np.float64) + shared * other, first))
    return np.concatenate(out)


def score_documents(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """docs: doc_id, text, train. doc_id, n_tokens, n_known, train_tokens, base_score, score of every row."""
    spark = docs.sparkSession
    # each partition tells each other one, so messages grow with the square of their number; half of them hold twice as much each
    parts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")) // 2)
    bounded_batches(spark)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")  # what a sweep shuffled goes as it ends; all that is read again is written first
    state = scratch.keep(gathered(postings(docs, parts, False), parts), "state", CODEC)
    names = ("tokens", "kinds", "ones", "twos", "customers", "ones0", "twos0")
    n, v, ones, twos, customers, ones0, twos0 = (int(x or 0) for x in state.agg(*(F.sum(c) for c in names)).first())
    d = _discount(ones, twos)

    def weigh(batches):
        out = np.zeros(256, np.int64)
        for b in batches:
            for s in as_bytes(b.column("spelling")):
                out += np.bincount(np.frombuffer(s, np.uint8), minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(256, dtype=np.int64)), pa.array(out)], ["byte", "n"])

    got = state.select("spelling").mapInArrow(tidied(weigh), "byte long, n long").groupBy("byte").sum("n").toPandas()
    weights = np.zeros(256, np.int64)
    weights[got["byte"]] = got["sum(n)"]
    weights[10] = 0
    classes = class_of(weights)
    rare = int((classes == A - 1).sum()) - 1  # the line feed stands in no word
    other = -float(np.log(max(1, rare)))

    def begin(batches):
        for b in batches:
            for row in b.to_pylist():
                pairs = Pairs(row)
                t = (pairs.count > 0).astype(np.int64)
                c0 = np.bincount(pairs.word, t, len(pairs.c)).astype(np.int64)
                yield _batch([*pairs.ask(row["p"], t, parts), (SEAT, row["p"], -1, _packed(c0), _packed((c0 > 0).astype(np.int64)), _packed(t))], MESSAGE)

    spelling, rng = Spelling(), np.random.default_rng(20)
    logs = [np.log(np.maximum(spelling.levels[3], 1e-300)).astype(np.float32).reshape(-1)]
    #: Of each sweep: customers, tables and discount of the restaurant without context.
    seated = [(customers, v, _discount(ones0, twos0))]
    told, said = [scratch.keep(state.mapInArrow(tidied(begin), MESSAGE), "told0", CODEC)], {}

    def words(row, box, s, spelled, seated):
        """Probabilities without context of the words that training has, after sweep s."""
        n0, tables, d0 = seated
        k, seat_ = len(spelled), box[s, -1]
        return (_sized(seat_["a"], k) - d0 * _sized(seat_["b"], k) + (THETA + d0 * tables) * spelled) / (THETA + n0)

    for s in range(1, SWEEPS + 1):
        shared = spark.sparkContext.broadcast((classes, other, logs[-1], seated[-1]))

        def sample(batches, s=s, shared=shared):
            classes, other, logp, seated = shared.value
            for row, box in _met(batches):
                p, spell, pairs = row["p"], row["spelling"], Pairs(row)
                spelled = np.exp(_spelled(spell, classes, other, logp))
                rng = np.random.default_rng([s, p])
                _, tables = pairs.sums(box, s - 1, parts)
                pull = (THETA + d * tables[pairs.context]) * words(row, box, s - 1, spelled, seated)[pairs.word]
                t = seat(pairs.count, pull, d, rng)
                c0 = np.bincount(pairs.word, t, len(pairs.c)).astype(np.int64)
                t0 = seat(c0, (THETA + seated[2] * seated[1]) * spelled, seated[2], rng)
                out = np.zeros(A**4, np.int64)
                for x, y, part in pieces(spell):
                    cell, first, _ = cells(part, classes)
                    out += np.bincount(cell, np.repeat(t0[x:y], np.diff(np.r_[first, len(cell)])), A**4).astype(np.int64)
                at = np.flatnonzero(out)
                sums = np.array([c0.sum(), t0.sum(), (c0 == 1).sum(), (c0 == 2).sum()], "<i8").tobytes()
                yield _batch([*pairs.ask(p, t, parts), (SEAT, p, -1, _packed(c0), _packed(t0), _packed(t)), (CELL, p, -1, at.astype("<u4").tobytes(), out[at].astype("<i8").tobytes(), sums)], MESSAGE)

        def cell_counts(batches):
            for b in batches:
                for x, y, z in zip(*(b.column(c).to_pylist() for c in "abc"), strict=True):
                    yield pa.RecordBatch.from_arrays([pa.array(np.r_[_i(x).astype(np.int64), -1, -2, -3, -4]), pa.array(np.r_[_i(y, "<i8"), _i(z, "<i8")])], ["cell", "n"])

        answered = answers(told[-1], parts)
        if s - 1 > BURN:  # read again when words are rated
            answered = said[s - 1] = scratch.keep(answered, f"said{s - 1}", CODEC)
        told.append(scratch.keep(meeting(state, [(s - 1, told[-1], answered)], parts).mapInArrow(tidied(sample), MESSAGE), f"told{s}", CODEC))
        if s - 1 <= BURN:
            scratch.drop(f"told{s - 1}")
        got = told[-1].where(F.col("kind") == CELL).mapInArrow(cell_counts, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
        counts = np.zeros(A**4, np.int64)
        real = got[got.cell >= 0]
        counts[real.cell] = real.n
        sums = dict(zip(got.cell[got.cell < 0], got.n[got.cell < 0], strict=True))
        seated.append((int(sums.get(-1, 0)), int(sums.get(-2, 0)), _discount(int(sums.get(-3, 0)), int(sums.get(-4, 0)))))
        logs.append(spelling.sweep(counts, rng))
        shared.destroy()
    kept = range(BURN + 1, SWEEPS + 1)
    spellings = spark.sparkContext.broadcast((classes, other, {s: logs[s] for s in kept}))

    def spelled_mass(batches):
        classes, other, logs = spellings.value
        total = dict.fromkeys(kept, 0.0)
        for b in batches:
            for spell, c in zip(*(b.column(x).to_pylist() for x in ("spelling", "entries")), strict=True):
                for s in kept:
                    total[s] += float(np.exp(_spelled(spell, classes, other, logs[s]))[_i(c, "<i8") > 0].sum())
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()))], ["s", "mass"])

    seen = dict(state.select("spelling", "entries").mapInArrow(tidied(spelled_mass), "s int, mass double").groupBy("s").sum("mass").collect())
    unseen = {s: max(1e-12, 1 - seen.get(s, 0.0)) for s in kept}

    def rate(batches):
        classes, other, logs = spellings.value
        for row, box in _met(batches):
            pairs = Pairs(row)
            pred = np.zeros(len(pairs.word))
            for s in kept:
                n0, tables0, d0 = seated[s]
                p0 = words(row, box, s, np.exp(_spelled(row["spelling"], classes, other, logs[s])), seated[s])
                p0 = np.where(pairs.c > 0, p0, (THETA + d0 * tables0) * unseen[s] / (THETA + n0))
                c, tables = (x[pairs.context] for x in pairs.sums(box, s, parts))
                pred += (pairs.count - d * _sized(box[s, -1]["c"], len(pred)) + (THETA + d * tables) * p0[pairs.word]) / (THETA + c)
            score = np.log10(np.maximum(pred / len(kept), 1e-300))
            yield _batch([(row["p"], -1, b"", b"", row["hashes"], b"", _packed(_i(row["pairs"])), row["contexts"], row["context"], _planes(score.astype("<f4")), _packed(pairs.c), b"")], POSTINGS)

    said[SWEEPS], rated = scratch.keep(answers(told[SWEEPS], parts), f"said{SWEEPS}", CODEC), None
    for r in range(ROUNDS):
        met = meeting(state, [(s, told[s], said[s]) for s in kept], parts, F.col("p") % ROUNDS == r)
        part = scratch.keep(met.mapInArrow(tidied(rate), POSTINGS), f"rated{r}", CODEC)
        rated = part if rated is None else rated.union(part)
    scratch.drop("state", *(f"{x}{s}" for x in ("told", "said") for s in kept))

    def add_up(batches):
        p = known = h = contexts = pairs = score = base = None  # of the word partition at hand
        for b in batches:
            for row in b.to_pylist():
                if row["batch"] < 0:
                    p, h, score = row["p"], _i(row["hashes"], np.uint64), _unplaned(row["entries"], "<f4")
                    count = _sized(row["place"], len(h)).astype(np.int64)
                    known, base = (count > 0).astype(np.uint8), np.log10((count + 0.1) / (n + 0.1 * (v + 1)))
                    contexts = _i(row["contexts"], np.uint64)
                    pairs = PairPlaces(_sized(row["pairs"], len(h)), _unplaned(row["context"]).astype(np.int64), len(contexts))
                    h, contexts = Hashes(h), Hashes(contexts)
                    continue
                assert p == row["p"]
                own = h.find(_i(row["hashes"], np.uint64))
                word = np.repeat(own, _sized(row["pairs"], len(own)))
                context = contexts.find(_i(row["contexts"], np.uint64))[_sized(row["context"], len(word))]
                pair = pairs.find(word, context)
                each = _sized(row["entries"], len(word))
                word, pair = np.repeat(word, each), np.repeat(pair, each)
                place, times, docs_ = _sized(row["place"], len(word)), _sized(row["times"], len(word)).astype(np.float64), _i(row["docs"], "<i8")
                sums = [np.bincount(place, times * x, len(docs_)) for x in (1.0, known[word], base[word], score[pair])]
                has = np.flatnonzero(sums[0])
                yield _batch([(row["batch"], p, row["docs"], _packed(has), *(_packed(x[has].astype(np.int64)) for x in sums[:2]), *(x[has].astype("<f8").tobytes() for x in sums[2:]))], SUMS)

    def total(batches):
        """Sums of the parts of each chunk of documents."""
        held = None

        def out():
            docs_, sums = held[1:]
            return pa.RecordBatch.from_arrays([pa.array(docs_, mask=docs_ == NO_ID), pa.array(sums[0].astype(np.int64)), pa.array(sums[1].astype(np.int64)), pa.array(sums[2]), pa.array(sums[3])], ["doc_id", "n_tokens", "n_known", "base_score", "score"])

        for b in batches:
            for row in b.to_pylist():
                if held is None or held[0] != row["batch"]:
                    if held is not None:
                        yield out()
                    docs_ = _i(row["docs"], "<i8")
                    held = row["batch"], docs_, [np.zeros(len(docs_)) for _ in range(4)]
                at = _sized(row["places"], len(row["base"]) // 8)
                for s, x in zip(held[2], (_sized(row["tokens"], len(at)), _sized(row["known"], len(at)), _i(row["base"], "<f8"), _i(row["score"], "<f8")), strict=True):
                    s[at] += x
        if held is not None:
            yield out()

    of, out = F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS)), None
    for r in range(ROUNDS):
        both = postings(docs.where(of == r), parts, True).union(rated)
        parted = both.repartitionById(parts, "p").sortWithinPartitions("p", "batch")
        summed = parted.mapInArrow(tidied(add_up), SUMS).repartition(parts, "batch").sortWithinPartitions("batch", "p")
        part = scratch.keep(summed.mapInArrow(tidied(total), "doc_id long, n_tokens long, n_known long, base_score double, score double"), f"scores{r}")
        out = part if out is None else out.union(part)
    scratch.drop(*(f"rated{r}" for r in range(ROUNDS)))
    spark.conf.set(CLEANUP, before)
    return out.select("doc_id", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")


def op10_pitmanyor(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("train", F.coalesce(crc_mod("doc_id", 10) != 0, F.lit(True)))
    out = score_documents(docs, Scratch(spark, "op10"))
    held = F.coalesce(crc_mod("doc_id", 10) == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
