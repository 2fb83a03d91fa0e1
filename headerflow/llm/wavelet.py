"""Token-id output as wavelet matrices.

Documents in ascending doc_id order are dealt by range; each task encodes its documents, appends the end id, and cuts the ids
into shards. A shard is one compressed file: for each bit of the ids, from the highest, a plane of bits in the order that the
planes above it leave, cut into blocks that are compressed one by one (Zstandard), with a directory of the ones before each block. Access,
counting and the places of a token's occurrences need a shard alone, and decompress only the blocks that they touch.

File: magic `HFWM`, version, planes, length (8 bytes), for each plane its zeros (8 bytes), then for each plane and block of 131072
bits the ones before it (4 bytes), then the stored bytes of each block (2 bytes; those of a whole block: it is stored as it is),
then the blocks. Shards are rows of a Parquet table in the shared folder, since executors see no other common file system.

Null text: the end id alone. Empty table: no shards. Repeated rows are documents of their own; rows that share a doc_id stand in
the order of their texts' hash, and rows without one stand first. Columns of the input other than doc_id and text are unread.
"""

import itertools
import os
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import NO_ID, Coded, Scratch, _slices, bounded_batches, table, tidied, value_hashes

MAGIC, VERSION, BLOCK = b"HFWM", 2, 131072
END = 2
#: Pieces that a worker's cache holds at most, about.
CACHE = 1_600_000
#: Marks that are cut off behind a word; no apostrophe, which begins words of the pattern.
MARKS = ".,;:!?%*#$&"
#: Ids of a shard at least, but for a task's last one.
SHARD = 1_000_000


def build(ids: np.ndarray) -> bytes:
    """The file for a sequence of ids."""
    n = len(ids)
    planes = max(1, int(ids.max()).bit_length()) if n else 1
    cur = ids.astype(np.uint16 if planes <= 16 else np.uint32)
    zeros, ranks, sizes, body = [], [], [], []
    press = zstandard.ZstdCompressor(1, write_content_size=False, write_checksum=False).compress
    for b in range(planes - 1, -1, -1):
        bit = (cur & cur.dtype.type(1 << b)).astype(np.bool_)
        packed = np.zeros(-(-n // BLOCK) * BLOCK // 8, np.uint8)
        raw = np.packbits(bit, bitorder="little")
        packed[: len(raw)] = raw
        blocks = packed.reshape(-1, BLOCK // 8)
        ones = np.bitwise_count(blocks).sum(1, dtype=np.uint32)
        ranks.append((np.cumsum(ones, dtype=np.uint32) - ones).astype("<u4").tobytes())
        for block in blocks:
            stored = press(block.tobytes())
            body.append(stored if len(stored) < BLOCK // 8 else block.tobytes())
            sizes.append(len(body[-1]))
        low = cur.take(np.flatnonzero(~bit))  # by places: masks are slow where bits change often
        zeros.append(len(low))
        cur = np.concatenate([low, cur.take(np.flatnonzero(bit))])
    return MAGIC + struct.pack("<BBQ", VERSION, planes, n) + struct.pack(f"<{planes}Q", *zeros) + b"".join(ranks) + np.array(sizes, "<u2").tobytes() + b"".join(body)


class WaveletMatrix:
    """A shard read back."""

    def __init__(self, file: bytes):
        if file[:4] != MAGIC or file[4] != VERSION:
            raise ValueError("not a wavelet matrix file")
        _, self.planes, self.n = struct.unpack_from("<BBQ", file, 4)
        at = 14
        self.zeros = struct.unpack_from(f"<{self.planes}Q", file, at)
        at += 8 * self.planes
        blocks = -(-self.n // BLOCK)
        self.ranks = np.frombuffer(file, "<u4", self.planes * blocks, at).reshape(self.planes, blocks)
        at += 4 * self.planes * blocks
        sizes = np.frombuffer(file, "<u2", self.planes * blocks, at).astype(np.int64)
        at += 2 * self.planes * blocks
        ends = at + np.cumsum(sizes)
        self.file, self.size, self.start = file, sizes.reshape(self.planes, blocks), (ends - sizes).reshape(self.planes, blocks)
        if at + int(sizes.sum()) != len(file):
            raise ValueError("truncated or overlong file")
        self._open = zstandard.ZstdDecompressor().decompress
        self._held: dict[tuple[int, int], np.ndarray] = {}

    def _block(self, plane: int, k: int) -> np.ndarray:
        """The bytes of a block; a few blocks a plane are held."""
        if (plane, k) not in self._held:
            if len(self._held) >= 4 * self.planes:
                self._held.clear()
            self._held[plane, k] = np.frombuffer(self._stored(plane, k), np.uint8)
        return self._held[plane, k]

    def _stored(self, plane: int, k: int) -> bytes:
        size, start = int(self.size[plane, k]), int(self.start[plane, k])
        stored = self.file[start : start + size]
        return stored if size == BLOCK // 8 else self._open(stored, max_output_size=BLOCK // 8)

    def _plane(self, plane: int) -> np.ndarray:
        return np.frombuffer(b"".join(self._stored(plane, k) for k in range(self.size.shape[1])), np.uint8)

    def __len__(self) -> int:
        return self.n

    def _rank1(self, plane: int, i: int) -> int:
        """Ones before place i."""
        if i >= self.n:
            return self.n - self.zeros[plane]
        k, at = divmod(i, BLOCK)
        block = self._block(plane, k)
        out = int(self.ranks[plane, k]) + int(np.bitwise_count(block[: at // 8]).sum(dtype=np.int64))
        return out + (int(block[at // 8]) & ((1 << at % 8) - 1)).bit_count() if at % 8 else out

    def _select(self, plane: int, bit: int, k: int) -> int:
        """Place of the k-th (from 0) such bit."""
        low, high = 0, self.n
        while low < high:
            mid = (low + high) // 2
            ones = self._rank1(plane, mid + 1)
            if (ones if bit else mid + 1 - ones) > k:
                high = mid
            else:
                low = mid + 1
        return low

    def access(self, i: int) -> int:
        out = 0
        for p in range(self.planes):
            ones = self._rank1(p, i)
            if self._block(p, i // BLOCK)[i % BLOCK // 8] >> (i % 8) & 1:
                out, i = out << 1 | 1, self.zeros[p] + ones
            else:
                out, i = out << 1, i - ones
        return out

    def _range(self, token: int, start: int, end: int) -> tuple[int, int]:
        for p in range(self.planes):
            a, b = self._rank1(p, start), self._rank1(p, end)
            if token >> (self.planes - 1 - p) & 1:
                start, end = self.zeros[p] + a, self.zeros[p] + b
            else:
                start, end = start - a, end - b
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """Occurrences of a token from start to before end."""
        if not 0 <= token < 1 << self.planes:
            return 0
        a, b = self._range(token, min(start, self.n), self.n if end is None else min(end, self.n))
        return max(0, b - a)

    def locate(self, token: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence."""
        start, end = self._range(token, 0, self.n) if 0 <= token < 1 << self.planes else (0, 0)
        if not 0 <= k < end - start:
            raise IndexError(k)
        i = start + k
        for p in range(self.planes - 1, -1, -1):
            one = token >> (self.planes - 1 - p) & 1
            i = self._select(p, one, i - self.zeros[p] if one else i)
        return i

    def counts(self, token: int, ends: np.ndarray) -> np.ndarray:
        """Occurrences of a token between neighbouring ends, which ascend; the first part begins at 0."""
        if not 0 <= token < 1 << self.planes:
            return np.zeros(len(ends), np.int64)
        at = np.append(0, ends).astype(np.int64)
        first = 0  # where the token's run of this plane begins
        for p in range(self.planes):
            bits = self._plane(p).view(np.uint64)
            sums = np.append(0, np.cumsum(np.bitwise_count(bits), dtype=np.int64))
            both = np.append(at, first)
            low = bits[np.minimum(both // 64, len(bits) - 1)] & ((np.uint64(1) << (both % 64).astype(np.uint64)) - np.uint64(1))
            ones = sums[both // 64] + np.where(both % 64 > 0, np.bitwise_count(low), 0) if len(bits) else np.zeros(len(both), np.int64)
            both = self.zeros[p] + ones if token >> (self.planes - 1 - p) & 1 else both - ones
            at, first = both[:-1], int(both[-1])
        return np.diff(at)

    def decode(self) -> np.ndarray:
        """All ids: from the lowest plane up, each plane undoes its own sorting."""
        cur = np.zeros(self.n, np.uint16 if self.planes <= 16 else np.uint32)
        for p in range(self.planes - 1, -1, -1):
            bit = np.unpackbits(self._plane(p), count=self.n, bitorder="little").view(np.bool_)
            out = np.empty_like(cur)
            out[np.flatnonzero(~bit)] = cur[: self.zeros[p]]
            out[np.flatnonzero(bit)] = cur[self.zeros[p] :] | cur.dtype.type(1 << (self.planes - 1 - p))
            cur = out
        return cur.astype(np.uint32)


class FastEncoder:
    """The tokenizers library behind a bounded cache of words.

    A space between two characters that are no white space begins a word of the byte-level pattern, and a single line feed
    between such characters is a word of its own, as are marks behind letters and digits. So texts are cut there, each distinct
    piece of a batch is looked up once, and pieces that are not in the cache are encoded by the library: letters by its model
    alone, the rest many in a call. A text
    with other white space at a cut, or with a special token, goes to the library whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        self.special = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self.cache, self.tails = Coded(np.uint16, CACHE), {}  # a piece: what follows a space; with its line feed, if it begins a line
        self.feed_id = self.lib.token_to_id("\u010a")
        vocab = self.lib.get_vocab()
        self.leads = np.zeros(max(vocab.values()) + 1, np.bool_)
        self.leads[[i for t, i in vocab.items() if t.startswith("\u0120")]] = True
        # letters alone are one match of the pattern, so the library's model can take them at once, bytes written as in its vocabulary
        kind = str(self.lib.pre_tokenizer)
        self.plain = self.lib.normalizer is None and kind.startswith("ByteLevel(add_prefix_space=False") and "use_regex=True" in kind
        same = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = iter(range(256, 512))
        spelled = [chr(c if c in same else next(other)).encode() for c in range(256)]
        self.wide = np.array([len(x) for x in spelled])
        self.first, self.second = (np.array([x[i] if len(x) > i else 0 for x in spelled], np.uint8) for i in (0, 1))

    def _spelled(self, words):
        """A column of words as the vocabulary writes them: a character for each byte."""
        words = words.cast(pa.large_binary())
        at = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1)
        raw = np.frombuffer(words.buffers()[2], np.uint8, at[-1])
        to = np.append(0, np.cumsum(self.wide[raw]))
        out = np.empty(to[-1], np.uint8)
        out[to[:-1]] = self.first[raw]
        two = np.flatnonzero(self.wide[raw] == 2)
        out[to[two] + 1] = self.second[raw[two]]
        return pa.LargeStringArray.from_buffers(len(words), pa.py_buffer(to[at]), pa.py_buffer(out))

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.lib.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint16)

    def _tail(self, marks: str) -> bytes:
        if len(self.tails) > 10_000:
            self.tails = {}
        if marks not in self.tails:
            self.tails[marks] = self._whole(marks).tobytes()
        return self.tails[marks]

    def _learn(self, pieces, special: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces (an Arrow column), end to end, and the number of each one's; 0 for one that cannot stand alone. special: special tokens stand somewhere."""
        bare = pc.utf8_rtrim(pieces, characters=MARKS)
        size, bare_size = (pc.binary_length(x).to_numpy().astype(np.int64) for x in (pieces, bare))
        lines = pc.starts_with(bare, "\n")
        letters = pc.utf8_is_alnum(pc.if_else(lines, pc.utf8_slice_codeunits(bare, 1), bare))
        cores = pc.if_else(letters, bare, pieces)
        marks = np.where(letters.to_numpy(zero_copy_only=False), size - bare_size, 0)
        distinct = cores.dictionary_encode()
        cores, code = distinct.dictionary, distinct.indices.to_numpy()
        # a core may be known
        at = self.cache.find(*value_hashes(cores))
        known = np.flatnonzero(at >= 0)
        known = known[self.cache.n[at[known]] > 0]
        start, n = np.zeros(len(cores), np.int64), np.zeros(len(cores), np.int64)
        n[known] = self.cache.n[at[known]]
        start[known] = np.cumsum(n[known]) - n[known]
        pool = [self.cache.gather(at[known])]
        held = len(pool[0])
        fit = np.zeros(len(cores), np.bool_)
        fit[code] = letters.to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(~fit).tolist() if not special else range(len(cores)):
            c = cores[i].as_py()
            word = c[1:] if c[:1] == "\n" else c
            fit[i] = bool(word) and not word[0].isspace() and not word[-1].isspace() and not (special and any(s in word for s in self.special))
        fit[known] = False
        line = pc.starts_with(cores, "\n").to_numpy(zero_copy_only=False)
        if self.plain and not special:
            body = pc.if_else(pc.starts_with(cores, "\n"), pc.utf8_slice_codeunits(cores, 1), cores)
            only = fit & pc.utf8_is_alpha(body).to_numpy(zero_copy_only=False)
            tokenize = self.lib.model.tokenize
            for part, lead, first in ((np.flatnonzero(only & ~line), "\u0120", []), (np.flatnonzero(only & line), "", [self.feed_id])):
                words = pc.binary_join_element_wise(pa.scalar(lead, pa.large_string()), self._spelled(body.take(pa.array(part))), pa.scalar("", pa.large_string())) if len(part) else []
                for a in range(0, len(part), 5000):
                    some = part[a : a + 5000]
                    own = [first + [t.id for t in tokenize(w)] for w in words[a : a + 5000].to_pylist()]
                    n[some] = [len(x) for x in own]
                    start[some] = held + np.cumsum(n[some]) - n[some]
                    pool.append(np.array(list(itertools.chain.from_iterable(own)), np.uint16))
                    held += len(pool[-1])
            fit &= ~only
        # one call for many pieces: in its ids a piece begins where a token has its space, or with the line feed's token
        for part, sep in ((np.flatnonzero(fit & ~line), " "), (np.flatnonzero(fit & line), "")):
            for a in range(0, len(part), 5000):
                some = part[a : a + 5000]
                ids = self._whole(sep + sep.join(cores.take(pa.array(some)).to_pylist()))
                starts = np.flatnonzero(self.leads[ids] if sep else ids == self.feed_id)
                if len(starts) != len(some):
                    raise ValueError(f"{len(some)} pieces, but {len(starts)} beginnings")
                start[some], n[some] = held + starts, np.diff(np.append(starts, len(ids)))
                pool.append(ids)
                held += len(ids)
        # the marks of a piece follow its core
        ends = np.cumsum(size)
        raw = np.frombuffer(pa.concat_arrays([pieces]).cast(pa.large_binary()).buffers()[2] or b"", np.uint8)
        which = np.flatnonzero(marks)
        tails = _slices(raw, ends[which] - marks[which], marks[which])
        offsets = np.append(0, np.cumsum(marks[which]))
        tails = pa.LargeStringArray.from_buffers(len(which), pa.py_buffer(offsets), pa.py_buffer(tails)).dictionary_encode()
        own = [np.frombuffer(self._tail(t), np.uint16) for t in tails.dictionary.to_pylist()]
        own_n = np.array([len(x) for x in own], np.int64)
        own_start = held + np.cumsum(own_n) - own_n
        both_start, both_n = np.zeros((len(pieces), 2), np.int64), np.zeros((len(pieces), 2), np.int64)
        both_start[:, 0], both_n[:, 0] = start[code], n[code]
        tail = tails.indices.to_numpy()
        both_start[which, 1], both_n[which, 1] = own_start[tail], own_n[tail]
        return _slices(np.concatenate([*pool, *own]), both_start.ravel(), both_n.ravel()), both_n.sum(1).astype(np.int32)

    def _known(self, pieces, special: bool) -> np.ndarray:
        """Places of the pieces (an Arrow column) in the cache, which learns those that it has not."""
        one, two = value_hashes(pieces)
        new = np.flatnonzero(self.cache.find(one, two) < 0)
        self.cache.add_flat(one[new], two[new], *self._learn(pieces.take(pa.array(new)), special))
        return self.cache.find(one, two)

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of an Arrow string column, end to end, with END behind each; the number of each one's ids."""
        texts = texts.fill_null("")
        if not len(texts):
            return np.zeros(0, np.uint16), np.zeros(0, np.int64)
        # each text as a line of its own; the token of its line feed becomes the END of the text before
        cut = pc.split_pattern(pc.binary_join_element_wise("\n", pc.replace_substring(texts, "\n", " \n"), ""), " ")
        flat = cut.flatten().dictionary_encode()
        places = self._known(flat.dictionary, any(pc.any(pc.match_substring(texts, s)).as_py() for s in self.special))
        alone = (places < 0) | (self.cache.n[places] == 0)
        code = flat.indices.to_numpy()
        first = np.diff(cut.offsets.to_numpy())
        first = np.cumsum(first) - first
        n = np.add.reduceat(np.where(alone, 0, self.cache.n[places])[code], first, dtype=np.int64)
        ids = self.cache.gather(places[code[~alone[code]]])
        whole = np.flatnonzero(np.logical_or.reduceat(alone[code], first))
        if len(whole):
            parts, at, ends = [], 0, np.cumsum(n)
            for i in whole.tolist():
                own = self._whole(texts[i].as_py()) if len(texts[i].as_py()) else np.zeros(0, np.uint16)
                parts += [ids[at : ends[i] - n[i]], np.zeros(1, np.uint16), own]
                at = int(ends[i])
                n[i] = 1 + len(own)
            ids = np.concatenate([*parts, ids[at:]])
        starts = np.cumsum(n) - n
        ids[starts] = END
        return np.append(ids, np.uint16(END))[1:], n


_encoders: dict[str, FastEncoder] = {}


def write(docs: DataFrame, path: str, scratch: Scratch, shard: int = SHARD) -> DataFrame:
    """The table of shards: part, seq (their order), doc_ids, sizes (binary, 8 and 4 bytes each), n_ids, file."""

    @tidied
    def run(batches):
        if path not in _encoders:
            _encoders[path] = FastEncoder(path)
        part, seq, ids, docs_, sizes, held = TaskContext.get().partitionId(), 0, [], [], [], 0

        def cut():
            file = build(np.concatenate(ids))
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "doc_ids": pa.array([np.concatenate(docs_).tobytes()], pa.binary()), "sizes": pa.array([np.concatenate(sizes).astype("<u4").tobytes()], pa.binary()), "n_ids": pa.array([held], pa.int64()), "file": pa.array([file], pa.binary())})

        for b in batches:
            own, n = _encoders[path].encode(b.column("text"))
            docs_here, at = b.column("doc_id").fill_null(NO_ID).to_numpy().astype("<i8"), 0
            ends = np.cumsum(n)
            while at < len(n):  # as many documents as fill the shard
                before = int(ends[at - 1]) if at else 0
                to = min(len(n), int(np.searchsorted(ends, before + shard - held)) + 1)
                ids.append(own[before : int(ends[to - 1])])
                docs_.append(docs_here[at:to])
                sizes.append(n[at:to])
                held, at = held + len(ids[-1]), to
                if held >= shard:
                    yield cut()
                    seq, ids, docs_, sizes, held = seq + 1, [], [], [], 0
        if ids:
            yield cut()

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = docs.select("doc_id", "text", F.xxhash64("text").alias("hash")).repartitionByRange(n, "doc_id", "hash").sortWithinPartitions("doc_id", "hash").drop("hash")
    return scratch.keep(ranges.mapInArrow(run, "part int, seq int, doc_ids binary, sizes binary, n_ids long, file binary"), "shards")


def read(shards: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, n_ends (how often the end id stands in it, by ranks), ids (binary, little-endian unsigned 32-bit) from the files."""
    return _read(shards, "ids binary", lambda x: x.tobytes(), pa.binary())


def _read(shards: DataFrame, field: str, made, kind) -> DataFrame:
    spark = shards.sparkSession
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n")).toPandas().sort_values("part")  # one row a task that wrote
    parts["base"] = parts["n"].cumsum() - parts["n"]
    bases = spark.createDataFrame([(int(a), int(b)) for a, b in parts[["part", "base"]].to_numpy()] or [(0, 0)], "part int, base long")
    inner = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_ids")
    starts = shards.select("part", "seq", inner.alias("inner")).join(F.broadcast(bases), "part").select("part", "seq", (F.col("inner") + F.col("base")).alias("start"))

    @tidied
    def run(batches):
        for b in batches:
            for docs, sizes, file, start in zip(*(b.column(c).to_pylist() for c in ("doc_ids", "sizes", "file", "start")), strict=True):
                matrix = WaveletMatrix(file)
                ids = matrix.decode().astype("<u4", copy=False)
                n = np.frombuffer(sizes, "<u4").astype(np.int64)
                ends = np.cumsum(n)
                out = [made(ids[e - k : e]) for e, k in zip(ends.tolist(), n.tolist(), strict=True)]
                own = np.frombuffer(docs, "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(own, mask=own == NO_ID), pa.array(start + ends - n), pa.array(n), pa.array(matrix.counts(END, ends)), pa.array(out, kind)], ["doc_id", "start", "n_tokens", "n_ends", field.split()[0]])

    return shards.join(F.broadcast(starts), ["part", "seq"]).select("doc_ids", "sizes", "file", "start").mapInArrow(run, f"doc_id long, start long, n_tokens long, n_ends long, {field}")


def op7_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    bounded_batches(spark, 4000, 8 << 20)  # larger batches have fewer distinct pieces
    shards = write(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), Scratch(spark, "op7"))
    return _read(shards, "ids_crc32 long", lambda x: zlib.crc32(x.tobytes()), pa.int64())
