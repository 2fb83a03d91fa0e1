"""BPE encoding and decoding with a given vocabulary.

Encoder: all vocabulary entries form an Aho-Corasick automaton over base symbols. One pass over a word gives the longest entry
at each place; tokens are taken longest first and kept while each neighbouring pair is compatible, which means that the merges
would really leave the two beside each other. An incompatible pair makes the encoder try the next shorter prefix, or step back.
The sequence in which all pairs are compatible is unique and is what the merges give. Words are found by the tokenizer's own
normal form and pattern. What stands between white space is looked up once a batch, in a cache that is bounded in bytes.

Decoder: the tokens' strings lie in one buffer; an offset table gives each token's slice, and one gather builds the text.

Null text is empty: no tokens, empty decoded text. Special tokens that stand in a text are recognised, as by the library. Rows are
coded one by one: repeated rows and ids give as many rows, an empty table none; there are no ties, and other columns are unread.
"""

import hashlib
import json
import unicodedata
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import Coded, bounded_batches, table, tidied, value_hashes

#: Pieces, and words within them, that a worker's caches hold at most; pairs whose compatibility is held (a power of 2).
PIECES, WORDS, PAIRS = 300_000, 400_000, 1 << 19


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(rest)) for b in range(256)]


class Encoder:
    """Exact BPE for a vocabulary file of the tokenizers library whose words end in a suffix symbol."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab, self.suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        self.pattern = regex.compile(next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.find_special = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        size = max(max(self.vocab.values()), max(self.special.values(), default=0)) + 1
        self.texts = [""] * size
        for t, i in [*self.vocab.items(), *self.special.items()]:
            self.texts[i] = t
        # symbols: a byte, or a byte that ends a word; a token is a string over these
        of_byte = byte_symbols()
        self.inner = [chr(b) for b in range(256)]
        self.last = [chr(b + 256) for b in range(256)] if self.suffix else self.inner
        back = {c: b for b, c in enumerate(of_byte)}
        self.parts: list[tuple[int, int] | None] = [None] * size
        self.pairs: dict[tuple[int, int], int] = {}
        self.order = [0] * size  # place among the merges: what was merged first is lowest; single symbols come before
        for rank, (a, b) in enumerate(model["merges"]):
            i = self.vocab[a + b]
            x, y = self.vocab[a], self.vocab[b]
            self.parts[i], self.order[i] = (x, y), rank + 1
            self.pairs[x, y] = i
        self.width = [0] * size
        self.automaton = ahocorasick.Automaton()
        names = {}
        for t, i in self.vocab.items():
            ends = self.suffix and t.endswith(self.suffix) and t != self.suffix
            body = t[: -len(self.suffix)] if ends else t
            s = "".join(self.inner[back[c]] for c in body[:-1]) + (self.last if ends else self.inner)[back[body[-1]]]
            names[s] = i
            self.width[i] = len(s)
            self.automaton.add_word(s, i)
        self.automaton.make_automaton()
        self.shorter = [-1] * size
        for s, i in names.items():
            self.shorter[i] = next((names[s[:n]] for n in range(len(s) - 1, 0, -1) if s[:n] in names), -1)
        kind = np.uint32 if size > 1 << 16 else np.uint16
        self.pieces, self.words = Coded(kind, PIECES), Coded(kind, WORDS)
        # the pair-compatibility table, filled as pairs come: of the pairs that share a place it holds the last one
        self.pair, self.fit = array("q", [-1]) * PAIRS, bytearray(PAIRS)

    def compatible(self, a: int, b: int) -> bool:
        """Whether the merges leave token a before token b as they are: no merge across their border comes in time.

        Undoes the later of the merges that made a's right edge and b's left edge, step by step; a merge of the two edge
        tokens that would have come before the one just undone rules the pair out.
        """
        parts, order, pairs = self.parts, self.order, self.pairs
        before = 1 << 60
        while True:
            across = pairs.get((a, b))
            if across is not None and order[across] < before:
                return False
            pa_, pb = parts[a], parts[b]
            if pa_ is None and pb is None:
                return True
            # of two equal merges the left one comes first, so b's is undone first
            if pb is None or (pa_ is not None and order[a] > order[b]):
                before, a = order[a], pa_[1]
            else:
                before, b = order[b] + 1, pb[0]

    def encode_word(self, word: str) -> list[int]:
        """Tokens of one word, without spaces; linear in its length but for the steps back."""
        width, shorter, pair, fits = self.width, self.shorter, self.pair, self.fit
        if word.isascii():
            s = word[:-1] + self.last[ord(word[-1])]
        else:
            raw = word.encode()
            s = raw[:-1].decode("latin-1") + self.last[raw[-1]]
        n = len(s)
        longest = [-1] * n
        for end, t in self.automaton.iter(s):  # ends ascend, so the longest at a place comes last
            longest[end - width[t] + 1] = t
        token = longest[0]
        if width[token] == n:
            return [token]
        out, at, open_ = [], 0, bytearray(b"\1") * (n + 1)
        while True:
            previous = out[-1] if out else -1
            while True:
                end = at + width[token]
                if open_[end]:
                    if previous < 0:
                        fit = True
                    else:
                        key = previous << 32 | token
                        place = (key * 0x9E3779B97F4A7C15 >> 40) & (PAIRS - 1)
                        if pair[place] != key:
                            pair[place], fits[place] = key, self.compatible(previous, token)
                        fit = fits[place]
                    if fit:
                        out.append(token)
                        if end == n:
                            return out
                        at, token = end, longest[end]
                        break
                token = shorter[token]
                if token < 0:
                    open_[at] = 0
                    token = out.pop()
                    at -= width[token]
                    break

    def _words(self, chunk: str) -> list[str]:
        """Normal form and split of what stands between white space."""
        if chunk.isascii():
            chunk = chunk.lower()
        else:
            chunk = "".join([c.lower() for c in unicodedata.normalize("NFC", chunk)])
        return [chunk] if chunk.isalpha() else self.pattern.findall(chunk)

    def _learn(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece; a piece has no ASCII white space in it."""
        words = [self._words(p) if p.isascii() else [w for c in SPACE.split(p) if c for w in self._words(c)] for p in pieces]
        distinct = list({w for x in words for w in x})
        one, two = value_hashes(pa.array(distinct, pa.string()))
        at, known, kind = self.words.find(one, two).tolist(), {}, self.words.kind
        start, n, raw = self.words.at, self.words.n, self.words.ids
        new = [i for i, x in enumerate(at) if x < 0]
        for w, i in zip(distinct, at, strict=True):
            known[w] = raw[start[i] : start[i] + n[i]].tobytes() if i >= 0 else np.array(self.encode_word(w), kind).tobytes()
        self.words.add(one[new], two[new], [known[distinct[i]] for i in new])
        return [b"".join([known[w] for w in x]) for x in words]

    def encode(self, text: str) -> bytes:
        """Token ids as unsigned 32-bit integers, little-endian as all machines that Spark runs on."""
        if self.find_special and "<|" in text:
            return b"".join(np.array([self.special[x]], "<u4").tobytes() if x in self.special else self._plain(x) for x in self.find_special.split(text))
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        words = [w for c in SPACE.split(text) if c for w in self._words(c)]
        return np.array([t for w in words for t in self.encode_word(w)], "<u4").tobytes()

    def encode_all(self, texts) -> list[bytes]:
        """The same of each text of an Arrow string column; null as empty."""
        texts = texts.fill_null("")
        if not len(texts):
            return []
        special = np.zeros(len(texts), np.bool_)
        if self.find_special:
            special |= pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)
        cut = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        flat = cut.flatten().dictionary_encode()
        code, starts = flat.indices.to_numpy(), cut.offsets.to_numpy()
        one, two = value_hashes(flat.dictionary)
        new = np.flatnonzero(self.pieces.find(one, two) < 0)
        self.pieces.add(one[new], two[new], self._learn(flat.dictionary.take(pa.array(new)).to_numpy(zero_copy_only=False).tolist()))
        places = self.pieces.find(one, two)
        lost = places < 0  # two pieces with one hash
        size = np.where(lost, 0, self.pieces.n[places])[code]
        ids = self.pieces.gather(places[code]).astype("<u4", copy=False).tobytes() if not lost.any() else b""
        ends = 4 * np.append(0, np.cumsum(size, dtype=np.int64))[starts - starts[0]]
        return [self.encode(texts[i].as_py()) if x or lost.any() else ids[a:b] for i, (x, a, b) in enumerate(zip(special.tolist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True))]


#: The white space of the pattern.
SPACE = regex.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


class Decoder:
    """Token strings with a space between, which is what the library gives where no decoder is set."""

    #: Tokens whose text is built at once.
    STEP = 100_000

    def __init__(self, texts: list[str]):
        raw = [t.encode() + b" " for t in texts]
        self.size = np.array([len(r) for r in raw], np.int32)
        self.offset = (np.cumsum(self.size) - self.size).astype(np.int32)
        self.buffer = np.frombuffer(b"".join(raw), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        out = []
        for a in range(0, len(ids), self.STEP):
            part = ids[a : a + self.STEP]
            size = self.size[part]
            ends = np.cumsum(size, dtype=np.int32)
            at = np.arange(int(ends[-1]), dtype=np.int32)
            at += np.repeat(self.offset[part] - (ends - size), size)
            out.append(self.buffer[at].tobytes())
        return b"".join(out)[:-1]


_made: dict[str, tuple[Encoder, Decoder]] = {}


def coder(path: str) -> tuple[Encoder, Decoder]:
    """One encoder and decoder a worker; its caches outlive a task."""
    if path not in _made:
        e = Encoder(path)
        _made[path] = e, Decoder(e.texts)
    return _made[path]


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit), decoded (string) of every document."""

    @tidied
    def run(batches):
        encoder, decoder = coder(path)
        for b in batches:
            ids = encoder.encode_all(b.column("text"))
            texts = [decoder.decode(np.frombuffer(x, "<u4")) for x in ids]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ids, pa.binary()), pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "ids", "decoded"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids binary, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """As encode_documents, but count and hashes instead of the ids and texts."""

    @tidied
    def run(batches):
        encoder, decoder = coder(path)
        for b in batches:
            n, one, two = [], [], []
            for ids in encoder.encode_all(b.column("text")):
                n.append(len(ids) // 4)
                one.append(hashlib.sha256(ids).hexdigest())
                two.append(hashlib.sha256(decoder.decode(np.frombuffer(ids, "<u4"))).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(one, pa.string()), pa.array(two, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark, 2000)
    return digests(table(spark, sf_dir, "documents"), vocabulary())
