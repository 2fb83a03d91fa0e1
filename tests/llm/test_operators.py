"""Each operator against a plain version of what it must give."""

import hashlib
import math
import struct
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import public_tokenizers
from headerflow.llm import bpe, decontaminate, language, media, neardup, pitmanyor, quality, registry, sharding, substring, wavelet
from headerflow.llm.common import Scratch, word_hashes

from ..oracle import bag, connect, same
from .data import awkward, frame, tables

ROWS = awkward()
#: Rows that repeat, and one without an id.
REPEATED = [*ROWS, ROWS[10], ROWS[3], (None, "no id here"), (None, None)]
LABELS = [(i, i % 3 % 2, 0) for i, _ in ROWS if i % 4]
ITEMS = [(0, " ".join(f"item{i}" for i in range(20))), (1, None), (2, ""), (3, "too short")]


def text_of(t):
    return (t or "").encode()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    return tables(spark, tmp_path_factory.mktemp("t"), ROWS, LABELS, ITEMS)


@pytest.fixture(scope="module")
def repeated(spark, tmp_path_factory):
    return tables(spark, tmp_path_factory.mktemp("r"), REPEATED, [*LABELS, LABELS[0], (None, 1, 0), (5, None, 0)], ITEMS, extra=True)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return tables(spark, tmp_path_factory.mktemp("e"), [])


def run(spark, name, folder):
    return [r.asDict() for r in registry.queries()[name](spark, folder).collect()]


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_empty_tables(spark, empty, name):
    assert run(spark, name, empty) == []


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - {"op6_decontaminate"}))
def test_repeats_nulls_and_other_columns(spark, repeated, name):
    got = Counter(r["doc_id"] for r in run(spark, name, repeated))
    assert got == Counter(i for i, _ in REPEATED)


# 1


def test_language(spark, sf_dir):
    got = registry.queries()["op1_language"](spark, sf_dir)
    both = got.join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(both) > 40 and sum(r.lang == r.lang_pred for r in both) >= 0.95 * len(both)
    assert all(0 <= r.score <= 1 for r in both)


def test_language_kernel():
    a, b = "der hund lief", "le chien 7 court"
    m = language.Model([a, b], ["de", "fr"])
    n = lambda t: {x for k in (1, 2, 3) for x in zip(*(f" {t} "[i:] for i in range(k)), strict=False)}
    clean = ["der hund lief", "le chien court"]
    sets = [n(t) for t in clean]
    want = [[len(x & y) / math.sqrt(len(x) * len(y)) for y in sets] for x in sets]
    assert np.allclose(m.kernel([language.grams(a), language.grams(b)]), want, atol=1e-5)
    assert m.predict([None, "", "123 !!", "hund"])[0] == ["und", "und", "und", "de"]
    assert m.predict(["\U00020000\U00020001"])[0][0] in ("de", "fr") and m.predict(["\U0001f642"])[0] == ["und"]
    assert language.Model([], []).predict(["a"])[0] == ["und"]


# 2


def reference_components(rows):
    sets = {}
    for i, t in rows:
        w = text_of(t).lower().split()
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    label = {i: i for i in sets}
    changed = True
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return {i: (len(sets[i]), label[i], label[i] == i) for i in sets}


def test_near_duplicates(spark, folder):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in run(spark, "op2_neardup", folder)}
    assert got == reference_components(ROWS)


def test_near_duplicates_sql(spark, sf_dir):
    same(registry.queries()["op2_neardup"](spark, sf_dir), connect(sf_dir), registry.oracle_sql()["op2_neardup"])


def test_many_near_copies(spark, monkeypatch):
    """A family whose members mostly miss their least one, in blocks smaller than its buckets."""
    monkeypatch.setattr(neardup, "BLOCK", 7)
    monkeypatch.setattr(neardup, "HUB", 5)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(60):
        w = list(base)
        for j in range(i % 12):
            w[(i * 37 + j * 17) % 200] = f"x{i}"
        rows.append((i, " ".join(w)))
    got = neardup.near_duplicates(frame(spark, rows), Scratch(spark, "t")).collect()
    want = reference_components(rows)
    assert {r.doc_id: r.component_id for r in got} == {i: c for i, (_, c, _) in want.items()}


def test_rows_that_share_an_id(spark):
    """A document whose rows differ links what either is like; rows without an id take part."""
    base = " ".join(f"b{i}" for i in range(60))
    six = "one two three four five six"
    rows = [(1, six), (1, base), (2, base + " z"), (3, six), (9, six + " x y z"), (9, base + " y"), (None, base + " q"), (None, "nobody at all has this one text"), (None, None), (7, ""), (7, "seven eight")]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in neardup.near_duplicates(frame(spark, rows), Scratch(spark, "t")).collect()), key=str)
    assert got == sorted([(1, 2, 1), (1, 56, 1), (2, 57, 1), (3, 2, 1), (9, 5, 1), (9, 57, 1), (None, 57, 1), (None, 3, None), (None, 0, None), (7, 0, 7), (7, 1, 7)], key=str)
    kept = neardup.keep_first(frame(spark, rows, True), Scratch(spark, "t")).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted([(1, six), (1, base), (9, six + " x y z"), (None, "nobody at all has this one text"), (None, None), (7, ""), (7, "seven eight")], key=str)


def test_estimate():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    for share in (0.2, 0.75, 0.9):
        n = int(2000 * 2 * share / (1 + share))
        a, b = x[:2000], np.concatenate([x[:n], x[2000 : 4000 - n]]) if n >= 1000 else np.concatenate([x[:n], rng.integers(0, 1 << 63, 2000 - n).astype(np.uint64)])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        s = [neardup.pack(neardup.minima([np.unique(neardup.mix(y))]))[0].view(np.uint64) for y in (a, b)]
        assert abs(float(neardup.estimate(*s)) - true) < 0.1


def test_small_sets_at_the_threshold(spark):
    """Pairs of few shingles with a similarity of exactly 0.75: the estimate alone loses some."""
    rows, lost = [], 0
    for i in range(4000):
        k = (4, 8, 12, 40, 80)[i % 5]
        w = [f"x{i}y{j}" for j in range(k + 4)]
        a, b = " ".join(w), " ".join(w[: k * 3 // 4 + 4])
        rows += [(2 * i, a), (2 * i + 1, b)]
        s = [neardup.pack(neardup.minima([neardup.shingles(word_hashes(t.encode().split()))]))[0].view(np.uint64) for t in (a, b)]
        lost += float(neardup.estimate(*s)) < 0.69
    assert lost > 0
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(frame(spark, rows), Scratch(spark, "t")).collect()}
    assert got == {i: i // 2 * 2 for i, _ in rows}


def test_alike():
    rng = np.random.default_rng(6)
    sets = [[], []]
    for _ in range(300):
        x = rng.choice(120, rng.integers(1, 86), replace=False)
        y = np.concatenate([x[: rng.integers(0, len(x) + 1)], 200 + rng.choice(120, rng.integers(1, 12), replace=False)])[:85]
        for side, z in zip(sets, (x, y), strict=True):
            side.append(np.unique(neardup.mix(z.astype(np.uint64))))
    want = [4 * len(np.intersect1d(x, y)) >= 3 * len(np.union1d(x, y)) for x, y in zip(*sets, strict=True)]
    n = tuple(np.array([len(x) for x in side]) for side in sets)
    carried = tuple(neardup._sets(__import__("pyarrow").array([x.tobytes() for x in side])) for side in sets)
    none = np.zeros((300, 64), np.uint64)
    assert neardup.alike(n, (none, none), carried).tolist() == want and 0 < sum(want) < 300


# 3


def test_sharding(spark, folder, repeated):
    for f, source in ((folder, ROWS), (repeated, REPEATED)):
        rows = run(spark, "op3_sharding", f)
        want = Counter((i, len(text_of(t)) + 1, zlib.crc32(text_of(t))) for i, t in source)
        assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
        shards = defaultdict(list)
        for r in rows:
            shards[r["shard"]].append(r)
        assert all(sorted(r["slot"] for r in s) == list(range(len(s))) for s in shards.values())
        assert set(shards) <= set(range(8)) and {r["law"] for r in rows} == {"bytes"} and {r["grown_shard"] for r in rows} == {None}


@pytest.mark.parametrize("hot", [0, 2000, 6000])
def test_shards_are_equal(spark, hot):
    """Equal keys of a third of the rows or of all, with sizes from 1 to 1000: shards differ by a record at most beyond the groups kept whole."""
    rows = [(i, 1 + i * i % 1000, 7 if i < hot else (i * 2654435761) % (1 << 40), (i * 40503) % (1 << 31)) for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, size long, key long, sub long")
    got = sharding.shard(df, Scratch(spark, "t")).groupBy("shard").sum("size").collect()
    total = sum(r[1] for r in rows)
    assert len(got) == 8 and all(abs(r[1] - total / 8) <= 1000 + sharding.SPLIT * total / 8 for r in got)


# 4


def reference_substring(rows, size=35):
    words = [text_of(t).split() for _, t in rows]
    seen = Counter(tuple(w[j : j + size]) for w in words for j in range(len(w) - size + 1))
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = set()
        for j in range(len(w) - size + 1):
            if seen[tuple(w[j : j + size])] > 1:
                gone |= set(range(j, j + size))
        kept = [x for j, x in enumerate(w) if j not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("hot", [0, 1, 4000])
def test_substring(spark, folder, repeated, monkeypatch, hot):
    monkeypatch.setattr(substring, "HOT", hot)
    for f, rows in ((folder, ROWS), (repeated, REPEATED)):
        got = Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in run(spark, "op4_substring", f))
        assert got == reference_substring(rows)


def test_substring_sql(spark, sf_dir):
    same(registry.queries()["op4_substring"](spark, sf_dir), connect(sf_dir), registry.oracle_sql()["op4_substring"])


def test_tree():
    rng = np.random.default_rng(2)
    for size in (1, 2, 3, 7, 35):
        w = rng.integers(0, 3, 400).astype(np.uint64)
        w[200:300] = w[50:150]
        starts = np.arange(0, 400 - size + 1, 2)
        seen = Counter(w[s : s + size].tobytes() for s in starts)
        assert substring.repeats(w, starts, size).tolist() == [seen[w[s : s + size].tobytes()] > 1 for s in starts]


# 5


@pytest.fixture(scope="module")
def word_tokenizer():
    return Tokenizer.from_file(bpe.vocabulary())


def test_bpe(spark, folder, word_tokenizer):
    for r in run(spark, "op5_bpe", folder):
        ids = word_tokenizer.encode(text_of(dict(ROWS)[r["doc_id"]]).decode(), add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(word_tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_on_random_texts(word_tokenizer):
    encoder, decoder = bpe.coder(bpe.vocabulary())
    rng = np.random.default_rng(4)
    alphabet = list("abcdefgh ABC'st\n\t 123,.!?éßçÅΣσİı中文́\x85\x1d🙂<|")
    for _ in range(400):
        t = "".join(rng.choice(alphabet, rng.integers(0, 50)))
        ids = word_tokenizer.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(t), "<u4").tolist() == ids, t
        assert decoder.decode(np.array(ids, np.uint32)) == word_tokenizer.decode(ids, skip_special_tokens=False).encode()


def test_encoded_documents(spark, word_tokenizer):
    got = {r.doc_id: r for r in bpe.encode_documents(frame(spark, ROWS, True), bpe.vocabulary()).collect()}
    assert np.frombuffer(got[10].ids, "<u4").tolist() == word_tokenizer.encode(ROWS[10][1], add_special_tokens=False).ids
    assert got[0].decoded == "" and got[0].ids == b""


# 6


def test_decontamination_sql(spark, sf_dir):
    same(registry.queries()["op6_decontaminate"](spark, sf_dir), connect(sf_dir), registry.oracle_sql()["op6_decontaminate"])


def test_decontamination_parameters(spark, tmp_path, monkeypatch):
    item = "A train leaves the old station at 9 with 120 km to go and Maria waits while Maria reads for 3 hours"
    same_shape = item.replace("9", "11").replace("120", "75").replace("Maria", "Tom").replace("3 hours", "5 minutes")
    broken = item.replace("Maria reads", "Tom reads")
    rows = [(1, "Before. " + item + " after"), (2, same_shape), (3, broken), (4, "the old station is a place with a name and nothing more"), (5, None), (6, ""), (7, item.upper())]
    f = tables(spark, tmp_path / "x", [*rows, rows[0]], items=[(7, item), (8, None), (9, "")])
    for limit in (20_000, 0):
        monkeypatch.setattr(decontaminate, "ANCHORS", limit)
        df = registry.queries()["op6_decontaminate"](spark, f)
        got = {r.doc_id: r for r in df.collect()}
        assert {1, 2} <= set(got) and not {4, 5, 6} & set(got)
        assert got[1].n_exact == got[1].n_windows and got[2].n_exact < got[2].n_windows
        # the window with both names is inconsistent, others are not
        assert got[3].n_windows < got[1].n_windows
        con = __import__("duckdb").connect()
        for t in ("documents", "benchmark"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{f}/{t}.parquet/*.parquet'")
        same(df, con, registry.oracle_sql()["op6_decontaminate"])


def test_decontamination_of_items_full_of_numbers(spark, tmp_path, monkeypatch):
    items = [(1, "Compute 3 + 4 * 7 - 2 / 5"), (2, "What is 12 * 7?"), (3, "12 7"), (4, "* ?")]
    rows = [(1, "We ask: Compute 3 + 4 * 7 - 2 / 5 and more"), (2, "so what is 12 * 7 then"), (3, "compute 9 + 8 * 1 - 3 / 6"), (4, "What is 13 * 7?"), (5, "12 8"), (6, "it has 12 7 in it"), (7, None)]
    f = tables(spark, tmp_path / "x", [*rows, rows[0]], items=items)
    for limit in (20_000, 0):
        monkeypatch.setattr(decontaminate, "ANCHORS", limit)
        got = {(r.doc_id, r.item_id): (r.n_windows, r.n_exact, r.first_word) for r in registry.queries()["op6_decontaminate"](spark, f).collect()}
        assert got == {(1, 1): (3, 3, 2), (2, 2): (1, 1, 1), (6, 3): (1, 1, 2)}


# 7


def test_wavelet_matrix():
    rng = np.random.default_rng(6)
    for ids in (np.zeros(0, np.uint16), np.zeros(5, np.uint16), np.array([7], np.uint16), rng.integers(0, 50, 3000).astype(np.uint16), rng.integers(0, 50257, 1025).astype(np.uint16), rng.integers(0, 1 << 20, 600).astype(np.uint32), rng.integers(0, 90, 70000).astype(np.uint16)):
        w = wavelet.WaveletMatrix(wavelet.build(ids))
        assert len(w) == len(ids) and w.decode().tolist() == ids.tolist()
        for i in range(0, len(ids), 97 if len(ids) < 5000 else 5003):
            assert w.access(i) == ids[i]
        for t in [*set(ids[:5].tolist()), 3, 1 << 22]:
            at = np.flatnonzero(ids == t)
            assert w.count(t) == len(at) and w.count(t, 2, 9) == int((ids[2:9] == t).sum())
            assert [w.locate(t, k) for k in range(min(5, len(at)))] == at[:5].tolist()
            with pytest.raises(IndexError):
                w.locate(t, len(at))
            ends = np.unique([*range(0, len(ids), 61), len(ids)])
            assert w.counts(t, ends).tolist() == [int((ids[a:b] == t).sum()) for a, b in zip([0, *ends[:-1]], ends, strict=True)]
    with pytest.raises(ValueError):
        wavelet.WaveletMatrix(b"XXXX" + bytes(40))


def test_token_output(spark, folder, monkeypatch):
    monkeypatch.setattr(wavelet.write, "__defaults__", (500,))
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r["doc_id"]: r for r in run(spark, "op7_wavelet", folder)}
    start = 0
    for i, t in ROWS:
        ids = [*lib.encode(text_of(t).decode(), add_special_tokens=False).ids, 2]
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)


def test_fast_encoder(monkeypatch):
    monkeypatch.setattr(wavelet, "CACHE", 100)  # the cache turns often
    path = public_tokenizers.path("byte_bpe_50k.json")
    lib, fast, rng = Tokenizer.from_file(path), wavelet.FastEncoder(path), np.random.default_rng(8)
    alphabet = list("abc de'sll\n 12,.é中\t\x85🙂")
    texts = ["".join(rng.choice(alphabet, rng.integers(0, 40))) for _ in range(600)] + ["a<|endoftext|>b", "a  b", " a", "a ", "\n", "a\n\nb", "a \nb"]
    for a in range(0, len(texts), 50):
        part = texts[a : a + 50]
        ids, n = fast.encode(pa.array(["gone", *part, None]).slice(1))
        want = [[*lib.encode(t, add_special_tokens=False).ids, 2] for t in [*part, ""]]
        assert n.tolist() == [len(x) for x in want] and ids.tolist() == sum(want, [])
    assert fast.encode(pa.array([], pa.string()))[0].tolist() == []


def test_pieces_are_learned_by_columns():
    path = public_tokenizers.path("byte_bpe_50k.json")
    lib, fast = Tokenizer.from_file(path), wavelet.FastEncoder(path)
    words = ["word", "Ünder", "中文", "x2", "½", "²", "e\u0301", "don't", "a-b", "\u00a0", "ⓐ", "ª", "\u200d", "1.5", ""]
    pieces = pa.array([x + w + m for x in ("", "\n") for w in words for m in ("", ".", "?!", "$,;")])
    for _ in range(2):  # the second time cores may be known
        flat, n = fast._learn(pieces, False)
        assert len(n) == len(pieces) and n.sum() == len(flat)
    texts = ["a " + p + " b" for p in pieces.to_pylist()]
    for part in (texts, texts[::-1], texts[:3]):  # the last two have nothing new
        ids, n = fast.encode(pa.array(part))
        want = [[*lib.encode(t, add_special_tokens=False).ids, 2] for t in part]
        assert n.tolist() == [len(x) for x in want] and ids.tolist() == sum(want, [])
    assert [len(x) for x in fast._learn(pieces.slice(0, 0), False)] == [0, 0]


def test_planes_are_faster_than_masks():
    ids = np.random.default_rng(5).integers(0, 50_000, 500_000).astype(np.uint16)

    def masked():
        cur = ids
        for b in range(15, -1, -1):
            bit = (cur & np.uint16(1 << b)).astype(np.bool_)
            cur = np.concatenate([cur[~bit], cur[bit]])

    def took(f):
        start = time.process_time()
        f()
        return time.process_time() - start

    assert min(took(lambda: wavelet.build(ids)) for _ in range(5)) < min(took(masked) for _ in range(5))


def test_shards_are_smaller_than_their_ids(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    shards = wavelet.write(docs, public_tokenizers.path("byte_bpe_50k.json"), Scratch(spark, "t")).collect()
    assert sum(len(r.file) for r in shards) < sum(2 * r.n_ids for r in shards)
    got = wavelet.read(spark.createDataFrame(shards)).collect()
    assert all(r.n_ends == np.frombuffer(r.ids, "<u4").tolist().count(2) for r in got)


# 8


def test_media(spark, folder):
    for r in run(spark, "op8_media", folder):
        t = text_of(dict(ROWS)[r["doc_id"]])
        p = t + bytes(max(64, -(-len(t) // 64) * 64) - len(t))
        assert (r["n_bytes"], r["payload_bytes"]) == (len(t), len(p))
        assert r["payload_sha256"] == hashlib.sha256(p).hexdigest() and r["tail_crc32"] == zlib.crc32(p[-64:])
        assert (r["media_bytes"], r["media_sha256"]) == (len(p) + 44, hashlib.sha256(media.wav(p)).hexdigest())
        assert r["feature"].startswith("audio/wav;8000Hz;8bit;")


def png() -> bytes:
    chunk = lambda k, b: struct.pack(">I", len(b)) + k + b + struct.pack(">I", zlib.crc32(k + b))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 1, 1, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"\0\0")) + chunk(b"IEND", b"")


def test_sniffing(spark):
    gif = b"GIF89a\x01\x00\x01\x00\x00\x00\x00,\x00\x00\x00\x00\x01\x00\x01\x00\x00\x02\x02D\x01\x00;"
    bmp = b"BM" + struct.pack("<IIII", 58, 0, 54, 40) + struct.pack("<IIHHIIIIII", 1, 1, 1, 24, 0, 4, 0, 0, 0, 0) + bytes(4)
    jpeg = b"\xff\xd8\xff\xe0" + struct.pack(">H", 4) + b"ab" + b"\xff\xda\x00\x02" + b"xyz\xff\xd9"
    pdf, gz = b"%PDF-1.4 startxref 0 %%EOF", zlib.compress(b"hello", wbits=31)
    zip_ = b"PK\x03\x04data" + b"PK\x05\x06" + struct.pack("<HHHHIIH", 0, 0, 1, 1, 0, 0, 0)
    kinds = {"image/png": png(), "image/gif": gif, "image/bmp": bmp, "image/jpeg": jpeg, "application/pdf": pdf, "application/gzip": gz, "application/zip": zip_, "audio/wav": media.wav(b"abc" * 22)}
    for kind, x in kinds.items():
        assert media.sniff(x)[0] == (0, len(x), kind), kind
        assert (7, len(x), kind) in media.sniff(b"prefix " + x + b" tail"), kind
        assert media.sniff(x[: len(x) // 2]) == [], kind
    assert media.sniff(b"BM and RIFF and GIF89a and %PDF- and PK\x03\x04") == [] and media.sniff(b"") == []
    rows = [(1, "image/png", png()), (2, "image/png", gif), (3, None, None), (4, "text/plain", media.wav(b"xx" + png()))]
    got = {r.doc_id: r for r in media.annotate(spark.createDataFrame(rows, "doc_id long, declared string, media binary")).collect()}
    assert [got[i].type for i in (1, 2, 3, 4)] == ["image/png", "image/gif", "application/octet-stream", "audio/wav"]
    assert [got[i].corrected for i in (1, 2, 4)] == [False, True, True]
    assert [(e.start, e.type) for e in got[4].embedded] == [(46, "image/png")]


# 9


def test_quality(spark, sf_dir):
    got = registry.queries()["op9_quality"](spark, sf_dir).collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    held = [(labels[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in labels]
    assert sum(a == b for a, b in held) >= 0.8 * len(held)


def test_nearest_neighbours():
    texts = [b"aaa bbb ccc", b"ddd eee fff", b"aaa bbb ccd", b"zzz zzz zzz"]
    m = quality.Model(texts, [1, 0, 1, 0])
    x = np.stack([quality.bag(t) for t in texts]) * m.weight
    z = m.latent(x)
    want = []
    for i in range(4):
        w = np.clip(z[i] @ z.T, 1e-6, 1) ** quality.SHARP
        want.append(float((w * [1, 0, 1, 0]).sum() / w.sum()))
    assert np.allclose(m.score(texts), want, atol=1e-4)
    assert quality.Model([], []).score([b"x"]).tolist() == [1.0]


# 10


def test_language_model(spark, folder, repeated):
    for f, rows in ((folder, ROWS), (repeated, REPEATED)):
        tokens = [[*text_of(t).lower().split(), b"\r"] for _, t in rows]
        train = [i is None or zlib.crc32(str(i).encode()) % 10 != 0 for i, _ in rows]
        c = Counter(w for ws, ok in zip(tokens, train, strict=True) if ok for w in ws)
        n, v = sum(c.values()), len(c)
        want = bag([(i, i is not None and not ok, len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 6)) for (i, _), ws, ok in zip(rows, tokens, train, strict=True)], ["a", "b", "c", "d", "e", "f"])
        got = run(spark, "op10_pitmanyor", f)
        assert bag([(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got], ["a", "b", "c", "d", "e", "f"]) == want
        assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_language_model_beats_its_base(spark, sf_dir):
    got = [r for r in run(spark, "op10_pitmanyor", sf_dir) if r["held_out"]]
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)


def test_language_model_reads_words_in_context(spark):
    """Two documents with the same words: the one in the corpus's order is likelier, and by the conditional probabilities of a bigram."""
    train = " ".join(["red fox", "blue sky", "old man"][i * i % 7 % 3] for i in range(200))
    rows = [(i, train, True) for i in range(5)] + [(10, "red fox blue sky old man", False), (11, "fox red sky blue man old", False), (12, "zzz fox", False), (13, "yyy fox", False), (14, "red zzz", False)]
    got = {r.doc_id: r for r in pitmanyor.score_documents(spark.createDataFrame(rows, "doc_id long, text string, train boolean"), Scratch(spark, "t")).collect()}
    assert got[10].base_score == pytest.approx(got[11].base_score) and got[10].score > got[11].score + 3
    assert got[12].score == pytest.approx(got[13].score) and all(math.isfinite(r.score) for r in got.values())


def test_language_model_answers_a_sweep_once(spark, monkeypatch):
    """Rating reads the answers that a sweep had, instead of adding them up again in each of its rounds."""
    asked, answers = [], pitmanyor.answers
    monkeypatch.setattr(pitmanyor, "answers", lambda messages, parts: asked.append(1) or answers(messages, parts))
    rows = spark.createDataFrame([(1, "red fox blue sky", True), (2, "Red fox", False), (3, None, True), (4, "", False)], "doc_id long, text string, train boolean")
    got = pitmanyor.score_documents(rows, Scratch(spark, "t")).collect()
    assert sorted(r.doc_id for r in got) == [1, 2, 3, 4] and len(asked) == pitmanyor.SWEEPS + 1


def test_words_and_pairs_are_counted(spark):
    """Spellings, as cut from the texts, and counts of pairs against a plain count."""
    texts = ["Red fox\tRED Straße", "fox", "", "x" * 300 + " red fox", None, "end\nred fox red"]
    rows = spark.createDataFrame([(i, t, i != 1) for i, t in enumerate(texts)], "doc_id long, text string, train boolean")
    want, seen = Counter(), set()
    for i, t in enumerate(texts):
        words = [*(t or "").lower().split(), "\r"]
        for a, b in zip([None, *words], words, strict=False):
            want[b] += i != 1
            seen.add((a, b))
    got = [r.asDict() for r in pitmanyor.gathered(pitmanyor.postings(rows, 3, False), 3).collect()]
    count = dict(x for r in got for x in zip(bytes(r["spelling"]).decode().split("\n"), np.frombuffer(r["entries"], "<i8").tolist(), strict=True))
    assert count == {w: want[w] for w in want} and sum(r["tokens"] for r in got) == want.total()
    assert sum(len(r["context"]) // 4 for r in got) == len(seen)


def test_counts_of_any_size():
    """Pairs whose numbers do not fit beside their counts are sorted by themselves."""
    rng = np.random.default_rng(4)
    word, context = rng.integers(0, 50, 3000), rng.integers(0, 9, 3000)
    for most in (3, 1 << 40):
        count = rng.integers(0, most, 3000)
        want = Counter()
        for k, n in zip(zip(word.tolist(), context.tolist(), strict=True), count.tolist(), strict=True):
            want[k] += n
        for words in (50, 1 << 30):
            got = pitmanyor._counted(word, context, count, words, 9)
            assert list(zip(*(x.tolist() for x in got), strict=True)) == [(*k, want[k]) for k in sorted(want)]


def test_places_of_hashes_and_pairs():
    rng = np.random.default_rng(5)
    for many in (1, 2, 5000):
        h = np.unique(rng.integers(0, 1 << 64, many, np.uint64))
        ask = rng.integers(0, len(h), 400)
        assert (pitmanyor.Hashes(h).find(h[ask]) == ask).all()
    key = np.unique(np.r_[rng.integers(0, 40 * 700, 3000), np.arange(700) + 7 * 700, 39 * 700 + np.arange(5)])  # a word with all contexts, one with the least
    n, word, context = np.bincount(key // 700, minlength=40), key // 700, key % 700
    ask = rng.integers(0, len(key), 5000)
    assert (pitmanyor.PairPlaces(n, context, 700).find(word[ask], context[ask]) == ask).all()


def test_seating():
    rng = np.random.default_rng(0)
    c, pull, d = np.full(4000, 40), np.full(4000, 3.0), 0.4
    got = pitmanyor.seat(c, pull, d, np.random.default_rng(1)).mean()
    want = []
    for _ in range(1500):
        t = 1
        for m in range(1, 40):
            t += rng.random() < 3.0 / (3.0 + m - d * t)
        want.append(t)
    assert abs(got - np.mean(want)) < 0.2
    assert pitmanyor.seat(np.array([0, 1, 2]), np.full(3, 1e9), 0.5, rng).tolist() == [0, 1, 2]


def test_spelling_is_a_distribution():
    classes = pitmanyor.class_of(np.bincount(np.frombuffer(b"abcabcaabb", np.uint8), minlength=256))
    s = pitmanyor.Spelling()
    cell, _, _ = pitmanyor.cells(b"abc\nab\nb", classes)
    for _ in range(3):
        s.sweep(np.bincount(cell, minlength=pitmanyor.A**4), np.random.default_rng(3))
    assert all(np.allclose(p.sum(-1), 1) for p in s.levels)
    words = [b"a", b"abc", b"zzz"]
    logp = np.log(s.levels[3]).astype(np.float32).reshape(-1)
    one = [float(pitmanyor._spelled(w, classes, -1.0, logp)[0]) for w in words]
    assert np.allclose(pitmanyor._spelled(b"\n".join(words), classes, -1.0, logp), one, atol=1e-4)
