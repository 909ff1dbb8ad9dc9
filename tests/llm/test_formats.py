"""Token files, packing, Ogg, WARC, chat: exact round trips and brute force."""

from __future__ import annotations

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strataloom.llm import chat, ogg, queries, token_files, warc
from strataloom.llm.eliasfano import EliasFano, Shard, ef_encode, shard_encode
from strataloom.llm.tokens import PieceTokenizer

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
DOCS = [(5, "Hello world, don't"), (2, None), (9, ""), (None, "x\ty  z\n"), (2, "Été à 12 34 !"), (7, "word " * 3000), (5, "Hello world, don't"), (11, "<|endoftext|> in text")]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 1 << 45), max_size=300))
def test_elias_fano(values):
    v = np.sort(np.array(values, np.int64))
    e = EliasFano(memoryview(ef_encode(v)))
    assert [e[i] for i in range(len(v))] == v.tolist()
    lo, hi = len(v) // 3, len(v) - len(v) // 4
    assert e.slice(lo, hi).tolist() == v[lo:hi].tolist()


def test_shard_is_small_and_exact():
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 900, 5000).tolist()
    ids = rng.integers(0, 60000, sum(lengths)).astype("<u2")
    raw = shard_encode(list(range(5000)), lengths, ids.tobytes(), 2)
    s = Shard(raw)
    assert s.keys() == list(range(5000)) and len(raw) - ids.nbytes < 5000 * 2.5
    at = np.concatenate([[0], np.cumsum(lengths)])
    assert all((s.document(i) == ids[at[i] : at[i + 1]]).all() for i in (0, 1, 63, 64, 65, 4999))
    assert Shard(shard_encode([3, None, 1], [1, 1, 1], b"abcdef", 2)).keys() == [3, None, 1]


@pytest.fixture(scope="module")
def tokenizers():
    return [PieceTokenizer(WORD, True), PieceTokenizer(BYTE, False)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("aB é\n\t\r\x0b\x1c  'sT.12Σ́ç漢<|>"), max_size=40), max_size=6))
def test_pieces_equal_whole_texts(tokenizers, texts):
    for t in tokenizers:
        for raw, text in zip(t.encode_batch(texts), texts):
            assert np.frombuffer(raw, t.dtype).tolist() == t.tok.encode(text, add_special_tokens=False).ids


def whole(path: str, end: int):
    t = Tokenizer.from_file(path)
    return lambda x: [*t.encode(x or "", add_special_tokens=False).ids, end]


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def frame(spark, rows=DOCS):
    return spark.createDataFrame([(a, b, 1) for a, b in rows], "doc_id long, text string, start int").repartition(3)


def test_token_files(spark):
    m = token_files.write_token_shards(frame(spark), WORD, 2, True, shard_ids=20)
    got = sorted(((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_files.read_token_shards(m).collect()), key=lambda r: r[0])
    encode, at, want = whole(WORD, 2), 0, {}
    for d, t in DOCS:
        want.setdefault(d, []).append((len(encode(t)), crc(encode(t))))
    assert [r[1] for r in got] == [None, 2, 2, 5, 5, 7, 9, 11]
    for start, d, n, c in got:
        assert start == at and (n, c) in want[d]
        want[d].remove((n, c))
        at += n
    empty = token_files.write_token_shards(frame(spark, []), WORD, 2, True)
    assert token_files.read_token_shards(empty).count() == 0 and token_files.pack_concat(empty).count() == 0


@pytest.mark.parametrize("window", [7, 64, 2048])
def test_packing(spark, window):
    m = token_files.write_token_shards(frame(spark), BYTE, 1, False, shard_ids=50)
    rows = sorted(token_files.pack_concat(m, window).collect(), key=lambda r: (r.sequence_id, r.offset))
    encode = whole(BYTE, 1)
    ids = [x for d, t in sorted(DOCS, key=lambda r: (r[0] is not None, r[0] or 0)) for x in [encode(t)]]
    assert sum(r.length for r in rows) == sum(map(len, ids))
    place = {}
    for r in rows:
        assert r.offset == place.get(r.sequence_id, 0) and r.offset + r.length <= window
        place[r.sequence_id] = r.offset + r.length
        cands = [encode(t) for d, t in DOCS if d == r.doc_id]
        assert any(len(c) == r.doc_tokens and crc(c[r.start : r.start + r.length]) == r.ids_crc32 for c in cands)
    last = max(place)
    assert all(n == window for k, n in place.items() if k != last)
    fill = place[last]
    assert {r.padded_length for r in rows if r.sequence_id == last} == {fill if fill & (fill - 1) == 0 else window}


def slow_crc(data: bytes) -> int:
    r = 0
    for b in data:
        r ^= b << 24
        for _ in range(8):
            r = ((r << 1) ^ 0x04C11DB7) & 0xFFFFFFFF if r & 0x80000000 else r << 1
    return r


def test_ogg_round_trip():
    rng = random.Random(0)
    assert all(ogg.ogg_crc(x) == slow_crc(x) for x in (b"", b"a", b"OggS" * 9, rng.randbytes(200)))
    for n in (0, 2, 192, 6144, 6146, 255 * 2, 510 * 300, 192 * 3333):
        data = rng.randbytes(n)
        d = ogg.decode(ogg.encode(data, 2, frames=rng.choice([255, 3072, 65_535])))
        assert d["payload"] == data and d["ok"] and d["streams"] == 2
        assert all(s == sorted(s) for s in d["packet_starts"])
    data = rng.randbytes(192 * 400)
    file = bytearray(ogg.encode(data))
    file[len(file) // 2] ^= 1
    d = ogg.decode(bytes(file))
    assert not d["ok"] and d["bad_pages"] == 1 and len(d["payload"]) == len(data) and d["payload"] != data
    assert not ogg.decode(b"no ogg")["ok"]


def test_ogg_columns(spark):
    df = spark.createDataFrame([(1, bytearray(b"ab" * 96), "q"), (2, None, "r"), (3, bytearray(), "s")], "doc_id long, payload binary, media string")
    out = {r.doc_id: r for r in ogg.ogg_decode(ogg.ogg_encode(df, "payload")).collect()}
    assert bytes(out[1].decoded.payload) == b"ab" * 96 and out[1].decoded.ok and out[2].media is None and out[2].decoded is None and bytes(out[3].decoded.payload) == b""


def test_op4(spark, sf):
    rows = queries.op4_ogg_media(spark, sf).collect()
    docs = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    for r in rows:
        raw = docs[r.doc_id]
        p = raw + b" " * (max(192, -(-len(raw) // 192) * 192) - len(raw))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32, r.ok) == (len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:]), True)


def test_warc(spark):
    rng = random.Random(1)
    big = "<p>" + " ".join(rng.choices(["alpha", "beta", "gamma"], k=4000))
    rows = [(i, f"http://h/{i % 9}\r\nX: y", f"<html>{rng.randrange(6)}</html>" if i % 3 else big + str(i)) for i in range(300)]
    rows += [(900, None, None), (901, "http://e", ""), (902, "http://e", ""), (None, "u", "<html>1</html>"), (903, "é", "ünï")]
    df = spark.createDataFrame([(*r, 5) for r in rows], "page_id long, url string, html string, digest int").repartition(3)
    archives = warc.write_warc(df, archive_bytes=200_000)
    got = warc.read_warc(archives).collect()
    assert len(got) == len(rows) and all(r.intact for r in got)
    top = {}
    for i, _, h in rows:
        if i is not None:
            top[h or ""] = max(top.get(h or "", -1), i)
    by_id = {i: (h or "").encode() for i, _, h in rows}
    for r in got:
        h = by_id[r.page_id]
        first = None if r.page_id is None or top[h.decode()] == r.page_id else top[h.decode()]
        assert (r.payload_bytes, r.payload_digest, r.refers_to, r.record_type) == (len(h), base64.b32encode(hashlib.sha1(h).digest()).decode(), first, "response" if first is None else "revisit")
        assert r.payload is None if first is not None else bytes(r.payload) == h
    head = open(archives.first().path.removeprefix("file://"), "rb").read(8)
    assert head[:4] == (0x184D2A5D).to_bytes(4, "little") and archives.agg(F.sum("n_bytes")).first()[0] < sum(len(h) for h in by_id.values()) / 3
    assert warc.read_warc(warc.write_warc(df.limit(0))).count() == 0


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "a b\nc%", None]), st.none() | st.text(st.sampled_from("<>/s[]INST\\ \nxé"), max_size=14)), min_size=1, max_size=5), min_size=1, max_size=4))
def test_chat_round_trip(spark, convs):
    rows = [(c, t, role, text) for c, turns in enumerate(convs) for t, (role, text) in enumerate(turns)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    examples = chat.prefix_targets(df)
    got = {r.conv_id: r for r in chat.read_back(examples).collect()}
    for c, turns in enumerate(convs):
        told = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
        loss = "".join(t or "" for r, t in turns if r == "assistant")
        r = got[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(turns), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    for e in examples.collect():
        body = e.formatted[e.loss_start : e.loss_start + e.loss_chars]
        assert "</s>" not in body and "[INST]" not in body and (e.trainable or e.loss_chars == 0)


def test_chat_odd_tables(spark):
    schema = "conv_id long, turn long, role string, text string, n int"
    assert chat.prefix_targets(spark.createDataFrame([], schema)).count() == 0
    df = spark.createDataFrame([(None, None, None, None, 1), (None, 1, "assistant", "b", 1), (None, 1, "assistant", "b", 2), (3, 1, "user", "q", 1)], schema)
    assert {r.conv_id: r.n_turns for r in chat.read_back(chat.prefix_targets(df)).collect()} == {None: 3, 3: 1}


@pytest.mark.parametrize(("name", "drops"), [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_pieces_equal_the_plain_call(name, drops):
    """Texts of special tokens' strings, odd blanks and letters, in pieces and in one go."""
    from strataloom.llm.tokens import PieceTokenizer

    rng = random.Random(1)
    bits = ["<|endoftext|>", "<|startoftext|>", "</s>", " ", "\n", "  ", "word", "hello", "x", "\u00e9", "\u65e5\u672c", "!", "\t", "<|", "|>", "12"]
    plain, pieces = whole(public_tokenizers.path(name), 0), PieceTokenizer(public_tokenizers.path(name), drops)
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 14))) for _ in range(4000)]
    assert [np.frombuffer(x, pieces.dtype).tolist() for x in pieces.encode_batch(texts)] == [plain(t)[:-1] for t in texts]
