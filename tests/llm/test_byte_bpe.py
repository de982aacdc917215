"""Byte-level BPE against the tiktoken library, and round trips."""

import base64
import hashlib
import os
import random

import public_tokenizers
import pytest
import tiktoken

from terrapop.llm import byte_bpe
from terrapop.llm.queries import QUERIES

CONFIG = byte_bpe.CoderConfig(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def coder():
    return byte_bpe.ByteCoder(CONFIG)


def library(coder):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.rank, special_tokens={})


def test_random_texts(coder):
    rng, lib = random.Random(12), library(coder)
    parts = ["a b'sé", "日本語テキスト漢字", " \n\t\r 　 ", "0123१२", "!?#$…—", "абвгд", "aaaa ", "\U0001f600\U0001f468‍", "Ünïcödé", "<|endoftext|>"]
    for _ in range(3000):
        text = "".join(rng.choice(rng.choice(parts)) for _ in range(rng.randint(0, 80)))
        assert coder.encode(text).tolist() == lib.encode_ordinary(text), text
        assert coder.decode(coder.encode(text)) == text.encode()


def test_code_points(coder):
    """Every seventh code point, among them letters that only newer Unicode tables know."""
    lib = library(coder)
    for c in range(1, 0x34000, 7):
        if not 0xD800 <= c < 0xE000:
            text = f"a{chr(c)}a1{chr(c)}1 {chr(c)}! "
            assert coder.encode(text).tolist() == lib.encode_ordinary(text), hex(c)


def saved(path, ranks):
    path.write_bytes(b"\n".join(base64.b64encode(b) + b" %d" % i for b, i in ranks.items()))
    return str(path)


def test_random_vocabularies(tmp_path):
    """Merges of random neighbours in random texts, and a token that no merge makes."""
    rng, pattern = random.Random(5), r"[a-z]+|\s+|."
    for _ in range(30):
        ranks = {bytes([b]): b for b in range(256)}
        while len(ranks) < 300:
            lib = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
            ids = lib.encode_ordinary("".join(rng.choice("aaabbc") for _ in range(60)))
            k = rng.randrange(len(ids) - 1)
            ranks.setdefault(lib.decode_single_token_bytes(ids[k]) + lib.decode_single_token_bytes(ids[k + 1]), len(ranks))
        ranks[b"zyx"] = 300
        coder = byte_bpe.ByteCoder(byte_bpe.CoderConfig(saved(tmp_path / "r", ranks), pattern))
        lib = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for _ in range(200):
            text = "".join(rng.choice("aaabbc ") for _ in range(rng.randint(0, 40))) + rng.choice(["", "zyx", " zyx", "zyxa"])
            assert coder.encode(text).tolist() == lib.encode_ordinary(text), text


def test_ranks_out_of_order(tmp_path):
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256, b"bc": 257}
    with pytest.raises(ValueError):
        byte_bpe.ByteCoder(byte_bpe.CoderConfig(saved(tmp_path / "r", ranks), "."))


def test_long_pieces_and_bounds(coder):
    lib = library(coder)
    for text in ("a" * 100_000, " " * 50_000, "ab" * 50_000, "é" * 30_000):
        assert coder.encode(text).tolist() == lib.encode_ordinary(text)
    small = byte_bpe.ByteCoder(byte_bpe.CoderConfig(CONFIG.ranks, CONFIG.pattern, cached_bytes=2000, cached_pairs=50))
    words = " ".join(f"word{k} x{k * 7919}y" for k in range(100_000))
    assert len(words) > byte_bpe.LONG and small.encode(words).tolist() == lib.encode_ordinary(words)
    assert len(small.pairs) <= 50 and not small.known


def test_ranks_without_bytes(tmp_path):
    path = tmp_path / "r"
    path.write_bytes(b"YQ== 0\n")
    with pytest.raises(ValueError):
        byte_bpe.ByteCoder(byte_bpe.CoderConfig(str(path), "."))


EDGE = [None, "", "   ", "one", "a b", "?!", "word " * 3000, "same", "same", "École ÉCOLE\x00\x1c", "line\n\n\nline ", "x" * 300_000]


def test_documents(spark, coder):
    """Nulls, empty, long and repeated texts, an id twice and without one, clashing columns."""
    lib = library(coder)
    rows = [(k if k < 9 else None, t, "clash", [k]) for k, t in enumerate(EDGE)]
    df = spark.createDataFrame(rows, "doc_id long, text string, decoded string, ids array<int>")
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in byte_bpe.op12_byte_bpe(df, CONFIG).collect())
    want = []
    for i, t, *_ in rows:
        ids = lib.encode_ordinary(t or "")
        want.append((str(i), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want)
    assert byte_bpe.op12_byte_bpe(df.limit(0), CONFIG).count() == 0
    texts = byte_bpe.decode_documents(byte_bpe.encode_documents(df, CONFIG, keep=("doc_id", "decoded")), CONFIG, keep=("decoded",))
    assert texts.columns == ["decoded", "decoded"] or len(texts.columns) == 2
    none = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [bytes(r.decoded) for r in byte_bpe.decode_documents(none, CONFIG).collect()] == [b"", b""]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")
def test_query(spark, coder):
    lib = library(coder)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: (len(ids := lib.encode_ordinary(r.text or "")), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()) for r in docs}
    got = QUERIES["op12_byte_bpe"](spark, SF).collect()
    assert len(got) == len(docs) and {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want
