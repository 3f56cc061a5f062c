"""Byte-level BPE against the tiktoken library, and back."""

from __future__ import annotations

import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken

from strandline.llm import bpe
from tests.llm.samples import AWKWARD, prose, table

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = bpe.read_ranks(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def awkward_texts():
    rng = random.Random(11)
    letters = "etaoin shrdlu,.'!19éüß中文字日本語кириллицаعربى\n\t \x1c\x85　​🙂👩‍👧́"
    added = "".join(chr(a) + "x" + chr(b) + "1" for a, b in bpe.ADDED)
    later = "a࢏b ꟎9\U0003d000\U000323b0z ՘⃁"
    mixed = ["".join(rng.choice(letters) for _ in range(rng.randrange(300))) for _ in range(150)]
    words = ["".join(rng.choice("abeinst") for _ in range(n)) for n in (63, 64, 65, 200, 3000)]
    return [*mixed, *words, added, later, "a" * 20_001, " " * 5_000, "ab" * 999, "<|endoftext|> don't WE'LL", "\r\n\r\n x", "x" * 70 + "y"]


@pytest.mark.parametrize("portion,words", [(bpe.PORTION, bpe.WORDS), (97, 50)])
def test_ids_are_those_of_the_library(spark, monkeypatch, portion, words):
    monkeypatch.setattr(bpe, "PORTION", portion)
    monkeypatch.setattr(bpe, "WORDS", words)
    rows = AWKWARD + list(enumerate(awkward_texts(), 100)) + [(99, prose(random.Random(2), 3_000))]
    docs = table(spark, rows).repartition(3)
    out = bpe.decode(bpe.encode(docs, PATH, public_tokenizers.PATTERN), PATH)
    assert out.columns == [*docs.columns, "__ids", "__decoded", "__ids_sha256"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        want = LIBRARY.encode_ordinary(r.text or "")
        assert r["__ids"] == want, r.text
        assert bytes(r["__decoded"]) == (r.text or "").encode()
        assert r["__ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(want)}I", *want)).hexdigest()


def test_equal_ranks_are_contracted_from_the_left():
    """Ranks under which a contraction makes a lower pair: the leftmost goes first, and all that follows from it."""
    rng = random.Random(5)
    for _ in range(40):
        tokens = {"".join(rng.choice("abc") for _ in range(rng.randrange(2, 6))).encode() for _ in range(40)}
        tokens = sorted(tokens, key=lambda t: rng.random())
        ranks = {bytes([i]): i for i in range(256)} | {t: 256 + i for i, t in enumerate(tokens)}
        library = tiktoken.Encoding("few", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
        words = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(1, 130))) for _ in range(60)})
        ids, counts = bpe.Encoder(ranks).encode(words)
        at = 0
        for word, n in zip(words, counts):
            assert ids[at : at + n].tolist() == library.encode_ordinary(word), word
            at += n


def test_every_code_point_is_of_the_library_s_class():
    cutter = bpe.Cutter(public_tokenizers.PATTERN, bpe.later_letters())
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    # With no merges but of whole pieces, the number of ids tells where pieces end.
    for start in range(0, len(points), 40_000):
        text = "".join(f"a{c}1{c}!{c}" for c in points[start : start + 40_000])
        mine = [len(LIBRARY._encode_single_piece(p)) for part in cutter.pieces(text) for p in part]
        assert sum(mine) == len(LIBRARY.encode_ordinary(text))


def test_digest_on_given_tables(spark, data):
    from strandline.llm.queries import QUERIES

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    got = QUERIES["op11_byte_bpe"](spark, data).collect()
    assert len(got) == len(texts)
    for r in got:
        want = LIBRARY.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(want)}I", *want)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_empty_table_and_unknown_ids(spark):
    empty = table(spark, AWKWARD).limit(0)
    assert bpe.decode(bpe.encode(empty, PATH, public_tokenizers.PATTERN), PATH).count() == 0
    lists = spark.createDataFrame([(1, None), (2, []), (3, [50300, 7])], "doc_id long, __ids array<int>")
    got = {r.doc_id: bytes(r["__decoded"]) for r in bpe.decode(lists, PATH).collect()}
    by_rank = {v: k for k, v in RANKS.items()}
    assert got == {1: b"", 2: b"", 3: by_rank[7]}


def test_merges_are_made_once_and_unknown_ids_have_no_bytes():
    merges = bpe.merges_of(RANKS)
    words = ["running", "straßenbahn", "xyzzyxyzzy", "日本語"]
    ids, counts = bpe.Encoder(RANKS, merges).encode(words)
    assert ids.tolist() == [i for w in words for i in LIBRARY.encode_ordinary(w)] and len(counts) == len(words)
    decoder = bpe.Decoder(RANKS)
    unknown = max(RANKS.values()) + 1
    assert decoder.decode([ids, ids[:0], ids[:1] * 0 + unknown]) == ["".join(words).encode(), b"", b""]
    assert not hasattr(decoder, "duck")
