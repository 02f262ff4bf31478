"""Encoder, packing and token files against the tokenizers library."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pitchforge.llm import packing, token_files
from pitchforge.llm.tokens import Encoder

from . import brute
from .conftest import same

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PARTS = [*"abcXYZ 012 ..,,''\n\n\t  éÉßñÀŷƀɏ²¼ªº÷×¬\"|<>&$%#", "don't", "I'll", "we've", "  ", "\r\n", " \n", "'s", "'LL",
         "Σ", "́", "\xa0", "\x85", "中", "<|endoftext|>", "İ", "ı", "\x00", "\x0b", "\x1d", "\x7f", "\x9f"]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_ids_equal_the_librarys(path, docs):
    rng, own, library = random.Random(3), Encoder(path), Tokenizer.from_file(path)
    texts = ["".join(rng.choices(PARTS[:40] if i % 2 else PARTS, k=rng.randint(0, 40))) for i in range(4000)]
    texts += [r["text"] for r in docs.select("text").collect()]
    for t in texts:
        assert np.frombuffer(own.encode(t), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, t
    assert own.encode(None) == own.encode("") == b""


def test_cache_starts_anew_when_full(monkeypatch):
    monkeypatch.setattr("pitchforge.llm.tokens.CACHE_WORDS", 3)
    own, library = Encoder(BYTES), Tokenizer.from_file(BYTES)
    for t in ("one two three four five", "six seven one", "two"):
        assert np.frombuffer(own.encode(t), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("which", ["docs", "odd_docs"])
def test_packing(request, which):
    df = request.getfixturevalue(which)
    got = packing.pack_documents(df, BYTES).collect()
    tok = Tokenizer.from_file(BYTES)
    want = [(r["doc_id"], *p) for r in df.select("doc_id", "text").collect() for p in brute.pieces(r["text"], tok)]
    same([(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got], want)
    places = {}
    for r in got:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in places.values():  # gapless from 0, within the limit
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.SEQUENCE
    total = sum(r["length"] for r in got)
    assert len(places) <= -(-total // packing.SEQUENCE) * 1.02 + 1


def test_best_fit_keeps_few_bins_open():
    rng = random.Random(1)
    lengths = [rng.randint(1, 100) for _ in range(3000)]
    for bins in (1, 4, 64):
        fill, open_ = {}, []
        for n, (b, offset) in zip(lengths, packing.best_fit(lengths, 100, bins)):
            assert fill.get(b, 0) == offset
            if b in fill:  # the fullest open bin that has room
                assert b in open_ and fill[b] == max(fill[x] for x in open_ if fill[x] + n <= 100)
            else:
                assert all(fill[x] + n > 100 for x in open_)
                if len(open_) == bins:
                    open_.remove(max(open_, key=lambda x: (fill[x], 0)) if bins == 1 else
                                 next(x for x in reversed(open_) if fill[x] == max(fill[y] for y in open_)))
                open_.append(b)
            fill[b] = offset + n
            if fill[b] == 100:
                open_.remove(b)
            elif b in open_:  # bins of equal fill close in the order last in, first out
                open_.remove(b)
                open_.append(b)
            assert len(open_) <= bins


def test_shards_hold_all_pieces(odd_docs, no_docs):
    pieces = packing.materialize(packing.tokenize_pieces(odd_docs, BYTES), "pieces")
    packed = packing.pack_pieces(pieces, shard_tokens=3000)
    assert packed.columns == [*pieces.columns, "sequence_id", "offset"] and packed.count() == pieces.count()
    assert packed.selectExpr("count(distinct sequence_id >> 40)").first()[0] > 1
    assert packing.pack_documents(no_docs, BYTES).count() == 0


@pytest.mark.parametrize("which,ranges", [("docs", None), ("docs", 7), ("odd_docs", 5)])
def test_token_files(spark, request, which, ranges):
    df = request.getfixturevalue(which)
    got = token_files.round_trip(spark, df, WORDS, ranges=ranges).collect()
    tok, start, want = Tokenizer.from_file(WORDS), 0, []
    order = sorted(df.select("doc_id", "text").collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    for r in order:
        (_, _, n, crc), = brute.pieces(r["text"], tok, end_id=1, sequence=1 << 30)
        want.append((r["doc_id"], n, crc))
    same([(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got], want)
    by_start = sorted(got, key=lambda r: r["start"])
    for r in by_start:  # each document begins where the one before it ends, in order of id
        assert r["start"] == start
        start += r["n_tokens"]
    ids = [r["doc_id"] for r in by_start]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))


def test_no_files_for_no_documents(spark, no_docs):
    assert token_files.round_trip(spark, no_docs, WORDS).count() == 0


def test_width_of_ids(spark, docs, tmp_path):
    assert token_files.width_of(WORDS, 1) == 16 and token_files.width_of(WORDS, 70_000) == 32
    few = docs.limit(5)
    wide = token_files.round_trip(spark, few, WORDS, end_id=70_000).collect()
    tok = Tokenizer.from_file(WORDS)
    want = [(r["doc_id"], *brute.pieces(r["text"], tok, end_id=70_000, sequence=1 << 30)[0][2:]) for r in few.collect()]
    same([(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in wide], want)
    with pytest.raises(Exception, match="does not fit"):
        token_files.round_trip(spark, few, WORDS, end_id=70_000, id_bits=16)
    with pytest.raises(TypeError, match="64-bit"):
        token_files.round_trip(spark, few.selectExpr("concat('d', doc_id) doc_id", "text"), WORDS)
