"""Tokenizer, packing and Huffman files against the tokenizers library."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stratum.llm import huffman, packing, tokens
from stratum.llm.queries import tokenizer

ODD = ["", " ", "a\x1cb\x1dc", "ΟΔΟΣ οδος οδοσ", "İstanbul ıI", "écafé ́x", "don't we'll I'M 'S",
       "x<|endoftext|>y <|startoftext|> <|endof text|>", "a b c　d​z", "½²٣٤ १२ 𝔘𝔫𝔦", "日本語のテキスト、です。", "👍🏽 👨‍👩‍👧",
       "ﬁ ǅ Ǆ ß ẞ", "a..b!? ... foo.bar,baz", "Å Å ẛ̣", "\x00 \x85 x\x85y", "ŉ ª º ʼn", "the The THE the, The."]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer())


@pytest.fixture(scope="module")
def true_ids(library, corpus_rows):
    return [(d, np.array(library.encode(t or "", add_special_tokens=False).ids + [1], "<u4")) for d, t in corpus_rows]


def encoded(enc: tokens.Encoder, texts: list[str]) -> list[list[int]]:
    flat, bounds = enc.encode(texts)
    return [flat[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]


def test_words_by_table_equal_whole_texts(library):
    enc = tokens.Encoder(tokenizer())
    assert enc.by_word and enc.lower
    for _ in range(2):  # the second time from the table
        assert encoded(enc, ODD) == [library.encode(t, add_special_tokens=False).ids for t in ODD]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_any_text(texts):
    enc = tokens.encoder(tokenizer())
    assert encoded(enc, texts) == [enc.tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_bounded_tables(library, monkeypatch):
    monkeypatch.setattr(tokens, "_POOL", 200)
    monkeypatch.setattr(tokens, "_PLACES", 64)
    monkeypatch.setattr(tokens, "_MASK", np.uint64(63))
    monkeypatch.setattr(tokens, "_STEMS", 10)
    enc = tokens.Encoder(tokenizer())
    for i in range(20):
        texts = [" ".join(f"word{chr(97 + (i * j) % 26)} {j}th thing, number{j}" for j in range(30)), "Plain words here. More words"]
        assert encoded(enc, texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_other_tokenizer_whole_texts():
    import public_tokenizers

    enc = tokens.Encoder(str(public_tokenizers.path("byte_bpe_50k.json")))
    assert not enc.by_word
    assert encoded(enc, ODD) == [enc.tok.encode(t, add_special_tokens=False).ids for t in ODD]


def test_packing(corpus, corpus_rows, true_ids):
    rows = packing.pack_documents(corpus, tokenizer(), with_ids=True).collect()
    want = Counter()
    for d, ids in true_ids:
        for s in range(0, len(ids), 2048):
            part = ids[s:s + 2048]
            want[(d, s, len(part), len(ids), zlib.crc32(part.tobytes()), part.astype("<u2").tobytes())] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["doc_tokens"], r["ids_crc32"], bytes(r["ids"])) for r in rows) == want
    seq = defaultdict(list)
    for r in rows:
        seq[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sorted(seq) == list(range(len(seq)))
    for parts in seq.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 2048
    assert 1 - sum(r["length"] for r in rows) / (2048 * len(seq)) < 0.05


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(0, 300), max_size=30))
def test_any_histogram(histogram):
    rows = packing.plan(histogram, window=64, classes=16)
    placed, seq = Counter(), defaultdict(list)
    for length, first, n, sequence, offset in rows.tolist():
        for i in range(n):
            placed[length, first + i] += 1
            seq[sequence + i].append((offset, length))
    assert placed == Counter({(k, i): 1 for k, v in histogram.items() for i in range(v)})
    assert sorted(seq) == list(range(len(seq)))
    for parts in seq.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 64


def test_nnls():
    rng = np.random.default_rng(1)
    for _ in range(20):
        a, x = rng.random((12, 20)), np.maximum(rng.normal(size=20), 0)
        got = packing.nnls(a, a @ x)
        assert (got >= 0).all() and np.linalg.norm(a @ got - a @ x) < 1e-6
    b = rng.normal(size=12)
    got, slope = packing.nnls(a, b), None
    slope = a.T @ (b - a @ got)
    assert (slope < 1e-6).all() and np.abs(slope[got > 1e-9]).max(initial=0) < 1e-6  # the optimality conditions


def test_huffman_files(corpus, true_ids, tmp_dir):
    rows = huffman.coded_documents(corpus, tokenizer(), f"{tmp_dir}/coded").collect()
    assert Counter((r["doc_id"], bytes(r["ids"])) for r in rows) == Counter((d, ids.tobytes()) for d, ids in true_ids)
    rows.sort(key=lambda r: r["start"])
    at = 0
    for r in rows:
        assert r["start"] == at and len(r["ids"]) == 4 * r["n_tokens"]
        at += r["n_tokens"]
    ids = [r["doc_id"] if r["doc_id"] is not None else -1 for r in rows]
    assert ids == sorted(ids)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=0, max_size=700), st.integers(6, 12), st.integers(1, 50))
def test_code_round_trip(ids, limit, every):
    ids = np.array(ids, np.int64)
    counts = np.bincount(ids, minlength=41)
    lengths = huffman.code_lengths(counts, limit)
    assert lengths.max(initial=0) <= limit and (lengths > 0).sum() == (counts > 0).sum()
    bits, marks = huffman.encode(ids, lengths, huffman.canonical(lengths), every)
    assert huffman.decode(bits, marks, len(ids), huffman.decode_table(lengths), every).tolist() == ids.tolist()


def test_code_lengths_are_optimal():
    import heapq

    rng = np.random.default_rng(3)
    for n in (2, 3, 17, 200):
        counts = rng.integers(1, 10_000, n)
        heap, cost = sorted(counts.tolist()), 0
        while len(heap) > 1:
            a = heapq.heappop(heap) + heapq.heappop(heap)
            cost += a
            heapq.heappush(heap, a)
        lengths = huffman.code_lengths(counts, 40)
        assert int((counts * lengths).sum()) == cost and abs(sum(2.0 ** -lengths.astype(float)) - 1) < 1e-12
        tight = huffman.code_lengths(counts, int(np.ceil(np.log2(n))))
        assert sum(2.0 ** -tight.astype(float)) <= 1 + 1e-12
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(5), 2)


def test_empty_tables(nothing):
    assert packing.pack_documents(nothing, tokenizer()).collect() == []
    assert huffman.coded_documents(nothing, tokenizer()).collect() == []
