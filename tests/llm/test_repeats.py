from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest

from stratum.llm import repeats


def brute(texts: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        edge = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        out.append(list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())))
    return out


def expected(rows: list[tuple], length: int) -> Counter:
    raw = [(t or "").encode() for _, t in rows]
    out = Counter()
    for (d, _), t, spans in zip(rows, raw, brute(raw, length)):
        kept, at = b"", 0
        for s, e in spans:
            kept, at = kept + t[at:s], e
        out[(d, len(t), sum(e - s for s, e in spans), len(spans), hashlib.sha256(kept + t[at:]).hexdigest())] += 1
    return out


def result(df, **args) -> Counter:
    return Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in repeats.repeated_spans(df, **args).collect())


def test_corpus(corpus, corpus_rows):
    assert result(corpus) == expected(corpus_rows, 200)


@pytest.mark.parametrize(("length", "gram"), [(30, 10), (12, 12), (40, 1)])
def test_dense_repeats(spark, length, gram):
    """Few letters, periods, overlaps, matches that end at text ends, copies."""
    rng = np.random.default_rng(length)
    rows = []
    pool = ["".join(rng.choice(list("abé"), 60)) for _ in range(6)]
    for k in range(60):
        parts = [pool[rng.integers(6)][int(rng.integers(20)):int(rng.integers(30, 60))] if rng.random() < 0.6 else "".join(rng.choice(list("abcdefg"), int(rng.integers(0, 40)))) for _ in range(5)]
        rows.append((k, "".join(parts)))
    rows += [(100, "ab" * 70), (101, "a" * 90), (102, "a" * length), (103, "a" * (length - 1)), (104, rows[0][1]), (104, rows[0][1]), (105, None), (None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(df, length=length, gram=gram) == expected(rows, length)


def test_hot_passage(spark):
    """One passage in every text, with different surroundings and near copies of it."""
    rng = np.random.default_rng(0)
    passage = "".join(rng.choice(list("abcdefghij "), 400))
    rows = []
    for k in range(150):
        own = list(passage)
        if k % 3 == 0:
            own[int(rng.integers(400))] = "#"
        rows.append((k, "".join(rng.choice(list("klmnop "), int(rng.integers(0, 150)))) + "".join(own) + "".join(rng.choice(list("qrstuv "), int(rng.integers(0, 150))))))
    assert result(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == expected(rows, 200)


def test_empty(nothing):
    assert repeats.repeated_spans(nothing).collect() == []
    with pytest.raises(ValueError):
        repeats.repeated_spans(nothing, length=400, gram=10)


@pytest.mark.parametrize(("length", "gram"), [(200, 64), (30, 10), (12, 12), (40, 1), (128, 64)])
def test_pointers_are_refined_from_later_offsets(length, gram):
    """Equal strings, and only they, have equal pointers; each one depends on q-gram pointers alone."""
    rng = np.random.default_rng(gram)
    text = bytes(rng.choice(list(b"ab"), 400)) + bytes(rng.choice(list(b"abcdef"), 300)) * 2
    place = np.arange(len(text) - gram + 1)
    grams = repeats.Prints([text]).of(place, place + gram)
    pointers = repeats.Pointers(grams, gram)
    for size in {gram, min(length, gram + 1), length - 3 if length - 3 > gram else length, length}:
        start = np.arange(len(text) - size + 1)
        got = pointers.of(start, size)
        strings = [text[i:i + size] for i in start]
        assert len(set(got.tolist())) == len(set(strings)) == len(set(zip(got.tolist(), strings)))
        assert np.array_equal(got, pointers.of_sizes(start, np.full(len(start), size)))
    changed = grams.copy()
    changed[150] ^= np.uint64(1)          # a pointer at a later offset changes those that read it, and no others
    before, after = (repeats.Pointers(g, gram).of(np.arange(300), length) if 300 + length <= len(text) else None for g in (grams, changed))
    differ = np.flatnonzero(before != after)
    assert differ.max() == 150 and differ.min() >= 150 - length + gram
