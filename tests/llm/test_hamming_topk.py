from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from stratum.llm import hamming_topk


def brute(codes: list[tuple], asked: list[tuple], k: int) -> Counter:
    out = Counter()
    distinct = sorted(set(codes))
    for q, c in set(asked):
        near = sorted((sum(a != b for a, b in zip(c, e)), i) for i, e in distinct if i != q)[:k]
        out.update((q, r, i, d) for r, (d, i) in enumerate(near, 1))
    return out


def run(spark, vectors: list[tuple], every: int, k: int):
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").repartition(3)
    codes, bits = hamming_topk.sign_codes(df, "vec_id", "embedding")
    got = hamming_topk.top_k(codes, codes.filter(codes.id % every == 0), bits, k).collect()
    full = [(i, tuple(bool(x is not None and x > 0) for x in [*v, *[0.0] * (bits - len(v))])) for i, v, _ in vectors if i is not None and v is not None]
    assert Counter(tuple(r) for r in got) == brute(full, [(i, c) for i, c in full if i % every == 0], k)
    return got


@pytest.mark.parametrize(("bits", "n", "k"), [(64, 300, 10), (100, 150, 3), (7, 200, 5), (1, 30, 4)])
def test_against_brute_force(spark, bits, n, k):
    rng = np.random.default_rng(bits)
    run(spark, [(int(i), rng.normal(size=bits).round(3).tolist(), 0) for i in rng.permutation(n)], 10, k)


def test_copies_ties_and_nulls(spark):
    rng = np.random.default_rng(9)
    hot = rng.normal(size=64).tolist()
    rows = [(i, hot, 1) for i in range(120)] + [(120 + i, [x if j != i else -x for j, x in enumerate(hot)], 2) for i in range(40)]
    rows += [(200, None, 0), (None, hot, 0), (201, [None] * 64, 0), (202, [], 0), (203, [1.0, None], None), (0, hot, 1), (210, [float("nan")] * 64, 0)]
    run(spark, rows, 10, 10)


def test_few_and_none(spark):
    got = run(spark, [(0, [1.0, -1.0], 0), (1, [1.0, 1.0], 0)], 1, 10)
    assert len(got) == 2
    run(spark, [(0, [1.0], 0)], 1, 10)
    run(spark, [], 1, 10)


def test_segment_by_segment(spark, monkeypatch):
    """Rounds of one segment each give the same neighbours."""
    monkeypatch.setattr(hamming_topk, "ROUND_PROBES", 1)
    assert hamming_topk._steps([(0, 2), (2, 3)]) == [(0, [0, 1]), (1, [0]), (1, [1]), (2, [0, 1])]
    rng = np.random.default_rng(3)
    run(spark, [(int(i), rng.normal(size=20).round(3).tolist(), 0) for i in range(120)], 20, 5)


@pytest.mark.parametrize("block", [1, 7, 2000])
def test_more_probes_than_codes_ends_in_a_scan(spark, monkeypatch, block):
    """Few, far codes: the search stops where probes outnumber codes, and is still exact."""
    monkeypatch.setattr(hamming_topk, "SCAN_BLOCK", block)
    scans = []
    scanned = hamming_topk._scanned
    monkeypatch.setattr(hamming_topk, "_scanned", lambda *a: scans.append(1) or scanned(*a))
    rng = np.random.default_rng(block)
    run(spark, [(i, rng.normal(size=64).tolist(), 0) for i in range(60)], 5, 8)
    assert scans


def test_probes_are_all_choices_of_bits(spark):
    asked = spark.createDataFrame([([5], [0b1011])], "code array<long>, values array<long>")
    for width, radius in [(4, 0), (4, 1), (6, 3), (5, 5), (1, 1)]:
        got = sorted(r["value"] for r in hamming_topk._probes(asked, 0, width, radius).collect())
        assert got == sorted(v for v in range(1 << width) if (v ^ 0b1011).bit_count() == radius) if width >= 4 else len(got) == 1


def test_no_scratch_stays(spark):
    import os

    from stratum.session import ensure_checkpoint_dir

    base = ensure_checkpoint_dir(spark).removeprefix("file:") + "/stratum-scratch"
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    rng = np.random.default_rng(3)
    run(spark, [(i, rng.normal(size=32).tolist(), 0) for i in range(200)], 20, 3)
    assert {n.rsplit("-", 1)[0] for n in set(os.listdir(base)) - before} == {"top-k"}
