from __future__ import annotations

import re
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

from stratum.llm import near_dedup, words


def shingle_set(text: str | None, size: int) -> frozenset:
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def brute_components(sets: list[frozenset], percent: int) -> list[int]:
    """Component numbers of a list of sets, by every pair that shares a shingle."""
    up = list(range(len(sets)))

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    for i, s in enumerate(sets):
        common = Counter(j for x in s for j in holders[x] if j < i)
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                up[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(sets))]


def expected(rows: list[tuple], size: int, percent: int = 80) -> Counter:
    sets = [shingle_set(t, size) for _, t in rows]
    roots = brute_components(sets, percent)
    least: dict[int, int | None] = {}
    for (d, _), r in zip(rows, roots):
        if d is not None and (least.get(r) is None or d < least[r]):
            least[r] = d
        least.setdefault(r, None)
    out = Counter()
    for (d, _), r, s in zip(rows, roots, sets):
        group = least[r] if s else d
        out[(d, len(s), group, d == group)] += 1
    return out


@pytest.mark.parametrize("size", [4, 5])
def test_groups(corpus, corpus_rows, size):
    got = near_dedup.near_groups(corpus, size=size).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got) == expected(corpus_rows, size)


def test_chains_hot_groups_and_thresholds(spark):
    """Chains whose ends differ, a large group of near copies, many texts that share a passage."""
    rng = np.random.default_rng(5)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for k in range(60):  # each step changes two words: neighbours are similar, ends are not
        base[k] = f"c{k}"
        rows.append((len(rows), " ".join(base)))
    hub = [f"h{i}" for i in range(200)]
    for _ in range(150):
        text = list(hub)
        for i in rng.choice(200, rng.integers(0, 8), replace=False):
            text[i] = f"n{rng.integers(1000)}"
        rows.append((len(rows), " ".join(text)))
    passage = " ".join(f"p{i}" for i in range(60))
    for k in range(80):
        rows.append((len(rows), passage + " " + " ".join(f"q{k}_{i}" for i in range(int(rng.integers(5, 40))))))
    rows += [(len(rows) + i, " ".join(hub)) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = near_dedup.near_groups(df, size=4).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got) == expected(rows, 4)


def test_drop_keeps_columns_and_one_of_each_group(corpus, corpus_rows):
    kept = near_dedup.drop_near_duplicates(corpus)
    assert kept.columns == corpus.columns
    want = Counter()
    for (d, _, _, k), n in expected(corpus_rows, 5).items():
        if k:
            want[d] += n
    got = Counter(r["doc_id"] for r in kept.collect())
    assert set(got) == {d for d in want}


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 1 << 62, 400).astype(np.uint64)
    b = np.concatenate([a[:320], rng.integers(0, 1 << 62, 80).astype(np.uint64)])
    small = a[:3]
    sig = near_dedup.super_minhash(np.concatenate([a, b, small, small]), np.array([0, 400, 800, 803, 806]), 128)
    assert abs((sig[0] == sig[1]).mean() - 320 / 480) < 0.15 and (sig[2] == sig[3]).all()
    assert (sig != near_dedup._UNSET).all()
    empty = near_dedup.super_minhash(np.zeros(0, np.uint64), np.array([0, 0]), 8)
    assert (empty == near_dedup._UNSET).all()


def test_shingles_equal_sets_of_words():
    texts = ["", " ", "a", "A b", "a b c d e", "x\ty\x0bz w v", "é É ß a b", "a a a a a a", "same same"]
    values, bounds = words.shingles([t.encode() for t in texts], 4)
    assert np.diff(bounds).tolist() == [len(shingle_set(t, 4)) for t in texts]
    one, two = words.shingles([b"The Cat sat down here"], 4)[0], words.shingles([b"the cat SAT down  here"], 4)[0]
    assert (one == two).all()


def test_components(spark):
    rng = np.random.default_rng(4)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2)) if a != b] + [(1000 + i, 1001 + i) for i in range(40)]
    up = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        ra, rb = root(a), root(b)
        up[max(ra, rb)] = min(ra, rb)
    got = near_dedup.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in got} == {x: root(x) for x in list(up)}


def test_empty(nothing):
    assert near_dedup.near_groups(nothing).collect() == []
    assert near_dedup.drop_near_duplicates(nothing).collect() == []


def test_long_texts_are_shingled_in_pieces_as_whole(monkeypatch):
    import random

    import numpy as np

    from stratum.llm import words

    rng = random.Random(2)
    texts = [" ".join(rng.choice(["a", "bb", "Ccc", "dddd"]) + rng.choice(["", "", "  ", "\n"]) for _ in range(n)).encode() for n in (0, 1, 3, 4, 5, 50, 900)]
    texts += [b" " * 500, b"x" * 700, b"one " + b" " * 600 + b"two", b"w" * 300 + b" v " + b"u" * 300, b"\n\n a b c d e f"]
    whole = [words.shingles([t], size) for t in texts for size in (1, 4, 5)]
    monkeypatch.setattr(words, "LONG", 64)
    cut = [words.shingles([t], size) for t in texts for size in (1, 4, 5)]
    for (v, b), (w, c) in zip(whole, cut):
        assert np.array_equal(v, w) and np.array_equal(b, c)
    v, b = words.shingles(texts, 4)
    monkeypatch.setattr(words, "LONG", 1 << 18)
    w, c = words.shingles(texts, 4)
    assert np.array_equal(v, w) and np.array_equal(b, c)


def test_signatures_of_slices_equal_those_of_the_whole(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(4)
    sizes = [0, 1, 40, 3000, 7, 500]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    values = rng.integers(0, 1 << 63, bounds[-1], dtype=np.uint64)
    want = near_dedup.super_minhash(values, bounds, 128)
    for elements in (1, 64, 1000, 1 << 17):
        monkeypatch.setattr(near_dedup, "_ELEMENTS", elements)
        assert np.array_equal(near_dedup.signatures(values, bounds, 128), want)


def test_memory_of_one_text_of_three_million_shingles():
    """In a process of its own: what shingling and signing add to the text itself."""
    import subprocess
    import sys

    code = """
import resource, numpy as np
from stratum.llm import near_dedup, words
rng = np.random.default_rng(1)
text = b" ".join(b"w%d" % k for k in rng.integers(0, 1 << 20, 3_000_000))
words.shingles([text[:100_000]], 5)
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
values, bounds = words.shingles([text], 5)
near_dedup.signatures(values, bounds, 128)
print(len(values), (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=str(Path(near_dedup.__file__).parents[2]))
    shingles, mb = out.stdout.split()
    assert int(shingles) > 2_900_000 and float(mb) < 150


def test_a_worker_forgets_what_another_operator_remembered():
    from stratum.llm import tokens, words, worker

    words.word_hashes([b"some words"])
    assert words._CACHE
    list(worker.task("one", iter)([]))
    words.word_hashes([b"some words"])
    list(worker.task("one", iter)([]))
    assert words._CACHE                                  # the same operator keeps its tables
    list(worker.task("two", iter)([]))
    assert not words._CACHE and tokens.encoder.cache_info().currsize == 0


def test_dense_groups_near_the_threshold(spark, monkeypatch):
    """Edits of a few passages at similarities on both sides of 0.8, where the
    first two rounds leave pairs of one bucket in different groups."""
    import random

    rng = random.Random(21)
    rows = []
    for base in range(4):
        passage = [f"p{base}w{rng.randrange(400)}" for _ in range(120)]
        for k in range(45):
            words_ = list(passage)
            for _ in range(rng.choice([1, 2, 3, 4, 5, 6])):
                at = rng.randrange(len(words_))
                words_[at:at + rng.choice([0, 1, 2])] = [rng.choice([f"e{rng.randrange(6)}", f"x{rng.randrange(9999)}"])]
            rows.append((1000 * base + k, " ".join(words_[rng.choice([0, 0, 5]):])))
    last = []
    components = near_dedup.components
    monkeypatch.setattr(near_dedup, "components", lambda links: last.append(links.count()) or components(links))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = near_dedup.near_groups(df, size=4).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got) == expected(rows, 4)
    assert len(last) == 3 and last[2] > last[1]     # the last round found links
