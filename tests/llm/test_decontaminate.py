from __future__ import annotations

from collections import Counter

import pytest
from conftest import SF_SMALL
from llm.test_near_dedup import shingle_set

from stratum.llm import decontaminate

PASSAGE = " ".join(f"passage word{i} of a stretch" for i in range(30))


@pytest.fixture(scope="module")
def items(shipped):
    rows = [(900, PASSAGE), (901, "one two three"), (902, None), (903, "  "), (None, PASSAGE), (900, PASSAGE), (904, "one"),
            (905, PASSAGE + " " + " ".join(f"z{i}" for i in range(30))), (906, PASSAGE + " " + " ".join(f"z{i}" for i in range(45))),
            (907, " ".join(f"w{i % 977}x{i % 31}" for i in range(3000, 9000)))]
    table = shipped.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text")
    return table.union(shipped.createDataFrame(rows, "item_id long, text string"))


def brute(docs: list[tuple], items: list[tuple], size: int, percent: int) -> Counter:
    out = Counter()
    sets = [(i, shingle_set(t, size)) for i, t in items]
    for d, t in docs:
        own = shingle_set(t, size)
        for i, s in sets:
            n = len(own & s)
            if s and 100 * n >= percent * len(s):
                out[(d, i, len(s), n)] += 1
    return out


@pytest.mark.parametrize(("size", "percent", "block"), [(5, 80, 2_000_000), (5, 80, 300), (3, 50, 100), (5, 100, 2_000_000), (1, 80, 50)])
def test_pairs(corpus, corpus_rows, items, size, percent, block):
    got = decontaminate.contained_items(corpus, items, size, percent, block).collect()
    assert Counter(tuple(r) for r in got) == brute(corpus_rows, [tuple(r) for r in items.collect()], size, percent)


@pytest.mark.parametrize(("size", "percent"), [(5, 80), (3, 50)])
def test_pairs_of_a_large_benchmark(corpus, corpus_rows, items, size, percent):
    got = decontaminate.contained_items(corpus, items, size, percent, sent_shingles=100).collect()
    assert Counter(tuple(r) for r in got) == brute(corpus_rows, [tuple(r) for r in items.collect()], size, percent)


def test_blocks_do_not_follow_partitions(items):
    sets = decontaminate._stored_sets(items.repartition(7), 5)
    assert sets.select("part").distinct().count() > 1
    numbered, blocks = decontaminate._numbered(sets, 2_000_000)
    assert blocks == 1 and numbered.select("block").distinct().count() == 1
    assert numbered.count() == sets.count()


def test_short_items_inside_longer_texts(shipped):
    docs = [(1, "x One  two three y z q"), (2, "one two"), (3, "one\ttwo three"), (4, "one two x three a b c"), (5, None), (6, "a b c d e f g"), (7, "")]
    items = [(10, "one two three"), (11, "two"), (12, "a b c d e"), (13, None), (14, " "), (15, " one two\n")]
    d, i = shipped.createDataFrame(docs, "doc_id long, text string"), shipped.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contained_items(d, i, short_inside=True).collect()
    want = {(1, 10), (3, 10), (1, 11), (2, 11), (3, 11), (4, 11), (6, 12), (1, 15), (2, 15), (3, 15), (4, 15)}
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == sorted(want)
    assert {r["doc_id"] for r in decontaminate.drop_contaminated(d, i, short_inside=True).collect()} == {5, 7}
    assert decontaminate.contained_items(d, i.filter("false"), short_inside=True).collect() == []


def test_drop(corpus, corpus_rows, items):
    kept = decontaminate.drop_contaminated(corpus, items)
    assert kept.columns == corpus.columns
    bad = {d for d, *_ in brute(corpus_rows, [tuple(r) for r in items.collect()], 5, 80)}
    texts = {t for d, t in corpus_rows if d in bad and brute([(d, t)], [tuple(r) for r in items.collect()], 5, 80)}
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter((d, t) for d, t in corpus_rows if t not in texts)


def test_empty(corpus, nothing, items):
    none = items.filter("false")
    assert decontaminate.contained_items(nothing, items).collect() == []
    assert decontaminate.contained_items(corpus, none).collect() == []
    assert decontaminate.drop_contaminated(corpus, none).count() == corpus.count()


def test_tiny_items_are_looked_for_among_whole_texts_only(spark):
    docs = spark.createDataFrame([(1, "the cat sat"), (2, "the"), (3, "here is new york city for you"), (4, "nothing of it")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "the"), (2, "new york city")], "item_id long, text string")
    kept = lambda least: sorted(r["doc_id"] for r in decontaminate.drop_contaminated(docs, items, short_inside=True, least_words=least).collect())
    assert kept(1) == [4] and kept(3) == [1, 4] and kept(4) == [1, 3, 4]


def test_a_large_benchmark_as_tables_gives_the_same_pairs(spark):
    import random

    rng = random.Random(8)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([3, 8, 20, 70]))) for _ in range(60)]
    docs = spark.createDataFrame([(i, " ".join(rng.sample(texts, 3)) + f" tail {i}") for i in range(80)], "doc_id long, text string")
    items = spark.createDataFrame([(i, " ".join(t.split()[:-1]) + rng.choice([" x", ""])) for i, t in enumerate(texts)], "item_id long, text string")
    sent, joined = (sorted(map(tuple, decontaminate.contained_items(docs, items, sent_shingles=n).collect())) for n in (8_000_000, 0))
    assert sent == joined and len(sent) > 100
