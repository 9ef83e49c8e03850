from __future__ import annotations

import math
import zlib

import numpy as np
import pytest
from conftest import SF_ORACLE

from stratum.llm import toxicity


@pytest.fixture(scope="module")
def tables(shipped):
    return shipped.read.parquet(f"{SF_ORACLE}/documents.parquet"), shipped.read.parquet(f"{SF_ORACLE}/labels.parquet")


@pytest.fixture(scope="module")
def model(tables):
    return toxicity.fit(*tables)


def area(scores: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean([np.mean(s > scores[y == 0]) + 0.5 * np.mean(s == scores[y == 0]) for s in scores[y == 1]]))


def test_held_out_quality(tables, model):
    docs, labels = tables
    scored = toxicity.score(docs.select("doc_id", "text"), model).select("doc_id", "score", "predicted").collect()
    y = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    own = [(r["score"], r["predicted"], y[r["doc_id"]]) for r in scored if r["doc_id"] in y and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    s, p, t = (np.array(c) for c in zip(*own))
    assert area(s, t) > 0.9 and (p == t).mean() > 0.93 and ((s >= 0.5) == p).all() and ((s >= 0) & (s <= 1)).all()


def test_held_out_labels_are_not_used(tables, model):
    docs, labels = tables
    flipped = labels.withColumn("toxic", (toxicity.held_out(labels.doc_id) & (labels.toxic == 0)).cast("int"))
    flipped = labels.filter(~toxicity.held_out(labels.doc_id)).unionByName(flipped.filter(toxicity.held_out(labels.doc_id)))
    again = toxicity.fit(docs.select("doc_id", "text"), flipped)
    assert again.lexicon == model.lexicon
    x = np.abs(np.random.default_rng(0).normal(size=(50, len(toxicity.FEATURES))))
    assert np.allclose(again.score(x), model.score(x))


def test_repeated_doc_ids_count_once(shipped, tables):
    _, labels = tables
    ids = [r["doc_id"] for r in labels.filter("toxic in (0, 1)").filter(~toxicity.held_out(labels.doc_id)).orderBy("doc_id").limit(40).collect()]
    labels = labels.filter(labels.doc_id.isin(ids))
    once = [(i, f"text {i}") for i in ids]
    hot = [(ids[0], f"text {ids[0]}")] * 500 + [(ids[1], f"other {k}") for k in range(500)]
    docs = shipped.createDataFrame(once + hot + [(None, "x")], "doc_id long, text string").repartition(5)
    got = toxicity.training_rows(docs, labels, 30).collect()
    assert len(got) == 30 and len({r["doc_id"] for r in got}) == 30
    assert sorted(toxicity.training_rows(docs.repartition(3), labels, 30).collect()) == sorted(got)
    assert len(toxicity.training_rows(docs, labels).collect()) == 40


def test_edge_rows(corpus, corpus_rows, model, nothing):
    scored = toxicity.score(corpus, model, "__s", "__p")
    assert scored.columns == [*corpus.columns, "__s", "__p"]
    rows = scored.collect()
    assert len(rows) == len(corpus_rows)
    by_text = {}
    for r in rows:
        assert 0 <= r["__s"] <= 1 and r["__p"] == (r["__s"] >= 0.5)
        assert by_text.setdefault(r["text"] or "", r["__s"]) == r["__s"]  # nothing but the text counts
    assert toxicity.score(nothing, model).collect() == []


def test_without_usable_labels(tables, corpus, nothing):
    docs, labels = tables
    for some in (labels.filter("false"), labels.filter("toxic = 0"), labels.selectExpr("doc_id", "quality", "cast(null as int) as toxic")):
        m = toxicity.fit(docs, some)
        assert m.trees is None and set(m.score(np.zeros((2, len(toxicity.FEATURES))))) == {0.0}
    assert toxicity.fit(nothing.select("doc_id", "text"), labels).trees is None


def test_drop_keeps_columns(tables):
    docs, labels = tables
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    toxic = {r["doc_id"] for r in labels.filter("toxic = 1").collect()}
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert len(toxic & ids) < 0.35 * len(toxic) and len(ids) > 0.85 * docs.count()


def test_features():
    reader = toxicity.Reader({"idiot": 5.0, "grob*": 3.0})
    x = reader.features(["you IDIOT! you", "", "an 1d1ot, idi.ot", "grobian grobe far far far far far far you", "plain words"])
    f = {n: x[:, i] for i, n in enumerate(toxicity.FEATURES)}
    assert f["hits"][0] == pytest.approx(math.log(2)) and f["near_person"][0] > 0 and f["shouted_rate"][0] == pytest.approx(1 / 3)
    assert (x[1] == 0).all() and f["hidden_hits"][2] == pytest.approx(math.log(3)) and f["obfuscated_rate"][2] > 0
    assert f["distinct"][3] == 2 and f["near_person"][3] == 0 and f["heaviest"][4] == 0


def test_trees_and_isotonic():
    rng = np.random.default_rng(7)
    x = rng.random((600, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    m = toxicity.boost(x, y).margin(x)
    assert ((m > 0) == y).mean() > 0.97
    at, p = toxicity.isotonic(m + rng.normal(size=600), y)
    assert (np.diff(at) >= 0).all() and (np.diff(p) >= 0).all() and p[0] < 0.2 and p[-1] > 0.8


def test_pooling_is_the_best_non_decreasing_fit():
    """Against the minimax formula: the largest, over starts, of the smallest, over ends, weighted mean."""
    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 30):
        for _ in range(20):
            v, w = rng.integers(0, 3, n).astype(float), rng.integers(1, 4, n).astype(float)
            mean = lambda a, b: (v[a:b + 1] * w[a:b + 1]).sum() / w[a:b + 1].sum()
            want = [max(min(mean(a, b) for b in range(i, n)) for a in range(i + 1)) for i in range(n)]
            p, length = toxicity.pooled(v, w)
            assert np.allclose(np.repeat(p, length), want) and length.sum() == n


def test_a_higher_margin_never_gets_a_lower_score():
    rng = np.random.default_rng(5)
    for k in range(200):
        n = int(rng.integers(2, 60))
        margin, y = rng.normal(size=n).round(1), rng.integers(0, 2, n).astype(float)
        at, p = toxicity.isotonic(margin, y)
        assert (np.diff(at) >= 0).all() and (np.diff(p) >= 0).all() and ((0 < p) & (p < 1) | (y.mean() == p)).all()
        trees = toxicity.Trees(0.0, 1, [(np.array([0]), np.array([0.0]), np.array([-1.0, 1.0]))])
        trees.margin = lambda x: x[:, 0]
        scores = toxicity.Model({}, trees, (at, p), float(y.mean())).score(np.linspace(-4, 4, 400)[:, None])
        assert (np.diff(scores) >= 0).all()
