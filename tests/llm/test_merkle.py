from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from stratum.llm import merkle


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row) -> str:
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes: list[str], arity: int):
    """(top, path of each node: (siblings before, siblings after) per level)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, k in enumerate(at):
            run = k // arity * arity
            paths[i].append((nodes[run:k], nodes[k + 1:run + arity]))
            at[i] = k // arity
        nodes = [sha("".join(nodes[i:i + arity])) for i in range(0, len(nodes), arity)]
    return nodes[0], paths


def brute(rows: list[tuple], arity: int) -> list[tuple]:
    """rows: (doc_id, source, lang, n_chars, text)"""
    langs: dict = {}
    for r in rows:
        langs.setdefault(r[2], []).append(r)
    order = sorted(langs, key=lambda v: (v is not None, (v or "").encode()))
    for rs in langs.values():
        rs.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {lang: tree([leaf(r) for r in langs[lang]], arity) for lang in order}
    root, upper = tree([trees[lang][0] for lang in order], arity) if order else (None, [])
    out = []
    for lang, up in zip(order, upper):
        sub, paths = trees[lang]
        for r, path in zip(langs[lang], paths):
            path = path + up
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
            node = leaf((*r[:3], r[3] + 1, r[4])) if bad else leaf(r)
            for before, after in path:
                node = sha("".join([*before, node, *after]))
            proof = sha("".join(s for step in path for side in step for s in side))
            out.append((r[0], leaf(r), sub, root, proof, node, node == root))
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def rows_of(docs):
    return [tuple(r) for r in docs.select(*merkle.LEAF_COLUMNS).collect()]


@pytest.fixture(scope="module")
def docs(corpus):
    """Nulls in every column, repeated rows and ids, a group that holds most rows, groups of one row."""
    lang = F.when(F.col("doc_id") % 23 == 0, F.lit(None)).when(F.col("doc_id") % 29 == 0, F.concat(F.lit("é"), F.col("doc_id").cast("string"))).otherwise(F.lit("en"))
    return corpus.select("*", lang.alias("lang"), F.when(F.col("doc_id") % 5 > 0, "s").alias("source"), F.length("text").cast("long").alias("n_chars"),
                         F.lit(3).alias("place"), F.lit("x").alias("grp"), F.lit("y").alias("digest"), F.lit(1).alias("block"))


@pytest.mark.parametrize(("arity", "height"), [(2, 11), (2, 2), (3, 1)])
def test_equals_brute_force(docs, arity, height):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    out = got(merkle.manifest(docs, tampered, arity, height))
    assert out == brute(rows_of(docs), arity)
    assert {r[6] for r in out} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 8, 9, 16, 17, 33])
def test_sizes_at_block_edges(shipped, n):
    rows = [(i, "s", "en", 10, f"t{i}") for i in range(n)] + [(100, "s", "fr", 10, "alone")]
    df = shipped.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    assert got(merkle.manifest(df, tampered, 2, 2)) == brute(rows, 2)


def test_no_rows_and_one_row(shipped):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    assert merkle.document_manifest(shipped.createDataFrame([], schema)).count() == 0
    for row in [(None, None, None, None, None), (7, "", "", 0, "")]:
        out = got(merkle.document_manifest(shipped.createDataFrame([row], schema)))
        assert out == brute([row], 2) and out[0][1] == out[0][2] == out[0][3]


def test_any_change_changes_the_root(shipped):
    rows = [(i, "s", "en", 10, f"t{i}") for i in range(50)]
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    roots = set()
    for k in range(5):
        changed = list(rows)
        changed[7] = [(7, "s", "en", 10, "t7"), (7, "S", "en", 10, "t7"), (7, "s", "EN", 10, "t7"), (7, "s", "en", None, "t7"), (7, "s", "en", 10, "")][k]
        roots |= {r["root"] for r in merkle.manifest(shipped.createDataFrame(changed, schema)).collect()}
    assert len(roots) == 5
