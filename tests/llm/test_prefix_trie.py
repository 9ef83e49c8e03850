from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from conftest import SF_SMALL
from stratum.llm import prefix_trie

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "conv_id long, turn long, role string, text string, pos int, digest string, idx int"


def turn_key(t):
    role, text = t[1] or "", t[2] or ""
    return (t[0] is not None, t[0] or 0, hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest())


def brute(rows):
    """Result rows of (conv_id, turn, role, text) rows, from sets of whole prefixes."""
    convs = {}
    for c, *t in rows:
        if c is not None:
            convs.setdefault(c, []).append(t)
    own = {c: [(r or "", x or "") for _, r, x in sorted(ts, key=turn_key)] for c, ts in convs.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = tuple(own.get(c - c % 20 if c >= 0 else -(-c - -c % 20), [])[:h] + turns[h:])
    members = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids.get(p, [])) or 1
        words = len(WORD.findall(p[-1][1])) if p else 0
        saved[p] = sum(saved[k] for k in kids.get(p, [])) + (len(members[p]) - 1) * words
    out = []
    for p, cs in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in cs if whole[c] == p))
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), len(kids.get(p, [])), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(spark, rows):
    df = spark.createDataFrame([(*r, 1, "clash", 2) for r in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, prefix_trie.conversation_trie(df).collect()), key=repr)


def long_rows(seed=5):
    """Nulls, ties, repeats, copies, very long conversations that part late, prefixes of each other."""
    rng = random.Random(seed)
    rows = []
    for c in range(0, 90):
        shape = rng.randrange(5)
        n = (1, 2, 3, 7, 30)[shape]
        same = rng.randrange(3)
        rows += [(c, t, "user" if t % 2 else "assistant", f"turn {t} of  line {same if t % 9 else rng.randrange(2)}\n") for t in range(n)]
    rows += [(100 + k, t, "user", f"deep {t}") for k in range(12) for t in range(150 + (k % 4) * 37)]
    rows += [(200, t, "user", f"deep {t}" if t < 70 else f"other {t}") for t in range(140)]
    rows += [(201, None, "a", "x"), (201, None, None, None), (201, 0, "a", ""), (201, 0, "a", ""), (201, 0, "b", "x"), (201, 5, None, "long " * 5000)]
    rows += [(None, 0, "a", "x"), (None, None, None, None), (-7, 0, "u", "minus"), (-20, 0, "u", "base"), (-20, 1, "u", "base two"), (-21, 3, None, "y")]
    return rows


def test_equals_brute_force(shipped):
    rows = long_rows()
    assert got(shipped, rows) == brute(rows)


def test_given_table(shipped):
    df = shipped.read.parquet(f"{SF_SMALL}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, prefix_trie.conversation_trie(df).collect()), key=repr) == brute(rows)


@pytest.mark.parametrize("rows", [
    [(5, 0, "u", "hi")], [(5, None, None, None)], [(1, 0, "u", "a"), (1, 0, "u", "a"), (21, 0, "u", "a")],
    [(c, t, "u", f"{t}") for c in range(40) for t in range(8)], [(c, 0, "u", "") for c in range(30)]])
def test_small_tables(shipped, rows):
    assert got(shipped, rows) == brute(rows)


def test_no_conversations(shipped):
    assert got(shipped, []) == [] and got(shipped, [(None, 1, "a", "b")]) == []


def test_long_end_lists_are_joined_in_order(shipped, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 100)
    rows = [(bytearray(b"n%d" % (k % 3)), k) for k in range(5000)]
    out = {bytes(r["id"]): r["ends_sha256"] for r in prefix_trie.end_digests(shipped.createDataFrame(rows, "id binary, conv long")).collect()}
    for k in range(3):
        assert out[b"n%d" % k] == hashlib.sha256(",".join(str(i) for i in range(k, 5000, 3)).encode()).hexdigest()
