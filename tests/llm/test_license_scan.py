from __future__ import annotations

import re

import pytest

from stratum.llm import license_scan as ls

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
MIT = ls.TEMPLATES[4].words.split()


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, coverage=ls.COVERAGE):
    words = words_of(text)
    places, base, labels, score = [], set(), set(), 0.0
    for t in ls.TEMPLATES:
        tw, k = t.words.split(), t.width()
        hits = [(p, a) for a in range(len(tw) - k + 1) for p in range(len(words) - k + 1) if words[p:p + k] == tw[a:a + k]]
        if t.base:
            places += [p for p, _ in hits]
            if hits:
                base.add(t.label)
                score = 1.0
            continue
        runs, last = [], None
        for d in sorted({p - a for p, a in hits}):
            if last is None or d - last > ls.DRIFT:
                runs.append(set())
            runs[-1].add(d)
            last = d
        for run in runs:
            held = {a + i for p, a in hits if p - a in run for i in range(k)}
            score = max(score, len(held) / len(tw))
            if len(held) / len(tw) >= coverage:
                labels.add(t.label)
    return (len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(sorted(base | labels)), pytest.approx(score))


TEXTS = [
    None, "", "  \n", "mit", "MIT License", "mit-license MIT  LICENSE, mit\nlicense", "gnu General public license version 3",
    "Licensed under CC BY-NC 4.0. Apache License", "cc by cc by cc by", "cc cc by by", "the mit licenseé", "é mit license", "MİT license", "ＭＩＴ license",
    " ".join(MIT), "Intro words here. " + " ".join(MIT).title() + " and more",
    " ".join(MIT[:9] + ["new"] + MIT[9:]), " ".join(MIT[:9] + MIT[11:]), " ".join(MIT[:5]), " ".join(MIT[:20]), " ".join(MIT[:14]),
    " ".join(MIT[::-1]), " ".join(MIT + ["x"] * 5 + MIT), "a b " * 300 + "apache license " + "c d " * 300 + " ".join(MIT),
    "w " * (ls.CHUNK - 1) + "gnu general public license", "w " * (ls.CHUNK - 3) + "gnu general public license",
    "w " * (ls.CHUNK - 1) + "mit license", "w " * ls.CHUNK + "mit license", "mit license " * 700,
    " ".join(f"w{i}" for i in range(50_000)) + " " + ls.TEMPLATES[7].words, "gnu lesser general public license", "permission is hereby granted free",
]


def test_equals_brute_force(shipped):
    rows = [(i, t, "clash", 1, "k") for i, t in enumerate(TEXTS)]
    rows += [(4, TEXTS[4], "clash", 1, "k"), (4, TEXTS[4], None, None, None), (4, "apache license mit", "c", 1, "k"), (None, "cc by", "c", 1, "k"), (None, None, None, 1, "k")]
    df = shipped.createDataFrame(rows, "doc_id long, text string, labels string, n_words int, key string").repartition(4, "doc_id")
    out = sorted(map(tuple, ls.scan(df).collect()), key=repr)
    want = sorted([(r[0], *brute(r[1])) for r in rows], key=lambda r: repr((*r[:-1], r[-1].expected)))
    assert len(out) == len(want)
    assert all(o == w for o, w in zip(out, want)), [(o, w) for o, w in zip(out, want) if o != w][:3]


def test_corpus(corpus, corpus_rows):
    out = sorted(map(tuple, ls.scan(corpus).collect()), key=repr)
    assert out == sorted([(i, *brute(t)) for i, t in corpus_rows], key=lambda r: repr((*r[:-1], r[-1].expected)))


def test_no_rows(nothing):
    assert ls.scan(nothing).count() == 0


def test_spans_are_merged_over_put_in_words(shipped):
    text = " ".join(["lead"] * 7 + MIT[:9] + ["new"] + MIT[9:] + ["tail"])
    df = shipped.createDataFrame([(1, text)], "doc_id long, text string")
    spans = [r for r in ls.spans(ls.votes(ls.matches(ls.rolling_grams(df)))).collect() if r["template"] == 4]
    assert [(r["start"], r["end"], r["share"]) for r in spans] == [(7, 7 + len(MIT) + 1, 1.0)]


def test_own_templates_and_bounds(shipped):
    df = shipped.createDataFrame([(1, "all rights are reserved here by us")], "doc_id long, text string")
    out = ls.scan(df, (ls.Template("own", "all rights are reserved here"),)).first()
    assert (out["labels"], out["base_labels"], out["n_base"], out["score"]) == ("own", "", 0, 1.0)
    with pytest.raises(ValueError):
        ls.scan(df, (ls.Template("one", "word"),))
    with pytest.raises(ValueError):
        ls.scan(df, (ls.Template("three", "one two three", base=True),))
