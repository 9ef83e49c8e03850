"""Toxicity scores: gradient-boosted trees over dense features, calibrated.

``fit`` learns everything from labelled rows, none of them held out:

* a lexicon - words and word beginnings that toxic documents use far more often,
* trees over dense features (lexicon densities, second-person proximity,
  capitals, punctuation and obfuscation rates), by logistic boosting,
* an isotonic map from margins to probabilities.

The training rows are halved: the features that the trees learn from use the
lexicon of the other half, and the calibration uses margins of trees that did
not see the row. The map never falls: a higher margin never gets a lower score.
The final lexicon and trees use all training rows. Labels, language, source and
ids are no features. At most ``max_rows`` labelled rows (by a hash of the id) are
used; a term needs support (one in 200 toxic rows), so the model's size is
bounded by them, whatever the number of documents. Scoring is one pass over whole
texts without a shuffle.

Defined results: null text scores as the empty text, which has features of 0; a
text of any length is read whole, in the memory of one task;
repeated rows are scored each; a null doc_id is never trained on; of repeated
labels of one id the highest counts, null labels don't; without labels of both
classes every score is the positive rate of the labels (0 without any).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm import tokens, worker
from stratum.session import scratch_path, scratch_scope

MAX_ROWS = 20_000     # labelled rows used at most
NEAR = 4              # words between a lexicon word and a second-person pronoun
_KEPT = 300_000       # words remembered by a worker

# Second-person pronouns (en, de, fr, es), characters that stand
# in for letters, lengths of word beginnings.
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine deinen ihr euch euer sie tu te toi ton ta tes "
                          "vous votre vos tú ti tus usted ustedes vosotros".split())
STAND_INS = str.maketrans("0134578@$!|€", "oieastbasiie")
BEGINNINGS = (4, 5, 6)

FEATURES = ("density", "hits", "heaviest", "distinct", "hidden_density", "hidden_hits", "near_person", "person_rate",
            "capital_rate", "shouted_rate", "punctuation_rate", "exclamation_rate", "obfuscated_rate", "words")


def held_out(doc_id: Column) -> Column:
    return fold(doc_id) == 0


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


# -- words ------------------------------------------------------------------

_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_INNER = re.compile(r"[\W_]+")
_LONG = re.compile(r"(.)\1{2,}")


def plain(word: str) -> str:
    return _EDGE.sub("", word).lower()


def unmasked(word: str) -> str:
    """The word without stand-in characters, inner punctuation and stretched letters."""
    return _LONG.sub(r"\1", _INNER.sub("", word.lower().translate(STAND_INS)))


def terms(word: str) -> list[str]:
    """What the lexicon may hold of a plain word: itself and its beginnings, marked by a star."""
    return [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) > n)] if word else []


class Reader:
    """Dense features of texts. Each distinct word is judged once and remembered."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.kinds: dict[tuple, int] = {}
        self.rows: list[tuple] = []
        self.words: dict[str, int] = {}
        self._kind((0.0, 0.0, False, False, False, -1))

    def _kind(self, row: tuple) -> int:
        if row not in self.kinds:
            self.kinds[row] = len(self.rows)
            self.rows.append(row)
        return self.kinds[row]

    def _weight(self, word: str) -> float:
        return max((self.lexicon.get(t, 0.0) for t in terms(word)), default=0.0)

    def _judge(self, raw: str) -> int:
        word = plain(raw)
        weight = self._weight(word)
        odd = not word.isalpha() and bool(word)
        stretched = bool(_LONG.search(word))
        hidden = 0.0 if weight or not (odd or stretched) else self._weight(unmasked(_EDGE.sub("", raw) if odd else word))
        shouted = len(word) > 1 and raw.isupper() and word.isalpha()
        masked = (odd and any(c.isalpha() for c in word)) or stretched
        # Distinct hits are told apart by a small digest of the word.
        mark = hash_of(word) if weight else -1
        return self._kind((weight, hidden, word in SECOND_PERSON, shouted, masked, mark))

    def features(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), len(FEATURES)))
        if len(self.words) > _KEPT:
            self.words.clear()
        split = [t.split() for t in texts]
        for w in set().union(*split) - self.words.keys():
            self.words[w] = self._judge(w)
        table = np.array(self.rows, np.float64)
        for i, words in enumerate(split):
            if not words:
                continue
            kinds = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
            marked = np.flatnonzero(kinds)
            row = table[kinds[marked]]
            n = len(words)
            hit, hidden, person = row[:, 0] > 0, row[:, 1] > 0, row[:, 2] > 0
            near = 0
            if person.any() and (hit | hidden).any():
                at, who = marked[hit | hidden], marked[person]
                j = np.searchsorted(who, at)
                after = who[np.minimum(j, len(who) - 1)] - at
                before = at - who[np.maximum(j - 1, 0)]
                near = int(((np.abs(after) <= NEAR) | (np.abs(before) <= NEAR)).sum())
            raw = np.bincount(np.frombuffer(texts[i].encode(errors="replace"), np.uint8), minlength=256)
            size = raw.sum()
            capitals, letters = raw[65:91].sum(), raw[65:91].sum() + raw[97:123].sum()
            signs = raw[33:48].sum() + raw[58:65].sum() + raw[91:97].sum() + raw[123:127].sum()
            out[i] = (row[:, 0].sum() / n, math.log1p(hit.sum()), row[:, 0].max(initial=0), len(set(row[hit, 5])),
                      row[:, 1].sum() / n, math.log1p(hidden.sum()), math.log1p(near), person.sum() / n,
                      capitals / max(1, letters), row[:, 3].sum() / n, signs / size, (raw[33] + raw[63]) / size,
                      row[:, 4].sum() / n, math.log1p(n))
        return out


def hash_of(word: str) -> int:
    import zlib

    return zlib.crc32(word.encode(errors="replace")) & 0xFFFF


# -- trees ------------------------------------------------------------------

@dataclass
class Trees:
    """Boosted trees of fixed depth, stored as complete binary trees."""
    base: float
    depth: int
    splits: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)  # feature, threshold, leaf values

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, value in self.splits:
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            out += value[at - (2 ** self.depth - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 64,
          ridge: float = 1.0, least: float = 0.5) -> Trees:
    """Second-order logistic boosting on binned features."""
    p = min(max(y.mean(), 1e-6), 1 - 1e-6)
    model = Trees(math.log(p / (1 - p)), depth)
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    edges = [np.unique(np.append(e, c.min())) for e, c in zip(edges, x.T)]  # so that "none" and "any" are told apart
    binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)], 1)
    margin = np.full(len(y), model.base)
    nodes = 2 ** depth - 1
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-margin))
        g, h = q - y, q * (1 - q)
        feature, threshold = np.zeros(nodes, np.int64), np.full(nodes, np.inf)
        at = np.zeros(len(y), np.int64)
        for node in range(nodes):
            own = np.flatnonzero(at == node)
            best = 1e-9
            cut = None
            if len(own):
                total_g, total_h = g[own].sum(), h[own].sum()
                for f, e in enumerate(edges):
                    left_g = np.cumsum(np.bincount(binned[own, f], g[own], len(e) + 1))[:-1]
                    left_h = np.cumsum(np.bincount(binned[own, f], h[own], len(e) + 1))[:-1]
                    right_g, right_h = total_g - left_g, total_h - left_h
                    gain = left_g ** 2 / (left_h + ridge) + right_g ** 2 / (right_h + ridge) - total_g ** 2 / (total_h + ridge)
                    gain[(left_h < least) | (right_h < least)] = 0
                    if len(gain) and gain.max() > best:
                        best, cut = gain.max(), (f, e[int(gain.argmax())])
            if cut:
                feature[node], threshold[node] = cut
            at[own] = 2 * node + 1 + (x[own, feature[node]] > threshold[node])
        leaf = at - nodes
        value = -rate * np.bincount(leaf, g, nodes + 1) / (np.bincount(leaf, h, nodes + 1) + ridge)
        model.splits.append((feature, threshold, value))
        margin += value[leaf]
    return model


def pooled(value: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(mean, length) of the blocks of the best non-decreasing fit to weighted values (pool adjacent violators)."""
    blocks: list[list[float]] = []  # weighted sum, weight, values
    for v, w in zip(value.tolist(), weight.tolist()):
        blocks.append([v * w, w, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            total, w2, n = blocks.pop()
            blocks[-1] = [blocks[-1][0] + total, blocks[-1][1] + w2, blocks[-1][2] + n]
    return np.array([b[0] / b[1] for b in blocks]), np.array([b[2] for b in blocks], np.int64)


def isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots (margin, probability) of a non-decreasing fit. Each block of the
    best fit is drawn to the positive rate, as by one row more, so that no score
    claims certainty; blocks that this puts out of order are pooled again."""
    order = np.argsort(margin, kind="stable")
    margin, y = margin[order], y[order]
    p, n = pooled(y, np.ones(len(y)))
    p, merged = pooled((p * n + y.mean()) / (n + 1), n + 1.0)
    n = np.add.reduceat(n, np.concatenate([[0], np.cumsum(merged)[:-1]]))
    at = np.add.reduceat(margin, np.concatenate([[0], np.cumsum(n)[:-1]])) / n
    return at, np.maximum.accumulate(p)  # against rounding


@dataclass
class Model:
    lexicon: dict[str, float]
    trees: Trees | None
    knots: tuple[np.ndarray, np.ndarray] | None
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None or self.knots is None:
            return np.full(len(x), self.prior)
        at, p = self.knots
        margin = self.trees.margin(x)
        flat = np.interp(margin, at, p)
        # Flat stretches keep the order of the margins.
        return np.clip(0.999 * flat + 0.001 / (1 + np.exp(-margin)), 0, 1)


# -- Spark ------------------------------------------------------------------

_COUNTS = ("clean_0", "toxic_0", "clean_1", "toxic_1")  # documents with a term, by label and half


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = [Counter() for _ in _COUNTS]

    def flush() -> pa.RecordBatch:
        keys = list(set().union(*counts))
        batch = pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *(pa.array([c[k] for k in keys], pa.int64()) for c in counts)],
                                           names=["term", *_COUNTS])
        for c in counts:
            c.clear()
        return batch

    for batch in batches:
        for text, label, half in zip(*(batch.column(c).to_pylist() for c in ("text", "toxic", "half"))):
            words = {plain(w) for w in set((text or "").split())}
            counts[2 * half + label].update({t for w in words for t in terms(w)})
            if sum(map(len, counts)) > 300_000:
                yield flush()
    yield flush()


def _lexicons(rows: DataFrame) -> list[dict[str, float]]:
    """Terms whose document frequency is far higher in toxic than in clean rows:
    of the first half, the second half, and all rows."""
    sizes = Counter()
    for r in rows.groupBy("half", "toxic").count().collect():
        sizes[f"{'toxic' if r['toxic'] else 'clean'}_{r['half']}"] = r["count"]
    toxic = sizes["toxic_0"] + sizes["toxic_1"]
    counts = (rows.select("text", "toxic", "half").mapInArrow(worker.task("toxicity", _term_counts), "term string, " + ", ".join(f"{c} long" for c in _COUNTS))
              .groupBy("term").agg(*(F.sum(c).alias(c) for c in _COUNTS)))
    ratio = (F.col("toxic_0") + F.col("toxic_1") + 0.5) / (F.col("clean_0") + F.col("clean_1") + 0.5)
    ratio = ratio * F.lit((sizes["clean_0"] + sizes["clean_1"] + 1) / (toxic + 1))
    top = (counts.filter(F.col("toxic_0") + F.col("toxic_1") >= max(3, round(0.005 * toxic))).filter(ratio > 4)
           .collect())  # each in one of 200 toxic rows: at most 200 times the terms of a mean one
    out = []
    for halves in ((0,), (1,), (0, 1)):
        n = [sum(sizes[f"{k}_{h}"] for h in halves) for k in ("toxic", "clean")]
        kept = {}
        for r in top:
            t, c = (sum(r[f"{k}_{h}"] for h in halves) for k in ("toxic", "clean"))
            odds = math.log((t + 0.5) / (n[0] + 1)) - math.log((c + 0.5) / (n[1] + 1))
            if t >= max(2, round(0.005 * n[0])) and odds > 2:
                kept[r["term"]] = round(odds, 6)
        out.append(kept)
    return out


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """(doc_id, text, toxic, fold) of at most ``max_rows`` labelled documents that aren't held out.

    A doc_id has one label and counts once, so of rows that repeat it one text is
    taken: that with the smallest hash.
    """
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    own = own.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    own = own.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id")).limit(max_rows)
    # Bounded by max_rows rows of two numbers.
    path = scratch_path(docs.sparkSession, "labelled-rows")
    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(own), "doc_id")
     .withColumn("row", F.monotonically_increasing_id()).write.parquet(path))
    rows = docs.sparkSession.read.parquet(path)
    # Only numbers are shuffled; the row number tells equal texts apart.
    one = rows.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("key"), "row")).alias("least")).select("least.row")
    return rows.join(F.broadcast(one), "row", "left_semi").drop("row").withColumn("fold", fold(F.col("doc_id")))


def _features(lexicons: list[dict[str, float]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        readers = [Reader(lexicons[1]), Reader(lexicons[0])]  # each half by the lexicon of the other
        for batch in batches:
            halves = np.array(batch.column("half").to_pylist(), np.int64)
            for half, reader in enumerate(readers):
                own = batch.filter(pa.array(halves == half))
                for at, texts in tokens.batches(own.column("text").to_pylist()):
                    x = reader.features(texts)
                    yield pa.RecordBatch.from_arrays(
                        [own.column("toxic").slice(at, len(texts)), own.column("fold").slice(at, len(texts)),
                         pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, len(FEATURES)), pa.int32()), pa.array(x.ravel()))],
                        names=["toxic", "fold", "x"])

    return run


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    with scratch_scope(docs.sparkSession):
        rows = training_rows(docs, labels, max_rows).withColumn("half", (F.col("fold") > 2).cast("int"))
        lexicons = _lexicons(rows)
        got = (rows.select("text", "toxic", F.col("fold").cast("int").alias("fold"), "half")
               .mapInArrow(worker.task("toxicity", _features(lexicons)), "toxic int, fold int, x array<double>").collect())  # at most max_rows rows, one a doc_id
    y = np.array([r["toxic"] for r in got], np.float64)
    x = np.array([r["x"] for r in got], np.float64).reshape(-1, len(FEATURES))
    kind = np.array([r["fold"] for r in got], np.int64)
    # A fixed order of rows: the sums of the fit don't depend on the partitions.
    order = np.lexsort((*x.T, y, kind))
    x, y, kind = x[order], y[order], kind[order]
    prior = float(y.mean()) if len(y) else 0.0
    if any(len(set(y[kind != k])) < 2 for k in set(kind.tolist()) | {0}):
        return Model(lexicons[2], None, None, prior)
    margin = np.zeros(len(y))
    for k in set(kind.tolist()):
        margin[kind == k] = boost(x[kind != k], y[kind != k]).margin(x[kind == k])
    return Model(lexicons[2], boost(x, y), isotonic(margin, y), prior)


def score(docs: DataFrame, model: Model, score_column: str = "score", predicted_column: str = "predicted") -> DataFrame:
    """``docs`` with a score (0 to 1) and a prediction (1 from 0.5 on); all other columns stay."""
    docs = docs.drop(score_column, predicted_column)
    schema = docs.withColumn(score_column, F.lit(0.0)).withColumn(predicted_column, F.lit(0)).schema
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value.lexicon)
        for batch in batches:
            scores = [np.zeros(0)]
            for _, texts in tokens.batches(batch.column("text").to_pylist()):
                scores.append(shared.value.score(reader.features(texts)))
            s = np.concatenate(scores)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                                             names=[*batch.schema.names, score_column, predicted_column])

    return docs.mapInArrow(worker.task("toxicity", run), schema)


def drop_toxic(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """``docs`` without the rows that a model fitted on ``labels`` rejects; all columns stay."""
    scored = score(docs, fit(docs, labels, max_rows), "__score", "__predicted")
    return scored.filter(F.col("__predicted") == 0).select(*docs.columns)
