"""Removal of long repeated byte strings by bucket-pointer refinement.

A byte goes if some string of ``length`` bytes around it also starts anywhere
else. Two starts belong together if their strings are equal. Starts are put into
buckets by their q-gram, and a bucket's identifier is a pointer that the other
starts of a text can read: the pointer of a longer string is made of the pointers
at its start and at a later offset (``Pointers``) - from q to 2q, 4q, ... and
``length`` - so what was refined for one start is reused for those before it, and
no bytes are compared again. Only starts in buckets that are still mixed are
refined. Pointers are identifiers made of those they refine, not places in a
sorted table: equal strings get equal pointers in whatever task they are, so
Spark groups by them instead of sorting all suffixes, and an update needs no
exchange. Three steps bring the starts of a bucket together:

* Level 0. Buckets of the q-gram. A string's bucket is that of its *anchor*, the
  q-gram with the smallest pointer in it, so the starts of a text fall into runs
  that share an anchor (about one run per 70 bytes), and equal strings always
  have equal anchors. Runs of a bucket that is held by one run only are unique;
  runs whose strings have the same pointers are repeated.
* Level 1. Only what is left of mixed buckets is refined, in blocks of 8 starts
  with the same place relative to the anchor, by the pointer of the bytes that
  all strings of the block share, then by the pointers of its first and last
  string.
* Level 2. Blocks still mixed are refined to the pointers of single strings,
  beside an independent fingerprint of the string.

At every level one representative stands for all equal members of a bucket, and
finished members are not touched again; its refinement is what others are
compared with. Bucket sizes are counted by aggregation, so a hot bucket costs
one row per map task. Members are compared by 128 bits, two numbers of 64.

Exact copies are counted first and kept once, as a bucketed table, to which the
levels' results are joined without moving texts again.

Defined results: null text is the empty text; texts shorter than ``length``
lose nothing; rows that repeat an id are separate texts; null ids are kept;
strings never span two texts; repeated rows are copies of each other; an empty
table gives an empty result; a very long text is one row, held whole with its
fingerprints (about 20 bytes a byte) by one task; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm import words
from stratum.session import scratch_path, scratch_scope

LENGTH, GRAM, BLOCK = 200, 64, 8
ROW_SCHEMA = "weak long, strong long, key long, loc long"
_CHUNK = 1 << 20
_POS = np.uint64((1 << 24) - 1)
_M = (1 << 64) - 1


def _salt(n: int) -> np.uint64:
    return np.uint64(n * 0xA0761D6478BD642F & _M)


class Prints:
    """Fingerprints of any stretch of some texts, in constant time each."""

    def __init__(self, texts: list[bytes]):
        self.blob = np.frombuffer(b"".join(texts), np.uint8)
        self.bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))]).astype(np.int64)
        values = words._EXACT[self.blob] * words._power_table(words._BASE, max(1, len(self.blob)))[:len(self.blob)]
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
        self.back = words._power_table(words._INVERSE, len(self.blob) + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return words.mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))


class Pointers:
    """Bucket pointers of strings, from those of the q-grams at every place."""

    def __init__(self, grams: np.ndarray, gram: int):
        self.grams, self.gram = grams, gram

    def of(self, start: np.ndarray, size: int) -> np.ndarray:
        """Pointers of the strings of ``size`` bytes: refined from those of the
        largest q * 2**k below, at the start and at the offset where it ends with the string."""
        if size == self.gram:
            return self.grams[start]
        half = self.gram
        while 2 * half < size:
            half *= 2
        return words.mix(self.of(start, half) + self.of(start + (size - half), half) * _salt(15) + np.uint64(size))

    def of_sizes(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        out = np.zeros(len(start), np.uint64)
        for n in np.unique(size).tolist():
            own = size == n
            out[own] = self.of(start[own], n)
        return out

    def of_run(self, first: np.ndarray, last: np.ndarray, size: int) -> np.ndarray:
        """Of all bytes under the strings from ``first`` to ``last``, which overlap or meet."""
        return words.mix(self.of(first, size) + self.of(last, size) * _salt(17) + (last - first).astype(np.uint64))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:len(x) - (width - span)], x[width - span:]) if width > span else x


def anchors(p: Prints, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, its anchor's place, pointer of every place's q-gram) for all starts of strings."""
    size = np.diff(p.bounds)
    count = np.maximum(size - length + 1, 0)
    start = np.repeat(p.bounds[:-1], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    if not len(start):
        return start, start, np.zeros(0, np.uint64)
    place = np.arange(len(p.blob) - gram + 1)
    grams = p.of(place, place + gram)
    # Equal grams: the leftmost. The place is kept modulo 2**24.
    keyed = grams & ~_POS | place.astype(np.uint64) & _POS
    least = _sliding_min(keyed, length - gram + 1)[start]
    at = start + ((least.astype(np.int64) - start) & int(_POS))
    return start, at, grams


def _cut(change: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(change)
    return first, np.append(first[1:], len(change)) - 1


def run_rows(texts: list[bytes], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Level 0: (text, start in the text, number of starts, weak, strong) of all runs."""
    p = Prints(texts)
    start, at, grams = anchors(p, length, gram)
    if not len(start):
        return (start,) * 3 + (grams,) * 2
    owner = np.searchsorted(p.bounds, start, "right") - 1
    first, last = _cut((np.diff(at, prepend=-1) != 0) | (np.diff(owner, prepend=-1) != 0))
    s, e, a = start[first], start[last], at[first]
    strong = words.mix(Pointers(grams, gram).of_run(s, e, length) + (a - s).astype(np.uint64) * _salt(3))
    return owner[first], s - p.bounds[owner[first]], e - s + 1, words.mix(grams[a] + _salt(5)), strong


def block_rows(parts: list[bytes], length: int, gram: int, block: int) -> tuple[np.ndarray, ...]:
    """Level 1 (``block`` > 1) or 2 (1): the same for blocks of the runs ``parts``,
    each given as the bytes from its first start to its last string's end."""
    p = Prints(parts)
    start, at, grams = anchors(p, length, gram)
    if not len(start):
        return (start,) * 3 + (grams,) * 2
    owner = np.searchsorted(p.bounds, start, "right") - 1
    x = at - start
    first, last = _cut((np.diff(x // block, prepend=-1) != 0) | (np.diff(owner, prepend=-1) != 0))
    s, e, a = start[first], start[last], at[first]
    lo = (a - s) // block * block
    hi = np.minimum(lo + block - 1, length - gram)
    pointers = Pointers(grams, gram)
    core = pointers.of_sizes(a - lo, length - (hi - lo))
    weak = words.mix(core + grams[a] * _salt(7) + lo.astype(np.uint64) * _salt(9))
    strong = (words.mix(pointers.of_run(s, e, length) + (a - s).astype(np.uint64) * _salt(11)) if block > 1
              else words.mix(p.of(s, s + length) + grams[a] * _salt(19) + lo.astype(np.uint64) * _salt(13)))
    return owner[first], s - p.bounds[owner[first]], e - s + 1, weak, strong


def _batch(key: np.ndarray, extra: np.ndarray, start: np.ndarray, count: np.ndarray, weak: np.ndarray, strong: np.ndarray) -> pa.RecordBatch:
    loc = extra.astype(np.int64) << 39 | start.astype(np.int64) << 8 | count.astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(weak.view(np.int64)), pa.array(strong.view(np.int64)), pa.array(key.astype(np.int64)), pa.array(loc)],
                                      names=["weak", "strong", "key", "loc"])


def _chunks(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[2])
        if size >= _CHUNK:
            yield held
            held, size = [], 0
    if held:
        yield held


def _runs(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column("key").to_pylist(), batch.column("extra").to_pylist(), batch.column("text").to_pylist())
            for held in _chunks((k, x, t.encode()) for k, x, t in rows):
                owner, start, count, weak, strong = run_rows([t for _, _, t in held], length, gram)
                key, extra = (np.array([r[i] for r in held], np.int64) for i in (0, 1))
                yield _batch(key[owner], extra[owner], start, count, weak, strong)

    return run


def _unpack(locs: list[int], extra: int) -> Iterator[tuple[int, int]]:
    """(start, number of starts) of the entries that are this text's."""
    for loc in locs:
        if loc >> 39 == extra:
            yield loc >> 8 & 0x7FFFFFFF, loc & 0xFF


def _blocks(length: int, gram: int, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts(batch: pa.RecordBatch) -> Iterator[tuple]:
            for key, extra, text, locs in zip(*(batch.column(c).to_pylist() for c in ("key", "extra", "text", "locs"))):
                raw = text.encode()
                for start, n in _unpack(locs, extra):
                    yield key, extra, raw[start:start + n - 1 + length], start

        for batch in batches:
            for held in _chunks(parts(batch)):
                owner, start, count, weak, strong = block_rows([r[2] for r in held], length, gram, block)
                key, extra, base = (np.array([r[i] for r in held], np.int64) for i in (0, 1, 3))
                yield _batch(key[owner], extra[owner], base[owner] + start, count, weak, strong)

    return run


def merge(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of the union of stretches."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(zip(starts.tolist(), ends.tolist())):
        if out and s <= out[-1][1]:
            if e > out[-1][1]:
                out[-1] = (out[-1][0], e)
        else:
            out.append((s, e))
    return out


def _removed(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, extra, text, copies, locs in zip(*(batch.column(c).to_pylist() for c in ("key", "extra", "text", "copies", "locs"))):
                raw = text.encode()
                if copies > 1 and len(raw) >= length:
                    spans = [(0, len(raw))]
                else:
                    own = np.array(list(_unpack(locs or [], extra)), np.int64).reshape(-1, 2)
                    spans = merge(own[:, 0], own[:, 0] + own[:, 1] - 1 + length)
                digest, at = hashlib.sha256(), 0
                for s, e in spans:
                    digest.update(raw[at:s])
                    at = e
                digest.update(raw[at:])
                out.append((key, extra, len(raw), sum(e - s for s, e in spans), len(spans), digest.hexdigest(), [x for span in spans for x in span]))
            cols = list(zip(*out)) or [()] * 7
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:5]), pa.array(cols[5], pa.string()), pa.array(cols[6], pa.list_(pa.int64()))],
                                             names=["key", "extra", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    return run


def _stored(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    path = path or scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _identified(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("key"),
                       F.crc32(text.cast("binary")).bitwiseAND(F.lit(0xFFFFFF)).alias("extra"), text.alias("text"))


def _texts(docs: DataFrame) -> tuple[DataFrame, str]:
    """Distinct texts with their number of copies, as a table bucketed by their identity; its name."""
    spark = docs.sparkSession
    name = f"repeats_{uuid.uuid4().hex[:12]}"
    distinct = docs.groupBy("key", "extra").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    (distinct.write.bucketBy(min(100_000, int(spark.conf.get("spark.sql.shuffle.partitions"))), "key", "extra")
     .option("path", scratch_path(spark, name)).option("compression", "zstd").saveAsTable(name))
    return spark.read.table(name), name


def _level(rows: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """(repeated (key, loc) rows, representatives to refine) of one level's rows."""
    buckets = (rows.groupBy("weak").agg(F.count(F.lit(1)).alias("n"), F.min("strong").alias("lo"), F.max("strong").alias("hi"))
               .filter("n > 1").select("weak", (F.col("lo") == F.col("hi")).alias("even")))
    shared = _stored(rows.join(_stored(buckets, f"{name}-buckets"), "weak"), f"{name}-shared")
    mixed = shared.filter("not even")
    classes = _stored(mixed.groupBy("weak", "strong").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "loc")).alias("one")), f"{name}-classes")
    again = mixed.join(classes.filter("n > 1").select("weak", "strong"), ["weak", "strong"])
    return [shared.filter("even").select("key", "loc"), again.select("key", "loc")], classes.select("one.key", "one.loc")


def _with_locs(texts: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    listed = rows.groupBy("key", F.shiftright("loc", 39).alias("extra")).agg(F.collect_list("loc").alias("locs"))
    return texts.join(listed, ["key", "extra"], how)


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and spans (start, end, start, end ...)
    of every row of ``docs`` (doc_id, text)."""
    if not 0 < gram <= length or length - gram > 254:
        raise ValueError("need 0 < gram <= length <= gram + 254")
    spark = docs.sparkSession
    named = _identified(docs)
    path = scratch_path(spark, "repeats")
    with scratch_scope(spark):  # what is made on the way goes once the results are stored
        texts, name = _texts(named)
        try:
            _find(texts, length, gram).write.parquet(path)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    result = spark.read.parquet(path)
    return named.select("doc_id", "key", "extra").join(result, ["key", "extra"]).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")


def _find(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """Removed spans and what is left of each distinct text."""
    long_ = texts.filter(F.octet_length("text") >= length)
    runs = long_.select("key", "extra", "text").mapInArrow(_runs(length, gram), ROW_SCHEMA)
    found, left = _level(runs, "level0")
    rows = _stored(_with_locs(long_, left, "inner").select("key", "extra", "text", "locs").mapInArrow(_blocks(length, gram, BLOCK), ROW_SCHEMA), "level1")
    more, left = _level(rows, "level1")
    found += more
    rows = _stored(_with_locs(long_, left, "inner").select("key", "extra", "text", "locs").mapInArrow(_blocks(length, gram, 1), ROW_SCHEMA), "level2")
    same = _stored(rows.groupBy("weak", "strong").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("weak", "strong"), "level2-same")
    found.append(rows.join(same, ["weak", "strong"]).select("key", "loc"))
    spans = found[0]
    for more_ in found[1:]:
        spans = spans.union(more_)
    return (_with_locs(texts, spans, "left").select("key", "extra", "text", "copies", "locs")
            .mapInArrow(_removed(length), "key long, extra long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>"))
