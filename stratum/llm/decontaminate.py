"""Benchmark decontamination by size-partitioned MinHash containment search.

A benchmark item is contained in a document if at least ``percent`` of its
distinct word shingles are among the document's. Items are short and documents
may be long, so Jaccard similarity - what plain MinHash estimates - says little.
Instead:

* Items are partitioned by size (powers of two). The partition fixes how many
  of an item's smallest shingle hashes, its bottom MinHash sketch, are looked
  up: one more than a document may miss. So a document that contains the item
  has at least one of them, and no pair is lost.
* Documents stay whole. Each one's shingles are looked up among the sketches;
  partitions whose smallest item needs more shingles than the document has are
  left out. A hit makes a candidate pair.
* Candidates are verified on the item's full shingle set.

The benchmark is cut into blocks of at most ``block_shingles`` shingles (a size
bound for what is sent to executors); documents are scanned once per block,
without any shuffle of texts. A usual benchmark is one block. A benchmark of
more than ``sent_shingles`` does not pass through the driver: sketches, sized by
the same partitions, are joined with the documents' shingles as tables (shingles
that many texts share are split by Spark's skew join), and candidates with the
full sets.

Defined results: null or wordless items and texts match nothing; a text with
fewer words than a shingle has its whole sequence as one, so a short item is
found only in a text that equals it - unless ``short_inside`` is set, as the
query and the pipeline do; then it is found wherever its words stand; repeated items and
rows give repeated pairs; null ids are kept; an empty benchmark or an empty
table gives no pairs; a very long text is shingled in pieces, so that a task
holds it and 8 bytes a shingle. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.llm import tokens, words, worker
from stratum.session import scratch_path

WORDS, PERCENT = 5, 80
BLOCK_SHINGLES = 2_000_000  # 8 bytes each, twice: at most about 40 MB a block
SENT_SHINGLES = 8_000_000  # of all blocks: at most about 64 MB held on the driver
PAIR_SCHEMA = "doc_id long, item_id long, item_shingles long, shared_shingles long"


def needed(size: np.ndarray, percent: int) -> np.ndarray:
    """How many of ``size`` shingles a document must share."""
    return -(-size * percent // 100)


class Block:
    """Items of one block: full sets, sketches, and the size partitions."""

    def __init__(self, ids: list[int | None], sets: list[np.ndarray], percent: int):
        self.ids, self.sets, self.percent = ids, sets, percent
        size = np.array([len(s) for s in sets], np.int64)
        self.need = needed(size, percent)
        partition = np.where(size > 0, np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64), 0)
        self.partitions = []
        for p in np.unique(partition[size > 0]):
            own = np.flatnonzero((partition == p) & (size > 0))
            # Missing `slack` shingles is allowed, so `slack + 1` sketch values suffice.
            slack = (1 << int(p)) - int(needed(np.array([1 << int(p)]), percent)[0])
            slack = np.maximum(slack, size[own] - self.need[own])
            keys = [sets[i][:k + 1] for i, k in zip(own, slack)]
            owner = np.repeat(own, [len(k) for k in keys])
            key = np.concatenate(keys)
            order = np.argsort(key, kind="stable")
            self.partitions.append((int(self.need[own].min()), key[order], owner[order]))

    def search(self, values: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(text, item, item's size, shared) for every contained item of a run of texts."""
        size = np.diff(bounds)
        text = np.repeat(np.arange(len(size)), size)
        pairs = set()
        for least, key, owner in self.partitions:
            lo = np.searchsorted(key, values, "left")
            hit = np.flatnonzero((key[np.minimum(lo, len(key) - 1)] == values) & (size[text] >= least))
            n = np.searchsorted(key, values[hit], "right") - lo[hit]
            at = np.repeat(lo[hit], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            pairs.update(zip(np.repeat(text[hit], n).tolist(), owner[at].tolist()))
        out = []
        for t, i in sorted(pairs):
            own, item = values[bounds[t]:bounds[t + 1]], self.sets[i]
            pos = np.minimum(np.searchsorted(own, item), len(own) - 1)
            shared = int((own[pos] == item).sum())
            if shared >= self.need[i]:
                out.append((t, i, len(item), shared))
        return out


def _item_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in tokens.batches(batch.column("text").to_pylist(), 1 << 19):
                values, bounds = words.shingles([t.encode(errors="replace") for t in texts], size)
                raw = [values[bounds[i]:bounds[i + 1]].tobytes() for i in range(len(texts))]
                yield pa.RecordBatch.from_arrays([batch.column("item_id").slice(at, len(texts)), pa.array(np.diff(bounds), pa.int64()),
                                                  pa.array(raw, pa.binary())], names=["item_id", "n", "shingles"])

    return run


def _stored_sets(items: DataFrame, size: int) -> DataFrame:
    """Item sets (item_id, n, shingles) with the written partition and a row number."""
    spark = items.sparkSession
    path = scratch_path(spark, "benchmark-sets")
    (items.select(F.col("item_id").cast("long").alias("item_id"), "text")
     .mapInArrow(worker.task("decontaminate", _item_sets(size)), "item_id long, n long, shingles binary").filter("n > 0")
     .withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()).write.parquet(path))
    sets = spark.read.parquet(path)
    return sets


def _numbered(sets: DataFrame, block_shingles: int) -> tuple[DataFrame, int]:
    """``sets`` with a block number, counted on over all written partitions, and how many blocks there are."""
    spark = sets.sparkSession
    totals = sets.groupBy("part").agg(F.sum("n").alias("total")).orderBy("part").collect()
    starts, total = [], 0
    for r in totals:
        starts.append((r["part"], total))
        total += r["total"]
    starts = F.broadcast(spark.createDataFrame(starts, "part int, start long"))
    # A running sum within each written partition, so no task sees more than one of them.
    before = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    sets = sets.join(starts, "part").withColumn("block", F.floor((F.col("start") + F.sum("n").over(before) - 1) / block_shingles))
    return sets, -(-total // block_shingles)


def contained_items(docs: DataFrame, items: DataFrame, size: int = WORDS, percent: int = PERCENT,
                    block_shingles: int = BLOCK_SHINGLES, sent_shingles: int = SENT_SHINGLES, short_inside: bool = False) -> DataFrame:
    """doc_id, item_id, item_shingles, shared_shingles of every document (doc_id, text)
    and every item (item_id, text) that it contains.

    ``short_inside``: an item of fewer than ``size`` words is looked for among the
    documents' word sequences of its own length, not among whole texts only.
    """
    spark = docs.sparkSession
    if short_inside:
        length = F.size(F.filter(F.split("text", "[\\x09-\\x0D\\x20]+"), lambda w: w != ""))
        items = items.withColumn("__width", F.least(length, F.lit(size)))
        widths = sorted(r[0] for r in items.filter(F.col("text").isNotNull()).select("__width").distinct().collect() if r[0] > 0)
        found = [contained_items(docs, items.filter(F.col("__width") == w), w, percent, block_shingles, sent_shingles) for w in widths]
        return reduce(DataFrame.union, found or [spark.createDataFrame([], T.StructType.fromDDL(PAIR_SCHEMA))])
    sets = _stored_sets(items, size)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = sets.agg(F.sum("n")).first()[0]
    if total is None:
        return spark.createDataFrame([], T.StructType.fromDDL(PAIR_SCHEMA))
    if total > sent_shingles:
        return _joined(texts, sets, size, percent)
    sets, blocks = _numbered(sets, block_shingles)
    out = None
    for block in range(blocks):
        rows = sets.filter(F.col("block") == block).select("item_id", "shingles").collect()
        if not rows:  # within an item of more than a block
            continue
        shared = spark.sparkContext.broadcast([(r["item_id"], bytes(r["shingles"])) for r in rows])
        found = texts.mapInArrow(worker.task("decontaminate", _search(shared, size, percent)), PAIR_SCHEMA)
        out = found if out is None else out.union(found)
    return out


def _joined(texts: DataFrame, sets: DataFrame, size: int, percent: int) -> DataFrame:
    """The same pairs by joins: sketches with the documents' shingles, then the candidates' full sets."""
    path = scratch_path(texts.sparkSession, "document-sets")
    (texts.select(F.col("doc_id").alias("item_id"), "text").mapInArrow(worker.task("decontaminate", _item_sets(size)), "item_id long, n long, shingles binary").filter("n > 0")
     .withColumn("doc", F.monotonically_increasing_id()).withColumnRenamed("item_id", "doc_id").write.parquet(path))
    own = texts.sparkSession.read.parquet(path)
    need = F.ceil(F.col("n") * percent / 100)
    # The size partition fixes the sketch, as in ``Block``: what its largest item may miss, and one more.
    top = F.pow(F.lit(2), F.ceil(F.log2("n")))
    slack = F.greatest((top - F.ceil(top * percent / 100)).cast("long"), F.col("n") - need)
    sketch = (sets.select(F.col("at").alias("id"), "n", "shingles", (slack + 1).alias("take")).mapInArrow(worker.task("decontaminate", _keys), "id long, key long, n long")
              .select(F.col("id").alias("at"), "key", need.alias("need")))
    keys = own.select(F.col("doc").alias("id"), "n", "shingles", F.col("n").alias("take")).mapInArrow(worker.task("decontaminate", _keys), "id long, key long, n long")
    pairs = keys.join(sketch, "key").filter("n >= need").select(F.col("id").alias("doc"), "at").distinct()
    pairs = pairs.join(own.select("doc", "doc_id", F.col("shingles").alias("own")), "doc").join(sets.select("at", "item_id", "n", "shingles"), "at")
    return pairs.select("doc_id", "item_id", "own", "shingles").mapInArrow(worker.task("decontaminate", _verified(percent)), PAIR_SCHEMA)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, n, shingles, take -> id, key, n of the ``take`` smallest shingles."""
    for batch in batches:
        for i in range(0, batch.num_rows, 64):
            ids, sizes, raw, take = (c.to_pylist() for c in batch.slice(i, 64).columns)
            keys = [np.frombuffer(r, np.int64)[:k] for r, k in zip(raw, take)]
            count = [len(k) for k in keys]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(ids, np.int64), count)), pa.array(np.concatenate(keys)),
                                              pa.array(np.repeat(np.array(sizes, np.int64), count))], names=["id", "key", "n"])


def _verified(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, item_id, own, item in zip(*(c.to_pylist() for c in batch.columns)):
                own, item = np.frombuffer(own, np.uint64), np.frombuffer(item, np.uint64)
                common = int((own[np.minimum(np.searchsorted(own, item), len(own) - 1)] == item).sum())
                if common >= needed(np.array([len(item)]), percent)[0]:
                    rows.append((doc_id, item_id, len(item), common))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in list(zip(*rows)) or [()] * 4],
                                             names=["doc_id", "item_id", "item_shingles", "shared_shingles"])

    return run


def _search(shared, size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block([i for i, _ in shared.value], [np.frombuffer(s, np.uint64) for _, s in shared.value], percent)
        for batch in batches:
            for at, run_ in tokens.batches(batch.column("text").to_pylist(), 1 << 19):
                pairs = block.search(*words.shingles([t.encode(errors="replace") for t in run_], size))
                ids = batch.column("doc_id").slice(at, len(run_)).to_pylist()
                rows = list(zip(*[(ids[t], block.ids[i], n, k) for t, i, n, k in pairs])) or [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows],
                                                 names=["doc_id", "item_id", "item_shingles", "shared_shingles"])

    return run


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = WORDS, percent: int = PERCENT, short_inside: bool = False,
                      least_words: int = 1) -> DataFrame:
    """``docs`` without the documents that contain a benchmark item; all columns stay.

    Documents with a null id can't be named by a pair, so they are told apart by
    their text. With ``short_inside``, items of fewer than ``least_words`` words are
    nevertheless looked for among whole texts only: one or two common words inside
    a text say nothing.
    """
    keyed = docs.select(F.xxhash64("text").alias("doc_id"), "text")
    if short_inside:
        tiny = F.size(F.filter(F.split("text", "[\\x09-\\x0D\\x20]+"), lambda w: w != "")) < least_words
        found = contained_items(keyed, items.filter(~tiny), size, percent, short_inside=True)
        if least_words > 1:
            found = found.union(contained_items(keyed, items.filter(tiny), size, percent))
    else:
        found = contained_items(keyed, items, size, percent)
    gone = found.select(F.col("doc_id").alias("__key")).distinct()
    path = scratch_path(docs.sparkSession, "contaminated")
    gone.write.parquet(path)
    gone = docs.sparkSession.read.parquet(path)
    return docs.join(gone, F.xxhash64(docs["text"]) == gone["__key"], "left_anti")
