"""Near-duplicate groups by SuperMinHash, banding, verification and union-find.

1. Every text becomes its set of distinct word shingles; equal sets are one
   *node* (a 128-bit fingerprint of the set). From here on only nodes count, so
   any number of copies costs one node.
2. A SuperMinHash signature of each node: for element ``x`` and level ``j`` a
   draw gives a rank ``r`` and the slot ``pi_x(j)`` of a random permutation; a
   slot keeps the least ``j + r``. Levels run in step for all elements of a
   text, and a text is finished at the level that fills its last slot, which for
   long texts is one of the first.
3. Bands of the signature are bucket keys. Links are looked for in rounds, each
   leaving out pairs that are connected already: every node with its smallest
   bucket leader; then every node with all its bucket leaders; then what is still
   in one bucket but in different groups. From the second round on, nodes
   are held against a bound: shingles that no other node of an unsettled bucket
   has are counted, and with ``s`` others left, a pair shares at most the smaller
   ``s``. Edited copies that are similar to none drop out by that alone. What is
   left for the last round is not compared bucket by bucket: nodes meet where they
   share one of their rarest shingles (``prefixes``) and are of like size, which
   no similar pair fails to do. After it each pair of each bucket has been
   verified, is connected, or cannot be similar enough.
4. Pairs are verified on full sets: both texts are shingled again and compared
   (100 * intersection >= percent * union).
5. Groups are the components of the verified links, found by contracting the
   link table in Spark.

With 32 bands of 4 slots a pair at similarity 0.8 misses all buckets with
probability 5e-8.

Defined results: null text is empty; a very long text is shingled in pieces and
signed in slices, so that a task holds its text and 8 bytes a shingle; a text
without words has no shingles, is linked with nothing and is its own group; a text with fewer words than a
shingle has its whole sequence as one; rows that repeat a doc_id are separate
texts with that id; null ids are never a group's id unless it has no other;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm import tokens, words, worker
from stratum.session import scratch_path, scratch_scope

BANDS, ROWS = 32, 4
WORDS, PERCENT = 5, 80
CELLS = 2048  # of the parity sketch; a power of two
_GOLD = 0x9E3779B97F4A7C15
_UNSET = np.uint64((1 << 64) - 1)
_ELEMENTS = 1 << 17  # elements handled at once, 128 bytes each
_TEXTS = 2048        # texts handled at once; a parity sketch is counted in 16 kB each
_LEADS = 64          # rarest shingles that a node of the last round lists, to meet another once
_PAIR_CHARS = 1 << 19  # characters of both texts of the pairs verified at once


def super_minhash(values: np.ndarray, bounds: np.ndarray, slots: int) -> np.ndarray:
    """(texts, slots) signatures of element sets given end to end; a set without elements keeps the top value."""
    texts = len(bounds) - 1
    sig = np.full(texts * slots, _UNSET, np.uint64)
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(texts), sizes)
    value = values
    perm = np.broadcast_to(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.uint16), (len(values), slots)).copy()
    rows = np.arange(len(values))
    for level in range(slots):
        draw = words.mix(value + np.uint64((level + 1) * _GOLD & (1 << 64) - 1))
        pick = level + ((draw & np.uint64(0xFFFFFFFF)) * np.uint64(slots - level) >> np.uint64(32)).astype(np.int64)
        slot = perm[rows, pick]
        perm[rows, pick] = perm[rows, level]
        rank = draw >> np.uint64(32) | np.uint64(level << 32)
        np.minimum.at(sig, owner * slots + slot, rank)
        open_ = (sig.reshape(texts, slots) == _UNSET).any(1) & (sizes > 0)
        if not open_.any():
            break
        keep = open_[owner]
        if keep.sum() < 0.7 * len(keep):
            owner, value, rows = owner[keep], value[keep], rows[keep]
    return sig.reshape(texts, slots)


def signatures(values: np.ndarray, bounds: np.ndarray, slots: int) -> np.ndarray:
    """``super_minhash`` of many sets, at most ``_ELEMENTS`` elements at a time. A
    larger set is signed slice by slice: each slot's least rank of the whole is
    the least of the slices'."""
    out = np.empty((len(bounds) - 1, slots), np.uint64)
    i = 0
    while i < len(out):
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + _ELEMENTS, "right")) - 1)
        if bounds[j] - bounds[i] <= _ELEMENTS:
            out[i:j] = super_minhash(values[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i], slots)
        else:
            parts = (values[at:min(at + _ELEMENTS, bounds[j])] for at in range(int(bounds[i]), int(bounds[j]), _ELEMENTS))
            out[i] = np.minimum.reduce([super_minhash(p, np.array([0, len(p)]), slots)[0] for p in parts])
        i = j
    return out


def fingerprints(values: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """128 bits for each set; the same for the same set."""
    out = np.zeros((len(bounds) - 1, 2), np.uint64)
    for i, salt in enumerate((0x243F6A8885A308D3, 0x13198A2E03707344)):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words.mix(values + np.uint64(salt)), dtype=np.uint64)])
        out[:, i] = sums[bounds[1:]] - sums[bounds[:-1]]
    raw = out.tobytes()
    return [raw[16 * i:16 * i + 16] for i in range(len(out))]


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    for at, run in tokens.batches(texts, 1 << 19):
        for i in range(0, len(run), _TEXTS):
            yield at + i, [t.encode(errors="replace") for t in run[i:i + _TEXTS]]


def _signed(size: int, bands: int, rows: int):
    """doc_id, text_key, text -> doc_id, text_key, n_shingles, node, buckets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in _chunks(batch.column("text").to_pylist()):
                values, bounds = words.shingles(texts, size)
                n = np.diff(bounds)
                sig = signatures(values, bounds, bands * rows)
                keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(texts), bands)).copy()
                for k in range(rows):
                    keys = words.mix(keys * np.uint64(_GOLD) + sig.reshape(len(texts), bands, rows)[:, :, k])
                buckets = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, bands), pa.int32()), pa.array(keys.view(np.int64).ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(texts)), batch.column("text_key").slice(at, len(texts)), pa.array(n, pa.int64()),
                     pa.array(fingerprints(values, bounds), pa.binary()), buckets], names=["doc_id", "text_key", "n_shingles", "node", "buckets"])

    return run


def _own_node(size: int):
    """(node, text) rows whose text really has that node's set: ids may repeat."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in _chunks(batch.column("text").to_pylist()):
                own = np.array(fingerprints(*words.shingles(texts, size)), object)
                part = batch.slice(at, len(texts))
                yield part.filter(pa.array(own == np.array(part.column("node").to_pylist(), object)))

    return run


def _linked(size: int, percent: int):
    """a, b, text_a, text_b -> the pairs a, b that are similar enough."""
    def similar(part: pa.RecordBatch) -> list[bool]:
        both = {}
        for side in "ab":
            both.update(zip(part.column(side).to_pylist(), part.column(f"text_{side}").to_pylist()))
        at = {node: k for k, node in enumerate(both)}
        values, bounds = words.shingles([(t or "").encode(errors="replace") for t in both.values()], size)
        good = []
        for a, b in zip(part.column("a").to_pylist(), part.column("b").to_pylist()):
            x, y = (values[bounds[at[k]]:bounds[at[k] + 1]] for k in (a, b))
            short, long = (x, y) if len(x) < len(y) else (y, x)
            pos = np.minimum(np.searchsorted(long, short), len(long) - 1)
            common = int((long[pos] == short).sum())
            good.append(100 * common >= percent * (len(x) + len(y) - common))
        return good

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chars = sum(pc.utf8_length(batch.column(f"text_{side}")).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for side in "ab")
            ends = np.cumsum(chars)
            i = 0
            while i < batch.num_rows:
                limit = _PAIR_CHARS + (ends[i - 1] if i else 0)
                j = max(i + 1, min(i + 128, int(np.searchsorted(ends, limit, "right"))))
                part = batch.slice(i, j - i)
                yield part.select(["a", "b"]).filter(pa.array(similar(part)))
                i = j

    return run


def _exploded(size: int):
    """id, text -> id, shingle for every distinct shingle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            for at, texts in _chunks(batch.column("text").to_pylist()):
                values, bounds = words.shingles(texts, size)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids[at:at + len(texts)], np.diff(bounds))), pa.array(values.view(np.int64))],
                                                 names=["id", "shingle"])

    return run


def _parities(size: int):
    """id, text -> id, parity: whether an odd number of shingles falls into each cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in _chunks(batch.column("text").to_pylist()):
                values, bounds = words.shingles(texts, size)
                cell = (values >> np.uint64(17) & np.uint64(CELLS - 1)).astype(np.int64)
                odd = np.bincount(np.repeat(np.arange(len(texts)), np.diff(bounds)) * CELLS + cell, minlength=len(texts) * CELLS) & 1
                bits = np.packbits(odd.astype(np.uint8)).view(np.int64)
                width = CELLS // 64
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(at, len(texts)), pa.ListArray.from_arrays(pa.array(np.arange(0, len(bits) + 1, width), pa.int32()), pa.array(bits))],
                    names=["id", "parity"])

    return run


def _stored(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Cut lineage with a table in the shared scratch folder."""
    path = path or scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): the smallest node of its component.

    Every round hooks each root to its smallest neighbour, shortens the chains
    by pointer jumping, and keeps only links between different roots; the number
    of rounds grows with the logarithm of the number of links.
    """
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct()
    labels = _stored(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("root")), "cc-labels")
    edges = both
    while True:
        # Chains of pointers end when a jump changes nothing.
        while True:
            up = labels.select(F.col("node").alias("__at"), F.col("root").alias("__up"))
            jumped = _stored(labels.join(up, labels["root"] == up["__at"])
                             .select("node", F.col("__up").alias("root"), (F.col("__up") != F.col("root")).alias("moved")), "cc-jump")
            labels = jumped.select("node", "root")
            if jumped.filter("moved").isEmpty():
                break
        left = labels.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        right = labels.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = _stored(edges.join(left, "a").join(right, "b").filter("ra != rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "cc-edges")
        hooks = edges.groupBy("a").agg(F.min("b").alias("b")).filter("b < a")
        if hooks.isEmpty():
            return labels
        hooked = hooks.select(F.col("a").alias("__at"), F.col("b").alias("__up"))
        labels = _stored(labels.join(hooked, labels["node"] == hooked["__at"], "left")
                         .select("node", F.coalesce("__up", "root").alias("root")), "cc-hook")


def _name_groups(base: DataFrame, signed: DataFrame, path: str, size: int, percent: int) -> None:
    """Write (__node, component_id) of all nodes of ``signed``; ``base`` has the texts."""
    nodes = _stored(signed.filter("n_shingles > 0").groupBy("node")
                    .agg(F.min(F.struct("doc_id", "text_key")).alias("rep"), F.min("doc_id").alias("least_id"),
                         F.first("n_shingles").alias("n"), F.first("buckets").alias("buckets")), "nodes")
    entries = nodes.select("node", "n", F.explode("buckets").alias("bucket"))
    shared = (entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("members"), F.min(F.struct("node", "n")).alias("leader"))
              .filter("members > 1").select("bucket", "leader"))
    entries = _stored(entries.join(shared, "bucket"), "entries")

    def fits(a: Column, b: Column) -> Column:
        return F.least(a, b) * 100 >= F.greatest(a, b) * percent

    stars = entries.filter("node != leader.node").filter(fits(F.col("n"), F.col("leader.n")))
    stars = _stored(stars.select(F.col("leader.node").alias("a"), F.col("node").alias("b")).distinct(), "stars")
    candidates = entries.select("node").distinct()
    reps = nodes.join(candidates, "node").select("node", "rep.doc_id", "rep.text_key")
    same = base["doc_id"].eqNullSafe(reps["doc_id"]) & (base["text_key"] == reps["text_key"])
    texts = _stored(base.join(reps, same).select("node", base["text"]).mapInArrow(worker.task("near_dedup", _own_node(size)), "node binary, text string")
                    .dropDuplicates(["node"]), "node-texts")

    def verified(pairs: DataFrame) -> DataFrame:
        a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
        b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
        return pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b").mapInArrow(worker.task("near_dedup", _linked(size, percent)), "a binary, b binary")

    def apart(pairs: DataFrame, groups: DataFrame) -> DataFrame:
        """Pairs whose nodes are in different groups."""
        for side in "ab":
            own = groups.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))
            pairs = pairs.join(own, side, "left").withColumn(f"root_{side}", F.coalesce(f"root_{side}", side))
        return pairs.filter("root_a != root_b").select("a", "b")

    def unsettled(members: DataFrame) -> DataFrame:
        """(bucket, node, n, root, ...) rows of buckets with several groups, and the bucket's least n."""
        mixed = (members.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.min("n").alias("least"))
                 .filter("lo != hi").select("bucket", "least"))
        return members.join(mixed, "bucket")

    def can_be_similar(n_a: Column, s_a: Column, n_b: Column, s_b: Column) -> Column:
        most = F.least(s_a, s_b)
        return most * 100 >= (n_a + n_b - most) * percent

    def grouped(groups: DataFrame) -> DataFrame:
        return entries.select("bucket", "node", "n").join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))

    def prefixes(members: DataFrame) -> DataFrame:
        """(id, shingle, place, n, root): the rarest shingles of each set with their
        place, as many as a similar one can't lack all of, without those that no
        other member has.

        In any fixed order of shingles, two sets of which the larger has n and the
        common part at least ``percent`` of n, share one of their first
        n - ceil(n * percent / 100) + 1; rarest first makes that choose few.
        """
        held = texts.join(members.select("node", "id"), "node").select("id", "text").mapInArrow(worker.task("near_dedup", _exploded(size)), "id long, shingle long")
        held = _stored(held, "open-shingles")
        common = held.groupBy("shingle").agg(F.count(F.lit(1)).alias("holders")).filter("holders > 1")
        own = Window.partitionBy("id")
        ranked = held.join(common, "shingle").withColumn("shared", F.count(F.lit(1)).over(own)).withColumn("rank", F.row_number().over(own.orderBy("holders", "shingle")))
        placed = ranked.join(members.select("id", "n", "root"), "id").withColumn("place", F.col("n") - F.col("shared") + F.col("rank"))
        return (placed.filter(F.col("place") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)
                .select("id", "shingle", "rank", "place", "n", "root"))

    def can_meet_here(n_a: Column, place_a: Column, n_b: Column, place_b: Column) -> Column:
        """Whether sets whose first common shingle has these places can be similar enough."""
        most = F.least(n_a - place_a, n_b - place_b) + 1
        return most * (100 + percent) >= (n_a + n_b) * percent

    def first_meeting(lead_a: Column, lead_b: Column, shingle: Column) -> Column:
        """Whether no rarer shingle of those that both list is common, so that a pair is made once."""
        met = F.get(F.array_intersect(lead_a, lead_b), F.lit(0))
        return met.isNull() | (met == shingle)

    first = stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    links = _stored(verified(first), "links-1")
    groups = components(links)

    opened = _stored(unsettled(grouped(groups)).select("node", "n").distinct().withColumn("id", F.monotonically_increasing_id()), "opened")
    shingles = texts.join(opened, "node").select("id", "text").mapInArrow(worker.task("near_dedup", _exploded(size)), "id long, shingle long")
    alone = (shingles.groupBy("shingle").agg(F.count(F.lit(1)).alias("holders"), F.min("id").alias("id")).filter("holders = 1")
             .groupBy("id").agg(F.count(F.lit(1)).alias("alone")))
    parities = texts.join(opened, "node").select("id", "text").mapInArrow(worker.task("near_dedup", _parities(size)), "id long, parity array<long>")
    shares = _stored(opened.join(alone, "id", "left").join(parities, "id")
                     .select("node", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("s"), "parity"), "shares")

    def differ_little(n_a: Column, parity_a: Column, n_b: Column, parity_b: Column) -> Column:
        cells = F.aggregate(F.zip_with(parity_a, parity_b, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda p, q: p + q)
        return cells * (100 + percent) <= (n_a + n_b) * (100 - percent)

    second = apart(stars.join(first, ["a", "b"], "left_anti"), groups)
    for side in "ab":
        second = second.join(shares.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("n", "s", "parity")]), side)
    second = second.filter(can_be_similar(F.col("n_a"), F.col("s_a"), F.col("n_b"), F.col("s_b")))
    second = second.filter(differ_little(F.col("n_a"), F.col("parity_a"), F.col("n_b"), F.col("parity_b"))).select("a", "b")
    links = links.union(_stored(verified(second), "links-2"))
    groups = components(links)

    open_ = unsettled(grouped(groups)).join(shares.select("node", "s", "parity"), "node")
    # The smallest partner a node could have in its bucket decides if it has any.
    partner = F.greatest("least", F.ceil(F.col("n") * percent / 100))
    open_ = open_.filter(can_be_similar(F.col("n"), F.col("s"), partner, F.col("s"))).drop("least")
    open_ = _stored(unsettled(_stored(open_, "open-members")), "open-buckets")
    members = _stored(open_.select("node", "n", "s", "root", "parity").distinct().withColumn("id", F.monotonically_increasing_id()), "open-nodes")
    keys = _stored(prefixes(members), "open-prefixes")
    split = keys.groupBy("shingle").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo != hi").select("shingle")
    # Similar sets have sizes of one class or of neighbouring ones.
    size_class = F.floor(F.log(F.col("n")) / math.log(100 / percent) + 1e-9) if percent < 100 else F.col("n")
    leads = keys.filter(F.col("rank") <= _LEADS).groupBy("id").agg(F.sort_array(F.collect_list(F.struct("rank", "shingle"))).alias("lead"))
    members = members.drop("n", "root").join(leads.select("id", F.col("lead.shingle").alias("lead")), "id")
    sided = keys.join(split, "shingle").join(members, "id").withColumn("size", size_class)
    x, y = (sided.select(F.col("shingle").alias(f"shingle_{side}"), F.col("node").alias(side), F.col("size").alias(f"size_{side}"),
                         *[F.col(c).alias(f"{c}_{side}") for c in ("n", "s", "root", "parity", "place", "lead")]) for side in "ab")
    y = y.withColumn("size_b", F.explode(F.array(*[F.col("size_b") + d for d in ((-1, 0, 1) if percent < 100 else (0,))])))
    rest = x.join(y, (x["shingle_a"] == y["shingle_b"]) & (x["size_a"] == y["size_b"]) & (x["a"] < y["b"]) & (F.col("root_a") != F.col("root_b"))
                  & can_meet_here(F.col("n_a"), F.col("place_a"), F.col("n_b"), F.col("place_b"))
                  & can_be_similar(F.col("n_a"), F.col("s_a"), F.col("n_b"), F.col("s_b"))
                  & differ_little(F.col("n_a"), F.col("parity_a"), F.col("n_b"), F.col("parity_b"))
                  & first_meeting(F.col("lead_a"), F.col("lead_b"), F.col("shingle_a")))
    rest = rest.select("a", "b").distinct().join(stars, ["a", "b"], "left_anti")
    third = _stored(verified(rest), "links-3")
    if not third.isEmpty():
        groups = components(links.union(third))

    named = nodes.select("node", "least_id").join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named.join(ids, "root").select(F.col("node").alias("__node"), "component_id").write.parquet(path)


def near_groups(docs: DataFrame, size: int = WORDS, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text).

    ``text_key`` is ``xxhash64(text)``; with doc_id it tells rows that share an id apart.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), F.col("text"))
    signed = _stored(base.mapInArrow(worker.task("near_dedup", _signed(size, bands, rows)), "doc_id long, text_key long, n_shingles long, node binary, buckets array<long>"), "signed")
    spark = docs.sparkSession
    path = scratch_path(spark, "named")
    with scratch_scope(spark):  # what is made on the way goes once the groups are stored
        _name_groups(base, signed, path, size, percent)
    named = spark.read.parquet(path)
    out = signed.select("doc_id", "text_key", "n_shingles", "node")
    out = out.join(named, (out["node"] == named["__node"]) & (out["n_shingles"] > 0), "left")
    out = out.withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    return out.select("doc_id", "text_key", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` without rows whose group has a smaller doc_id; all columns stay."""
    gone = near_groups(docs, size, percent).filter(~F.col("kept")).select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct()
    gone = _stored(gone, "near-duplicates")
    same = docs["doc_id"].eqNullSafe(F.col("__id")) & (F.xxhash64(docs["text"]) == F.col("__key"))
    return docs.join(gone, same, "left_anti")
