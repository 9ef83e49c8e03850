"""Exact top-k search of binary codes by incremental multi-index hashing.

A code of b bits is cut into m segments (about log2 of the number of codes each)
and entered once per segment under the segment's value. A query looks up values
at segment distance 0, then 1, 2 ... Once segments 0 to ``j`` have been searched
at radius ``s`` and the others at ``s - 1``, every code at Hamming distance up to
``m * s + j`` has been met, by the pigeonhole principle, so a query is finished
once its k-th verified distance is within that; the rounds end when all are. Each
round is one equi-join of the unfinished queries' probes with the index, verified
on whole codes, with the k best kept per query. A round that would make more
probes a query than there are codes is not made: the queries that are left are
held against all codes, in blocks, which is exact and less work.

Equal codes are one entry with their k + 1 smallest ids, and equal queries are
searched once, so copies never multiply. A code is only taken at the segment
and radius that meet it first, so nothing is verified twice.

Defined results: rows with a null id or vector are neither found nor asked; a
missing or null component is a 0 bit, as is one that isn't positive; repeated
(id, code) rows count once; a query is never its own neighbour; ties in
distance go to the smaller id; with fewer than k others all are returned; an
empty table gives an empty result; texts, however long, play no part, and further
columns are not read.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.session import scratch_path, scratch_scope

ROUND_PROBES = 1000  # probes a segment up to which all segments share a round
SCAN_BLOCK = 2000    # queries that are held against all codes at once


def sign_words(vector: Column, bits: int) -> Column:
    """array<long>: bit i of the code is set if component i is positive."""
    def word(w: int) -> Column:
        part = F.transform(F.slice(vector, 64 * w + 1, 64),
                           lambda x, i: F.when((x > 0) & ~F.isnan(x), F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
        return F.aggregate(part, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))

    return F.array(*[word(w) for w in range(max(1, -(-bits // 64)))])


def segments(bits: int, codes: int) -> list[tuple[int, int]]:
    """(first bit, end) of segments of about log2(codes) bits, at most 30."""
    width = min(30, max(1, round(math.log2(max(2, codes)))))
    m = max(1, -(-bits // width))
    cuts = [round(i * bits / m) for i in range(m + 1)]
    return list(zip(cuts, cuts[1:]))


def segment_value(words: Column, lo: int, hi: int) -> Column:
    out, at = F.lit(0).cast("long"), lo
    while at < hi:
        w, bit = divmod(at, 64)
        n = min(hi - at, 64 - bit)
        piece = F.shiftrightunsigned(words[w], bit)
        if n < 64:
            piece = piece.bitwiseAND(F.lit((1 << n) - 1))
        out = out.bitwiseOR(F.shiftleft(piece, at - lo))
        at += n
    return out


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _probes(asked: DataFrame, segment: int, width: int, radius: int) -> DataFrame:
    """(code, values, segment, value): the segment's value with every choice of
    ``radius`` bits turned, chosen one after the other from low to high on the executors."""
    out = asked.select("code", "values", F.lit(segment).alias("segment"), F.col("values")[segment].alias("value"), F.lit(-1).alias("last"))
    for i in range(radius):
        out = out.select("code", "values", "segment", "value", F.explode(F.sequence(F.col("last") + 1, F.lit(width - radius + i))).alias("last"))
        out = out.withColumn("value", F.col("value").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("last"))))
    return out.select("code", "values", "segment", "value")


def _scanned(active: DataFrame, entries: DataFrame, k: int) -> DataFrame:
    """(code, distance, neighbor_id) of the k + 1 nearest of each query, held
    against all codes, ``SCAN_BLOCK`` queries at a time."""
    spark = active.sparkSession
    blocks = max(1, -(-active.count() // SCAN_BLOCK))
    order = Window.partitionBy("code").orderBy("distance", "neighbor_id")
    numbered = _stored(active.select("code", F.pmod(F.xxhash64("code"), F.lit(blocks)).alias("block")), "scan-queries")
    paths = []
    for block in range(blocks):
        own = F.broadcast(numbered.filter(F.col("block") == block).select("code"))  # about SCAN_BLOCK codes
        apart = F.aggregate(F.zip_with("code", "found", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda a, b: a + b)
        pairs = entries.select(F.col("code").alias("found"), "ids").join(own).select("code", apart.alias("distance"), F.explode("ids").alias("neighbor_id"))
        paths.append(scratch_path(spark, "scanned"))
        pairs.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= k + 1).write.parquet(paths[-1])
    return spark.read.parquet(*paths)


def _steps(parts: list[tuple[int, int]]) -> list[tuple[int, list[int]]]:
    """(radius, segments) in the order of the search. A radius with few probes is
    one round; one with many goes segment by segment, as queries end in between."""
    out = []
    for radius in range(max(hi - lo for lo, hi in parts) + 1):
        everyone = list(range(len(parts)))
        many = max(math.comb(hi - lo, radius) for lo, hi in parts) > ROUND_PROBES
        out += [(radius, [j]) for j in everyone] if many else [(radius, everyone)]
    return out


def top_k(codes: DataFrame, queries: DataFrame, bits: int, k: int = 10) -> DataFrame:
    """query_id, rank (from 1), neighbor_id, distance; both inputs are (id, code),
    code an array of 64-bit words."""
    spark = codes.sparkSession
    path = scratch_path(spark, "top-k")
    with scratch_scope(spark):  # what is made on the way goes once the result is stored
        _search(codes, queries, bits, k).write.parquet(path)
    return spark.read.parquet(path)


def _search(codes: DataFrame, queries: DataFrame, bits: int, k: int) -> DataFrame:
    spark = codes.sparkSession
    known = codes.filter(F.col("id").isNotNull() & F.col("code").isNotNull()).select("id", "code").distinct()
    first = Window.partitionBy("code").orderBy("id")
    entries = _stored(known.withColumn("at", F.row_number().over(first)).filter(F.col("at") <= k + 1)
                      .groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "codes")
    n = entries.count()
    parts = segments(bits, n)

    def values(code: Column) -> Column:
        return F.array(*[segment_value(code, lo, hi) for lo, hi in parts])

    index = _stored(entries.select(F.col("code").alias("found"), "ids", values(F.col("code")).alias("found_values"))
                    .select("found", "ids", "found_values", F.posexplode("found_values").alias("segment", "value")), "code-index")
    asked = _stored(queries.filter(F.col("id").isNotNull() & F.col("code").isNotNull()).select("id", "code").distinct(), "queries")
    active = _stored(asked.select("code").distinct().withColumn("values", values(F.col("code"))), "active")
    # The distance of each segment; the earliest segment among the nearest meets the code.
    apart = F.zip_with("values", "found_values", lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    best = None
    for radius, chosen in _steps(parts):
        fitting = [(j, parts[j][1] - parts[j][0]) for j in chosen if radius <= parts[j][1] - parts[j][0]]
        if not fitting:
            continue
        if sum(math.comb(width, radius) for _, width in fitting) > n:  # comparing with all codes is less work
            scanned = _scanned(active, entries, k).select("code", "distance", "neighbor_id")
            ended = best.join(active.select("code"), "code", "left_anti").select("code", "distance", "neighbor_id") if best is not None else None
            best = scanned if ended is None else ended.union(scanned)
            break
        # A query makes many probes: spread them before, and shuffle them - Spark
        # would judge their number by the few queries and broadcast them.
        spread = active.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "code")
        probes = reduce(DataFrame.union, [_probes(spread, j, width, radius) for j, width in fitting])
        met = probes.hint("merge").join(index, ["segment", "value"]).withColumn("apart", apart)
        met = met.filter((F.array_min("apart") == radius) & (F.array_position("apart", radius) == F.col("segment") + 1))
        met = met.select("code", F.aggregate("apart", F.lit(0), lambda a, b: a + b).alias("distance"), F.explode("ids").alias("neighbor_id"))
        met = met if best is None else met.union(best.select("code", "distance", "neighbor_id"))
        order = Window.partitionBy("code").orderBy("distance", "neighbor_id")
        best = _stored(met.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= k + 1), "best")
        covered = len(parts) * radius + chosen[-1]
        done = (best.filter((F.col("at") == k + 1) & (F.col("distance") <= covered)).select("code"))
        active = _stored(active.join(done, "code", "left_anti"), "active")
        if active.isEmpty():
            break
    named = asked.withColumnRenamed("id", "query_id").join(best, "code").filter("neighbor_id != query_id")
    order = Window.partitionBy("query_id").orderBy("distance", "neighbor_id")
    return (named.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "neighbor_id", "distance"))


def sign_codes(vectors: DataFrame, id_column: str, vector: str) -> tuple[DataFrame, int]:
    """((id, code) of the vectors' signs, number of bits)."""
    bits = vectors.agg(F.max(F.size(vector))).first()[0]
    bits = max(1, bits or 1)
    return vectors.select(F.col(id_column).cast("long").alias("id"), F.when(F.col(vector).isNotNull(), sign_words(F.col(vector), bits)).alias("code")), bits
