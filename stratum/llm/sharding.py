"""Sharding by jump consistent hashing (Lamping & Veach), DataFrame only.

``jump_buckets`` walks the jump sequence of a 64-bit key: a linear
congruential generator seeded with the key yields the shard counts at which
the key moves; the last one below the shard count is its shard. No ring or
table exists, and adding shard ``n`` moves exactly the keys whose next jump
is ``n``, all of them into ``n``.

``assign_shards`` adds ``shard``, ``grown_shard`` (one more shard) and a
gapless ``slot`` in every shard, ordered by the order columns.

Defined results: a null key is hashed as key 0; keys of any other type than an
integer go through ``xxhash64`` first; rows that tie on all order columns are
numbered in an arbitrary but gapless way (they are interchangeable); an empty
table gives an empty result; of a text, however long, only size and CRC leave
the scan; further columns pass through untouched, and
columns called ``shard``, ``grown_shard`` or ``slot`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.llm.numbering import number_within

# Multiplier of the generator, and the range of its draws.
LCG = 2862933555777941757
DRAWS = float(1 << 31)

_M16, _M32 = (1 << 16) - 1, (1 << 32) - 1
# Steps taken for every row before the (practically empty) rest is finished.
_FIRST_STEPS = 64


def _advance(hi: Column, lo: Column) -> tuple[Column, Column]:
    """key * LCG + 1 modulo 2**64 on 32-bit halves; every product stays
    below 2**63, so nothing overflows under ANSI."""
    c1, c0 = LCG >> 32, LCG & _M32
    c0h, c0l = c0 >> 16, c0 & _M16
    p = lo * F.lit(c0l) + F.lit(1)
    q = lo * F.lit(c0h) + F.shiftright(p, 16)
    new_lo = F.shiftleft(q.bitwiseAND(F.lit(_M16)), 16) + p.bitwiseAND(F.lit(_M16))
    cross = hi * F.lit(c0l) + F.shiftleft((hi * F.lit(c0h)).bitwiseAND(F.lit(_M16)), 16)
    new_hi = (F.shiftright(q, 16) + lo * F.lit(c1) + cross).bitwiseAND(F.lit(_M32))
    return new_hi, new_lo


def key64(key: Column, dtype: T.DataType) -> Column:
    """The 64-bit key that is hashed: integers as they are, all else by xxhash64."""
    whole = isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    return F.coalesce(key.cast("long") if whole else F.xxhash64(key), F.lit(0).cast("long"))


def jump_buckets(key: Column, shards: int) -> Column:
    """struct(b: shard among ``shards``, j: the next shard count minus one at
    which the key moves)."""
    if shards < 1:
        raise ValueError("shards must be at least 1")

    def step(s: Column, _: Column) -> Column:
        hi, lo = _advance(s["hi"], s["lo"])
        draw = F.shiftright(hi, 1) + F.lit(1)
        jump = F.floor((s["j"] + F.lit(1)) * (F.lit(DRAWS) / draw)).cast("long")
        return (F.when(s["j"] >= F.lit(shards), s)
                .otherwise(F.struct(hi.alias("hi"), lo.alias("lo"), s["j"].alias("b"), jump.alias("j"))))

    start = F.struct(F.shiftrightunsigned(key, 32).alias("hi"),
                     key.bitwiseAND(F.lit(_M32)).alias("lo"),
                     F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))
    # b grows with every step, so `shards` steps always end the walk; the
    # expected number is about ln(shards), and the rest is only run for keys
    # that still need it.
    state = F.aggregate(F.sequence(F.lit(1), F.lit(min(shards, _FIRST_STEPS))), start, step)
    if shards <= _FIRST_STEPS:
        return state
    rest = F.sequence(F.lit(1), F.lit(shards - _FIRST_STEPS))
    return F.aggregate(F.array(state), start, lambda _, s: F.when(s["j"] >= F.lit(shards), s)
                       .otherwise(F.aggregate(rest, s, step)))


def assign_shards(df: DataFrame, key: str, shards: int, order: list[str]) -> DataFrame:
    """``df`` with shard, grown_shard and slot. Pass narrow rows (see ``number_within``)."""
    df = df.drop("shard", "grown_shard", "slot")
    jump = jump_buckets(key64(F.col(key), df.schema[key].dataType), shards)
    grown = F.when(F.col("__jump.j") == shards, F.lit(shards)).otherwise(F.col("__jump.b"))
    placed = (df.withColumn("__jump", jump).withColumn("shard", F.col("__jump.b").cast("int"))
              .withColumn("grown_shard", grown.cast("int")).drop("__jump"))
    return number_within(placed, "shard", order, "slot")


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(body) + 1).cast("long").alias("size"),
                       F.crc32(body.cast("binary")).alias("text_crc32"))
    out = assign_shards(rows, "doc_id", shards, ["doc_id", "size", "text_crc32"])
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
