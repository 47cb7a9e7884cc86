"""Sets of keys as bitmaps, built by aggregates: exact ones of whole numbers, Bloom filters of any key.

An exact set has one bit a number, in bitmaps of 32,768 numbers; sets are united
and counted bitmap by bitmap, so what travels is a bit a number where keys lie
close together. A Bloom filter has one bitmap a block; a key's hash names the
block and four bits in it. A key whose bits are not all set is certainly not in
the set; one whose bits are may be, so an exact test follows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimsmith.functions.joins import BROADCAST_MAX_BYTES, broadcast_if_small

# Bits and bytes of one bitmap of the aggregates.
BITMAP_BITS, BITMAP_BYTES = 32_768, 4096
BITS_PER_KEY, PROBES = 12, 4


def bitmaps(df: DataFrame, number: str, by: Sequence[str] = ()) -> DataFrame:
    """(by.., bucket, bits): the numbers of ``df`` as bitmaps, sorted and packed inside each task first."""
    n = F.col(number)
    return df.where(n.isNotNull()).groupBy(*by, F.bitmap_bucket_number(n).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(n)).alias("bits"))


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(F.lit("bloom"), *keys)


def _places(h: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(h, F.lit(k)), F.lit(BITMAP_BITS)) for k in range(PROBES)]


def bloom_filter(rows: DataFrame, keys: Sequence[str], n_keys: int) -> tuple[DataFrame, int]:
    """((block, bits) of a filter for about ``n_keys`` distinct keys, number of blocks)."""
    blocks = max(1, -(-n_keys * BITS_PER_KEY // BITMAP_BITS))
    hashed = rows.select(_hash(keys).alias("h"))
    bits = hashed.select(F.pmod("h", F.lit(blocks)).alias("block"), F.explode(F.array(*_places(F.col("h")))).alias("place"))
    return bits.groupBy("block").agg(F.bitmap_construct_agg("place").alias("bits")), blocks


def _set(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (place % 8).cast("int")) == 1


def may_hold(df: DataFrame, keys: Sequence[str], filter_: DataFrame, blocks: int) -> DataFrame:
    """Rows of ``df`` whose key may be in the set; the filter (at most 4 KB a block) is broadcast."""
    h = _hash(keys)
    named = filter_.select(F.col("block").alias("__block"), F.col("bits").alias("__bits"))
    met = df.join(F.broadcast(named), F.pmod(h, F.lit(blocks)) == F.col("__block"))
    hit = _set(F.col("__bits"), _places(h)[0])
    for place in _places(h)[1:]:
        hit = hit & _set(F.col("__bits"), place)
    return met.where(hit).drop("__block", "__bits")


def semi_join(df: DataFrame, rows: DataFrame, keys: Sequence[str], max_bytes: int | None = BROADCAST_MAX_BYTES) -> DataFrame:
    """Rows of a large ``df`` whose key is among those of ``rows``.

    Up to ``max_bytes`` the keys themselves are broadcast. Beyond that a Bloom
    filter of them is, sized by a sketch of their distinct count, and only the
    rows that pass it are shuffled to the exact join. A filter that would itself
    be larger than ``max_bytes`` is left out. ``None`` leaves all to the planner.
    """
    keys = list(keys)
    wanted = rows.select(*keys)
    if max_bytes is not None:
        small = broadcast_if_small(wanted, max_bytes)
        if small is not wanted:
            return df.join(small, keys, "left_semi")
        n = wanted.agg(F.approx_count_distinct(F.struct(*keys)).alias("n")).first()[0]
        if n * BITS_PER_KEY / 8 + BITMAP_BYTES <= max_bytes:
            df = may_hold(df, keys, *bloom_filter(wanted, keys, n)).select(*df.columns)
    return df.join(wanted, keys, "left_semi")
