"""Change feeds: stamped base load (K2), change batches (K3), the feed.

No wall clock and no ``rand()``: every batch is a pure function of the source
rows, the batch number and a seed, so a feed rebuilt after a failure is the
same feed. The load timestamp of batch ``b`` is ``epoch + b x 10 minutes``.

Two samplers exist, both distributed:
* ``feed_batch`` picks a fixed fraction of keys per batch by a multiplicative
  selector (three in ten keys), so a batch grows with the source;
* ``change_batch`` picks exactly ``n`` rows, the top ``n`` by a seeded
  multiplicative hash (a distributed top-k, ``TakeOrderedAndProject``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimsmith.functions.temporal import BATCH_MINUTES, FEED_EPOCH, load_ts
from dimsmith.sources.model import MONEY

# Fixed values of the fixture feed: base-load modulus, selector and
# perturbation constants (multipliers, modulus, offset) and phone format.
BASE_MODULUS = 4
SELECT_MULT, SELECT_BATCH_MULT, SELECT_MOD, SELECT_BELOW = 7919, 104729, 10, 3
PERTURB_EVERY = 3
DELTA_MULT, DELTA_BATCH_MULT, DELTA_MOD, DELTA_OFFSET = 31, 17, 18447, 9223
# Sampler: Lehmer (Park-Miller) steps modulo the prime 2^31 - 1; every product
# stays below 2^47, so no key size can overflow a 64-bit integer.
SAMPLE_MULT, SAMPLE_SEED_MULT, SAMPLE_MOD = 48271, 40503, 2147483647


def base_load(source: DataFrame, key: str = "customer_id", modulus: int = BASE_MODULUS,
              batch: int = 0) -> DataFrame:
    """One quarter of the keys, stamped with the load time of ``batch``."""
    return (source.where(F.col(key) % modulus == 0)
            .withColumn("__ldts", load_ts(batch)))


def balance_delta(key: Column, batch: Column | int) -> Column:
    """A reproducible stand-in for a random amount in about +-92.23."""
    # (key mod m) first: same value for non-negative keys, no overflow for any key
    cents = ((key % DELTA_MOD) * DELTA_MULT + F.lit(batch) * DELTA_BATCH_MULT) % DELTA_MOD - DELTA_OFFSET
    return (cents.cast(MONEY) / F.lit(100)).cast(MONEY)


def _changes(batch: Column, key: Column, alternate: bool, phone_on_odd: bool) -> dict[str, Column]:
    hit = key % PERTURB_EVERY == 0
    if alternate:
        hit = hit & ((key + batch) % 2 == 0)
    cols = {"account_balance_usd": F.when(
        hit, (F.col("account_balance_usd") + balance_delta(key, batch)).cast(MONEY)
    ).otherwise(F.col("account_balance_usd"))}
    if phone_on_odd:
        cols["phone"] = F.when(batch % 2 == 1, F.concat(F.lit("20-"), key.cast("string"), F.lit("-"),
                                                        batch.cast("string"))).otherwise(F.col("phone"))
    return cols


def perturb(df: DataFrame, batch: int, key: str = "customer_id",
            alternate: bool = True, phone_on_odd: bool = True) -> DataFrame:
    """Change every third key's balance (on alternating visits if ``alternate``),
    and the phone in odd batches (a Type-1 change)."""
    return df.withColumns(_changes(F.lit(batch), F.col(key), alternate, phone_on_odd))


def _selected(key: Column, batch: Column) -> Column:
    return ((key % SELECT_MOD) * SELECT_MULT + batch * SELECT_BATCH_MULT) % SELECT_MOD < SELECT_BELOW


def feed_batch(source: DataFrame, batch: int, key: str = "customer_id") -> DataFrame:
    """Fixture change batch ``batch`` >= 1: three in ten keys, perturbed."""
    picked = source.where(_selected(F.col(key), F.lit(batch)))
    return perturb(picked, batch, key).withColumn("__ldts", load_ts(batch))


def change_feed(source: DataFrame, batches: int = 4, key: str = "customer_id") -> DataFrame:
    """Base load plus ``batches`` change batches (the appended feed, S6/U1).

    One scan of the source: each row fans out over the batch numbers, keeps
    the batches that select it, and takes that batch's changes (no shuffle)."""
    b, k = F.col("__b"), F.col(key)
    fanned = source.select("*", F.explode(F.sequence(F.lit(0), F.lit(batches))).alias("__b"))
    picked = fanned.where(F.when(b == 0, k % BASE_MODULUS == 0).otherwise(_selected(k, b)))
    changed = picked.withColumns({
        c: F.when(b == 0, F.col(c)).otherwise(v) for c, v in _changes(b, k, True, True).items()})
    stamp = F.lit(FEED_EPOCH).cast("timestamp_ntz") + F.make_dt_interval(mins=b * BATCH_MINUTES)
    return changed.withColumn("__ldts", stamp).drop("__b")


def sample_key(key: Column, seed: int) -> Column:
    """Seeded pseudo-random order of keys, exact integer arithmetic."""
    h = ((key % SAMPLE_MOD) * SAMPLE_MULT) % SAMPLE_MOD
    return ((h + seed * SAMPLE_SEED_MULT) * SAMPLE_MULT) % SAMPLE_MOD


def periodic_order(key: Column, batch: int, seed: int = 0) -> Column:
    """Another pseudo-random order of keys for each batch: a multiplier of its own.

    A run of the periodic load so samples anew, yet the same run repeated
    samples the same keys. Exact integer arithmetic, no overflow."""
    return ((key % SAMPLE_MOD) * F.lit(periodic_multiplier(batch, seed))) % SAMPLE_MOD


def periodic_multiplier(batch: int, seed: int = 0) -> int:
    return pow(SAMPLE_MULT, 2 * batch + 1 + 7 * seed, SAMPLE_MOD)


def periodic_batch(source: DataFrame, batch: int, n: int = 1000, seed: int = 0,
                   key: str = "customer_id") -> DataFrame:
    """Change batch number ``batch`` of the periodic load: a fresh sample of ``n`` rows."""
    return change_batch(source, batch, n, seed, key, order=periodic_order(F.col(key), batch, seed))


def change_batch(source: DataFrame, batch: int, n: int = 1000, seed: int = 0,
                 key: str = "customer_id", order: Column | None = None) -> DataFrame:
    """Fixed-size sample (top ``n`` by seeded hash) with every third key's
    balance changed, stamped with the load time of ``batch``.

    ``n`` is the sampler's size, so the limit is the feature; the ordering is a
    distributed top-k (each task keeps ``n`` rows, one final merge)."""
    k = F.col(key)
    picked = source.orderBy(sample_key(k, seed) if order is None else order, k).limit(n)
    return (perturb(picked, batch, key, alternate=False, phone_on_odd=False)
            .withColumn("__ldts", load_ts(batch)))
