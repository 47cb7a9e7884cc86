"""Loyalty mart maintained by order batches.

Order totals are kept by customer in a ``BucketedTable``; a batch adds its sums
to the customers it names and rewrites their buckets only. The ranking needs the
customers with the highest totals, so each bucket also keeps its *candidates*:
eligible customers whose total is at least ``floor``. The floor is the total of
rank ``SLACK`` times the last rank, so candidates are few, and the ranking reads
them alone.

Totals that fall (cancelled orders) can take customers below the floor. When
fewer distinct totals than ranks are left among the candidates, the floor is
taken anew from all totals; when there are far more than needed, it is raised.
Either way the candidates are written again from the totals: the exact way for
all cases that the bound leaves out. A customer without a total (all amounts
NULL) ranks first, as in the full ranking, and is always a candidate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimsmith.functions.keysets import semi_join
from dimsmith.operators.loyalty import EXCLUDED_LOCATION, MIN_BALANCE, TIERS, rank_totals
from dimsmith.sources.bucketed import BucketedTable

TOTALS, CANDIDATES, FLOOR = "totals", "candidates", "floor"
SLACK = 2
MONEY_SUM = "decimal(38,2)"


def _last_rank(tiers) -> int:
    return max(hi for _, hi, _ in tiers)


def _above(floor: str | None) -> Column:
    at_least = F.lit(True) if floor is None else F.col("total").isNull() | (F.col("total") >= F.lit(floor).cast(MONEY_SUM))
    return (F.col("copies") > 0) & at_least


def _floor(totals: DataFrame, ranks: int) -> str | None:
    """The distinct total of that rank among eligible customers; None if there are fewer."""
    distinct = totals.where("copies > 0").select("total").distinct()
    ranked = distinct.withColumn("r", F.dense_rank().over(Window.orderBy(F.desc_nulls_first("total")))).where(F.col("r") <= ranks)
    row = ranked.where(F.col("r") == ranks).first()
    return None if row is None or row.total is None else str(row.total)


def apply_orders(spark: SparkSession, base: str, orders: DataFrame, customer: DataFrame, batch_id: int,
                 buckets: int | None = None, tiers: Sequence[tuple[int, int, str]] = TIERS,
                 exclude_location: int = EXCLUDED_LOCATION, min_balance: float = MIN_BALANCE) -> None:
    """Add one batch of orders (negative amounts take back). A repeated batch is left out.

    ``customer`` is looked at for the customers of the batch only; whether one is
    eligible counts from its next batch on.
    """
    table = BucketedTable(spark, base, "customer_id", buckets)
    done = table.pointer.streams.get("orders")
    if done is not None and done >= batch_id:
        return
    commit = table.begin()
    sums = (orders.groupBy("customer_id").agg(F.sum("total_price_usd").cast(MONEY_SUM).alias("amount"),
                                              F.count("total_price_usd").alias("amounts"))
            .where("customer_id IS NOT NULL").checkpoint(eager=True))  # one row a customer of the batch
    touched = table.buckets_of(sums)
    floor = table.pointer.notes.get(FLOOR)
    if touched:
        known = (semi_join(customer, sums, ["customer_id"])
                 .groupBy("customer_id").agg(F.count_if((F.col("account_balance_usd") > min_balance)
                                                        & (F.col("location_id") != exclude_location)).alias("copies")))
        new = sums.join(known, "customer_id", "left").select(
            "customer_id", "amount", "amounts", F.coalesce("copies", F.lit(0)).cast("bigint").alias("copies"), F.lit(True).alias("named"))
        held = table.read(TOTALS, touched)
        if held is not None:
            new = new.unionByName(held.select("customer_id", "amount", "amounts", "copies", F.lit(False).alias("named")))
        both = new.groupBy("customer_id").agg(F.sum("amount").cast(MONEY_SUM).alias("amount"), F.sum("amounts").alias("amounts"),
                                              F.max_by("copies", "named").alias("copies"))
        # A repeated customer counts its orders once a copy, as the join of the full ranking does.
        total = F.when(F.col("amounts") > 0, F.col("amount") * F.col("copies")).cast(MONEY_SUM)
        commit.rewrite(TOTALS, both.withColumn("total", total), touched)
        commit.rewrite(CANDIDATES, commit.written(TOTALS).where(_above(floor)).select("customer_id", "total", "copies"), touched)
    last = _last_rank(tiers)
    now = commit.all(CANDIDATES)
    n = 0 if now is None else now.select("total").distinct().count()
    if (n < last and floor is not None) or n > 2 * SLACK * last:
        totals = commit.all(TOTALS)
        floor = _floor(totals, SLACK * last)
        every = list(range(table.pointer.buckets))
        commit.note(FLOOR, floor).rewrite(CANDIDATES, totals.where(_above(floor)).select("customer_id", "total", "copies"), every)
    commit.stream("orders", batch_id).publish()


def ranking(spark: SparkSession, base: str, early_ids: Sequence[int] = (),
            tiers: Sequence[tuple[int, int, str]] = TIERS) -> DataFrame:
    """The loyalty table by now, from the candidates alone."""
    held = BucketedTable(spark, base, "customer_id").read(CANDIDATES)
    if held is None:
        held = spark.createDataFrame([], f"customer_id bigint, total {MONEY_SUM}")
    return rank_totals(held.select("customer_id", F.col("total").alias("total_price_usd")), early_ids, tiers)
