"""Aggregates by event period that late records correct until the period closes.

The store holds mergeable partial aggregates, one row for each period, group
and arrival batch. It is combined when read, or merged step by step; both
give the same totals in any order, since sums and counts commute. A record
that arrives after its period has closed is refused: it is kept in a partial
of its own that totals leave out, so nothing is lost and refusals can be counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.skew import BROADCAST_BYTES, measured_bytes

DAY_MS = 86_400_000
ON_TIME, LATE, TOO_LATE = "on_time", "late", "too_late"


def arrival(period_end_ms: Column, arrived_ms: Column, allowed_ms: int) -> Column:
    """``on_time`` before the end of the period, ``late`` from then on, ``too_late`` from ``allowed_ms`` after it; null if either time is."""
    return (
        F.when(arrived_ms >= period_end_ms + F.lit(allowed_ms), F.lit(TOO_LATE))
        .when(arrived_ms >= period_end_ms, F.lit(LATE))
        .when(arrived_ms < period_end_ms, F.lit(ON_TIME))
    )


def admit(records: DataFrame, period: str, arrived_ms: str, allowed_hours: int = 72, batch_ms: int = DAY_MS) -> DataFrame:
    """Adds ``lateness`` and ``arrival_batch`` to records of daily periods.

    period: a date column, whose day ends at 24:00 UTC. arrived_ms: epoch
    milliseconds. Records without a period or an arrival belong to no period;
    their lateness is null and :func:`partials` leaves them out.
    """
    end = (F.unix_date(F.col(period)).cast("bigint") + 1) * F.lit(DAY_MS)
    return records.withColumn("lateness", arrival(end, F.col(arrived_ms), allowed_hours * 3_600_000)).withColumn("arrival_batch", F.floor(F.col(arrived_ms) / F.lit(batch_ms)).cast("bigint"))


def placed(records: DataFrame, period: str, arrived_ms: str, batch_ms: int = DAY_MS) -> DataFrame:
    """Adds ``arrival_batch`` to the records that have a period and an arrival; others belong to no period and are left out."""
    known = records.filter(F.col(period).isNotNull() & F.col(arrived_ms).isNotNull())
    return known.withColumn("arrival_batch", F.floor(F.col(arrived_ms) / F.lit(batch_ms)).cast("bigint"))


def partials_of_batches(records: DataFrame, period: str, groups: Sequence[str], amount: str, allowed_hours: int = 72, batch_ms: int = DAY_MS) -> DataFrame:
    """The store's rows from :func:`placed` records: counts and sums of each period, group and arrival batch, and the batch's ``lateness``.

    Records aren't classified one by one: whether a batch comes in time, corrects its
    period or is refused by it is a matter of the two. So batches must not straddle
    the end of a period or its cut-off, or ValueError is raised. The result
    is that of :func:`partials`, in the same form.
    """
    allowed_ms = allowed_hours * 3_600_000
    if DAY_MS % batch_ms or allowed_ms % batch_ms:
        raise ValueError("arrival batches must divide the day and the hours allowed")
    end = (F.unix_date(F.col(period)).cast("bigint") + 1) * F.lit(DAY_MS)
    summed = records.groupBy(period, *groups, "arrival_batch").agg(F.count(F.lit(1)).alias("n"), F.sum(amount).cast("decimal(38,2)").alias("amount"))
    lateness = arrival(end, F.col("arrival_batch") * F.lit(batch_ms), allowed_ms)
    return summed.select(period, *groups, "arrival_batch", lateness.alias("lateness"), "n", "amount")


def records_of(store: DataFrame, records: DataFrame, period: str, groups: Sequence[str]) -> DataFrame:
    """The :func:`placed` records behind the store's partials, with their ``lateness``.

    A partial is looked up by period, group and arrival batch, null groups too. The
    store has a row for each of them however many records there are, and
    is broadcast if it is measured to be small; else both are shuffled by all three.
    """
    keys = [period, *groups, "arrival_batch"]
    asked = store.select(*[F.col(k).alias(f"__{k}") for k in keys], "lateness")
    if measured_bytes(asked) <= BROADCAST_BYTES:
        asked = F.broadcast(asked)
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return records.join(asked, same).select(*records.columns, "lateness")


def partials(admitted: DataFrame, groups: Sequence[str], amount: str) -> DataFrame:
    """The store's rows: counts and sums of each group, arrival batch and lateness.

    Null amounts count as records and add nothing. The aggregation combines
    before its shuffle, so a group with most of the records costs no more.
    """
    known = admitted.filter(F.col("lateness").isNotNull())
    return known.groupBy(*groups, "arrival_batch", "lateness").agg(F.count(F.lit(1)).alias("n"), F.sum(amount).cast("decimal(38,2)").alias("amount"))


def merge(*stores: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Stores of different arrivals as one, partial by partial."""
    one = stores[0]
    for more in stores[1:]:
        one = one.unionByName(more)
    return one.groupBy(*groups, "arrival_batch", "lateness").agg(F.sum("n").alias("n"), F.sum("amount").cast("decimal(38,2)").alias("amount"))


def combine(store: DataFrame, groups: Sequence[str], as_of_batch: int | None = None) -> DataFrame:
    """Totals of each group from its partials, as known after ``as_of_batch`` (all, if None).

    ``n`` and ``amount`` hold on-time and late records; ``late_n`` and
    ``late_amount`` the part by which late ones corrected them; ``refused_n``
    and ``refused_amount`` what came after the period closed.
    """
    if as_of_batch is not None:
        store = store.filter(F.col("arrival_batch") <= as_of_batch)
    def of(column: str, *kinds: str) -> Column:
        return F.sum(F.when(F.col("lateness").isin(*kinds), F.col(column)))
    zero = F.lit(0).cast("decimal(38,2)")
    return store.groupBy(*groups).agg(
        F.coalesce(of("n", ON_TIME, LATE), F.lit(0)).alias("n"),
        F.coalesce(of("amount", ON_TIME, LATE), zero).cast("decimal(38,2)").alias("amount"),
        F.coalesce(of("n", LATE), F.lit(0)).alias("late_n"),
        F.coalesce(of("amount", LATE), zero).cast("decimal(38,2)").alias("late_amount"),
        F.coalesce(of("n", TOO_LATE), F.lit(0)).alias("refused_n"),
        F.coalesce(of("amount", TOO_LATE), zero).cast("decimal(38,2)").alias("refused_amount"),
    )
