"""Rows that found no partner yet: kept, tried again with growing waits, given up after a number of tries.

States, waits and the number of tries are parameters; the clock is an ``as_of`` column,
so every result can be repeated.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

PENDING, RESOLVED, FAILED = "PENDING", "RESOLVED", "FAILED"


def wait_minutes(tries: Column, schedule: Sequence[int]) -> Column:
    """Minutes to wait after ``tries`` tries; the last entry holds on."""
    return F.get(F.array(*[F.lit(m) for m in schedule]), F.least(tries, F.lit(len(schedule) - 1)))


def next_try(as_of: Column, tries: Column, schedule: Sequence[int]) -> Column:
    return as_of + F.make_interval(mins=wait_minutes(tries, schedule))


def pend(misses: DataFrame, as_of: Column, schedule: Sequence[int]) -> DataFrame:
    """New entries for rows without a partner: no tries yet, the first due after the first wait."""
    return misses.withColumns({"status": F.lit(PENDING), "retry_count": F.lit(0), "pending_since": as_of, "next_retry_at": next_try(as_of, F.lit(0), schedule), "resolved_at": F.lit(None).cast("timestamp")})


def due(entries: DataFrame, as_of: Column, ignore_wait: bool = False) -> DataFrame:
    """The pending entries whose next try has come."""
    pending = entries.filter(F.col("status") == PENDING)
    return pending if ignore_wait else pending.filter(F.col("next_retry_at") <= as_of)


def run_until(misses: DataFrame, since: Column, found: Column, stopped: Column, schedule: Sequence[int], most: int) -> DataFrame:
    """The entries of misses after a runner made each try when it was due, up to ``stopped``: what rounds of :func:`retry` come to.

    since: when the row was missed. found: whether its key has had a partner from then on, so that the first try resolves it.
    """
    waits = list(accumulate(schedule[min(i, len(schedule) - 1)] for i in range(most + 1)))
    age = F.unix_micros(stopped) - F.unix_micros(since)
    tries = F.lit(0)
    for w in waits:
        tries = tries + F.when(age >= w * 60_000_000, 1).otherwise(0)
    hit, out = found & (tries > 0), ~found & (tries > most)
    due = since + F.make_interval(mins=F.get(F.array(*[F.lit(w) for w in waits]), F.when(hit, 0).otherwise(F.least(tries, F.lit(most)))))
    return misses.withColumns({
        "status": F.when(hit, F.lit(RESOLVED)).when(out, F.lit(FAILED)).otherwise(F.lit(PENDING)), "retry_count": F.when(found, 0).otherwise(tries),
        "pending_since": since, "next_retry_at": due, "resolved_at": F.when(hit | out, due),
    })


def _keyed(entries: DataFrame, key: str, trim: bool) -> Column:
    return F.trim(F.col(key)) if trim else F.col(key)


def _turn(as_of: Column, ignore_wait: bool) -> Column:
    pending = F.col("status") == PENDING
    return pending if ignore_wait else pending & (F.col("next_retry_at") <= as_of)


def retry(entries: DataFrame, dimension: DataFrame, key: str, as_of: Column, schedule: Sequence[int], most: int, ignore_wait: bool = False, trim: bool = False, skip_if_none: bool = False) -> DataFrame:
    """All entries after one try of those due.

    Found: resolved, the count unchanged. Not found with ``most`` tries behind it: failed, one
    more counted. Not found else: one more counted and due again after the wait for
    that count. An empty dimension is taken for one that isn't loaded: nothing changes;
    with ``skip_if_none`` nor does it if no entry that is due is found. Entries that
    aren't due pass through. Waiting keys are looked up once, not row by row.

    ignore_wait: a try out of turn, of all pending entries, which leaves ``next_retry_at`` as it is.
    trim: keys are looked up without surrounding spaces on either side.
    """
    known = dimension.select(_keyed(dimension, key, trim).alias("__k")).filter(F.col("__k").isNotNull()).distinct()
    any_row = lambda df: df.limit(1).agg(F.count(F.lit(1)).alias("n")).scalar() > 0
    go = any_row(dimension)
    if skip_if_none:
        go = go & any_row(entries.filter(_turn(as_of, ignore_wait)).join(known, _keyed(entries, key, trim) == F.col("__k"), "left_semi"))
    tried = entries.join(known, _keyed(entries, key, trim) == F.col("__k"), "left")
    turn = _turn(as_of, ignore_wait) & go
    hit, out = turn & F.col("__k").isNotNull(), turn & F.col("__k").isNull() & (F.col("retry_count") >= most)
    again = turn & F.col("__k").isNull() & (F.col("retry_count") < most)
    after = {
        "status": F.when(hit, F.lit(RESOLVED)).when(out, F.lit(FAILED)).otherwise(F.col("status")),
        "retry_count": F.when(out | again, F.col("retry_count") + 1).otherwise(F.col("retry_count")),
        "next_retry_at": F.col("next_retry_at") if ignore_wait else F.when(again, next_try(as_of, F.col("retry_count") + 1, schedule)).otherwise(F.col("next_retry_at")),
        "resolved_at": F.when(hit | out, as_of).otherwise(F.col("resolved_at")),
    }
    return tried.select(*[after[c].alias(c) if c in after else F.col(f"`{c}`") for c in entries.columns])


def recovered(entries: DataFrame, dimension: DataFrame, key: str, attributes: Sequence[str], as_of: Column, ignore_wait: bool = False, trim: bool = False, constants: dict[str, Column] | None = None) -> DataFrame:
    """The rows that :func:`retry` of the same arguments writes: the columns of each entry that it resolves, without its states, and the dimension's ``attributes``.

    The dimension has one row a key. ``constants`` come out beside them, as a mark of values that aren't those of the event's time.
    """
    states = ("status", "retry_count", "pending_since", "next_retry_at", "resolved_at", "error_code", "error_reason")
    looked = dimension.select(_keyed(dimension, key, trim).alias("__k"), *[F.col(a).alias(f"__{a}") for a in attributes])
    both = entries.filter(_turn(as_of, ignore_wait)).join(looked, _keyed(entries, key, trim) == F.col("__k"))
    kept = [c for c in entries.columns if c not in states and c not in attributes]
    return both.select(*kept, *[F.col(f"__{a}").alias(a) for a in attributes], *[c.alias(n) for n, c in (constants or {}).items()])


def cleanup_counts(tables: dict[str, DataFrame], as_of: Column, days: int) -> DataFrame:
    """What :func:`expire` would remove, without removing it: ``table_name, kind, name, n``, for ``eligible`` entries by status and ``pending`` ones by error code."""
    if days < 1:
        raise ValueError("days must be 1 or more")
    out = None
    for table, entries in tables.items():
        gone = F.col("resolved_at") < as_of - F.make_interval(days=F.lit(days))
        kind = F.when(F.col("status") == PENDING, "pending").when(F.col("status").isin(RESOLVED, FAILED) & gone, "eligible")
        name = F.when(F.col("status") == PENDING, F.col("error_code")).otherwise(F.col("status"))
        one = entries.select(F.lit(table).alias("table_name"), kind.alias("kind"), name.alias("name")).filter(F.col("kind").isNotNull())
        one = one.groupBy("table_name", "kind", "name").agg(F.count(F.lit(1)).alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


def expire(entries: DataFrame, as_of: Column, days: int) -> DataFrame:
    """The entries without those settled more than ``days`` ago; pending ones never go."""
    if days < 1:
        raise ValueError("days must be 1 or more")
    old = F.col("status").isin(RESOLVED, FAILED) & (F.col("resolved_at") < as_of - F.make_interval(days=F.lit(days)))
    return entries.filter(~F.coalesce(old, F.lit(False)))
