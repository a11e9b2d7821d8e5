"""Rounds over the dead letters of a store: retries that write what they find, and cleanup. Run once or again and again."""

from __future__ import annotations

import argparse
import datetime as dt
import logging
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators import deadletter, merge
from tidemark.streaming.store import Store

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Letters:
    """Dead letters of one join and what it takes to try them again.

    dead, table: the store's tables of letters and of whole rows, by ``key``. on: the column that is looked up in
    ``dimension``, which is read anew for every round, after ``before`` has run (as the dimension's own feed must be
    applied first). constants: marks of rows that were found late. most: tries before the last.
    """

    dead: str
    table: str
    key: str
    on: str
    dimension: Callable[[], DataFrame]
    attributes: tuple[str, ...]
    schedule: tuple[int, ...] = (5, 15, 60, 240, 1440)
    most: int = 5
    trim: bool = False
    skip_if_none: bool = False
    constants: dict[str, Column] | None = None
    before: Callable[[], None] | None = None


def _clock(now: dt.datetime) -> tuple[Column, int]:
    ms = int(now.timestamp() * 1000)
    return F.timestamp_millis(F.lit(ms)), ms


def retry(store: Store, letters: Letters, now: dt.datetime, ignore_wait: bool = False, most: int | None = None) -> dict[str, int]:
    """One round: letters that are found become rows of the table and are resolved in the same commit; counts by outcome.

    A round is known by its time: the same one again changes nothing, as after a crash between commit and report.
    """
    if letters.before:
        letters.before()
    entries = store.read(letters.dead)
    if entries is None:
        return {}
    as_of, number = _clock(now)
    dimension = letters.dimension().persist()
    try:
        after = deadletter.retry(entries, dimension, letters.on, as_of, letters.schedule, letters.most if most is None else most, ignore_wait, letters.trim, letters.skip_if_none)
        turn = F.col("status") == deadletter.PENDING if ignore_wait else (F.col("status") == deadletter.PENDING) & (F.col("next_retry_at") <= as_of)
        tried = entries.filter(turn).select(letters.key)
        changed = after.join(tried, letters.key, "left_semi").persist()
        found = deadletter.recovered(entries, dimension, letters.on, letters.attributes, as_of, ignore_wait, letters.trim, letters.constants)
        present = store.read(letters.table)
        target = found.columns if present is None else present.columns
        rows = found.select(*[F.col(c) if c in found.columns else F.lit(None).cast(present.schema[c].dataType).alias(c) for c in target])
        counts = {r.outcome: r.n for r in changed.groupBy(F.when(F.col("status") == deadletter.PENDING, "retrying").otherwise(F.lower("status")).alias("outcome")).agg(F.count(F.lit(1)).alias("n")).collect()}
        store.commit(f"retry/{letters.dead}", number, {
            letters.table: (rows, [letters.key], lambda old, new: merge.insert_absent(old, new, [letters.key])),
            letters.dead: (changed, [letters.key], lambda old, new: merge.upsert(old, new, [letters.key])),
        })
        changed.unpersist()
        return counts
    finally:
        dimension.unpersist()


def cleanup(store: Store, dead: dict[str, str], now: dt.datetime, days: int, dry_run: bool = False) -> list[tuple[str, str, str | None, int]]:
    """Takes settled letters of more than ``days`` out of the tables ``dead`` (with their keys), unless ``dry_run``; what it takes and what is pending, as ``deadletter.cleanup_counts``."""
    as_of, number = _clock(now)
    tables = {name: entries for name in dead if (entries := store.read(name)) is not None}
    if not tables:
        return []
    counts = [tuple(r) for r in deadletter.cleanup_counts(tables, as_of, days).collect()]  # a row for each table, state and error code
    if not dry_run:
        def merged(key: str) -> Callable[[DataFrame, DataFrame], DataFrame]:
            return lambda old, gone: merge.delete(old, gone, [key])

        # Only buckets with something to take are written again.
        store.commit("cleanup", number, {name: (merge.delete(e, deadletter.expire(e, as_of, days), [dead[name]]), [dead[name]], merged(dead[name])) for name, e in tables.items()})
    return counts


def rounds(work: Callable[[dt.datetime], object], once: bool = True, interval: float = 600, stop: Callable[[], bool] = lambda: False, sleep: Callable[[float], None] = time.sleep) -> int:
    """Runs ``work`` once, or every ``interval`` seconds until ``stop``. A round that fails is logged; once, it is the exit code 1, else the next comes in its time."""
    while True:
        try:
            log.info("round done: %s", work(dt.datetime.now(dt.timezone.utc)))
            failed = 0
        except Exception:
            log.exception("round failed")
            failed = 1
        if once or stop():
            return failed
        sleep(interval)


def main(store: Store, letters: dict[str, Letters], argv: Sequence[str] | None = None) -> int:
    """``retry|cleanup [--once] [--interval S] [--max-retry N] [--ignore-wait] [--days N] [--dry-run] [--tables name...]``."""
    parser = argparse.ArgumentParser()
    parser.add_argument("work", choices=("retry", "cleanup"))
    parser.add_argument("--once", action="store_true")
    parser.add_argument("--interval", type=float, default=600)
    parser.add_argument("--max-retry", type=int)
    parser.add_argument("--ignore-wait", action="store_true")
    parser.add_argument("--days", type=int, default=7)
    parser.add_argument("--dry-run", action="store_true")
    parser.add_argument("--tables", nargs="+", choices=list(letters), default=list(letters))
    args = parser.parse_args(argv)

    def work(now: dt.datetime) -> object:
        if args.work == "retry":
            return {name: retry(store, letters[name], now, args.ignore_wait, args.max_retry) for name in args.tables}
        return cleanup(store, {letters[name].dead: letters[name].key for name in args.tables}, now, args.days, args.dry_run)

    return rounds(work, args.once, args.interval)
