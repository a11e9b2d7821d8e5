"""Keyed merges of changes into a table, as overlays: a join that yields the table's next version.

Every function takes one row a key in ``changes`` (see :mod:`tidemark.operators.dedup`) and
gives whole new rows, so the result can be written as a snapshot or merged further.
Changes with a null key are left out; rows of the target with a null key stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _overlay(target: DataFrame, changes: DataFrame, key: Sequence[str], pick: Callable[[str, Column, Column], Column]) -> DataFrame:
    """The rows of both sides by key; ``pick(column, old, new)`` gives the value where a change has the key."""
    columns = target.columns
    known = F.lit(True)
    for k in key:
        known = known & F.col(k).isNotNull()
    new = changes.filter(known).select(*[F.col(k) for k in key], F.struct(*[F.col(c) if c in changes.columns else F.lit(None).cast(target.schema[c].dataType).alias(c) for c in columns]).alias("__new"))
    old = target.select(*[F.col(k) for k in key], F.struct(*columns).alias("__old"))
    both = old.join(new, list(key), "full_outer")
    there, come = F.col("__old").isNotNull(), F.col("__new").isNotNull()
    value = lambda c: F.when(~come, F.col(f"__old.`{c}`")).when(~there, F.col(f"__new.`{c}`")).otherwise(pick(c, F.col(f"__old.`{c}`"), F.col(f"__new.`{c}`")))
    return both.select(*[F.col(c) if c in key else value(c).cast(target.schema[c].dataType).alias(c) for c in columns])


def upsert(target: DataFrame, changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """Changes replace the row of their key, or are added."""
    return _overlay(target, changes, key, lambda c, old, new: new)


def upsert_newer(target: DataFrame, changes: DataFrame, key: Sequence[str], time: str) -> DataFrame:
    """As :func:`upsert`, but a row is replaced only by one with a strictly later ``time``; equal or null times keep it."""
    newer = F.coalesce(F.col(f"__new.`{time}`") > F.col(f"__old.`{time}`"), F.lit(False))
    return _overlay(target, changes, key, lambda c, old, new: F.when(newer, new).otherwise(old))


def update_columns(target: DataFrame, changes: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """As :func:`upsert`, but rows that are there change in ``columns`` only."""
    return _overlay(target, changes, key, lambda c, old, new: new if c in columns else old)


def insert_absent(target: DataFrame, changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """Changes are added where their key is new; rows that are there never change."""
    return _overlay(target, changes, key, lambda c, old, new: old)


def add_up(target: DataFrame, deltas: DataFrame, key: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Adds the measures of ``deltas`` to those of the target: one union and one aggregation, so deltas needn't be unique.

    A null measure adds nothing; a null in the key is a value. Sums keep the target's types.
    """
    both = target.select(*key, *measures).unionByName(deltas.select(*key, *measures))
    return both.groupBy(*key).agg(*[F.sum(m).cast(target.schema[m].dataType).alias(m) for m in measures])


def delete(target: DataFrame, keys: DataFrame, key: Sequence[str]) -> DataFrame:
    """The target without the rows of ``keys``; empty and null keys delete nothing."""
    named = keys.select(*key)
    for k in key:
        named = named.filter(F.col(k).isNotNull() & (F.col(k).cast("string") != ""))
    return target.join(named, list(key), "left_anti")
