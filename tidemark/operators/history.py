"""Validity periods of changing attributes, from periodic snapshots.

Gaps and islands: within an entity a snapshot whose attribute hash differs from
the one before it marks a change, the running sum of the marks numbers the
islands, and an island is one version, valid from its first snapshot to the start
of the next island.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.dedup import keep_last


def attribute_hash(attributes: Sequence[str]) -> Column:
    """64 bits of the attributes as stored; null differs from every value and from being elsewhere."""
    return F.xxhash64(*[x for a in attributes for x in (F.col(a).isNull(), F.col(a))])


def history(snapshots: DataFrame, entity: str, taken: str, loaded: str, attributes: Sequence[str], forever: str = "9999-12-31") -> DataFrame:
    """``entity``, the attributes, ``valid_from``, ``valid_to`` (exclusive) and ``n_snapshots`` of each version.

    snapshots: any order, any number of rows for an entity and snapshot, of
    which the last by ``loaded`` counts (equal ones are told apart by a hash of
    the row). That step is a partial aggregation, after which an entity has
    at most one row for each snapshot: no window partition can outgrow the number
    of snapshots, whoever holds most rows. Absence from a snapshot ends nothing.
    A value that returns later starts a version of its own. Rows without entity
    or snapshot are left out; null attributes are values like others.
    """
    rows = snapshots.select(*dict.fromkeys([entity, taken, loaded, *attributes]))
    one = keep_last(rows, [entity, taken], [loaded])
    by_time = Window.partitionBy(entity).orderBy(taken)
    marked = one.withColumn("__h", attribute_hash(attributes))
    marked = marked.withColumn("__new", F.when(F.lag("__h").over(by_time) == F.col("__h"), 0).otherwise(1))
    islands = marked.withColumn("__island", F.sum("__new").over(by_time.rowsBetween(Window.unboundedPreceding, 0)))
    versions = islands.groupBy(entity, "__island").agg(F.min(taken).alias("valid_from"), F.count(F.lit(1)).alias("n_snapshots"), *[F.min_by(a, taken).alias(a) for a in attributes])
    following = F.lead("valid_from").over(Window.partitionBy(entity).orderBy("__island"))
    end = F.coalesce(following, F.lit(forever).cast(one.schema[taken].dataType))
    return versions.select(entity, *attributes, "valid_from", end.alias("valid_to"), "n_snapshots")
