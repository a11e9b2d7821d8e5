"""Commit-ordered transactional replay of a change feed.

Changes may arrive in any order and number of copies. The replay

1. assembles transactions: copies of a change (one transaction, key, position and
   image) collapse, and a transaction is
   complete once every change of it that is known has an intact copy (and, where
   the feed says how many changes it has, all of them arrived);
2. holds at gaps: the committed watermark is the position before the first
   incomplete transaction or, where commits are numbered without gaps, before
   the first missing number, whichever is lower;
3. replays nonconflicting keys side by side: changes of different keys commute,
   so the order matters within a key only, where full row images make the last
   change decide; that is a ``max_by`` with map-side partial aggregation;
4. exposes only state made of changes below the watermark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.envelope import DELETE, WRITES, is_json_object


def prepare(feed: DataFrame, key: str, transaction: str, time: str = "ts_ms", payload: Sequence[str] = ("after",), ordinal: str | None = None) -> DataFrame:
    """The changes of a feed of envelopes as ``replay`` takes them.

    Tombstones and other ops are no changes. ``time`` is compared as a number.
    Changes without key, time or transaction have no place in the order and are
    left out. A change is intact if its images are whole JSON objects as far as
    they are there, and a write has its ``after``.

    ordinal: a whole number, the same in all copies of a change, that orders the
    changes of a transaction (their number in it or their place in the log). Without
    one, changes of one key in one transaction follow the life of a row: it
    is written, updated, deleted; what tells them apart is ``image``, a hash of
    op and images.
    """
    nth = F.lit(None).cast("bigint") if ordinal is None else F.col(ordinal).cast("bigint")
    life = F.when(F.col("op") == DELETE, 2).when(F.col("op") == "u", 1).otherwise(0)
    position = F.struct(F.col(time).try_cast("bigint").alias("at"), F.col(transaction).alias("commit"), nth.alias("nth"), life.alias("life"))
    whole = F.when(F.col("op").isin(*WRITES), is_json_object(F.col("after"))).otherwise(F.lit(True))
    whole = whole & (F.col("before").isNull() | is_json_object(F.col("before")))
    image = F.xxhash64("op", F.col("before").isNull(), "before", F.col("after").isNull(), "after") if ordinal is None else F.lit(0).cast("bigint")
    changes = feed.filter(F.col("op").isin(*WRITES, DELETE)).select(
        F.col(key).alias("key"), F.col(transaction).alias("transaction"), position.alias("position"), "op", image.alias("image"), whole.alias("intact"), F.struct(*[F.col(c) for c in payload]).alias("payload")
    )
    return changes.filter(F.col("key").isNotNull() & F.col("transaction").isNotNull() & F.col("position.at").isNotNull())


def assemble(changes: DataFrame, size: Column | None = None) -> DataFrame:
    """One row for each transaction: ``transaction, first, last`` (positions), ``changes`` and ``complete``.

    Copies are changes of one transaction, key, position and image. A damaged copy
    can't show its image; it belongs to an intact change of its transaction, key and
    position if there is one, and is a change that is missing otherwise.

    size: the number of changes the feed announces for the transaction, as an
    aggregate-free column of ``changes``; without it, what is known counts.
    """
    announced = F.lit(None).cast("bigint") if size is None else size.cast("bigint")
    place = ["transaction", "key", "position"]
    sized = changes.withColumn("__size", announced)
    copies = sized.groupBy(*place, F.when(F.col("intact"), F.col("image")).alias("image")).agg(F.max("__size").alias("size"))
    one = copies.groupBy(*place).agg(F.count("image").alias("intact"), F.max("size").alias("size"))  # the same keys: shuffled once
    return one.groupBy("transaction").agg(
        F.min("position").alias("first"),
        F.max("position").alias("last"),
        F.sum(F.greatest("intact", F.lit(1))).alias("changes"),
        (F.min(F.col("intact") > 0) & (F.sum("intact") >= F.coalesce(F.max("size"), F.lit(0)))).alias("complete"),
    )


def first_gap(numbers: DataFrame, column: str, start: int, buckets: int = 65536) -> int:
    """The first whole number from ``start`` on that ``column`` lacks.

    Each round counts the distinct numbers by ranges, at most ``buckets`` of
    them, and looks on into the first range that isn't full, so no task sorts
    the sequence and the driver gets one row a round. Nulls and numbers below
    ``start`` don't count.
    """
    seen = numbers.select(F.col(column).cast("bigint").alias("n")).filter(F.col("n") >= start).distinct()
    top = seen.agg(F.max("n")).first()[0]
    if top is None:
        return start
    low, high = start, top
    while True:
        width = max(1, -(-(high - low + 1) // buckets))
        inside = seen.filter(F.col("n").between(low, high))
        full = inside.groupBy(F.floor((F.col("n") - low) / width).cast("bigint").alias("b")).agg(F.count(F.lit(1)).alias("c"))
        full = full.withColumn("whole", F.col("c") == F.least(F.lit(width), F.lit(high + 1) - (F.lit(low) + F.col("b") * width)))
        found = {r.b for r in full.filter("whole").select("b").collect()}  # at most `buckets` small numbers
        b = 0
        while b in found:
            b += 1
        low = min(low + b * width, high + 1)  # the last range may be short
        if low > high or width == 1:
            return low
        high = min(high, low + width - 1)


def before(position: Column, held) -> Column:
    """Whether ``position`` is before ``held``, the position in a collected row, or null for no hold."""
    if held is None:
        return F.lit(True)
    at = F.struct(F.lit(held["at"]).cast("bigint").alias("at"), F.lit(held["commit"]).alias("commit"), F.lit(held["nth"]).cast("bigint").alias("nth"), F.lit(held["life"]).cast("int").alias("life"))
    return position < at


def watermark(transactions: DataFrame) -> DataFrame:
    """One row: ``held``, the position of the first change that must wait, or null if all transactions are complete."""
    return transactions.filter(~F.col("complete")).agg(F.min("first").alias("held"))


def replay(changes: DataFrame, transactions: DataFrame | None = None, sequence_gap: Column | None = None, keep_deleted: bool = False) -> DataFrame:
    """The current row of each key: ``key, op, transaction, position, payload``.

    Only changes before the first incomplete transaction count and, if
    ``sequence_gap`` is given, only those with ``transaction`` below it. Within
    a key the last position decides; damaged copies never do. Equal positions of
    one key are told apart by op and payload, so copies and input order don't
    matter. Deleted keys come out only with ``keep_deleted``.
    """
    done = assemble(changes) if transactions is None else transactions
    held = watermark(done).scalar()
    exposed = changes.filter(F.col("intact") & (held.isNull() | (F.col("position") < held)))
    if sequence_gap is not None:
        exposed = exposed.filter(F.col("transaction") < sequence_gap)
    value = F.struct("op", "transaction", "position", "payload")
    last = exposed.groupBy("key").agg(F.max_by(value, F.struct("position", "image", F.xxhash64("payload"))).alias("v"))
    last = last.select("key", "v.*")
    return last if keep_deleted else last.filter(F.col("op") != DELETE)
