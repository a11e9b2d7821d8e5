"""Joins of events with dimensions and with other events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: A dimension is broadcast up to this size by the optimizer's estimate; larger ones are joined by shuffle.
BROADCAST_BYTES = 64 << 20


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of a table's size."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def small(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if it is estimated at ``most`` bytes or less, else as it is."""
    return F.broadcast(df) if estimated_bytes(df) <= most else df


def enrich(events: DataFrame, dimension: DataFrame, key: str, attributes: list[str], trim: bool = False) -> DataFrame:
    """Each event with the attributes of its dimension row and ``matched``.

    key: the name of the column on both sides; the dimension has one row a key. Keys match exactly
    or, with ``trim``, without surrounding spaces on either side. Attributes replace event
    columns of their names. Events without a row, or with a null key, get nulls.
    """
    as_key = (lambda c: F.trim(F.col(c))) if trim else F.col
    looked = dimension.select(as_key(key).alias("__k"), *[F.col(a).alias(f"__{a}") for a in attributes], F.lit(True).alias("__hit"))
    both = events.join(small(looked), as_key(key) == F.col("__k"), "left")
    kept = [c for c in events.columns if c not in attributes]
    return both.select(*[F.col(f"`{c}`") for c in kept], *[F.col(f"__{a}").alias(a) for a in attributes], F.coalesce("__hit", F.lit(False)).alias("matched"))


def misses(enriched: DataFrame, dimension: DataFrame, code: str, empty_code: str, reason: Column) -> DataFrame:
    """The events that found no row, with ``error_code`` and ``error_reason``; ``empty_code`` if the dimension has no rows at all."""
    any_row = dimension.limit(1).agg(F.count(F.lit(1)).alias("n")).scalar()
    coded = F.when(any_row == 0, F.lit(empty_code)).otherwise(F.lit(code))
    return enriched.filter(~F.col("matched")).drop("matched").withColumn("error_code", coded).withColumn("error_reason", reason)


def _in_cells(left: DataFrame, right: DataFrame, key: str, left_id: str, left_time: str, right_time: str, before: int, after: int) -> DataFrame:
    """``__id`` and the right row ``__r`` of every pair within the interval.

    Time is cut into cells as long as the interval, a left row is looked up in the cells
    its interval touches, two at most, and (key, cell) is the join key: a key with most
    of the rows is spread over its cells and never meets all of its own rows.
    """
    width = max(1, before + after)
    cell = lambda c: F.floor(c / F.lit(width)).cast("bigint")
    asked = left.select(F.col(left_id).alias("__id"), F.col(key).alias("__k"), F.col(left_time).cast("bigint").alias("__at")).filter(F.col("__k").isNotNull() & F.col("__at").isNotNull())
    asked = asked.withColumn("__cell", F.explode(F.sequence(cell(F.col("__at") - before), cell(F.col("__at") + after))))
    held = right.select(F.col(key).alias("__rk"), F.col(right_time).cast("bigint").alias("__rat"), F.struct(*[F.col(f"`{c}`") for c in right.columns]).alias("__r")).filter(F.col("__rk").isNotNull() & F.col("__rat").isNotNull())
    held = held.withColumn("__rcell", cell(F.col("__rat")))
    near = F.col("__rat").between(F.col("__at") - before, F.col("__at") + after)
    return asked.join(held, (F.col("__k") == F.col("__rk")) & (F.col("__cell") == F.col("__rcell")) & near).select("__id", "__rat", "__r")


def _beside(left: DataFrame, pairs: DataFrame, right: DataFrame, key: str, left_id: str, how: str) -> DataFrame:
    """Left rows with the columns of their right rows; clashing names get the suffix ``_right``."""
    names = {c: f"{c}_right" if c in left.columns else c for c in right.columns if c != key}
    both = left.join(pairs, F.col(left_id) == F.col("__id"), how)
    return both.select(*[F.col(f"`{c}`") for c in left.columns], *[F.col(f"__r.`{c}`").alias(n) for c, n in names.items()])


def interval_join(left: DataFrame, right: DataFrame, key: str, left_id: str, left_time: str, right_time: str, before: int, after: int, how: str = "left") -> DataFrame:
    """``left`` with every row of ``right`` under its key within [left_time - before, left_time + after], borders included.

    Times are whole numbers of one unit; ``left_id`` is unique on the left. how: left
    (rows without a partner come out with nulls) or inner. Null keys or times match nothing.
    """
    return _beside(left, _in_cells(left, right, key, left_id, left_time, right_time, before, after), right, key, left_id, how)


def first_match(left: DataFrame, right: DataFrame, key: str, left_id: str, left_time: str, right_time: str, after: int, tie: str, how: str = "left") -> DataFrame:
    """Each left row with its first partner in [left_time, left_time + after], by ``right_time`` and then ``tie``.

    The pairs of a row are combined as they arise, so none is collected. Otherwise as :func:`interval_join`.
    """
    pairs = _in_cells(left, right, key, left_id, left_time, right_time, 0, after)
    first = pairs.groupBy("__id").agg(F.min_by("__r", F.struct("__rat", f"__r.{tie}")).alias("__r"))
    return _beside(left, first, right, key, left_id, how)


def full_outer_window(left: DataFrame, right: DataFrame, key: str, left_id: str, right_id: str, left_time: str, right_time: str, window: int, by_id: bool = True) -> DataFrame:
    """Pairs of one key within ``window`` of each other, and what is left over on either side: ``left_id, right_id``.

    by_id: an event is left over only if no event of its id has a pair, which is an
    id-level rule; otherwise each event without a pair is. ``left_id`` and ``right_id`` name ids that
    may repeat; events are told apart by (id, time).
    """
    a = left.select(F.col(left_id).alias("left_id"), F.col(left_time).cast("bigint").alias("lt"), F.col(key).alias("k")).withColumn("lrow", F.struct("left_id", "lt", "k"))
    b = right.select(F.col(right_id).alias("right_id"), F.col(right_time).cast("bigint").alias("rt"), F.col(key).alias("k")).withColumn("rrow", F.struct("right_id", "rt", "k"))
    pairs = _in_cells(a, b, "k", "lrow", "lt", "rt", window, window).select(F.col("__id.left_id").alias("left_id"), F.col("__id.lt").alias("lt"), F.col("__r.right_id").alias("right_id"), F.col("__r.rt").alias("rt"))
    on_left, on_right = (["left_id"], ["right_id"]) if by_id else (["left_id", "lt"], ["right_id", "rt"])
    only_left = a.join(pairs.select(*on_left).distinct(), on_left, "left_anti").select("left_id", "lt", F.lit(None).cast(b.schema["right_id"].dataType).alias("right_id"), F.lit(None).cast("bigint").alias("rt"))
    only_right = b.join(pairs.select(*on_right).distinct(), on_right, "left_anti").select(F.lit(None).cast(a.schema["left_id"].dataType).alias("left_id"), F.lit(None).cast("bigint").alias("lt"), "right_id", "rt")
    return pairs.unionByName(only_left).unionByName(only_right)


def absent(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """The rows of ``left`` whose key ``right`` doesn't have; null keys are absent."""
    return left.join(right.select(key), key, "left_anti")


def coverage(rows: DataFrame, key: str, parts: dict[str, DataFrame]) -> DataFrame:
    """``rows`` with one true or false column for each part that says whether it has the key. Parts have one row a key."""
    out = rows
    for name, part in parts.items():
        out = out.join(part.select(F.col(key).alias("__k"), F.lit(True).alias(f"__{name}")), F.col(key) == F.col("__k"), "left").drop("__k")
        out = out.withColumn(name, F.coalesce(f"__{name}", F.lit(False))).drop(f"__{name}")
    return out
