"""Differences between two copies of a table, by a matrix of checksums.

Keys fall into buckets by hash. Each side sums a wide hash of (key, value) for
every bucket and column; the sums don't depend on order and combine before
their shuffle. Only buckets whose sums differ can hold a difference, and only in
the columns that differ there, so just those rows and columns are read again and
joined; everything else is settled by the two matrices. Where buckets are large, the
unequal ones are split again by a second hash before that.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.dedup import keep_first, keep_last
from tidemark.operators.skew import BROADCAST_BYTES, measured_bytes
from tidemark.session import cut_lineage

MISSING_IN_TARGET, MISSING_IN_SOURCE, DIFFERS = "missing_in_target", "missing_in_source", "differs"


#: The most buckets of the first matrix; its unequal cells are broadcast.
MOST_BUCKETS = 65536


def bucket_count(rows: int, rows_per_bucket: int = 32, most: int = MOST_BUCKETS) -> int:
    """A power of two, so that a bucket has about ``rows_per_bucket`` keys.

    ``most`` bounds the first matrix, so that each task's part of it stays at a few MB;
    where buckets hold more, :func:`differences` splits the unequal ones again.
    """
    n = 16
    while n * rows_per_bucket < rows and n < most:
        n *= 2
    return n


@dataclass(frozen=True)
class Settle:
    """Which of several rows of a key stands for it: the first or last by ``order``."""

    order: tuple[str, ...]
    last: bool = False

    def __call__(self, df: DataFrame, key: str, columns: Sequence[Column]) -> DataFrame:
        order = [F.col(f"`{c}`").alias(f"__by_{i}") for i, c in enumerate(self.order)]
        names = [f"__by_{i}" for i in range(len(order))]
        return (keep_last if self.last else keep_first)(_keyed(df, key, *columns, *order), KEY, names).drop(*names)


#: A key is kept as its text and whether it is null, neither of which is null, so that plain equality joins on it.
KEY = ("__key", "__null")


def _keyed(df: DataFrame, key: str, *columns: Column) -> DataFrame:
    return df.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("__key"), F.col(key).isNull().alias("__null"), *columns)


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(*KEY, F.lit("bucket")), F.lit(buckets).cast("bigint"))


def matrix(side: DataFrame, columns: Sequence[str], bucket: Sequence[Column]) -> DataFrame:
    """``bucket, part`` and ``sums``: the number of rows, one sum of hashes for the key and one for each column.

    Hashes have 56 bits, so a sum is exact up to 128 rows a bucket beyond chance
    and overflows only past that many times its width; then it is null, which
    equals nothing.
    """
    hashes = [F.xxhash64(*KEY)] + [F.xxhash64("__key", F.col(f"`{c}`").isNull(), F.col(f"`{c}`")) for c in columns]
    hashed = side.select(*bucket, *[F.shiftright(h, 8).alias(f"h{i}") for i, h in enumerate(hashes)])
    summed = hashed.groupBy("bucket", "part").agg(F.count(F.lit(1)).alias("n"), *[F.try_sum(f"h{i}").alias(f"s{i}") for i in range(len(hashes))])
    return summed.select("bucket", "part", F.array("n", *[F.col(f"s{i}") for i in range(len(hashes))]).alias("sums"))


def _unequal(source: DataFrame, target: DataFrame, columns: Sequence[str], bucket: Sequence[Column]) -> DataFrame:
    a, b = (matrix(side, columns, bucket).withColumnRenamed("sums", name) for side, name in ((source, "a"), (target, "b")))
    both = a.join(b, ["bucket", "part"], "full_outer")
    same = lambda i: F.coalesce(F.get("a", i) == F.get("b", i), F.lit(False))
    keys_differ = ~(same(0) & same(1))
    cells = [F.when(keys_differ | ~same(i + 2), F.lit(c)) for i, c in enumerate(columns)]
    listed = F.array_compact(F.array(*cells)) if cells else F.array().cast("array<string>")
    rows = F.greatest(F.get("a", 0), F.get("b", 0)).alias("rows")
    return both.select("bucket", "part", listed.alias("columns"), rows, keys_differ.alias("keys_differ")).filter(F.col("keys_differ") | (F.size("columns") > 0)).drop("keys_differ")


def unequal_cells(source: DataFrame, target: DataFrame, columns: Sequence[str], buckets: int) -> DataFrame:
    """``bucket, columns``: the buckets that differ and which columns do there; all, where the keys differ."""
    return _unequal(source, target, columns, [_bucket(buckets).alias("bucket"), F.lit(0).cast("bigint").alias("part")]).select("bucket", "columns", "rows")


def unequal_parts(source: DataFrame, target: DataFrame, columns: Sequence[str], buckets: int, cells: DataFrame, rows_per_bucket: int) -> DataFrame:
    """``bucket, part, parts, columns``: each unequal bucket split by a second hash into parts of about ``rows_per_bucket`` rows, and the parts that differ."""
    many = F.greatest(F.lit(1), F.ceil(F.col("rows") / F.lit(rows_per_bucket))).cast("bigint")
    split = F.broadcast(cells.select(F.col("bucket").alias("__bucket"), many.alias("__parts"), F.col("columns").alias("__unequal")))
    shown = lambda df: df.join(split, _bucket(buckets) == F.col("__bucket"))
    bucket = [F.struct("__bucket", "__parts").alias("bucket"), F.pmod(F.xxhash64(*KEY, F.lit("part")), F.col("__parts")).alias("part")]
    return _unequal(shown(source), shown(target), columns, bucket).select("bucket.__bucket", "bucket.__parts", F.col("part").alias("__part"), F.col("columns").alias("__unequal"))


def differences(source: DataFrame, target: DataFrame, key: str, columns: Sequence[str] | None = None, buckets: int = 4096, settle: Settle | None = None, rows: int | None = None, rows_per_bucket: int = 32, most_broadcast: int = BROADCAST_BYTES, unique_target: bool = False) -> DataFrame:
    """``row_key, field_name, diff_kind``: rows that one side lacks (field ``*``) and each differing field.

    columns: compared as stored, null equal only to null; by default all of the
    target but the key, as far as the source has them. settle: which of the
    source's rows of a key counts. Without it, and always on the target, a
    repeated key stands for the smallest of its rows; rows repeated alike on
    both sides are equal. A null key is a key like others, with a null ``row_key``.
    unique_target: the target's key is declared unique, so its rows needn't be
    brought together by key before the join; a key that is repeated all the same comes out
    once for each of its rows.

    rows: how many the target has about. Where that makes more than ``rows_per_bucket``
    a bucket, unequal buckets are split by a second hash into parts of that size, and
    only unequal parts are joined; their list grows with the differences, so it is
    broadcast only if it is measured to be small.
    """
    columns = [c for c in (columns or target.columns) if c != key and c in source.columns]
    types = {f.name: f.dataType for f in target.schema}
    typed = [F.col(f"`{c}`").cast(types[c]).alias(c) for c in columns]
    source = settle(source, key, typed) if settle else _keyed(source, key, *typed)
    target = _keyed(target, key, *typed)
    # At most `buckets` rows of names of columns, whatever the tables hold.
    cells = unequal_cells(source, target, columns, buckets)
    if rows is not None and rows > buckets * rows_per_bucket:
        parts = cut_lineage(unequal_parts(source, target, columns, buckets, cells, rows_per_bucket))
        split = F.broadcast(cut_lineage(parts.select(F.col("__bucket").alias("__b"), F.col("__parts").alias("__n")).distinct()))  # at most `buckets` rows
        parts = F.broadcast(parts) if measured_bytes(parts) <= most_broadcast else parts
        part = F.pmod(F.xxhash64(*KEY, F.lit("part")), F.col("__n"))
        inside = lambda df: df.join(split, _bucket(buckets) == F.col("__b")).withColumn("__p", part).join(parts, (F.col("__b") == F.col("__bucket")) & (F.col("__p") == F.col("__part")))
    else:
        listed = F.broadcast(cells.select(F.col("bucket").alias("__bucket"), F.col("columns").alias("__unequal")))
        inside = lambda df: df.join(listed, _bucket(buckets) == F.col("__bucket"))

    def left(df: DataFrame, name: str, unique: bool) -> DataFrame:
        """One row a key of the unequal buckets, with only the values that some row of its bucket has unequal."""
        values = F.struct(*[F.when(F.array_contains("__unequal", c), F.col(f"`{c}`")).alias(c) for c in columns], F.lit(True).alias("__there"))
        found = inside(df).select(*KEY, values.alias(name))
        return found if unique else found.groupBy(*KEY).agg(F.min(name).alias(name))

    # The settled source comes out of one shuffle by key, which both the matrix and this join read.
    both = left(source, "a", unique=settle is not None).join(left(target, "b", unique=unique_target), list(KEY), "full_outer")
    in_a, in_b = F.col("a").isNotNull(), F.col("b").isNotNull()
    one = lambda field, kind: F.struct(field.alias("field_name"), F.lit(kind).alias("diff_kind"))
    fields = [F.when(~F.col(f"a.`{c}`").eqNullSafe(F.col(f"b.`{c}`")), F.lit(c)) for c in columns]
    differing = F.transform(F.array_compact(F.array(*fields, F.lit(None).cast("string"))), lambda c: one(c, DIFFERS))
    found = F.when(~in_b, F.array(one(F.lit("*"), MISSING_IN_TARGET))).when(~in_a, F.array(one(F.lit("*"), MISSING_IN_SOURCE))).otherwise(differing)
    listed = both.select(F.when(~F.col("__null"), F.col("__key")).alias("row_key"), F.explode(found).alias("d"))
    return listed.select("row_key", "d.field_name", "d.diff_kind")
