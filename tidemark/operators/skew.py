"""Per-key work where a few keys hold most rows.

A mergeable frequent-items sketch names the candidates in one pass, an exact
count of the candidates settles which keys are heavy, and heavy keys then go
another way than the rest: their rows stay where they are and meet a broadcast
table, while all other rows are shuffled as usual; the two results are united.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: The sketch tracks so many items a share of 1; its error is then below a quarter of the share.
TRACKED_PER_SHARE = 64
#: Fixed value: the most counters Spark's sketch has, a power of two. Shares it can't tell are counted key by key.
MOST_TRACKED = 1 << 19
#: The rows of heavy keys' partners are broadcast up to so many bytes, as measured; beyond that they are salted.
BROADCAST_BYTES = 64 << 20


def least_share() -> float:
    """The least share whose heavy keys the sketch is sure to name."""
    return TRACKED_PER_SHARE / MOST_TRACKED


def candidates(df: DataFrame, keys: Sequence[str], share: float) -> DataFrame:
    """Keys that may hold at least ``share`` of all rows, and how many rows there are: ``key_name, key_value, n_all``, values as text.

    A frequent-items sketch for each column, all in one pass, with at least 64/share
    counters, merged from the partitions' sketches, overestimates by less than
    share/4. At most 1/(share - share/4) keys can thus seem heavy, and the sketch
    returns twice as many by estimate, so no heavy key is missing. Null is
    no key. Below :func:`least_share` that doesn't hold, and ValueError is raised.
    """
    if share < least_share():
        raise ValueError(f"the sketch tells shares from {least_share()} on, not {share}")
    most, tracked = math.ceil(2.7 / share) + 1, 1 << math.ceil(math.log2(TRACKED_PER_SHARE / share))
    sketches = [F.expr(f"approx_top_k(CAST(`{k}` AS STRING), {most}, {max(most, tracked)})").alias(f"t{i}") for i, k in enumerate(keys)]
    def named(i: int, name: str) -> Column:
        return F.transform(f"t{i}", lambda t: F.struct(F.lit(name).alias("key_name"), t["item"].alias("key_value")))
    top = df.agg(*sketches, F.count(F.lit(1)).alias("n_all")).select(F.explode(F.concat(*[named(i, k) for i, k in enumerate(keys)])).alias("c"), "n_all")
    return top.select("c.*", "n_all").filter(F.col("key_value").isNotNull())


def heavy(df: DataFrame, keys: Sequence[str], share: float) -> DataFrame:
    """The values of each of ``keys`` on at least ``share`` of all rows, nulls included in all: ``key_name, key_value, n_rows, n_all``; exact.

    Two passes over the columns of all keys together: the sketch names candidates,
    a count of them settles it. Shares too small for the sketch are settled by
    counting every key, which combines before its shuffle. Either way at most 1/share
    rows come out for each key, whatever the size of ``df``. An empty table has none.
    """
    each = df.select(F.explode(F.array(*[F.struct(F.lit(k).alias("key_name"), F.col(f"`{k}`").cast("string").alias("key_value")) for k in keys])).alias("k")).select("k.*")
    each = each.filter(F.col("key_value").isNotNull())
    if share < least_share():
        counts = each.groupBy("key_name", "key_value").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_all", df.agg(F.count(F.lit(1)).alias("n")).scalar())
    else:
        few = candidates(df, keys, share).withColumnsRenamed({"key_name": "__name", "key_value": "__value"})
        joined = each.join(F.broadcast(few), (F.col("key_name") == F.col("__name")) & (F.col("key_value") == F.col("__value")))
        counts = joined.groupBy("key_name", "key_value", "n_all").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.filter(F.col("n_rows") >= F.lit(share) * F.col("n_all")).select("key_name", "key_value", "n_rows", "n_all")


def heavy_keys(df: DataFrame, key: str, share: float) -> DataFrame:
    """:func:`heavy` for one key, with the key's own name and type: ``key, n_rows, n_all``; at most 1/share rows, so it is broadcast safely."""
    found = heavy(df.select(F.col(key).alias("k")), ["k"], share)
    return found.select(F.col("key_value").cast(df.schema[key].dataType).alias(key), "n_rows", "n_all")


def measured_bytes(df: DataFrame) -> int:
    """About how many bytes the rows of ``df`` are in memory, by counting them."""
    wide = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")) if isinstance(f.dataType, (T.StringType, T.BinaryType)) else F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`")))), F.lit(0)) for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType, T.ArrayType, T.StructType, T.MapType))]
    size = F.lit(16 + 8 * len(df.columns)).cast("bigint")
    for w in wide:
        size = size + w
    return df.agg(F.sum(size).alias("n")).first().n or 0


def aggregate_by_key(df: DataFrame, key: str, share: float, aggregates: Sequence[Column]) -> DataFrame:
    """``aggregates`` of each key, null among them, with the heavy keys apart.

    Rows of heavy keys are picked by a broadcast join and combined where they
    are; only one partial row for each task and heavy key is shuffled. The rest
    is hashed by key as usual, without the heavy keys no partition stands out.
    ``heavy`` says which way a key went. The aggregates must be mergeable, as
    all built-in ones are.
    """
    few = F.broadcast(heavy_keys(df, key, share).select(F.col(key).alias("__heavy")))
    marked = df.join(few, F.col(key) == F.col("__heavy"), "left")
    few = marked.filter(F.col("__heavy").isNotNull()).groupBy(key).agg(*aggregates).withColumn("heavy", F.lit(True))
    rest = marked.filter(F.col("__heavy").isNull()).groupBy(key).agg(*aggregates).withColumn("heavy", F.lit(False))
    return few.unionByName(rest)


def join_by_key(left: DataFrame, right: DataFrame, key: str, share: float, how: str = "inner", most_broadcast: int = BROADCAST_BYTES) -> DataFrame:
    """``left`` joined with ``right`` on ``key``, safe against heavy keys of ``left``.

    The rows of ``right`` under heavy keys are broadcast if they take at most
    ``most_broadcast`` bytes, as measured by a pass over them; if they take more, the rows on
    the left are salted and the partners repeated for each salt instead. All
    other rows are joined by an ordinary shuffle. how: inner or left. Clashing
    names other than the key get the suffix ``_right``. Null keys match nothing.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how}")
    clash = {c: f"{c}_right" for c in right.columns if c in left.columns and c != key}
    right = right.withColumnsRenamed(clash)
    few_keys = F.broadcast(heavy_keys(left, key, share).select(F.col(key).alias("__heavy")))
    partners = right.join(few_keys, F.col(key) == F.col("__heavy"), "left_semi")
    marked = left.join(few_keys, F.col(key) == F.col("__heavy"), "left")
    rows = marked.filter(F.col("__heavy").isNotNull()).drop("__heavy")
    others = right.join(few_keys, F.col(key) == F.col("__heavy"), "left_anti")
    rest = marked.filter(F.col("__heavy").isNull()).drop("__heavy").join(others, key, how)
    if measured_bytes(partners) <= most_broadcast:
        few = rows.join(F.broadcast(partners), key, how)
    else:
        salts = max(2, math.ceil(4 / share) // 16)
        salted = rows.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns if not c.startswith("__")]), F.lit(salts)))
        repeated = partners.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
        few = salted.join(repeated, [key, "__salt"], how).drop("__salt")
    return few.unionByName(rest)
