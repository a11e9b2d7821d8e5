"""Signed, conditional and distribution aggregates over changes and events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

MONEY = "decimal(38,2)"


def signed(changes: DataFrame, row_type, keys: Sequence[str]) -> DataFrame:
    """The effect of each change on totals, in one pass: columns of its image, ``sign``.

    Inserts and snapshot reads count their ``after`` image once, updates take their
    ``before`` image back; deletes and other ops count for nothing. Rows lacking one of
    ``keys`` in the image are left out. row_type: the image's struct.
    """
    image = F.when(F.col("op").isin("c", "r"), F.col("after")).when(F.col("op") == "u", F.col("before"))
    sign = F.when(F.col("op") == "u", -1).otherwise(1)
    rows = changes.select(F.from_json(image, row_type).alias("r"), sign.alias("sign")).select("r.*", "sign")
    for k in keys:
        rows = rows.filter(F.col(k).isNotNull())
    return rows


def signed_totals(rows: DataFrame, groups: Sequence[str], amount: str, parts: dict[str, Column]) -> DataFrame:
    """Signed sums and counts of each group; ``parts`` name conditions whose share of the sum comes out on its own.

    A condition that is null counts for no part. Sums of decimals are exact.
    """
    effect = F.col(amount) * F.col("sign")
    split = [F.sum(F.when(on, effect).otherwise(F.lit(0))).cast(MONEY).alias(name) for name, on in parts.items()]
    return rows.groupBy(*groups).agg(F.sum(effect).cast(MONEY).alias("total_amount"), F.sum("sign").cast("bigint").alias("txn_count"), *split)


#: Values are counted in steps of so many bits, so that a step has at most 2^21 counters, whatever the number of values.
_STEPS = (42, 21, 0)


def percentiles(rows: DataFrame, value: Column, groups: Sequence[str] = (), shares: Sequence[float] = (0.5, 0.95), discrete: bool = False) -> DataFrame:
    """``groups`` and the exact percentiles ``p50`` ... of ``value`` to six decimals, interpolated or, with ``discrete``, the first value that has the share below or at it.

    No task ever holds the values: they are counted by their leading bits, then, within the
    few ranges that hold the wanted positions, by further bits, and so on. Each step
    combines before its shuffle. What is broadcast is two rows for each group and
    share. Null values don't count; null groups are groups; values beyond 9 * 10^12 raise.
    """
    names = list(groups)
    base = rows.select(*[F.col(f"`{g}`").alias(f"g{i}") for i, g in enumerate(names)], F.lit(0).alias("g"), F.round(value.cast("double") * F.lit(1_000_000)).cast("bigint").alias("q")).filter(F.col("q").isNotNull())
    keys = ["g", *[f"g{i}" for i in range(len(names))]]

    def same(left: list[str], right: str) -> Column:
        on = F.lit(True)
        for k in left:
            on = on & F.col(k).eqNullSafe(F.col(f"{right}{k}"))
        return on

    def at(share: float) -> list[Column]:
        if discrete:
            one = F.greatest(F.ceil(F.lit(share) * F.col("n")).cast("bigint") - 1, F.lit(0).cast("bigint"))
            return [one, one]
        exact = F.lit(share) * (F.col("n") - 1)
        return [F.floor(exact).cast("bigint"), F.ceil(exact).cast("bigint")]

    wanted = [F.struct(F.lit(i).alias("share"), F.lit(j).alias("side"), c.alias("place")) for i, s in enumerate(shares) for j, c in enumerate(at(s))]
    targets = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).select(*keys, "n", F.explode(F.array(*wanted)).alias("w")).select(*keys, "n", "w.*")
    known: list[str] = []
    for i, bits in enumerate(_STEPS):
        inside = base
        for j, before in enumerate(_STEPS[:i]):
            inside = inside.withColumn(f"b{j}", F.shiftright("q", before))
        by = [*keys, *known]
        if known:
            ranges = F.broadcast(targets.select(*[F.col(k).alias(f"t_{k}") for k in by]).distinct())
            inside = inside.join(ranges, same(by, "t_"), "left_semi")
        step = f"b{i}"
        counted = inside.groupBy(*by, F.shiftright("q", bits).alias(step)).agg(F.count(F.lit(1)).alias("c"))
        upto = F.sum("c").over(Window.partitionBy(*by).orderBy(step).rowsBetween(Window.unboundedPreceding, 0))
        placed = counted.withColumn("upto", upto).select(*[F.col(k).alias(f"c_{k}") for k in by], step, "c", "upto")
        hit = F.broadcast(targets).join(placed, same(by, "c_") & (F.col("place") < F.col("upto")) & (F.col("place") >= F.col("upto") - F.col("c")))
        targets = hit.select(*by, step, "n", "share", "side", (F.col("place") - F.col("upto") + F.col("c")).alias("place"))
        known.append(step)
    found = targets.groupBy(*keys).agg(F.max("n").alias("n"), *[F.max(F.when((F.col("share") == i) & (F.col("side") == j), F.col(known[-1]))).alias(f"v{i}{j}") for i in range(len(shares)) for j in (0, 1)])

    def between(i: int) -> Column:
        low, high = F.col(f"v{i}0").cast("double"), F.col(f"v{i}1").cast("double")
        exact = F.lit(shares[i]) * (F.col("n") - 1)
        return F.round((low + (high - low) * (exact - F.floor(exact))) / F.lit(1_000_000), 6).alias(f"p{shares[i] * 100:g}")

    return found.select(*[F.col(f"g{i}").alias(g) for i, g in enumerate(names)], *[between(i) for i in range(len(shares))])


def distribution(rows: DataFrame, value: Column, groups: Sequence[str] = (), shares: Sequence[float] = (0.5, 0.95), discrete: bool = False) -> DataFrame:
    """Count, average, exact percentiles (``p50`` ..., see :func:`percentiles`) and maximum of ``value``, six decimals. Nulls don't count.

    The average is that of the values to six decimals, summed exactly, so it doesn't depend on the order of the
    rows. Without groups there is one row, of zero and nulls where there are no values.
    """
    v = rows.withColumn("__v", value.cast("double")).filter(F.col("__v").isNotNull())
    summed = v.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("__v").cast("decimal(38,6)")).cast("double") / F.nullif(F.count(F.lit(1)), F.lit(0)), 6).alias("average"), F.round(F.max("__v"), 6).alias("most"))
    points = percentiles(v, F.col("__v"), groups, shares, discrete).withColumnsRenamed({g: f"__{g}" for g in groups})
    on = F.lit(True)
    for g in groups:
        on = on & F.col(g).eqNullSafe(F.col(f"__{g}"))
    named = [f"p{s * 100:g}" for s in shares]
    return summed.join(F.broadcast(points), on, "left").select(*groups, "n", "average", *[F.col(f"`{c}`") for c in named], "most")


def reconcile(raw: DataFrame, kept: DataFrame, keys: Sequence[str], amount: str, count: str, tolerance: str = "0.01") -> DataFrame:
    """Recomputed totals against kept ones, by ``keys``: both, their difference, and OK or MISMATCH. Groups that weren't kept count as zero."""
    k = kept.select(*keys, F.col(amount).alias("__a"), F.col(count).alias("__n"))
    both = raw.join(k, list(keys), "left")
    other = F.coalesce("__a", F.lit(0)).cast(MONEY)
    diff = (F.col(amount) - other).cast(MONEY)
    return both.select(*keys, F.col(amount).alias("raw_sum"), other.alias("kept_sum"), F.col(count).alias("raw_count"), F.coalesce("__n", F.lit(0)).alias("kept_count"), diff.alias("amount_diff"), F.when(F.abs(diff) < F.lit(tolerance).cast(MONEY), "OK").otherwise("MISMATCH").alias("check_result"))


def repeated(rows: DataFrame, key: str) -> DataFrame:
    """``key, n`` of the keys on more than one row; null is no key."""
    return rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``table_name, n`` of each table."""
    every = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()]
    out = every[0]
    for more in every[1:]:
        out = out.unionByName(more)
    return out


def age_buckets(rows: DataFrame, since: str, as_of: Column, edges_hours: Sequence[int], groups: Sequence[str] = ()) -> DataFrame:
    """Counts by age at ``as_of``: ``bucket`` i holds ages from edge i - 1 (or 0) up to but without edge i, the last all beyond. Null times have no age."""
    hours = (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.col(since).cast("timestamp"))) / F.lit(3_600_000_000)
    bucket = F.lit(len(edges_hours))
    for i, edge in reversed(list(enumerate(edges_hours))):
        bucket = F.when(hours < edge, F.lit(i)).otherwise(bucket)
    return rows.filter(F.col(since).isNotNull()).groupBy(*groups, bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
