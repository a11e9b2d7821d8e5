"""Invented transactions in any number, the same for the same seed."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


@dataclass(frozen=True)
class Kinds:
    """What categories are drawn from; shorter lists make values more frequent."""

    types: Sequence[str] = ("standing order", "card", "cash", "fee")
    currencies: Sequence[str] = ("AAA", "BBB")
    channels: Sequence[str] = ("counter", "phone", "net")
    statuses: Sequence[str] = ("done", "open", "undone")
    amounts: tuple[int, int] = (20_000, 9_000_000)


def transactions(spark: SparkSession, n: int, seed: int = 1, first: int = 0, accounts: int = 1000, customers: int = 400, branches: int = 20, start: str = "2026-01-01", days: int = 90, kinds: Kinds = Kinds(), parts: int | None = None) -> DataFrame:
    """``n`` transactions with ids from ``first`` on; every value is a hash of the id and the seed, so partitions don't matter."""
    def draw(name: str, many: int) -> Column:
        return F.pmod(F.xxhash64(F.col("id"), F.lit(name), F.lit(seed)), F.lit(many).cast("bigint")).cast("int")

    def one_of(name: str, values: Sequence[str]) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), draw(name, len(values)))

    day = F.date_add(F.lit(start).cast("date"), draw("day", days + 1))
    at = F.timestamp_seconds(F.unix_date(day).cast("bigint") * 86_400 + draw("second", 86_400))
    low, high = kinds.amounts
    return spark.range(first, first + n, 1, parts).select(
        F.format_string("t%d", F.col("id")).alias("transaction_id"),
        F.format_string("a%d", draw("account", accounts)).alias("account_id"),
        F.format_string("c%d", draw("customer", customers)).alias("customer_id"),
        day.alias("transaction_date"),
        F.date_add(day, draw("value", 3)).alias("value_date"),
        at.alias("transaction_time"),
        one_of("type", kinds.types).alias("transaction_type"),
        (F.lit(low) + draw("amount", high - low) + draw("cents", 100).cast("decimal(4,0)") / F.lit(100)).cast("decimal(18,2)").alias("amount"),
        one_of("currency", kinds.currencies).alias("currency_code"),
        one_of("channel", kinds.channels).alias("channel"),
        F.format_string("in%d", draw("input", 50)).alias("input_id"),
        F.format_string("au%d", draw("author", 20)).alias("author_id"),
        F.format_string("b%d", draw("branch", branches)).alias("branch_code"),
        F.format_string("ref%x", F.xxhash64("id", F.lit("reference"), F.lit(seed))).alias("reference_no"),
        one_of("status", kinds.statuses).alias("transaction_status"),
        F.timestamp_seconds(F.unix_seconds(at) + draw("delay", 600)).alias("created_at"),
    )
