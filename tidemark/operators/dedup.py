"""One row per identifier: redelivered messages, latest and earliest rows.

All functions here are one aggregation by identifier over a struct of delivery
time and tie-break, so copies are combined before the shuffle and an
identifier that holds a large part of all rows never meets in one task as rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T


def _identified(ids: Sequence[str]) -> Column:
    known = F.lit(True)
    for name in ids:
        known = known & F.col(name).isNotNull()
    return known


#: The bits a value of an order needs as a whole number; Spark's times, of the years 1 to 9999, need 59.
_BITS = {T.BooleanType: 1, T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.DateType: 32, T.LongType: 64, T.TimestampType: 59, T.TimestampNTZType: 59}
#: The bits of the widest number that hash aggregation updates in place.
_ROOM, _NUMBER = 126, "decimal(38,0)"


def _whole(df: DataFrame, name: str) -> tuple[Column, int]:
    kind, c = df.schema[name].dataType, F.col(name)
    if type(kind) not in _BITS:
        raise TypeError(f"{name} is {kind.simpleString()}; an order of deliveries is of whole numbers, dates or times")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        c = F.unix_micros(c.cast("timestamp"))
    elif isinstance(kind, T.DateType):
        c = F.unix_date(c)
    return c.cast("bigint"), _BITS[type(kind)]


def packed(df: DataFrame, order: Sequence[str]) -> list[Column]:
    """The columns of ``order`` (delivery time, then what breaks its ties) as a number, nulls last.

    It is the struct of them with each field in bits of its own, so it compares as the
    struct does, but hash aggregation updates it in place where a struct makes Spark
    sort. 126 bits hold a time and a 64-bit number; of longer orders the rest comes in further numbers.
    """
    numbers: list[Column] = []
    room = 0
    for name in order:
        value, bits = _whole(df, name)
        shifted = F.coalesce(value.cast(_NUMBER) + F.lit(Decimal(1 << (bits - 1))), F.lit(Decimal(1 << bits))).cast(_NUMBER)
        room -= bits + 1
        if numbers and room >= 0:
            numbers[-1] = (numbers[-1] * F.lit(Decimal(1 << (bits + 1))) + shifted).cast(_NUMBER)
        else:
            numbers.append(shifted)
            room = _ROOM - bits - 1
    return numbers


def keep_first(df: DataFrame, ids: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Exactly one row of each identifier: the first by ``order``.

    ids: the columns that together identify a message. order: the delivery
    time and what breaks its ties; nulls come last. Rows equal in all of
    ``order`` are ranked by a hash of the whole row, and wholly equal rows
    are interchangeable, so the result doesn't depend on the order of the
    input. Rows without an identifier (a null in any of ``ids``) can't be
    told to be copies of anything and all stay. Other columns pass through,
    whatever their names; an empty table gives an empty table.
    """
    return _one_of_each(df, ids, order, last=False)


def keep_last(df: DataFrame, ids: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Exactly one row of each identifier: the last by ``order``, nulls first.

    Otherwise as :func:`keep_first`, but rows without an identifier are left
    out, since they are the state of nothing.
    """
    return _one_of_each(df.filter(_identified(ids)), ids, order, last=True)


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind)
    return _orderable(kind.elementType) if isinstance(kind, T.ArrayType) else not isinstance(kind, (T.MapType, T.VariantType))


def _one_of_each(df: DataFrame, ids: Sequence[str], order: Sequence[str], last: bool) -> DataFrame:
    """The least (or greatest) struct of order and remaining columns; the struct is both the rank and the row, so each column is carried once.

    Select the columns that are needed before: what is in ``df`` is read and shuffled.
    """
    rest = [f for f in df.schema if f.name not in ids and f.name not in order]
    plain, odd = [f.name for f in rest if _orderable(f.dataType)], [f.name for f in rest if not _orderable(f.dataType)]
    ordered = [F.col(f"`{name}`").alias(f"o{i}") for i, name in enumerate(order)]
    flags = [] if last else [F.col(f"`{name}`").isNull().alias(f"n{i}") for i, name in enumerate(order)]
    by = ordered if last else [x for pair in zip(flags, ordered, strict=True) for x in pair]
    row = F.struct(*by, *[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(plain)], *[F.to_json(F.col(f"`{c}`")).alias(f"j{i}") for i, c in enumerate(odd)])
    pick = (F.max if last else F.min)(row).alias("__row")
    beside = [(F.max_by if last else F.min_by)(F.struct(*[F.col(f"`{c}`").alias(f"u{i}") for i, c in enumerate(odd)]), row).alias("__odd")] if odd else []
    picked = df.filter(_identified(ids)).groupBy(*ids).agg(pick, *beside)
    back = {c: F.col(f"__row.o{i}") for i, c in enumerate(order) if c not in ids} | {c: F.col(f"__row.v{i}") for i, c in enumerate(plain)} | {c: F.col(f"__odd.u{i}") for i, c in enumerate(odd)}
    one = picked.select(*[back[c].alias(c) if c in back else F.col(f"`{c}`") for c in df.columns])
    return one if last else one.unionByName(df.filter(~_identified(ids)))


def first_values(df: DataFrame, ids: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``ids`` and the ``columns`` of the first row of each identifier by ``order``, which must fit one packed number and tell all rows apart.

    As :func:`keep_first`, with ``min_by`` by the packed order for each column: numbers, times and decimals are
    updated in place by hash aggregation, so a few such columns are cheaper this way. Rows without
    an identifier are left out.
    """
    rank, *more = packed(df, order)
    if more:
        raise ValueError("the order is longer than one packed number")
    ranked = df.filter(_identified(ids)).select(*ids, *[F.col(c) for c in columns], rank.alias("__rank"))
    return ranked.groupBy(*ids).agg(*[F.min_by(c, "__rank").alias(c) for c in columns])


def redelivered(df: DataFrame, ids: Sequence[str], row: str, order: Sequence[str]) -> DataFrame:
    """The rows that are surplus copies: all of each identifier but the one :func:`keep_first` keeps.

    row: an integer column that is unique to a delivery and the last tie-break
    of ``order``. Returns ``ids`` and ``row``. One hash aggregation by
    identifier with a count and ``min_by`` over the packed struct of ``order``
    (:func:`packed`) finds the kept delivery; only identifiers delivered more than
    once are joined back to their rows, so identifiers delivered once are
    shuffled as partial aggregates and no more. A row repeated with the same
    ``row`` value is surplus too, once for each repetition. Rows without an
    identifier are never surplus.
    """
    assert list(order)[-1] == row, "the last tie-break must be the delivery itself"
    narrow = df.filter(_identified(ids)).select(*dict.fromkeys([*ids, *order]))
    *firsts, last = packed(narrow, order)
    count, in_front = F.count(F.lit(1)).alias("__n"), narrow
    for number in firsts:  # orders longer than one number: of each identifier, the rows that are first so far
        ranked = in_front.withColumn("__rank", number)
        best = ranked.groupBy(*ids).agg(F.min("__rank").alias("__best"))
        in_front = ranked.join(best, list(ids)).filter("__rank = __best").drop("__rank", "__best")
    kept = in_front.groupBy(*ids).agg(F.min_by(F.col(row), last).alias("__kept"), count)
    if firsts:
        kept = kept.drop("__n").join(narrow.groupBy(*ids).agg(count), list(ids))
    several = kept.filter("__n > 1").select(*[F.col(c).alias(f"__{c}") for c in ids], "__kept")
    same = F.lit(True)
    for c in ids:
        same = same & (F.col(c) == F.col(f"__{c}"))
    copies = narrow.join(several, same).groupBy(*dict.fromkeys([*ids, row]), "__kept").agg(F.count(F.lit(1)).alias("__m"))
    surplus = copies.withColumn("__m", F.col("__m") - F.when(F.col(row).eqNullSafe(F.col("__kept")), 1).otherwise(0)).filter("__m > 0")
    return surplus.withColumn("__i", F.explode(F.sequence(F.lit(1), F.col("__m").cast("int")))).select(*dict.fromkeys([*ids, row]))
