"""Column mappings with a small expression language, and conversions of wire values."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: The functions a mapping may call.
ALLOWED = ("UPPER", "LOWER", "ABS", "COALESCE", "TRIM", "CONCAT", "ROUND", "CAST", "NULLIF", "SUBSTRING")
_CALL = re.compile(r"\b([A-Za-z_][A-Za-z_0-9]*)\s*\(")


def expression(text: str) -> Column:
    """A mapping's value as a column: a column's name, or calls of allowed functions, with or without a leading SELECT. Others raise ValueError."""
    body = re.sub(r"^\s*SELECT\s+", "", text, flags=re.IGNORECASE).strip()
    unknown = [f for f in _CALL.findall(re.sub(r"'(?:[^']|'')*'", "''", body)) if f.upper() not in ALLOWED]
    if unknown:
        raise ValueError(f"functions not allowed in a mapping: {', '.join(unknown)}")
    return F.expr(body) if "(" in body or body != text.strip() else F.col(f"`{body}`")


def apply_mapping(df: DataFrame, mapping: dict[str, str | None], keep: tuple[str, ...] = ()) -> DataFrame:
    """The target's columns by name; a null value drops the column. ``keep`` passes columns through."""
    return df.select(*keep, *[expression(v).alias(k) for k, v in mapping.items() if v is not None])


def convert(value: Column, kind: str, unit: str = "ms") -> Column:
    """A wire value as the declared type; what can't be read is null.

    Dates and times are epochs in ``unit`` (s, ms or us), UTC. Numbers keep the
    precision and scale they declare, 38 and 10 without.
    """
    name, _, size = kind.strip().upper().partition("(")
    name, size = name.split()[0], size.rstrip(") ")
    if name in ("DATE", "TIMESTAMP"):
        epoch = value.try_cast("bigint")
        at = {"s": F.timestamp_seconds, "ms": F.timestamp_millis, "us": F.timestamp_micros}[unit](epoch)
        return F.to_date(at) if name == "DATE" else at
    if name in ("NUMBER", "DECIMAL", "NUMERIC"):
        return value.try_cast(f"decimal({size or '38,10'})")
    if name in ("FLOAT", "DOUBLE"):
        return value.try_cast("double")
    if name in ("INTEGER", "INT", "LONG"):
        return value.try_cast("bigint")
    return value.cast("string")


def spark_type(kind: str) -> T.DataType:
    """The column type a database type is kept as."""
    name, _, size = kind.strip().upper().partition("(")
    name, size = name.split()[0], size.split(")")[0].replace(" CHAR", "").replace(" BYTE", "")
    if name == "DATE":
        return T.DateType()
    if name == "TIMESTAMP":
        return T.TimestampType()
    if name in ("NUMBER", "DECIMAL", "NUMERIC"):
        parts = [int(x) for x in size.split(",")] if size else [38, 10]
        return T.DecimalType(parts[0], parts[1] if len(parts) > 1 else 0)
    if name in ("FLOAT", "DOUBLE"):
        return T.DoubleType()
    if name in ("INTEGER", "INT", "LONG"):
        return T.LongType()
    return T.StringType()
