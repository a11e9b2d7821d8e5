"""Change envelopes: {op, before, after, ts_ms} with row images as JSON text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: The operations of a change and the image each takes effect through.
WRITES = ("r", "c", "u")
DELETE = "d"
ENVELOPE = T.StructType([T.StructField(n, T.StringType()) for n in ("op", "before", "after", "ts_ms")])
_USER_TYPES = {"STRING": T.StringType(), "LONG": T.LongType(), "INTEGER": T.IntegerType(), "BOOLEAN": T.BooleanType()}


def envelope_schema(declared: dict[str, str]) -> T.StructType:
    """An envelope schema from names and declared types; unknown types are read as strings."""
    return T.StructType([T.StructField(n, _USER_TYPES.get(str(t).upper(), T.StringType())) for n, t in declared.items()])


def parse_envelope(messages: DataFrame, value: str = "value", schema: T.StructType = ENVELOPE, keep: Sequence[str] = ("offset",)) -> DataFrame:
    """The envelope's fields of each message, next to the columns in ``keep``.

    Messages without a readable ``op`` (damaged JSON, tombstones) are left out.
    An image may be embedded JSON or JSON text; both come out as text. Numbers
    may be quoted; what can't be read as its declared type is null.
    """
    wire = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    parsed = messages.select(*keep, F.from_json(F.col(value).cast("string"), wire).alias("__m"))
    typed = [F.col(f"__m.`{f.name}`") if isinstance(f.dataType, T.StringType) else F.col(f"__m.`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema]
    return parsed.select(*keep, *typed).filter(F.col("op").isNotNull())


def effective_image(changes: DataFrame, to: str = "row_data") -> DataFrame:
    """Adds the image a change takes effect through: ``after`` of writes, else ``before``; rows without one are left out."""
    image = F.when(F.col("op").isin(*WRITES), F.col("after")).otherwise(F.col("before"))
    return changes.withColumn(to, image).filter(F.col(to).isNotNull())


def is_json_object(text: Column) -> Column:
    """True where the text is intact JSON with an object on top."""
    return F.try_parse_json(text).isNotNull() & F.coalesce(F.ltrim(text, F.lit(" \t\n\r")).startswith("{"), F.lit(False))


def typed_rows(changes: DataFrame, schema: T.StructType, image: str = "row_data", keep: Sequence[str] = ("op", "offset")) -> DataFrame:
    """The image as typed columns. Decimals are read from the text itself, so money stays exact."""
    return changes.select(*keep, F.from_json(F.col(image), schema).alias("__r")).select(*keep, "__r.*")


def text_rows(changes: DataFrame, fields: Sequence[str], image: str = "row_data", keep: Sequence[str] = ("op", "offset")) -> DataFrame:
    """The image's ``fields`` as text, numbers as they are written but for trailing zeros; damaged images are left out."""
    read = changes.select(*keep, F.try_parse_json(F.col(image)).alias("__v")).filter(F.coalesce(F.schema_of_variant("__v").startswith("OBJECT"), F.lit(False)))
    return read.select(*keep, *[F.try_variant_get("__v", f"$.{f}", "string").alias(f) for f in fields])


def delete_keys(changes: DataFrame, key: str) -> DataFrame:
    """The keys that deletes name in their ``before`` image; empty and null keys are left out."""
    keys = changes.filter(F.col("op") == DELETE).select(F.get_json_object("before", f"$.{key}").alias(key))
    return keys.filter(F.col(key).isNotNull() & (F.col(key) != "")).distinct()
