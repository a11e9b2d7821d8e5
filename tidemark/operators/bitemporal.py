"""Attributes as they were valid and known at an event's time.

A version of an entity is valid from one time and recorded, that is known, from
another. In the plane of valid and recorded time it holds in the quadrant to the
upper right of its corner, less what better versions take; of the versions at a
point the one with the latest valid time counts, then recorded time, then tie.

The plane of each entity is split into disjoint rectangles with one current version
each, indexed by a grid of cells over both axes, and an event meets the rectangles of
its own cell only. What can hold in a cell comes from four places, so no rectangle
is repeated over the cells it spans:

* the versions whose valid time is in the cell's column, recorded before or in its row;
* the versions recorded in its row, valid before its column: they hold from its left edge on;
* of all versions below and to the left of both, the best one, which is a maximum over
  the grid's lower left corner. It is put together from maxima over blocks of
  2^i by 2^j cells, of which each corner needs a logarithmic number.

Only cells with events are filled. Inside a cell versions are taken in the order they
were recorded; each cuts the rectangle it falls into, closing it and opening at
most two, so a cell with m versions has at most 2m rectangles. Entities with a large
part of all versions or events get a finer grid, so that neither meet in one cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.operators.skew import heavy_keys
from tidemark.session import cut_lineage

_LIMIT = 9223372036854775807


def _micros(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(F.col(column).cast("timestamp"))
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("bigint") * F.lit(86_400_000_000)
    return F.col(column).cast("bigint")


def cell_widths(versions: DataFrame, points: DataFrame, span: Column, cell_micros: int, share: float, per_cell: int, events_per_cell: int) -> DataFrame:
    """``entity, width``: the cells of entities with at least ``share`` of all versions or of all events; at most 2/share rows.

    Their cells are narrowed so that a column or row of them holds about ``per_cell``
    versions and a cell ``events_per_cell`` events, if they are spread evenly over ``span``.
    """
    dense = [heavy_keys(df.select("entity"), "entity", share).select("entity", (F.col("n_rows") / F.lit(many)).alias("parts")) for df, many in ((versions, per_cell), (points, events_per_cell))]
    most = dense[0].unionByName(dense[1]).groupBy("entity").agg(F.max("parts").alias("parts"))
    return most.select("entity", F.least(F.lit(cell_micros), F.greatest(F.lit(1), F.floor(span / F.col("parts")))).cast("bigint").alias("width"))


#: The blocks of a row or column index ``x`` in which something at ``x`` counts: those with an even number on their level.
_BLOCKS_OF = "transform(filter(sequence(0, top), l -> (shiftright({x}, l) & 1L) = 0L), l -> shiftright({x}, l) * 64L + l)"
#: The blocks that make up all indices before ``x``: one for each bit of it.
_BLOCKS_BEFORE = "transform(filter(sequence(0, top), l -> (shiftright({x}, l) & 1L) = 1L), l -> (shiftright({x}, l) - 1L) * 64L + l)"


def _in_blocks(df: DataFrame, blocks: str, across: str, along: str) -> DataFrame:
    """``df`` once for each block of columns and rows, ``__a`` and ``__b``."""
    return df.withColumn("__a", F.explode(F.expr(blocks.format(x=across)))).withColumn("__b", F.explode(F.expr(blocks.format(x=along))))


def _rectangles(placed: Column, version: str) -> Column:
    """The disjoint rectangles of a cell, from its versions as structs (recorded, valid, version), both times within the cell."""
    rect = f"struct<left:bigint,right:bigint,low:bigint,high:bigint,version:{version}>"
    inside = lambda o, p: (o["left"] <= p["valid"]) & (p["valid"] < o["right"])
    make = lambda left, right, low, high, v: F.struct(left.alias("left"), right.alias("right"), low.alias("low"), high.alias("high"), v.alias("version"))
    none, end = F.array().cast(f"array<{rect}>"), F.lit(_LIMIT)

    def insert(state: Column, p: Column) -> Column:
        opened, shut = state["opened"], state["shut"]

        def cut(hit: Column) -> Column:
            """State after ``p``, which falls into the open rectangle ``hit``, or left of all if it is null."""
            first = F.struct(F.concat(F.array(make(p["valid"], F.coalesce(F.array_min(F.transform(opened, lambda o: o["left"])), end), p["recorded"], end, p["version"])), opened).alias("opened"), shut.alias("shut"))
            left_of = F.when(hit["left"] < p["valid"], F.array(make(hit["left"], p["valid"], p["recorded"], end, hit["version"]))).otherwise(none)
            now = F.concat(F.filter(opened, lambda o: ~inside(o, p)), left_of, F.array(make(p["valid"], hit["right"], p["recorded"], end, p["version"])))
            gone = F.when(hit["low"] < p["recorded"], F.array(make(hit["left"], hit["right"], hit["low"], p["recorded"], hit["version"]))).otherwise(none)
            split = F.struct(now.alias("opened"), F.concat(shut, gone).alias("shut"))
            return F.when(hit.isNull(), first).when(p["version"] > hit["version"], split).otherwise(F.struct(opened.alias("opened"), shut.alias("shut")))

        return F.get(F.transform(F.array(F.get(F.filter(opened, lambda o: inside(o, p)), 0)), cut), 0)

    several = F.aggregate(F.array_sort(placed), F.struct(none.alias("opened"), none.alias("shut")), insert, lambda s: F.concat(s["shut"], s["opened"]))
    one = F.transform(placed, lambda p: make(p["valid"], end, p["recorded"], end, p["version"]))
    return F.when(F.size(placed) == 1, one).otherwise(several)


def as_known(
    events: DataFrame,
    versions: DataFrame,
    entity: str,
    event_time: str,
    valid_from: str,
    recorded_from: str,
    tie: str,
    attributes: list[str],
    known_time: str | None = None,
    cell_micros: int = 32 * 86_400_000_000,
    heavy_share: float = 0.0005,
    per_cell: int = 8,
    events_per_cell: int = 4096,
    prefix: str = "",
) -> DataFrame:
    """Each event with the ``attributes`` of its entity valid at its time and known at ``known_time``, by default the same.

    Events without such a version are left out, as are events or versions with
    a null entity or time. Versions that are repeated count once. ``tie`` is a
    column that tells apart versions of one valid and recorded time. Attributes may
    be null; they come out as ``prefix`` + name and win over event columns of
    that name. Times at the border count: a version holds from its own times on.
    """
    seen = versions.select(F.col(entity).alias("entity"), _micros(versions, valid_from).alias("valid"), _micros(versions, recorded_from).alias("recorded"), F.col(tie).alias("tie"), F.struct(*attributes).alias("values"))
    seen = seen.filter(F.col("entity").isNotNull() & F.col("valid").isNotNull() & F.col("recorded").isNotNull())
    seen = seen.select("entity", "valid", "recorded", F.struct("valid", "recorded", "tie", "values").alias("version"))
    whole = F.struct(*[F.col(f"`{c}`") for c in events.columns]).alias("event")
    points = events.select(F.col(entity).alias("entity"), _micros(events, event_time).alias("valid"), _micros(events, known_time or event_time).alias("recorded"), whole)
    points = points.filter(F.col("entity").isNotNull() & F.col("valid").isNotNull() & F.col("recorded").isNotNull())

    # The grid is settled first, so that what follows reads it instead of finding it again in every branch: one row, and at most 2/heavy_share.
    ends = cut_lineage(seen.agg(F.min(F.least("valid", "recorded")).alias("from"), F.max(F.greatest("valid", "recorded")).alias("to")))
    start, stop = ends.select("from").scalar(), ends.select("to").scalar()
    widths = F.broadcast(cut_lineage(cell_widths(seen, points, stop - start + 1, cell_micros, heavy_share, per_cell, events_per_cell).withColumnsRenamed({"entity": "__e", "width": "__w"})))

    def gridded(df: DataFrame) -> DataFrame:
        """Adds the width of the entity's cells, the column ``x`` and row ``y`` counted from the first version on, and the highest level of blocks."""
        wide = df.join(widths, F.col("entity") == F.col("__e"), "left").withColumn("width", F.coalesce("__w", F.lit(cell_micros))).withColumn("start", start).drop("__e", "__w")
        index = lambda c: F.floor((F.col(c) - F.col("start")) / F.col("width")).cast("bigint")
        last = F.floor((stop - F.col("start")) / F.col("width")).cast("bigint")
        return wide.withColumns({"x": index("valid"), "y": index("recorded"), "last": last}).withColumn("top", F.floor(F.log2(F.col("last") + 1)).cast("int"))

    corners = gridded(seen)
    asked = gridded(points).filter((F.col("x") >= 0) & (F.col("y") >= 0))  # before the first version nothing holds
    cells = asked.select("entity", "x", "y", "width", "start", "last", "top").distinct()
    left, bottom = F.col("start") + F.col("x") * F.col("width"), F.col("start") + F.col("y") * F.col("width")
    found = ["entity", "x", "y", "recorded", "valid", "version"]

    own = corners.select("entity", F.col("x").alias("vx"), F.col("y").alias("vy"), "valid", "recorded", "version")
    column = cells.join(own.withColumnRenamed("entity", "__e"), (F.col("entity") == F.col("__e")) & (F.col("x") == F.col("vx")) & (F.col("vy") <= F.col("y")))
    column = column.withColumn("recorded", F.greatest("recorded", bottom)).select(*found)
    row = cells.join(own.withColumnRenamed("entity", "__e"), (F.col("entity") == F.col("__e")) & (F.col("y") == F.col("vy")) & (F.col("vx") < F.col("x")))
    row = row.withColumn("valid", left).select(*found)

    blocks = _in_blocks(corners, _BLOCKS_OF, "x", "y").groupBy("entity", "__a", "__b").agg(F.max("version").alias("version"))
    within = cells.withColumns({"cx": F.least("x", F.col("last") + 1), "cy": F.least("y", F.col("last") + 1)})
    wanted = _in_blocks(within, _BLOCKS_BEFORE, "cx", "cy").select("entity", "x", "y", left.alias("valid"), bottom.alias("recorded"), "__a", "__b")
    corner = wanted.join(blocks, ["entity", "__a", "__b"]).select(*found)

    version = seen.schema["version"].dataType.simpleString()
    placed = column.unionByName(row).unionByName(corner).groupBy("entity", "x", "y").agg(F.collect_list(F.struct("recorded", "valid", "version")).alias("placed"))
    indexed = placed.select("entity", "x", "y", F.inline(_rectangles(F.col("placed"), version)))

    here = F.col("at_valid").between(F.col("left"), F.col("right") - 1) & F.col("at_recorded").between(F.col("low"), F.col("high") - 1)
    located = asked.select("entity", "x", "y", F.col("valid").alias("at_valid"), F.col("recorded").alias("at_recorded"), "event").join(indexed, ["entity", "x", "y"]).filter(here)
    known = located.select("event", "version")
    out = {prefix + a: F.col(f"version.values.`{a}`") for a in attributes}
    return known.select(*[F.col(f"event.`{c}`") for c in events.columns if c not in out], *[v.alias(k) for k, v in out.items()])
