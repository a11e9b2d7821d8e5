"""Streams from declared specs: each table of a YAML text becomes a job that keeps a table of the store."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.mapping import apply_mapping, convert
from tidemark.sources import feeds, specs
from tidemark.sources.specs import TableSpec
from tidemark.streaming import jobs, supervise
from tidemark.streaming.store import Store

log = logging.getLogger(__name__)
Source = Callable[[SparkSession, TableSpec], DataFrame]


def kafka(servers: str) -> Source:
    """Each spec's topic, read as its settings say."""
    def read(spark: SparkSession, spec: TableSpec) -> DataFrame:
        s = spec.settings
        return feeds.kafka_stream(spark, servers, spec.topic, s["starting_offsets"], s["max_offsets_per_trigger"], s["fail_on_data_loss"])
    return read


def files(folder: str) -> Source:
    """Each spec's topic as a folder of Parquet files with a feed's columns."""
    return lambda spark, spec: feeds.file_stream(spark, f"{folder.rstrip('/')}/{spec.topic}")


def shape(spec: TableSpec) -> jobs.Shape:
    """Wire values converted as declared and then mapped to the target's columns; what a change has beside its image stays."""
    unit = spec.settings["time_unit"]

    def made(parsed: DataFrame) -> DataFrame:
        typed = parsed.select(*[c for c in jobs.AROUND if c not in spec.source_schema], *[convert(F.col(n), kind, unit).alias(n) for n, kind in spec.source_schema.items()])
        return apply_mapping(typed, spec.mapping, keep=jobs.AROUND)

    return made


def start(spark: SparkSession, spec: TableSpec, source: Source, store: Store, deletes: bool = True, available: bool = False) -> StreamingQuery:
    """The spec's stream into the store's table of its name: a mirror, or with ``deletes`` false a fold of upserts by its time column (the commit time without one)."""
    how = {"shape": shape(spec), "envelope": spec.envelope, "name": spec.job_name, "available": available, "seconds": spec.settings["trigger_seconds"]}
    feed = source(spark, spec)
    if deletes:
        return jobs.mirror(feed, spec.row_type, spec.key, store, spec.target_table, spec.checkpoint, spec.time_column, **how)
    return jobs.fold_upserts(feed, spec.row_type, spec.key, spec.time_column or "ts_ms", store, spec.target_table, spec.checkpoint, **how)


def start_all(spark: SparkSession, found: Sequence[TableSpec], source: Source, store: Callable[[TableSpec], Store], deletes: bool = True, available: bool = False) -> list[StreamingQuery]:
    """A query for each spec. One that can't be started is logged and leaves the others alone; if none can, RuntimeError.

    store: of each spec. Stores have one writer, so specs that run side by side need a folder each.
    """
    started = []
    for spec in found:
        try:
            started.append(start(spark, spec, source, store(spec), deletes, available))
        except Exception:
            log.exception("%s can't be started", spec.job_name)
    if found and not started:
        raise RuntimeError("none of the declared jobs can be started")
    return started


def registry(source: Source, folder: str, sync: str | None = None, upsert: str | None = None, available: bool = False) -> supervise.Registry:
    """The jobs ``sync`` and ``upsert`` of two YAML texts, as far as given. They write the same tables, so they exclude each other."""
    jobs_ = supervise.Registry()
    for name, text, deletes in (("sync", sync, True), ("upsert", upsert, False)):
        if text is not None:
            found = specs.load(text)
            jobs_.add(name, lambda spark, found=found, deletes=deletes: start_all(spark, found, source, lambda spec: Store(spark, f"{folder.rstrip('/')}/{spec.target_table}"), deletes, available), "tables")
    return jobs_


def main(spark: Callable[[], SparkSession], argv: Sequence[str] | None = None) -> int:
    """``--sync-config FILE --upsert-config FILE --store FOLDER (--servers HOSTS | --files FOLDER) [--once] [--jobs name...] [--keep-going]``."""
    parser = argparse.ArgumentParser()
    parser.add_argument("--sync-config")
    parser.add_argument("--upsert-config")
    parser.add_argument("--store", required=True)
    parser.add_argument("--locks", default="locks")
    parser.add_argument("--once", action="store_true", help="what is there now, and end")
    feed = parser.add_mutually_exclusive_group(required=True)
    feed.add_argument("--servers")
    feed.add_argument("--files")
    args, rest = parser.parse_known_args(argv)

    def text(path: str | None) -> str | None:
        if path is None:
            return None
        with open(path, encoding="utf-8") as f:
            return f.read()

    source = kafka(args.servers) if args.servers else files(args.files)
    return supervise.main(registry(source, args.store, text(args.sync_config), text(args.upsert_config), args.once), spark, rest, args.locks)
