"""The pipeline as streams: each job is the batch operators over micro-batches, committed to a :class:`Store` once.

Every job takes a stream with a feed's columns (see :mod:`tidemark.sources.feeds`) and a
checkpoint folder, and returns the started query. ``available`` runs a query over
what is there now and ends; otherwise it runs on with the given trigger.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import aggregates, deadletter, dedup, joins, late, merge, replay
from tidemark.operators.envelope import DELETE, ENVELOPE, WRITES, effective_image, is_json_object, parse_envelope
from tidemark.streaming.store import Store


def start(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, name: str, available: bool = False, seconds: float = 3) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).queryName(name)
    return (writer.trigger(availableNow=True) if available else writer.trigger(processingTime=f"{seconds} seconds")).start()


def ledger_name(batch: DataFrame, name: str, checkpoint: str) -> str:
    """The query in the ledger: its name and the id its checkpoint gave it, as a new checkpoint numbers its batches from 0 again."""
    spark = batch.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/metadata")
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        return f"{name}/{json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, 'UTF-8'))['id']}"
    finally:
        stream.close()


def show(stream: DataFrame, sink: str = "console", name: str = "shown", rows: int = 20, available: bool = False, seconds: float = 5) -> StreamingQuery:
    """A stream on the console, or as the table ``name`` of this session with ``sink`` memory; to look at, not to keep."""
    writer = stream.writeStream.format(sink).queryName(name).outputMode("append")
    writer = writer.option("numRows", rows).option("truncate", "false") if sink == "console" else writer
    return (writer.trigger(availableNow=True) if available else writer.trigger(processingTime=f"{seconds} seconds")).start()


def changes(feed: DataFrame, row_type: T.StructType, envelope: T.StructType = ENVELOPE) -> DataFrame:
    """``op, offset, ts_ms, timestamp`` and the image's columns of every whole change. Works on streams and tables."""
    parsed = parse_envelope(feed, schema=envelope, keep=("offset", "timestamp"))
    missing = {f.name: F.lit(None).cast("string") for f in ENVELOPE if f.name not in parsed.columns}
    parsed = effective_image(parsed.withColumns(missing) if missing else parsed)
    parsed = parsed.filter(is_json_object(F.col("row_data")))
    return parsed.select("op", "offset", F.col("ts_ms").try_cast("bigint").alias("ts_ms"), "timestamp", F.from_json("row_data", row_type).alias("r")).select("op", "offset", "ts_ms", "timestamp", "r.*")


def apply_changes(old: DataFrame, new: DataFrame, key: str, time: str | None, deletes: bool = True) -> DataFrame:
    """One batch in a mirror: the last change of each key by offset, upserts before deletes; with ``time`` only newer rows replace."""
    last = dedup.keep_last(new, [key], ["offset"])
    rows = last.filter(F.col("op").isin(*WRITES)).select(*old.columns)
    kept = merge.upsert_newer(old, rows, [key], time) if time else merge.upsert(old, rows, [key])
    return merge.delete(kept, last.filter(F.col("op") == DELETE), [key]) if deletes else kept


#: What a change has beside the columns of its image.
AROUND = ("op", "offset", "ts_ms", "timestamp")
Shape = Callable[[DataFrame], DataFrame]


def mirror(feed: DataFrame, row_type: T.StructType, key: str, store: Store, table: str, checkpoint: str, time: str | None = None, deletes: bool = True, shape: Shape | None = None, envelope: T.StructType = ENVELOPE, **how) -> StreamingQuery:
    """A mirror of the feed's table. shape: makes the target's columns, ``key`` and ``time`` among them, of the image's; what is in :data:`AROUND` stays."""
    name = how.pop("name", f"mirror_{table}")

    def work(batch: DataFrame, number: int) -> None:
        read = changes(batch, row_type, envelope)
        parsed = (shape(read) if shape else read).filter(F.col(key).isNotNull()).persist()
        try:
            target = [c for c in parsed.columns if c not in AROUND]

            def one(old: DataFrame, new: DataFrame) -> DataFrame:
                return apply_changes(old.select(*target), new, key, time, deletes)

            store.commit(ledger_name(batch, name, checkpoint), number, {table: (parsed, [key], one)})
        finally:
            parsed.unpersist()

    return start(feed, work, checkpoint, name, **how)


def fold_upserts(feed: DataFrame, row_type: T.StructType, key: str, time: str, store: Store, table: str, checkpoint: str, shape: Shape | None = None, envelope: T.StructType = ENVELOPE, **how) -> StreamingQuery:
    """Upserts only, without deletes: the greatest time of a key stays, of equal ones the first by offset. shape: as in :func:`mirror`."""
    name = how.pop("name", f"fold_{table}")

    def work(batch: DataFrame, number: int) -> None:
        read = changes(batch, row_type, envelope)
        rows = (shape(read) if shape else read).filter(F.col("op").isin(*WRITES) & F.col(key).isNotNull())
        target = dict.fromkeys([*[c for c in rows.columns if c not in AROUND], time])
        best = dedup.keep_last(rows.select(*target, (-F.col("offset")).alias("__back")), [key], [time, "__back"]).select(*target)
        store.commit(ledger_name(batch, name, checkpoint), number, {table: (best, [key], lambda old, new: merge.upsert_newer(old, new, [key], time))})

    return start(feed, work, checkpoint, name, **how)


def enrich(feed: DataFrame, row_type: T.StructType, key: str, on: str, dimension: Callable[[], DataFrame], attributes: list[str], store: Store, table: str, dead: str, checkpoint: str, trim: bool = False, update: Sequence[str] | None = None, schedule: Sequence[int] = (5, 15, 60, 240, 1440), clock: Callable[[], Column] = F.current_timestamp, **how) -> StreamingQuery:
    """Transactions with the attributes of a dimension that is read anew for every batch; misses become dead letters in the same commit.

    update: the columns that change in rows that are there already; by default all. Dead letters are
    pending from ``clock`` on and first due after the first wait of ``schedule``; :mod:`tidemark.streaming.maintain` retries them.
    """
    name = how.pop("name", f"enrich_{table}")

    def work(batch: DataFrame, number: int) -> None:
        rows = changes(batch, row_type).filter(F.col("op").isin(*WRITES) & F.col(key).isNotNull())
        last = dedup.keep_last(rows, [key], ["offset"])
        dim = dimension()
        both = joins.enrich(last, dim, on, attributes, trim).persist()
        try:
            lost = joins.misses(both, dim, "NOT_FOUND", "TABLE_EMPTY", F.concat(F.lit(f"no {on} "), F.coalesce(F.col(on), F.lit("null"))))
            hits = both.filter("matched").drop("matched")
            store.commit(ledger_name(batch, name, checkpoint), number, {
                table: (hits, [key], lambda old, new: merge.upsert(old, new, [key]) if update is None else merge.update_columns(old, new, [key], update)),
                dead: (deadletter.pend(lost.select(*[f.name for f in row_type], "error_code", "error_reason"), clock(), schedule), [key], lambda old, new: merge.insert_absent(old, new, [key])),
            })
        finally:
            both.unpersist()

    return start(feed, work, checkpoint, name, **how)


def interval(left: DataFrame, right: DataFrame, on: str, delay: str) -> DataFrame:
    """The stream-stream form of :func:`joins.interval_join`: left rows with right ones up to ``delay`` later, or with nulls once the watermark has passed.

    Both sides have ``on`` and ``timestamp``; both are watermarked by ``delay``. The range
    in the condition is what lets Spark drop old state.
    """
    a = left.withWatermark("timestamp", delay).select(*[F.col(c).alias(f"l_{c}") for c in left.columns])
    b = right.withWatermark("timestamp", delay).select(*[F.col(c).alias(f"r_{c}") for c in right.columns])
    near = (F.col(f"l_{on}") == F.col(f"r_{on}")) & (F.col("r_timestamp") >= F.col("l_timestamp")) & (F.col("r_timestamp") <= F.col("l_timestamp") + F.expr(f"INTERVAL {delay}"))
    return a.join(b, near, "left_outer")


def balances(transactions: DataFrame, accounts: DataFrame, on: str, key: str, delay: str, store: Store, table: str, dead: str, checkpoint: str, **how) -> StreamingQuery:
    """Each transaction with the first account state up to ``delay`` later; without one, a dead letter. Both sides are parsed changes.

    Writes only are joined, of either side; without a column ``op`` all rows are writes. Deletes of
    transactions take their row away in the same commit that adds others, and stay by offset in
    ``<table>_deleted``, so that an older write that finds its match late can't bring the row
    back. Dead letters are left to their own states, but a delete never becomes one.
    """
    name = how.pop("name", f"balances_{table}")
    id_, order = f"l_{key}", ["r_timestamp", "r_offset"]
    writes = lambda side: side.filter(F.col("op").isin(*WRITES)) if "op" in side.columns else side
    joined = interval(writes(transactions), writes(accounts), on, delay)
    if with_deletes := "op" in transactions.columns:
        deletes = transactions.filter((F.col("op") == DELETE) & F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
        joined = joined.unionByName(deletes.select(F.col("op").alias("l_op"), F.col("offset").alias("l_offset"), F.col(key).alias(id_)), allowMissingColumns=True)

    def latest(old: DataFrame, new: DataFrame) -> DataFrame:
        return old.unionByName(new).groupBy(id_).agg(F.max("deleted").alias("deleted"))

    def work(batch: DataFrame, number: int) -> None:
        found = batch.persist()
        try:
            gone = found.filter(F.col("l_op") == DELETE) if with_deletes else found.limit(0)
            written = found.filter(F.col("l_op") != DELETE) if with_deletes else found
            now = gone.select(id_, F.col("l_offset").alias("deleted"))
            before = store.read(f"{table}_deleted")
            deleted = latest(now if before is None else before, now)

            def alive(rows: DataFrame) -> DataFrame:
                both = rows.join(deleted, id_, "left")
                return both.filter(F.col("deleted").isNull() | (F.col("l_offset") > F.col("deleted"))).select(*rows.columns)

            def earliest(old: DataFrame, new: DataFrame) -> DataFrame:
                new = new.filter(F.col("l_op") != DELETE) if with_deletes else new
                return dedup.keep_first(alive(old.unionByName(new)), [id_], order)

            hit, lost = written.filter(F.col("r_timestamp").isNotNull()), written.filter(F.col("r_timestamp").isNull())
            merges = {
                table: (hit.unionByName(gone), [id_], earliest),
                dead: (dedup.keep_last(lost, [id_], ["l_offset"]), [id_], lambda old, new: merge.insert_absent(old, new, [id_])),
            }
            if with_deletes:
                merges[f"{table}_deleted"] = (now, [id_], latest)
            store.commit(ledger_name(batch, name, checkpoint), number, merges)
        finally:
            found.unpersist()

    return start(joined, work, checkpoint, name, **how)


def totals(feed: DataFrame, row_type: T.StructType, groups: Sequence[str], amount: str, required: Sequence[str], parts: dict[str, Column], store: Store, table: str, checkpoint: str, **how) -> StreamingQuery:
    """Signed totals kept up by adding each batch's; the store's ledger makes a replayed batch count once."""
    name = how.pop("name", f"totals_{table}")

    def work(batch: DataFrame, number: int) -> None:
        rows = aggregates.signed(parse_envelope(batch, keep=("offset",)), row_type, required)
        delta = aggregates.signed_totals(rows, groups, amount, parts)
        measures = ["total_amount", "txn_count", *parts]
        store.commit(ledger_name(batch, name, checkpoint), number, {table: (delta, list(groups), lambda old, new: merge.add_up(old, new, list(groups), measures))})

    return start(feed, work, checkpoint, name, **how)


def periods(records: DataFrame, period: str, arrived_ms: str, groups: Sequence[str], amount: str, store: Store, table: str, checkpoint: str, allowed_hours: int = 72, **how) -> StreamingQuery:
    """Partial aggregates of each period and arrival batch, merged batch by batch; read totals with ``late.combine``."""
    name = how.pop("name", f"periods_{table}")
    keys = [period, *groups, "arrival_batch", "lateness"]

    def work(batch: DataFrame, number: int) -> None:
        new = late.partials(late.admit(batch, period, arrived_ms, allowed_hours), [period, *groups], amount)
        store.commit(ledger_name(batch, name, checkpoint), number, {table: (new, keys, lambda old, more: late.merge(old, more, groups=[period, *groups]))})

    return start(records, work, checkpoint, name, **how)


#: What tells a change of the replay from others; copies of one change share it.
CHANGE = ["transaction", "key", "position"]


def without_known_damage(changes: DataFrame, store: Store, exposed: str) -> DataFrame:
    """The changes without damaged copies of those in the table ``exposed``."""
    damaged = changes.filter(~F.col("intact"))
    # As many numbers as the table has buckets, at most.
    touched = [r.b for r in damaged.select(store.bucket(CHANGE, store.buckets_of(exposed)).alias("b")).distinct().collect()]
    known = store.read(exposed, touched) if touched else None
    return changes if known is None else changes.filter("intact").unionByName(damaged.join(known, CHANGE, "left_anti").select(*changes.columns))


def replayed(feed: DataFrame, key: str, transaction: str, store: Store, table: str, checkpoint: str, first: int | None = None, payload: Sequence[str] = ("after",), ordinal: str | None = None, **how) -> StreamingQuery:
    """The replay of :mod:`tidemark.operators.replay` batch by batch: ``key, op, transaction, position, payload``, deleted keys among them.

    feed: a stream of envelopes' fields with ``key`` and ``transaction``. What is at or above the
    committed watermark waits in the table ``<table>_waiting``, which is the part of the
    feed not yet exposed, and joins the next batch; both tables and the next expected
    number change in one commit. first: the first number, where transactions are
    numbered without gaps. Deleted keys stay as rows with op d, so that an older change
    that comes late can't bring them back. ``<table>_exposed`` names every change exposed
    so far, so that a damaged copy that comes after its intact one doesn't hold the state;
    it grows with the feed, without images, and only buckets with damaged copies are looked up.
    """
    name = how.pop("name", f"replayed_{table}")

    def work(batch: DataFrame, number: int) -> None:
        every = without_known_damage(replay.prepare(batch, key, transaction, payload=payload, ordinal=ordinal), store, f"{table}_exposed")
        waiting = store.read(f"{table}_waiting")
        every = (every if waiting is None else every.unionByName(waiting)).persist()
        try:
            held = replay.watermark(replay.assemble(every)).first().held
            ready = replay.before(F.col("position"), held)
            merges = {}
            if first is not None:
                next_ = store.read(f"{table}_next")
                gap = replay.first_gap(every, "transaction", first if next_ is None else next_.first().n)
                ready = ready & (F.col("transaction") < gap)
                merges[f"{table}_next"] = (every.sparkSession.createDataFrame([(0, gap)], "id int, n long"), ["id"], None)
            now = replay.replay(every.filter(ready), keep_deleted=True)
            merges[table] = (now, ["key"], lambda old, new: merge.upsert_newer(old, new, ["key"], "position"))
            merges[f"{table}_waiting"] = (every.filter(~ready).distinct(), ["key"], None)
            merges[f"{table}_exposed"] = (every.filter(ready & F.col("intact")).select(*CHANGE).distinct(), CHANGE, lambda old, new: old.unionByName(new).distinct())
            store.commit(ledger_name(batch, name, checkpoint), number, merges)
        finally:
            every.unpersist()

    return start(feed, work, checkpoint, name, **how)


def once(messages: DataFrame, ids: Sequence[str], order: Sequence[str], store: Store, table: str, checkpoint: str, **how) -> StreamingQuery:
    """Exactly one of each message, within and across batches: the first by ``order``, even if it comes after its copies.

    Messages without an identifier are left out, as a table can't tell them apart.
    """
    name = how.pop("name", f"once_{table}")

    def work(batch: DataFrame, number: int) -> None:
        for column in ids:
            batch = batch.filter(F.col(column).isNotNull())
        new = dedup.keep_first(batch, ids, order)
        store.commit(ledger_name(batch, name, checkpoint), number, {table: (new, ids, lambda old, more: dedup.keep_first(old.unionByName(more), ids, order))})

    return start(messages, work, checkpoint, name, **how)


def bootstrap(store: Store, table: str, rows: DataFrame, key: Sequence[str], number: int = 0) -> bool:
    """A cold start: ``rows`` as the table's first content, before its stream starts; done once for each ``number``, whatever is replayed."""
    return store.commit(f"bootstrap/{table}", number, {table: (rows, key, lambda old, new: merge.upsert(old, new, key))})
