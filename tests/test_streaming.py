"""Streams against their batch form, replays, and the runner."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F, types as T

from tidemark.operators import aggregates, dedup, joins, late, merge
from tidemark.operators.envelope import DELETE
from tidemark.plans import problems
from tidemark.sources import feeds
from tidemark.sources.tables import table
from tidemark.streaming import jobs, supervise
from tidemark.streaming.store import Conflict, Store

ROW = T.StructType([T.StructField(n, t) for n, t in (("TRANSACTION_ID", T.StringType()), ("BRANCH_CODE", T.StringType()), ("AMOUNT", T.DecimalType(18, 2)), ("TRANSACTION_DATE", T.LongType()), ("CURRENCY_CODE", T.StringType()))])
KEY = "TRANSACTION_ID"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def feed(spark, folder, tmp_path_factory):
    """The change feed as files of messages in order of offset; the first of each file are the earliest."""
    at = str(tmp_path_factory.mktemp("feed"))
    feeds.as_messages(table(spark, folder, "debezium_envelope")).repartitionByRange(4, "offset").sortWithinPartitions("offset").write.mode("overwrite").parquet(at)
    for n, f in enumerate(sorted(f for f in os.listdir(at) if f.startswith("part-"))):  # a file stream goes by the files' times
        os.utime(f"{at}/{f}", (1_700_000_000 + n, 1_700_000_000 + n))
    return at


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def test_mirror_as_in_batch_and_replayed(spark, feed, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store", buckets=5)
    go = lambda at: run(jobs.mirror(feeds.file_stream(spark, feed, per_trigger=2), ROW, KEY, store, "m", f"{tmp_path}/{at}", available=True))
    go("c1")
    changes = jobs.changes(feeds.file_table(spark, feed), ROW).filter(F.col(KEY).isNotNull())
    want = dedup.keep_last(changes, [KEY], ["offset"]).filter(F.col("op") != DELETE).select(*ROW.fieldNames())
    assert rows(store.read("m").select(*ROW.fieldNames())) == rows(want)
    versions = store.manifest()["version"]
    assert versions == 2 and len(store.manifest()["ledger"]) == 1
    go("c1")
    assert store.manifest()["version"] == versions
    go("c2")  # a new checkpoint numbers its batches anew and is another query
    assert len(store.manifest()["ledger"]) == 2
    assert rows(store.read("m").select(*ROW.fieldNames())) == rows(want)


def test_upsert_fold_as_in_batch(spark, feed, tmp_path):
    store = Store(spark, str(tmp_path / "store"), buckets=3)
    run(jobs.fold_upserts(feeds.file_stream(spark, feed), ROW, KEY, "ts_ms", store, "f", f"{tmp_path}/c", available=True))
    writes = jobs.changes(feeds.file_table(spark, feed), ROW).filter(F.col("op") != DELETE).filter(F.col(KEY).isNotNull()).withColumn("back", -F.col("offset"))
    want = dedup.keep_last(writes, [KEY], ["ts_ms", "back"])
    assert rows(store.read("f").select(KEY, "AMOUNT", "ts_ms")) == rows(want.select(KEY, "AMOUNT", "ts_ms"))


def test_enrichment_and_dead_letters_in_one_commit(spark, folder, feed, tmp_path):
    store = Store(spark, str(tmp_path / "store"), buckets=3)
    dim = lambda: table(spark, folder, "t24_branch_target").filter("branch_code < 'BR030'").withColumnRenamed("branch_code", "BRANCH_CODE")
    run(jobs.enrich(feeds.file_stream(spark, feed), ROW, KEY, "BRANCH_CODE", dim, ["branch_name"], store, "e", "dead", f"{tmp_path}/c", available=True))
    known = {r.BRANCH_CODE: r.branch_name for r in dim().collect()}
    assert all(known[r.BRANCH_CODE] == r.branch_name for r in store.read("e").collect())
    assert all(r.BRANCH_CODE not in known and r.error_code == "NOT_FOUND" for r in store.read("dead").collect())
    written = jobs.changes(feeds.file_table(spark, feed), ROW).filter(F.col("op") != DELETE).select(KEY).distinct()
    assert rows(store.read("e").select(KEY).union(store.read("dead").select(KEY)).distinct()) == rows(written)


def test_totals_as_in_batch_and_counted_once(spark, feed, tmp_path):
    store = Store(spark, str(tmp_path / "store"), buckets=3)
    groups, credit = ["BRANCH_CODE", "CURRENCY_CODE"], F.col("CURRENCY_CODE") == "USD"
    go = lambda: run(jobs.totals(feeds.file_stream(spark, feed), ROW, groups, "AMOUNT", [KEY, "BRANCH_CODE", "AMOUNT"], {"usd": credit}, store, "t", f"{tmp_path}/c", available=True))
    go()
    from tidemark.operators.envelope import parse_envelope

    batch = aggregates.signed_totals(aggregates.signed(parse_envelope(feeds.file_table(spark, feed)), ROW, [KEY, "BRANCH_CODE", "AMOUNT"]), groups, "AMOUNT", {"usd": credit})
    want = rows(batch.select(*groups, "total_amount", "txn_count", "usd"))
    assert rows(store.read("t").select(*groups, "total_amount", "txn_count", "usd")) == want
    go()
    delta = batch.limit(0)
    name = next(iter(store.manifest()["ledger"]))
    assert not store.commit(name, 0, {"t": (delta, groups, lambda old, new: old)}) and store.seen(name, 0) and not store.seen("other", 0)
    assert rows(store.read("t").select(*groups, "total_amount", "txn_count", "usd")) == want


def test_periods_as_in_batch(spark, folder, tmp_path):
    records = problems.late_records(spark, folder).select("row_table", "row_key", "branch_code", "transaction_date", "amount", "ts_ms")
    at = str(tmp_path / "records")
    records.repartitionByRange(3, "ts_ms").write.parquet(at)
    store = Store(spark, str(tmp_path / "store"), buckets=4)
    stream = spark.readStream.schema(records.schema).option("maxFilesPerTrigger", 1).parquet(at)
    run(jobs.periods(stream, "transaction_date", "ts_ms", ["branch_code"], "amount", store, "p", f"{tmp_path}/c", available=True))
    got = late.combine(store.read("p"), ["transaction_date", "branch_code"])
    want = problems.p2_totals(spark, folder)
    assert rows(got.select(*sorted(got.columns))) == rows(want.select(*sorted(want.columns)))


def test_interval_stream_matches_and_gives_up(spark, tmp_path):
    base = dt.datetime(2026, 1, 1)
    at = lambda m: base + dt.timedelta(minutes=m)
    schema = "k string, id string, offset long, timestamp timestamp"
    flush = [("z", f"z{m}", 90 + m, at(m)) for m in (60, 120, 180)]
    left = [("a", "t1", 1, at(0)), ("a", "t2", 2, at(3)), ("b", "t3", 3, at(1)), *flush]
    right = [("a", "x1", 1, at(0)), ("a", "x2", 2, at(5)), ("a", "x3", 3, at(8)), ("b", "x4", 4, at(0)), *[("y", *f[1:]) for f in flush]]
    streams = []
    for name, data in (("l", left), ("r", right)):
        for n in range(len(data)):
            spark.createDataFrame([data[n]], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}/part{n:02d}")
        streams.append(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/{name}/*"))
    store = Store(spark, str(tmp_path / "store"), buckets=2)
    run(jobs.balances(*streams, "k", "id", "5 minutes", store, "s", "dead", f"{tmp_path}/c", available=True))
    got = {r.l_id: r.r_id for r in store.read("s").collect()}
    assert got == {"t1": "x1", "t2": "x2"}
    assert "t3" in {r.l_id for r in store.read("dead").collect()}
    batch = joins.first_match(spark.createDataFrame(left, schema).withColumn("ms", F.unix_millis("timestamp")), spark.createDataFrame(right, schema).withColumn("ms", F.unix_millis("timestamp")), "k", "id", "ms", "ms", 300_000, "offset", "inner")
    assert {r.id: r.id_right for r in batch.collect()} == got


def test_deletes_take_balances_away(spark, tmp_path):
    base = dt.datetime(2026, 1, 1)
    at = lambda m: base + dt.timedelta(minutes=m)
    schema = "op string, k string, id string, offset long, timestamp timestamp"
    flush = [("c", "z", f"z{m}", 90 + m, at(m)) for m in (60, 120, 180)]
    left = [("c", "a", "t1", 1, at(0)), ("d", "a", "t1", 2, at(1)), ("c", "a", "t2", 3, at(3)), ("d", "a", "t2", 4, at(3)), ("d", "a", "t4", 5, at(3)), ("c", "a", "t4", 6, at(4)), ("c", "b", "t3", 7, at(4)), ("d", "a", "t5", 8, at(4)), *flush]
    right = [("c", "a", "x1", 1, at(0)), *[("c", "w", f"w{n}", 2 + n, at(1)) for n in range(5)], ("c", "a", "x2", 8, at(5)), ("d", "b", "x3", 9, at(5)), *[(f[0], "y", *f[2:]) for f in flush]]
    streams = []
    for name, data in (("l", left), ("r", right)):
        for n in range(len(data)):
            spark.createDataFrame([data[n]], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}/part{n:02d}")
            for f in os.listdir(f"{tmp_path}/{name}/part{n:02d}"):
                os.utime(f"{tmp_path}/{name}/part{n:02d}/{f}", (1_700_000_000 + n, 1_700_000_000 + n))
        streams.append(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/{name}/*"))
    store = Store(spark, str(tmp_path / "store"), buckets=2, keep_versions=40)
    run(jobs.balances(*streams, "k", "id", "5 minutes", store, "s", "dead", f"{tmp_path}/c", available=True))
    at_version = [{r.l_id: r.r_id for r in t.collect()} for v in store._versions() if (t := store.read("s", version=v)) is not None]
    assert at_version[0] == {"t1": "x1"} and {} in at_version  # t1 was there and is taken away
    assert at_version[-1] == {"t4": "x2"}  # t2's match comes after its delete; t4 was written anew after its delete
    dead = {(r.l_id, r.l_op) for r in store.read("dead").collect()}
    assert ("t3", "c") in dead and not {x for x in dead if x[1] == "d"}


def test_store_versions_and_conflicts(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), buckets=2, keep_versions=2)
    assert store.read("t") is None and store.manifest()["version"] == 0
    one = lambda *r: spark.createDataFrame(list(r), "k string, v int")
    up = lambda old, new: merge.upsert(old, new, ["k"])
    for i in range(4):
        assert store.commit("q", i, {"t": (one(("a", i), (f"k{i}", i)), ["k"], up)})
    assert rows(store.read("t")) == [("a", 3), ("k0", 0), ("k1", 1), ("k2", 2), ("k3", 3)]
    assert rows(store.read("t", version=3).filter("k = 'a'")) == [("a", 2)]
    assert len(store._versions()) == 2
    assert store.commit("q", 4, {"t": (one(("x", 0)).limit(0), ["k"], up)}) and rows(store.read("t"))[0] == ("a", 3)
    with pytest.raises(Conflict):
        store._publish({"version": store.manifest()["version"], "tables": {}, "ledger": {}})
    assert not [f for f in os.listdir(tmp_path / "s" / "manifests") if f.startswith(".") and not f.endswith(".crc")]


def test_registry_and_locks(tmp_path, capsys):
    registry = supervise.Registry()
    for name, group in (("a", None), ("sync", "mirror"), ("yaml_sync", "mirror")):
        registry.add(name, lambda spark: [], group)
    assert registry.chosen(["all"]) == ["a", "sync"] and registry.chosen(["yaml_sync", "a", "a"]) == ["yaml_sync", "a"]
    assert supervise.main(registry, lambda: None, ["--jobs", "nope"]) == 1 and "nope" in capsys.readouterr().err
    assert supervise.main(registry, lambda: None, ["--jobs", "a"], locks=str(tmp_path)) == 0
    path = str(tmp_path / "x.lock")
    with supervise.Lock(path), pytest.raises(RuntimeError), supervise.Lock(path):
        pass
    assert not os.path.exists(path)
    (tmp_path / "x.lock").write_text("999999999")
    with supervise.Lock(path):
        assert open(path).read() == str(os.getpid())


def test_watch_stops_all_on_a_failure(spark, feed, tmp_path):
    def fail(batch, number):
        raise RuntimeError("on purpose")

    good = jobs.start(feeds.file_stream(spark, feed), lambda b, n: None, f"{tmp_path}/a", "good", seconds=1)
    bad = jobs.start(feeds.file_stream(spark, feed), fail, f"{tmp_path}/b", "bad", seconds=1)
    with pytest.raises(Exception, match="on purpose"):
        supervise.watch([good, bad], every=0.2)
    assert not good.isActive and not bad.isActive


ENVELOPES = "op string, before string, after string, ts_ms string, scn long, id string"


def staged(spark, at, batches):
    for n, batch in enumerate(batches):
        spark.createDataFrame(batch, ENVELOPES).coalesce(1).write.mode("append").parquet(f"{at}/part{n:02d}")
        for f in os.listdir(f"{at}/part{n:02d}"):
            os.utime(f"{at}/part{n:02d}/{f}", (1_700_000_000 + n, 1_700_000_000 + n))
    return spark.readStream.schema(ENVELOPES).option("maxFilesPerTrigger", 1).parquet(f"{at}/*")


def test_replay_stream_waits_and_keeps_deletes(spark, tmp_path):
    change = lambda op, key, scn, whole=True: (op, None, ('{"N":%d}' % scn if whole else '{"N"') if op != "d" else None, str(scn), scn, key)
    batches = [
        [change("c", "a", 1), change("c", "b", 2), change("u", "a", 4, whole=False), change("d", "b", 5)],
        [change("u", "a", 3), change("c", "c", 6)],
        [change("u", "a", 4)],
        [change("u", "b", 2)],
    ]
    store = Store(spark, str(tmp_path / "store"), buckets=3, keep_versions=20)
    run(jobs.replayed(staged(spark, f"{tmp_path}/in", batches), "id", "scn", store, "s", f"{tmp_path}/c", available=True))
    seen = [{r.key: (r.op, r.transaction) for r in store.read("s", version=v).collect()} for v in (1, 2, 3, 4)]
    assert seen[0] == {"a": ("c", 1), "b": ("c", 2)}
    assert seen[1] == {"a": ("u", 3), "b": ("c", 2)}
    assert seen[2] == seen[3] == {"a": ("u", 4), "b": ("d", 5), "c": ("c", 6)}
    assert [store.read("s_waiting", version=v).count() for v in (1, 2, 3, 4)] == [2, 3, 0, 0]


def test_replay_stream_takes_a_damaged_copy_after_its_intact_one(spark, tmp_path):
    change = lambda op, key, scn, whole=True: (op, None, ('{"N":%d}' % scn if whole else '{"N"') if op != "d" else None, str(scn), scn, key)
    batches = [
        [change("c", "a", 1), change("c", "b", 2)],
        [change("c", "b", 2, whole=False), change("u", "a", 3)],
        [change("c", "b", 2, whole=False), change("c", "d", 1, whole=False), change("c", "c", 4)],
        [change("c", "d", 1), change("u", "d", 5)],
    ]
    store = Store(spark, str(tmp_path / "store"), buckets=3, keep_versions=20)
    run(jobs.replayed(staged(spark, f"{tmp_path}/in", batches), "id", "scn", store, "s", f"{tmp_path}/c", available=True))
    seen = [{r.key: r.transaction for r in store.read("s", version=v).collect()} for v in (1, 2, 3, 4)]
    assert seen[0] == {"a": 1, "b": 2}
    assert seen[1] == {"a": 3, "b": 2}
    assert seen[2] == {"a": 3, "b": 2}  # the change of d is new and damaged, so it holds
    assert seen[3] == {"a": 3, "b": 2, "c": 4, "d": 5}
    assert [store.read("s_waiting", version=v).count() for v in (1, 2, 3, 4)] == [0, 0, 2, 0]


def test_replay_stream_holds_at_missing_numbers(spark, tmp_path):
    change = lambda key, scn: ("c", None, "{}", str(scn), scn, key)
    store = Store(spark, str(tmp_path / "store"), buckets=2, keep_versions=20)
    run(jobs.replayed(staged(spark, f"{tmp_path}/in", [[change("a", 1), change("b", 3)], [change("c", 2), change("d", 5)]]), "id", "scn", store, "s", f"{tmp_path}/c", first=1, available=True))
    assert [{r.key for r in store.read("s", version=v).collect()} for v in (1, 2)] == [{"a"}, {"a", "b", "c"}]
    assert store.read("s_next").first().n == 4 and {r.key for r in store.read("s_waiting").collect()} == {"d"}


def test_bootstrap_once(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"), buckets=2)
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    assert jobs.bootstrap(store, "t", df, ["k"]) and not jobs.bootstrap(store, "t", df, ["k"])
    assert rows(store.read("t")) == [("a", 1)]


def test_messages_once_across_batches(spark, folder, tmp_path):
    messages = table(spark, folder, "t24_transactions").select("transaction_id", "amount", "kafka_offset")
    at = str(tmp_path / "in")
    messages.repartition(3, "kafka_offset").write.parquet(at)
    store = Store(spark, str(tmp_path / "store"), buckets=4)
    stream = spark.readStream.schema(messages.schema).option("maxFilesPerTrigger", 1).parquet(at)
    run(jobs.once(stream, ["transaction_id"], ["kafka_offset"], store, "m", f"{tmp_path}/c", available=True))
    assert rows(store.read("m").select(*messages.columns)) == rows(dedup.keep_first(messages, ["transaction_id"], ["kafka_offset"]))
