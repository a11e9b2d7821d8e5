"""Streams from declared specs, rounds over dead letters, a store that grows, and the settings of a session."""

from __future__ import annotations

import datetime as dt
import json
import os
import re

import pytest
from pyspark.sql import functions as F

from tidemark import session
from tidemark.operators import merge
from tidemark.plans import cdc
from tidemark.sources import feeds, generator, specs
from tidemark.sources.tables import table
from tidemark.streaming import configured, jobs, maintain, supervise
from tidemark.streaming.store import Store


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def feed(spark, folder, tmp_path_factory):
    """The change feed as files of messages under its topic, in order of offset."""
    at = str(tmp_path_factory.mktemp("feed"))
    topic = f"{at}/bank.S.TX"
    feeds.as_messages(table(spark, folder, "debezium_envelope")).repartitionByRange(3, "offset").sortWithinPartitions("offset").write.parquet(topic)
    for n, f in enumerate(sorted(f for f in os.listdir(topic) if f.startswith("part-"))):
        os.utime(f"{topic}/{f}", (1_700_000_000 + n, 1_700_000_000 + n))
    return at


CONFIG = """
defaults: {{topic_prefix: bank.S, checkpoint_base: "{at}/checkpoints"}}
tables:
  - job_name: tx
    topic_suffix: TX
    target_table: transactions
    key: transaction_id
    source_schema: {{TRANSACTION_ID: VARCHAR2(30), AMOUNT: "NUMBER(18,2)", BRANCH_CODE: VARCHAR2(10), TRANSACTION_STATUS: VARCHAR2(10), TRANSACTION_DATE: DATE}}
    mapping: {{transaction_id: TRANSACTION_ID, amount: AMOUNT, branch_code: BRANCH_CODE, transaction_status: TRANSACTION_STATUS, booked: TRANSACTION_DATE, size: ABS(AMOUNT), TRANSACTION_DATE: null}}
  - {{job_name: broken, topic_suffix: NONE, target_table: nothing, key: K, source_schema: {{K: VARCHAR2(5)}}}}
  - {{job_name: lacking, topic_suffix: TX, key: K, source_schema: {{K: VARCHAR2(5)}}}}
"""


def written(at, text=CONFIG):
    path = f"{at}/config.yaml"
    with open(path, "w") as f:
        f.write(text.format(at=at))
    return path


def test_declared_sync_is_the_mirror(spark, folder, feed, tmp_path):
    """One YAML text starts the streams; a job that can't be started and one that isn't valid leave the other alone."""
    argv = ["--sync-config", written(tmp_path), "--store", f"{tmp_path}/store", "--files", feed, "--locks", f"{tmp_path}/locks", "--once", "--jobs", "all"]
    assert configured.main(lambda: spark, argv) == 0
    got = Store(spark, f"{tmp_path}/store/transactions").read("transactions")
    want = cdc.mirror_max_by(spark, folder)
    shared = ["transaction_id", "amount", "branch_code", "transaction_status"]
    assert want.count() and rows(got.select(*shared)) == rows(want.select(*shared))
    assert got.columns == [*shared, "booked", "size"] and dict(got.dtypes)["booked"] == "date"
    assert got.filter("size <> abs(amount) or booked is null").count() == 0
    assert not os.path.exists(f"{tmp_path}/store/nothing/manifests")
    version = Store(spark, f"{tmp_path}/store/transactions").manifest()["version"]
    assert configured.main(lambda: spark, argv) == 0 and Store(spark, f"{tmp_path}/store/transactions").manifest()["version"] == version


def test_declared_upserts_are_the_fold(spark, folder, feed, tmp_path):
    argv = ["--upsert-config", written(tmp_path), "--store", f"{tmp_path}/store", "--files", feed, "--locks", f"{tmp_path}/locks", "--once", "--jobs", "upsert"]
    assert configured.main(lambda: spark, argv) == 0
    got = Store(spark, f"{tmp_path}/store/transactions").read("transactions")
    shared = ["transaction_id", "amount", "branch_code", "transaction_status", "ts_ms"]
    assert rows(got.select(*shared)) == rows(cdc.upsert_only_fold(spark, folder).select(*shared))


def test_jobs_of_both_configs_exclude_each_other(spark, tmp_path, capsys):
    both = configured.registry(configured.files("x"), str(tmp_path), sync="", upsert="")
    assert both.chosen(["all"]) == ["sync"]
    with pytest.raises(ValueError, match="same tables"):
        both.chosen(["sync", "upsert"])
    assert supervise.main(both, lambda: spark, ["--jobs", "nope"]) == 1
    with pytest.raises(RuntimeError, match="none"):
        configured.start_all(spark, specs.load(CONFIG.format(at=tmp_path)), configured.files(f"{tmp_path}/missing"), lambda spec: Store(spark, str(tmp_path)))


def test_a_declared_envelope_without_times(spark, tmp_path):
    message = json.dumps({"op": "c", "after": {"K": "a", "AT": 1_700_000_000}, "extra": 1})
    spark.createDataFrame([("a", message, "t", 0, 1, dt.datetime(2026, 1, 1))], feeds.COLUMNS).write.parquet(f"{tmp_path}/t")
    spec = specs.resolve({"job_name": "j", "topic": "t", "target_table": "x", "key": "K", "source_schema": {"K": "VARCHAR2(3)", "AT": "TIMESTAMP"}, "time_unit": "s", "checkpoint_base": f"{tmp_path}/c", "envelope_schema": {"op": "STRING", "after": "STRING", "before": "STRING"}})
    store = Store(spark, f"{tmp_path}/s")
    configured.start(spark, spec, configured.files(str(tmp_path)), store, available=True).awaitTermination()
    assert rows(store.read("x").select("K", F.unix_seconds("AT"))) == [("a", 1_700_000_000)]


# Rounds over dead letters.

NOW = dt.datetime(2026, 1, 2, tzinfo=dt.timezone.utc)


def later(minutes):
    return NOW + dt.timedelta(minutes=minutes)


@pytest.fixture
def letters(spark, tmp_path):
    """Two misses of a branch join, as the enriching stream leaves them."""
    at = f"{tmp_path}/in"
    image = lambda k, b: json.dumps({"op": "c", "ts_ms": "5", "after": {"ID": k, "B": b, "N": 1}})
    spark.createDataFrame([("k", image(k, b), "t", 0, n, dt.datetime(2026, 1, 1)) for n, (k, b) in enumerate((("t1", "b1"), ("t2", " b2"), ("t3", "b3")))], feeds.COLUMNS).write.parquet(at)
    store = Store(spark, f"{tmp_path}/store", buckets=3, keep_versions=30)
    dim = [("b1", "first")]
    read = lambda: spark.createDataFrame(list(dim), "B string, name string")
    kind = specs.resolve({"job_name": "j", "topic": "t", "target_table": "x", "key": "ID", "source_schema": {"ID": "VARCHAR2(3)", "B": "VARCHAR2(3)", "N": "INTEGER"}}).row_type
    clock = lambda: F.timestamp_millis(F.lit(int(NOW.timestamp() * 1000)))
    jobs.enrich(feeds.file_stream(spark, at), kind, "ID", "B", read, ["name"], store, "rows", "dead", f"{tmp_path}/c", clock=clock, available=True).awaitTermination()
    assert {r.ID: r.status for r in store.read("dead").collect()} == {"t2": "PENDING", "t3": "PENDING"}
    return store, dim, maintain.Letters("dead", "rows", "ID", "B", read, ("name",), trim=True, constants={"late": F.lit(1)})


def test_retries_write_rows_and_states_in_one_commit(letters):
    store, dim, spec = letters
    dim.append(("b2", "second"))
    assert maintain.retry(store, spec, later(4)) == {}
    before = store.manifest()["version"]
    assert maintain.retry(store, spec, later(5)) == {"resolved": 1, "retrying": 1}
    assert store.manifest()["version"] == before + 1
    assert {r.ID: r.name for r in store.read("rows").collect()} == {"t1": "first", "t2": "second"}
    assert {r.ID: (r.status, r.retry_count) for r in store.read("dead").collect()} == {"t2": ("RESOLVED", 0), "t3": ("PENDING", 1)}
    maintain.retry(store, spec, later(5))  # the same round again
    assert store.manifest()["version"] == before + 1
    assert maintain.retry(store, spec, later(6), ignore_wait=True, most=1) == {"failed": 1}
    assert {r.ID: r.status for r in store.read("dead").collect()}["t3"] == "FAILED"


def test_retries_with_constants_feeds_first_and_unloaded_dimensions(spark, letters):
    store, dim, spec = letters
    ran = []
    import dataclasses

    empty = dataclasses.replace(spec, dimension=lambda: spark.createDataFrame([], "B string, name string"))
    maintain.retry(store, empty, later(5))
    assert {r.retry_count for r in store.read("dead").collect()} == {0}
    skip = dataclasses.replace(spec, skip_if_none=True)
    maintain.retry(store, skip, later(6))
    assert {r.retry_count for r in store.read("dead").collect()} == {0}

    def apply_feed():
        ran.append(1)
        dim.extend([("b2", "second"), ("b3", "third")])

    fresh = dataclasses.replace(spec, table="approximate", before=apply_feed)
    assert maintain.retry(store, fresh, later(7)) == {"resolved": 2} and ran
    assert rows(store.read("approximate").select("ID", "name", "late")) == [("t2", "second", 1), ("t3", "third", 1)]
    assert maintain.retry(Store(spark, f"{store.folder}-none"), spec, later(8)) == {}


def test_cleanup_rounds(letters):
    store, dim, spec = letters
    dim.append(("b2", "second"))
    maintain.retry(store, spec, later(5))
    week = later(5 + 8 * 1440)
    assert sorted(maintain.cleanup(store, {"dead": "ID", "none": "ID"}, week, 7, dry_run=True)) == [("dead", "eligible", "RESOLVED", 1), ("dead", "pending", "NOT_FOUND", 1)]
    assert store.read("dead").count() == 2
    maintain.cleanup(store, {"dead": "ID"}, week, 7)
    assert [r.ID for r in store.read("dead").collect()] == ["t3"]
    assert maintain.cleanup(store, {"none": "ID"}, week, 7) == []


def test_runner_once_and_again(letters, caplog):
    store, dim, spec = letters
    dim.append(("b2", "second"))
    assert maintain.main(store, {"branch": spec}, ["retry", "--once", "--ignore-wait", "--max-retry", "0"]) == 0
    assert {r.ID: r.status for r in store.read("dead").collect()} == {"t2": "RESOLVED", "t3": "FAILED"}
    assert maintain.main(store, {"branch": spec}, ["cleanup", "--once", "--days", "1", "--dry-run"]) == 0
    done, slept = [], []

    def fails_once(now):
        done.append(now)
        if len(done) == 1:
            raise RuntimeError("on purpose")
        return "fine"

    assert maintain.rounds(fails_once, once=False, interval=9, stop=lambda: len(done) == 3, sleep=slept.append) == 0
    assert len(done) == 3 and slept == [9, 9] and "on purpose" in caplog.text
    assert maintain.rounds(lambda now: 1 / 0, once=True) == 1


# Store, sinks, session.


def test_store_grows(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), buckets=2, bucket_bytes=700, keep_versions=50)
    up = lambda old, new: merge.upsert(old, new, ["k"])
    want = {}
    for i in range(6):
        new = {f"k{i}-{j}": i for j in range(100)} | {"k0-0": i}
        want |= new
        assert store.commit("q", i, {"t": (spark.createDataFrame(list(new.items()), "k string, v int"), ["k"], up)})
        assert dict(store.read("t").collect()) == want
    buckets = [store.buckets_of("t", store.manifest(v)) for v in store._versions()]
    assert buckets[0] == 2 and buckets[-1] >= 4 and buckets == sorted(buckets)
    numbers = store.buckets_of("t")
    for b in range(numbers):
        part = store.read("t", [b]).select(store.bucket(["k"], numbers).alias("b")).distinct().collect()
        assert [r.b for r in part] in ([b], [])
    before = store.manifest()["tables"]["t"]["paths"]
    store.commit("q", 9, {"t": (spark.createDataFrame([("k0-0", 99)], "k string, v int"), ["k"], up)})
    after = store.manifest()["tables"]["t"]["paths"]
    assert store.buckets_of("t") > numbers or sum(before[b] != after[b] for b in before) == 1


def test_shown_in_memory(spark, feed):
    query = jobs.show(feeds.file_stream(spark, f"{feed}/bank.S.TX").select("offset"), "memory", "looked_at", available=True)
    query.awaitTermination()
    assert spark.table("looked_at").count() == feeds.file_table(spark, f"{feed}/bank.S.TX").count()


def test_no_folder_of_one_machine_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://elsewhere:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: {})

    class Frame:
        sparkSession = type("Session", (), {"sparkContext": Context})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.cut_lineage(Frame())
    assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")


def test_watch_notices_a_context_that_is_gone():
    class Gone:
        class sparkContext:
            class _jsc:
                sc = staticmethod(lambda: type("Sc", (), {"isStopped": staticmethod(lambda: True)}))

    with pytest.raises(RuntimeError, match="stopped"):
        supervise.watch([], spark=Gone)


def test_generated_transactions_have_all_columns_and_kinds(spark):
    kinds = generator.Kinds(types=("only",), amounts=(5, 6))
    df = generator.transactions(spark, 200, seed=3, branches=4, kinds=kinds)
    assert len(df.columns) == 16
    r = df.agg(F.count_distinct("transaction_type"), F.min("amount"), F.max("amount"), F.count_distinct("branch_code")).first()
    assert (r[0], r[3]) == (1, 4) and 5 <= r[1] and r[2] < 7
    assert df.filter("created_at < transaction_time or value_date < transaction_date").count() == 0
    assert not any(re.search("null", str(x)) for x in df.select(*[F.count_if(F.col(c).isNull()) for c in df.columns]).first() if x)
