"""Merges, joins, totals, dead letters, mappings and sources on small tables."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from tidemark.functions import mapping
from tidemark.operators import aggregates, deadletter, dedup, envelope, joins, merge
from tidemark.sources import ddl, feeds, generator, specs


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# Envelopes.


def test_envelopes(spark):
    after = '{"ID":"a","AMOUNT":9007199254740993.25}'
    messages = [
        (1, '{"op":"c","before":null,"after":%s,"ts_ms":"5"}' % after),
        (2, '{"op":"c","after":"{\\"ID\\":\\"b\\",\\"AMOUNT\\":1.10}","ts_ms":7,"source":{"x":1}}'),
        (3, None),
        (4, "{broken"),
        (5, '{"before":null}'),
        (6, '{"op":"d","before":{"ID":"c"},"after":null}'),
        (7, '{"op":"d","before":null,"after":null}'),
        (8, '{"op":"t","before":{"ID":"t"}}'),
    ]
    df = spark.createDataFrame(messages, "offset long, value string")
    parsed = envelope.parse_envelope(df)
    assert [r.offset for r in parsed.orderBy("offset").collect()] == [1, 2, 6, 7, 8]
    typed = envelope.typed_rows(envelope.effective_image(parsed), T.StructType().add("ID", "string").add("AMOUNT", "decimal(18,2)"))
    assert [(r.offset, r.ID) for r in typed.orderBy("offset").collect()] == [(1, "a"), (2, "b"), (6, "c"), (8, "t")]
    assert str(typed.filter("ID = 'b'").first().AMOUNT) == "1.10"
    assert rows(envelope.delete_keys(parsed, "ID")) == [("c",)]
    assert envelope.envelope_schema({"op": "string", "ts_ms": "LONG", "x": "odd"}).simpleString() == "struct<op:string,ts_ms:bigint,x:string>"
    json = spark.createDataFrame([("{}",), ('{"a":1',), ("[1]",), (None,), ('{"a":{}}',)], "j string")
    assert [r[0] for r in json.select(envelope.is_json_object(F.col("j"))).collect()] == [True, False, False, False, True]
    more = ["", " ", "null", "1", '"{}"', ' \t\r\n{"a":1} ', '{"a":1}x', "{}{}", "\ufeff{}", '{"a":1,}', "{'a':1}", '{"a":[1,{"b":2}]}', "{", "}{"]
    both = spark.createDataFrame([(j,) for j in more], "j string").select("j", envelope.is_json_object(F.col("j")).alias("quick"), F.coalesce(F.schema_of_variant(F.try_parse_json("j")).startswith("OBJECT"), F.lit(False)).alias("slow"))
    assert [(r.j, r.quick) for r in both.collect()] == [(r.j, r.slow) for r in both.collect()]


def test_declared_envelopes_and_rows_as_text(spark):
    df = spark.createDataFrame([(1, '{"op":"c","ts_ms":"5","snapshot":true,"after":{"A":12.50,"B":null}}'), (2, '{"op":"u","ts_ms":7,"snapshot":"false"}'), (3, '{"op":"d","ts_ms":"soon"}')], "offset long, value string")
    shape = envelope.envelope_schema({"op": "STRING", "after": "STRING", "ts_ms": "LONG", "snapshot": "BOOLEAN"})
    parsed = envelope.parse_envelope(df, schema=shape)
    assert rows(parsed.select("offset", "ts_ms", "snapshot")) == [(1, 5, True), (2, 7, False), (3, None, None)]
    images = spark.createDataFrame([(1, '{"A":431280016.21,"B":"x","C":{"D":1}}'), (2, '{"A":1'), (3, None), (4, "[1]"), (5, "{}")], "offset long, row_data string")
    assert rows(envelope.text_rows(images, ["A", "B", "C"], keep=("offset",))) == [(1, "431280016.21", "x", '{"D":1}'), (5, None, None, None)]


# Folds.


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from("crud"), st.one_of(st.none(), st.integers(0, 5))), max_size=25), st.randoms())
def test_last_by_offset_is_a_sequential_fold(spark, changes, rng):
    data = [(k, o, t, i) for i, (k, o, t) in enumerate(changes)]
    want = {}
    for k, o, t, i in data:
        want[k] = (o, i)
    newest = {}
    for k, o, t, i in data:
        old = newest.get(k)
        if old is None or (t is not None and (old[0] is None or t >= old[0])) or (t is None and old[0] is None):
            newest[k] = (t, i)
    rng.shuffle(data)
    df = spark.createDataFrame(data, "k string, op string, ts int, off int")
    assert {r.k: (r.op, r.off) for r in dedup.keep_last(df, ["k"], ["off"]).collect()} == want
    assert {r.k: (r.ts, r.off) for r in dedup.keep_last(df, ["k"], ["ts", "off"]).collect()} == newest


# Merges.

OLD = [("a", 1, "old"), ("b", 5, "old"), ("c", None, "old"), (None, 1, "null")]
NEW = [("a", 2, "new"), ("b", 5, "new"), ("c", 9, "new"), ("d", None, "new"), (None, 7, "lost")]


def test_merges(spark):
    old, new = spark.createDataFrame(OLD, "k string, t int, v string"), spark.createDataFrame(NEW, "k string, t int, v string").withColumn("more", F.lit(1))
    null = (None, 1, "null")
    got = lambda df: rows(df)
    want = lambda *r: sorted([*r, null], key=repr)
    assert got(merge.upsert(old, new, ["k"])) == want(*NEW[:4])
    assert got(merge.upsert_newer(old, new, ["k"], "t")) == want(("a", 2, "new"), ("b", 5, "old"), ("c", None, "old"), ("d", None, "new"))
    assert got(merge.update_columns(old, new, ["k"], ["v"])) == want(("a", 1, "new"), ("b", 5, "new"), ("c", None, "new"), ("d", None, "new"))
    assert got(merge.insert_absent(old, new, ["k"])) == want(*OLD[:3], ("d", None, "new"))
    assert got(merge.upsert(old, new.limit(0), ["k"])) == sorted(OLD, key=repr)
    assert got(merge.upsert(old.limit(0), new, ["k"])) == sorted(NEW[:4], key=repr)
    keys = spark.createDataFrame([("a",), ("",), (None,), ("zz",), ("a",)], "k string")
    assert got(merge.delete(old, keys, ["k"])) == want(*OLD[1:3])


def test_adding_deltas_is_a_recomputation(spark):
    rng = random.Random(1)
    data = [(rng.choice(["x", "y", None]), rng.randrange(3), rng.randrange(1, 100)) for _ in range(200)]
    df = spark.createDataFrame(data, "b string, d int, amount int")
    agg = lambda x: x.groupBy("b", "d").agg(F.sum("amount").alias("s"), F.count("*").alias("n"))
    total = agg(df.limit(0))
    for i in range(3):
        total = merge.add_up(total, agg(df.filter(F.pmod("amount", F.lit(3)) == i)), ["b", "d"], ["s", "n"])
    assert rows(total) == rows(agg(df))


# Joins.


def test_enrich_and_misses(spark):
    events = spark.createDataFrame([(1, "A"), (2, " A"), (3, None), (4, "Z"), (5, "a")], "id int, k string").withColumn("name", F.lit("mine"))
    dim = spark.createDataFrame([("A", "first"), (None, "null")], "k string, name string")
    exact = joins.enrich(events, dim, "k", ["name"])
    assert rows(exact.filter("matched").select("id", "name")) == [(1, "first")]
    trimmed = joins.enrich(events, dim, "k", ["name"], trim=True)
    assert rows(trimmed.filter("matched").select("id", "k")) == [(1, "A"), (2, " A")]
    lost = joins.misses(exact, dim, "NO", "EMPTY", F.lit("r"))
    assert rows(lost.select("id", "error_code")) == [(2, "NO"), (3, "NO"), (4, "NO"), (5, "NO")]
    none = dim.limit(0)
    assert {r.error_code for r in joins.misses(joins.enrich(events, none, "k", ["name"]), none, "NO", "EMPTY", F.lit("r")).collect()} == {"EMPTY"}


@pytest.mark.parametrize("seed", range(3))
def test_interval_joins_against_brute_force(spark, seed):
    rng = random.Random(seed)
    key = lambda: None if rng.random() < 0.05 else "hot" if rng.random() < 0.5 else f"k{rng.randrange(4)}"
    left = [(i, key(), None if rng.random() < 0.05 else rng.randrange(200)) for i in range(60)]
    right = [(i, key(), None if rng.random() < 0.05 else rng.randrange(200)) for i in range(80)]
    a, b = spark.createDataFrame(left, "id int, k string, t long"), spark.createDataFrame(right, "rid int, k string, t long")
    before, after = rng.choice([(0, 7), (5, 5), (0, 0), (3, 20)])
    fit = lambda x: [y for y in right if None not in (x[1], x[2], y[1], y[2]) and x[1] == y[1] and x[2] - before <= y[2] <= x[2] + after]
    want = [(x[0], y[0]) for x in left for y in fit(x)] + [(x[0], None) for x in left if not fit(x)]
    assert rows(joins.interval_join(a, b, "k", "id", "t", "t", before, after).select("id", "rid")) == sorted(want, key=repr)
    assert rows(joins.interval_join(a, b, "k", "id", "t", "t", before, after, "inner").select("id", "rid")) == sorted([w for w in want if w[1] is not None], key=repr)
    if not before:
        first = [(x[0], min(fit(x), key=lambda y: (y[2], y[0]))[0] if fit(x) else None) for x in left]
        assert rows(joins.first_match(a, b, "k", "id", "t", "t", after, "rid").select("id", "rid")) == sorted(first, key=repr)


def test_full_outer_window_rules(spark):
    a = spark.createDataFrame([("a", "c", 0), ("a", "c", 1000), ("b", "x", 5)], "id string, k string, t long")
    b = spark.createDataFrame([("c", "c", 10), ("c", "c", 5000), ("y", "y", 1)], "rid string, k string, t long")
    pair = ("a", 0, "c", 10)
    by_id = joins.full_outer_window(a, b, "k", "id", "rid", "t", "t", 30)
    assert rows(by_id.select("left_id", "lt", "right_id", "rt")) == sorted([pair, ("b", 5, None, None), (None, None, "y", 1)], key=repr)
    by_row = joins.full_outer_window(a, b, "k", "id", "rid", "t", "t", 30, by_id=False)
    assert rows(by_row.select("left_id", "lt", "right_id", "rt")) == sorted([pair, ("a", 1000, None, None), ("b", 5, None, None), (None, None, "c", 5000), (None, None, "y", 1)], key=repr)


# Totals.


def test_signed_totals(spark):
    image = lambda b, amount, kind: '{"B":%s,"A":%s,"K":%s}' % (b, amount, kind)
    data = [
        ("c", None, image('"b1"', 10, '"CREDIT_TRANSFER"')),
        ("r", None, image('"b1"', 5, "null")),
        ("u", image('"b1"', 4, '"X"'), image('"b1"', 400, '"X"')),
        ("u", None, image('"b1"', 7, '"X"')),
        ("d", image('"b1"', 1, '"X"'), None),
        ("c", None, image("null", 3, '"X"')),
        ("c", None, image('"b2"', "null", '"X"')),
    ]
    df = spark.createDataFrame(data, "op string, before string, after string")
    kind = T.StructType().add("B", "string").add("A", "decimal(18,2)").add("K", "string")
    credit = F.col("K").contains("CREDIT")
    got = aggregates.signed_totals(aggregates.signed(df, kind, ["B", "A"]), ["B"], "A", {"credit": credit, "debit": ~credit})
    assert [tuple(map(str, r)) for r in got.collect()] == [("b1", "11.00", "1", "10.00", "-4.00")]


def test_distribution_and_ages(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 101)] + [(None,)], "v double")
    assert rows(aggregates.distribution(df, F.col("v"))) == [(100, 50.5, 50.5, 95.05, 100.0)]
    at = dt.datetime(2026, 1, 2)
    since = [at - dt.timedelta(minutes=m) for m in (0, 59, 60, 360, 1440, 4320, 9999)] + [None]
    ages = aggregates.age_buckets(spark.createDataFrame([(x,) for x in since], "t timestamp_ntz"), "t", F.lit("2026-01-02").cast("timestamp"), (1, 6, 24, 72))
    assert rows(ages) == [(0, 2), (1, 1), (2, 1), (3, 1), (4, 2)]


@pytest.mark.parametrize("discrete", [False, True])
def test_percentiles_against_sorting(spark, discrete):
    rng = random.Random(6)
    data = [(rng.choice(["a", "b", None]), rng.choice([rng.uniform(-50, 50), float(rng.randrange(4)), 3e11, None])) for _ in range(700)] + [("one", 4.25), ("none", None)]
    shares = (0.0, 0.31, 0.5, 0.95, 1.0)
    got = aggregates.percentiles(spark.createDataFrame(data, "g string, v double"), F.col("v"), ["g"], shares, discrete)
    want = {}
    for g in {g for g, v in data if v is not None}:
        values = sorted(round(v, 6) for k, v in data if k == g and v is not None)
        if discrete:
            want[g] = [values[max(0, math.ceil(s * len(values)) - 1)] for s in shares]
        else:
            at = [s * (len(values) - 1) for s in shares]
            want[g] = [values[int(p)] + (values[math.ceil(p)] - values[int(p)]) * (p - int(p)) for p in at]
    assert {r[0]: list(r[1:]) for r in got.collect()} == {g: pytest.approx(v, abs=2e-6) for g, v in want.items()}
    nothing = aggregates.distribution(spark.createDataFrame([(None,)], "v double"), F.col("v"), discrete=discrete)
    assert rows(nothing) == [(0, None, None, None, None)]


# Dead letters.


def test_a_runner_comes_to_the_same_as_its_rounds(spark):
    """Rounds of tries at every minute a try is due, against the closed form, at many stops."""
    schedule, most, base = (5, 15, 60, 240, 1440), 5, dt.datetime(2026, 1, 1)
    clock = lambda m: F.lit(base + dt.timedelta(minutes=m)).cast("timestamp")
    misses = spark.createDataFrame([("a", "known"), ("b", "lost")], "id string, key string")
    known = spark.createDataFrame([("known",)], "key string")
    entries, at = deadletter.pend(misses, clock(0), schedule), 0
    names = ["id", "status", "retry_count", "next_retry_at", "resolved_at"]
    for due in (5, 20, 80, 320, 1760, 3200):
        for stop in (due - 1, due):
            if stop == due:
                entries = spark.createDataFrame(deadletter.retry(entries, known, "key", clock(due), schedule, most).collect(), entries.schema)
            closed = deadletter.run_until(misses, clock(0), F.col("key") == "known", clock(stop), schedule, most)
            kept = entries.select(*names).collect()
            shown = [(*r[:3], r.next_retry_at if r.status == "PENDING" else r.resolved_at) for r in kept]
            assert [(*r[:3], r.next_retry_at) for r in closed.select(*names).collect()] == shown, stop


def test_retries_out_of_turn_trimmed_and_without_partners(spark):
    clock = lambda m: F.lit(dt.datetime(2026, 1, 1) + dt.timedelta(minutes=m)).cast("timestamp")
    fresh = deadletter.pend(spark.createDataFrame([(1, " k "), (2, "other"), (3, None)], "id int, key string"), clock(0), (5, 15))
    dim = spark.createDataFrame([("k", "first"), (None, "null")], "key string, name string")
    go = lambda **how: rows(deadletter.retry(fresh, dim, "key", clock(1), (5, 15), 2, **how).select("id", "status", "retry_count"))
    assert go() == [(1, "PENDING", 0), (2, "PENDING", 0), (3, "PENDING", 0)]
    assert go(ignore_wait=True, trim=True) == [(1, "RESOLVED", 0), (2, "PENDING", 1), (3, "PENDING", 1)]
    assert go(ignore_wait=True, skip_if_none=True) == [(1, "PENDING", 0), (2, "PENDING", 0), (3, "PENDING", 0)]
    assert go(ignore_wait=True, trim=True, skip_if_none=True) == go(ignore_wait=True, trim=True)
    out = deadletter.retry(fresh, dim, "key", clock(1), (5, 15), 2, ignore_wait=True)
    assert rows(out.select("id", "next_retry_at")) == rows(fresh.select("id", "next_retry_at"))
    got = deadletter.recovered(fresh, dim, "key", ["name"], clock(5), trim=True, constants={"approximate": F.lit(1)})
    assert got.columns == ["id", "key", "name", "approximate"] and rows(got) == [(1, " k ", "first", 1)]
    assert deadletter.recovered(fresh, dim, "key", ["name"], clock(4), trim=True).count() == 0


def test_cleanup_counts_are_what_expire_removes(spark):
    clock = lambda d: F.lit(dt.datetime(2026, 1, 1) + dt.timedelta(days=d)).cast("timestamp")
    entries = spark.createDataFrame([(s, e, dt.datetime(2026, 1, 1) + dt.timedelta(days=d)) for s, e, d in (("RESOLVED", "A", 0), ("RESOLVED", "A", 5), ("FAILED", "B", 0), ("PENDING", "B", 0), ("PENDING", None, 0))], "status string, error_code string, resolved_at timestamp")
    got = deadletter.cleanup_counts({"t": entries, "empty": entries.limit(0)}, clock(8), 7)
    assert rows(got) == [("t", "eligible", "FAILED", 1), ("t", "eligible", "RESOLVED", 1), ("t", "pending", "B", 1), ("t", "pending", None, 1)]
    assert entries.count() - deadletter.expire(entries, clock(8), 7).count() == 2
    with pytest.raises(ValueError):
        deadletter.cleanup_counts({"t": entries}, clock(8), 0)



def test_dead_letters_live_through_their_states(spark):
    schedule, most = (5, 15, 60, 240, 1440), 5
    clock = lambda m: F.lit(dt.datetime(2026, 1, 1) + dt.timedelta(minutes=m)).cast("timestamp")
    entries = deadletter.pend(spark.createDataFrame([("a", "k")], "id string, key string"), clock(0), schedule)
    other, known = spark.createDataFrame([("other",)], "key string"), spark.createDataFrame([("k",)], "key string")
    now, tries = 0, []
    for wait in (5, 15, 60, 240, 1440, 1440):
        assert deadletter.due(entries, clock(now + wait - 1)).count() == 0
        now += wait
        kept = spark.createDataFrame(deadletter.retry(entries, other, "key", clock(now), schedule, most).collect(), entries.schema)
        entries = kept
        tries.append((kept.first().status, kept.first().retry_count))
    assert tries == [("PENDING", 1), ("PENDING", 2), ("PENDING", 3), ("PENDING", 4), ("PENDING", 5), ("FAILED", 6)]
    fresh = deadletter.pend(spark.createDataFrame([("a", "k"), ("b", None)], "id string, key string"), clock(0), schedule)
    assert rows(deadletter.retry(fresh, known, "key", clock(5), schedule, most).select("id", "status", "retry_count")) == [("a", "RESOLVED", 0), ("b", "PENDING", 1)]
    assert rows(deadletter.retry(fresh, known.limit(0), "key", clock(5), schedule, most).select("status", "retry_count")) == [("PENDING", 0)] * 2
    assert rows(deadletter.retry(fresh, known, "key", clock(4), schedule, most).select("status")) == [("PENDING",)] * 2
    assert deadletter.retry(fresh, known, "key", clock(4), schedule, most, ignore_wait=True).filter("status = 'RESOLVED'").count() == 1
    assert deadletter.expire(entries, clock(now + 8 * 1440), 7).count() == 0 and deadletter.expire(fresh, clock(10**6), 7).count() == 2
    with pytest.raises(ValueError):
        deadletter.expire(entries, clock(0), 0)


# Mappings, conversions, schemas, configuration.


def test_mapping_language(spark):
    df = spark.createDataFrame([("x", None, -2)], "a string, b string, n int")
    got = mapping.apply_mapping(df, {"A": "UPPER(a)", "B": "SELECT coalesce(b, a, 'UPPERCASE(')", "N": "ABS(n)", "a": "a", "gone": None})
    assert got.columns == ["A", "B", "N", "a"] and rows(got) == [("X", "x", 2, "x")]
    with pytest.raises(ValueError, match="reflect"):
        mapping.expression("reflect('java.lang.Runtime', 'x')")


def test_conversions(spark):
    df = spark.createDataFrame([("1700000000123", "12.345", "x")], "ms string, n string, bad string")
    c = mapping.convert
    got = df.select(c(F.col("ms"), "DATE"), c(F.col("ms"), "TIMESTAMP(6)").cast("string"), c(F.concat("ms", F.lit("000")), "timestamp", "us").cast("string"), c(F.col("n"), "NUMBER(10,2)"), c(F.col("bad"), "INTEGER"), c(F.col("bad"), "DATE"), c(F.col("bad"), "VARCHAR2(5)")).first()
    assert [str(x) for x in got] == ["2023-11-14", "2023-11-14 22:13:20.123", "2023-11-14 22:13:20.123", "12.35", "None", "None", "x"]


def test_ddl():
    found = ddl.parse("""
      -- a comment, with (parentheses)
      CREATE TABLE S.A_TARGET (ID VARCHAR2(50 CHAR) PRIMARY KEY, BAL NUMBER(18,2) NOT NULL, AT TIMESTAMP(6) DEFAULT now(), D DATE);
      CREATE TABLE B (X VARCHAR2(5), Y DATE, N NUMBER(15), F NUMBER(1) DEFAULT 0, CONSTRAINT PK PRIMARY KEY (X, Y));""")
    assert found["A_TARGET"].key == ("ID",) and found["B"].key == ("X", "Y")
    assert found["A_TARGET"].schema.simpleString() == "struct<ID:string,BAL:decimal(18,2),AT:timestamp,D:date>"
    assert not found["A_TARGET"].schema["BAL"].nullable and found["B"].schema["N"].dataType == T.DecimalType(15, 0)


def test_specs(caplog):
    text = """
defaults: {topic_prefix: feed.S, checkpoint_base: /c/, trigger_seconds: 9}
tables:
  - {job_name: one, topic_suffix: A, target_table: A_TARGET, key: ID, time_column: AT, source_schema: {SRC_ID: VARCHAR2, AT: TIMESTAMP, N: "NUMBER(10,2)"}, mapping: {ID: SRC_ID, N: ABS(N), AT: null}}
  - {job_name: off, enabled: false, topic: t, target_table: X, key: K, source_schema: {K: NUMBER}}
  - {job_name: lacking, topic: t, key: K, source_schema: {K: NUMBER}}
  - {job_name: wrong, topic: t, target_table: X, key: K, source_schema: {K: NUMBER}, mapping: {K: NOSUCH(K)}}
"""
    found = specs.load(text)
    assert [s.job_name for s in found] == ["one"]
    assert found[0].topic == "feed.S.A" and found[0].checkpoint == "/c/one" and found[0].settings["trigger_seconds"] == 9
    assert found[0].source_key == "SRC_ID" and found[0].row_type.simpleString() == "struct<SRC_ID:string,AT:bigint,N:decimal(10,2)>"
    assert "lacking" in caplog.text and "NOSUCH" in caplog.text
    assert specs.checkpoints(found) == ["/c/one"] and specs.load("") == []


def test_generator(spark):
    one, many = generator.transactions(spark, 500, parts=1), generator.transactions(spark, 500, parts=7)
    assert rows(one) == rows(many)
    assert one.select("transaction_id").distinct().count() == 500
    r = one.agg(F.min("amount"), F.max("amount"), F.min("transaction_date"), F.max("transaction_date"), F.count_distinct("branch_code")).first()
    assert r[0] >= 10_000 and r[1] <= 500_000_000 and str(r[2]) >= "2024-01-01" and r[4] == 20


def test_messages_keep_tombstones(spark):
    df = spark.createDataFrame([(None, None, None, None, "k", 0, 1), ("c", None, "{}", "5", "k", 0, 2)], "op string, before string, after string, ts_ms string, msg_key string, kafka_partition int, kafka_offset long")
    got = feeds.as_messages(df).orderBy("offset").collect()
    assert got[0].value is None and '"op":"c"' in got[1].value
