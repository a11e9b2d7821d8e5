"""Edge cases of the operators for the general problems, against plain Python."""

from __future__ import annotations

import datetime as dt
import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators import bitemporal, dedup, diff, history, late, replay, skew


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# Replay.

FEED = "op string, before string, after string, ts_ms string, source_scn long, msg_key string, note string"


def change(op, key, scn, ts, after=True, before=None, note=None):
    image = json.dumps({"TRANSACTION_ID": key, "N": scn})
    return (op, before, image if after is True and op != "d" else after or None, str(ts), scn, key, note)


def state(spark, feed, **how):
    prepared = replay.prepare(spark.createDataFrame(feed, FEED), "msg_key", "source_scn")
    return {r.key: r.transaction for r in replay.replay(prepared, **how).collect()}


def test_replay_any_order_and_copies(spark):
    feed = [change("c", "a", 1, 10), change("u", "a", 2, 20), change("c", "b", 3, 20), change("d", "b", 4, 30), change("c", "b", 5, 40), change("r", "c", 6, 5), change("d", "c", 7, 6), change("u", "only", 8, 7)]
    feed += [(None, None, None, None, None, "a", None), ("m", None, None, "5", None, None, None)]
    want = {"a": 2, "b": 5, "only": 8}
    for seed in range(3):
        shuffled = feed * 3
        random.Random(seed).shuffle(shuffled)
        assert state(spark, shuffled) == want


def test_replay_orders_time_as_a_number_then_commit(spark):
    assert state(spark, [change("c", "a", 1, 9), change("u", "a", 2, 10)]) == {"a": 2}
    assert state(spark, [change("u", "a", 8, 10), change("c", "a", 7, 10)]) == {"a": 8}


def test_replay_holds_before_a_damaged_change(spark):
    broken = change("u", "b", 3, 30, after='{"TRANSACTION_ID":"b","N"')
    feed = [change("c", "a", 1, 10), change("c", "b", 2, 20), broken, change("u", "a", 4, 40)]
    assert state(spark, feed) == {"a": 1, "b": 2}
    assert state(spark, [*feed, change("u", "b", 3, 30)]) == {"a": 4, "b": 3}


def test_replay_waits_for_announced_changes_and_numbers(spark):
    feed = [change("c", "a", 1, 10), change("c", "b", 2, 20), change("c", "c", 2, 20), change("c", "d", 3, 30)]
    prepared = replay.prepare(spark.createDataFrame(feed, FEED), "msg_key", "source_scn")
    sizes = F.when(F.col("transaction") == 2, 3)
    held = replay.replay(prepared, replay.assemble(prepared, sizes))
    assert [r.key for r in held.collect()] == ["a"]
    assert replay.first_gap(prepared, "transaction", 1) == 4
    gap = replay.replay(prepared, sequence_gap=F.lit(replay.first_gap(prepared.filter("transaction <> 2"), "transaction", 1)))
    assert [r.key for r in gap.collect()] == ["a"]


def in_one_transaction(spark, feed, ordinal=None, size=None, **how):
    """The keys and ops after a feed of (op, key, commit, n, whole), all of a commit at one time."""
    image = lambda n, whole: '{"N":%d}' % n if whole else '{"N"'
    data = [(op, None if op == "c" else image(n - 1, whole or op != "d"), None if op == "d" else image(n, whole), "5", scn, key, n) for op, key, scn, n, whole in feed]
    prepared = replay.prepare(spark.createDataFrame(data, "op string, before string, after string, ts_ms string, source_scn long, msg_key string, n int"), "msg_key", "source_scn", ordinal=ordinal)
    done = replay.assemble(prepared, None if size is None else F.lit(size))
    return {(r.key, r.op) for r in replay.replay(prepared, done, **how).collect()}, sorted((r.changes, r.complete) for r in done.collect())


@pytest.mark.parametrize("ordinal", [None, "n"])
def test_replay_of_several_changes_of_a_key_in_one_transaction(spark, ordinal):
    life = [("c", "a", 1, 1, True), ("u", "a", 1, 2, True), ("d", "a", 1, 3, True)]
    for seed in range(3):
        shuffled = life * 2
        random.Random(seed).shuffle(shuffled)
        assert in_one_transaction(spark, shuffled, ordinal) == (set(), [(3, True)])
        assert in_one_transaction(spark, shuffled, ordinal, size=3, keep_deleted=True) == ({("a", "d")}, [(3, True)])
    assert in_one_transaction(spark, life[:2], ordinal, size=3) == (set(), [(2, False)])
    assert in_one_transaction(spark, life[:2], ordinal) == ({("a", "u")}, [(2, True)])
    damaged = [*life[:2], ("u", "a", 1, 2, False)]
    assert in_one_transaction(spark, damaged, ordinal, size=2) == ({("a", "u")}, [(2, True)])
    assert in_one_transaction(spark, damaged, ordinal, size=3) == (set(), [(2, False)])
    assert in_one_transaction(spark, [life[0], ("u", "a", 1, 2, False)], ordinal) == (set(), [(2, False)])


def test_replay_ordinal_decides_where_a_row_is_written_anew(spark):
    again = [("d", "a", 1, 1, True), ("c", "a", 1, 2, True), ("u", "a", 1, 3, True), ("u", "a", 1, 4, True)]
    assert in_one_transaction(spark, again, "n", size=4) == ({("a", "u")}, [(4, True)])
    assert in_one_transaction(spark, again[:2], "n") == ({("a", "c")}, [(2, True)])


@pytest.mark.parametrize("missing", [1, 2, 17, 100, 999, 1000])
def test_first_gap(spark, missing):
    numbers = spark.range(1, 1001).filter(F.col("id") != missing)
    assert replay.first_gap(numbers.union(numbers), "id", 1, buckets=7) == missing
    assert replay.first_gap(spark.range(0), "id", 5) == 5


def test_replay_without_place_or_rows(spark):
    feed = [change("c", None, 1, 10), change("c", "a", None, 10), ("c", None, "{}", "soon", 3, "a", None)]
    assert state(spark, feed) == {}
    assert state(spark, []) == {}
    assert [r.key for r in replay.replay(replay.prepare(spark.createDataFrame([change("d", "x", 1, 1)], FEED), "msg_key", "source_scn"), keep_deleted=True).collect()] == ["x"]


# Late records.


def test_late_borders_and_merge(spark):
    day, end = dt.date(2026, 1, 1), 1767312000000
    at = [end - 1, end, end + 72 * 3_600_000 - 1, end + 72 * 3_600_000, None]
    data = [(day, t, 10, "x") for t in at] + [(None, end, 1, "x"), (day, end, None, None)]
    records = spark.createDataFrame(data, "d date, t long, amount int, g string").withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    admitted = late.admit(records, "d", "t")
    assert [r.lateness for r in admitted.orderBy(F.monotonically_increasing_id()).collect()][:5] == ["on_time", "late", "late", "too_late", None]
    whole = late.combine(late.partials(admitted, ["d", "g"], "amount"), ["d", "g"])
    assert rows(whole.filter("g = 'x'").select("n", "late_n", "refused_n")) == [(3, 2, 1)]
    assert rows(whole.filter("g is null").select("n", "late_n")) == [(1, 1)]
    parts = [late.partials(admitted.filter(F.pmod(F.xxhash64("t"), F.lit(3)) == i), ["d", "g"], "amount") for i in range(3)]
    assert rows(late.combine(late.merge(*parts, groups=["d", "g"]), ["d", "g"])) == rows(whole)
    assert late.combine(late.partials(admitted.limit(0), ["d", "g"], "amount"), ["d", "g"]).count() == 0
    assert rows(late.combine(late.partials(admitted, ["d", "g"], "amount"), ["d", "g"], as_of_batch=end // late.DAY_MS - 1).select("n", "late_n")) == [(1, 0)]


def test_late_records_come_from_the_store(spark):
    """Batches of half a day, null groups and records without a period, against classifying each record."""
    rng, day0 = random.Random(8), dt.date(2026, 1, 1)
    base = 1767225600000
    data = [(i, None if rng.random() < 0.05 else day0 + dt.timedelta(days=rng.randrange(3)), None if rng.random() < 0.05 else base + rng.randrange(8 * late.DAY_MS), rng.choice([None, "x", "y"])) for i in range(400)]
    data += [(1000 + i, day0, base + late.DAY_MS + t, "x") for i, t in enumerate((-1, 0, 1, 72 * 3_600_000 - 1, 72 * 3_600_000))]
    df = spark.createDataFrame(data, "i int, d date, t long, g string").withColumn("amount", F.lit(1).cast("decimal(18,2)"))
    half = late.DAY_MS // 2
    batches = late.placed(df, "d", "t", half)
    store = late.partials_of_batches(batches, "d", ["g"], "amount", 72, half)
    got = late.records_of(store.filter(F.col("lateness") != late.ON_TIME), batches, "d", ["g"])
    admitted = late.admit(df, "d", "t", 72, half)
    assert rows(got.select("i", "lateness")) == rows(admitted.filter("lateness in ('late', 'too_late')").select("i", "lateness"))
    assert rows(store.select("d", "g", "arrival_batch", "lateness", "n")) == rows(late.partials(admitted, ["d", "g"], "amount").select("d", "g", "arrival_batch", "lateness", "n"))
    assert late.records_of(store.limit(0), batches, "d", ["g"]).count() == 0
    with pytest.raises(ValueError):
        late.partials_of_batches(batches, "d", ["g"], "amount", 72, 7 * 3_600_000)


# Skew.


def test_shares_below_the_sketch_are_counted(spark):
    df = spark.range(30_000).select(F.when(F.col("id") < 3, "few").otherwise(F.col("id").cast("string")).alias("k"))
    share = 2.5 / 30_000
    assert share < skew.least_share()
    assert rows(skew.heavy_keys(df, "k", share)) == [("few", 3, 30_000)]
    with pytest.raises(ValueError):
        skew.candidates(df, ["k"], share)


def test_heavy_values_of_several_keys_in_one_pass(spark):
    df = spark.createDataFrame([(1 if i < 60 else i, "x" if i % 2 else None, 2.5) for i in range(100)], "a long, b string, c double")
    got = skew.heavy(df, ["a", "b", "c"], 0.3)
    assert rows(got) == [("a", "1", 60, 100), ("b", "x", 50, 100), ("c", "2.5", 100, 100)]
    assert skew.heavy(df.limit(0), ["a", "b"], 0.3).count() == 0


def test_wide_partners_are_not_broadcast(spark):
    left = spark.createDataFrame([("hot", i) for i in range(60)] + [(f"k{i}", i) for i in range(9)], "k string, v int")
    wide = spark.createDataFrame([("hot", "y" * 5000)], "k string, w string")
    plan = lambda most: skew.join_by_key(left, wide, "k", 0.2, most_broadcast=most)._jdf.queryExecution().optimizedPlan().toString()
    assert skew.measured_bytes(wide) > 5000
    assert "__salt" in plan(4000) and "__salt" not in plan(6000)
    assert skew.join_by_key(left, wide, "k", 0.2, most_broadcast=4000).count() == 60


def test_heavy_keys_are_exact(spark):
    data = [("a",)] * 50 + [("b",)] * 2 + [(None,)] * 8 + [(f"k{i}",) for i in range(40)]
    df = spark.createDataFrame(data, "k string")
    assert rows(skew.heavy_keys(df, "k", 0.02).select("k", "n_rows", "n_all")) == [("a", 50, 100), ("b", 2, 100)]
    assert skew.heavy_keys(df.limit(0), "k", 0.02).count() == 0


def test_aggregate_by_key_is_a_plain_aggregate(spark):
    rng = random.Random(3)
    data = [(None if rng.random() < 0.1 else "hot" if rng.random() < 0.4 else f"k{rng.randrange(60)}", rng.randrange(9), i) for i in range(2000)]
    df = spark.createDataFrame(data, "k string, heavy int, i int")
    got = skew.aggregate_by_key(df, "k", 0.05, [F.count("*").alias("n"), F.sum("i").alias("s"), F.max_by("i", F.struct("heavy", "i")).alias("m")])
    assert rows(got.drop("heavy")) == rows(df.groupBy("k").agg(F.count("*"), F.sum("i"), F.max_by("i", F.struct("heavy", "i"))))
    assert rows(got.filter("heavy").select("k")) == [("hot",)]


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("most", [100_000, 1])
def test_join_by_key_is_a_plain_join(spark, how, most):
    left = spark.createDataFrame([("hot", i) for i in range(50)] + [(f"k{i % 7}", i) for i in range(50)] + [(None, 1), ("none", 2)], "k string, v int")
    right = spark.createDataFrame([("hot", 1), ("hot", 2)] + [(f"k{i}", i) for i in range(7)] + [(None, 3)], "k string, v int")
    got = skew.join_by_key(left, right, "k", 0.1, how, most_broadcast=most)
    assert rows(got.select("k", "v", "v_right")) == rows(left.join(right.withColumnRenamed("v", "w"), "k", how).select("k", "v", "w"))


# Copies.


def test_keep_first_and_redelivered_share_the_rows(spark):
    data = [("a", 2, 5, "x"), ("a", 1, 9, "y"), ("a", 1, 4, "z"), ("b", None, 3, None), ("b", 7, 1, "q"), (None, 1, 2, "n"), (None, 1, 2, "n"), ("c", 1, 8, "c"), ("c", 1, 8, "c")]
    df = spark.createDataFrame(data, "id string, at int, off int, `v 0` string")
    kept = dedup.keep_first(df, ["id"], ["at", "off"])
    assert kept.columns == df.columns
    assert rows(kept) == sorted([("a", 1, 4, "z"), ("b", 7, 1, "q"), ("c", 1, 8, "c"), (None, 1, 2, "n"), (None, 1, 2, "n")], key=repr)
    surplus = dedup.redelivered(df, ["id"], "off", ["at", "off"])
    assert Counter(r.off for r in surplus.collect()) == Counter([5, 9, 3, 8])
    assert rows(dedup.keep_last(df, ["id"], ["at", "off"])) == [("a", 2, 5, "x"), ("b", 7, 1, "q"), ("c", 1, 8, "c")]
    assert dedup.keep_first(df.limit(0), ["id"], ["at"]).count() == 0


def test_ties_do_not_depend_on_input_order(spark):
    data = [("a", 1, f"v{i}") for i in range(20)]
    picks = set()
    for seed in range(4):
        random.Random(seed).shuffle(data)
        picks.add(dedup.keep_first(spark.createDataFrame(data, "id string, at int, v string").repartition(3), ["id"], ["at"]).first().v)
    assert len(picks) == 1


def test_redelivered_uses_hash_aggregation(spark):
    df = spark.createDataFrame([("a", 1)], "id string, off long")
    plan = dedup.redelivered(df, ["id"], "off", ["off"])._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate(keys=[id" in plan and "SortAggregate" not in plan


@pytest.mark.parametrize("order", [["at", "off"], ["on", "at", "off"], ["off2", "at", "off"]])
def test_redelivered_for_any_order(spark, order):
    """Times, dates and 64-bit numbers with nulls; orders beyond one packed number too. Against sorting, and always by hash aggregation."""
    rng, base = random.Random(len(order)), dt.datetime(2026, 1, 1)
    some = lambda x: None if rng.random() < 0.2 else x
    data = [(f"k{rng.randrange(40)}", some(base + dt.timedelta(microseconds=rng.randrange(3))), some(base.date() - dt.timedelta(days=rng.randrange(3))), some(rng.choice([-(2**63), 2**63 - 1, 0])), i - 150) for i in range(300)]
    df = spark.createDataFrame(data, "id string, at timestamp, on date, off2 long, off long")
    names = ["id", "at", "on", "off2", "off"]
    place = lambda r: [(r[names.index(c)] is None, r[names.index(c)] or 0) if r[names.index(c)] is not None else (True, 0) for c in order]
    kept = {}
    for r in data:
        if r[0] not in kept or place(r) < place(kept[r[0]]):
            kept[r[0]] = r
    got = dedup.redelivered(df, ["id"], "off", order)
    assert sorted(r.off for r in got.collect()) == sorted(r[4] for r in data if kept[r[0]] is not r)
    assert rows(dedup.keep_first(df, ["id"], order)) == sorted(kept.values(), key=repr)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate(keys=[id" in plan and "SortAggregate" not in plan


def test_redelivered_wants_numbers_and_times(spark):
    with pytest.raises(TypeError, match="string"):
        dedup.redelivered(spark.createDataFrame([("a", "b", 1)], "id string, s string, off long"), ["id"], "off", ["s", "off"])


def test_first_values_are_those_of_the_first_row(spark):
    data = [("a", 3, 1, None), ("a", 1, None, 2.5), ("b", 2, 7, 1.0), (None, 1, 1, 1.0)]
    df = spark.createDataFrame(data, "id string, off long, n int, x double")
    got = dedup.first_values(df, ["id"], ["off"], ["n", "x"])
    assert rows(got) == [("a", None, 2.5), ("b", 7, 1.0)]
    assert "SortAggregate" not in got._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        dedup.first_values(df, ["id"], ["off", "off"], ["n"])


def test_keep_first_with_columns_that_have_no_order(spark):
    df = spark.createDataFrame([("a", 2, {"x": 1}), ("a", 1, {"y": 2}), ("b", None, None)], "id string, at int, m map<string,int>")
    assert rows(dedup.keep_first(df, ["id"], ["at"])) == [("a", 1, {"y": 2}), ("b", None, None)]
    assert rows(dedup.keep_last(df, ["id"], ["at"])) == [("a", 2, {"x": 1}), ("b", None, None)]


# Attributes as known.


def test_rectangles_are_disjoint_and_whole(spark):
    """Every point of a small plane is in exactly one rectangle, that of the best version known there, or in none."""
    rng = random.Random(4)
    for many in (1, 2, 7, 30):
        placed = [(rng.randrange(6), rng.randrange(6), i) for i in range(many)]
        df = spark.createDataFrame([([(r, v, (v, r, i)) for r, v, i in placed],)], "placed array<struct<recorded:bigint,valid:bigint,version:struct<valid:bigint,recorded:bigint,tie:int>>>")
        rects = df.select(bitemporal._rectangles(F.col("placed"), "struct<valid:bigint,recorded:bigint,tie:int>")).first()[0]
        assert len(rects) <= 2 * many
        for v in range(7):
            for r in range(7):
                inside = [x.version.tie for x in rects if x.left <= v < x.right and x.low <= r < x.high]
                fit = [(pv, pr, i) for pr, pv, i in placed if pv <= v and pr <= r]
                assert inside == ([max(fit)[2]] if fit else [])


@pytest.mark.parametrize("seed", range(3))
def test_as_known_off_the_diagonal(spark, seed):
    rng = random.Random(seed)
    base = dt.datetime(2026, 1, 1)
    when = lambda: None if rng.random() < 0.03 else base + dt.timedelta(hours=rng.randrange(300))
    key = lambda: None if rng.random() < 0.03 else "hot" if rng.random() < 0.6 else f"e{rng.randrange(5)}"
    versions = [(i, key(), when(), when()) for i in range(150)]
    events = [(i, key(), when(), when()) for i in range(300)] + [(900, "hot", base - dt.timedelta(days=9), base), (901, "hot", base + dt.timedelta(days=900), base + dt.timedelta(days=9))]
    v = spark.createDataFrame(versions, "id long, e string, valid timestamp_ntz, seen timestamp_ntz")
    e = spark.createDataFrame(events, "n long, e string, t timestamp_ntz, k timestamp_ntz")
    got = bitemporal.as_known(e, v, "e", "t", "valid", "seen", "id", ["id"], known_time="k", cell_micros=3_600_000_000 * rng.choice([3, 50, 5000]), heavy_share=0.2, per_cell=6, events_per_cell=rng.choice([5, 1000]))
    want = []
    for n, k, t, known in events:
        fit = [x for x in versions if None not in (k, t, known, x[2], x[3]) and x[1] == k and x[2] <= t and x[3] <= known]
        want += [(n, max(fit, key=lambda x: (x[2], x[3], x[0]))[0])] if fit else []
    assert rows(got.select("n", "id")) == sorted(want, key=repr)


def test_entities_heavy_in_events_or_versions_get_a_finer_grid(spark):
    entities = lambda counts: spark.createDataFrame([(e,) for e, n in counts.items() for _ in range(n)], "entity string")
    versions, points = entities({"a": 2, "b": 80, "c": 2}), entities({"a": 800, "b": 10, "c": 10})
    got = bitemporal.cell_widths(versions, points, F.lit(1_000_000), 500_000, 0.1, 8, 100)
    assert rows(got) == [("a", 125_000), ("b", 100_000)]


@pytest.mark.parametrize("seed", range(4))
def test_as_known_against_brute_force(spark, seed):
    rng = random.Random(seed)
    base = dt.datetime(2026, 1, 1)
    when = lambda: None if rng.random() < 0.03 else base + dt.timedelta(hours=rng.randrange(400))
    key = lambda: None if rng.random() < 0.03 else "hot" if rng.random() < 0.5 else f"e{rng.randrange(5)}"
    versions = [(i // 2, key(), when(), when(), None if i % 5 == 0 else i) for i in range(200)]
    versions += versions[:20]
    events = [(i, key(), when(), "mine") for i in range(300)]
    v = spark.createDataFrame(versions, "id long, e string, valid timestamp_ntz, seen timestamp_ntz, balance int")
    e = spark.createDataFrame(events, "n long, e string, t timestamp_ntz, balance string")
    got = bitemporal.as_known(e, v, "e", "t", "valid", "seen", "id", ["balance", "id"], cell_micros=3_600_000_000 * rng.choice([1, 20, 1000]), heavy_share=0.2, per_cell=5)
    want = []
    for n, k, t, _ in events:
        fit = [x for x in versions if k is not None and t is not None and x[1] == k and x[2] and x[3] and x[2] <= t and x[3] <= t]
        if fit:
            best = max(fit, key=lambda x: (x[2], x[3], x[0], x[4] is not None, x[4] or 0))
            want.append((n, best[0]))
    assert rows(got.select("n", "id")) == sorted(want, key=repr)
    assert got.columns == ["n", "e", "t", "balance", "id"]


def test_as_known_at_the_border_and_empty(spark):
    t = dt.datetime(2026, 1, 1)
    v = spark.createDataFrame([(1, "a", t, t), (2, "a", t, t + dt.timedelta(microseconds=1))], "id long, e string, valid timestamp_ntz, seen timestamp_ntz")
    e = spark.createDataFrame([(1, "a", t), (2, "a", t + dt.timedelta(microseconds=1)), (3, "a", t - dt.timedelta(microseconds=1))], "n long, e string, t timestamp_ntz")
    known = lambda e, v: rows(bitemporal.as_known(e, v, "e", "t", "valid", "seen", "id", ["id"]).select("n", "id"))
    assert known(e, v) == [(1, 1), (2, 2)]
    assert known(e.limit(0), v) == [] and known(e, v.limit(0)) == []


# Differences.


def brute_diff(a, b, columns):
    a, b = dict(a), dict(b)
    out = [(k, "*", "missing_in_target") for k in a.keys() - b.keys()] + [(k, "*", "missing_in_source") for k in b.keys() - a.keys()]
    for k in a.keys() & b.keys():
        out += [(k, c, "differs") for c, x, y in zip(columns, a[k], b[k], strict=True) if x != y]
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("buckets", [1, 16, 512])
def test_differences_against_brute_force(spark, seed, buckets):
    rng = random.Random(seed)
    a = {(f"k{i}" if i else None): (rng.choice([None, 1, 2]), rng.choice([None, "", "x"])) for i in range(120)}
    b = {k: (v if rng.random() < 0.9 else (rng.choice([None, 1]), v[1])) for k, v in a.items() if rng.random() < 0.95} | {"new": (1, None), "": (2, "")}
    columns = ["n", "a.b"]
    schema = "k string, n int, `a.b` string"
    left = spark.createDataFrame([(k, *v) for k, v in a.items()] + [("k5", *a["k5"])], schema).withColumn("more", F.lit(1)).withColumn("off", F.monotonically_increasing_id())
    right = spark.createDataFrame([(k, *v) for k, v in b.items()], schema)
    want = brute_diff(a.items(), b.items(), columns)
    for settle in (None, diff.Settle(("off",)), diff.Settle(("off",), last=True)):
        for unique in (False, True):
            got = diff.differences(left, right, "k", buckets=buckets, settle=settle, unique_target=unique)
            assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_equal_buckets_are_not_joined(spark):
    a = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    b = a.withColumn("v", F.when(F.col("k") == "7", -1).otherwise(F.col("v")))
    keyed = [diff._keyed(x, "k", F.col("v")) for x in (a, b)]
    cells = diff.unequal_cells(*keyed, ["v"], 256).collect()
    assert len(cells) == 1 and cells[0]["columns"] == ["v"]
    assert diff.differences(a, a, "k").count() == 0
    assert diff.differences(a, a.limit(0), "k").count() == 1000
    assert rows(diff.differences(a.select("k"), b.select("k").filter("k <> '3'"), "k")) == [("3", "*", "missing_in_target")]


@pytest.mark.parametrize("most", [1, 1 << 30])
def test_unequal_buckets_are_split_again(spark, most):
    a = spark.range(3000).select(F.when(F.col("id") > 0, F.col("id").cast("string")).alias("k"), F.col("id").alias("v"), F.lit("x").alias("w"))
    b = a.filter("v <> 11").withColumn("v", F.when(F.col("v").isin(7, 0, 2900), -1).otherwise(F.col("v")))
    b = b.unionByName(spark.createDataFrame([("new", 1, "x")], b.schema))
    want = sorted([("7", "v", "differs"), (None, "v", "differs"), ("2900", "v", "differs"), ("11", "*", "missing_in_target"), ("new", "*", "missing_in_source")], key=repr)
    for settle in (None, diff.Settle(("v",))):
        got = diff.differences(a, b, "k", buckets=4, settle=settle, rows=3000, rows_per_bucket=16, most_broadcast=most)
        assert rows(got) == want
    keyed = [diff._keyed(x, "k", F.col("v"), F.col("w")) for x in (a, b)]
    cells = diff.unequal_cells(*keyed, ["v", "w"], 4)
    assert cells.count() >= 3  # most of the buckets, and so most of the rows
    parts = diff.unequal_parts(*keyed, ["v", "w"], 4, cells, 16)
    assert parts.count() == 5 and parts.filter("size(__unequal) = 1").count() == 3
    assert diff.differences(a, a, "k", buckets=4, rows=3000).count() == 0 and diff.differences(a.limit(0), a.limit(0), "k", buckets=1, rows=33).count() == 0


# Histories.


@pytest.mark.parametrize("seed", range(3))
def test_history_against_brute_force(spark, seed):
    rng = random.Random(seed)
    day = lambda i: dt.date(2026, 1, 1) + dt.timedelta(days=i)
    data = [(None if rng.random() < 0.02 else f"c{rng.randrange(8)}", None if rng.random() < 0.02 else day(rng.randrange(12)), i, rng.choice([None, "A", "B"]), rng.choice([None, "A"])) for i in range(300)]
    df = spark.createDataFrame(data + data[:9], "who string, snap date, loaded int, s string, m string")
    got = history.history(df, "who", "snap", "loaded", ["s", "m"])
    last = {}
    for who, snap, loaded, s, m in data:
        if who and snap and loaded >= last.get((who, snap), (-1,))[0]:
            last[who, snap] = (loaded, s, m)
    want = []
    for who in {w for w, _ in last}:
        versions = []
        for snap in sorted(d for w, d in last if w == who):
            value = last[who, snap][1:]
            if not versions or versions[-1][1] != value:
                versions.append([snap, value])
        want += [(who, v[0], v[1], a, b) for (a, v), b in zip(versions, [x[0] for x in versions[1:]] + [dt.date(9999, 12, 31)], strict=True)]
    assert rows(got.select("who", "s", "m", "valid_from", "valid_to")) == sorted(want, key=repr)
    assert history.history(df.limit(0), "who", "snap", "loaded", ["s"]).count() == 0
