"""The pipeline's own queries: mirrors, merges, enrichment, interval joins, totals, dead letters and monitoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from tidemark.functions.mapping import apply_mapping, convert
from tidemark.operators import aggregates, deadletter, dedup, joins, merge
from tidemark.operators.envelope import DELETE, WRITES, delete_keys, effective_image, envelope_schema, is_json_object, parse_envelope, text_rows
from tidemark.plans.cdc_sql import SQL  # noqa: F401  (registered with QUERIES)
from tidemark.sources.feeds import as_messages
from tidemark.sources.tables import table

ROW = T.StructType(
    [
        T.StructField("TRANSACTION_ID", T.StringType()),
        T.StructField("ACCOUNT_ID", T.StringType()),
        T.StructField("TRANSACTION_DATE", T.LongType()),
        T.StructField("TRANSACTION_TYPE", T.StringType()),
        T.StructField("AMOUNT", T.DecimalType(18, 2)),
        T.StructField("CURRENCY_CODE", T.StringType()),
        T.StructField("BRANCH_CODE", T.StringType()),
        T.StructField("TRANSACTION_STATUS", T.StringType()),
    ]
)
#: The clock of every query that needs one: the end of the data's last day.
AS_OF = "2026-05-01 00:00:00"
# Waits in minutes and the most tries, the join delay and window, and the edges of age buckets in hours.
SCHEDULE, BALANCE_SCHEDULE, MOST_TRIES = (5, 15, 60, 240, 1440), (10, 30, 120, 360, 1440), 5
DELAY_MS, WINDOW_MS = 5 * 60_000, 30 * 60_000
EDGES_HOURS = (1, 6, 24, 72)


def as_of():
    return F.lit(AS_OF).cast("timestamp")


def stopped():
    """When the runner of retries made its last round, a day before :func:`as_of`."""
    return as_of() - F.make_interval(days=F.lit(1))


def _ms(column: str):
    return F.unix_millis(F.col(column).cast("timestamp"))


def _changes(spark: SparkSession, d: str) -> DataFrame:
    """The feed's changes with their image as a struct ``r``, parsed from whole messages; damaged images are left out."""
    messages = as_messages(table(spark, d, "debezium_envelope"))
    parsed = effective_image(parse_envelope(messages, keep=("offset",)))
    whole = parsed.filter(is_json_object(F.col("row_data")))
    return whole.select("op", "offset", F.col("ts_ms").try_cast("bigint").alias("ts_ms"), F.from_json("row_data", ROW).alias("r")).filter(F.col("r.TRANSACTION_ID").isNotNull())


_IMAGE = ("transaction_id", "amount", "branch_code", "transaction_status")


def _flat(changes: DataFrame) -> DataFrame:
    return changes.select("op", "offset", "ts_ms", *[F.col(f"r.{c.upper()}").alias(c) for c in _IMAGE])


def envelope_rows(spark, d):
    """Every change with its typed image (scan, parse, image choice, corrupt rows)."""
    return _flat(_changes(spark, d))


def envelope_declared(spark, d):
    """Messages by a declared envelope: numbers as numbers, unknown fields null; the image stays text."""
    shape = envelope_schema({"op": "STRING", "before": "STRING", "after": "STRING", "ts_ms": "LONG", "snapshot": "BOOLEAN"})
    return parse_envelope(as_messages(table(spark, d, "debezium_envelope")), schema=shape, keep=("offset",)).select("offset", "op", "ts_ms", "snapshot")


def rows_as_text(spark, d):
    """Every change's image with all of its fields as text, as written."""
    feed = table(spark, d, "debezium_envelope").filter(F.col("op").isNotNull()).withColumnRenamed("kafka_offset", "offset")
    return text_rows(effective_image(feed), ROW.fieldNames(), keep=("offset",))


def mirror_row_number(spark, d):
    """The mirror of the feed, the last event of a key by offset found with a window."""
    rows = _flat(_changes(spark, d))
    last = Window.partitionBy("transaction_id").orderBy(F.col("offset").desc())
    return rows.withColumn("n", F.row_number().over(last)).filter("n = 1").filter(F.col("op") != DELETE).drop("n")


def mirror_max_by(spark, d):
    """The same by an aggregation, which combines before its shuffle and sorts no key's events."""
    return dedup.keep_last(_flat(_changes(spark, d)), ["transaction_id"], ["offset"]).filter(F.col("op") != DELETE)


def upsert_only_fold(spark, d):
    """Writes folded in order of offset, a later time replacing an earlier one: the greatest time, of equal ones the first."""
    rows = _flat(_changes(spark, d)).filter(F.col("op").isin(*WRITES)).withColumn("back", -F.col("offset"))
    return dedup.keep_last(rows, ["transaction_id"], ["ts_ms", "back"]).drop("back", "op")


def _accounts(spark, d) -> DataFrame:
    """The last version of each account by the time it was recorded."""
    versions = table(spark, d, "t24_account")
    return dedup.keep_last(versions, ["account_id"], ["updated_at", "event_time", "version_id"]).drop("version_id")


_ACCOUNT = ["account_id", "customer_id", "working_balance", "online_actual_bal", "updated_at"]


def merge_newer(spark, d):
    """Last write wins: the account mirror with the source's rows merged in where they are strictly newer."""
    return merge.upsert_newer(table(spark, d, "t24_account_target").select(*_ACCOUNT), _accounts(spark, d), ["account_id"], "updated_at")


def merge_upsert(spark, d):
    return merge.upsert(table(spark, d, "t24_account_target").select(*_ACCOUNT), _accounts(spark, d), ["account_id"])


def merge_update_columns(spark, d):
    return merge.update_columns(table(spark, d, "t24_account_target").select(*_ACCOUNT), _accounts(spark, d), ["account_id"], ["working_balance", "updated_at"])


def merge_insert_absent(spark, d):
    return merge.insert_absent(table(spark, d, "t24_account_target").select(*_ACCOUNT), _accounts(spark, d), ["account_id"])


def _once(spark, d, *columns: str) -> DataFrame:
    """Each message once, with the given columns; only they, the identifier and the offset are read and shuffled."""
    needed = dict.fromkeys(["transaction_id", *columns, "kafka_offset"])
    kept = dedup.keep_first(table(spark, d, "t24_transactions").select(*needed), ["transaction_id"], ["kafka_offset"])
    return kept.select(*dict.fromkeys(["transaction_id", *columns]))


def _totals(df: DataFrame) -> DataFrame:
    return df.groupBy("branch_code", "transaction_date", "currency_code").agg(F.sum("amount").cast("decimal(38,2)").alias("total_amount"), F.count(F.lit(1)).alias("txn_count"))


def merge_add_up(spark, d):
    """Totals of the mirror with those of the source added."""
    mirror, source = _totals(table(spark, d, "t24_transactions_target")), _totals(_once(spark, d, "branch_code", "transaction_date", "currency_code", "amount"))
    return merge.add_up(mirror, source, ["branch_code", "transaction_date", "currency_code"], ["total_amount", "txn_count"])


def delete_by_key(spark, d):
    """The keys the feed's deletes name, taken from a table of keys: the transactions it ever wrote and never deleted."""
    feed = table(spark, d, "debezium_envelope").filter(F.col("before").isNull() | is_json_object(F.col("before")))
    written = _flat(_changes(spark, d)).filter(F.col("op").isin(*WRITES)).select("transaction_id").distinct()
    return merge.delete(written, delete_keys(feed, "TRANSACTION_ID").withColumnRenamed("TRANSACTION_ID", "transaction_id"), ["transaction_id"])


def _by_branch(spark, d, *columns: str) -> DataFrame:
    return joins.enrich(_once(spark, d, "branch_code", *columns), table(spark, d, "t24_branch_target"), "branch_code", ["branch_name", "region_code", "region_name"])


def enrich_branch(spark, d):
    return _by_branch(spark, d, "amount").filter("matched").select("transaction_id", "branch_code", "branch_name", "region_code", "region_name", "amount")


def misses_branch(spark, d):
    reason = F.concat(F.lit("no branch "), F.coalesce("branch_code", F.lit("null")))
    return joins.misses(_by_branch(spark, d), table(spark, d, "t24_branch_target"), "BRANCH_NOT_FOUND", "BRANCH_TABLE_EMPTY", reason).select("transaction_id", "branch_code", "error_code", "error_reason")


def _customers(spark, d) -> DataFrame:
    """Each customer's last snapshot."""
    rows = dedup.keep_last(table(spark, d, "t24_customer_target").select("customer_id", "customer_name", "segment", "snapshot_date", "loaded_at"), ["customer_id"], ["snapshot_date", "loaded_at"])
    return rows.select("customer_id", "customer_name", "segment")


def _by_customer(spark, d, *columns: str, trim: bool = True) -> DataFrame:
    return joins.enrich(_once(spark, d, "customer_id", *columns), _customers(spark, d), "customer_id", ["customer_name", "segment"], trim=trim)


def enrich_customer(spark, d):
    return _by_customer(spark, d, "amount").filter("matched").drop("matched")


def misses_customer(spark, d):
    reason = F.concat(F.lit("no customer "), F.coalesce(F.trim("customer_id"), F.lit("null")))
    return joins.misses(_by_customer(spark, d), _customers(spark, d), "CUSTOMER_NOT_FOUND", "CUSTOMER_CACHE_WARMING", reason).select("transaction_id", "error_code", "error_reason")


def cache_fold(spark, d):
    """Last write wins with ties going to the later event; deletes are tombstones that an older write can't undo."""
    rows = _flat(_changes(spark, d))
    return dedup.keep_last(rows, ["transaction_id"], ["ts_ms", "offset"]).filter(F.col("op") != DELETE).drop("op", "ts_ms")


def _timed(spark, d) -> tuple[DataFrame, DataFrame]:
    left = _once(spark, d, "account_id", "transaction_time").select("transaction_id", "account_id", _ms("transaction_time").alias("at"))
    right = table(spark, d, "t24_account").select("version_id", "account_id", _ms("event_time").alias("acct_at"), "working_balance").distinct()
    return left, right


def interval_left(spark, d):
    """Each transaction with every balance of its account from its time to five minutes later, or none."""
    left, right = _timed(spark, d)
    return joins.interval_join(left, right, "account_id", "transaction_id", "at", "acct_at", 0, DELAY_MS).select("transaction_id", "at", "version_id", "acct_at")


def interval_first(spark, d):
    """Each transaction with the first of them."""
    left, right = _timed(spark, d)
    return joins.first_match(left, right, "account_id", "transaction_id", "at", "acct_at", DELAY_MS, "version_id").select("transaction_id", "version_id", "working_balance")


def bootstrap(spark, d):
    """A cold start: every transaction with its account's current balance."""
    accounts = table(spark, d, "t24_account_target").select("account_id", F.col("customer_id").alias("acct_customer"), "working_balance", "online_actual_bal")
    both = _once(spark, d, "account_id", "customer_id").join(joins.small(accounts), "account_id")
    return both.select("transaction_id", "account_id", F.coalesce("customer_id", "acct_customer").alias("customer_id"), "working_balance", "online_actual_bal", F.lit(1).alias("balance_is_approximate"))


def bootstrap_rejects(spark, d):
    return joins.absent(_once(spark, d, "account_id"), table(spark, d, "t24_account_target"), "account_id")


def bootstrap_since(spark, d):
    """A cold start of the transactions from a date on."""
    rows = _once(spark, d, "account_id", "transaction_date").filter(F.col("transaction_date") >= F.date_sub(F.to_date(as_of()), 7))
    accounts = table(spark, d, "t24_account_target").select("account_id", "working_balance")
    return rows.join(joins.small(accounts), "account_id").select("transaction_id", "account_id", "working_balance")


def bootstrap_counts(spark, d):
    """What that start would write and reject, in all and from the date on, without writing it."""
    rows = joins.enrich(_once(spark, d, "account_id", "transaction_date"), table(spark, d, "t24_account_target"), "account_id", [])
    recent = F.col("transaction_date") >= F.date_sub(F.to_date(as_of()), 7)
    one = lambda on, name: F.count_if(on).alias(name)
    return rows.agg(one(F.col("matched"), "written"), one(~F.col("matched"), "rejected"), one(F.col("matched") & recent, "written_since"), one(~F.col("matched") & recent, "rejected_since"))


def full_outer_key(spark, d):
    """Accounts and customers side by side, and what either lacks."""
    accounts = table(spark, d, "t24_account_target").select("account_id", "customer_id")
    customers = _customers(spark, d).select("customer_id", "customer_name")
    return accounts.join(customers, "customer_id", "full_outer").select("customer_id", "account_id", "customer_name")


def _updates(spark, d) -> tuple[DataFrame, DataFrame]:
    accounts = table(spark, d, "t24_account_target").select("account_id", "customer_id", _ms("event_time").alias("at"))
    customers = table(spark, d, "t24_customer_target").select("customer_id", _ms("updated_at").alias("at")).distinct()
    return accounts, customers.withColumn("cust", F.col("customer_id"))


def full_outer_window(spark, d):
    """Account and customer updates within half an hour of each other, and ids without any (times in ms)."""
    accounts, customers = _updates(spark, d)
    return joins.full_outer_window(accounts, customers, "customer_id", "account_id", "cust", "at", "at", WINDOW_MS).withColumnsRenamed({"left_id": "account_id", "right_id": "customer_id", "lt": "acct_at", "rt": "cust_at"})


def join_methods(spark, d):
    """How many pairs and leftovers the two ways of joining make."""
    by_key = full_outer_key(spark, d).select(F.lit("key").alias("method"), _kind("account_id", "customer_name").alias("kind"))
    by_window = full_outer_window(spark, d).select(F.lit("window").alias("method"), _kind("account_id", "customer_id").alias("kind"))
    return by_key.unionByName(by_window).groupBy("method", "kind").agg(F.count(F.lit(1)).alias("n"))


def _kind(left: str, right: str):
    return F.when(F.col(left).isNotNull() & F.col(right).isNotNull(), "both").when(F.col(left).isNotNull(), "left").otherwise("right")


def signed_totals(spark, d):
    """Totals by branch, day and currency from changes: inserts count, updates take their before image back."""
    feed = table(spark, d, "debezium_envelope")
    whole = feed.filter((F.col("after").isNull() | is_json_object(F.col("after"))) & (F.col("before").isNull() | is_json_object(F.col("before"))))
    once = dedup.keep_first(whole.select("op", "before", "after", "source_scn", "kafka_offset").filter(F.col("source_scn").isNotNull()), ["source_scn"], ["kafka_offset"])
    rows = aggregates.signed(once, ROW, ["TRANSACTION_ID", "BRANCH_CODE", "AMOUNT"])
    rows = rows.select(F.col("BRANCH_CODE").alias("branch_code"), F.to_date(F.timestamp_millis("TRANSACTION_DATE")).alias("rpt_date"), F.coalesce("CURRENCY_CODE", F.lit("VND")).alias("currency_code"), F.col("AMOUNT").alias("amount"), "sign", F.col("TRANSACTION_TYPE").alias("kind"))
    credit = F.col("kind").contains("CREDIT")
    return aggregates.signed_totals(rows, ["branch_code", "rpt_date", "currency_code"], "amount", {"credit_amount": credit, "debit_amount": ~credit})


def _recomputed(rows: DataFrame) -> DataFrame:
    signed = F.when(F.coalesce("transaction_status", F.lit("")) != "REVERSED", F.col("amount")).otherwise(-F.col("amount"))
    return rows.groupBy("branch_code", "currency_code", F.col("transaction_date").alias("rpt_date")).agg(F.sum(signed).cast("decimal(38,2)").alias("total_amount"), F.count(F.lit(1)).alias("txn_count"))


def sales_recompute(spark, d):
    return _recomputed(table(spark, d, "t24_transactions_target"))


def reconcile(spark, d):
    """Totals recomputed from the source against those of the mirror."""
    return aggregates.reconcile(_recomputed(_once(spark, d, "branch_code", "currency_code", "transaction_date", "amount", "transaction_status")).filter(F.col("branch_code").isNotNull() & F.col("currency_code").isNotNull()), _recomputed(table(spark, d, "t24_transactions_target")), ["branch_code", "currency_code", "rpt_date"], "total_amount", "txn_count")


def reconcile_worst(spark, d):
    """The twenty groups that differ most, mismatches first."""
    return reconcile(spark, d).orderBy(F.asc("check_result"), F.desc(F.abs("amount_diff")), F.desc("rpt_date"), "branch_code", "currency_code").limit(20)


def region_rollup(spark, d):
    """The last seven days by region."""
    week = table(spark, d, "t24_transactions_target").filter(F.col("transaction_date") >= F.date_sub(F.to_date(as_of()), 7))
    return week.join(joins.small(table(spark, d, "t24_branch_target")), "branch_code").groupBy("region_code", "region_name").agg(F.sum("amount").cast("decimal(38,2)").alias("total_amount"), F.count(F.lit(1)).alias("txn_count"))


def top_branches(spark, d):
    """The ten branches with the highest totals."""
    sums = table(spark, d, "t24_transactions_target").groupBy("branch_code").agg(F.sum("amount").cast("decimal(38,2)").alias("total_amount"), F.count(F.lit(1)).alias("txn_count"))
    return sums.join(joins.small(table(spark, d, "t24_branch_target")), "branch_code").select("branch_code", "branch_name", "total_amount", "txn_count").orderBy(F.desc("total_amount"), "branch_code").limit(10)


def freshest(spark, d):
    """The twenty groups that changed last, with their age."""
    groups = _once(spark, d, "branch_code", "transaction_date", "ts_ms").groupBy("branch_code", F.col("transaction_date").alias("rpt_date")).agg(F.max("ts_ms").alias("updated_ms"), F.count(F.lit(1)).alias("txn_count"))
    age = F.floor((F.unix_millis(as_of()) - F.col("updated_ms")) / 1000).cast("bigint")
    return groups.withColumn("data_age_s", age).orderBy(F.desc("updated_ms"), "branch_code", "rpt_date").limit(20)


def _branch_letters(spark, d) -> DataFrame:
    """The misses of the branch join as a runner has left them: no branch of theirs has come since."""
    missed = _by_branch(spark, d, "amount", "ts_ms").filter(~F.col("matched"))
    code = F.when(F.col("branch_code").isNull(), "NO_BRANCH").otherwise("BRANCH_NOT_FOUND")
    rows = missed.select("transaction_id", "branch_code", "amount", code.alias("error_code"), F.timestamp_millis("ts_ms").alias("since"))
    return deadletter.run_until(rows, F.col("since"), F.lit(False), stopped(), SCHEDULE, MOST_TRIES).drop("since")


def _customer_letters(spark, d) -> DataFrame:
    """The misses of the customer join by ids as they came. Ids with spaces around them are found by the retry, which trims them."""
    missed = _by_customer(spark, d, "amount", "ts_ms", trim=False).filter(~F.col("matched")).select("transaction_id", "customer_id", "amount", "ts_ms")
    known = joins.enrich(missed, _customers(spark, d), "customer_id", ["segment"], trim=True)
    code = F.when(F.col("customer_id").isNull(), "NO_CUSTOMER").otherwise("CUSTOMER_NOT_FOUND")
    rows = known.select("transaction_id", "customer_id", "amount", code.alias("error_code"), F.timestamp_millis("ts_ms").alias("since"), F.col("matched").alias("found"))
    return deadletter.run_until(rows, F.col("since"), F.col("found"), stopped(), SCHEDULE, MOST_TRIES).drop("since", "found")


def _balance_letters(spark, d) -> DataFrame:
    """Transactions without a balance in the time after them, as they were pended when they were committed; the runner hasn't tried them."""
    left = _once(spark, d, "account_id", "customer_id", "transaction_time", "ts_ms").withColumn("at", _ms("transaction_time"))
    lost = joins.first_match(left, _timed(spark, d)[1], "account_id", "transaction_id", "at", "acct_at", DELAY_MS, "version_id").filter(F.col("version_id").isNull())
    return deadletter.pend(lost.select("transaction_id", "account_id", "customer_id", F.lit("BALANCE_NOT_FOUND").alias("error_code"), "ts_ms"), F.timestamp_millis("ts_ms"), BALANCE_SCHEDULE)


def _dead(spark, d) -> DataFrame:
    """The dead letters of the branch and the customer join: ``source``, the key that was looked up, and their states."""
    one = lambda df, source, key: df.select(F.lit(source).alias("source"), F.col(key).alias("lookup"), "transaction_id", "error_code", "status", "retry_count", "pending_since", "next_retry_at", "resolved_at")
    return one(_branch_letters(spark, d), "branch", "branch_code").unionByName(one(_customer_letters(spark, d), "customer", "customer_id"))


def _partners(spark, d) -> DataFrame:
    """What the keys of dead letters are looked up in: branches and customers, each under its source."""
    branches = table(spark, d, "t24_branch_target").select(F.concat(F.lit("branch/"), F.trim("branch_code")).alias("place"))
    return branches.unionByName(_customers(spark, d).select(F.concat(F.lit("customer/"), F.trim("customer_id")).alias("place")))


def _placed(dead: DataFrame) -> DataFrame:
    return dead.withColumn("place", F.concat("source", F.lit("/"), F.trim("lookup")))


def _retried(spark, d, **how) -> DataFrame:
    return deadletter.retry(_placed(_dead(spark, d)), _partners(spark, d), "place", as_of(), SCHEDULE, MOST_TRIES, **how)


def _states(after: DataFrame) -> DataFrame:
    return after.select("source", "transaction_id", "status", "retry_count", F.unix_seconds("next_retry_at").alias("next_retry_s"), F.unix_seconds("resolved_at").alias("resolved_s"))


def retry_outcomes(spark, d):
    """All dead letters after one round of retries."""
    return _states(_retried(spark, d))


def retry_out_of_turn(spark, d):
    """The same if all pending entries are tried at once, whenever they are due."""
    return _states(_retried(spark, d, ignore_wait=True))


def retry_unloaded(spark, d):
    """Against an empty dimension, taken for one that isn't loaded: nothing changes."""
    return _states(deadletter.retry(_placed(_dead(spark, d)), _partners(spark, d).limit(0), "place", as_of(), SCHEDULE, MOST_TRIES))


def retry_none_found(spark, d):
    """The branch letters where a round that finds none of their codes changes nothing."""
    after = deadletter.retry(_branch_letters(spark, d), table(spark, d, "t24_branch_target"), "branch_code", as_of(), SCHEDULE, MOST_TRIES, ignore_wait=True, trim=True, skip_if_none=True)
    return after.select("transaction_id", "status", "retry_count")


def retry_enriched(spark, d):
    """The rows a retry writes: customer letters that are found once their ids are trimmed, with the customer's attributes, as if the runner had not tried them yet."""
    missed = _by_customer(spark, d, "amount", "ts_ms", trim=False).filter(~F.col("matched")).select("transaction_id", "customer_id", "amount", "ts_ms")
    fresh = deadletter.pend(missed, F.timestamp_millis("ts_ms"), SCHEDULE).drop("ts_ms")
    return deadletter.recovered(fresh, _customers(spark, d), "customer_id", ["customer_name", "segment"], as_of(), trim=True)


def retry_account(spark, d):
    """Transactions without a balance of their time, with the account's current one, marked as approximate."""
    current = table(spark, d, "t24_account_target").select("account_id", "working_balance", "online_actual_bal")
    marks = {"balance_is_approximate": F.lit(1), "acct_ts_ms": F.lit(None).cast("bigint")}
    return deadletter.recovered(_balance_letters(spark, d).drop("ts_ms"), current, "account_id", ["working_balance", "online_actual_bal"], as_of(), constants=marks)


def cleanup_counts(spark, d):
    """What a cleanup after seven days would remove, and what is pending and why."""
    tables = {"dead_branch": _branch_letters(spark, d), "dead_customer": _customer_letters(spark, d), "dead_balance": _balance_letters(spark, d)}
    return deadletter.cleanup_counts(tables, as_of(), 7)


def retry_summary(spark, d):
    due = deadletter.due(_dead(spark, d), as_of()).select("source", "transaction_id")
    return _retried(spark, d).join(due, ["source", "transaction_id"], "left_semi").groupBy(F.when(F.col("status") == "PENDING", "retrying").otherwise(F.lower("status")).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def backoff_waits(spark, d):
    """The waits after each number of tries, of the dimensions' and of the balances' letters."""
    tries = F.col("id").cast("int")
    return spark.range(0, 8).select(tries.alias("tries"), deadletter.wait_minutes(tries, SCHEDULE).alias("minutes"), deadletter.wait_minutes(tries, BALANCE_SCHEDULE).alias("balance_minutes"))


def dead_letters_due(spark, d):
    return deadletter.due(_dead(spark, d), as_of()).select("source", "transaction_id", "retry_count", F.unix_seconds("pending_since").alias("pending_s"))


def dead_letters_pending(spark, d):
    """Those of any wait."""
    return deadletter.due(_dead(spark, d), as_of(), ignore_wait=True).select("source", "transaction_id", "retry_count", F.unix_seconds("pending_since").alias("pending_s"))


def dead_letters_expired(spark, d):
    return deadletter.expire(_dead(spark, d), as_of(), 7).select("source", "transaction_id", "status")


def dead_letters_new(spark, d):
    """First entries for the misses of the customer join."""
    pended = deadletter.pend(_by_customer(spark, d).filter(~F.col("matched")).select("transaction_id"), as_of(), SCHEDULE)
    return pended.select("transaction_id", "status", "retry_count", F.unix_seconds("next_retry_at").alias("next_retry_s"))


def dead_letter_states(spark, d):
    return _dead(spark, d).groupBy("status", "error_code").agg(F.count(F.lit(1)).alias("n"))


def dead_letter_tries(spark, d):
    """How often pending entries were tried."""
    p = _dead(spark, d).filter("status = 'PENDING'")
    return p.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("retry_count") == 0).alias("first_attempt"), F.count_if(F.col("retry_count") > 0).alias("retried"), F.max("retry_count").alias("most"), F.round(F.avg("retry_count"), 1).alias("average"))


def dead_letter_rates(spark, d):
    share = lambda s: F.round(100 * F.count_if(F.col("status") == s) / F.nullif(F.count(F.lit(1)), F.lit(0)), 2).alias(f"{s.lower()}_pct")
    return _dead(spark, d).agg(F.count(F.lit(1)).alias("total"), *[share(s) for s in ("RESOLVED", "FAILED", "PENDING")])


def dead_letter_oldest(spark, d):
    oldest = _dead(spark, d).filter("status = 'PENDING'").agg(F.min("pending_since").alias("oldest"))
    return oldest.select(F.unix_seconds("oldest").alias("oldest_s"), (F.unix_seconds(as_of()) - F.unix_seconds("oldest") > 86_400).alias("over_a_day"))


def dead_letter_ages(spark, d):
    return aggregates.age_buckets(_dead(spark, d).filter("status = 'PENDING'"), "pending_since", as_of(), EDGES_HOURS, ["error_code"])


def dead_letter_hourly(spark, d):
    return _dead(spark, d).groupBy(F.unix_seconds(F.date_trunc("hour", "pending_since")).alias("hour_s"), "error_code").agg(F.count(F.lit(1)).alias("n"))


def dead_letter_top(spark, d):
    """The ten commonest error codes and keys of the last thirty days."""
    recent = _dead(spark, d).filter(F.col("pending_since") >= as_of() - F.make_interval(days=F.lit(30)))
    return recent.groupBy("error_code", "lookup").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "error_code", F.asc_nulls_last("lookup")).limit(10)


def dead_letter_newest(spark, d):
    """The ten newest samples."""
    rows = _dead(spark, d).select("source", "transaction_id", "lookup", "error_code", "status", F.unix_millis("pending_since").alias("pending_ms"))
    return rows.orderBy(F.desc("pending_ms"), "source", "transaction_id").limit(10)


def dead_letter_minutes(spark, d):
    """New dead letters a minute over the last day."""
    recent = _dead(spark, d).filter((F.col("pending_since") >= stopped()) & (F.col("pending_since") < as_of()))
    return recent.groupBy(F.unix_seconds(F.date_trunc("minute", "pending_since")).alias("minute_s"), "error_code").agg(F.count(F.lit(1)).alias("n"))


def dead_letter_last_hour(spark, d):
    """New dead letters of the last hour by error code."""
    recent = _dead(spark, d).filter((F.col("pending_since") >= as_of() - F.make_interval(hours=F.lit(1))) & (F.col("pending_since") < as_of()))
    return recent.groupBy("error_code").agg(F.count(F.lit(1)).alias("n"))


def dead_letter_share(spark, d):
    """Dead letters per day's transactions, in one row of scalars."""
    one = lambda df, name: df.agg(F.count(F.lit(1)).alias(name)).scalar()
    parts = spark.range(1).select(one(_once(spark, d), "n").alias("total"), one(_by_branch(spark, d).filter(~F.col("matched")), "n").alias("branch"), one(_by_customer(spark, d).filter(~F.col("matched")), "n").alias("customer"))
    pct = lambda c: F.round(100 * F.col(c) / F.nullif("total", F.lit(0)), 2).alias(f"{c}_pct")
    return parts.select("total", "branch", "customer", pct("branch"), pct("customer"))


def row_counts(spark, d):
    names = ["t24_transactions", "t24_transactions_target", "t24_account", "t24_account_target", "t24_customer_target", "t24_branch_target", "t24_stream_batch_log"]
    return aggregates.counts({n: table(spark, d, n) for n in names})


def _lag(spark, d) -> DataFrame:
    """How long after its time each message was committed, in seconds."""
    return _once(spark, d, "ts_ms", "transaction_time").withColumn("lag_s", (F.col("ts_ms") - _ms("transaction_time")) / 1000)


def _recent(rows: DataFrame, minutes: int) -> DataFrame:
    """Messages committed in the last minutes before :func:`as_of`. Copies share their commit time, so the filter may come first or last."""
    end = F.unix_millis(as_of())
    return rows.filter((F.col("ts_ms") >= end - minutes * 60_000) & (F.col("ts_ms") < end))


def latency(spark, d):
    return aggregates.distribution(_lag(spark, d), F.col("lag_s"), shares=(0.5, 0.95, 0.99))


def latency_by_hour(spark, d):
    return aggregates.distribution(_lag(spark, d).withColumn("hour", F.hour(F.timestamp_millis("ts_ms"))), F.col("lag_s"), ["hour"], (0.95,))


def latency_last_hour(spark, d):
    """The same of the last hour."""
    return aggregates.distribution(_recent(_lag(spark, d), 60), F.col("lag_s"))


def latency_discrete(spark, d):
    """Percentiles that are values of the data."""
    return aggregates.distribution(_lag(spark, d), F.col("lag_s"), discrete=True)


def throughput_last_half_hour(spark, d):
    recent = _recent(_once(spark, d, "ts_ms"), 30)
    return recent.groupBy(F.floor(F.col("ts_ms") / 60_000).cast("bigint").alias("minute")).agg(F.count(F.lit(1)).alias("n"))


def throughput(spark, d):
    """Messages a minute."""
    return _once(spark, d, "ts_ms").groupBy(F.floor(F.col("ts_ms") / 60_000).cast("bigint").alias("minute")).agg(F.count(F.lit(1)).alias("n"))


def time_skew(spark, d):
    """Distance between a transaction and the first balance after it, in seconds."""
    left, right = _timed(spark, d)
    found = joins.first_match(left, right, "account_id", "transaction_id", "at", "acct_at", DELAY_MS, "version_id", how="inner")
    return aggregates.distribution(found, F.abs(F.col("at") - F.col("acct_at")) / 1000, shares=(0.95, 0.99))


def coverage(spark, d):
    """Transactions of the mirror that lack the branch or the balance, and which, and whether they are dead letters of either join."""
    found = joins.first_match(*_timed(spark, d), "account_id", "transaction_id", "at", "acct_at", DELAY_MS, "version_id").select("transaction_id", "version_id")
    parts = {
        "enriched": enrich_branch(spark, d), "with_balance": found.filter(F.col("version_id").isNotNull()),
        "dead_letter": _branch_letters(spark, d), "balance_dead_letter": found.filter(F.col("version_id").isNull()),
    }
    rows = joins.coverage(table(spark, d, "t24_transactions_target").select("transaction_id", "branch_code", "account_id"), "transaction_id", parts)
    return rows.filter(~F.col("enriched") | ~F.col("with_balance"))


def coverage_newest(spark, d):
    """The fifty newest of them."""
    dates = table(spark, d, "t24_transactions_target").select("transaction_id", "transaction_date")
    return coverage(spark, d).join(dates, "transaction_id").select("transaction_id", "transaction_date", "enriched", "with_balance").orderBy(F.desc("transaction_date"), "transaction_id").limit(50)


def samples(spark, d):
    """Five rows of the mirror, the first by key so that they are the same every time."""
    return table(spark, d, "t24_transactions_target").select("transaction_id", "account_id", "amount", "transaction_date").orderBy("transaction_id").limit(5)


def sync_lag(spark, d):
    """Source rows the mirror lacks: how many, and since when."""
    rows = joins.absent(_once(spark, d, "transaction_date"), table(spark, d, "t24_transactions_target"), "transaction_id")
    return rows.agg(F.count(F.lit(1)).alias("not_yet_synced"), F.min("transaction_date").alias("oldest_date"))


def sync_missing(spark, d):
    return joins.absent(_once(spark, d, "transaction_date"), table(spark, d, "t24_transactions_target"), "transaction_id")


def snapshot_timing(spark, d):
    rows = table(spark, d, "t24_transactions_target")
    return rows.agg(F.unix_micros(F.min("transaction_time").cast("timestamp")).alias("first_us"), F.unix_micros(F.max("transaction_time").cast("timestamp")).alias("last_us"), F.count_distinct("account_id").alias("accounts"), F.count_distinct("customer_id").alias("customers"))


def duplicate_keys(spark, d):
    return aggregates.repeated(table(spark, d, "t24_account_target"), "customer_id")


def duplicate_rows(spark, d):
    """The rows under repeated keys."""
    rows = table(spark, d, "t24_account_target").select("account_id", "customer_id")
    return rows.join(aggregates.repeated(rows, "customer_id").select("customer_id"), "customer_id", "left_semi")


def column_mapping(spark, d):
    """Renames, dropped columns and expressions of the mapping language, on the mirror's transactions."""
    mapping = {"id": "transaction_id", "channel_upper": "UPPER(channel)", "kind_lower": "SELECT LOWER(transaction_type)", "abs_amount": "ABS(amount)", "who": "COALESCE(author_id, input_id, channel)", "gone": None}
    return apply_mapping(table(spark, d, "t24_transactions_target"), mapping)


def wire_values(spark, d):
    """Wire values as their declared types: epochs, numbers, text."""
    rows = table(spark, d, "t24_transactions").select("kafka_offset", F.col("ts_ms").cast("string").alias("v"), "amount", "branch_code")
    return rows.select("kafka_offset", F.unix_millis(convert(F.col("v"), "TIMESTAMP", "ms")).alias("at_ms"), convert(F.col("v"), "DATE", "ms").alias("on_day"), convert(F.col("amount").cast("string"), "NUMBER(18,2)").alias("number"), convert(F.col("branch_code"), "NUMBER").alias("unreadable"))


def scalar_functions(spark, d):
    """The scalar functions of the pipeline, together."""
    rows = table(spark, d, "t24_transactions")
    return rows.select(
        "kafka_offset", F.upper("channel").alias("up"), F.lower("transaction_type").alias("low"), F.trim("customer_id").alias("trimmed"), F.length("customer_id").alias("chars"),
        F.concat_ws("|", "account_id", "currency_code").alias("joined"), F.abs(-F.col("amount")).alias("absolute"), F.round(F.col("amount").cast("double") / 3, 2).alias("third"),
        F.nullif("channel", F.lit("ATM")).alias("not_atm"), F.coalesce("author_id", "input_id").alias("who"), F.hex(F.col("branch_code")).alias("bytes"),
        F.datediff("value_date", "transaction_date").alias("days"), F.to_date(F.date_format("transaction_date", "dd/MM/yyyy"), "dd/MM/yyyy").alias("parsed"),
        F.unix_seconds(F.to_timestamp(F.date_format("transaction_time", "yyyy-MM-dd HH:mm:ss"), "yyyy-MM-dd HH:mm:ss")).alias("parsed_s"), F.get_json_object(F.to_json(F.struct("branch_code")), "$.branch_code").alias("from_json"),
    )


def ledger_seen(spark, d):
    """Batches of the log by job and query, once each, with how often they were logged: what a replay must skip."""
    return table(spark, d, "t24_stream_batch_log").groupBy("job_name", "query_id", "batch_id").agg(F.count(F.lit(1)).alias("n"))


_NAMES = """envelope_rows mirror_row_number mirror_max_by upsert_only_fold merge_newer merge_upsert merge_update_columns merge_insert_absent merge_add_up delete_by_key enrich_branch misses_branch
enrich_customer misses_customer cache_fold interval_left interval_first bootstrap bootstrap_rejects full_outer_key full_outer_window join_methods signed_totals sales_recompute reconcile region_rollup
top_branches freshest bootstrap_since bootstrap_counts envelope_declared rows_as_text reconcile_worst retry_outcomes retry_out_of_turn retry_unloaded retry_none_found retry_enriched retry_account retry_summary cleanup_counts backoff_waits dead_letters_due dead_letters_pending dead_letters_expired dead_letters_new dead_letter_states dead_letter_tries dead_letter_rates dead_letter_oldest
dead_letter_ages dead_letter_hourly dead_letter_top dead_letter_newest dead_letter_minutes dead_letter_last_hour dead_letter_share row_counts latency latency_by_hour latency_last_hour latency_discrete throughput throughput_last_half_hour time_skew coverage coverage_newest samples sync_lag sync_missing snapshot_timing
duplicate_keys duplicate_rows column_mapping wire_values scalar_functions ledger_seen"""
QUERIES = {name: globals()[name] for name in _NAMES.split()}
