"""The queries of the general data problems, p1 to p7, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.operators import bitemporal, dedup, diff, history, late, replay, skew
from tidemark.operators.envelope import WRITES, is_json_object
from tidemark.session import cut_lineage
from tidemark.sources.tables import table

#: Row image of the transaction feed; times are epoch milliseconds.
IMAGE = T.StructType(
    [
        T.StructField("TRANSACTION_ID", T.StringType()),
        T.StructField("ACCOUNT_ID", T.StringType()),
        T.StructField("TRANSACTION_DATE", T.LongType()),
        T.StructField("AMOUNT", T.DecimalType(18, 2)),
        T.StructField("BRANCH_CODE", T.StringType()),
        T.StructField("TRANSACTION_STATUS", T.StringType()),
    ]
)
HEAVY_SHARE = 0.02
HISTORY_OF = ["segment", "status", "manage_branch_code"]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """A commit number is that of one change and the same in its copies, so it is the change's ordinal too."""
    feed = table(spark, d, "debezium_envelope")
    state = replay.replay(replay.prepare(feed, "msg_key", "source_scn", payload=(), ordinal="source_scn"))
    return state.select(F.col("key").alias("transaction_id"), F.col("transaction").alias("source_scn"))


def p1_state(spark: SparkSession, d: str) -> DataFrame:
    """The current rows themselves."""
    feed = table(spark, d, "debezium_envelope")
    state = replay.replay(replay.prepare(feed, "msg_key", "source_scn", ordinal="source_scn"))
    row = state.select(F.col("key").alias("transaction_id"), F.col("transaction").alias("source_scn"), F.from_json("payload.after", IMAGE).alias("r"))
    return row.select(
        "transaction_id", "source_scn", F.col("r.ACCOUNT_ID").alias("account_id"), F.date_from_unix_date(F.floor(F.col("r.TRANSACTION_DATE") / F.lit(late.DAY_MS)).try_cast("int")).alias("transaction_date"),
        F.col("r.AMOUNT").alias("amount"), F.col("r.BRANCH_CODE").alias("branch_code"), F.col("r.TRANSACTION_STATUS").alias("transaction_status"),
    )


def late_deliveries(spark: SparkSession, d: str) -> DataFrame:
    """Messages and changes as records of a day as often as they came, in batches by the day of their arrival: ``row_table, row_key, branch_code, transaction_date, amount, ts_ms, kafka_offset, arrival_batch``."""
    rows = table(spark, d, "t24_transactions").select(F.lit("t24_transactions").alias("row_table"), F.col("transaction_id").alias("row_key"), "branch_code", "transaction_date", "amount", "ts_ms", "kafka_offset")
    feed = table(spark, d, "debezium_envelope").filter(F.col("op").isin(*WRITES) & is_json_object(F.col("after")))
    changes = feed.select("source_scn", F.col("ts_ms").try_cast("bigint").alias("ts_ms"), F.from_json("after", IMAGE).alias("r"), "kafka_offset")
    changes = changes.select(
        F.lit("debezium_envelope").alias("row_table"), F.col("source_scn").cast("string").alias("row_key"), F.col("r.BRANCH_CODE").alias("branch_code"),
        F.date_from_unix_date(F.floor(F.col("r.TRANSACTION_DATE") / F.lit(late.DAY_MS)).try_cast("int")).alias("transaction_date"), F.col("r.AMOUNT").alias("amount"), "ts_ms", "kafka_offset",
    )
    return late.placed(rows.unionByName(changes), "transaction_date", "ts_ms")


def late_records(spark: SparkSession, d: str) -> DataFrame:
    """The same, each record once."""
    return dedup.keep_first(late_deliveries(spark, d), ["row_table", "row_key"], ["kafka_offset"]).drop("kafka_offset")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """The records behind the partials that correct their day or are refused by it. The store is kept, as it is read twice.

    Copies of a record have its day, branch and time, so one of each is kept of the few that are found.
    """
    store = cut_lineage(p2_partials(spark, d).filter(F.col("lateness") != late.ON_TIME))
    deliveries = late_deliveries(spark, d).drop("amount", "ts_ms")
    found = late.records_of(store, deliveries, "transaction_date", ["branch_code"])
    return dedup.keep_first(found.select("row_table", "row_key", "lateness", "kafka_offset"), ["row_table", "row_key"], ["kafka_offset"]).drop("kafka_offset")


def p2_partials(spark: SparkSession, d: str) -> DataFrame:
    """The store: partial aggregates by day, branch and day of arrival."""
    return late.partials_of_batches(late_records(spark, d), "transaction_date", ["branch_code"], "amount", allowed_hours=72)


def p2_totals(spark: SparkSession, d: str) -> DataFrame:
    """Totals by day and branch, combined from the partials."""
    return late.combine(p2_partials(spark, d), ["transaction_date", "branch_code"])


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "t24_transactions")
    return skew.heavy(rows, ["account_id", "branch_code"], HEAVY_SHARE).select("key_name", "key_value")


def _per_key(spark: SparkSession, d: str, key: str) -> DataFrame:
    rows = table(spark, d, "t24_transactions").select("transaction_id", key, "amount", "transaction_time", "kafka_offset")
    once = dedup.keep_first(rows, ["transaction_id"], ["kafka_offset"])
    latest = F.max_by("transaction_id", F.struct("transaction_time", "transaction_id")).alias("latest_transaction")
    return skew.aggregate_by_key(once, key, HEAVY_SHARE, [F.count(F.lit(1)).alias("n"), F.sum("amount").cast("decimal(38,2)").alias("amount"), latest]).drop("heavy")


def p3_per_account(spark: SparkSession, d: str) -> DataFrame:
    return _per_key(spark, d, "account_id")


def p3_per_branch(spark: SparkSession, d: str) -> DataFrame:
    return _per_key(spark, d, "branch_code")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    messages = dedup.redelivered(table(spark, d, "t24_transactions"), ["transaction_id"], "kafka_offset", ["kafka_offset"])
    entries = dedup.redelivered(table(spark, d, "t24_stream_batch_log"), ["job_name", "query_id", "batch_id"], "log_id", ["log_id"])
    return messages.select(F.lit("t24_transactions").alias("row_table"), F.col("kafka_offset").alias("row_id")).unionByName(
        entries.select(F.lit("t24_stream_batch_log").alias("row_table"), F.col("log_id").alias("row_id"))
    )


def p4_messages(spark: SparkSession, d: str) -> DataFrame:
    """Exactly one delivery of each message, whole."""
    rows = table(spark, d, "t24_transactions").select("transaction_id", "account_id", "transaction_date", "amount", "ts_ms", "batch_id", "kafka_offset")
    return dedup.keep_first(rows, ["transaction_id"], ["kafka_offset"])


def p4_batches(spark: SparkSession, d: str) -> DataFrame:
    """Exactly one entry of each batch."""
    return dedup.keep_first(table(spark, d, "t24_stream_batch_log"), ["job_name", "query_id", "batch_id"], ["log_id"])


def _as_known(spark: SparkSession, d: str, attributes: list[str], event_time: str = "transaction_time", known_time: str | None = None) -> DataFrame:
    """Each message once with what was known. Deliveries of a message have the same account and times, so all are located where they are and one of each is kept of what was found."""
    events = table(spark, d, "t24_transactions").select("transaction_id", "account_id", event_time, *([F.timestamp_millis(known_time).alias("known")] if known_time else []), "kafka_offset")
    found = bitemporal.as_known(events, table(spark, d, "t24_account"), "account_id", event_time, "event_time", "updated_at", "version_id", attributes, known_time="known" if known_time else None)
    return dedup.first_values(found, ["transaction_id"], ["kafka_offset"], [event_time, *attributes])


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _as_known(spark, d, ["version_id"]).select("transaction_id", "version_id")


def p5_balances(spark: SparkSession, d: str) -> DataFrame:
    """Each transaction with the balances of its account as valid and known then."""
    return _as_known(spark, d, ["working_balance", "online_actual_bal"])


def p5_as_booked(spark: SparkSession, d: str) -> DataFrame:
    """Points off the diagonal: the balance valid at the start of each transaction's booking day, as known when it was committed."""
    return _as_known(spark, d, ["version_id"], "transaction_date", "ts_ms").select("transaction_id", "version_id")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """The targets' keys are unique, see TESTDATA.md."""
    sides = [
        ("transactions", "t24_transactions", "t24_transactions_target", "transaction_id", diff.Settle(("kafka_offset",))),
        ("account", "t24_account", "t24_account_target", "account_id", diff.Settle(("event_time", "updated_at", "version_id"), last=True)),
    ]
    found = []
    for entity, source, target, key, settle in sides:
        copy = table(spark, d, target)
        rows = copy.count()  # from the Parquet footers
        found.append(diff.differences(table(spark, d, source), copy, key, buckets=diff.bucket_count(rows), settle=settle, rows=rows, unique_target=True).withColumn("entity", F.lit(entity)))
    return found[0].unionByName(found[1]).select("entity", "row_key", "field_name", "diff_kind")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return p7_history(spark, d).select("customer_id", "valid_from", "valid_to")


def p7_history(spark: SparkSession, d: str) -> DataFrame:
    """The versions with their attributes."""
    versions = history.history(table(spark, d, "t24_customer_target"), "customer_id", "snapshot_date", "loaded_at", HISTORY_OF)
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return versions.select("customer_id", *HISTORY_OF, day("valid_from"), day("valid_to"), F.col("n_snapshots").cast("bigint").alias("n_snapshots"))


_CHANGES = "SELECT *, TRY_CAST(ts_ms AS BIGINT) AS ts FROM debezium_envelope WHERE op IN ('c','r','u','d') AND (after IS NULL OR json_valid(after)) AND (before IS NULL OR json_valid(before))"
_LAST = f"SELECT * FROM ({_CHANGES}) QUALIFY row_number() OVER (PARTITION BY msg_key ORDER BY ts DESC, source_scn DESC) = 1"
_RECORDS = """
  SELECT 't24_transactions' AS row_table, transaction_id AS row_key, any_value(branch_code) AS branch_code, any_value(transaction_date) AS transaction_date, any_value(amount) AS amount, any_value(ts_ms) AS ts_ms
  FROM t24_transactions GROUP BY transaction_id
  UNION ALL
  SELECT 'debezium_envelope', CAST(source_scn AS VARCHAR), any_value(after->>'$.BRANCH_CODE'), any_value(DATE '1970-01-01' + CAST(CAST(after->>'$.TRANSACTION_DATE' AS BIGINT) // 86400000 AS INTEGER)),
    any_value(CAST(after->>'$.AMOUNT' AS DECIMAL(18,2))), any_value(CAST(ts_ms AS BIGINT))
  FROM (SELECT * FROM debezium_envelope WHERE op IN ('c','r','u') AND json_valid(after)) GROUP BY source_scn"""
_LATENESS = "CASE WHEN ts_ms >= 86400000 * (date_diff('day', DATE '1970-01-01', transaction_date) + 4) THEN 'too_late' WHEN ts_ms >= 86400000 * (date_diff('day', DATE '1970-01-01', transaction_date) + 1) THEN 'late' ELSE 'on_time' END"
_CLASSED = f"SELECT *, {_LATENESS} AS lateness FROM ({_RECORDS})"
_ONCE = "SELECT * FROM t24_transactions QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY kafka_offset) = 1"
_PER_KEY = f"SELECT {{key}}, count(*) AS n, CAST(sum(amount) AS DECIMAL(38,2)) AS amount, arg_max(transaction_id, (transaction_time, transaction_id)) AS latest_transaction FROM ({_ONCE}) GROUP BY 1"
_KNOWN = """SELECT {columns} FROM (SELECT DISTINCT transaction_id, account_id, transaction_time FROM t24_transactions) t JOIN t24_account a
  ON a.account_id = t.account_id AND a.event_time <= t.transaction_time AND a.updated_at <= t.transaction_time
  QUALIFY row_number() OVER (PARTITION BY t.transaction_id ORDER BY a.event_time DESC, a.updated_at DESC, a.version_id DESC) = 1"""
_TX_COLUMNS = "account_id customer_id transaction_date value_date transaction_time transaction_type amount currency_code channel input_id author_id branch_code reference_no transaction_status".split()
_ACCOUNT_COLUMNS = "customer_id working_balance online_actual_bal currency_code branch_code last_tx_time event_time created_at updated_at".split()


def _diff_sql(entity: str, source: str, target: str, key: str, columns: list[str]) -> str:
    joined = f"({source}) s FULL JOIN {target} t ON s.{key} = t.{key}"
    parts = [f"SELECT '{entity}' AS entity, coalesce(s.{key}, t.{key}) AS row_key, '*' AS field_name, CASE WHEN t.{key} IS NULL THEN 'missing_in_target' ELSE 'missing_in_source' END AS diff_kind FROM {joined} WHERE s.{key} IS NULL OR t.{key} IS NULL"]
    parts += [f"SELECT '{entity}', s.{key}, '{c}', 'differs' FROM ({source}) s JOIN {target} t ON s.{key} = t.{key} WHERE s.{c} IS DISTINCT FROM t.{c}" for c in columns]
    return " UNION ALL ".join(parts)


_SNAPSHOTS = "SELECT customer_id, snapshot_date, segment, status, manage_branch_code FROM t24_customer_target QUALIFY row_number() OVER (PARTITION BY customer_id, snapshot_date ORDER BY loaded_at DESC) = 1"
_MARKED = f"""SELECT *, CASE WHEN lag(snapshot_date) OVER w IS NOT NULL AND lag(segment) OVER w IS NOT DISTINCT FROM segment AND lag(status) OVER w IS NOT DISTINCT FROM status
  AND lag(manage_branch_code) OVER w IS NOT DISTINCT FROM manage_branch_code THEN 0 ELSE 1 END AS new FROM ({_SNAPSHOTS}) WINDOW w AS (PARTITION BY customer_id ORDER BY snapshot_date)"""
_VERSIONS = f"""SELECT customer_id, any_value(segment) AS segment, any_value(status) AS status, any_value(manage_branch_code) AS manage_branch_code, min(snapshot_date) AS f, count(*) AS n_snapshots
  FROM (SELECT *, sum(new) OVER (PARTITION BY customer_id ORDER BY snapshot_date) AS island FROM ({_MARKED})) GROUP BY customer_id, island"""
_HISTORY = f"""SELECT {{columns}} CAST(f AS VARCHAR) AS valid_from, coalesce(CAST(lead(f) OVER (PARTITION BY customer_id ORDER BY f) AS VARCHAR), '9999-12-31') AS valid_to FROM ({_VERSIONS})"""

QUERIES = {f.__name__: f for f in (p1_found, p1_state, p2_found, p2_partials, p2_totals, p3_found, p3_per_account, p3_per_branch, p4_found, p4_messages, p4_batches, p5_found, p5_balances, p5_as_booked, p6_found, p7_found, p7_history)}

SQL = {
    "p1_found": f"SELECT msg_key AS transaction_id, source_scn FROM ({_LAST}) WHERE op <> 'd'",
    "p1_state": f"""SELECT msg_key AS transaction_id, source_scn, after->>'$.ACCOUNT_ID' AS account_id, DATE '1970-01-01' + CAST(CAST(after->>'$.TRANSACTION_DATE' AS BIGINT) // 86400000 AS INTEGER) AS transaction_date,
        CAST(after->>'$.AMOUNT' AS DECIMAL(18,2)) AS amount, after->>'$.BRANCH_CODE' AS branch_code, after->>'$.TRANSACTION_STATUS' AS transaction_status FROM ({_LAST}) WHERE op <> 'd'""",
    "p2_found": f"SELECT row_table, row_key, lateness FROM ({_CLASSED}) WHERE lateness <> 'on_time'",
    "p2_partials": f"SELECT transaction_date, branch_code, ts_ms // 86400000 AS arrival_batch, lateness, count(*) AS n, CAST(sum(amount) AS DECIMAL(38,2)) AS amount FROM ({_CLASSED}) GROUP BY ALL",
    "p2_totals": f"""SELECT transaction_date, branch_code, count(*) FILTER (lateness <> 'too_late') AS n, CAST(coalesce(sum(amount) FILTER (lateness <> 'too_late'), 0) AS DECIMAL(38,2)) AS amount,
        count(*) FILTER (lateness = 'late') AS late_n, CAST(coalesce(sum(amount) FILTER (lateness = 'late'), 0) AS DECIMAL(38,2)) AS late_amount,
        count(*) FILTER (lateness = 'too_late') AS refused_n, CAST(coalesce(sum(amount) FILTER (lateness = 'too_late'), 0) AS DECIMAL(38,2)) AS refused_amount FROM ({_CLASSED}) GROUP BY ALL""",
    "p3_found": " UNION ALL ".join(f"SELECT '{c}' AS key_name, {c} AS key_value FROM t24_transactions GROUP BY {c} HAVING {c} IS NOT NULL AND count(*) >= 0.02 * (SELECT count(*) FROM t24_transactions)" for c in ("account_id", "branch_code")),
    "p3_per_account": _PER_KEY.format(key="account_id"),
    "p3_per_branch": _PER_KEY.format(key="branch_code"),
    "p4_found": """SELECT 't24_transactions' AS row_table, kafka_offset AS row_id FROM t24_transactions QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY kafka_offset) > 1
        UNION ALL SELECT 't24_stream_batch_log', log_id FROM t24_stream_batch_log QUALIFY row_number() OVER (PARTITION BY job_name, query_id, batch_id ORDER BY log_id) > 1""",
    "p4_messages": f"SELECT transaction_id, account_id, transaction_date, amount, ts_ms, batch_id, kafka_offset FROM ({_ONCE})",
    "p4_batches": "SELECT * FROM t24_stream_batch_log QUALIFY row_number() OVER (PARTITION BY job_name, query_id, batch_id ORDER BY log_id) = 1",
    "p5_found": _KNOWN.format(columns="t.transaction_id, a.version_id"),
    "p5_balances": _KNOWN.format(columns="t.transaction_id, t.transaction_time, a.working_balance, a.online_actual_bal"),
    "p5_as_booked": f"""SELECT t.transaction_id, a.version_id FROM ({_ONCE}) t JOIN t24_account a ON a.account_id = t.account_id AND a.event_time <= t.transaction_date AND a.updated_at <= make_timestamp(t.ts_ms * 1000)
        QUALIFY row_number() OVER (PARTITION BY t.transaction_id ORDER BY a.event_time DESC, a.updated_at DESC, a.version_id DESC) = 1""",
    "p6_found": _diff_sql("transactions", _ONCE, "t24_transactions_target", "transaction_id", _TX_COLUMNS) + " UNION ALL "
    + _diff_sql("account", "SELECT * FROM t24_account QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY event_time DESC, updated_at DESC, version_id DESC) = 1", "t24_account_target", "account_id", _ACCOUNT_COLUMNS),
    "p7_found": _HISTORY.format(columns="customer_id,"),
    "p7_history": _HISTORY.format(columns="customer_id, segment, status, manage_branch_code, n_snapshots,"),
}
