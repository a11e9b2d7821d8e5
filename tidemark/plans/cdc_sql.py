"""SQL for the pipeline's queries, for an engine that reads the same tables."""

from __future__ import annotations

AS_OF = "TIMESTAMP '2026-05-01 00:00:00'"

_CHANGES = """SELECT op, kafka_offset AS "offset", TRY_CAST(ts_ms AS BIGINT) AS ts_ms, img->>'$.TRANSACTION_ID' AS transaction_id, CAST(img->>'$.AMOUNT' AS DECIMAL(18,2)) AS amount,
  img->>'$.BRANCH_CODE' AS branch_code, img->>'$.TRANSACTION_STATUS' AS transaction_status
  FROM (SELECT *, CASE WHEN op IN ('r','c','u') THEN after ELSE before END AS img FROM debezium_envelope WHERE op IS NOT NULL) WHERE img IS NOT NULL AND json_valid(img)"""


def _last(order: str, where: str = "true") -> str:
    return f"SELECT * FROM ({_CHANGES}) WHERE {where} QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY {order}) = 1"


_MIRROR = f"""SELECT op, "offset", ts_ms, transaction_id, amount, branch_code, transaction_status FROM ({_last('"offset" DESC')}) WHERE op <> 'd'"""
_ACCOUNTS = "SELECT * FROM t24_account QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY updated_at DESC, event_time DESC, version_id DESC) = 1"


def _merged(pick) -> str:
    columns = ["customer_id", "working_balance", "online_actual_bal", "updated_at"]
    values = ", ".join(f"CASE WHEN s.account_id IS NULL THEN t.{c} WHEN t.account_id IS NULL THEN s.{c} ELSE {pick(c)} END AS {c}" for c in columns)
    return f"SELECT coalesce(t.account_id, s.account_id) AS account_id, {values} FROM t24_account_target t FULL JOIN ({_ACCOUNTS}) s ON s.account_id = t.account_id"


_ONCE = "SELECT * FROM t24_transactions QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY kafka_offset) = 1"
_GROUPED = "SELECT branch_code, transaction_date, currency_code, sum(amount) AS total_amount, count(*) AS txn_count FROM ({}) GROUP BY ALL"
_BRANCHED = f"SELECT o.*, b.branch_name, b.region_code, b.region_name, b.branch_code IS NOT NULL AS matched FROM ({_ONCE}) o LEFT JOIN t24_branch_target b ON b.branch_code = o.branch_code"
_CUSTOMERS = "SELECT customer_id, customer_name, segment FROM t24_customer_target QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY snapshot_date DESC, loaded_at DESC) = 1"
_CUSTOMERED = f"SELECT o.transaction_id, o.customer_id, o.amount, c.customer_name, c.segment, c.customer_id IS NOT NULL AS matched FROM ({_ONCE}) o LEFT JOIN ({_CUSTOMERS}) c ON trim(c.customer_id) = trim(o.customer_id)"
_LEFT = f"SELECT transaction_id, account_id, epoch_ms(transaction_time) AS tm FROM ({_ONCE})"
_RIGHT = "SELECT version_id, account_id, epoch_ms(any_value(event_time)) AS acct_at, any_value(working_balance) AS working_balance FROM t24_account GROUP BY version_id, account_id"
_NEAR = f"({_LEFT}) l {{}} JOIN ({_RIGHT}) r ON r.account_id = l.account_id AND r.acct_at BETWEEN l.tm AND l.tm + 300000"
_FIRST = f"SELECT l.transaction_id, l.tm, r.version_id, r.acct_at, r.working_balance FROM {_NEAR} QUALIFY row_number() OVER (PARTITION BY l.transaction_id ORDER BY r.acct_at NULLS LAST, r.version_id) = 1"
_BY_KEY = f"SELECT coalesce(a.customer_id, c.customer_id) AS customer_id, a.account_id, c.customer_name FROM t24_account_target a FULL JOIN ({_CUSTOMERS}) c ON c.customer_id = a.customer_id"
_ACC = "SELECT account_id, customer_id, epoch_ms(event_time) AS tm FROM t24_account_target"
_CUS = "SELECT DISTINCT customer_id, epoch_ms(updated_at) AS tm FROM t24_customer_target"
_PAIRS = f"SELECT a.account_id, a.tm AS acct_at, c.customer_id, c.tm AS cust_at FROM ({_ACC}) a JOIN ({_CUS}) c ON a.customer_id = c.customer_id AND abs(a.tm - c.tm) <= 1800000"
_BY_WINDOW = f"""SELECT * FROM ({_PAIRS}) UNION ALL SELECT account_id, tm, NULL, NULL FROM ({_ACC}) a WHERE NOT EXISTS (SELECT 1 FROM ({_PAIRS}) p WHERE p.account_id = a.account_id)
  UNION ALL SELECT NULL, NULL, customer_id, tm FROM ({_CUS}) c WHERE NOT EXISTS (SELECT 1 FROM ({_PAIRS}) p WHERE p.customer_id = c.customer_id)"""
_KIND = "CASE WHEN {0} IS NOT NULL AND {1} IS NOT NULL THEN 'both' WHEN {0} IS NOT NULL THEN 'left' ELSE 'right' END"
_SIGNED = """SELECT *, CASE WHEN op = 'u' THEN -1 ELSE 1 END AS sign FROM (SELECT op, CASE WHEN op IN ('c','r') THEN after WHEN op = 'u' THEN before END AS img FROM
  (SELECT * FROM debezium_envelope WHERE source_scn IS NOT NULL AND (after IS NULL OR json_valid(after)) AND (before IS NULL OR json_valid(before)) QUALIFY row_number() OVER (PARTITION BY source_scn ORDER BY kafka_offset) = 1))
  WHERE img->>'$.TRANSACTION_ID' IS NOT NULL AND img->>'$.BRANCH_CODE' IS NOT NULL AND img->>'$.AMOUNT' IS NOT NULL"""
_RECOMPUTED = "SELECT branch_code, currency_code, transaction_date AS rpt_date, CAST(sum(CASE WHEN coalesce(transaction_status, '') <> 'REVERSED' THEN amount ELSE -amount END) AS DECIMAL(38,2)) AS total_amount, count(*) AS txn_count FROM ({}) GROUP BY ALL"
# The tries a runner has made by a day before AS_OF: due 5 minutes after the miss and then after growing waits; the sixth is the last.
_WAITED = "(epoch_us({AS_OF}) - 86400000000 - ts_ms * 1000) / 60000000".replace("{AS_OF}", AS_OF)
_TRIES = f"len(list_filter([5, 20, 80, 320, 1760, 3200], lambda w: w <= {_WAITED}))"
_MISSED = f"""SELECT 'branch' AS source, branch_code AS lookup, transaction_id, amount, ts_ms, false AS found, CASE WHEN branch_code IS NULL THEN 'NO_BRANCH' ELSE 'BRANCH_NOT_FOUND' END AS error_code FROM ({_BRANCHED}) WHERE NOT matched
  UNION ALL SELECT 'customer', customer_id, transaction_id, amount, ts_ms, trim(customer_id) IN (SELECT trim(customer_id) FROM t24_customer_target), CASE WHEN customer_id IS NULL THEN 'NO_CUSTOMER' ELSE 'CUSTOMER_NOT_FOUND' END
  FROM ({_ONCE}) o WHERE NOT EXISTS (SELECT 1 FROM t24_customer_target c WHERE c.customer_id = o.customer_id)"""
_DEAD = f"""SELECT *, CASE WHEN status <> 'PENDING' THEN next_retry_at END AS resolved_at FROM (SELECT source, lookup, transaction_id, amount, ts_ms, found, error_code, make_timestamp(ts_ms * 1000) AS pending_since,
  CASE WHEN found AND tries > 0 THEN 'RESOLVED' WHEN NOT found AND tries = 6 THEN 'FAILED' ELSE 'PENDING' END AS status, CAST(CASE WHEN found THEN 0 ELSE tries END AS INTEGER) AS retry_count,
  make_timestamp(ts_ms * 1000) + to_minutes([5, 20, 80, 320, 1760, 3200][CASE WHEN found THEN 1 ELSE least(tries + 1, 6) END]) AS next_retry_at FROM (SELECT *, {_TRIES} AS tries FROM ({_MISSED})))"""
_TURN = f"SELECT *, coalesce(found, false) AS hit, status = 'PENDING' AND next_retry_at <= {AS_OF} AS turn FROM ({_DEAD})"
_WAIT = "[5, 15, 60, 240, 1440][least({}, 4) + 1]"
_RETRIED = f"""SELECT source, transaction_id, turn, CASE WHEN turn AND hit THEN 'RESOLVED' WHEN turn AND retry_count >= 5 THEN 'FAILED' ELSE status END AS status, CASE WHEN turn AND NOT hit THEN retry_count + 1 ELSE retry_count END AS retry_count,
  CASE WHEN turn AND NOT hit AND retry_count < 5 THEN {AS_OF} + to_minutes({_WAIT.format('retry_count + 1')}) ELSE next_retry_at END AS next_retry_at,
  CASE WHEN turn AND (hit OR retry_count >= 5) THEN {AS_OF} ELSE resolved_at END AS resolved_at FROM ({_TURN})"""
_AT_ONCE = f"""SELECT source, transaction_id, CASE WHEN status <> 'PENDING' THEN status WHEN hit THEN 'RESOLVED' WHEN retry_count >= 5 THEN 'FAILED' ELSE status END AS status, CASE WHEN status = 'PENDING' AND NOT hit THEN retry_count + 1 ELSE retry_count END AS retry_count,
  next_retry_at, CASE WHEN status = 'PENDING' AND (hit OR retry_count >= 5) THEN {AS_OF} ELSE resolved_at END AS resolved_at FROM ({_TURN})"""
_NO_BALANCE = f"SELECT o.transaction_id, o.account_id, o.customer_id, o.ts_ms FROM ({_ONCE}) o JOIN ({_FIRST.format('LEFT')}) f USING (transaction_id) WHERE f.version_id IS NULL"
_S = "CAST(floor(epoch({})) AS BIGINT)"
_LAG = f"SELECT *, (ts_ms - epoch_ms(transaction_time)) / 1000 AS lag_s FROM ({_ONCE})"
_POINT = "round(quantile_cont(CAST({0} AS DOUBLE), {1}), 6) AS p{2}"
_COVERAGE = f"""SELECT t.transaction_id, t.branch_code, t.account_id, t.transaction_date, coalesce(e.matched, false) AS enriched, f.version_id IS NOT NULL AS with_balance, coalesce(NOT e.matched, false) AS dead_letter, f.transaction_id IS NOT NULL AND f.version_id IS NULL AS balance_dead_letter
  FROM t24_transactions_target t LEFT JOIN ({_BRANCHED}) e ON e.transaction_id = t.transaction_id LEFT JOIN ({_FIRST.format('LEFT')}) f ON f.transaction_id = t.transaction_id WHERE NOT (coalesce(e.matched, false) AND f.version_id IS NOT NULL)"""
_RECONCILED = f"""SELECT s.branch_code, s.currency_code, s.rpt_date, s.total_amount AS raw_sum, coalesce(k.total_amount, 0) AS kept_sum, s.txn_count AS raw_count, coalesce(k.txn_count, 0) AS kept_count, s.total_amount - coalesce(k.total_amount, 0) AS amount_diff,
        CASE WHEN abs(s.total_amount - coalesce(k.total_amount, 0)) < 0.01 THEN 'OK' ELSE 'MISMATCH' END AS check_result FROM ({_RECOMPUTED.format(_ONCE)}) s LEFT JOIN ({_RECOMPUTED.format("SELECT * FROM t24_transactions_target")}) k
        ON k.branch_code = s.branch_code AND k.currency_code = s.currency_code AND k.rpt_date = s.rpt_date WHERE s.branch_code IS NOT NULL AND s.currency_code IS NOT NULL"""
_TABLES = "t24_transactions t24_transactions_target t24_account t24_account_target t24_customer_target t24_branch_target t24_stream_batch_log".split()

SQL = {
    "envelope_rows": _CHANGES,
    "envelope_declared": """SELECT kafka_offset AS "offset", op, TRY_CAST(ts_ms AS BIGINT) AS ts_ms, CAST(NULL AS BOOLEAN) AS snapshot FROM debezium_envelope WHERE op IS NOT NULL""",
    "rows_as_text": "SELECT kafka_offset AS \"offset\", " + ", ".join((f"img->>'$.{c}' AS {c}" if c != "AMOUNT" else "CASE WHEN contains(img->>'$.AMOUNT', '.') THEN rtrim(rtrim(img->>'$.AMOUNT', '0'), '.') ELSE img->>'$.AMOUNT' END AS AMOUNT") for c in "TRANSACTION_ID ACCOUNT_ID TRANSACTION_DATE TRANSACTION_TYPE AMOUNT CURRENCY_CODE BRANCH_CODE TRANSACTION_STATUS".split())
    + " FROM (SELECT *, CASE WHEN op IN ('r','c','u') THEN after ELSE before END AS img FROM debezium_envelope WHERE op IS NOT NULL) WHERE img IS NOT NULL AND json_valid(img)",
    "mirror_row_number": _MIRROR,
    "mirror_max_by": _MIRROR,
    "upsert_only_fold": f"""SELECT "offset", ts_ms, transaction_id, amount, branch_code, transaction_status FROM ({_last('ts_ms DESC NULLS LAST, "offset"', "op IN ('r','c','u')")})""",
    "merge_newer": _merged(lambda c: f"CASE WHEN s.updated_at > t.updated_at THEN s.{c} ELSE t.{c} END"),
    "merge_upsert": _merged(lambda c: f"s.{c}"),
    "merge_update_columns": _merged(lambda c: f"s.{c}" if c in ("working_balance", "updated_at") else f"t.{c}"),
    "merge_insert_absent": _merged(lambda c: f"t.{c}"),
    "merge_add_up": f"""SELECT branch_code, transaction_date, currency_code, CAST(sum(total_amount) AS DECIMAL(38,2)) AS total_amount, CAST(sum(txn_count) AS BIGINT) AS txn_count
        FROM ({_GROUPED.format("SELECT * FROM t24_transactions_target")} UNION ALL {_GROUPED.format(_ONCE)}) GROUP BY ALL""",
    "delete_by_key": f"""SELECT DISTINCT transaction_id FROM ({_CHANGES}) WHERE op IN ('r','c','u') AND transaction_id NOT IN
        (SELECT before->>'$.TRANSACTION_ID' FROM debezium_envelope WHERE op = 'd' AND json_valid(before) AND before->>'$.TRANSACTION_ID' IS NOT NULL)""",
    "enrich_branch": f"SELECT transaction_id, branch_code, branch_name, region_code, region_name, amount FROM ({_BRANCHED}) WHERE matched",
    "misses_branch": f"SELECT transaction_id, branch_code, 'BRANCH_NOT_FOUND' AS error_code, 'no branch ' || coalesce(branch_code, 'null') AS error_reason FROM ({_BRANCHED}) WHERE NOT matched",
    "enrich_customer": f"SELECT transaction_id, customer_id, amount, customer_name, segment FROM ({_CUSTOMERED}) WHERE matched",
    "misses_customer": f"SELECT transaction_id, 'CUSTOMER_NOT_FOUND' AS error_code, 'no customer ' || coalesce(trim(customer_id), 'null') AS error_reason FROM ({_CUSTOMERED}) WHERE NOT matched",
    "cache_fold": f"""SELECT "offset", transaction_id, amount, branch_code, transaction_status FROM ({_last('ts_ms DESC NULLS LAST, "offset" DESC')}) WHERE op <> 'd'""",
    "interval_left": f"SELECT l.transaction_id, l.tm AS \"at\", r.version_id, r.acct_at FROM {_NEAR.format('LEFT')}",
    "interval_first": f"SELECT transaction_id, version_id, working_balance FROM ({_FIRST.format('LEFT')})",
    "bootstrap": f"SELECT o.transaction_id, o.account_id, coalesce(o.customer_id, a.customer_id) AS customer_id, a.working_balance, a.online_actual_bal, 1 AS balance_is_approximate FROM ({_ONCE}) o JOIN t24_account_target a ON a.account_id = o.account_id",
    "bootstrap_rejects": f"SELECT transaction_id, account_id FROM ({_ONCE}) o WHERE NOT EXISTS (SELECT 1 FROM t24_account_target a WHERE a.account_id = o.account_id)",
    "bootstrap_since": f"SELECT o.transaction_id, o.account_id, a.working_balance FROM ({_ONCE}) o JOIN t24_account_target a ON a.account_id = o.account_id WHERE o.transaction_date >= CAST({AS_OF} AS DATE) - 7",
    "bootstrap_counts": f"""SELECT count(*) FILTER (hit) AS written, count(*) FILTER (NOT hit) AS rejected, count(*) FILTER (hit AND recent) AS written_since, count(*) FILTER (NOT hit AND recent) AS rejected_since
        FROM (SELECT a.account_id IS NOT NULL AS hit, o.transaction_date >= CAST({AS_OF} AS DATE) - 7 AS recent FROM ({_ONCE}) o LEFT JOIN t24_account_target a ON a.account_id = o.account_id)""",
    "full_outer_key": _BY_KEY,
    "full_outer_window": _BY_WINDOW,
    "join_methods": f"SELECT 'key' AS method, {_KIND.format('account_id', 'customer_name')} AS kind, count(*) AS n FROM ({_BY_KEY}) GROUP BY ALL UNION ALL SELECT 'window', {_KIND.format('account_id', 'customer_id')}, count(*) FROM ({_BY_WINDOW}) GROUP BY ALL",
    "signed_totals": f"""SELECT img->>'$.BRANCH_CODE' AS branch_code, DATE '1970-01-01' + CAST(CAST(img->>'$.TRANSACTION_DATE' AS BIGINT) // 86400000 AS INTEGER) AS rpt_date, coalesce(img->>'$.CURRENCY_CODE', 'VND') AS currency_code,
        CAST(sum(sign * CAST(img->>'$.AMOUNT' AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_amount, CAST(sum(sign) AS BIGINT) AS txn_count,
        CAST(sum(CASE WHEN contains(img->>'$.TRANSACTION_TYPE', 'CREDIT') THEN sign * CAST(img->>'$.AMOUNT' AS DECIMAL(18,2)) ELSE 0 END) AS DECIMAL(38,2)) AS credit_amount,
        CAST(sum(CASE WHEN NOT contains(img->>'$.TRANSACTION_TYPE', 'CREDIT') THEN sign * CAST(img->>'$.AMOUNT' AS DECIMAL(18,2)) ELSE 0 END) AS DECIMAL(38,2)) AS debit_amount FROM ({_SIGNED}) GROUP BY ALL""",
    "sales_recompute": _RECOMPUTED.format("SELECT * FROM t24_transactions_target"),
    "reconcile": _RECONCILED,
    "reconcile_worst": f"SELECT * FROM ({_RECONCILED}) ORDER BY check_result, abs(amount_diff) DESC, rpt_date DESC, branch_code, currency_code LIMIT 20",
    "region_rollup": f"SELECT region_code, region_name, CAST(sum(amount) AS DECIMAL(38,2)) AS total_amount, count(*) AS txn_count FROM t24_transactions_target JOIN t24_branch_target USING (branch_code) WHERE transaction_date >= CAST({AS_OF} AS DATE) - 7 GROUP BY ALL",
    "top_branches": "SELECT branch_code, branch_name, CAST(sum(amount) AS DECIMAL(38,2)) AS total_amount, count(*) AS txn_count FROM t24_transactions_target JOIN t24_branch_target USING (branch_code) GROUP BY ALL ORDER BY total_amount DESC, branch_code LIMIT 10",
    "freshest": f"SELECT branch_code, transaction_date AS rpt_date, max(ts_ms) AS updated_ms, count(*) AS txn_count, CAST(floor((epoch_ms({AS_OF}) - max(ts_ms)) / 1000) AS BIGINT) AS data_age_s FROM ({_ONCE}) GROUP BY ALL ORDER BY updated_ms DESC, branch_code, rpt_date LIMIT 20",
    "retry_out_of_turn": f"SELECT source, transaction_id, status, retry_count, {_S.format('next_retry_at')} AS next_retry_s, {_S.format('resolved_at')} AS resolved_s FROM ({_AT_ONCE})",
    "retry_unloaded": f"SELECT source, transaction_id, status, retry_count, {_S.format('next_retry_at')} AS next_retry_s, {_S.format('resolved_at')} AS resolved_s FROM ({_DEAD})",
    "retry_none_found": f"SELECT transaction_id, status, retry_count FROM ({_DEAD}) WHERE source = 'branch'",
    "retry_enriched": f"""SELECT o.transaction_id, o.customer_id, o.amount, c.customer_name, c.segment FROM ({_ONCE}) o JOIN ({_CUSTOMERS}) c ON trim(c.customer_id) = trim(o.customer_id)
        WHERE o.ts_ms + 300000 <= epoch_ms({AS_OF}) AND NOT EXISTS (SELECT 1 FROM t24_customer_target x WHERE x.customer_id = o.customer_id)""",
    "retry_account": f"""SELECT n.transaction_id, n.account_id, n.customer_id, a.working_balance, a.online_actual_bal, 1 AS balance_is_approximate, CAST(NULL AS BIGINT) AS acct_ts_ms FROM ({_NO_BALANCE}) n JOIN t24_account_target a ON a.account_id = n.account_id
        WHERE n.ts_ms + 600000 <= epoch_ms({AS_OF})""",
    "cleanup_counts": f"""SELECT 'dead_' || source AS table_name, CASE WHEN status = 'PENDING' THEN 'pending' ELSE 'eligible' END AS kind, CASE WHEN status = 'PENDING' THEN error_code ELSE status END AS name, count(*) AS n FROM ({_DEAD})
        WHERE status = 'PENDING' OR resolved_at < {AS_OF} - INTERVAL 7 DAY GROUP BY ALL UNION ALL SELECT 'dead_balance', 'pending', 'BALANCE_NOT_FOUND', count(*) FROM ({_NO_BALANCE}) HAVING count(*) > 0""",
    "retry_outcomes": f"SELECT source, transaction_id, status, retry_count, {_S.format('next_retry_at')} AS next_retry_s, {_S.format('resolved_at')} AS resolved_s FROM ({_RETRIED})",
    "retry_summary": f"SELECT CASE WHEN status = 'PENDING' THEN 'retrying' ELSE lower(status) END AS outcome, count(*) AS n FROM ({_RETRIED}) WHERE turn GROUP BY ALL",
    "backoff_waits": f"SELECT CAST(range AS INTEGER) AS tries, {_WAIT.format('CAST(range AS INTEGER)')} AS minutes, [10, 30, 120, 360, 1440][least(CAST(range AS INTEGER), 4) + 1] AS balance_minutes FROM range(0, 8)",
    "dead_letters_due": f"SELECT source, transaction_id, retry_count, {_S.format('pending_since')} AS pending_s FROM ({_DEAD}) WHERE status = 'PENDING' AND next_retry_at <= {AS_OF}",
    "dead_letters_pending": f"SELECT source, transaction_id, retry_count, {_S.format('pending_since')} AS pending_s FROM ({_DEAD}) WHERE status = 'PENDING'",
    "dead_letters_expired": f"SELECT source, transaction_id, status FROM ({_DEAD}) WHERE NOT (status <> 'PENDING' AND resolved_at < {AS_OF} - INTERVAL 7 DAY)",
    "dead_letters_new": f"SELECT transaction_id, 'PENDING' AS status, 0 AS retry_count, {_S.format(AS_OF)} + 300 AS next_retry_s FROM ({_CUSTOMERED}) WHERE NOT matched",
    "dead_letter_states": f"SELECT status, error_code, count(*) AS n FROM ({_DEAD}) GROUP BY ALL",
    "dead_letter_tries": f"SELECT count(*) AS total, count(*) FILTER (retry_count = 0) AS first_attempt, count(*) FILTER (retry_count > 0) AS retried, max(retry_count) AS most, round(avg(retry_count), 1) AS average FROM ({_DEAD}) WHERE status = 'PENDING'",
    "dead_letter_rates": f"SELECT count(*) AS total, " + ", ".join(f"round(100 * count(*) FILTER (status = '{s}') / nullif(count(*), 0), 2) AS {s.lower()}_pct" for s in ("RESOLVED", "FAILED", "PENDING")) + f" FROM ({_DEAD})",
    "dead_letter_oldest": f"SELECT {_S.format('min(pending_since)')} AS oldest_s, {_S.format(AS_OF)} - {_S.format('min(pending_since)')} > 86400 AS over_a_day FROM ({_DEAD}) WHERE status = 'PENDING'",
    "dead_letter_ages": f"""SELECT error_code, CASE WHEN h < 1 THEN 0 WHEN h < 6 THEN 1 WHEN h < 24 THEN 2 WHEN h < 72 THEN 3 ELSE 4 END AS bucket, count(*) AS n
        FROM (SELECT error_code, (epoch_us({AS_OF}) - epoch_us(pending_since)) / 3600000000 AS h FROM ({_DEAD}) WHERE status = 'PENDING') GROUP BY ALL""",
    "dead_letter_hourly": f"SELECT {_S.format("date_trunc('hour', pending_since)")} AS hour_s, error_code, count(*) AS n FROM ({_DEAD}) GROUP BY ALL",
    "dead_letter_top": f"SELECT error_code, lookup, count(*) AS n FROM ({_DEAD}) WHERE pending_since >= {AS_OF} - INTERVAL 30 DAY GROUP BY ALL ORDER BY n DESC, error_code, lookup NULLS LAST LIMIT 10",
    "dead_letter_newest": f"SELECT source, transaction_id, lookup, error_code, status, ts_ms AS pending_ms FROM ({_DEAD}) ORDER BY pending_ms DESC, source, transaction_id LIMIT 10",
    "dead_letter_minutes": f"SELECT {_S.format("date_trunc('minute', pending_since)")} AS minute_s, error_code, count(*) AS n FROM ({_DEAD}) WHERE pending_since >= {AS_OF} - INTERVAL 1 DAY AND pending_since < {AS_OF} GROUP BY ALL",
    "dead_letter_last_hour": f"SELECT error_code, count(*) AS n FROM ({_DEAD}) WHERE pending_since >= {AS_OF} - INTERVAL 1 HOUR AND pending_since < {AS_OF} GROUP BY ALL",
    "dead_letter_share": f"""SELECT total, branch, customer, round(100 * branch / nullif(total, 0), 2) AS branch_pct, round(100 * customer / nullif(total, 0), 2) AS customer_pct FROM (SELECT (SELECT count(*) FROM ({_ONCE})) AS total,
        (SELECT count(*) FROM ({_BRANCHED}) WHERE NOT matched) AS branch, (SELECT count(*) FROM ({_CUSTOMERED}) WHERE NOT matched) AS customer)""",
    "row_counts": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in _TABLES),
    "latency": f"SELECT count(*) AS n, round(CAST(sum(CAST(lag_s AS DECIMAL(38,6))) AS DOUBLE) / count(*), 6) AS average, {_POINT.format('lag_s', 0.5, 50)}, {_POINT.format('lag_s', 0.95, 95)}, {_POINT.format('lag_s', 0.99, 99)}, round(max(lag_s), 6) AS most FROM ({_LAG})",
    "latency_by_hour": f"SELECT CAST(hour(make_timestamp(ts_ms * 1000)) AS INTEGER) AS hour, count(*) AS n, round(CAST(sum(CAST(lag_s AS DECIMAL(38,6))) AS DOUBLE) / count(*), 6) AS average, {_POINT.format('lag_s', 0.95, 95)}, round(max(lag_s), 6) AS most FROM ({_LAG}) GROUP BY ALL",
    "latency_last_hour": f"SELECT count(*) AS n, round(CAST(sum(CAST(lag_s AS DECIMAL(38,6))) AS DOUBLE) / count(*), 6) AS average, {_POINT.format('lag_s', 0.5, 50)}, {_POINT.format('lag_s', 0.95, 95)}, round(max(lag_s), 6) AS most FROM ({_LAG}) WHERE ts_ms >= epoch_ms({AS_OF}) - 3600000 AND ts_ms < epoch_ms({AS_OF})",
    "latency_discrete": f"SELECT count(*) AS n, round(CAST(sum(CAST(lag_s AS DECIMAL(38,6))) AS DOUBLE) / count(*), 6) AS average, round(quantile_disc(lag_s, 0.5), 6) AS p50, round(quantile_disc(lag_s, 0.95), 6) AS p95, round(max(lag_s), 6) AS most FROM ({_LAG})",
    "throughput_last_half_hour": f"SELECT ts_ms // 60000 AS minute, count(*) AS n FROM ({_ONCE}) WHERE ts_ms >= epoch_ms({AS_OF}) - 1800000 AND ts_ms < epoch_ms({AS_OF}) GROUP BY ALL",
    "throughput": f"SELECT ts_ms // 60000 AS minute, count(*) AS n FROM ({_ONCE}) GROUP BY ALL",
    "time_skew": f"SELECT count(*) AS n, round(CAST(sum(CAST(s AS DECIMAL(38,6))) AS DOUBLE) / count(*), 6) AS average, {_POINT.format('s', 0.95, 95)}, {_POINT.format('s', 0.99, 99)}, round(max(s), 6) AS most FROM (SELECT abs(tm - acct_at) / 1000 AS s FROM ({_FIRST.format('')}))",
    "coverage": f"SELECT transaction_id, branch_code, account_id, enriched, with_balance, dead_letter, balance_dead_letter FROM ({_COVERAGE})",
    "coverage_newest": f"SELECT transaction_id, transaction_date, enriched, with_balance FROM ({_COVERAGE}) ORDER BY transaction_date DESC, transaction_id LIMIT 50",
    "samples": "SELECT transaction_id, account_id, amount, transaction_date FROM t24_transactions_target ORDER BY transaction_id LIMIT 5",
    "sync_lag": f"SELECT count(*) AS not_yet_synced, min(transaction_date) AS oldest_date FROM ({_ONCE}) o WHERE NOT EXISTS (SELECT 1 FROM t24_transactions_target t WHERE t.transaction_id = o.transaction_id)",
    "sync_missing": f"SELECT transaction_id, transaction_date FROM ({_ONCE}) o WHERE NOT EXISTS (SELECT 1 FROM t24_transactions_target t WHERE t.transaction_id = o.transaction_id)",
    "snapshot_timing": "SELECT epoch_us(min(transaction_time)) AS first_us, epoch_us(max(transaction_time)) AS last_us, count(DISTINCT account_id) AS accounts, count(DISTINCT customer_id) AS customers FROM t24_transactions_target",
    "duplicate_keys": "SELECT customer_id, count(*) AS n FROM t24_account_target WHERE customer_id IS NOT NULL GROUP BY ALL HAVING count(*) > 1",
    "duplicate_rows": "SELECT account_id, customer_id FROM t24_account_target WHERE customer_id IN (SELECT customer_id FROM t24_account_target GROUP BY 1 HAVING count(*) > 1)",
    "column_mapping": "SELECT transaction_id AS id, upper(channel) AS channel_upper, lower(transaction_type) AS kind_lower, abs(amount) AS abs_amount, coalesce(author_id, input_id, channel) AS who FROM t24_transactions_target",
    "wire_values": "SELECT kafka_offset, ts_ms AS at_ms, DATE '1970-01-01' + CAST(ts_ms // 86400000 AS INTEGER) AS on_day, amount AS number, CAST(NULL AS DECIMAL(38,10)) AS unreadable FROM t24_transactions",
    "scalar_functions": """SELECT kafka_offset, upper(channel) AS up, lower(transaction_type) AS low, trim(customer_id) AS trimmed, CAST(length(customer_id) AS INTEGER) AS chars, concat_ws('|', account_id, currency_code) AS joined, abs(-amount) AS absolute,
        round(CAST(amount AS DOUBLE) / 3, 2) AS third, nullif(channel, 'ATM') AS not_atm, coalesce(author_id, input_id) AS who, hex(branch_code) AS bytes, CAST(date_diff('day', transaction_date, value_date) AS INTEGER) AS days, transaction_date AS parsed, CAST(floor(epoch(transaction_time)) AS BIGINT) AS parsed_s, branch_code AS from_json FROM t24_transactions""",
    "ledger_seen": "SELECT job_name, query_id, batch_id, count(*) AS n FROM t24_stream_batch_log GROUP BY ALL",
}
