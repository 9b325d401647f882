"""Expected results in SQL, computed from the tables and not by decoding."""

from __future__ import annotations

from cdclake.plans.queries import CONFIRMED, CUTS, FINISHED, JOINT_HOURS, JOINT_SIZE, RERUN_UNTIL, SEGMENT_SIZE

# One row per sent row change (`sent`), the changes of the slot (`changes`).
_BASE = r"""
WITH txns AS (
  SELECT event_id // 5 AS txn, max(ts) AS commit_ts, min(ts) AS begin_ts, max(event_id) AS last_event
  FROM events GROUP BY 1
),
every AS (
  SELECT e.*, t.txn, t.commit_ts, t.begin_ts, t.last_event, t.txn // 100 + r.r AS session,
         t.txn % 100 - 100 * r.r AS pos
  FROM events e JOIN txns t ON e.event_id // 5 = t.txn, (VALUES (0), (1)) r(r)
  WHERE r.r = 0 OR t.txn % 100 >= 80
),
placed AS (
  SELECT *, (session * 120 + pos + 20) * 32 AS base, user_id % 12 = 11 AS unknown,
         to_seconds(CASE WHEN pos < 0 THEN 65 ELSE 5 END) AS delay,
         CASE WHEN txn % 10 = 3 THEN 16777216 + txn * 600 ELSE 16777216 + event_id * 120 END AS lsn,
         CASE WHEN event_type IN ('signup', 'purchase') THEN 'insert' WHEN event_type = 'error' THEN 'delete'
              ELSE 'update' END AS operation,
         CASE WHEN user_id % 12 = 11 THEN 'unknown-16395' ELSE 'table_' || lpad((user_id % 12)::VARCHAR, 2, '0')
              END AS "table",
         '9007199254740' || lpad(event_id::VARCHAR, 9, '0') || '.'
           || split_part(value::DECIMAL(18,2)::VARCHAR, '.', 2) AS digits
  FROM every
),
images AS (
  SELECT *, base + 16 + event_id % 5 AS seq,
    '{"created_on":"' || strftime(ts, '%Y-%m-%d') || '","event_type":"' || event_type || '"'
      || CASE WHEN user_id % 12 = 3 AND pos >= 40 THEN ',"extra":' || event_id % 7 ELSE '' END
      || ',"id":' || event_id || ',"is_error":' || CASE WHEN event_type = 'error' THEN 'true' ELSE 'false' END
      || ',"note":' AS head,
    CASE event_id % 4 WHEN 0 THEN 'null' WHEN 1 THEN '"<TOAST>"'
      WHEN 2 THEN '"binary(' || event_id % 100 || ' bytes)"' ELSE '"n\"' || event_id || '\\"' END AS note,
    ',"props":' || to_json(props)::VARCHAR || ',"score":'
      || CASE WHEN event_id % 50 = 0 THEN '"NaN"' ELSE event_id % 1000 || '.5' END
      || ',"user_id":' || user_id || ',"value":' || digits || '}' AS tail
  FROM placed
),
leaky AS (
  SELECT *,
    CASE WHEN event_type IN ('signup', 'purchase') THEN NULL WHEN unknown THEN '{}'
         WHEN event_type = 'click' THEN '{"id":' || event_id || '}' ELSE head || 'null' || tail END AS before,
    CASE WHEN event_type = 'error' THEN NULL WHEN unknown THEN '{}' ELSE head || note || tail END AS after,
    CASE WHEN txn > 0 THEN commit_ts END AS commit_time, ts + delay AS decoded
  FROM images
),
sent AS (
  SELECT *, coalesce(commit_time, decoded)::DATE AS day FROM leaky WHERE txn % 97 <> 13
),
commits AS (
  SELECT session, base + 31 AS seq, txn, '_transaction' AS "table", 'commit' AS operation,
         16777216 + (last_event + 1) * 120 AS lsn, commit_ts AS commit_time, commit_ts + delay AS decoded,
         commit_ts::DATE AS day
  FROM sent WHERE event_id = last_event
),
changes AS (
  SELECT session, seq, txn, "table", operation, lsn, before, after, commit_time, decoded, day FROM sent
  UNION ALL
  SELECT session, seq, txn, "table", operation, lsn, NULL, NULL, commit_time, decoded, day FROM commits
),
messages AS (
  SELECT session, seq, txn, substr(upper(operation), 1, 1) AS kind,
         CASE WHEN operation <> 'commit' THEN 16384 + user_id % 12 END AS relation_id,
         CASE event_type WHEN 'click' THEN 'K' WHEN 'view' THEN 'O' WHEN 'error' THEN 'O' END AS old_type,
         NULL::BIGINT AS end_lsn
  FROM sent
  UNION ALL SELECT session, seq, txn, 'C', NULL, NULL, lsn FROM commits
  UNION ALL SELECT session, base, txn, 'B', NULL, NULL, NULL FROM sent WHERE event_id % 5 = 0 AND txn > 0
  UNION ALL SELECT session, base + 14, txn, CASE txn % 50 WHEN 7 THEN 'T' ELSE 'Y' END, 16384 + user_id % 12, NULL, NULL
    FROM sent WHERE event_id % 5 = 0 AND txn % 50 IN (7, 9)
  UNION ALL SELECT session, base + 1 + i, txn, 'R', 16384 + i, NULL, NULL
    FROM leaky, (SELECT unnest(range(11)) AS i)
    WHERE event_id % 5 = 0 AND (pos = -20 OR (session = 0 AND pos = 0))
  UNION ALL SELECT session, base + 1, txn, 'R', 16387, NULL, NULL FROM leaky WHERE event_id % 5 = 0 AND pos = 40
),
numbered AS (
  SELECT *, row_number() OVER (ORDER BY seq) - 1 AS idx FROM changes
),
segmented AS (
  SELECT *, idx // {n} AS segment FROM numbered
),
islands AS (
  SELECT *, CASE WHEN day <> lag(day) OVER (PARTITION BY segment ORDER BY idx) THEN 1 ELSE 0 END AS changed
  FROM segmented
),
runs AS (
  SELECT *, sum(changed) OVER (PARTITION BY segment ORDER BY idx)::BIGINT AS run FROM islands
),
files AS (
  SELECT segment, run, day, min(idx) AS start_idx, count(*) AS events,
         count(*) FILTER (operation <> 'commit') AS rows, arg_min(lsn, idx) AS first_lsn,
         arg_max(lsn, idx) AS last_lsn, arg_max(epoch_us(decoded), idx) AS last_decoded_us
  FROM runs GROUP BY ALL
),
manifest AS (
  SELECT *, CASE WHEN rows > 0 THEN sum((rows > 0)::BIGINT) OVER (ORDER BY start_idx)::BIGINT END AS sequence
  FROM files
),
both_slots AS (
  SELECT m.* EXCLUDE (sequence), s.slot, m.sequence + s.k * (SELECT max(sequence) FROM manifest) AS sequence
  FROM manifest m, (VALUES ('main', 0), ('twin', 1)) s(slot, k)
)
""".replace("{n}", str(SEGMENT_SIZE))

_JOINT_US = JOINT_HOURS * 3_600_000_000
_UNSET = -62135596800000000
_DAY = "strftime(day, '%Y-%m-%d')"
_STORED = f"""
SELECT "table", operation, epoch_us(decoded) AS timestamp_us, lsn, before, after,
       coalesce(epoch_us(commit_time), {_UNSET}) AS commit_time_us, session, seq, {_DAY} AS commit_date
FROM changes WHERE operation <> 'commit'
"""
_IMAGES = """SELECT seq, "table", lsn, before, after FROM changes WHERE operation = '{}'"""
_RESTART = """
SELECT m.session, m.seq, m.kind FROM messages m JOIN commits c ON m.session = c.session AND m.txn = c.txn
WHERE c.lsn > {} AND m.kind <> 'R'
"""
_LEDGER = """
WITH ledger AS (
  SELECT 's' || event_id % 4 AS slot, event_id // 4 AS i, event_id // 4 * 10 AS start_idx,
         event_id // 4 * 10 + 10 AS end_idx,
         event_type <> 'error' OR event_id // 4 < 100 + 25 * (event_id % 4) AS done,
         16777216 + (event_id * 7919) % 100003 AS last_lsn
  FROM events
  WHERE NOT (event_id % 4 = 2 AND event_id // 4 = 0) AND NOT (event_id % 4 = 3 AND event_id // 4 = 150)
)
"""
_PROGRESS = """
WITH progress AS (
  SELECT 'p' || lpad((user_id % 20)::VARCHAR, 2, '0') AS slot, epoch_us(ts) AS at_us, event_type <> 'error' AS streaming,
         CASE WHEN event_type = 'click' THEN epoch_us(ts) - user_id % 120 * 1000000 END AS blocked_us,
         event_id * 3 + user_id AS write_idx, event_id * 3 AS read_idx,
         16777216 + event_id * 120 - CASE WHEN event_id % 50 = 0 THEN 10000 ELSE 0 END AS acked_lsn
  FROM events
)
"""


def _hex_text(value: str) -> str:
    return f"format('{{:X}}/{{:X}}', ({value}) >> 32, ({value}) & 4294967295)"


ORACLES: dict[str, str] = {
    "event_counts": _BASE
    + f"""SELECT "table", operation, {_DAY} AS commit_date, count(*) AS events FROM sent GROUP BY ALL""",
    "relation_asof": _BASE
    + """SELECT session, seq, 16384 + user_id % 12 AS relation_id, "table",
         CASE WHEN unknown THEN NULL ELSE 'public' END AS namespace,
         user_id % 12 = 3 AND pos >= 40 AS extra_seen FROM sent""",
    "unknown_relation": _BASE
    + """SELECT seq, 'unknown-16395' AS "table", operation, CASE WHEN operation <> 'insert' THEN '{}' END AS before,
         CASE WHEN operation <> 'delete' THEN '{}' END AS after FROM sent WHERE user_id % 12 = 11""",
    "commit_time_fill": _BASE + "SELECT seq, operation, epoch_us(commit_time) AS commit_time_us FROM changes",
    "insert_images": _BASE + _IMAGES.format("insert"),
    "update_images": _BASE + _IMAGES.format("update"),
    "delete_images": _BASE + _IMAGES.format("delete"),
    "commit_markers": _BASE
    + """SELECT seq, "table", lsn, before, after, epoch_us(commit_time) AS commit_time_us,
         epoch_us(decoded) AS timestamp_us FROM changes WHERE operation = 'commit'""",
    "key_only_images": _BASE
    + """SELECT seq, CASE WHEN unknown THEN '{}' ELSE '{"id":' || event_id || '}' END AS before
         FROM sent WHERE event_type = 'click'""",
    "cell_types": r"""
SELECT 2 + l_orderkey * 8 + l_linenumber AS seq,
  '{"discount":' || CASE WHEN l_discount = 0 THEN '"-Infinity"' ELSE l_discount::DECIMAL(18,2)::VARCHAR END
  || ',"extendedprice":' || l_extendedprice::DECIMAL(18,2)::VARCHAR
  || ',"is_open":' || CASE WHEN l_linestatus = 'O' THEN 'true' ELSE 'false' END
  || ',"linenumber":' || l_linenumber || ',"orderkey":' || l_orderkey || ',"partkey":' || l_partkey
  || ',"quantity":' || l_quantity::DECIMAL(18,2)::VARCHAR || ',"returnflag":"' || l_returnflag || '\t"'
  || ',"shipdate":"' || strftime(l_shipdate, '%Y-%m-%d') || '","suppkey":' || l_suppkey
  || ',"tax":' || CASE WHEN l_tax = 0 THEN '"NaN"' ELSE l_tax::DECIMAL(18,2)::VARCHAR END || '}' AS after
FROM lineitem""",
    "type_registry": _BASE
    + """, j AS (SELECT *, replace(tail, to_json(props)::VARCHAR, props) AS json_tail FROM sent)
         SELECT seq, operation, CASE WHEN before LIKE '%"note"%' THEN head || 'null' || json_tail ELSE before END AS before,
         CASE WHEN after LIKE '%"note"%' THEN head || note || json_tail ELSE after END AS after FROM j""",
    "table_selection": _BASE
    + """SELECT "table", operation, count(*) AS events FROM changes
         WHERE "table" IN ('table_01', 'table_03', '_transaction') GROUP BY ALL""",
    "message_counts": _BASE
    + """SELECT 'main' AS slot, kind, count(*) AS messages, count(*) FILTER (kind IN ('T', 'Y')) AS ignored
         FROM messages GROUP BY kind""",
    "utc_commit_day": _BASE + f"SELECT seq, {_DAY} AS commit_date FROM changes",
    "lsn_text": _BASE + f"SELECT seq, lsn * 4099 AS position, {_hex_text('lsn * 4099')} AS text FROM changes",
    "lsn_number": """SELECT o_orderkey, format('{:X}/{:X}', o_custkey, o_orderkey) AS text,
         o_custkey * 4294967296 + o_orderkey AS position FROM orders""",
    "filter_chain": _BASE
    + f"""SELECT seq, "table", operation, lsn FROM sent WHERE "table" <> 'table_05' AND lsn > {CONFIRMED}""",
    "lake_roundtrip": _BASE + _STORED,
    "day_pruned_read": _BASE + _STORED + "AND day BETWEEN DATE '2024-01-05' AND DATE '2024-01-09'",
    "dated_export": _BASE
    + f"""SELECT "table", operation, epoch_us(decoded) AS timestamp_us, lsn, before, after, {_DAY} AS commit_date
         FROM sent""",
    "batch_then_stream": _BASE + _STORED,
    "compacted_days": _BASE + _STORED,
    "rerun_batch": _BASE + _STORED + f"AND day <= DATE '{RERUN_UNTIL}'",
    "empty_batch": _BASE
    + """SELECT 'main' AS slot, count(*) AS read_idx, arg_max(lsn, idx) AS acked_lsn, max(lsn) AS confirmed_lsn,
         0::BIGINT AS files FROM numbered""",
    "order_breaks": _BASE
    + """, written AS (SELECT *, epoch_us(decoded) AS us, seq + CASE WHEN seq % 50 = 0 THEN 6400 ELSE 0 END AS place FROM sent),
         pairs AS (SELECT *, lag({'a': us, 'b': lsn, 'c': seq}) OVER (PARTITION BY day ORDER BY place) AS prior FROM written)
         SELECT seq, lsn, us AS timestamp_us FROM pairs WHERE {'a': us, 'b': lsn, 'c': seq} < prior""",
    "file_stats": _BASE
    + f"""SELECT {_DAY} AS commit_date, count(*) AS rows,
         sum(coalesce(length(before), 0) + coalesce(length(after), 0))::BIGINT AS image_chars, true AS sized
         FROM sent GROUP BY day""",
    "segments_by_count": _BASE
    + """SELECT 'main' AS slot, min(idx) AS start_idx, max(idx) + 1 AS end_idx, false AS done,
         arg_max(lsn, idx) AS last_lsn, arg_max(epoch_us(decoded), idx) AS cut_at_us
         FROM segmented GROUP BY segment""",
    "segments_by_interval": _BASE
    + """, ticks AS (SELECT epoch_us(decoded) // 3600000000 AS tick, count(*) AS n, arg_max(lsn, seq) AS last_lsn
           FROM changes GROUP BY 1)
         SELECT 'main' AS slot, (sum(n) OVER w - n)::BIGINT AS start_idx, (sum(n) OVER w)::BIGINT AS end_idx,
           false AS done, last_lsn, (tick + 1) * 3600000000 AS cut_at_us
         FROM ticks WINDOW w AS (ORDER BY tick)""",
    # One cut by count after the other; between two of them the ticks.
    "segments_joint": _BASE.replace("WITH txns", "WITH RECURSIVE txns", 1)
    + f""", timed AS (SELECT idx + 1 AS idx, lsn, max(epoch_us(decoded)) OVER (ORDER BY seq) AS us FROM numbered),
    spans AS (SELECT *, us - lag(us, {JOINT_SIZE - 1}) OVER (ORDER BY idx) AS span FROM timed),
    counted AS (
      SELECT 0::BIGINT AS j, min(us) AS since FROM timed
      UNION ALL
      SELECT min(e.idx), arg_min(e.us, e.idx)
      FROM counted r JOIN spans e ON e.idx >= r.j + {JOINT_SIZE} AND (e.us - r.since) % {_JOINT_US} >= e.span
      HAVING count(*) > 0),
    ticked AS (SELECT e.*, r.j, r.since, (e.us - r.since) // {_JOINT_US} AS tick FROM timed e ASOF JOIN counted r ON e.idx > r.j),
    segments AS (
      SELECT min(idx) - 1 AS start_idx, max(idx) AS end_idx, arg_max(lsn, idx) AS last_lsn, max(us) AS last_at,
             any_value(since) + (tick + 1) * {_JOINT_US} AS tick_at
      FROM ticked GROUP BY j, tick)
    SELECT s.slot, start_idx, end_idx, false AS done, last_lsn,
           CASE WHEN c.j IS NULL THEN tick_at ELSE last_at END AS cut_at_us,
           CASE WHEN c.j IS NULL THEN 'tick' ELSE 'count' END AS cut_by
    FROM segments LEFT JOIN counted c ON c.j = end_idx, (VALUES ('main'), ('twin')) s(slot)""",
    "day_runs": _BASE + f"SELECT seq, idx, segment, run, {_DAY} AS commit_date FROM runs",
    "file_manifest": _BASE
    + f"""SELECT slot, segment, run, {_DAY} AS commit_date, start_idx, events, rows, first_lsn, last_lsn, last_decoded_us,
         sequence, 'ns/' || strftime(day, '%Y/%m/%d') || '/' || last_decoded_us || '-' || sequence || '.ZSTD.parquet'
         AS key FROM both_slots""",
    "contiguous_prefix": _LEDGER
    + """, marked AS (
      SELECT *, sum((NOT done OR start_idx <> coalesce(prev, 0))::INT) OVER (PARTITION BY slot ORDER BY start_idx) AS broken
      FROM (SELECT *, lag(end_idx) OVER (PARTITION BY slot ORDER BY start_idx) AS prev FROM ledger))
    SELECT slot, coalesce(max(end_idx) FILTER (broken = 0), 0) AS read_idx,
           arg_max(last_lsn, end_idx) FILTER (broken = 0) AS acked_lsn,
           max(last_lsn) FILTER (broken = 0) AS confirmed_lsn
    FROM marked GROUP BY slot""",
    "folded_prefix": _LEDGER
    + """, marked AS (
      SELECT *, sum((NOT done OR start_idx <> coalesce(prev, 0))::INT) OVER (PARTITION BY slot ORDER BY start_idx) AS broken
      FROM (SELECT *, lag(end_idx) OVER (PARTITION BY slot ORDER BY start_idx) AS prev FROM ledger))
    SELECT slot, coalesce(max(end_idx) FILTER (broken = 0), 0) AS read_idx,
           arg_max(last_lsn, end_idx) FILTER (broken = 0) AS acked_lsn,
           max(last_lsn) FILTER (broken = 0) AS confirmed_lsn
    FROM marked GROUP BY slot""",
    "acked_position": _LEDGER + "SELECT slot, max(last_lsn) AS acked_lsn FROM ledger WHERE done GROUP BY slot",
    "acked_history": _LEDGER
    + """SELECT slot, end_idx, last_lsn, max(last_lsn) OVER (PARTITION BY slot ORDER BY end_idx) AS confirmed_lsn
         FROM ledger WHERE done""",
    "safe_restart": _BASE + _RESTART.format(CONFIRMED),
    # What was published once stays: the highest position of the finished segments.
    "resume": _BASE
    + f""", done AS (SELECT segment, arg_max(lsn, idx) AS last_lsn, max(idx) + 1 AS end_idx FROM segmented GROUP BY segment),
         position AS (SELECT 'main' AS slot, max(last_lsn) AS lsn FROM done WHERE end_idx <= {FINISHED}
                      UNION ALL SELECT 'twin', {CONFIRMED})
         SELECT p.slot, m.session, m.seq, m.kind
         FROM position p, messages m JOIN commits c ON m.session = c.session AND m.txn = c.txn
         WHERE c.lsn > p.lsn AND m.kind <> 'R'""",
    "backlog": _PROGRESS
    + """SELECT slot, max(write_idx - read_idx) AS max_backlog, arg_max(write_idx - read_idx, at_us) AS backlog
         FROM progress GROUP BY slot""",
    "stream_health": _PROGRESS
    + """, newest AS (SELECT slot, max(at_us) AS at_us, arg_max(streaming, at_us) AS streaming,
             arg_max({'b': blocked_us}, at_us).b AS blocked_us FROM progress GROUP BY slot),
         judged AS (SELECT slot, at_us, CASE WHEN NOT streaming THEN 'stopped'
           WHEN epoch_us(TIMESTAMP '2024-01-31 00:00:00') - blocked_us > 60000000 THEN 'blocked'
           ELSE 'ready' END AS status FROM newest)
         SELECT *, status = 'ready' AS ready FROM judged""",
    "position_regressions": _PROGRESS
    + """SELECT slot, at_us, acked_lsn, previous_lsn FROM (
           SELECT *, lag(acked_lsn) OVER (PARTITION BY slot ORDER BY at_us) AS previous_lsn FROM progress)
         WHERE acked_lsn < previous_lsn""",
    "missing_changes": _BASE
    + """SELECT operation, event_id AS id, event_type, CASE WHEN event_id % 103 <> 0 THEN digits END AS value FROM sent
         WHERE NOT unknown AND session = txn // 100
           AND (event_id % 101 = 0 OR (event_id % 103 = 0 AND operation <> 'delete'))""",
    "rolled_back_leaks": _BASE
    + "SELECT seq, event_id AS id, operation FROM leaky WHERE txn % 97 = 13 AND NOT unknown",
    "misplaced_rows": _BASE
    + f"""SELECT seq, strftime(day + 1, '%Y-%m-%d') AS commit_date, {_DAY} AS expected_date
         FROM sent WHERE seq % 37 = 0""",
    "mixed_day_files": _BASE
    + """SELECT 'f' || seq // 2048 AS file, strftime(min(day), '%Y-%m-%d') AS first_day,
         strftime(max(day), '%Y-%m-%d') AS last_day, count(*) AS rows
         FROM sent GROUP BY 1 HAVING min(day) <> max(day)""",
    "duplicate_keys": _BASE
    + """SELECT 'ns/' || strftime(day, '%Y/%m/%d') || '/' || sequence % 5 || '.ZSTD.parquet' AS key, count(*) AS count
         FROM both_slots WHERE sequence IS NOT NULL GROUP BY 1 HAVING count(*) > 1""",
    "conservation": _BASE
    + """SELECT 'main' AS slot, session, seq, 1::BIGINT AS decoded,
         CASE WHEN seq % 41 = 0 THEN 0 ELSE 2 END::BIGINT AS stored
         FROM changes WHERE seq % 41 = 0 OR seq % 43 = 0""",
    "expand_image": _BASE
    + r"""SELECT seq, CASE WHEN unknown THEN NULL ELSE event_id END AS id,
         CASE WHEN unknown THEN NULL ELSE user_id::INT END AS user_id,
         CASE WHEN unknown THEN NULL ELSE event_type END AS event_type,
         CASE WHEN unknown THEN NULL ELSE digits END AS value,
         CASE WHEN unknown THEN NULL ELSE event_type = 'error' END AS is_error,
         CASE WHEN unknown THEN NULL ELSE strftime(ts, '%Y-%m-%d') END AS created_on,
         CASE WHEN unknown OR event_id % 4 = 0 THEN NULL WHEN event_id % 4 = 1 THEN '<TOAST>'
              WHEN event_id % 4 = 2 THEN 'binary(' || event_id % 100 || ' bytes)'
              ELSE 'n"' || event_id || '\' END AS note,
         CASE WHEN unknown THEN NULL ELSE digits END AS digits,
         CASE WHEN unknown THEN NULL ELSE '1234567890123456789012345678901234567890' END AS long_digits,
         CASE WHEN unknown THEN NULL ELSE seq::VARCHAR END AS quoted_name
         FROM sent WHERE operation <> 'delete'""",
    "row_identity": _BASE
    + "SELECT seq, operation, CASE WHEN unknown THEN NULL ELSE event_id END AS id FROM sent",
    "dedup_replays": _BASE
    + """SELECT s.slot, session, seq, lsn, operation FROM changes, (VALUES ('main'), ('twin')) s(slot)
         WHERE session = txn // 100""",
    "lsn_ranges": _BASE
    + f"""SELECT 'main' AS slot, {_DAY} AS commit_date, min(lsn) AS min_lsn, max(lsn) AS max_lsn, count(*) AS events,
         {_hex_text("min(lsn)")} AS first, {_hex_text("max(lsn)")} AS last FROM changes GROUP BY day""",
    "image_widths": _BASE
    + """, widths AS (
      SELECT *, CASE WHEN unknown THEN 0 ELSE 9 + (user_id % 12 = 3 AND pos >= 40)::INT END AS full_width,
             CASE WHEN unknown THEN 0 ELSE 1 END AS key_width FROM sent),
    totals AS (
      SELECT "table", operation, count(*) AS events,
        sum(CASE WHEN event_type = 'click' THEN key_width WHEN event_type IN ('view', 'error') THEN full_width END)::BIGINT
          AS before_fields,
        sum(CASE WHEN event_type <> 'error' THEN full_width END)::BIGINT AS after_fields
      FROM widths GROUP BY ALL)
    SELECT *, before_fields / events AS avg_before, after_fields / events AS avg_after FROM totals""",
    "stream_parity": _BASE + _STORED,
    "stream_dedup": _BASE + "SELECT 'main' AS slot, session, seq, lsn, operation FROM changes WHERE session = txn // 100",
    "record_progress": _BASE
    + """, batches AS (SELECT *, CASE WHEN seq <= {a} THEN 0 WHEN seq <= {b} THEN 1 ELSE 2 END AS batch FROM numbered)
    SELECT batch::BIGINT AS batch_id, 'main' AS slot, min(idx) AS start_idx, max(idx) + 1 AS end_idx, true AS done,
           arg_max(lsn, idx) AS last_lsn
    FROM batches GROUP BY batch""".replace("{a}", str(CUTS[0])).replace("{b}", str(CUTS[1])),
    "landed_messages": _BASE + "SELECT session, seq, kind, relation_id, old_type, end_lsn FROM messages",
}
