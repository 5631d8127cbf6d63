"""The same results in plain SQL, computed straight from the source tables and without any JSON parsing.

The common tables below say what every field of a message is in terms of ``events``; the queries read
them.  Used by the tests and by the driver's comparison only.
"""

from __future__ import annotations

AS_OF = "2024-01-31 00:00:00"
RATE_AS_OF = "2024-01-30 12:00:00"

# Messages and the tables made of them.
BASE = """
WITH e AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k
  FROM events
),
sent AS (
  SELECT e.*, c.copy FROM e JOIN (SELECT unnest([0, 1]) AS copy) c ON c.copy = 0 OR e.event_id % 20 = 0
),
f AS (
  SELECT event_id, ts, k, copy, event_type,
    CASE WHEN event_type IN ('click', 'view') THEN 'edit' WHEN event_type = 'purchase' THEN 'new'
         WHEN event_type = 'signup' THEN 'categorize' ELSE 'log' END AS kind,
    CASE WHEN event_id % 97 = 0 THEN '' ELSE 'Page ' || k END AS title,
    CASE WHEN event_id % 89 = 0 THEN '' WHEN user_id % 10 = 7 THEN '~2024-' || user_id
         WHEN user_id % 10 = 3 THEN 'Bot' || user_id ELSE 'User' || user_id END AS author,
    (user_id % 10 = 3 OR user_id % 50 = 7) AS bot,
    CASE WHEN copy = 1 THEN 'v2' ELSE repeat('é', 10 * k) END AS comment,
    CAST(floor(epoch(ts)) AS BIGINT) AS seconds,
    CASE user_id % 8 WHEN 0 THEN 'enwiki' WHEN 1 THEN 'dewiki' WHEN 2 THEN 'frwiki' WHEN 3 THEN 'eswiki'
         WHEN 4 THEN 'commonswiki' WHEN 5 THEN 'wikidatawiki' WHEN 6 THEN 'enwiktionary' ELSE 'commons' END AS wiki,
    CASE user_id % 8 WHEN 0 THEN 'en' WHEN 1 THEN 'de' WHEN 2 THEN 'fr' WHEN 3 THEN 'es'
         WHEN 4 THEN 'commons' WHEN 5 THEN 'wikidata' WHEN 6 THEN 'enwiktionary' ELSE 'commons' END AS language,
    CAST(1000 + k AS BIGINT) AS size,
    CAST(floor(value) AS BIGINT) * CASE WHEN event_id % 2 = 0 THEN 1 ELSE -1 END AS step,
    event_id % 3 AS kafka_partition,
    2 * event_id + copy AS kafka_offset,
    ts + INTERVAL 2 SECOND + copy * INTERVAL 1 HOUR AS ingested_at
  FROM sent
),
texts AS (
  SELECT f.*,
    '{"id":' || event_id || ',"type":"' || kind || '","namespace":' || k % 16 || ',"title":"' || title
    || '","page_id":' || size || ',"user":"' || author || '","bot":' || bot || ',"minor":' || (k % 3 = 0)
    || CASE WHEN k % 4 = 0 THEN '' ELSE ',"patrolled":' || (k % 2 = 0) END
    || ',"comment":"' || comment || '","timestamp":' || seconds || ',"wiki":"' || wiki || '","length":{'
    || CASE WHEN kind = 'new' THEN '' ELSE '"old":' || size || ',' END || '"new":' || (size + step)
    || '},"revision":{"old":' || 2 * event_id || ',"new":' || (2 * event_id + 1)
    || '},"meta":{"id":"uuid-' || event_id || '","domain":"' || wiki || '.example.org"}}' AS full_text
  FROM f
),
messages AS (
  SELECT CASE WHEN event_id % 50 = 1 THEN left(full_text, length(full_text) - 10) ELSE full_text END AS raw_message,
    'wiki-events' AS kafka_topic, kafka_partition, kafka_offset, ingested_at AS kafka_timestamp,
    'uuid-' || event_id AS kafka_key, ingested_at,
    CASE WHEN event_id % 50 = 1 THEN 'malformed JSON' ELSE '' END AS error
  FROM texts
),
bronze AS (SELECT * EXCLUDE (error) FROM messages WHERE error = ''),
errors AS (
  SELECT kafka_topic, kafka_partition, kafka_offset, raw_message, error AS error_message, ingested_at
  FROM messages WHERE error <> ''
),
silver_log AS (
  SELECT event_id, 'uuid-' || event_id AS event_uuid, kind AS event_type, k % 16 AS namespace, title,
    size AS page_id, author AS user, CAST(bot AS INTEGER) AS user_is_bot,
    CAST(author LIKE '~%' AS INTEGER) AS user_is_anonymous, wiki, language, wiki || '.example.org' AS domain,
    left(comment, 500) AS comment, CAST(k % 3 = 0 AS INTEGER) AS is_minor,
    CAST(k % 4 <> 0 AND k % 2 = 0 AS INTEGER) AS is_patrolled,
    CASE WHEN kind = 'new' THEN 0 ELSE size END AS length_old, size + step AS length_new,
    size + step - CASE WHEN kind = 'new' THEN 0 ELSE size END AS length_delta,
    2 * event_id AS revision_old, 2 * event_id + 1 AS revision_new,
    date_trunc('second', ts) AS event_timestamp, ingested_at, kafka_partition, kafka_offset
  FROM f
  WHERE event_id % 50 <> 1 AND kind IN ('edit', 'new') AND title <> '' AND author <> ''
),
silver AS (
  SELECT * EXCLUDE (kafka_partition, kafka_offset) FROM silver_log
  QUALIFY row_number() OVER (PARTITION BY event_timestamp, wiki, event_id
                             ORDER BY ingested_at DESC, kafka_partition DESC, kafka_offset DESC) = 1
),
g1 AS (
  SELECT date_trunc('hour', event_timestamp) AS hour, wiki, language, count(*) AS total_edits,
    count(*) FILTER (user_is_bot = 1) AS bot_edits,
    count(*) FILTER (user_is_bot = 0 AND user_is_anonymous = 0) AS human_edits,
    count(*) FILTER (user_is_anonymous = 1) AS anonymous_edits,
    count(*) FILTER (is_minor = 1) AS minor_edits,
    count(DISTINCT user) AS unique_users, count(DISTINCT title) AS unique_pages,
    CAST(sum(length_delta) AS BIGINT) AS total_length_delta
  FROM silver GROUP BY 1, 2, 3
),
g2 AS (
  SELECT CAST(event_timestamp AS DATE) AS day, wiki, user, max(user_is_bot) AS user_is_bot,
    max(user_is_anonymous) AS user_is_anonymous, count(*) AS edits, count(DISTINCT title) AS pages_touched,
    CAST(sum(length_delta) AS BIGINT) AS total_length_delta,
    min(event_timestamp) AS first_edit_at, max(event_timestamp) AS last_edit_at
  FROM silver GROUP BY 1, 2, 3
),
g3 AS (
  SELECT date_trunc('hour', event_timestamp) AS hour, wiki, title, count(*) AS edits,
    count(DISTINCT user) AS unique_users, count(*) FILTER (user_is_bot = 1) AS bot_edits,
    CAST(sum(length_delta) AS BIGINT) AS total_length_delta, max(event_timestamp) AS last_event_at
  FROM silver GROUP BY 1, 2, 3
),
g4 AS (
  SELECT date_trunc('hour', event_timestamp) AS hour, language, count(DISTINCT wiki) AS wiki_count,
    count(*) AS total_edits, count(DISTINCT user) AS unique_users, count(DISTINCT title) AS unique_pages
  FROM silver GROUP BY 1, 2
),
typed AS (
  SELECT title, author AS user, CAST(bot AS INTEGER) AS bot, date_trunc('second', ts) AS timestamp,
    CASE WHEN k % 5 = 0 THEN '' ELSE repeat('é', k) END AS comment, ingested_at, event_id,
    kafka_partition, kafka_offset,
    CASE WHEN event_id % 50 = 1 THEN 'malformed JSON' WHEN event_id % 60 = 7 THEN 'wrong type' ELSE '' END AS error
  FROM f WHERE copy = 0
),
wiki_events AS (SELECT title, user, bot, timestamp, comment, ingested_at FROM typed WHERE error = ''),
line_parts AS (
  SELECT event_id, event_id % 6 AS n,
    CASE WHEN event_id % 6 = 2 THEN NULL ELSE title END AS t,
    'uuid-' || event_id AS uuid
  FROM f WHERE copy = 0
),
line_texts AS (
  SELECT event_id, n, t, uuid,
    '{"id":' || event_id % 1000 || CASE WHEN t IS NULL THEN '' ELSE ',"title":"' || t || '"' END
    || CASE n WHEN 1 THEN '' WHEN 2 THEN '' WHEN 3 THEN ',"meta":{"domain":"d"}' WHEN 4 THEN ',"meta":"none"'
              WHEN 5 THEN ',"meta":{"id":"","domain":"d"}' ELSE ',"meta":{"id":"' || uuid || '","domain":"d"}' END
    || '}' AS object_text
  FROM line_parts
),
payloads AS (
  SELECT event_id, n, t, uuid,
    CASE WHEN event_id % 31 = 3 THEN '[' || object_text || ']'
         WHEN event_id % 50 = 1 THEN left(object_text, length(object_text) - 10) ELSE object_text END AS raw_message,
    CASE WHEN event_id % 31 = 3 THEN 'not a JSON object' WHEN event_id % 50 = 1 THEN 'malformed JSON' ELSE '' END AS error
  FROM line_texts
  WHERE event_id % 10 NOT IN (4, 9) AND event_id % 29 <> 5
),
keyed AS (
  SELECT event_id, raw_message,
    CASE WHEN n = 0 THEN uuid WHEN coalesce(t, '') <> '' THEN t
         WHEN event_id % 1000 <> 0 THEN CAST(event_id % 1000 AS VARCHAR) ELSE '' END AS kafka_key
  FROM payloads WHERE error = ''
)
"""

HUMAN = "user_is_bot = 0 AND user_is_anonymous = 0"
SILVER_COLUMNS = (
    "event_id, event_uuid, event_type, namespace, title, page_id, user, user_is_bot, user_is_anonymous, wiki, "
    "language, domain, comment, is_minor, is_patrolled, length_old, length_new, length_delta, revision_old, "
    "revision_new, event_timestamp, ingested_at"
)

_BIG = "CAST({} AS BIGINT)"

QUERIES: dict[str, str] = {
    # 2.1 sources, sinks, ingestion
    "s01_frames": "SELECT event_id, raw_message FROM payloads",
    "s02_json_validity": "SELECT event_id, error AS _error FROM payloads",
    "s03_message_key": "SELECT event_id, kafka_key FROM keyed",
    "s04_value_bytes": "SELECT kafka_partition, kafka_offset, md5(raw_message) AS value_md5, "
    "strlen(raw_message) AS value_bytes FROM messages",
    "s05_key_bytes": "SELECT event_id, hex(encode(nullif(kafka_key, ''))) AS key_hex FROM keyed",
    "s06_kafka_records": "SELECT nullif(kafka_key, '') AS key, raw_message AS value, 'wiki-events' AS topic FROM keyed",
    "s07_ingest_counters": "SELECT count(*) FILTER (error = '') AS sent, count(*) FILTER (error <> '') AS skipped FROM payloads",
    "s08_raw_messages": "SELECT kafka_partition, kafka_offset, raw_message FROM messages",
    "s08b_typed_messages": "SELECT title, user, bot, timestamp, comment, ingested_at FROM wiki_events",
    "s09_record_metadata": "SELECT kafka_topic, kafka_partition, kafka_offset, kafka_timestamp, kafka_key, "
    "error AS _error, ingested_at FROM messages",
    "s10_dead_letters": "SELECT kafka_topic, kafka_partition, kafka_offset, raw_message, error_message, ingested_at FROM errors",
    "s11_broken_budget": "SELECT count(*) AS messages, count(*) FILTER (error <> '') AS broken, "
    "count(*) FILTER (error <> '') > 10 AS over_budget FROM messages",
    "s15_peek": "SELECT kafka_partition, kafka_offset, raw_message FROM messages ORDER BY 1, 2 LIMIT 5",
    # 2.2 projections and filters
    "p01_healthy_route": "SELECT kafka_partition, kafka_offset, kafka_key, ingested_at FROM bronze",
    "p02_error_route": "SELECT kafka_topic, kafka_partition, kafka_offset, error_message, ingested_at FROM errors",
    "p03_silver_projection": f"SELECT {SILVER_COLUMNS}, kafka_partition, kafka_offset FROM silver_log",
    "p03_whole_documents": "SELECT doc_id AS event_id, 'Doc ' || doc_id AS title, source AS user, lang || 'wiki' AS wiki, "
    "lang AS language, left(text, 500) AS comment, n_chars AS length_new, n_chars AS length_delta, "
    "make_timestamp((1704067200 + doc_id % 86400) * 1000000) AS event_timestamp FROM documents WHERE source <> ''",
    "p04_silver_validation": "SELECT event_type, count(*) AS kept FROM silver_log GROUP BY 1",
    "p05_flag_equality": f"SELECT event_id, user FROM silver WHERE {HUMAN}",
    "p06_prefix_exclusion": "SELECT user, timestamp FROM wiki_events WHERE user NOT LIKE '~%'",
    "p07_positive_delta": "SELECT event_id, length_delta FROM silver WHERE length_delta > 0",
    "p08_trailing_range": f"SELECT * FROM g1 WHERE hour >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR",
    "p09_hour_filter": "SELECT * FROM g3 WHERE hour BETWEEN TIMESTAMP '2024-01-10 06:00:00' AND TIMESTAMP '2024-01-12 18:00:00'",
    "p10_total_alert": "SELECT count(*) AS total_edits FROM silver HAVING count(*) > 1000",
    "p10_busy_hours_alert": f"SELECT hour, {_BIG.format('sum(total_edits)')} AS total_edits FROM g1 "
    "GROUP BY 1 HAVING sum(total_edits) > 10",
    "p11_preview": "SELECT kafka_topic, kafka_partition, kafka_offset, error_message, ingested_at, "
    "left(raw_message, 300) AS raw_preview FROM errors",
    "p12_renamed_columns": "SELECT kafka_topic, kafka_partition, kafka_offset, kafka_timestamp, kafka_key FROM bronze",
    "p13_ingestion_stamp": "SELECT CAST(ingested_at AS DATE) AS ingest_date, count(*) AS rows FROM bronze GROUP BY 1",
    # 2.4 aggregate functions
    "a01_count": "SELECT wiki, count(*) AS n FROM silver GROUP BY 1",
    "a02_count_if": "SELECT wiki, count(*) FILTER (is_minor = 1) AS n FROM silver GROUP BY 1",
    "a03_sum": f"SELECT wiki, {_BIG.format('sum(length_delta)')} AS n FROM silver GROUP BY 1",
    "a04_sum_of_flag": f"SELECT wiki, {_BIG.format('sum(user_is_bot)')} AS n FROM silver GROUP BY 1",
    "a05_exact_distinct": "SELECT wiki, count(DISTINCT user) AS users, count(DISTINCT title) AS pages FROM silver GROUP BY 1",
    "a06_any": "SELECT user, max(user_is_bot) AS user_is_bot FROM silver GROUP BY 1",
    "a07_min_max": "SELECT user, min(event_timestamp) AS first_at, max(event_timestamp) AS last_at FROM silver GROUP BY 1",
    "a08_avg": "SELECT bot, round(avg(length(comment)), 4) AS n FROM wiki_events GROUP BY 1",
    "a09_count_distinct": "SELECT count(DISTINCT CAST(event_timestamp AS DATE)) AS days FROM silver",
    # 2.5 gold
    "g1_hourly_stats": "SELECT * FROM g1",
    "g2_users_daily": "SELECT * FROM g2",
    "g3_pages_hourly": "SELECT * FROM g3",
    "g4_languages_hourly": "SELECT * FROM g4",
    "g5b_user_totals": "SELECT user, count(*) AS edits FROM wiki_events GROUP BY 1",
    # 2.6 merges
    "r1_keep_latest_silver": f"SELECT {SILVER_COLUMNS} FROM silver",
    "r2_keep_latest_gold_users": "SELECT * FROM g2",
    "r2_keep_latest_gold_pages": "SELECT * FROM g3",
    "r3_sum_merge": "SELECT hour, wiki, language, total_edits, bot_edits, human_edits, anonymous_edits, minor_edits, "
    "total_length_delta FROM g1",
    "r3_merged_sketches": "SELECT wiki, CASE WHEN event_timestamp < TIMESTAMP '2024-01-16' THEN 1 ELSE 2 END AS half, "
    "count(DISTINCT user) AS approx_users, count(DISTINCT title) AS approx_pages FROM silver GROUP BY 1, 2",
    # 2.7 windows
    "w1_share_of_total": "SELECT bot, count(*) AS cnt, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct "
    "FROM wiki_events GROUP BY bot",
    "w1_share_of_users": "SELECT user, count(*) AS cnt, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct "
    "FROM wiki_events GROUP BY user",
    "w2_busiest_users_per_day": "SELECT day, wiki, CAST(row_number() OVER (PARTITION BY day, wiki ORDER BY edits DESC, user) "
    "AS INTEGER) AS place, user, edits FROM g2 QUALIFY place <= 3",
    "w2_hottest_pages_per_hour": "SELECT hour, CAST(row_number() OVER (PARTITION BY hour ORDER BY edits DESC, wiki, title) "
    "AS INTEGER) AS place, wiki, title, edits FROM g3 QUALIFY place <= 3",
    # 2.8 sorting
    "o1_top_by_aggregate": "SELECT title, count(*) AS edits FROM silver GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15",
    "o2_top_by_column": "SELECT event_id, length_new FROM silver ORDER BY length_new DESC, event_timestamp, wiki, event_id LIMIT 10",
    "o3_newest_buckets": "SELECT date_trunc('minute', event_timestamp) AS minute, count(*) AS edits FROM silver "
    "GROUP BY 1 ORDER BY 1 DESC LIMIT 20",
    "o4_full_order": "SELECT user, count(*) AS edits FROM silver GROUP BY 1 ORDER BY 2 DESC, 1",
    # 2.9 set operations
    "u1_gold_row_counts": "SELECT 'gold_wiki_hourly_stats' AS t, count(*) AS rows FROM g1 UNION ALL "
    "SELECT 'gold_top_users_daily', count(*) FROM g2 UNION ALL "
    "SELECT 'gold_top_pages_hourly', count(*) FROM g3 UNION ALL "
    "SELECT 'gold_language_hourly', count(*) FROM g4",
    "u2_layer_health": "SELECT 'bronze_wiki_events' AS t, count(*) AS rows FROM bronze UNION ALL "
    "SELECT 'silver_wiki_events', count(*) FROM silver UNION ALL "
    "SELECT 'gold_wiki_hourly_stats', count(*) FROM g1 UNION ALL "
    "SELECT 'bronze_wiki_events_errors', count(*) FROM errors",
    # 2.10 scalar functions
    "f01_f06_json_fields": "SELECT event_id, namespace, title, is_patrolled, length_old, length_new, length_delta, "
    "revision_old, domain FROM silver",
    "f01_f04_mistyped_fields": "SELECT event_id, CASE WHEN event_id % 7 = 3 THEN 0 ELSE event_id END AS id, "
    "CASE WHEN event_id % 7 = 4 THEN '' ELSE CAST(user_id AS VARCHAR) END AS title, "
    "CASE WHEN event_id % 7 = 5 THEN 0 ELSE k END AS namespace, "
    "CAST(event_id % 7 NOT IN (6) AND k % 2 = 0 AS INTEGER) AS bot, "
    "CASE WHEN event_id % 7 = 2 THEN '' ELSE 'u' || event_id END AS uuid FROM e",
    "f07_like": "SELECT event_id FROM silver WHERE user LIKE '~%'",
    "f08_language": "SELECT wiki, language, count(*) AS n FROM silver GROUP BY 1, 2",
    "f09_substring": "SELECT conv_id, turn, left(text, 100) AS head FROM conversations",
    "f10_length": "SELECT kafka_partition, kafka_offset, length(raw_message) AS chars FROM messages",
    "f11_f12_arithmetic": "SELECT event_id, length_new - length_old AS delta, round(length_new * 100.0 / 3, 4) AS scaled "
    "FROM silver WHERE namespace >= 4 AND namespace < 12 AND event_type <> 'new'",
    "f13_f18_time_buckets": "SELECT event_id, event_timestamp, date_trunc('hour', event_timestamp) AS hour, "
    "date_trunc('minute', event_timestamp) AS minute, date_trunc('second', ingested_at) AS second, "
    "CAST(event_timestamp AS DATE) AS day FROM silver",
    "f14_now": "SELECT count(*) AS past FROM silver WHERE event_timestamp < TIMESTAMP '2024-01-16'",
    "f19_date_numbers": "SELECT event_id, CAST(strftime(event_timestamp, '%Y%m%d') AS INTEGER) AS yyyymmdd, "
    "CAST(strftime(event_timestamp, '%Y%m') AS INTEGER) AS yyyymm FROM silver",
    "f20_intervals": "SELECT event_id, event_timestamp + INTERVAL 7 DAY AS later, event_timestamp - INTERVAL 90 MINUTE AS earlier FROM silver",
    "f21_f22_seconds_between": "SELECT event_id, date_diff('second', event_timestamp, ingested_at) AS lag_seconds FROM silver",
    "f23_round": "SELECT event_id, round(value * 1.0 / 8, 2) AS r FROM (SELECT event_id, CAST(floor(value) AS BIGINT) AS value FROM e)",
    "f24_readable_size": "SELECT event_id, CASE WHEN x >= 1073741824 THEN printf('%.2f GiB', x / 1073741824) "
    "WHEN x >= 1048576 THEN printf('%.2f MiB', x / 1048576) WHEN x >= 1024 THEN printf('%.2f KiB', x / 1024) "
    "ELSE printf('%.2f B', x) END AS size FROM (SELECT event_id, CAST(event_id AS DOUBLE) * event_id * 64 AS x FROM e)",
    # 2.13 catalogue
    "q01_bronze_rows": "SELECT count(*) AS total FROM bronze",
    "q02_error_rows": "SELECT count(*) AS total FROM errors",
    "q03_bronze_range": "SELECT min(ingested_at) AS first_event, max(ingested_at) AS last_event, count(*) AS total FROM bronze",
    "q04_total_edits": "SELECT count(*) AS total_edits FROM silver",
    "q05_silver_overview": "SELECT count(*) AS total_events, count(DISTINCT wiki) AS unique_wikis, "
    "count(DISTINCT user) AS unique_users, count(DISTINCT title) AS unique_pages, "
    f"{_BIG.format('sum(user_is_bot)')} AS bot_events, {_BIG.format('sum(user_is_anonymous)')} AS anonymous_events FROM silver",
    "q06_languages": "SELECT language, count(*) AS events FROM silver GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15",
    "q07_event_types": "SELECT event_type, count(*) AS cnt FROM silver GROUP BY 1 ORDER BY 2 DESC, 1",
    "q08_top_human_users": f"SELECT user, count(*) AS edits FROM silver WHERE {HUMAN} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    "q09_top_wikis": "SELECT wiki, language, count(*) AS edits FROM silver GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10",
    "q10_author_mix": f"SELECT count(*) FILTER (user_is_bot = 1) AS bots, count(*) FILTER ({HUMAN}) AS humans, "
    "count(*) FILTER (user_is_anonymous = 1) AS anonymous, count(*) AS total FROM silver",
    "q11_largest_growth": "SELECT title, user, length_delta, event_timestamp FROM silver WHERE length_delta > 0 "
    "ORDER BY length_delta DESC, event_timestamp, wiki, event_id LIMIT 10",
    "q12_latest_hours": "SELECT date_trunc('hour', event_timestamp) AS hour, count(*) AS events FROM silver "
    "GROUP BY 1 ORDER BY 1 DESC LIMIT 24",
    "q13_latest_changes": "SELECT title, user, wiki, language, length_delta, event_timestamp FROM silver "
    "ORDER BY event_timestamp DESC, wiki, event_id LIMIT 10",
    "q14_latest_errors": "SELECT kafka_partition, kafka_offset, error_message, left(raw_message, 200) AS raw_preview, "
    "ingested_at FROM errors ORDER BY ingested_at DESC, kafka_partition DESC, kafka_offset DESC LIMIT 10",
    "q15_errors_by_type": "SELECT left(error, 100) AS error_type, count(*) AS cnt FROM typed WHERE error <> '' GROUP BY 1",
    "q16_error_trend": f"SELECT date_trunc('hour', ingested_at) AS hour, count(*) AS error_count FROM errors "
    f"WHERE ingested_at > TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR GROUP BY 1",
    "q17_hourly_authors": f"SELECT hour, {_BIG.format('sum(total_edits)')} AS edits, {_BIG.format('sum(bot_edits)')} AS bots, "
    f"{_BIG.format('sum(human_edits)')} AS humans FROM g1 WHERE hour >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR GROUP BY 1",
    "q18_hourly_edits": f"SELECT hour, {_BIG.format('sum(total_edits)')} AS edits FROM g1 "
    f"WHERE hour >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR GROUP BY 1",
    "q19_top_human_users_gold": f"SELECT user, {_BIG.format('sum(edits)')} AS total_edits FROM g2 WHERE {HUMAN} "
    "GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    "q20_language_share": f"SELECT language, {_BIG.format('sum(total_edits)')} AS edits FROM g4 "
    f"WHERE hour >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    "q21_top_pages": f"SELECT title, wiki, {_BIG.format('sum(edits)')} AS total_edits FROM g3 "
    f"WHERE hour >= TIMESTAMP '{AS_OF}' - INTERVAL 12 HOUR GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10",
    "q22b_total_events": "SELECT count(*) AS total_events FROM wiki_events",
    "q23b_top_users": "SELECT user, count(*) AS edits FROM wiki_events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    "q24b_bot_share": "SELECT bot, count(*) AS cnt, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct "
    "FROM wiki_events GROUP BY bot",
    "q25b_most_edited": "SELECT title, count(*) AS edits FROM wiki_events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    "q26b_latest_minutes": "SELECT date_trunc('minute', timestamp) AS minute, count(*) AS edits FROM wiki_events "
    "GROUP BY 1 ORDER BY 1 DESC LIMIT 20",
    "q27b_registered_users": "SELECT user, count(*) AS edits FROM wiki_events WHERE user NOT LIKE '~%' "
    "GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    "q28b_top_bots": "SELECT user, count(*) AS edits FROM wiki_events WHERE bot = 1 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5",
    "q29b_ingestion_rate": "SELECT date_trunc('second', ingested_at) AS second, count(*) AS events FROM wiki_events "
    f"WHERE ingested_at > TIMESTAMP '{RATE_AS_OF}' - INTERVAL 1 MINUTE GROUP BY 1",
    "q30b_processing_lag": "SELECT round(avg(date_diff('second', timestamp, ingested_at)), 2) AS avg_lag_seconds, "
    "max(date_diff('second', timestamp, ingested_at)) AS max_lag_seconds FROM wiki_events "
    f"WHERE ingested_at > TIMESTAMP '{RATE_AS_OF}' - INTERVAL 5 MINUTE",
    "q31_gold_row_counts": "SELECT 'gold_wiki_hourly_stats' AS t, count(*) AS rows FROM g1 UNION ALL "
    "SELECT 'gold_top_users_daily', count(*) FROM g2 UNION ALL "
    "SELECT 'gold_top_pages_hourly', count(*) FROM g3 UNION ALL "
    "SELECT 'gold_language_hourly', count(*) FROM g4",
    "q32_layer_health": "SELECT 'bronze_wiki_events' AS t, count(*) AS rows FROM bronze UNION ALL "
    "SELECT 'silver_wiki_events', count(*) FROM silver UNION ALL "
    "SELECT 'gold_wiki_hourly_stats', count(*) FROM g1 UNION ALL "
    "SELECT 'bronze_wiki_events_errors', count(*) FROM errors",
}

_LAST_NOON = "TIMESTAMP '2024-01-30 12:00:00'"

# Tables as the live path, a replay or a maintenance job leaves them.
QUERIES |= {
    "s07_stream_counters": "SELECT count(*) AS messages_read, count(*) FILTER (error = '') AS sent, "
    "count(*) FILTER (error <> '') AS skipped, (SELECT count(*) FROM silver_log WHERE event_timestamp < ingested_at - INTERVAL 90 DAY) "
    "AS late, count(*) FILTER (kafka_topic IS NULL) AS failed FROM messages",
    "s10_failed_messages": "SELECT count(*) FILTER (kafka_topic IS NULL) AS sent, 2 * count(*) AS failed, "
    "count(*) FILTER (kafka_topic IS NULL) AS batches FROM messages",
    "s16_bronze_sink": "SELECT * FROM bronze",
    "s17_errors_sink": "SELECT * FROM errors",
    "s18_silver_log_sink": "SELECT * FROM silver_log",
    "s18_silver_sink": "SELECT * FROM silver",
    "s19_hourly_stats_sink": "SELECT * FROM g1",
    "s19_users_daily_sink": "SELECT * FROM g2",
    "s19_pages_hourly_sink": "SELECT * FROM g3",
    "s19_languages_hourly_sink": "SELECT * FROM g4",
    "s19_wiki_hourly_stats_by_hour": "SELECT * FROM g1",
    "s19_top_users_daily_by_hour": "SELECT * FROM g2",
    "s19_top_pages_hourly_by_hour": "SELECT * FROM g3",
    "s19_language_hourly_by_hour": "SELECT * FROM g4",
    "s20b_typed_sink": "SELECT * FROM wiki_events",
    "s20b_typed_errors_sink": "SELECT 'wiki-events' AS kafka_topic, kafka_partition, kafka_offset, "
    "error AS error_message, ingested_at FROM typed WHERE error <> ''",
    "g5b_stored_user_totals": "SELECT user, count(*) AS edits FROM wiki_events GROUP BY 1",
    "s06_streamed_records": "SELECT nullif(kafka_key, '') AS key, raw_message AS value, 'wiki-events' AS topic FROM keyed",
    "s21_snapshot": "SELECT * FROM silver",
    "t03_tumbling_windows": "SELECT date_trunc('hour', event_timestamp) AS hour, count(*) AS edits FROM silver GROUP BY 1",
    "t04_watermark_variant_exact": "SELECT hour, wiki, language, total_edits, bot_edits, human_edits, anonymous_edits, "
    "total_length_delta FROM g1",
    "t09_backfilled_silver": "SELECT * FROM silver",
    "t10_backfilled_hourly_stats": "SELECT * FROM g1",
    "t10_backfilled_users_daily": "SELECT * FROM g2",
    "t11_replayed_pages_hourly": "SELECT * FROM g3",
    "t11_replayed_languages_hourly": "SELECT * FROM g4",
    "r4_compacted_log": "SELECT * FROM silver",
    "r4_compacted_bronze": "SELECT * FROM bronze WHERE kafka_partition <> 1",
    "r4_compacted_errors": "SELECT * FROM errors WHERE kafka_partition <> 1",
    "o5_sorted_files": "SELECT CAST(event_timestamp AS DATE) AS event_date, count(*) AS rows, min(event_timestamp) AS first, "
    "max(event_timestamp) AS last, count(*) FILTER (event_timestamp IS NULL) AS out_of_order FROM silver GROUP BY 1",
    "o5_key_range": "SELECT * FROM silver WHERE event_timestamp BETWEEN TIMESTAMP '2024-01-12 05:30:00' AND TIMESTAMP '2024-01-12 17:30:00'",
    "o6b_resorted_table": "SELECT * FROM wiki_events",
    "m01_retained_rows": f"SELECT * FROM silver WHERE event_timestamp >= TIMESTAMP '{AS_OF}' - INTERVAL 14 DAY",
    "m01_expired_silver": f"SELECT * FROM silver WHERE event_timestamp >= {_LAST_NOON} - INTERVAL 14 DAY",
    "m02_deleted_bronze": f"SELECT * FROM bronze WHERE ingested_at >= {_LAST_NOON} - INTERVAL 7 DAY",
    "m02_deleted_silver": "SELECT * FROM silver WHERE user NOT LIKE 'Bot%'",
    "m02_deleted_silver_in_bronze": "SELECT b.* FROM bronze b WHERE NOT EXISTS (SELECT 1 FROM silver_log l JOIN silver s "
    "USING (event_timestamp, wiki, event_id) WHERE s.user LIKE 'Bot%' AND l.kafka_partition = b.kafka_partition "
    "AND l.kafka_offset = b.kafka_offset)",
    "m02_deleted_silver_in_gold": "SELECT * FROM g2 WHERE user NOT LIKE 'Bot%'",
    "m02_deleted_typed": "SELECT * FROM wiki_events WHERE title <> '' AND user NOT LIKE '~%'",
    "m03_truncated_errors": "SELECT * FROM errors WHERE kafka_partition = 0",
    "m04_changed_retention": f"SELECT * FROM wiki_events WHERE timestamp >= {_LAST_NOON} - INTERVAL 10 DAY",
    "m05_table_sizes": "SELECT \"table\", total_rows, total_rows > 0 AS has_files, true AS readable FROM (SELECT 'bronze_wiki_events' AS "
    "\"table\", count(*) AS total_rows FROM bronze UNION ALL SELECT 'bronze_wiki_events_errors', count(*) FROM errors UNION ALL "
    "SELECT 'silver_wiki_events', count(*) FROM silver UNION ALL SELECT 'gold_wiki_hourly_stats', count(*) FROM g1 UNION ALL "
    "SELECT 'gold_top_users_daily', count(*) FROM g2 UNION ALL SELECT 'gold_top_pages_hourly', count(*) FROM g3 UNION ALL "
    "SELECT 'gold_language_hourly', count(*) FROM g4)",
    "m05_table_rows": "SELECT 'bronze_wiki_events' AS \"table\", count(*) AS total_rows FROM bronze UNION ALL "
    "SELECT 'bronze_wiki_events_errors', count(*) FROM errors UNION ALL "
    "SELECT 'silver_wiki_events', count(*) FROM silver UNION ALL "
    "SELECT 'gold_wiki_hourly_stats', count(*) FROM g1 UNION ALL "
    "SELECT 'gold_top_users_daily', count(*) FROM g2 UNION ALL "
    "SELECT 'gold_top_pages_hourly', count(*) FROM g3 UNION ALL "
    "SELECT 'gold_language_hourly', count(*) FROM g4",
    "m06_partition_counts": "SELECT 'silver_wiki_events' AS \"table\", count(DISTINCT CAST(event_timestamp AS DATE)) AS partitions "
    "FROM silver UNION ALL "
    "SELECT 'gold_wiki_hourly_stats', count(DISTINCT CAST(hour AS DATE)) FROM g1 UNION ALL "
    "SELECT 'gold_top_users_daily', count(DISTINCT day) FROM g2 UNION ALL "
    "SELECT 'gold_top_pages_hourly', count(DISTINCT CAST(hour AS DATE)) FROM g3 UNION ALL "
    "SELECT 'gold_language_hourly', count(DISTINCT CAST(hour AS DATE)) FROM g4",
}


def oracle_sql() -> dict[str, str]:
    return {name: f"{BASE}{sql}" for name, sql in QUERIES.items()}
