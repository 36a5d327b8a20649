"""The same queries as SQL text for another engine, over the given tables."""

from __future__ import annotations

from tidemark.plans.queries import LOOKUP_ITEM, LOOKUP_VISITOR

_PROPERTIES = """
raw AS (
  SELECT epoch_us(l_shipdate) // 1000 AS "timestamp", CAST(l_partkey AS INTEGER) AS itemid,
         l_linenumber AS property, concat(l_returnflag, l_linestatus) AS "value"
  FROM lineitem),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY itemid, property
                               ORDER BY "timestamp" DESC NULLS LAST, "value" DESC NULLS LAST) AS rn
  FROM raw WHERE itemid IS NOT NULL AND property IS NOT NULL),
silver AS (
  SELECT "timestamp" AS timestamp_unix,
         make_timestamp(("timestamp" // 1000) * 1000000) AS event_time,
         itemid AS item_id, property AS property_id, "value" AS property_value,
         CAST(make_timestamp(("timestamp" // 1000) * 1000000) AS DATE) AS event_date
  FROM ranked WHERE rn = 1),
summary AS (
  SELECT item_id, count(DISTINCT property_id) AS property_count, count(*) AS total_values,
         array_to_string(list_sort(list(DISTINCT property_id)), ',') AS property_ids,
         min(event_time) AS first_seen, max(event_time) AS last_seen,
         CAST(datediff('day', min(event_time), max(event_time)) AS INTEGER) AS days_active
  FROM silver GROUP BY item_id),
statistics AS (
  SELECT property_id, count(DISTINCT item_id) AS items_with_property,
         count(*) AS total_property_records, count(DISTINCT property_value) AS distinct_values,
         min(event_time) AS first_seen, max(event_time) AS last_seen,
         round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM silver), 4) AS frequency_ratio
  FROM silver GROUP BY property_id)
"""

_EVENTS = f"""
bronze AS (
  SELECT epoch_us(ts) // 1000 AS ms, CAST(epoch_us(ts) // 1000 AS VARCHAR) AS "timestamp",
         CAST(user_id AS VARCHAR) AS visitorid,
         CASE event_type WHEN 'click' THEN 'addtocart' WHEN 'purchase' THEN 'transaction'
                         ELSE event_type END AS event,
         json_extract_string(props, '$.k') AS itemid,
         concat(user_id, '-', strftime(ts, '%Y%m%d')) AS transactionid,
         CAST(event_id AS VARCHAR) AS _ingestion_id,
         epoch_us(ts) // 1000 + CAST(round("value" * 1000) AS BIGINT) AS ingested_ms
  FROM events),
silver AS (
  SELECT * REPLACE (CASE WHEN event = 'transaction' THEN transactionid END AS transactionid),
         make_timestamp((ms // 1000) * 1000000) AS event_time, make_timestamp(ms * 1000) AS moment
  FROM bronze WHERE event IN ('view', 'addtocart', 'transaction')),
profile AS (
  SELECT visitorid, count(*) FILTER (WHERE event = 'view') AS total_viewcount,
         count(DISTINCT itemid) FILTER (WHERE event = 'view') AS unique_items_viewed,
         count(*) FILTER (WHERE event = 'addtocart') AS total_addtocart,
         CAST(count(*) FILTER (WHERE event = 'transaction') > 0 AS INTEGER) AS bought_something
  FROM silver GROUP BY visitorid),
journey AS (
  SELECT "timestamp", visitorid, event, itemid, transactionid, event_time,
         row_number() OVER (PARTITION BY visitorid, itemid
           ORDER BY ms NULLS FIRST, event NULLS FIRST, transactionid NULLS FIRST,
                    CAST(ingested_ms AS VARCHAR) NULLS FIRST, _ingestion_id NULLS FIRST)
           AS event_order
  FROM silver),
basket AS (
  SELECT transactionid, string_agg(itemid, ',' ORDER BY itemid) AS items_bought_together,
         count(itemid) AS items
  FROM silver WHERE event = 'transaction' GROUP BY transactionid),
metrics AS (
  SELECT time_bucket(INTERVAL 5 MINUTE, moment) AS window_start,
         time_bucket(INTERVAL 5 MINUTE, moment) + INTERVAL 5 MINUTE AS window_end,
         event, count(*) AS event_count
  FROM silver GROUP BY ALL),
behavior AS (
  SELECT time_bucket(INTERVAL 10 MINUTE, moment) AS window_start,
         time_bucket(INTERVAL 10 MINUTE, moment) + INTERVAL 10 MINUTE AS window_end, visitorid,
         count(*) AS total_events, count(*) FILTER (WHERE event = 'view') AS views,
         count(*) FILTER (WHERE event = 'addtocart') AS addtocarts,
         count(*) FILTER (WHERE event = 'transaction') AS transactions,
         count(DISTINCT itemid) AS unique_items
  FROM silver GROUP BY 1, 2, 3),
popularity AS (
  SELECT time_bucket(INTERVAL 15 MINUTE, moment) AS window_start,
         time_bucket(INTERVAL 15 MINUTE, moment) + INTERVAL 15 MINUTE AS window_end, itemid,
         count(*) AS interactions,
         count(*) FILTER (WHERE event = 'transaction') AS purchases
  FROM silver GROUP BY 1, 2, 3),
checked AS (
  SELECT CASE WHEN event IN ('view', 'addtocart', 'transaction') THEN 'passed' ELSE 'failed' END
           AS validation_status,
         CASE WHEN event NOT IN ('view', 'addtocart', 'transaction') THEN 'unknown_event' END
           AS validation_error
  FROM bronze)
"""

_RAW = 'SELECT "timestamp", itemid, property, "value" FROM raw'
_SILVER = (
    "SELECT *, CAST(year(event_date) AS INTEGER) AS event_year, "
    "CAST(month(event_date) AS INTEGER) AS event_month FROM silver"
)
_EVENT_COLUMNS = '"timestamp", visitorid, event, itemid, transactionid'
_JOURNEY = f"SELECT {_EVENT_COLUMNS}, event_time, event_order FROM journey"
_BASKET = "SELECT transactionid, items_bought_together FROM basket"
_CLOSED = "WHERE window_end <= (SELECT max(moment) FROM silver) - INTERVAL 10 MINUTE"

_OVER_PROPERTIES = {
    "bronze_item_properties": _RAW,
    "csv_inferred_preview": _RAW,
    "bronze_preview": f'{_RAW} ORDER BY "timestamp" NULLS FIRST, itemid NULLS FIRST, '
    'property NULLS FIRST, "value" NULLS FIRST LIMIT 10',
    "bronze_completeness": 'SELECT count(*) AS total_records, count("timestamp") AS has_timestamp, '
    "count(itemid) AS has_itemid, count(property) AS has_property, "
    'count("value") AS has_value, count(*) - count("timestamp") AS missing_timestamp FROM raw',
    "bronze_completeness_stored": 'SELECT count(*) AS total_records, count("timestamp") AS has_timestamp, '
    "count(itemid) AS has_itemid, count(property) AS has_property, "
    'count("value") AS has_value, count(*) - count("timestamp") AS missing_timestamp FROM raw',
    "dedup_ratio": "SELECT (SELECT count(*) FROM raw) AS input_rows, count(*) AS output_rows, "
    "CAST((SELECT count(*) FROM raw) AS DOUBLE) / nullif(count(*), 0) AS dedup_ratio FROM silver",
    "schema_evolution_append": f"{_RAW.replace(' FROM', ', CAST(NULL AS VARCHAR) AS _load_id FROM')}"
    f" UNION ALL {_RAW.replace(' FROM', ', ' + chr(39) + 'second' + chr(39) + ' FROM')}",
    "schema_evolution_catalog": f"{_RAW.replace(' FROM', ', CAST(NULL AS VARCHAR) AS _load_id FROM')}"
    f" UNION ALL {_RAW.replace(' FROM', ', ' + chr(39) + 'second' + chr(39) + ' FROM')}",
    "schema_evolution_stream": f"{_RAW.replace(' FROM', ', CAST(NULL AS VARCHAR) AS _load_id FROM')}"
    f" UNION ALL {_RAW.replace(' FROM', ', ' + chr(39) + 'second' + chr(39) + ' FROM')}",
    "csv_inferred_stream": _RAW,
    "silver_documented_required": "SELECT timestamp_unix, "
    "make_timestamp((timestamp_unix // 1000) * 1000000) AS event_time, item_id, property_id, "
    "property_value, CAST(make_timestamp((timestamp_unix // 1000) * 1000000) AS DATE) AS event_date, "
    "CAST(year(make_timestamp(timestamp_unix * 1000)) AS INTEGER) AS event_year, "
    "CAST(month(make_timestamp(timestamp_unix * 1000)) AS INTEGER) AS event_month "
    'FROM (SELECT "timestamp" AS timestamp_unix, itemid AS item_id, property_id, '
    '"value" AS property_value, row_number() OVER (PARTITION BY itemid, property_id '
    'ORDER BY "timestamp" DESC, "value" DESC) AS rn FROM (SELECT *, '
    "CASE WHEN property % 3 <> 0 THEN property END AS property_id FROM raw "
    'WHERE itemid % 5 <> 0 AND "timestamp" IS NOT NULL)) WHERE rn = 1',
    "silver_incremental": _SILVER,
    "silver_item_properties": _SILVER,
    "silver_partitioned_table": _SILVER,
    "silver_quality": "SELECT count(*) AS total_records, count(DISTINCT item_id) AS unique_items, "
    "count(DISTINCT property_id) AS unique_properties, min(event_time) AS earliest_event, "
    "max(event_time) AS latest_event, count(DISTINCT event_date) AS date_range FROM silver",
    "silver_null_check": "SELECT count(*) FILTER (WHERE item_id IS NULL) AS null_item_id, "
    "count(*) FILTER (WHERE property_id IS NULL) AS null_property_id FROM silver",
    "item_property_summary": "SELECT * FROM summary",
    "top_enriched_items": "SELECT * FROM summary ORDER BY property_count DESC, item_id LIMIT 10",
    "batch_layer_gold": "SELECT * FROM summary",
    "property_statistics": "SELECT * FROM statistics",
    "top_properties": "SELECT * FROM statistics "
    "ORDER BY total_property_records DESC, property_id LIMIT 10",
    "item_property_lists": "SELECT item_id, count(property_id) AS total_properties, "
    "count(DISTINCT property_id) AS unique_properties, max(event_date) AS last_updated, "
    "string_agg(CAST(property_id AS VARCHAR), ',' ORDER BY property_id, property_value) "
    "AS property_ids, string_agg(property_value, ',' ORDER BY property_id, property_value) "
    "AS property_values FROM silver GROUP BY item_id",
    "property_count_per_item": "SELECT item_id, count(*) AS property_count FROM silver "
    "GROUP BY item_id",
    "gold_lineage": "SELECT 'item_property_summary' AS table_name, count(*) AS record_count, "
    "count(DISTINCT item_id) AS unique_items FROM summary UNION ALL "
    "SELECT 'property_statistics', count(*), count(DISTINCT property_id) FROM statistics",
}

_OVER_EVENTS = {
    "publish_events": f"SELECT itemid AS key, {_EVENT_COLUMNS}, TRUE AS has_ingestion_id, "
    "TRUE AS has_ingestion_time, TRUE AS has_source_file, 'passed' AS validation_status "
    "FROM bronze",
    "publish_counts": "SELECT count(*) FILTER (WHERE CAST(_ingestion_id AS BIGINT) % 10 <> 0) "
    "AS successful, count(*) FILTER (WHERE CAST(_ingestion_id AS BIGINT) % 10 = 0) AS failed FROM bronze",
    "publish_rejected": 'SELECT "timestamp", CAST(NULL AS VARCHAR) AS visitorid, event, itemid, '
    "transactionid, 'missing_visitorid' AS validation_error FROM bronze "
    "WHERE CAST(_ingestion_id AS BIGINT) % 10 = 0",
    "malformed_payloads": "SELECT 'published' AS part, count(*) AS record_count FROM bronze UNION ALL "
    "SELECT 'malformed', count(*) FROM bronze WHERE CAST(itemid AS INTEGER) % 8 = 0 UNION ALL "
    "SELECT 'silver', count(*) FROM silver WHERE CAST(itemid AS INTEGER) % 8 <> 0",
    "bronze_processing_time": f"SELECT {_EVENT_COLUMNS}, TRUE AS stamped FROM bronze",
    "silver_events_documented": "SELECT CAST(event_id AS VARCHAR) AS _ingestion_id, "
    'CAST(epoch_us(ts) // 1000 AS VARCHAR) AS "timestamp", CAST(user_id AS VARCHAR) AS visitorid, '
    "event_type AS event, make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS event_time, "
    "CAST(ts AS DATE) AS event_date, CAST(hour(ts) AS INTEGER) AS event_hour FROM events "
    "WHERE user_id % 7 <> 0 "
    "AND event_type IN ('view', 'click', 'purchase', 'add_to_cart', 'remove_from_cart')",
    "silver_events_restarted": f"SELECT {_EVENT_COLUMNS}, event_time FROM silver",
    "bronze_events": f"SELECT {_EVENT_COLUMNS} FROM bronze",
    "bronze_events_stream": f"SELECT {_EVENT_COLUMNS} FROM bronze",
    "events_renamed": 'SELECT "timestamp" AS event_time, visitorid AS visitor_id, '
    "event AS event_type, itemid AS item_id, transactionid AS transaction_id FROM bronze",
    "silver_events": f"SELECT {_EVENT_COLUMNS}, event_time FROM silver",
    "silver_events_stream": f"SELECT {_EVENT_COLUMNS}, event_time FROM silver",
    "silver_events_validated": 'SELECT "timestamp", visitorid, lower(event) AS event, itemid, '
    "transactionid, _ingestion_id, CAST(ingested_ms AS VARCHAR) AS _ingestion_timestamp, "
    "make_timestamp((ms // 1000) * 1000000) AS event_time, "
    "CAST(make_timestamp(ms * 1000) AS DATE) AS event_date, "
    "CAST(hour(make_timestamp(ms * 1000)) AS INTEGER) AS event_hour FROM bronze "
    "WHERE event IN ('view', 'addtocart', 'transaction')",
    "events_date_parts": "SELECT _ingestion_id, make_timestamp((ms // 1000) * 1000000) "
    "AS event_time, CAST(make_timestamp(ms * 1000) AS DATE) AS event_date, "
    "CAST(year(make_timestamp(ms * 1000)) AS INTEGER) AS event_year, "
    "CAST(month(make_timestamp(ms * 1000)) AS INTEGER) AS event_month, "
    "CAST(hour(make_timestamp(ms * 1000)) AS INTEGER) AS event_hour FROM bronze",
    "ingestion_latency": "SELECT ms AS event_timestamp, visitorid, event, "
    "CAST(itemid AS INTEGER) AS item_id, CAST(make_timestamp(ms * 1000) AS DATE) AS event_date, "
    "CAST(ingested_ms - ms AS DOUBLE) / 1000.0 AS ingestion_latency_seconds FROM bronze",
    "events_appended_by_date": f"SELECT {_EVENT_COLUMNS}, "
    "CAST(make_timestamp(ms * 1000) AS DATE) AS event_date FROM bronze",
    "events_batch_callback": f"SELECT {_EVENT_COLUMNS}, TRUE AS enriched FROM bronze",
    "events_quarantine": f"SELECT {_EVENT_COLUMNS}, 'failed' AS validation_status, "
    "'unknown_event' AS validation_error FROM bronze "
    "WHERE event NOT IN ('view', 'addtocart', 'transaction')",
    "events_validation_report": "SELECT validation_status, validation_error, "
    "count(*) AS record_count FROM checked GROUP BY ALL",
    "validation_error_count": "SELECT count(*) AS errors FROM checked "
    "WHERE validation_status = 'failed'",
    "events_overview": "SELECT count(*) AS total_events, count(DISTINCT visitorid) AS "
    "unique_visitors, count(DISTINCT itemid) AS unique_items FROM bronze",
    "events_overview_by_load": "SELECT count(*) AS total_events, count(DISTINCT visitorid) AS "
    "unique_visitors, count(DISTINCT itemid) AS unique_items FROM bronze",
    "events_by_type": "SELECT event, count(*) AS event_count FROM bronze GROUP BY event",
    "event_timeline": "SELECT event_time, count(*) AS event_count FROM silver GROUP BY event_time",
    "top_visitors": "SELECT visitorid, count(*) AS event_count FROM silver GROUP BY visitorid "
    "ORDER BY event_count DESC, visitorid LIMIT 20",
    "top_items": "SELECT itemid, count(*) AS event_count FROM silver GROUP BY itemid "
    "ORDER BY event_count DESC, itemid LIMIT 20",
    "data_freshness": "SELECT max(ingested_ms) AS last_ingestion_ms FROM bronze",
    "ingestion_rate_daily": "SELECT CAST(make_timestamp(ingested_ms * 1000) AS DATE) "
    "AS ingestion_date, count(*) AS record_count FROM bronze GROUP BY 1 ORDER BY 1 DESC LIMIT 7",
    "ingestion_rate_hourly": "SELECT make_timestamp((ingested_ms // 3600000) * 3600000000) "
    "AS ingestion_hour, count(*) AS records FROM bronze GROUP BY 1",
    "visitor_profile": "SELECT * FROM profile",
    "top_viewers": "SELECT * FROM profile ORDER BY total_viewcount DESC, visitorid LIMIT 20",
    "visitor_profile_stream": "SELECT visitorid, total_viewcount, total_addtocart, "
    "bought_something, TRUE AS unique_items_close FROM profile",
    "customer_journey": _JOURNEY,
    "customer_journey_stream": _JOURNEY,
    "visitor_journey_lookup": f"{_JOURNEY} WHERE visitorid = '{LOOKUP_VISITOR}'",
    "item_cooccurrence": _BASKET,
    "item_cooccurrence_stream": _BASKET,
    "baskets_containing_item": f"{_BASKET} "
    f"WHERE list_contains(string_split(items_bought_together, ','), '{LOOKUP_ITEM}')",
    "event_metrics_5m": "SELECT * FROM metrics",
    "event_metrics_5m_stream": "SELECT * FROM metrics",
    "event_metrics_5m_watermark": f"SELECT * FROM metrics {_CLOSED}",
    "visitor_behavior_10m_watermark": "SELECT * EXCLUDE (unique_items), "
    f"TRUE AS unique_items_close FROM behavior {_CLOSED}",
    "item_popularity_15m_watermark": f"SELECT * FROM popularity {_CLOSED}",
    "visitor_behavior_10m": "SELECT * FROM behavior",
    "visitor_behavior_10m_stream": "SELECT * EXCLUDE (unique_items), "
    "TRUE AS unique_items_close FROM behavior",
    "item_popularity_15m": "SELECT * FROM popularity",
    "item_popularity_15m_stream": "SELECT * FROM popularity",
    "trending_items": "SELECT * FROM popularity "
    "ORDER BY interactions DESC, window_start, itemid LIMIT 20",
    "recent_event_volume": "SELECT event, count(*) AS windows, "
    "CAST(sum(event_count) AS BIGINT) AS event_count FROM metrics "
    "WHERE window_end > (SELECT max(window_end) FROM metrics) - INTERVAL 1 HOUR GROUP BY event",
    "recent_event_volume_stored": "SELECT event, count(*) AS windows, "
    "CAST(sum(event_count) AS BIGINT) AS event_count FROM metrics "
    "WHERE window_end > (SELECT max(window_end) FROM metrics) - INTERVAL 1 HOUR GROUP BY event",
    "event_metrics_5m_corrected": "SELECT * FROM metrics",
    "visitor_behavior_10m_corrected": "SELECT * FROM behavior",
    "item_popularity_15m_corrected": "SELECT * FROM popularity",
    "speed_layer_gold": "SELECT 'visitor_profile' AS table_name, count(*) AS record_count, "
    "count(DISTINCT visitorid) AS unique_keys, "
    "CAST(sum(total_viewcount) AS BIGINT) AS checksum FROM profile UNION ALL "
    "SELECT 'customer_journey', count(*), count(DISTINCT (visitorid, itemid)), "
    "CAST(sum(event_order) AS BIGINT) FROM journey UNION ALL "
    "SELECT 'item_cooccurrence', count(*), count(DISTINCT transactionid), "
    "CAST(sum(items) AS BIGINT) FROM basket UNION ALL "
    "SELECT 'event_metrics', count(*), count(DISTINCT (window_start, event)), "
    "CAST(sum(event_count) AS BIGINT) FROM metrics UNION ALL "
    "SELECT 'visitor_behavior', count(*), count(DISTINCT (window_start, visitorid)), "
    "CAST(sum(total_events) AS BIGINT) FROM behavior UNION ALL "
    "SELECT 'item_popularity', count(*), count(DISTINCT (window_start, itemid)), "
    "CAST(sum(interactions) AS BIGINT) FROM popularity",
}


def all_sql() -> dict[str, str]:
    over_properties = {k: f"WITH {_PROPERTIES} {v}" for k, v in _OVER_PROPERTIES.items()}
    return over_properties | {k: f"WITH {_EVENTS} {v}" for k, v in _OVER_EVENTS.items()}
