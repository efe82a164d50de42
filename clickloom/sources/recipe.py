"""Raw clickstream derived from the ``events`` table, one output row per input row.

The rules are plain expressions that Spark and other SQL engines evaluate alike; they plant
missing ids, bad timestamps, unknown event names, broken JSON and blank agents at fixed rates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)"

RULES = {
    "event_id": "event_id",
    "source_file": "concat('events_', replace(CAST(CAST(ts AS DATE) AS STRING), '-', ''), '.csv')",
    "client_id": f"""CASE WHEN event_id % 17 <> 0 THEN
        concat('c', CAST(user_id AS STRING), '_', CAST({_K} % 2 AS STRING)) END""",
    "page_url": f"""concat('https://shop.example.com/p/', CAST({_K} AS STRING),
        CASE WHEN event_id % 5 = 0 THEN concat('?utm_source=s', CAST({_K} % 4 AS STRING),
            '&utm_medium=m', CAST({_K} % 3 AS STRING), '&utm_campaign=c', CAST({_K} % 7 AS STRING))
        ELSE '' END)""",
    "referrer": """CASE event_id % 6 WHEN 1 THEN '' WHEN 2 THEN 'https://www.Google.com/'
        WHEN 3 THEN 'https://bing.com/' WHEN 4 THEN 'https://yahoo.com/'
        WHEN 5 THEN 'https://blog.example.net/' END""",
    "timestamp": """CASE WHEN event_id % 101 = 0 THEN 'not-a-time'
        ELSE concat(replace(CAST(ts AS STRING), ' ', 'T'), 'Z') END""",
    "event_name": """CASE WHEN event_id % 97 = 0 THEN 'bogus' WHEN event_type = 'view' THEN ' Page_Viewed '
        WHEN event_type = 'click' THEN 'product_added_to_cart'
        WHEN event_type = 'signup' THEN 'email_filled_on_popup'
        WHEN event_type = 'error' THEN 'checkout_started' ELSE 'checkout_completed' END""",
    "event_data": f"""CASE WHEN event_id % 103 = 0 THEN '{{bad' WHEN event_id % 107 = 0 THEN '[1]'
        WHEN event_type = 'signup' THEN
            concat('{{"user_email":"u', CAST(user_id AS STRING), '@example.com"}}')
        WHEN event_type = 'purchase' THEN
            concat('{{"transaction_id":"T', CAST(event_id AS STRING), '"',
                CASE WHEN event_id % 50 = 7 THEN '' ELSE concat(',"revenue":', CAST(value AS STRING)) END,
                ',"items":[{{"item_id":"i', CAST({_K} AS STRING),
                '","item_name":"n', CAST({_K} % 10 AS STRING),
                '","item_price":', CAST(value AS STRING),
                ',"quantity":', CASE WHEN event_id % 40 = 3 THEN '2' ELSE '1' END, '}}]}}')
        WHEN event_id % 2 = 0 THEN 'null' END""",
    "user_agent": f"""CASE WHEN event_id % 109 = 0 THEN '  '
        WHEN {_K} % 8 = 0 THEN 'Mozilla/5.0 (iPhone; CPU iPhone OS 17_0 like Mac OS X) Mobile Safari/604.1'
        WHEN {_K} % 8 = 1 THEN 'Mozilla/5.0 (Linux; Android 14) Chrome/120.0 Mobile Safari/537.36'
        WHEN {_K} % 8 = 2 THEN 'Mozilla/5.0 (iPad; CPU OS 17_0 like Mac OS X) Safari/604.1'
        WHEN {_K} % 8 = 3 THEN 'Mozilla/5.0 (Windows NT 10.0) Chrome/120.0 Safari/537.36 Edg/120.0'
        WHEN {_K} % 8 = 4 THEN 'Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15) Safari/605.1'
        WHEN {_K} % 8 = 5 THEN 'Mozilla/5.0 (X11; Linux x86_64) Firefox/121.0'
        WHEN {_K} % 8 = 6 THEN 'Mozilla/5.0 (Windows NT 10.0) Chrome/120.0'
        ELSE 'curl/8' END""",
}


def raw_clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    # the number in props is searched once per row, not by each rule that asks for it
    numbered = events.selectExpr("*", f"{_K} AS props_number")
    return numbered.selectExpr(*[f"{rule.replace(_K, 'props_number')} AS {name}" for name, rule in RULES.items()])
