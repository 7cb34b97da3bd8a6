"""DuckDB SQL for the queries in ``__spark_entry__``.

Written from the definitions of the tables in their plain join form, so that
the single-pass and sweep formulations of the package are checked against it.
"""

from __future__ import annotations

EVENT_TYPES = (
    "('signup', 'login', 'page_view', 'purchase', 'refund', 'trial_start', 'trial_convert',"
    " 'cancel')"
)


def cents(expression: str) -> str:
    """Round half up on the decimal value of a double, as Spark does."""
    return f"CAST(round(CAST({expression} AS DECIMAL(38, 10)), 2) AS DOUBLE)"


def total(expression: str) -> str:
    return f"CAST(SUM(CAST({expression} AS DECIMAL(24, 9))) AS DOUBLE)"


CTES = {
    "customers": "SELECT c_custkey, lower(c_mktsegment) AS channel FROM customer",
    "event_copies": """
        SELECT *, 0 AS copy FROM events
        UNION ALL SELECT *, 1 FROM events WHERE event_id % 20 = 0
        UNION ALL SELECT *, 2 FROM events WHERE event_id % 21 = 0""",
    "events_keyed": """
        SELECT event_id AS _key,
            CASE WHEN event_id % 71 <> 0 THEN CAST(event_id AS VARCHAR) END AS event_id,
            CASE WHEN event_id % 29 <> 0 THEN CAST(user_id AS VARCHAR) END AS user_id,
            CASE WHEN event_id % 43 = 0 THEN 'bogus'
                 WHEN event_id % 47 = 0 THEN NULL
                 WHEN event_type = 'click' THEN 'page_view'
                 WHEN event_type = 'view' THEN 'login'
                 WHEN event_type = 'error' THEN 'refund'
                 ELSE event_type END AS event_type,
            CASE WHEN event_id % 53 = 0 THEN 'not-a-time'
                 WHEN event_id % 59 = 0 THEN NULL
                 WHEN event_id % 3 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
                 WHEN event_id % 3 = 1
                     THEN strftime(ts + INTERVAL 330 MINUTE, '%Y-%m-%dT%H:%M:%S+05:30')
                 ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS timestamp,
            CASE WHEN event_id % 83 = 0 THEN NULL
                 WHEN event_id % 2 = 0 THEN 'v2' ELSE 'v1' END AS schema_version,
            CASE WHEN event_id % 67 = 0 THEN NULL
                 WHEN event_id % 61 = 0 THEN -value
                 ELSE value END + CASE WHEN copy = 2 THEN 10 ELSE 0 END AS amount,
            CASE WHEN event_id % 2 = 0 THEN 'USD' END AS currency,
            CASE WHEN event_id % 2 = 0
                 THEN CAST(round(CAST(value AS DECIMAL(18, 4)) * CAST(0.1 AS DECIMAL(2, 1)), 2)
                           AS DOUBLE) END AS tax,
            CAST(NULL AS VARCHAR) AS refers_to_event_id,
            CASE WHEN event_type = 'signup' THEN channel END AS acquisition_channel,
            CASE WHEN event_id % 73 = 0 THEN '{"event_id": "' || event_id END AS _rescued_data,
            TIMESTAMP '2024-02-01' + to_days(copy) AS _ingest_timestamp
        FROM event_copies LEFT JOIN customers ON c_custkey = user_id""",
    "events_bronze": "SELECT * EXCLUDE (_key) FROM events_keyed",
    "events_faults": f"""
        SELECT *,
            CASE WHEN _rescued_data IS NOT NULL THEN 'corrupted_json'
                 WHEN event_id IS NULL THEN 'null_event_id'
                 WHEN event_type IS NULL THEN 'null_event_type'
                 WHEN timestamp IS NULL THEN 'null_timestamp'
                 WHEN event_type NOT IN {EVENT_TYPES} THEN 'invalid_event_type'
            END AS _quarantine_reason
        FROM events_bronze""",
    "events_parsed": """
        SELECT *, CAST(_timestamp_utc AS DATE) AS event_date
        FROM (
            SELECT *,
                coalesce(
                    try_strptime(timestamp, '%Y-%m-%dT%H:%M:%SZ'),
                    try_strptime(timestamp, '%Y-%m-%dT%H:%M:%S%z') AT TIME ZONE 'UTC',
                    try_strptime(timestamp, '%Y-%m-%d %H:%M:%S')) AS _timestamp_utc
            FROM events_faults
            WHERE _quarantine_reason IS NULL)""",
    "events_silver": """
        SELECT event_id, user_id, user_id IS NULL AS _user_id_missing, event_type, timestamp,
            _timestamp_utc, event_date, schema_version, amount, currency, tax,
            refers_to_event_id, acquisition_channel, _ingest_timestamp
        FROM (
            SELECT *, row_number() OVER (
                PARTITION BY event_id
                ORDER BY amount DESC NULLS LAST, _ingest_timestamp DESC NULLS LAST,
                    user_id NULLS FIRST, event_type NULLS FIRST, timestamp NULLS FIRST,
                    schema_version NULLS FIRST, currency NULLS FIRST, tax NULLS FIRST,
                    refers_to_event_id NULLS FIRST, acquisition_channel NULLS FIRST) AS rn
            FROM events_parsed)
        WHERE rn = 1""",
    "known_users": "SELECT * FROM events_silver WHERE NOT _user_id_missing",
    "marketing_keyed": """
        SELECT
            CASE WHEN o_orderkey % 103 = 0 THEN NULL
                 WHEN o_orderkey % 109 = 0 THEN 'soon'
                 ELSE strftime(DATE '2024-01-01' + CAST(CASE
                     WHEN channel = 'building' AND o_orderkey % 30 IN (4, 11) THEN o_orderkey % 30 - 1
                     WHEN channel = 'building' AND o_orderkey % 30 = 5 THEN 6
                     ELSE o_orderkey % 30 END AS INTEGER), '%Y-%m-%d')
            END AS date,
            CASE WHEN o_orderkey % 101 = 0 THEN '' ELSE channel END AS channel,
            CASE WHEN o_orderkey % 107 = 0 THEN NULL
                 WHEN o_orderkey % 97 = 0 THEN -spend ELSE spend END AS spend,
            TIMESTAMP '2024-02-01' + to_days(copy) AS _ingest_timestamp,
            o_orderkey AS _key
        FROM (
            SELECT o_orderkey, channel, copy,
                CAST(round(CAST(o_totalprice AS DECIMAL(18, 4)) * CAST(0.001 AS DECIMAL(4, 3)), 2)
                     AS DOUBLE) AS spend
            FROM (SELECT *, 0 AS copy FROM orders
                  UNION ALL SELECT *, 1 FROM orders WHERE o_orderkey % 50 = 0)
            LEFT JOIN customers ON c_custkey = o_custkey)""",
    "marketing_bronze": "SELECT * EXCLUDE (_key) FROM marketing_keyed",
    "marketing_faults": """
        SELECT *,
            CASE WHEN date IS NULL THEN 'missing_date'
                 WHEN channel IS NULL OR channel = '' THEN 'missing_channel'
                 WHEN spend IS NULL THEN 'null_spend'
                 WHEN spend < 0 THEN 'negative_spend' END AS _quarantine_reason
        FROM (SELECT * REPLACE (CAST(try_strptime(date, '%Y-%m-%d') AS DATE) AS date)
              FROM marketing_bronze)""",
    "marketing_silver": """
        SELECT date, channel, spend,
            coalesce(date - lag(date) OVER (PARTITION BY channel ORDER BY date, spend) > 1, false)
                AS has_gap_before,
            _ingest_timestamp
        FROM (
            SELECT *, row_number() OVER (
                PARTITION BY date, channel, spend ORDER BY _ingest_timestamp) AS rn
            FROM marketing_faults
            WHERE _quarantine_reason IS NULL)
        WHERE rn = 1""",
    "subscriptions_bronze": """
        SELECT
            CAST(o_orderkey AS VARCHAR) AS subscription_id,
            CASE WHEN o_orderkey % 137 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS user_id,
            CASE WHEN o_orderkey % 127 = 0 THEN 'gold'
                 WHEN o_orderkey % 3 = 0 THEN 'basic'
                 WHEN o_orderkey % 3 = 1 THEN 'pro' ELSE 'team' END AS plan_id,
            CASE WHEN o_orderkey % 131 <> 0 THEN
                CAST(round(CAST(o_totalprice AS DECIMAL(18, 4)) * CAST(0.001 AS DECIMAL(4, 3)), 2)
                     AS DOUBLE) END AS price,
            'USD' AS currency,
            CASE WHEN o_orderkey % 113 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END
                AS start_date,
            CASE WHEN o_orderkey % 10 <> 0 THEN strftime(
                o_orderdate + to_days(CAST(
                    CASE WHEN o_orderkey % 139 = 0 THEN -3 ELSE o_orderkey % 90 END AS INTEGER)),
                '%Y-%m-%d') END AS end_date,
            CASE WHEN (o_orderstatus = 'F') <> (copy = 1) THEN 'canceled' ELSE 'active' END
                AS status,
            strftime(o_orderdate + to_days(copy), '%Y-%m-%d %H:%M:%S') AS created_at,
            TIMESTAMP '2024-02-01' AS _ingest_timestamp
        FROM (SELECT *, 0 AS copy FROM orders
              UNION ALL SELECT *, 1 FROM orders WHERE o_orderkey % 25 = 0)""",
    "subscriptions_checked": """
        SELECT subscription_id, user_id, plan_id, price, currency, start_date, end_date, status,
            created_at,
            coalesce(start_date <= lag(end_date) OVER history, false) AS is_overlapping,
            coalesce(lag(status) OVER history = 'canceled' AND status = 'active', false)
                AS is_reactivation,
            _ingest_timestamp
        FROM (
            SELECT * REPLACE (
                    CAST(try_strptime(start_date, '%Y-%m-%d') AS DATE) AS start_date,
                    CAST(try_strptime(end_date, '%Y-%m-%d') AS DATE) AS end_date,
                    TRY_CAST(created_at AS TIMESTAMP) AS created_at),
                row_number() OVER (
                    PARTITION BY subscription_id
                    ORDER BY TRY_CAST(created_at AS TIMESTAMP) DESC NULLS LAST,
                        status NULLS FIRST, plan_id NULLS FIRST, price NULLS FIRST,
                        start_date NULLS FIRST, end_date NULLS FIRST, user_id NULLS FIRST,
                        currency NULLS FIRST, _ingest_timestamp NULLS FIRST) AS rn
            FROM subscriptions_bronze)
        WHERE rn = 1
        WINDOW history AS (
            PARTITION BY user_id
            ORDER BY start_date NULLS FIRST, subscription_id NULLS FIRST)""",
    "subscriptions_silver": "SELECT * FROM subscriptions_checked WHERE start_date IS NOT NULL",
    "users_table": """
        SELECT c_custkey AS user_id,
            CASE WHEN c_custkey % 11 = 0 THEN NULL
                 WHEN c_custkey % 7 = 0 THEN lower(replace(c_name, '#', '.'))
                 ELSE lower(replace(c_name, '#', '.')) || '@example.com' END AS email,
            c_name AS name, c_mktsegment AS user_type
        FROM customer""",
    "gross": f"""
        SELECT event_date, {total("amount")} AS gross_revenue,
            count(event_id) AS purchase_count, count(DISTINCT user_id) AS paying_users
        FROM events_silver
        WHERE event_type = 'purchase' AND amount IS NOT NULL AND amount > 0
        GROUP BY event_date""",
    "refunds": f"""
        SELECT event_date, {total("abs(coalesce(amount, 0))")} AS total_refunds
        FROM events_silver WHERE event_type = 'refund' GROUP BY event_date""",
    "signup_weeks": """
        SELECT user_id, CAST(date_trunc('week', min(_timestamp_utc)) AS DATE) AS cohort_week
        FROM known_users WHERE event_type = 'signup' GROUP BY user_id""",
    "active_weeks": """
        SELECT DISTINCT user_id, CAST(date_trunc('week', _timestamp_utc) AS DATE) AS activity_week
        FROM known_users""",
    "cohort_sizes": """
        SELECT cohort_week, count(DISTINCT user_id) AS cohort_size
        FROM signup_weeks GROUP BY cohort_week""",
    "cohort_activity": """
        SELECT cohort_week, weeks_since_signup, count(DISTINCT user_id) AS active_users
        FROM (SELECT user_id, cohort_week,
                  CAST((activity_week - cohort_week) / 7 AS INTEGER) AS weeks_since_signup
              FROM signup_weeks JOIN active_weeks USING (user_id))
        WHERE weeks_since_signup >= 0
        GROUP BY cohort_week, weeks_since_signup""",
    "user_purchases": f"""
        SELECT user_id, {total("amount")} AS total_purchases, count(event_id) AS purchase_count
        FROM known_users WHERE event_type = 'purchase' AND amount > 0 GROUP BY user_id""",
    "user_refunds": f"""
        SELECT user_id, {total("abs(amount)")} AS total_refunds
        FROM known_users WHERE event_type = 'refund' GROUP BY user_id""",
    "user_channels": """
        SELECT user_id, acquisition_channel
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY user_id
                  ORDER BY _timestamp_utc IS NULL, _timestamp_utc, event_id) AS rn
              FROM known_users
              WHERE event_type = 'signup' AND acquisition_channel IS NOT NULL)
        WHERE rn = 1""",
    "user_sights": """
        SELECT user_id, min(_timestamp_utc) AS first_seen, max(_timestamp_utc) AS last_seen
        FROM known_users GROUP BY user_id""",
    "ltv": f"""
        SELECT user_id, acquisition_channel, first_seen, last_seen,
            CAST(CAST(last_seen AS DATE) - CAST(first_seen AS DATE) AS INTEGER)
                AS customer_lifetime_days,
            purchase_count,
            coalesce(total_purchases, 0.0) AS total_purchases,
            coalesce(total_refunds, 0.0) AS total_refunds,
            {cents("coalesce(total_purchases, 0.0) - coalesce(total_refunds, 0.0)")} AS ltv
        FROM user_sights
        LEFT JOIN user_channels USING (user_id)
        LEFT JOIN user_purchases USING (user_id)
        LEFT JOIN user_refunds USING (user_id)""",
    "new_customers": """
        SELECT event_date AS date, acquisition_channel AS channel,
            count(DISTINCT user_id) AS new_customers
        FROM known_users
        WHERE event_type = 'signup' AND acquisition_channel IS NOT NULL
        GROUP BY event_date, acquisition_channel""",
    "daily_spend": f"""
        SELECT date, channel, {total("spend")} AS total_spend
        FROM marketing_silver GROUP BY date, channel""",
    "cac": f"""
        SELECT coalesce(s.date, n.date) AS date, coalesce(s.channel, n.channel) AS channel,
            coalesce(total_spend, 0.0) AS total_spend,
            coalesce(new_customers, 0) AS new_customers,
            CASE WHEN total_spend > 0 AND new_customers > 0
                 THEN {cents("total_spend / new_customers")} END AS cac
        FROM daily_spend s FULL JOIN new_customers n
            ON s.date = n.date AND s.channel = n.channel""",
    "channel_value": f"""
        SELECT acquisition_channel, avg(CAST(ltv AS DECIMAL(24, 9))) AS avg_ltv,
            count(user_id) AS total_customers, {total("ltv")} AS total_ltv
        FROM ltv WHERE acquisition_channel IS NOT NULL GROUP BY acquisition_channel""",
    "channel_spend": f"""
        SELECT channel, {total("spend")} AS total_spend FROM marketing_silver GROUP BY channel""",
    "channel_cost": f"""
        SELECT channel, total_spend, {cents("total_spend / acquired")} AS avg_cac
        FROM (SELECT channel, CAST(sum(new_customers) AS BIGINT) AS acquired
              FROM cac WHERE new_customers > 0 GROUP BY channel)
        LEFT JOIN channel_spend USING (channel)""",
    "channel_ratio": f"""
        SELECT *, CASE WHEN avg_cac > 0 THEN {cents("avg_ltv / avg_cac")} END AS ltv_cac_ratio
        FROM channel_value LEFT JOIN channel_cost ON acquisition_channel = channel""",
    "days": """
        SELECT CAST(unnest(generate_series(
                   min(start_date)::TIMESTAMP, max(greatest(start_date, end_date))::TIMESTAMP, INTERVAL 1 DAY)) AS DATE)
               AS spine_date
        FROM subscriptions_silver""",
    "spine": """
        SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-08-01',
                                           INTERVAL 1 DAY)) AS DATE) AS spine_date""",
}

# What each CTE reads, so that a query carries only what it needs.
NEEDS = {
    "event_copies": [],
    "events_keyed": ["customers", "event_copies"],
    "events_bronze": ["events_keyed"],
    "events_faults": ["events_bronze"],
    "events_parsed": ["events_faults"],
    "events_silver": ["events_parsed"],
    "known_users": ["events_silver"],
    "marketing_keyed": ["customers"],
    "marketing_bronze": ["marketing_keyed"],
    "marketing_faults": ["marketing_bronze"],
    "marketing_silver": ["marketing_faults"],
    "subscriptions_checked": ["subscriptions_bronze"],
    "subscriptions_silver": ["subscriptions_checked"],
    "days": ["subscriptions_silver"],
    "gross": ["events_silver"],
    "refunds": ["events_silver"],
    "signup_weeks": ["known_users"],
    "active_weeks": ["known_users"],
    "cohort_sizes": ["signup_weeks"],
    "cohort_activity": ["signup_weeks", "active_weeks"],
    "user_purchases": ["known_users"],
    "user_refunds": ["known_users"],
    "user_channels": ["known_users"],
    "user_sights": ["known_users"],
    "ltv": ["user_sights", "user_channels", "user_purchases", "user_refunds"],
    "new_customers": ["known_users"],
    "daily_spend": ["marketing_silver"],
    "cac": ["daily_spend", "new_customers"],
    "channel_value": ["ltv"],
    "channel_spend": ["marketing_silver"],
    "channel_cost": ["cac", "channel_spend"],
    "channel_ratio": ["channel_value", "channel_cost"],
}


def with_tables(names: list[str], select: str, given: tuple[str, ...] = ()) -> str:
    """``select`` over the named CTEs; ``given`` are tables the database has."""
    needed: set[str] = set()

    def add(name: str) -> None:
        if name not in given:
            needed.add(name)
            for other in NEEDS.get(name, []):
                add(other)

    for name in names:
        add(name)
    parts = [f"{name} AS ({CTES[name]})" for name in CTES if name in needed]
    return f"WITH {', '.join(parts)} {select}"


def _rule(dataset: str, table: str, rule: str, action: str, predicate: str) -> str:
    return (
        f"SELECT '{dataset}' AS dataset, '{rule}' AS rule, '{action}' AS action,"
        f" count(*) FILTER (WHERE coalesce({predicate}, false)) AS passed,"
        f" count(*) FILTER (WHERE NOT coalesce({predicate}, false)) AS failed FROM {table}"
    )


EXPECTATIONS = " UNION ALL ".join(
    [
        _rule("events_silver", "events_silver", rule, "warn", predicate)
        for rule, predicate in [
            ("event_id_not_null", "event_id IS NOT NULL"),
            ("valid_event_type", f"event_type IN {EVENT_TYPES}"),
            ("normalized_timestamp_not_null", "_timestamp_utc IS NOT NULL"),
            ("non_negative_amount", "amount IS NULL OR amount >= 0"),
        ]
    ]
    + [
        _rule("marketing_spend_silver", "marketing_silver", rule, action, predicate)
        for rule, action, predicate in [
            ("valid_date", "drop", "date IS NOT NULL"),
            ("valid_channel", "drop", "channel IS NOT NULL AND channel <> ''"),
            ("non_negative_spend", "drop", "spend >= 0"),
            ("spend_not_null", "warn", "spend IS NOT NULL"),
        ]
    ]
    + [
        _rule("subscriptions_silver", "subscriptions_checked", rule, action, predicate)
        for rule, action, predicate in [
            ("valid_status", "warn", "status IN ('active', 'canceled')"),
            ("valid_plan", "warn", "plan_id IN ('basic', 'pro', 'team')"),
            ("valid_price", "warn", "price > 0"),
            ("user_id_not_null", "warn", "user_id IS NOT NULL"),
            ("valid_start_date", "drop", "start_date IS NOT NULL"),
            ("end_after_start", "warn", "end_date IS NULL OR end_date >= start_date"),
        ]
    ]
)

_RESCUED = """
    SELECT
        CASE WHEN _rescued_data IS NULL THEN event_id END AS event_id,
        CASE WHEN _rescued_data IS NULL THEN user_id END AS user_id,
        CASE WHEN _rescued_data IS NULL THEN event_type END AS event_type,
        CASE WHEN _rescued_data IS NULL THEN timestamp END AS timestamp,
        CASE WHEN _rescued_data IS NULL THEN schema_version END AS schema_version,
        CASE WHEN _rescued_data IS NULL THEN amount END AS amount,
        CASE WHEN _rescued_data IS NULL THEN currency END AS currency,
        CASE WHEN _rescued_data IS NULL THEN tax END AS tax,
        CAST(NULL AS VARCHAR) AS refers_to_event_id,
        CASE WHEN _rescued_data IS NULL THEN acquisition_channel END AS acquisition_channel,
        _rescued_data,
        CASE WHEN _rescued_data IS NULL THEN nullif(concat_ws(';',
            CASE WHEN _key % 37 = 0 AND _key % 83 <> 0 THEN 'schema_version=v0' END,
            CASE WHEN _key % 31 = 0 THEN 'campaign=c' || (_key % 7) END,
            CASE WHEN _key % 41 = 0 THEN 'device={"os":"x","v":' || (_key % 7) || '}' END), '')
        END AS _extra_fields,
        TIMESTAMP '2024-02-01' AS _ingest_timestamp
    FROM events_keyed"""

_GROSS = """
    SELECT event_date, round(gross_revenue, 2) AS gross_revenue, purchase_count, paying_users
    FROM gross"""


def oracle_sql() -> dict[str, str]:
    return {
        "events_bronze": with_tables(["events_keyed"], _RESCUED),
        "marketing_spend_bronze": with_tables(
            ["marketing_keyed"],  # a CSV field without text is read as null
            "SELECT date, nullif(channel, '') AS channel, CAST(spend AS VARCHAR) AS spend,"
            " CAST(NULL AS VARCHAR) AS _rescued_data,"
            " CASE WHEN _key % 3 = 1 THEN 'note=n, ' || (_key % 7) END AS _extra_fields,"
            " TIMESTAMP '2024-02-01' AS _ingest_timestamp FROM marketing_keyed",
        ),
        "subscriptions_bronze": with_tables(
            ["subscriptions_bronze"],
            "SELECT * REPLACE (CAST(price AS VARCHAR) AS price),"
            " CAST(NULL AS VARCHAR) AS _rescued_data,"
            " CASE WHEN CAST(subscription_id AS BIGINT) % 151 = 0 THEN 'referrer={\"k\":'"
            " || (CAST(subscription_id AS BIGINT) % 5) || '}' END AS _extra_fields"
            " FROM subscriptions_bronze UNION ALL BY NAME"
            " SELECT '{\"subscription_id\": \"' || subscription_id || '\", \"pri' AS _rescued_data,"
            " TIMESTAMP '2024-02-01' AS _ingest_timestamp"
            " FROM subscriptions_bronze WHERE CAST(subscription_id AS BIGINT) % 149 = 0",
        ),
        "events_quarantine": with_tables(
            ["events_faults"],
            "SELECT * FROM events_faults WHERE _quarantine_reason IS NOT NULL",
        ),
        "marketing_spend_quarantine": with_tables(
            ["marketing_faults"],
            "SELECT * FROM marketing_faults WHERE _quarantine_reason IS NOT NULL",
        ),
        "normalized_timestamps": with_tables(
            ["events_parsed"],
            "SELECT event_id, timestamp, _timestamp_utc, event_date FROM events_parsed",
        ),
        "unified_event_schema": with_tables(
            ["events_bronze"],
            "SELECT event_id, schema_version, currency, tax, refers_to_event_id, user_id,"
            " user_id IS NULL AS _user_id_missing FROM events_bronze",
        ),
        "events_silver": with_tables(["events_silver"], "SELECT * FROM events_silver"),
        "marketing_spend_silver": with_tables(["marketing_silver"], "SELECT * FROM marketing_silver"),
        "subscriptions_silver": with_tables(
            ["subscriptions_silver"], "SELECT * FROM subscriptions_silver"
        ),
        "expectation_report": with_tables(
            ["events_silver", "marketing_silver", "subscriptions_checked"], EXPECTATIONS
        ),
        "daily_active_users": with_tables(
            ["known_users"],
            "SELECT event_date, count(DISTINCT user_id) AS dau, count(event_id) AS total_events"
            " FROM known_users GROUP BY event_date",
        ),
        "daily_revenue_gross": with_tables(["gross"], _GROSS),
        "daily_revenue_net": with_tables(
            ["gross", "refunds"],
            "SELECT g.event_date, round(gross_revenue, 2) AS gross_revenue,"
            " round(coalesce(total_refunds, 0), 2) AS total_refunds,"
            " round(gross_revenue - coalesce(total_refunds, 0), 2) AS net_revenue"
            " FROM gross g LEFT JOIN refunds r ON g.event_date = r.event_date",
        ),
        "weekly_cohort_retention": with_tables(
            ["cohort_activity", "cohort_sizes"],
            "SELECT cohort_week, weeks_since_signup, active_users, cohort_size,"
            " CAST(round(CAST(active_users / cohort_size AS DECIMAL(38, 10)), 4) AS DOUBLE)"
            " AS retention_rate"
            " FROM cohort_activity JOIN cohort_sizes USING (cohort_week)",
        ),
        "ltv_per_user": with_tables(
            ["ltv"],
            "SELECT * REPLACE (round(total_purchases, 2) AS total_purchases,"
            " round(total_refunds, 2) AS total_refunds) FROM ltv",
        ),
        "cac_by_channel": with_tables(
            ["cac"], "SELECT * REPLACE (round(total_spend, 2) AS total_spend) FROM cac"
        ),
        "mrr_daily": with_tables(
            ["subscriptions_silver", "spine"],
            f"SELECT spine_date AS date, round({total('price')}, 2) AS mrr,"
            " count(DISTINCT subscription_id) AS active_subscriptions,"
            " count(DISTINCT user_id) AS subscribed_users"
            " FROM spine LEFT JOIN"
            " (SELECT * FROM subscriptions_silver WHERE status = 'active') s"
            " ON s.start_date <= spine_date"
            " AND (s.end_date IS NULL OR s.end_date >= spine_date)"
            " GROUP BY spine_date",
        ),
        "ltv_cac_ratio": with_tables(
            ["channel_ratio"],
            "SELECT acquisition_channel, total_customers, round(avg_ltv, 6) AS avg_ltv,"
            " round(total_ltv, 2) AS total_ltv, avg_cac, round(total_spend, 2) AS total_spend,"
            " ltv_cac_ratio, ltv_cac_ratio >= 3.0 AS is_healthy FROM channel_ratio",
        ),
        "date_spine": with_tables(["days"], "SELECT spine_date FROM days"),
        "table_roundtrip": with_tables(["gross"], _GROSS),
        "users": with_tables(["users_table"], "SELECT * FROM users_table"),
        "email_validity_by_user_type": with_tables(
            ["users_table"],
            "SELECT user_type, count(user_id) AS total_count,"
            " count(*) FILTER (WHERE coalesce(regexp_matches(email,"
            " '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{2,}$'), false)) AS count_valid_emails"
            " FROM users_table GROUP BY user_type",
        ),
        "user_type_counts": with_tables(
            ["users_table"],
            "SELECT user_type, count(user_type) AS total_count FROM users_table"
            " GROUP BY user_type",
        ),
    }
