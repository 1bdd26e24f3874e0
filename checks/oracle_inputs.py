"""SQL for the mapped input tables, one named subquery each."""

import re

K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

# Bands as (least, greatest, label), both inclusive; None is open.
BANDS = {
    "views": [
        (0, 0, "0"), (1, 10, "1-10"), (11, 100, "11-100"), (101, 1000, "101-1K"), (1001, 10000, "1K-10K"),
        (10001, None, "10K+"),
    ],
    "length": [(None, 30, "0-30 days"), (31, 60, "31-60 days"), (61, 90, "61-90 days"), (91, None, "90+ days")],
    "matrix_stage": [(None, 30, "new"), (31, 90, "early"), (91, 365, "established"), (366, None, "veteran")],
    "lifecycle_stage": [(None, 30, "new"), (31, 90, "early"), (91, None, "established")],
    "funnel": [
        (None, 30, "New Subscribers (0-30 days)"), (31, 90, "Early Stage (31-90 days)"),
        (91, 365, "Established (91-365 days)"), (366, None, "Veteran (365+ days)"),
    ],
    "age_stage": [
        (None, 30, "New (0-30 days)"), (31, 90, "Early (31-90 days)"), (91, 365, "Established (91-365 days)"),
        (366, None, "Veteran (365+ days)"),
    ],
    "survival": [
        (None, 30, "Month 1"), (31, 60, "Month 2"), (61, 90, "Month 3"), (91, 120, "Month 4"),
        (121, 150, "Month 5"), (151, 180, "Month 6"), (181, None, "Month 6+"),
    ],
    "adoption": [
        (5, None, "Power User (5+ features)"), (3, 4, "Regular User (3-4 features)"),
        (1, 2, "Basic User (1-2 features)"), (None, 0, "Feature Averse (0 features)"),
    ],
}


def band_rows(name):
    """The band as a VALUES list."""
    far = 9_000_000_000
    return ", ".join(
        f"({-far if least is None else least}, {far if greatest is None else greatest}, '{label}')"
        for least, greatest, label in BANDS[name]
    )


def band(name, value):
    """The label of a value, looked up in the band's table."""
    return f"(SELECT label FROM (VALUES {band_rows(name)}) AS b(least, greatest, label) WHERE {value} BETWEEN least AND greatest)"


INPUTS = {
    "behavior": f"""
        SELECT CAST(user_id AS VARCHAR) AS user_id,
               ts AS "timestamp",
               CAST(user_id AS VARCHAR) || '_' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id,
               CASE event_type WHEN 'signup' THEN 'login' WHEN 'view' THEN 'page_view'
                    WHEN 'error' THEN 'support_ticket' ELSE 'feature_use' END AS action_type,
               CASE WHEN event_type IN ('click', 'purchase') THEN
                    CASE {K} % 6 WHEN 0 THEN 'dashboard' WHEN 1 THEN 'analytics' WHEN 2 THEN 'reports'
                         WHEN 3 THEN 'integrations' WHEN 4 THEN 'api_access' ELSE 'support_portal' END
               END AS feature_name,
               CASE WHEN event_type IN ('view', 'click', 'purchase') THEN CAST(floor(value) AS INTEGER) END
                    AS duration_seconds,
               CASE WHEN event_type = 'view' THEN '/page_view/' || CAST({K} AS VARCHAR) END AS page_url,
               CASE {K} % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' ELSE 'tablet' END AS device_type,
               CASE user_id % 4 WHEN 0 THEN 'US' WHEN 1 THEN 'EU' WHEN 2 THEN 'APAC' ELSE 'LATAM' END AS location,
               event_id
        FROM events""",
    "subscriptions": """
        SELECT CAST(c_custkey AS VARCHAR) AS user_id,
               last_order + INTERVAL 8218 DAY AS subscription_start,
               CASE WHEN status = 'F'
                    THEN least(last_order + to_days(CAST(8218 + o_orderkey % 400 AS INTEGER)),
                               TIMESTAMP '2024-01-31 00:00:00')
               END AS subscription_end,
               CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'basic'
                    WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN 'pro' ELSE 'enterprise' END AS plan_type,
               CASE WHEN c_custkey % 10 < 7 THEN 'monthly' ELSE 'annual' END AS billing_cycle,
               CASE WHEN n_regionkey IN (0, 1, 2) THEN 'credit_card'
                    WHEN n_regionkey = 3 THEN 'paypal' ELSE 'bank_transfer' END AS payment_method,
               CASE WHEN status = 'F' THEN
                    CASE priority WHEN '1-URGENT' THEN 'price' WHEN '2-HIGH' THEN 'features'
                         WHEN '3-MEDIUM' THEN 'support' WHEN '5-LOW' THEN 'competitor' END
               END AS churn_reason,
               status = 'F' AS is_churned
        FROM (SELECT o_custkey, o_orderkey, o_orderdate AS last_order, o_orderstatus AS status,
                     o_orderpriority AS priority,
                     row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r
              FROM orders)
        JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey
        WHERE r = 1""",
    "pageviews": f"""
        SELECT event_type AS project,
               'Page_' || CAST({K} AS VARCHAR) AS page_title,
               CAST(floor(value * value / 10) AS INTEGER) AS view_count,
               CASE {K} % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile-web' ELSE 'mobile-app' END AS access_method,
               'pageviews-' || strftime(ts, '%Y%m%d-%H') || '0000.gz' AS source_file,
               CAST(date_trunc('hour', ts) AS TIMESTAMP) AS file_timestamp
        FROM events""",
    "manifest": """
        SELECT source_file AS filename, file_timestamp AS "timestamp",
               CAST(sum(view_count) AS BIGINT) AS file_size_bytes
        FROM pageviews GROUP BY 1, 2""",
    "scores": """
        SELECT user_id, p AS churn_probability,
               CASE WHEN p >= 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction,
               CASE WHEN p >= 0.5 THEN 'high_risk' WHEN p >= 0.3 THEN 'medium_risk' ELSE 'low_risk' END
                    AS churn_risk,
               is_churned
        FROM (SELECT user_id, is_churned,
                     ((CAST(user_id AS BIGINT) * 37) % 80 + CASE WHEN is_churned THEN 20 ELSE 0 END)
                     / 100.0::DOUBLE AS p
              FROM subscriptions)""",
    "engagement": """
        SELECT user_id, count(*) AS total_actions, count(DISTINCT session_id) AS total_sessions,
               count(DISTINCT CAST("timestamp" AS DATE)) AS active_days,
               count(DISTINCT feature_name) AS features_adopted,
               count(*) FILTER (WHERE action_type = 'feature_use') AS feature_usage_count,
               avg(duration_seconds) AS avg_session_duration,
               stddev_samp(duration_seconds) AS stddev_session_duration,
               count(DISTINCT device_type) AS device_types_used, count(DISTINCT location) AS locations_used,
               count(*) FILTER (WHERE "timestamp" >= TIMESTAMP '2024-01-24') AS actions_last_7_days,
               count(*) FILTER (WHERE "timestamp" >= TIMESTAMP '2024-01-01') AS actions_last_30_days
        FROM behavior GROUP BY user_id""",
    "lifecycle": """
        SELECT *, CAST(date_diff('day', CAST(subscription_start AS DATE), DATE '2024-01-31') AS INTEGER)
                  AS days_since_subscription,
               CAST(date_diff('day', CAST(subscription_start AS DATE),
                              coalesce(CAST(subscription_end AS DATE), DATE '2024-01-31')) AS INTEGER)
                  AS subscription_length_days
        FROM subscriptions""",
    "usage": """
        SELECT user_id,
               count(*) FILTER (WHERE feature_name = 'dashboard') AS dashboard,
               count(*) FILTER (WHERE feature_name = 'analytics') AS analytics,
               count(*) FILTER (WHERE feature_name = 'reports') AS reports,
               count(*) FILTER (WHERE feature_name = 'integrations') AS integrations,
               count(*) FILTER (WHERE feature_name = 'api_access') AS api_access,
               count(*) FILTER (WHERE feature_name = 'support_portal') AS support_portal
        FROM behavior WHERE action_type = 'feature_use' GROUP BY user_id""",
    "counts": """
        SELECT user_id,
               count(*) FILTER (WHERE action_type = 'login') AS login_count,
               count(*) FILTER (WHERE action_type = 'page_view') AS page_view_count,
               count(*) FILTER (WHERE action_type = 'feature_use') AS feature_use_count,
               count(*) FILTER (WHERE action_type = 'support_ticket') AS support_ticket_count
        FROM behavior GROUP BY user_id""",
    "fortnight": """
        SELECT user_id, count(*) FILTER (WHERE "timestamp" >= TIMESTAMP '2024-01-17') AS actions_last_2_weeks
        FROM behavior GROUP BY user_id""",
    "matrix": f"""
        SELECT e.*, e.actions_last_7_days AS actions_last_week, w.actions_last_2_weeks,
               e.actions_last_30_days AS actions_last_month,
               c.* EXCLUDE (user_id), u.* EXCLUDE (user_id), s.* EXCLUDE (user_id),
               e.total_actions / e.total_sessions::DOUBLE AS avg_actions_per_session,
               e.total_actions / e.active_days::DOUBLE AS avg_actions_per_day,
               e.feature_usage_count * 100.0::DOUBLE / e.total_actions AS feature_usage_ratio,
               c.support_ticket_count * 100.0::DOUBLE / e.total_actions AS support_ticket_ratio,
               coalesce({band("matrix_stage", "subscription_length_days")}, 'veteran') AS subscription_stage
        FROM engagement e
        JOIN counts c ON c.user_id = e.user_id
        JOIN fortnight w ON w.user_id = e.user_id
        LEFT JOIN usage u ON u.user_id = e.user_id
        LEFT JOIN lifecycle s ON s.user_id = e.user_id""",
    "modal_location": """
        SELECT user_id, location FROM (
            SELECT user_id, location,
                   row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, location) AS r
            FROM behavior GROUP BY user_id, location) WHERE r = 1""",
    "modal_device": """
        SELECT user_id, device_type FROM (
            SELECT user_id, device_type,
                   row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, device_type) AS r
            FROM behavior GROUP BY user_id, device_type) WHERE r = 1""",
    "daily_views": """
        SELECT project, CAST(file_timestamp AS DATE) AS date, CAST(sum(view_count) AS BIGINT) AS value
        FROM pageviews GROUP BY 1, 2""",
    "daily_users": """
        SELECT CAST("timestamp" AS DATE) AS date, count(DISTINCT user_id) AS value FROM behavior GROUP BY 1""",
    "dense_users": """
        SELECT CAST(d AS DATE) AS date, coalesce(value, 0) AS value
        FROM (SELECT unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS d FROM daily_users)
        LEFT JOIN daily_users ON daily_users.date = CAST(d AS DATE)""",
    "dense_views": """
        SELECT g.project, CAST(g.d AS DATE) AS date, coalesce(v.value, 0) AS value
        FROM (SELECT project, unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS d
              FROM daily_views GROUP BY project) g
        LEFT JOIN daily_views v ON v.project = g.project AND v.date = CAST(g.d AS DATE)""",
    "labelled_scores": """
        SELECT s.user_id, s.churn_probability AS p, CAST(s.is_churned AS INTEGER) AS y, s.prediction
        FROM scores s""",
}

NEEDS = {
    "manifest": ["pageviews"],
    "scores": ["subscriptions"],
    "engagement": ["behavior"],
    "lifecycle": ["subscriptions"],
    "usage": ["behavior"],
    "counts": ["behavior"],
    "fortnight": ["behavior"],
    "matrix": ["engagement", "counts", "fortnight", "usage", "lifecycle"],
    "modal_location": ["behavior"],
    "modal_device": ["behavior"],
    "daily_views": ["pageviews"],
    "daily_users": ["behavior"],
    "dense_users": ["daily_users"],
    "dense_views": ["daily_views"],
    "labelled_scores": ["scores"],
}


# Dates inside the data for the check of snapshots: each date of the SQL above, moved from the last day to this one.
SNAPSHOT_DAY = "2024-01-16"
MOVED = {
    "2024-01-31": "2024-01-16",
    "2024-01-24": "2024-01-09",
    "2024-01-17": "2024-01-02",
    "2024-01-01": "2023-12-17",
}


def moved(sql):
    return re.sub("|".join(MOVED), lambda found: MOVED[found[0]], sql)


def snapshot_inputs():
    """The inputs as known at the end of SNAPSHOT_DAY; scores are those of all subscriptions."""
    inputs = {name: moved(sql) for name, sql in INPUTS.items()}
    inputs["behavior"] += " WHERE ts < TIMESTAMP '2024-01-17 00:00:00'"
    inputs["all_subscriptions"] = INPUTS["subscriptions"]
    inputs["subscriptions"] = """
        SELECT * REPLACE (
            CASE WHEN CAST(subscription_end AS DATE) <= DATE '2024-01-16' THEN subscription_end END AS subscription_end,
            CASE WHEN CAST(subscription_end AS DATE) <= DATE '2024-01-16' THEN churn_reason END AS churn_reason,
            coalesce(CAST(subscription_end AS DATE) <= DATE '2024-01-16', false) AS is_churned)
        FROM all_subscriptions WHERE CAST(subscription_start AS DATE) <= DATE '2024-01-16'"""
    inputs["scores"] = INPUTS["scores"].replace("FROM subscriptions", "FROM all_subscriptions")
    return inputs, NEEDS | {"subscriptions": ["all_subscriptions"], "scores": ["all_subscriptions"]}


def with_inputs(names, body, inputs=INPUTS, needs=NEEDS):
    """The query with its named inputs, and theirs, in front."""
    needed = []

    def add(name):
        for before in needs.get(name, []):
            add(before)
        if name not in needed:
            needed.append(name)

    for name in names:
        add(name)
    if not needed:
        return body
    ctes = ",\n".join(f"{name} AS ({inputs[name]})" for name in needed)
    joint = "," if body.lstrip().startswith("+") else ""
    return f"WITH {ctes}{joint}\n{body.lstrip().lstrip('+')}"
