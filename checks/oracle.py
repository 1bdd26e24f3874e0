"""The same queries in SQL, written from the definitions and run by another engine."""

import re
from itertools import combinations

from checks.oracle_inputs import SNAPSHOT_DAY, band, band_rows, moved, snapshot_inputs, with_inputs

CHURNED = "count(*) FILTER (WHERE is_churned)"
ACTIVE = "count(*) FILTER (WHERE NOT is_churned)"
AGE = "date_diff('day', CAST(subscription_start AS DATE), DATE '2024-01-31')"
LENGTH = "date_diff('day', CAST(subscription_start AS DATE), CAST(subscription_end AS DATE))"


def pct(part, whole, digits=2):
    return f"round({part} * 100.0::DOUBLE / nullif({whole}, 0), {digits})"


def avg2(column, digits=2):
    return f"round(avg({column}), {digits})"


def long_table(table, columns, name, cast=""):
    """One row per row and column: the column's name and its value."""
    names = ", ".join(f"'{c}'" for c in columns)
    values = ", ".join(f"{c}{cast}" for c in columns)
    return f"SELECT unnest([{names}]) AS {name}, unnest([{values}]) AS v, * FROM {table}"


def null_rows(table, columns, name):
    return f"""
        SELECT {name}, count(*) AS total_records, count(v) AS non_null_count,
               count(*) FILTER (WHERE v IS NULL) AS null_count,
               {pct('count(*) FILTER (WHERE v IS NULL)', 'count(*)')} AS null_percentage
        FROM ({long_table(table, columns, name, '::VARCHAR')}) GROUP BY 1"""


def active_users(period, key, name, previous):
    """The previous period is found by its number rather than by a window."""
    return f"""
        + periods AS (
            SELECT {period} AS {key}, count(DISTINCT user_id) AS {name},
                   row_number() OVER (ORDER BY {period}) AS number
            FROM behavior GROUP BY 1)
        SELECT now.{key}, now.{name}, past.{name} AS {previous},
               {pct(f'(now.{name} - past.{name})', f'past.{name}')} AS {name}_change_pct
        FROM periods now LEFT JOIN periods past ON past.number = now.number - 1"""


def share_of(key, name):
    return f"""
        SELECT {key} AS {name}, count(*) AS total_pageviews,
               {pct('count(*)', '(SELECT count(*) FROM pageviews)')} AS percentage
        FROM pageviews GROUP BY 1"""


SUBSCRIPTION_COLUMNS = (
    "user_id, plan_type, billing_cycle, payment_method, subscription_start, subscription_end, is_churned, "
    "churn_reason, days_since_subscription, subscription_length_days"
)
NUMERIC_FEATURES = [
    "total_actions", "total_sessions", "active_days", "features_adopted", "feature_usage_count",
    "avg_session_duration", "stddev_session_duration", "device_types_used", "locations_used",
    "actions_last_7_days", "actions_last_30_days", "actions_last_week", "actions_last_2_weeks",
    "actions_last_month", "login_count", "page_view_count", "feature_use_count", "support_ticket_count",
    "dashboard", "analytics", "reports", "integrations", "api_access", "support_portal",
    "avg_actions_per_session", "avg_actions_per_day", "feature_usage_ratio", "support_ticket_ratio",
]
MATRIX_COLUMNS = [
    "user_id", *NUMERIC_FEATURES, "plan_type", "billing_cycle", "payment_method", "subscription_start",
    "subscription_end", "is_churned", "churn_reason", "days_since_subscription", "subscription_length_days",
    "subscription_stage",
]
DURATION_ROUNDED = """round(avg_session_duration, 6) AS avg_session_duration,
    round(stddev_session_duration, 6) AS stddev_session_duration"""


def scaled(name):
    x = f"coalesce({name}, 0)::DOUBLE"
    spread = f"stddev_samp({x}) OVER ()"
    return f"round(CASE WHEN {spread} = 0 THEN 0 ELSE ({x} - avg({x}) OVER ()) / {spread} END, 6) AS {name}"


def category_index(column):
    return f"""
        SELECT '{column}' AS column_name, value,
               CAST(row_number() OVER (ORDER BY count(*) DESC, value) - 1 AS DOUBLE) AS category_index
        FROM (SELECT coalesce({column}, 'unknown') AS value FROM matrix) GROUP BY value"""


def slice_sql(source, dimension, averages):
    measures = "".join(f", {avg2(column)} AS {name}" for name, column in averages.items())
    return f"""
        SELECT {dimension}, count(*) AS total_subscribers, {CHURNED} AS churned_count,
               {pct(CHURNED, 'count(*)')} AS churn_rate {measures}
        FROM {source} GROUP BY 1"""


def segments(name, case, measures):
    picked = "".join(f", {avg2(column)} AS {out}" for out, column in measures.items())
    return f"""
        SELECT {name}, count(*) AS user_count,
               {pct('count(*)', '(SELECT count(*) FROM engagement)')} AS user_percentage {picked},
               {CHURNED} AS churned_count, {pct(CHURNED, 'count(*)')} AS churn_rate
        FROM (SELECT *, {case} AS {name} FROM engagement) JOIN subscriptions USING (user_id) GROUP BY 1"""


def auc(rows, by):
    """Rank sum with average ranks; area under precision and recall over all distinct thresholds."""
    keys = f"{by}," if by else ""
    part = f"PARTITION BY {by}" if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""
        points AS (
            SELECT {keys} p, count(*) AS n, sum(y) AS pos FROM ({rows}) GROUP BY {keys} p),
        curve AS (
            SELECT *, sum(n) OVER ({part} ORDER BY p DESC) AS flagged, sum(pos) OVER ({part} ORDER BY p DESC) AS hits,
                   sum(n) OVER ({part} ORDER BY p) AS upto, sum(n) OVER ({part}) AS everyone,
                   sum(pos) OVER ({part}) AS positives
            FROM points),
        steps AS (
            SELECT *, hits * 1.0::DOUBLE / flagged AS prec,
                   coalesce((hits - pos) * 1.0::DOUBLE / nullif(flagged - n, 0), hits * 1.0::DOUBLE / flagged)
                       AS prec_above
            FROM curve),
        areas AS (
            SELECT {keys} max(everyone) AS n, max(positives) AS positives,
                   (sum(pos * (upto - n + (n + 1) / 2.0::DOUBLE))
                     - max(positives) * (max(positives) + 1) / 2.0::DOUBLE)
                       / nullif(max(positives) * (max(everyone) - max(positives)), 0) AS roc,
                   sum(pos * (prec + prec_above) / 2) / nullif(max(positives), 0) AS pr
            FROM steps {group})"""


def funnel():
    """The stages are a table to which the subscriptions are joined, so that empty ones stay."""
    return f"""
        SELECT label AS stage, count(age) AS user_count, {CHURNED} AS churned_count,
               {pct(CHURNED, 'count(age)')} AS churn_rate, {pct(ACTIVE, 'count(age)')} AS retention_rate,
               {pct('count(age)', '(SELECT count(*) FROM subscriptions)')} AS stage_percentage
        FROM (VALUES {band_rows('funnel')}) AS b(least, greatest, label)
        LEFT JOIN (SELECT is_churned, {AGE} AS age FROM subscriptions) ON age BETWEEN least AND greatest
        GROUP BY 1"""


def cohorts(extra):
    """Lower bounds 90, 80, 70 and 60 of the grades."""
    return f"""
        SELECT *, CASE WHEN retention_rate >= 90 THEN 'Excellent' WHEN retention_rate >= 80 THEN 'Good'
                       WHEN retention_rate >= 70 THEN 'Fair' WHEN retention_rate >= 60 THEN 'Poor'
                       ELSE 'Critical' END AS retention_grade
        FROM (SELECT strftime(subscription_start, '%Y-%m') AS cohort_month, {band('survival', AGE)} AS survival_month,
                     count(*) AS user_count, {CHURNED} AS churned_count,
                     {pct(ACTIVE, 'count(*)')} AS retention_rate, {pct(CHURNED, 'count(*)')} AS churn_rate
              FROM subscriptions WHERE {AGE} <= 180 GROUP BY 1, 2 {extra})"""


def tier_count(tier):
    return f"count(*) FILTER (WHERE churn_risk = '{tier}')"


def named_values(source, key, *entries):
    """One row per (name, value) of a one-row aggregate."""
    names = ", ".join(f"'{name}'" for name, _ in entries)
    values = ", ".join(value for _, value in entries)
    return f"SELECT unnest([{names}]) AS {key}, unnest([{values}]) AS value FROM {source}"


def missing(columns):
    rows = [
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_count FROM matrix" for c in columns
    ]
    return " UNION ALL ".join(rows)


def rule(source, name, condition):
    return (
        f"SELECT '{source}' AS source, '{name}' AS rule, count(*) FILTER (WHERE {condition}) AS violations "
        f"FROM {source}"
    )


def rules():
    domains = {
        "pageviews": {"access_method": "'desktop', 'mobile-web', 'mobile-app'"},
        "behavior": {
            "action_type": "'login', 'page_view', 'feature_use', 'support_ticket'",
            "feature_name": "'dashboard', 'analytics', 'reports', 'integrations', 'api_access', 'support_portal'",
            "device_type": "'desktop', 'mobile', 'tablet'",
            "location": "'US', 'EU', 'APAC', 'LATAM'",
        },
        "subscriptions": {
            "plan_type": "'basic', 'pro', 'enterprise'",
            "billing_cycle": "'monthly', 'annual'",
            "payment_method": "'credit_card', 'paypal', 'bank_transfer'",
            "churn_reason": "'price', 'features', 'support', 'competitor', 'no_longer_needed'",
        },
    }
    mandatory = {
        "pageviews": ["project", "page_title", "view_count", "access_method"],
        "behavior": ["user_id", "timestamp", "action_type"],
        "subscriptions": ["user_id", "subscription_start", "plan_type", "billing_cycle", "is_churned"],
    }
    rows = [rule(t, f"{c} not null", f'"{c}" IS NULL') for t, names in mandatory.items() for c in names]
    rows += [rule(t, f"{c} in domain", f"{c} NOT IN ({v})") for t, d in domains.items() for c, v in d.items()]
    rows += [
        rule("pageviews", "view_count not negative", "view_count < 0"),
        rule("behavior", "duration_seconds not negative", "duration_seconds < 0"),
        rule("subscriptions", "end not before start", "subscription_end < subscription_start"),
        """SELECT 'behavior', 'user has a subscription', count(DISTINCT user_id) FROM behavior
           WHERE user_id NOT IN (SELECT user_id FROM subscriptions)""",
        """SELECT 'behavior', 'timestamps in order', count(*) FILTER (WHERE "timestamp" < seen)
           FROM (SELECT "timestamp", max("timestamp") OVER (
                    PARTITION BY user_id, session_id ORDER BY event_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM behavior)""",
    ]
    return " UNION ALL ".join(rows)


def correlations():
    names = [
        "total_actions", "features_adopted", "avg_actions_per_session", "support_ticket_ratio",
        "subscription_length_days",
    ]
    return f"""
        SELECT feature_name, CASE WHEN min(v) < max(v) THEN round(corr(v, CAST(is_churned AS INTEGER)), 4) END
                   AS correlation_with_churn
        FROM ({long_table('matrix', names, 'feature_name', '::DOUBLE')}) WHERE is_churned IS NOT NULL GROUP BY 1"""


def statistics():
    names = ["total_actions", "features_adopted", "subscription_length_days"]
    quantiles = ", ".join(
        f"round(quantile_cont(v, {q}), 4) AS {name}_value"
        for name, q in (("p25", 0.25), ("median", 0.5), ("p75", 0.75), ("p95", 0.95))
    )
    return f"""
        SELECT feature_name, count(*) AS total_users, {avg2('v')} AS mean_value,
               round(stddev_samp(v), 2) AS stddev_value, CAST(min(v) AS BIGINT) AS min_value,
               CAST(max(v) AS BIGINT) AS max_value, {quantiles}
        FROM ({long_table('matrix', names, 'feature_name', '::DOUBLE')}) GROUP BY 1"""


def rate(condition):
    churned = f"count(*) FILTER (WHERE is_churned AND {condition})"
    return f"({churned} * 1.0::DOUBLE / nullif(count(*) FILTER (WHERE {condition}), 0))"


def hits(fraction):
    places = f"ceil(everyone * {fraction}::DOUBLE)"
    return f"sum(pos * greatest(0, least(n, {places} - (flagged - n))) / n::DOUBLE)"


TIME_WINDOWS = f"""
    SELECT user_id, is_churned,
           CAST(floor((d - min(d) OVER ()) * 6 / (max(d) OVER () - min(d) OVER () + 1)::DOUBLE) AS INTEGER)
               AS time_window
    FROM (SELECT user_id, is_churned, -({AGE}) AS d FROM subscriptions)"""

SEGMENT_ROWS = f"""
    WITH people AS (
        SELECT s.user_id, s.p, s.y, plan_type, location,
               {band('matrix_stage', AGE)} AS stage
        FROM labelled_scores s JOIN subscriptions USING (user_id) LEFT JOIN modal_location USING (user_id))
    SELECT 'plan_type' AS segment_type, plan_type AS segment, p, y FROM people
    UNION ALL SELECT 'stage', stage, p, y FROM people
    UNION ALL SELECT 'location', location, p, y FROM people WHERE location IS NOT NULL"""

FIRST_USES = """
    SELECT user_id, feature_name, min("timestamp") AS first_used FROM behavior
    WHERE action_type = 'feature_use' AND feature_name IS NOT NULL GROUP BY 1, 2"""
JOURNEY = f"""
    SELECT user_id, feature_name, first_used,
           CAST(row_number() OVER (PARTITION BY user_id ORDER BY first_used, feature_name) AS INTEGER) AS step,
           lead(feature_name) OVER (PARTITION BY user_id ORDER BY first_used, feature_name) AS next_feature
    FROM ({FIRST_USES})"""


def by_periods(table, timestamp, measures):
    """One row per day, week, month and in total."""
    parts = [
        f"""SELECT '{period}' AS period, CAST(date_trunc('{period}', {timestamp}) AS DATE) AS period_start, {measures}
            FROM {table} GROUP BY 2"""
        for period in ("day", "week", "month")
    ]
    return " UNION ALL ".join([*parts, f"SELECT 'total', NULL, {measures} FROM {table}"])


MODELS = {
    "users_by_period": (["behavior"], by_periods(
        "behavior", '"timestamp"', "count(DISTINCT user_id) AS distinct_count, count(*) AS rows")),
    "titles_by_period": (["pageviews"], by_periods(
        "pageviews", "file_timestamp", "count(DISTINCT page_title) AS distinct_count, count(*) AS rows")),
    "sketches_by_period": (["pageviews"], by_periods(
        "pageviews", "file_timestamp", "count(*) AS rows, true AS page_title_within, true AS source_file_within")),
    "read_file_manifest": (["manifest"], """
        SELECT *, 'https://example.org/pageviews/' || filename AS full_url FROM manifest"""),
    "daily_file_sample": (["manifest"], """
        SELECT filename, "timestamp", file_size_bytes, 'https://example.org/pageviews/' || filename AS full_url
        FROM (SELECT *, row_number() OVER (PARTITION BY substr(filename, 11, 8)
                                           ORDER BY md5('42' || filename), filename) AS r
              FROM manifest
              WHERE file_size_bytes > 0 AND CAST(substr(filename, 20, 2) AS INTEGER) BETWEEN 12 AND 16)
        WHERE r = 1"""),
    "parse_pageview_lines": (["pageviews"], """
        SELECT project, page_title, view_count, access_method, source_file AS filename FROM pageviews"""),
    "enrich_pageviews": (["pageviews", "manifest"], """
        SELECT project, page_title, view_count, access_method, "timestamp" AS file_timestamp, file_size_bytes,
               'https://example.org/pageviews/' || filename AS source_url, 'wikimedia_pageviews' AS data_source
        FROM pageviews LEFT JOIN manifest ON filename = source_file"""),
    "ingestion_flow": (["pageviews", "manifest"], """
        SELECT project, page_title, view_count, access_method, "timestamp" AS file_timestamp, file_size_bytes,
               'https://example.org/pageviews/' || filename AS source_url, 'wikimedia_pageviews' AS data_source,
               CAST("timestamp" AS DATE) AS file_date
        FROM pageviews JOIN
             (SELECT *, row_number() OVER (PARTITION BY substr(filename, 11, 8)
                                           ORDER BY md5('42' || filename), filename) AS r
              FROM manifest
              WHERE file_size_bytes > 0 AND CAST(substr(filename, 20, 2) AS INTEGER) BETWEEN 12 AND 16)
             ON filename = source_file
        WHERE r = 1"""),
    "silver_layer": (["matrix"], f"SELECT * REPLACE ({DURATION_ROUNDED}) FROM matrix"),
    "write_layer": (["behavior"], """
        SELECT CAST("timestamp" AS DATE) AS event_date, count(*) AS row_count FROM behavior GROUP BY 1"""),
    "read_layer": (["behavior"], """
        SELECT * EXCLUDE (event_id), CAST("timestamp" AS DATE) AS event_date FROM behavior"""),
    "clustered_rewrite": (["pageviews"], "SELECT * FROM pageviews"),
    "collect_table_stats": (["subscriptions"], """
        SELECT 'subscriptions' AS table_name, count(*) AS row_count FROM subscriptions"""),
    "pageview_summary": (["pageviews"], """
        SELECT count(*) AS total_records, count(DISTINCT project) AS unique_projects,
               count(DISTINCT page_title) AS unique_pages, count(DISTINCT access_method) AS unique_access_methods,
               count(DISTINCT source_file) AS total_files, min(file_timestamp) AS earliest_timestamp,
               max(file_timestamp) AS latest_timestamp FROM pageviews"""),
    "project_distribution": (["pageviews"], f"""
        SELECT project, count(*) AS record_count,
               {pct('count(*)', '(SELECT count(*) FROM pageviews)')} AS percentage
        FROM pageviews GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""),
    "view_count_stats": (["pageviews"], f"""
        SELECT 'All Records' AS category, count(*) AS total_records, min(view_count) AS min_views,
               max(view_count) AS max_views, {avg2('view_count')} AS avg_views,
               round(stddev_samp(view_count), 2) AS stddev_views,
               round(quantile_cont(view_count::DOUBLE, 0.25), 4) AS p25_views,
               round(quantile_cont(view_count::DOUBLE, 0.5), 4) AS median_views,
               round(quantile_cont(view_count::DOUBLE, 0.75), 4) AS p75_views,
               round(quantile_cont(view_count::DOUBLE, 0.95), 4) AS p95_views,
               round(quantile_cont(view_count::DOUBLE, 0.99), 4) AS p99_views
        FROM pageviews WHERE view_count IS NOT NULL"""),
    "null_profile": (["pageviews"], null_rows(
        "pageviews", ["project", "page_title", "view_count", "access_method"], "column_name")),
    "summary_long": (["pageviews"], named_values(
        "pageviews", "metric",
        ("Total Records", "CAST(count(*) AS VARCHAR)"),
        ("Total Files Processed", "CAST(count(DISTINCT source_file) AS VARCHAR)"),
        ("Unique Projects", "CAST(count(DISTINCT project) AS VARCHAR)"),
        ("Unique Page Titles", "CAST(count(DISTINCT page_title) AS VARCHAR)"),
        ("Date Range Start", "strftime(min(file_timestamp), '%Y-%m-%d %H:%M:%S')"),
        ("Date Range End", "strftime(max(file_timestamp), '%Y-%m-%d %H:%M:%S')"))),
    "complete_record_ratio": (["pageviews"], f"""
        SELECT quality_metric, value AS record_count, {pct('value', 'max(value) OVER ()')} AS percentage
        FROM ({named_values('pageviews', 'quality_metric',
                            ('Records with Complete Data',
                             'count(*) FILTER (WHERE (project || page_title || view_count || access_method) NOTNULL)'),
                            ('Total Records', 'count(*)'))})"""),
    "daily_pageview_trend": (["pageviews"], f"""
        SELECT CAST(file_timestamp AS DATE) AS date, count(*) AS total_pageviews,
               count(DISTINCT page_title) AS unique_pages, {avg2('view_count')} AS avg_views_per_page
        FROM pageviews GROUP BY 1"""),
    "hourly_distribution": (["pageviews"], share_of("CAST(hour(file_timestamp) AS INTEGER)", "hour_of_day")),
    "weekday_distribution": (["pageviews"], share_of(
        "CAST(dayofweek(file_timestamp) + 1 AS INTEGER)", "day_of_week")),
    "view_count_histogram": (["pageviews"], f"""
        SELECT coalesce({band('views', 'view_count')}, '10K+') AS view_count_range, count(*) AS page_count,
               {pct('count(*)', '(SELECT count(*) FROM pageviews)')} AS percentage
        FROM pageviews GROUP BY 1"""),
    "behavior_summary": (["behavior"], f"""
        SELECT count(*) AS total_records, count(DISTINCT user_id) AS unique_users,
               count(DISTINCT session_id) AS unique_sessions, count(DISTINCT action_type) AS unique_action_types,
               min("timestamp") AS earliest_timestamp, max("timestamp") AS latest_timestamp,
               {avg2('duration_seconds')} AS avg_duration FROM behavior"""),
    "action_distribution": (["behavior"], f"""
        SELECT action_type, count(*) AS record_count,
               {pct('count(*)', '(SELECT count(*) FROM behavior)')} AS percentage FROM behavior GROUP BY 1"""),
    "feature_usage_share": (["behavior"], f"""
        SELECT feature_name, count(*) AS usage_count, count(DISTINCT user_id) AS unique_users,
               {pct('count(*)', "(SELECT count(*) FROM behavior WHERE action_type = 'feature_use')")} AS percentage
        FROM behavior WHERE action_type = 'feature_use' AND feature_name IS NOT NULL GROUP BY 1"""),
    "subscription_summary": (["subscriptions"], f"""
        SELECT count(*) AS total_subscriptions, count(DISTINCT user_id) AS unique_users, {CHURNED} AS churned_users,
               {ACTIVE} AS active_users, {pct(CHURNED, 'count(*)')} AS churn_rate_percentage FROM subscriptions"""),
    "plan_distribution": (["subscriptions"], f"""
        SELECT plan_type, count(*) AS subscription_count, {CHURNED} AS churned_count,
               {pct(CHURNED, 'count(*)')} AS churn_rate FROM subscriptions GROUP BY 1"""),
    "churn_reason_breakdown": (["subscriptions"], f"""
        SELECT coalesce(churn_reason, 'Unknown') AS churn_reason, count(*) AS churn_count,
               {pct('count(*)', '(SELECT count(*) FROM subscriptions WHERE is_churned)')} AS percentage
        FROM subscriptions WHERE is_churned GROUP BY subscriptions.churn_reason"""),
    "churn_by_subscription_length": (["subscriptions"], f"""
        SELECT {band('length', LENGTH)} AS subscription_length_range, count(*) AS total_subscriptions,
               {CHURNED} AS churned_count, {pct(CHURNED, 'count(*)')} AS churn_rate
        FROM subscriptions WHERE subscription_end IS NOT NULL GROUP BY 1"""),
    "source_overview": (["pageviews", "behavior", "subscriptions"], f"""
        SELECT 'Wikimedia Pageviews' AS data_source, count(*) AS record_count,
               count(DISTINCT project) AS unique_projects, count(DISTINCT page_title) AS unique_pages FROM pageviews
        UNION ALL SELECT 'User Behavior', count(*), count(DISTINCT user_id), count(DISTINCT session_id) FROM behavior
        UNION ALL SELECT 'Subscriptions', count(*), count(DISTINCT user_id), {CHURNED} FROM subscriptions"""),
    "daily_active_users": (["behavior"], active_users('CAST("timestamp" AS DATE)', "date", "dau", "dau_prev_day")),
    "weekly_active_users": (["behavior"], active_users(
        """CAST(date_trunc('week', "timestamp") AS DATE)""", "week_start", "wau", "wau_prev_week")),
    "monthly_active_users": (["behavior"], active_users(
        """CAST(date_trunc('month', "timestamp") AS DATE)""", "month_start", "mau", "mau_prev_month")),
    "session_stats": (["behavior"], f"""
        SELECT {avg2('actions')} AS avg_actions_per_session, {avg2('duration')} AS avg_session_duration_seconds,
               {avg2('span')} AS avg_session_time_span, round(stddev_samp(actions), 2) AS stddev_actions_per_session,
               round(stddev_samp(duration), 2) AS stddev_session_duration,
               round(quantile_cont(actions::DOUBLE, 0.25), 4) AS p25_actions,
               round(quantile_cont(actions::DOUBLE, 0.5), 4) AS median_actions,
               round(quantile_cont(actions::DOUBLE, 0.75), 4) AS p75_actions,
               round(quantile_cont(actions::DOUBLE, 0.95), 4) AS p95_actions
        FROM (SELECT count(*) AS actions, sum(coalesce(duration_seconds, 0)) AS duration,
                     date_sub('second', min("timestamp"), max("timestamp")) AS span
              FROM behavior WHERE session_id IS NOT NULL GROUP BY user_id, session_id)"""),
    "feature_adoption_histogram": (["behavior"], f"""
        SELECT features_used, count(*) AS user_count, {avg2('uses')} AS avg_feature_uses,
               {avg2('usage')} AS avg_feature_usage_ratio
        FROM (SELECT user_id, count(DISTINCT feature_name) AS features_used,
                     count(*) FILTER (WHERE action_type = 'feature_use') AS uses,
                     count(*) FILTER (WHERE action_type = 'feature_use') * 100.0::DOUBLE / count(*) AS usage
              FROM behavior WHERE feature_name IS NOT NULL GROUP BY 1)
        GROUP BY 1"""),
    "engagement_features": (["engagement"], f"SELECT * REPLACE ({DURATION_ROUNDED}) FROM engagement"),
    "action_mix": (["counts"], f"""
        SELECT user_id, {', '.join(
            pct(f'{a}_count', '(login_count + page_view_count + feature_use_count + support_ticket_count)')
            + f' AS {a}_percentage' for a in ('login', 'page_view', 'feature_use', 'support_ticket'))}
        FROM counts"""),
    "subscription_lifecycle": (["lifecycle"], f"""
        SELECT {SUBSCRIPTION_COLUMNS},
               if(subscription_end IS NULL, {band('lifecycle_stage', 'days_since_subscription')}, 'churned')
                   AS subscription_stage
        FROM lifecycle"""),
    "action_count_pivot": (["counts"], "SELECT * FROM counts"),
    "feature_usage_pivot": (["usage"], "SELECT * FROM usage"),
    "subscription_features": (["lifecycle"], f"SELECT {SUBSCRIPTION_COLUMNS} FROM lifecycle"),
    "feature_matrix": (["matrix"], f"SELECT * REPLACE ({DURATION_ROUNDED}) FROM matrix"),
    "feature_matrix_refreshed": (["matrix"], f"SELECT * REPLACE ({DURATION_ROUNDED}) FROM matrix"),
    "feature_statistics": (["matrix"], statistics()),
    "churn_correlation": (["matrix"], correlations()),
    "class_balance": (["matrix"], f"""
        SELECT count(*) AS total_users, {CHURNED} AS churned_users, {ACTIVE} AS active_users,
               {pct(CHURNED, 'count(*)')} AS churn_rate_percentage FROM matrix"""),
    "feature_completeness": (["matrix"], null_rows(
        "matrix", ["total_actions", "features_adopted", "subscription_length_days"], "feature_name")),
    "feature_summary": (["matrix"], f"""
        SELECT 'Feature Matrix' AS component, count(*) AS user_count, CAST(39 AS BIGINT) AS feature_count,
               'Ready for modeling' AS status FROM matrix
        UNION ALL
        SELECT 'Churn Distribution', {CHURNED}, {ACTIVE},
               CAST(CAST({pct(CHURNED, 'count(*)')} AS DECIMAL(10, 2)) AS VARCHAR) || '%' FROM matrix"""),
    "missing_counts": (["matrix"], missing(MATRIX_COLUMNS)),
    "fill_missing": (["matrix"], f"""
        SELECT * REPLACE (
            {', '.join(
                f"round(coalesce({c}, 0), 6) AS {c}" if c.endswith('_session_duration') else f"coalesce({c}, 0) AS {c}"
                for c in [*NUMERIC_FEATURES, 'days_since_subscription', 'subscription_length_days'])},
            {', '.join(f"coalesce({c}, 'unknown') AS {c}" for c in
                       ('plan_type', 'billing_cycle', 'payment_method', 'subscription_stage'))})
        FROM matrix"""),
    "preprocess_category_index": (["matrix"], " UNION ALL ".join(
        category_index(c) for c in ("plan_type", "billing_cycle", "payment_method"))),
    "preprocess_scaled_features": (["matrix"], f"""
        SELECT user_id, {', '.join(scaled(c) for c in NUMERIC_FEATURES)} FROM matrix"""),
    "train_test_split": (["matrix"], f"""
        SELECT CASE WHEN substr(md5(user_id || '42'), 1, 8) < 'cccccccc' THEN 'train' ELSE 'test' END AS side,
               count(*) AS users, {CHURNED} AS churned_users, {pct(CHURNED, 'count(*)')} AS churn_rate
        FROM matrix WHERE is_churned IS NOT NULL GROUP BY 1"""),
    "classification_metrics": (["labelled_scores"], f"""
        + {auc('SELECT p, y FROM labelled_scores', '')},
        cells AS (
            SELECT count(*) AS n, sum(y) AS pos, sum(prediction) AS said, sum(prediction * y) AS tp
            FROM labelled_scores)
        SELECT round(roc, 6) AS roc_auc, round(pr, 6) AS pr_auc,
               round((tp + c.n - pos - said + tp) / c.n, 6) AS accuracy,
               round((pos * tp / said + (c.n - pos) * (c.n - pos - said + tp) / (c.n - said)) / c.n, 6) AS precision,
               round((tp + c.n - pos - said + tp) / c.n, 6) AS recall
        FROM areas, cells c"""),
    "risk_tiers": (["scores"], """
        SELECT user_id, prediction, churn_probability,
               CASE WHEN prediction = 1 THEN 'high_risk' WHEN churn_probability >= 0.3 THEN 'medium_risk'
                    ELSE 'low_risk' END AS churn_risk FROM scores"""),
    "executive_kpis": (["scores", "subscriptions"], f"""
        SELECT metric, CAST(value AS DOUBLE) AS value, if(metric LIKE '%Rate', 'Percentage', 'Count') AS unit
        FROM ({named_values('subscriptions', 'metric', ('Total Subscribers', 'count(*)'),
                            ('Active Subscribers', ACTIVE), ('Churned Subscribers', CHURNED),
                            ('Overall Churn Rate', pct(CHURNED, 'count(*)')))}
              UNION ALL
              {named_values('scores', 'metric', ('High Risk Users', tier_count('high_risk')),
                            ('Medium Risk Users', tier_count('medium_risk')),
                            ('Low Risk Users', tier_count('low_risk')))})"""),
    "retention_funnel": (["subscriptions"], funnel()),
    "cohort_retention": (["subscriptions"], cohorts("")),
    "cohort_retention_by_day": (["subscriptions"], cohorts(f", {AGE}")),
    "slice_by_plan": (["engagement", "subscriptions"], slice_sql(
        "subscriptions JOIN engagement USING (user_id)", "plan_type", {
            "avg_actions_per_user": "total_actions", "avg_features_adopted": "features_adopted",
            "avg_session_duration": "avg_session_duration"})),
    "slice_by_billing": (["engagement", "lifecycle"], slice_sql(
        "lifecycle JOIN engagement USING (user_id)", "billing_cycle", {
            "avg_subscription_length": "subscription_length_days", "avg_actions_per_user": "total_actions"})),
    "slice_by_payment": (["lifecycle"], slice_sql(
        "lifecycle", "payment_method", {"avg_subscription_length": "subscription_length_days"})),
    "engagement_segments": (["engagement", "subscriptions"], segments("engagement_level", """
        (SELECT label FROM (VALUES (1, 100, 4, 'High Engagement'), (2, 50, 2, 'Medium Engagement'),
                                   (3, 20, 1, 'Low Engagement'), (4, 0, 0, 'Minimal Engagement'))
                           AS b(place, actions, features, label)
         WHERE total_actions >= actions AND features_adopted >= features ORDER BY place LIMIT 1)""", {
        "avg_total_actions": "total_actions", "avg_features_adopted": "features_adopted",
        "avg_session_duration": "avg_session_duration"})),
    "adoption_segments": (["engagement", "subscriptions"], segments(
        "adoption_segment", band("adoption", "features_adopted"), {
            "avg_features_adopted": "features_adopted", "avg_total_actions": "total_actions"})),
    "risk_distribution": (["scores"], f"""
        SELECT churn_risk, count(*) AS predicted_count,
               {pct('count(*)', '(SELECT count(*) FROM scores)')} AS predicted_percentage,
               {CHURNED} AS actual_churned, {pct(CHURNED, 'count(*)')} AS actual_churn_rate,
               {avg2('churn_probability', 4)} AS avg_churn_probability,
               round(stddev_samp(churn_probability), 4) AS stddev_churn_probability
        FROM scores GROUP BY 1"""),
    "prediction_outcomes": (["scores"], f"""
        SELECT outcome AS prediction_outcome, count(*) AS count,
               {pct('count(*)', "(SELECT count(*) FROM scores WHERE churn_risk <> 'medium_risk')")} AS percentage
        FROM scores JOIN (VALUES ('high_risk', true, 'True Positive'), ('high_risk', false, 'False Positive'),
                                 ('low_risk', false, 'True Negative'), ('low_risk', true, 'False Negative'))
                         AS cells(tier, churned, outcome) ON tier = churn_risk AND churned = is_churned
        GROUP BY 1"""),
    "geographic_churn": (["engagement", "modal_location", "subscriptions"], f"""
        SELECT location, count(DISTINCT user_id) AS total_users, {CHURNED} AS churned_users,
               {pct(CHURNED, 'count(DISTINCT user_id)')} AS churn_rate,
               {avg2('total_actions')} AS avg_actions_per_user, {avg2('features_adopted')} AS avg_features_adopted
        FROM engagement JOIN modal_location USING (user_id) JOIN subscriptions USING (user_id) GROUP BY 1"""),
    "device_churn": (["engagement", "modal_device", "subscriptions"], f"""
        SELECT device_type, count(DISTINCT user_id) AS total_users, {CHURNED} AS churned_users,
               {pct(CHURNED, 'count(DISTINCT user_id)')} AS churn_rate,
               {avg2('avg_session_duration')} AS avg_session_duration, {avg2('total_actions')} AS avg_total_actions
        FROM engagement JOIN modal_device USING (user_id) JOIN subscriptions USING (user_id) GROUP BY 1"""),
    "monthly_churn_trend": (["subscriptions"], f"""
        SELECT *, {pct('(new_subscribers - prev_month_new)', 'prev_month_new')} AS new_subscriber_growth,
               {pct('(churned_subscribers - prev_month_churned)', 'prev_month_churned')} AS churn_rate_change
        FROM (SELECT *, lag(new_subscribers) OVER (ORDER BY month) AS prev_month_new,
                     lag(churned_subscribers) OVER (ORDER BY month) AS prev_month_churned
              FROM (SELECT CAST(date_trunc('month', subscription_start) AS DATE) AS month,
                           count(*) AS new_subscribers, {CHURNED} AS churned_subscribers,
                           {pct(CHURNED, 'count(*)')} AS churn_rate
                    FROM subscriptions WHERE subscription_start >= DATE '2024-01-31' - 365 GROUP BY 1))"""),
    "churn_by_end_month": (["subscriptions"], f"""
        + moves AS (
            SELECT CAST(date_trunc('month', subscription_start) AS DATE) AS month, 1 AS s, 0 AS e FROM subscriptions
            UNION ALL
            SELECT CAST(date_trunc('month', subscription_end) AS DATE), 0, 1 FROM subscriptions
            WHERE is_churned AND subscription_end IS NOT NULL),
        months AS (SELECT month, CAST(sum(s) AS BIGINT) AS s, CAST(sum(e) AS BIGINT) AS e FROM moves GROUP BY 1),
        rated AS (
            SELECT m.month, m.s AS new_subscribers, m.e AS churned_subscribers,
                   CAST((SELECT coalesce(sum(p.s - p.e), 0) FROM months p WHERE p.month < m.month) + m.s AS BIGINT)
                       AS active_subscribers
            FROM months m),
        shown AS (SELECT *, {pct('churned_subscribers', 'active_subscribers')} AS churn_rate FROM rated)
        SELECT *, lag(churn_rate) OVER (ORDER BY month) AS prev_churn_rate,
               CASE sign(churn_rate - lag(churn_rate) OVER (ORDER BY month))
                    WHEN 1 THEN 'up' WHEN -1 THEN 'down' WHEN 0 THEN 'flat' END AS trend
        FROM shown"""),
    "weekly_engagement_trend": (["behavior"], f"""
        SELECT CAST(date_trunc('week', "timestamp") AS DATE) AS week_start, count(DISTINCT user_id) AS active_users,
               count(*) AS total_actions, round(count(*) * 1.0::DOUBLE / count(DISTINCT user_id), 2)
                   AS actions_per_user,
               {avg2('duration_seconds')} AS avg_session_duration, count(DISTINCT session_id) AS total_sessions,
               round(count(DISTINCT session_id) * 1.0::DOUBLE / count(DISTINCT user_id), 2) AS sessions_per_user
        FROM behavior WHERE "timestamp" >= DATE '2024-01-31' - 90 GROUP BY 1"""),
    "risk_by_stage": (["scores", "subscriptions"], f"""
        + staged AS (
            SELECT {band('age_stage', AGE)} AS subscription_stage, churn_risk, churn_probability
            FROM scores JOIN subscriptions USING (user_id)),
        stages AS (SELECT subscription_stage, count(*) AS everyone FROM staged GROUP BY 1)
        SELECT subscription_stage, churn_risk, count(*) AS user_count,
               {pct('count(*)', 'max(everyone)')} AS stage_percentage,
               {avg2('churn_probability', 4)} AS avg_churn_probability
        FROM staged JOIN stages USING (subscription_stage) GROUP BY 1, 2"""),
    "kpi_scorecard": (["scores", "engagement"], f"""
        + figures AS (
            SELECT 'Churn Rate' AS metric, {pct(CHURNED, 'count(*)')} AS shown, shown AS judged FROM subscriptions
            UNION ALL
            SELECT 'High Risk Users', {tier_count('high_risk')}, {tier_count('high_risk')} * 100.0::DOUBLE / count(*)
            FROM scores
            UNION ALL
            SELECT 'Feature Adoption Rate', round(avg(features_adopted), 2), avg(features_adopted) FROM engagement
            UNION ALL
            SELECT 'Early Stage Retention', {pct(ACTIVE, 'count(*)')}, {ACTIVE} * 100.0::DOUBLE / count(*)
            FROM subscriptions WHERE {AGE} <= 90)
        SELECT metric, CAST(shown AS DOUBLE) AS current_value, benchmark,
               if(side * (judged - off) > 0, worst, if(side * (judged - risky) > 0, 'At Risk', 'On Target')) AS status
        FROM figures JOIN (VALUES ('Churn Rate', '15.2%', 1, 15.2, 12.0, 'Above Target'),
                                  ('High Risk Users', '5%', 1, 5, 3, 'Above Target'),
                                  ('Feature Adoption Rate', '3.0', -1, 2.5, 3.0, 'Below Target'),
                                  ('Early Stage Retention', '85%', -1, 80, 85, 'Below Target'))
                          AS marks(metric, benchmark, side, off, risky, worst) USING (metric)"""),
    "rolling_averages": (["dense_users"], """
        SELECT date, value,
               round(avg(value) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 4) AS avg_7d,
               round(avg(value) OVER (ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 4) AS avg_30d
        FROM dense_users"""),
    "rolling_averages_by_project": (["dense_views"], """
        SELECT project, date, value,
               round(avg(value) OVER (PARTITION BY project ORDER BY date
                                      ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 4) AS avg_7d,
               round(avg(value) OVER (PARTITION BY project ORDER BY date
                                      ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 4) AS avg_30d
        FROM dense_views"""),
    "seasonal_decomposition": (["dense_views"], """
        SELECT project, date, value, round(trend, 4) AS trend, round(seasonal, 4) AS seasonal,
               round(value - trend - seasonal, 4) AS residual
        FROM (SELECT *, avg(value - trend) OVER (PARTITION BY project, dayofweek(date))
                        - avg(value - trend) OVER (PARTITION BY project) AS seasonal
              FROM (SELECT *, CASE WHEN count(*) OVER w = 7 THEN avg(value) OVER w END AS trend FROM dense_views
                    WINDOW w AS (PARTITION BY project ORDER BY date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)))"""),
    "calendar_features": (["behavior"], """
        SELECT date, actions, CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week,
               CAST(month(date) AS INTEGER) AS month, dayofweek(date) IN (0, 6) AS is_weekend,
               date IN (DATE '2024-01-01', DATE '2024-01-15') AS is_holiday
        FROM (SELECT CAST("timestamp" AS DATE) AS date, count(*) AS actions FROM behavior GROUP BY 1)"""),
    "seasonal_minmax": (["daily_views"], """
        SELECT project, date, value, round((value - min(value) OVER w)::DOUBLE
               / nullif(max(value) OVER w - min(value) OVER w, 0), 6) AS scaled
        FROM daily_views WINDOW w AS (PARTITION BY project, dayofweek(date))"""),
    "log_transform": (["pageviews"], "SELECT *, round(ln(1 + view_count), 6) AS log_view_count FROM pageviews"),
    "percentile_bins": (["pageviews"], """
        SELECT * EXCLUDE (place), CAST(least(floor(place * 10) + 1, 10) AS INTEGER) AS bin,
               printf('p%02d-%02d', CAST((least(floor(place * 10) + 1, 10) - 1) * 10 AS INTEGER),
                      CAST(least(floor(place * 10) + 1, 10) * 10 AS INTEGER)) AS bin_label
        FROM (SELECT *, percent_rank() OVER (PARTITION BY project ORDER BY view_count) AS place FROM pageviews)"""),
    "robust_stats": (["pageviews"], """
        SELECT project, round(quantile_cont(view_count::DOUBLE, 0.25), 4) AS p25,
               round(quantile_cont(view_count::DOUBLE, 0.5), 4) AS median,
               round(quantile_cont(view_count::DOUBLE, 0.75), 4) AS p75,
               round(quantile_cont(view_count::DOUBLE, 0.75) - quantile_cont(view_count::DOUBLE, 0.25), 4) AS iqr
        FROM pageviews GROUP BY 1"""),
    "cap_outliers": (["pageviews"], """
        SELECT pageviews.*, round(least(view_count::DOUBLE, cap), 4) AS capped_view_count
        FROM pageviews JOIN (SELECT project, quantile_cont(view_count::DOUBLE, 0.95) AS cap
                             FROM pageviews GROUP BY 1) caps ON caps.project = pageviews.project"""),
    "cutoff_features": (["behavior", "subscriptions"], f"""
        SELECT s.user_id, plan_type, billing_cycle, payment_method,
               CAST(date_diff('day', CAST(subscription_start AS DATE), DATE '2024-01-16') AS INTEGER)
                   AS days_since_subscription,
               is_churned AND coalesce(subscription_end < DATE '2024-01-16' + 30, false) AS churns_in_horizon,
               {', '.join(f'coalesce({c}, 0) AS {c}' for c in (
                   'total_actions', 'total_sessions', 'active_days', 'features_adopted', 'feature_usage_count',
                   'device_types_used', 'locations_used', 'actions_last_7_days', 'actions_last_30_days'))},
               {DURATION_ROUNDED}
        FROM subscriptions s LEFT JOIN (
            SELECT user_id, count(*) AS total_actions, count(DISTINCT session_id) AS total_sessions,
                   count(DISTINCT CAST("timestamp" AS DATE)) AS active_days,
                   count(DISTINCT feature_name) AS features_adopted,
                   count(*) FILTER (WHERE action_type = 'feature_use') AS feature_usage_count,
                   avg(duration_seconds) AS avg_session_duration,
                   stddev_samp(duration_seconds) AS stddev_session_duration,
                   count(DISTINCT device_type) AS device_types_used, count(DISTINCT location) AS locations_used,
                   count(*) FILTER (WHERE "timestamp" >= TIMESTAMP '2024-01-09') AS actions_last_7_days,
                   count(*) AS actions_last_30_days
            FROM behavior
            WHERE "timestamp" >= TIMESTAMP '2023-12-17' AND "timestamp" < TIMESTAMP '2024-01-16'
            GROUP BY 1) f ON f.user_id = s.user_id
        WHERE subscription_start < TIMESTAMP '2024-01-16'
              AND (subscription_end IS NULL OR subscription_end >= TIMESTAMP '2024-01-16')"""),
    "time_series_folds": (["subscriptions"], f"""
        SELECT CAST(fold AS INTEGER) AS fold, CASE WHEN time_window < fold THEN 'train' ELSE 'validate' END AS role,
               count(*) AS users, {CHURNED} AS churned_users
        FROM ({TIME_WINDOWS}), range(1, 6) folds(fold) WHERE time_window <= fold GROUP BY 1, 2"""),
    "time_series_windows": (["subscriptions"], f"SELECT user_id, time_window FROM ({TIME_WINDOWS})"),
    "stratified_sample": (["subscriptions"], """
        SELECT user_id, plan_type, is_churned FROM subscriptions
        WHERE is_churned OR substr(md5(user_id || '42'), 1, 8) < '40000000'"""),
    "ranking_metrics": (["labelled_scores"], f"""
        + {auc('SELECT p, y FROM labelled_scores', '')}
        SELECT CAST(max(everyone) AS BIGINT) AS users,
               round({hits(0.1)} / max(ceil(everyone * 0.1::DOUBLE)), 6) AS precision_at_top,
               round({hits(0.2)} / max(positives), 6) AS recall_at_flagged,
               round(sum(n - pos) FILTER (WHERE p >= 0.5) * 1.0::DOUBLE / sum(n - pos), 6) AS false_positive_rate
        FROM curve"""),
    "calibration": (["labelled_scores"], """
        SELECT CAST(least(floor(p * 10), 9) AS INTEGER) AS bin, count(*) AS n, round(avg(p), 6) AS mean_score,
               round(avg(y), 6) AS observed_rate,
               (SELECT round(avg((p - y) * (p - y)), 6) FROM labelled_scores) AS brier_score
        FROM labelled_scores GROUP BY 1"""),
    "segment_auc": (["labelled_scores", "subscriptions", "modal_location"], f"""
        + {auc(SEGMENT_ROWS, 'segment_type, segment')}
        SELECT segment_type, segment, CAST(n AS BIGINT) AS n, CAST(positives AS BIGINT) AS positives,
               round(roc, 6) AS roc_auc, CASE WHEN roc IS NOT NULL THEN round(pr, 6) END AS pr_auc FROM areas"""),
    "risk_bands": (["scores"], f"""
        SELECT CASE WHEN churn_probability < 0.3 THEN 'green' WHEN churn_probability < 0.7 THEN 'yellow'
                    ELSE 'red' END AS band, count(*) AS user_count,
               {avg2('churn_probability', 4)} AS avg_probability
        FROM scores GROUP BY 1"""),
    "intervention_queue": (["scores", "subscriptions"], """
        SELECT user_id, plan_type, churn_probability, churn_risk FROM scores JOIN
               (SELECT user_id, plan_type FROM subscriptions WHERE NOT is_churned) USING (user_id)
        ORDER BY churn_probability DESC, user_id LIMIT 100"""),
    "new_high_risk": (["scores"], """
        SELECT user_id, churn_probability, churn_risk FROM scores
        WHERE churn_risk = 'high_risk' AND churn_probability - 0.2::DOUBLE < 0.5"""),
    "activity_recency": (["behavior"], """
        SELECT user_id, days AS days_since_last_session, days >= 14 AS is_inactive,
               a AS actions_last_7_days, b AS actions_previous_7_days, a - b AS action_trend
        FROM (SELECT user_id,
                     CAST(date_diff('day', CAST(max("timestamp") AS DATE), DATE '2024-01-31') AS INTEGER) AS days,
                     count(*) FILTER (WHERE "timestamp" >= TIMESTAMP '2024-01-24') AS a,
                     count(*) FILTER (WHERE "timestamp" >= TIMESTAMP '2024-01-17'
                                            AND "timestamp" < TIMESTAMP '2024-01-24') AS b
              FROM behavior GROUP BY 1)"""),
    "early_adoption_effect": (["behavior", "subscriptions"], f"""
        SELECT adopter_group, user_count, churned_count,
               {pct('churned_count', 'user_count')} AS churn_rate,
               round((churned_count / user_count::DOUBLE) / (max(CASE WHEN adopter_group = 'late adopter'
                     THEN churned_count / user_count::DOUBLE END) OVER ()), 4) AS rate_vs_late
        FROM (SELECT CASE WHEN early >= 3 THEN 'early adopter' ELSE 'late adopter' END AS adopter_group,
                     count(*) AS user_count, {CHURNED} AS churned_count
              FROM (SELECT user_id, count(DISTINCT feature_name) FILTER (
                                WHERE date_diff('day', CAST(first_time AS DATE), CAST("timestamp" AS DATE)) < 30)
                                AS early
                    FROM (SELECT *, min("timestamp") OVER (PARTITION BY user_id) AS first_time FROM behavior)
                    GROUP BY 1) JOIN subscriptions USING (user_id)
              GROUP BY 1)"""),
    "bronze_validation": (["pageviews", "behavior", "subscriptions"], rules()),
    "early_churn_share": (["subscriptions"], f"""
        SELECT count(*) AS total_churned, count(*) FILTER (WHERE {LENGTH} <= 90) AS early_churned,
               {pct(f'count(*) FILTER (WHERE {LENGTH} <= 90)', 'count(*)')} AS early_churn_share,
               count(*) FILTER (WHERE {LENGTH} BETWEEN 14 AND 45) AS critical_window_churned
        FROM subscriptions WHERE is_churned AND subscription_end IS NOT NULL"""),
    "adoption_journey": (["behavior"], JOURNEY),
    "adoption_transitions": (["behavior"], f"""
        SELECT feature_name, next_feature, count(*) AS users FROM ({JOURNEY})
        WHERE next_feature IS NOT NULL GROUP BY 1, 2"""),
    "insight_ratios": (["behavior", "engagement", "subscriptions", "modal_location"], f"""
        + people AS (
            SELECT * FROM engagement JOIN subscriptions USING (user_id) LEFT JOIN modal_location USING (user_id))
        SELECT 'Churn ratio of 0-1 to 5+ features' AS insight,
               round({rate('features_adopted <= 1')} / nullif({rate('features_adopted >= 5')}, 0), 4) AS value FROM people
        UNION ALL SELECT 'APAC churn against US and EU, percent',
               round(({rate("location = 'APAC'")} - {rate("location IN ('US', 'EU')")})
                     / {rate("location IN ('US', 'EU')")} * 100, 4) FROM people
        UNION ALL SELECT 'Share of churns within 90 days, percent',
               {pct(f'count(*) FILTER (WHERE is_churned AND {LENGTH} <= 90)', CHURNED, 4)} FROM subscriptions
        UNION ALL SELECT 'Churn ratio of basic to enterprise',
               round({rate("plan_type = 'basic'")} / {rate("plan_type = 'enterprise'")}, 4) FROM subscriptions
        UNION ALL SELECT 'Churn ratio of monthly to annual billing',
               round({rate("billing_cycle = 'monthly'")} / {rate("billing_cycle = 'annual'")}, 4) FROM subscriptions
        UNION ALL SELECT 'Mean duration ratio of mobile to desktop',
               round(avg(duration_seconds) FILTER (WHERE device_type = 'mobile')
                     / avg(duration_seconds) FILTER (WHERE device_type = 'desktop'), 4) FROM behavior"""),
    # Trained models have no SQL: these compare what must hold for any model.
    "reload_differences": (["behavior"], """
        SELECT CAST(0 AS BIGINT) AS changed_rows, count(DISTINCT user_id) AS users FROM behavior"""),
    "score_rules": (["behavior"], """
        SELECT DISTINCT user_id, 'v1.0' AS model_version, true AS is_probability, true AS tier_follows FROM behavior"""),
    "holdout_predictions": (["behavior", "subscriptions"], """
        SELECT model_name, user_id, CAST(is_churned AS DOUBLE) AS label, true AS is_probability,
               true AS prediction_follows
        FROM (SELECT DISTINCT user_id FROM behavior) JOIN subscriptions USING (user_id),
             (VALUES ('Random Forest'), ('Gradient Boosting'), ('Logistic Regression')) AS m(model_name)
        WHERE substr(md5(user_id || '42'), 1, 8) >= 'cccccccc'"""),
    "tuning_grid": ([], """
        SELECT 'maxBins=' || bins || ', maxDepth=' || depth || ', minInstancesPerNode=' || least || ', numTrees=' || trees
                   AS settings,
               true AS is_area
        FROM (VALUES (32), (64), (128)) AS b(bins), (VALUES (5), (10), (15)) AS d(depth),
             (VALUES (1), (5), (10)) AS i(least), (VALUES (50), (100), (200)) AS t(trees)"""),
    "alert_differences": ([], """
        SELECT CAST(0 AS BIGINT) AS only_in_stream, CAST(0 AS BIGINT) AS only_in_batch"""),
    "stream_daily_actions": (["behavior"], """
        SELECT CAST("timestamp" AS DATE) AS date, action_type, count(*) AS actions FROM behavior GROUP BY 1, 2"""),
    "stream_active_users": (["behavior"], """
        SELECT CAST("timestamp" AS DATE) AS date, count(DISTINCT user_id) AS dau FROM behavior GROUP BY 1"""),
}

MODELS["stream_first_actions"] = MODELS["stream_active_users"]
MODELS["stream_new_alerts"] = MODELS["new_high_risk"]


def _at_cutoffs():
    """The SQL of one cutoff, its dates moved to each of three."""
    inputs, body = MODELS["cutoff_features"]
    parts = []
    for cutoff, week, month in (
        ("2024-01-09", "2024-01-02", "2023-12-10"),
        ("2024-01-16", "2024-01-09", "2023-12-17"),
        ("2024-01-31", "2024-01-24", "2024-01-01"),
    ):
        new = {"2024-01-16": cutoff, "2024-01-09": week, "2023-12-17": month}
        moved_body = re.sub("|".join(new), lambda found: new[found[0]], body)
        parts.append(f"SELECT DATE '{cutoff}' AS cutoff, * FROM ({moved_body})")
    return inputs, " UNION ALL ".join(parts)


def _slices():
    people = """
        people AS (
            SELECT s.*, location, device_type, total_actions, e.features_adopted
            FROM subscriptions s LEFT JOIN engagement e USING (user_id) LEFT JOIN modal_location USING (user_id)
            LEFT JOIN modal_device USING (user_id))"""
    dimensions = ("plan_type", "billing_cycle", "payment_method", "location", "device_type")
    parts = []
    for own in [*combinations(dimensions, 1), *combinations(dimensions, 2)]:
        columns = ", ".join(c if c in own else f"NULL::VARCHAR AS {c}" for c in dimensions)
        parts.append(f"""
            SELECT {columns}, '{",".join(own)}' AS sliced_by, count(*) AS total_subscribers, {CHURNED} AS churned_count,
                   {pct(CHURNED, 'count(*)')} AS churn_rate, {avg2('total_actions')} AS avg_actions_per_user,
                   {avg2('features_adopted')} AS avg_features_adopted
            FROM people GROUP BY {", ".join(own)}""")
    return ["engagement", "modal_location", "modal_device", "subscriptions"], f"+ {people} {' UNION ALL '.join(parts)}"


MODELS["compare_fixed_scores"] = (["labelled_scores"], f"""
    + models AS (
        SELECT 'given' AS model_name, p, y, prediction FROM labelled_scores
        UNION ALL SELECT 'reversed', 1 - p, y, 1 - prediction FROM labelled_scores
        UNION ALL SELECT 'coarse', floor(p * 4) / 4, y, prediction FROM labelled_scores),
    {auc('SELECT model_name, p, y FROM models', 'model_name')},
    cells AS (
        SELECT model_name, count(*) AS c, sum(y) AS pos, sum(prediction) AS said, sum(prediction * y) AS tp
        FROM models GROUP BY 1),
    metrics AS (
        SELECT model_name, roc, pr, (tp + c - pos - said + tp) / c AS accuracy,
               (pos * coalesce(tp / nullif(said, 0), 0)
                 + (c - pos) * coalesce((c - pos - said + tp) / nullif(c - said, 0), 0)) / c AS prec
        FROM areas JOIN cells USING (model_name))
    SELECT model_name, round(roc, 4) AS roc_auc, round(pr, 4) AS pr_auc, round(accuracy, 4) AS accuracy,
           round(prec, 4) AS precision, round(accuracy, 4) AS recall,
           CASE WHEN roc = max(roc) OVER () THEN 'Best ROC-AUC' ELSE '' END AS best_roc_auc,
           CASE WHEN pr = max(pr) OVER () THEN 'Best PR-AUC' ELSE '' END AS best_pr_auc
    FROM metrics""")
MODELS["features_at_cutoffs"] = _at_cutoffs()
MODELS["churn_slices"] = _slices()
MODELS["last_use_before_ticket"] = (["behavior"], """
    SELECT t.user_id, t."timestamp", t.session_id, u.matched_time, u.last_feature_name, u.last_device_type
    FROM behavior t LEFT JOIN LATERAL (
        SELECT "timestamp" AS matched_time, feature_name AS last_feature_name, device_type AS last_device_type
        FROM behavior b WHERE b.user_id = t.user_id AND b.action_type = 'feature_use' AND b."timestamp" <= t."timestamp"
        ORDER BY 1 DESC, 2 DESC, 3 DESC LIMIT 1) u ON true
    WHERE t.action_type = 'support_ticket'""")


# Queries that are also run as of a day inside the data.
SNAPSHOTS = (
    "feature_matrix",
    "activity_recency",
    "retention_funnel",
    "cohort_retention",
    "weekly_engagement_trend",
    "monthly_churn_trend",
    "kpi_scorecard",
)


def snapshot_name(name):
    return f"{name}_{SNAPSHOT_DAY.replace('-', '_')}"


def oracle_sql():
    found = {name: with_inputs(inputs, body) for name, (inputs, body) in MODELS.items()}
    at_day = snapshot_inputs()
    for name in SNAPSHOTS:
        inputs, body = MODELS[name]
        found[snapshot_name(name)] = with_inputs([*inputs, "subscriptions"], moved(body), *at_day)
    return found
