"""Static schemas of the input and layer tables."""

from pyspark.sql import types as T

MANIFEST = T.StructType([
    T.StructField("filename", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("file_size_bytes", T.LongType()),
])

BEHAVIOR = T.StructType([
    T.StructField("user_id", T.StringType(), False),
    T.StructField("timestamp", T.TimestampNTZType(), False),
    T.StructField("session_id", T.StringType()),
    T.StructField("action_type", T.StringType(), False),
    T.StructField("feature_name", T.StringType()),
    T.StructField("duration_seconds", T.IntegerType()),
    T.StructField("page_url", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("location", T.StringType()),
])

SUBSCRIPTIONS = T.StructType([
    T.StructField("user_id", T.StringType(), False),
    T.StructField("subscription_start", T.TimestampNTZType(), False),
    T.StructField("subscription_end", T.TimestampNTZType()),
    T.StructField("plan_type", T.StringType(), False),
    T.StructField("billing_cycle", T.StringType(), False),
    T.StructField("payment_method", T.StringType()),
    T.StructField("churn_reason", T.StringType()),
    T.StructField("is_churned", T.BooleanType(), False),
])

PAGEVIEWS = T.StructType([
    T.StructField("project", T.StringType()),
    T.StructField("page_title", T.StringType()),
    T.StructField("view_count", T.IntegerType()),
    T.StructField("access_method", T.StringType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("file_timestamp", T.TimestampNTZType()),
])

# Driver table the streams read; timestamps without zone are cast before watermarking.
EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])
