"""Fixed values and parameter defaults.

FIXED VALUES: the domains, bounds and labels below must equal the published ones for results to match.
"""

AS_OF = "2024-01-31"

# Domains of the behaviour and subscription tables.
ACTION_TYPES = ["login", "page_view", "feature_use", "support_ticket"]
FEATURE_NAMES = ["dashboard", "analytics", "reports", "integrations", "api_access", "support_portal"]
DEVICE_TYPES = ["desktop", "mobile", "tablet"]
LOCATIONS = ["US", "EU", "APAC", "LATAM"]
PLAN_TYPES = ["basic", "pro", "enterprise"]
BILLING_CYCLES = ["monthly", "annual"]
PAYMENT_METHODS = ["credit_card", "paypal", "bank_transfer"]
CHURN_REASONS = ["price", "features", "support", "competitor", "no_longer_needed"]
ACCESS_METHODS = ["desktop", "mobile-web", "mobile-app"]
RISK_TIERS = ["high_risk", "medium_risk", "low_risk"]

# Manifest timestamp format, file-name pattern and sampled hours.
MANIFEST_TIME_FORMAT = "dd-MMM-yyyy HH:mm"
PAGEVIEW_FILE = r"pageviews-(\d{8}-\d{2})"
PAGEVIEW_FILE_TIME = "yyyyMMdd-HH"
PEAK_HOURS = (12, 16)
DATA_SOURCE = "wikimedia_pageviews"

# Inclusive upper bounds and labels of the bands; the last label has no bound.
VIEW_COUNT_BANDS = [
    (0, "0"),
    (10, "1-10"),
    (100, "11-100"),
    (1000, "101-1K"),
    (10000, "1K-10K"),
    (None, "10K+"),
]
LENGTH_BANDS = [(30, "0-30 days"), (60, "31-60 days"), (90, "61-90 days"), (None, "90+ days")]
MATRIX_STAGES = [(30, "new"), (90, "early"), (365, "established"), (None, "veteran")]
LIFECYCLE_STAGES = [(30, "new"), (90, "early"), (None, "established")]
FUNNEL_STAGES = [
    (30, "New Subscribers (0-30 days)"),
    (90, "Early Stage (31-90 days)"),
    (365, "Established (91-365 days)"),
    (None, "Veteran (365+ days)"),
]
AGE_STAGES = [
    (30, "New (0-30 days)"),
    (90, "Early (31-90 days)"),
    (365, "Established (91-365 days)"),
    (None, "Veteran (365+ days)"),
]
SURVIVAL_MONTHS = [
    (30, "Month 1"),
    (60, "Month 2"),
    (90, "Month 3"),
    (120, "Month 4"),
    (150, "Month 5"),
    (180, "Month 6"),
    (None, "Month 6+"),
]

# Inclusive lower bounds and labels, highest first.
RETENTION_GRADES = [(90, "Excellent"), (80, "Good"), (70, "Fair"), (60, "Poor"), (None, "Critical")]
ENGAGEMENT_LEVELS = [
    (100, 4, "High Engagement"),
    (50, 2, "Medium Engagement"),
    (20, 1, "Low Engagement"),
    (None, None, "Minimal Engagement"),
]
ADOPTION_SEGMENTS = [
    (5, "Power User (5+ features)"),
    (3, "Regular User (3-4 features)"),
    (1, "Basic User (1-2 features)"),
    (None, "Feature Averse (0 features)"),
]

# Risk thresholds and scorecard benchmarks.
MEDIUM_RISK_PROBABILITY = 0.3
RISK_BANDS = [(0.7, "red"), (0.3, "yellow"), (None, "green")]
MODEL_VERSION = "v1.0"
# Scorecard benchmark as shown, bound of the named status, bound of "At Risk", named status.
BENCHMARKS = {
    "Churn Rate": ("15.2%", 15.2, 12.0, "Above Target"),
    "High Risk Users": ("5%", 5, 3, "Above Target"),
    "Feature Adoption Rate": ("3.0", 2.5, 3.0, "Below Target"),
    "Early Stage Retention": ("85%", 80, 85, "Below Target"),
}

# Lookback, horizon and window lengths in days.
FEATURE_LOOKBACK_DAYS = 30
PREDICTION_HORIZON_DAYS = 30
COHORT_WINDOW_DAYS = 180
CHURN_TREND_DAYS = 365
ENGAGEMENT_TREND_DAYS = 90

# Partition column of the layer tables by the timestamp it is cut from, and its unit.
PARTITIONS = {
    "timestamp": ("event_date", "day"),
    "subscription_start": ("start_month", "month"),
    "file_timestamp": ("file_date", "day"),
}

# Model settings and the tuning grid.
FOREST = {"numTrees": 100, "maxDepth": 10, "seed": 42}
BOOSTING = {"maxIter": 100, "maxDepth": 6, "seed": 42}
LOGISTIC = {"maxIter": 100, "regParam": 0.1, "elasticNetParam": 0.0}
TUNING_GRID = {
    "numTrees": [50, 100, 200],
    "maxDepth": [5, 10, 15],
    "minInstancesPerNode": [1, 5, 10],
    "maxBins": [32, 64, 128],
}
