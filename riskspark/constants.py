"""Fixed domain values.

FIXED VALUES — these must equal the reference pipeline's values for results to
match (expectation sets, rule thresholds, decision tiers, blend weights, label
keys).  They are stated plainly, in their natural order.
"""

# --- fixed values: validation domains -------------------------------------
REQUIRED_COLUMNS = [
    "event_id", "event_type", "event_ts", "user_id", "merchant_id", "device_id",
    "ip_id", "amount", "currency", "country", "channel", "drift_phase",
]
ID_COLUMNS = ["user_id", "merchant_id", "device_id", "ip_id"]
COUNTRIES = ["US", "GB", "CA", "DE", "IN", "BR", "SG", "AU", "FR", "JP", "NG"]
CURRENCIES = ["USD", "GBP", "CAD", "EUR", "INR", "BRL", "SGD", "AUD", "JPY", "NGN"]
CHANNELS = ["web", "mobile"]
EVENT_TYPES = ["txn.created"]
DRIFT_PHASES = [0, 1]
AMOUNT_MIN = 0.01
AMOUNT_MAX = 100000.0
EVENT_TS_REGEX = r"^\d{4}-\d{2}-\d{2}T.*Z$"
VOLUME_WINDOW_SECONDS = 60
VOLUME_SPIKE_THRESHOLD = 20000

# --- fixed values: country -> currency (NG only appears in the drift phase) --
COUNTRY_CURRENCY = {
    "US": "USD", "GB": "GBP", "CA": "CAD", "DE": "EUR", "IN": "INR", "BR": "BRL",
    "SG": "SGD", "AU": "AUD", "FR": "EUR", "JP": "JPY", "NG": "NGN",
}

# --- fixed values: rules model --------------------------------------------
RULE_THRESHOLDS = {
    "high_amount": 1500.0,
    "very_high_amount": 5000.0,
    "velocity_count_5m": 6.0,
    "velocity_amount_1h": 2500.0,
    "merchant_risk": 0.8,
    "base_risk": 0.05,
    "high_risk": 0.95,
    "elevated_risk": 0.75,
}

# --- fixed values: decision tiers and blend weights ------------------------
DECISION_THRESHOLDS = {"block": 0.92, "review": 0.80, "step_up": 0.55}
BLEND = {
    "both": (0.6, 0.4),            # champion, anomaly
    "champion_only": (0.8, 0.2),   # champion, rules
    "anomaly_only": (0.7, 0.3),    # anomaly, rules
}

# --- fixed values: labels ---------------------------------------------------
PAYLOAD_LABEL_KEYS = ["is_fraud", "label", "isFraud"]
GROUND_TRUTH_SOURCE = "synthetic_ground_truth"
PROXY_SOURCE = "proxy_rule"

# --- fixed values: feature views (entity keys, windows, TTL) ---------------
ENTITY_KEYS = ["user_id", "merchant_id", "device_id", "ip_id"]
FEATURE_TTL_DAYS = 90
VELOCITY_FEATURES = [
    # (name, aggregate, window)
    ("user_txn_count_5m", "count", "5 minutes"),
    ("user_txn_count_1h", "count", "1 hour"),
    ("user_amount_sum_1h", "sum", "1 hour"),
    ("user_avg_amount_30d", "avg", "30 days"),
]
CONSTANT_FEATURES = ["merchant_chargeback_rate_30d", "device_risk_score", "ip_risk_score"]
FEATURE_VIEWS = {
    "user_id": ["user_txn_count_5m", "user_txn_count_1h", "user_amount_sum_1h",
                "user_avg_amount_30d"],
    "merchant_id": ["merchant_chargeback_rate_30d"],
    "device_id": ["device_risk_score"],
    "ip_id": ["ip_risk_score"],
}

# --- fixed values: monitoring / feedback defaults ---------------------------
SLICE_DIMS = ["country", "channel", "drift_phase", "served_by"]
MIN_ROWS_PERF = 200
MIN_ROWS_DRIFT = 200
RETRAIN_MIN_LABELED_ROWS = 500
RETRAIN_F1_FLOOR = 0.6
RETRAIN_PRECISION_FLOOR = 0.5
PERF_THRESHOLD = 0.7
SLICE_THRESHOLD = 0.5
LOW_METRIC_FLAG = 0.2
CHAMPION_MAX_FPR = 0.2
DRIFT_SHARE = 0.5
DRIFT_P_VALUE = 0.05
DRIFT_DISTANCE = 0.1
DRIFT_SMALL_SAMPLE = 1000
LABEL_BATCH = 500
LABEL_DELAY_MINUTES = 5
RECENT_MAX = 200
MODEL_REF_CHARS = 40

# FIXED VALUES: upper bounds of the score-delta histogram's buckets.
DELTA_BUCKETS = [0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0, float("inf")]
