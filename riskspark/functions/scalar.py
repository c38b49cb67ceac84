"""Column-level functions (projections, labels, tiers, flags).

Every function here returns a ``Column`` or a projected ``DataFrame`` built only
from built-in Spark expressions, so it stays inside whole-stage codegen and is
pushed / pruned by Catalyst like any other projection.  Nothing here shuffles;
the two helpers that need a table-wide fact (``label_status``, ``one_hot_fit``)
use an uncorrelated scalar subquery or a distinct-values aggregate.
"""

from __future__ import annotations

import hashlib
import json
import re
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C


def col_or(df: DataFrame, name: str, default) -> Column:
    """``df[name]`` when present, else a literal default (missing column = default)."""
    return F.col(name) if name in df.columns else F.lit(default)


def ts_lit(value) -> Column:
    """Timestamp literal as TIMESTAMP_NTZ (UTC wall clock)."""
    if isinstance(value, datetime):
        if value.tzinfo is not None:
            value = value.astimezone(timezone.utc).replace(tzinfo=None)
        value = value.isoformat(sep=" ")
    return F.to_timestamp_ntz(F.lit(str(value)))


# --------------------------------------------------------------------------
# P12 time literals
# --------------------------------------------------------------------------
_REL = re.compile(r"^now\s*([+-])\s*(\d+)\s*([smhdw])$")
_UNIT = {"s": "seconds", "m": "minutes", "h": "hours", "d": "days", "w": "weeks"}


def parse_time(value, now: datetime | None = None) -> datetime:
    """``now``, ``now±N[smhdw]`` or ISO-8601 (naive = UTC) -> naive UTC datetime.

    Evaluated once on the driver and injected as a literal, so every task of a
    job sees the same instant (checked queries always pass explicit instants).
    """
    if isinstance(value, datetime):
        dt = value
    else:
        s = str(value).strip()
        base = now or datetime.now(timezone.utc)
        if s == "now":
            dt = base
        else:
            m = _REL.match(s)
            if m:
                delta = timedelta(**{_UNIT[m.group(3)]: int(m.group(2))})
                dt = base + delta if m.group(1) == "+" else base - delta
            else:
                dt = datetime.fromisoformat(s.replace("Z", "+00:00"))
    if dt.tzinfo is not None:
        dt = dt.astimezone(timezone.utc).replace(tzinfo=None)
    return dt


# --------------------------------------------------------------------------
# P1, P2, P35 event projection / rendering
# --------------------------------------------------------------------------
def canonical_event(df: DataFrame) -> DataFrame:
    """Typed 12-column event; a missing ``event_id`` becomes a hash of the row."""
    row_hash = F.sha2(F.to_json(F.struct(*[F.col(c) for c in df.columns])), 256)
    eid = F.coalesce(F.col("event_id").cast("string"), row_hash) if "event_id" in df.columns else row_hash
    return df.select(
        eid.alias("event_id"),
        F.lit("txn.created").alias("event_type"),
        F.col("event_ts"),
        *[F.col(c).cast("bigint").alias(c) for c in C.ID_COLUMNS],
        F.col("amount").cast("double").alias("amount"),
        F.col("currency").cast("string").alias("currency"),
        F.col("country").cast("string").alias("country"),
        F.col("channel").cast("string").alias("channel"),
        F.col("drift_phase").cast("int").alias("drift_phase"),
    )


def iso_utc(ts: Column | str) -> Column:
    """ISO-8601 with ``Z``; fraction printed only when microseconds are non-zero."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "SSSSSS")
    return F.when(ts.isNull(), F.lit(None).cast("string")).otherwise(
        F.concat(whole, F.when(micros == "000000", F.lit("")).otherwise(F.concat(F.lit("."), micros)),
                 F.lit("Z")))


def to_payload(df: DataFrame, cols: list[str] | None = None) -> Column:
    """The event as JSON text."""
    return F.to_json(F.struct(*[F.col(c) for c in (cols or df.columns)]))


# --------------------------------------------------------------------------
# P3-P8 labels
# --------------------------------------------------------------------------
def derive_label(df: DataFrame) -> Column:
    """``is_fraud`` when present, else heuristic score >= 1."""
    score = (F.lit(0.0)
             + F.when(col_or(df, "amount", 0.0) >= 500, 1.0).otherwise(0.0)
             + F.when(F.coalesce(col_or(df, "geo_mismatch", 0), F.lit(0)) == 1, 1.0).otherwise(0.0)
             + F.when(F.coalesce(col_or(df, "is_new_device", 0), F.lit(0)) == 1, 0.75).otherwise(0.0)
             + F.when(F.coalesce(col_or(df, "is_new_ip", 0), F.lit(0)) == 1, 0.75).otherwise(0.0)
             + F.when(F.lower(F.coalesce(col_or(df, "channel", ""), F.lit(""))) == "mobile", 0.25)
             .otherwise(0.0))
    heuristic = (score >= 1.0).cast("int")
    if "is_fraud" in df.columns:
        return F.coalesce(F.col("is_fraud").cast("int"), heuristic)
    return heuristic


def payload_label(payload: Column | str, keys=None, default=None) -> Column:
    """First non-null of the label keys inside a JSON payload (unparsable -> null)."""
    payload = F.col(payload) if isinstance(payload, str) else payload
    keys = keys or C.PAYLOAD_LABEL_KEYS
    parts = [F.get_json_object(payload, f"$.{k}").try_cast("int") for k in keys]
    if default is not None:
        parts.append(F.lit(default))
    return F.coalesce(*parts) if len(parts) > 1 else parts[0]


def training_label(df: DataFrame, key: str = "is_fraud", delayed: str | None = None) -> Column:
    """Delayed label, then the chosen payload key, then ``is_fraud``, then ``label``."""
    parts = []
    if delayed:
        parts.append(F.col(delayed).cast("int"))
    order = [key] + [k for k in ("is_fraud", "label") if k != key]
    parts += [F.get_json_object(F.col("payload"), f"$.{k}").try_cast("int") for k in order]
    return F.coalesce(*parts)


def label_status(df: DataFrame, label: str = "label") -> DataFrame:
    """All labels null -> every label 0 with status 'missing'; else null -> 0, 'ok'.

    The table-wide fact is an uncorrelated scalar subquery (one partial+final
    aggregate), not a window over the whole table.
    """
    n_labels = df.agg(F.count(label)).scalar()
    return (df.withColumn(label, F.coalesce(F.col(label).cast("int"), F.lit(0)))
              .withColumn("label_status", F.when(n_labels == 0, "missing").otherwise("ok")))


def _hex_mod100(hexcol: Column) -> Column:
    """sha256 hex digest (64 chars) mod 100 without 256-bit integers.

    Horner over eight 32-bit chunks: r <- (r * (2^32 mod 100) + chunk) mod 100,
    with 2^32 mod 100 = 96.
    """
    r = F.lit(0).cast("bigint")
    for i in range(8):
        chunk = F.conv(F.substring(hexcol, 8 * i + 1, 8), 16, 10).cast("bigint")
        r = F.pmod(r * 96 + chunk, F.lit(100))
    return r


def proxy_label(event_id: Column | str, drift_phase: Column | str, amount: Column | str,
                channel: Column | str) -> Column:
    """Proxy label score (drift .5, amount>=1000 .4, mobile .2, hash jitter) >= .75."""
    c = [F.col(x) if isinstance(x, str) else x for x in (event_id, drift_phase, amount, channel)]
    eid, drift, amt, ch = c
    jitter = _hex_mod100(F.sha2(eid.cast("string"), 256)).cast("double") / 1000.0
    score = F.lit(0.0)
    score = score + F.when(F.coalesce(drift, F.lit(0)) == 1, 0.5).otherwise(0.0)
    score = score + F.when(F.coalesce(amt, F.lit(0.0)) >= 1000, 0.4).otherwise(0.0)
    score = score + F.when(F.lower(F.coalesce(ch, F.lit(""))) == "mobile", 0.2).otherwise(0.0)
    score = score + jitter
    return (score >= 0.75).cast("int")


# --------------------------------------------------------------------------
# P9-P11 time windows
# --------------------------------------------------------------------------
def in_window(ts: str | Column, as_of, hours: float, closed: str = "left") -> Column:
    """P9 half-open ``[as_of-h, as_of)``; P10 ``closed='both'`` -> ``[start, end]``."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    end = parse_time(as_of)
    start = end - timedelta(hours=hours)
    if closed == "both":
        return ts.between(ts_lit(start), ts_lit(end))
    return (ts >= ts_lit(start)) & (ts < ts_lit(end))


def between_times(ts: str | Column, start, end) -> Column:
    """P10 with explicit bounds (closed on both ends)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return ts.between(ts_lit(parse_time(start)), ts_lit(parse_time(end)))


def window_tag(ts: str | Column, as_of, ref_hours: float, cur_hours: float) -> Column:
    """P11: 'cur' = last ``cur_hours`` before ``as_of``; 'ref' = the ``ref_hours`` before that."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    end = parse_time(as_of)
    cur_start = end - timedelta(hours=cur_hours)
    ref_start = cur_start - timedelta(hours=ref_hours)
    return (F.when((ts >= ts_lit(cur_start)) & (ts < ts_lit(end)), "cur")
             .when((ts >= ts_lit(ref_start)) & (ts < ts_lit(cur_start)), "ref"))


def hour_of_day(ts: str | Column) -> Column:
    """P13."""
    return F.hour(F.col(ts) if isinstance(ts, str) else ts)


# --------------------------------------------------------------------------
# P14-P20 feature frames
# --------------------------------------------------------------------------
def fill_context(df: DataFrame) -> DataFrame:
    """Defaults for ids-only scoring rows."""
    defaults = {"currency": F.lit("USD"), "distance_from_home_km": F.lit(0.0),
                "geo_mismatch": F.lit(0), "is_new_device": F.lit(0), "is_new_ip": F.lit(0),
                "drift_phase": F.lit(0)}
    out = df
    for name, lit in defaults.items():
        out = out.withColumn(name, F.coalesce(F.col(name), lit) if name in df.columns else lit)
    return out.withColumn("hour_of_day", hour_of_day("event_ts")) if "event_ts" in df.columns else out


def scoring_input(df: DataFrame, feature_cols: list[str] | None = None) -> DataFrame:
    """Amount 0, USD, US, web, drift 0; null features -> 0."""
    d = {"amount": F.lit(0.0), "currency": F.lit("USD"), "country": F.lit("US"),
         "channel": F.lit("web"), "drift_phase": F.lit(0)}
    out = df
    for name, lit in d.items():
        out = out.withColumn(name, F.coalesce(F.col(name), lit) if name in df.columns else lit)
    for c in feature_cols or []:
        out = out.withColumn(c, F.coalesce(F.col(c).cast("double"), F.lit(0.0))
                             if c in df.columns else F.lit(0.0))
    return out


def one_hot_fit(df: DataFrame, cats: list[str]) -> list[str]:
    """P16 (fit): names ``col=value`` of the distinct values, sorted.

    One distributed distinct over the categorical columns (partial aggregation on
    the map side); only the distinct value list -- bounded by category
    cardinality -- reaches the driver.
    """
    if not cats:
        return []
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in cats])).alias("p")
    ).select("p.c", "p.v").where(F.col("v").isNotNull()).distinct()
    return sorted(f"{r['c']}={r['v']}" for r in pairs.collect())


def one_hot(df: DataFrame, cats: list[str], names: list[str], drop_source: bool = True) -> DataFrame:
    """P16 (apply): one int column per ``col=value`` name."""
    cols = []
    for n in names:
        c, v = n.split("=", 1)
        if c in cats:
            cols.append(F.coalesce((F.col(c).cast("string") == v).cast("int"), F.lit(0)).alias(n))
    keep = [F.col(c) for c in df.columns if not (drop_source and c in cats)]
    return df.select(*keep, *cols)


def align_features(df: DataFrame, feature_list: list[str], keep: list[str] | None = None) -> DataFrame:
    """Add missing features as 0, drop extras, order as the frozen list."""
    keep = keep or []
    cols = [F.col(c) for c in keep]
    for f in feature_list:
        cols.append(F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(0.0)).alias(f)
                    if f in df.columns else F.lit(0.0).alias(f))
    return df.select(*cols)


def to_numeric(c: str | Column) -> Column:
    """Numeric coercion, bad / null -> 0."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("string").try_cast("double"), F.lit(0.0))


def feature_keys(df: DataFrame, col: str = "features") -> list[str]:
    """P19 helper: union of map keys (distributed distinct; key set is small)."""
    return sorted(r[0] for r in df.select(F.explode(F.map_keys(col))).distinct().collect())


def flatten_features(df: DataFrame, col: str = "features", keys: list[str] | None = None,
                     keep: list[str] | None = None) -> DataFrame:
    """Map column -> one column per key (null map = empty)."""
    keys = keys if keys is not None else feature_keys(df, col)
    m = F.coalesce(F.col(col), F.create_map().cast("map<string,double>"))
    return df.select(*[F.col(c) for c in (keep or [])], *[m.getItem(k).alias(k) for k in keys])


def has_features(col: str | Column = "features") -> Column:
    """P20."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.size(c) > 0, F.lit(False))


# --------------------------------------------------------------------------
# P21-P26 decisions / routing
# --------------------------------------------------------------------------
def decision_as_label(decision: str | Column) -> Column:
    """review/block -> 1, anything else (incl. null) -> 0."""
    d = F.col(decision) if isinstance(decision, str) else decision
    return F.when(F.lower(F.coalesce(d, F.lit(""))).isin("review", "block"), 1).otherwise(0)


def decide(score: str | Column, thresholds: dict | None = None) -> Column:
    """Block / review / step_up / approve tiers (>=)."""
    t = dict(C.DECISION_THRESHOLDS, **(thresholds or {}))
    s = F.col(score) if isinstance(score, str) else score
    return (F.when(s >= t["block"], "block").when(s >= t["review"], "review")
             .when(s >= t["step_up"], "step_up").otherwise("approve"))


def predict_at(score: str | Column, t: float = 0.5) -> Column:
    """1 when score >= t."""
    s = F.col(score) if isinstance(score, str) else score
    return (s >= F.lit(float(t))).cast("int")


def fraud_label_text(score: str | Column, t: float = 0.5) -> Column:
    """P23 text form."""
    return F.when(predict_at(score, t) == 1, "fraud").otherwise("legit")


def assign_variant(user_id: str | Column, pct: float) -> Column:
    """Canary when ``user_id mod 100 < pct`` (pct clamped to 0..100)."""
    u = F.col(user_id) if isinstance(user_id, str) else user_id
    p = max(0.0, min(100.0, float(pct)))
    return F.when(F.pmod(u, F.lit(100)) < F.lit(p), "v2").otherwise("v1")


def true_flags(m: str | Column) -> Column:
    """P25: sorted names of the true entries of a map<string,boolean>."""
    c = F.col(m) if isinstance(m, str) else m
    return F.array_sort(F.map_keys(F.map_filter(c, lambda k, v: F.coalesce(v, F.lit(False)))))


def model_ref(c: str | Column) -> Column:
    """40-char prefix, null -> ''."""
    c = F.col(c) if isinstance(c, str) else c
    return F.substring(F.coalesce(c.cast("string"), F.lit("")), 1, C.MODEL_REF_CHARS)


# --------------------------------------------------------------------------
# P27-P32 enrichment / explanation columns
# --------------------------------------------------------------------------
def currency_of(country: str | Column) -> Column:
    """Literal map lookup (no join; 11 entries)."""
    c = F.col(country) if isinstance(country, str) else country
    kv = []
    for k, v in C.COUNTRY_CURRENCY.items():
        kv += [F.lit(k), F.lit(v)]
    return F.create_map(*kv)[c]


def risk_tier(rate: str | Column, cuts=(0.01, 0.02)) -> Column:
    """Left-closed buckets at .01/.02 -> 0/1/2."""
    r = F.col(rate) if isinstance(rate, str) else rate
    return F.when(r >= cuts[1], 2).when(r >= cuts[0], 1).otherwise(0)


def clip(c: str | Column, lo: float = 0.0, hi: float = 1.0) -> Column:
    """P29."""
    c = F.col(c) if isinstance(c, str) else c
    return F.least(F.greatest(c, F.lit(lo)), F.lit(hi))


def geo_mismatch(country: str | Column = "country", home: str | Column = "home_country") -> Column:
    """P30."""
    a = F.col(country) if isinstance(country, str) else country
    b = F.col(home) if isinstance(home, str) else home
    return (a != b).cast("int")


# FIXED VALUES: rule and anomaly explanation messages, in rule order.
RULE_MESSAGES = [
    "Very high amount + suspicious context",
    "High amount + suspicious context",
    "High transaction velocity (5m)",
    "High spending velocity (1h)",
    "High-risk merchant",
]
ANOMALY_MESSAGES = [
    "Transaction looks highly unusual compared to baseline patterns",
    "Geo mismatch",
    "New device",
    "New IP",
    "Unusual velocity",
]


def _num(df: DataFrame, name: str) -> Column:
    return to_numeric(F.col(name)) if name in df.columns else F.lit(0.0)


def rules_triggered(df: DataFrame, thresholds: dict | None = None) -> Column:
    """Messages of the rules that fire, fixed order."""
    t = dict(C.RULE_THRESHOLDS, **(thresholds or {}))
    amt = _num(df, "amount")
    susp = (_num(df, "geo_mismatch") + _num(df, "is_new_device") + _num(df, "is_new_ip")) >= 1
    conds = [
        (amt >= t["very_high_amount"]) & susp,
        (amt >= t["high_amount"]) & susp,
        _num(df, "user_txn_count_5m") >= t["velocity_count_5m"],
        _num(df, "user_amount_sum_1h") >= t["velocity_amount_1h"],
        _num(df, "merchant_chargeback_rate_30d") >= t["merchant_risk"],
    ]
    return F.array_compact(F.array(*[F.when(c, F.lit(m)) for c, m in zip(conds, RULE_MESSAGES)]))


def anomaly_reasons(df: DataFrame, anomaly_score: str | Column = "anomaly_score",
                    thresholds: dict | None = None, limit: int = 4) -> Column:
    """At most ``limit`` reasons, fixed order."""
    t = dict(C.RULE_THRESHOLDS, **(thresholds or {}))
    a = F.col(anomaly_score) if isinstance(anomaly_score, str) else anomaly_score
    conds = [
        F.coalesce(a, F.lit(0.0)) > 0.8,
        _num(df, "geo_mismatch") >= 1,
        _num(df, "is_new_device") >= 1,
        _num(df, "is_new_ip") >= 1,
        (_num(df, "user_txn_count_5m") >= t["velocity_count_5m"])
        | (_num(df, "user_amount_sum_1h") >= t["velocity_amount_1h"]),
    ]
    arr = F.array_compact(F.array(*[F.when(c, F.lit(m)) for c, m in zip(conds, ANOMALY_MESSAGES)]))
    return F.slice(arr, 1, limit)


# --------------------------------------------------------------------------
# P33, P34, P36 quarantine and fingerprints
# --------------------------------------------------------------------------
def quarantine_id(event_id: str | Column, raw: str | Column) -> Column:
    """Event id, else ``unknown:<hash of raw text>`` (stable across replays)."""
    e = F.col(event_id) if isinstance(event_id, str) else event_id
    r = F.col(raw) if isinstance(raw, str) else raw
    return F.coalesce(F.nullif(e.cast("string"), F.lit("")),
                      F.concat(F.lit("unknown:"), F.substring(F.sha2(r, 256), 1, 16)))


def failure_reason(failed: str | Column, spike: str | Column | None = None) -> Column:
    """``validation_failed[: a, b]`` (sorted distinct names) [+ ``; volume_spike``]."""
    f = F.col(failed) if isinstance(failed, str) else failed
    names = F.array_sort(F.array_distinct(F.coalesce(f, F.array().cast("array<string>"))))
    base = F.when(F.size(names) == 0, F.lit("validation_failed")).otherwise(
        F.concat(F.lit("validation_failed: "), F.array_join(names, ", ")))
    if spike is None:
        return base
    s = F.col(spike) if isinstance(spike, str) else spike
    return F.when(F.coalesce(s, F.lit(False)), F.concat(base, F.lit("; volume_spike"))).otherwise(base)


def feature_hash_text(feature_list: list[str]) -> str:
    """P36 on the driver: sha256 of the JSON list (``json.dumps`` default separators)."""
    return hashlib.sha256(json.dumps(list(feature_list)).encode("utf-8")).hexdigest()


def feature_hash(arr: str | Column) -> Column:
    """P36 as a column: sha256 of ``["a", "b"]`` text (same separators as json.dumps)."""
    a = F.col(arr) if isinstance(arr, str) else arr
    body = F.array_join(F.transform(a, lambda x: F.concat(F.lit('"'), x, F.lit('"'))), ", ")
    return F.sha2(F.concat(F.lit("["), body, F.lit("]")), 256)
