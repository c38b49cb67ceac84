"""Join operators.

Sizing rule: nothing is broadcast on faith.  ``broadcast_if_small`` checks the
optimizer's size estimate of the side against a byte budget and otherwise
leaves the join to a shuffle (sort-merge / shuffle-hash); AQE may still switch
to a broadcast at runtime from *measured* shuffle sizes, and splits skewed
partitions of a sort-merge join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C

BROADCAST_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString())
    except Exception:  # noqa: BLE001 - no estimate (e.g. Spark Connect)
        return None


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only when the estimated size is known and under ``max_bytes``."""
    est = estimated_bytes(df)
    return F.broadcast(df) if est is not None and est <= max_bytes else df


# ---------------------------------------------------------------------------
# J1 point-in-time join
# ---------------------------------------------------------------------------
def asof_join(entities: DataFrame, features: DataFrame, key: str, ts: str = "event_ts",
              created: str = "validated_at", ttl: str = f"{C.FEATURE_TTL_DAYS} days",
              feature_cols: list[str] | None = None, feature_ts: str | None = None,
              bucket: str = "1 day", prefix: str = "") -> DataFrame:
    """Per entity row, the latest feature row with ``f.ts <= e.ts`` and ``f.ts >= e.ts - ttl``.

    Of the feature rows of one key and instant the newest by ``created`` counts.  A null key or time has no features.
    No pairs are made; see ``_running`` for the plan.
    """
    from .windows import interval_micros

    fts = feature_ts or ts
    fcols = feature_cols or [c for c in features.columns if c not in (key, fts, created)]
    ent = entities.select(F.col(key).alias("_key"), _micros(ts).alias("_t"), F.struct(*entities.columns).alias("_e"))
    rows = _running(_feature_rows(features, key, fts, created, fcols), ent, ["_key"], interval_micros(bucket), interval_micros(ttl))
    return rows.select(*[F.col(f"_e.`{c}`") for c in entities.columns], *[F.col(f"_v.`{c}`").alias(prefix + c) for c in fcols])


def _micros(c: str) -> Column:
    return F.unix_micros(F.col(c).cast("timestamp"))


def _feature_rows(features: DataFrame, key: str, ts: str, created: str, cols: list[str]) -> DataFrame:
    return features.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(
        F.col(key).alias("_key"), _micros(ts).alias("_t"), F.col(created).alias("_created"),
        F.struct(*[F.col(c) for c in cols]).alias("_v"))


def _running(frows: DataFrame, erows: DataFrame, keys: list[str], bucket: int, ttl: int) -> DataFrame:
    """Entity rows ``(keys, _t, _e)`` with ``_v``, the newest feature at or before their instant and not older than ``ttl``.

    Features and entities are one table, partitioned by (keys, time bucket) so a hot key is spread over its buckets.
    One ordered window carries the newest feature along a bucket (features before entities at one instant, the newest
    ``_created`` last, so no rows have to be de-duplicated first); what a bucket starts with comes from a table of
    one row per (keys, bucket), aggregated before its shuffle.
    """
    f = frows.select(*keys, "_t", "_created", F.struct("_t", "_v").alias("_f"))
    u = f.unionByName(erows.select(*keys, "_t", "_e"), allowMissingColumns=True)
    u = u.withColumn("_b", F.floor(F.col("_t") / F.lit(bucket)))
    w = (Window.partitionBy(*keys, "_b").orderBy("_t", F.col("_e").isNotNull(), "_created")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    here = u.withColumn("_here", F.last("_f", ignorenulls=True).over(w)).where("_e is not null")
    when = F.when(F.col("_f").isNotNull(), F.struct("_t", "_created"))
    newest = u.groupBy(*keys, "_b").agg(F.max_by("_f", when).alias("_newest"))
    wk = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = newest.select(*keys, "_b", F.last("_newest", ignorenulls=True).over(wk).alias("_carry"))
    pick = F.coalesce("_here", "_carry")
    return here.join(carry, [*keys, "_b"], "left").select(
        *keys, "_t", "_e", F.when(pick["_t"] >= F.col("_t") - F.lit(ttl), pick["_v"]).alias("_v"))


def historical_features(entities: DataFrame, views: dict[str, DataFrame], ts: str = "event_ts",
                        created: str = "validated_at", ttl: str = f"{C.FEATURE_TTL_DAYS} days",
                        feature_lists: dict[str, list[str]] | None = None, bucket: str = "1 day") -> DataFrame:
    """J1 for several feature views at once: one merged as-of join over (view, key, time).

    The answer depends on an entity's time and keys alone, so only those go through the as-of join, once per view;
    the views' answers are put together per (time, keys) and joined to the entities once, whatever columns they have.
    Rows with a null time or a null key keep null features of the views concerned.
    """
    from .windows import interval_micros

    fl = feature_lists or C.FEATURE_VIEWS
    keys = list(views)
    cols = {k: fl.get(k) or [c for c in v.columns if c not in (k, ts, created)] for k, v in views.items()}
    probe = [ts, *keys]
    types = {d.schema[k].dataType.simpleString() for k, v in views.items() for d in (v, entities)}
    as_key = (lambda k: F.col(k)) if len(types) == 1 else (lambda k: F.col(k).cast("string"))
    asked = F.struct(*[F.col(c) for c in probe]).alias("_e")
    frows = erows = None
    for i, (k, v) in enumerate(views.items()):
        f = _feature_rows(v, k, ts, created, cols[k]).select(
            F.lit(i).alias("_view"), as_key("_key").alias("_key"), "_t", "_created", F.struct(F.col("_v").alias(f"v{i}")).alias("_v"))
        # one struct with a field per view, so the rows of all views have one type
        f = f.withColumn("_v", F.struct(*[F.col("_v")[f"v{j}"].alias(f"v{j}") if j == i else
                                          F.lit(None).cast(_struct_type(views[kj], cols[kj])).alias(f"v{j}") for j, kj in enumerate(keys)]))
        e = entities.where(F.col(k).isNotNull() & F.col(ts).isNotNull()).select(
            F.lit(i).alias("_view"), as_key(k).alias("_key"), _micros(ts).alias("_t"), asked)
        frows = f if frows is None else frows.unionByName(f)
        erows = e if erows is None else erows.unionByName(e)
    rows = _running(frows, erows, ["_view", "_key"], interval_micros(bucket), interval_micros(ttl))
    found = rows.groupBy(*[F.col(f"_e.`{c}`").alias(f"_p{n}") for n, c in enumerate(probe)]).agg(
        *[F.first(F.col("_v")[f"v{i}"][c], ignorenulls=True).alias(f"_v{i}_{n}") for i, k in enumerate(keys) for n, c in enumerate(cols[k])])
    same = [F.col(c).eqNullSafe(F.col(f"_p{n}")) for n, c in enumerate(probe)]
    on = same[0]
    for x in same[1:]:
        on = on & x
    return entities.join(found, on, "left").select(
        *entities.columns, *[F.col(f"_v{i}_{n}").alias(c) for i, k in enumerate(keys) for n, c in enumerate(cols[k])])


def _struct_type(df: DataFrame, cols: list[str]):
    return df.select(F.struct(*[F.col(c) for c in cols])).schema[0].dataType


# ---------------------------------------------------------------------------
# Label / payload / context joins
# ---------------------------------------------------------------------------
def decisions_with_labels(decisions: DataFrame, labels: DataFrame) -> DataFrame:
    """Decision log left join labels (fan-out on re-scored events is kept, as in the view)."""
    lab = labels.select("event_id", F.col("label").alias("true_label"), "label_source", "labeled_at")
    return decisions.join(lab, "event_id", "left")


def unlabeled(decisions: DataFrame, labels: DataFrame) -> DataFrame:
    """Decisions with no label yet (NOT EXISTS -> left anti)."""
    return decisions.join(labels.select("event_id"), "event_id", "left_anti")


def with_payload(decisions: DataFrame, validated: DataFrame) -> DataFrame:
    """Decisions left join validated payload."""
    return decisions.join(validated.select("event_id", "payload"), "event_id", "left")


def labeled_decisions(decisions: DataFrame, labels: DataFrame) -> DataFrame:
    """Inner join decisions-labels."""
    return decisions.join(labels.select("event_id", "label"), "event_id", "inner")


def attach_context(features: DataFrame, base: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Left join feature rows to base rows on a key list (multi-key mode keeps fan-out)."""
    keys = keys or ["event_id"]
    extra = [c for c in base.columns if c not in features.columns or c in keys]
    return features.join(base.select(*extra), keys, "left")


def training_base(validated: DataFrame, labels: DataFrame) -> DataFrame:
    """Validated left join delayed labels (``delayed_label``)."""
    return validated.join(labels.select("event_id", F.col("label").alias("delayed_label")), "event_id", "left")


# ---------------------------------------------------------------------------
# J8, J9, J14 online lookups
# ---------------------------------------------------------------------------
def online_features(events: DataFrame, snapshots: dict[str, DataFrame], strict: bool = False) -> DataFrame:
    """Each event joined to the latest snapshot of each entity key.

    ``strict`` raises at run time on a missing snapshot row (``assert_true``);
    lenient mode sets ``feast_failed``.
    """
    out = events
    found = []
    for key, snap in snapshots.items():
        cols = [c for c in snap.columns if c != key]
        flag = f"_found_{key}"
        s = snap.select(key, F.lit(True).alias(flag), *cols)
        out = out.join(broadcast_if_small(s), key, "left")
        found.append(F.coalesce(F.col(flag), F.lit(False)))
    all_found = F.lit(True)
    for f in found:
        all_found = all_found & f
    out = out.withColumn("feast_failed", ~all_found)
    if strict:
        out = out.withColumn("feast_failed", F.when(F.assert_true(~F.col("feast_failed"),
                                                                  F.lit("missing online features")).isNull(),
                                                    F.col("feast_failed")))
    return out.drop(*[f"_found_{k}" for k in snapshots])


def enrich_profiles(txn: DataFrame, dims: dict[str, tuple[str, DataFrame]]) -> DataFrame:
    """Left join each profile dimension ``{name: (key, df)}`` (broadcast only when small)."""
    out = txn
    for _, (key, d) in dims.items():
        out = out.join(broadcast_if_small(d), key, "left")
    return out


def latest_online(txn: DataFrame, snapshots: dict[str, DataFrame], ts: str = "validated_at") -> DataFrame:
    """The newest validated transaction (top-1) -> its online features."""
    latest = txn.orderBy(F.col(ts).desc(), F.col("event_id").desc()).limit(1)
    return online_features(latest, snapshots)


# ---------------------------------------------------------------------------
# J11-J13 shadow and slice context
# ---------------------------------------------------------------------------
def shadow_compare(v1: DataFrame, v2: DataFrame, keep_missing: bool = False) -> DataFrame:
    """Pair v1 and v2 answers of the same event."""
    a = v1.select("event_id", F.col("final_score").alias("v1_score"), F.col("decision").alias("v1_decision"),
                  F.col("latency_ms").alias("v1_latency_ms"))
    b = v2.select("event_id", F.col("final_score").alias("v2_score"), F.col("decision").alias("v2_decision"),
                  F.col("latency_ms").alias("v2_latency_ms"))
    j = a.join(b, "event_id", "left" if keep_missing else "inner")
    return j.select(
        "*",
        (F.coalesce(F.col("v2_score"), F.lit(0.0)) - F.coalesce(F.col("v1_score"), F.lit(0.0))).alias("score_delta"),
        (F.coalesce(F.col("v1_decision"), F.lit("")) != F.coalesce(F.col("v2_decision"), F.lit(""))).alias(
            "decision_diff"),
        F.col("v2_decision").isNull().alias("shadow_error"))


def slice_context(events: DataFrame, slices: DataFrame, dims: list[str] | None = None) -> DataFrame:
    """For each event and dimension, the matching slice row (first match per dimension)."""
    dims = dims or C.SLICE_DIMS
    ev = events.select("event_id", *[F.col(d).cast("string").alias(d) for d in dims])
    long = ev.unpivot("event_id", dims, "slice", "value")
    s = slices.withColumn("value", F.col("value").cast("string"))
    s = s.groupBy("slice", "value").agg(F.first(F.struct(*[c for c in s.columns if c not in ("slice", "value")]))
                                        .alias("_m")).select("slice", "value", "_m.*")
    return long.join(s, ["slice", "value"], "left")


def insert_ignore(target: DataFrame, batch: DataFrame, key: str = "event_id",
                  order: list[str] | None = None) -> DataFrame:
    """Rows of ``batch`` that an ``ON CONFLICT DO NOTHING`` insert would add.

    First write wins inside the batch (earliest by ``order``), then left-anti
    against keys already in the target.
    """
    from .windows import first_write

    b = first_write(batch, key, order or [key]) if order else batch.dropDuplicates([key])
    return b.join(target.select(key), key, "left_anti")


def col_or_null(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None)


__all__ = ["asof_join", "historical_features", "decisions_with_labels", "unlabeled", "with_payload",
           "labeled_decisions", "attach_context", "training_base", "online_features", "enrich_profiles",
           "latest_online", "shadow_compare", "slice_context", "insert_ignore", "broadcast_if_small"]
