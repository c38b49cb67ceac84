"""Fixture views over the driver's tables (FIXTURES.md, part B).

The driver supplies generic tables; the operators need transaction events, a
validated table, a decision log and delayed labels.  These functions derive
them from ``events`` with pure column expressions (one scan, no shuffle except
where the operator itself needs one), so every query built on them grows with
the ``events`` table.  ``plans/oracle.py`` holds the same definitions as DuckDB
SQL text for the correctness gate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import scalar as P
from ..functions.expectations import validate
from ..session import checkpoint_dir, fingerprint, path_exists, scratch_path, write_scratch
from .tables import table

# FIXED VALUES: fixture constants (FIXTURES.md B1-B4).
EPOCH_US = 1704067200000000          # 2024-01-01 00:00:00 UTC
TIME_SQUEEZE = 120                   # 30 days -> 6 hours
DRIFT_START = "2024-01-20 00:00:00"
FIXTURE_COUNTRIES = ["US", "GB", "CA", "DE", "IN", "BR", "SG", "AU", "FR", "JP", "NG", "ZZ"]
AS_OF = "2024-01-01 06:05:00"        # monitoring windows on created_at
AS_OF_LABELS = "2024-01-01 07:00:00"  # labeler / performance runs


def txn(spark: SparkSession, sf_dir: str, duplicates: bool = False) -> DataFrame:
    """B1: transaction events (one per ``events`` row; ``duplicates=True`` adds replays)."""
    e = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    event_ts = F.expr(f"cast(timestamp_micros({EPOCH_US} + (unix_micros(cast(ts as timestamp)) - {EPOCH_US})"
                      f" div {TIME_SQUEEZE}) as timestamp_ntz)")
    amount = F.round(F.when(eid % 23 == 0, F.col("value") * 50).otherwise(F.col("value")), 2)
    country = F.element_at(F.array(*[F.lit(c) for c in FIXTURE_COUNTRIES]), (eid % 12).cast("int") + 1)
    home = F.element_at(F.array(*[F.lit(c) for c in C.COUNTRIES]), (F.col("user_id") % 11).cast("int") + 1)
    channel = (F.when(eid % 50 == 0, "kiosk").when(eid % 2 == 0, "mobile").otherwise("web"))
    lab = (amount >= 500).cast("int").cast("string")
    payload = (F.when(eid % 3 == 0, F.concat(F.lit('{"is_fraud":'), lab, F.lit("}")))
                .when(eid % 3 == 1, F.concat(F.lit('{"label":'), lab, F.lit("}")))
                .otherwise(F.lit("{}")))
    out = e.select(
        eid.cast("string").alias("event_id"),
        F.when(eid % 71 == 0, "txn.updated").otherwise("txn.created").alias("event_type"),
        event_ts.alias("event_ts"),
        F.col("user_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("merchant_id"),
        (eid % 97).alias("device_id"),
        (eid % 61).alias("ip_id"),
        amount.alias("amount"),
        country.alias("country"),
        channel.alias("channel"),
        F.when(F.col("ts") >= P.ts_lit(DRIFT_START), 1).otherwise(0).cast("int").alias("drift_phase"),
        home.alias("home_country"),
        (eid % 19 == 0).cast("int").alias("is_new_device"),
        (eid % 29 == 0).cast("int").alias("is_new_ip"),
        payload.alias("payload"),
    )
    out = (out.withColumn("currency", P.currency_of("country"))
              .withColumn("geo_mismatch", P.geo_mismatch("country", "home_country"))
              .withColumn("validated_at", F.col("event_ts") + F.expr("INTERVAL 2 SECONDS")))
    if duplicates:
        dup = (out.where(F.col("event_id").cast("bigint") % 41 == 0)
                  .withColumn("validated_at", F.col("validated_at") + F.expr("INTERVAL 1 SECOND")))
        out = out.unionByName(dup)
    return out


def txn_validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid rows of B1 (default suite on the typed table)."""
    t = txn(spark, sf_dir)
    # every column is computed once per row: without the inline() the optimizer repeats the derived columns'
    # expressions in each of the suite's predicates, and a filter evaluates them all again
    v = validate(t.select(F.inline(F.array(F.struct(*t.columns)))))
    return v.where("is_valid").drop("failed", "is_valid")


_FEATURES: dict = {}


def validated_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The validated rows with their velocity features (W1-W5), both made and written once per application and input.

    Decisions, model frames, snapshots and explanations of one query read their columns from here.
    """
    from ..operators.windows import velocity_features

    key = (spark.sparkContext.applicationId, sf_dir, fingerprint(spark, f"{sf_dir.rstrip('/')}/events.parquet"))
    if key not in _FEATURES or not path_exists(spark, _FEATURES[key][0]):
        path = scratch_path(spark, "validated-features")
        f = velocity_features(write_scratch(txn_validated(spark, sf_dir), "validated"))
        f.write.parquet(path)
        _FEATURES[key] = path, f.schema
    path, schema = _FEATURES[key]
    return spark.read.schema(schema).parquet(path)


def decision_log(spark: SparkSession, sf_dir: str, rescored: bool = True,
                 velocity_method: str = "prefix", validated: DataFrame | None = None,
                 features: DataFrame | None = None) -> DataFrame:
    """B2: decisions for the validated rows, with fixed model scores.

    The rows and the totals of the velocity features read the validated rows: those are validated and written once,
    by the caller (``validated``) or here.  ``features``: the validated rows with their velocity features
    (``validated_features``), which then are not computed again.

    Rules (M1) run on the velocity features; champion / anomaly scores are fixed
    expressions of ``event_id`` (null on a pattern) so every blend branch occurs.
    """
    from ..operators.scoring import score_decisions

    v = features if features is not None else validated if validated is not None else \
        write_scratch(txn_validated(spark, sf_dir), "validated")
    eid = F.col("event_id").cast("bigint")
    champion = F.when(eid % 10 != 9, ((eid * 37) % 101).cast("double") / 100.0)
    anomaly = F.when(eid % 7 != 6, ((eid * 53) % 101).cast("double") / 100.0)
    return score_decisions(
        v, champion=champion, anomaly=anomaly,
        served_by=F.when(F.col("user_id") % 100 < 20, "v2").otherwise("v1"),
        created_at=F.col("event_ts") + F.expr("INTERVAL 1 MINUTE"),
        latency_total=(F.lit(5) + eid % 40).cast("double"),
        empty_features=(eid % 13 == 0),
        rescored=(eid % 37 == 0) if rescored else None,
        velocity_method=velocity_method,
        with_features=features is None,
    )


def txn_labels(spark: SparkSession, sf_dir: str, validated: DataFrame | None = None) -> DataFrame:
    """Ground-truth labels for even event ids, 30 minutes after the first decision.

    The first decision of an event is made at ``event_ts + 1 minute``, so the
    label table is a projection of the validated rows (no join needed).
    """
    v = validated if validated is not None else txn_validated(spark, sf_dir)
    return v.where(F.col("event_id").cast("bigint") % 2 == 0).select(
        "event_id",
        P.payload_label("payload", default=0).alias("label"),
        F.lit(C.GROUND_TRUTH_SOURCE).alias("label_source"),
        (F.col("event_ts") + F.expr("INTERVAL 31 MINUTES")).alias("labeled_at"),
    )


# FIXED VALUES: raw-message breakage pattern (B5), checked in this priority order.
BREAKAGE = [
    (53, "truncated"),      # not JSON at all -> dead letter
    (59, "float_id"),       # "user_id": 5.0 -> integer-type expectation fails
    (67, "missing_user"),   # user_id key absent -> not-null fails
    (73, "negative_ip"),    # ip_id -1 -> between fails
    (79, "zero_amount"),    # amount 0 -> between fails
    (83, "no_z"),           # event_ts without Z -> regex fails
]


def raw_messages(spark: SparkSession, sf_dir: str, duplicates: bool = True,
                 materialize: bool = True) -> DataFrame:
    """B1 rendered as JSON messages (one ``raw`` text per event) with broken lines.

    Columns: ``seq`` (arrival order key), ``raw``.  Replays of ``event_id % 41 = 0``
    arrive again later (``duplicates``).
    """
    t = txn(spark, sf_dir, duplicates=duplicates)
    eid = F.col("event_id").cast("bigint")
    lab = (F.col("amount") >= 500).cast("int")
    msg = F.to_json(F.struct(
        "event_id", "event_type", P.iso_utc("event_ts").alias("event_ts"), *C.ID_COLUMNS,
        "amount", "currency", "country", "channel", "drift_phase",
        F.when(eid % 3 == 0, lab).alias("is_fraud"), F.when(eid % 3 == 1, lab).alias("label")))
    broken = (F.when(eid % 53 == 0, F.substring(msg, 1, 20))
               .when(eid % 59 == 0, F.regexp_replace(msg, '"user_id":(-?[0-9]+)', '"user_id":$1.0'))
               .when(eid % 67 == 0, F.regexp_replace(msg, '"user_id":-?[0-9]+,', ""))
               .when(eid % 73 == 0, F.regexp_replace(msg, '"ip_id":[0-9]+', '"ip_id":-1'))
               .when(eid % 79 == 0, F.regexp_replace(msg, '"amount":[-0-9.eE+]+', '"amount":0'))
               .when(eid % 83 == 0, F.regexp_replace(msg, 'Z"', '"'))
               .otherwise(msg))
    # arrival order: event time, then first copy before its replay
    seq = F.concat(F.date_format("validated_at", "yyyyMMddHHmmssSSSSSS"), F.lit("-"),
                   F.lpad(F.col("event_id"), 12, "0"))
    out = t.select(seq.alias("seq"), F.col("validated_at").alias("arrived_at"), broken.alias("raw"))
    if not materialize:
        return out
    # The message text is the *source* of the validate-and-route path (files or a
    # broker topic in production).  Writing it once to the shared checkpoint
    # folder gives the operators a plain scan to start from, as a file source
    # would, instead of re-deriving (and re-rendering) the JSON text in every
    # expression that reads it.
    checkpoint_dir(spark)
    return out.checkpoint(eager=True)
