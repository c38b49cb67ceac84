"""Offline training frame (M13) and model training / evaluation compositions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import scalar as P
from ..operators import joins as J
from ..operators.windows import velocity_features

NUMERIC = [n for n, _, _ in C.VELOCITY_FEATURES] + C.CONSTANT_FEATURES
CONTEXT = ["amount", "geo_mismatch", "is_new_device", "is_new_ip", "drift_phase"]


def feature_views(validated: DataFrame, features: DataFrame | None = None) -> dict[str, DataFrame]:
    """Feature rows per entity key: ``(key, event_ts, validated_at, features...)``; ``features``: the offline table, if written."""
    from ..session import write_scratch

    # the offline feature table is computed once and written to the shared checkpoint
    # folder (as an offline store would hold it); the four views read their columns from it
    f = features if features is not None else write_scratch(velocity_features(validated), "offline-features")
    return {k: f.select(k, "event_ts", "validated_at", *cols) for k, cols in C.FEATURE_VIEWS.items()}


def training_frame(validated: DataFrame, labels: DataFrame | None = None, strict: bool = True,
                   ttl: str = f"{C.FEATURE_TTL_DAYS} days", features: DataFrame | None = None) -> DataFrame:
    """Entity rows -> point-in-time features of 4 views (J1) -> context (J7) -> label.

    ``features``: the validated rows with their velocity features, if they are written already.

    ``strict`` fails the job when any feature is still null after the joins.
    """
    from ..session import write_scratch

    # entities and features of four views read the validated rows about ten times: they are validated and written once
    validated = features if features is not None else write_scratch(validated, "validated")
    # the context (J7) is columns of the same rows: it rides along in the one join of the features
    ent = validated.select("event_id", "event_ts", *C.ID_COLUMNS, *CONTEXT, "country", "channel", "payload")
    frame = J.historical_features(ent, feature_views(validated, features), ts="event_ts", created="validated_at", ttl=ttl)
    if labels is not None:
        frame = J.training_base(frame, labels)
        lab = P.training_label(frame, key="is_fraud", delayed="delayed_label")
    else:
        lab = P.training_label(frame, key="is_fraud")
    frame = P.label_status(frame.withColumn("label", lab), "label")
    if strict:
        anynull = F.lit(False)
        for c in NUMERIC:
            anynull = anynull | F.col(c).isNull()
        frame = frame.withColumn("_chk", F.assert_true(~anynull, F.lit("null feature in training frame"))) \
            .drop("_chk")
    return frame.drop("payload", *[c for c in ("delayed_label",) if c in frame.columns])


def model_features(frame: DataFrame) -> tuple[DataFrame, list[str]]:
    """One-hot country / channel and the frozen feature list."""
    names = P.one_hot_fit(frame, ["country", "channel"])
    oh = P.one_hot(frame, ["country", "channel"], names, drop_source=False)
    return oh, NUMERIC + CONTEXT + names
