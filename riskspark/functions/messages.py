"""Raw JSON message parsing for the validate-and-route path.

Every field is read as text first (``from_json`` with a string schema keeps the
original token, so ``5.0`` stays ``5.0``), then cast with ``try_cast``.  A line
whose text is not a JSON object is a dead letter; anything that parses goes
through the expectation suite.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from .expectations import Expectation, default_suite, failed_flag

TEXT_SCHEMA = ", ".join(f"{c} STRING" for c in C.REQUIRED_COLUMNS + ["is_fraud", "label", "isFraud"])


def parse_messages(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Adds ``is_dead``, text fields ``s_*`` and typed fields (``event_ts`` stays text for V11)."""
    keys = F.json_object_keys(F.col(raw))
    p = F.from_json(F.col(raw), TEXT_SCHEMA)
    out = df.withColumn("_keys", keys).withColumn("_p", p)
    out = out.withColumn("is_dead", F.col("_keys").isNull())
    cols = []
    for c in C.REQUIRED_COLUMNS:
        cols.append(F.when(~F.col("is_dead"), F.col(f"_p.{c}")).alias(f"s_{c}"))
    out = out.select(*df.columns, "is_dead", F.col("_keys").alias("keys"), *cols)
    num = {c: F.col(f"s_{c}").try_cast("double") for c in C.ID_COLUMNS + ["amount", "drift_phase"]}
    return out.select(
        "*",
        F.col("s_event_id").alias("event_id"),
        F.col("s_event_type").alias("event_type"),
        F.col("s_event_ts").alias("event_ts"),
        *[num[c].alias(c) for c in C.ID_COLUMNS],
        num["amount"].alias("amount"),
        F.col("s_currency").alias("currency"),
        F.col("s_country").alias("country"),
        F.col("s_channel").alias("channel"),
        num["drift_phase"].alias("drift_phase"),
    )


def message_suite(integer_check: bool = True) -> list[Expectation]:
    return default_suite(integer_check=integer_check)


def validate_messages(parsed: DataFrame, suite: list[Expectation] | None = None) -> DataFrame:
    """V13 over parsed messages: ``failed`` names (suite order) and ``is_valid`` (dead rows excluded).

    The integer-type check reads the text token (``s_<col>``).
    """
    suite = suite or message_suite()
    flags = []
    for e in suite:
        if e.kind == "integer":
            tok = F.col(f"s_{e.column}")
            f = tok.isNotNull() & ~tok.rlike(r"^-?[0-9]+$")
        elif e.kind == "columns":
            f = F.lit(False)  # messages are re-indexed to the required columns first
        else:
            f = failed_flag(parsed, e)
        flags.append(F.when(f, F.lit(e.name)))
    failed = F.array_compact(F.array(*flags))
    return (parsed.withColumn("failed", F.when(~F.col("is_dead"), failed))
                  .withColumn("is_valid", ~F.col("is_dead") & (F.size(F.col("failed")) == 0)))


def typed_validated(v: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Typed ``txn_validated`` row of a valid message (ints, double, UTC timestamp)."""
    return v.select(
        "event_id", "event_type",
        F.col("event_ts").try_cast("timestamp").cast("timestamp_ntz").alias("event_ts"),
        *[F.col(c).cast("bigint").alias(c) for c in C.ID_COLUMNS],
        F.col("amount").cast("double").alias("amount"),
        "currency", "country", "channel", F.col("drift_phase").cast("int").alias("drift_phase"),
        F.col("raw").alias("payload"),
        *(extra or []),
    )
