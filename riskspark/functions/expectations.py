"""Validation expectations (V1-V16) as boolean column expressions.

A suite is data: a list of ``Expectation(name, kind, column, params)``.  Folding
the suite yields one projection of boolean "failed" flags, so validating a table
is a single scan + projection (no per-row Python, no per-expectation pass);
the table report (V14) is one aggregate over the same flags.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C


@dataclass(frozen=True)
class Expectation:
    name: str            # stable expectation name used in reasons / reports
    kind: str            # not_null | between | in_set | regex | integer | columns
    column: str | None = None
    params: dict = field(default_factory=dict)

    @property
    def key(self) -> str:
        return f"{self.name}:{self.column}" if self.column else self.name


def default_suite(integer_check: bool = True) -> list[Expectation]:
    """V12 built-in suite (the reference's programmatic suite)."""
    s = [Expectation("expect_table_columns_to_match_set", "columns",
                     params={"column_set": list(C.REQUIRED_COLUMNS)})]
    s += [Expectation("expect_column_values_to_not_be_null", "not_null", c) for c in C.REQUIRED_COLUMNS]
    s.append(Expectation("expect_column_values_to_be_between", "between", "amount",
                         {"min_value": C.AMOUNT_MIN, "max_value": C.AMOUNT_MAX}))
    s.append(Expectation("expect_column_values_to_be_in_set", "in_set", "country", {"value_set": C.COUNTRIES}))
    s.append(Expectation("expect_column_values_to_be_in_set", "in_set", "currency", {"value_set": C.CURRENCIES}))
    s.append(Expectation("expect_column_values_to_be_in_set", "in_set", "channel", {"value_set": C.CHANNELS}))
    s.append(Expectation("expect_column_values_to_be_in_set", "in_set", "event_type", {"value_set": C.EVENT_TYPES}))
    s.append(Expectation("expect_column_values_to_be_in_set", "in_set", "drift_phase", {"value_set": C.DRIFT_PHASES}))
    for c in C.ID_COLUMNS:
        s.append(Expectation("expect_column_values_to_be_between", "between", c, {"min_value": 0}))
        if integer_check:
            s.append(Expectation("expect_column_values_to_be_of_type", "integer", c, {"type_": "int64"}))
    s.append(Expectation("expect_column_values_to_match_regex", "regex", "event_ts", {"regex": C.EVENT_TS_REGEX}))
    return s


def suite_from_json(doc: str | dict) -> list[Expectation]:
    """A JSON suite document (``expectations: [{type|expectation_type, kwargs}]``)."""
    d = json.loads(doc) if isinstance(doc, str) else doc
    out = []
    kinds = {
        "expect_table_columns_to_match_set": "columns",
        "expect_column_values_to_not_be_null": "not_null",
        "expect_column_values_to_be_between": "between",
        "expect_column_values_to_be_in_set": "in_set",
        "expect_column_values_to_match_regex": "regex",
        "expect_column_values_to_be_of_type": "integer",
    }
    for e in d.get("expectations", []):
        name = e.get("expectation_type") or e.get("type")
        kw = dict(e.get("kwargs", {}))
        col = kw.pop("column", None)
        if name == "expect_table_columns_to_match_set":
            kw.setdefault("exact_match", True)
        if name not in kinds:
            raise ValueError(f"unknown expectation type {name!r}")
        out.append(Expectation(name, kinds[name], col, kw))
    return out


def _raw_token(raw: Column | None, column: str) -> Column | None:
    return None if raw is None else F.get_json_object(raw, f"$.{column}")


def failed_flag(df: DataFrame, e: Expectation, raw: Column | None = None,
                present: Column | None = None, tokens: dict[str, Column] | None = None) -> Column:
    """True when the row fails ``e``.  Value expectations ignore nulls (V2 catches them).

    ``raw`` is the original JSON text when validating a stream of messages; the
    integer check (V10) then reads the raw token (``5.0`` is not an integer even
    though it casts), as does the column-set check (V1) via the message keys.
    """
    c = F.col(e.column) if e.column and e.column in df.columns else (
        F.lit(None) if e.column else None)
    p = e.params
    if e.kind == "columns":
        want = sorted(set(p["column_set"]))
        if present is not None:
            have = F.array_sort(F.array_distinct(present))
            return ~(have == F.array(*[F.lit(x) for x in want]))
        have = set(df.columns) if p.get("exact_match", False) else set(df.columns) & set(want)
        return F.lit(sorted(have) != want)
    if e.kind == "not_null":
        return c.isNull()
    if e.kind == "between":
        fails = F.lit(False)
        if p.get("min_value") is not None:
            fails = fails | (c < F.lit(p["min_value"]))
        if p.get("max_value") is not None:
            fails = fails | (c > F.lit(p["max_value"]))
        return F.coalesce(fails, F.lit(False))
    if e.kind == "in_set":
        return F.coalesce(~c.isin(*p["value_set"]), F.lit(False))
    if e.kind == "regex":
        if e.column in df.columns and df.schema[e.column].dataType.typeName() in ("timestamp", "timestamp_ntz"):
            from .scalar import iso_utc
            c = iso_utc(c)  # typed timestamps are checked in their ISO-8601 UTC rendering
        return F.coalesce(~c.cast("string").rlike(p["regex"]), F.lit(False))
    if e.kind == "integer":
        tok = (tokens or {}).get(e.column, _raw_token(raw, e.column))
        if tok is None:  # typed table: integral type is guaranteed by the schema
            return F.lit(False)
        return F.coalesce(~tok.rlike(r"^-?[0-9]+$"), F.lit(False)) & tok.isNotNull()
    raise ValueError(f"unknown expectation kind {e.kind}")


def validate(df: DataFrame, suite: list[Expectation] | None = None, raw: str | None = None,
             present: str | None = None) -> DataFrame:
    """Adds ``failed`` (array of failed expectation names, suite order) and ``is_valid``."""
    suite = suite or default_suite(integer_check=raw is not None)
    rawc = F.col(raw) if raw else None
    presc = F.col(present) if present else None
    names = F.array_compact(F.array(*[
        F.when(failed_flag(df, e, rawc, presc), F.lit(e.name)) for e in suite]))
    return df.withColumn("failed", names).withColumn("is_valid", F.size("failed") == 0)


def validation_report(df: DataFrame, suite: list[Expectation] | None = None, raw: str | None = None,
                      present: str | None = None, tokens: dict[str, Column] | None = None) -> DataFrame:
    """Per expectation, evaluated rows, unexpected count, success -- one aggregate pass.

    ``tokens``: columns that already hold a message's raw token for the integer check (V10).
    """
    suite = suite or default_suite(integer_check=raw is not None)
    rawc = F.col(raw) if raw else None
    presc = F.col(present) if present else None
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, e in enumerate(suite):
        aggs.append(F.sum(failed_flag(df, e, rawc, presc, tokens).cast("int")).alias(f"_f{i}"))
    wide = df.agg(*aggs)
    stack = ", ".join(f"{i}, '{e.name}', '{e.column or ''}', _f{i}" for i, e in enumerate(suite))
    return (wide.selectExpr("_n", f"stack({len(suite)}, {stack}) as (ordinal, expectation, column, unexpected)")
                .select("ordinal", "expectation", "column", F.col("_n").alias("evaluated"),
                        F.coalesce(F.col("unexpected"), F.lit(0)).cast("bigint").alias("unexpected"),
                        (F.coalesce(F.col("unexpected"), F.lit(0)) == 0).alias("success")))


def expect_columns(df: DataFrame, column_set=None) -> DataFrame:
    """V1 / U2 on a table schema: missing and unexpected column names (no job runs)."""
    want = list(column_set or C.REQUIRED_COLUMNS)
    spark = df.sparkSession
    have = list(df.columns)
    return spark.createDataFrame(
        [(sorted(set(want) - set(have)), sorted(set(have) - set(want)), set(want) == set(have))],
        "missing array<string>, unexpected array<string>, success boolean")
