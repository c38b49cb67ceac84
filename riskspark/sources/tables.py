"""Table readers.

Reads are lazy: a column list becomes a ``select`` that Catalyst pushes into
the parquet scan (``ReadSchema`` shows only those columns) and filters applied
later are pushed as ``PushedFilters``.  CSV is read with an explicit schema
(never ``inferSchema``, which costs a full extra pass at scale).
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import constants as C
from ..session import path_exists


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table: ``{sf_dir}/{name}.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_transactions(spark: SparkSession, path: str, fmt: str | None = None,
                      columns: list[str] | None = None, required: list[str] | None = None,
                      schema: StructType | str | None = None) -> DataFrame:
    """S1 read by suffix (parquet / csv); S2 ordered de-duplicated column list; S4 required gate."""
    fmt = fmt or _suffix_format(path)
    if not path_exists(spark, path):
        raise FileNotFoundError(f"Dataset not found at {path}")
    if fmt == "parquet":
        df = spark.read.parquet(path)
    elif fmt == "csv":
        r = spark.read.option("header", "true")
        df = r.schema(schema).csv(path) if schema is not None else r.csv(path)
    else:
        raise ValueError(f"unknown format for {path}")
    if required:
        missing = [c for c in required if c not in df.columns]
        if missing:
            raise ValueError(f"Missing required columns: {missing}")
    if columns:
        seen, ordered = set(), []
        for c in columns:
            if c not in seen:
                seen.add(c)
                ordered.append(c)
        df = df.select(*ordered)
    return df


def require_timestamp(df: DataFrame, col: str = "event_ts", fail: bool = True) -> DataFrame:
    """S3: parse ``col`` to a UTC timestamp; with ``fail`` any unparsable value raises at run time.

    ``assert_true`` runs inside the same scan (no extra pass over the data).
    """
    parsed = F.try_to_timestamp(F.col(col).cast("string"))
    if df.schema[col].dataType.typeName() in ("timestamp", "timestamp_ntz"):
        parsed = F.col(col)
    out = df.withColumn(col, parsed)
    if fail:
        out = out.withColumn(col, F.when(F.assert_true(F.col(col).isNotNull(),
                                                       F.lit(f"invalid {col}")).isNull(), F.col(col)))
    return out


def invalid_timestamp_count(df: DataFrame, col: str = "event_ts") -> DataFrame:
    """S3 as a query: number of values that do not parse."""
    parsed = F.try_to_timestamp(F.col(col).cast("string"))
    return df.agg(F.count_if(F.col(col).isNotNull() & parsed.isNull()).alias("invalid"))


#: columns of the four profile files that are not text
PROFILE_TYPES = {
    "users": {"user_id": "bigint", "avg_amount_30d": "double", "baseline_activity_rate": "double", "baseline_risk": "double"},
    "merchants": {"merchant_id": "bigint", "merchant_chargeback_rate": "double", "merchant_risk_tier": "int"},
    "devices": {"device_id": "bigint", "device_risk_score": "double"},
    "ips": {"ip_id": "bigint", "ip_risk_score": "double"},
}
PROFILE_KEYS = {"users": "user_id", "merchants": "merchant_id", "devices": "device_id", "ips": "ip_id"}


def read_profiles(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """Users / merchants / devices / ips dimension files (CSV with header), typed by column name.

    No schema is inferred (that would be a pass over the data); a value that does not parse is null.  Files that are
    not there are left out.
    """
    out = {}
    for name, types in PROFILE_TYPES.items():
        p = f"{directory.rstrip('/')}/{name}.csv"
        if path_exists(spark, p):
            raw = spark.read.option("header", "true").option("inferSchema", "false").csv(p)
            out[name] = raw.select(*[F.col(f"`{c}`").try_cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in raw.columns])
    return out


def _suffix_format(path: str) -> str:
    p = path.lower().rstrip("/")
    if p.endswith(".parquet") or p.endswith(".pq"):
        return "parquet"
    if p.endswith(".csv"):
        return "csv"
    raise ValueError(f"unknown format for {path}")


REQUIRED_TXN = C.REQUIRED_COLUMNS
