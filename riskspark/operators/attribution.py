"""Per-event attribution of a fitted Spark ML ensemble (M14, tree path).

``attribute_trees`` reads the fitted model's node table (bounded by its size) and gives
exact path-dependent Shapley values of the raw margin in long form; see ``tree_model``
for the algorithm and for the forms that do not blow rows up by the number of features.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import scratch_path
from .tree_model import from_spark_ml, shap_long


def attribute_trees(df: DataFrame, model, features: list[str], key: str = "event_id") -> DataFrame:
    """Long ``(event_id, feature, contribution)`` plus a ``__base__`` row per event; their sum is the raw margin."""
    spark = df.sparkSession
    return shap_long(df, from_spark_ml(model, features, spark, scratch_path(spark, "gbt-model")), key)
