"""Both layers as SQL views, and the standard distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from chartmill.config import Layout
from chartmill.operators.aggregate import describe, histogram, positive_histogram
from chartmill.schemas import BRONZE
from chartmill.sources import scans, store


def register_layer(spark: SparkSession, layout: Layout, layer: str = "silver") -> list[str]:
    """Each table of a layer as a view of its current version."""
    if layer == "bronze":
        tables = {name: store.scan_bronze(spark, layout, name) for name in BRONZE}
    else:
        tables = {name: store.read_build(spark, build) for name, build in store.current_builds(spark, layout).items()}
    return scans.register_views(spark, tables)


def age_and_stay(bronze: DataFrame) -> dict[str, DataFrame]:
    """Age and length-of-stay distributions of the encounters."""
    df = bronze.select("LOG_ID", "MRN", F.col("BIRTH_DATE").alias("age_years"), F.col("LOS").alias("los_days"))
    return {
        "describe": describe(df, ["age_years", "los_days"]),
        "age": histogram(df, "age_years", 40),
        "stay": histogram(df, "los_days", 60),
        "stay_positive": positive_histogram(df, "los_days", 60),
    }
