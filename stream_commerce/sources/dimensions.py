"""Dimension tables kept in a database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stream_commerce.schemas import PROVINCE_INFO


def jdbc_options(url: str, table: str, user: str, password: str, driver: str) -> dict[str, str]:
    return {"url": url, "dbtable": table, "user": user, "password": password, "driver": driver}


def jdbc_provinces(
    spark: SparkSession, url: str, user: str, password: str, driver: str,
    table: str = "base_province",
) -> DataFrame:
    """Province rows, all columns as text; read again on every use, so changes are seen."""
    loaded = spark.read.format("jdbc").options(
        **jdbc_options(url, table, user, password, driver)
    ).load()
    return loaded.select(*[
        loaded[name].cast("string").alias(name) for name in PROVINCE_INFO.fieldNames()
    ])
