"""The date-partitioned store: idempotent days, views, retention.

Defined cases
    * writing a day replaces its partition; a day without rows loses its partition.
    * a day is staged first and then takes the old one's place by renames; if that fails the old one is put back, so a reader
      or a job that dies never leaves half a day.
    * a store without any day gives empty views with the tables' columns.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborlens.operators.exposure import current_state, lifecycle
from harborlens.session import file_system as _fs
from harborlens.session import move


def replace_day(rows: DataFrame, path: str, day: str) -> int:
    """rows (without date) become the partition of the day; computed once. Returns their number."""
    spark, target, mark = rows.sparkSession, f"{path}/date={day}", uuid.uuid4().hex
    staged, old = f"{path}/_staged-{mark}", f"{path}/_old-{mark}"  # names that readers skip
    fs, goal = _fs(spark, target)
    try:
        rows.drop("date").write.parquet(staged)
        n = spark.read.parquet(staged).count()  # from the footers
        had = fs.exists(goal)
        if had:
            move(spark, target, old)
        if n:
            try:
                move(spark, staged, target)
            except BaseException:
                if had:
                    move(spark, old, target)
                raise
        fs.delete(_fs(spark, old)[1], True)
        return n
    finally:
        fs.delete(_fs(spark, staged)[1], True)


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    fs, p = _fs(spark, path)
    if not fs.exists(p) or not len(fs.listStatus(p)):
        return spark.createDataFrame([], schema)
    return spark.read.option("mergeSchema", "true").option("basePath", path).parquet(path)


def wipe(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def expire(spark: SparkSession, path: str, before: str) -> list[str]:
    """Removes the partitions of days before the given one; returns their days."""
    fs, p = _fs(spark, path)
    names = [x.getPath() for x in fs.listStatus(p)] if fs.exists(p) else []
    old = [x for x in names if x.getName().startswith("date=") and x.getName()[5:] < before]
    for x in old:
        fs.delete(x, True)
    return sorted(x.getName()[5:] for x in old)


def register_views(observations: DataFrame, vulns: DataFrame) -> None:
    """observations, vulns, current_state and lifecycle as views for SQL."""
    order = observations if "obs_id" in observations.columns else observations.withColumn("obs_id", F.col("hash"))
    observations.createOrReplaceTempView("observations")
    vulns.createOrReplaceTempView("vulns")
    current_state(order).createOrReplaceTempView("current_state")
    lifecycle(observations).createOrReplaceTempView("lifecycle")
