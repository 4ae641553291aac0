"""Enrichment feeds: listed vulnerabilities, exploit probabilities, networks.

Defined cases
    * a feed that isn't there is an empty dimension; comment lines, headers and lines without a number are skipped.
    * of repeated CVEs in the probabilities the last line counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborlens.session import file_system


def keep(dimension: DataFrame, path: str) -> DataFrame:
    """The dimension as a Parquet table of its own, so that its feed is parsed once and not with every day; replaced whole."""
    dimension.coalesce(1).write.mode("overwrite").parquet(path)
    return dimension.sparkSession.read.parquet(path)


def _there(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def listed(spark: SparkSession, path: str) -> DataFrame:
    """cve, from a JSON document with vulnerabilities[].cveID."""
    if not _there(spark, path):
        return spark.createDataFrame([], "cve string")
    doc = spark.read.schema("vulnerabilities array<struct<cveID:string>>").option("multiLine", "true").json(path)
    return doc.select(F.explode("vulnerabilities.cveID").alias("cve")).where("cve is not null").distinct()


def probabilities(spark: SparkSession, path: str) -> DataFrame:
    """cve, epss, from a CSV of cve and score."""
    if not _there(spark, path):
        return spark.createDataFrame([], "cve string, epss double")
    lines = spark.read.text(path).withColumn("line", F.monotonically_increasing_id())
    cells = F.split("value", ",")
    rows = lines.where(~F.col("value").startswith("#")).select(F.trim(cells[0]).alias("cve"), F.get(cells, F.lit(1)).try_cast("double").alias("epss"), "line")
    return rows.where("cve <> '' and cve <> 'cve' and epss is not null").groupBy("cve").agg(F.max_by("epss", "line").alias("epss"))


def networks(spark: SparkSession, path: str) -> DataFrame:
    """cidr, country, region, from a CSV with a header."""
    schema = "cidr string, country string, region string"
    return spark.read.schema(schema).option("header", "true").csv(path) if _there(spark, path) else spark.createDataFrame([], schema)
