"""One row per host from its banners.

Defined cases
    * banners without ip are no host's; null elements and values are left out of every set.
    * org and city are the first non-empty ones in order of rec_id; hosts with more distinct ports than the limit are honeypots
      (a missing port counts as one).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborlens.functions.text import given

HONEYPOT_PORTS = 100


def first_given(value: str, order: str):
    """The value of the first row, by order, that isn't null or empty. Combines on the map side, unlike a window."""
    return F.min(F.when(F.coalesce(F.col(value), F.lit("")) != "", F.struct(F.col(order), F.col(value).alias("v"))))["v"]


def aggregate_hosts(banners: DataFrame, by: list[str]) -> DataFrame:
    """by, ip and the host's sets. Sets are of distinct elements, so they don't follow a host's number of banners."""
    rows = banners.drop("ip").where("ip_str <> ''").withColumnRenamed("ip_str", "ip")
    sets = {"hostnames": given(F.col("hostnames")), "domains": given(F.col("domains")), "cves": F.coalesce(F.map_keys("vulns"), F.array().cast("array<string>"))}
    scalar = rows.groupBy(*by, "ip").agg(
        first_given("org", "rec_id").alias("org"),
        first_given("city", "rec_id").alias("city"),
        F.array_sort(F.collect_set("port")).alias("ports"),
        F.max(F.col("port").isNull().cast("int")).alias("portless"),
        F.array_sort(F.collect_set(F.when(F.col("product") != "", F.col("product")))).alias("products"),
        *[F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))).alias(name) for name, c in sets.items()],
        F.count(F.lit(1)).alias("n_banners"),
    )
    return scalar.withColumn("n_ports", (F.size("ports") + F.col("portless")).cast("bigint")).drop("portless")


def without_honeypots(hosts: DataFrame, most: int = HONEYPOT_PORTS) -> DataFrame:
    return hosts.where(F.col("n_ports") <= most)
