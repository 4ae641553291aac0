"""Observations and vulnerabilities from banners, the current state, and lifecycles.

Defined cases
    * banners without ip have no row; cpe23 and the other lists are joined by commas, '' for none; a missing hash is ``None``.
    * the current row of a service is the one of the latest date, then banner_ts (null lowest), then obs_id.
    * a null port is a service of its own in groupings and meets nothing in joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborlens.functions.text import day_of_file, joined
from harborlens.operators.classify import classify
from harborlens.operators.hosts import aggregate_hosts


def with_city(banners: DataFrame) -> DataFrame:
    return banners.withColumn("date", day_of_file(F.col("src_file"))).withColumn("city", F.col("location.city"))


def project(banners: DataFrame, strict: bool = False) -> DataFrame:
    """The 20 columns of observations (and rec_id), with each host's tier of that day. A time that is none is null or, if strict, an error."""
    rows = with_city(banners.drop("tier")).where("ip_str <> ''")
    hosts = aggregate_hosts(rows, ["date"])
    tiers = hosts.select("date", F.col("ip").alias("ip_str"), classify(F.col("org"), F.col("hostnames"), F.col("domains"), F.col("ports"))["tier"].alias("tier"))
    flat = rows.join(tiers, ["date", "ip_str"])
    info = F.col("info") if "info" in flat.columns else F.lit(None).cast("string").alias("info")
    time = F.col("timestamp").cast("timestamp_ntz") if strict else F.col("timestamp").try_cast("timestamp_ntz")
    return flat.select(
        "rec_id", "date", F.col("ip_str").alias("ip"), "port", "transport", F.col("asn").cast("string").alias("asn"), "org", "isp", "product", F.col("version").cast("string").alias("version"),
        joined(F.col("cpe23")).alias("cpe23"), F.col("_shodan.module").alias("service"), info, "city", F.col("location.region_code").alias("region_code"),
        joined(F.col("hostnames")).alias("hostnames"), joined(F.col("domains")).alias("domains"), joined(F.col("tags")).alias("tags"),
        time.alias("banner_ts"), F.coalesce(F.col("hash").cast("string"), F.lit("None")).alias("hash"), "tier",
    )


def vulnerabilities(banners: DataFrame, kev: DataFrame, epss: DataFrame) -> DataFrame:
    """One row per banner and CVE, not deduplicated. kev and epss are joined by CVE; Spark broadcasts them while they are small."""
    rows = banners.where("ip_str <> ''").select(day_of_file(F.col("src_file")).alias("date"), F.col("ip_str").alias("ip"), "port", F.explode("vulns").alias("cve", "detail"))
    scored = rows.withColumn("cvss", F.when(F.ltrim("detail").startswith("{"), F.get_json_object("detail", "$.cvss").try_cast("double")))
    return enrich(scored, kev, epss).select("date", "ip", "port", "cve", "cvss", "in_kev", "epss")


def enrich(rows: DataFrame, kev: DataFrame, epss: DataFrame, missing: Column | None = None) -> DataFrame:
    """rows with in_kev and epss by cve; an unknown probability is null, or ``missing``."""
    listed = kev.select("cve", F.lit(True).alias("_listed")).distinct()
    scores = epss.groupBy("cve").agg(F.max("epss").alias("epss"))
    out = rows.drop("in_kev", "epss").join(listed, "cve", "left").join(scores, "cve", "left").withColumn("in_kev", F.coalesce("_listed", F.lit(False))).drop("_listed")
    return out if missing is None else out.withColumn("epss", F.coalesce("epss", missing))


def current_state(observations: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The newest row of each (ip, port). As an aggregation it combines on the map side: a hot service isn't one task's."""
    rest = [c for c in columns or observations.columns if c not in ("ip", "port")]
    newest = F.max_by(F.struct(*rest), F.struct("date", "banner_ts", "obs_id"))
    return observations.groupBy("ip", "port").agg(newest.alias("row")).select("ip", "port", *[F.col(f"row.{c}").alias(c) for c in rest])


def lifecycle(observations: DataFrame) -> DataFrame:
    """ip, port, first_seen, last_seen, days_observed, span_days."""
    days = observations.groupBy("ip", "port").agg(F.min("date").alias("first_seen"), F.max("date").alias("last_seen"), F.count_distinct("date").alias("days_observed"))
    return days.withColumn("span_days", (F.datediff("last_seen", "first_seen") + 1).cast("bigint"))


def keep_first(rows: DataFrame, within: list[str], ip: str = "ip_str", time: str = "timestamp", order: str = "rec_id") -> DataFrame:
    """The first banner of each key within the given columns: the hash, else ip:port:time with ``None`` for what is missing."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("None"))
    key = F.coalesce(F.col("hash").cast("string"), F.concat_ws(":", part(ip), part("port"), part(time)))
    first = rows.select(*within, key.alias("key"), order).groupBy(*within, "key").agg(F.min(order).alias(order)).select(order)
    return rows.join(first, order, "left_semi")


def merge_parts(parts: list[DataFrame], within: list[str], order: str = "rec_id") -> DataFrame:
    """The union of what several queries brought, the first banner of each key in the parts' order; place tells the part.

    A banner that several parts brought is kept from the first of them. ``order`` is unique within a part.
    """
    every = None
    for i, part in enumerate(parts):
        placed = part.withColumn("place", F.lit(i)).withColumn("_turn", F.struct(F.lit(i).alias("place"), F.col(order).alias("nth")))
        every = placed if every is None else every.unionByName(placed, allowMissingColumns=True)
    return keep_first(every, within, order="_turn").drop("_turn")
